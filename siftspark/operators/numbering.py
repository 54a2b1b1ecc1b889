"""Row numbers and running sums over a whole table without one task that sees all rows.

Rows are dealt into ranges of the order and written once; each range is summed, the few sums of the ranges give every range
its offset, and windows run inside ranges alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftspark.session import checkpointed


def _fresh(df: DataFrame, name: str) -> str:
    return name if name not in df.columns else _fresh(df, name + "_")


def prefix_sums(df: DataFrame, order: list[Column], sums: dict[str, Column], partitions: int | None = None) -> DataFrame:
    """All rows with a running sum of each value (nulls count 0), the row itself included, along the order.

    The order must end in a unique column; only then are ranges even where many rows share its first ones, and results the same each time.
    The offsets are one row a range, so what is broadcast has the size of the number of partitions.  An empty table gives no rows.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    lane, values, keys = _fresh(df, "_lane"), {x: _fresh(df, f"_v_{x}") for x in sums}, {x: _fresh(df, f"_o_{x}") for x in sums}
    rows = df.select("*", *[F.coalesce(c, F.lit(0)).alias(values[x]) for x, c in sums.items()])
    rows = checkpointed(rows.repartitionByRange(n, *order).withColumn(lane, F.spark_partition_id()))
    whole = rows.groupBy(lane).agg(*[F.sum(v).alias(v) for v in values.values()])
    before = Window.orderBy(lane).rowsBetween(Window.unboundedPreceding, -1)  # as many rows as ranges
    offsets = whole.select(lane, *[F.coalesce(F.sum(values[x]).over(before), F.lit(0)).alias(keys[x]) for x in sums])
    inside = Window.partitionBy(lane).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.join(F.broadcast(offsets), lane)
    return out.select(*df.columns, *[(F.sum(values[x]).over(inside) + F.col(keys[x])).alias(x) for x in sums])


def numbered(df: DataFrame, order: list[Column], name: str, start: int = 1, partitions: int | None = None) -> DataFrame:
    """All rows with their place along the order, from ``start``."""
    out = prefix_sums(df, order, {name: F.lit(1)}, partitions)
    return out.withColumn(name, F.col(name) + (start - 1))


def within_budget(df: DataFrame, order: list[Column], size: Column, budget: int) -> DataFrame:
    """All rows with ``used``, the sum of sizes up to the row, and ``fits``: whether the budget covers it.  Once a row doesn't fit, none
    after it does, as a global budget that is used up stops a run."""
    return prefix_sums(df, order, {"used": size}).withColumn("fits", F.col("used") <= budget)
