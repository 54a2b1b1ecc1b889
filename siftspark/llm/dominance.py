"""Dominance counting by a distributed range tree.

How many sales lie above each sale: a slot no later than its own and a level strictly higher.  Equal (slot, level) pairs are
one point with a count and a weight.  A point stands in the dyadic nodes over slots that hold its own slot, at each height at
which such a node can be part of a prefix; a query's prefix of slots is the union of one canonical node for each bit that is
set in its length.  In every node the points are sorted by level, highest first, with running sums.  A node's list is cut
into blocks of ``FAN`` levels, blocks into blocks of blocks and so on, so that a sort never has more than ``FAN`` rows
whatever the number of points: the top node's list is spread like all others.  Joins are merge joins: what grows with the input is
never broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftspark.llm.common import forget, written

#: Bits of a level that a block leaves out: a block has 64 levels or blocks of the next size.
BITS = 6
DAY = 86_400


def day_slot(at: str, kind: str) -> Column:
    """Whole days since 1970 of a time column of this type; times with a zone count in UTC, whatever the session's zone."""
    if kind == "timestamp":
        return F.floor(F.unix_seconds(at) / F.lit(DAY))
    return F.unix_date(F.col(at).cast("date")).cast("long")


def price_level(total: str) -> Column:
    """Tens of units, rounded to cents first, in doubles; null for null, NaN and infinite totals.  Beyond the range of longs
    all totals share a level."""
    value = F.col(total).cast("double")
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
    return F.when(finite, F.floor(F.floor(F.lit(100.0) * value + F.lit(0.5)) / F.lit(1000.0)))


def _bit(value: Column, height: int) -> Column:
    return F.shiftright(value, height).bitwiseAND(F.lit(1)) == 1


def _node(height: int, index: Column) -> Column:
    """A node's id: its place at its height, and the height in the last six bits."""
    return F.shiftleft(index, 6) + F.lit(height)


def _ancestors(slot: Column, heights: int) -> Column:
    """The nodes that hold a slot and can be part of a prefix: those of even places."""
    return F.array_compact(F.array(*[F.when(~_bit(slot, h), _node(h, F.shiftright(slot, h))) for h in range(heights)]))


def _prefix(slot: Column, heights: int) -> Column:
    """The canonical nodes whose union is the slots from 0 to this one."""
    end = slot + 1
    return F.array_compact(F.array(*[F.when(_bit(end, h), _node(h, F.shiftright(end, h) - 1)) for h in range(heights)]))


def _higher(rows: DataFrame, span: int) -> DataFrame:
    """(node, at, n, w) for each row, where n and w are the sums over the same node's rows of a larger ``at``.

    ``rows`` has one row for each node and ``at``, from 0 to ``span``."""
    block = F.shiftright("at", BITS)
    order = Window.partitionBy("node", "block").orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.coalesce(F.sum(c).over(order), F.lit(0)).alias(c) for c in ("n", "w")]
    inside = rows.withColumn("block", block).select("node", "at", "block", *sums)
    if span >> BITS == 0:
        return inside.drop("block")
    blocks = rows.groupBy("node", block.alias("at")).agg(F.sum("n").alias("n"), F.sum("w").alias("w"))
    beyond = _higher(blocks, span >> BITS).select("node", F.col("at").alias("block"), F.col("n").alias("_n"), F.col("w").alias("_w"))
    return inside.join(beyond.hint("merge"), ["node", "block"]).select("node", "at", (F.col("n") + F.col("_n")).alias("n"), (F.col("w") + F.col("_w")).alias("w"))


def dominators(points: DataFrame) -> DataFrame:
    """(slot, level, n, w) for each distinct (slot, level): the sums of n and w over all points of a slot no later and a
    strictly higher level.

    ``points`` has long columns slot, level, n and w and one row for each slot and level, without nulls, and is read several times; slots and levels
    may be negative and their ranges may span up to 2^56.  No points give no rows.
    """
    ends = points.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("slot", "level") for f in (F.min, F.max)]).first()
    if ends["min_slot"] is None:
        return points.sparkSession.createDataFrame([], points.schema)
    span, top = ends["max_slot"] - ends["min_slot"], ends["max_level"] - ends["min_level"]
    if max(span, top) >= 1 << 56:
        raise ValueError(f"slots or levels span {max(span, top)}, more than a node's id can hold")
    heights = (span + 1).bit_length()
    placed = points.select((F.col("slot") - ends["min_slot"]).alias("slot"), (F.col("level") - ends["min_level"]).alias("at"), "n", "w")
    asked = placed.select("slot", "at", F.explode(_prefix(F.col("slot"), heights)).alias("node"))
    held = placed.select(F.explode(_ancestors(F.col("slot"), heights)).alias("node"), "at", "n", "w")
    places = held.unionByName(asked.select("node", "at", F.lit(0).alias("n"), F.lit(0).alias("w")))
    lists = written(places.groupBy("node", "at").agg(F.sum("n").alias("n"), F.sum("w").alias("w")))
    found = asked.join(_higher(lists, top).hint("merge"), ["node", "at"]).groupBy("slot", "at").agg(F.sum("n").alias("n"), F.sum("w").alias("w"))
    out = written(found.select((F.col("slot") + ends["min_slot"]).alias("slot"), (F.col("at") + ends["min_level"]).alias("level"), "n", "w"))
    forget(lists)
    return out


def sales_above(sales: DataFrame, key: str = "sale_id", at: str = "sold_at", total: str = "total") -> DataFrame:
    """Every row's key, slot, level, the number of rows above it and the number of rows those stand for.

    A row of a null slot or level is above none and has null counts; with none above it both are 0.  A row stands for 1 + crc32(key) mod
    3 rows, one of a null key for 1.  Repeated rows are counted and returned each; other columns aren't read, whatever
    their names.  An empty table gives no rows.
    """
    kind = dict(sales.dtypes)[at]
    rows = sales.select(F.col(key).alias("key"), day_slot(at, kind).alias("slot"), price_level(total).alias("level"))
    placed = "slot is not null and level is not null"
    weight = F.coalesce(F.crc32(F.col("key").cast("string")) % 3, F.lit(0)) + 1
    points = written(rows.where(placed).groupBy("slot", "level").agg(F.count("*").alias("n"), F.sum(weight).alias("w")))
    counts = dominators(points).select("slot", "level", F.col("n").alias("n_sales"), F.col("w").alias("n_rows"))
    forget(points)
    none = F.lit(None).cast("long")
    out = rows.where(placed).join(counts.hint("merge"), ["slot", "level"], "left").select("key", "slot", "level", "n_sales", "n_rows")
    # Rows without a place don't go through the join, where all their nulls would meet in one task.
    rest = rows.where(f"not ({placed})").select("key", "slot", "level", none.alias("n_sales"), none.alias("n_rows"))
    return out.unionByName(rest).withColumnRenamed("key", key)


def op12_dominance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sale with the sales above it; see ``sales_above`` for nulls, ties, repeated rows and empty tables."""
    return sales_above(spark.read.parquet(f"{sf_dir}/sales.parquet"))


ORACLE = """
WITH s AS (
  SELECT sale_id, CAST(floor(epoch(sold_at) / 86400) AS BIGINT) AS slot, CAST(floor(floor(100 * total + 0.5) / 1000) AS BIGINT) AS level,
    1 + xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(sale_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 3 AS weight
  FROM sales),
p AS (SELECT slot, level, count(*) AS n, sum(weight) AS w FROM s WHERE slot IS NOT NULL AND level IS NOT NULL GROUP BY ALL),
c AS (SELECT q.slot, q.level, coalesce(sum(p.n), 0) AS n, coalesce(sum(p.w), 0) AS w FROM p q LEFT JOIN p ON p.slot <= q.slot AND p.level > q.level GROUP BY ALL)
SELECT sale_id, s.slot, s.level, CAST(n AS BIGINT) AS n_sales, CAST(w AS BIGINT) AS n_rows
FROM s LEFT JOIN c ON s.slot = c.slot AND s.level = c.level
"""
