"""Names made unique over a whole table: a ladder of wishes, and the first free numbers for what is left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftspark.operators.numbering import numbered
from siftspark.session import checkpointed


def first_free(df: DataFrame, base: str, order: list[str], name: str, mark: str = "_", reserved: DataFrame | None = None) -> DataFrame:
    """All rows with a name of their own: the first row of a base keeps it, the others get ``base`` + ``mark`` + number.

    Numbers begin at 2 and skip those whose name is a base itself, or reserved (a table with one column ``base``); a
    reserved base is kept by no row.  So results are unique by construction: two bases never make the same numbered name, since what stands before its last
    mark is the base.  ``order`` must be unique within a base.  A null base stays null.

    A base that a third of all rows share is numbered in ranges like all others; the taken numbers of a base meet its rows by a join on
    both, never by a window over the base.
    """
    rows = df.where(F.col(base).isNotNull())
    keys = [F.asc(base), *[F.asc(c) for c in order]]
    placed = checkpointed(numbered(rows, keys, "_n"))
    start = placed.groupBy(base).agg(F.min("_n").alias("_first"))
    held = reserved.select(F.col("base").alias(base)).distinct().withColumn("_held", F.lit(1)) if reserved is not None else start.select(base, F.lit(1).alias("_held")).limit(0)
    ranked = placed.join(start.join(held, base, "left"), base).withColumn("_rank", F.col("_n") - F.col("_first") + F.coalesce("_held", F.lit(0)))  # 0 keeps the base
    # Taken numbers: bases (or reserved names) that read as another base, the mark and a number from 2 on without leading zeros.
    every = start.select(base).unionByName(held.select(base)).distinct()
    pattern = rf"^(?s)(.*)\Q{mark}\E([1-9][0-9]{{0,17}})$"
    owner, number = F.regexp_extract(base, pattern, 1), F.regexp_extract(base, pattern, 2).cast("long")
    taken = every.where(F.col(base).rlike(pattern)).select(owner.alias(base), number.alias("_t")).where("_t >= 2")
    # The i-th taken number t of a base lies behind t - i - 1 free ones: all ranks beyond that move on by one.
    by = Window.partitionBy(base).orderBy("_t")
    shifts = taken.join(start.select(base), base, "left_semi").withColumn("_free", F.col("_t") - F.row_number().over(by) - 1)
    # Runs of ranks between taken numbers, so that each rank meets one run.
    runs = shifts.groupBy(base, "_free").agg(F.count("*").alias("_c"))
    total = F.sum("_c").over(Window.partitionBy(base).orderBy("_free"))
    upto = F.lead("_free").over(Window.partitionBy(base).orderBy("_free"))
    runs = runs.select(base, (F.col("_free") + 1).alias("_from"), F.coalesce(upto, F.lit((1 << 62) - 1)).alias("_to"), total.alias("_skip"))
    plain = ranked.where("_rank = 0").select(*df.columns, F.col(base).alias(name))
    repeats = ranked.where("_rank > 0")
    skipped = repeats.join(runs.withColumnRenamed(base, "_b"), (F.col(base) == F.col("_b")) & F.col("_rank").between(F.col("_from"), F.col("_to")), "left")
    numberred = skipped.select(*df.columns, F.concat(F.col(base), F.lit(mark), (F.col("_rank") + 1 + F.coalesce("_skip", F.lit(0))).cast("string")).alias(name))
    none = df.where(F.col(base).isNull()).withColumn(name, F.lit(None).cast("string"))
    return plain.unionByName(numberred).unionByName(none)


def ladder(df: DataFrame, wishes: list[Column], order: list[str], name: str, mark: str = " #", reserved: list[str] | None = None) -> DataFrame:
    """All rows with a unique name: each takes its first wish that nobody before it has; the last wish is numbered if need be.

    At each rung the rows that are left ask for their next wish, the first by order gets it unless it is taken.  ``order`` must be unique.
    """
    spark = df.sparkSession
    taken = spark.createDataFrame([(x,) for x in reserved or []], "base string")
    left, done = df.select("*", *[w.alias(f"_w{i}") for i, w in enumerate(wishes)]), None
    for i in range(len(wishes) - 1):
        ask = checkpointed(left.join(taken.select(F.col("base").alias(f"_w{i}"), F.lit(True).alias("_gone")), f"_w{i}", "left"))
        first = ask.where("_gone is null").groupBy(f"_w{i}").agg(F.min(F.struct(*order)).alias("_least"))
        met = ask.drop("_gone").join(first, f"_w{i}", "left")
        wins = F.coalesce(F.struct(*order) == F.col("_least"), F.lit(False))
        met = checkpointed(met.withColumn("_wins", wins))
        got = met.where("_wins").select(*df.columns, F.col(f"_w{i}").alias(name))
        done = got if done is None else done.unionByName(got)
        taken = taken.unionByName(got.select(F.col(name).alias("base")))
        left = met.where("not _wins").drop("_least", "_wins")
    last = first_free(left.select(*df.columns, F.col(f"_w{len(wishes) - 1}").alias("_base")), "_base", order, name, mark, taken).drop("_base")
    return last if done is None else done.unionByName(last)
