"""Ranked selection: winners per group, and duplicates that are flagged rather than dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftspark.operators.numbering import numbered


def best_per_group(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group; the order must end in a unique column.  Spark keeps one row a group and task before it
    shuffles (a window group limit), so a large group is never gathered."""
    by = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(by)).where("_rank = 1").drop("_rank")


def best_by_struct(df: DataFrame, group: list[str], order: list[Column], keep: list[str]) -> DataFrame:
    """The same with a minimum over (order, kept columns), which pre-aggregates and needs no sort."""
    least = F.min(F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)], *keep)).alias("_x")
    return df.groupBy(*group).agg(least).select(*group, *[F.col(f"_x.{c}").alias(c) for c in keep])


def flag_losers(df: DataFrame, key: list[Column], eligible: Column, order: list[Column], status: str = "publication_status", loser: str = "withheld") -> DataFrame:
    """All rows; of eligible rows with one key all but the best get the loser's status."""
    by = Window.partitionBy(F.coalesce(eligible, F.lit(False)), *key).orderBy(*order)
    lost = F.coalesce(eligible, F.lit(False)) & (F.row_number().over(by) > 1)
    return df.withColumn("_lost", lost).withColumn(status, F.when(F.col("_lost"), loser).otherwise(F.col(status))).drop("_lost")


def two_stage(df: DataFrame, entity: list[str], identity: list[Column], eligible: Column, order: list[Column], status: str = "publication_status") -> DataFrame:
    """One representative row an entity, then a winner an identity among the eligible ones; losers stay, withheld."""
    return flag_losers(best_per_group(df, entity, order), identity, eligible, order, status)


def rank_order(successes: str, score: str, latency: Column, quality: Column, url: str) -> list[Column]:
    """Longest run of successes, best path, lowest latency, best quality, first URL."""
    return [F.desc(successes), F.desc(score), latency.asc(), quality.desc(), F.asc(url)]


def selected_channels(live: DataFrame, order: list[Column]) -> DataFrame:
    """The winner of each channel among publishable rows."""
    return best_per_group(live.where("publishable"), ["channel_id"], order)


def unique_keys(df: DataFrame, source: str, key: str, order: list[str]) -> DataFrame:
    """Keys made unique: one that repeats gets its source's prefix, and further repeats a number."""
    count = F.count("*").over(Window.partitionBy(key))
    base = F.when(count > 1, F.concat(F.lit("src_"), F.col(source), F.lit("_"), F.col(key))).otherwise(F.col(key))
    df = df.withColumn("_base", base)
    place = F.row_number().over(Window.partitionBy("_base").orderBy(*order))
    return df.withColumn("client_key", F.when(place > 1, F.concat("_base", F.lit("_"), place.cast("string"))).otherwise(F.col("_base"))).drop("_base")


def pinned_first(df: DataFrame, pinned: DataFrame, order: list[Column]) -> DataFrame:
    """Ranked rows behind a pinned one, numbered from 0."""
    rows = pinned.withColumn("_pin", F.lit(0)).unionByName(df.withColumn("_pin", F.lit(1)), allowMissingColumns=True)
    return numbered(rows, [F.asc("_pin"), *order], "line", 0).drop("_pin")
