"""Set algebra between runs: removals, proofs of pure subtraction, denied values, limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def without(df: DataFrame, removed: DataFrame, key: list[str]) -> DataFrame:
    return df.join(removed.select(*key).distinct(), key, "left_anti")


def differences(claimed: DataFrame, required: DataFrame) -> DataFrame:
    """Rows that one side has more of, with the side; none proves equality as multisets."""
    columns = claimed.columns
    more = claimed.exceptAll(required.select(columns)).withColumn("side", F.lit("claimed"))
    return more.unionByName(required.select(columns).exceptAll(claimed).withColumn("side", F.lit("required")))


def denied_sources(values: DataFrame, denied: DataFrame, hosts: DataFrame, urls: DataFrame) -> DataFrame:
    """Sources hit by id, host or URL: three equality semi-joins, never one join on a disjunction.

    ``values`` has source_id, host and url; the others one column of the same name each.
    """
    by_id = values.join(denied, "source_id", "left_semi").select("source_id", F.lit("id").alias("reason"))
    by_host = values.join(hosts, "host", "left_semi").select("source_id", F.lit("host").alias("reason"))
    by_url = values.join(urls, "url", "left_semi").select("source_id", F.lit("url").alias("reason"))
    return by_id.unionByName(by_host).unionByName(by_url).distinct()


def outcome_within(df: DataFrame, group: list[str], limit: int, reason: str = "catalog_limit_exceeded") -> DataFrame:
    """Per group its count, and the reason where it exceeds the limit: rows are never cut."""
    counted = df.groupBy(*group).agg(F.count("*").alias("n"))
    return counted.withColumn("outcome", F.when(F.col("n") > limit, reason).otherwise("ok"))


def repeated(df: DataFrame, key: list[str | Column]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def closure_mismatch(declared: DataFrame, actual: DataFrame, key: str, value: str) -> DataFrame:
    """Declared entries without a file, files that aren't declared, and values that differ."""
    d = declared.select(key, F.col(value).alias("_d"), F.lit(True).alias("_in_d"))
    a = actual.select(key, F.col(value).alias("_a"), F.lit(True).alias("_in_a"))
    rule = F.when(F.col("_in_a").isNull(), "missing").when(F.col("_in_d").isNull(), "undeclared").when(~F.col("_d").eqNullSafe(F.col("_a")), "changed")
    return d.join(a, key, "full_outer").select(key, rule.alias("rule")).where("rule is not null")


def class_members(df: DataFrame, key: list[str], member: str, name: str) -> DataFrame:
    """Members of classes of equal key with more than one row: the class's least member and its size, never its pairs."""
    classes = df.groupBy(*key).agg(F.min(member).alias(name), F.count("*").alias("n")).where("n > 1")
    return df.join(classes, key).select(member, name, "n")
