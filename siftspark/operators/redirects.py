"""Redirect chains of a table of hops, by pointer doubling: five hops take three joins, whatever the number of chains; or, hop by hop, all branches
of addresses that have several locations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftspark.functions import urls

#: Hops that a request follows at most; a fixed value.
HOPS = 5


def _extended(chains: DataFrame, hops: DataFrame) -> DataFrame:
    """Chains continued by the chains of the same length that begin where they end."""
    more = hops.select(F.col("url").alias("_at"), F.col("path").alias("_more"))
    joined = chains.join(more, F.element_at("path", -1) == F.col("_at"), "left")
    return joined.select("url", F.concat("path", F.coalesce("_more", F.array().cast("array<string>"))).alias("path"))


def chains(table: DataFrame, hops: int = HOPS) -> DataFrame:
    """(url, path) of every address that redirects: what it leads to, step by step, at least ``hops`` + 1 steps where there are so many.

    ``table`` has url and location; of an address with several locations the least counts, null locations don't redirect.
    Each join doubles what is known; the right side has one row an address, so a popular target is a skewed left side that
    adaptive execution splits."""
    found = table.where("url is not null and location is not null").groupBy("url").agg(F.array(F.min("location")).alias("path"))
    length = 1
    while length < hops + 1:
        found, length = _extended(found, found), 2 * length
    return found


def _allowed() -> Column:
    return urls.structural_reason(F.col("_to")).isNull() & ~(F.col("_from").startswith("https:") & ~F.col("_to").startswith("https:"))


def branches(starts: DataFrame, table: DataFrame, allowed: Column | None = None, hops: int = HOPS) -> DataFrame:
    """``starts`` with final_url, hops and reason, as ``resolved`` gives them, where an address with several locations leads to each of them.

    ``hops`` are those of the longest branch, ``reason`` is that of the longest one that has a reason, and final_url, without any reason, the
    end of the longest one (the greatest of several).  Each distinct address is followed once, one join a hop, and a branch that has stopped
    meets no further location; addresses whose locations all have several of their own have as many branches as the product of these."""
    allowed = _allowed() if allowed is None else allowed
    onward = table.where("url is not null and location is not null").select(F.col("url").alias("_at"), F.col("location").alias("_to")).distinct()
    rows = starts.where("url is not null").select(F.col("url").alias("_start")).distinct().select("_start", F.array("_start").alias("_path"), F.lit(None).cast("string").alias("reason"))
    for i in range(1, hops + 2):
        rows = rows.withColumn("_from", F.element_at("_path", -1)).join(onward, (F.col("_from") == F.col("_at")) & F.col("reason").isNull(), "left")
        refused = ~F.coalesce(allowed, F.lit(False)) if i <= hops else F.lit(False)
        stop = F.when(refused, "redirect_refused").when(F.array_contains("_path", F.col("_to")), "redirect_loop").when(F.lit(i > hops), "redirect_limit")
        path = F.when(F.col("_to").isNull(), F.col("_path")).otherwise(F.concat("_path", F.array("_to")))
        rows = rows.select("_start", path.alias("_path"), F.when(F.col("_to").isNull(), F.col("reason")).otherwise(stop).alias("reason"))
    length = (F.size("_path") - 1).cast("int").alias("n")
    stopped = F.max(F.when(F.col("reason").isNotNull(), F.struct(length, "reason")))
    ends = F.max(F.struct(length, F.element_at("_path", -1).alias("node")))
    found = rows.groupBy("_start").agg(stopped.alias("_stopped"), ends.alias("_end"))
    joined = starts.join(found, F.col("url") == F.col("_start"), "left")
    last = F.when(F.col("_stopped").isNull(), F.col("_end.node"))
    shown = joined.withColumn("reason", F.col("_stopped.reason")).withColumn("hops", F.coalesce("_end.n", F.lit(0))).withColumn("final_url", last)
    return shown.drop("_start", "_stopped", "_end")


def resolved(starts: DataFrame, table: DataFrame, allowed: Column | None = None, hops: int = HOPS) -> DataFrame:
    """``starts`` with final_url, hops and reason: where each address ends, or why it doesn't.

    In the order of the steps: ``redirect_refused`` at the first step to an address that its start may not go to (``allowed`` is a
    predicate over ``_from`` and ``_to``, by default neither a downgrade from HTTPS nor a refused address), ``redirect_loop`` where an
    address comes again, ``redirect_limit`` beyond ``hops``.  A start that doesn't redirect ends where it is; a null one has no end.
    """
    allowed = _allowed() if allowed is None else allowed
    known = chains(table, hops)
    rows = starts.join(known.withColumnRenamed("url", "_start"), F.col("url") == F.col("_start"), "left").drop("_start")
    nodes = F.slice(F.concat(F.array("url"), F.coalesce("path", F.array().cast("array<string>"))), 1, hops + 2)
    rows = rows.withColumn("_nodes", nodes)
    steps = F.size("_nodes") - 1
    # The predicate stands over columns, so that a caller writes it like any other; it is applied to each step by its place.
    rows = rows.withColumn("_bad", F.lit(None).cast("int"))
    for i in range(hops, 0, -1):
        at = rows.withColumn("_from", F.get("_nodes", F.lit(i - 1))).withColumn("_to", F.get("_nodes", F.lit(i)))
        rows = at.withColumn("_bad", F.when(F.col("_to").isNotNull() & ~F.coalesce(allowed, F.lit(False)), i).otherwise(F.col("_bad"))).drop("_from", "_to")
    again = F.filter(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), lambda i: F.array_contains(F.slice("_nodes", 1, i), F.get("_nodes", i)))
    rows = rows.withColumn("_again", F.when(steps > 0, F.get(again, F.lit(0))))
    stop = F.least(F.coalesce("_bad", F.lit(99)), F.coalesce("_again", F.lit(99)), F.when(steps > hops, hops + 1).otherwise(99))
    reason = F.when(F.col("_bad") == stop, "redirect_refused").when(F.col("_again") == stop, "redirect_loop").when(stop == hops + 1, "redirect_limit")
    rows = rows.withColumn("reason", F.when(stop < 99, reason)).withColumn("hops", F.when(stop < 99, stop).otherwise(steps).cast("int"))
    return rows.withColumn("final_url", F.when(F.col("reason").isNull(), F.element_at("_nodes", -1))).drop("_nodes", "_bad", "_again", "path")
