"""Connected components over DataFrames of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.llm.common import forget, written


def _shape(edges: DataFrame) -> tuple[int, bool]:
    """The number of links (a, b), distinct with a > b, and whether they are stars: an a has one b, and no b is an a."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("b").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    each = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    row = each.agg(F.sum("up"), F.max(F.col("up") + F.col("down"))).first()
    return row[0] or 0, (row[1] or 0) <= 1


#: An id is a hub from this many neighbours on, or from this share of all links; so there are 2 / SHARE hubs at most.
HUB, SHARE = 10_000, 1e-5
#: Links that a task writes, about, and tasks at least: a few links aren't spread over one small file a partition.
FILE, FILES = 100_000, 8


def _to_least(both: DataFrame, least: DataFrame, hubs: list[int]) -> DataFrame:
    """Each link (a, b) with the least neighbour m of a.  Links of hubs stay where they are and get m by broadcast."""
    if not hubs:
        return both.join(least, "a")
    of = both.sparkSession.createDataFrame([(h,) for h in hubs], "a long")
    m = F.broadcast(least.join(F.broadcast(of), "a", "left_semi"))
    return both.join(m, "a").unionByName(both.join(F.broadcast(of), "a", "left_anti").join(least, "a"))


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) of every id that has a link to another; component is the smallest id reachable.

    ``links`` has long columns a and b; repeated links and links of an id to itself are allowed, links with a null aren't
    counted, no links give no rows.  Every round links each id's larger neighbours to its smallest one, then each id
    and its smaller neighbours to the smallest, until the links are stars.  Groups are only ever reduced to their minimum,
    and the links of hubs are joined without moving them.  Each round is written, not kept; rounds that don't end raise.
    """
    start = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    edges = written(start.groupBy("a", "b").agg(F.lit(1).alias("_")).drop("_"))
    for left in range(rounds, -1, -1):
        count, stars = _shape(edges)
        if stars:
            break
        if not left:
            raise RuntimeError(f"components are not found after {rounds} rounds")
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        hubs = []
        if count >= HUB:
            many = both.groupBy("a").agg(F.count("*").alias("n")).where(F.col("n") >= max(HUB, int(SHARE * count)))
            hubs = [r["a"] for r in many.collect()]
        large = _to_least(both.where("b > a"), least, hubs).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = large.groupBy("a", "b").agg(F.lit(1).alias("_")).drop("_")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        near = large.join(least, "a")
        small = near.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        small = small.groupBy("a", "b").agg(F.lit(1).alias("_")).drop("_")
        before, edges = edges, written(small.coalesce(FILES + 2 * count // FILE))
        forget(before)
    own = edges.groupBy("b").agg(F.lit(1).alias("_")).select(F.col("b").alias("id"), F.col("b").alias("component"))
    out = edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(own)
    out = written(out.coalesce(FILES + 2 * count // FILE))
    forget(edges)
    return out
