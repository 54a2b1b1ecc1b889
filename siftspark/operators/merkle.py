"""A Merkle tree over the files of a release, as a table of levels: two releases are compared from the root down.

A file's leaf is the first hex digits of its path's hash, so leaves are even whatever the folders are, a file's leaf doesn't move when others come or
go, and no row ever holds more than a leaf's files or sixteen children.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.session import checkpointed

#: Files of a leaf, about.
LEAF = 512


def depth_for(files: int, leaf: int = LEAF) -> int:
    """Hex digits of a leaf for so many files; two trees are compared at one depth."""
    return max(1, math.ceil(math.log(max(files, 1) / leaf, 16))) if files > leaf else 1


def _leaf(depth: int):
    return F.substring(F.sha2(F.col("path"), 256), 1, depth)


def tree(files: DataFrame, depth: int) -> DataFrame:
    """(level, prefix, digest, files) of every node from the root (level 0, an empty prefix) to the leaves, of (path, sha256).

    A leaf's digest is that of its files' lines (path, NUL, digest) in order, with line feeds between; a node's that of its children's (prefix, colon, digest).
    Nodes without files don't exist; no files give no rows.  A path that stands twice counts twice; null paths or digests are left out."""
    line = F.concat("path", F.lit("\u0000"), "sha256")
    rows = files.where("path is not null and sha256 is not null").groupBy(_leaf(depth).alias("prefix"))
    level = checkpointed(rows.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("digest"), F.count("*").alias("files")))
    out = level.select(F.lit(depth).alias("level"), "prefix", "digest", "files")
    for n in range(depth - 1, -1, -1):
        child = F.concat("prefix", F.lit(":"), "digest")
        level = level.groupBy(F.substring("prefix", 1, n).alias("prefix")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(child)), "\n"), 256).alias("digest"), F.sum("files").alias("files"))
        out = out.unionByName(level.select(F.lit(n).alias("level"), "prefix", "digest", "files"))
    return out


def changed_leaves(one: DataFrame, two: DataFrame, depth: int) -> DataFrame:
    """(prefix) of the leaves in which two trees of a depth differ, found from the root down: a level's nodes are only looked at below nodes that differ.

    Written trees are read by level and prefix, so equal parts aren't."""
    below = None
    for n in range(depth + 1):
        a, b = (t.where(F.col("level") == n).select("prefix", F.col("digest").alias(name)) for t, name in ((one, "a"), (two, "b")))
        if below is not None:
            above = F.substring("prefix", 1, n - 1)
            a, b = (t.join(below.withColumnRenamed("prefix", "_above"), above == F.col("_above"), "left_semi") for t in (a, b))
        below = checkpointed(a.join(b, "prefix", "full_outer").where("not a <=> b").select("prefix"))
        if not below.take(1):
            break
    return below


def changed_files(one: DataFrame, two: DataFrame, leaves: DataFrame, depth: int) -> DataFrame:
    """(path, change) of the files in these leaves that were added, removed or changed from one list of (path, sha256) to the other."""
    side = lambda t, name: t.where("path is not null and sha256 is not null").join(leaves, _leaf(depth) == F.col("prefix"), "left_semi").select("path", F.col("sha256").alias(name))
    both = side(one, "a").join(side(two, "b"), "path", "full_outer").where("not a <=> b")
    return both.select("path", F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").otherwise("changed").alias("change"))
