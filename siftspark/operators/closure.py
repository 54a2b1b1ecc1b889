"""Bounded closure over reference edges, and single matches of paths to patterns."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.session import checkpointed


def reachable(roots: DataFrame, edges: DataFrame, depth: int) -> DataFrame:
    """(node, depth) of all nodes within so many steps; every node at its least depth, so that cycles end.

    Breadth first: each step joins the last one's nodes and drops those already seen.
    """
    seen = roots.select("node").distinct().withColumn("depth", F.lit(0))
    last = seen
    for d in range(1, depth + 1):
        step = last.join(edges, last["node"] == edges["src"]).select(F.col("dst").alias("node")).distinct()
        # Each level reads the one before twice; left as plans, their size would double with every level.
        last = checkpointed(step.join(seen.select("node"), "node", "left_anti").withColumn("depth", F.lit(d)))
        seen = seen.unionByName(last)
    return seen


def glob_pattern(glob: str) -> str:
    """A path glob as a regular expression: ``**`` crosses folders, ``*`` and ``?`` don't."""
    out, i = "", 0
    while i < len(glob):
        if glob.startswith("**/", i):
            out, i = out + "(?:.*/)?", i + 3
        elif glob.startswith("**", i):
            out, i = out + ".*", i + 2
        else:
            out += {"*": "[^/]*", "?": "[^/]"}.get(glob[i], re.escape(glob[i]))
            i += 1
    return f"^{out}$"


def matched_once(paths: DataFrame, column: str, globs: dict[str, str]) -> DataFrame:
    """The parser of each path by the one glob that fits it; null where none or several do, with the count."""
    hits = F.array_compact(F.array(*[F.when(F.col(column).rlike(glob_pattern(g)), F.lit(p)) for g, p in globs.items()]))
    return paths.withColumn("matches", F.size(hits)).withColumn("parser", F.when(F.size(hits) == 1, F.get(hits, F.lit(0))))
