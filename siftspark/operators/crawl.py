"""A crawl of repositories: files are read level by level, and only files that were reached say where to go next.

Each level is one pass: the frontier meets the files that were visited before (anti join), what is new is numbered in the
order of discovery and joined with its content, a reader turns contents into entries, and entries that lead back into
the repository form the next frontier.  Every level is cut from its lineage, so a plan never grows with the depth.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftspark.functions import urls
from siftspark.operators import config, parse
from siftspark.operators.closure import matched_once
from siftspark.session import checkpointed

#: Entries that name another configuration.
NESTED = ("depot", "store")
ENTRIES = "source_id string, path string, kind string, ordinal int, type int, url string, executable boolean, issue string, next_path string"


@dataclass
class Crawl:
    """``files`` (source_id, path, depth, place) in the order of reading, ``entries`` of those that were read, ``outcomes``
    (source_id, files_scanned, technical_status, inconclusive, failure_reason) of every source."""

    files: DataFrame
    entries: DataFrame
    outcomes: DataFrame

    def candidates(self) -> DataFrame:
        """Candidates of the sources that could be read; those of a limit's are what was found before it."""
        alive = self.outcomes.where("technical_status <> 'dead'").select("source_id")
        return config.catalogue_candidates(self.entries.join(alive, "source_id", "left_semi"))


def crawl(sources: DataFrame, roots: DataFrame, tree: DataFrame, read: Callable[[DataFrame], DataFrame]) -> Crawl:
    """Crawls all sources at once.

    ``sources`` has source_id, repository, revision, max_depth and max_files; ``roots`` source_id and path; ``tree`` repository,
    revision, path and content; ``read`` gets (source_id, repository, revision, path, content) and gives the columns of
    ``ENTRIES``, where ``next_path`` is a file of the same repository, or null for a leaf.

    A file is visited once at its least depth, so cycles end.  More roots than ``max_files`` read nothing; a file beyond it ends its
    source with what was found before (unknown, inconclusive, ``catalog_limit_exceeded``).  An edge beyond ``max_depth`` leaves the source
    partial (``catalog_depth_exceeded``).  A file without content makes it dead (``http_404``).  A source without roots is healthy
    and empty; null paths are no roots.
    """
    spark = sources.sparkSession
    deepest = sources.agg(F.max("max_depth")).first()[0] or 0
    first = roots.where("path is not null").select("source_id", "path").distinct()
    turn = F.struct(F.lit(0).alias("place"), F.lit("").alias("kind"), F.lit(0).alias("ordinal"), "path")
    frontier = first.select("source_id", "path", turn.alias("turn"))
    limits = sources.select("source_id", "repository", "revision", "max_depth", "max_files")
    visited = spark.createDataFrame([], "source_id string, path string, depth int, place int, failed boolean, over boolean")
    entries = spark.createDataFrame([], ENTRIES)
    beyond = spark.createDataFrame([], "source_id string")
    for depth in range(deepest + 1):
        ended = visited.groupBy("source_id").agg(F.max("place").alias("before"), F.bool_or(F.col("failed") | F.col("over")).alias("ended"))
        new = frontier.join(visited.select("source_id", "path"), ["source_id", "path"], "left_anti").join(limits, "source_id").join(ended, "source_id", "left").where("not coalesce(ended, false)")
        place = F.row_number().over(Window.partitionBy("source_id").orderBy("turn")) + F.coalesce("before", F.lit(0))
        # One place beyond the limit says that there is more; Spark keeps no more rows of a source than that while it sorts.
        new = new.withColumn("place", place).where(F.col("place") <= F.col("max_files") + 1)
        held = new.join(tree.select("repository", "revision", "path", "content"), ["repository", "revision", "path"], "left")
        level = held.select(
            "source_id", "repository", "revision", "path", "max_depth", "place", "content",
            F.lit(depth).alias("depth"), (F.col("place") > F.col("max_files")).alias("over"), (F.col("content").isNull() & (F.col("place") <= F.col("max_files"))).alias("failed"),
        )
        level = checkpointed(level)
        if not level.take(1):
            break
        # What comes after the first file that can't be read isn't read.
        stop = level.where("failed").groupBy("source_id").agg(F.min("place").alias("stop"))
        live = level.join(stop, "source_id", "left").where("stop is null or place <= stop").drop("stop")
        if depth == 0:  # more roots than files may be read: none is
            flooded = live.where("over").select("source_id")
            live = live.join(flooded, "source_id", "left_anti").unionByName(live.where("over"))
        found = checkpointed(read(live.where("not over and not failed").select("source_id", "repository", "revision", "path", "content")))
        visited = visited.unionByName(live.select("source_id", "path", "depth", "place", "failed", "over"))
        entries = entries.unionByName(found)
        onward = found.where(F.col("next_path").isNotNull()).join(live.select("source_id", "path", "place", "max_depth"), ["source_id", "path"])
        beyond = beyond.unionByName(onward.where(F.col("max_depth") <= depth).select("source_id").distinct())
        step = F.min(F.struct("place", "kind", "ordinal", F.col("next_path").alias("path"))).alias("turn")
        frontier = onward.where(F.col("max_depth") > depth).groupBy("source_id", F.col("next_path").alias("path")).agg(step)
    tally = visited.groupBy("source_id").agg(F.bool_or("over").alias("over"), F.bool_or("failed").alias("failed"), F.max("place").alias("files_scanned"), F.max(F.when(F.col("over") & (F.col("depth") == 0), 1)).alias("flooded"))
    states = sources.select("source_id").join(tally, "source_id", "left").join(beyond.distinct().withColumn("deep", F.lit(True)), "source_id", "left")
    no = lambda c: F.coalesce(c, F.lit(False))
    dead, over, deep = no("failed"), no("over"), no("deep")
    outcomes = states.select(
        "source_id", F.when(F.col("flooded") == 1, 0).otherwise(F.coalesce("files_scanned", F.lit(0))).alias("files_scanned"),
        F.when(dead, "dead").when(over, "unknown").when(deep, "partial").otherwise("healthy").alias("technical_status"), (over & ~dead).alias("inconclusive"),
        F.when(dead, "http_404").when(over, "catalog_limit_exceeded").when(deep, "catalog_depth_exceeded").alias("failure_reason"),
    )
    return Crawl(visited.where("not over").select("source_id", "path", "depth", "place"), entries, checkpointed(outcomes))


def configurations(parsers: dict[str, str], raw_host: str, page_host: str, base: str) -> Callable[[DataFrame], DataFrame]:
    """A reader of configurations and playlists by the one glob that fits a path.

    ``base`` is the address that raw files have below (owner/name/revision/path); a reference to the repository itself, on either
    host and at the same revision, is its next file if a glob fits it, any other a leaf."""

    def read(files: DataFrame) -> DataFrame:
        known = matched_once(files, "path", parsers)
        own = F.concat_ws("\u0000", "source_id", "path")
        address = urls.raw_file_url(base, F.col("repository"), F.col("revision"), F.col("path"))
        documents = known.select(own.alias("source_id"), F.col("content").cast("string").alias("content"), address.alias("base_url"), "parser")
        parts = [config.read(documents.where(F.col("parser") == p), relaxed=p == "tvbox_json5") for p in sorted({p for p in parsers.values() if p.startswith("tvbox")})]
        lists = documents.where("parser = 'm3u'").select("source_id", F.col("content").cast("binary").alias("content"))
        parts.append(parse.m3u_entries(lists).select("source_id", F.lit("entry").alias("kind"), "ordinal", "url", "issue"))
        plain = parse.txt_live(documents.where("parser = 'txt_live'"))
        parts.append(plain.select("source_id", F.lit("entry").alias("kind"), "ordinal", "url", "issue"))
        rows = parts[0]
        for more in parts[1:]:
            rows = rows.unionByName(more, allowMissingColumns=True)
        at = F.split("source_id", "\u0000")
        rows = rows.withColumn("path", F.get(at, F.lit(1))).withColumn("source_id", F.get(at, F.lit(0)))
        rows = rows.join(files.select("source_id", "path", "repository", "revision"), ["source_id", "path"])
        onward = F.when(F.col("kind").isin(*NESTED), urls.same_repository_path(F.col("url"), F.col("repository"), F.col("revision"), raw_host, page_host))
        rows = matched_once(rows.withColumn("_next", onward), "_next", parsers)
        return rows.select(
            "source_id", "path", "kind", F.col("ordinal").cast("int"), F.col("type").cast("int").alias("type"), "url", F.coalesce("executable", F.lit(False)).alias("executable"), "issue",
            F.when(F.col("parser").isNotNull(), F.col("_next")).alias("next_path"),
        )

    return read
