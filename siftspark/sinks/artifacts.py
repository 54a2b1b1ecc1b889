"""Release artefacts: canonical JSON, playlists, manifests, and releases behind one pointer."""

from __future__ import annotations

import hashlib
import json
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.functions.policy import warned
from siftspark.operators.numbering import numbered
from siftspark.sinks.commitlog import CommitLog, State, Store


def canonical(value: object) -> bytes:
    """JSON with sorted keys, two blanks of indent, characters as they are and a newline at the end."""
    return (json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True, allow_nan=False) + "\n").encode()


def _attribute(name: str, value: Column) -> Column:
    text = F.replace(F.replace(F.trim(value), F.lit("&"), F.lit("&amp;")), F.lit('"'), F.lit("&quot;"))
    return F.when(F.coalesce(F.trim(value), F.lit("")) != "", F.concat(F.lit(f' {name}="'), text, F.lit('"'))).otherwise("")


def playlist_lines(winners: DataFrame) -> DataFrame:
    """(place, line) of a playlist in order: by identity, source, name and URL; of one final URL the first alone."""
    from pyspark.sql.window import Window

    order = ["normalized_identity", "source_id", "name", "final_url"]
    once = winners.withColumn("_n", F.row_number().over(Window.partitionBy("final_url").orderBy(*order))).where("_n = 1")
    attributes = F.concat(_attribute("tvg-id", F.col("tvg_id")), _attribute("tvg-logo", F.col("logo")), _attribute("tvg-url", F.col("epg")), _attribute("group-title", F.col("group")))
    info = F.concat(F.lit("#EXTINF:-1"), attributes, F.lit(","), warned(F.col("name"), F.col("rights_status") == "public_unverified"))
    rows = numbered(once.drop("_n"), [*map(F.asc, order), F.asc("final_url")], "place")
    return rows.select("place", F.concat(info, F.lit("\n"), "final_url").alias("line"))


def playlist(winners: DataFrame) -> bytes:
    lines = [r["line"] for r in playlist_lines(winners).orderBy("place").toLocalIterator()]
    return ("\n".join(["#EXTM3U", *lines]) + "\n").encode()


def manifest(files: dict[str, bytes], own: str = "manifest.json") -> dict[str, str]:
    """Hashes by path, without the manifest's own."""
    return {p: "sha256:" + hashlib.sha256(d).hexdigest() for p, d in sorted(files.items()) if p != own}


def inventory(spark, root: str) -> DataFrame:
    """(path, size, sha256) of all files below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select(F.col("path"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


class Releases:
    """Immutable releases in one folder each below any folder that Spark can write; which one is current is a replay of the commit log.

    A release is staged in a folder of its own attempt, with its state, then committed by one entry of the log, then given its final
    name.  A writer that dies before the commit leaves an attempt that nothing names (``leftovers``); one that dies after it leaves the last step,
    which any reader takes.  So no death blocks another writer, and state and release can't part.
    """

    def __init__(self, root: str | os.PathLike, spark: SparkSession | None = None):
        spark = spark or SparkSession.getActiveSession()
        if spark is None:
            raise RuntimeError("releases need a session to reach their file system")
        self.store = Store(spark, str(root))
        self.log = CommitLog(self.store)
        self.attempts: dict[str, str] = {}

    def _finished(self) -> State:
        """The log's state, after last steps that a dead writer has left are taken."""
        now = self.log.state()
        for name, commit in now.releases.items():
            if not self.store.exists(f"releases/{name}"):
                self.store.move(f"staging/{commit['attempt']}/files", f"releases/{name}")
        return now

    def current(self) -> dict | None:
        now = self._finished()
        return {"release": now.release, "generation": now.generation, "previous": now.previous} if now.release else None

    def next_name(self) -> str:
        return f"g{self.log.state().generation + 1:08d}"

    def stage(self, release: str, files: dict[str, bytes], state: DataFrame | None = None) -> str:
        """Writes a release, and the state it leaves, as an attempt; what is committed or staged by this writer isn't staged again."""
        if release in self.attempts or release in self.log.state().releases:
            raise FileExistsError(release)
        attempt = f"{release}-{uuid.uuid4().hex[:12]}"
        if state is not None:
            state.write.parquet(self.store.place(f"staging/{attempt}/state"))
        for path, data in {**files, "manifest.json": canonical(manifest(files))}.items():
            self.store.create(f"staging/{attempt}/files/{path}", data)
        self.attempts[release] = attempt
        return attempt

    def _attempt(self, release: str) -> str | None:
        """This writer's attempt, or the first whole one of another's."""
        own = self.attempts.get(release)
        found = [own] if own else [a for a in self.store.names("staging") if a.rpartition("-")[0] == release]
        return next((a for a in found if self._whole(f"staging/{a}/files")), None)

    def _whole(self, folder: str) -> bool:
        """Whether a release reads back as its manifest says."""
        declared = self.store.read(f"{folder}/manifest.json")
        return declared is not None and manifest({p: self.store.read(f"{folder}/{p}") for p in self.store.files(folder)}) == json.loads(declared)

    def verified(self, release: str) -> bool:
        self._finished()
        return self._whole(f"releases/{release}")

    def promote(self, release: str, expected: dict | None) -> bool:
        """Commits a staged release if the log still stands where it was expected and the release reads back whole."""
        now, seen = self._finished(), (expected or {}).get("generation", 0)
        attempt = self._attempt(release)
        if now.generation != seen or attempt is None:
            return False
        kept = f"staging/{attempt}/state" if self.store.exists(f"staging/{attempt}/state") else None
        if not self.log.commit(seen, "publish", release, attempt=attempt, state=kept):
            return False
        self._finished()
        return True

    def rollback(self) -> bool:
        """Back to the release before, as a new generation."""
        now = self._finished()
        return bool(now.previous) and self.verified(now.previous) and self.log.commit(now.generation, "rollback", now.previous)

    def remove(self, release: str) -> bool:
        """Takes a release that isn't current out of the log, then its files; files that stay behind a death are leftovers."""
        now = self._finished()
        if release == now.release or release not in now.releases or not self.log.commit(now.generation, "delete", release):
            return False
        self.store.delete(f"releases/{release}")
        self.store.delete(f"staging/{now.releases[release]['attempt']}")
        return True

    def leftovers(self) -> list[str]:
        """Folders that no commit names: attempts that lost or died, and files of removed releases.  A writer may still be at one of the
        newest, so whoever deletes them knows their age."""
        now = self._finished()
        named = {c["attempt"] for c in now.releases.values()}
        return [f"staging/{a}" for a in self.store.names("staging") if a not in named] + [f"releases/{r}" for r in self.store.names("releases") if r not in now.releases]

    def state(self, release: str) -> str | None:
        """Where a release's observed items are kept for the next run; none if it was published without.  A release that isn't in the log is an error."""
        commit = self.log.state().releases.get(release)
        if commit is None:
            raise FileNotFoundError(release)
        return self.store.place(commit["state"]) if commit.get("state") else None
