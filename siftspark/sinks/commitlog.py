"""An append-only log of numbered commits on any file system that Spark can write, and what a release's life is as such commits.

A commit is one file, made by a rename that fails if the number is taken: that is the compare-and-swap.  Whoever wants to
commit number n + 1 has read the log up to n.  State is a replay of the log and nothing else is ever overwritten, so a writer that dies
leaves either a whole commit or none, and files that no commit names, which block nobody.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession


class Store:
    """Small files below a folder of a Hadoop file system, whole or absent."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root.rstrip("/")
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        # An instance of its own: what is read is checked by digests, and side files of checksums would be in the way of that.
        self.fs = self.jvm.org.apache.hadoop.fs.FileSystem.newInstance(self._path("").toUri(), self.conf)
        self.fs.setVerifyChecksum(False)
        self.fs.setWriteChecksum(False)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def place(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._path(name))

    def read(self, name: str) -> bytes | None:
        if not self.exists(name):
            return None
        stream = self.fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes())
        finally:
            stream.close()

    def create(self, name: str, data: bytes) -> bool:
        """Whether this call made the file, whole: false if it existed."""
        part = f"{name.rpartition('/')[0]}/.{uuid.uuid4().hex}".lstrip("/")
        stream = self.fs.create(self._path(part), False)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()
        if self.move(part, name):
            return True
        self.delete(part)
        return False

    def move(self, source: str, target: str) -> bool:
        """Whether this call gave a file or folder its name: false if that is taken or the source is gone."""
        from py4j.protocol import Py4JJavaError

        never = self.jvm.org.apache.hadoop.fs.Options.Rename.NONE
        options = self.jvm.java.lang.reflect.Array.newInstance(never.getClass(), 1)
        options[0] = never
        try:
            self.fs.mkdirs(self._path(target).getParent())
            self.context.rename(self._path(source), self._path(target), options)
            return True
        except Py4JJavaError as e:
            if e.java_exception.getClass().getSimpleName() in ("FileAlreadyExistsException", "FileNotFoundException"):
                return False
            raise

    def names(self, folder: str) -> list[str]:
        """Names below a folder, hidden ones left out."""
        if not self.exists(folder):
            return []
        found = (status.getPath().getName() for status in self.fs.listStatus(self._path(folder)))
        return sorted(n for n in found if not n.startswith("."))

    def files(self, folder: str) -> list[str]:
        """Paths of all files below a folder, from there."""
        if not self.exists(folder):
            return []
        top, out = self.fs.makeQualified(self._path(folder)).toUri().getPath(), []
        walk = self.fs.listFiles(self._path(folder), True)
        while walk.hasNext():
            out.append(walk.next().getPath().toUri().getPath()[len(top) + 1 :])
        return sorted(p for p in out if not p.rpartition("/")[2].startswith("."))

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


@dataclass
class State:
    """What the log says up to a commit."""

    generation: int = 0
    release: str | None = None
    previous: str | None = None
    releases: dict[str, dict] = field(default_factory=dict)  # of each release that was published and isn't deleted: its commit

    def after(self, number: int, commit: dict) -> State:
        kept = dict(self.releases)
        if commit["kind"] == "publish":
            kept[commit["release"]] = commit
            return State(number, commit["release"], self.release, kept)
        if commit["kind"] == "rollback":
            return State(number, commit["release"], None, kept)
        if commit["kind"] == "delete":
            kept.pop(commit["release"], None)
            return State(number, self.release, None if self.previous == commit["release"] else self.previous, kept)
        raise ValueError(f"a commit of kind {commit['kind']}")


class CommitLog:
    """Commits 1, 2, 3, ... as files; the first number that is missing ends the log."""

    def __init__(self, store: Store, folder: str = "log"):
        self.store, self.folder = store, folder

    def _name(self, number: int) -> str:
        return f"{self.folder}/{number:08d}.json"

    def state(self) -> State:
        state = State()
        while (data := self.store.read(self._name(state.generation + 1))) is not None:
            state = state.after(state.generation + 1, json.loads(data))
        return state

    def commit(self, expected: int, kind: str, release: str, **facts) -> bool:
        """Whether this writer's commit follows the one it has seen; false if another writer's does."""
        data = json.dumps({"kind": kind, "release": release, **facts}, sort_keys=True).encode()
        if self.store.read(self._name(expected + 1)) is not None or (expected and self.store.read(self._name(expected)) is None):
            return False
        return self.store.create(self._name(expected + 1), data)
