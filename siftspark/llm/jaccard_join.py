"""N-gram Jaccard join with count-vector R-trees.

A document's set of word shingles is a point: how many of its shingles hash to each group.  Larger sets have more groups, in
powers of two, so that points fold onto fewer groups.  The overlap of two sets is at most the sum of their coordinate
minima, which bounds whole boxes of points as well; pairs that survive the boxes and the points are verified on the sets.

One tree over all documents can't be split among machines, so points are first routed to cells without losing a pair: sets
whose Jaccard index reaches t share e + 1 shingles among the first n - ceil(t n) + 1 + e of either in any common order.
Shingles that are frequent in the input come last in that order.  A document that shares fewer of these with others has no
partner; any other one drops its e most shared ones, now that they are counted, and is left with at least one in common with
each partner.  A cell holds the documents of neighbouring sizes with one such shingle.  Equal sets are one point, cells of
equal members are one cell, and a cell's members are first linked to its smallest id, after which the trees only have to look
for pairs whose components still differ.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftspark.llm import textkit as tk
from siftspark.llm.common import forget, written
from siftspark.llm.graph import components

#: Shingles per group, about: a set of n shingles is hashed into a power of two of groups, n / SPREAD of them at least.
SPREAD = 1.5
LEAST_GROUPS, CELL_GROUPS = 16, 512
#: Points of a leaf, and nodes of an inner node.
FANOUT = 32
#: Documents of one cell that one task compares with as many others.
BLOCK = 1024
#: Shingles of a prefix of which one more must be shared: one for so many shingles of the set.
MORE = 20
#: Frequent shingles that are put last, at most; the order changes the work, never the result.
FREQUENT = 200_000
#: Documents of a frequent shingle that one task joins with its counts, about.
SPLIT = 4096
#: Bytes of text over which a shingle is counted before it is reported as locally frequent.
COUNTED = 8 << 20
#: Ids up to which a set of ids is sent to all executors instead of being shuffled with the texts.
BROADCAST_IDS = 1_000_000


def points_of(doc: np.ndarray, h: np.ndarray, n: np.ndarray) -> list[bytes]:
    """Each document's counts by group, a byte a group; 255 stands for any count from there on."""
    groups = np.maximum(LEAST_GROUPS, 2.0 ** np.ceil(np.log2(np.maximum(n, 1) / SPREAD))).astype(np.int64)
    base = np.concatenate([[0], np.cumsum(groups)])
    place = base[doc] + (h & (groups[doc] - 1).astype(np.uint64)).astype(np.int64)
    counts = np.minimum(np.bincount(place, minlength=base[-1]), 255).astype(np.uint8)
    return [counts[a:b].tobytes() for a, b in zip(base[:-1], base[1:], strict=True)]


def point(data: bytes, groups: int) -> np.ndarray:
    """Counts on this many groups, of a point on as many or more; never less than they are."""
    counts = np.frombuffer(data, np.uint8).astype(np.int32)
    counts[counts == 255] = 1 << 20
    return counts.reshape(-1, groups).sum(axis=0)


class Tree:
    """An R-tree over count vectors, packed by size and by its widest coordinates; boxes keep their maxima."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, fanout: int = FANOUT):
        order = np.lexsort([points[:, j] for j in np.argsort(points.var(axis=0))[-4:]])
        order = order[np.argsort(sizes[order], kind="stable")]
        self.order = order
        self.points, self.sizes = points[order], sizes[order]
        self.levels = []  # (maxima, least size), from the leaves up
        top, least = self.points, self.sizes
        while len(top) > fanout or not self.levels:
            cut = np.arange(0, len(top), fanout)
            top, least = np.maximum.reduceat(top, cut, axis=0), np.minimum.reduceat(least, cut)
            self.levels.append((top, least))
        self.fanout = fanout

    def search(self, point: np.ndarray, size: int, top: int, bottom: int) -> np.ndarray:
        """Positions of the points whose overlap with this one may reach a Jaccard index of top / bottom."""
        need = lambda least: top * (size + least)  # noqa: E731  overlap * (top + bottom) at least
        node = np.arange(len(self.levels[-1][0]))
        for k in range(len(self.levels) - 1, -1, -1):
            box, least = self.levels[k]
            node = node[np.minimum(box[node], point).sum(axis=1) * (top + bottom) >= need(least[node])]
            node = (node[:, None] * self.fanout + np.arange(self.fanout)).ravel()
            node = node[node < (len(self.levels[k - 1][0]) if k else len(self.points))]
        node = node[np.minimum(self.points[node], point).sum(axis=1) * (top + bottom) >= need(self.sizes[node])]
        return self.order[node]


def distinct_shingles(buf: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, hash, size of each document's set), hashes distinct and ascending in each document."""
    doc, h, _ = tk.shingles(tk.Words(buf, off, tk.NOT_SPACE), k)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], h[new], np.bincount(doc[new], minlength=len(off) - 1)


def _locally_frequent(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held), return_counts=True)
            some = n >= 3
            return pa.RecordBatch.from_arrays([pa.array(values[some].view(np.int64)), pa.array(n[some].astype(np.int64))], names=["h", "n"])

        for batch in batches:
            for _, _, buf, off in tk.slices(batch.column(0)):
                held.append(distinct_shingles(buf, off, k)[1])
                size += len(buf)
                if size >= COUNTED:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return run


def _identity(h: np.ndarray, at: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each document's set, whatever the order of its hashes."""
    first, second = np.zeros(len(some), np.uint64), np.zeros(len(some), np.uint64)
    if len(h):
        first[some] = np.add.reduceat(tk.mix64(h + np.uint64(0x51ED)), at[:-1][some])
        second[some] = np.bitwise_xor.reduceat(tk.mix64(h + np.uint64(0xA0761)), at[:-1][some])
    return first.view(np.int64), second.view(np.int64)


def _prefixed(k: int, top: int, bottom: int, frequent: np.ndarray, seen: np.ndarray):
    """Size, 128-bit identity, routing shingles (with how often they were seen, if they are frequent) and point of each
    document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = tk.HashIndex(frequent)
        for batch in batches:
            for i, j, buf, off in tk.slices(batch.column(1)):
                doc, h, n = distinct_shingles(buf, off, k)
                at = np.concatenate([[0], np.cumsum(n)])
                some = n > 0
                first, second = _identity(h, at, some)
                found = index.find(h)
                weight = np.where(found >= 0, seen[found] if len(seen) else 0, 0)
                order = np.lexsort((weight, doc))  # stable: by hash within equal weights
                least = -(-n * top // bottom)
                need = n - least + 1 + np.minimum(n // MORE, np.maximum(least - 1, 0))
                rank = np.arange(len(h)) - np.repeat(at[:-1], n)
                first_ones = order[rank < np.repeat(need, n)]
                cuts = pa.array(np.concatenate([[0], np.cumsum(np.where(some, need, 0))]).astype(np.int32))
                prefix = pa.StructArray.from_arrays([pa.array(h[first_ones].view(np.int64)), pa.array(weight[first_ones])], names=["token", "weight"])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i), pa.array(n.astype(np.int64)), pa.array(first), pa.array(second),
                        pa.ListArray.from_arrays(cuts, prefix), pa.array(points_of(doc, h, n), pa.binary()),
                    ],
                    names=["id", "n", "h1", "h2", "prefix", "v"],
                )

    return run


def _whole_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, off in tk.slices(batch.column(1)):
                _, h, n = distinct_shingles(buf, off, k)
                at = np.concatenate([[0], np.cumsum(n)])
                first, second = _identity(h, at, n > 0)
                sets = pa.array([h[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(n.astype(np.int64)), pa.array(first), pa.array(second), sets], names=["id", "n", "h1", "h2", "s"])

    return run


def _verified(top: int, bottom: int):
    """Of rows sorted by (a, salt, role): the set of a, then the sets that it is compared with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, mine = None, None
        for batch in tk.parts(batches):
            found = []
            for key, role, other, s in zip(*(batch.column(c).to_pylist() for c in ("a", "role", "b", "s")), strict=True):
                h = np.frombuffer(s, np.uint64)
                if role == 0:
                    a, mine = key, h
                elif key == a:
                    small, large = (h, mine) if len(h) < len(mine) else (mine, h)
                    place = np.minimum(np.searchsorted(large, small), len(large) - 1)
                    both = int((large[place] == small).sum())
                    if bottom * both >= top * (len(small) + len(large) - both):
                        found.append((key, other))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], names=["a", "b"])

    return run


def verify(pairs: DataFrame, rows: DataFrame, k: int, top: int, bottom: int, repeated: bool, share: int = 256) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold.  Sets are made anew from the texts of the pairs' documents alone; a
    set with many partners is sent to as many tasks as they fill."""
    pairs = written(pairs)
    if not pairs.take(1):
        return pairs
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).groupBy("id").agg(F.lit(0).alias("_")).select("id")
    sets = written(of_ids(rows, ids, "id").select("id", "t").mapInArrow(_whole_sets(k), "id long, n long, h1 long, h2 long, s binary"))
    if repeated:
        sets = written(sets.where("n > 0").groupBy("id").agg(F.min(F.struct("n", "h1", "h2", "s")).alias("x")).select("id", "x.*"))
    tasks = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(share)).cast("int").alias("tasks"))
    right = (
        pairs.join(tasks, "a").select("a", F.pmod(F.xxhash64("b"), F.col("tasks")).cast("int").alias("salt"), F.lit(1).alias("role"), "b")
        .join(sets.select(F.col("id").alias("b"), "s"), "b").select("a", "salt", "role", "b", "s")
    )
    left = (
        tasks.join(sets.select(F.col("id").alias("a"), "s"), "a")
        .select("a", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("salt"), F.lit(0).alias("role"), F.col("a").alias("b"), "s")
    )
    rows = left.unionByName(right).repartition("a", "salt").sortWithinPartitions("a", "salt", "role")
    return rows.mapInArrow(_verified(top, bottom), "a long, b long")


def _coarse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Points on CELL_GROUPS groups at most, for cells, which hold a document many times."""
    for batch in tk.parts(batches):
        v = [np.minimum(point(x, min(CELL_GROUPS, len(x))), 255).astype(np.uint8).tobytes() for x in batch.column("v").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(v, pa.binary())], names=["id", "v"])


def _bounded(top: int, bottom: int):
    """Of pairs with their sizes and points, those whose coordinate minima allow the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.parts(batches):
            keep = []
            for x, y, n, m in zip(*(batch.column(c).to_pylist() for c in ("v", "w", "n", "m")), strict=True):
                groups = min(len(x), len(y))
                keep.append(int(np.minimum(point(x, groups), point(y, groups)).sum()) * (top + bottom) >= top * (n + m))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def bounded(pairs: DataFrame, points: DataFrame, top: int, bottom: int) -> DataFrame:
    """The distinct pairs (a, b) that their points don't rule out."""
    pairs = pairs.groupBy("a", "b").agg(F.lit(0).alias("_")).drop("_")
    both = pairs.join(points.select(F.col("id").alias("a"), "n", "v"), "a").join(points.select(F.col("id").alias("b"), F.col("n").alias("m"), F.col("v").alias("w")), "b")
    return both.select("a", "b", "n", "m", "v", "w").mapInArrow(_bounded(top, bottom), "a long, b long")


def _searched(top: int, bottom: int, first: bool):
    """Candidate pairs of each block: rows sorted by cell and block pair, each with its side.  With first, of each document's
    candidates the one of the smallest id."""

    def block(rows: list[tuple]) -> list[tuple[int, int]]:
        tree_rows = [r for r in rows if r[5] != 0]  # of the second block; a block with itself has side 2
        ask = [r for r in rows if r[5] != 1]
        if not tree_rows or not ask:
            return []
        groups = min(len(r[3]) for r in rows)
        points = np.stack([point(r[3], groups) for r in tree_rows])
        sizes = np.array([r[1] for r in tree_rows])
        tree = Tree(points, sizes)
        out = []
        for r in ask:
            near = (tree_rows[i] for i in tree.search(point(r[3], groups), r[1], top, bottom).tolist())
            near = [o[0] for o in near if r[2] != o[2] and (r[4] or o[4])]
            near = [min(near)] if first and near else near
            out += [(min(r[0], o), max(r[0], o)) for o in near if first or r[5] != 2 or r[0] < o]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def out(pairs: list) -> pa.RecordBatch:
            pairs = list(dict.fromkeys(pairs))
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"])

        for batch in tk.parts(batches):
            columns = [batch.column(c).to_pylist() for c in ("token", "bucket", "i", "j", "id", "n", "component", "v", "home", "side")]
            for token, bucket, i, j, *row in zip(*columns, strict=True):
                if (token, bucket, i, j) != key:
                    if held:
                        yield out(block(held))
                    key, held = (token, bucket, i, j), []
                held.append(tuple(row))
        if held:
            yield out(block(held))

    return run


def residual(cells: DataFrame, points: DataFrame, groups: DataFrame, top: int, bottom: int, first: bool, block: int = BLOCK) -> DataFrame:
    """Candidate pairs (a, b) of cells whose members' components differ; with first, one of each document in a block.
    Large cells are cut into blocks, and every two blocks meet in a task of their own."""
    of = written(cells.join(groups, "id", "left").withColumn("component", F.coalesce("component", "id")))
    mixed = of.groupBy("token", "bucket", "split").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("m"))
    mixed = mixed.where("x <> y").select("token", "bucket", "split", F.ceil(F.col("m") / F.lit(block)).cast("int").alias("blocks"))
    placed = of.join(_salted(mixed), ["token", "bucket", "salt"])
    mine = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    placed = placed.withColumn("s", mine).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("s") == F.col("o"), 2).when(F.col("s") < F.col("o"), 0).otherwise(1)
    placed = placed.select("token", "bucket", F.least("s", "o").alias("i"), F.greatest("s", "o").alias("j"), "id", "n", "component", "home", side.alias("side"))
    coarse = points.select("id", "v").mapInArrow(_coarse, "id long, v binary")
    rows = placed.join(coarse, "id").repartition("token", "bucket", "i", "j").sortWithinPartitions("token", "bucket", "i", "j")
    return bounded(rows.mapInArrow(_searched(top, bottom, first), "a long, b long"), points, top, bottom)


def _salted(cells: DataFrame) -> DataFrame:
    """Rows (token, bucket, split, ...) once for each salt, to be joined with rows that carry one of ``split`` salts."""
    return cells.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("split") - 1))).drop("split")


def routed(alone: DataFrame, top: int, bottom: int) -> DataFrame:
    """Cells (token, bucket) with their members (id, n, home) and smallest member (least, of ``m``).

    ``alone`` has id, n and prefix.  Two documents that can link meet in a cell of which one of them is at home: buckets of
    size are so wide that they lie in the same or in neighbouring ones, and each document is a guest in the one below.
    """
    rows = alone.select("id", F.col("n").cast("int").alias("n"), F.inline("prefix"))
    sized = Window.partitionBy("token").orderBy("n")
    rare = rows.where("weight = 0").select(
        "id", "n", "token", "weight", F.lag("n").over(sized).alias("below"), F.lead("n").over(sized).alias("above"), F.count("*").over(Window.partitionBy("token")).alias("rank")
    )
    # A document with no other of a size that can link shares nothing there.
    rare = rare.where((F.col("below") * bottom >= F.col("n") * top) | (F.col("n") * bottom >= F.col("above") * top)).drop("below", "above")
    shared = rare.unionByName(rows.where("weight > 0").withColumn("rank", F.col("weight") + F.lit(1 << 40)))
    least = F.ceil(F.col("n") * top / bottom)
    more = F.least(F.floor(least / MORE), F.ceil(least * top / bottom) - 1)
    by = Window.partitionBy("id")
    kept = shared.select("*", F.count("*").over(by).alias("all"), F.row_number().over(by.orderBy("rank", "token")).alias("place"))
    kept = kept.where(F.col("place") <= F.col("all") - more)
    width = math.log(bottom / top) * 1.000001
    split = (F.col("weight") / F.lit(SPLIT)).cast("int") + 1
    bucket = F.floor(F.log(F.col("n").cast("double")) / F.lit(width)).cast("int")
    home = kept.select("token", bucket.alias("bucket"), split.alias("split"), F.pmod(F.xxhash64("id"), split).cast("int").alias("salt"), "id", "n", F.lit(True).alias("home"))
    placed = written(home.unionByName(home.withColumn("bucket", F.col("bucket") - 1).withColumn("home", F.lit(False))))
    cells = placed.groupBy("token", "bucket").agg(
        F.max("split").alias("split"), F.count("*").alias("m"), F.min("id").alias("least"), F.bit_xor(F.xxhash64("id", "home")).alias("mark"), F.max("home").alias("some")
    )
    one = cells.where("m > 1 and some").groupBy("m", "least", "mark").agg(F.min(F.struct("token", "bucket", "split")).alias("x")).select("m", "least", "x.*")
    out = written(placed.join(_salted(one), ["token", "bucket", "salt"]))
    forget(placed)
    return out


def of_ids(docs: DataFrame, ids: DataFrame, column: str, how: str = "left_semi") -> DataFrame:
    """The rows whose id is among the ids (or isn't): these are sent to all while they are few, shuffled beyond."""
    ids = written(ids)
    few = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, column, how)


def join_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 4, top: int = 85, bottom: int = 100) -> DataFrame:
    """One row per input row: the size of its shingle set and its component, the smallest key reachable by links.

    Texts link where top/bottom of the union of their sets is shared.  A-Z counts as a-z, words end at ASCII white space; a
    text of fewer than k words is one shingle.  A null text, or one without words, has size 0 and links with nothing; a null
    key has a null component.  Of rows with one key the least set that is not empty stands for all in linking.  A very long
    text is one set like any other; other columns aren't read, whatever their names.  An empty table gives no rows.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("t"))
    local = rows.select("t").mapInArrow(_locally_frequent(k), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    often = local.where("n >= 20").orderBy(F.desc("n"), "h").limit(FREQUENT).toPandas()
    route = _prefixed(k, top, bottom, often["h"].to_numpy(np.int64).view(np.uint64), often["n"].to_numpy(np.int64))
    sets = written(rows.mapInArrow(route, "id long, n long, h1 long, h2 long, prefix array<struct<token:long,weight:long>>, v binary"))
    full = sets.where("n > 0 and id is not null")
    same = ["n", "h1", "h2"]
    repeated = bool(full.groupBy("id").count().where("count > 1").take(1))
    if repeated:
        full = full.groupBy("id").agg(F.min(F.struct(*same, "prefix", "v")).alias("x")).select("id", "x.*")
    classes = written(full.groupBy(*same).agg(F.min("id").alias("rep"), F.count("*").alias("copies")))
    copies = full.join(classes.where("copies > 1"), same).where("id <> rep").select("id")
    alone = of_ids(full, copies, "id", "left_anti")
    points = alone.select("id", "n", "v")
    cells = routed(alone, top, bottom)
    near = F.col("id") != F.col("least")
    stars = cells.where(near).groupBy(F.col("least").alias("a"), F.col("id").alias("b")).agg(F.count("*").alias("shared"))
    both = stars.join(points.select(F.col("id").alias("b"), "n"), "b").join(points.select(F.col("id").alias("a"), F.col("n").alias("m")), "a")
    stars = written(both.where(F.least("n", "m") * bottom >= F.greatest("n", "m") * top).select("a", "b", "shared"))
    # Each document is compared with the one that it shares most cells with; the others count where that joined too little.
    best = stars.groupBy("b").agg(F.max(F.struct("shared", -F.col("a"))).alias("x")).select((-F.col("x.col2")).alias("a"), "b")
    links = written(verify(bounded(best, points, top, bottom), rows, k, top, bottom, repeated))
    groups = components(links)
    named = groups.withColumnRenamed("component", "of")
    rest = stars.join(named.select(F.col("id").alias("a"), F.col("of").alias("p")), "a", "left").join(named.select(F.col("id").alias("b"), F.col("of").alias("q")), "b", "left")
    rest = rest.where("coalesce(p, a) <> coalesce(q, b)").select("a", "b")
    links, groups = _more_links(links, groups, written(verify(bounded(rest, points, top, bottom), rows, k, top, bottom, repeated)))
    # What the stars missed joins by one candidate of each document first; only then every pair that is left is looked at,
    # so that a large group of near copies isn't expanded into its pairs.  In a cell of two the star compared them.
    wide = cells.where("m > 2")
    for first in (True, False):
        rest = residual(wide, points, groups, top, bottom, first)
        links, groups = _more_links(links, groups, written(verify(rest, rows, k, top, bottom, repeated)))
    # Documents of equal sets take their representative's component.
    named = full.join(classes, same).select("id", "rep").join(groups.withColumnRenamed("id", "rep"), "rep", "left")
    named = named.select("id", F.coalesce("component", "rep").alias("component"))
    forget(cells, stars, links)
    return sets.join(named, "id", "left").select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))


def _more_links(links: DataFrame, groups: DataFrame, more: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links and their components with more links."""
    if not more.take(1):
        forget(more)
        return links, groups
    both = written(links.unionByName(more))
    found = components(both)
    forget(links, more, groups)
    return both, found


#: The same by comparing all pairs that share a shingle.
ORACLE = r"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS sh FROM d),
e AS (SELECT doc_id, unnest(sh) AS h FROM s), p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM e a JOIN e b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN s a ON a.doc_id = x JOIN s b ON b.doc_id = y WHERE 100 * n >= 85 * (len(a.sh) + len(b.sh) - n)), g AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(id, m) AS (SELECT doc_id, doc_id FROM s UNION SELECT g.y, r.m FROM r JOIN g ON g.x = r.id)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, c AS component_id FROM s LEFT JOIN (SELECT id, min(m) AS c FROM r GROUP BY id) ON id = s.doc_id"""


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
