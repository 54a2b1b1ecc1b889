"""Near-duplicate embeddings by sorted projection passes.

Equal vectors of a label are one.  In every pass vectors of a label are ordered by the signs of their random projections, taken from
the label's centre, and compared with their neighbours within a bounded window; pairs that reach the cosine threshold are united across
passes.  Each label has passes of its own: at first as many as a model of its size and of how far its vectors share a direction
asks for, then more until planted partners of some of its vectors, at just the threshold, are found.  Links are then counted exactly
inside each united component: vectors within half the threshold's angle of the component's centre are all linked to each
other without being compared, and the rest are compared with the whole component in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.llm import textkit as tk
from siftspark.llm.common import forget, written
from siftspark.llm.graph import HUB, SHARE, components

THRESHOLD = 0.93
#: Share of lone pairs at the threshold that the passes are to find; the share of planted pairs that has to be found.
RECALL, PLANTED = 0.999, 0.99
#: Planted pairs of a label, about; passes of a label at first, and at most before it is an error.
PROBES, LEAST_PASSES, MOST_PASSES = 256, 10, 4096
BITS = 40
WINDOW = 32
#: Vectors of a component that one task compares with as many others.
BLOCK = 2048



def passes_for(n: int, shared: float = 0.0, threshold: float = THRESHOLD, recall: float = RECALL, window: int = WINDOW) -> int:
    """Passes for a label of n vectors whose mean cosine to each other is ``shared``.

    From the centre a pair at the threshold has the cosine (threshold - shared) / (1 - shared), so its vectors stand on one side of a plane
    with chance 1 - angle / pi; they have to for as many planes as leave a window of the label's vectors."""
    apart = math.acos(max(-1.0, min(1.0, (threshold - shared) / max(1 - shared, 1e-9)))) / math.pi
    once = min(0.9, 1.1 * (1 - apart) ** max(0.0, math.log2(max(n, 1) / window)))
    return min(MOST_PASSES // 4, max(LEAST_PASSES, math.ceil(math.log(1 - recall) / math.log(1 - once))))


_ROW = "pass int, grp string, dim int, code long, id long, probe boolean, v binary"


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision, whatever their scale."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _vectors(values: list[bytes], kind: str) -> np.ndarray:
    """Unit vectors of equal dimension from their bytes; ``kind`` is the width that they came in."""
    return _unit(np.frombuffer(b"".join(values), kind).reshape(len(values), -1))


def _packed(kind: str):
    """Valid vectors as bytes of their own width; zero vectors are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.parts(batches):
            rows = [np.asarray(x, kind) for x in batch.column(2).to_pylist()]
            some = pa.array([bool(x.any()) for x in rows], pa.bool_())
            packed = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(x) for x in rows], pa.int32()), pa.array([x.tobytes() for x in rows], pa.binary())], names=["id", "grp", "dim", "v"]
            )
            yield packed.filter(some)

    return run


def _partner(x: np.ndarray, key: int, threshold: float) -> np.ndarray:
    """A vector of a unit vector at just the threshold, in a direction that its key chooses."""
    u = np.random.RandomState(key % (1 << 32)).standard_normal(len(x))
    u -= (u @ x) * x
    t = threshold + 1e-3
    return t * x + math.sqrt(1 - t * t) * u / max(np.linalg.norm(u), 1e-300)


def _planned(threshold: float, window: int):
    """(cell, mean, vectors, passes) from sums of unit vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(2).to_pylist()
            mean = [np.frombuffer(v, np.float64) / k for v, k in zip(batch.column(1).to_pylist(), n, strict=True)]
            # The mean's square is the mean cosine of all pairs, each vector with itself included.
            shared = [max(0.0, (k * float(m @ m) - 1) / (k - 1)) if k > 1 else 0.0 for m, k in zip(mean, n, strict=True)]
            passes = [passes_for(k, min(s, threshold - 0.01), threshold, window=window) for s, k in zip(shared, n, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([m.tobytes() for m in mean], pa.binary()), batch.column(2), pa.array(passes, pa.int32())], names=["cell", "c", "n", "passes"])

    return run


def _projected(bits: int, kind: str, threshold: float):
    """Each vector with its code in each of its label's passes from ``begin`` to ``passes``; a probe's row stands for its planted partner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.slice(at, 1000)
                dims = part.column("dim").to_numpy()
                for dim in np.unique(dims).tolist():
                    sub = part.take(pa.array(np.flatnonzero(dims == dim)))
                    x = _vectors(sub.column("v").to_pylist(), kind)
                    probe = np.flatnonzero(sub.column("probe").to_numpy(zero_copy_only=False))
                    for i, key in zip(probe.tolist(), sub.column("id").take(pa.array(probe)).to_pylist(), strict=True):
                        x[i] = _partner(x[i], key, threshold)
                    x = x - np.frombuffer(b"".join(sub.column("c").to_pylist()), np.float64).reshape(len(x), -1)
                    begin, end = sub.column("begin").to_numpy(), sub.column("passes").to_numpy()
                    for p in range(int(begin.min()), int(end.max())):
                        live = np.flatnonzero((begin <= p) & (p < end))
                        if not len(live):
                            continue
                        plane = np.random.RandomState(1000 * p + 17).standard_normal((dim, bits))
                        code = ((x[live] @ plane) > 0) @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))
                        own = sub.take(pa.array(live))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(live), p, np.int32)), own.column("grp"), own.column("dim"), pa.array(code), own.column("id"), own.column("probe"), own.column("v")],
                            names=["pass", "grp", "dim", "code", "id", "probe", "v"],
                        )

    return run


class _Forest:
    """Keeps the links that join two groups of ids."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def top(self, x: int) -> int:
        up = self.up
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def joins(self, a: int, b: int) -> bool:
        a, b = self.top(a), self.top(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _neighbours(threshold: float, window: int, borders: bool, kind: str):
    """Links between sorted rows within the window (kind 0), and planted pairs within it (kind 3); with borders also the partition's first
    and last rows, which the next partition's rows may link to.  A probe links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "slot", "a", "b", "pass", "grp", "dim", "code", "id", "probe", "v"]
        part = TaskContext.get().partitionId()
        tail, head = None, 0

        def border(rows: pa.RecordBatch, kind: int, slot: int) -> pa.RecordBatch:
            n = len(rows)
            none = pa.nulls(n, pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), pa.array(np.full(n, slot, np.int32)), none, none, *(rows.column(k) for k in names[4:])], names=names)

        for batch in batches:
            if borders and head < window and len(batch):
                first = batch.slice(0, window - head)
                head += len(first)
                if part:
                    yield border(first, 2, part - 1)
            for at in range(0, len(batch), 4096):
                rows = batch.slice(at, 4096)
                if tail is not None:
                    rows = pa.Table.from_batches([tail, rows]).combine_chunks().to_batches()[0]
                if not len(rows):
                    continue
                n, fresh = len(rows), 0 if tail is None else len(tail)
                ids = rows.column("id").to_numpy()
                keys = [rows.column(k).to_numpy(zero_copy_only=False) for k in (["slot"] if not borders else []) + ["pass", "grp", "dim"]]
                new = np.zeros(n, bool)
                for k in keys:
                    new[1:] |= k[1:] != k[:-1]
                run_ = np.cumsum(new)
                dims, probe = rows.column("dim").to_numpy(), rows.column("probe").to_numpy(zero_copy_only=False).astype(bool)
                links, met = [], []
                for dim in np.unique(dims).tolist():
                    own = np.flatnonzero(dims == dim)
                    x = _vectors(rows.column("v").take(pa.array(own)).to_pylist(), kind)
                    for k in range(1, min(window, len(own) - 1) + 1):
                        there = (run_[own[k:]] == run_[own[:-k]]) & (own[k:] >= fresh)
                        met += ids[own[k:][there & (ids[own[k:]] == ids[own[:-k]]) & (probe[own[k:]] != probe[own[:-k]])]].tolist()
                        same = np.flatnonzero(there & (ids[own[k:]] != ids[own[:-k]]) & ~probe[own[k:]] & ~probe[own[:-k]])
                        near = same[np.einsum("ij,ij->i", x[same + k], x[same]) >= threshold]
                        links += zip(ids[own[near]].tolist(), ids[own[near + k]].tolist(), strict=True)
                forest = _Forest()
                links = [x for x in links if forest.joins(*x)]
                for what, pairs in ((0, links), (3, [(i, i) for i in set(met)])):
                    m = len(pairs)
                    if m:
                        empty = [pa.nulls(m, t) for t in (pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(m, what, np.int32)), pa.array(np.zeros(m, np.int32)), pa.array([x[0] for x in pairs], pa.int64()), pa.array([x[1] for x in pairs], pa.int64()), *empty],
                            names=names,
                        )
                tail = rows.slice(max(0, n - window))
        if borders and tail is not None:
            yield border(tail, 1, part)

    return run


def _sums(kind: str | None, name: str = "component", type_: pa.DataType | None = None):
    """Sums of unit vectors by component (or another key) over what a task reads; without a kind, of sums in double precision."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(found), type_ or pa.int64()), pa.array([x[0].tobytes() for x in found.values()], pa.binary()), pa.array([x[1] for x in found.values()], pa.int64())], names=[name, "v", "n"]
            )

        for batch in tk.parts(batches):
            for c, v, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                x = _vectors([v], kind)[0] if kind else np.frombuffer(v, np.float64)
                if c in found:
                    found[c][0] = found[c][0] + x
                    found[c][1] += n
                else:
                    if len(found) >= 20_000:
                        yield out()
                        found.clear()
                    found[c] = [x, n]
        if found:
            yield out()

    return run


def _compared(threshold: float, kind: str):
    """Links between the queries (role 0) and members (role 1) of each block, counted by id; copies count each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, q_ids, q, q_many = None, [], [], []
        for batch in tk.parts(batches):
            keys = list(zip(*(batch.column(k).to_pylist() for k in ("component", "qb", "mb")), strict=True))
            roles, ids, vs, cores, copies = (batch.column(k).to_pylist() for k in ("role", "id", "v", "core", "copies"))
            at = 0
            while at < len(keys):
                end = at
                while end < len(keys) and keys[end] == keys[at] and roles[end] == roles[at]:
                    end += 1
                if keys[at] != key:
                    key, q_ids, q, q_many = keys[at], [], [], []
                block = _vectors(vs[at:end], kind)
                if roles[at] == 0:
                    q_ids += ids[at:end]
                    q_many += copies[at:end]
                    q.append(block)
                elif q:
                    own = np.array(ids[at:end])
                    hit = (np.concatenate(q) @ block.T >= threshold) & (np.array(q_ids)[:, None] != own)
                    core = np.array(cores[at:end])
                    who = np.concatenate([q_ids, own[core]])
                    n = np.concatenate([hit @ np.array(copies[at:end], np.int64), (np.array(q_many, np.int64) @ hit)[core]])
                    yield pa.RecordBatch.from_arrays([pa.array(who[n > 0], pa.int64()), pa.array(n[n > 0], pa.int64())], names=["id", "n"])
                at = end

    return run


def _links(valid: DataFrame, kind: str, threshold: float, passes: int | None, bits: int, window: int) -> DataFrame:
    """(a, b) links found by the passes; labels whose planted pairs aren't found get as many passes again, until they are.

    With ``passes`` given all labels have so many, and nothing is planted."""
    cell = F.concat_ws(":", F.col("dim").cast("string"), "grp")
    celled = valid.select("id", "grp", "dim", "v", cell.alias("cell"))
    sums = celled.select("cell", "v", F.lit(1).cast("long").alias("n")).mapInArrow(_sums(kind, "cell", pa.string()), "cell string, v binary, n long")
    sums = sums.repartition("cell").sortWithinPartitions("cell").mapInArrow(_sums(None, "cell", pa.string()), "cell string, v binary, n long")
    # Rows come sorted by cell, so each cell is one row of sums.
    plan = written(sums.mapInArrow(_planned(threshold, window), "cell string, c binary, n long, passes int"))
    if passes is not None:
        plan = plan.withColumn("passes", F.lit(passes))
    plan = plan.withColumn("begin", F.lit(0))
    sort, schema = ["pass", "grp", "dim", "code", "id", "probe"], f"kind int, slot int, a long, b long, {_ROW}"
    links, held, most = None, None, 0
    probed = (F.lit(passes is None) & (F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 30)) < F.lit(PROBES) * F.lit(float(1 << 30)) / F.col("n"))).alias("chosen")
    while True:
        placed = celled.join(plan, "cell").select("*", probed)
        places = placed.withColumn("probe", F.explode(F.when(F.col("chosen"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
        places = places.select("id", "grp", "dim", "v", "c", "begin", "passes", "probe")
        found = written(
            places.mapInArrow(_projected(bits, kind, threshold), _ROW).repartitionByRange(*sort).sortWithinPartitions(*sort)
            .mapInArrow(_neighbours(threshold, window, True, kind), schema)
        )
        borders = found.where("kind in (1, 2)")
        across = borders.repartition("slot").sortWithinPartitions("slot", *sort).mapInArrow(_neighbours(threshold, window, False, kind), schema)
        every = written(found.where("kind in (0, 3)").select("kind", "a", "b").unionByName(across.where("kind in (0, 3)").select("kind", "a", "b")))
        forget(found)
        own = every.where("kind = 0").select("a", "b")
        links = own if links is None else links.unionByName(own)
        if passes is not None:
            return links
        met = every.where("kind = 3").select(F.col("a").alias("id"))
        held = met if held is None else held.unionByName(met)
        hit = held.groupBy("id").agg(F.lit(1).alias("hit"))
        counts = placed.where("chosen").select("id", "cell").join(hit, "id", "left").groupBy("cell").agg(F.count("*").alias("planted"), F.count("hit").alias("seen"))
        short = counts.where(F.col("seen") < F.lit(PLANTED) * F.col("planted")).select("cell")
        plan = written(plan.join(short, "cell", "left_semi").select("cell", "c", "n", F.col("passes").alias("begin"), (F.col("passes") * 2).alias("passes")))
        most = plan.agg(F.max("passes")).first()[0]
        if most is None:
            return links
        if most > MOST_PASSES:
            raise RuntimeError(f"planted pairs of a label aren't found by {most // 2} passes")


def near_duplicates(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    threshold: float = THRESHOLD, passes: int | None = None, bits: int = BITS, window: int = WINDOW, block: int = BLOCK,
) -> DataFrame:
    """One row per input row: links of its vector, its component (smallest key) and whether it is the one to keep.

    Only vectors of equal, non-null label and equal length are compared.  Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing, nor does a null key (component null, not kept).  Of rows with one key the
    smallest label and vector stand for all.  Ties are broken by key; other columns aren't read, whatever their names; an
    empty table gives no rows.
    """
    narrow = vectors.schema[vector].dataType.jsonValue()["elementType"] == "float"
    kind = "<f4" if narrow else "<f8"
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("grp"), F.col(vector).cast("array<double>").alias("x"))
    whole = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    valid = rows.where(F.col("id").isNotNull() & F.col("grp").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0)).where(whole)
    valid = valid.groupBy("id").agg(F.min(F.struct("grp", "x")).alias("s")).select("id", "s.grp", "s.x")
    single = written(valid.mapInArrow(_packed(kind), "id long, grp string, dim int, v binary"))
    valid = written(single.groupBy("grp", "dim", "v").agg(F.min("id").alias("id"), F.count("*").alias("copies")))
    groups = components(_links(valid, kind, threshold, passes, bits, window))

    members = written(valid.select("id", "v", "copies").join(groups, "id"))
    partial = members.select("component", "v", F.lit(1).cast("long").alias("n")).mapInArrow(_sums(kind), "component long, v binary, n long")
    centres = partial.repartition("component").sortWithinPartitions("component").mapInArrow(_sums(None), "component long, v binary, n long")
    half = float(np.sqrt((1 + threshold) / 2)) + 1e-9

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.parts(batches):
            core = []
            for v, c in zip(batch.column("v").to_pylist(), batch.column("c").to_pylist(), strict=True):
                x, y = _vectors([v], kind)[0], np.frombuffer(c, np.float64)
                core.append(bool(x @ y >= half * np.linalg.norm(y) and y.any()))
            yield pa.RecordBatch.from_arrays([batch.column("component"), batch.column("id"), batch.column("v"), batch.column("n"), batch.column("copies"), pa.array(core, pa.bool_())], names=["component", "id", "v", "n", "copies", "core"])

    centres = written(centres.select("component", F.col("v").alias("c"), "n"))
    # The members of a large component stay where they are; there are 1 / SHARE of these, at most.
    large = max(HUB, int(SHARE * (centres.agg(F.sum("n")).first()[0] or 0)))
    few = centres.where(F.col("n") >= large)
    centred = members.join(F.broadcast(few), "component").unionByName(
        members.join(F.broadcast(few.select("component")), "component", "left_anti").join(centres.where(F.col("n") < large), "component")
    )
    marked = centred.select("component", "id", "v", "n", "copies", "c").mapInArrow(mark, "component long, id long, v binary, n long, copies long, core boolean")
    marked = written(marked)
    cores = marked.groupBy("component").agg(F.sum(F.when(F.col("core"), F.col("copies")).otherwise(0)).alias("cores"), F.sum((~F.col("core")).cast("long")).alias("others"))
    open_ = marked.join(cores.where("others > 0"), "component")
    place = lambda n: F.pmod(F.xxhash64("id"), F.ceil(n / F.lit(block))).cast("int")
    span = lambda n: F.explode(F.sequence(F.lit(0), (F.ceil(n / F.lit(block)) - 1).cast("int")))
    queries = open_.where("not core").withColumn("qb", place(F.col("others"))).withColumn("mb", span(F.col("n"))).withColumn("role", F.lit(0))
    targets = open_.withColumn("mb", place(F.col("n"))).withColumn("qb", span(F.col("others"))).withColumn("role", F.lit(1))
    blocks = queries.unionByName(targets).select("component", "qb", "mb", "role", "id", "v", "core", "copies")
    counted = (
        blocks.repartition("component", "qb", "mb").sortWithinPartitions("component", "qb", "mb", "role")
        .mapInArrow(_compared(threshold, kind), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    )
    own = (
        marked.select("component", "id", "core", "copies").join(cores, "component").join(counted, "id", "left")
        .select(F.col("id").alias("rep"), "component", (F.when(F.col("core"), F.col("cores") - 1).otherwise(F.col("copies") - 1) + F.coalesce("n", F.lit(0))).alias("n_links"))
    )
    classes = valid.select(F.col("id").alias("rep"), "grp", "dim", "v", (F.col("copies") - 1).alias("others"))
    own = single.join(classes, ["grp", "dim", "v"]).select("id", "rep", "others").join(own, "rep", "left")
    own = own.select("id", F.coalesce("n_links", "others").alias("n_links"), F.coalesce("component", "rep").alias("component"))
    # A component is closed under links, so its smallest key is reachable; vectors of a component are all linked into it.
    return (
        rows.select("id").join(own, "id", "left")
        .select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)))
    )


#: The same by comparing all pairs of a label.
ORACLE = """WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL),
f AS (SELECT * FROM v WHERE len(x) > 0 AND len(list_filter(x, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0 AND len(list_filter(x, lambda e: e <> 0)) > 0),
l AS (SELECT a.vec_id AS p, b.vec_id AS q FROM f a JOIN f b ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.x, b.x) >= 0.93),
r(id, m) AS (SELECT vec_id, vec_id FROM f UNION SELECT l.q, r.m FROM r JOIN l ON l.p = r.id)
SELECT e.vec_id, coalesce(n, 0) AS n_links, coalesce(c, e.vec_id) AS component_id, coalesce(coalesce(c, e.vec_id) = e.vec_id, false) AS kept
FROM embeddings e LEFT JOIN (SELECT p, count(*) AS n FROM l GROUP BY p) ON p = e.vec_id LEFT JOIN (SELECT id, min(m) AS c FROM r GROUP BY id) ON id = e.vec_id"""


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
