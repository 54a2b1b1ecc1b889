"""Benchmark decontamination by latent semantic retrieval.

Passages (overlapping word windows) and benchmark items become TF-IDF vectors over the benchmark's words, with document
frequencies counted over all documents.  A randomised SVD of all passages and items maps them to a latent space, from the
sums over all passages of the products of two terms' weights, which is all that it needs of them; passages near an item by cosine are candidates, and so are those that hold enough of its answer, for
the space doesn't span every item.  A candidate counts when the longest common subsequence
of words covers enough of the item, by count and by IDF, and most of the item's answer (its rarest words) stands in the
passage.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.llm import textkit as tk
from siftspark.llm.common import written

#: Passages begin at every so many words; an item is searched in passages of as many blocks as hold it wherever it begins.
BLOCK = 12
RANK = 128
OVERSAMPLED = 16
#: Blocks of a passage that the latent space is fitted on.
FITTED = 4
#: All passages together weigh as much as so many items in the latent space at most, so that items keep their share of it.
PASSAGES_WEIGH = 20_000
#: Products of two terms that are worked out at once, and sums of them that a task holds.
PRODUCTS, SUMS = 1 << 18, 1 << 20
#: Words in more than this share of the documents say nothing about a passage, but each item keeps its rarest ones.
COMMON = 0.02
KEPT = 6
COSINE = 0.45
#: Share of an item's weight that a passage must hold to be compared.
MASS = 0.5
#: Share of an item's words in common order, and of their weight, which varies more with the words that were changed.
COVERAGE = 0.7
WEIGHT = 0.6
ANSWER_WORDS = 8
ANSWER = 0.5
#: Items handled in one pass over the documents; more items take more passes.
ITEMS = 20_000

SCHEMA = "doc_id long, item_id long, start_word long, end_word long, cosine double, coverage double, answer double"


@dataclass
class Items:
    ids: list[int]
    words: list[np.ndarray]  # hashes of each item's words, in order
    vocabulary: np.ndarray

    @classmethod
    def of(cls, rows: list) -> Items:
        texts = [(r[1] or "").encode() for r in rows]
        off = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        w = tk.Words(np.frombuffer(b"".join(texts), np.uint8), off, tk.ALNUM)
        words = [w.hash[a:b] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
        some = [i for i, x in enumerate(words) if len(x)]
        return cls([int(rows[i][0]) for i in some], [words[i] for i in some], np.unique(w.hash))


@dataclass
class Space:
    """Term weights, the latent basis (terms x rank), and the items in it."""

    idf: np.ndarray  # 0 for words that say nothing
    every: np.ndarray  # of all words
    basis: np.ndarray
    items: np.ndarray
    mass: np.ndarray  # of each item's own weights
    blocks: np.ndarray  # that a passage needs to hold the item
    answers: list[np.ndarray]


def lcs_length(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel over a."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b.tolist():
        m = masks.get(x)
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def lcs_weight(a: np.ndarray, b: np.ndarray, weights: np.ndarray) -> float:
    """Greatest weight of a's words in a common subsequence."""
    best = np.zeros(len(b) + 1)
    for x, value in zip(a, weights, strict=True):
        best[1:] = np.maximum(best[1:], np.where(b == x, best[:-1] + value, 0))
        np.maximum.accumulate(best, out=best)
    return float(best[-1])


def document_frequencies(docs: DataFrame, vocabulary: np.ndarray) -> tuple[int, np.ndarray]:
    """The number of rows, and in how many of them each of the hashed words stands; over whole texts of all rows."""
    n = len(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = tk.HashIndex(vocabulary)
        total, rows = np.zeros(n, np.int64), 0
        for batch in batches:
            for _, _, buf, off in tk.slices(batch.column(0)):
                w = tk.Words(buf, off, tk.ALNUM)
                ids = index.find(w.hash)
                at = np.flatnonzero(ids >= 0)
                total += np.bincount(np.unique(w.doc[at] * n + ids[at]) % n, minlength=n)
                rows += len(off) - 1
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([*some.tolist(), -1], pa.int32()), pa.array([*total[some].tolist(), rows], pa.int64())], names=["w", "n"])

    got = docs.mapInArrow(count, "w int, n long").groupBy("w").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(n, np.int64)
    known = got["w"].to_numpy() >= 0
    df[got["w"].to_numpy()[known]] = got["n"].to_numpy()[known]
    return int(got["n"].to_numpy()[~known].sum()), df


def _blocks(w: tk.Words) -> tuple[np.ndarray, np.ndarray]:
    """(block of each word, first block of each document); a document has ceil(words / BLOCK) blocks."""
    count = -(-w.count // BLOCK)
    first = np.concatenate([[0], np.cumsum(count)])
    return first[w.doc] + w.pos // BLOCK, first


def _terms(items: Items, index: tk.HashIndex, idf: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
    ids, n = np.unique(index.find(items.words[i]), return_counts=True)
    value = (1 + np.log(n)) * idf[ids]
    return ids, value / max(np.linalg.norm(value), 1e-12)


def passage_products(w: tk.Words, ids: np.ndarray, idf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(pairs of terms, sums of the products of their weights, passages) over all passages of these documents that hold any
    term of weight: FITTED blocks each, from every block on, of unit length.  A pair is lesser term times vocabulary plus greater."""
    block, first = _blocks(w)
    n = len(idf)
    known = np.flatnonzero(ids >= 0)
    known = known[idf[ids[known]] > 0]
    at = block[known][:, None] - np.arange(FITTED)
    inside = at >= first[w.doc[known]][:, None]
    held, times = np.unique((at * n + ids[known][:, None])[inside], return_counts=True)
    passage, term = held // n, held % n
    begin = np.flatnonzero(np.diff(passage, prepend=-1))
    size = np.diff(begin, append=len(held))
    value = (1 + np.log(times)) * idf[term]
    if len(begin):
        value /= np.repeat(np.sqrt(np.add.reduceat(value**2, begin)), size)
    left = np.repeat(begin + size, size) - np.arange(len(held))  # terms of the passage from here on, with which each is paired
    done = np.cumsum(left)
    i = 0
    while i < len(held):
        j = max(i + 1, int(np.searchsorted(done, (done[i - 1] if i else 0) + PRODUCTS, "right")))
        one = np.repeat(np.arange(i, j), left[i:j])
        other = one + np.arange(len(one)) - np.repeat(np.cumsum(left[i:j]) - left[i:j], left[i:j])
        pair, of = np.unique(term[one] * n + term[other], return_inverse=True)
        yield pair, np.bincount(of, value[one] * value[other], len(pair)), int(np.searchsorted(begin, j) - np.searchsorted(begin, i))
        i = j


def fit(docs: DataFrame, items: Items, rank: int = RANK) -> Space:
    """Document frequencies over all rows, then the latent space of all passages and all items."""
    rows, df = document_frequencies(docs.select("_t"), items.vocabulary)
    every = np.log((rows + 1) / (df + 1.0)) + 0.01
    index = tk.HashIndex(items.vocabulary)
    said = df <= COMMON * rows
    for words in items.words:
        ids = np.unique(index.find(words))
        if said[ids].sum() < KEPT:
            said[ids[np.lexsort((ids, -every[ids]))[:KEPT]]] = True
    idf = np.where(said, every, 0.0)
    width = rank + OVERSAMPLED
    terms = [_terms(items, index, idf, i) for i in range(len(items.ids))]

    def of_items(x: np.ndarray) -> np.ndarray:
        """The items' sparse rows times x."""
        return np.stack([value @ x[ids] for ids, value in terms])

    vocabulary = items.vocabulary
    none = len(vocabulary) ** 2  # stands for no pair: its sum is the number of passages

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of the products of each two terms over a task's passages; several of a pair where a task has very many."""
        index = tk.HashIndex(vocabulary)
        pairs, sums, held, total = [], [], 0, 0

        def summed() -> tuple[np.ndarray, np.ndarray]:
            pair, of = np.unique(np.concatenate(pairs), return_inverse=True)
            return pair, np.bincount(of, np.concatenate(sums), len(pair))

        for batch in batches:
            for _, _, buf, off in tk.slices(batch.column(0)):
                w = tk.Words(buf, off, tk.ALNUM)
                for pair, value, n in passage_products(w, index.find(w.hash), idf):
                    pairs.append(pair)
                    sums.append(value)
                    held, total = held + len(pair), total + n
                    if held > SUMS:
                        pair, value = summed()
                        pairs, sums, held = [pair], [value], len(pair)
                        if held > SUMS // 2:
                            yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(value)], names=["p", "g"])
                            pairs, sums, held = [], [], 0
        pair, value = summed() if pairs else (np.zeros(0, np.int64), np.zeros(0))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(pair, none), pa.int64()), pa.array(np.append(value, float(total)))], names=["p", "g"])

    products = written(docs.select("_t").mapInArrow(multiplied, "p long, g double").groupBy("p").agg(F.sum("g").alias("g")))
    passages = products.where(F.col("p") == none).agg(F.sum("g")).first()[0] or 0.0
    products, weight = products.where(F.col("p") != none), min(1.0, PASSAGES_WEIGH / max(1.0, passages))

    def product(x: np.ndarray) -> np.ndarray:
        """A'A x over all passages, weighed, and the items, by term."""
        n = len(vocabulary)

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in tk.parts(batches):
                total = np.zeros_like(x) if total is None else total
                pair, g = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                i, j = pair // n, pair % n
                apart = i != j
                i, j, g = np.append(i, j[apart]), np.append(j, i[apart]), np.append(g, g[apart])
                order = np.argsort(i, kind="stable")
                i, j, g = i[order], j[order], g[order]
                begin = np.flatnonzero(np.diff(i, prepend=-1))
                total[i[begin]] += np.add.reduceat(g[:, None] * x[j], begin, axis=0)
            if total is not None:
                some = np.flatnonzero(total.any(axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([y.tobytes() for y in total[some]], pa.binary())], names=["t", "y"])

        def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for batch in tk.parts(batches):
                for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    total[t] = total[t] + np.frombuffer(y) if t in total else np.frombuffer(y)
            if total:
                yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([y.tobytes() for y in total.values()], pa.binary())], names=["t", "y"])

        out = np.zeros_like(x)
        for (ids, value), y in zip(terms, of_items(x), strict=True):
            out[ids] += value[:, None] * y
        for r in products.mapInArrow(part, "t int, y binary").repartition("t").mapInArrow(merged, "t int, y binary").toLocalIterator():
            out[r["t"]] += weight * np.frombuffer(bytes(r["y"]))
        return out

    width = min(width, len(idf))
    q, _ = np.linalg.qr(product(np.random.RandomState(5).standard_normal((len(idf), width))))
    q, _ = np.linalg.qr(product(q))
    values, turn = np.linalg.eigh(q.T @ product(q))
    basis = (q @ turn[:, ::-1])[:, : min(rank, int((values > 1e-9).sum()) or 1)]
    latent = of_items(basis)
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
    answers = []
    for words in items.words:
        ids = index.find(words)
        _, firsts = np.unique(ids, return_index=True)
        rare = sorted(firsts.tolist(), key=lambda p: (-every[ids[p]], p))[:ANSWER_WORDS]
        answers.append(words[sorted(rare)])
    mass = np.array([(idf[index.find(w)]).sum() for w in items.words])
    blocks = np.array([-(-len(words) // BLOCK) + 1 for words in items.words])
    return Space(idf, every, basis.astype(np.float32), latent.astype(np.float32), mass, blocks, answers)


def answered(block: np.ndarray, doc: np.ndarray, first: np.ndarray, ids: np.ndarray, size: int, answers: list[np.ndarray], answer: float) -> tuple[np.ndarray, np.ndarray]:
    """(first block, index of the item) where passages, with a block more on either side, hold so much of an item's answer.

    ``ids`` are the words' terms, ``answers`` the distinct terms of each item's answer.
    """
    count = np.array([len(x) for x in answers])
    term, of = np.concatenate(answers), np.repeat(np.arange(len(answers)), count)
    order = np.argsort(term, kind="stable")
    term, of = term[order], of[order]
    at = np.flatnonzero(np.isin(ids, term))
    b = (block[at][:, None] - np.arange(-1, size + 1)).ravel()
    own, t = np.repeat(doc[at], size + 2), np.repeat(ids[at], size + 2)
    inside = (b >= first[own]) & (b < first[own + 1])
    held = np.unique(np.stack([b[inside], t[inside]], axis=1), axis=0)
    lo, hi = np.searchsorted(term, held[:, 1]), np.searchsorted(term, held[:, 1], "right")
    n = hi - lo
    item = of[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
    both, words = np.unique(np.repeat(held[:, 0], n) * len(answers) + item, return_counts=True)
    enough = words >= answer * count[both % len(answers)] - 1e-9
    return both[enough] // len(answers), both[enough] % len(answers)


def candidates(w: tk.Words, ids: np.ndarray, space: Space, cosine: float, asked: list[np.ndarray], answer: float) -> list[tuple[int, int, int, float]]:
    """(document, first word, item, cosine) of the passages near an item, or that hold its answer; ``asked`` are the answers'
    terms."""
    block, first = _blocks(w)
    n = int(first[-1])
    known = np.flatnonzero(ids >= 0)
    known = known[space.idf[ids[known]] > 0]
    if not len(known):
        return []
    value = space.idf[ids[known]]
    mass = np.bincount(block[known], weights=value, minlength=n)
    at = np.flatnonzero(np.diff(block[known], prepend=-1))
    part = np.zeros((n, space.basis.shape[1]), np.float32)
    part[block[known][at]] = np.add.reduceat(space.basis[ids[known]] * value[:, None].astype(np.float32), at, axis=0)
    doc = np.repeat(np.arange(w.n_docs), np.diff(first))
    end = first[doc + 1]
    found = []
    for size in np.unique(space.blocks).tolist():
        items = np.flatnonzero(space.blocks == size)
        there = np.arange(n)
        held = mass.copy()
        for s in range(1, size):
            held[: n - s] += np.where(there[: n - s] + s < end[: n - s], mass[s:], 0)
        live = np.flatnonzero(held >= MASS * space.mass[items].min())
        z = part[live]
        for s in range(1, size):
            more = live + s < end[live]
            z[more] += part[live[more] + s]
        z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
        near = z @ space.items[items].T
        b, i = answered(block, w.doc, first, ids, size, [asked[k] for k in items.tolist()], answer)
        row = np.minimum(np.searchsorted(live, b), max(len(live) - 1, 0))
        some = live[row] == b if len(live) else np.zeros(len(b), bool)
        close = near >= cosine
        close[row[some], i[some]] = True
        p, i = np.nonzero(close & (held[live][:, None] >= MASS * space.mass[items]))
        b = live[p]
        found += zip(doc[b].tolist(), (w.first[doc[b]] + (b - first[doc[b]]) * BLOCK).tolist(), items[i].tolist(), near[p, i].tolist(), strict=True)
    return sorted(found)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    cosine: float = COSINE, coverage: float = COVERAGE, answer: float = ANSWER, weight: float = WEIGHT, items_at_once: int = ITEMS,
) -> DataFrame:
    """One row per document and item found in it: the words of the document that hold it and the three measures.

    Null or empty texts match nothing, nor do items without words; a null key stays null; items of one id are each
    searched.  Repeated rows are searched each, very long texts whole, and other columns aren't read, whatever their names.
    An empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("_k"), F.col(text).cast("string").alias("_t"))
    of = benchmark.select(F.col(item).cast("long").alias("i"), F.col(item_text).cast("string").alias("t")).where("i is not null and t is not null")
    out, block = [], []
    for r in of.orderBy("i", "t").toLocalIterator():
        block.append((r["i"], r["t"]))
        if len(block) == items_at_once:
            out.append(_searched(rows, Items.of(block), cosine, coverage, answer, weight))
            block = []
    if block:
        out.append(_searched(rows, Items.of(block), cosine, coverage, answer, weight))
    out = [x for x in out if x is not None]
    if not out:
        return spark.createDataFrame([], SCHEMA)
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


def _searched(rows: DataFrame, items: Items, cosine: float, coverage: float, answer: float, weight: float) -> DataFrame | None:
    if not items.ids:
        return None
    space = fit(rows, items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = tk.HashIndex(items.vocabulary)
        asked = [index.find(x) for x in space.answers]
        for batch in batches:
            for i, _, buf, off in tk.slices(batch.column(1)):
                w = tk.Words(buf, off, tk.ALNUM)
                ids = index.find(w.hash)
                spans: dict[tuple[int, int], list] = {}
                for d, begin, k, c in candidates(w, ids, space, cosine, asked, answer):
                    # a changed item may be a little longer than the one that the passage was cut for
                    a = max(int(w.first[d]), begin - BLOCK)
                    b = min(int(w.first[d + 1]), begin + (int(space.blocks[k]) + 1) * BLOCK)
                    spans.setdefault((d, k), []).append((a, b, c))
                out = []
                for (d, k), held in spans.items():
                    best = None
                    item = items.words[k]
                    value = space.every[index.find(item)]
                    for a, b, c in held:
                        mine = w.hash[a:b]
                        share = lcs_length(item, mine) / len(item)
                        told = float(np.isin(space.answers[k], mine).mean())
                        if share >= coverage and told >= answer and (best is None or share > best[0]) and lcs_weight(item, mine, value) >= weight * value.sum():
                            best = (share, told, a, b, c)
                    if best:
                        share, told, a, b, c = best
                        out.append((i + d, items.ids[k], int(a - w.first[d]), int(b - w.first[d]), float(c), share, told))
                if out:
                    columns = list(zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(columns[0])), *(pa.array(x, pa.int64()) for x in columns[1:4]), *(pa.array(x, pa.float64()) for x in columns[4:])],
                        names=["doc_id", "item_id", "start_word", "end_word", "cosine", "coverage", "answer"],
                    )

    return rows.mapInArrow(run, SCHEMA)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
