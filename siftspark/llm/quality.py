"""Quality scores from histogram gradient-boosted trees over document statistics.

Statistics of whole texts are computed over byte buffers; trees are grown leaf by level on binned statistics of a bounded
labelled sample and flattened into arrays, which a whole batch of documents walks at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.llm import textkit as tk
from siftspark.llm.common import crc_mod, prior_shift, sampled_labels

#: Labelled documents of either class that the trees are grown from, at most.
SAMPLE = 12_000
BINS = 64
TREES = 80
DEPTH = 5
RATE = 0.15
LEAST = 20
THRESHOLD = 0.7

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True
_SPACE = ~tk.NOT_SPACE
_POINT = np.zeros(256, bool)
_POINT[[ord(c) for c in ".,;:?!'\"()-"]] = True
_WIDE = np.zeros(256, bool)
_WIDE[128:] = True
_SYMBOL = ~(_UPPER | _LOWER | _DIGIT | _SPACE | _POINT | _WIDE)
_BANG = np.zeros(256, bool)
_BANG[[ord(c) for c in "!?"]] = True
_CLASSES = [_UPPER, _LOWER, _DIGIT, _NEWLINE, _SPACE, _POINT, _WIDE, _SYMBOL, _BANG]

FEATURES = [
    "log_bytes", "upper", "lower", "digit", "newline", "space", "point", "wide", "symbol", "bang", "log_words", "mean_length",
    "spread_length", "long_words", "short_words", "adjacent_repeats", "distinct_words", "top_word", "distinct_lines", "mean_line",
    "closed_words", "opened_words", "symbol_words", "distinct_pairs", "capital_words", "worst_block_symbols", "worst_block_repeats", "worst_block_upper",
]

#: Words of a block; the worst block of a text shows junk that the whole text hides.
BLOCK = 40


def statistics(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of FEATURES a document; zeros for an empty text."""
    n = len(off) - 1
    size = np.diff(off)
    some = np.maximum(size, 1)
    w = tk.Words(buf, off, tk.NOT_SPACE)
    count = w.count
    words = np.maximum(count, 1)
    length = w.end - w.start
    of = lambda values: np.bincount(w.doc, weights=values, minlength=n) / words
    first, last = buf[w.start], buf[w.end - 1]
    out = [np.log1p(size)]
    out += [tk.per_doc(table[buf], off) / some for table in _CLASSES]
    mean = of(length)
    same = np.zeros(len(w), bool)
    same[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    order = np.lexsort((w.hash, w.doc))
    h, d = w.hash[order], w.doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(h)))
    top = np.zeros(n)
    np.maximum.at(top, d[at], runs)
    distinct = np.bincount(d[at], minlength=n)
    pair_doc, pair, _ = tk.shingles(w, 2, short=False)
    pairs = np.bincount(np.unique(np.stack([pair_doc.astype(np.uint64), pair]), axis=1)[0].astype(np.int64), minlength=n) if len(pair) else np.zeros(n)
    lines = tk.Words(buf, off, ~_NEWLINE, lower=False)
    line_order = np.lexsort((lines.hash, lines.doc))
    lh, ld = lines.hash[line_order], lines.doc[line_order]
    line_new = np.ones(len(lh), bool)
    line_new[1:] = (lh[1:] != lh[:-1]) | (ld[1:] != ld[:-1])
    n_lines = np.maximum(lines.count, 1)
    sums = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(_SYMBOL[buf] | _BANG[buf], out=sums[1:])
    odd = (sums[w.end] - sums[w.start]) > 0
    np.cumsum(_UPPER[buf], out=sums[1:])
    capital = (sums[w.end] - sums[w.start]) * 2 > length
    block = w.pos // BLOCK
    key = np.cumsum(np.concatenate([[0], (np.diff(block) != 0) | (np.diff(w.doc) != 0)])) if len(w) else np.zeros(0, int)

    def worst(flag: np.ndarray) -> np.ndarray:
        if not len(w):
            return np.zeros(n)
        share = np.bincount(key, weights=flag) / np.maximum(np.bincount(key), 8)
        found = np.zeros(n)
        np.maximum.at(found, w.doc[np.flatnonzero(np.diff(key, prepend=-1))], share)
        return found

    out += [
        np.log1p(count), mean, np.sqrt(np.maximum(of(length.astype(float) ** 2) - mean**2, 0)), of(length >= 15), of(length <= 2), of(same),
        distinct / words, top / words, np.bincount(ld[line_new], minlength=n) / n_lines, size / n_lines, of(~tk.ALNUM[last]), of(~tk.ALNUM[first]),
        of(odd), pairs / words, of(capital & (length > 2)), worst(odd), worst(same), worst(capital & (length > 2)),
    ]
    return np.column_stack(out).astype(np.float32)


@dataclass
class Trees:
    """Trees of one depth as arrays over all nodes: feature (or -1), threshold, left child (right is next), value."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            f = self.feature[node]
            step = self.left[node] + (x[rows, np.maximum(f, 0)] > self.threshold[node])
            node = np.where(f >= 0, step, node)
        return self.base + self.value[node].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS, least: int = LEAST) -> Trees:
    """Gradient-boosted trees for the logistic loss, from histograms of binned statistics."""
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1]).astype(np.float32)) for j in range(m)]
    binned = np.column_stack([np.searchsorted(edges[j], x[:, j], "left") for j in range(m)])
    flat = binned + np.arange(m) * bins
    share = float(np.clip(y.mean(), 1e-4, 1 - 1e-4))
    base = float(np.log(share / (1 - share)))
    raw = np.full(n, base)
    feature, threshold, left, value, roots = [], [], [], [], []

    def node() -> int:
        feature.append(-1), threshold.append(0.0), left.append(0), value.append(0.0)
        return len(feature) - 1

    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        roots.append(node())
        at = np.full(n, roots[-1])
        level = [roots[-1]]
        for d in range(depth + 1):
            slot = np.searchsorted(level, at)
            live = np.isin(at, level)
            k = len(level)
            gs = np.bincount(slot[live], weights=g[live], minlength=k)
            hs = np.bincount(slot[live], weights=h[live], minlength=k)
            for i, nid in enumerate(level):
                value[nid] = rate * gs[i] / (hs[i] + 1.0)
            if d == depth:
                break
            cell = (slot[live][:, None] * (m * bins) + flat[live]).ravel()
            shape = (k, m, bins)
            gh = np.bincount(cell, weights=np.repeat(g[live], m), minlength=k * m * bins).reshape(shape).cumsum(axis=2)
            hh = np.bincount(cell, weights=np.repeat(h[live], m), minlength=k * m * bins).reshape(shape).cumsum(axis=2)
            ch = np.bincount(cell, minlength=k * m * bins).reshape(shape).cumsum(axis=2)
            gt, ht, ct = gh[:, :, -1:], hh[:, :, -1:], ch[:, :, -1:]
            gain = gh**2 / (hh + 1) + (gt - gh) ** 2 / (ht - hh + 1) - gt**2 / (ht + 1)
            gain[(ch < least) | (ct - ch < least)] = -1
            for j in range(m):
                gain[:, j, len(edges[j]) :] = -1
            best = gain.reshape(k, -1).argmax(axis=1)
            following = []
            for i, nid in enumerate(level):
                j, b = divmod(int(best[i]), bins)
                if gain[i, j, b] <= 1e-6:
                    continue
                a, c = node(), node()
                feature[nid], threshold[nid], left[nid] = j, float(edges[j][b]), a
                mine = np.flatnonzero(at == nid)
                at[mine] = a + (binned[mine, j] > b)
                following += [a, c]
            level = following
            if not level:
                break
        raw += np.array(value)[at]
    arrays = np.array(feature), np.array(threshold, np.float32), np.array(left), np.array(value)
    return Trees(base, *arrays, np.array(roots, np.int64), depth)


def measured(docs: DataFrame, key: str, text: str, extra: list[str] | None = None) -> DataFrame:
    """Statistics of every row as one binary column of 32-bit floats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, off in tk.slices(batch.column(1)):
                x = statistics(buf, off)
                rest = [batch.column(k).slice(i, j - i) for k in range(2, batch.num_columns)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([r.tobytes() for r in x], pa.binary()), *rest], names=["_k", "_x", *(extra or [])])

    schema = "_k long, _x binary" + "".join(f", {c} int" for c in extra or [])
    return docs.select(F.col(key).cast("long").alias("_k"), F.col(text).cast("string").alias("_t"), *(extra or [])).mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", where=None, sample: int = SAMPLE) -> Trees:
    """Trees from a bounded sample of labelled rows; a constant one half where no row is labelled."""
    rows, counts = sampled_labels(labels, key, label, sample, where)
    train = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t")).join(F.broadcast(rows), "_k").select("_k", "_t", (F.col("_y") > 0).cast("int").alias("_y"))
    got = measured(train, "_k", "_t", ["_y"]).select("_x", "_y").toPandas()
    if not len(got):
        return Trees(0.0, np.array([-1]), np.zeros(1, np.float32), np.array([0]), np.zeros(1), np.array([0]), 0)
    x = np.frombuffer(b"".join(bytes(v) for v in got["_x"]), np.float32).reshape(len(got), -1)
    y = got["_y"].to_numpy(float)
    trees = boost(x, y)
    # The sample takes either class up to the bound; the base is moved to the shares of all labelled rows.
    trees.base += prior_shift(counts, y.mean())
    return trees


def score(docs: DataFrame, trees: Trees, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Score and decision of every row.  A null text counts as empty and is scored by its zero statistics; repeated rows are
    scored each; a null key stays null; an empty table gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, off in tk.slices(batch.column(1)):
                p = trees.probability(statistics(buf, off))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select(F.col(key).cast("long").alias("_k"), F.col(text).cast("string").alias("_t")).mapInArrow(run, "doc_id long, score double, predicted int")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    trees = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), where=lambda k: crc_mod(k, 4) != 2)
    return score(docs, trees).select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "score", "predicted")
