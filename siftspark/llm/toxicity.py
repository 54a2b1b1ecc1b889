"""Toxic passages as maximum-scoring segments of token log-odds.

Token weights are log-odds between toxic and clean labelled documents with an informative Dirichlet prior (the counts of
both together), of either sign, kept where they are significant; a word without a weight of its own takes its longest
weighted prefix's, so that inflected forms count, and what has neither takes a small constant from a segment.  A linear-time scan finds every maximal segment of each text; segment
scores are put on the extreme-value scale of clean text (lambda solves sum p exp(lambda s) = 1, K is fitted by moments),
and a document's evidence is turned into a probability by a logistic curve over the same labelled sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.llm import textkit as tk
from siftspark.llm.common import crc_mod, prior_shift, sampled_labels, written

#: Labelled documents of either class that the weights are learned from, at most.
SAMPLE = 6000
#: Root of the likelihood ratio from which a word's log-odds are significant.
Z = 4.0
#: Log-odds from which a word speaks for toxicity, and a prefix, whose other continuations may be harmless.
WORD_ODDS, PREFIX_ODDS = 2.0, 3.0
#: Bytes of the prefixes that words back off to, the longest first.
PREFIXES = (8, 7, 6, 5, 4)
#: Weight of the prior in words, at most, and as a share of the sample's.
PRIOR, PRIOR_SHARE = 1000.0, 0.01
#: What a token without a weight takes from a segment.
DRIFT = 0.35
THRESHOLD = 0.3


@dataclass
class Model:
    hashes: np.ndarray
    weights: np.ndarray
    lam: float = 1.0
    log_k: float = -2.0
    curve: tuple[float, float, float] = (-3.0, 1.0, 0.0)

    def probability(self, found: np.ndarray) -> np.ndarray:
        """Of each document's evidence; with documents that hold no toxic passage the curve's low end."""
        a, b, c = self.curve
        return 1 / (1 + np.exp(-np.clip(a + b * np.sqrt(found[:, 0]) + c * np.clip(found[:, 1], -10, 30), -30, 30)))


def log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float, prior: float = PRIOR) -> tuple[np.ndarray, np.ndarray]:
    """(log-odds, z) of words from their counts and the totals of toxic and clean text.  The log-odds are under a Dirichlet
    prior of their joint shares; z is the signed root of the likelihood ratio, which stands at counts of zero too."""
    prior = min(prior, PRIOR_SHARE * (n_toxic + n_clean))
    alpha = prior * (toxic + clean) / (n_toxic + n_clean) + 1e-3
    a, b = toxic + alpha, clean + alpha
    delta = np.log(a / (n_toxic + prior - a)) - np.log(b / (n_clean + prior - b))
    share = n_toxic / (n_toxic + n_clean)
    e, f = (toxic + clean) * share, (toxic + clean) * (1 - share)
    ratio = toxic * np.log(np.maximum(toxic, 1e-9) / np.maximum(e, 1e-9)) + clean * np.log(np.maximum(clean, 1e-9) / np.maximum(f, 1e-9))
    return delta, np.sign(toxic - e) * np.sqrt(2 * np.maximum(ratio, 0))


def token_weights(model: Model, w: tk.Words, index: tk.HashIndex) -> np.ndarray:
    """The weight of each word: its own, else its longest known prefix's, else the drift."""
    ids = index.find(w.hash)
    for size in PREFIXES:
        rest = np.flatnonzero(ids < 0)
        ids[rest] = index.find(w.prefix(size)[rest])
    return np.where(ids >= 0, model.weights[ids] if len(model.weights) else 0.0, -DRIFT)


def segments(weights: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a sequence, in order, in linear time."""
    total = np.concatenate([[0.0], np.cumsum(weights)])
    left: list[float] = []
    right: list[float] = []
    span: list[list[int]] = []
    lower: list[int] = []  # the last earlier segment that begins below this one
    for i in np.flatnonzero(weights > 0).tolist():
        l, r, start = float(total[i]), float(total[i + 1]), i
        while True:
            j = len(left) - 1
            while j >= 0 and left[j] >= l:
                j = lower[j]
            if j < 0 or right[j] >= r:
                left.append(l), right.append(r), span.append([start, i + 1]), lower.append(j)
                break
            l, start = left[j], span[j][0]
            del left[j:], right[j:], span[j:], lower[j:]
    return [(s, e, r - l) for (s, e), l, r in zip(span, left, right, strict=True)]


def evidence(model: Model, buf: np.ndarray, off: np.ndarray, index: tk.HashIndex) -> tuple[np.ndarray, list]:
    """(significant evidence, best segment on the extreme-value scale) of each document, and its significant segments."""
    w = tk.Words(buf, off, tk.ALNUM)
    weights = token_weights(model, w, index)
    out = np.zeros((len(off) - 1, 2))
    found: list = [[] for _ in range(len(off) - 1)]
    for d in np.unique(w.doc[weights > 0]).tolist():
        own = weights[w.first[d] : w.first[d + 1]]
        base = model.log_k + np.log(len(own))
        all_ = [(s, e, model.lam * score - base) for s, e, score in segments(own)]
        found[d] = [x for x in all_ if x[2] > 0]
        out[d] = sum(x[2] for x in found[d]), max(x[2] for x in all_)
    out[:, 1][(out == 0).all(axis=1)] = -(model.log_k + np.log(np.maximum(w.count, 1)))[(out == 0).all(axis=1)]
    return out, found


def fit_lambda(weights: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum p exp(lambda s) = 1, or 1 where there is none in reach."""
    low, high = 1e-3, 8.0
    f = lambda x: float(np.log(np.sum(shares * np.exp(np.minimum(x * weights, 500)))))
    if f(low) >= 0 or f(high) <= 0:
        return 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return low


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 40, ridge: float = 0.05) -> np.ndarray:
    """Weights (intercept first) of a ridge logistic regression by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        g = x.T @ (y - p) - ridge * beta
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(h, g)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def _least_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two independent least hashes of each document's five-word shingles; its key's own where it has none."""
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        for i, j, buf, off in tk.slices(batch.column(1)):
            doc, h, _ = tk.shingles(tk.Words(buf, off, tk.ALNUM), 5)
            own = tk.mix64(keys[i:j].astype(np.int64).view(np.uint64))
            out = []
            for seed in (np.uint64(0), np.uint64(0xABCDEF)):
                least = np.full(j - i, np.iinfo(np.uint64).max)
                np.minimum.at(least, doc, tk.mix64(h + seed))
                out.append(pa.array(np.where(least == np.iinfo(np.uint64).max, own, least).view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(keys[i:j].astype(np.int64)), *out], names=["_k", "a", "b"])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", where=None, sample: int = SAMPLE) -> Model:
    """The model from a bounded sample of labelled rows; with no row of either class, one without words."""
    rows, counts = sampled_labels(labels, key, label, sample, where)
    labelled = (
        docs.select(F.col(key).alias("_k"), F.col(text).cast("string").alias("_t"))
        .join(F.broadcast(rows), "_k")
        .select("_k", "_t", (F.col("_y") > 0).cast("int").alias("_y"))
    )
    # Copies of one document are one observation: of documents of equal least shingle hashes the first is kept.
    kept = labelled.mapInArrow(_least_shingles, "_k long, a long, b long").groupBy("a", "b").agg(F.min("_k").alias("_k"))
    train = written(labelled.join(F.broadcast(kept.select("_k")), "_k", "left_semi").select("_t", "_y"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(1).to_numpy(zero_copy_only=False)
            for i, _, buf, off in tk.slices(batch.column(0)):
                w = tk.Words(buf, off, tk.ALNUM)
                for kind, hashes in enumerate([w.hash, *(w.prefix(size) for size in PREFIXES)]):
                    # a document counts once for each of its words, however often it repeats them
                    order = np.lexsort((hashes, w.doc))
                    new = np.ones(len(order), bool)
                    new[1:] = (np.diff(hashes[order]) != 0) | (np.diff(w.doc[order]) != 0)
                    once = order[new]
                    words, at = np.unique(hashes[once], return_inverse=True)
                    toxic = np.bincount(at, weights=y[i + w.doc[once]] > 0, minlength=len(words)).astype(np.int64)
                    n = np.bincount(at, minlength=len(words))
                    some = words > 0
                    columns = [pa.array(np.full(some.sum(), kind, np.int32)), pa.array(words.view(np.int64)[some]), pa.array(toxic[some]), pa.array((n - toxic)[some])]
                    yield pa.RecordBatch.from_arrays(columns, names=["kind", "w", "toxic", "clean"])

    words = train.mapInArrow(count, "kind int, w long, toxic long, clean long").groupBy("kind", "w").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    sums = words.where("kind = 0").agg(F.sum("toxic"), F.sum("clean")).first()
    if not sums or not sums[0] or not sums[1]:
        return Model(np.zeros(0, np.uint64), np.zeros(0))
    # The words of the bounded sample; one that stands in a single document is no evidence.
    n_toxic, n_clean = float(sums[0]), float(sums[1])
    got = words.where("toxic + clean > 1").orderBy("kind", "w").toPandas()
    toxic, clean = got["toxic"].to_numpy(float), got["clean"].to_numpy(float)
    delta, z = log_odds(toxic, clean, n_toxic, n_clean)
    hashes = got["w"].to_numpy(np.int64).view(np.uint64)
    plain = got["kind"].to_numpy() == 0
    keep = ((z >= Z) & (delta > np.where(plain, WORD_ODDS, PREFIX_ODDS))) | (plain & (z <= -Z) & (delta < -DRIFT))
    model = Model(hashes[keep], delta[keep])
    share = np.where(plain[keep], clean[keep] / n_clean, 0.0)
    model.lam = fit_lambda(np.append(model.weights, -DRIFT), np.append(np.maximum(share, 1e-7), max(1 - share.sum(), 1e-7)))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = tk.HashIndex(model.hashes)
        for batch in batches:
            for i, j, buf, off in tk.slices(batch.column(0)):
                out, _ = evidence(model, buf, off, index)
                yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1]), batch.column(1).slice(i, j - i)], names=["a", "b", "y"])

    seen = train.mapInArrow(measure, "a double, b double, y int").toPandas()
    y = seen["y"].to_numpy(float)
    quiet = seen["b"].to_numpy()[y == 0]
    if len(quiet):  # moments of the extreme-value law of clean text: mean of lambda S - ln n is ln K + Euler's constant
        model.log_k = float(np.clip(np.mean(quiet) + model.log_k - 0.5772, -6.0, 0.0))
    seen = train.mapInArrow(measure, "a double, b double, y int").toPandas()
    y = seen["y"].to_numpy(float)
    x = np.column_stack([np.sqrt(seen["a"]), np.clip(seen["b"], -10, 30)])
    a, b, c = logistic(x, y)
    model.curve = (float(a) + prior_shift(counts, y.mean()), float(b), float(c))
    return model


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Score, decision and significant passages (as word ranges) of every row.

    A null or empty text has no passage and the curve's lowest evidence; a very long one is scored whole.  Repeated rows are
    scored each; a null key stays null; other columns aren't read, whatever their names; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = tk.HashIndex(model.hashes)
        for batch in batches:
            for i, j, buf, off in tk.slices(batch.column(1)):
                out, found = evidence(model, buf, off, index)
                p = model.probability(out)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i), pa.array(p), pa.array((p >= threshold).astype(np.int32)),
                        pa.array([[{"start": s, "end": e, "evidence": float(v)} for s, e, v in x] for x in found],
                                 pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("evidence", pa.float64())]))),
                    ],
                    names=["doc_id", "score", "predicted", "passages"],
                )

    schema = "doc_id long, score double, predicted int, passages array<struct<start:long,end:long,evidence:double>>"
    return docs.select(F.col(key).cast("long").alias("_k"), F.col(text).cast("string").alias("_t")).mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose text isn't judged toxic, with all their columns, whatever their names.  Null and empty texts hold no
    passage; repeated rows are judged each, null keys too; an empty table gives no rows."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = tk.HashIndex(model.hashes)
        for batch in batches:
            keep = [model.probability(evidence(model, buf, off, index)[0]) < threshold for _, _, buf, off in tk.slices(batch.column(at))]
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(run, docs.schema)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(docs, labels, where=lambda k: crc_mod(k, 4) != 2)
    return score(docs, model).select(
        "doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages")
    )
