"""Language identification by prediction by partial matching.

Every language has a tree of byte contexts up to ORDER bytes, with escape probabilities (method C: an unseen byte costs
distinct / (total + distinct)).  Under frozen counts the code length of a byte depends only on the bytes before it, so
the trees are unfolded into tables over byte windows, whose costs for all languages are summed over the whole text; the
language with the shortest code wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.llm import textkit as tk
from siftspark.llm.common import crc_mod, sampled_labels

ORDER = 4
#: Documents of a language that its tree is grown from, at most.
SAMPLE = 800
#: Documents without any letter, or null, are undetermined.
UNKNOWN = "und"

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def folded(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters in lower case (ASCII and Latin-1), everything else one blank; a blank begins every document."""
    n = len(off) - 1
    b = _FOLD[buf]
    if len(b):
        after = np.zeros(len(b), bool)
        after[1:] = b[:-1] == 0xC3
        b[after & (b >= 0x80) & (b <= 0x9E) & (b != 0x97)] += 0x20
    keep = np.ones(len(b), bool)
    keep[1:] = (b[1:] != 32) | (b[:-1] != 32)
    keep[off[:-1][off[:-1] < len(b)]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    out_off = kept[off] + np.arange(n + 1)
    out = np.full(int(out_off[-1]), 32, np.uint8)
    at = np.flatnonzero(keep)
    doc = np.searchsorted(off, at, "right") - 1
    out[np.arange(len(at)) + doc + 1] = b[at]
    return out, out_off


def windows(b: np.ndarray, off: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, window of order + 1 bytes ending at each byte, context length) of all bytes but the leading blanks."""
    w = np.zeros(len(b), np.uint64)
    pos = np.arange(len(b)) - np.repeat(off[:-1], np.diff(off))
    for i in range(order, -1, -1):
        shifted = np.zeros(len(b), np.uint64)
        shifted[i:] = b[: len(b) - i]
        shifted[pos < i] = 32  # before the text: blanks
        w = (w << np.uint64(8)) | shifted
    keep = pos > 0
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    return doc[keep], w[keep], pos[keep]


@dataclass
class Model:
    """For each order, from the highest: windows and their costs, contexts and their escape costs (bits a language)."""

    languages: list[str]
    keys: list[np.ndarray]
    costs: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]
    unseen: float = 9.0


def grow(languages: list[str], lang: np.ndarray, window: np.ndarray, n: np.ndarray, order: int = ORDER) -> Model:
    """Tables from counts of windows of each language (by its index)."""
    count = len(languages)
    model = Model(languages, [], [], [], [])
    below_keys, below_costs = np.zeros(0, np.uint64), np.zeros((0, count), np.float32)
    tables = []
    for k in range(order + 1):
        size = np.uint64(8 * (k + 1))
        mask = np.uint64((1 << int(size)) - 1)
        keys, at = np.unique(window & mask, return_inverse=True)
        c = np.zeros((len(keys), count))
        np.add.at(c, (at, lang), n)
        contexts, of = np.unique(keys >> np.uint64(8), return_inverse=True)
        total = np.zeros((len(contexts), count))
        kinds = np.zeros((len(contexts), count))
        np.add.at(total, of, c)
        np.add.at(kinds, of, c > 0)
        escape = np.where(total > 0, -np.log2(np.maximum(kinds, 1) / np.maximum(total + kinds, 1)), 0.0)
        if k == 0:
            lower = np.full((len(keys), count), model.unseen)
        else:
            context_mask = np.uint64((1 << (8 * k)) - 1)
            lower = below_costs[np.searchsorted(below_keys, keys & context_mask)]
        seen = c > 0
        cost = np.where(seen, -np.log2(np.maximum(c, 1e-9) / np.maximum(total + kinds, 1)[of]), escape[of] + lower)
        below_keys, below_costs = keys, cost
        tables.append((keys, cost.astype(np.float32), contexts, escape.astype(np.float32)))
    for keys, cost, contexts, escape in reversed(tables):
        model.keys.append(keys), model.costs.append(cost), model.contexts.append(contexts), model.escapes.append(escape)
    return model


class Coder:
    def __init__(self, model: Model):
        self.model = model
        self.keys = [tk.HashIndex(k) for k in model.keys]
        self.contexts = [tk.HashIndex(k) for k in model.contexts]

    def lengths(self, doc: np.ndarray, window: np.ndarray, n_docs: int) -> np.ndarray:
        """Code length in bits of each document under each language."""
        model = self.model
        order = len(model.keys) - 1
        total = np.zeros((n_docs, len(model.languages)))

        def add(which: np.ndarray, cost: np.ndarray) -> None:  # which: documents in ascending order
            if len(which):
                at = np.flatnonzero(np.diff(which, prepend=-1))
                total[which[at]] += np.add.reduceat(cost, at, axis=0, dtype=np.float64)

        for level, (keys, contexts) in enumerate(zip(self.keys, self.contexts, strict=True)):
            k = order - level
            found = keys.find(window & np.uint64((1 << (8 * (k + 1))) - 1))
            hit = found >= 0
            add(doc[hit], model.costs[level][found[hit]])
            doc, window = doc[~hit], window[~hit]
            if not len(doc):
                break
            above = contexts.find((window & np.uint64((1 << (8 * (k + 1))) - 1)) >> np.uint64(8))
            some = above >= 0
            add(doc[some], model.escapes[level][above[some]])
            if k == 0:
                add(doc, np.full((len(doc), len(model.languages)), model.unseen))
        return total


def has_letter(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    ascii_ = tk.per_doc((_FOLD[buf] != 32) & (buf < 128), off) > 0
    for d in np.flatnonzero(~ascii_ & (tk.per_doc(buf >= 128, off) > 0)).tolist():
        ascii_[d] = any(c.isalpha() for c in bytes(buf[off[d] : off[d + 1]]).decode("utf-8", "replace"))
    return ascii_


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", where=None, sample: int = SAMPLE, order: int = ORDER) -> Model:
    """Trees from a bounded sample of each language's documents, whole texts; without any, no language."""
    known = docs.where(F.col(text).isNotNull())
    rows, _ = sampled_labels(known, key, lang, sample, where)
    train = docs.select(F.col(key).alias("_k"), F.col(text).cast("string").alias("_t")).join(F.broadcast(rows), "_k").select("_t", F.col("_y").cast("string").alias("_y"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, codes = np.unique(np.array(batch.column(1).to_pylist(), object).astype(str), return_inverse=True)
            for i, _, buf, off in tk.slices(batch.column(0)):
                doc, window, _ = windows(*folded(buf, off), order)
                both, n = np.unique((codes[i + doc].astype(np.uint64) << np.uint64(48)) | window, return_counts=True)
                which = (both >> np.uint64(48)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[which].tolist(), pa.string()), pa.array((both & np.uint64((1 << 48) - 1)).astype(np.int64)), pa.array(n.astype(np.int64))],
                    names=["lang", "w", "n"],
                )

    got = train.mapInArrow(count, "lang string, w long, n long").groupBy("lang", "w").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(got["lang"].unique().tolist())
    at = {x: i for i, x in enumerate(languages)}
    return grow(languages, got["lang"].map(at).to_numpy(np.int64), got["w"].to_numpy(np.int64).astype(np.uint64), got["n"].to_numpy(float), order)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """The language of every row's whole text, and its share of probability among the learned ones (bits a byte, over 64
    bytes at most).  Null, empty, or without a letter: ``und`` and 0.  Ties go to the first language by name; very long texts
    are coded whole; repeated rows are scored each; a null key stays null; other columns aren't read, whatever their names;
    an empty table gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(model)
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            for i, j, buf, off in tk.slices(batch.column(1)):
                b, b_off = folded(buf, off)
                doc, window, _ = windows(b, b_off, order)
                best = np.full(j - i, len(model.languages))
                p = np.zeros(j - i)
                if model.languages:
                    bits = coder.lengths(doc, window, j - i)
                    letters = has_letter(buf, off)
                    best = np.where(letters, bits.argmin(axis=1), best)
                    n = np.maximum(np.diff(b_off) - 1, 1)[:, None]
                    gap = (bits - bits.min(axis=1, keepdims=True)) * np.minimum(1.0, 64.0 / n)
                    p = np.where(letters, 1 / np.exp2(-np.minimum(gap, 1000)).sum(axis=1), 0.0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(names[best].tolist(), pa.string()), pa.array(p)], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col(key).cast("long").alias("_k"), F.col(text).cast("string").alias("_t")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, where=lambda k: crc_mod(k, 5) != 0)
    return score(docs, model).select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")
