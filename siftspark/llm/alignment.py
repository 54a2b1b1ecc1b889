"""Cross-tokenizer alignment: groups of two tokenizers' tokens over the same bytes, and how often their ids meet.

Both tokenizers' tokens cover the same bytes (a blank and the text).  A two-pointer merge of the cumulative ends of both
cuts them into groups where both end; tokens of one group are linked.  Ids that are linked in a document count once for it.

Texts are read once, in blocks of bounded size.  A block keeps, for each of its documents, places in its own list of
distinct id pairs; so what is shuffled to count pairs, and to bring counts back, is one row for each block and pair and not
one for each document and pair.  Counts come back to a block as rows, and sums by document are made there.

Words recur, so tokens and links are worked out once for each stretch of text that neither tokenizer can look across: the
byte-level vocabulary's cuts and the pieces of the other are inspected for that (``Pair.cuts``), else whole texts are taken.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.llm.common import bound_batches, forget, written
from siftspark.llm.packing import Encoder, byte_of, plain_text
from siftspark.llm.textkit import settle

#: Bytes of text, about, that form a block; a longer document is a block of its own.
BLOCK_BYTES = 4 << 20
#: Characters of a block's texts, about, whose stretches are held at once; a longer document is held whole.
HELD_CHARS = 1 << 20
#: Stretches of text whose tokens a task remembers, and the characters of the longest that it does.
REMEMBERED, LONGEST = 250_000, 100
#: Characters of a run of stretches that are encoded together, about; links of a group that are written out.
RUN_CHARS, GROUP_LINKS = 1 << 14, 64

#: What any of the libraries may take for white space, and the blank of pieces.
_WHITE = r"\s\u180e\u200b\ufeff\u2581"
#: A stretch ends where a blank or a line feed follows a character that is no white space at all.
_STRETCH = re.compile(rf"[{_WHITE}]*[^{_WHITE}]+(?:(?![ \n])[{_WHITE}]+[^{_WHITE}]*)*|[{_WHITE}]+")
#: What a stretch that can't stand before another ends in, besides white space.
_ENDS = "\u180e\u200b\ufeff\u2581"
_ACROSS = re.compile(rf"[^{_WHITE}][ \n▁]")

BLOCKS = """block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups array<string>,
  ends array<long>, place array<int>, times array<int>, pair array<long>, docs array<int>"""
SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def merged(ends_a: list[int], ends_b: list[int]) -> Iterator[tuple[int, int]]:
    """(tokens of a, tokens of b) up to each place where both end, in order."""
    i = j = 0
    while i < len(ends_a) and j < len(ends_b):
        if ends_a[i] == ends_b[j]:
            i, j = i + 1, j + 1
            yield i, j
        elif ends_a[i] < ends_b[j]:
            i += 1
        else:
            j += 1


def ends_of(tokens: list[bytes]) -> list[int]:
    return np.cumsum([len(t) for t in tokens], dtype=np.int64).tolist()


class Known:
    """What is known of stretches in a row: tokens of a, of b, and groups of each (-1 where a side's bytes are others), their
    groups as text, and links (pair and times, as many of each stretch as ``links`` says)."""

    def __init__(self, counts: np.ndarray, texts: list[str], links: np.ndarray, pair: np.ndarray, times: np.ndarray):
        self.counts, self.texts, self.links, self.pair, self.times = counts, texts, links, pair, times


class Pair:
    """The two tokenizers and what they make of stretches of text."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece

        encoder = Encoder(path_a)
        self.a, self.fast = encoder.tokenizer, encoder.fast
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        of = byte_of()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(self.a.get_vocab().values()) + 1)
        for word, i in vocabulary.items():
            self.bytes_a[i] = bytes(of[c] for c in word) if all(c in of for c in word) else word.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in own], np.int64) for own in (self.bytes_a, self.bytes_b))
        self.wide = len(pieces)
        self.cuts = self._cuts([p for i, p in enumerate(pieces) if not self.b.is_byte(i)])
        self.before = len(self.b.encode("x"))

    def _cuts(self, pieces: list[str]) -> bool:
        """Neither tokenizer changes a text before it or joins what stands on both sides of a stretch's end: the one splits at
        white space first, the other has no piece that holds a character and then a blank or a line feed."""
        file = json.loads(self.a.to_str())
        splits = file["pre_tokenizer"] or {}
        if file["normalizer"] or splits.get("type") != "ByteLevel" or splits.get("add_prefix_space") or not splits.get("use_regex", True):
            return False
        try:
            from sentencepiece import sentencepiece_model_pb2
        except ImportError:
            return False
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(self.b.serialized_model_proto())
        spec = model.normalizer_spec
        plain = spec.name == "identity" and not spec.precompiled_charsmap and not spec.normalization_rule_tsv and spec.add_dummy_prefix and not spec.remove_extra_whitespaces
        return bool(plain) and model.trainer_spec.model_type == model.trainer_spec.BPE and not any(_ACROSS.search(p) for p in pieces)

    def stretches(self, text: str) -> list[str]:
        """The parts of a blank and this text whose tokens don't depend on each other."""
        return _STRETCH.findall(" " + text) if self.cuts else [" " + text]

    def encoded(self, text: str) -> tuple[list[int], list[int]]:
        """(ids of a, ids of b) of a stretch, or of several in a row, as within a longer text."""
        a = self.fast.encode_ordinary(text) if self.fast is not None and plain_text(text) else self.a.encode(text, add_special_tokens=False).ids
        return a, self.b.encode("x" + text)[self.before :] if self.cuts else self.b.encode(text[1:])

    def known(self, parts: list[str]) -> Iterator[Known]:
        """What is known of these stretches, in order, a bounded run of them at a time."""
        run, held = [], 0
        for part in parts:
            # Stretches that end in a character of their own can stand before any other.
            alone = not self.cuts or len(part) > LONGEST or part[-1] in _ENDS or part[-1].isspace()
            if run and (alone or held > RUN_CHARS):
                yield from self._of_run(run)
                run, held = [], 0
            if alone:
                yield from self._of_run([part])
            else:
                run.append(part)
                held += len(part)
        if run:
            yield from self._of_run(run)

    def _of_run(self, parts: list[str]) -> Iterator[Known]:
        text = "".join(parts)
        a, b = self.encoded(text)
        want = text.encode()
        if b"".join([self.bytes_a[i] for i in a]) == want == b"".join([self.bytes_b[i] for i in b]):
            yield self._aligned(parts, np.array(a, np.int64), np.array(b, np.int64))
        elif len(parts) > 1:  # some of them: each by itself
            for part in parts:
                yield from self._of_run([part])
        else:
            none = np.zeros(0, np.int64)
            yield Known(np.full((1, 3), -1), [""], np.zeros(1, np.int64), none, none)

    def _aligned(self, parts: list[str], a: np.ndarray, b: np.ndarray) -> Known:
        """Merges the ends of both sides' tokens over all stretches of a run: every stretch ends where both end."""
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        both = np.array(list(merged(ends_a.tolist(), ends_b.tolist())), np.int64).reshape(-1, 2)
        count = np.diff(both, axis=0, prepend=0)
        n_a, n_b = count[:, 0], count[:, 1]
        ends = np.cumsum([len(p.encode()) for p in parts])
        part = np.searchsorted(ends, ends_a[both[:, 0] - 1])  # of each group
        groups = np.bincount(part, minlength=len(parts))
        last = np.cumsum(groups) - 1
        counts = np.stack([np.diff(both[last, 0], prepend=0), np.diff(both[last, 1], prepend=0), groups], 1)
        texts = _texts(a, b, n_a, n_b, last)
        small = n_a * n_b <= GROUP_LINKS
        first_a, first_b = both[:, 0] - n_a, both[:, 1] - n_b
        # All links of a group: each of its a tokens meets each of its b tokens.
        tokens = np.repeat(np.flatnonzero(small), n_a[small])  # the group of each a token
        at_a, met = _spread(first_a[small], n_a[small]), n_b[tokens]
        pair = [np.repeat(a[at_a], met) * self.wide + b[_spread(first_b[tokens], met)]]
        owner, times = [np.repeat(part[tokens], met)], [np.ones(len(pair[0]), np.int64)]
        for g in np.flatnonzero(~small):  # equal ids of a large group count together: no link is written out
            (p, n), (q, m) = (np.unique(x[f : f + c], return_counts=True) for x, f, c in ((a, first_a[g], n_a[g]), (b, first_b[g], n_b[g])))
            pair.append((p[:, None] * self.wide + q).ravel())
            times.append((n[:, None] * m).ravel())
            owner.append(np.full(len(pair[-1]), part[g]))
        pair, owner, times = map(np.concatenate, (pair, owner, times))
        order = np.lexsort((pair, owner))
        pair, owner, times = pair[order], owner[order], times[order]
        new = np.flatnonzero((np.diff(pair, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0))
        return Known(counts, texts, np.bincount(owner[new], minlength=len(parts)), pair[new], np.add.reduceat(times, new))


@lru_cache(2)
def loaded(path_a: str, path_b: str) -> Pair:
    """The pair of two files; a Python worker keeps it for its next tasks."""
    return Pair(path_a, path_b)


def _texts(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, last: np.ndarray) -> list[str]:
    """The groups of each stretch as text: ids of a side with commas, sides with a bar, groups with semicolons."""
    size = n_a + n_b
    begin = np.cumsum(size) - size
    ids, marks = np.empty(int(size.sum()), np.int64), np.zeros(int(size.sum()), np.int64)
    ids[_spread(begin, n_a)], ids[_spread(begin + n_a, n_b)] = a, b
    marks[begin + n_a - 1], marks[begin + size - 1] = 1, 2
    marks[begin[last] + size[last] - 1] = 3
    words = [x + y for x, y in zip(map(str, ids.tolist()), np.array([",", "|", ";", ""], object)[marks].tolist(), strict=True)]
    stops = (begin[last] + size[last]).tolist()
    return ["".join(words[i:j]) for i, j in zip([0, *stops[:-1]], stops, strict=True)]


class _Memory:
    """What is known of stretches, by number; pairs have numbers too."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.clear()

    def clear(self) -> None:
        self.number, self.texts = {}, []
        self.counts, self.start = np.zeros((0, 3), np.int64), np.zeros(1, np.int64)
        self.at, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pairs = np.zeros(0, np.int64)  # sorted; a link's ``at`` is a place here
        self.large = 0

    def learn(self, parts: list[str]) -> None:
        found = list(self.pair.known(parts))
        if not found:
            return
        self.number.update(zip(parts, range(len(self.texts), len(self.texts) + len(parts)), strict=True))
        for x in found:
            self.texts += x.texts
        self.large += sum(map(len, parts))
        self.counts = np.concatenate([self.counts, *(x.counts for x in found)])
        links = np.concatenate([x.links for x in found])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(links)])
        pair = np.concatenate([x.pair for x in found])
        pairs = np.union1d(self.pairs, pair)
        self.at = np.concatenate([np.searchsorted(pairs, self.pairs)[self.at], np.searchsorted(pairs, pair)])
        self.pairs, self.times = pairs, np.concatenate([self.times, *(x.times for x in found)])

    def full(self) -> bool:
        return len(self.texts) > REMEMBERED or self.large > 16 * REMEMBERED


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each run."""
    ends = np.cumsum(size)
    return np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


def _linked(memory: _Memory, texts: list[str]) -> tuple[list[np.ndarray], list[str], np.ndarray, np.ndarray, np.ndarray]:
    """(tokens of a, of b, and groups of each text; digests; text, pair and times of each distinct link, by text)."""
    parts = [memory.pair.stretches(t) if t else [] for t in texts]
    known = memory.number
    memory.learn(list(dict.fromkeys(p for own in parts for p in own if p not in known)))
    numbers = [[known[p] for p in own] for own in parts]
    del parts
    count = np.array([len(own) for own in numbers], np.int64)
    flat = np.fromiter((x for own in numbers for x in own), np.int64, int(count.sum()))
    doc = np.repeat(np.arange(len(texts)), count)
    # A document of which any stretch has other bytes has no tokens.
    odd = np.bincount(doc, memory.counts[flat, 2] < 0, len(texts)) > 0
    strings = memory.texts
    groups = [hashlib.sha256(";".join([strings[x] for x in own]).encode()).hexdigest() if own and not none else "" for own, none in zip(numbers, odd.tolist(), strict=True)]
    flat, doc = flat[~odd[doc]], doc[~odd[doc]]
    sums = [np.bincount(doc, memory.counts[flat, k], len(texts)).astype(np.int64) for k in range(3)]
    size = memory.start[flat + 1] - memory.start[flat]
    where = _spread(memory.start[flat], size)
    linked, times = np.repeat(doc, size) << 40 | memory.at[where], memory.times
    order = np.argsort(linked, kind="stable")
    first = np.flatnonzero(np.diff(linked[order], prepend=-1)) if len(order) else np.zeros(0, np.int64)
    each = np.add.reduceat(times[where][order], first) if len(first) else np.zeros(0, np.int64)
    linked = linked[order][first]
    return sums, groups, linked >> 40, memory.pairs[linked & ((1 << 40) - 1)], each


def _runs(texts: list[str], chars: int) -> Iterator[tuple[int, int]]:
    """(first, end) of runs of texts of so many characters, about."""
    begin = held = 0
    for i, t in enumerate(texts):
        if i > begin and held + len(t) > chars:
            yield begin, i
            begin, held = i, 0
        held += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def _block(memory: _Memory, number: int, keys: list, texts: list[str]) -> dict:
    """A block's row: sums of each document, its links as places in the block's list of pairs, and that list."""
    found = []
    for i, j in _runs(texts, HELD_CHARS):
        if memory.full():
            memory.clear()
        sums, groups, of, pair, each = _linked(memory, texts[i:j])
        found.append((*sums, groups, of + i, pair, each))
        settle()
    n_a, n_b, n_groups, groups, of, pair, each = zip(*found, strict=True)
    of, each = np.concatenate(of), np.concatenate(each)
    used, place, docs = np.unique(np.concatenate(pair), return_inverse=True, return_counts=True)
    return {
        "block": number, "doc_id": keys, "n_a": np.concatenate(n_a), "n_b": np.concatenate(n_b), "n_groups": np.concatenate(n_groups), "n_links": np.bincount(of, each, len(texts)).astype(np.int64), "groups": [g for own in groups for g in own],
        "ends": np.searchsorted(of, np.arange(len(texts)), "right"), "place": place.astype(np.int32), "times": each.astype(np.int32), "pair": used, "docs": docs.astype(np.int32),
    }


def _table(row: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in schema], schema=schema)


def blocks(docs: DataFrame, path_a: str, path_b: str, key: str, text: str, block_bytes: int) -> DataFrame:
    """The documents as rows of blocks."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kinds = to_arrow_schema(StructType.fromDDL(BLOCKS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = loaded(path_a, path_b)
        memory, number = _Memory(pair), TaskContext.get().partitionId() << 36
        keys, texts, held = [], [], 0

        def flushed() -> pa.RecordBatch:
            nonlocal number, keys, texts, held
            out = _table(_block(memory, number, keys, texts), kinds)
            number, keys, texts, held = number + 1, [], [], 0
            return out

        for batch in batches:
            for k, t in zip(batch.column(0), batch.column(1), strict=True):
                t = t.as_py() or ""
                if held and held + len(t) > block_bytes:
                    yield flushed()
                keys.append(k.as_py())
                texts.append(t)
                held += len(t) + 64
            settle()
        if keys:
            yield flushed()

    bound_batches(docs.sparkSession)
    return docs.select(F.col(key).cast("long").alias("_k"), F.col(text).cast("string").alias("_t")).mapInArrow(run, BLOCKS)


def pair_counts(rows: DataFrame, wide: int) -> DataFrame:
    """(pair, count, best): the documents that hold each pair linked, and whether that is the most of its first id's pairs."""
    each = rows.select(F.explode(F.arrays_zip("pair", "docs")).alias("x")).select("x.pair", F.col("x.docs").cast("long").alias("docs"))
    counts = written(each.groupBy("pair").agg(F.sum("docs").alias("count")))
    first = F.floor(F.col("pair") / F.lit(wide)).alias("id_a")
    most = counts.groupBy(first).agg(F.max("count").alias("most"))
    out = written(counts.withColumn("id_a", first).join(most, "id_a").select("pair", "count", (F.col("count") == F.col("most")).alias("best")))
    forget(counts)
    return out


def _summed(_, counts: pa.Table, block: pa.Table) -> pa.Table:
    """The documents of a block, with the counts of its pairs."""
    loaded.cache_clear()  # a worker that read texts before keeps no tokenizers beside the block
    row = {name: block.column(name).combine_chunks() for name in block.column_names}

    def values(name: str) -> np.ndarray:
        return row[name].flatten().to_numpy(zero_copy_only=False)

    order = np.argsort(counts.column("place").to_numpy())
    count, best = counts.column("count").to_numpy()[order], counts.column("best").to_numpy()[order].astype(np.int64)
    place, times = values("place"), values("times").astype(np.int64)
    ends = np.concatenate([[0], values("ends")])
    sums = []
    for value in (best, count):
        total = np.concatenate([[0], np.cumsum(value[place] * times)]) if len(place) else np.zeros(1, np.int64)
        sums.append(total[ends[1:]] - total[ends[:-1]])
    columns = [row[c].flatten() for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")] + [pa.array(x, pa.int64()) for x in sums] + [row["groups"].flatten()]
    return pa.table(columns, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def align(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row a document: its tokens of both tokenizers, groups, links, links whose pair is its first id's most common, and
    the sum of the counts of its links' pairs.

    A null or empty text, or one that a tokenizer doesn't give back byte by byte, has no tokens: zeros, and no digest.  Every
    row is a document, with a repeated or null key too (repeated rows count each); ties for the most common all are best.
    Memory is bounded by a block, or by the longest text.  Other columns aren't read, whatever their names; an empty
    table gives no rows.
    """
    rows = written(blocks(docs, path_a, path_b, key, text, block_bytes), group_rows=1)
    wide = loaded(path_a, path_b).wide
    counts = pair_counts(rows, wide)
    own = rows.select("block", F.posexplode("pair").alias("place", "pair"))
    back = own.join(counts, "pair").select("block", "place", "count", "best")
    held = rows.withColumnRenamed("block", "of").drop("pair", "docs")
    return back.groupBy("block").cogroup(held.groupBy("of")).applyInArrow(_summed, SCHEMA)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document under the byte-level and the piece vocabulary; see ``align`` for nulls, odd texts, ties and repeated rows."""
    import public_tokenizers

    return align(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
