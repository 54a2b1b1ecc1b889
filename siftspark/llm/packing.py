"""Best-fit packing of tokenised documents into sequences of a fixed length.

Bounded-space online best fit: a fixed number of open bins, found through a bitset keyed by free space; a piece goes to
the bin with the least free space that still holds it, and when too many bins are open the fullest closes first.
Pieces are placed as they come.  Each task packs the rows it reads, in the order it reads them, so that a task run again
gives the same sequences.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.llm.common import bound_batches

LENGTH = 1024
END = 2
OPEN_BINS = 1024
#: Documents whose pieces form a batch of the result.
RUN = 1000

#: The byte-level vocabulary's cuts of a text; a fixed value.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space that two libraries' patterns may read differently; such texts go to ``tokenizers`` itself.
_ODD = re.compile("[\x1c-\x1f\x85\u180e\u200b\ufeff]")

#: A run of so many characters that one cut of the pattern may take goes to ``tokenizers``.
RUN_BYTES = 20_000
_RUN = re.compile(r"[^\W\d_]{%d}|\d{%d}|\s{%d}|[\W_]{%d}" % ((RUN_BYTES,) * 4))

SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def byte_of() -> dict[str, int]:
    """The character by which a byte-level vocabulary writes each byte: itself if it prints, else the next from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes: those of the vocabulary file under ``tokenizers``.

    The same merges run about three times faster in ``tiktoken``, if that can be imported, which gets the file's vocabulary as
    ranks.  It is used if the file says that it works alike (see ``ranked``) and it agrees on a probe, and never for texts that hold a
    special token's string or unusual white space, or runs of ``RUN_BYTES`` characters or more of one kind, which it can't hold on its stack.
    """

    PROBE = "It's Über-1234  «día»\n\n\t ça va?!  we'll see...\r\n 日本語 \U0001f600 the end "

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [x.content for x in added.values()]
        self.fast = ranked(self.tokenizer)
        if self.fast is not None and self.fast.encode_ordinary(self.PROBE) != self._plain(self.PROBE):
            self.fast = None

    def _plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> bytes:
        if self.fast is None or not plain_text(text) or any(s in text for s in self.special):
            return array("I", self._plain(text)).tobytes()
        return array("I", self.fast.encode_ordinary(text)).tobytes()


@lru_cache(2)
def encoder_of(path: str) -> Encoder:
    """The encoder of a file; a Python worker keeps it for its next tasks."""
    return Encoder(path)


def plain_text(text: str) -> bool:
    """Whether the fast library may encode it: no unusual white space and no run that overflows its stack."""
    return not _ODD.search(text) and (len(text) < RUN_BYTES or not _RUN.search(text))


def ranked(tokenizer):
    """The vocabulary as a ``tiktoken`` encoding, or None where the file doesn't prove that it works alike: no normaliser, the
    byte-level cuts without a blank before, plain merges, each of which makes a token of its own in the order of ids."""
    try:
        import tiktoken
    except ImportError:
        return None
    file, of = json.loads(tokenizer.to_str()), byte_of()
    cuts, model = file["pre_tokenizer"] or {}, file["model"]
    if file["normalizer"] or cuts.get("type") != "ByteLevel" or cuts.get("add_prefix_space") or not cuts.get("use_regex", True):
        return None
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if model["type"] != "BPE" or any(model.get(x) for x in odd):
        return None
    made = [model["vocab"].get("".join(m if isinstance(m, list) else m.split(" ")), -1) for m in model.get("merges", [])]
    if not made or min(made) < 0 or any(a >= b for a, b in zip(made[:-1], made[1:], strict=True)):
        return None
    added = tokenizer.get_added_tokens_decoder()
    vocabulary = {w: i for w, i in tokenizer.get_vocab(with_added_tokens=False).items() if i not in added}
    if not all(c in of for w in vocabulary for c in w):
        return None
    ranks = {bytes(of[c] for c in w): i for w, i in vocabulary.items()}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class BestFit:
    """Places lengths into bins of ``size``; ``place`` gives the bin and the offset in it."""

    def __init__(self, size: int = LENGTH, open_bins: int = OPEN_BINS):
        self.size, self.limit = size, open_bins
        self.free: list[list[int]] = [[] for _ in range(size + 1)]  # open bins by free space
        self.bits = 0  # bit f: a bin with f free is open
        self.count = 0
        self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.bits >> length
        if fitting and length:
            space = length + (fitting & -fitting).bit_length() - 1
            bin_ = self.free[space].pop()
            if not self.free[space]:
                self.bits ^= 1 << space
            self.count -= 1
        else:
            space, bin_ = self.size, self.made
            self.made += 1
        left = space - length
        if left:
            if self.count >= self.limit:  # the fullest of the open bins closes
                fullest = (self.bits & -self.bits).bit_length() - 1
                if fullest <= left:
                    self.free[fullest].pop()
                    if not self.free[fullest]:
                        self.bits ^= 1 << fullest
                    self.count -= 1
                else:
                    return bin_, self.size - space
            self.free[left].append(bin_)
            self.bits |= 1 << left
            self.count += 1
        return bin_, self.size - space


def pieces(length: int, size: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: the first takes the remainder, the others are full."""
    if length <= size:
        return [(0, length)]
    first = length % size or size
    return [(0, first)] + [(at, size) for at in range(first, length, size)]


def pack(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", size: int = LENGTH, end: int = END, open_bins: int = OPEN_BINS
) -> DataFrame:
    """One row a piece of a document: where its ids start in the document, and its sequence and offset there.

    A null text counts as empty: its document is the end id alone.  Documents longer than ``size`` are cut, others never
    are; repeated rows are packed each; a null key stays null; other columns aren't read, whatever their names.  An empty
    table gives no rows.
    """
    bound_batches(docs.sparkSession)
    tail = end.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, bins = encoder_of(path), BestFit(size, open_bins)
        base = TaskContext.get().partitionId() << 36
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for at in range(0, len(batch), RUN):
                found = []
                for i in range(at, min(at + RUN, len(batch))):
                    ids = encoder.encode(texts[i].as_py() or "") + tail
                    for k, (start, length) in enumerate(pieces(len(ids) // 4, size)):
                        found.append((-length, i, k, start, zlib.crc32(ids[4 * start : 4 * (start + length)])))
                placed = [bins.place(-x[0]) for x in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array([x[1] for x in found], pa.int64())).cast(pa.int64()), pa.array([x[2] for x in found], pa.int32()),
                        pa.array([x[3] for x in found], pa.int64()), pa.array([-x[0] for x in found], pa.int64()), pa.array([x[4] for x in found], pa.int64()),
                        pa.array([base + b for b, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
                )

    return docs.select(F.col(key).cast("long").alias("_k"), F.col(text).cast("string").alias("_t")).mapInArrow(run, SCHEMA)


def tokenizer_path() -> str:
    """The public vocabulary file that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path())
