"""Substring dedup by collinear chaining of shared word k-mers.

Documents of equal words are one: each copy is one passage of the smallest key's document.  Of the others minimisers (the
least k-mer hash of every window) are the seeds.  A seed in few places is matched with all its earlier places, one in many
with the first of them.  Places of these that no passage covers then are compared with all earlier places of their seed by the
words around them at the places' own distance, until one makes a passage that holds the place.  Matches of two documents are
merged along diagonals, chained with gap costs through a Fenwick tree, and the chains are aligned word by word; what reaches
the length and the identity is a repeated passage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftspark.llm import textkit as tk
from siftspark.llm.common import written
from siftspark.llm.jaccard_join import BROADCAST_IDS, of_ids
from siftspark.llm.toxicity import segments

K = 4
WINDOW = 6
LENGTH = 50
IDENTITY = 0.8
#: Score of a seed in a chain, and cost of a word of gap in either document.
SEED, GAP = 10.0, 0.1
#: Occurrences up to which a seed is rare: each is matched with all before it.
RARE = 32
#: Occurrences from which a seed may be hot, and hot seeds at most: their first places are sent to all tasks, so that their
#: occurrences needn't come together.
HOT, HOT_SEEDS = 256, 200_000
#: Words on either side of a frequent seed's place by which it is compared with others, and words that are counted at once.
REACH, STEP = 150, 25
#: Places of a frequent seed that meet in one task, about, and pairs of them that are compared at once.
PLACES, CELLS = 32_768, 1 << 18
#: Words of a block; places of a seed that share a passage agree in several.
BLOCK = 3
#: Words beyond a chain's ends that are aligned too.
MARGIN = 100
#: Chains of one source that one task gives its words to, about.
SHARE = 512
#: Bytes of text over which a seed is counted before it is reported as locally frequent.
COUNTED = 8 << 20
#: Matches on one diagonal are one fragment up to this distance.
NEAR = 40

SCHEMA = "doc_id long, start_word long, end_word long, source_id long, source_start long, source_end long, identity double"


def minimisers(w: tk.Words, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, hash, word position) of the least k-mer of every window, or of the whole text if it is shorter."""
    doc, h, at = tk.shingles(w, k, short=False)
    n = len(h)
    if not n:
        return doc, h, at
    count = np.bincount(doc, minlength=w.n_docs)
    first = np.concatenate([[0], np.cumsum(count)])
    end = first[doc + 1]
    # the place of the least hash in [i, i + window), by doubling; the leftmost of equal ones
    best = np.arange(n)
    size = 1
    while size < window:
        step = min(size, window - size)
        other = np.minimum(np.arange(n) + step, n - 1)
        inside = np.arange(n) + step < end
        rival = best[other]
        best = np.where(inside & (h[rival] < h[best]), rival, best)
        size += step
    starts = np.arange(n)
    whole = (starts + window <= end) | (starts == first[doc])
    chosen = np.unique(best[whole])
    # runs of one repeated k-mer (a word over and over) keep one seed a window
    same = np.zeros(len(chosen), bool)
    same[1:] = (h[chosen[1:]] == h[chosen[:-1]]) & (doc[chosen[1:]] == doc[chosen[:-1]]) & (np.diff(chosen) < window)
    begin = np.maximum.accumulate(np.where(same, 0, np.arange(len(chosen))))
    place = (chosen - chosen[begin]) // window
    keep = ~same
    keep[1:] |= place[1:] != place[:-1]
    chosen = chosen[keep]
    return doc[chosen], h[chosen], at[chosen] - w.first[doc[chosen]]


def _prepared(k: int, window: int, length: int):
    """Kind 0: each long document's words as 128 bits, and their number.  Kind 1: seeds that are frequent in a run of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out(kind: int, id_, a, b, n) -> pa.RecordBatch:
            names = ["kind", "id", "a", "b", "n"]
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), id_, pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(n.astype(np.int64))], names=names)

        def frequent() -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held), return_counts=True)
            values, n = values[n >= 3], n[n >= 3]
            return out(1, pa.array(np.zeros(len(values), np.int64)), values, np.zeros(len(values), np.uint64), n)

        for batch in batches:
            for i, _, buf, off in tk.slices(batch.column(1)):
                w = tk.Words(buf, off, tk.ALNUM)
                some = np.flatnonzero(w.count >= length)
                place = tk.mix64(w.pos.astype(np.uint64) + np.uint64(1))
                sums = []
                for mixed in (w.hash ^ place, w.hash + place * np.uint64(3)):
                    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tk.mix64(mixed))])
                    sums.append((total[w.first[1:]] - total[w.first[:-1]])[some])
                yield out(0, batch.column(0).take(pa.array(i + some)), *sums, w.count[some])
                doc, h, _ = minimisers(w, k, window)
                held.append(h[w.count[doc] >= length])
                size += len(buf)
                if size >= COUNTED:
                    yield frequent()
                    held, size = [], 0
        if held:
            yield frequent()

    return run


def _seeded(k: int, window: int, length: int, hot: np.ndarray, wanted: bool):
    """Seeds of long documents: the hot ones if they are wanted, else all others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = tk.HashIndex(hot)
        for batch in batches:
            for i, _, buf, off in tk.slices(batch.column(1)):
                w = tk.Words(buf, off, tk.ALNUM)
                doc, h, pos = minimisers(w, k, window)
                keep = (w.count[doc] >= length) & ((index.find(h) >= 0) == wanted)
                doc, h, pos = doc[keep], h[keep], pos[keep]
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), batch.column(0).take(pa.array(i + doc)), pa.array(pos.astype(np.int32))], names=["h", "id", "pos"])

    return run


def chain(start: np.ndarray, end: np.ndarray, diagonal: np.ndarray, score: np.ndarray, gap: float = GAP) -> list[list[int]]:
    """Fragments (start and end in one text, diagonal to the other) as collinear chains, each fragment in one at most.

    The best chain that ends at a fragment extends the best earlier one whose end lies before it in both texts; gaps cost
    their words in both texts, so the best is a prefix maximum over the other text's ends, kept in a Fenwick tree.
    """
    n = len(start)
    if n == 1:
        return [[0]]
    other_start, other_end = start + diagonal, end + diagonal
    places = np.unique(other_end)
    tree: list[tuple[float, int]] = [(-np.inf, -1)] * (len(places) + 1)
    best, before = np.array(score, float), np.full(n, -1)
    # ends enter the tree when the scan along the first text has passed them
    events = sorted([(int(start[i]), 0, i) for i in range(n)] + [(int(end[i]), 1, i) for i in range(n)], key=lambda e: (e[0], -e[1]))
    for _, kind, i in events:
        if kind:
            value = (best[i] + gap * (end[i] + other_end[i]), i)
            p = int(np.searchsorted(places, other_end[i])) + 1
            while p < len(tree):
                if value > tree[p]:
                    tree[p] = value
                p += p & -p
        else:
            p = int(np.searchsorted(places, other_start[i], "right"))
            top = (-np.inf, -1)
            while p:
                top = max(top, tree[p])
                p -= p & -p
            gain = top[0] - gap * (start[i] + other_start[i])
            if gain > 0:
                best[i], before[i] = score[i] + gain, top[1]
    used, out = np.zeros(n, bool), []
    for i in np.argsort(-best, kind="stable").tolist():
        path = []
        while i >= 0 and not used[i]:
            used[i] = True
            path.append(i)
            i = int(before[i])
        if path:
            out.append(path[::-1])
    return out


def _fragments(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Matches of one batch of whole pairs, merged along diagonals: pair index, start, end, diagonal, seeds."""
    b, a, pos, source = (batch.column(c).to_numpy() for c in ("id", "source", "pos", "source_pos"))
    diagonal = source.astype(np.int64) - pos
    order = np.lexsort((pos, diagonal, a, b))
    b, a, pos, diagonal = b[order], a[order], pos[order].astype(np.int64), diagonal[order]
    new = np.ones(len(b), bool)
    new[1:] = (b[1:] != b[:-1]) | (a[1:] != a[:-1]) | (diagonal[1:] != diagonal[:-1]) | (pos[1:] - pos[:-1] > NEAR)
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(b)) - 1
    return b[at], a[at], pos[at], pos[last] + K, diagonal[at], last - at + 1


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chains of each pair of documents: their fragments' starts, ends and diagonals as one binary column."""

    def out(rows: pa.RecordBatch) -> pa.RecordBatch:
        b, a, start, end, diagonal, seeds = _fragments(rows)
        cut = np.flatnonzero(np.r_[True, (b[1:] != b[:-1]) | (a[1:] != a[:-1]), True])
        result = []
        for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            for path in chain(start[x:y], end[x:y], diagonal[x:y], SEED * seeds[x:y]):
                path = x + np.array(path)
                if seeds[path].sum() > 1:  # one seed alone is mostly chance
                    result.append((int(b[x]), int(a[x]), np.stack([start[path], end[path], diagonal[path]]).astype(np.int64).tobytes()))
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in result], pa.int64()), pa.array([r[1] for r in result], pa.int64()), pa.array([r[2] for r in result], pa.binary())], names=["id", "source", "f"])

    held = None
    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if not len(batch):
            continue
        b, a = batch.column("id").to_numpy(), batch.column("source").to_numpy()
        same = (b == b[-1]) & (a == a[-1])
        whole = len(b) if not same.any() else int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if whole:
            yield out(batch.slice(0, whole))
        held = batch.slice(whole)
    if held is not None and len(held):
        yield out(held)


def align(words: np.ndarray, source: np.ndarray, fragments: np.ndarray, length: int = LENGTH, identity: float = IDENTITY) -> list[tuple]:
    """Passages (start, end, source start, source end, identity) along one chain of fragments.

    Between two fragments the cut goes where most words agree on either diagonal; the ends are carried on to where the
    texts end, and maximal segments of agreement with enough identity are kept.
    """
    start, end, diagonal = fragments
    d = np.empty(len(words), np.int64)
    cut = 0
    for i in range(len(start)):
        if i + 1 < len(start) and diagonal[i + 1] != diagonal[i]:
            lo, hi = int(min(end[i], start[i + 1])), int(max(end[i], start[i + 1]))
            x = np.arange(lo, hi)
            left = _agree(words, source, x, diagonal[i])
            right = _agree(words, source, x, diagonal[i + 1])
            gain = np.concatenate([[0], np.cumsum(left.astype(int) - right)])
            nxt = lo + int(gain.argmax())
        else:
            nxt = len(words) if i + 1 == len(start) else int(start[i + 1])
        d[cut:nxt] = diagonal[i]
        cut = max(cut, nxt)
    x = np.arange(len(words))
    same = _agree(words, source, x, d)
    run = np.flatnonzero(np.r_[True, same[1:] != same[:-1]])
    size = np.diff(np.append(run, len(words)))
    weight = np.where(same[run], size * 1.0, size * -(identity / (1 - identity)))
    kept = [(int(run[a]), int(run[b - 1] + size[b - 1])) for a, b, _ in segments(weight)]
    kept = [(s, e) for s, e in kept if e - s >= length]
    # Where edits lie so evenly that no segment is long enough, a longer range may still agree in enough of its words.
    edges = [0, *(x for p in kept for x in p), len(words)]
    for a, b in zip(edges[::2], edges[1::2], strict=True):
        kept += _ranges(same, a, b, length, identity)
    return [(s, e, int(s + d[s]), int(e + d[e - 1]), float(same[s:e].mean())) for s, e in sorted(kept)]


def _ranges(same: np.ndarray, a: int, b: int, length: int, identity: float) -> list[tuple[int, int]]:
    """The longest range within [a, b) that has the length and the identity and begins and ends with an agreeing word, then
    those on either side of it."""
    if b - a < length or same[a:b].sum() < identity * length:
        return []
    total = np.concatenate([[0], np.cumsum(same[a:b] - identity)])
    starts, ends = np.flatnonzero(same[a:b]), np.flatnonzero(same[a:b]) + 1
    top = np.maximum.accumulate(total[ends][::-1])  # of the last i ends, ascending with i
    last = len(ends) - 1 - np.searchsorted(top, total[starts] - 1e-9)
    size = np.where(last >= 0, ends[last] - starts, 0)
    i = int(size.argmax())
    if size[i] < length:
        return []
    s, e = a + int(starts[i]), a + int(ends[last[i]])
    return [*_ranges(same, a, s, length, identity), (s, e), *_ranges(same, e, b, length, identity)]


def _agree(words: np.ndarray, source: np.ndarray, x: np.ndarray, diagonal) -> np.ndarray:
    y = x + diagonal
    inside = (y >= 0) & (y < len(source))
    out = np.zeros(len(x), bool)
    out[inside] = words[x[inside]] == source[y[inside]]
    return out


def _worded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each text from ``lo`` to ``hi``, 32 bits a word."""
    for batch in tk.parts(batches):
        for i, j, buf, off in tk.slices(batch.column(1)):
            w = tk.Words(buf, off, tk.ALNUM)
            lo, hi = (batch.column(c).slice(i, j - i).to_numpy() for c in (2, 3))
            low, high = w.first[:-1] + np.minimum(np.maximum(lo, 0), w.count), w.first[:-1] + np.minimum(hi, w.count)
            half = (w.hash >> np.uint64(32)).astype(np.uint32)
            words = pa.array([half[a:b].tobytes() for a, b in zip(low.tolist(), high.tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(low - w.first[:-1]), words], names=["id", "at", "w"])


def _cut(name: str, start: str):
    """Replaces a document's words (w, from word ``at`` on) by those near the row's chain: (name, name_at)."""
    other = start == "source"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.parts(batches):
            words, first = [], []
            for f, at, w in zip(*(batch.column(c).to_pylist() for c in ("f", "at", "w")), strict=True):
                lo, hi = _reach(np.frombuffer(f, np.int64).reshape(3, -1), other)
                lo = max(lo, at)
                words.append(w[4 * (lo - at) : 4 * (hi - at)])
                first.append(lo)
            keep = [c for c in batch.schema.names if c not in ("at", "w")]
            columns = [*(batch.column(c) for c in keep), pa.array(first, pa.int64()), pa.array(words, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, f"{name}_at", name])

    return run


def _reach(fragments: np.ndarray, other: bool) -> tuple[int, int]:
    """The words around a chain in its document, or in the other one."""
    start, end, diagonal = fragments
    if other:
        start, end = start + diagonal, end + diagonal
    return max(0, int(start.min()) - MARGIN), int(end.max()) + MARGIN


def _reaches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, lo, hi) of both documents of each chain."""
    for batch in tk.parts(batches):
        rows = []
        for a, b, f in zip(*(batch.column(c).to_pylist() for c in ("id", "source", "f")), strict=True):
            parts = np.frombuffer(f, np.int64).reshape(3, -1)
            rows += [(a, *_reach(parts, False)), (b, *_reach(parts, True))]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], names=["id", "lo", "hi"])


def _aligned(length: int, identity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.parts(batches):
            rows = []
            for b, a, f, at, w, of, s in zip(*(batch.column(c).to_pylist() for c in ("id", "source", "f", "w_at", "w", "s_at", "s")), strict=True):
                parts = np.frombuffer(f, np.int64).reshape(3, -1) + np.array([[-at], [-at], [at - of]])
                for p in align(np.frombuffer(w, np.uint32), np.frombuffer(s, np.uint32), parts, length, identity):
                    rows.append((b, p[0] + at, p[1] + at, a, p[2] + of, p[3] + of, p[4]))
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            types = [pa.int64()] * 6 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "start_word", "end_word", "source_id", "source_start", "source_end", "identity"])

    return run


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each place (h, id, pos, target) of a text with the words within REACH of it, 16 bits a word, from word ``at`` on."""
    for batch in tk.parts(batches):
        for i, j, buf, off in tk.slices(batch.column(1)):
            w = tk.Words(buf, off, tk.ALNUM)
            short = (w.hash >> np.uint64(48)).astype(np.uint16)
            places = batch.column(2).slice(i, j - i)
            flat, n = places.flatten(), pc.list_value_length(places).to_numpy()
            doc = np.repeat(np.arange(j - i), n)
            h, pos, target = (flat.field(c) for c in range(3))
            at = np.maximum(pos.to_numpy() - REACH, 0)
            low, high = w.first[doc] + at, w.first[doc] + np.minimum(pos.to_numpy() + REACH, w.count[doc])
            words = pa.array([short[x:y].tobytes() for x, y in zip(low.tolist(), high.tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([h, batch.column(0).slice(i, j - i).take(pa.array(doc)), pos, target, pa.array(at.astype(np.int32)), words], names=["h", "id", "pos", "target", "at", "w"])


def _compared(length: int, identity: float):
    """Of groups (h, part, share) of places, each a target, a source or both: matches of each target with an earlier source whose
    words around it make a passage that holds the target.  All sources are compared until one does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h", "part", "share", "as_target", "as_source", "id", "pos", "at", "w"]
        held: list[pa.RecordBatch] = []

        def out(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            groups = [rows.column(c).to_numpy() for c in names[:3]]
            cut = np.flatnonzero(np.r_[True, np.any([g[1:] != g[:-1] for g in groups], axis=0), True])
            found = []
            for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                found += _earlier(_Places(rows.slice(x, y - x)), length, identity)
            columns = list(zip(*found, strict=True)) or [[]] * 4
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["id", "pos", "source", "source_pos"])

        for batch in batches:
            batch = batch.select(names)
            if not len(batch):
                continue
            same = np.all([batch.column(c).to_numpy() == batch.column(c)[len(batch) - 1].as_py() for c in range(3)], axis=0)
            last = [held[0].column(c)[0].as_py() for c in range(3)] if held else None
            if held and last != [batch.column(c)[len(batch) - 1].as_py() for c in range(3)] or not held and not same.all():
                whole = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
                yield out(pa.Table.from_batches([*held, batch.slice(0, whole)]))
                held, batch = [], batch.slice(whole)
            held.append(batch)
        if held:
            yield out(pa.Table.from_batches(held))

    return run


class _Places:
    """Places of one seed, by text, with the words around each, end to end."""

    def __init__(self, rows: pa.Table):
        self.id, self.pos, self.at = (rows.column(c).to_numpy().astype(np.int64) for c in ("id", "pos", "at"))
        self.target, self.source = (rows.column(c).to_numpy() for c in ("as_target", "as_source"))
        w = rows.column("w").to_pylist()
        self.words = np.frombuffer(b"".join(w), np.uint16)
        self.first = np.concatenate([[0], np.cumsum([len(x) // 2 for x in w])])

    def of(self, i: int) -> np.ndarray:
        return self.words[self.first[i] : self.first[i + 1]]

    def lined(self) -> np.ndarray:
        """The words around each place as a row, all places in the middle; 0 where a text has none."""
        out, n = np.zeros((len(self.id), 2 * REACH), np.uint16), np.diff(self.first)
        owner = np.repeat(np.arange(len(n)), n)
        out[owner, np.arange(len(owner)) - (self.first[:-1] - self.at + self.pos - REACH)[owner]] = np.maximum(self.words, 1)
        return out


def alike_blocks(length: int, identity: float) -> int:
    """How many blocks of BLOCK words, all at one distance, agree in any passage at least, that of the seed left out.

    A passage holds one of ``length`` words or more and less than twice as many; each word that differs spoils one block."""
    return min((n - BLOCK + 1) // BLOCK - int((1 - identity) * n + 1e-9) for n in range(length, 2 * length)) - 1


def _shared(lined: np.ndarray, spare: int) -> tuple[np.ndarray, np.ndarray]:
    """(key's number, place) of blocks that places share, in that order: the words of a block and where it lies are its key.  The
    seed's own block is left out, and each place's ``spare`` most frequent ones: places that share more than ``spare`` blocks still
    share the rarest of these."""
    found, numbers, blocks = [], 0, lined.shape[1] // BLOCK
    step = max(1, CELLS // len(lined))
    for x in range(0, blocks, step):
        key, whole = np.arange(x, min(x + step, blocks), dtype=np.uint64)[None, :], True
        for c in range(BLOCK):
            word = lined[:, BLOCK * x + c : BLOCK * (x + step) : BLOCK]
            key, whole = key << np.uint64(16) | word, whole & (word > 0)
        if x <= REACH // BLOCK < x + step:
            whole[:, REACH // BLOCK - x] = False
        owner, key = np.nonzero(whole)[0], key[whole]
        if not len(key):
            continue
        order = np.argsort(key, kind="stable")
        owner, key = owner[order], key[order]
        number = np.cumsum(np.r_[False, key[1:] != key[:-1]])
        size = np.bincount(number)[number]
        found.append([c[size > 1] for c in (number + numbers, owner, size)])
        numbers += int(number[-1]) + 1
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    number, owner, size = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((number, -size, owner))
    begin = np.r_[True, owner[order][1:] != owner[order][:-1]][: len(order)]
    rank = np.arange(len(order)) - np.maximum.accumulate(np.where(begin, np.arange(len(order)), 0))
    kept = np.sort(order[rank >= spare])
    return number[kept], owner[kept]


def _earlier(p: _Places, length: int, identity: float) -> list[tuple[int, int, int, int]]:
    """Targets are compared with those sources of smaller keys that agree in a block beyond what is usual, the first sources first."""
    found: list[tuple[int, int, int, int]] = []
    before, alive, n = np.searchsorted(p.id, p.id), p.target.copy(), len(p.id)
    alive &= before > 0
    if not alive.any():
        return found
    lined, spare = p.lined(), alike_blocks(length, identity) - 1
    # without blocks that must agree all places share one key
    number, owner = _shared(lined, spare) if spare >= 0 else (np.zeros(n, np.int64), np.arange(n))
    standing = np.zeros(n, bool)
    standing[_apart(p, np.flatnonzero(p.source))] = True
    sources = (number * n + owner)[standing[owner]]
    entry = np.flatnonzero(alive[owner])
    entry = entry[np.argsort(owner[entry], kind="stable")]
    to, lo, size = np.maximum(np.searchsorted(_along(p), _along(p) + LENGTH), np.arange(n) + 1), 0, 64
    while lo < n and len(entry):
        hi, size = lo + size, 2 * size
        entry = entry[alive[owner[entry]] & (before[owner[entry]] > lo)]
        live = np.zeros(n, bool)
        live[_apart(p, np.flatnonzero(alive & (before > lo)))] = True
        now = entry[live[owner[entry]]]
        low = np.searchsorted(sources, number[now] * n + lo)
        high = np.searchsorted(sources, number[now] * n + np.minimum(hi, before[owner[now]]))
        some = np.flatnonzero(high > low)
        # whole targets, about CELLS pairs at once
        step = np.cumsum((high - low)[some]) // CELLS
        new = np.flatnonzero(np.r_[True, owner[now[some]][1:] != owner[now[some]][:-1]][: len(some)])
        cut = [*new[np.r_[True, np.diff(step[new]) > 0][: len(new)]].tolist(), len(some)]
        for x, y in zip(cut[:-1], cut[1:], strict=True):
            i, j = _expanded(some[x:y], low, high)
            pairs = np.unique(owner[now[i]] * n + sources[j] % n)
            for a, b in _alike(lined, pairs // n, pairs % n, length, identity):
                if alive[a : to[a]].any():
                    _verify(p, a, b, alive, found, length, identity)
        lo = hi
    return found


def _along(p: _Places) -> np.ndarray:
    """The places' positions, each text's beyond those of the one before."""
    return np.cumsum(np.r_[0, p.id[1:] != p.id[:-1]]) * (1 << 32) + p.pos


def _apart(p: _Places, some: np.ndarray) -> np.ndarray:
    """Of these places those that stand for all: the first of each text, and the next that is LENGTH words from the one before.
    What lies between is within reach of the one before."""
    kept, last, along = [], -LENGTH, _along(p)[some].tolist()
    for k, at in zip(some.tolist(), along, strict=True):
        if at >= last + LENGTH:
            kept.append(k)
            last = at
    return np.array(kept, np.int64)


def _alike(lined: np.ndarray, ts: np.ndarray, ss: np.ndarray, length: int, identity: float) -> Iterator[tuple[int, int]]:
    """Of these pairs of places those with a range of words that holds the place, or one of those that it stands for, begins and ends
    with a word that agrees, has the length and agrees in enough of its words, all at the places' own distance.  Words are counted by runs of STEP first, so that no pair with such words is left out."""
    runs, span, most = 2 * REACH // STEP, -(-length // STEP) + 1, CELLS // REACH
    near, ends = REACH + LENGTH, np.arange(REACH + 1, 2 * REACH + 1)
    for x in range(0, len(ts), most):
        t, s = ts[x : x + most], ss[x : x + most]
        same = (lined[t] == lined[s]) & (lined[t] > 0)
        total = same.reshape(len(t), runs, STEP).sum(axis=2, dtype=np.int16)
        some = np.flatnonzero(sum(total[:, i : runs - span + 1 + i] for i in range(span)).max(axis=1) >= identity * length - 1e-9)
        gain = np.zeros((len(some), 2 * REACH + 1), np.float32)
        np.cumsum(same[some] - np.float32(identity), axis=1, out=gain[:, 1:])
        least = np.minimum.accumulate(np.where(same[some, :near], gain[:, :near], np.float32(np.inf)), axis=1)
        enough = gain[:, ends] >= least[:, np.clip(ends - length, 0, near - 1)] - 1e-3
        good = some[(enough & same[some][:, ends - 1])[:, ends >= length].any(axis=1)]
        yield from zip(t[good].tolist(), s[good].tolist(), strict=True)


def _expanded(some: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of all j from low[i] up to high[i], for each i of ``some``."""
    n = (high - low)[some]
    return np.repeat(some, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[some], n)


def _verify(p: _Places, i: int, j: int, alive: np.ndarray, found: list, length: int, identity: float) -> None:
    """The passages at the places' own distance that hold targets, as matches along them; these targets are done."""
    at = p.pos[i] - p.at[i]
    diagonal = p.pos[j] - p.at[j] - at
    own = slice(*np.searchsorted(p.id, [p.id[i], p.id[i] + 1]).tolist())
    for x, y, *_ in align(p.of(i), p.of(j), np.array([[at], [at + K], [diagonal]]), length, identity):
        done = own.start + np.flatnonzero(alive[own] & (p.pos[own] >= x + p.at[i]) & (p.pos[own] < y + p.at[i]))
        if len(done):
            alive[done] = False
            for q in [*range(x, y - K, NEAR // 2), y - K]:
                found.append((int(p.id[i]), int(q + p.at[i]), int(p.id[j]), int(q + diagonal + p.at[j])))


def _rest(frequent: DataFrame, found: DataFrame, rows: DataFrame, length: int, identity: float) -> DataFrame:
    """Matches of the places (h, id, pos) of frequent seeds that no passage found so far holds with all earlier places, as far as
    the words around them make a passage.  The places of one seed are dealt out: each part of targets meets each share of
    sources in a task of bounded size."""
    spans = found.groupBy("doc_id").agg(F.collect_set(F.struct("start_word", "end_word")).alias("spans"))
    covered = F.exists("spans", lambda p: (p["start_word"] <= F.col("pos")) & (F.col("pos") < p["end_word"]))
    places = written(frequent.join(spans, F.col("id") == F.col("doc_id"), "left").select("h", "id", "pos", (~F.coalesce(covered, F.lit(False))).alias("target")))
    sizes = places.groupBy("h").agg(F.count("*").alias("sources"), F.count_if("target").alias("targets"), F.min("id").alias("least"), F.max(F.when(F.col("target"), F.col("id"))).alias("last"))
    dealt = lambda n: F.when(F.col("sources") > PLACES, F.col(n) / PLACES).otherwise(0).cast("int")
    sizes = written(sizes.where("least < last").select("h", dealt("targets").alias("parts"), dealt("sources").alias("shares")))
    by_id = written(of_ids(places, sizes.select("h"), "h").groupBy("id").agg(F.collect_list(F.struct("h", "pos", "target")).alias("places")))
    few = by_id.count() <= BROADCAST_IDS
    around = rows.join(F.broadcast(by_id) if few else by_id, "id").select("id", "t", "places").mapInArrow(_contexts, "h long, id long, pos int, target boolean, at int, w binary")
    around = written(around)
    sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_IDS else sizes
    all_ = around.join(sizes, "h")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n)))
    own = lambda n: F.pmod(F.xxhash64("id", F.lit(3)), F.col(n) + 1).cast("int")
    columns, group = ["id", "pos", "at", "w"], ["h", "part", "share"]
    whole = all_.where("shares = 0").select("h", F.lit(0).alias("part"), F.lit(0).alias("share"), F.col("target").alias("as_target"), F.lit(True).alias("as_source"), *columns)
    large = all_.where("shares > 0")
    targets = large.where("target").select("h", own("parts").alias("part"), every("shares").alias("share"), F.lit(True).alias("as_target"), F.lit(False).alias("as_source"), *columns)
    sources = large.select("h", every("parts").alias("part"), own("shares").alias("share"), F.lit(False).alias("as_target"), F.lit(True).alias("as_source"), *columns)
    met = whole.unionByName(targets).unionByName(sources).repartition(*group).sortWithinPartitions(*group, "id", "pos")
    return met.mapInArrow(_compared(length, identity), "id long, pos int, source long, source_pos int")


def _met(seeds: DataFrame) -> DataFrame:
    """Of each occurrence (h, id, pos) the number n of its seed's, and the places ``to`` that it is matched with: all earlier
    ones of a rare seed, else the first one.  Seeds of one document alone are left out."""
    by, place = Window.partitionBy("h"), F.struct("id", "pos")
    order = by.orderBy("id", "pos")
    met = seeds.select(
        "*", F.count("*").over(by).alias("n"), F.min("id").over(by).alias("least"), F.max("id").over(by).alias("last"),
        F.first(place).over(order).alias("x"), F.collect_list(place).over(order.rowsBetween(-RARE, -1)).alias("before"),
    )
    to = F.when(F.col("n") <= RARE, F.col("before")).otherwise(F.array("x"))
    return met.where("least < last").select("h", "id", "pos", "n", F.filter(to, lambda p: p["id"] < F.col("id")).alias("to"))


def _matches(met: DataFrame) -> DataFrame:
    return met.select("id", "pos", F.explode("to").alias("s")).select("id", "pos", F.col("s.id").alias("source"), F.col("s.pos").alias("source_pos"))


def _with_first(seeds: DataFrame, first: DataFrame) -> DataFrame:
    """Matches of hot seeds with their first places ``x``, which have a bounded number of rows."""
    found = seeds.join(F.broadcast(first), "h").where("x.id < id")
    return found.select("id", "pos", F.col("x.id").alias("source"), F.col("x.pos").alias("source_pos"))


def passages(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, window: int = WINDOW, length: int = LENGTH, identity: float = IDENTITY) -> DataFrame:
    """Repeated passages: word ranges of a document that stand in a source document of a smaller key.

    Words are runs of letters and digits, A-Z as a-z.  A passage has at least ``length`` words, of which ``identity`` agree.
    Null and empty texts, and null keys, have none; of rows with one key the longest text (then the greatest) stands for
    all; of equal texts the smallest key's is the source, and the others take part through it alone.  A very long text is
    handled whole; other columns aren't read, whatever their names.  An empty table gives no rows.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("t")).where("id is not null and t is not null")
    twice = written(rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"))
    if twice.take(1):
        one = of_ids(rows, twice, "id").groupBy("id").agg(F.max(F.struct(F.length("t").alias("n"), "t")).alias("x")).select("id", "x.t")
        rows = of_ids(rows, twice, "id", "left_anti").unionByName(written(one))
    ready = written(rows.mapInArrow(_prepared(k, window, length), "kind int, id long, a long, b long, n long"))
    same = ["a", "b", "n"]
    whole = ready.where("kind = 0")
    classes = whole.groupBy(*same).agg(F.min("id").alias("rep"), F.count("*").alias("m")).where("m > 1")
    copies = written(whole.join(classes, same).where("id <> rep").select("id", "rep", "n"))
    alone = of_ids(rows, copies.select("id"), "id", "left_anti")
    often = ready.where("kind = 1").groupBy("a").agg(F.sum("n").alias("n")).where(F.col("n") >= HOT).orderBy(F.desc("n"), "a").limit(HOT_SEEDS).toPandas()
    hot = often["a"].to_numpy(np.int64).view(np.uint64)
    schema = "h long, id long, pos int"
    met = written(_met(alone.mapInArrow(_seeded(k, window, length, hot, False), schema)))
    common = written(alone.mapInArrow(_seeded(k, window, length, hot, True), schema)) if len(hot) else alone.sparkSession.createDataFrame([], schema)
    first = common.groupBy("h").agg(F.min(F.struct("id", "pos")).alias("x"))  # as many rows as hot seeds, at most
    found = written(_passages_of(_matches(met).unionByName(_with_first(common, first)), alone, length, identity))
    # What lies in a passage has its source; the rest of the frequent seeds is compared with all that is earlier.
    frequent = met.where(F.col("n") > RARE).select("h", "id", "pos").unionByName(common)
    more = _passages_of(_rest(frequent, found, alone, length, identity), alone, length, identity)
    equal = copies.select(
        F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("start_word"), F.col("n").alias("end_word"), F.col("rep").alias("source_id"),
        F.lit(0).cast("long").alias("source_start"), F.col("n").alias("source_end"), F.lit(1.0).alias("identity"),
    )
    out = found.unionByName(more).unionByName(equal).distinct()
    return out


def _passages_of(matches: DataFrame, rows: DataFrame, length: int, identity: float) -> DataFrame:
    """The passages along the chains of these matches of the rows' words."""
    chains = written(matches.repartition("id", "source").sortWithinPartitions("id", "source").mapInArrow(_chained, "id long, source long, f binary"))
    need = written(chains.mapInArrow(_reaches, "id long, lo long, hi long").groupBy("id").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    few = need.count() <= BROADCAST_IDS
    words = written(rows.join(F.broadcast(need) if few else need, "id").select("id", "t", "lo", "hi").mapInArrow(_worded, "id long, at long, w binary"))
    # The words of a source with many chains go to as many tasks as they fill.
    tasks = chains.groupBy("source").agg((F.count("*") / F.lit(SHARE)).cast("int").alias("more"))
    salted = chains.join(tasks, "source").withColumn("salt", F.pmod(F.xxhash64("id"), F.col("more") + 1).cast("int")).drop("more")
    of = words.join(tasks.select(F.col("source").alias("id"), "more"), "id")
    of = of.select(F.col("id").alias("source"), "at", "w", F.explode(F.sequence(F.lit(0), F.col("more"))).alias("salt"))
    half = salted.join(of, ["source", "salt"]).select("id", "source", "f", "at", "w").mapInArrow(_cut("s", "source"), "id long, source long, f binary, s_at long, s binary")
    # A merge join ends the stage, and one function does what is left: no task holds more than one Python worker.
    cut, aligned = _cut("w", "id"), _aligned(length, identity)
    return half.join(words.hint("merge"), "id").mapInArrow(lambda batches: aligned(cut(batches)), SCHEMA)


def cut_passages(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without their repeated passages; those of which no word remains go.  All columns and rows else stay.

    Of rows with one key only those of the text that stood for all (see ``passages``) are cut; the others stay whole, as do
    null keys and null, empty and unrepeated texts.  Extra columns may have any names.  An empty table gives no rows.
    """
    free = iter(f"_{n}" for n in range(10_000) if f"_{n}" not in docs.columns)
    of, name, stands, own_text = (next(free) for _ in range(4))
    spans = written(found.groupBy(F.col("doc_id").alias(of)).agg(F.array_sort(F.collect_set(F.struct("start_word", "end_word"))).alias(name)))
    few = (spans.agg(F.sum(F.size(name))).first()[0] or 0) <= 200_000
    twice = written(docs.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("id")).agg(F.count("*").alias("n")).where("n > 1").select("id"))
    hash_ = F.xxhash64(F.col(text).cast("string"))
    if twice.take(1):
        texts = of_ids(docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("t")).where("t is not null"), twice, "id")
        texts = texts.groupBy("id").agg(F.max(F.struct(F.length("t").alias("n"), "t")).alias("x")).select(F.col("id").alias(own_text), F.xxhash64("x.t").alias(stands))
        spans = written(spans.join(texts, F.col(of) == F.col(own_text), "left").drop(own_text))
    else:
        spans = spans.withColumn(stands, F.lit(None).cast("long"))
    match = (docs[key].cast("long") == spans[of]) & (spans[stands].isNull() | (spans[stands] == hash_))
    joined = docs.join(F.broadcast(spans) if few else spans, match, "left").drop(of, stands)
    at = joined.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.parts(batches):
            spans_ = batch.column(batch.num_columns - 1).to_pylist()
            new, keep = batch.column(at).to_pylist(), np.ones(len(batch), bool)
            for i, own in enumerate(spans_):
                if not own or new[i] is None:
                    continue
                data = new[i].encode()
                w = tk.Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), tk.ALNUM)
                gone = np.zeros(len(w), bool)
                for s in own:
                    gone[s["start_word"] : s["end_word"]] = True
                if gone.all():
                    keep[i] = False
                    continue
                parts, last = [], 0
                begin, end = np.flatnonzero(gone & ~np.r_[False, gone[:-1]]), np.flatnonzero(gone & ~np.r_[gone[1:], False])
                for a, b in zip(begin.tolist(), end.tolist(), strict=True):
                    parts.append(data[last : w.start[a]])
                    last = int(w.end[b])
                new[i] = b"".join([*parts, data[last:]]).decode("utf-8", "replace")
            columns = [pa.array(new, batch.schema.field(at).type) if k == at else batch.column(k) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1]).filter(pa.array(keep))

    return joined.mapInArrow(run, docs.schema)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
