"""Many fixed strings at once in whole texts: an Aho-Corasick automaton in flat arrays, walked over many lanes of bytes together.

The automaton is built once per rule set; states times byte classes bound its size, and a rule set that would exceed it becomes
several automata, each of which reads the texts.  A task lays its texts' bytes into lanes of equal length that overlap by the longest pattern, and
takes one step of all lanes at a time, so a byte costs a few array operations and no Python call.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cells (states times byte classes) of an automaton at most: 4 bytes each go to every task.
CELLS = 4 << 20
#: Bytes of a lane without its overlap, at least; bytes of text laid out at once, about.
LANE, TOGETHER = 1024, 8 << 20
#: Patterns that a rule set may have; they are read by the driver, so a larger table is refused and not cut.
RULES = 1_000_000


class Automaton:
    """``step[state * classes + class]`` is the next state; ``out`` lists, for each state from ``first[state]`` to ``first[state + 1]``, the patterns that end there."""

    def __init__(self, patterns: list[bytes]):
        self.longest = max(map(len, patterns), default=0)
        used = sorted({b for p in patterns for b in p})
        self.of_byte = np.zeros(256, np.int64)  # class 0: bytes of no pattern
        self.of_byte[used] = np.arange(1, len(used) + 1)
        self.classes = len(used) + 1
        children: list[dict[int, int]] = [{}]
        ends: list[list[int]] = [[]]
        for i, p in enumerate(patterns):
            at = 0
            for b in p:
                c = int(self.of_byte[b])
                if c not in children[at]:
                    children[at][c] = len(children)
                    children.append({})
                    ends.append([])
                at = children[at][c]
            ends[at].append(i)
        step = np.zeros((len(children), self.classes), np.int32)
        fail, queue = [0] * len(children), deque([0])
        while queue:
            at = queue.popleft()
            step[at] = step[fail[at]] if at else 0
            for c, child in children[at].items():
                fail[child] = int(step[at, c]) if at else 0
                step[at, c] = child
                queue.append(child)
                ends[child] = ends[child] + ends[fail[child]]
        self.step = step.reshape(-1)
        self.first = np.concatenate([[0], np.cumsum([len(x) for x in ends])])
        self.out = np.array([i for own in ends for i in own], np.int64)

    def hits(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(end of the match in the data, pattern) of every match that doesn't cross a start of a text."""
        n, keep = len(data), max(self.longest - 1, 0)
        if not n or not self.longest:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lane = max(LANE, 4 * keep, n // 65_536 + 1)
        begin = np.arange(0, n, lane)
        fresh = np.zeros(n, bool)
        fresh[starts[starts < n]] = True
        classes = self.of_byte[data]
        state = np.zeros(len(begin), np.int64)
        ends, states = [], []
        for t in range(-keep, lane):
            at = begin + t
            here = (at >= 0) & (at < n)
            at = np.where(here, at, 0)
            state = np.where(fresh[at] | ~here, 0, state)
            state = np.where(here, self.step[state * self.classes + classes[at]], 0)
            if t >= 0:
                found = np.flatnonzero(self.first[state + 1] > self.first[state])
                if len(found):
                    ends.append(at[found] + 1)
                    states.append(state[found])
        if not ends:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        end, state = np.concatenate(ends), np.concatenate(states)
        count = self.first[state + 1] - self.first[state]
        run = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(end, count), self.out[np.repeat(self.first[state], count) + run]


def automata(patterns: list[bytes], cells: int = CELLS) -> list[tuple[Automaton, list[int]]]:
    """Automata that hold all patterns between them, each within the bound unless one pattern alone exceeds it."""
    out, own, size = [], [], 1
    order = sorted(range(len(patterns)), key=patterns.__getitem__)  # neighbours share their beginnings
    for i in order:
        if own and (size + len(patterns[i])) * 256 > cells:
            out.append((Automaton([patterns[k] for k in own]), own))
            own, size = [], 1
        own.append(i)
        size += len(patterns[i])
    return [*out, (Automaton([patterns[k] for k in own]), own)] if own else out


def search(texts: DataFrame, patterns: DataFrame, key: str, text: str, rule: str, pattern: str, cells: int = CELLS) -> DataFrame:
    """(key, rule, hits, first) of every text that holds a rule's pattern: how often, overlaps included, and the byte where the first begins.

    Case counts.  Null and empty patterns match nothing, equal patterns of several rules match for each; null texts hold
    nothing.  ``key`` may be of any type and needn't be unique: repeated rows give repeated results.  No patterns, or no texts, give no rows.
    """
    rows = patterns.where(F.coalesce(F.length(pattern), F.lit(0)) > 0).select(F.col(rule).cast("string").alias("r"), F.col(pattern).cast("string").alias("p")).distinct().limit(RULES + 1).collect()
    if len(rows) > RULES:
        raise ValueError(f"more than {RULES} patterns")
    names = [r["r"] for r in rows]
    built = automata([r["p"].encode() for r in rows], cells)
    kind = dict(texts.dtypes)[key]
    length = np.array([len(r["p"].encode()) for r in rows], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = pc.fill_null(batch.column(1), "").cast(pa.large_string())
            size = pc.binary_length(held).to_numpy(zero_copy_only=False)
            cut = np.concatenate([[0], np.flatnonzero(np.diff(np.cumsum(size) // TOGETHER)) + 1, [len(held)]])
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                part = held.slice(a, b - a)
                _, offsets, data = part.buffers()
                offsets = np.frombuffer(offsets, np.int64)[part.offset : part.offset + len(part) + 1]
                data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
                starts = offsets[:-1] - offsets[0]
                for automaton, own in built:
                    end, found = automaton.hits(data, starts)
                    if not len(end):
                        continue
                    found = np.array(own, np.int64)[found]
                    owner = np.searchsorted(starts, end - 1, "right") - 1
                    table = pd.DataFrame({"owner": owner, "rule": found, "first": end - length[found] - starts[owner]}).groupby(["owner", "rule"])["first"].agg(["size", "min"]).reset_index()
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(table["owner"] + a)), pa.array([names[i] for i in table["rule"]], pa.string()), pa.array(table["size"], pa.int64()), pa.array(table["min"], pa.int64())],
                        names=["key", "rule", "hits", "first"],
                    )

    if not built:
        return texts.select(F.col(key).alias("key"), F.lit("").alias("rule"), F.lit(0).cast("long").alias("hits"), F.lit(0).cast("long").alias("first")).limit(0)
    return texts.select(F.col(key), F.col(text).cast("string")).mapInArrow(run, f"key {kind}, rule string, hits long, first long")
