import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from siftspark.llm import textkit as tk

texts = st.lists(st.one_of(st.none(), st.text(alphabet="aAbB é\n\t.Ñ1", max_size=30)), max_size=6)


@settings(deadline=None)
@given(texts)
def test_words_are_those_of_the_pattern(values):
    table = {i: i + 32 for i in range(65, 91)}
    for i, j, buf, off in tk.slices(pa.array(values, pa.string()), 16):
        w = tk.Words(buf, off)
        for d in range(j - i):
            want = re.findall(r"[^\x20\x09-\x0D]+", (values[i + d] or "").translate(table))
            assert w.hash[w.first[d] : w.first[d + 1]].tolist() == tk.word_hash(want).tolist()


@settings(deadline=None)
@given(texts)
def test_every_row_is_in_one_slice(values):
    seen = [k for i, j, _, _ in tk.slices(pa.array(values, pa.string()), 8) for k in range(i, j)]
    assert seen == list(range(len(values)))


def test_shingles_of_short_and_long_texts():
    _, _, buf, off = next(tk.slices(pa.array(["a b", "a b c d e", "", "a b c d"])))
    doc, h, at = tk.shingles(tk.Words(buf, off), 4)
    assert doc.tolist() == [0, 1, 1, 3] and at.tolist() == [0, 2, 3, 7]
    assert h[1] == h[3] and len(set(h.tolist())) == 3


def test_index_finds_only_what_is_there():
    keys = np.random.RandomState(1).randint(0, 1 << 62, 5000).astype(np.uint64)
    index = tk.HashIndex(keys)
    assert (index.find(keys[::-1].copy()) == np.arange(5000)[::-1]).all()
    assert (index.find(keys + np.uint64(1)) == -1).all()
    assert (tk.HashIndex(np.zeros(0, np.uint64)).find(keys) == -1).all()


def test_long_words_of_two_letters_differ():
    for n in (512, 1024, 2048, 4096):
        bits = [bin(i).count("1") % 2 for i in range(n)]  # Thue-Morse, on which sums of powers modulo 2^64 vanish
        one, two = ("".join("ab"[x ^ y] for x in bits) for y in (0, 1))
        assert len(set(tk.word_hash([one, two]).tolist())) == 2


@settings(deadline=None)
@given(st.text(alphabet="abB é", min_size=1, max_size=12), st.integers(1, 8))
def test_prefixes_are_those_of_the_bytes(word, size):
    data = word.encode()
    w = tk.Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), np.ones(256, bool))
    other = data[:size] + b"~~"
    v = tk.Words(np.frombuffer(other, np.uint8), np.array([0, len(other)]), np.ones(256, bool))
    assert (w.prefix(size)[0] == v.prefix(size)[0] if len(data) > size else w.prefix(size)[0] == 0)
