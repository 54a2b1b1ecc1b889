"""Operators 11 to 13: alignment, dominance counts, personal data."""

import collections
import datetime
import hashlib
import itertools
import os
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from compare import duck_rows, spark_rows
from conftest import DATA

from siftspark.llm import alignment, dominance, pii

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "x", "a  b\n\n c\td\r\n e", "<|endoftext|> <s></s> <unk> <0x41>", "no▁break", "日本語 \U0001f600 é ﬁ", "nbsp  x  y \u0085 z\x1c w", "zero​ width﻿ ᠎ end", "}\r\n  );\r x", "\x00 nul",
    "same text twice", "same text twice", "x" * 5000, " " * 5000, "1234567890 " * 300, "don't we'll -- it's\n", "\n", "tab\t", "end ",
]


def brute_alignment(docs):
    """Each document's row, over whole texts and with every link written out."""
    pair = alignment.Pair(*PATHS)
    held, count, most = [], collections.Counter(), {}
    for key, text in docs:
        full = " " + (text or "")
        a, b = pair.a.encode(full, add_special_tokens=False).ids, pair.b.encode(text or "")
        parts = [[pair.bytes_a[i] for i in a], [pair.bytes_b[i] for i in b]]
        if not text or any(b"".join(p) != full.encode() for p in parts):
            held.append((key, 0, 0, 0, [], ""))
            continue
        ends = [list(itertools.accumulate(map(len, p))) for p in parts]
        groups = []
        for stop in sorted(set(ends[0]) & set(ends[1])):
            groups.append([[i for i, e in zip(ids, own, strict=True) if begin < e <= stop] for ids, own in zip((a, b), ends, strict=True) for begin in [groups_end(groups, ends)]])
        links = [x for p, q in groups for x in itertools.product(p, q)]
        count.update(set(links))
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        held.append((key, len(a), len(b), len(groups), links, hashlib.sha256(text.encode()).hexdigest()))
    for (p, _), n in count.items():
        most[p] = max(n, most.get(p, 0))
    return [(k, n, m, g, len(x), sum(count[y] == most[y[0]] for y in x), sum(count[y] for y in x), h) for k, n, m, g, x, h in held]


def groups_end(groups, ends):
    """Where the groups so far end."""
    return ends[0][sum(len(p) for p, _ in groups) - 1] if groups else 0


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_alignment_equals_brute_force_on_odd_texts(spark):
    docs = [(i if i % 7 else None, t) for i, t in enumerate(ODD)] + [(3, "x"), (3, "x")]
    df = spark.createDataFrame([(k, t, 1, "u") for k, t in docs], "doc_id long, text string, block int, pair string")
    for size in (alignment.BLOCK_BYTES, 300):
        assert rows_of(alignment.align(df.repartition(3), *PATHS, block_bytes=size)) == sorted(brute_alignment(docs), key=repr)
    assert alignment.align(df.limit(0), *PATHS).count() == 0


def test_alignment_query_equals_brute_force(spark):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect() if len(r[1] or "") < 3000]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows_of(alignment.align(df, *PATHS)) == sorted(brute_alignment(docs), key=repr)
    whole = alignment.op11_alignment(spark, DATA)
    assert whole.count() == spark.read.parquet(f"{DATA}/documents.parquet").count()


def test_alignment_blocks_are_row_groups_of_their_own(spark, monkeypatch):
    import pyarrow.parquet as pq

    groups, plain = [], alignment.written

    def watched(df, *a, **b):
        out = plain(df, *a, **b)
        if "pair" in out.columns and "docs" in out.columns:
            files = [f for f in os.listdir(out._written_at.removeprefix("file:")) if f.endswith(".parquet")]
            groups.extend(pq.ParquetFile(f"{out._written_at.removeprefix('file:')}/{f}").metadata for f in files)
        return out

    monkeypatch.setattr(alignment, "written", watched)
    df = spark.createDataFrame([(i, f"word {i} and more words " * 20) for i in range(40)], "doc_id long, text string").coalesce(1)
    assert alignment.align(df, *PATHS, block_bytes=1000).count() == 40
    # the reader decodes all rows of a group that stand in its batch of thousands: a row is a block of megabytes
    assert sum(m.num_rows for m in groups) > 10 and all(m.row_group(i).num_rows == 1 for m in groups for i in range(m.num_row_groups))


def test_alignment_block_does_not_depend_on_what_is_held(monkeypatch):
    pair = alignment.Pair(*PATHS)
    texts = [t or "" for t in ODD] * 2 + [f"some words of text {i} {i % 3}" for i in range(50)]
    want = alignment._block(alignment._Memory(pair), 5, list(range(len(texts))), texts)
    monkeypatch.setattr(alignment, "HELD_CHARS", 100)
    monkeypatch.setattr(alignment, "REMEMBERED", 20)
    memory = alignment._Memory(pair)
    got = alignment._block(memory, 5, list(range(len(texts))), texts)
    assert len(memory.texts) < 200 and got.keys() == want.keys() and all(np.array_equal(got[k], want[k]) for k in want)


def test_stretches_tokenise_as_the_whole():
    pair, rng = alignment.Pair(*PATHS), np.random.RandomState(3)
    assert pair.cuts
    alphabet = [*"ab.,'(9é日", " ", " ", "  ", "\n", "\n\n", "\t", "\r", " ", " ", "\x85", "\x1c", "​", "▁", "}", ");", "don't", "\U0001f600"]
    for _ in range(400):
        text = "".join(rng.choice(alphabet, rng.randint(1, 40)))
        parts = pair.stretches(text)
        assert "".join(parts) == " " + text
        sides = list(zip(*(pair.encoded(p) for p in parts), strict=True))
        assert [i for a in sides[0] for i in a] == pair.a.encode(" " + text, add_special_tokens=False).ids
        assert [i for b in sides[1] for i in b] == pair.b.encode(text)


def test_alignment_of_a_very_long_text(spark):
    texts = [(1, " " * 1_000_000 + "x"), (2, "\n" * 300_000), (3, "ab" * 300_000), (4, "word " * 200_000)]
    got = alignment.align(spark.createDataFrame(texts, "doc_id long, text string"), *PATHS).toPandas().set_index("doc_id")
    assert (got["n_groups"] > 0).all() and (got["n_links"] >= got["n_groups"]).all()


def test_dominance_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW sales AS SELECT * FROM '{DATA}/sales.parquet'")
    want = duck_rows(con, dominance.ORACLE)
    assert spark_rows(dominance.op12_dominance(spark, DATA)) == want
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
    try:
        assert spark_rows(dominance.op12_dominance(spark, DATA)) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("levels", [3, 100, 10_000, 10_000_000])
def test_dominators_equal_brute_force(spark, levels):
    rng = np.random.RandomState(levels % 97)
    points = {(int(rng.randint(-50, 500)), int(rng.randint(-levels, levels))): (int(rng.randint(1, 5)), int(rng.randint(1, 9))) for _ in range(600)}
    df = spark.createDataFrame([(*k, *v) for k, v in points.items()], "slot long, level long, n long, w long")
    got = {(r["slot"], r["level"]): (r["n"], r["w"]) for r in dominance.dominators(df).collect()}
    for (s, v), sums in got.items():
        above = [x for (s2, v2), x in points.items() if s2 <= s and v2 > v]
        assert sums == (sum(x[0] for x in above), sum(x[1] for x in above))
    assert got.keys() == points.keys()


def test_dominance_of_odd_rows(spark):
    day = datetime.datetime(2024, 1, 1)
    rows = [
        (1, 10.0, day), (1, 10.0, day), (2, 25.0, day), (3, None, day), (4, 50.0, None), (None, 99.0, day - datetime.timedelta(days=30_000)), (6, float("nan"), day), (7, float("inf"), day), (8, -5.0, day), (9, 9.995, day), (10, 1e30, day),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "sale_id long, total double, sold_at timestamp_ntz, node string, level int")

    def weight(key):
        return 1 + (zlib.crc32(str(key).encode()) % 3 if key is not None else 0)

    def place(r):
        level = None if r[1] is None or r[1] != r[1] or r[1] == float("inf") else min(int(np.floor(np.floor(100 * r[1] + 0.5) / 1000)), 9223372036854776)  # longs end there
        return (r[2] - datetime.datetime(1970, 1, 1)).days if r[2] else None, level

    want = []
    for r in rows:
        s, v = place(r)
        above = [o for o in rows if None not in (s, v, *place(o)) and place(o)[0] <= s and place(o)[1] > v]
        want.append((r[0], s, v, *((len(above), sum(weight(o[0]) for o in above)) if s is not None and v is not None else (None, None))))
    assert rows_of(dominance.sales_above(df)) == sorted(want, key=repr)
    assert dominance.sales_above(df.limit(0)).count() == 0
    assert dominance.sales_above(df.where("total is null")).count() == 1


NAIVE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(re.sub("[ -]", "", m[0])) <= 19 and pii.luhn(re.sub("[ -]", "", m[0]))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= sum(c.isdigit() for c in m[0]) <= 15),
]


def naive_spans(text):
    return [(k, *m.span()) for k, (_, pattern, good) in enumerate(NAIVE) for m in re.finditer(pattern, text) if good(m)]


def test_base_spans_equal_the_patterns():
    rng = np.random.RandomState(8)
    alphabet = [*"ab.@-_+%() 0129", "a.b@c.d", "@@", "255.1.2.3", "256.", "4111 1111 1111 1111", "4111111111111111", "+1 (234) 555-6789", "é", "٣"]
    for _ in range(3000):
        text = "".join(rng.choice(alphabet, rng.randint(0, 30)))
        assert pii.base_spans(text) == naive_spans(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 2_000_000, "1" * 2_000_000, "1." * 500_000, "@" * 500_000, "a@" * 300_000, "+1" * 500_000, "1 " * 500_000, "a.b@c" * 200_000):
        pii.base_spans(text)


@pytest.fixture(scope="module")
def field(spark):
    return pii.fit(pii.labelled(spark))


def test_viterbi_equals_exhaustive_search(field):
    chain_texts = ["token = 9a8b7c6d5e 12 x1", "call (123) 555-4766 now", "+1%%% (123)*** 555-4766###", "a1@b.c 1.2.3.4 77 88"]
    for text in chain_texts:
        for chain, labels in zip(pii.islands(text), field.decode(pii.islands(text)), strict=True):
            scores, _ = field.emissions([chain])

            def total(path, scores=scores):
                steps = sum(field.steps[a, b] for a, b in zip((0, *path), (*path, 0), strict=True))
                return steps + sum(scores[t, p] for t, p in enumerate(path))

            best = max(itertools.product(range(len(pii.LABELS)), repeat=len(chain)), key=total)
            assert abs(total(best) - total(labels)) < 1e-9


def test_field_on_held_out_rows(spark, field):
    hit = wrong = missed = 0
    for row in pii.labelled(spark, 400, 99).collect():
        want = {(s["kind"], s["start"], s["end"]) for s in row["spans"]}
        chains = pii.islands(row["text"])
        got = {(pii.KINDS[k], s, e) for c, labels in zip(chains, field.decode(chains), strict=True) for k, s, e in pii._spans_of(c, labels)}
        hit, wrong, missed = hit + len(want & got), wrong + len(got - want), missed + len(want - got)
    assert hit / (hit + wrong) > 0.97 and hit / (hit + missed) > 0.97


def test_gradient_of_the_likelihood():
    rng = np.random.RandomState(1)
    k, scores = 3, rng.randn(4, 3, 3)
    steps, mask = rng.randn(k, k), np.array([[1, 1, 1], [1, 1, 1], [1, 1, 0], [1, 0, 0]], bool)
    norm, chance, pairs = pii._chances(scores, steps, mask)
    seen, sums = np.zeros_like(chance), np.zeros((k, k))
    for i in range(4):
        size = int(mask[i].sum())
        paths = list(itertools.product(range(k), repeat=size))
        value = np.array([steps[0, p[0]] + sum(scores[i, t, x] for t, x in enumerate(p)) + sum(steps[a, b] for a, b in itertools.pairwise(p)) + steps[p[-1], 0] for p in paths])
        assert abs(np.log(np.exp(value).sum()) - norm[i]) < 1e-9
        for p, c in zip(paths, np.exp(value - norm[i]), strict=True):
            for t, x in enumerate(p):
                seen[i, t, x] += c
            for a, b in itertools.pairwise(p):
                sums[a, b] += c
    assert np.allclose(seen, chance) and np.allclose(sums, pairs)


def test_pii_query_equals_a_plain_loop(spark, field):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in pii.op13_pii(spark, DATA).collect()}
    assert len(got) == len(docs)
    for key, text in docs:
        base = naive_spans(text or "")
        digest = hashlib.sha256(",".join(f"{NAIVE[k][0]}:{s}:{e}" for k, s, e in base).encode()).hexdigest()
        r = got[key]
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == tuple(sum(x[0] == k for x in base) for k in range(4)) and r["base_sha256"] == digest
        spans = {tuple(x.split(":")) for x in r["spans"].split(",") if x}
        assert {(NAIVE[k][0], str(s), str(e)) for k, s, e in base} <= spans


def test_pii_of_odd_rows(spark, field):
    rows = [
        (1, None), (2, ""), (None, "mail a1@b.test"), (3, 'the token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" is'), (3, "x\U0001f600 +1 (234) 555-6789"), (4, "call +1%%% (234)*** 555-6789###"), (5, "commit 04dbebab91ab85687d33eeaaf9ac699e1188f962"),
        (6, "1 " * 60_000), (7, "on 2024-01-02 at 10:45, 9807915762804491 pieces of 3.5"), (8, "4111111111111111 4111111111111111"),
    ]
    df = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, spans int")
    got = sorted(((r["doc_id"], r["spans"]) for r in pii.find(df, field).collect()), key=repr)
    token = 'token = "'
    want = [
        (1, ""), (2, ""), (None, "email:5:14"), (3, f"secret:{4 + len(token)}:{44 + len(token)}"), (3, "phone:3:20"), (4, "phone:5:28"), (5, ""), (6, ""), (7, ""), (8, "card:0:16,card:17:33"),
    ]
    assert got == sorted(want, key=repr)
    assert pii.find(df.limit(0), field).count() == 0
    assert pii.fit(pii.labelled(spark).limit(0)).decode(pii.islands("a1 b2")) == [[0, 0]]
