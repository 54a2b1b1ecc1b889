import zlib

import duckdb
import numpy as np
import pytest
from compare import duck_rows, spark_rows
from conftest import DATA

from siftspark.llm import decontamination, packing, url_filters

RNG = np.random.RandomState(5)
WORDS = [f"term{i}" for i in range(4000)]


def test_packing_is_a_round_trip(spark):
    from tokenizers import Tokenizer

    odd = [(1, None), (2, ""), (2, ""), (None, "x y"), (3, "<|endoftext|> and <|endoftext|>"), (4, "a\x1cb\u3000 c\x85d  \n\n e"), (5, "long words here " * 4000)]
    docs = spark.createDataFrame(odd, "doc_id long, text string").unionByName(spark.read.parquet(f"{DATA}/documents.parquet").selectExpr("doc_id + 100 as doc_id", "text"))
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    want = []
    for r in docs.collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        want.append((str(r["doc_id"]), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got = packing.pack(docs, packing.tokenizer_path()).toPandas()
    for _, own in got.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own["offset"].iloc[0] == 0 and (own["offset"].to_numpy()[1:] == (own["offset"] + own["length"]).to_numpy()[:-1]).all() and own["length"].sum() <= 1024
    whole = got[got["doc_id"] != 2].fillna(-1).groupby("doc_id")
    lengths = {("None" if k == -1 else str(int(k))): int(g["length"].sum()) for k, g in whole}
    assert lengths == {k: n for k, n, _ in want if k != "2"} and (got["doc_id"] == 2).sum() == 2
    single = got[(got["piece"] == 0) & (got["length"] < 1024)]
    assert {zlib_ for k, n, zlib_ in want if n < 1024} == set(single[~single["doc_id"].isin(got[got["piece"] > 0]["doc_id"])]["ids_crc32"])
    assert (got[got["piece"] > 0]["length"] == 1024).all()
    assert got["sequence_id"].nunique() <= 1.05 * got["length"].sum() / 1024 + 8


@pytest.mark.parametrize("unit", [" ", "\n", "x", "7", "-", "é"])
def test_packing_of_a_very_long_run(spark, unit):
    from tokenizers import Tokenizer

    text = unit * 1_000_000 + "x"
    docs = spark.createDataFrame([(1, text), (2, "some words")], "doc_id long, text string")
    ids = Tokenizer.from_file(packing.tokenizer_path()).encode(text, add_special_tokens=False).ids
    got = packing.pack(docs.withColumnRenamed("text", "piece").withColumnRenamed("doc_id", "length"), packing.tokenizer_path(), key="length", text="piece").toPandas()
    assert int(got[got["doc_id"] == 1]["length"].sum()) == len(ids) + 1
    assert packing.pack(docs.limit(0), packing.tokenizer_path()).count() == 0


def test_the_fast_encoder_is_refused_where_the_file_differs():
    import json

    from tokenizers import Tokenizer

    file = json.loads(Tokenizer.from_file(packing.tokenizer_path()).to_str())
    assert packing.ranked(Tokenizer.from_str(json.dumps(file))) is not None
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": file["pre_tokenizer"] | {"add_prefix_space": True}}, {"pre_tokenizer": file["pre_tokenizer"] | {"use_regex": False}}, {"pre_tokenizer": None}):
        assert packing.ranked(Tokenizer.from_str(json.dumps(file | change))) is None


def test_best_fit_takes_the_least_space_that_holds():
    bins = packing.BestFit(10, 3)
    assert [bins.place(n) for n in (7, 6, 3, 4, 10, 5)] == [(0, 0), (1, 0), (0, 7), (1, 6), (2, 0), (3, 0)]
    limited = packing.BestFit(10, 2)
    for n in (9, 8, 7):  # the fullest closes
        limited.place(n)
    assert limited.place(1) == (1, 8)


def test_url_filters_equal_sql(spark, duck):
    names, rows = spark_rows(url_filters.op8_url_filters(spark, DATA))
    assert (names, rows) == duck_rows(duck, url_filters.ORACLE)


def test_url_filters_of_odd_rows(spark):
    rows = [
        (1, None), (2, "no scheme"), (3, "http://COM/en/x"), (4, "http://a.b.example.com/en/77?x"), (5, "http://example.com/en/6"), (6, "http://notcom/en/"), (7, "http://com?/en/"),
        (8, "x://org/es/#"), (8, "x://org/es/#"), (None, "http://net/de/"), (9, "http://a.example.net/de/81"), (10, "://org/es/a://b"), (11, "http://" + "a." * 5000 + "org/es/" + "p" * 50_000),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string")
    df.createOrReplaceTempView("odd")
    con = duckdb.connect()
    con.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", rows)
    assert spark_rows(url_filters.filter_urls(df)) == duck_rows(con, url_filters.ORACLE)
    assert url_filters.filter_urls(df.limit(0)).count() == 0


def test_url_filters_hold_the_contracts_rules(spark):
    contract = {"com/en/": "block", "example.com/en/7": "allow", "net/de/": "allow", "example.net/de/8": "block", "org/es/": "block"}
    assert {host + path: action for action, host, path in url_filters.RULES} == contract
    df = spark.createDataFrame(list(enumerate(f"http://www.{rule}x" for rule in contract)), "page_id long, url string")
    assert {r["rule"]: r["verdict"] for r in url_filters.filter_urls(df).collect()} == contract


@pytest.fixture(scope="module")
def leaks():
    items = {i: list(RNG.choice(WORDS, n)) for i, n in enumerate([15, 20, 30, 45, 60, 120])}
    docs, truth = {}, set()
    for i in range(150):
        docs[i] = list(RNG.choice(WORDS, RNG.randint(10, 400)))
    for k, words in items.items():
        for share in (0, 0.1, 0.2):
            i = len(docs)
            own = list(RNG.choice(WORDS, 150))
            at = RNG.randint(0, 100)
            docs[i] = own[:at] + [RNG.choice(WORDS) if RNG.rand() < share else w for w in words] + own[at:]
            truth.add((i, k, share))
    return {i: " ".join(w) for i, w in docs.items()}, {k: " ".join(w) for k, w in items.items()}, truth


def test_leaks_are_found_and_clean_documents_left(spark, leaks):
    docs, items, truth = leaks
    df = spark.createDataFrame([*docs.items(), (None, items[3]), (900, None), (901, "")], "doc_id long, text string")
    bench = spark.createDataFrame([*items.items(), (50, None), (51, ""), (None, "x")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(df, bench).collect()}
    assert {(i, k) for i, k, share in truth if share == 0} <= got
    assert len({(i, k) for i, k, _ in truth} - got) <= 3
    assert got <= {(i, k) for i, k, _ in truth} | {(None, 3)} and (None, 3) in got
    assert decontamination.contaminated(df.limit(0), bench).count() == 0
    assert decontamination.contaminated(df, bench.limit(0)).count() == 0


@pytest.mark.parametrize("share", [0.1, 0.2, 0.25])
def test_changed_items_are_found(spark, share):
    rng = np.random.RandomState(17)
    items = {k: list(rng.choice(WORDS, rng.randint(15, 80))) for k in range(60)}
    docs = {}
    for k, words in items.items():
        changed = rng.permutation(len(words))[: int(share * len(words))]
        leak = [str(rng.choice(WORDS)) if i in changed else w for i, w in enumerate(words)]
        own, at = list(rng.choice(WORDS, 150)), rng.randint(0, 100)
        docs[k] = own[:at] + leak + own[at:]
    docs |= {i: list(rng.choice(WORDS, 200)) for i in range(60, 160)}
    df = spark.createDataFrame([(i, " ".join(w), 1, "x") for i, w in docs.items()], "doc_id long, text string, item_id int, _t string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(df, bench).collect()}
    assert got <= {(k, k) for k in items} and len(got) >= 0.9 * len(items)


def test_common_subsequences():
    def plain(a, b):
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1, j + 1] = best[i, j] + 1 if x == y else max(best[i, j + 1], best[i + 1, j])
        return best[-1, -1]

    for _ in range(50):
        a, b = (RNG.randint(0, 6, RNG.randint(1, 30)).astype(np.uint64) for _ in range(2))
        assert decontamination.lcs_length(a, b) == plain(a, b) == decontamination.lcs_weight(a, b, np.ones(len(a)))
