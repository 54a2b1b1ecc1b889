import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from siftspark.llm import language, licenses, quality, toxicity
from siftspark.llm import queries as Q

ODD = [(1, None), (2, ""), (2, ""), (None, "word"), (3, " \n\t "), (4, "x" * 200_000), (5, "a " * 50_000)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in ODD], "doc_id long, text string, _k string, score int")


@pytest.fixture(scope="module")
def toy(spark):
    rng = np.random.RandomState(3)
    words = {"en": ["the", "house", "with", "river", "thing"], "de": ["der", "häuser", "mit", "flüsse", "dinge"]}
    rows = []
    for i in range(300):
        lang = ["en", "de"][i % 2]
        text = " ".join(rng.choice(words[lang], 60))
        toxic, good = int(i % 5 == 0), int(i % 3 > 0)
        text = text + " vileword vileish" * (2 * toxic) if toxic else text
        rows.append((i, text if good else " ".join(f"#{w}%%" for w in text.split()), lang, good, toxic))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int, toxic int")
    return df.select("doc_id", "text", "lang").cache(), df.select("doc_id", "quality", "toxic").cache()


def split(df):
    held = df.where(F.crc32(F.col("doc_id").cast("string")) % 4 == 2)
    return held.collect()


def test_toxicity_finds_held_out_cases(spark, toy, odd):
    docs, labels = toy
    model = toxicity.fit(docs, labels, where=lambda k: F.crc32(F.col(k).cast("string")) % 4 != 2)
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    got = split(toxicity.score(docs, model))
    assert len(got) > 40 and all(r["predicted"] == truth[r["doc_id"]] for r in got)
    assert all(len(r["passages"]) > 0 for r in got if truth[r["doc_id"]])
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 and r["predicted"] == 0 for r in rows)
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(not v for v in truth.values())
    assert toxicity.score(odd.limit(0), model).count() == 0


def test_toxicity_without_labels_keeps_all(spark, toy):
    docs, labels = toy
    model = toxicity.fit(docs, labels.where("toxic > 1"))
    assert toxicity.score(docs, model).where("predicted = 1").count() == 0


def test_segments_are_those_of_brute_force():
    rng = np.random.RandomState(0)

    def brute(w):  # all segments whose every proper prefix and suffix is positive, and that no such segment holds
        n, good = len(w), []
        for i in range(n):
            for j in range(i + 1, n + 1):
                p = np.cumsum(w[i:j])
                if (p > 0).all() and (p[-1] - np.concatenate([[0], p[:-1]]) > 0).all():
                    good.append((i, j))
        return sorted(x for x in good if not any(y != x and y[0] <= x[0] and x[1] <= y[1] for y in good))

    for _ in range(200):
        w = rng.choice([-3.1, -1.7, -0.9, 0.8, 1.3, 2.2], rng.randint(1, 14))
        assert [(s, e) for s, e, _ in toxicity.segments(w)] == brute(w)


def test_quality_learns_and_scores_all_rows(spark, toy, odd):
    docs, labels = toy
    trees = quality.fit(docs, labels, where=lambda k: F.crc32(F.col(k).cast("string")) % 4 != 2)
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in split(quality.score(docs, trees))]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in quality.score(odd, trees).collect())
    none = quality.fit(docs, labels.where("quality > 1"))
    assert quality.score(docs, none).select("score").distinct().count() == 1


def test_flattened_trees_walk_like_one_row_at_a_time():
    rng = np.random.RandomState(1)
    x = rng.rand(400, 5).astype(np.float32)
    t = quality.boost(x, (x[:, 0] + x[:, 1] > 1).astype(float), trees=10, depth=3)

    def walk(row):
        total = t.base
        for node in t.roots:
            while t.feature[node] >= 0:
                node = t.left[node] + int(row[t.feature[node]] > t.threshold[node])
            total += t.value[node]
        return total

    assert np.allclose(t.raw(x), [walk(r) for r in x])


def test_language_of_held_out_texts(spark, toy, odd):
    docs, _ = toy
    model = language.fit(docs, where=lambda k: F.crc32(F.col(k).cast("string")) % 5 != 0)
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = language.score(docs, model).collect()
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in got]) > 0.99
    rows = {(r["doc_id"], r["lang_pred"]) for r in language.score(odd, model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und")} <= rows
    assert language.score(docs.limit(2), language.fit(docs.limit(0))).select("lang_pred").distinct().collect()[0][0] == "und"


def test_code_lengths_are_those_of_a_plain_model():
    order = 2
    sample = b" abab abc"
    window = np.array([int.from_bytes((b"  " + sample)[i : i + 3], "big") for i in range(1, len(sample))], np.uint64)
    keys, n = np.unique(window, return_counts=True)
    model = language.grow(["x"], np.zeros(len(keys), int), keys, n.astype(float), order)

    def bits(context, symbol):  # method C over contexts of falling length
        cost = 0.0
        for k in range(order, -1, -1):
            c = context[len(context) - k :]
            seen = {}
            for w in window.tolist():
                b = w.to_bytes(3, "big")
                if b[order - k : order] == c:
                    seen[b[order]] = seen.get(b[order], 0) + 1
            if symbol in seen:
                return cost - np.log2(seen[symbol] / (sum(seen.values()) + len(seen)))
            if seen:
                cost -= np.log2(len(seen) / (sum(seen.values()) + len(seen)))
        return cost + model.unseen

    text = b"abcaz ab"
    padded = b"   " + text
    want = sum(bits(padded[i - order : i], padded[i]) for i in range(3, len(padded)))
    b, off = language.folded(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    doc, w, _ = language.windows(b, off, order)
    assert np.isclose(language.Coder(model).lengths(doc, w, 1)[0, 0], want, atol=1e-3)


def test_license_base_phrases_are_those_of_a_plain_scan(spark, odd):
    import re

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    more = [(-1, "The MIT  License; mit-license mit license MITLICENSE"), (-2, "apache\nlicense GNU general public licenses gnu general public license cc by by cc by"), (-3, "permission is hereby granted free of charge to any person obtaining a copy of this software")]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string")).unionByName(odd.select("doc_id", "text"))
    rows = docs.collect()
    table = {i: i + 32 for i in range(65, 91)}
    want = []
    for r in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r["text"] or "").translate(table))
        places = [(i, label) for phrase, label in licenses.BASE for k in [len(phrase.split())] for i in range(len(w) - k + 1) if w[i : i + k] == phrase.split()]
        at = [i for i, _ in places]
        want.append((r["doc_id"], len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))))
    got = licenses.scan(docs).collect()
    key = lambda x: tuple(str(v) for v in x)
    assert sorted([(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got], key=key) == sorted(want, key=key)
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(","))) and 0 <= r["score"] <= 1 for r in got)
    assert next(r["labels"] for r in got if r["doc_id"] == -3) == "mit-notice"


@pytest.mark.parametrize("name", ["op1_quality", "op7_toxicity", "op9_language", "op10_licenses"])
def test_query_gives_every_document_once(spark, name):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = Q.QUERIES[name](spark, DATA)
    assert got.count() == docs.count() and got.select("doc_id").exceptAll(docs.select("doc_id")).count() == 0
