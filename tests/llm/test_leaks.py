import corpus_pipeline
import numpy as np
import pytest

from siftspark.llm import decontamination
from siftspark.llm import textkit as tk


@pytest.mark.parametrize("of", ["op4", "pipeline"])
def test_the_latent_space_is_that_of_all_passages(spark, tmp_path, monkeypatch, of):
    rng = np.random.RandomState(4)
    rare = [f"w{i}" for i in range(40)]
    texts = [" ".join(rare[rng.randint(1 + d % 40)] if rng.rand() < 0.02 else f"c{rng.randint(3000)}" for _ in range(rng.randint(0, 120))) for d in range(900)]
    items = decontamination.Items.of([(i, " ".join(rare[8 * i : 8 * i + 8])) for i in range(5)])
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "doc_id long, text string").repartition(3)
    fit, made = decontamination.fit, []
    monkeypatch.setattr(decontamination, "fit", lambda rows, own: made.append(fit(rows, own, rank=30)) or made[-1])  # so wide that the products alone decide
    bench = spark.createDataFrame([(i, " ".join(rare[8 * i : 8 * i + 8])) for i in range(5)], "item_id long, text string")
    if of == "op4":
        decontamination.contaminated(docs, bench)
    else:
        bench.write.parquet(str(tmp_path / "benchmark.parquet"))
        corpus_pipeline.without_benchmark(spark, docs, str(tmp_path))
    space = made[0]
    place = {int(h): k for k, h in enumerate(items.vocabulary)}
    word = {w: place[int(tk.word_hash([w])[0])] for w in rare}

    def vector(words):
        n = np.zeros(len(space.idf))
        for x in words:
            if x in word:
                n[word[x]] += 1
        v = np.where(n > 0, 1 + np.log(np.maximum(n, 1)), 0) * space.idf
        return v / max(np.linalg.norm(v), 1e-12)

    split = [t.split() for t in texts]
    passages = np.array([v for t in split for a in range(0, len(t), decontamination.BLOCK) if (v := vector(t[a : a + 4 * decontamination.BLOCK])).any()])
    own = np.array([vector(rare[8 * i : 8 * i + 8]) for i in range(5)])
    assert 1000 < len(passages) < 20_000
    _, want = np.linalg.eigh(passages.T @ passages + own.T @ own)
    assert np.linalg.svd(want[:, ::-1][:, :6].T @ space.basis[:, :6], compute_uv=False).min() > 1 - 1e-4


def test_products_of_terms_do_not_depend_on_how_many_are_held(spark, monkeypatch):
    rng = np.random.RandomState(6)
    words = [f"w{i}" for i in range(30)]
    texts = [rng.choice(words, n).tolist() for n in (0, 5, 300, 12, 13, 48, 49)]
    data = [" ".join(t).encode() for t in texts]
    w = tk.Words(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]).astype(np.int64), tk.ALNUM)
    ids = tk.HashIndex(tk.word_hash(words)).find(w.hash)
    idf = np.where(np.arange(30) % 3, 1.0 + np.arange(30) / 30, 0.0)

    def dense():
        out, n = np.zeros(900), 0
        for pair, value, passages in decontamination.passage_products(w, ids, idf):
            out[pair] += value
            n += passages
        return out, n

    want, n = dense()
    monkeypatch.setattr(decontamination, "PRODUCTS", 7)
    got, m = dense()
    held = sum(any(int(x[1:]) % 3 for x in t[a : a + 48]) for t in texts for a in range(0, len(t), 12))
    assert n == m == held and np.allclose(got, want) and np.isclose(want[np.arange(30) * 31].sum(), n)


def test_items_outside_the_latent_space_are_found_word_by_word_and_changed(spark, monkeypatch):
    rng = np.random.RandomState(8)
    words = [f"w{i}" for i in range(4000)]
    items = {i: list(rng.choice(words, 40)) for i in range(60)}
    docs, want = {}, set()
    for d in range(240):
        text = list(rng.choice(words, 150))
        if d % 2:
            item, share = d // 2 % 60, (0, 0.1)[d // 120]
            leak = [str(rng.choice(words)) if rng.rand() < share else x for x in items[item]]
            at = rng.randint(0, 100)
            text[at:at] = leak
            rare = 0.7 * 40 <= sum(x == y for x, y in zip(leak, items[item], strict=True))
            want |= {(d, item)} if rare else set()
        docs[d] = " ".join(text)
    fit = decontamination.fit

    def misplaced(rows, of):
        space = fit(rows, of)
        space.items[:20] *= -1  # as of items that the basis doesn't span
        return space

    monkeypatch.setattr(decontamination, "fit", misplaced)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["cosine"] for r in decontamination.contaminated(df, bench).collect()}
    brute = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(df, bench, cosine=-2.0).collect()}
    assert set(found) == brute and len(brute & want) >= 0.9 * len(want)
    assert set(found) <= want and min(found.values()) < decontamination.COSINE
