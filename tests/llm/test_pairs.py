import re

import numpy as np
import pyarrow as pa
import pytest

from siftspark.llm import embedding_dedup, graph, jaccard_join, substring_dedup

RNG = np.random.RandomState(11)
VOCABULARY = [f"w{i}" for i in range(3000)]


def union(ids, links):
    up = {i: i for i in ids}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def edited(words, share):
    return [RNG.choice(VOCABULARY) if RNG.rand() < share else w for w in words]


@pytest.fixture(scope="module")
def texts():
    out, i = {}, 0
    passage = list(RNG.choice(VOCABULARY, 60))
    for n in (5, 30, 90, 300, 900):
        for _ in range(6):
            base = list(RNG.choice(VOCABULARY, n))
            for share in (0, 0, 0.01, 0.02, 0.03, 0.04):
                out[i] = " ".join(edited(base, share))
                i += 1
    for _ in range(25):  # documents that share one passage and little else
        out[i] = " ".join([*passage, *RNG.choice(VOCABULARY, 10)])
        i += 1
    base = list(RNG.choice(VOCABULARY, 120))
    for _ in range(120):  # a large group of near copies
        out[i] = " ".join(edited(base, 0.012))
        i += 1
    return out


def shingle_sets(texts, k):
    table = {i: i + 32 for i in range(65, 91)}
    out = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(table))
        out[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    return out


@pytest.mark.parametrize(("k", "top"), [(4, 85), (5, 80)])
def test_jaccard_components_are_those_of_all_pairs(spark, texts, k, top):
    sets = shingle_sets(texts, k)
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= top * len(sets[a] | sets[b])]
    want = union(ids, links)
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, n string").repartition(7)
    got = {r["doc_id"]: r for r in jaccard_join.join_groups(df, k=k, top=top).collect()}
    assert len(links) > 500 and {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}


def test_jaccard_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (6, "a b"), (6, "a b"), (None, "a b"), (7, "c d e f g"), (7, "a b")]
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"]) for r in jaccard_join.join_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert [x for x in got if x[0] in (1, 2, 3)] == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]
    assert [x for x in got if x[0] in (4, 5, 6)] == [(4, 1, 4), (5, 1, 4), (6, 1, 4), (6, 1, 4)]
    assert (-1, 1, None) in got and len(got) == len(rows)
    assert jaccard_join.join_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize(("k", "top"), [(4, 85), (5, 80)])
def test_jaccard_near_copies_inside_a_long_document(spark, k, top):
    rng, texts = np.random.RandomState(5), {}
    for i in range(0, 120, 3):
        words = [f"g{i}x{j}" for j in rng.permutation(130)]
        texts[i] = " ".join(words)  # of the smallest id, and too long to link with the two near copies of its beginning
        texts[i + 1] = " ".join(words[:40])
        texts[i + 2] = " ".join([*words[:39], "other"])
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.join_groups(df, k=k, top=top).collect()}
    assert got == {i: i - 1 if i % 3 == 2 else i for i in texts}


def test_tree_loses_no_pair():
    h = [np.unique(RNG.randint(0, 1 << 40, n).astype(np.uint64)) for n in RNG.randint(3, 80, 300)]
    h += [np.unique(np.concatenate([x[:-2], RNG.randint(0, 1 << 40, 2).astype(np.uint64)])) for x in h if len(x) > 25]
    points = np.stack([np.bincount((x % 16).astype(int), minlength=16) for x in h])
    sizes = np.array([len(x) for x in h])
    tree = jaccard_join.Tree(points, sizes, fanout=8)
    for i, x in enumerate(h):
        near = set(tree.search(points[i], sizes[i], 85, 100).tolist())
        assert {j for j, y in enumerate(h) if 100 * len(np.intersect1d(x, y)) >= 85 * len(np.union1d(x, y))} <= near


def test_points_never_fall_short():
    h = RNG.randint(0, 1 << 60, 5000).astype(np.uint64)
    data = jaccard_join.points_of(np.zeros(5000, int), h, np.array([5000]))[0]
    assert (jaccard_join.point(data, 64) == np.bincount((h % np.uint64(64)).astype(int), minlength=64)).all()
    same = jaccard_join.points_of(np.zeros(900, int), np.zeros(900, np.uint64), np.array([900]))[0]
    assert jaccard_join.point(same, 16)[0] >= 900


def test_components_of_chains_hubs_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 60)] + [(5, 5), (200, 201), (201, 200), (59, 100)]
    got = {r["id"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    ids = {x for a, b in links for x in (a, b) if a != b}
    assert got == {i: c for i, c in union(ids, [x for x in links if x[0] != x[1]]).items()}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_embeddings_equal_all_pairs(spark):
    rows, n = [], 0
    for label in (0, 1):
        for _ in range(40):
            centre = RNG.standard_normal(32)
            for _ in range(RNG.choice([1, 1, 2, 12])):
                rows.append((n, (centre + RNG.standard_normal(32) * RNG.choice([0, 0.05, 0.12, 0.25])).astype(np.float32), label))
                n += 1
    good = [(i, [float(x) for x in v], l) for i, v, l in rows]
    bad = [(n, None, 0), (n + 1, [0.0] * 32, 0), (n + 2, [float("nan")] + [1.0] * 31, 0), (n + 3, [None] + [1.0] * 31, 0), (n + 4, good[0][1], None), (n + 5, [float("inf")] * 32, 1), (n + 6, [1.0, 2.0], 0), (n + 7, [2.0, 4.0], 0), (None, good[0][1], 0), (n + 8, [], 0)]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<float>, label int")
    x = np.array([v for _, v, _ in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lab = np.array([l for *_, l in rows])
    near = (x @ x.T >= 0.93) & (lab[:, None] == lab) & ~np.eye(n, dtype=bool)
    want = union(range(n), zip(*np.nonzero(np.triu(near)), strict=True))
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df, window=16).collect()}
    found = sum(got[i]["n_links"] for i in range(n))
    assert found >= 0.97 * near.sum() and all(got[i]["n_links"] <= near[i].sum() for i in range(n))
    assert np.mean([got[i]["component_id"] == want[i] for i in range(n)]) > 0.97
    assert all(got[n + k]["n_links"] == 0 for k in (0, 1, 2, 3, 4, 5, 8)) and got[n + 6]["n_links"] == got[n + 7]["n_links"] == 1
    assert got[n + 7]["component_id"] == n + 6 and not got[n + 7]["kept"] and got[n + 6]["kept"] and not got[None]["kept"]
    assert len(got) == len(good) + len(bad) and embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_small_blocks_count_the_same(spark):
    centre = RNG.standard_normal(16)
    rows = [(i, [float(v) for v in centre + RNG.standard_normal(16) * 0.28], 1) for i in range(150)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.93) & ~np.eye(150, dtype=bool)
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(df, block=20, window=150).collect()}
    assert [got[i] for i in range(150)] == near.sum(axis=1).tolist()


def test_equal_vectors_count_each(spark):
    rng = np.random.RandomState(9)
    one = rng.standard_normal(24)
    other, far = one + rng.standard_normal(24) * 0.15, rng.standard_normal(24)
    rows = [(i, [float(v) for v in (one, one, one, other, other, far, far)[i]], 0, 5) for i in range(7)] + [(7, [float(v) for v in one], 1, 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, id int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_duplicates(df).collect()}
    assert got == {i: (4, 0, i == 0) for i in range(5)} | {5: (1, 5, True), 6: (1, 5, False), 7: (0, 7, True)}


@pytest.mark.parametrize("n", [2_000, 20_000])
def test_passes_find_the_pairs_near_the_threshold(spark, n):
    rng = np.random.RandomState(n)
    x = rng.standard_normal((n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    pairs = 400
    side = rng.standard_normal((pairs, 64))
    side -= (side * x[:pairs]).sum(axis=1, keepdims=True) * x[:pairs]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    x[pairs : 2 * pairs] = 0.935 * x[:pairs] + np.sqrt(1 - 0.935**2) * side
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>").selectExpr("*", "0 as label")
    got = {r["vec_id"]: r["component_id"] for r in embedding_dedup.near_duplicates(df).collect()}
    assert np.mean([got[pairs + i] == i for i in range(pairs)]) >= 0.98
    assert all(got[i] == i for i in range(2 * pairs, n))


@pytest.fixture(scope="module")
def planted():
    passages = [list(RNG.choice(VOCABULARY, n)) for n in (55, 80, 160)]
    docs, holders = {}, {}
    for i in range(60):
        docs[i] = list(RNG.choice(VOCABULARY, RNG.randint(20, 300)))
    for p, words in enumerate(passages):
        for share in (0, 0, 0, 0.03, 0.06):
            i = len(docs)
            at = RNG.randint(0, 50)
            own = list(RNG.choice(VOCABULARY, 120))
            docs[i] = own[:at] + edited(words, share) + own[at:]
            holders.setdefault(p, []).append((i, share, at))
    return {i: " ".join(w) for i, w in docs.items()}, holders


def test_planted_passages_are_found_and_nothing_else(spark, planted):
    docs, holders = planted
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    rows = substring_dedup.passages(df).collect()
    touched = {r["doc_id"] for r in rows} | {r["source_id"] for r in rows}
    assert touched <= {i for x in holders.values() for i, *_ in x}
    for cases in holders.values():
        exact = [i for i, share, _ in cases if share == 0]
        assert set(exact) <= touched
        assert all(i in touched for i, *_ in cases)
    for r in rows:
        a, b = docs[r["doc_id"]].split(), docs[r["source_id"]].split()
        assert r["source_id"] < r["doc_id"] and r["end_word"] - r["start_word"] >= 50 and r["identity"] >= 0.8
        if r["identity"] == 1:
            assert a[r["start_word"] : r["end_word"]] == b[r["source_start"] : r["source_end"]]
    cut = {r["doc_id"]: r["text"] for r in substring_dedup.cut_passages(df, substring_dedup.passages(df)).collect()}
    assert all(cut[i] == t for i, t in docs.items() if i not in {r["doc_id"] for r in rows})
    assert all(len(cut[r["doc_id"]].split()) < len(docs[r["doc_id"]].split()) for r in rows)


def test_whole_holder_is_found_between_holders_of_its_halves(spark):
    rng = np.random.RandomState(4)
    one, two = list(rng.choice(VOCABULARY, 30)), list(rng.choice(VOCABULARY, 30))
    rest = lambda: list(rng.choice(VOCABULARY, 40))
    docs = [one + rest(), two + rest(), one + two + rest(), rest() + one, rest() + two, one + two + rest()]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string")
    assert [(r["doc_id"], r["source_id"]) for r in substring_dedup.passages(df).collect()] == [(5, 2)]


@pytest.mark.parametrize("share", [0.1, 0.13, 0.17])
def test_fuzzy_copies_of_a_passage_all_find_an_earlier_holder(spark, share):
    rng = np.random.RandomState(3)
    docs, where = {}, {}
    for p in range(10):
        passage = rng.choice(VOCABULARY, 60)
        for _ in range(12):
            i, at = len(docs), rng.randint(0, 60)
            own = np.where(rng.rand(60) < share, rng.choice(VOCABULARY, 60), passage)
            rest = rng.choice(VOCABULARY, 80)
            docs[i], where[i] = [*rest[:at], *own, *rest[at:]], (p, at, own)
    # brute force: two copies hold a passage if some 50 words or more of the planted 60 agree in 80 %
    want = set()
    for i, (p, _, x) in where.items():
        for j in range(i):
            q, _, y = where[j]
            same = (x == y) if p == q else np.zeros(60, bool)
            if any(same[a:b].mean() >= 0.8 for a in range(11) for b in range(a + 50, 61)):
                want.add(i)
                break
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string").repartition(5)
    got = {r["doc_id"] for r in substring_dedup.passages(df).collect()}
    assert len(want) > 10 and len(got & want) >= 0.95 * len(want)


def test_substring_odd_rows(spark):
    long = " ".join(RNG.choice(VOCABULARY, 200))
    rows = [(1, long), (2, long), (2, long), (3, None), (4, ""), (None, long), (5, "word " * 3000), (6, "word " * 2000)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, id int")
    found = substring_dedup.passages(df)
    assert {(r["doc_id"], r["source_id"], r["start_word"], r["end_word"]) for r in found.collect() if r["doc_id"] < 5} == {(2, 1, 0, 200)}
    left = substring_dedup.cut_passages(df, found).collect()
    assert sorted(str(r["doc_id"]) for r in left if r["doc_id"] in (1, 2, 3, 4, None)) == ["1", "3", "4", "None"]
    assert substring_dedup.passages(df.limit(0)).count() == 0


def test_cut_passages_by_row_and_with_clashing_names(spark):
    rng = np.random.RandomState(6)
    long, other = " ".join(rng.choice(VOCABULARY, 200)), " ".join(rng.choice(VOCABULARY, 100))
    rows = [(1, long, 7), (2, long, 8), (2, other, 9), (3, other + " x " + long, 10)]
    df = spark.createDataFrame([(i, t, n, n, n) for i, t, n in rows], "doc_id long, text string, _id int, _spans int, _0 int")
    left = {r["_id"]: r["text"] for r in substring_dedup.cut_passages(df, substring_dedup.passages(df)).collect()}
    assert set(left) == {7, 9, 10} and left[7] == long and left[9] == other and left[10].split() == [*other.split(), "x"]


def test_hot_seeds_and_copies_of_whole_texts(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT", 4)
    rng = np.random.RandomState(2)
    passage = list(rng.choice(VOCABULARY, 70))
    docs = {i: [*rng.choice(VOCABULARY, 30), *passage, *rng.choice(VOCABULARY, 30)] for i in range(60)}
    docs |= {i: docs[i % 60] for i in range(60, 90)}
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string").repartition(2)
    rows = {(r["doc_id"], r["source_id"]): r for r in substring_dedup.passages(df).collect()}
    assert {(i, 0) for i in range(1, 60)} <= set(rows) and {(i, i % 60) for i in range(60, 90)} <= set(rows)
    assert all(r["start_word"] <= 30 and r["end_word"] >= 100 for r in rows.values())


@pytest.fixture(scope="module")
def frequent_sentences():
    """Documents of five sentences of a pool each, so that every seed is frequent, and edited copies of some of them."""
    rng = np.random.RandomState(11)
    pool = [list(rng.choice(VOCABULARY, 12)) for _ in range(40)]
    made = [[w for k in rng.choice(40, 5, replace=False) for w in pool[k]] for _ in range(400)]
    want = {}
    for share in (0.0, 0.06, 0.12, 0.17):
        for i in rng.choice(range(40, 400), 20, replace=False).tolist():
            x = np.array(made[i])
            y = np.where(rng.rand(60) < share, rng.choice(VOCABULARY, 60), x)
            same = x == y
            if any(same[a:b].mean() >= 0.8 for a in range(11) for b in range(a + 50, 61)):
                want[len(made)] = share
            made.append(y.tolist())
    return [(i, " ".join(["x%d" % i, *w, "y%d" % i])) for i, w in enumerate(made)], want


def test_edited_passages_of_frequent_sentences_are_found(spark, frequent_sentences):
    docs, want = frequent_sentences
    got = {r["doc_id"] for r in substring_dedup.passages(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert min(sum(v == share for v in want.values()) for share in (0.0, 0.06, 0.12)) > 10
    assert len(got & want.keys()) >= 0.95 * len(want)


def test_which_seeds_are_known_as_hot_changes_no_row(spark, frequent_sentences, monkeypatch):
    df = spark.createDataFrame(frequent_sentences[0], "doc_id long, text string").repartition(2)
    rows = []
    for hot in (40, 10**9):
        monkeypatch.setattr(substring_dedup, "HOT", hot)
        rows.append(sorted(tuple(r) for r in substring_dedup.passages(df).collect()))
    assert rows[0] == rows[1]


def frequent_places(n):
    """Places of one seed in ``n`` texts whose words around it are unrelated, but for some edited copies."""
    rng = np.random.RandomState(5)
    lined = rng.randint(1, 1 << 16, (n, 2 * substring_dedup.REACH)).astype(np.uint16)
    for i in range(n // 10, n, n // 10):
        at, size = substring_dedup.REACH - rng.randint(46), 50 + rng.randint(40)
        some = at + np.sort(rng.choice(size, size - int(0.2 * size), replace=False))
        lined[i, some] = lined[i - 1 - rng.randint(5), some]
    lined[:, substring_dedup.REACH : substring_dedup.REACH + substring_dedup.K] = [1, 2, 3, 4]
    texts = [row.tobytes() for row in lined]
    return pa.table({"id": range(n), "pos": [substring_dedup.REACH] * n, "at": [0] * n, "as_target": [True] * n, "as_source": [True] * n, "w": texts}), lined


def test_places_of_one_seed_meet_few_others_and_lose_none(monkeypatch):
    """Unrelated places aren't compared, so that the work doesn't grow with the square of the places."""
    rows, lined = frequent_places(1500)
    want = set()
    for i in range(1, 1500):
        same = lined[:i] == lined[i]
        for j in np.flatnonzero(same.sum(axis=1) >= 40).tolist():
            if substring_dedup.align(lined[i], lined[j], np.array([[150], [154], [0]])):
                want.add(i)
    compared, alike = [], substring_dedup._alike
    monkeypatch.setattr(substring_dedup, "_alike", lambda lined, ts, *rest: compared.append(len(ts)) or alike(lined, ts, *rest))
    found = substring_dedup._earlier(substring_dedup._Places(rows), substring_dedup.LENGTH, substring_dedup.IDENTITY)
    assert len(want) >= 8 and {f[0] for f in found} == want and sum(compared) < 1500


def test_large_groups_of_places_are_dealt_out_without_loss(spark, frequent_sentences, monkeypatch):
    docs, want = frequent_sentences
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    got = []
    for places in (16, 10**6):
        monkeypatch.setattr(substring_dedup, "PLACES", places)
        got.append({r["doc_id"] for r in substring_dedup.passages(df).collect()})
    assert got[0] == got[1] and len(got[0] & want.keys()) >= 0.95 * len(want)


def test_chain_is_the_best_of_all_orders():
    for _ in range(60):
        n = RNG.randint(1, 7)
        start = np.sort(RNG.randint(0, 60, n))
        end, diagonal = start + RNG.randint(5, 15, n), RNG.randint(-20, 20, n)
        score = 10.0 * RNG.randint(1, 4, n)
        got = substring_dedup.chain(start, end, diagonal, score)
        assert sorted(i for path in got for i in path) == list(range(n))

        def value(path):
            total = score[path[0]]
            for i, j in zip(path[:-1], path[1:], strict=True):
                if start[j] < end[i] or start[j] + diagonal[j] < end[i] + diagonal[i]:
                    return -1.0
                total += score[j] - 0.1 * (start[j] - end[i] + start[j] + diagonal[j] - end[i] - diagonal[i])
            return total

        def best(path):
            more = [best([*path, j]) for j in range(n) if j not in path and value([*path, j]) >= 0]
            return max([value(path), *more])

        assert np.isclose(max(value(p) for p in got), max(best([i]) for i in range(n)))


@pytest.mark.parametrize(("base", "size"), [(0.0, 2000), (0.5, 6000), (0.8, 3000)])
def test_recall_on_vectors_that_share_a_direction(spark, base, size):
    """Lone pairs at cosine 0.935 among vectors of one label whose unrelated cosine is ``base``, beside a label that shares nothing."""
    rng, d, k = np.random.RandomState(5), 64, 300
    m = rng.randn(d)
    m /= np.linalg.norm(m)

    def apart(n):
        r = rng.randn(n, d)
        r -= (r @ m)[:, None] * m
        return r / np.linalg.norm(r, axis=1, keepdims=True)

    x = np.sqrt(base) * m + np.sqrt(1 - base) * apart(size)
    u, y = apart(k), x[:k]
    u -= np.einsum("ij,ij->i", u, y)[:, None] * y
    z = 0.935 * y + np.sqrt(1 - 0.935**2) * u / np.linalg.norm(u, axis=1, keepdims=True)
    v = np.concatenate([x, z])
    rows = [(i, r.tolist(), "a") for i, r in enumerate(v)] + [(len(v) + i, r.tolist(), "b") for i, r in enumerate(rng.randn(50, d))]
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()}
    want = sum(int((v @ v[i] >= 0.93).sum()) - 1 for i in [*range(k), *range(size, size + k)])
    assert sum(got[i] for i in [*range(k), *range(size, size + k)]) >= 0.99 * want
    assert len(got) == len(rows)
