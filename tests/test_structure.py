"""Crawls, chains, numbering, names, nested values, schemas and pattern searches against plain versions."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftspark.operators import crawl, merkle, names, numbering, patterns, redirects, walk
from siftspark.validate import schema

RAW, PAGE = "raw.example.test", "git.example.test"
PARSERS = {"**/*.json": "tvbox_json", "**/*.m3u": "m3u", "*.txt": "txt_live"}


def raw(path, repository="o/s", revision="abc"):
    return f"https://{RAW}/{repository}/{revision}/{path}"


def crawled(spark, cases):
    """One crawl of (source, files, roots, max_depth, max_files) of each case, in a repository of its own."""
    sources = spark.createDataFrame([(s, f"o/{s}", "abc", d, n) for s, _, _, d, n in cases], "source_id string, repository string, revision string, max_depth int, max_files int")
    tree = spark.createDataFrame([(f"o/{s}", "abc", p, c) for s, files, *_ in cases for p, c in files.items()], "repository string, revision string, path string, content string")
    start = spark.createDataFrame([(s, p) for s, _, roots, *_ in cases for p in roots], "source_id string, path string")
    return crawl.crawl(sources, start, tree, crawl.configurations(PARSERS, RAW, PAGE, f"https://{RAW}"))


def outcomes(result):
    return {r["source_id"]: (r["files_scanned"], r["technical_status"], r["inconclusive"], r["failure_reason"]) for r in result.outcomes.collect()}


def depot(*targets):
    return json.dumps({"urls": [{"name": f"n{i}", "url": t} for i, t in enumerate(targets)]})


def chain(source):
    return {f"f{i}.json": depot(raw(f"f{i + 1}.json", f"o/{source}"), f"https://h{i}.example.test/") for i in range(5)} | {"f5.json": "{}"}


def test_crawl_of_configurations_limits_and_failures(spark):
    files = {
        "a.json": depot(raw("sub/b.json"), f"https://{PAGE}/o/s/blob/abc/c.json", raw("x.json", "o/other"), raw("pic.png"), raw("a.json")),
        "sub/b.json": depot("../a.json", "list.m3u"), "c.json": json.dumps({"sites": [{"key": "k", "name": "n", "type": 1, "api": "https://v.example.test/api"}], "lives": [{"name": "l", "type": 0, "url": "https://l.example.test/x.m3u"}]}),
        "sub/list.m3u": "#EXTM3U\n#EXTINF:-1,One\nhttps://t.example.test/1.m3u8\n", "never.json": "{}",
    }
    loop = {"a.json": depot(raw("b.json", "o/loop")), "b.json": depot(raw("a.json", "o/loop"), raw("b.json", "o/loop"))}
    lost = {"a.json": depot(raw("gone.json", "o/lost"), "https://h.example.test/")}
    got = crawled(spark, [
        ("s", files, ["a.json", "a.json"], 3, 50), ("empty", {}, [], 3, 5), ("deep", chain("deep"), ["f0.json"], 3, 50), ("whole", chain("whole"), ["f0.json"], 5, 50), ("over", chain("over"), ["f0.json"], 5, 3),
        ("flood", chain("flood"), [f"f{i}.json" for i in range(4)], 3, 3), ("lost", lost, ["a.json"], 3, 50), ("loop", loop, ["a.json"], 5, 50),
    ])
    assert outcomes(got) == {
        "s": (4, "healthy", False, None), "empty": (0, "healthy", False, None), "deep": (4, "partial", False, "catalog_depth_exceeded"), "whole": (6, "healthy", False, None), "over": (4, "unknown", True, "catalog_limit_exceeded"),
        "flood": (0, "unknown", True, "catalog_limit_exceeded"), "lost": (2, "dead", False, "http_404"), "loop": (2, "healthy", False, None),
    }
    read = {(r["source_id"], r["path"], r["depth"]) for r in got.files.where("source_id in ('s', 'over', 'flood')").collect()}
    assert read == {("s", "a.json", 0), ("s", "sub/b.json", 1), ("s", "c.json", 1), ("s", "sub/list.m3u", 2), ("over", "f0.json", 0), ("over", "f1.json", 1), ("over", "f2.json", 2)}
    found = {(r["source_id"], r["kind"], r["target"]) for r in got.candidates().collect()}
    assert {("s", "vod_site", "https://v.example.test/api"), ("s", "live_url", "https://t.example.test/1.m3u8"), ("s", "nested_config", raw("x.json", "o/other")), ("s", "nested_config", raw("a.json"))} <= found
    assert {t for s, _, t in found if s == "over"} >= {f"https://h{i}.example.test/" for i in range(3)} and not {s for s, _, _ in found} & {"lost", "flood", "empty"}


def test_prefix_sums_equal_a_loop(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([None, 1, 2, 7]), rng.choice("aab")) for i in range(500)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id int, size int, _lane string").repartition(5)
    got = {r["id"]: (r["used"], r["fits"], r["_lane"]) for r in numbering.within_budget(df, [F.desc("_lane"), F.asc("id")], F.col("size"), 700).collect()}
    total, want = 0, {}
    for i, size, lane in sorted(rows, key=lambda r: (-ord(r[2]), r[0])):
        total += size or 0
        want[i] = (total, total <= 700, lane)
    assert got == want
    assert [r["n"] for r in numbering.numbered(df, [F.asc("id")], "n", 0).orderBy("id").collect()] == list(range(500))
    assert numbering.numbered(df.limit(0), [F.asc("id")], "n").count() == 0


def test_running_sums_send_no_rows_to_one_task(spark):
    df = spark.range(1000).withColumn("v", F.lit(1))
    plan = numbering.prefix_sums(df, [F.asc("id")], {"s": F.col("v")})._jdf.queryExecution().executedPlan().toString()
    single = [line for line in plan.splitlines() if "Exchange SinglePartition" in line]
    assert len(single) <= 1  # that of the ranges' sums


@pytest.mark.parametrize("seed", range(3))
def test_first_free_names(spark, seed):
    rng = random.Random(seed)
    bases = [rng.choice(["a", "a", "a", "a_2", "a_4", "a_2_2", "b_02", "b", "B", "x_1", None]) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(bases)), "id int, base string")
    reserved = spark.createDataFrame([("b",), ("a_5",)], "base string")
    got = {r["id"]: r["key"] for r in names.first_free(df, "base", ["id"], "key", reserved=reserved).collect()}
    taken, want, count = {b for b in bases if b} | {"b", "a_5"}, {}, {}
    for i, b in enumerate(bases):
        if b is None:
            want[i] = None
            continue
        if b not in count:
            count[b] = 1
            if b not in ("b", "a_5"):
                want[i] = b
                continue
        n = count[b] + 1
        while f"{b}_{n}" in taken:
            n += 1
        count[b], want[i] = n, f"{b}_{n}"
    assert got == want
    shown = [v for v in got.values() if v is not None]
    assert len(shown) == len(set(shown)) and not {"b", "a_5"} & set(shown)


def test_names_by_a_ladder_of_wishes(spark):
    rows = [("s1", "News"), ("s1", "News"), ("s2", "News"), ("s2", "Main"), ("s3", "Sport"), ("s3", "News [s1]")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, source string, name string")
    wishes = [F.col("name"), F.concat("name", F.lit(" ["), "source", F.lit("]"))]
    got = [r["line"] for r in names.ladder(df, wishes, ["id"], "line", reserved=["Main"]).orderBy("id").collect()]
    assert got == ["News", "News [s1] #2", "News [s2]", "Main [s2]", "Sport", "News [s1]"]


def test_redirect_chains(spark):
    hop = {"a": "b", "b": "c", "c": "d", "d": "e", "e": "f", "f": "g", "g": "h", "l": "m", "m": "l", "s": "s", "x": "bad", "bad": "y", "q": "x"}
    table = spark.createDataFrame([*hop.items(), ("b", "zz"), ("n", None)], "url string, location string")
    starts = spark.createDataFrame([(u,) for u in [*hop, "none", None, "a"]], "url string")
    got = {(r["url"], r["final_url"], r["hops"], r["reason"]) for r in redirects.resolved(starts, table, F.col("_to") != "bad").collect()}
    want = {
        ("a", None, 6, "redirect_limit"), ("b", None, 6, "redirect_limit"), ("c", "h", 5, None), ("d", "h", 4, None), ("e", "h", 3, None), ("f", "h", 2, None), ("g", "h", 1, None), ("l", None, 2, "redirect_loop"), ("m", None, 2, "redirect_loop"),
        ("s", None, 1, "redirect_loop"), ("x", None, 1, "redirect_refused"), ("bad", "y", 1, None), ("q", None, 2, "redirect_refused"), ("none", "none", 0, None), (None, None, 0, None),
    }
    assert got == want
    rows = spark.createDataFrame([("https://a.example.test/", "http://a.example.test/"), ("https://b.example.test/", "https://a.example.test/"), ("http://c.example.test/", "https://c.example.test/")], "url string, location string")
    got = {r["url"]: (r["final_url"], r["reason"]) for r in redirects.resolved(rows.select("url"), rows).collect()}
    assert got == {"https://a.example.test/": (None, "redirect_refused"), "https://b.example.test/": (None, "redirect_refused"), "http://c.example.test/": ("https://c.example.test/", None)}


def test_redirect_branches(spark):
    hop = [("a", "b"), ("a", "c"), ("b", "d"), ("c", "c2"), ("c2", "c3"), ("p", "q"), ("p", "bad"), ("q", "r"), ("s", "t"), ("s", "s"), ("t", "u"), ("l0", "l1"), ("l0", "x"), ("n", None), ("v", "w"), ("v", "w2"), ("v", "w")]
    hop += [(f"l{i}", f"l{i + 1}") for i in range(1, 8)]
    starts = spark.createDataFrame([(u,) for u in ["a", "a", "p", "s", "l0", "l3", "n", "v", "none", None]], "url string")
    got = [(r["url"], r["final_url"], r["hops"], r["reason"]) for r in redirects.branches(starts, spark.createDataFrame(hop, "url string, location string"), F.col("_to") != "bad").collect()]
    assert sorted(got, key=repr) == sorted([
        ("a", "c3", 3, None), ("a", "c3", 3, None), ("p", None, 2, "redirect_refused"), ("s", None, 2, "redirect_loop"), ("l0", None, 6, "redirect_limit"), ("l3", "l8", 5, None), ("n", "n", 0, None), ("v", "w2", 1, None),
        ("none", "none", 0, None), (None, None, 0, None),
    ], key=repr)


def test_redirect_query_equals_sql_where_addresses_repeat(spark, tmp_path):
    import duckdb

    from siftspark.plans import catalogue

    rows = [(i, f"http://h{i % 60}.example.{'net/de' if i % 60 == 7 else 'org/en'}/{'x' * (i % 60 % 4)}") for i in range(64)]
    spark.createDataFrame(rows, "page_id long, url string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    columns = ["page_id", "hops", "reason", "final_url"]
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({catalogue.ORACLES['redirect_chains']})").fetchall()
    assert sorted(map(tuple, catalogue.QUERIES["redirect_chains"](spark, str(tmp_path)).select(columns).collect())) == sorted(want)


def test_walk_of_nested_values(spark):
    deep = {"a/b": [{"x~y": {"z": [1, [None, True, "t"]]}}], "title": 'a "jar": thing.js?', "spider": ""}
    rows = [(1, json.dumps(deep)), (2, "7"), (3, None), (4, json.dumps({"list": [{"JAR": "x"}, {"u": "https://h.example.test/p.js?q=1"}]}))]
    df = spark.createDataFrame(rows, "id int, t string").withColumn("v", F.parse_json("t"))
    got = {(r["id"], r["path"]): (r["kind"], r["scalar"]) for r in walk.walk(df, ["id"], "v").collect()}
    assert got[1, "/a~1b/0/x~0y/z/1/1"] == ("boolean", "true") and got[1, "/a~1b/0/x~0y/z/1/0"] == ("null", None) and got[1, "/a~1b/0/x~0y/z/0"] == ("number", "1")
    assert got[2, ""] == ("number", "7") and not any(k[0] == 3 for k in got) and len(got) == 1 + 3 + 1 + 1 + 1 + 2 + 3 + 1 + 1 + 1 + 2 + 2
    flagged = walk.executable_parts(df, ["id"], "v", ["jar", "spider"], r"(?i)\.(jar|js|py|dex|so)($|[?#])").collect()
    assert {(r["id"], r["path"], r["rule"]) for r in flagged if r["id"] == 4} == {(4, "/list/0/JAR", "key"), (4, "/list/1/u", "reference")}
    shallow = walk.walk(df.where("id = 1"), ["id"], "v", 2).where("kind = 'too_deep'").collect()
    assert [r["path"] for r in shallow] == ["/a~1b/0"]


def test_schemas(spark):
    own = {
        "type": "object", "required": ["version", "entries"], "additionalProperties": False,
        "properties": {"version": {"const": 1}, "entries": {"type": "array", "uniqueItems": True, "maxItems": 3, "items": {"$ref": "#/$defs/entry"}}, "free": {"oneOf": [{"type": "string"}, {"type": "integer"}, {"minimum": 5}]}},
        "$defs": {"entry": {"type": "object", "required": ["id"], "properties": {"id": {"type": "string", "pattern": "^[a-z]+$"}, "at": {"type": ["string", "null"], "format": "date"}, "hosts": {"type": "array"}, "urls": {"type": "array"}},
                            "anyOf": [{"properties": {"hosts": {"minItems": 1}}, "required": ["hosts"]}, {"properties": {"urls": {"minItems": 1}}, "required": ["urls"]}], "not": {"required": ["bad"]}}},
    }
    good = {"id": "a", "at": "2024-01-31", "hosts": ["h"]}
    cases = [
        ({"version": 1, "entries": [good]}, set()), ({"version": 1.0, "entries": [], "free": 3}, set()), ({"version": True, "entries": []}, {("/version", "const")}), ({"version": 1, "entries": [], "more": 1}, {("/more", "additionalProperties")}),
        ({"version": 1}, {("/entries", "required")}), ([], {("", "type")}), ({"version": 1, "entries": [good, good]}, {("/entries", "uniqueItems")}), ({"version": 1, "entries": [good | {"id": "A1"}]}, {("/entries/0/id", "pattern")}),
        ({"version": 1, "entries": [good | {"at": "2024-13-01"}]}, {("/entries/0/at", "format")}), ({"version": 1, "entries": [{"id": "a", "hosts": [], "at": None}]}, {("/entries/0", "anyOf")}), ({"version": 1, "entries": [good | {"bad": 1}]}, {("/entries/0", "not")}),
        ({"version": 1, "entries": [], "free": 7}, {("/free", "oneOf")}), ({"version": 1, "entries": ["x", 5]}, {("/entries/0", "type"), ("/entries/1", "type"), ("/entries/0", "anyOf"), ("/entries/1", "anyOf")}), (None, {("", "type")}),
    ]
    df = spark.createDataFrame([(i, json.dumps(c)) for i, (c, _) in enumerate(cases)], "i int, t string").select("i", schema.violations(F.parse_json("t"), own).alias("v"))
    got = {r["i"]: {(x["path"], x["rule"]) for x in r["v"]} for r in df.collect()}
    for i, (value, want) in enumerate(cases):
        if i == 12:  # a scalar has no keys to ask for: JSON Schema leaves anyOf of properties to objects, `required` too
            want = {("/entries/0", "type"), ("/entries/1", "type")}
        assert got[i] - {("/entries/0", "not"), ("/entries/1", "not")} == want - {("/entries/0", "not")}, value
    with pytest.raises(ValueError, match="aren't supported"):
        schema.violations(F.lit(None), {"dependentRequired": {}})
    with pytest.raises(ValueError, match="inside each other"):
        schema.violations(F.lit(None), {"$defs": {"a": {"items": {"$ref": "#/$defs/a"}}}, "$ref": "#/$defs/a"})


def test_patterns_equal_brute_force(spark):
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abé ") for _ in range(n))
    rules = [(f"r{i}", word(rng.randint(1, 6))) for i in range(60)] + [("long", "ab" * 700), ("none", ""), ("null", None)]
    texts = [(i % 40, word(rng.randint(0, 4000))) for i in range(50)] + [(90, None), (91, "x" + "ab" * 1500), (92, "")]
    docs = spark.createDataFrame([(*t, "k") for t in texts], "id int, body string, rule string").repartition(3)
    table = spark.createDataFrame(rules, "rule string, pattern string")
    for cells in (patterns.CELLS, 4000):  # one automaton, and many
        got = sorted(map(tuple, patterns.search(docs, table, "id", "body", "rule", "pattern", cells).collect()))
        want = []
        for i, t in texts:
            for r, p in rules:
                places = [k for k in range(len(t or "") - len(p or "") + 1) if p and t and t.startswith(p, k)]
                if places:
                    want.append((i, r, len(places), len(t[: places[0]].encode())))
        assert got == sorted(want)
    assert patterns.search(docs, table.limit(0), "id", "body", "rule", "pattern").count() == 0


def test_automaton_finds_overlaps_and_suffixes():
    built = patterns.Automaton([b"he", b"she", b"hers", b"e"])
    end, which = built.hits(np.frombuffer(b"ushershe", np.uint8), np.array([0, 6]))
    assert sorted(zip(end.tolist(), which.tolist(), strict=True)) == [(4, 0), (4, 1), (4, 3), (6, 2), (8, 0), (8, 3)]


def test_merkle_tree_equals_brute_force_and_finds_changes(spark):
    import hashlib

    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    files = {f"d/{i}": sha(str(i)) for i in range(300)}
    df = lambda f: spark.createDataFrame([*f.items(), (None, "x"), ("y", None)], "path string, sha256 string")
    level = {}
    for p, s in files.items():
        level.setdefault(sha(p)[:2], []).append(f"{p}\0{s}")
    level = {k: (sha("\n".join(sorted(v))), len(v)) for k, v in level.items()}
    want = {(2, k, *v) for k, v in level.items()}
    for n in (1, 0):
        up = {}
        for k, v in level.items():
            up.setdefault(k[:n], []).append((f"{k}:{v[0]}", v[1]))
        level = {k: (sha("\n".join(sorted(x for x, _ in v))), sum(c for _, c in v)) for k, v in up.items()}
        want |= {(n, k, *v) for k, v in level.items()}
    assert {tuple(r) for r in merkle.tree(df(files), 2).collect()} == want
    other = {p: s for p, s in files.items() if p != "d/7"} | {"d/9": "z", "new": "n"}
    one, two = merkle.tree(df(files), 2), merkle.tree(df(other), 2)
    leaves = merkle.changed_leaves(one, two, 2)
    assert {r["prefix"] for r in leaves.collect()} == {sha(p)[:2] for p in ("d/7", "d/9", "new")}
    assert {tuple(r) for r in merkle.changed_files(df(files), df(other), leaves, 2).collect()} == {("d/7", "removed"), ("d/9", "changed"), ("new", "added")}
    assert merkle.changed_leaves(one, one, 2).count() == 0 and merkle.tree(df({}), 2).count() == 0
    assert [merkle.depth_for(n) for n in (0, 512, 513, 512 * 16, 512 * 16 + 1)] == [1, 1, 1, 1, 2]


def test_bodies_within_bounds(spark):
    import gzip
    import zlib

    from siftspark.functions import decode

    text = b"some text " * 1000
    raw = zlib.compressobj(wbits=-15)
    raw = raw.compress(text) + raw.flush()
    bomb = gzip.compress(b"\0" * 50_000_000)
    cases = [
        (text, None, text, None), (text, " ", text, None), (text, "Identity", text, None), (gzip.compress(text), "gzip", text, None), (gzip.compress(text) + gzip.compress(b"more"), "GZIP", text + b"more", None), (zlib.compress(text), "deflate", text, None),
        (raw, "deflate", text, None), (gzip.compress(text)[:-9], "gzip", None, "truncated_body"), (zlib.compress(text)[:-20], "deflate", None, "truncated_body"), (b"no gzip", "gzip", None, "invalid_encoding"), (b"", "gzip", None, "truncated_body"), (text, "br", None, "unsupported_encoding"),
        (bomb, "gzip", None, "response_too_large"), (b"x" * 20_001, None, None, "response_too_large"), (b"x" * 200_000, "gzip", None, "response_too_large"), (None, "gzip", None, None), (b"", None, b"", None),
    ]
    df = spark.createDataFrame([(i, bytearray(b) if b is not None else None, e) for i, (b, e, _, _) in enumerate(cases)], "i int, b binary, e string")
    got = {r["i"]: (bytes(r["d"]["body"]) if r["d"]["body"] is not None else None, r["d"]["reason"]) for r in df.select("i", decode.decoded(F.col("b"), F.col("e"), 100_000, 20_000).alias("d")).collect()}
    assert got == {i: (want, why) for i, (_, _, want, why) in enumerate(cases)}
    assert decode.inflated(gzip.compress(b""), "gzip", 10) == (b"", None)


def test_bodies_that_end_early_are_truncated_whatever_their_size():
    import gzip
    import zlib

    from siftspark.functions import decode

    text = np.random.RandomState(1).bytes(200_000)
    raw = zlib.compressobj(wbits=-15)
    raw = raw.compress(text) + raw.flush()
    for body, encoding in ((gzip.compress(text), "gzip"), (zlib.compress(text), "deflate"), (raw, "deflate")):
        assert decode.inflated(body[:-9], encoding, 20_000) == (None, "truncated_body")
        assert decode.inflated(body, encoding, 20_000) == (None, "response_too_large")
        assert decode.inflated(body, encoding, 200_000) == (text, None)


def test_schemas_work_out_each_node_once(spark):
    from conftest import DATA

    from siftspark.plans import structure_queries

    deep = {"type": "object", "required": ["a"], "additionalProperties": False, "properties": {"a": {"type": "object", "required": ["b"], "properties": {"b": {"enum": ["x", "y", 1]}}}}}
    df = spark.createDataFrame([('{"a": {"b": 2}, "c": 1}',)], "t string").withColumn("v", F.parse_json("t"))
    found = df.select(schema.violations(F.col("v"), deep).alias("x"))
    once = df.select(schema._kind(F.col("v")).alias("x"))
    uses = lambda rows: rows._jdf.queryExecution().analyzed().toString().count("schema_of_variant(")
    assert uses(found) == 3 * uses(once) > 0
    assert [tuple(x) for x in found.first()["x"]] == [("/c", "additionalProperties"), ("/a/b", "enum")]
    plan = structure_queries.schema_violations(spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert len([line for line in plan.splitlines() if "schemaofvariant" in line.lower()]) == 1


def test_walk_reads_its_input_once_for_all_levels(spark):
    deep = "[" * 11 + "7" + "]" * 11
    df = spark.createDataFrame([(1, '{"a": [{"b": 1}]}'), (2, deep), (3, None)], "id int, t string").withColumn("v", F.parse_json("t"))
    plan = walk.walk(df.where("id <> 2"), ["id"], "v")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate ") == 1 and "Union" not in plan
    got = {(r["path"], r["kind"], r["scalar"], r["level"]) for r in walk.walk(df.where("id = 2"), ["id"], "v").collect()}
    assert got == {("/0" * n, "array" if n < 11 else "number", None if n < 11 else "7", n) for n in range(12)}
