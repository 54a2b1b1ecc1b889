"""Configurations, catalogues, headers and client documents."""

import json

import pytest
from pyspark.sql import functions as F

from siftspark.functions import headers
from siftspark.operators import config
from siftspark.sinks import client

DOCUMENT = {
    "sites": [
        {"key": "a", "name": "A", "type": 1, "api": "/api", "categories": ["x"]}, {"key": "b", "name": "B", "type": True, "api": "u"}, {"key": "c", "name": " ", "type": 0, "api": "u"},
        {"key": "d", "name": "D", "type": 3, "api": "https://s.example.test/x.jar"}, {"key": "e", "name": "E", "type": 0, "api": "u", "header": {"Cookie": "1"}}, 5,
    ],
    "lives": [{"name": "L", "type": 0, "url": "l.m3u"}, {"name": "M", "url": "m"}], "urls": [{"name": "N", "url": "n.json"}], "storeHouse": [{"sourceName": "S", "sourceUrl": "s.json"}, {}],
}


def read(spark, *texts, **more):
    rows = [(f"s{i}", t, "https://h.example.test/c/x.json") for i, t in enumerate(texts)]
    return config.read(spark.createDataFrame(rows, "source_id string, content string, base_url string"), **more)


def test_entries_keep_their_own_faults(spark):
    rows = read(spark, json.dumps(DOCUMENT)).collect()
    got = sorted((r["kind"], r["ordinal"], r["url"], r["issue"]) for r in rows if r["issue"] is None)
    assert got == [("depot", 0, "https://h.example.test/c/n.json", None), ("live", 0, "https://h.example.test/c/l.m3u", None), ("site", 0, "https://h.example.test/api", None), ("site", 3, "https://s.example.test/x.jar", None), ("store", 0, "https://h.example.test/c/s.json", None)]
    bad = sorted((r["kind"], r["ordinal"], r["issue"]) for r in rows if r["issue"])
    assert bad == [("live", 1, "schema_incompatible"), ("site", 1, "schema_incompatible"), ("site", 2, "schema_incompatible"), ("site", 4, "credential_header_rejected"), ("site", 5, "schema_incompatible"), ("store", 1, "schema_incompatible")]
    assert [r["executable"] for r in rows if r["ordinal"] == 3 and r["kind"] == "site"] == [True]


def test_documents_that_fail_as_a_whole(spark):
    twice = '{"sites": [{"key": "a", "name": "A", "type": 0, "api": "u"}, {"key": "a", "name": "B", "type": 0, "api": "v"}]}'
    rows = read(spark, "{", '{"a": 1, "a": 2}', twice).collect()
    assert sorted((r["source_id"], r["kind"], r["issue"]) for r in rows) == [("s0", "document", "invalid_json"), ("s1", "document", "invalid_json"), ("s2", "document", "schema_incompatible")]
    assert [r["name"] for r in read(spark, "{sites: [{key: 'k', name: 'N', type: 0, api: 'u',}]} // end", relaxed=True).collect()] == ["N"]


def test_candidates_are_one_a_target(spark):
    entries = read(spark, json.dumps(DOCUMENT)).where("kind <> 'document'").withColumn("path", F.lit("p.json"))
    again = entries.withColumn("path", F.lit("q.json"))
    found = config.catalogue_candidates(entries.unionByName(again))
    rows = {r["target"]: r for r in found.collect()}
    assert rows["https://h.example.test/api"]["evidence"] == ["p.json#0", "q.json#0"] and rows["https://h.example.test/api"]["failure_reason"] is None
    assert rows["https://s.example.test/x.jar"]["failure_reason"] == "unsupported_spider"
    assert {r["outcome"] for r in config.within_limits(found, 3).collect()} == {"catalog_limit_exceeded"}
    assert config.within_limits(found, 3).count() == found.count()


@pytest.mark.parametrize(
    ("pairs", "issue"),
    [({"User-Agent": "x"}, None), ({"referer": "https://r.example.test/"}, None), ({"Referer": "nope"}, "credential_header_rejected"), ({"Cookie": "1"}, "credential_header_rejected"), ({"accept": "a\nb"}, "invalid_header_syntax"), ({"Accept": "1", "accept": "2"}, "invalid_header_syntax"), ({"Accept": "x" * 1025}, "credential_header_rejected")],
)
def test_headers(spark, pairs, issue):
    row = spark.createDataFrame([(pairs,)], "h map<string,string>")
    assert row.select(headers.issue(F.col("h")).alias("i")).first()["i"] == issue


def test_headers_behind_urls(spark):
    rows = spark.createDataFrame([("https://h.test/a|Accept=a%20b&Origin=c+d",), ("https://h.test/",), ("u|a",), ("u|a=1|b=2",), ("u|a=1&a=2",)], "t string")
    got = [(r["v"]["url"], r["v"]["headers"], r["v"]["issue"]) for r in rows.select(headers.behind_url(F.col("t")).alias("v")).collect()]
    assert got[0] == ("https://h.test/a", {"Accept": "a b", "Origin": "c+d"}, None) and got[1] == ("https://h.test/", None, None)
    assert [x[2] for x in got[2:]] == ["invalid_header_syntax"] * 3


def test_client_documents_are_ordered_and_closed(spark):
    schema = "source_id string, key string, name string, type int, api string, searchable int, quickSearch int, filterable int, changeable int, categories array<string>, publication_status string, rights_status string"
    rows = [(s, k, k, 1, f"https://{s}.example.test/{k}", 1, 1, 1, 1, ["c"] if k == "k1" else [], p, r) for s, k, p, r in [("z", "k1", "stable", "verified"), ("a", "k2", "experimental", "public_unverified"), ("m", "k3", "stable", "public_unverified"), ("m", "k4", "experimental", "public_unverified")]]
    out = client.files(spark.createDataFrame(rows, schema), "https://h.test/r", 1)
    names = lambda path: [u["name"] for u in json.loads(out[path])["urls"]]
    assert names("index.json") == [client.STABLE_LINE, "DS z", "⚠️ DS m", "⚠️ DS a"]
    assert names("depots/stable.json") == [client.STABLE_LINE, "DS z", "⚠️ DS m"] and names("depots/public-unverified.json") == ["⚠️ DS m", "⚠️ DS a"]
    assert [s["key"] for s in json.loads(out["configs/stable.json"])["sites"]] == ["k3", "k1"]
    assert "categories" not in json.loads(out["configs/a.json"])["sites"][0] and client.unreferenced(out, "https://h.test/r") == []
