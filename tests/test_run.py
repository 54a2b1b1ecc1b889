"""Registry, probes, health, artefacts and a whole run on recorded responses."""

import pytest
from pyspark.sql import functions as F

from siftspark import schemas as S
from siftspark.operators import probe
from siftspark.plans import run
from siftspark.sinks.artifacts import Releases, canonical, inventory
from siftspark.sources import registry, responses
from siftspark.validate.health import violations

SOURCE = """
  - id: {id}
    kind: live_playlist
    parser: m3u
    enabled: true
    fetch: {{mode: direct_url, reviewed_url: "https://{id}.example.test/list.m3u"}}
    terms_watch: []
    rights_status: {rights}
    allowed_hosts: [{id}.example.test]
    http_exceptions: []
    denied_categories: []
    reviewed_at: 2024-01-01
"""
REGISTRY = "sources:" + SOURCE.format(id="one", rights="verified") + SOURCE.format(id="two", rights="public_unverified") + SOURCE.format(id="three", rights="takedown")
MASTER = "#EXTM3U\n#EXT-X-STREAM-INF:BANDWIDTH=3000000,RESOLUTION=1920x1080\nhi.m3u8\n"
SEGMENT = ("G\x00\x00\x10" + "x" * 184) * 3
MEDIA = "#EXTM3U\n#EXT-X-TARGETDURATION:6\n#EXTINF:5,\nseg.ts\n"


def response(url, body="", status=200, headers=False, ms=10, final=None, error=None):
    return (url, headers, status, bytearray(body.encode()), final or url, ms, error)


def stream(base, ms=10, headers=False, final=None):
    return [response(f"{base}/m.m3u8", MASTER, ms=ms, headers=headers, final=final), response(f"{base}/hi.m3u8", MEDIA, ms=ms, headers=headers), response(f"{base}/seg.ts", SEGMENT, ms=ms, headers=headers)]


@pytest.fixture(scope="module")
def recorded(spark):
    one = '#EXTM3U\n#EXTINF:-1 tvg-id="C1",News\nhttps://a.example.test/m.m3u8\n#EXTINF:-1,Only here\nhttps://b.example.test/m.m3u8|Referer=https://r.example.test/\n#EXTINF:-1,Bad\nhttp://c.example.test/m.m3u8\n'
    two = '#EXTM3U\n#EXTINF:-1 tvg-id="ｃ1" group-title="G&amp",News two\nhttps://d.example.test/m.m3u8\n#EXTINF:-1,Gone\nhttps://e.example.test/m.m3u8\n'
    rows = [response("https://one.example.test/list.m3u", one), response("https://two.example.test/list.m3u", two)]
    rows += stream("https://a.example.test", 50) + stream("https://d.example.test", 5) + stream("https://b.example.test", headers=True)
    rows += [response("https://b.example.test/m.m3u8", status=403), response("https://e.example.test/m.m3u8", status=404)]
    return spark.createDataFrame(rows, S.RESPONSES)


def test_registry_rules(spark):
    sources = registry.registry(spark, REGISTRY)
    assert sources.count() == 3 and registry.violations(sources).count() == 0
    bad = REGISTRY.replace("parser: m3u", "parser: maccms_json", 1).replace("allowed_hosts: [two.example.test]", "allowed_hosts: [x.example.test, X.example.test]")
    assert sorted(map(tuple, registry.violations(registry.registry(spark, bad)).collect())) == [("one", "illegal_combination"), ("two", "host_not_allowed"), ("two", "repeated_host")]
    with pytest.raises(ValueError, match="repeated key"):
        registry.load_yaml("a: 1\na: 2")
    assert registry.load_yaml("a: 2024-01-01") == {"a": "2024-01-01"}


def test_run_publishes_then_carries_state(spark, recorded, tmp_path):
    releases = Releases(tmp_path / "r")
    first = run.collect(spark, REGISTRY, recorded, None, releases, "t1", place=str(tmp_path / "o1"))
    assert first["published"] and first["channels"] == 1 and releases.current()["release"] == "g00000001"
    text = (tmp_path / "r/releases/g00000001/live/live.m3u").read_text()
    assert text == '#EXTM3U\n#EXTINF:-1 tvg-id="ｃ1" group-title="G&amp;amp",⚠️ News two\nhttps://d.example.test/m.m3u8\n'
    items = {r["entity_id"]: r for r in first["items"].collect()}
    by = sorted((r["technical_status"], r["publication_status"], r["failure_reason"]) for r in items.values())
    assert by == sorted([("healthy", "stable", None), ("healthy", "stable", None), ("partial", "withheld", "client_header_unsupported"), ("dead", "withheld", "http_404")])
    state = first["items"].withColumn("response_ms_history", F.array().cast("array<int>"))
    state.write.mode("overwrite").parquet(str(tmp_path / "s"))
    less = recorded.where("url not like 'https://two%'")
    second = run.collect(spark, REGISTRY, less, spark.read.parquet(str(tmp_path / "s")), releases, "t2", place=str(tmp_path / "o2"))
    carried = {r["entity_id"]: r for r in second["items"].collect()}
    assert set(carried) == set(items)
    gone = [r for r in carried.values() if r["source_id"] == "two"]
    assert {r["failure_reason"] for r in gone} == {"blocked_by_source"} and all(r["consecutive_successes"] == 0 for r in gone)
    kept = next(r for r in carried.values() if r["technical_status"] == "healthy")
    assert kept["consecutive_successes"] == 2 and kept["last_success_at"] == "t2"
    assert releases.rollback() and releases.current()["release"] == "g00000001" and releases.current()["generation"] == 3


def test_broken_health_is_seen(spark):
    items = spark.createDataFrame([("a", "s", "live_url", "c", "healthy", "stable", "verified", 0, 2, None, None), ("b", "x", "live_url", "c", "dead", "withheld", "verified", 0, 1, None, None)], ", ".join(f"{c} {'int' if c.startswith('consecutive') else 'string'}" for c in run.health.ITEM))
    channels = spark.createDataFrame([("c", "dead", "b", ["a"])], "channel_id string, technical_status string, selected_url_id string, candidate_url_ids array<string>")
    sources = spark.createDataFrame([("s", "restricted")], "source_id string, rights_status string")
    assert {r["rule"] for r in violations(items, channels, sources).collect()} == {"unknown_source", "bad_streak", "rights_barred", "channel_candidates", "channel_status", "bad_winner"}


def site(videos):
    import json

    return json.dumps({"class": [{"type_id": 1, "type_name": "t"}], "list": videos})


@pytest.mark.parametrize(
    ("change", "status", "reason"),
    [({}, "healthy", None), ({"wd": site([])}, "partial", None), ({"ids": site([])}, None, "detail_contract_failed"), ({"home": "{"}, None, "invalid_json"), ({"home": '{"list": []}'}, None, "home_contract_failed"), ({"play": "x$ftp://h"}, None, "play_contract_failed")],
)
def test_site_chain(change, status, reason):
    video = {"vod_id": 7, "vod_name": "A B", "vod_play_url": change.get("play", "e$https://h.example.test/m.m3u8")}
    api = "https://s.example.test/api"
    bodies = {f"{api}?ac=list": change.get("home", site([video])), f"{api}?ac=list&wd=A%20B": change.get("wd", site([video])), f"{api}?ac=detail&ids=7": change.get("ids", site([video]))}
    rows = [response(u, b) for u, b in bodies.items()] + stream("https://h.example.test")
    fetcher = responses.Recorded({(r[0], r[1]): dict(zip(["url", "with_headers", "status", "body", "final_url", "elapsed_ms", "error"], r, strict=True)) for r in rows})
    got = probe.probe_site(fetcher, api, False)
    assert (got["technical_status"], got["failure_reason"]) == (status, reason)


def test_sites_that_need_code_are_never_fetched(spark):
    rows = spark.createDataFrame([("a", "https://s.example.test/x.jar", 1, "verified", True), ("b", "https://s.example.test/", 3, "verified", False)], "entity_id string, api string, type int, rights_status string, executable boolean")
    got = probe.probe_sites(rows, None, spark.createDataFrame([], "entity_id string, technical_status string")).collect()
    assert {(r["failure_reason"], r["publication_status"]) for r in got} == {("unsupported_spider", "rejected")}


def test_releases_are_immutable_and_promoted_once(spark, tmp_path):
    releases = Releases(tmp_path)
    releases.stage("a", {"x": b"1"})
    with pytest.raises(FileExistsError):
        releases.stage("a", {})
    assert releases.promote("a", None) and not releases.promote("a", None)
    (tmp_path / "releases/a/x").write_bytes(b"2")
    assert not releases.verified("a")
    assert inventory(spark, str(tmp_path / "releases")).count() == 2
    assert canonical({"b": 1, "a": "é"}) == '{\n  "a": "é",\n  "b": 1\n}\n'.encode()


def test_cli_carries_state_applies_the_denylist_and_verifies(spark, recorded, tmp_path, monkeypatch):
    from siftspark import cli

    monkeypatch.setattr(cli, "local_session", lambda *a: spark)
    (tmp_path / "registry.yaml").write_text(REGISTRY)
    (tmp_path / "deny.yaml").write_text("entries:\n  - {id: d1, source_ids: [], hosts: [two.example.test], urls: [], reason: r}\n")
    recorded.write.parquet(str(tmp_path / "responses"))
    releases = Releases(tmp_path / "r")
    base = ["collect", str(tmp_path / "registry.yaml"), str(tmp_path / "responses"), str(tmp_path / "r")]
    for at in ("t1", "t2"):
        assert cli.main([*base, at]) == 0
    state = spark.read.parquet(str(releases.state("g00000002"))).where("technical_status = 'healthy'")
    assert {(r["consecutive_successes"], r["last_success_at"]) for r in state.collect()} == {(2, "t2")}
    cli.main([*base, "t3", "--denylist", str(tmp_path / "deny.yaml")])
    observed = spark.read.parquet(str(tmp_path / "r/observed/t3"))
    assert {r["source_id"] for r in observed.select("source_id").distinct().collect()} == {"one"}
    assert cli.main(["verify-artifact", str(tmp_path / "r"), "g00000002"]) == 0
    (tmp_path / "r/releases/g00000002/live/live.m3u").write_text("x")
    assert cli.main(["verify-artifact", str(tmp_path / "r"), "g00000002"]) == 1
    assert cli.main(["verify-release", str(tmp_path / "r"), "g00000002"]) == 1


def test_two_writers_of_one_generation(spark, tmp_path):
    one, two = Releases(tmp_path), Releases(tmp_path)
    for w, body in ((one, b"1"), (two, b"2")):
        w.stage("a", {"x": body})
    assert two.promote("a", None) and not one.promote("a", None)
    assert (tmp_path / "releases/a/x").read_bytes() == b"2" and one.current() == two.current() == {"release": "a", "generation": 1, "previous": None}
    assert len(one.leftovers()) == 1 and one.leftovers()[0].startswith("staging/a-")
    one.stage("b", {"x": b"3"})
    two.stage("c", {"x": b"4"})
    seen = one.current()
    assert two.promote("c", seen) and not one.promote("b", seen) and one.promote("b", one.current())
    assert one.current() == {"release": "b", "generation": 3, "previous": "c"}
    assert two.rollback() and two.current() == {"release": "c", "generation": 4, "previous": None} and not two.rollback()
    assert not two.remove("c") and two.remove("b") and "b" not in two.log.state().releases and not (tmp_path / "releases/b").exists()


class Died(Exception):
    pass


@pytest.mark.parametrize("step", ["stage", "write", "commit", "move", "after"])
def test_a_writer_that_dies_blocks_nobody(spark, tmp_path, monkeypatch, step):
    from siftspark.sinks import commitlog

    first = Releases(tmp_path)
    first.stage("a", {"x": b"1"}, spark.range(1))
    assert first.promote("a", None)

    def die(*_, **__):
        raise Died

    with monkeypatch.context() as m:
        writer = Releases(tmp_path)
        if step == "stage":  # some files of the attempt are there, its manifest isn't
            create = commitlog.Store.create
            m.setattr(commitlog.Store, "create", lambda self, name, data: die() if name.endswith("manifest.json") else create(self, name, data))
        with pytest.raises(Died):
            writer.stage("b", {"x": b"2"}, spark.range(2))
            if step == "write":  # the commit's file was written and not named
                m.setattr(commitlog.Store, "move", die)
            if step == "commit":
                m.setattr(commitlog.CommitLog, "commit", die)
            if step == "move":  # committed; the release hasn't got its name yet
                move = commitlog.Store.move
                m.setattr(commitlog.Store, "move", lambda self, a, b: die() if b.startswith("releases/") else move(self, a, b))
            writer.promote("b", writer.current())
            die()
    done = step in ("move", "after")
    other = Releases(tmp_path)
    assert other.current() == ({"release": "b", "generation": 2, "previous": "a"} if done else {"release": "a", "generation": 1, "previous": None})
    assert other.verified(other.current()["release"]) and spark.read.parquet(other.state(other.current()["release"])).count() == (2 if done else 1)
    name = "c" if done else "b"
    other.stage(name, {"x": b"3"})
    assert other.promote(name, other.current()) and (tmp_path / f"releases/{name}/x").read_bytes() == b"3"


def test_a_claim_of_the_old_layout_blocks_nobody(spark, tmp_path):
    releases = Releases(tmp_path)
    releases.stage("a", {"x": b"1"})
    (tmp_path / "claims").mkdir()
    (tmp_path / "claims/00000001").touch()
    assert releases.promote("a", None)


def test_tracked_files_are_read_at_their_revision(spark):
    rows = [
        ("d", ("direct_url", "https://d.example.test/l.m3u", None, None, None, None)), ("t", ("github_tracked_file", None, "https://github.com/o/r.git", "main", "a b/list.m3u", "abc")),
        ("n", ("github_tracked_file", None, "https://github.com/o/r", "main", "list.m3u", None)), ("w", ("github_repository", None, "https://github.com/o/r", "main", None, "abc")),
    ]
    names = [f.split(":")[0] for f in "mode:,reviewed_url:,repository_url:,track_ref:,config_path:,reviewed_revision:".split(",")]
    fetch = ", ".join(f"{n}: string" for n in names)
    df = spark.createDataFrame([(i, "m3u", f, [], "verified") for i, f in rows], f"id string, parser string, fetch struct<{fetch}>, terms_watch array<struct<type: string, url: string, path: string, reviewed_sha256: string>>, rights_status string")
    recorded = spark.createDataFrame([response("https://d.example.test/l.m3u", "D"), response("https://raw.githubusercontent.com/o/r/abc/a%20b/list.m3u", "T")], S.RESPONSES)
    got = {r["source_id"]: bytes(r["content"]).decode() if r["content"] is not None else None for r in responses.fetched(df, recorded).collect()}
    assert got == {"d": "D", "t": "T", "n": None, "w": None}


def test_streams_by_joins(spark):
    base = "https://h.example.test"
    rows = [*stream(base), response(f"{base}/flat.m3u8", MEDIA, ms=3), response(f"{base}/loop.m3u8", MASTER.replace("hi.m3u8", "m.m3u8")), response(f"{base}/none.m3u8", "x"), response(f"{base}/gone.m3u8", status=404), response(f"{base}/slow.m3u8", error="fetch_timeout"), response(f"{base}/moved.m3u8", MASTER, final=f"{base}/deep/m.m3u8"), response(f"{base}/big.m3u8", "x" * (2 << 20) + "y")]
    urls = {n: f"{base}/{n}.m3u8" for n in ("m", "flat", "loop", "none", "gone", "slow", "moved", "big", "lost")}
    df = spark.createDataFrame([*urls.items(), ("twice", urls["m"])], "entity_id string, url string").withColumn("declared", F.lit(False))
    got = {r["entity_id"]: (r["ok"], r["response_ms"], r["media_path_score"], r["width"], r["failure_reason"]) for r in probe.streams(df, spark.createDataFrame(rows, S.RESPONSES)).collect()}
    assert got == {
        "m": (True, 30, 2, 1920, None), "twice": (True, 30, 2, 1920, None), "flat": (True, 13, 1, None, None), "loop": (False, None, 0, 1920, "schema_incompatible"), "none": (False, None, 0, None, "schema_incompatible"), "gone": (False, None, 0, None, "http_404"),
        "slow": (False, None, 0, None, "fetch_timeout"), "moved": (False, None, 0, 1920, "dns_failure"), "big": (False, None, 0, None, "response_too_large"), "lost": (False, None, 0, None, "dns_failure"),
    }


def test_static_and_xml_sites_and_bodies_that_are_no_media(spark):
    fetch = lambda rows: responses.Recorded({(r[0], r[1]): dict(zip(["url", "with_headers", "status", "body", "final_url", "elapsed_ms", "error"], r, strict=True)) for r in rows})
    api = "https://s.example.test/api"
    sites = spark.createDataFrame([("ok", api), ("lost", api + "2"), ("plain", "http://s.example.test/"), ("key", api + "?to_ken=1"), ("jar", "https://s.example.test/a.jar"), ("page", api + "3"), ("bytes", api + "4")], "entity_id string, api string")
    bodies = fetch([response(api, "{}"), response(api + "3", "<html><title>404 not found"), (api + "4", False, 200, bytearray(b"\xff"), api + "4", 1, None)])
    got = {r["entity_id"]: (r["technical_status"], r["failure_reason"]) for r in probe.static_sites(sites, bodies).collect()}
    assert got == {
        "ok": ("partial", None), "lost": (None, "dns_failure"), "plain": (None, "client_http_disallowed"), "key": (None, "credential_query_rejected"), "jar": (None, "unsupported_spider"),
        "page": (None, "home_contract_failed"), "bytes": (None, "schema_incompatible"),
    }
    xml = '<rss><class><ty id="1">t</ty></class><list><video><id>7</id><name>A</name><dl><dd flag="f">e$https://h.example.test/m.m3u8</dd></dl></video></list></rss>'
    pages = [response(f"{api}?ac={q}", xml) for q in ("list", "list&wd=A", "detail&ids=7")]
    assert probe.probe_site(fetch(pages + stream("https://h.example.test")), api, False)["technical_status"] == "healthy"
    assert probe.probe_site(fetch([response(f"{api}?ac=list", "<!DOCTYPE x>" + xml)]), api, False)["failure_reason"] == "invalid_xml"
    dead = [r if not r[0].endswith(".ts") else response(r[0], "x") for r in stream("https://h.example.test")]
    assert probe.probe_stream(fetch(dead), "https://h.example.test/m.m3u8", False)["failure_reason"] == "media_probe_failed"


def test_stream_keeps_state_like_batches(spark, tmp_path):
    from siftspark.streaming import replay

    place = tmp_path / "in"
    schema = "entity_id string, technical_status string, response_ms int, checked_at string"
    for i, status in enumerate(["healthy", "healthy", "dead"]):
        spark.createDataFrame([("e", status, 10 + i, f"t{i}")], schema).coalesce(1).write.mode("append").parquet(str(place))
        replay.follow(spark.readStream.schema(schema).parquet(str(place)), str(tmp_path / "state"), str(tmp_path / "check")).awaitTermination()
    row = replay.state(spark, str(tmp_path / "state")).first()
    assert (row["consecutive_successes"], row["consecutive_failures"], row["last_success_at"], row["response_ms_history"]) == (0, 1, "t1", [10, 11])
