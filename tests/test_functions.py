"""Boundaries of the functions and operators."""

import pytest
from pyspark.sql import functions as F

from siftspark import schemas as S
from siftspark.functions import ids, media, policy, urls
from siftspark.operators import closure, history, parse, select, sets


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("size", "expected"),
    [((1920, 1080, 3_000_000), 4), ((1919, 1080, 3_000_000), 3), ((1280, 720, 1_500_000), 3), ((640, 360, 500_000), 2), ((639, 360, 500_000), 0), ((None, 1080, 3_000_000), 1)],
)
def test_quality(spark, size, expected):
    assert one(spark, media.quality_score(*[F.lit(x).cast("int") for x in size])) == expected


@pytest.mark.parametrize(
    ("values", "current", "expected"),
    [([], None, float("inf")), ([], 40, 40.0), ([7], 1, 7.0), ([1, 4], None, 2.5), ([9, 1, 2, 3, 4, 5, 6, 7], None, 4.0), ([1, 1, 1, 1, 1, 1, 1, 100], None, 1.0)],
)
def test_response_rank(spark, values, current, expected):
    history_ = F.array(*map(F.lit, values)).cast("array<int>")
    assert one(spark, media.response_rank(history_, F.lit(current).cast("int"))) == expected


def test_history_keeps_seven(spark):
    eight = F.array(*[F.lit(i) for i in range(7)])
    assert one(spark, media.next_history(eight, F.lit(99), F.lit(True))) == [1, 2, 3, 4, 5, 6, 99]
    assert one(spark, media.next_history(eight, F.lit(99), F.lit(False))) == list(range(7))


def test_streak_breaks_on_partial_and_keeps_last_success(spark):
    s = one(spark, media.next_streak(F.lit("partial"), F.lit(3), F.lit(0), F.lit("t3"), F.lit("t4")))
    assert (s["consecutive_successes"], s["consecutive_failures"], s["last_success_at"]) == (0, 1, "t3")


def test_replay_equals_repeated_steps(spark):
    statuses = ["healthy", "healthy", "partial", "healthy", "dead", "dead", "healthy"]
    rows = spark.createDataFrame([("e", i, s, i * 10) for i, s in enumerate(statuses)], "entity_id string, run int, technical_status string, response_ms int")
    whole = history.replay_streaks(rows, ["entity_id"], ["run"], F.col("technical_status") == "healthy", "run").orderBy("run").collect()
    state = spark.createDataFrame([], "entity_id string, consecutive_successes int, consecutive_failures int, last_success_at string, response_ms_history array<int>")
    for i, _ in enumerate(statuses):
        now = rows.where(F.col("run") == i).withColumn("checked_at", F.col("run").cast("string"))
        r = history.step(now, state).first()
        assert (r["consecutive_successes"], r["consecutive_failures"]) == (whole[i]["consecutive_successes"], whole[i]["consecutive_failures"])
        assert r["last_success_at"] == (None if whole[i]["last_success_at"] is None else str(whole[i]["last_success_at"]))
        state = spark.createDataFrame([r.asDict()], "entity_id string, consecutive_successes int, consecutive_failures int, last_success_at string, response_ms_history array<int>")


def test_flagging_is_idempotent_and_ignores_order(spark):
    rows = [(i, i % 3, "stable" if i % 4 else "withheld") for i in range(24)]
    of = lambda data: select.flag_losers(spark.createDataFrame(data, "id int, url int, publication_status string"), [F.col("url")], F.col("publication_status") == "stable", [F.asc("id")])
    once = sorted(map(tuple, of(rows).collect()))
    assert once == sorted(map(tuple, of(rows[::-1]).collect()))
    assert once == sorted(map(tuple, of(once).collect()))
    assert len(once) == 24 and sum(s == "stable" for *_, s in once) == 3


def test_reasons_are_ranked_and_distinct(spark):
    df = spark.createDataFrame([("fetch_timeout",), ("takedown",), (None,), ("takedown",), ("odd",)], "r string")
    got = df.agg(policy.ordered_reasons(F.col("r")).alias("v")).first()["v"]
    assert got == ["takedown", "fetch_timeout", "odd"]
    assert len(S.FAILURES) == len(set(S.FAILURES)) == 34


@pytest.mark.parametrize(
    ("url", "reason"),
    [
        ("https://a.example.test/x", None), ("http://a.example.test/x", "client_http_disallowed"), ("ftp://a.example.test/", "dangerous_scheme_rejected"),
        ("https://u:p@a.example.test/", "invalid_url"), ("https://a.example.test/?ToKeN=1", "credential_query_rejected"), ("https://a.example.test/?api%5Fkey=1", "credential_query_rejected"),
        ("https://a.example.test/?a+b=1", None), ("https://a.example.test/?%zz=1", "credential_query_rejected"), ("https://localhost/", "invalid_host"), ("https://a.example.test:99999/", "invalid_url"), ("", "invalid_url"),
    ],
)
def test_structural_reason(spark, url, reason):
    assert one(spark, urls.structural_reason(F.lit(url))) == reason


def test_normal_url(spark):
    assert one(spark, urls.normal_url(F.lit("HTTPS://EX.Example.test:443/A?x=1#f"))) == "https://ex.example.test/A?x=1"
    assert one(spark, urls.normal_url(F.lit("https://ex.test:8443/"))) == "https://ex.test:8443/"


def test_hosts_and_keys(spark):
    rows = spark.createDataFrame([("BÜCHER.example",), ("nodots",), ("10.0.0.1",), ("-a.test",)], "h string")
    assert [r[0] for r in rows.select(urls.idna_host("h")).collect()] == ["xn--bcher-kva.example", None, "10.0.0.1", None]
    keys = spark.createDataFrame([("ToKeN",), ("api%5Fkey",), ("a+b",), ("%zz",)], "k string")
    assert [r[0] for r in keys.select(urls.strict_key("k")).collect()] == ["token", "apikey", "a+b", None]


def test_channel_identity_is_global_by_guide_id_and_local_by_name(spark):
    key = lambda tvg, source, name: one(spark, ids.channel_id(ids.channel_key(F.lit(tvg), F.lit(source), F.lit(name))))
    assert key("cctv1", "a", "x") == key("cctv1", "b", "y")
    assert key("", "a", "x") != key("", "b", "x")


def test_gate_at_exactly_twenty_percent(spark):
    lit = lambda **k: {n: F.lit(v) for n, v in k.items()}
    base = lit(state_available=True, previous_known=True, live_lost=0, live_previous=0, vod_now=0, live_now=3, least_vod=1, least_live=1, least_previous=5, max_ratio=0.2, failed_groups=2, abort_groups=2)
    assert one(spark, policy.gate_reasons(base | lit(vod_lost=1, vod_previous=5))) == ["vod_zero", "minimum_vod_sites", "network_outage"]
    assert one(spark, policy.gate_reasons(base | lit(vod_lost=2, vod_previous=5)))[0] == "vod_failure_ratio"


def test_due_at_exactly_240_hours(spark):
    now = F.lit("2024-01-11 00:00:00").cast("timestamp")
    due = lambda last: one(spark, policy.due_decision(now, F.lit(last).cast("timestamp"), F.lit("regular"), F.lit(False)))
    assert due("2024-01-01 00:00:00") == "elapsed_240h"
    assert due("2024-01-01 00:00:01") == "not_due"


def test_play_lines(spark):
    issue = lambda names, text: one(spark, parse.play_line_issue(F.lit(names), F.lit(text)))
    assert issue("a", "e$https://h.test/1#") is None
    assert issue("a", "e$https://h.test/1##f$https://h.test/2") == "empty_episode"
    assert issue("a$$$b", "e$https://h.test/1") == "line_count"
    assert issue("a", "e$ftp://h.test/1") == "bad_url"


def test_json_repeats_and_relaxed(spark):
    assert one(spark, parse.pointer(F.lit('{"a": {"b": [5, 6]}}'), "/a/b/1")) == "6"
    assert one(spark, parse.pointer(F.lit('{"a": 1, "a": 2}'), "/a")) is None
    rows = spark.createDataFrame([("{a: 'x', b: [1, .5,], /* c */}",), ("{a: 1, a: 2}",), ("{",)], "t string")
    assert [r[0] for r in rows.select(parse.json5("t")).collect()] == ['{"a": "x", "b": [1, 0.5]}', None, None]


def test_m3u_headers_end_with_their_entry(spark):
    text = '#EXTM3U\n#EXTINF:-1 tvg-id="a,b" group-title="g",Name, one\n#EXTVLCOPT:http-user-agent=U\nhttps://h.test/1\nhttps://h.test/2\n#EXTINF:-1,X\nftp://h\n'
    rows = spark.createDataFrame([("s", bytearray(text.encode())), ("t", bytearray(b"\xff"))], "source_id string, content binary")
    got = [(r["name"], r["tvg_id"], r["headers"], r["issue"]) for r in parse.m3u_entries(rows).orderBy("source_id", "ordinal").collect()]
    assert got == [("Name, one", "a,b", {"user-agent": "U"}, None), ("", None, {}, "missing_info"), ("X", None, {}, "bad_url"), (None, None, None, "invalid_utf8")]


def test_closure_ends_on_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e")], "src string, dst string")
    roots = spark.createDataFrame([("a",)], "node string")
    assert sorted(map(tuple, closure.reachable(roots, edges, 3).collect())) == [("a", 0), ("b", 1), ("c", 2), ("d", 3)]


def test_deep_closure_cuts_its_lineage(spark):
    edges = spark.createDataFrame([(str(i), str(i + 1)) for i in range(20)], "src string, dst string")
    roots = spark.createDataFrame([("0",)], "node string")
    assert closure.reachable(roots, edges, 10).count() == 11


def test_globs():
    import re

    fits = lambda glob, path: bool(re.match(closure.glob_pattern(glob), path))
    assert fits("**/*.json", "a/b/c.json") and fits("**/*.json", "c.json") and not fits("*.json", "a/c.json")
    assert fits("a?c", "abc") and not fits("a?c", "a/c")


def test_differences_count_repeats(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    assert sorted(map(tuple, sets.differences(a, b).collect())) == [(1, "claimed"), (3, "required")]
