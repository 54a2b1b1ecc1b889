"""A whole run: registry and responses in, a verified release behind the pointer out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.functions import ids, media, policy, urls
from siftspark.operators import health, parse, probe, select
from siftspark.sinks.artifacts import Releases, canonical, playlist
from siftspark.sources import registry, responses
from siftspark.validate import release
from siftspark.validate.health import violations

ITEMS = ", ".join(f"{c} {'int' if c.startswith('consecutive') else 'string'}" for c in health.ITEM) + ", response_ms_history array<int>"


@dataclass
class Policy:
    """Bounds of the gate; the values are the policy's defaults."""

    least_vod: int = 0
    least_live: int = 1
    least_previous: int = 5
    max_ratio: float = 0.2
    abort_groups: int = 2


def candidates(sources: DataFrame, content: DataFrame) -> DataFrame:
    """Live candidates of all playlists: one a source and normal URL, the first by place, refused URLs left out."""
    entries = parse.m3u_entries(content.where("parser = 'm3u' and content is not null")).where("issue is null")
    plain = parse.txt_live(content.where("parser = 'txt_live' and content is not null").withColumn("content", F.col("content").cast("string"))).where("issue is null")
    rows = entries.unionByName(plain.select("source_id", "ordinal", "name", "url", "group"), allowMissingColumns=True)
    rows = rows.withColumn("normalized_url", urls.normal_url(F.col("url"))).where(urls.structural_reason(F.col("url")).isNull())
    first = select.best_per_group(rows, ["source_id", "normalized_url"], [F.asc("ordinal")])
    owned = first.join(sources.select(F.col("id").alias("source_id"), "rights_status"), "source_id")
    key = ids.channel_key(ids.ascii_lower(ids.nfkc("tvg_id")), F.col("source_id"), ids.one_spaced("name"))
    return owned.select(
        ids.live_url_id(F.col("source_id"), F.col("normalized_url")).alias("entity_id"), "source_id", F.lit("live_url").alias("entity_type"),
        ids.channel_id(key).alias("channel_id"), F.regexp_replace(key, "^(tvg|local):", "").alias("normalized_identity"), "name", F.col("normalized_url").alias("url"),
        "tvg_id", "group", "logo", "epg", "rights_status", (F.size("headers") > 0).alias("has_headers"),
    )


def selected(observed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(observations with losers of equal final URLs withheld, the winner of each channel)."""
    quality = media.quality_score(F.col("width"), F.col("height"), F.col("bandwidth"))
    order = select.rank_order("consecutive_successes", "media_path_score", media.response_rank(F.col("response_ms_history"), F.col("response_ms")), quality, "url")
    able = lambda: policy.publishable_live(F.col("technical_status"), F.col("publication_status"), F.col("ok"), F.col("media_path_score"))
    rows = select.flag_losers(observed, [F.col("final_url")], able(), [*order, F.asc("channel_id"), F.asc("source_id")])
    winners = select.best_per_group(rows.where(able()), ["channel_id"], [*order, F.asc("entity_id")])
    return rows, winners


def collect(spark: SparkSession, registry_text: str, recorded: DataFrame, previous: DataFrame | None, releases: Releases, checked_at: str, bounds: Policy | None = None, place: str | None = None, denied: DataFrame | None = None) -> dict:
    """Runs it all; what it returns says whether and why a release was published.  Sources that ``denied`` entries hit by id,
    host or URL take no part."""
    bounds = bounds or Policy()
    sources = registry.registry(spark, registry_text).where("enabled")
    if denied is not None:
        watched = F.transform("terms_watch", lambda t: t["url"])
        own = sources.select(F.col("id").alias("source_id"), "enabled", F.col("allowed_hosts").alias("hosts"), F.array_compact(F.concat(F.array("fetch.reviewed_url", "fetch.repository_url"), watched)).alias("urls"))
        kept = release.active_sources(own, *registry.denied_parts(denied)).select(F.col("source_id").alias("id"))
        sources = sources.join(kept, "id", "left_semi")
    broken = registry.violations(sources).collect()
    if broken:
        return {"published": False, "reasons": sorted(f"{r['id']}: {r['rule']}" for r in broken)}
    before = previous if previous is not None else spark.createDataFrame([], ITEMS)
    content = responses.fetched(sources, recorded)
    observed = probe.probe_live(candidates(sources, content), recorded, before, checked_at)
    if place:  # what a probe saw isn't repeatable; it is written once
        observed.write.mode("overwrite").parquet(place)
        observed = spark.read.parquet(place)
    rows, winners = selected(observed)
    read = content.select("source_id", F.col("failure_reason").alias("_f"))
    status = sources.select(F.col("id").alias("source_id"), "rights_status").join(read, "source_id", "left")
    status = status.withColumn("technical_status", F.when(F.col("_f").isNull(), F.lit(None).cast("string")).otherwise(policy.technical_for_failure(F.col("_f"), F.lit(None).cast("string"), F.lit(None).cast("string"))))
    now = health.items(rows, before, status.select("source_id", "technical_status", "rights_status"))
    seen = rows.select("entity_id", F.col("response_ms_history").alias("_new"))
    old = before.select("entity_id", F.col("response_ms_history").alias("_old"))
    state = now.join(seen, "entity_id", "left").join(old, "entity_id", "left").select(*health.ITEM, F.coalesce("_new", "_old").alias("response_ms_history"))
    channels = health.channels(now, winners)
    rules = violations(now, channels, status).collect()
    ok = now.where("publication_status = 'stable' and technical_status = 'healthy'").select("entity_id")
    was = before.where("publication_status = 'stable' and technical_status = 'healthy'").select("entity_id")
    counts = was.join(ok.withColumn("_here", F.lit(True)), "entity_id", "left").agg(F.count("*").alias("live_previous"), F.count_if(F.col("_here").isNull()).alias("live_lost"))
    facts = {n: F.lit(v) for n, v in {"state_available": True, "previous_known": True, "vod_lost": 0, "vod_previous": 0, "vod_now": 1, "live_now": winners.count(), "failed_groups": 0, **bounds.__dict__}.items()}
    reasons = counts.select(policy.gate_reasons(facts | {"live_lost": F.col("live_lost"), "live_previous": F.col("live_previous")}).alias("r")).first()["r"]
    reasons = [*reasons, *sorted(f"{r['rule']}: {r['key']}" for r in rules)]
    result = {"published": False, "reasons": reasons, "channels": winners.count(), "items": now, "state": state, "rights": {r["rights_status"]: r["count"] for r in channels.groupBy("rights_status").count().collect()}}
    if reasons:
        return result
    pointer = releases.current()
    name = releases.next_name()
    shown = {"checked_at": checked_at, "channels": [r.asDict() for r in channels.orderBy("channel_id").toLocalIterator()]}
    releases.stage(name, {"live/live.m3u": playlist(winners), "health.json": canonical(shown)}, state)
    return result | {"published": releases.promote(name, pointer), "release": name}
