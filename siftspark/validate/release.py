"""Rules of a sealed release, derived apart from what produced it.

Each function gives the broken rules as rows (rule, key, detail); a release that keeps them gives none.  Tables are joined on
equal keys only, and what is compared per field is compared null-safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftspark import schemas as S
from siftspark.functions import policy, urls
from siftspark.operators import sets

# The forms of ids and digests, and which items and configurations a kind of source may have.
SOURCE_ID = "^[a-z0-9][a-z0-9-]*$"
SHA40, SHA64 = "^[0-9a-f]{40}$", "^[0-9a-f]{64}$"
ITEM_OF_KIND = {"vod_site": "vod", "vod_config": "vod", "live_playlist": "live", "repository_catalog": "catalog"}
STATUS_PAIRS = [("pending", "pending"), ("success", "success")]


def broken(df: DataFrame, key: Column, rules: dict[str, Column], detail: Column | None = None) -> DataFrame:
    """One row for each row and rule that it breaks; a rule that is null isn't broken."""
    names = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))
    return df.select(F.explode(names).alias("rule"), key.cast("string").alias("key"), (F.lit("") if detail is None else detail.cast("string")).alias("detail"))


def active_sources(sources: DataFrame, ids: DataFrame, hosts: DataFrame, blocked: DataFrame) -> DataFrame:
    """Enabled sources that no denylist entry hits by id, by one of their ``hosts`` or by one of their ``urls``."""
    by_host = sources.select("source_id", F.explode("hosts").alias("host"), F.lit(None).cast("string").alias("url"))
    by_url = sources.select("source_id", F.explode("urls").alias("url")).select("source_id", urls.host(F.col("url")).alias("host"), urls.normal_url(F.col("url")).alias("url"))
    own = sources.select("source_id", F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("url"))
    hit = sets.denied_sources(own.unionByName(by_host).unionByName(by_url), ids, hosts, blocked)
    return sources.where("enabled").join(hit.select("source_id").distinct(), "source_id", "left_anti")


def denied_but_active(sources: DataFrame, ids: DataFrame, hosts: DataFrame, blocked: DataFrame) -> DataFrame:
    """Enabled sources that the denylist hits."""
    kept = active_sources(sources, ids, hosts, blocked)
    return broken(sources.where("enabled").join(kept, "source_id", "left_anti"), F.col("source_id"), {"denied_source_active": F.lit(True)})


def upstream_bindings(upstreams: DataFrame, health: DataFrame, registry: DataFrame, strict: bool = True) -> DataFrame:
    """Claims about upstreams against the health table and the registry, by source_id.

    ``upstreams``: fetch_mode, reviewed_revision, resolved_revision, resolved_fetch_url, terms; ``health``: upstream_revision;
    ``registry``: mode, reviewed, expected_url, reviewed_terms.  A safety release (not strict) may keep sources that the
    registry no longer has, and reviewed facts of before.
    """
    u, h, r = upstreams.withColumn("_u", F.lit(True)), health.withColumn("_h", F.lit(True)), registry.withColumn("_r", F.lit(True))
    rows = u.join(h, "source_id", "full_outer").join(r, "source_id", "full_outer")
    both, known = F.col("_u") & F.col("_h"), F.col("_u") & F.col("_r")
    differs = lambda a, b: ~F.col(a).eqNullSafe(F.col(b))
    direct = F.col("mode") == "direct_url"
    rules = {
        "upstream_without_health": F.col("_u") & F.col("_h").isNull(),
        "health_without_upstream": F.col("_h") & F.col("_u").isNull(),
        "revision_differs_from_health": both & differs("upstream_revision", "resolved_revision"),
        "mode_differs": known & differs("fetch_mode", "mode"),
        "direct_claims_revision": known & direct & (F.col("reviewed_revision").isNotNull() | F.col("resolved_revision").isNotNull()),
        "bad_revision": known & ~direct & ~F.coalesce(F.col("resolved_revision").rlike(SHA40), F.lit(False)),
        "url_differs": known & differs("resolved_fetch_url", "expected_url"),
    }
    if strict:
        rules |= {
            "not_in_registry": F.col("_u") & F.col("_r").isNull(),
            "registry_without_upstream": F.col("_r") & F.col("_u").isNull(),
            "reviewed_revision_differs": known & differs("reviewed_revision", "reviewed"),
            "terms_differ": known & differs("terms", "reviewed_terms"),
        }
    return broken(rows, F.col("source_id"), rules)


def rights_bindings(health: DataFrame, registry: DataFrame, items: DataFrame, channels: DataFrame) -> DataFrame:
    """Rights of health rows against the registry's, items that these bar from publication, and channels' rights, which are
    the most restrictive of their items'."""
    known = registry.select("source_id", F.col("rights_status").alias("_known"))
    own = broken(health.join(known, "source_id"), F.col("source_id"), {"rights_differ": ~F.col("rights_status").eqNullSafe(F.col("_known"))}, F.col("_known"))
    barred = items.join(known, "source_id").where(F.col("_known").isin("restricted", "takedown", "unknown"))
    out = own.unionByName(broken(barred, F.col("entity_id"), {"rights_barred": F.col("publication_status").isin("stable", "experimental")}, F.col("_known")))
    derived = items.join(known, "source_id").groupBy("channel_id").agg(policy.rights_rollup(F.col("_known")).alias("_rights"))
    bound = channels.join(derived, "channel_id", "left")
    return out.unionByName(broken(bound, F.col("channel_id"), {"channel_rights": ~F.col("rights_status").eqNullSafe(F.col("_rights"))}, F.col("_rights")))


def rights_floor(retained: DataFrame, registry: DataFrame) -> DataFrame:
    """Sources that a safety release keeps although the registry now restricts them or takes them down."""
    blocked = registry.where(F.col("rights_status").isin("restricted", "takedown")).select("source_id", F.col("rights_status").alias("_now"))
    return broken(retained.join(blocked, "source_id"), F.col("source_id"), {"retained_though_blocked": F.lit(True)}, F.col("_now"))


def site_categories(sites: DataFrame, sources: DataFrame) -> DataFrame:
    """Sites (site_id, source_id, categories, api) against what their source denies and which hosts it allows."""
    of = sources.select("source_id", F.transform("denied_categories", lambda x: F.trim(x)).alias("_denied"), "allowed_hosts", "allow_discovered_media_hosts")
    rules = {
        "categories_not_canonical": F.col("categories") != F.array_sort(F.array_distinct("categories")),
        "denied_category": F.arrays_overlap(F.transform("categories", lambda x: F.trim(x)), "_denied"),
        "host_not_allowed": ~F.col("allow_discovered_media_hosts") & ~F.array_contains("allowed_hosts", urls.host(F.col("api"))),
    }
    return broken(sites.join(of, "source_id"), F.col("site_id"), rules)


def facts_differ(actual: DataFrame, expected: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Each field in which a row differs from the one rebuilt from trusted facts, and rows that only one side has."""
    a, e = actual.select(key, F.struct(*columns).alias("_a")), expected.select(key, F.struct(*columns).alias("_e"))
    both = a.join(e, key, "full_outer")
    here = F.col("_a").isNotNull() & F.col("_e").isNotNull()
    rules = {f"{c}_differs": here & ~F.col(f"_a.{c}").eqNullSafe(F.col(f"_e.{c}")) for c in columns}
    return broken(both, F.col(key), {"missing": F.col("_a").isNull(), "unexpected": F.col("_e").isNull()} | rules)


def kind_matrix(sources: DataFrame, items: DataFrame, configs: DataFrame) -> DataFrame:
    """Item types and configuration files that a kind of source can't have, or must have (source_id, kind; source_id,
    entity_type; source_id)."""
    kinds = items.groupBy("source_id").agg(F.collect_set("entity_type").alias("types"), F.bool_or(F.col("published")).alias("shown"))
    rows = sources.join(kinds, "source_id", "left").join(configs.select("source_id", F.lit(True).alias("_c")), "source_id", "left")
    fit = F.element_at(F.create_map(*[F.lit(x) for pair in ITEM_OF_KIND.items() for x in pair]), F.col("kind"))
    vod = fit == "vod"
    rules = {
        "foreign_item_type": F.exists("types", lambda t: t != fit),
        "config_of_other_kind": F.col("_c") & ~vod,
        "config_missing": vod & F.col("shown") & F.col("_c").isNull(),
        "config_without_items": vod & F.col("_c") & ~F.coalesce("shown", F.lit(False)),
    }
    return broken(rows, F.col("source_id"), rules)


def denied_payload(values: DataFrame, ids: DataFrame, hosts: DataFrame, blocked: DataFrame) -> DataFrame:
    """Denied ids, hosts and URLs among all values of a payload (source_id, url), with what they were hit by."""
    rows = values.select("source_id", urls.host(F.col("url")).alias("host"), urls.normal_url(F.col("url")).alias("url"))
    hit = sets.denied_sources(rows, ids, hosts, blocked)
    return broken(hit, F.col("source_id"), {"denied_value": F.lit(True)}, F.col("reason"))


def inventory(declared: DataFrame, actual: DataFrame, cap: int) -> DataFrame:
    """Files (path, size, sha256) against their inventory, and their total size against the cap."""
    d, a = declared.select("path", F.struct("size", "sha256").alias("_d")), actual.select("path", F.struct("size", "sha256").alias("_a"))
    rules = {
        "missing": F.col("_a").isNull(), "undeclared": F.col("_d").isNull(), "size_differs": F.col("_d.size") != F.col("_a.size"),
        "hash_differs": F.col("_d.sha256") != F.col("_a.sha256"), "unsafe_path": ~safe_path(F.col("path")),
    }
    total = actual.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("total"))
    return broken(d.join(a, "path", "full_outer"), F.col("path"), rules).unionByName(broken(total, F.lit("*"), {"total_exceeds_cap": F.col("total") > cap}, F.col("total")))


def safe_path(path: Column) -> Column:
    """Relative, without empty, dot and backslash parts."""
    return ~path.rlike(r"^/|\\|(^|/)\.{0,2}(/|$)")


def sealed(actual: DataFrame) -> DataFrame:
    """One row for a whole inventory: files, bytes, and a digest of its sorted entries, pre-aggregated by first directory."""
    line = F.concat_ws(":", "path", F.col("size").cast("string"), "sha256")
    parts = actual.groupBy(F.substring_index("path", "/", 1).alias("top")).agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("h"))
    digest = F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "top", "h"))), "\n"), 256)
    return parts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), digest.alias("digest"))


def release_closure(links: DataFrame, present: DataFrame, prefix: str) -> DataFrame:
    """Links (name, url) that leave the release, that lead to no file of it, and configurations that no link names."""
    inside = F.col("url").startswith(prefix)
    own = links.withColumn("path", F.when(inside, F.substr("url", F.lit(len(prefix) + 1))))
    out = broken(own, F.col("name"), {"crosses_release": ~inside | ~safe_path(F.col("path"))}, F.col("url"))
    held = own.where("path is not null").join(present, "path", "left_anti")
    unnamed = present.where(F.col("path").startswith("configs/")).join(own.where("path is not null").select("path").distinct(), "path", "left_anti")
    return out.unionByName(broken(held, F.col("name"), {"target_missing": F.lit(True)}, F.col("path"))).unionByName(broken(unnamed, F.col("path"), {"config_unreferenced": F.lit(True)}))


def upstream_records(upstreams: DataFrame) -> DataFrame:
    """Form and order of a manifest's upstream records (ordinal, source_id, fetch_mode, revisions, URL, terms map).  The order
    is checked between neighbours within ranges of ordinals and across their borders, so no task reads all records."""
    valid = lambda c: F.coalesce(F.col(c).rlike(SHA40), F.lit(False))
    direct = F.col("fetch_mode") == "direct_url"
    rules = {
        "bad_source_id": ~F.coalesce(F.col("source_id").rlike(SOURCE_ID), F.lit(False)),
        "bad_mode": ~F.coalesce(F.col("fetch_mode").isin(S.FETCH_MODES), F.lit(False)),
        "direct_claims_revision": direct & (F.col("reviewed_revision").isNotNull() | F.col("resolved_revision").isNotNull()),
        "bad_revision": ~direct & ~(valid("reviewed_revision") & valid("resolved_revision")),
        "bad_url": ~F.coalesce(F.col("resolved_fetch_url").rlike("^https?://[^/@]+(/|$)"), F.lit(False)) | (F.size(urls.rejected_keys(F.col("resolved_fetch_url"))) > 0),
        "bad_terms": F.exists(F.map_values("terms"), lambda v: ~F.coalesce(v.rlike(SHA64), F.lit(False))),
    }
    last = upstreams.select((F.col("ordinal") + 1).alias("ordinal"), F.col("source_id").alias("_before"))
    order = broken(upstreams.join(last, "ordinal"), F.col("source_id"), {"not_sorted": F.col("source_id") < F.col("_before"), "repeated": F.col("source_id") == F.col("_before")})
    return broken(upstreams, F.col("source_id"), rules).unionByName(order)


def manifest_rules(manifests: DataFrame) -> DataFrame:
    """Generation, id and counts of release manifests, and what their root manifest repeats of them."""
    same = ["generated_at", "previous_commit_sha", "content_run_id", "content_run_attempt"]
    rules = {
        "id_is_not_generation": ~F.col("release_id").eqNullSafe(release_id(F.col("generation"))) | ~F.coalesce(F.col("generation") >= 1, F.lit(False)),
        "bad_count": F.least("source_count", "vod_site_count", "live_channel_count") < 0,
        "source_count_differs": F.col("source_count") != F.col("upstreams"),
        "bad_identity": ~F.coalesce((F.col("content_run_id") != "") & (F.col("content_run_attempt") >= 1), F.lit(False)),
    }
    rules |= {f"root_{c}_differs": ~F.col(c).eqNullSafe(F.col(f"root_{c}")) for c in same}
    return broken(manifests, F.col("release_id"), rules)


def release_id(generation: Column) -> Column:
    return F.concat(F.lit("g"), F.lpad(generation.cast("string"), 8, "0"))


def state_and_report(rows: DataFrame) -> DataFrame:
    """A state, its report and the release that they speak of, one row each: present together, of one status, identity, kind
    and generation; a rollback's generation is beyond the release's, any other's equals it."""
    f = F.col
    pair = F.lit(False)
    for a, b in STATUS_PAIRS:
        pair = pair | ((f("state_status") == a) & (f("report_status") == b))
    safe = (f("state_status") == "success") & (f("report_status") == "safety_degraded") & (f("state_kind") == "safety") & F.array_contains("gate_reasons", "safety_degraded")
    both = f("state_status").isNotNull() & f("report_status").isNotNull()
    rollback = f("state_kind") == "rollback"
    rules = {
        "not_together": f("state_status").isNull() != f("report_status").isNull(),
        "status_pair": both & ~F.coalesce(pair | safe, F.lit(False)),
        "active_release": both & ~(f("state_release").eqNullSafe(f("release_id")) & f("report_release").eqNullSafe(f("release_id"))),
        "event_identity": both & ~(f("state_run").eqNullSafe(f("report_run")) & F.coalesce(f("state_run") != "", F.lit(False))),
        "kind": both & ~f("state_kind").eqNullSafe(f("report_kind")),
        "generation": both & ~F.coalesce(f("report_generation") == f("state_generation"), F.lit(False)),
        "rollback_generation": both & rollback & (f("state_generation") <= f("generation")),
        "content_generation": both & ~rollback & (f("state_generation") != f("generation")),
    }
    return broken(rows, f("release_id"), rules)


def success_state(rows: DataFrame) -> DataFrame:
    """What a state lacks that the next run may start from."""
    f = F.col
    recovery = f("release_kind").isin("safety", "rollback")
    timestamp = lambda c: F.coalesce(f(c).rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?(Z|\+00:00)$") & F.try_to_timestamp(f(c)).isNotNull(), F.lit(False))
    rules = {
        "not_success": ~F.coalesce((f("schema_version") == "1.0.0") & (f("status") == "success"), F.lit(False)),
        "bad_generation": ~F.coalesce(f("generation") >= 1, F.lit(False)),
        "release_is_not_generation": (f("release_kind") != "rollback") & ~f("active_release_id").eqNullSafe(release_id(f("generation"))),
        "bad_rollback_release": (f("release_kind") == "rollback") & ~F.coalesce(f("active_release_id").rlike("^g[0-9]{8}$"), F.lit(False)),
        "bad_identity": ~F.coalesce((f("workflow_run_id") != "") & (f("workflow_run_attempt") >= 1), F.lit(False)),
        "no_publish_time": ~timestamp("last_publish_at"),
        "no_commit": ~F.coalesce(f("content_commit_sha") != "", F.lit(False)),
        "no_success_time": F.when(f("last_success_at").isNull(), ~recovery).otherwise(~timestamp("last_success_at")),
    }
    return broken(rows, f("active_release_id"), rules)


def client_urls(values: DataFrame) -> DataFrame:
    """URLs (key, url) that a client may not be given."""
    why = urls.structural_reason(F.col("url"))
    return values.select(F.lit("refused_url").alias("rule"), F.col("key").cast("string").alias("key"), why.alias("detail")).where("detail is not null")


def single_line(values: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Texts that are empty, longer than their limit or hold a line end or control character; ``values``: key and the columns."""
    rules = {}
    for name, most in limits.items():
        c = F.col(name)
        rules[f"{name}_bounds"] = (F.length(F.trim(c)) == 0) | (F.length(c) > most)
        rules[f"{name}_lines"] = c.rlike("[\\x00-\\x1f\\x7f]")
    return broken(values, F.col("key"), rules)


def entity_index(items: DataFrame) -> DataFrame:
    """Entity ids that repeat, or whose prefix isn't their type and source."""
    own = F.concat_ws(":", "entity_type", "source_id", F.lit(""))
    out = broken(items, F.col("entity_id"), {"foreign_prefix": ~F.col("entity_id").startswith(own)})
    return out.unionByName(broken(sets.repeated(items, ["entity_id"]), F.col("entity_id"), {"repeated_entity": F.lit(True)}, F.col("n")))


def report_audit(claimed: DataFrame, items: DataFrame) -> DataFrame:
    """A report's counts (source_id, technical_status, n) against a recount of the items."""
    derived = items.groupBy("source_id", "technical_status").agg(F.count("*").alias("n"))
    c, d = claimed.withColumnRenamed("n", "_c"), derived.withColumnRenamed("n", "_d")
    both = c.join(d, ["source_id", "technical_status"], "full_outer")
    return broken(both, F.concat_ws(":", "source_id", "technical_status"), {"count_differs": ~F.col("_c").eqNullSafe(F.col("_d"))}, F.coalesce("_d", F.lit(0)))


def claims_not_reproduced(claimed: DataFrame, observed: DataFrame, key: list[str]) -> DataFrame:
    """Destructive claims that a second look doesn't bear out."""
    return broken(claimed.join(observed.select(*key).distinct(), key, "left_anti"), F.concat_ws(":", *key), {"claim_not_reproduced": F.lit(True)})


def deletion_scope(claimed: DataFrame, scanned: DataFrame, active: DataFrame) -> DataFrame:
    """Releases to delete that a trusted scan doesn't name, the reverse, and any that is active."""
    both = claimed.select("release", F.lit(True).alias("_c")).distinct().join(scanned.select("release", F.lit(True).alias("_s")).distinct(), "release", "full_outer")
    both = both.join(active.select("release", F.lit(True).alias("_a")).distinct(), "release", "left")
    rules = {"not_scanned": F.col("_s").isNull(), "not_claimed": F.col("_c").isNull(), "active_release": F.col("_c") & F.col("_a")}
    return broken(both, F.col("release"), rules)


def absent_paths(must: DataFrame, listing: DataFrame, most: int = 10_000) -> DataFrame:
    """Paths of a deletion receipt that are still there, and a receipt that is too long."""
    there = broken(must.select("path").distinct().join(listing.select("path").distinct(), "path", "left_semi"), F.col("path"), {"still_present": F.lit(True)})
    counted = must.agg(F.countDistinct("path").alias("n"))
    return there.unionByName(broken(counted, F.lit("*"), {"receipt_too_long": F.col("n") > most}, F.col("n")))


def text_scan(files: DataFrame, wanted: DataFrame, pattern: str) -> DataFrame:
    """Wanted values (value) that stand in the files' texts (path, text) as matches of the pattern."""
    said = files.select("path", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))).alias("value"))
    return broken(said.join(wanted.select("value").distinct(), "value", "left_semi"), F.col("path"), {"forbidden_value": F.lit(True)}, F.col("value"))


def changed_beyond(before: DataFrame, after: DataFrame, allowed: list[str]) -> DataFrame:
    """Paths that a confirmation changes though it may not."""
    diff = sets.closure_mismatch(before, after, "path", "sha256")
    return broken(diff, F.col("path"), {"changed_path": ~F.col("path").isin(allowed)}, F.col("rule"))


def rollback_target(releases: DataFrame, hits: DataFrame) -> DataFrame:
    """Releases (release, status) that can't be rolled back to: unsuccessful, or with values that must be removed."""
    found = releases.join(hits.groupBy("release").agg(F.count("*").alias("_n")), "release", "left")
    return broken(found, F.col("release"), {"not_success": ~F.col("status").eqNullSafe(F.lit("success")), "holds_mandatory_removal": F.col("_n") > 0}, F.coalesce("_n", F.lit(0)))


def change_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """(source_id, category) between two releases' sources (source_id, technical, publication, rights); a rollback passes the
    bad release as ``before`` and its target as ``after``."""
    side = lambda df, p: df.select("source_id", F.struct("technical", "publication", "rights").alias(p))
    both = side(before, "b").join(side(after, "a"), "source_id", "full_outer")
    facts = lambda p: {n: F.col(f"{p}.{n}") for n in ("technical", "publication", "rights")}
    return both.select("source_id", policy.change_category(F.col("b").isNotNull(), F.col("a").isNotNull(), facts("b"), facts("a")).alias("category"))


def normalised_upstreams(upstreams: DataFrame) -> DataFrame:
    """Upstream records with bare digests, sorted terms, and whether they are fit for a manifest."""
    terms = F.map_from_entries(F.array_sort(F.transform(F.map_entries("terms"), lambda e: F.struct(e["key"].alias("key"), F.regexp_replace(e["value"], "^sha256:", "").alias("value")))))
    rows = upstreams.withColumn("terms", terms)
    bad = upstream_records(rows).where("rule not in ('not_sorted')").select(F.col("key").alias("source_id")).distinct().withColumn("_bad", F.lit(True))
    return rows.join(bad, "source_id", "left").withColumn("fit", F.col("_bad").isNull()).drop("_bad")


def alias_hashes(aliases: DataFrame, files: DataFrame, names: list[str]) -> DataFrame:
    """Aliases (alias, path) against the closed set of names, and their bytes against the release's file."""
    known = aliases.sparkSession.createDataFrame([(n,) for n in names], "alias string").withColumn("_known", F.lit(True))
    rows = aliases.join(F.broadcast(known), "alias", "full_outer")
    out = broken(rows, F.col("alias"), {"unknown_alias": F.col("_known").isNull(), "alias_missing": F.col("path").isNull()})
    digest = files.select(F.col("path").alias("_p"), "sha256")
    own = aliases.select("alias", "path").join(digest.withColumnRenamed("_p", "alias").withColumnRenamed("sha256", "_own"), "alias", "left")
    both = own.join(digest.withColumnRenamed("_p", "path"), "path", "left")
    return out.unionByName(broken(both, F.col("alias"), {"alias_bytes_differ": ~F.col("_own").eqNullSafe(F.col("sha256"))}))


def playlist_rules(lines: DataFrame) -> DataFrame:
    """The grammar of a written playlist, line by line (file, number from 0, line): a head, then pairs of a directive and an
    HTTPS address, none of which repeats."""
    attribute = r'( tvg-id="[^"]*"| tvg-logo="[^"]*"| tvg-url="[^"]*"| group-title="[^"]*")*'
    odd = F.col("number") % 2 == 1
    rules = {
        "bad_head": (F.col("number") == 0) & (F.col("line") != "#EXTM3U"),
        "bad_directive": odd & ~F.col("line").rlike(rf"^#EXTINF:-1{attribute},[^\r\n]+$"),
        "refused_url": (F.col("number") > 0) & ~odd & urls.structural_reason(F.col("line")).isNotNull(),
    }
    key = F.concat_ws(":", "file", F.col("number").cast("string"))
    out = broken(lines, key, rules)
    size = lines.groupBy("file").agg(F.max("number").alias("_last"))
    out = out.unionByName(broken(size, F.col("file"), {"unpaired": F.col("_last") % 2 == 1}))
    again = sets.repeated(lines.where((F.col("number") > 0) & ~odd), ["file", "line"])
    return out.unionByName(broken(again, F.col("file"), {"repeated_url": F.lit(True)}, F.col("line")))


def transitions(releases: DataFrame) -> DataFrame:
    """Rules between consecutive releases of a line (line, generation, kind, previous): generations go up by one, and a
    rollback never comes first."""
    by = Window.partitionBy("line").orderBy("generation")
    rows = releases.select("*", F.lag("generation").over(by).alias("_g"), F.lag("head").over(by).alias("_h"))
    rules = {
        "generation_gap": F.col("_g").isNotNull() & (F.col("generation") != F.col("_g") + 1),
        "wrong_parent": ~F.col("previous").eqNullSafe(F.col("_h")),
        "rollback_without_release": F.col("_g").isNull() & (F.col("kind") == "rollback"),
    }
    return broken(rows, F.concat_ws(":", "line", F.col("generation").cast("string")), rules)
