"""Facts of a run rebuilt from an old release, and what a safety release must take out of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftspark.functions import ids, urls

#: Failures that take an entity out of every release; fixed values.
SECURITY = [
    "credential_query_rejected", "credential_header_rejected", "private_address_rejected", "dangerous_scheme_rejected",
]


def taken_down(sources: DataFrame, denied: DataFrame) -> DataFrame:
    """Sources with the rights of denied ones (source_id) set to takedown."""
    hit = denied.select("source_id", F.lit(True).alias("_hit")).distinct()
    rights = F.when(F.col("_hit"), F.lit("takedown")).otherwise(F.col("rights_status"))
    return sources.join(hit, "source_id", "left").withColumn("rights_status", rights).drop("_hit")


def previous_sources(index: DataFrame, upstreams: DataFrame, health: DataFrame, configs: DataFrame) -> DataFrame:
    """Source facts of an old release: its kind follows from whether a configuration or live lines stand for it; where both do,
    or neither, it is ambiguous and the row says so."""
    rows = index.join(upstreams, "source_id", "left").join(health, "source_id", "left").join(configs.select("source_id", F.lit(True).alias("_c")).distinct(), "source_id", "left")
    live, vod = F.coalesce(F.col("live_lines") > 0, F.lit(False)), F.coalesce("_c", F.lit(False))
    kind = F.when(vod & ~live, "vod_config").when(live & ~vod, "live_playlist")
    error = F.when(F.col("fetch_mode").isNull(), "no_upstream").when(F.col("rights_status").isNull(), "no_health").when(kind.isNull(), "ambiguous_kind")
    return rows.select("source_id", kind.alias("kind"), "fetch_mode", "rights_status", error.alias("error"))


def previous_vod(sites: DataFrame, stable: DataFrame, mandatory: DataFrame) -> DataFrame:
    """Observations of an old release's sites (entity_id, source_id, type, api): healthy and stable where the stable
    configuration has them, else partial and experimental; those that must go are left out."""
    own = stable.select("type", "api", F.lit(True).alias("_s")).distinct()
    rows = sites.join(mandatory.select("entity_id").distinct(), "entity_id", "left_anti").join(own, ["type", "api"], "left")
    here = F.coalesce("_s", F.lit(False))
    return rows.select(
        "entity_id", "source_id", "type", "api", F.when(here, "healthy").otherwise("partial").alias("technical_status"),
        F.when(here, "stable").otherwise("experimental").alias("publication_status"), here.alias("media_probe"),
    )


def previous_live(items: DataFrame, lines: DataFrame) -> DataFrame:
    """Live items (entity_id, source_id, url) with the name of the one line of their URL, and whether their id reproduces."""
    named = lines.groupBy("url").agg(F.count("*").alias("_n"), F.min("name").alias("name"))
    own = ids.live_url_id(F.col("source_id"), F.col("url"))
    error = F.when(~F.col("entity_id").eqNullSafe(own), "id_differs").when(F.col("_n").isNull(), "no_line").when(F.col("_n") > 1, "ambiguous_line")
    return items.join(named, "url", "left").select("entity_id", "source_id", "url", F.when(F.col("_n") == 1, F.col("name")).alias("name"), error.alias("error"))


def upstream_audit(sources: DataFrame, observations: DataFrame, base: str) -> DataFrame:
    """One record an enabled source: what was resolved, else what was reviewed; without either the row names the error."""
    rows = sources.where("enabled").join(observations, "source_id", "left")
    revision = F.when(F.col("mode") != "direct_url", F.coalesce("resolved_revision", "reviewed_revision"))
    tracked = F.when(
        F.col("config_path").isNotNull(), urls.raw_file_url(base, F.col("repository"), revision, F.col("config_path"))
    ).otherwise(F.concat(F.lit(base + "/"), F.col("repository"), F.lit("/tree/"), revision))
    url = F.coalesce("resolved_fetch_url", F.when(F.col("mode") == "direct_url", F.col("reviewed_url")).otherwise(tracked))
    error = F.when(F.col("observed").isNull(), "missing_observation").when((F.col("mode") != "direct_url") & revision.isNull(), "no_revision").when(url.isNull(), "no_url")
    return rows.select("source_id", F.col("mode").alias("fetch_mode"), "reviewed_revision", revision.alias("resolved_revision"), url.alias("resolved_fetch_url"), error.alias("error"))


def failure_reasons(discarded: DataFrame, vod: DataFrame, live: DataFrame) -> DataFrame:
    """(kind, failure_reason) of every entity that has one."""
    part = lambda df, kind: df.where("failure_reason is not null").select(F.lit(kind).alias("kind"), "failure_reason")
    return part(discarded, "discarded").unionByName(part(vod, "vod")).unionByName(part(live, "live"))


def gate_payload(decision: DataFrame, inputs: list[str], thresholds: list[str]) -> DataFrame:
    """A decision row as the report's gate object: reasons, inputs and thresholds as structs."""
    return decision.select("release_kind", (F.size("reasons") == 0).alias("publish"), "reasons", F.struct(*inputs).alias("inputs"), F.struct(*thresholds).alias("thresholds"))


def retained(previous: DataFrame, removed: DataFrame, dependents: DataFrame) -> DataFrame:
    """Ids (id) of the previous release that neither must go nor depend on one that must."""
    gone = removed.select("id").unionByName(dependents.select("id")).distinct()
    return previous.select("id").distinct().join(gone, "id", "left_anti")


def mandatory_removals(previous: DataFrame, rights: DataFrame, failures: DataFrame, entities: DataFrame) -> DataFrame:
    """(id, historical): what a safety release must take out of the previous one (source_id, entity_id).

    Sources of barred rights (``rights``: source_id), of changed terms or security failures (``failures``: source_id,
    failure_reason) go with all their entities; entities with a security failure of their own (``entities``: entity_id,
    failure_reason) go alone.  Only what the previous release holds is named.  Historical ones are searched in older
    releases too: all but sources of changed terms and the entities that only follow their source.
    """
    known = previous.select("source_id").distinct()
    why = rights.select("source_id", F.lit(True).alias("_h")).unionByName(
        failures.where(F.col("failure_reason").isin("terms_changed", *SECURITY)).select("source_id", F.col("failure_reason").isin(SECURITY).alias("_h"))
    )
    sources = why.groupBy("source_id").agg(F.bool_or("_h").alias("historical")).join(known, "source_id", "left_semi")
    own = sources.select(F.concat(F.lit("source:"), "source_id").alias("id"), "historical")
    children = previous.join(sources, "source_id", "left_semi").select(F.col("entity_id").alias("id"), F.lit(False).alias("historical"))
    unsafe = entities.where(F.col("failure_reason").isin(SECURITY)).select("entity_id").distinct().join(previous.select("entity_id").distinct(), "entity_id", "left_semi")
    alone = unsafe.select(F.col("entity_id").alias("id"), F.lit(True).alias("historical"))
    return own.unionByName(children).unionByName(alone).groupBy("id").agg(F.bool_or("historical").alias("historical"))


def removal_leaks(mandatory: DataFrame, sources: DataFrame, entities: DataFrame) -> DataFrame:
    """Ids that had to go and still stand among a payload's sources (source_id) or entities (entity_id)."""
    there = sources.select(F.concat(F.lit("source:"), "source_id").alias("id")).unionByName(entities.select(F.col("entity_id").alias("id"))).distinct()
    return mandatory.select("id").distinct().join(there, "id", "left_semi")


def tree_paths(trees: DataFrame) -> DataFrame:
    """Files of recorded trees (source_id, body): one row a path, with its place in byte order; a truncated or unreadable tree
    has one row with the reason instead, never a part of its paths."""
    schema = "tree array<struct<path:string,type:string,sha:string,size:long>>, truncated boolean"
    rows = trees.withColumn("t", F.from_json(F.col("body"), schema))
    bad = F.exists("t.tree", lambda e: ~F.coalesce(e["sha"].rlike("^[0-9a-f]{40}$") & ~e["path"].rlike(r"^/|\\|(^|/)\.{0,2}(/|$)"), F.lit(False)))
    why = F.when(F.col("t.tree").isNull(), "schema_incompatible").when(F.col("t.truncated"), "catalog_limit_exceeded").when(bad, "schema_incompatible")
    rows = rows.select("source_id", why.alias("failure_reason"), F.when(why.isNull(), F.array_sort(F.transform(F.filter("t.tree", lambda e: e["type"] == "blob"), lambda e: e["path"]))).alias("paths"))
    return rows.select("source_id", "failure_reason", F.posexplode_outer("paths").alias("ordinal", "path"))


def commit_facts(body: Column) -> Column:
    """(sha, tree) of a recorded commit document; null where either isn't a full id."""
    c = F.from_json(body, "sha string, commit struct<tree:struct<sha:string>>")
    good = c["sha"].rlike("^[0-9a-f]{40}$") & c["commit"]["tree"]["sha"].rlike("^[0-9a-f]{40}$")
    return F.when(good, F.struct(c["sha"].alias("sha"), c["commit"]["tree"]["sha"].alias("tree")))
