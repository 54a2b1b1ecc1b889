"""Client configurations and catalogues as rows: sites, lives, nested configurations, and what is wrong with each entry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftspark.functions import headers, ids, urls
from siftspark.operators import parse


def _text(v: Column, path: str) -> Column:
    """A string that isn't blank, trimmed; null for any other value."""
    is_text = F.schema_of_variant(F.try_variant_get(v, path, "variant")) == "STRING"
    return F.when(is_text, F.nullif(F.trim(F.try_variant_get(v, path, "string")), F.lit("")))


def _whole(v: Column, path: str) -> Column:
    """An integer; null for booleans and anything else."""
    return F.when(F.schema_of_variant(F.try_variant_get(v, path, "variant")) == "BIGINT", F.try_variant_get(v, path, "int"))


def _array(documents: DataFrame, path: str) -> DataFrame:
    items = F.try_variant_get("v", path, "array<variant>")
    return documents.select("source_id", "base_url", F.posexplode(items).alias("ordinal", "item"))


_CATEGORIES = "array<string>"


def read(documents: DataFrame, relaxed: bool = False) -> DataFrame:
    """(source_id, kind, ordinal, key, name, type, url, categories, executable, issue) of configurations in JSON.

    An entry's faults stay with it.  A document that isn't JSON, repeats a key of an object, or repeats a site's key, gives one
    row of kind ``document`` with the reason.  ``documents`` has source_id, content (text) and base_url.
    """
    text = parse.json5("content") if relaxed else F.col("content")
    parsed = documents.select("source_id", "base_url", F.try_parse_json(text).alias("v"))
    bad = parsed.where("v is null").select("source_id", F.lit("document").alias("kind"), F.lit("invalid_json").alias("issue"))
    good = parsed.where("v is not null")
    sites = _array(good, "$.sites").select(
        "source_id", "ordinal", F.lit("site").alias("kind"), _text(F.col("item"), "$.key").alias("key"), _text(F.col("item"), "$.name").alias("name"), _whole(F.col("item"), "$.type").alias("type"),
        urls.joined("base_url", _text(F.col("item"), "$.api")).alias("url"), F.try_variant_get("item", "$.categories", _CATEGORIES).alias("categories"),
        F.try_variant_get("item", "$.header", "map<string,string>").alias("headers"), F.to_json("item").alias("raw"),
    )
    wrong = F.col("key").isNull() | F.col("name").isNull() | F.col("url").isNull() | ~F.coalesce(F.col("type").isin(0, 1, 3, 4), F.lit(False)) | F.exists(F.coalesce("categories", F.array().cast(_CATEGORIES)), lambda c: c.isNull() | (F.trim(c) == ""))
    executable = F.col("raw").rlike(r'(?i)"(jar|spider)"\s*:|\.(jar|js|py|dex|so)("|[?#])')
    sites = sites.withColumn("issue", F.when(wrong, "schema_incompatible").otherwise(headers.issue(F.col("headers")))).withColumn("executable", executable).drop("headers", "raw")

    def named(path: str, kind: str, name: str, url: str, typed: bool = False) -> DataFrame:
        rows = _array(good, path).select("source_id", "ordinal", F.lit(kind).alias("kind"), _text(F.col("item"), name).alias("name"), urls.joined("base_url", _text(F.col("item"), url)).alias("url"), _whole(F.col("item"), "$.type").alias("type"))
        missing = F.col("name").isNull() | F.col("url").isNull() | (F.col("type").isNull() if typed else F.lit(False))
        return rows.withColumn("issue", F.when(missing, "schema_incompatible"))

    rows = sites
    for more in (named("$.lives", "live", "$.name", "$.url", True), named("$.urls", "depot", "$.name", "$.url"), named("$.storeHouse", "store", "$.sourceName", "$.sourceUrl"), bad):
        rows = rows.unionByName(more, allowMissingColumns=True)
    twice = rows.where("kind = 'site' and key is not null").groupBy("source_id", "key").count().where("count > 1").select("source_id").distinct()
    failed = twice.select("source_id", F.lit("document").alias("kind"), F.lit("schema_incompatible").alias("issue"))
    return rows.join(twice, "source_id", "left_anti").unionByName(failed, allowMissingColumns=True)


def catalogue_candidates(entries: DataFrame) -> DataFrame:
    """Candidates of a crawl: one a kind and target, the first by place, with all evidence and the reasons that differ.

    ``entries`` has source_id, path, ordinal, kind, type, url, executable and issue.  Targets that may not be shown are hashed.
    """
    kind = F.when(F.col("kind") == "site", "vod_site").when(F.col("kind") == "entry", "live_url").otherwise("nested_config")
    refused = urls.structural_reason(F.col("url"))
    why = F.when(F.col("issue").isNotNull(), F.col("issue")).when((F.col("type") == 3) | F.coalesce("executable", F.lit(False)), "unsupported_spider").otherwise(refused)
    target = F.when(refused.isNull() & F.col("url").isNotNull(), urls.normal_url(F.col("url"))).otherwise(F.concat(F.lit("rejected:"), F.sha2(F.coalesce("url", F.lit("")), 256)))
    rows = entries.select("source_id", "path", "ordinal", kind.alias("kind"), F.col("type").cast("string").alias("type"), target.alias("target"), why.alias("reason"))
    identity = F.when(F.col("kind") == "vod_site", F.concat_ws("\u0000", F.coalesce("type", F.lit("")), "target")).otherwise(F.col("target"))
    rows = rows.withColumn("candidate_id", ids.candidate_id(F.col("source_id"), F.col("kind"), identity))
    place = F.struct("path", "ordinal")
    found = rows.groupBy("source_id", "candidate_id").agg(
        F.min_by("kind", place).alias("kind"), F.min_by("target", place).alias("target"), F.min_by(F.coalesce("reason", F.lit("")), place).alias("_first"),
        F.array_sort(F.collect_set(F.concat_ws("#", "path", F.col("ordinal").cast("string")))).alias("evidence"), F.array_sort(F.collect_set("reason")).alias("_all"),
    )
    return found.select("source_id", "candidate_id", "kind", "target", F.nullif(F.col("_first"), F.lit("")).alias("failure_reason"), F.array_remove("_all", F.col("_first")).alias("secondary_reasons"), "evidence")


def within_limits(candidates: DataFrame, limit: int) -> DataFrame:
    """The candidates with their source's outcome: beyond the limit it is unknown, and nothing is cut."""
    count = F.count("*").over(Window.partitionBy("source_id"))
    return candidates.withColumn("technical_status", F.when(count > limit, "unknown").otherwise("healthy")).withColumn("outcome", F.when(count > limit, "catalog_limit_exceeded").otherwise("ok"))
