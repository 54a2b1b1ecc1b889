"""Fetched responses: where bodies come from, and what is decided about them before they are parsed."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftspark.functions import urls
from siftspark.functions.policy import http_reason

#: Bytes a response may have, by what it is; fixed values.
LIMITS = {"config": 5 << 20, "playlist": 10 << 20, "hls": 2 << 20, "media": 1 << 20, "terms": 1 << 20}


class Fetcher(Protocol):
    """What a probe asks for a URL; given to the executors, so it must pickle."""

    def fetch(self, url: str, with_headers: bool = False) -> dict: ...


@dataclass
class Recorded:
    """Responses that were recorded before, by URL and whether declared headers were sent."""

    responses: dict = field(default_factory=dict)

    def fetch(self, url: str, with_headers: bool = False) -> dict:
        return self.responses.get((url, with_headers)) or {"status": None, "body": b"", "final_url": url, "elapsed_ms": 0, "error": "dns_failure"}


def reason(kind: str, context: str = "probe") -> Column:
    """Why a response can't be used: its error, its status, its size; null if it can."""
    status = F.col("status")
    return (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(status.isNull(), "fetch_timeout")
        .when((status < 200) | (status >= 300), http_reason(status, context))
        .when(F.octet_length("body") > LIMITS[kind], "response_too_large")
    )


def changed_terms(sources: DataFrame, responses: DataFrame) -> DataFrame:
    """(id, changed) per source: whether any watched document's hash isn't the reviewed one, or it can't be read."""
    watched = sources.select("id", F.explode("terms_watch").alias("t")).select("id", F.coalesce("t.url", "t.path").alias("url"), "t.reviewed_sha256")
    body = responses.where("not with_headers").select("url", F.sha2("body", 256).alias("now"), (F.col("status") == 200).alias("ok"))
    joined = watched.join(body, "url", "left")
    same = F.coalesce(F.col("ok") & (F.col("now") == F.col("reviewed_sha256")), F.lit(False))
    return joined.groupBy("id").agg(F.bool_or(~same).alias("changed"))


#: Where files of a repository are served as they are; a fixed value.
RAW_FILES = "https://raw.githubusercontent.com"


def address() -> Column:
    """Where a source's content is read: its reviewed address, or its tracked file at the reviewed revision; null for whole repositories,
    which a crawl reads."""
    name = F.regexp_extract("fetch.repository_url", r"^https://[^/]+/([^/]+/[^/]+?)(?:\.git)?/?$", 1)
    file = urls.raw_file_url(RAW_FILES, name, F.col("fetch.reviewed_revision"), F.col("fetch.config_path"))
    whole = (name != "") & F.col("fetch.reviewed_revision").isNotNull() & F.col("fetch.config_path").isNotNull()
    return F.when(F.col("fetch.mode") == "github_tracked_file", F.when(whole, file)).when(F.col("fetch.mode") == "direct_url", F.col("fetch.reviewed_url"))


def fetched(sources: DataFrame, responses: DataFrame) -> DataFrame:
    """Sources with their content: terms first, restricted ones never read."""
    terms = changed_terms(sources, responses)
    body = responses.where("not with_headers").select("url", "status", "body", "error")
    rows = sources.withColumn("_address", address()).join(terms, "id", "left").join(body, F.col("_address") == body["url"], "left")
    barred = F.when(F.col("rights_status") == "takedown", "takedown").when(F.col("rights_status") == "restricted", "rights_restricted").when(F.coalesce("changed", F.lit(False)), "terms_changed")
    why = F.coalesce(barred, reason("config", "upstream"))
    return rows.select(F.col("id").alias("source_id"), "parser", F.when(why.isNull(), F.col("body")).alias("content"), why.alias("failure_reason"))
