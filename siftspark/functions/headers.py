"""Declared request headers: which may be, how they are written behind URLs, and how they merge."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftspark.functions import urls

#: The headers that a source may declare, by their lower-case names; fixed values.
ALLOWED = {"user-agent": "User-Agent", "referer": "Referer", "origin": "Origin", "accept": "Accept", "accept-language": "Accept-Language"}
VALUE_BYTES, BLOCK_BYTES = 1024, 4096


def canonical(headers: Column) -> Column:
    """Header names as they are written; null for one that isn't allowed."""
    names = F.create_map(*[F.lit(x) for pair in ALLOWED.items() for x in pair])
    return F.transform(F.map_entries(headers), lambda e: F.struct(names[F.lower(e["key"])].alias("key"), e["value"].alias("value")))


def issue(headers: Column) -> Column:
    """What is wrong with a map of headers; null if nothing is."""
    entries = canonical(headers)
    sizes = F.aggregate(entries, F.lit(0), lambda a, e: a + F.octet_length(e["key"]) + F.octet_length(e["value"]))
    addressed = F.filter(entries, lambda e: e["key"].isin("Referer", "Origin"))
    return (
        F.when(F.exists(F.map_entries(headers), lambda e: e["key"].rlike(r"[\x00\r\n]") | e["value"].rlike(r"[\x00\r\n]")), "invalid_header_syntax")
        .when(F.exists(entries, lambda e: e["key"].isNull()), "credential_header_rejected")
        .when(F.size(F.array_distinct(F.transform(entries, lambda e: e["key"]))) < F.size(entries), "invalid_header_syntax")
        .when(F.exists(entries, lambda e: F.octet_length(e["value"]) > VALUE_BYTES) | (sizes > BLOCK_BYTES), "credential_header_rejected")
        .when(F.exists(addressed, lambda e: urls.structural_reason(e["value"], False).isNotNull()), "credential_header_rejected")
    )


def behind_url(text: Column) -> Column:
    """``URL|Name=Value&…`` as struct of url, headers and issue."""
    parts = F.split(text, r"\|")
    pairs = F.split(F.get(parts, F.lit(1)), "&")
    bad = F.exists(pairs, lambda p: ~p.contains("="))
    decode = lambda x: F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B")))
    entries = F.transform(pairs, lambda p: F.struct(decode(F.substring_index(p, "=", 1)).alias("key"), decode(F.regexp_replace(p, "^[^=]*=", "")).alias("value")))
    names = F.transform(entries, lambda e: e["key"])
    wrong = (F.size(parts) > 2) | bad | F.exists(entries, lambda e: e["key"].isNull() | e["value"].isNull()) | (F.size(F.array_distinct(names)) < F.size(names))
    has = F.size(parts) > 1
    return F.struct(
        F.trim(F.get(parts, F.lit(0))).alias("url"),
        F.when(has & ~F.coalesce(wrong, F.lit(True)), F.map_from_entries(entries)).alias("headers"),
        F.when(has & F.coalesce(wrong, F.lit(True)), "invalid_header_syntax").alias("issue"),
    )


def collide(a: Column, b: Column) -> Column:
    """Whether two declarations name one header."""
    lowered = lambda m: F.transform(F.map_keys(m), F.lower)
    return F.coalesce(F.arrays_overlap(lowered(a), lowered(b)), F.lit(False))
