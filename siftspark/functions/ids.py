"""Identities of entities, by hashes of their normalised parts."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def sha16(c: Column) -> Column:
    return F.substring(F.sha2(c, 256), 1, 16)


@F.pandas_udf(T.StringType())
def nfkc(values: pd.Series) -> pd.Series:
    """NFKC and stripped; the one part of names that Spark has no function for."""
    return values.map(lambda x: unicodedata.normalize("NFKC", x).strip(), na_action="ignore")


@F.pandas_udf(T.StringType())
def one_spaced(values: pd.Series) -> pd.Series:
    return values.map(lambda x: " ".join(unicodedata.normalize("NFKC", x).split()), na_action="ignore")


def source_id(source: Column) -> Column:
    return F.concat(F.lit("source:"), source)


def vod_id(source: Column, site_type: Column, api: Column) -> Column:
    return F.concat(F.lit("vod:"), source, F.lit(":"), sha16(F.concat(site_type.cast("string"), api)))


def live_url_id(source: Column, url: Column) -> Column:
    return F.concat(F.lit("live-url:"), source, F.lit(":"), sha16(url))


def channel_key(tvg_id: Column, source: Column, name: Column) -> Column:
    """What a channel is identified by, of normalised parts: its guide id, else its name within the source."""
    own = F.nullif(tvg_id, F.lit(""))
    return F.when(own.isNotNull(), F.concat(F.lit("tvg:"), own)).when(F.length(name) > 0, F.concat(F.lit("local:"), source, F.lit(":"), name))


def channel_id(key: Column) -> Column:
    return F.concat(F.lit("channel:"), sha16(key))


def candidate_id(source: Column, kind: Column, identity: Column) -> Column:
    return F.concat(F.lit("candidate:"), source, F.lit(":"), sha16(F.concat_ws("\u0000", kind, identity)))


def client_suffix(source: Column, site_type: Column, api: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("\u0000", source, site_type.cast("string"), api), 256), 1, 8)


def release_id(generation: Column) -> Column:
    return F.format_string("g%08d", generation)
