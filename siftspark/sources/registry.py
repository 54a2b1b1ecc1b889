"""The registry of sources: strict YAML, typed rows, and what is wrong with them as rows."""

from __future__ import annotations

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark import schemas as S
from siftspark.functions import urls

#: Which parsers and fetch modes a kind of source may have; fixed values.
LEGAL = {
    "vod_site": (["maccms_json", "maccms_xml"], ["direct_url"]),
    "vod_config": (["tvbox_json", "tvbox_json5"], ["direct_url", "github_tracked_file"]),
    "live_playlist": (["m3u", "txt_live"], ["direct_url", "github_tracked_file"]),
    "repository_catalog": (["repository_catalog"], ["github_repository"]),
}


class _Strict(yaml.SafeLoader):
    """Repeated keys are errors; dates stay text."""


_Strict.yaml_implicit_resolvers = {k: [(tag, r) for tag, r in v if tag != "tag:yaml.org,2002:timestamp"] for k, v in yaml.SafeLoader.yaml_implicit_resolvers.items()}


def _mapping(loader: _Strict, node: yaml.MappingNode, deep: bool = False) -> dict:
    out: dict = {}
    for key_node, value_node in node.value:
        key = loader.construct_object(key_node, deep=True)
        if key in out:
            raise ValueError(f"repeated key {key!r}")
        out[key] = loader.construct_object(value_node, deep=True)
    return out


_Strict.add_constructor(yaml.resolver.BaseResolver.DEFAULT_MAPPING_TAG, _mapping)


def load_yaml(text: str) -> object:
    if text.startswith("﻿"):
        text = text[1:]
    return yaml.load(text, _Strict)  # noqa: S506  a safe loader


def registry(spark: SparkSession, text: str) -> DataFrame:
    """The sources of a registry document; a few rows by nature, read on the driver."""
    document = load_yaml(text)
    names = [f.split(":")[0].split()[0] for f in _fields(S.SOURCES)]
    rows = [{n: s.get(n) for n in names} for s in document["sources"]]
    return spark.createDataFrame(rows, S.SOURCES)


def _fields(ddl: str) -> list[str]:
    out, depth, last = [], 0, ""
    for c in ddl:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(last.strip())
            last = ""
        else:
            last += c
    return [*out, last.strip()]


def violations(sources: DataFrame) -> DataFrame:
    """(id, rule) of every rule that a source breaks; none for a valid registry."""
    f = F.col
    legal = F.lit(False)
    for kind, (parsers, modes) in LEGAL.items():
        legal = legal | ((f("kind") == kind) & f("parser").isin(parsers) & f("fetch.mode").isin(modes))
    git = f("fetch.mode").isin("github_tracked_file", "github_repository")
    paths = F.transform(F.filter("terms_watch", lambda t: t["type"] == "github_path"), lambda t: F.lower(F.element_at(F.split(t["path"], "/"), -1)))
    rules = {
        "illegal_combination": ~F.coalesce(legal, F.lit(False)),
        "bad_rights": ~f("rights_status").isin(S.RIGHTS),
        "direct_needs_url_alone": (f("fetch.mode") == "direct_url") & (f("fetch.reviewed_url").isNull() | f("fetch.repository_url").isNotNull() | f("fetch.track_ref").isNotNull()),
        "bad_revision": git & ~F.coalesce(f("fetch.reviewed_revision").rlike("^[0-9a-f]{40}$"), F.lit(False)),
        "bad_ref": git & ~F.coalesce(f("fetch.track_ref").rlike("^[A-Za-z0-9][A-Za-z0-9._/-]*$") & ~f("fetch.track_ref").rlike(r"\.\.|//|\.lock$|@\{"), F.lit(False)),
        "unsafe_path": f("fetch.config_path").rlike(r"^/|(^|/)\.\.?(/|$)|\\"),
        "url_refused": F.coalesce(urls.structural_reason(f("fetch.reviewed_url"), False).isNotNull(), F.lit(False)) & f("fetch.reviewed_url").isNotNull(),
        "host_not_allowed": f("fetch.reviewed_url").isNotNull() & ~F.array_contains("allowed_hosts", urls.host(f("fetch.reviewed_url"))),
        "repeated_host": F.size("allowed_hosts") != F.size(F.array_distinct(F.transform("allowed_hosts", F.lower))),
        "site_needs_client": (f("kind") == "vod_site") != f("client_site").isNotNull(),
        "unwatched_license": git & ~F.exists(paths, lambda p: p.rlike("^(license|copying)")),
        "unwatched_terms": git & ~F.exists(paths, lambda p: p.rlike("readme|term")),
        "repeated_terms": F.size("terms_watch") != F.size(F.array_distinct(F.transform("terms_watch", lambda t: F.struct(t["type"], t["url"], t["path"])))),
    }
    broken = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in rules.items()]))
    own = sources.select("id", F.explode(broken).alias("rule"))
    return own.unionByName(sources.groupBy("id").count().where("count > 1").select("id", F.lit("repeated_id").alias("rule")))


def denylist(spark: SparkSession, text: str) -> DataFrame:
    return spark.createDataFrame([{n: e.get(n) for n in [f.split()[0] for f in _fields(S.DENYLIST)]} for e in load_yaml(text)["entries"]], S.DENYLIST)


def denied_parts(entries: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The ids, hosts and URLs of a denylist as three one-column tables."""
    part = lambda c, name: entries.select(F.explode(c).alias(name)).distinct()
    return part("source_ids", "source_id"), part("hosts", "host"), part("urls", "url")
