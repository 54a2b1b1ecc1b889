"""Client documents of a release: one configuration a source, the stable one, index, depots and warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark import schemas as S
from siftspark.functions.policy import rank, warned
from siftspark.sinks.artifacts import canonical

#: Names of the pinned lines; fixed values.
STABLE_LINE, STABLE_STORE, RISK_STORE, LIVE_LINE = "DS 稳定聚合", "DS 稳定仓", "DS 公共实验仓", "DS 稳定直播"
_RIGHTS = ["verified", "open_license", "public_unverified"]


def lines(sites: DataFrame) -> DataFrame:
    """One line a source: its best publication, whether anything is stable, and its name, unique and warned once."""
    place = rank(F.col("publication_status"), S.PUBLICATION_ROLLUP)
    rows = sites.groupBy("source_id").agg(F.min(place).alias("publication_rank"), F.bool_or(F.col("publication_status") == "stable").alias("has_stable"), F.first("rights_status").alias("rights_status"))
    name = warned(F.concat(F.lit("DS "), "source_id"), F.col("rights_status") == "public_unverified")
    return rows.withColumn("rights_rank", rank(F.col("rights_status"), _RIGHTS)).withColumn("name", name)


def _documents(sites: list, live: list) -> dict:
    return {"sites": [{k: v for k, v in s.items() if k not in ("source_id", "publication_status", "rights_status") and (k != "categories" or v)} for s in sites], "lives": live, "parses": []}


def files(sites: DataFrame, base: str, live_count: int) -> dict[str, bytes]:
    """All documents by path.  A release's sites are few by contract; they are put in order by Spark and written here.

    ``sites`` has source_id, key, name, type, api, searchable, quickSearch, filterable, changeable, categories,
    publication_status and rights_status, winners alone, keys already unique.
    """
    live = [{"name": LIVE_LINE, "type": 0, "url": f"{base}/live/stable.m3u"}] if live_count else []
    rows = [r.asDict() for r in sites.orderBy("source_id", "key").toLocalIterator()]
    ranked = lines(sites)
    line = lambda r: {"name": r["name"], "url": f"{base}/configs/{r['source_id']}.json"}
    pinned = {"name": STABLE_LINE, "url": f"{base}/configs/stable.json"}
    index = [line(r) for r in ranked.orderBy("publication_rank", "rights_rank", "source_id").collect()]
    stable = [line(r) for r in ranked.where("has_stable").orderBy("rights_rank", "source_id").collect()]
    risk = [line(r) for r in ranked.where("rights_status = 'public_unverified'").orderBy("publication_rank", "source_id").collect()]
    out = {f"configs/{s}.json": _documents([r for r in rows if r["source_id"] == s], live) for s in sorted({r["source_id"] for r in rows})}
    out |= {
        "configs/stable.json": _documents([r for r in rows if r["publication_status"] == "stable"], live),
        "index.json": {"urls": [pinned, *index]}, "depots/stable.json": {"urls": [pinned, *stable]}, "depots/public-unverified.json": {"urls": risk},
        "warehouse.json": {"storeHouse": [{"sourceName": STABLE_STORE, "sourceUrl": f"{base}/depots/stable.json"}, {"sourceName": RISK_STORE, "sourceUrl": f"{base}/depots/public-unverified.json"}]},
    }
    return {path: canonical(document) for path, document in sorted(out.items())}


def unreferenced(documents: dict[str, bytes], base: str) -> list[str]:
    """Configurations that no index names, and names without a configuration: a closed release has neither."""
    import json

    named = {u["url"].removeprefix(f"{base}/") for d in ("index.json", "depots/stable.json", "depots/public-unverified.json") for u in json.loads(documents[d])["urls"]}
    return sorted(named ^ {p for p in documents if p.startswith("configs/")})
