"""Command line: validate a registry, decide whether a run is due, run it on recorded responses, verify a release."""

from __future__ import annotations

import argparse
import json
import re
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.functions.policy import due_decision
from siftspark.plans import run
from siftspark.session import local_session
from siftspark.sinks.artifacts import Releases, inventory
from siftspark.sources import registry
from siftspark.validate import release


def collected(spark: SparkSession, args: argparse.Namespace) -> dict:
    """A run on the state of the release that the pointer names, whose own state is kept with its release."""
    releases = Releases(args.releases, spark)
    pointer = releases.current()
    kept = releases.state(pointer["release"]) if pointer else None
    before = spark.read.parquet(kept) if kept else None  # a state that the log names and that is gone is an error
    denied = registry.denylist(spark, Path(args.denylist).read_text()) if args.denylist else None
    observed = releases.store.place("observed/" + re.sub("[^0-9A-Za-z]", "-", args.checked_at))
    return run.collect(spark, Path(args.registry).read_text(), spark.read.parquet(args.responses), before, releases, args.checked_at, place=observed, denied=denied)


def artifact_violations(spark: SparkSession, releases: Releases, name: str, cap: int) -> DataFrame:
    """What of a release's files isn't as its manifest says; sizes are only bounded in total."""
    place = f"releases/{name}"
    declared = json.loads(releases.store.read(f"{place}/manifest.json"))
    files = inventory(spark, releases.store.place(place)).withColumn("path", F.substring_index("path", f"/releases/{name}/", -1)).where("path <> 'manifest.json'").withColumn("sha256", F.concat(F.lit("sha256:"), "sha256"))
    known = spark.createDataFrame(list(declared.items()), "path string, sha256 string")
    sized = known.join(files.select("path", "size"), "path", "left").select("path", "size", "sha256")
    return release.inventory(sized, files, cap)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="siftspark")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("validate-static").add_argument("registry")
    due = commands.add_parser("due-check")
    for name in ("now", "last_success", "kind"):
        due.add_argument(f"--{name}", required=name != "kind", default="regular")
    due.add_argument("--force", action="store_true")
    collect = commands.add_parser("collect")
    for name in ("registry", "responses", "releases", "checked_at"):
        collect.add_argument(name)
    collect.add_argument("--denylist")
    verify = commands.add_parser("verify-release")
    verify.add_argument("releases")
    verify.add_argument("release")
    artifact = commands.add_parser("verify-artifact")
    artifact.add_argument("releases")
    artifact.add_argument("release")
    artifact.add_argument("--cap", type=int, default=200 << 20)
    publish = commands.add_parser("publish")
    publish.add_argument("releases")
    publish.add_argument("release")
    args = parser.parse_args(argv)
    try:
        spark = local_session(4, 4, "siftspark")
        if args.command == "verify-release":
            return 0 if Releases(args.releases, spark).verified(args.release) else 1
        if args.command == "publish":
            releases = Releases(args.releases, spark)
            return 0 if releases.promote(args.release, releases.current()) else 1
        if args.command == "verify-artifact":
            broken = artifact_violations(spark, Releases(args.releases, spark), args.release, args.cap).collect()
            print("\n".join(f"{r['key']}: {r['rule']}" for r in broken) or "valid")
            return int(bool(broken))
        if args.command == "validate-static":
            broken = registry.violations(registry.registry(spark, Path(args.registry).read_text())).collect()
            print("\n".join(f"{r['id']}: {r['rule']}" for r in broken) or "valid")
            return int(bool(broken))
        if args.command == "due-check":
            ts = lambda v: F.lit(v).cast("timestamp")
            decision = spark.range(1).select(due_decision(ts(args.now), ts(args.last_success), F.lit(args.kind), F.lit(args.force)).alias("d")).first()["d"]
            print(json.dumps({"should_refresh": decision != "not_due", "reason": decision}))
            return 0
        out = collected(spark, args)
        print(json.dumps({k: v for k, v in out.items() if k not in ("items", "state")}, ensure_ascii=False))
        return 0 if out["published"] else 1
    except (OSError, ValueError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
