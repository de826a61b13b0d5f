"""Command line: prepare, plan, run-shard, consolidate, build and smoke-test."""

from __future__ import annotations

import argparse
import importlib
import json
import os
from pathlib import Path
from typing import Any

from pyspark.sql import SparkSession

from lodeweave.plans import config, shards
from lodeweave.plans.prepare import prepare

CONFIG = "LODEWEAVE_CONFIG"


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lodeweave", description="Build, check and release a parallel speech corpus.")
    p.add_argument("--config", type=Path, default=os.environ.get(CONFIG), help=f"settings; ${CONFIG} by default")
    p.add_argument("--backend", help="module:function that makes the speech backend; only smoke-test has one of its own, of tones")
    sub = p.add_subparsers(dest="command", required=True)
    for name, what in (("prepare", "archives to manifest"), ("plan", "shard sizes and storage"), ("build", "everything, going on where a run broke off"), ("smoke-test", "everything, with a few pairs")):
        sub.add_parser(name, help=what)
    sub.add_parser("run-shard", help="speak and check one shard").add_argument("--shard-index", type=int, required=True)
    sub.add_parser("consolidate", help="make a release").add_argument("--allow-incomplete", action="store_true")
    return p


def _backend(name: str | None, trial: bool = False) -> Any:
    if name is None and not trial:
        raise ValueError("--backend must name a speech backend")
    name = name or "lodeweave.backends:tone_backend"
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)()


def run(spark: SparkSession, args: argparse.Namespace, c: Any) -> dict[str, Any]:
    """What a command gives."""
    if args.command == "prepare":
        return prepare(spark, c)
    if args.command == "plan":
        return shards.plan(spark, c)
    if args.command == "run-shard":
        return shards.run(spark, c, _backend(args.backend), args.shard_index)
    if args.command == "consolidate":
        return shards.consolidate(spark, c, args.allow_incomplete)
    backend = _backend(args.backend, args.command == "smoke-test")
    done: dict[str, Any] = {"preparation": prepare(spark, c)}
    if args.command == "smoke-test":
        done["selection"] = shards.trial_manifest(spark, c)
        c = config.trial_settings(c)
    done["plan"] = shards.plan(spark, c)
    for limit, what in (("within_pair_limit", "run.max_pairs_per_shard"), ("within_audio_budget", "run.maximum_output_gib")):
        if args.command == "build" and not done["plan"][limit]:
            raise ValueError(f"the manifest is too large for {what}")
    shards.room(spark, c.run.output_dir, c.run.minimum_free_gib)
    shards.run(spark, c, backend)
    done["release"] = shards.consolidate(spark, c)
    if args.command == "smoke-test":
        done["release"]["all_pairs_accepted"] = done["release"]["accepted_pairs"] == c.run.max_pairs_per_shard
    return done


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    if args.config is None:
        raise SystemExit(f"--config or ${CONFIG} must name a file")
    spark = SparkSession.builder.appName("lodeweave").getOrCreate()
    print(json.dumps(run(spark, args, config.load(Path(args.config))), ensure_ascii=False, indent=2, sort_keys=True))


if __name__ == "__main__":
    main()
