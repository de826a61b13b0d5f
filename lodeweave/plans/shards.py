"""From a manifest to a release: plan, speak and check shard by shard or all at once, put together."""

from __future__ import annotations

import hashlib
import json
import shutil
from dataclasses import asdict
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeweave.backends import Backend, generated, heard
from lodeweave.functions import ids, rates
from lodeweave.functions import text as X
from lodeweave.operators import attempts, manifest, release, samples
from lodeweave.scratch import written
from lodeweave.sources import manifests, sinks

GIB = 2**30


def room(spark: SparkSession, folder: Path, gib: float) -> None:
    """ValueError unless what a folder holds and what is free beside it come to so much."""
    folder.mkdir(parents=True, exist_ok=True)
    have = (manifests.stored_bytes(spark, str(folder)) + shutil.disk_usage(folder).free) / GIB
    if have < gib:
        raise ValueError(f"{folder}: {have:.1f} GiB are there or free, {gib:.1f} GiB are needed")


def accelerator(c: Any) -> dict[str, Any]:
    """What the machine offers; ValueError where it isn't what the settings require."""
    try:
        import torch
    except ModuleNotFoundError as e:
        raise ValueError("the settings require CUDA, and there is no library for it") from e
    if not torch.cuda.is_available():
        raise ValueError("the settings require CUDA")
    gpu = torch.cuda.get_device_properties(0)
    if gpu.total_memory / GIB < c.device.minimum_vram_gib:
        raise ValueError(f"the GPU has {gpu.total_memory / GIB:.2f} GiB, {c.device.minimum_vram_gib:.2f} GiB are needed")
    if c.device.require_bf16 and not torch.cuda.is_bf16_supported():
        raise ValueError("the settings require BF16")
    return {"gpu": gpu.name, "vram_gib": round(gpu.total_memory / GIB, 2), "torch": torch.__version__}


def within_limit(spark: SparkSession, c: Any) -> None:
    used = manifests.stored_bytes(spark, str(c.run.output_dir)) / GIB
    if used > c.run.maximum_output_gib:
        raise ValueError(f"the output takes {used:.2f} GiB, more than {c.run.maximum_output_gib:.2f} GiB")


def plan(spark: SparkSession, c: Any) -> dict[str, Any]:
    """Shard sizes, counts and storage of a manifest, and whether they keep to the limits."""
    rows = manifests.read_manifest(spark, str(c.run.input_jsonl))
    total = manifest.shard_plan(rows, c.run.num_shards).first().asDict()
    counts: dict[str, dict[str, int]] = {"corpus": {}, "split": {}}
    for r in manifest.value_counts(rows).orderBy("value").collect():
        counts[r.field][r.value] = r.pairs
    per = [r.pairs for r in manifest.shard_counts(rows, c.run.num_shards).orderBy("shard").collect()]
    gib = ids.pcm16_gib(c.run.expected_hours_per_language, retries=c.run.retry_storage_fraction)
    return total | {
        "corpora": counts["corpus"], "splits": counts["split"], "shard_counts": per, "input_jsonl": str(c.run.input_jsonl), "output_dir": str(c.run.output_dir), "save_native": c.run.save_native,
        "expected_hours_per_language": c.run.expected_hours_per_language, "canonical_audio_gib_with_retry_allowance": round(gib, 2), "maximum_output_gib": c.run.maximum_output_gib,
        "within_pair_limit": total["maximum_pairs_per_shard"] <= c.run.max_pairs_per_shard, "within_audio_budget": gib <= c.run.maximum_output_gib,
    }


def settings_hash(c: Any) -> str:
    """Of the settings that decide what a finished shard holds."""
    return hashlib.sha256(json.dumps({k: asdict(getattr(c, k)) for k in ("asr", "qc", "tts")} | {"num_shards": c.run.num_shards}, sort_keys=True).encode()).hexdigest()


def _folder(c: Any, kind: str) -> str:
    return str(c.run.output_dir / "manifests" / kind)


def finished(spark: SparkSession, c: Any) -> DataFrame:
    """(shard) of shards with a mark."""
    found = manifests.inventory(spark, _folder(c, "done"))
    return found.select(F.regexp_extract("path", r"shard-(\d+)-of-", 1).cast("int").alias("shard")).where("shard is not null").distinct()


def _judged(tried: DataFrame, records: DataFrame, backend: Backend, c: Any) -> DataFrame:
    """Transcripts, error rates and checks for generated attempts."""
    said = records.select("pair_id", F.explode(F.map_from_arrays(F.array(F.lit("ja"), F.lit("en")), F.array("ja_tts_text", "en_tts_text"))).alias("language", "said"))
    df = tried.join(heard(tried, backend), ["pair_id", "language", "attempt"], "left").join(said, ["pair_id", "language"])
    ja = F.col("language") == "ja"
    both = [F.when(ja, X.japanese_reading(F.col(t), backend.reader)).otherwise(X.english_spoken(F.col(t), backend.tokenizer)) for t in ("said", "asr_text")]
    df = df.withColumns({"reference_eval_norm": F.when(F.col("asr_text").isNotNull(), both[0]), "asr_eval_norm": both[1]})
    pair = (F.col("reference_eval_norm"), F.col("asr_eval_norm"))
    df = df.withColumns({"cer": F.when(ja, rates.character_error_rate(*pair)), "wer": F.when(~ja, rates.word_error_rate(*pair))}).withColumn("metric", F.coalesce("cer", "wer")).drop("said")
    return attempts.checked(df, {"ja": c.qc.max_ja_cer, "en": c.qc.max_en_wer}, c.qc.min_duration_seconds, c.qc.max_duration_seconds)


def _tried(spark: SparkSession, c: Any, backend: Backend, made: DataFrame, records: DataFrame) -> None:
    """Make and check attempts, and write what came of them."""
    tried = written(generated(made, backend, str(c.run.output_dir), c.run.num_shards, c.tts.output_sample_rate, c.qc.min_duration_seconds, c.qc.max_duration_seconds, c.run.resume, c.run.save_native), "tried")
    if tried.isEmpty():
        return
    new = _judged(tried, records, backend, c).join(records.select("pair_id", "shard"), "pair_id")
    new.withColumn("written_at", F.current_timestamp()).write.mode("append").partitionBy("shard").parquet(_folder(c, "generated"))


def run(spark: SparkSession, c: Any, backend: Backend, index: int | None = None) -> dict[str, int]:
    """Speak and check one shard or all that aren't finished; gives how many pairs were accepted and rejected.

    Results are written after every ``checkpoint_every`` attempts for each core, so a run that breaks off goes on from there.
    ValueError where the backend needs an accelerator that isn't there. An attempt that has failed isn't made again under its number. ValueError if finished shards had other settings.
    """
    if backend.accelerated:
        accelerator(c)
    within_limit(spark, c)
    rows = manifests.read_manifest(spark, str(c.run.input_jsonl))
    over = manifest.shard_counts(rows, c.run.num_shards).where(F.col("pairs") > c.run.max_pairs_per_shard).limit(1).collect()
    if over:
        raise ValueError(f"shard {over[0].shard} has {over[0].pairs} pairs, and at most {c.run.max_pairs_per_shard} are allowed; more shards are needed")
    mark = c.run.output_dir / "manifests" / "settings.json"
    if mark.is_file() and json.loads(mark.read_text())["hash"] != settings_hash(c):
        raise ValueError("shards that are there were made with other settings; use another folder")
    sinks.write_json(mark, {"hash": settings_hash(c)})
    wanted = spark.range(c.run.num_shards).select(F.col("id").cast("int").alias("shard"))
    if index is not None:
        if not 0 <= index < c.run.num_shards:
            raise ValueError(f"there is no shard {index} of {c.run.num_shards}")
        wanted = wanted.where(F.col("shard") == index)
    if c.run.resume:
        wanted = wanted.join(finished(spark, c), "shard", "left_anti")
    todo = [r.shard for r in wanted.collect()]
    if not todo:
        return {"accepted": 0, "rejected": 0}
    own = manifest.sharded(rows, c.run.num_shards).where(F.col("shard").isin(todo))
    records = written(attempts.new_records(own.withColumnRenamed("line_no", "manifest_pos")).drop("attempts"), "records")
    goal = attempts.targets(records)
    for number in range(c.tts.max_content_retries + 1):
        have = _attempts(spark, c, todo)
        missing = attempts.missing(goal if number == 0 else attempts.unpassed(goal, have), have, number)
        text = F.when(F.col("language") == "ja", F.col("ja_tts_text")).otherwise(F.col("en_tts_text"))
        made = missing.join(records.select("pair_id", "shard", "ja_tts_text", "en_tts_text"), "pair_id").select("pair_id", "language", "shard", F.lit(number).alias("attempt"), text.alias("text"))
        made = written(made, "wanted")
        # so many attempts for each core are made before their results are written, and at most these are lost
        waves = max(1, -(-made.count() // (c.run.checkpoint_every * spark.sparkContext.defaultParallelism)))
        for wave in range(waves):
            some = made.where(F.pmod(F.xxhash64(F.lit(number), "pair_id", "language"), F.lit(waves)) == wave)
            _tried(spark, c, backend, some, records)
    every = attempts.nested(_attempts(spark, c, todo))
    facts = backend.facts or {"tts_model_id": c.tts.model_id, "tts_model_revision": c.tts.revision, "tts_speaker_id": c.tts.speaker, "tts_dtype": c.tts.dtype, "qc_asr_model_id": c.asr.model_id, "qc_asr_model_revision": c.asr.revision}
    final = written(attempts.finalized(records.join(every, "pair_id", "left"), facts), "final")
    sinks.write_shards(final, _folder(c, "qc"))
    sinks.write_shards(release.rejected(final), str(c.run.output_dir / "failures"))
    for k in todo:  # marks of shards, empty ones included, after their rows
        sinks.write_json(Path(_folder(c, "done")) / f"shard-{k:05d}-of-{c.run.num_shards:05d}.json", {"hash": settings_hash(c)})
    within_limit(spark, c)
    n = final.agg(F.count_if(F.col("qc_status") == "accepted").alias("a"), F.count("*").alias("n")).first()
    return {"accepted": n.a, "rejected": n.n - n.a}


def _attempts(spark: SparkSession, c: Any, shards: list[int]) -> DataFrame:
    """Attempts made so far, of some shards; of repeated ones, as an append that is run again can leave, the first by time."""
    if not Path(_folder(c, "generated")).exists():
        return spark.createDataFrame([], attempts.ATTEMPT).withColumns({"pair_id": F.lit(""), "language": F.lit("")})
    rows = spark.read.parquet(_folder(c, "generated")).where(F.col("shard").isin(shards)).drop("shard")
    rest = [c for c in rows.columns if c != "written_at"]
    first = rows.groupBy("pair_id", "language", "attempt").agg(F.min_by(F.struct(*rest), "written_at").alias("row"))
    return first.select("row.*")


def consolidate(spark: SparkSession, c: Any, allow_incomplete: bool = False) -> dict[str, Any]:
    """Write all finished pairs, the accepted ones, and a summary; ValueError for missing shards or repeated ids."""
    missing = [r.shard for r in release.missing_shards(finished(spark, c), c.run.num_shards).orderBy("shard").collect()]
    if missing and not allow_incomplete:
        raise ValueError(f"{len(missing)} shards are missing, the first of them {missing[:10]}")
    rows = spark.read.parquet(_folder(c, "qc"))
    twice = rows.groupBy("pair_id").count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"pair_id {twice[0].pair_id} is in more than one place")
    out = c.run.output_dir / "manifests" / "releases"
    out.mkdir(parents=True, exist_ok=True)
    sinks.write_lines(rows, str(out / "all.jsonl"), ["shard", "manifest_pos"])
    sinks.write_lines(release.accepted(rows), str(out / "accepted.jsonl"), ["shard", "manifest_pos"])
    total = release.summary(rows).first().asDict()
    total |= {"complete": not missing, "missing_shards": missing, "accepted_by_corpus": {r.corpus: r.accepted_pairs for r in release.by_corpus(rows).orderBy("corpus").collect()}}
    sinks.write_json(out / "summary.json", total)
    return total


def trial_manifest(spark: SparkSession, c: Any) -> dict[str, Any]:
    """Choose the pairs of a trial from the manifest and write them as one of their own."""
    rows = manifests.read_manifest(spark, str(c.run.input_jsonl)).withColumnRenamed("line_no", "manifest_pos")
    some = written(samples.required_trial(rows, c.smoke.pair_count), "trial").orderBy("smoke_selection_index")
    sinks.write_lines(some.drop("json", "manifest_pos").coalesce(1), str(c.smoke.input_jsonl))
    return {"pairs": some.count(), "pair_ids": [r.pair_id for r in some.collect()], "input_jsonl": str(c.smoke.input_jsonl)}
