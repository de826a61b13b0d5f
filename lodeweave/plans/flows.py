"""The engine's sources, sinks, models and commands as queries: files are made from the tables, and read back by the readers.

Archives, audio and settings are made from ``nation``, which has 25 rows at any scale: they stand in for downloads, which
one machine unpacks. Lines of JSON and Parquet are made from whole tables, by executors.
"""

from __future__ import annotations

import io
import json
import tarfile
from argparse import Namespace
from collections.abc import Iterator
from pathlib import Path
from types import SimpleNamespace
from typing import Any
from urllib.parse import urlparse

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeweave import backends, cli
from lodeweave.functions import audio
from lodeweave.functions import text as X
from lodeweave.operators import attempts, manifest, release, rules, samples
from lodeweave.plans import config, prepare, shards
from lodeweave.plans.queries import _CONTENT, _CUE, _DOCS, _LINK, _MARKUP, _SHARD, SEED, SHARDS, _candidates, _long, _norm, _only, _units, _words
from lodeweave.plans.registry import query
from lodeweave.scratch import scratch
from lodeweave.session import spread, table
from lodeweave.sources import archives, manifests, sinks

LICENSE = "CC-BY-SA-4.0"
JA = "この国の人々は川の近くを歩くのが好きです。"
EN = "The people of {} like to walk near the river."
_SPLITS = ("train", "dev", "test")
#: Nations as text pairs: a Chinese character of its own makes each Japanese sentence different.
_NATIONS = f"""said AS (SELECT n_nationkey AS k, n_name, concat(chr(23665 + n_nationkey), '{JA}') AS ja, replace('{EN}', '{{}}', n_name) AS en, CASE WHEN n_nationkey % 2 = 0 THEN 'jesc' ELSE 'kftt' END AS corpus,
    CASE n_nationkey % 5 WHEN 0 THEN 'dev' WHEN 1 THEN 'test' ELSE 'train' END AS split FROM nation),
  placed AS (SELECT *, row_number() OVER (PARTITION BY corpus, split ORDER BY k) AS i FROM said),
  known AS (SELECT *, concat(corpus, '_', split, '_', lpad(i::VARCHAR, 8, '0'), '_', substr(sha256(concat(ja, chr(0), en)), 1, 12)) AS pair_id FROM placed),
  ranked AS (SELECT *, sha256(concat('{SEED}', chr(0), pair_id)) AS priority, (concat('0x', substr(sha256(pair_id), 1, 16))::UBIGINT % 3)::INTEGER AS shard FROM known)"""


def _folder(spark: SparkSession, what: str) -> Path:
    """A new folder in the shared one, by its mounted path: archives, audio and settings are files of a mounted file system."""
    url = scratch(spark, what)
    parts = urlparse(url)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"{url} isn't on a mounted file system")
    place = Path(parts.path)
    place.mkdir(parents=True)
    return place


def _nations(spark: SparkSession, sf_dir: str) -> list[SimpleNamespace]:
    rows = table(spark, sf_dir, "nation").orderBy("n_nationkey").collect()
    return [SimpleNamespace(k=r.n_nationkey, name=r.n_name, ja=chr(23665 + r.n_nationkey) + JA, en=EN.format(r.n_name), corpus="kftt" if r.n_nationkey % 2 else "jesc", split={0: "dev", 1: "test"}.get(r.n_nationkey % 5, "train")) for r in rows]


def _archive(path: Path, files: dict[str, str]) -> None:
    with tarfile.open(path, "w:gz") as t:
        for name, text in files.items():
            info = tarfile.TarInfo(name)
            info.size = len(text.encode())
            t.addfile(info, io.BytesIO(text.encode()))


def _archives(spark: SparkSession, sf_dir: str, at: Path) -> list[SimpleNamespace]:
    """Both corpora's archives, in their layouts; gives their rows."""
    rows = _nations(spark, sf_dir)
    of = lambda c, s: [r for r in rows if (r.corpus, r.split) == (c, s)]
    _archive(at / "jesc.tar.gz", {f"split/{s}": "".join(f"{r.en}\t{r.ja}\n" for r in of("jesc", s)) for s in _SPLITS})
    _archive(at / "kftt.tar.gz", {f"data/orig/kyoto-{s}.{x}": "".join(getattr(r, x) + "\n" for r in of("kftt", s)) for s in _SPLITS for x in ("ja", "en")})
    return rows


def _raw(at: Path, hours: float = 1.0, fraction: float = 0.5) -> dict[str, Any]:
    return {
        "run": {"input_jsonl": f"{at}/manifest.jsonl", "output_dir": f"{at}/out", "num_shards": 3, "max_pairs_per_shard": 50, "checkpoint_every": 10, "minimum_free_gib": 1, "minimum_cache_free_gib": 1, "maximum_output_gib": 2, "expected_hours_per_language": 1, "retry_storage_fraction": 0.1, "save_native": False, "resume": True},
        "prepare": {"sources_dir": f"{at}/sources", "work_dir": f"{at}/work", "reports_dir": f"{at}/reports", "target_train_hours": hours, "jesc_fraction": fraction, "selection_seed": SEED, "ja_chars_per_second": 5.5, "utterance_padding_seconds": 0.5, "short_max_ja_chars": 24, "medium_max_ja_chars": 64, "short_time_fraction": 0.2, "medium_time_fraction": 0.5, "long_time_fraction": 0.3, "include_dev": True, "include_test": True},
        "sources": {n: {"url": (at / f"{n}.tar.gz").as_uri(), "archive_name": f"{n}.tar.gz", "version": "1", "license_id": LICENSE} for n in ("jesc", "kftt")},
        "smoke": {"input_jsonl": f"{at}/trial.jsonl", "output_dir": f"{at}/trial", "pair_count": 2, "minimum_free_gib": 1, "maximum_output_gib": 1},
        "device": {"require_cuda": True, "minimum_vram_gib": 16, "require_bf16": True, "attention": "sdpa"},
        "tts": {"model_id": "m", "revision": "r", "device": "cuda:0", "dtype": "bfloat16", "speaker": "s", "instruct": "", "max_new_tokens": 1, "do_sample": True, "subtalker_do_sample": True, "remove_invalid_values": True, "renormalize_logits": True, "output_sample_rate": 16000, "max_content_retries": 1},
        "asr": {"model_id": "a", "revision": "r", "dtype": "float16", "attention": "sdpa", "do_sample": False, "num_beams": 1, "condition_on_prev_tokens": False},
        "qc": {"max_ja_cer": 0.1, "max_en_wer": 0.1, "min_duration_seconds": 0.7, "max_duration_seconds": 30.0},
    }


def _settings(spark: SparkSession, sf_dir: str) -> Any:
    """Settings by which all training pairs of nations are chosen: the hours asked for are just short of what there is."""
    at = _folder(spark, "speech")
    train = [r for r in _archives(spark, sf_dir, at) if r.split == "train"]
    jesc = sum(r.corpus == "jesc" for r in train)
    seconds = len(JA) / 5.5 + 0.5  # a character more at the start, a full stop less at the end
    return config.settings(_raw(at, 0.999 * len(train) * seconds / 3600, jesc / len(train)), https=False)


def half_deaf() -> backends.Backend:
    """Tones, of which those that speak of one nation are always misheard."""
    return backends.tone_backend(lambda text, seed: "NATION_7 " in text)


# ---- archives and manifests


@query("text_pairs", f"WITH {_NATIONS} SELECT corpus, split, i AS source_index, ja AS ja_raw, en AS en_raw FROM placed")
def text_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives fetched, verified, unpacked once, and read in both layouts."""
    at = _folder(spark, "archives")
    _archives(spark, sf_dir, at)
    out = None
    for name, reader in prepare.READERS.items():
        got = archives.fetch((at / f"{name}.tar.gz").as_uri(), at / "sources" / f"{name}.tar.gz", archives.file_digest(at / f"{name}.tar.gz"))
        for _ in range(2):
            root = archives.unpack(Path(got["path"]), at / "work" / name, got["sha256"])
        rows = reader(spark, root, _SPLITS).withColumn("corpus", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return out.select("corpus", "split", "source_index", "ja_raw", "en_raw")


@query("prepared_manifest", f"WITH {_NATIONS} SELECT pair_id, corpus, split, concat(corpus, ':', split, ':', i) AS source_id, ja AS ja_text, en AS en_text, {_units('ja')} AS ja_chars, {_words('en')} AS en_words, priority AS selection_priority, '1' AS corpus_version, '{LICENSE}' AS license_id, TRUE AS reused FROM ranked")
def prepared_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From archives to a manifest; a second run uses it again."""
    c = _settings(spark, sf_dir)
    cli.run(spark, Namespace(command="prepare"), c)
    again = prepare.prepare(spark, c)
    rows = manifests.read_manifest(spark, str(c.run.input_jsonl))
    return rows.select("pair_id", "corpus", "split", "source_id", "ja_text", "en_text", "ja_chars", "en_words", "selection_priority", "corpus_version", "license_id", F.lit(again["reused"]).alias("reused"))


@query("prepare_report", f"""WITH {_NATIONS} SELECT corpus, CASE WHEN split = 'train' THEN 'train' ELSE 'evaluation' END AS stage, count(*) AS eligible, 0::BIGINT AS duplicates, 0::BIGINT AS filtered, count(*) AS pairs FROM said GROUP BY ALL""")
def prepare_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a preparation, as rows."""
    c = _settings(spark, sf_dir)
    prepare.prepare(spark, c)
    got = json.loads((c.prepare.reports_dir / prepare.SUMMARY).read_text())
    pairs = lambda n, stage: sum(v for k, v in got["manifest_counts"].items() if k.endswith(f":{n}") and (k.startswith("train") == (stage == "train")))
    rows = [(n, stage, x["eligible"], x["duplicates"], sum(x["filtered"].values()), pairs(n, stage)) for n, of in got["ingestion"].items() for stage, x in of.items()]
    return spark.createDataFrame(rows, "corpus string, stage string, eligible long, duplicates long, filtered long, pairs long")


_LINES = f"WITH {_DOCS} SELECT pair_id, corpus, split, ja_chars, length_bin FROM full_ WHERE ja_norm <> ''"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _candidates(spark, sf_dir).where("ja_norm <> ''")
    return rows.select("pair_id", "corpus", "split", F.col("ja_norm").alias("ja_text"), F.col("en_norm").alias("en_text"), "ja_chars", "length_bin")


@query("strict_manifest", _LINES)
def strict_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as a manifest and read strictly."""
    path = scratch(spark, "strict")
    sinks.write_lines(_lines(spark, sf_dir), path)
    return manifests.read_manifest(spark, path).select("pair_id", "corpus", "split", "ja_chars", "length_bin")


@query("lenient_rows", f"WITH {_DOCS} SELECT pair_id, ja_chars, NULL::VARCHAR AS other FROM full_ WHERE ja_norm <> ''")
def lenient_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines read as a checkpoint, with a field that they lack."""
    path = scratch(spark, "lenient")
    sinks.write_lines(_lines(spark, sf_dir), path)
    return spark.read.schema("pair_id string, ja_chars long, other string").option("mode", "FAILFAST").json(path) if "://" in path and not path.startswith("file:") else manifests.read_rows(spark, urlparse(path).path, "pair_id string, ja_chars long, other string")


@query("sorted_json", """SELECT concat('{"doc_id":', doc_id, ',"lang":', coalesce('"' || lang || '"', 'null'), ',"n_chars":', coalesce(n_chars::VARCHAR, 'null'), ',"none":null,"source":', coalesce('"' || source || '"', 'null'), '}') AS line FROM documents""")
def sorted_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of JSON with their keys sorted and their nulls kept, twice in the same place."""
    path = scratch(spark, "json")
    rows = table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars", "lang", F.lit(None).cast("string").alias("none"))
    for _ in range(2):
        sinks.write_lines(rows, path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("json_digests", "SELECT n_name AS name, sha256(concat('\"', n_name, '\"', chr(10))) AS sha256 FROM nation")
def json_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON file for each nation, and the digests of all files of the folder."""
    at = _folder(spark, "digests")
    for r in _nations(spark, sf_dir):
        sinks.write_json(at / "in" / f"{r.name}.json", r.name)
    return manifests.digests(spark, (at / "in").as_uri()).select(F.regexp_extract("path", r"([^/]+)\.json$", 1).alias("name"), "sha256")


@query("release_files", f"WITH {_DOCS}, s AS (SELECT ({_SHARD} % {SHARDS})::INTEGER AS shard FROM named) SELECT shard, count(*) AS pairs, 0::BIGINT AS inversions FROM s GROUP BY ALL")
def release_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards written one by one, put together, and written in the order of a release: how often a line is before its place."""
    rows = manifest.sharded(_candidates(spark, sf_dir), SHARDS).select("pair_id", "shard", F.col("doc_id").alias("manifest_pos"))
    path, out = scratch(spark, "shards"), scratch(spark, "release")
    for part in (0, 1):
        sinks.write_shards(rows.where(F.col("shard") % 2 == part), path)
    sinks.write_lines(release.ordered(spark.read.parquet(path)), out)
    lines = spark.read.schema("shard int, manifest_pos long").json(out).select("shard", "manifest_pos", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    # a shard's lines in the order of their files, then of their places in these
    before = F.lag("manifest_pos").over(samples.W.partitionBy("shard").orderBy("file", "block", "at"))
    return lines.withColumn("wrong", F.coalesce(before > F.col("manifest_pos"), F.lit(False))).groupBy("shard").agg(F.count("*").alias("pairs"), F.count_if("wrong").alias("inversions"))


# ---- rules and texts of both languages

_CASES = [
    ("音楽", "Music"), ("詳細はhttps://example.comです。", "Read the website for details."), ("短い", "Too short."), ("駅に着いたら私に電話してください。", "Please call me when you arrive at the station."),
    ("これは<b>太字</b>の文章です。", "Please call me when you arrive at the station."), ("。。。", "This is a valid sentence."), ("12345678", "This is a valid sentence."), ("あ" * 161, "word " * 30), ("あ" * 100, "word " * 51),
    ("ABCDEFGHIJあいうえ", "Please call me when you arrive at the station."), ("佐々々々々々々々々木さん", "Please call me when you arrive at the station."), ("駅に着いたら電話してください", "One two three four приветпривет"),
    ("あ" * 8, "one two three four five six seven eight nine ten"), ("あ" * 8, "one two three four five six seven eight nine ten eleven"), ("あ" * 32, "one two three four"), ("あ" * 33, "one two three four"),
    ("詳細はfoo@bar.com です、見てください。", "Please call me when you arrive at the station."), ("カタカナとひらがな。", "It's a well-known fact of life!"), ("你們說這個國家的人來了。", "They said that the people came."), ("", "Nothing on the left side."),
]
_JAPANESE = r"\x{3040}-\x{30ff}\x{3400}-\x{9fff}"
_VALUES = ", ".join("({}, '{}', '{}')".format(k, *(x.strip().replace("'", "''") for x in case)) for k, case in enumerate(_CASES))
_PLAIN = rules.Profile()


def _cap(side: int) -> str:
    return f"CASE corpus WHEN 'jesc' THEN {_PLAIN.caps['jesc'][side]} ELSE {_PLAIN.cap[side]} END"


_RULED = f"""c(k, ja_norm, en_norm) AS (VALUES {_VALUES}), x AS (SELECT *, {_units('ja_norm')} AS n, {_words('en_norm')} AS w FROM c, (VALUES ('jesc'), ('kftt')) t(corpus)),
  r AS (SELECT *, CASE WHEN ja_norm = '' OR en_norm = '' THEN 'empty' WHEN regexp_matches(ja_norm, {_LINK}) OR regexp_matches(en_norm, {_LINK}) THEN 'url_or_email' WHEN regexp_matches(ja_norm, {_MARKUP}) OR regexp_matches(en_norm, {_MARKUP}) THEN 'markup'
    WHEN regexp_matches(ja_norm, {_CUE}) OR regexp_matches(en_norm, {_CUE}) THEN 'subtitle_cue' WHEN NOT regexp_matches(ja_norm, {_CONTENT}) OR NOT regexp_matches(en_norm, {_CONTENT}) THEN 'no_content'
    WHEN n < 8 OR w < 4 THEN 'too_short' WHEN n > {_cap(0)} OR w > {_cap(1)} THEN 'too_long' WHEN {_only('ja_norm', _JAPANESE)}::DOUBLE / greatest(n, 1) < 0.45 THEN 'not_japanese'
    WHEN {_only('en_norm', 'A-Za-z')}::DOUBLE / greatest({_only('en_norm', chr(92) + 'p{L}')}, 1) < 0.8 THEN 'not_english' WHEN NOT n::DOUBLE / greatest(w, 1) BETWEEN 0.8 AND 8.0 THEN 'length_ratio' END AS reason FROM x)"""


def _cases(spark: SparkSession) -> DataFrame:
    rows = [(k, ja, en, c) for k, (ja, en) in enumerate(_CASES) for c in ("jesc", "kftt")]
    return spark.createDataFrame(rows, "k int, ja_raw string, en_raw string, corpus string")


@query("japanese_rules", f"WITH {_RULED} SELECT k, corpus, reason, {_only('ja_norm', _JAPANESE)} AS letters FROM r")
def japanese_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules with their own limits, over stated Japanese and English pairs."""
    return rules.classified(_cases(spark)).select("k", "corpus", "reason", _long(X.japanese_letters(F.col("ja_norm"))).alias("letters"))


@query("japanese_sentences", rf"WITH {_RULED} SELECT k, corpus, regexp_matches(ja_norm, '[。！？!?]$') AND regexp_matches(en_norm, '[.!?]$') AND NOT regexp_matches(concat(ja_norm, en_norm), '\.\.\.|[…()（）\[\]【】]') AND NOT regexp_matches(ja_norm, '[A-Za-z{samples._CHINESE}]') AS complete FROM r")
def japanese_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cases(spark).select("k", "corpus", samples.complete(F.trim("ja_raw"), F.trim("en_raw")).alias("complete"))


@query("gated_rows", f"WITH {_DOCS} SELECT split, count(*) AS pairs FROM docs WHERE split <> 'dev' GROUP BY ALL")
def gated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the dev split switched off."""
    return rules.gated(_candidates(spark, sf_dir), dev=False).groupBy("split").agg(F.count("*").alias("pairs"))


@query("compat_forms", "SELECT n_nationkey, concat(n_name, '...ガギ&lt;1 (KK)') AS norm FROM nation")
def compat_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-width letters, half-width kana, ligatures, entities, zero-width and control characters."""
    n = table(spark, sf_dir, "nation")
    wide = F.translate("n_name", "NATIO", "ＮＡＴＩＯ")
    return n.select("n_nationkey", X.normalized(F.concat(F.lit("　"), wide, F.lit("…ｶﾞｷﾞ&amp;lt;​①\u0000\u0085⒦".replace("⒦", "(㏍)").replace("㏍", "ＫＫ")), F.lit("  "))).alias("norm"))


@query("english_eval", rf"""WITH n AS (SELECT conv_id, turn, {_norm("regexp_replace(lower(" + _norm('text') + ") , '[^\\p{L}\\p{N}_\\s'']', ' ', 'g')")} AS plain FROM conversations) SELECT conv_id, turn, plain, replace(plain, 'the ', '') AS spoken FROM n""")
def english_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English for comparison, without a tokenizer and with one that leaves articles out."""
    c = spread(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"))
    plain = c.select("conv_id", "turn", X.english_plain(F.col("text")).alias("plain"))
    return plain.select("conv_id", "turn", "plain", X.english_spoken(F.col("plain"), SimpleNamespace(normalize=lambda t: t.replace("the ", ""))).alias("spoken"))


@query("japanese_readings", rf"WITH {_RULED} SELECT k, corpus, regexp_replace(translate(ja_norm, 'あいう', 'アイウ'), '[\s、。！？!?,.・「」『』（）()\[\]【】〈〉《》…―:：;；''\"“”‘’]', '', 'g') AS reading FROM r")
def japanese_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings by a stand-in for a dictionary, which knows three letters."""
    known = str.maketrans("あいう", "アイウ")
    return _cases(spark).select("k", "corpus", X.japanese_reading(F.col("ja_raw"), lambda t, kana: t.translate(known) if kana else t).alias("reading"))


# ---- records and attempts


@query("new_records", f"WITH {_DOCS} SELECT pair_id, ja_norm AS ja_text_raw, lang AS en_text_raw, ja_norm AS ja_tts_text, lang AS en_tts_text, 0::BIGINT AS tries FROM named JOIN (SELECT doc_id AS d, lang FROM documents) ON d = doc_id")
def new_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = attempts.new_records(_lines_all(spark, sf_dir))
    return rows.select("pair_id", "ja_text_raw", "en_text_raw", "ja_tts_text", "en_tts_text", _long(F.size("attempts.ja") + F.size("attempts.en")).alias("tries"))


def _lines_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir).select("pair_id", F.col("ja_norm").alias("ja_text"), F.col("en_norm").alias("en_text"))


@query("unchecked_attempts", "SELECT user_id AS pair_id, event_id % 2 AS attempt, count(*) AS tries FROM events WHERE event_id % 2 = 1 AND event_type = 'error' GROUP BY ALL")
def unchecked_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts of one number that have no result yet."""
    tried = table(spark, sf_dir, "events").select(F.col("user_id").alias("pair_id"), (F.col("event_id") % 2).alias("attempt"), F.when(F.col("event_type") != "error", F.lit(True)).alias("qc_pass"))
    return attempts.unchecked(tried, 1).groupBy("pair_id", "attempt").agg(F.count("*").alias("tries"))


@query("one_shard", f"WITH {_DOCS} SELECT pair_id, ({_SHARD} % {SHARDS})::INTEGER AS shard FROM named WHERE {_SHARD} % {SHARDS} = 5")
def one_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A shard's rows, which must not be more than its limit."""
    rows = _candidates(spark, sf_dir)
    return manifest.shard_rows(rows, 5, SHARDS, 1 << 40).select("pair_id", F.lit(5).alias("shard"))


# ---- settings, speech and commands


@query("loaded_settings", "SELECT * FROM (VALUES ('checkpoint_every', 1.0::DOUBLE), ('expected_hours_per_language', 2 * 30.0::DOUBLE / 3600), ('max_pairs_per_shard', 2.0), ('maximum_output_gib', 1.0), ('minimum_free_gib', 1.0), ('num_shards', 1.0), ('sources', 2.0)) t(name, value)")
def loaded_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings read from a file, and those of a trial that follow from them."""
    at = _folder(spark, "settings")
    raw = _raw(at)
    for s in raw["sources"].values():
        s["url"] = "https://example.org/corpus.tar.gz"
    sinks.write_json(at / "settings.json", raw)
    c = config.trial_settings(config.load(at / "settings.json"))
    names = ("checkpoint_every", "expected_hours_per_language", "max_pairs_per_shard", "maximum_output_gib", "minimum_free_gib", "num_shards")
    return spark.createDataFrame([*[(n, float(getattr(c.run, n))) for n in names], ("sources", float(len(c.sources)))], "name string, value double")


_FRAMES = "greatest(12000, least(24000, 600 * length(en)))"


def _spoken(spark: SparkSession, sf_dir: str, at: Path) -> DataFrame:
    rows = [(f"n{r.k}", "en", 0, r.k % 3, r.en if r.k != 3 else "!error") for r in _nations(spark, sf_dir)]
    targets = spark.createDataFrame(rows, "pair_id string, language string, attempt int, shard int, text string")
    return backends.generated(targets, backends.tone_backend(), str(at), 3, 16000, 0.7, 30.0)


@query("spoken_attempts", f"WITH {_NATIONS} SELECT concat('n', k) AS pair_id, CASE WHEN k = 3 THEN 'failed' ELSE 'ok' END AS status, CASE WHEN k <> 3 THEN {_FRAMES}::DOUBLE / 16000 END AS duration, CASE WHEN k <> 3 THEN en END AS asr_text, CASE WHEN k <> 3 THEN {_FRAMES}::DOUBLE / 16000 END AS seconds FROM said")
def spoken_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts spoken in tones, one of which fails, then heard, and their files measured; a second run finds the files."""
    at = _folder(spark, "audio")
    for _ in range(2):
        tried = _spoken(spark, sf_dir, at)
        tried.write.mode("overwrite").parquet((at / "tried").as_uri())
    tried = spark.read.parquet((at / "tried").as_uri())
    files = audio.usable(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load((at / "audio").as_uri()), 0.7, 30.0)
    seconds = files.select(F.regexp_extract("path", r"[^/]+$", 0).alias("file"), "seconds")
    found = tried.withColumn("file", F.regexp_extract("wav_16k", r"[^/]+$", 0)).join(seconds, "file", "left")
    return found.join(backends.heard(tried, backends.tone_backend()).select("pair_id", "asr_text"), "pair_id", "left").select("pair_id", F.col("generation_status").alias("status"), "duration", "asr_text", "seconds")


@query("stored_audio", f"WITH {_NATIONS} SELECT count(*) AS files, sum(44 + 2 * {_FRAMES})::BIGINT AS bytes FROM said WHERE k <> 3")
def stored_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many files a folder holds, and their bytes, without reading them."""
    at = _folder(spark, "stored")
    _spoken(spark, sf_dir, at).write.parquet((at / "tried").as_uri())
    where = (at / "audio").as_uri()
    return manifests.inventory(spark, where).agg(F.count("*").alias("files")).withColumn("bytes", F.lit(manifests.stored_bytes(spark, where)).cast("long"))


@F.pandas_udf(T.LongType())
def _frames(n: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in n:
        yield s.map(lambda k: len(audio.resampled(np.zeros(1000 + int(k), np.float32), 24000, 16000)))


@query("resampled_frames", "SELECT n_nationkey, ceil((1000 + n_nationkey) * 2 / 3.0)::BIGINT AS frames FROM nation")
def resampled_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select("n_nationkey", _frames(_long("n_nationkey")).alias("frames"))


@query("speech_plan", f"WITH {_NATIONS} SELECT count(*) AS pairs, 3::BIGINT AS num_shards, count(*) FILTER (WHERE corpus = 'jesc') AS jesc, count(*) FILTER (WHERE split = 'train') AS train, TRUE AS within_pair_limit, round(3600 * 16000 * 2 * 2 * 1.1::DOUBLE / 1073741824, 2) AS gib, TRUE AS within_audio_budget FROM said")
def speech_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _settings(spark, sf_dir)
    prepare.prepare(spark, c)
    p = cli.run(spark, Namespace(command="plan"), c)
    row = (p["pairs"], p["num_shards"], p["corpora"]["jesc"], p["splits"]["train"], p["within_pair_limit"], p["canonical_audio_gib_with_retry_allowance"], p["within_audio_budget"])
    return spark.createDataFrame([row], "pairs long, num_shards long, jesc long, train long, within_pair_limit boolean, gib double, within_audio_budget boolean")


@query("speech_release", f"WITH {_NATIONS} SELECT pair_id, corpus, split, shard, CASE WHEN n_name = 'NATION_7' THEN 'rejected' ELSE 'accepted' END AS qc_status, CASE WHEN n_name = 'NATION_7' THEN 'en_no_passing_attempt' ELSE '' END AS reasons, 0::BIGINT AS ja_attempt, CASE WHEN n_name <> 'NATION_7' THEN 0::BIGINT END AS en_attempt, CASE WHEN n_name = 'NATION_7' THEN 2 ELSE 1 END::BIGINT AS tries, 'tone' AS tts_model_id, 24::BIGINT AS accepted FROM ranked")
def speech_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything from archives to a release by the commands: one shard by itself, then the rest, retries, and the files put together."""
    c = _settings(spark, sf_dir)
    named = {"backend": "lodeweave.plans.flows:half_deaf"}
    cli.run(spark, Namespace(command="prepare"), c)
    cli.run(spark, Namespace(command="run-shard", shard_index=0, **named), c)
    cli.run(spark, Namespace(command="build", **named), c)
    done = cli.run(spark, Namespace(command="consolidate", allow_incomplete=False), c)
    place = (c.run.output_dir / "manifests/releases/all.jsonl").as_uri()
    schema = "pair_id string, corpus string, split string, shard int, qc_status string, qc_reasons array<string>, ja_attempt long, en_attempt long, attempts struct<en: array<struct<attempt: int>>>, tts_model_id string"
    rows = spark.read.schema(schema).json(place)
    return rows.select("pair_id", "corpus", "split", "shard", "qc_status", F.array_join("qc_reasons", ",").alias("reasons"), "ja_attempt", "en_attempt", _long(F.size("attempts.en")).alias("tries"), "tts_model_id", _long(F.lit(done["accepted_pairs"])).alias("accepted"))


@query("speech_trial", f"WITH {_NATIONS}, t AS (SELECT pair_id, row_number() OVER (ORDER BY priority) AS i FROM ranked WHERE split = 'train' AND corpus = 'jesc') SELECT pair_id, 2::BIGINT AS accepted_pairs, TRUE AS all_pairs_accepted FROM t WHERE i <= 2")
def speech_trial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trial of two pairs: the first of the first slot, then the next of the manifest."""
    done = cli.run(spark, Namespace(command="smoke-test", backend=None), _settings(spark, sf_dir))
    return spark.createDataFrame([(x, done["release"]["accepted_pairs"], done["release"]["all_pairs_accepted"]) for x in done["selection"]["pair_ids"]], "pair_id string, accepted_pairs long, all_pairs_accepted boolean")
