import io
import json
import tarfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lodeweave import cli
from lodeweave.backends import Backend, fatal, tone_backend
from lodeweave.functions import ids
from lodeweave.plans import config, shards
from lodeweave.plans.prepare import prepare
from lodeweave.sources import archives, lines, manifests, pairs, sinks

JA = ["駅に着いたら電話してください。", "今日はとても暖かい一日でした。", "新しい本を友達から借りました。", "明日の朝は早く起きるつもりです。", "この町には古い寺がたくさんあります。"]
EN = ["Please phone me from the station.", "It was a very warm day today.", "I borrowed a new book from a friend.", "I mean to get up early tomorrow.", "There are many old temples in this town."]


def settings(tmp, **run):
    raw = {
        "run": {"input_jsonl": tmp / "manifest.jsonl", "output_dir": tmp / "out", "num_shards": 3, "max_pairs_per_shard": 50, "checkpoint_every": 10, "minimum_free_gib": 1, "minimum_cache_free_gib": 1, "maximum_output_gib": 2, "expected_hours_per_language": 1, "retry_storage_fraction": 0.1, "save_native": False, "resume": True} | run,
        "prepare": {"sources_dir": tmp / "sources", "work_dir": tmp / "work", "reports_dir": tmp / "reports", "target_train_hours": 0.001, "jesc_fraction": 0.7, "selection_seed": 20260723, "ja_chars_per_second": 5.5, "utterance_padding_seconds": 0.5, "short_max_ja_chars": 24, "medium_max_ja_chars": 64, "short_time_fraction": 0.2, "medium_time_fraction": 0.5, "long_time_fraction": 0.3, "include_dev": True, "include_test": True},
        "sources": {n: {"url": (tmp / f"{n}.tar.gz").as_uri(), "archive_name": f"{n}.tar.gz", "version": "1", "license_id": "L"} for n in ("jesc", "kftt")},
        "smoke": {"input_jsonl": tmp / "trial.jsonl", "output_dir": tmp / "trial", "pair_count": 2, "minimum_free_gib": 1, "maximum_output_gib": 1},
        "device": {"require_cuda": True, "minimum_vram_gib": 16, "require_bf16": True, "attention": "sdpa"},
        "tts": {"model_id": "m", "revision": "r", "device": "cuda:0", "dtype": "bfloat16", "speaker": "s", "instruct": "", "max_new_tokens": 1, "do_sample": True, "subtalker_do_sample": True, "remove_invalid_values": True, "renormalize_logits": True, "output_sample_rate": 16000, "max_content_retries": 1},
        "asr": {"model_id": "a", "revision": "r", "dtype": "float16", "attention": "sdpa", "do_sample": False, "num_beams": 1, "condition_on_prev_tokens": False},
        "qc": {"max_ja_cer": 0.1, "max_en_wer": 0.1, "min_duration_seconds": 0.7, "max_duration_seconds": 30.0},
    }
    return raw


def archive(path, files):
    with tarfile.open(path, "w:gz") as t:
        for name, text in files.items():
            info = tarfile.TarInfo(name)
            info.size = len(text.encode())
            t.addfile(info, io.BytesIO(text.encode()))


@pytest.fixture
def corpus(tmp_path):
    tab = lambda ks: "".join(f"{EN[k]}\t{JA[k]}\n" for k in ks)
    archive(tmp_path / "jesc.tar.gz", {"split/train": tab([0, 1, 2]) + "Music\t音楽\n", "split/dev": tab([2]), "split/test": tab([3])})
    files = {}
    for s, ks in (("train", [4, 0]), ("dev", [1]), ("test", [4])):
        files |= {f"data/orig/kyoto-{s}.ja": "".join(JA[k] + "\n" for k in ks), f"data/orig/kyoto-{s}.en": "".join(EN[k] + "\n" for k in ks)}
    archive(tmp_path / "kftt.tar.gz", files)
    return tmp_path


def test_prepare_speak_release(spark, corpus):
    raw = settings(corpus)
    raw["prepare"]["target_train_hours"] = 0.0012
    c = config.settings(raw, https=False)
    (corpus / "sources").mkdir()
    (corpus / "sources" / "jesc.tar.gz.part").write_bytes(b"stale")
    with pytest.raises(ValueError, match="kftt"):  # its training rows are all repeats of evaluation rows or of the other corpus
        prepare(spark, c)
    archive(corpus / "kftt2.tar.gz", {f"data/orig/kyoto-{s}.{x}": t for s, a, b in (("train", JA[4] + "\n" + JA[0] + "\n" + JA[0] + JA[1] + "\n", EN[4] + "\n" + EN[0] + "\n" + EN[0] + " " + EN[1] + "\n"), ("dev", JA[1] + "\n", EN[1] + "\n"), ("test", JA[4] + "\n", EN[4] + "\n")) for x, t in (("ja", a), ("en", b))})
    raw["sources"]["kftt"] |= {"url": (corpus / "kftt2.tar.gz").as_uri(), "archive_name": "kftt2.tar.gz"}
    raw["prepare"] |= {"work_dir": corpus / "work2"}
    c = config.settings(raw, https=False)
    got = prepare(spark, c)
    assert got["ingestion"]["jesc"] == {"evaluation": {"eligible": 2, "duplicates": 0, "filtered": {}}, "train": {"eligible": 1, "duplicates": 2, "filtered": {"subtitle_cue": 1}}}
    assert got["ingestion"]["kftt"]["train"] == {"eligible": 1, "duplicates": 2, "filtered": {}}
    assert got["manifest_counts"] == {"train:jesc": 1, "train:kftt": 1, "dev:jesc": 1, "dev:kftt": 1, "test:jesc": 1, "test:kftt": 1}
    rows = manifests.read_manifest(spark, str(c.run.input_jsonl)).collect()
    assert len(rows) == 6 and set(json.loads(rows[0].json)) == set(manifests.FIELDS.fieldNames())
    assert prepare(spark, c)["reused"]
    with pytest.raises(ValueError, match="other settings"):
        raw["prepare"]["selection_seed"] = 1
        prepare(spark, config.settings(raw, https=False))

    p = shards.plan(spark, c)
    assert p["pairs"] == 6 and sum(p["shard_counts"]) == 6 and p["within_pair_limit"] and p["splits"] == {"dev": 2, "test": 2, "train": 2}
    dev = next(r for r in rows if r.en_text == EN[2])
    once = spark.range(1).select(ids.seed(F.lit(dev.pair_id), F.lit("en"), F.lit(0))).first()[0]
    misheard = tone_backend(lambda text, seed: text == JA[3] or seed == once)
    first = shards.run(spark, c, misheard, 0)
    with pytest.raises(ValueError, match="missing"):
        shards.consolidate(spark, c)
    rest = shards.run(spark, c, misheard)
    assert first["accepted"] + rest["accepted"] == 5 and first["rejected"] + rest["rejected"] == 1
    assert shards.run(spark, c, misheard) == {"accepted": 0, "rejected": 0}
    out = shards.consolidate(spark, c)
    assert out["complete"] and out["accepted_pairs"] == 5 and out["ja_hours"] > 0
    done = {r["en_text"]: r for p_ in sorted((c.run.output_dir / "manifests/releases/all.jsonl").glob("part-*")) for r in map(json.loads, p_.read_text().splitlines())}
    assert done[EN[2]]["en_attempt"] == 1 and done[EN[3]]["qc_reasons"] == ["ja_no_passing_attempt"] and len(done[EN[3]]["attempts"]["ja"]) == 2
    args = cli.parser().parse_args(["--config", "x", "smoke-test"])
    trial = cli.run(spark, args, c)
    assert trial["release"]["all_pairs_accepted"] and trial["selection"]["pairs"] == 2


def test_cli_needs_a_file(monkeypatch):
    monkeypatch.delenv(cli.CONFIG, raising=False)
    with pytest.raises(SystemExit):
        cli.main(["plan"])


def test_honest_runs(spark, corpus, monkeypatch):
    """No made-up speech unasked, provenance from the backend, an accelerator where one is needed, nothing lost that was written."""
    raw = settings(corpus, checkpoint_every=1, num_shards=1)
    rows = [{"pair_id": f"p{k}", "corpus": "jesc", "split": "train", "ja_text": JA[k % 5] + str(k), "en_text": EN[k % 5]} for k in range(20)]
    (corpus / "manifest.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows))
    c = config.settings(raw, https=False)
    with pytest.raises(ValueError, match="--backend"):
        cli.run(spark, cli.parser().parse_args(["run-shard", "--shard-index", "0"]), c)
    real = Backend("real", None, None, None)
    with pytest.raises(ValueError, match="CUDA"):
        shards.run(spark, c, real)
    made, once = [], shards._tried

    def breaks(*a):
        once(*a)
        made.append(1)
        if len(made) == 2:
            raise KeyboardInterrupt

    monkeypatch.setattr(shards, "_tried", breaks)
    with pytest.raises(KeyboardInterrupt):
        shards.run(spark, c, tone_backend())
    have = shards._attempts(spark, c, [0]).count()
    assert 0 < have < 40
    assert shards.run(spark, c, tone_backend()) == {"accepted": 20, "rejected": 0} and len(made) > 2
    done = spark.read.parquet(shards._folder(c, "qc")).collect()
    assert {(r.tts_model_id, r.qc_asr_model_id) for r in done} == {("tone", "tone")} and all(len(r.attempts.ja) == len(r.attempts.en) == 1 for r in done)
    assert spark.read.parquet(shards._folder(c, "generated")).count() == 40


def test_old_output_stays_if_the_new_one_fails(spark, tmp_path, monkeypatch):
    sinks.write_rows(spark.range(3), str(tmp_path / "x"))
    with pytest.raises(Exception, match="boom"):
        sinks.write_rows(spark.range(3).select(F.raise_error(F.lit("boom")).alias("x")), str(tmp_path / "x"))
    assert spark.read.parquet(str(tmp_path / "x")).count() == 3
    sinks.write_rows(spark.range(4), str(tmp_path / "x"))
    assert spark.read.parquet(str(tmp_path / "x")).count() == 4 and not list(tmp_path.glob("*.old"))


def test_config(tmp_path):
    raw = settings(tmp_path)
    for s in raw["sources"].values():
        s["url"] = "https://x/y.tar.gz"
    file = tmp_path / "c.json"
    file.write_text(json.dumps(raw, default=str))
    c = config.load(file)
    assert c.run.num_shards == 3 and isinstance(c.prepare.work_dir, Path) and config.trial_settings(c).run.num_shards == 1
    for section, name, bad in (("run", "num_shards", 0), ("prepare", "jesc_fraction", 1), ("prepare", "short_time_fraction", 0.3), ("tts", "dtype", "float32"), ("qc", "max_ja_cer", 2), ("smoke", "minimum_free_gib", 0)):
        with pytest.raises(ValueError):
            config.settings(raw | {section: raw[section] | {name: bad}})
    with pytest.raises(TypeError):
        config.settings(raw | {"run": raw["run"] | {"more": 1}})
    with pytest.raises(ValueError, match="https"):
        config.settings(settings(tmp_path))


def test_archives(tmp_path):
    archive(tmp_path / "bad.tar.gz", {"../escape.txt": "x"})
    with pytest.raises(ValueError, match="unsafe archive member"):
        archives.unpack(tmp_path / "bad.tar.gz", tmp_path / "a", "0")
    archive(tmp_path / "good.tar.gz", {"d/x.txt": "x"})
    got = archives.fetch((tmp_path / "good.tar.gz").as_uri(), tmp_path / "s" / "g.tar.gz")
    assert archives.fetch("file:///none", tmp_path / "s" / "g.tar.gz", got["sha256"])["reused"]
    for url, name in (((tmp_path / "good.tar.gz").as_uri(), "new"), ("file:///none", "g.tar.gz")):
        with pytest.raises(ValueError, match="digest"):
            archives.fetch(url, tmp_path / "s" / name, "0" * 64)
    place = archives.unpack(tmp_path / "s" / "g.tar.gz", tmp_path / "b", "1")
    assert (place / "d/x.txt").read_text() == "x" and archives.unpack(tmp_path / "s" / "g.tar.gz", place, "1") == place
    with pytest.raises(ValueError):
        archives.unpack(tmp_path / "s" / "g.tar.gz", place, "2")
    assert archives.first_existing(place, "nope", "d") == place / "d"
    with pytest.raises(FileNotFoundError):
        archives.first_existing(place, "nope")


def test_text_sources(spark, tmp_path):
    (tmp_path / "t").write_bytes("﻿a\tあ\r\n\"b\t\r\nc c\tう\u0085え".encode())
    got = [tuple(r) for r in pairs.tab_separated(spark, str(tmp_path / "t"), "dev").orderBy("source_index").collect()]
    assert got == [("dev", 1, "あ", "a"), ("dev", 2, "", '"b'), ("dev", 3, "う\u0085え", "c c")]
    (tmp_path / "u").write_text("a\tb\nc\n")
    with pytest.raises(ValueError, match="line 2"):
        pairs.tab_separated(spark, str(tmp_path / "u"), "dev")
    (tmp_path / "x.ja").write_text("一\n二\n")
    (tmp_path / "x.en").write_text("one\n")
    with pytest.raises(ValueError, match="numbers of lines"):
        pairs.aligned(spark, str(tmp_path / "x.ja"), str(tmp_path / "x.en"), "dev")
    (tmp_path / "long").write_text("".join(f"line {k}\n" for k in range(20000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1000")
        n = lines.numbered_lines(spark, str(tmp_path / "long"))
        assert n.rdd.getNumPartitions() > 3 and n.where("value <> concat('line ', line_no - 1)").count() == 0 and n.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_manifest_sources(spark, tmp_path):
    ok = {"pair_id": "a", "corpus": "c", "split": "train", "ja_text": "あ", "en_text": "a", "ja_chars": 3, "own": [1]}
    write = lambda *rows: (tmp_path / "m.jsonl").write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))
    write(ok, "", ok | {"pair_id": "b", "ja_chars": "x"})
    got = manifests.read_manifest(spark, str(tmp_path / "m.jsonl")).orderBy("line_no").collect()
    assert [(r.line_no, r.pair_id, r.ja_chars, json.loads(r.json)["own"]) for r in got] == [(1, "a", 3, [1]), (3, "b", None, [1])]
    for bad in (ok | {"pair_id": 1}, "[1]", "{", ok | {"ja_text": " "}, ok, ok | {"pair_id": "a b"}):
        write(ok, bad)
        with pytest.raises(ValueError):
            manifests.read_manifest(spark, str(tmp_path / "m.jsonl"))
    assert manifests.read_rows(spark, str(tmp_path / "none"), "a int").count() == 0 and manifests.stored_bytes(spark, str(tmp_path / "none")) == 0
    df = spark.createDataFrame([(2, None), (1, "é")], "b int, a string")
    for _ in range(2):
        sinks.write_lines(df, str(tmp_path / "w"), ["b"])
    assert "".join(p.read_text() for p in sorted((tmp_path / "w").glob("part-*"))) == '{"a":"é","b":1}\n{"a":null,"b":2}\n'
    assert manifests.read_rows(spark, str(tmp_path / "w"), "a string, b int").count() == 2
    sinks.write_rows(df, str(tmp_path / "p"))
    assert manifests.digests(spark, str(tmp_path / "p")).count() >= 1
    sinks.write_shards(df.withColumn("shard", F.col("b")), str(tmp_path / "s"))
    sinks.write_shards(df.where("b = 1").withColumn("shard", F.col("b")), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 2


def test_errors_of_backends():
    assert fatal(RuntimeError("CUDA error")) and not fatal(ValueError("cuda")) and not fatal(RuntimeError("text"))
    assert isinstance(tone_backend(), Backend)


def test_stream(spark, tmp_path):
    from lodeweave.streaming import ingest

    row = lambda k, split="train", t="2024-01-01T00:00:00Z": json.dumps({"corpus": "jesc", "split": split, "source_index": k, "ja_raw": JA[k % 5], "en_raw": EN[k % 5], "ts": t}, ensure_ascii=False)
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text("\n".join([row(0), row(1), row(5), row(2)]))
    known = ingest.accepted(spark.read.schema(ingest.ARRIVING).json(str(tmp_path / "in")).where("source_index = 2"))
    s = ingest.accepted(ingest.read(spark, str(tmp_path / "in")), known.select("fingerprint"))
    ingest.write(s, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    (tmp_path / "in/b.json").write_text("\n".join([row(1), row(3, t="2024-01-01T00:20:00Z")]))
    ingest.write(s, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.ja_raw for r in spark.read.parquet(str(tmp_path / "out")).collect()) == sorted([JA[0], JA[1], JA[3]])
    n = ingest.counts(spark.read.schema(ingest.ARRIVING).json(str(tmp_path / "in")))
    assert sum(r.rows for r in n.collect()) == 6
