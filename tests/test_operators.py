import random
import re

import pytest
from pyspark.sql import functions as F

from lodeweave.functions import ids
from lodeweave.operators import attempts, dedup, manifest, quota, release, rules, samples

EN = "Please call me when you arrive at the station."


def test_reasons(spark):
    cases = [
        ("jesc", "音楽", "Music", "subtitle_cue", 0, 0), ("jesc", "詳細はhttps://example.comです。", "Read the website for details.", "url_or_email", 0, 0), ("jesc", "短い", "Too short.", "too_short", 2, 2),
        ("jesc", " ​ ", EN, "empty", 0, 0), ("jesc", "これは&lt;b&gt;太字&lt;/b&gt;の文章です。", EN, "markup", 0, 0), ("jesc", "これは&amp;amp;です、長い文章。", EN, "markup", 0, 0), ("jesc", "（拍手）", EN, "subtitle_cue", 0, 0),
        ("jesc", "。。。！！！", "This is a valid sentence.", "no_content", 0, 0), ("jesc", "１２３４５６７８", "This is a valid sentence.", "no_content", 0, 0), ("jesc", "あ" * 161, "word " * 30, "too_long", 161, 30), ("kftt", "あ" * 161, "word " * 30, None, 161, 30),
        ("jesc", "あ" * 100, "word " * 51, "too_long", 100, 51), ("kftt", "あ" * 100, "word " * 51, None, 100, 51), ("jesc", "ABCDEFGHIJあいうえ", EN, "not_japanese", 14, 9), ("jesc", "佐々々々々々々々々木さん", EN, "not_japanese", 12, 9),
        ("jesc", "駅に着いたら電話してください", "One two three four приветпривет", "not_english", 14, 4), ("jesc", "あ" * 8, "a b c d e f g h i j", None, 8, 10), ("jesc", "あ" * 8, "a b c d e f g h i j k", "length_ratio", 8, 11), ("jesc", "あ" * 32, "one two three four", None, 32, 4),
        ("jesc", "あ" * 33, "one two three four", "length_ratio", 33, 4), ("jesc", "詳細はfoo@bar.com です、見てください。", EN, "url_or_email", 0, 0), ("jesc", "詳細はfoo@bar.comです、見てください。", EN, None, 20, 9), (None, None, EN, "empty", 0, 0), (None, "あ" * 161, "word " * 30, None, 161, 30),
    ]
    df = spark.createDataFrame([(k, c, ja, en, "x") for k, (c, ja, en, *_) in enumerate(cases)], "k int, corpus string, ja_raw string, en_raw string, reason string")
    out = rules.classified(df)
    got = {r.k: (r.reason, r.ja_chars, r.en_words) for r in out.collect()}
    assert got == {k: tuple(c[3:]) for k, c in enumerate(cases)}
    assert sum(r.rows for r in rules.histogram(out, "corpus").collect()) == sum(c[3] is not None for c in cases)
    splits = spark.createDataFrame([("dev",), ("test",), ("train",), (None,)], "split string")
    assert rules.gated(splits, dev=False).count() == 3 and rules.gated(splits).count() == 4
    assert rules.classified(df.limit(0)).count() == 0


def test_dedup_prefers_evaluation(spark):
    rows = [("jesc", "train", 1, "a"), ("jesc", "train", 2, "b"), ("kftt", "dev", 9, "a"), ("kftt", "train", 1, "b"), ("jesc", "test", 3, "c"), ("jesc", "dev", 7, "c"), ("kftt", "train", 5, None), ("kftt", "train", 6, None)]
    df = spark.createDataFrame([(*r, f"p{k}") for k, r in enumerate(rows)], "corpus string, split string, source_index long, fingerprint string, pair_id string")
    assert {r.pair_id for r in dedup.first_copies(df).collect()} == {"p2", "p1", "p5", "p6", "p7"}
    marked = dedup.ranked(df).withColumn("reason", F.lit(None).cast("string"))
    assert {(r.corpus, r.stage, r.eligible, r.duplicates) for r in dedup.accounting(marked).collect()} == {("jesc", "train", 1, 1), ("kftt", "train", 2, 1), ("kftt", "evaluation", 1, 0), ("jesc", "evaluation", 1, 1)}
    assert {(r.fingerprint, r.rows) for r in dedup.repeated_keys(df.where("fingerprint is not null"), "fingerprint").collect()} == {("a", 2), ("b", 2), ("c", 2)}


def loop(rows, hours, shares):
    """Quota selection one row at a time."""
    out = set()
    for corpus, h in hours.items():
        own = sorted((r for r in rows if r[1] == corpus), key=lambda r: r[3])
        for b, s in shares.items():
            t = 0.0
            for r in own:
                if r[2] == b and t < h * s * 3600:
                    out.add(r[0])
                    t += r[4]
        got = sum(r[4] for r in own if r[0] in out)
        if got < h * 3600:
            t = 0.0
            for r in own:
                if r[0] not in out and t < (h - got / 3600) * 3600:
                    out.add(r[0])
                    t += r[4]
    return out


@pytest.mark.parametrize("seed", range(3))
def test_quota_against_a_loop(spark, seed):
    rnd = random.Random(seed)
    rows = [(f"i{k}", rnd.choice(["jesc", "kftt"]), rnd.choice(["short", "short", "medium", "long"]), f"{rnd.getrandbits(256):064x}", rnd.choice([1.5, 2.0, 7.25])) for k in range(800)]
    hours, shares = {"jesc": rnd.choice([0.1, 0.3]), "kftt": 0.2}, {"short": 0.2, "medium": 0.5, "long": 0.3}
    df = quota.selected(spark.createDataFrame(rows, "pair_id string, corpus string, length_bin string, priority string, estimated_ja_seconds double"), hours, shares)
    assert {r.pair_id for r in df.where("selected").collect()} == loop(rows, hours, shares)
    with pytest.raises(ValueError):
        quota.require(df, {"jesc": 1000.0})


def test_quota_bounds(spark):
    df = spark.createDataFrame([(f"p{k}", "c", f"{k}", 2.0) for k in (1, 2, 3)] + [("n", None, "0", None)], "id string, g string, priority string, estimated_ja_seconds double")
    for target, n in ((0, 0), (1, 1), (2, 1), (3, 2), (4, 2), (5, 3), (7, 3)):
        assert quota.until(df.where("g = 'c'"), ["g"], F.lit(float(target))).where("taken").count() == n
    assert quota.until(df.limit(0), ["g"], F.lit(1.0)).count() == 0 and quota.until(df, ["g"], F.lit(1.0)).count() == 4


def manifest_rows(spark, n=20):
    return spark.createDataFrame([(f"pair_{i:04d}", "jesc" if i % 2 else "kftt", "train", f"日本語の文{i}です。", f"English {i}.", ids_[i % 3], i) for i, ids_ in ((i, ["short", "medium", "long"]) for i in range(n))], "pair_id string, corpus string, split string, ja_text string, en_text string, length_bin string, manifest_pos long")


def test_manifest(spark):
    df = manifest_rows(spark)
    assert [r.pairs for r in manifest.shard_counts(df, 4).orderBy("shard").collect()] == [6, 6, 5, 3]
    p = manifest.shard_plan(df, 40).first()
    assert (p.pairs, p.num_shards, p.mean_pairs_per_shard, p.minimum_pairs_per_shard) == (20, 40, 0.5, 0) and p.empty_shards > 0
    assert sorted(map(tuple, manifest.value_counts(df).collect())) == [("corpus", "jesc", 10), ("corpus", "kftt", 10), ("split", "train", 20)]
    parts = [{r.pair_id for r in manifest.shard_rows(df, k, 3, 100).collect()} for k in range(3)]
    assert sum(map(len, parts)) == 20 == len(set.union(*parts))
    for bad in (lambda: manifest.shard_rows(df, 3, 3, 100), lambda: manifest.shard_rows(df, 0, 1, 19), lambda: manifest.validated(df.limit(0)), lambda: manifest.validated(df.unionByName(df)), lambda: manifest.validated(df.withColumn("split", F.lit(" "))), lambda: manifest.validated(df.withColumn("pair_id", F.lit("a/b")))):
        with pytest.raises(ValueError):
            bad()
    assert manifest.validated(df) is df
    rows = [("train", "b", "0f"), ("train", "a", "ff"), ("train", "a", "00"), ("test", "a", "00"), ("dev", "b", "11"), ("other", "a", "01")]
    m = manifest.with_position(spark.createDataFrame([(*r, f"p{k}") for k, r in enumerate(rows)], "split string, corpus string, selection_priority string, pair_id string"))
    assert [r.pair_id for r in m.orderBy("manifest_pos").collect()] == ["p2", "p1", "p0", "p4", "p3", "p5"] == [r.pair_id for r in manifest.ordered(m).collect()]


def test_trial(spark):
    df = manifest_rows(spark)
    got = samples.trial(df, 5).orderBy("smoke_selection_index").collect()
    assert [(r.corpus, r.length_bin) for r in got] == list(samples.SLOTS) and [r.manifest_pos for r in got] == [3, 1, 5, 4, 2]
    assert [r.manifest_pos for r in samples.trial(df, 7).orderBy("smoke_selection_index").collect()] == [3, 1, 5, 4, 2, 0, 6]
    texts = [("そうです。", "Yes it is.", True), ("そうです", "Yes it is.", False), ("そうです。", "and then", False), ("Aです。", "Yes.", False), ("這是。", "Yes.", False), ("（あ）。", "Yes.", False), ("あ。", "Well... yes.", False), ("あ？  ", "Yes! ", True)]
    out = spark.createDataFrame(texts, "ja string, en string, ok boolean").select("ok", samples.complete(F.col("ja"), F.col("en")).alias("got")).collect()
    assert all(r.ok == r.got for r in out)
    with pytest.raises(ValueError):
        samples.required_trial(df, 21)


def test_attempts(spark):
    a = spark.createDataFrame([("p", "ja", 0, "ok", 1.0, 0.08, None), ("p", "ja", 1, "ok", 1.0, 0.03, None), ("p", "en", 1, "ok", 1.0, 0.03, None), ("p", "en", 0, "ok", 1.0, 0.03, None), ("q", "ja", 0, "failed", None, None, None), ("q", "en", 0, "ok", 31.0, 0.2, None), ("q", "en", 1, "ok", 0.7, None, "E"), ("r", "ja", 0, "ok", 30.0, 0.1, None)], "pair_id string, language string, attempt int, generation_status string, duration double, metric double, asr_error string")
    c = attempts.checked(a, {"ja": 0.1, "en": 0.1})
    got = {(r.pair_id, r.language, r.attempt): (r.qc_reasons, r.qc_pass) for r in c.collect()}
    assert got["q", "ja", 0] == (["generation_failed"], False) and got["q", "en", 0] == (["duration_out_of_range", "wer_above_threshold"], False)
    assert got["q", "en", 1] == (["asr_failed"], False) and got["r", "ja", 0] == ([], True)
    assert {(r.pair_id, r.language, r.attempt) for r in attempts.best(c).collect()} == {("p", "ja", 1), ("p", "en", 0), ("r", "ja", 0)}
    records = spark.createDataFrame([("p", "jesc"), ("q", None), ("r", "x"), ("s", "x")], "pair_id string, corpus string")
    n = attempts.nested(c)
    assert sorted(map(str, attempts.flat(n).select("pair_id", "language", "attempt").collect())) == sorted(map(str, a.select("pair_id", "language", "attempt").collect()))
    f = {r.pair_id: r for r in attempts.finalized(records.join(n, "pair_id", "left"), {"tts_model_id": "m"}).collect()}
    assert (f["p"].qc_status, f["p"].ja_attempt, f["p"].en_attempt, f["p"].ja_cer, f["p"].tts_model_id) == ("accepted", 1, 0, 0.03, "m")
    assert f["q"].qc_reasons == ["ja_no_passing_attempt", "en_no_passing_attempt"] == f["s"].qc_reasons and f["r"].qc_reasons == ["en_no_passing_attempt"] and f["r"].en_duration is None
    t = attempts.targets(records)
    assert t.count() == 8 and attempts.missing(t, a, 0).count() == 3 and attempts.unpassed(t, c).count() == 5 and attempts.unchecked(c, 0).count() == 0
    prior = spark.createDataFrame([("p", None, 1), ("p", "new", 2), ("z", "z", 3)], "pair_id string, corpus string, pos int")
    assert {(r.pair_id, r.corpus) for r in attempts.resumed(records, prior).collect()} == {("p", "new"), ("q", None), ("r", "x"), ("s", "x")}
    new = attempts.new_records(spark.createDataFrame([("p", "ａ", "b", None)], "pair_id string, ja_text string, en_text string, ja_text_raw string")).first()
    assert (new.ja_tts_text, new.ja_text_raw, new.en_text_raw, new.attempts.ja) == ("a", "ａ", "b", [])


def test_release(spark):
    rows = spark.createDataFrame([("a", "jesc", "accepted", 3600.0, 1800.0, 0, 1), ("b", None, "accepted", 0.0, 0.0, 0, 0), ("c", "x", "rejected", None, None, 2, 0)], "pair_id string, corpus string, qc_status string, ja_duration double, en_duration double, shard int, manifest_pos int")
    assert tuple(release.summary(rows).first()) == (3, 2, 1, 2 / 3, 1.0, 0.5) and tuple(release.summary(rows.limit(0)).first()) == (0, 0, 0, 0.0, 0.0, 0.0)
    assert {tuple(r) for r in release.by_corpus(rows).collect()} == {("jesc", 1), ("unknown", 1)}
    assert [r.shard for r in release.missing_shards(rows, 4).orderBy("shard").collect()] == [1, 3] and [r.pair_id for r in release.ordered(rows).collect()] == ["b", "a", "c"]
    assert release.rejected(rows).count() == 1
    assert ids.pcm16_gib(0) == 0


def test_texts_are_normalised_once_and_null_keys_are_spread(spark):
    pairs = spark.createDataFrame([("jesc", JA_ONE, "This is a valid sentence.")] * 4, "corpus string, ja_raw string, en_raw string")
    plan = rules.histogram(rules.classified(pairs), "corpus")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.index("Filter") < plan.index("ArrowEvalPython")
    rows = spark.range(1000).selectExpr("concat('p', id) as pair_id", "cast(null as string) as fingerprint", "'jesc' as corpus", "'train' as split", "id as source_index")
    got = dedup.ranked(rows)
    assert got.where("copy <> 1").count() == 0
    assert got.rdd.mapPartitions(lambda x: [sum(1 for _ in x)]).filter(lambda n: n > 500).count() == 0


JA_ONE = "駅に着いたら私に電話してください。"


def test_histogram_judges_a_line_once(spark):
    lines = [("a", "Music"), ("a", "&lt;b&gt; and more of it"), ("b", ""), ("b", None), (None, "Music"), ("a", "Music"), ("a", "One two three four five six seven.")]
    rows = rules.classified(spark.createDataFrame(lines, "corpus string, line string"), left="line", right="line")
    twice = rules.classified(spark.createDataFrame([(c, x, x) for c, x in lines], "corpus string, ja_raw string, en_raw string"))
    names = ["ja_norm", "en_norm", "reason", "ja_chars", "en_words"]
    assert rows.select(names).collect() == twice.select(names).collect()
    got = rules.histogram(rows, "corpus")
    assert {tuple(r) for r in got.collect()} == {("a", "subtitle_cue", 2), (None, "subtitle_cue", 1), ("a", "markup", 1), ("b", "empty", 2), ("a", "not_japanese", 1)}
    assert got._jdf.queryExecution().optimizedPlan().toString().count("applause") == 1


def test_quota_joins_no_rows_by_corpus_alone(spark):
    rows = spark.createDataFrame([(c, b, f"{k:064x}", 1.0 + k) for k, (c, b) in enumerate([("jesc", "short"), ("jesc", "long"), ("kftt", "short"), ("other", "short"), (None, "long"), ("jesc", None)])], "corpus string, length_bin string, priority string, estimated_ja_seconds double")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = quota.selected(rows, {"jesc": 1.0, "kftt": 0.0}, {"short": 0.5, "long": 0.5})
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert {(r.corpus, r.length_bin): r.selected for r in out.collect()} == {("jesc", "short"): True, ("jesc", "long"): True, ("kftt", "short"): False, ("other", "short"): False, (None, "long"): False, ("jesc", None): False}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert "SortMergeJoin" in plan and not re.search(r"SortMergeJoin(\(skew=\w+\))? \[(coalesce\()?corpus#\d+(, \), isnull\(corpus#\d+\))?\]", plan)
