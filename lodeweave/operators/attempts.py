"""Attempts at speech for each pair and language: targets, checks, the choice of the best, and final records.

Attempts are rows (pair_id, language, attempt, ...), which join and aggregate; ``nested`` and ``flat`` turn them to
and from the arrays that manifests hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeweave.functions import text as X

LANGUAGES = ("ja", "en")
METRICS = {"ja": "cer", "en": "wer"}
ATTEMPT = T.StructType([
    T.StructField("attempt", T.IntegerType()), T.StructField("seed", T.LongType()), T.StructField("generation_status", T.StringType()), T.StructField("generation_error", T.StringType()),
    T.StructField("wav_native", T.StringType()), T.StructField("wav_16k", T.StringType()), T.StructField("duration", T.DoubleType()), T.StructField("sha256", T.StringType()), T.StructField("tts_seconds", T.DoubleType()),
    T.StructField("asr_text", T.StringType()), T.StructField("asr_seconds", T.DoubleType()), T.StructField("reference_eval_norm", T.StringType()), T.StructField("asr_eval_norm", T.StringType()),
    T.StructField("cer", T.DoubleType()), T.StructField("wer", T.DoubleType()), T.StructField("metric", T.DoubleType()), T.StructField("qc_reasons", T.ArrayType(T.StringType())), T.StructField("qc_pass", T.BooleanType()), T.StructField("asr_error", T.StringType()),
])


def new_records(pairs: DataFrame) -> DataFrame:
    """Adds raw texts where there are none, texts to speak, and no attempts yet."""
    have = pairs.columns
    raw = {f"{s}_text_raw": F.coalesce(F.col(f"{s}_text_raw"), F.col(f"{s}_text")) if f"{s}_text_raw" in have else F.col(f"{s}_text") for s in LANGUAGES}
    none = F.array().cast(T.ArrayType(ATTEMPT))
    return pairs.withColumns(raw | {f"{s}_tts_text": X.normalized(F.col(f"{s}_text")) for s in LANGUAGES} | {"attempts": F.struct(none.alias("ja"), none.alias("en"))})


def resumed(new: DataFrame, prior: DataFrame, order: str = "pos") -> DataFrame:
    """Each new row, or in its place the last prior row of its pair_id; prior rows of other pairs go.

    prior has the columns of new and ``order``. Columns are taken as a whole: a prior null isn't filled from new.
    """
    columns = new.columns
    last = prior.groupBy("pair_id").agg(F.max_by(F.struct(*columns), F.col(order)).alias("__prior"))
    both = new.select(F.struct(*columns).alias("__new"), F.col("pair_id")).join(last, "pair_id", "left")
    return both.select(F.coalesce("__prior", "__new").alias("row")).select("row.*")


def targets(records: DataFrame) -> DataFrame:
    """(pair_id, language): both languages of each pair, Japanese first."""
    return records.select("pair_id", F.explode(F.array(*map(F.lit, LANGUAGES))).alias("language"))


def missing(wanted: DataFrame, attempts: DataFrame, attempt: int) -> DataFrame:
    """Targets that have no attempt of this number, failed ones included."""
    done = attempts.where(F.col("attempt") == attempt).select("pair_id", "language")
    return wanted.join(done, ["pair_id", "language"], "left_anti")


def unpassed(wanted: DataFrame, attempts: DataFrame) -> DataFrame:
    """Targets without a passing attempt: these are tried again."""
    return wanted.join(attempts.where("qc_pass").select("pair_id", "language"), ["pair_id", "language"], "left_anti")


def unchecked(attempts: DataFrame, attempt: int) -> DataFrame:
    return attempts.where((F.col("attempt") == attempt) & F.col("qc_pass").isNull())


def checked(attempts: DataFrame, limits: dict[str, float], least: float = 0.7, most: float = 30.0) -> DataFrame:
    """Adds qc_reasons and qc_pass from generation_status, duration, metric and asr_error.

    What wasn't generated fails for that alone. Else: a duration outside the closed range, an error rate above its
    language's limit (equal passes), a failed transcript; none of these is a pass. A missing duration is outside.
    """
    limit = F.lit(None).cast("double")
    name = F.lit(None).cast("string")
    for lang, x in limits.items():
        limit = F.when(F.col("language") == lang, float(x)).otherwise(limit)
        name = F.when(F.col("language") == lang, f"{METRICS.get(lang, 'metric')}_above_threshold").otherwise(name)
    failed = F.col("asr_error").isNotNull() | F.col("metric").isNull()
    found = F.array_compact(F.array(
        F.when(~F.coalesce(F.col("duration").between(least, most), F.lit(False)), F.lit("duration_out_of_range")),
        F.when(~failed & (F.col("metric") > limit), name),
        F.when(failed, F.lit("asr_failed")),
    ))
    ok = F.coalesce(F.col("generation_status") == "ok", F.lit(False))
    reasons = F.when(ok, found).otherwise(F.array(F.lit("generation_failed")))
    return attempts.withColumn("qc_reasons", reasons).withColumn("qc_pass", F.size("qc_reasons") == 0)


def best(attempts: DataFrame, *columns: str) -> DataFrame:
    """One row for each pair and language with a passing attempt: the lowest metric, then the lowest number."""
    names = columns or tuple(c for c in attempts.columns if c not in ("pair_id", "language"))
    pick = F.min_by(F.struct(*names), F.struct("metric", "attempt"))
    return attempts.where("qc_pass").groupBy("pair_id", "language").agg(pick.alias("best")).select("pair_id", "language", "best.*")


def best_of(attempts: Column) -> Column:
    """The same for an array of attempt structs; null if none passes."""
    passing = F.filter(attempts, lambda x: F.coalesce(x["qc_pass"], F.lit(False)))
    first = F.array_min(F.transform(passing, lambda x: F.struct(x["metric"].alias("metric"), x["attempt"].alias("attempt"))))
    return F.get(F.filter(passing, lambda x: (x["metric"] == first["metric"]) & (x["attempt"] == first["attempt"])), F.lit(0))


def nested(attempts: DataFrame) -> DataFrame:
    """(pair_id, attempts): arrays by language, in the order of attempts; empty where there are none."""
    none = F.array().cast(T.ArrayType(ATTEMPT))
    full = attempts.select("pair_id", "language", F.struct(*[(F.col(f.name) if f.name in attempts.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in ATTEMPT.fields]).alias("a"))
    by = lambda s: F.coalesce(F.sort_array(F.collect_list(F.when(F.col("language") == s, F.col("a")))), none).alias(s)
    return full.groupBy("pair_id").agg(*[by(s) for s in LANGUAGES]).select("pair_id", F.struct(*LANGUAGES).alias("attempts"))


def flat(records: DataFrame) -> DataFrame:
    """Attempt rows of records with nested arrays."""
    by = F.map_from_arrays(F.array(*map(F.lit, LANGUAGES)), F.array(*[F.col(f"attempts.{s}") for s in LANGUAGES]))
    return records.select("pair_id", F.explode(by).alias("language", "own")).select("pair_id", "language", F.explode("own").alias("a")).select("pair_id", "language", "a.*")


def finalized(records: DataFrame, constants: dict[str, str] | None = None) -> DataFrame:
    """Adds qc_status, qc_reasons and the chosen attempt's fields for both languages to records with nested attempts.

    accepted needs a passing attempt in both languages; fields of a language without one are null. ``constants`` are
    provenance columns.
    """
    df = records.withColumns({f"__{s}": best_of(F.col(f"attempts.{s}")) for s in LANGUAGES})
    none = {s: F.col(f"__{s}").isNull() for s in LANGUAGES}
    out = {"qc_status": F.when(none["ja"] | none["en"], "rejected").otherwise("accepted"), "qc_reasons": F.array_compact(F.array(*[F.when(none[s], F.lit(f"{s}_no_passing_attempt")) for s in LANGUAGES]))}
    for s in LANGUAGES:
        out |= {f"{s}_{f}": F.col(f"__{s}.{f}") for f in ("attempt", "wav_16k", "wav_native", "duration", "sha256", "asr_text")} | {f"{s}_{METRICS[s]}": F.col(f"__{s}.metric")}
    return df.withColumns(out | {k: F.lit(v) for k, v in (constants or {}).items()}).drop("__ja", "__en")
