"""The engine's operators as queries over the standard tables, each with the SQL it is compared with.

The tables stand in for the engine's inputs: neighbouring turns of conversations for text pairs, documents for
candidates (their splits and corpora follow from doc_id), lines of documents for short texts, events for attempts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeweave.functions import ids, rates
from lodeweave.functions import text as X
from lodeweave.operators import attempts, dedup, manifest, quota, release, rules, samples
from lodeweave.plans.registry import query
from lodeweave.scratch import written
from lodeweave.session import spread, table

SEED = 20260723
SHARDS = 128
SHORT, MEDIUM = 600, 2000
PER_SECOND, PADDING = 5.5, 0.5
HOURS = {"jesc": 8.0, "kftt": 5.0}
SHARES = {"short": 0.2, "medium": 0.5, "long": 0.3}
#: Limits by which the tables' Latin texts are told apart.
LATIN = rules.Profile(caps={"jesc": (1600, 300)}, cap=(4000, 700), left_share=0.9, ratio=(0.05, 8.0), left_letters=X.ascii_letters, names=("not_latin", "not_english"))
LINES = rules.Profile(caps={}, cap=(600, 120), left_share=0.9, ratio=(3.5, 8.0), left_letters=X.ascii_letters, names=("not_latin", "not_english"))

# ---- pieces of SQL

_CTRL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f\x{200b}-\x{200f}\x{feff}]"


def _norm(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace({x}, '{_CTRL}', '', 'g'), '[\s\x{{85}}\x{{a0}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{3000}}]+', ' ', 'g'))"


def _units(x: str) -> str:
    return rf"length(regexp_replace({x}, '[^\p{{L}}\p{{N}}_\x{{3040}}-\x{{30ff}}\x{{3400}}-\x{{9fff}}]+', '', 'g'))"


def _words(x: str) -> str:
    return rf"len(regexp_extract_all({x}, '[A-Za-z]+(?:[''’-][A-Za-z]+)?'))"


def _only(x: str, keep: str) -> str:
    return f"length(regexp_replace({x}, '[^{keep}]', '', 'g'))"


_LINK = r"'(?i)https?://|www\.|\b[\w.+-]+@[\w.-]+\.[A-Za-z]{2,}\b'"
_MARKUP = "'(?i)<[^>]+>|&(?:amp|apos|gt|lt|nbsp|quot);'"
_CUE = r"'(?i)^\s*[\[(（【]?\s*(?:" + "|".join(X.CUES) + r")\s*[\])）】]?\s*[.!。…-]*\s*$'"
_CONTENT = r"'[A-Za-z\x{3040}-\x{30ff}\x{3400}-\x{9fff}]'"


def _reason(p: rules.Profile) -> str:
    """The rules of a Latin profile, over ja_norm, en_norm, n, w and corpus."""
    cap = [f"CASE corpus {' '.join(f"WHEN '{c}' THEN {v[k]}" for c, v in p.caps.items())} ELSE {p.cap[k]} END" if p.caps else str(p.cap[k]) for k in (0, 1)]
    either = lambda pattern: f"regexp_matches(ja_norm, {pattern}) OR regexp_matches(en_norm, {pattern})"
    return f"""CASE WHEN ja_norm = '' OR en_norm = '' THEN 'empty' WHEN {either(_LINK)} THEN 'url_or_email' WHEN {either(_MARKUP)} THEN 'markup'
        WHEN {either(_CUE)} THEN 'subtitle_cue' WHEN NOT regexp_matches(ja_norm, {_CONTENT}) OR NOT regexp_matches(en_norm, {_CONTENT}) THEN 'no_content'
        WHEN n < {p.least[0]} OR w < {p.least[1]} THEN 'too_short' WHEN n > {cap[0]} OR w > {cap[1]} THEN 'too_long'
        WHEN {_only('ja_norm', 'A-Za-z')}::DOUBLE / greatest(n, 1) < {p.left_share} THEN '{p.names[0]}'
        WHEN {_only('en_norm', 'A-Za-z')}::DOUBLE / greatest({_only('en_norm', chr(92) + 'p{L}')}, 1) < {p.right_share} THEN '{p.names[1]}'
        WHEN NOT n::DOUBLE / greatest(w, 1) BETWEEN {p.ratio[0]} AND {p.ratio[1]} THEN 'length_ratio' END"""


_EARLY = "('empty', 'url_or_email', 'markup', 'subtitle_cue', 'no_content')"
_PAIRS = f"""pairs AS (SELECT u.conv_id, u.turn, CASE WHEN u.conv_id % 2 = 0 THEN 'kftt' ELSE 'jesc' END AS corpus, {_norm('u.text')} AS ja_norm, {_norm('a.text')} AS en_norm
    FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'),
  counted AS (SELECT *, {_units('ja_norm')} AS n, {_words('en_norm')} AS w FROM pairs)"""
_DOCS = f"""docs AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'kftt' ELSE 'jesc' END AS corpus, CASE doc_id % 10 WHEN 0 THEN 'dev' WHEN 1 THEN 'test' ELSE 'train' END AS split,
    {_norm('text')} AS ja_norm, lang AS en_norm FROM documents),
  cand AS (SELECT *, {_units('ja_norm')} AS ja_chars, {_words('ja_norm')} AS en_words, sha256(concat(ja_norm, chr(0), en_norm)) AS fingerprint FROM docs),
  named AS (SELECT *, concat(corpus, '_', split, '_', lpad(doc_id::VARCHAR, greatest(8, length(doc_id::VARCHAR))::INTEGER, '0'), '_', substr(fingerprint, 1, 12)) AS pair_id FROM cand),
  full_ AS (SELECT *, sha256(concat('{SEED}', chr(0), pair_id)) AS priority, CASE WHEN ja_chars <= {SHORT} THEN 'short' WHEN ja_chars <= {MEDIUM} THEN 'medium' ELSE 'long' END AS length_bin,
    ja_chars / CAST({PER_SECOND} AS DOUBLE) + CAST({PADDING} AS DOUBLE) AS est FROM named)"""
_PHASE = "CASE corpus WHEN 'jesc' THEN 0 ELSE 1 END + CASE WHEN split = 'train' THEN 3 ELSE 0 END, CASE WHEN split = 'test' THEN 1 ELSE 0 END, doc_id"
_RANKED = f"{_DOCS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY fingerprint ORDER BY {_PHASE}) AS copy FROM full_)"
_GOALS = ", ".join(f"('{c}', '{b}', CAST({x!r} AS DOUBLE), CAST({y!r} AS DOUBLE))" for c, b, x, y in quota.targets_of(HOURS, SHARES))
_SELECTED = f"""{_RANKED}, train AS (SELECT * FROM ranked WHERE copy = 1 AND split = 'train'), goals(c, b, bin_goal, goal) AS (VALUES {_GOALS}),
  one AS (SELECT *, coalesce(sum(est) OVER (PARTITION BY corpus, length_bin ORDER BY priority ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), CAST(0 AS DOUBLE)) < bin_goal AS first_ FROM train JOIN goals ON c = corpus AND b = length_bin),
  got AS (SELECT corpus AS gc, coalesce(sum(est) FILTER (WHERE first_), CAST(0 AS DOUBLE)) AS got FROM one GROUP BY ALL),
  two AS (SELECT *, coalesce(sum(CASE WHEN first_ THEN CAST(0 AS DOUBLE) ELSE est END) OVER (PARTITION BY corpus ORDER BY priority ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), CAST(0 AS DOUBLE)) AS prior FROM one JOIN got ON gc = corpus),
  chosen AS (SELECT *, first_ OR (NOT first_ AND got < goal AND prior < (goal / 3600 - got / 3600) * 3600) AS selected FROM two)"""
_MANIFEST = f"""{_SELECTED}, kept AS (SELECT pair_id, corpus, split, priority, ja_chars, length_bin, est, ja_norm FROM chosen WHERE selected UNION ALL
    SELECT pair_id, corpus, split, priority, ja_chars, length_bin, est, ja_norm FROM ranked WHERE copy = 1 AND split <> 'train')"""
_SHARD = "concat('0x', substr(sha256(pair_id), 1, 16))::UBIGINT"
_TRIES = """tries AS (SELECT user_id, CASE WHEN event_id % 2 = 0 THEN 'ja' ELSE 'en' END AS language, event_id AS attempt, value AS metric, value / 10 AS duration, event_type FROM events),
  judged AS (SELECT *, CASE WHEN event_type = 'error' THEN 'generation_failed' ELSE concat_ws(',', CASE WHEN NOT duration BETWEEN 0.7 AND 30.0 THEN 'duration_out_of_range' END,
      CASE WHEN metric > 12.0 AND language = 'ja' THEN 'cer_above_threshold' WHEN metric > 9.0 AND language = 'en' THEN 'wer_above_threshold' END) END AS reasons FROM tries)"""

# ---- staging


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's turn and the answer, joined by position."""
    c = table(spark, sf_dir, "conversations")
    left = c.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("ja_raw"))
    right = c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("en_raw"))
    return spread(left.join(right, ["conv_id", "turn"])).withColumn("corpus", F.when(F.col("conv_id") % 2 == 0, "kftt").otherwise("jesc"))


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as candidates with ids, priorities and bins."""
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    split = F.when(F.col("doc_id") % 10 == 0, "dev").when(F.col("doc_id") % 10 == 1, "test").otherwise("train")
    df = d.select("doc_id", F.col("doc_id").alias("source_index"), F.when(F.col("doc_id") % 3 == 0, "kftt").otherwise("jesc").alias("corpus"), split.alias("split"), X.normalized(F.col("text")).alias("ja_norm"), F.col("lang").alias("en_norm"))
    df = df.select("*", X.script_units(F.col("ja_norm")).cast("long").alias("ja_chars"), X.latin_words(F.col("ja_norm")).cast("long").alias("en_words"), ids.fingerprint(F.col("ja_norm"), F.col("en_norm")).alias("fingerprint"))
    df = df.withColumn("pair_id", ids.pair_id(F.col("corpus"), F.col("split"), F.col("source_index"), F.col("fingerprint")))
    return df.select("*", ids.priority(SEED, F.col("pair_id")).alias("priority"), ids.length_bin(F.col("ja_chars"), SHORT, MEDIUM).alias("length_bin"), ids.spoken_seconds(F.col("ja_chars"), PER_SECOND, PADDING).alias("estimated_ja_seconds"))


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates for plans that read them more than once, written so that texts are normalised once."""
    return written(_candidates(spark, sf_dir), "candidates")


def _chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = dedup.first_copies(_candidates(spark, sf_dir)).where("split = 'train'")
    return quota.selected(train, HOURS, SHARES)


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = written(dedup.first_copies(_candidates(spark, sf_dir)), "first-copies")
    chosen = quota.selected(first.where("split = 'train'"), HOURS, SHARES)
    return manifest.kept(chosen.unionByName(first.where("split <> 'train'"), allowMissingColumns=True))


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    language = F.when(F.col("event_id") % 2 == 0, "ja").otherwise("en")
    return e.select(F.col("user_id").alias("pair_id"), language.alias("language"), F.col("event_id").alias("attempt"), F.when(F.col("event_type") == "error", "failed").otherwise("ok").alias("generation_status"), F.col("value").alias("metric"), (F.col("value") / 10).alias("duration"), F.lit(None).cast("string").alias("asr_error"))


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attempts.checked(_attempts(spark, sf_dir), {"ja": 12.0, "en": 9.0})


def _long(c: str | Column) -> Column:
    return F.col(c).cast("long") if isinstance(c, str) else c.cast("long")


# ---- text


@query("normalize_text", f"SELECT doc_id, {_norm('text')} AS norm FROM documents")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", X.normalized(F.col("text")).alias("norm"))


def _entities(x: str) -> str:
    """The entities that the pages have, the ampersand's last, so that each is decoded once."""
    for name, c in (("copy", "©"), ("middot", "·"), ("nbsp", " "), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "''"), ("amp", "&")):
        x = f"replace({x}, '&{name};', '{c}')"
    return x


@query("nfkc_norm", f"SELECT page_id, {_norm(_entities('html'))} AS norm FROM pages")
def nfkc_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", X.normalized(F.col("html"), terminated=True).alias("norm"))


@query("reject_reasons", f"WITH {_PAIRS}, r AS (SELECT *, {_reason(LATIN)} AS reason FROM counted) SELECT conv_id, turn, reason, CASE WHEN reason IN {_EARLY} THEN 0 ELSE n END AS ja_chars, CASE WHEN reason IN {_EARLY} THEN 0 ELSE w END AS en_words FROM r")
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.classified(_pairs(spark, sf_dir), LATIN).select("conv_id", "turn", "reason", "ja_chars", "en_words")


_LINE_ROWS = f"""lines AS (SELECT source AS corpus, unnest(string_split(text, chr(10))) AS line FROM documents), normed AS (SELECT corpus, {_norm('line')} AS ja_norm, {_norm('line')} AS en_norm FROM lines),
  counted AS (SELECT *, {_units('ja_norm')} AS n, {_words('en_norm')} AS w FROM normed), r AS (SELECT *, {_reason(LINES)} AS reason FROM counted)"""


@query("reject_histogram", f"WITH {_LINE_ROWS} SELECT corpus, reason, count(*) AS rows FROM r WHERE reason IS NOT NULL GROUP BY ALL")
def reject_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spread(table(spark, sf_dir, "documents").select("source", "text")).select(F.col("source").alias("corpus"), F.explode(F.split("text", "\n")).alias("line"))
    return rules.histogram(rules.classified(lines, LINES, "line", "line"), "corpus")


@query("markup_url_flags", f"SELECT page_id, regexp_matches(html, {_MARKUP}) AS markup, regexp_matches(html, {_LINK}) AS link FROM pages")
def markup_url_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", X.has_markup(F.col("html")).alias("markup"), X.has_link(F.col("html")).alias("link"))


@query("word_counts", f"SELECT doc_id, {_words('text')} AS words, {_units('text')} AS units, {_only('text', 'A-Za-z')} AS ascii_letters, {_only('text', chr(92) + 'p{L}')} AS letters FROM documents")
def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", _long(X.latin_words(t)).alias("words"), _long(X.script_units(t)).alias("units"), _long(X.ascii_letters(t)).alias("ascii_letters"), _long(X.letters(t)).alias("letters"))


@query("cer", "SELECT p_partkey, levenshtein(p_name, p_type)::DOUBLE / greatest(length(p_name), 1) AS cer FROM part")
def cer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part's type as if it were a transcript of its name; both are ASCII, as DuckDB's distance is by byte."""
    return table(spark, sf_dir, "part").select("p_partkey", rates.character_error_rate(F.col("p_name"), F.col("p_type")).alias("cer"))


@query("wer", r"""WITH p AS (SELECT u.conv_id, u.turn, list_filter(regexp_split_to_array(u.text, '[\s\x{85}\x{a0}\x{2000}-\x{200a}\x{2028}\x{2029}\x{3000}]+'), lambda w: w <> '') AS r,
    list_filter(regexp_split_to_array(a.text, '[\s\x{85}\x{a0}\x{2000}-\x{200a}\x{2028}\x{2029}\x{3000}]+'), lambda w: w <> '') AS h FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'),
  k AS (SELECT *, list_distinct(list_concat(r, h)) AS known FROM p), c AS (SELECT conv_id, turn, list_transform(r, lambda w: list_position(known, w)::BIGINT) AS r, list_transform(h, lambda w: [list_position(known, w)::BIGINT]) AS h FROM k),
  d AS (SELECT conv_id, turn, len(r) AS n, list_reduce(h, lambda before, x: list_reduce(list_transform(range(1, len(r) + 1), lambda i: [i]), lambda now, i: list_append(now, least(before[i[1] + 1] + 1, now[i[1]] + 1, before[i[1]] + CASE WHEN r[i[1]] = x[1] THEN 0 ELSE 1 END)), [before[1] + 1]), range(0, len(r) + 1)) AS last FROM c)
  SELECT conv_id, turn, last[n + 1]::DOUBLE / greatest(n, 1) AS wer FROM d""")  # fmt: skip
def wer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn's answer against the turn, word by word; the SQL is a dynamic programme over lists."""
    return _pairs(spark, sf_dir).select("conv_id", "turn", rates.word_error_rate(F.col("ja_raw"), F.col("en_raw")).alias("wer"))


# ---- ids, bins and shards


@query("length_bins", f"WITH {_DOCS} SELECT doc_id, length_bin, ja_chars, round(est, 6) AS seconds FROM full_")
def length_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir).select("doc_id", "length_bin", "ja_chars", F.round("estimated_ja_seconds", 6).alias("seconds"))


@query("fingerprint", f"WITH {_DOCS} SELECT doc_id, fingerprint FROM cand")
def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir).select("doc_id", "fingerprint")


@query("pair_ids", f"WITH {_DOCS} SELECT doc_id, pair_id, concat(corpus, ':', split, ':', doc_id) AS source_id FROM named")
def pair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir).select("doc_id", "pair_id", ids.source_id(F.col("corpus"), F.col("split"), F.col("source_index")).alias("source_id"))


@query("selection_priority", f"WITH {_DOCS} SELECT pair_id, priority FROM full_")
def selection_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir).select("pair_id", "priority")


@query("stable_shard", f"WITH {_DOCS} SELECT pair_id, ({_SHARD} % {SHARDS})::INTEGER AS shard, printf('shard-%05d-of-%05d', ({_SHARD} % {SHARDS})::INTEGER, {SHARDS}) AS name FROM named")
def stable_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.sharded(_candidates(spark, sf_dir), SHARDS).select("pair_id", "shard", ids.shard_name(F.col("shard"), SHARDS).alias("name"))


@query("deterministic_seed", f"WITH {_DOCS}, s AS (SELECT pair_id, language, attempt, concat('0x', substr(sha256(concat(pair_id, chr(0), language, chr(0), attempt)), 1, 16))::UBIGINT AS u FROM named, (VALUES ('ja'), ('en')) l(language), (VALUES (0), (1)) a(attempt)) SELECT pair_id, language, attempt, (u % 9223372036854775808)::BIGINT AS seed FROM s")
def deterministic_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = attempts.targets(_candidates(spark, sf_dir)).withColumn("attempt", F.explode(F.array(F.lit(0), F.lit(1))))
    return each.withColumn("seed", ids.seed(F.col("pair_id"), F.col("language"), F.col("attempt")))


@query("shard_counts", f"WITH {_DOCS}, s AS (SELECT ({_SHARD} % {SHARDS})::INTEGER AS shard FROM named) SELECT r.range::INTEGER AS shard, count(s.shard) AS pairs FROM range({SHARDS}) r LEFT JOIN s ON s.shard = r.range GROUP BY ALL")
def shard_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.shard_counts(_candidates(spark, sf_dir), SHARDS)


@query("shard_plan", f"""WITH {_DOCS}, s AS (SELECT ({_SHARD} % {SHARDS})::INTEGER AS shard FROM named), c AS (SELECT count(s.shard) AS n FROM range({SHARDS}) r LEFT JOIN s ON s.shard = r.range GROUP BY r.range)
  SELECT sum(n)::BIGINT AS pairs, count(*) AS num_shards, count(*) FILTER (WHERE n = 0) AS empty_shards, min(n) AS minimum_pairs_per_shard, max(n) AS maximum_pairs_per_shard, avg(n) AS mean_pairs_per_shard FROM c""")  # fmt: skip
def shard_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.shard_plan(_candidates(spark, sf_dir), SHARDS)


@query("value_counts", f"WITH {_DOCS} SELECT 'corpus' AS field, corpus AS value, count(*) AS pairs FROM docs GROUP BY ALL UNION ALL SELECT 'split', split, count(*) FROM docs GROUP BY ALL")
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.value_counts(_candidates(spark, sf_dir))


# ---- dedup and accounting


@query("dedup_keep_first", f"WITH {_RANKED} SELECT pair_id, split, fingerprint FROM ranked WHERE copy = 1")
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.first_copies(_candidates(spark, sf_dir)).select("pair_id", "split", "fingerprint")


@query("eval_leak_guard", f"WITH {_RANKED}, e AS (SELECT DISTINCT fingerprint AS f FROM ranked WHERE split <> 'train') SELECT pair_id, copy FROM ranked JOIN e ON f = fingerprint WHERE split = 'train'")
def eval_leak_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows that repeat an evaluation row: none of them has copy 1."""
    rows = dedup.ranked(_stored(spark, sf_dir).select("corpus", "split", "source_index", "pair_id", "fingerprint"))
    seen = rows.where("split <> 'train'").select("fingerprint")
    return rows.where("split = 'train'").join(seen, "fingerprint", "left_semi").select("pair_id", _long("copy").alias("copy"))


_INGEST = f"""{_DOCS}, judged AS (SELECT *, ja_chars > 1600 AS bad FROM full_), numbered AS (SELECT *, CASE WHEN NOT bad THEN row_number() OVER (PARTITION BY fingerprint, bad ORDER BY {_PHASE}) END AS copy FROM judged)"""


@query("ingest_accounting", f"WITH {_INGEST} SELECT corpus, CASE WHEN split = 'train' THEN 'train' ELSE 'evaluation' END AS stage, count(*) FILTER (WHERE bad) AS filtered, count(*) FILTER (WHERE NOT bad AND copy = 1) AS eligible, count(*) FILTER (WHERE NOT bad AND copy > 1) AS duplicates FROM numbered GROUP BY ALL")
def ingest_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a length rule rejects don't take part in dedup."""
    rows = rules.gated(_candidates(spark, sf_dir)).withColumn("reason", F.when(F.col("ja_chars") > 1600, "too_long"))
    rows = rows.withColumn("key", F.when(F.col("reason").isNull(), F.col("fingerprint")))
    return dedup.accounting(dedup.ranked(rows, "key"))


@query("repeated_keys", f"WITH {_DOCS} SELECT fingerprint, count(*) AS rows FROM cand GROUP BY ALL HAVING count(*) > 1")
def repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.repeated_keys(_candidates(spark, sf_dir), "fingerprint")


# ---- quotas and manifests


@query("quota_select", f"WITH {_SELECTED} SELECT pair_id, first_ AS taken FROM one")
def quota_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each length bin up to its own target, without backfill."""
    train = written(dedup.first_copies(_candidates(spark, sf_dir)).where("split = 'train'"), "train")
    goal = F.lit(None).cast("double")
    for c, b, seconds, _ in quota.targets_of(HOURS, SHARES):
        goal = F.when((F.col("corpus") == c) & (F.col("length_bin") == b), seconds).otherwise(goal)
    return quota.until(train, ["corpus", "length_bin"], goal).select("pair_id", "taken")


@query("quota_backfill", f"WITH {_SELECTED} SELECT pair_id, corpus, length_bin, priority, selected FROM chosen")
def quota_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chosen(spark, sf_dir).select("pair_id", "corpus", "length_bin", "priority", "selected")


@query("selected_hours", f"WITH {_SELECTED} SELECT corpus, length_bin, count(*) FILTER (WHERE selected) AS selected_pairs, round(coalesce(sum(est) FILTER (WHERE selected), 0) / 3600, 6) AS selected_hours, round(sum(est) / 3600, 6) AS available_hours FROM chosen GROUP BY ALL")
def selected_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quota.selection_summary(_chosen(spark, sf_dir)).withColumns({c: F.round(c, 6) for c in ("selected_hours", "available_hours")})


_VERSIONS = [("jesc", "2.0", "CC-BY-SA-4.0"), ("kftt", "1.0", "CC-BY-SA-3.0")]


@query("manifest_rows", f"WITH {_MANIFEST}, src(corpus, v, l) AS (VALUES {', '.join(map(str, _VERSIONS))}) SELECT pair_id, k.corpus, split, v AS corpus_version, l AS license_id, '{manifest.NORMALIZER}' AS normalizer_version, priority AS selection_priority, row_number() OVER (ORDER BY CASE split WHEN 'train' THEN 0 WHEN 'dev' THEN 1 ELSE 2 END, k.corpus, priority) - 1 AS manifest_pos, ja_norm AS ja_text FROM kept k JOIN src USING (corpus)")
def manifest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = spark.createDataFrame(_VERSIONS, "corpus string, corpus_version string, license_id string")
    rows = _manifest(spark, sf_dir).withColumns({"ja_raw": F.col("ja_norm"), "en_raw": F.col("en_norm"), "source_id": ids.source_id(F.col("corpus"), F.col("split"), F.col("source_index"))})
    return manifest.with_position(manifest.rows_of(rows, sources)).select("pair_id", "corpus", "split", "corpus_version", "license_id", "normalizer_version", "selection_priority", _long("manifest_pos").alias("manifest_pos"), "ja_text")


@query("manifest_counts", f"WITH {_MANIFEST} SELECT concat(split, ':', corpus) AS key, count(*) AS pairs FROM kept GROUP BY ALL")
def manifest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.split_counts(_manifest(spark, sf_dir))


@query("invalid_fields", "SELECT conv_id, turn, concat_ws(',', CASE WHEN trim(text) = '' THEN 'ja_text' END) AS invalid, NOT regexp_full_match(concat(conv_id, '_', turn, CASE WHEN turn = 2 THEN '/' ELSE '' END), '[A-Za-z0-9_-]{1,96}') AS unsafe FROM conversations")
def invalid_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    rows = c.select("conv_id", "turn", F.concat("conv_id", F.lit("_"), "turn", F.when(F.col("turn") == 2, "/").otherwise("")).alias("pair_id"), F.col("role").alias("corpus"), F.col("role").alias("split"), F.col("text").alias("ja_text"), F.col("role").alias("en_text"))
    return manifest.invalid_fields(rows).select("conv_id", "turn", F.array_join("invalid", ",").alias("invalid"), "unsafe")


@query("positional_zip", f"WITH {_PAIRS} SELECT conv_id, turn, ja_norm AS ja, en_norm AS en FROM pairs")
def positional_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("conv_id", "turn", X.normalized_plain(F.col("ja_raw")).alias("ja"), X.normalized_plain(F.col("en_raw")).alias("en"))


@query("line_numbers", "WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents), n AS (SELECT doc_id, unnest(x) AS line, generate_subscripts(x, 1) AS line_no FROM l) SELECT doc_id, line_no, line FROM n")
def line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    return lines.select("doc_id", (F.col("n") + 1).cast("long").alias("line_no"), "line")


# ---- trial samples


_GOOD = r"regexp_matches(rtrim(ja_norm), '[.。！？!?]$') AND NOT regexp_matches(ja_norm, '\.\.\.|[…()（）\[\]【】]')"
_SLOTS = (("jesc", "short"), ("jesc", "medium"), ("jesc", "long"), ("kftt", "medium"), ("kftt", "long"))


@query("smoke_slots", f"""WITH {_DOCS}, good AS (SELECT *, CASE {' '.join(f"WHEN corpus = '{c}' AND length_bin = '{b}' THEN {k}" for k, (c, b) in enumerate(_SLOTS))} END AS slot FROM full_ WHERE split = 'train' AND {_GOOD}),
  r AS (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY doc_id) AS k FROM good), o AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN k = 1 THEN slot END NULLS LAST, doc_id) - 1 AS i FROM r)
  SELECT pair_id, i::INTEGER AS smoke_selection_index FROM o WHERE i < 8""")  # fmt: skip
def smoke_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight training documents for a trial: the first of each slot, then others; that number is the feature."""
    rows = _stored(spark, sf_dir).withColumns({"ja_text": F.col("ja_norm"), "en_text": F.col("ja_norm"), "manifest_pos": F.col("doc_id")})
    return samples.trial(rows, 8, _SLOTS, latin=True).select("pair_id", "smoke_selection_index")


@query("complete_sentences", f"WITH {_DOCS} SELECT doc_id, {_GOOD} AND regexp_matches(ja_norm, '[.!?]$') AS complete FROM docs")
def complete_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir).select("doc_id", samples.complete(F.col("ja_norm"), F.col("ja_norm"), latin=True).alias("complete"))


# ---- attempts and resuming


@query("retry_targets", f"WITH {_TRIES}, t AS (SELECT DISTINCT user_id AS pair_id, language FROM events, (VALUES ('ja'), ('en')) l(language)) SELECT pair_id, language FROM t WHERE NOT EXISTS (SELECT 1 FROM judged j WHERE j.user_id = t.pair_id AND j.language = t.language AND j.reasons = '')")
def retry_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = attempts.targets(table(spark, sf_dir, "events").select(F.col("user_id").alias("pair_id")).distinct())
    return attempts.unpassed(wanted, _checked(spark, sf_dir))


@query("missing_attempts", "SELECT d.doc_id AS pair_id, l.language FROM documents d, (VALUES ('ja'), ('en')) l(language) WHERE NOT EXISTS (SELECT 1 FROM labels x WHERE x.doc_id = d.doc_id AND l.language = CASE WHEN x.toxic = 1 THEN 'ja' ELSE 'en' END)")
def missing_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("pair_id"), F.when(F.col("toxic") == 1, "ja").otherwise("en").alias("language"), F.lit(0).alias("attempt"))
    return attempts.missing(attempts.targets(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pair_id"))), done, 0)


@query("qc_reasons", f"WITH {_TRIES} SELECT user_id AS pair_id, language, attempt, reasons, reasons = '' AS qc_pass FROM judged")
def qc_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).select("pair_id", "language", "attempt", F.array_join("qc_reasons", ",").alias("reasons"), "qc_pass")


@query("select_attempt", f"WITH {_TRIES}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id, language ORDER BY metric, attempt) AS k FROM judged WHERE reasons = '') SELECT user_id AS pair_id, language, attempt, metric, duration FROM r WHERE k = 1")
def select_attempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attempts.best(_checked(spark, sf_dir), "attempt", "metric", "duration")


_FINAL = f"""{_TRIES}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id, language ORDER BY metric, attempt) AS k FROM judged WHERE reasons = ''),
  pair AS (SELECT user_id AS pair_id, max(CASE WHEN language = 'ja' THEN attempt END) AS ja_attempt, max(CASE WHEN language = 'en' THEN attempt END) AS en_attempt, max(CASE WHEN language = 'ja' THEN metric END) AS ja_cer, max(CASE WHEN language = 'en' THEN metric END) AS en_wer,
    max(CASE WHEN language = 'ja' THEN duration END) AS ja_duration, max(CASE WHEN language = 'en' THEN duration END) AS en_duration FROM r WHERE k = 1 GROUP BY ALL),
  done AS (SELECT u.user_id AS pair_id, CASE WHEN ja_attempt IS NULL OR en_attempt IS NULL THEN 'rejected' ELSE 'accepted' END AS qc_status, concat_ws(',', CASE WHEN ja_attempt IS NULL THEN 'ja_no_passing_attempt' END, CASE WHEN en_attempt IS NULL THEN 'en_no_passing_attempt' END) AS reasons,
    ja_attempt, en_attempt, ja_cer, en_wer, ja_duration, en_duration, CASE WHEN u.user_id % 3 = 0 THEN 'kftt' WHEN u.user_id % 3 = 1 THEN 'jesc' END AS corpus FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN pair ON pair.pair_id = u.user_id)"""


def _final(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = attempts.finalized(attempts.nested(_checked(spark, sf_dir)))
    return records.withColumn("corpus", F.when(F.col("pair_id") % 3 == 0, "kftt").when(F.col("pair_id") % 3 == 1, "jesc"))


@query("finalize", f"WITH {_FINAL} SELECT pair_id, qc_status, reasons, ja_attempt, en_attempt, ja_cer, en_wer FROM done")
def finalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _final(spark, sf_dir).select("pair_id", "qc_status", F.array_join("qc_reasons", ",").alias("reasons"), _long("ja_attempt").alias("ja_attempt"), _long("en_attempt").alias("en_attempt"), "ja_cer", "en_wer")


@query("release_summary", f"WITH {_FINAL} SELECT count(*) AS total_pairs, count(*) FILTER (WHERE qc_status = 'accepted') AS accepted_pairs, count(*) FILTER (WHERE qc_status <> 'accepted') AS rejected_pairs, count(*) FILTER (WHERE qc_status = 'accepted')::DOUBLE / count(*) AS acceptance_rate, round(sum(ja_duration) FILTER (WHERE qc_status = 'accepted') / 3600, 9) AS ja_hours, round(sum(en_duration) FILTER (WHERE qc_status = 'accepted') / 3600, 9) AS en_hours FROM done")
def release_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.summary(_final(spark, sf_dir)).withColumns({c: F.round(c, 9) for c in ("ja_hours", "en_hours")})


@query("accepted_by_corpus", f"WITH {_FINAL} SELECT coalesce(corpus, 'unknown') AS corpus, count(*) AS accepted_pairs FROM done WHERE qc_status = 'accepted' GROUP BY ALL")
def accepted_by_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.by_corpus(_final(spark, sf_dir))


@query("missing_shards", f"WITH {_DOCS} SELECT range::INTEGER AS shard FROM range(4096) WHERE range NOT IN (SELECT ({_SHARD} % 4096)::INTEGER FROM named)")
def missing_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.missing_shards(manifest.sharded(_candidates(spark, sf_dir), 4096), 4096)


@query("resume_merge", "SELECT d.doc_id AS pair_id, CASE WHEN x.doc_id IS NULL THEN d.source ELSE NULL END AS source, coalesce(x.quality::BIGINT, d.n_chars) AS size FROM documents d LEFT JOIN labels x USING (doc_id)")
def resume_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as finished rows take the place of the new ones as a whole, nulls included."""
    new = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pair_id"), "source", F.col("n_chars").alias("size"))
    prior = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("pair_id"), F.lit(None).cast("string").alias("source"), _long("quality").alias("size"), F.col("doc_id").alias("pos"))
    return attempts.resumed(new, prior)


@query("last_wins", "SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY ALL")
def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max_by(F.struct("event_type", "value"), "event_id").alias("x"))
    return last.select("user_id", "x.event_type", "x.value")


@query("phase_union", f"WITH {_DOCS} SELECT corpus, CASE WHEN split = 'train' THEN 'train' ELSE 'evaluation' END AS stage, count(*) AS rows FROM docs GROUP BY ALL")
def phase_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four phases of ingestion put together by name."""
    rows = _candidates(spark, sf_dir).select("corpus", "split")
    parts = [rows.where((F.col("corpus") == c) & (t == (F.col("split") == "train"))).select("corpus", F.lit("train" if t else "evaluation").alias("stage")) for t in (False, True) for c in ("jesc", "kftt")]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole.groupBy("corpus", "stage").agg(F.count("*").alias("rows"))


@query("audio_budget", f"WITH h AS (SELECT sum(n_chars) / CAST({PER_SECOND} AS DOUBLE) / 3600 AS hours FROM documents) SELECT round(hours, 6) AS hours, round(hours * 3600 * 16000 * 2 * 2 * CAST(1.1 AS DOUBLE) / 1073741824, 6) AS gib, hours * 3600 * 16000 * 2 * 2 * CAST(1.1 AS DOUBLE) / 1073741824 <= 78 AS within_audio_budget FROM h")
def audio_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = table(spark, sf_dir, "documents").agg((F.sum("n_chars") / F.lit(PER_SECOND) / 3600).alias("h"))
    gib = F.col("h") * F.lit(ids.pcm16_gib(1.0, retries=0.1))
    return hours.select(F.round("h", 6).alias("hours"), F.round(gib, 6).alias("gib"), (gib <= 78).alias("within_audio_budget"))


@query("turn_gaps", "SELECT conv_id, max(turn) + 1 - count(*) AS gaps FROM conversations GROUP BY ALL")
def turn_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many positions each conversation lacks: what the positional join's assertion looks for."""
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg((F.max("turn") + 1 - F.count("*")).alias("gaps"))


