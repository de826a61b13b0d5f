"""Quality rules: robust multivariate outliers by minimum-covariance-determinant estimates for each language and source.

Statistics of a text (letters in a word and their spread, symbols, capitals, distinct words, length) are transformed
so that clean texts of a group scatter about one centre. Concentration steps find the centre and scatter of the
``SHARE`` of the group's texts that lie closest together, so that bad texts, however many short of a quarter, don't
shape the measure that they are held against. They begin at four estimates for each group: quartiles, correlations
of squashed values, correlations of directions, and plain moments. After ``TRIED`` steps from each, the one whose
scatter has the least determinant goes on. A text is rejected if its Mahalanobis distance, given its length,
is beyond a quantile of the chi-squared distribution. Length itself is never a reason.

Every step is an aggregation over all texts of all groups: a concentration step sums moments by group and by bins of
distance, takes the bins up to the group's share, the last one in part, and yields a row of estimates for each
group, joined to the statistics in the next step. Nothing is collected, and a group may have any size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from lodeweave.llm.common import written

#: Texts of a group that the estimates are taken from; concentration steps; the quantile beyond which texts are rejected.
SHARE, STEPS, QUANTILE = 0.75, 8, 0.9999
#: Of the concentration steps, those that are taken from every start.
TRIED = 2
#: Groups with fewer texts are estimated together, those of a language first; if they are still fewer, they are accepted,
#: or judged by all other groups' pooled estimates, the scatter widened by so much.
MIN_ROWS, WIDENED = 100, 2.0
#: Texts count as if they had so many words or characters of their group's average besides their own.
PRIOR_WORDS, PRIOR_CHARS = 20, 100
NAMES = ("word_length", "symbols", "capitals", "distinct", "spread", "length")
#: Standard deviations that are no cause for suspicion in any group: a phone number or an address in a short text.
FLOORS = (0.05, 0.35, 0.4, 0.1, 0.13, 0.0)
_D = len(NAMES)
_PAIRS = [(i, j) for i in range(_D) for j in range(i, _D)]
_BINS = 32
_STATS = ("words", "solid", "letters", "capital", "kinds", "squares")
_OWN = [*[f"q_{s}" for s in _STATS]]


def _classes() -> np.ndarray:
    """For each code point, bit 0: not white space, bit 1: letter, bit 2: capital letter."""
    out = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        x = chr(c)
        out[c] = (not x.isspace()) | x.isalpha() << 1 | x.isupper() << 2
    return out


_CLASS: list[np.ndarray] = []


def statistics(texts: list[str]) -> np.ndarray:
    """(texts, 6): words, characters other than white space, letters, capitals, distinct words in lower case, sum of squared word lengths."""
    if not _CLASS:
        _CLASS.append(_classes())
    whole = "".join(t + " " for t in texts)
    ends = np.cumsum([len(t) + 1 for t in texts])
    out = np.zeros((len(texts), 6), np.int64)
    if not len(texts):
        return out
    kind = _CLASS[0][np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)]
    solid = (kind & 1).astype(bool)
    starts = np.append(0, ends[:-1])
    for k, bit in ((1, 1), (2, 2), (3, 4)):
        out[:, k] = np.add.reduceat((kind & bit) > 0, starts, dtype=np.int64)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], solid])))  # each text ends with a space, so edges come in pairs
    first, last = edge[::2], edge[1::2]
    doc = np.searchsorted(ends, first, side="right")
    out[:, 0] = np.bincount(doc, minlength=len(texts))
    out[:, 5] = np.bincount(doc, weights=((last - first) ** 2).astype(np.float64), minlength=len(texts)).astype(np.int64)
    words = pc.utf8_lower(pa.array(whole.split())).dictionary_encode() if len(first) else None
    if words is not None:
        code = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        pairs = np.unique(doc.astype(np.int64) * (len(words.dictionary) + 1) + code)
        out[:, 4] = np.bincount(pairs // (len(words.dictionary) + 1), minlength=len(texts))
    return out


def _counted(column: int, keep: list[int], names: list[str]):
    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(column)
            rows: list[np.ndarray] = []
            held: list[str] = []
            size = 0
            for t in texts:
                held.append(t.as_py() or "")
                size += len(held[-1])
                if size >= 1 << 20:
                    rows.append(statistics(held))
                    held, size = [], 0
            rows.append(statistics(held))
            s = np.concatenate(rows)
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], *[pa.array(s[:, k]) for k in range(6)]], names=names)

    return f


def counted(docs: DataFrame, text: bool) -> DataFrame:
    """Adds the statistics as q_ columns; leaves the text away if it isn't needed."""
    docs = docs.drop(*_OWN)
    keep = [k for k, c in enumerate(docs.columns) if text or c != "text"]
    fields = [docs.schema.fields[k] for k in keep] + [T.StructField(n, T.LongType()) for n in _OWN]
    return docs.mapInArrow(_counted(docs.columns.index("text"), keep, [f.name for f in fields]), T.StructType(fields))


def _group(*columns: str) -> Column:
    """One string for the values of columns, nulls apart from all others."""
    return F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns])


def groups(stats: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """(key, grp): the group by which each language and source is estimated."""
    n = stats.where("q_words > 0").groupBy(_group("lang", "source").alias("key"), _group("lang").alias("of")).agg(F.count("*").alias("n"))
    own = F.when(F.col("n") >= min_rows, F.col("key"))
    small = F.sum(F.when(own.isNull(), F.col("n"))).over(W.partitionBy("of"))
    grp = F.coalesce(own, F.when(small >= min_rows, F.concat(F.lit("of "), F.col("of"))), F.lit("rest"))
    return n.select("key", grp.alias("grp"))


def features() -> list[Column]:
    """The transformed statistics, from q_ columns and the group's totals in t_ columns; null without words."""
    w, s, letters, cap, kinds, sq = (F.col(c).cast("double") for c in _OWN)
    tw, ts, tl, tc, _, tq = (F.col(f"t_{c}").cast("double") for c in _STATS)

    def logit(a: Column, b: Column, p: Column) -> Column:
        p = F.greatest(F.lit(1e-3), F.least(F.lit(1 - 1e-3), p))
        return F.log((a + PRIOR_CHARS * p) / (b - a + PRIOR_CHARS * (1 - p)))

    length = F.log((s + PRIOR_WORDS * ts / tw) / (w + PRIOR_WORDS))
    spread = F.log((sq + PRIOR_WORDS * tq / tw) / (w + PRIOR_WORDS)) - 2 * length
    out = [length, logit(s - letters, s, (ts - tl) / ts), logit(cap, letters, F.when(tl > 0, tc / tl).otherwise(0.0)), F.log(F.when(w > 0, kinds / w)), spread, F.log(w + PRIOR_WORDS)]
    return [x.alias(f"x{k}") for k, x in enumerate(out)]


def _away(i: int) -> str:
    return f"(x{i} - get(m, {i}))"


def _quadratic() -> Column:
    """(x - m)' P (x - m) from the columns x, m and p; SQL, as a call for each operator would take the driver longer than Spark the step."""
    return F.expr("greatest(0D, " + " + ".join(f"{1 if i == j else 2}D * get(p, {k}) * {_away(i)} * {_away(j)}" for k, (i, j) in enumerate(_PAIRS)) + ")")


def chi2_cdf(x: float, k: int) -> float:
    """The chi-squared distribution with k degrees of freedom, by the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, z = k / 2, x / 2
    term = total = 1 / a
    n = 0
    while term > total * 1e-16:
        n += 1
        term *= z / (a + n)
        total += term
    return min(1.0, total * math.exp(-z + a * math.log(z) - math.lgamma(a)))


def chi2_quantile(q: float, k: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, k) < q else (lo, mid)
    return hi


def consistency(share: float) -> float:
    """By what the scatter of the nearest share of normal data is to be multiplied."""
    return share / chi2_cdf(chi2_quantile(share, _D), _D + 2)


def _parameters(mean: np.ndarray, cov: np.ndarray) -> tuple[list[float], list[float], float, float]:
    """Centre, precision with the floors added to the scatter, the variance of the length, and the logarithm of the scatter's determinant."""
    cov = cov + np.diag(np.square(FLOORS)) + np.eye(_D) * 1e-6
    inverse = np.linalg.inv(cov)
    return mean.tolist(), [float(inverse[i, j]) for i, j in _PAIRS], float(cov[-1, -1]), float(np.linalg.slogdet(cov)[1])


_ESTIMATE = "m array<double>, p array<double>, v double, det double"
#: s is the number of the start.
_SCHEMA = f"grp string, s int, {_ESTIMATE}"
_COLUMNS = ["grp", "s", "m", "p", "v", "det"]
_SUMS = [f"s{k}" for k in range(_D + len(_PAIRS))]


def _first(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Medians and interquartile ranges."""
    for pdf in pdfs:
        rows = []
        for g, *q in pdf.itertuples(index=False):
            q = np.array([np.asarray(x, np.float64) for x in q])
            sd = (q[:, 2] - q[:, 0]) / 1.349 + 0.02
            rows.append((g, 0, *_parameters(q[:, 1], np.diag(sd**2)), sd.tolist()))
        yield pd.DataFrame(rows, columns=[*_COLUMNS, "sd"])


def _covariance(n: float, one: list[float], two: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Mean and scatter from sums and sums of products."""
    mean, cov = np.asarray(one) / n, np.zeros((_D, _D))
    for (i, j), x in zip(_PAIRS, two):
        cov[i, j] = cov[j, i] = x / n - mean[i] * mean[j]
    return mean, cov


def _others(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The starts 1 and 2, which keep the medians and ranges and take only the correlations from sums, and 3, which takes all."""
    for pdf in pdfs:
        rows = []
        for g, s, m, sd, n, one, two in pdf[["grp", "s", "m", "sd", "n", "one", "two"]].itertuples(index=False):
            m, sd = np.asarray(m), np.asarray(sd)
            mean, cov = _covariance(n, one if s == 3 else [0.0] * _D, two)
            if s == 3:
                rows.append((g, s, *_parameters(m + sd * mean, cov * np.outer(sd, sd))))
                continue
            by = np.sqrt(np.diag(cov))
            like = np.divide(cov, np.outer(by, by), out=np.zeros_like(cov), where=np.outer(by, by) > 0)
            np.fill_diagonal(like, 1.0)
            rows.append((g, s, *_parameters(m, like * np.outer(sd, sd))))
        yield pd.DataFrame(rows, columns=_COLUMNS)


def _next(factor: float):
    def f(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            rows = []
            for g, s, m, n, one, two in pdf[["grp", "s", "m", "n", "one", "two"]].itertuples(index=False):
                shift, cov = _covariance(n, one, two)
                rows.append((g, s, *_parameters(np.asarray(m) + shift, cov * factor)))
            yield pd.DataFrame(rows, columns=_COLUMNS)

    return f


def _moment_sums(e: list[str]) -> list[Column]:
    return [F.expr(f"sum({x}) as {c}") for x, c in zip([*e, *[f"{e[i]} * {e[j]}" for i, j in _PAIRS]], _SUMS)]


def _arrays() -> list[Column]:
    return [F.expr(f"array({', '.join(_SUMS[:_D])}) as one"), F.expr(f"array({', '.join(_SUMS[_D:])}) as two")]


def starts(rows: DataFrame) -> DataFrame:
    """Four estimates for each group, in two passes."""
    quartiles = rows.groupBy("grp").agg(*[F.percentile_approx(f"x{k}", [0.25, 0.5, 0.75], 1000).alias(f"q{k}") for k in range(_D)])
    first = written(quartiles.mapInPandas(_first, f"{_SCHEMA}, sd array<double>"), "quality-first")
    df = rows.join(first.select("grp", "m", "sd"), "grp").selectExpr("grp", *[f"{_away(i)} / get(sd, {i}) as z{i}" for i in range(_D)])
    df = df.selectExpr("*", f"greatest(sqrt({' + '.join(f'z{i} * z{i}' for i in range(_D))}), 1e-9D) as away")
    each = [f"struct({s} as s, {', '.join(f'{f.format(i)} as y{i}' for i in range(_D))})" for s, f in ((1, "tanh(z{})"), (2, "z{} / away"), (3, "z{}"))]
    df = df.selectExpr("grp", f"inline(array({', '.join(each)}))")
    sums = df.groupBy("grp", "s").agg(F.count("*").cast("double").alias("n"), *_moment_sums([f"y{i}" for i in range(_D)]))
    others = sums.select("grp", "s", "n", *_arrays()).join(first.select("grp", "m", "sd"), "grp").mapInPandas(_others, _SCHEMA)
    return written(first.select(*_COLUMNS).unionByName(others), "quality-starts")


def least(params: DataFrame) -> DataFrame:
    """Of each group's estimates the one of the least determinant, of equal ones that of the first start."""
    best = params.groupBy("grp").agg(F.min_by(F.struct(*_COLUMNS[1:]), F.struct("det", "s")).alias("b"))
    return written(best.select("grp", "b.*"), "quality-least")


def _concentrated(rows: DataFrame, params: DataFrame, share: float | None) -> DataFrame:
    """One step: estimates from the nearest share, or, without one, from all within the 97.5 % ellipsoid."""
    df = rows.join(params.drop("v", "det"), "grp").withColumn("d", _quadratic())
    sums = _moment_sums([_away(i) for i in range(_D)])
    if share is None:
        df = df.where(F.col("d") <= chi2_quantile(0.975, _D))
        part = df.groupBy("grp", "s").agg(F.count("*").cast("double").alias("n"), *sums)
        taken = part.withColumn("take", F.lit(1.0))
        factor = 0.975 / chi2_cdf(chi2_quantile(0.975, _D), _D + 2)
    else:
        part = df.groupBy("grp", "s", F.floor(F.log(F.col("d") + 1e-9) * _BINS).alias("bin")).agg(F.count("*").cast("double").alias("n"), *sums)
        before = F.coalesce(F.sum("n").over(W.partitionBy("grp", "s").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
        all_ = F.sum("n").over(W.partitionBy("grp", "s"))
        taken = part.withColumn("take", F.greatest(F.lit(0.0), F.least(F.lit(1.0), (share * all_ - before) / F.col("n"))))
        factor = consistency(share)
    total = taken.groupBy("grp", "s").agg(*[F.expr(f"sum(take * {c}) as {c}") for c in ["n", *_SUMS]])
    return written(total.select("grp", "s", "n", *_arrays()).join(params.select("grp", "s", "m"), ["grp", "s"]).mapInPandas(_next(factor), _SCHEMA), "quality-step")


def _moments(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each group's centre and second moments, without the floors, times its rows."""
    for pdf in pdfs:
        rows = []
        for n, m, p in pdf[["t_rows", "m", "p"]].itertuples(index=False):
            inverse = np.zeros((_D, _D))
            for (i, j), x in zip(_PAIRS, p):
                inverse[i, j] = inverse[j, i] = x
            two = np.linalg.inv(inverse) - np.diag(np.square(FLOORS)) + np.outer(m, m)
            rows.append((float(n), *(n * np.asarray(m)), *(n * two[i, j] for i, j in _PAIRS)))
        yield pd.DataFrame(rows, columns=["n", *_SUMS])


def _pooled(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in pdfs:
        rows = []
        for n, *sums in pdf[["n", *_SUMS]].itertuples(index=False):
            mean, cov = _covariance(n, sums[:_D], sums[_D:])
            rows.append(("rest", 0, *_parameters(mean, cov * WIDENED)))
        yield pd.DataFrame(rows, columns=_COLUMNS)


def with_fallback(params: DataFrame) -> DataFrame:
    """Adds estimates for the rest, if it has none: the groups' pooled, their scatter and that between their centres together."""
    sums = params.mapInPandas(_moments, ", ".join(f"{c} double" for c in ["n", *_SUMS])).agg(*[F.sum(c).alias(c) for c in ["n", *_SUMS]]).where("n > 0")
    totals = params.agg(*[F.sum(c).alias(c) for c in ["t_rows", *[f"t_{s}" for s in _STATS]]])
    rest = sums.mapInPandas(_pooled, _SCHEMA).crossJoin(totals)
    return params.unionByName(rest.join(params.where("grp = 'rest'").select("grp"), "grp", "left_anti"))


def concentrated(rows: DataFrame, share: float = SHARE, steps: int = STEPS) -> DataFrame:
    """The estimates of each group after all steps, from (grp, x0, x1, ...)."""
    params = starts(rows)
    for k in range(steps):
        params = _concentrated(rows, least(params) if k == min(TRIED, steps - 1) else params, share)
    return params


def estimates(stats: DataFrame, share: float = SHARE, steps: int = STEPS, min_rows: int = MIN_ROWS) -> tuple[DataFrame, DataFrame]:
    """(key, grp), and the centre and precision of each group with at least ``min_rows`` texts, and its totals."""
    of = written(groups(stats, min_rows), "quality-groups")
    rows = stats.where("q_words > 0").select("*", _group("lang", "source").alias("key")).join(of, "key").drop("key")
    totals = rows.groupBy("grp").agg(F.count("*").alias("t_rows"), *[F.sum(c).alias(f"t_{s}") for c, s in zip(_OWN, _STATS)]).where(F.col("t_rows") >= min_rows)
    totals = written(totals, "quality-totals")
    rows = written(rows.select("grp", *_OWN).join(totals, "grp").select("grp", *features()), "quality-features")
    params = concentrated(rows, share, steps)
    return of, _concentrated(rows, params, None).join(totals, "grp")


def judged(stats: DataFrame, of: DataFrame, params: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """Puts quality_distance and quality_ok in place of the q_ columns; all other columns travel in one, so none can clash."""
    rest = [c for c in stats.columns if c not in _OWN]
    df = stats.select(_group("lang", "source").alias("key"), F.struct(*rest).alias("row"), *_OWN)
    df = df.join(of, "key", "left").join(params, "grp", "left").select("row", "q_words", "m", "p", "v", *features())
    away = F.col(f"x{_D - 1}") - F.get("m", F.lit(_D - 1))
    # columns of their own, so that each is worked out once
    df = df.select("row", "q_words", "m", (_quadratic() - away * away / F.col("v")).alias("d2"))
    # greatest() skips nulls, so a group without estimates is told by its missing centre
    df = df.select("row", "q_words", F.when((F.col("q_words") > 0) & F.col("m").isNotNull(), F.sqrt(F.greatest(F.lit(0.0), F.col("d2")))).alias("d"))
    ok = (F.col("q_words") > 0) & F.coalesce(F.col("d") <= math.sqrt(chi2_quantile(quantile, _D - 1)), F.lit(True))
    return df.select("row.*", F.col("d").alias("quality_distance"), ok.alias("quality_ok"))


def outliers(docs: DataFrame, quantile: float = QUANTILE, every: bool = False) -> DataFrame:
    """(doc_id, lang, source, quality_distance, quality_ok) of each document, false for what is rejected.

    A null text and one without words have no distance and are rejected. Null lang and source are values like
    others. In groups that are too small for estimates even together, nothing is rejected and there is no
    distance; equal statistics, at a bin's edge too, get the same; a text of any length is counted whole; with ``every``, they are judged by the other groups' estimates, and only in a table that has no group
    of ``MIN_ROWS`` texts, however put together, is nothing rejected. Repeated rows each get the same. An empty table gives no rows. Extra columns are ignored.
    """
    stats = written(counted(docs.select("doc_id", "lang", "source", "text"), text=False), "quality-counts")
    of, params = estimates(stats)
    params = with_fallback(written(params, "quality-estimates")) if every else params
    return judged(stats, of, params, quantile).select("doc_id", "lang", "source", "quality_distance", "quality_ok")


def within(docs: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """The documents that aren't rejected, with all their columns."""
    of, params = estimates(written(counted(docs.select("lang", "source", "text"), text=False), "quality-counts"))
    return judged(counted(docs.select(F.struct(*docs.columns).alias("__all"), "lang", "source", "text"), text=True), of, params, quantile).where("quality_ok").select("__all.*")
