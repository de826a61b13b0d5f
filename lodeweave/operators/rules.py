"""Ordered rejection rules for text pairs: the first rule that applies names the reason, as one CASE expression."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeweave.functions import text as X

REASONS = ("empty", "url_or_email", "markup", "subtitle_cue", "no_content", "too_short", "too_long", "not_japanese", "not_english", "length_ratio")


@dataclass(frozen=True)
class Profile:
    """Limits and measures of the rules. Caps are (left units, right words), by corpus, with one for all others."""

    least: tuple[int, int] = (8, 4)
    caps: dict[str, tuple[int, int]] = field(default_factory=lambda: {"jesc": (160, 50)})
    cap: tuple[int, int] = (180, 60)
    left_share: float = 0.45
    right_share: float = 0.80
    ratio: tuple[float, float] = (0.8, 8.0)
    left_units: Callable[[Column], Column] = X.script_units
    left_letters: Callable[[Column], Column] = X.japanese_letters
    names: tuple[str, str] = ("not_japanese", "not_english")
    normalize: Callable[[Column], Column] = X.normalized


def classified(pairs: DataFrame, profile: Profile = Profile(), left: str = "ja_raw", right: str = "en_raw") -> DataFrame:
    """Adds ja_norm, en_norm, reason (null for an accepted pair), ja_chars and en_words.

    Counts are 0 for pairs that one of the first five rules rejects. A null text counts as empty; a null corpus has
    the general caps. Input columns of the added names are replaced. Where left and right are one column, it is normalised
    and tested once.
    """
    p, one = profile, left == right
    keep = [c for c in pairs.columns if c not in ("ja_norm", "en_norm", "reason", "ja_chars", "en_words")]
    df = pairs.select(*keep, p.normalize(F.coalesce(left, F.lit(""))).alias("ja_norm"), *[] if one else [p.normalize(F.coalesce(right, F.lit(""))).alias("en_norm")])
    ja, en = F.col("ja_norm"), F.col("ja_norm" if one else "en_norm")

    def either(test: Callable[[Column], Column]) -> Column:
        return test(ja) if one else test(ja) | test(en)

    early = F.when(either(lambda t: F.length(t) == 0), "empty")
    for name, test in (("url_or_email", X.has_link), ("markup", X.has_markup), ("subtitle_cue", X.is_cue)):
        early = early.when(either(test), name)
    early = early.when(either(lambda t: ~X.has_content(t)), "no_content")
    # counts are columns of their own, so that each is worked out once, and only where it is needed
    df = df.select("*", early.alias("__early"))
    kept = F.col("__early").isNull()
    df = df.select("*", F.when(kept, p.left_units(ja)).otherwise(0).cast("long").alias("ja_chars"), F.when(kept, X.latin_words(en)).otherwise(0).cast("long").alias("en_words"))
    n, w = F.col("ja_chars"), F.col("en_words")

    def cap(side: int) -> Column:
        c = F.lit(p.cap[side])
        for corpus, limits in p.caps.items():
            c = F.when(F.col("corpus") == corpus, F.lit(limits[side])).otherwise(c)
        return c

    def share(part: Column, whole: Column) -> Column:
        return part.cast("double") / F.greatest(whole, F.lit(1)).cast("double")

    late = F.when((n < p.least[0]) | (w < p.least[1]), "too_short").when((n > cap(0)) | (w > cap(1)), "too_long")
    late = late.when(share(p.left_letters(ja), n) < p.left_share, p.names[0]).when(share(X.ascii_letters(en), X.letters(en)) < p.right_share, p.names[1])
    late = late.when(~share(n, w).between(*p.ratio), "length_ratio")
    return df.select(*keep, "ja_norm", en.alias("en_norm"), F.coalesce("__early", late).alias("reason"), "ja_chars", "en_words")


def histogram(rows: DataFrame, *by: str) -> DataFrame:
    """(by..., reason, rows): how often each reason occurs; accepted pairs aren't counted.

    These are a group of null reason, which count() leaves at 0: a filter on the reason itself would be moved below the
    projections that make it, with a copy of all rules and counts in it for each place where they are used.
    """
    return rows.groupBy(*by, "reason").agg(F.count("reason").alias("rows")).where("rows > 0")


def gated(rows: DataFrame, dev: bool = True, test: bool = True) -> DataFrame:
    """Without the splits that are switched off: their rows count nowhere and block no duplicates."""
    off = [s for s, on in (("dev", dev), ("test", test)) if not on]
    return rows.where(~F.coalesce(F.col("split").isin(off), F.lit(False))) if off else rows
