"""A few complete sentence pairs for a trial run: one for each slot of corpus and length, then any others in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

SLOTS = (("jesc", "short"), ("jesc", "medium"), ("jesc", "long"), ("kftt", "medium"), ("kftt", "long"))
_CHINESE = "你們嗎這發來會與從對裡還說國學體點聲樣讓"
_NOISE = r"\.\.\.|[…()（）\[\]【】]"


def complete(ja: Column, en: Column, latin: bool = False) -> Column:
    """Both end like sentences, nothing is left out or in brackets, and the left one is Japanese; ``latin`` leaves that test out."""
    ja, en = F.rtrim(ja), F.rtrim(en)
    whole = F.rlike(ja, F.lit(r"[.。！？!?]\z" if latin else r"[。！？!?]\z")) & F.rlike(en, F.lit(r"[.!?]\z")) & ~F.rlike(F.concat(ja, en), F.lit(_NOISE))
    return whole if latin else whole & ~F.rlike(ja, F.lit(rf"[A-Za-z{_CHINESE}]"))


def trial(rows: DataFrame, n: int, slots: tuple[tuple[str, str], ...] = SLOTS, latin: bool = False) -> DataFrame:
    """Adds smoke_selection_index to ``n`` training rows: the first of each slot, in slot order, then the first others.

    Rows need manifest_pos. Fewer rows than ``n`` come back if there are no more.
    """
    if n < 1:
        raise ValueError("a trial needs a pair at least")
    slots = slots[:n]
    good = rows.where((F.col("split") == "train") & complete(F.col("ja_text"), F.col("en_text"), latin))
    place = F.lit(None).cast("int")
    for k, (c, b) in enumerate(slots):
        place = F.when((F.col("corpus") == c) & (F.col("length_bin") == b), k).otherwise(place)
    good = good.withColumn("__slot", place)
    # the first n of each slot and of the rest are all that can be chosen, so one small window orders them
    near = good.withColumn("__k", F.row_number().over(W.partitionBy("__slot").orderBy("manifest_pos"))).where(F.col("__k") <= n)
    order = [F.when((F.col("__k") == 1), F.col("__slot")).asc_nulls_last(), F.col("manifest_pos")]
    top = near.orderBy(*order).limit(n)
    return top.withColumn("smoke_selection_index", (F.row_number().over(W.orderBy(*order)) - 1).cast("int")).drop("__slot", "__k")


def required_trial(rows: DataFrame, n: int, slots: tuple[tuple[str, str], ...] = SLOTS) -> DataFrame:
    """``trial``, with ValueError where there are fewer than ``n`` rows."""
    out = trial(rows, n, slots)
    if (have := out.count()) < n:
        raise ValueError(f"{n} pairs are asked for, {have} are there")
    return out
