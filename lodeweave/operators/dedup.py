"""Keep-first dedup by fingerprint, evaluation splits first, so that no training row repeats an evaluation row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def phase(corpora: tuple[str, ...] = ("jesc", "kftt")) -> Column:
    """The order of ingestion: each corpus's evaluation rows, then each corpus's training rows."""
    place = F.lit(len(corpora))
    for k, c in enumerate(corpora):
        place = F.when(F.col("corpus") == c, k).otherwise(place)
    return F.when(F.col("split") == "train", place + len(corpora) + 1).otherwise(place)


def split_order() -> Column:
    return F.when(F.col("split") == "test", 1).otherwise(0)


def _own(key: str) -> Column:
    return F.coalesce(F.col(key), F.concat(F.lit("\0"), F.col("pair_id").cast("string")))


def ranked(rows: DataFrame, key: str = "fingerprint", order: list[Column] | None = None) -> DataFrame:
    """Adds copy: 1 for the row that stays of those with one key, in the order of ingestion, then 2, 3, ...

    Rows of a null key are copies of nothing. Ties in the order are broken by pair_id.
    """
    order = order or [phase(), split_order(), F.col("source_index"), F.col("pair_id")]
    # a key of the row's own in place of a null one, so that such rows don't meet in one task
    n = F.row_number().over(W.partitionBy(_own(key)).orderBy(*order))
    return rows.withColumn("copy", F.when(F.col(key).isNull(), 1).otherwise(n))


def first_copies(rows: DataFrame, key: str = "fingerprint", order: list[Column] | None = None) -> DataFrame:
    """Only the rows that stay. Spark cuts each partition to one row a key before the shuffle."""
    order = order or [phase(), split_order(), F.col("source_index"), F.col("pair_id")]
    return rows.withColumn("__copy", F.row_number().over(W.partitionBy(_own(key)).orderBy(*order))).where(F.col("__copy") == 1).drop("__copy")


def accounting(rows: DataFrame) -> DataFrame:
    """(corpus, stage, filtered, eligible, duplicates) of classified rows with copy; a duplicate counts at its own, later, stage."""
    stage = F.when(F.col("split") == "train", "train").otherwise("evaluation")
    return rows.groupBy("corpus", stage.alias("stage")).agg(
        F.count_if(F.col("reason").isNotNull()).alias("filtered"),
        F.count_if(F.col("reason").isNull() & (F.col("copy") == 1)).alias("eligible"),
        F.count_if(F.col("reason").isNull() & (F.col("copy") > 1)).alias("duplicates"),
    )


def repeated_keys(rows: DataFrame, key: str) -> DataFrame:
    """(key, rows) of keys that occur more than once."""
    return rows.groupBy(key).agg(F.count("*").alias("rows")).where("rows > 1")
