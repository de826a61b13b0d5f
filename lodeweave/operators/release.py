"""Releases: finished shards put together, their completeness, and a summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_shards(present: DataFrame, shards: int) -> DataFrame:
    """(shard): those of the range that aren't present."""
    return present.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard")).join(present.select("shard").distinct(), "shard", "left_anti")


def ordered(rows: DataFrame) -> DataFrame:
    """By shard, then the manifest's order."""
    return rows.orderBy("shard", "manifest_pos")


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where("qc_status = 'accepted'")


def rejected(rows: DataFrame) -> DataFrame:
    return rows.where("qc_status is null or qc_status <> 'accepted'")


def summary(rows: DataFrame) -> DataFrame:
    """One row: total, accepted and rejected pairs, the rate (0 for none), hours of accepted speech."""
    ok = F.coalesce(F.col("qc_status") == "accepted", F.lit(False))
    df = rows.agg(
        F.count("*").alias("total_pairs"),
        F.count_if(ok).alias("accepted_pairs"),
        *[(F.coalesce(F.sum(F.when(ok, F.col(f"{s}_duration"))), F.lit(0.0)) / 3600).alias(f"{s}_hours") for s in ("ja", "en")],
    )
    rate = F.when(F.col("total_pairs") > 0, F.col("accepted_pairs") / F.col("total_pairs")).otherwise(0.0)
    return df.select("total_pairs", "accepted_pairs", (F.col("total_pairs") - F.col("accepted_pairs")).alias("rejected_pairs"), rate.alias("acceptance_rate"), "ja_hours", "en_hours")


def by_corpus(rows: DataFrame) -> DataFrame:
    """(corpus, accepted_pairs); a null corpus is unknown."""
    return accepted(rows).groupBy(F.coalesce("corpus", F.lit("unknown")).alias("corpus")).agg(F.count("*").alias("accepted_pairs"))
