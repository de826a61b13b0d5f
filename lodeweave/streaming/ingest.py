"""Pairs as a stream: the same rules and ids as in batch, with duplicates dropped by state that a watermark bounds.

Beyond what the batch does, a stream can't know a later evaluation row, so the guard against leaks is a stream of
evaluation fingerprints that training rows are checked against before; ``known`` is that table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lodeweave.functions import ids
from lodeweave.operators import rules

ARRIVING = T.StructType([T.StructField("corpus", T.StringType()), T.StructField("split", T.StringType()), T.StructField("source_index", T.LongType()), T.StructField("ja_raw", T.StringType()), T.StructField("en_raw", T.StringType()), T.StructField("ts", T.TimestampType())])


def read(spark: SparkSession, folder: str) -> DataFrame:
    """JSON lines with the fields of ARRIVING, as files arrive."""
    return spark.readStream.schema(ARRIVING).json(folder)


def accepted(pairs: DataFrame, known: DataFrame | None = None, late: str = "1 hour", profile: rules.Profile = rules.Profile()) -> DataFrame:
    """Accepted pairs, each fingerprint once within the watermark ``late`` of ts; none of ``known`` (fingerprint)."""
    df = rules.classified(pairs.withWatermark("ts", late), profile).where("reason is null").withColumn("fingerprint", ids.fingerprint(F.col("ja_norm"), F.col("en_norm")))
    df = df.withColumn("pair_id", ids.pair_id(F.col("corpus"), F.col("split"), F.col("source_index"), F.col("fingerprint")))
    if known is not None:
        df = df.join(known.select("fingerprint"), "fingerprint", "left_anti")
    return df.dropDuplicatesWithinWatermark(["fingerprint"]) if df.isStreaming else df.dropDuplicates(["fingerprint"])


def counts(pairs: DataFrame, width: str = "10 minutes", late: str = "1 hour", profile: rules.Profile = rules.Profile()) -> DataFrame:
    """(start, corpus, reason, rows) by windows of time; accepted pairs have the reason ``accepted``."""
    df = rules.classified(pairs.withWatermark("ts", late), profile)
    by = df.groupBy(F.window("ts", width).alias("w"), "corpus", F.coalesce("reason", F.lit("accepted")).alias("reason"))
    return by.agg(F.count("*").alias("rows")).select(F.col("w.start").alias("start"), "corpus", "reason", "rows")


def write(rows: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Append to a folder of Parquet until what is there has been read."""
    return rows.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
