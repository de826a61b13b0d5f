"""Text files with line numbers, without a pass over all lines in one task.

A split of a file counts its own lines; the counts of the splits before it, of which there are few, are added.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at: tuple[str, int] | None = None
    n = 0
    for b in batches:
        numbers = []
        for key in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            if key != at:
                at, n = key, 0
            n += 1
            numbers.append(n)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(numbers, pa.int64())], names=[*b.schema.names, "k"])


def numbered_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """(file, line_no, value), from 1 on in each file; a byte order mark at the start of a file is left out."""
    raw = spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    rows = raw.mapInArrow(_counted, "value string, file string, block bigint, k bigint")
    counts = rows.groupBy("file", "block").agg(F.max("k").alias("n"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    base = counts.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    line = F.col("base") + F.col("k")
    value = F.when(line == 1, F.regexp_replace("value", "^﻿", "")).otherwise(F.col("value"))
    return rows.join(base, ["file", "block"]).select("file", line.alias("line_no"), value.alias("value"))
