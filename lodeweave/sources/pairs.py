"""Text pairs from two layouts: one tab-separated file a split, and two files with a sentence a line each."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeweave.sources.archives import first_existing
from lodeweave.sources.lines import numbered_lines

SCHEMA = "split string, source_index bigint, ja_raw string, en_raw string"


def _complain(rows: DataFrame, what: str) -> None:
    first = rows.orderBy("line_no").limit(1).collect()
    if first:
        raise ValueError(f"{first[0].file}, line {first[0].line_no}: {what}")


def tab_separated(spark: SparkSession, path: str, split: str) -> DataFrame:
    """English, a tab, Japanese, on each line; quotes are ordinary characters. ValueError for a line of other than two fields."""
    lines = numbered_lines(spark, path).withColumn("f", F.split("value", "\t", -1))
    _complain(lines.where(F.size("f") != 2), "not two fields")
    return lines.select(F.lit(split).alias("split"), F.col("line_no").alias("source_index"), F.get("f", F.lit(1)).alias("ja_raw"), F.get("f", F.lit(0)).alias("en_raw"))


def aligned(spark: SparkSession, ja: str, en: str, split: str) -> DataFrame:
    """Line n of one file with line n of the other. ValueError where one has more lines."""
    left = numbered_lines(spark, ja).select("line_no", F.col("file"), F.col("value").alias("ja_raw"))
    right = numbered_lines(spark, en).select("line_no", F.col("value").alias("en_raw"))
    both = left.join(right, "line_no", "full")
    _complain(both.where("ja_raw is null or en_raw is null"), "the two files have different numbers of lines")
    return both.select(F.lit(split).alias("split"), F.col("line_no").alias("source_index"), "ja_raw", "en_raw")


def read_tab_separated(spark: SparkSession, root: Path, splits: tuple[str, ...]) -> DataFrame:
    """The splits of a folder, each a file or in a folder of its own."""
    out = spark.createDataFrame([], SCHEMA)
    for s in splits:
        out = out.unionByName(tab_separated(spark, str(first_existing(root, f"split/{s}", f"{s}", f"raw/{s}")), s))
    return out


def read_aligned(spark: SparkSession, root: Path, splits: tuple[str, ...], stem: str = "kyoto") -> DataFrame:
    """The splits of a folder of files named stem-split.language."""
    out = spark.createDataFrame([], SCHEMA)
    for s in splits:
        place = first_existing(root, f"data/orig/{stem}-{s}.ja", f"kftt-data-1.0/data/orig/{stem}-{s}.ja", f"{stem}-{s}.ja")
        out = out.unionByName(aligned(spark, str(place), str(place.with_suffix(".en")), s))
    return out
