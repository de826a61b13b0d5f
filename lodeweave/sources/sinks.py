"""Outputs that appear whole or not at all."""

from __future__ import annotations

import json
import os
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_json(path: Path, value: object) -> None:
    """One JSON document, keys sorted, under a temporary name first."""
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(f"{path.name}.{uuid.uuid4().hex}.part")
    with part.open("w", encoding="utf-8", newline="\n") as f:
        f.write(json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) + "\n")
        f.flush()
        os.fsync(f.fileno())
    part.replace(path)


def _moved(spark: SparkSession, part: str, path: str) -> None:
    jvm = spark.sparkContext._jvm
    a, b = jvm.org.apache.hadoop.fs.Path(part), jvm.org.apache.hadoop.fs.Path(path)
    system = b.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = jvm.org.apache.hadoop.fs.Path(f"{part}.old")
    had = system.exists(b)
    if had and not system.rename(b, old):
        raise OSError(f"{path} can't be put aside")
    if not system.rename(a, b):
        if had:
            system.rename(old, b)
        raise OSError(f"{part} can't be renamed to {path}")
    if had:  # only now, so that the old or the new output is whole at any time
        system.delete(old, True)


def write_lines(rows: DataFrame, path: str, order: list[str] | None = None) -> None:
    """A folder of JSON lines: columns by name, nulls kept, rows in the order of their part files; in place of an older one."""
    rows = rows.orderBy(*order) if order else rows
    part = f"{path}.{uuid.uuid4().hex}.part"
    whole = F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"})
    rows.select(whole.alias("value")).write.text(part)
    _moved(rows.sparkSession, part, path)


def write_rows(rows: DataFrame, path: str) -> None:
    """A folder of Parquet in place of an older one."""
    part = f"{path}.{uuid.uuid4().hex}.part"
    rows.write.parquet(part)
    _moved(rows.sparkSession, part, path)


def write_shards(rows: DataFrame, path: str) -> None:
    """A folder for each shard that occurs; those of other shards stay."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path)
