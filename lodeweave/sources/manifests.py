"""Manifests and checkpoints as lines of JSON, read strictly or leniently, with any further fields passed on."""

from __future__ import annotations

import glob
import hashlib
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeweave.operators.manifest import REQUIRED, validated
from lodeweave.sources.lines import numbered_lines

FIELDS = T.StructType([
    T.StructField(n, t)
    for n, t in sorted({**dict.fromkeys((*REQUIRED, "corpus_version", "en_text_raw", "ja_text_raw", "length_bin", "license_id", "normalizer_version", "selection_priority", "source_id"), T.StringType()), "en_words": T.LongType(), "ja_chars": T.LongType(), "estimated_ja_seconds": T.DoubleType()}.items())
])


def read_manifest(spark: SparkSession, path: str, fields: T.StructType = FIELDS) -> DataFrame:
    """(line_no, fields..., json): blank lines are skipped; ValueError for what isn't an object, lacks required strings, or repeats an id.

    A required field must be a string in the JSON itself: a number isn't taken for one. json is the whole line, so
    other fields stay at hand.
    """
    lines = numbered_lines(spark, path).where(F.length(F.trim("value")) > 0).withColumn("v", F.try_parse_json("value"))
    kind = F.expr("schema_of_variant(v)")
    wrong = lines.where(F.col("v").isNull() | ~kind.startswith("OBJECT")).orderBy("line_no").limit(1).collect()
    if wrong:
        raise ValueError(f"{path}, line {wrong[0].line_no}: not a JSON object")

    def required(name: str):
        text = F.expr(f"schema_of_variant(variant_get(v, '$.{name}', 'variant')) = 'STRING'")
        return F.when(text, F.expr(f"variant_get(v, '$.{name}', 'string')")).alias(name)

    rest = [F.expr(f"try_variant_get(v, '$.{f.name}', '{f.dataType.simpleString()}')").alias(f.name) for f in fields if f.name not in REQUIRED]
    rows = lines.select("line_no", *[required(n) for n in REQUIRED], *rest, F.col("value").alias("json"))
    return validated(rows)


def read_rows(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of a checkpoint with the fields of ``schema``; none if there is no such file."""
    if not glob.glob(path) if "://" not in path else False:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of all files below a folder; their content isn't read. A missing folder has none."""
    if "://" not in folder and not Path(folder).exists():
        return spark.createDataFrame([], "path string, length bigint")
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")


def stored_bytes(spark: SparkSession, folder: str) -> int:
    return inventory(spark, folder).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """(path, sha256) of all files below a folder; a file of any size is read a piece at a time."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path in batch.column(0).to_pylist():
                system, place = pa.fs.FileSystem.from_uri(path)
                whole = hashlib.sha256()
                with system.open_input_stream(place) as f:
                    while piece := f.read(1 << 20):
                        whole.update(piece)
                out.append(whole.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["path", "sha256"])

    return inventory(spark, folder).select("path").mapInArrow(hashed, "path string, sha256 string")
