"""Manifests: rows in a fixed order, validation, shards and plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lodeweave.functions import ids
from lodeweave.scratch import written

REQUIRED = ("pair_id", "corpus", "split", "ja_text", "en_text")
SAFE_ID = r"^[A-Za-z0-9_-]{1,96}\z"
NORMALIZER = "minimal-nfkc-v1"
SPLITS = ("train", "dev")
_COLUMNS = {
    "corpus": "corpus", "corpus_version": "corpus_version", "en_text": "en_norm", "en_text_raw": "en_raw", "en_words": "en_words", "estimated_ja_seconds": "estimated_ja_seconds", "ja_chars": "ja_chars", "ja_text": "ja_norm", "ja_text_raw": "ja_raw",
    "length_bin": "length_bin", "license_id": "license_id", "normalizer_version": "normalizer_version", "pair_id": "pair_id", "selection_priority": "priority", "source_id": "source_id", "split": "split",
}


def split_place() -> Column:
    place = F.lit(len(SPLITS))
    for k, s in enumerate(SPLITS):
        place = F.when(F.col("split") == s, k).otherwise(place)
    return place


def kept(rows: DataFrame) -> DataFrame:
    """Selected training rows and all evaluation rows."""
    return rows.where(F.coalesce("selected", F.lit(False)) | (F.col("split") != "train"))


def rows_of(candidates: DataFrame, sources: DataFrame) -> DataFrame:
    """The manifest's sixteen columns, by name, with the source's version; sources is (corpus, corpus_version, license_id)."""
    df = candidates.drop("corpus_version", "license_id").join(F.broadcast(sources), "corpus").withColumn("normalizer_version", F.lit(NORMALIZER))
    return df.select(*[F.col(c).alias(n) for n, c in _COLUMNS.items()])


def ordered(manifest: DataFrame) -> DataFrame:
    """Training rows, then dev, then the others; within these by corpus and priority."""
    return manifest.orderBy(split_place(), "corpus", "selection_priority", "pair_id")


def with_position(manifest: DataFrame, order: str = "selection_priority") -> DataFrame:
    """Adds manifest_pos from 0 on, in the manifest's order.

    Not by one window over everything: rows are numbered in buckets of the hash-valued order, and counts of
    the buckets before are added, of which there are a bounded number for each split and corpus.
    """
    df = written(manifest, "manifest-rows").withColumn("__split", split_place()).withColumn("__bucket", F.substring(order, 1, 3))
    key = ["__split", "corpus", "__bucket"]
    counts = df.groupBy(*key).agg(F.count("*").alias("__n"))
    base = counts.select(*key, F.coalesce(F.sum("__n").over(W.orderBy(*key).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__base"))
    n = F.row_number().over(W.partitionBy(*key).orderBy(order, "pair_id"))
    return df.join(base, key).withColumn("manifest_pos", F.col("__base") + n - 1).drop("__split", "__bucket", "__base")


def split_counts(manifest: DataFrame) -> DataFrame:
    """(key, pairs) with split:corpus as key."""
    return manifest.groupBy(F.concat_ws(":", "split", "corpus").alias("key")).agg(F.count("*").alias("pairs"))


def invalid_fields(rows: DataFrame) -> DataFrame:
    """Adds invalid: the required fields that are null or blank, and unsafe, whether the id can't be part of a file name."""
    bad = F.array(*[F.when(F.coalesce(F.trim(F.regexp_replace(F.col(c).cast("string"), r"(?U)\s+", " ")) == "", F.lit(True)), F.lit(c)) for c in REQUIRED])
    return rows.withColumn("invalid", F.array_compact(bad)).withColumn("unsafe", ~F.coalesce(F.rlike("pair_id", F.lit(SAFE_ID)), F.lit(False)))


def validated(rows: DataFrame) -> DataFrame:
    """The rows as they are; ValueError for no rows, invalid fields, unsafe ids or repeated ids, naming a few."""
    checked = invalid_fields(rows)
    n = checked.agg(F.count("*").alias("n"), F.count_if((F.size("invalid") > 0) | F.col("unsafe")).alias("bad")).first()
    if not n.n:
        raise ValueError("the manifest has no rows")
    if n.bad:
        some = [(r.pair_id, r.invalid, r.unsafe) for r in checked.where((F.size("invalid") > 0) | F.col("unsafe")).select("pair_id", "invalid", "unsafe").limit(5).collect()]
        raise ValueError(f"{n.bad} rows with invalid fields or ids, among them {some}")
    twice = [r.pair_id for r in rows.groupBy("pair_id").count().where("count > 1").limit(5).collect()]
    if twice:
        raise ValueError(f"repeated pair_id, among them {twice}")
    return rows


def sharded(rows: DataFrame, shards: int) -> DataFrame:
    return rows.withColumn("shard", ids.shard(F.col("pair_id"), shards))


def shard_rows(rows: DataFrame, index: int, shards: int, most: int) -> DataFrame:
    """One shard's rows; ValueError for an index that isn't one, or more than ``most`` rows."""
    if not 0 <= index < shards:
        raise ValueError(f"there is no shard {index} of {shards}")
    own = rows.where(ids.shard(F.col("pair_id"), shards) == index)
    n = own.count()
    if n > most:
        raise ValueError(f"shard {index} has {n} pairs, and at most {most} are allowed; more shards are needed")
    return own


def shard_counts(rows: DataFrame, shards: int) -> DataFrame:
    """(shard, pairs) of every shard, with 0 for empty ones."""
    have = sharded(rows, shards).groupBy("shard").agg(F.count("*").alias("pairs"))
    return rows.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard")).join(have, "shard", "left").select("shard", F.coalesce("pairs", F.lit(0)).alias("pairs"))


def shard_plan(rows: DataFrame, shards: int) -> DataFrame:
    """One row of totals over the shards; the mean is over all shards, empty ones included."""
    return shard_counts(rows, shards).agg(
        F.sum("pairs").alias("pairs"), F.count("*").alias("num_shards"), F.count_if(F.col("pairs") == 0).alias("empty_shards"),
        F.min("pairs").alias("minimum_pairs_per_shard"), F.max("pairs").alias("maximum_pairs_per_shard"), F.avg("pairs").alias("mean_pairs_per_shard"),
    )


def value_counts(rows: DataFrame) -> DataFrame:
    """(field, value, pairs) for corpus and split, in one pass."""
    return rows.groupingSets([["corpus"], ["split"]], "corpus", "split").agg(F.grouping("corpus").alias("g"), F.count("*").alias("pairs")).select(
        F.when(F.col("g") == 0, "corpus").otherwise("split").alias("field"), F.when(F.col("g") == 0, F.col("corpus")).otherwise(F.col("split")).alias("value"), "pairs"
    )
