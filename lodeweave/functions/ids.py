"""Deterministic identifiers: fingerprints, pair ids, priorities, shards and seeds, all from SHA-256."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_U64 = "decimal(20,0)"


def fingerprint(ja: Column, en: Column) -> Column:
    """Of two texts with a NUL between them, which normalised texts can't hold."""
    return F.sha2(F.concat(ja, F.lit("\0"), en), 256)


def pair_id(corpus: Column, split: Column, index: Column, print_: Column) -> Column:
    """corpus_split_index_fingerprint; the index has eight digits at least, the fingerprint twelve."""
    return F.format_string("%s_%s_%08d_%s", corpus, split, index, F.substring(print_, 1, 12))


def source_id(corpus: Column, split: Column, index: Column) -> Column:
    return F.concat_ws(":", corpus, split, index.cast("string"))


def priority(seed: int, id_: Column) -> Column:
    """A pseudo-random order of ids, other for each seed."""
    return F.sha2(F.concat(F.lit(f"{seed}\0"), id_), 256)


def leading_u64(text: Column) -> Column:
    """The first eight bytes of the digest as an unsigned number."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 16), 16, 10).cast(_U64)


def shard(id_: Column, shards: int) -> Column:
    """A stable shard number from 0 on."""
    if shards < 1:
        raise ValueError("there must be a shard at least")
    return (leading_u64(id_) % F.lit(shards).cast(_U64)).cast("int")


def shard_name(index: Column, shards: int) -> Column:
    return F.format_string("shard-%05d-of-%05d", index, F.lit(shards))


def audio_name(id_: Column, attempt: Column) -> Column:
    return F.format_string("%s.a%d.wav", id_, attempt)


def seed(id_: Column, language: Column, attempt: Column) -> Column:
    """A non-negative 63-bit seed for an attempt."""
    text = F.concat(id_, F.lit("\0"), language, F.lit("\0"), attempt.cast("string"))
    return (leading_u64(text) % F.lit(str(2**63)).cast(_U64)).cast("long")


def length_bin(units: Column, short: int, medium: int) -> Column:
    """Up to ``short`` units is short, up to ``medium`` medium, else long; null for null."""
    return F.when(units <= short, "short").when(units <= medium, "medium").when(units.isNotNull(), "long")


def spoken_seconds(units: Column, per_second: float, padding: float) -> Column:
    """Estimated length of speech, in double precision."""
    return units.cast("double") / F.lit(float(per_second)) + F.lit(float(padding))


def pcm16_gib(hours: float, languages: int = 2, rate: int = 16_000, retries: float = 0.0) -> float:
    """Storage of 16-bit audio in GiB."""
    return hours * 3600 * rate * 2 * languages * (1 + retries) / 2**30
