"""Queries of the corpus operators, and the SQL that some can be compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodeweave.llm.jaccard_join import linked
from lodeweave.llm.langid import identify
from lodeweave.llm.line_dedup import line_dedup
from lodeweave.llm.media import image_hashes, rendered
from lodeweave.llm.mixing import copies
from lodeweave.llm.outliers import outliers
from lodeweave.llm.pieces import encode
from lodeweave.llm.pii import redact
from lodeweave.llm.token_counts import token_counts
from lodeweave.llm.warc import round_trip
from lodeweave.session import spread, table

#: Where the public tokenizers' files are, on every machine.
TOKENIZERS = "/opt/tokenizers"
PIECE_MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"
_ALL: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _op(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    _ALL[f.__name__] = f
    return f


@_op
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each document by its text, and whether it is accepted."""
    return identify(spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))).select("doc_id", "lang", "lang_id", "lang_entropy", "lang_ok")


@_op
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether decoding gives its text again."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return encode(docs, PIECE_MODEL).select("doc_id", "token_ids", "n_tokens", "round_trip")


@_op
def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's class of near duplicates, and with how many documents it is linked."""
    return linked(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


@_op
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document occurs in a mixture of the sources by their weights."""
    return copies(table(spark, sf_dir, "documents"))


@_op
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to WARC files and read back, with their digests verified."""
    return round_trip(table(spark, sf_dir, "pages")).select("page_id", "url", "html", "n_bytes", "digest_ok", "error")


_SQL["op5_warc"] = """
SELECT page_id, url, html, CAST(strlen(html) AS BIGINT) AS n_bytes, TRUE AS digest_ok, CAST(NULL AS VARCHAR) AS error FROM pages
"""


@_op
def op6_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as PNG pictures in a binary column, decoded and hashed."""
    return image_hashes(rendered(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))).select("vec_id", "png", "width", "height", "phash", "image_error")


@_op
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of tokens of each document."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return token_counts(docs, f"{TOKENIZERS}/byte_bpe_multi_50k.tiktoken")


@_op
def op8_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's robust distance from its language and source, and whether it is accepted."""
    return outliers(spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")), every=True)


@_op
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs."""
    return line_dedup(spread(table(spark, sf_dir, "documents").select("doc_id", "text"))).select("doc_id", "text", "lines_deleted")


@_op
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with personal data and secrets redacted, and where they were."""
    return redact(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Query by name."""
    return dict(_ALL)


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL by query name."""
    return dict(_SQL)
