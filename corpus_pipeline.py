"""The corpus pipeline: stages over documents, each written as Parquet and read again as the next one's input.

What holds for all stages: extra columns are left out, so none can clash, and the columns of documents come back; an empty
table gives an empty table; a very long text is worked on whole. doc_id is an integer and should be unique: rows that repeat
one with its text are kept or dropped alike. No stage samples, caps or reorders what it keeps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodeweave.llm.common import written
from lodeweave.llm.jaccard_join import near_duplicates_dropped
from lodeweave.llm.langid import known_languages
from lodeweave.llm.line_dedup import line_dedup
from lodeweave.llm.mixing import mixed
from lodeweave.llm.pieces import encode
from lodeweave.llm.queries import PIECE_MODEL

#: Of a near copy, line dedup may have taken whole lines before, so less of it need be alike than in a join of whole texts.
NEAR = 0.4
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents that it rejects go.

    Null and empty texts, and those without letters, have no language and go. A null lang is no label, and its text is
    judged like others. A tie between languages goes to the first by name. Rows with a null doc_id are judged too.
    """
    return known_languages(docs.select(*COLUMNS))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: later copies of repeated line runs go from the texts, and a document goes if nothing is left of it.

    n_chars follows a text that has changed, and stays, null included, where it hasn't. Null and empty texts and rows with a null
    doc_id stay as they are. Of equal runs the first by (doc_id, line) stays.
    """
    return line_dedup(docs.select(*COLUMNS)).where("lines_deleted = 0 or text <> ''").selectExpr("doc_id", "text", "lang", "source", "if(lines_deleted > 0, cast(length(text) as bigint), n_chars) as n_chars")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: one document of each group of near duplicates stays, that of the smallest doc_id.

    Null and blank texts and rows with a null doc_id join nothing and stay.
    """
    return near_duplicates_dropped(docs.select(*COLUMNS), NEAR)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: each document as often as its source's weight asks for, once at least.

    A null source is a source like others; documents of a source without any characters occur once. Repeated rows are
    repeated alike. Equal fractions are told apart by hashes of the documents.
    """
    return mixed(docs.select(*COLUMNS)).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece: token ids beside the texts that they decode to. A null text has null ids, an empty one none."""
    return encode(docs.select(*COLUMNS), PIECE_MODEL)


STAGES = [("language ID", language), ("line dedup", lines), ("near duplicates", near_duplicates), ("mixture", mixture), ("tokens", tokens)]

#: No SQL can express the models, the candidate search and the rounding; tests/llm/test_pipeline.py has the brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; a null text goes with the first."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage-{k}")
    return docs
