"""Line dedup: a suffix array over line-ID sequences by distributed prefix doubling.

Every document is a sequence of lines. Only lines that occur more than once in the corpus can be part of a
repeated run, so the suffix array holds the suffixes of the *blocks* of consecutive repeated lines; a block's
end works as the end marker. Prefix doubling refines ranks until they order the suffixes by whole blocks; the
longest common prefixes of neighbours in that order give, through a stack over the sorted stream, each
suffix's longest run that also occurs earlier in the corpus (by doc_id, then line number). Those runs are the
later copies of the maximal repeated runs; where one has at least ``min_words`` words, its lines are deleted.

Two reductions before that change no result and take out what would be hot. A block of under ``min_words`` words can
hold no run of so many, nor a copy of one, so it goes: a line that nearly every document has, such as a blank one, stands
mostly in such blocks. Of blocks that are equal from end to end only the first goes on; a later one is a copy as
a whole, and whatever is a copy of a part of it is one of the same part of the first.

Every shuffle except the last, by which the masks meet the texts, moves fixed-width rows of repeated lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from lodeweave.llm.common import fresh, written

MIN_WORDS = 50
#: Ranges of the hash space in which the first ranks are counted; fixed, whatever the input.
BUCKETS = 4096
_BITS = 12


def _lines(docs: DataFrame) -> DataFrame:
    """(id, pos, h1, h2, words): a row for each line of each non-null text."""
    at = F.posexplode(F.split(F.col("text"), "\n"))
    one = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("id"), at.alias("pos", "line"))
    words: Column = F.when(F.trim("line") == "", 0).otherwise(F.size(F.split(F.trim("line"), r"\s+")))
    return one.select("id", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"), words.alias("words"))


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(id, pos, words, r0): lines that occur twice or more; r0 is the number of such lines with a smaller ID."""
    lines = _lines(docs)
    ids = lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1")
    ids = ids.withColumn("bucket", F.shiftright(F.col("h1"), 64 - _BITS))
    per = ids.groupBy("bucket").agg(F.sum("n").alias("bn"))
    before = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    per = per.select("bucket", F.coalesce(F.sum("bn").over(before), F.lit(0)).alias("base"))
    inside = W.partitionBy("bucket").orderBy("h1", "h2").rowsBetween(W.unboundedPreceding, -1)
    # per has at most BUCKETS rows, so it may be broadcast whatever the input
    ids = ids.join(F.broadcast(per), "bucket").select("h1", "h2", (F.col("base") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("r0"))
    return lines.join(ids, ["h1", "h2"]).select("id", "pos", "words", "r0")


def _blocks(lines: DataFrame) -> DataFrame:
    """Adds blk, the first line of the block, rem, the lines from here to its end, and cw, the words up to here."""
    doc = W.partitionBy("id").orderBy("pos")
    gap = lines.withColumn("gap", F.col("pos") - F.row_number().over(doc))
    block = W.partitionBy("id", "gap").orderBy("pos")
    whole = W.partitionBy("id", "gap")
    return gap.select("id", "pos", "words", "r0", F.min("pos").over(whole).alias("blk"), (F.max("pos").over(whole) - F.col("pos") + 1).alias("rem"), F.sum("words").over(block).alias("cw"))


def _reduced(blocks: DataFrame, min_words: int) -> tuple[DataFrame, DataFrame]:
    """The lines of the first of each kind of block with enough words, and (id, pos, n) of the later ones' first lines, n being the block's length."""
    each = blocks.groupBy("id", "blk").agg(F.sum("words").alias("w"), F.sort_array(F.collect_list(F.struct("pos", "r0"))).alias("s")).where(F.col("w") >= min_words)
    each = each.select("id", "blk", F.size("s").alias("len"), F.sha2(F.array_join(F.transform("s", lambda x: x["r0"].cast("string")), ","), 256).alias("kind"))
    each = written(each, "line-kinds")
    # partial aggregates leave a row for each kind and task, so a kind that a third of all blocks are of isn't gathered in one
    first = each.groupBy("kind").agg(F.min(F.struct("id", "blk")).alias("f")).select("f.*")
    later = each.join(first, ["id", "blk"], "left_anti").select("id", "blk", "len")
    own = blocks.join(first, ["id", "blk"])
    return own.select(*blocks.columns), later.select("id", F.col("blk").alias("pos"), F.col("len").alias("n"))


def suffix_ranks(blocks: DataFrame, rounds: int) -> DataFrame:
    """Prefix doubling. Adds rs, the ranks by the first 1, 2, 4, ... lines; the last orders whole suffixes.

    A rank is the number of suffixes that are smaller by so many lines. The rank 2^k lines further on comes
    from a window over the document, the refined rank from a window over the suffixes of equal rank.
    """
    df = blocks.withColumn("r", F.col("r0")).withColumn("rs", F.array("r0"))
    for k in range(rounds):
        step = 1 << k
        ahead = W.partitionBy("id").orderBy("pos").rangeBetween(step, step)
        df = df.withColumn("next", F.when(F.col("rem") > step, F.max("r").over(ahead)).otherwise(F.lit(-1)))
        df = df.withColumn("r", F.col("r") + F.rank().over(W.partitionBy("r").orderBy("next")) - 1)
        df = df.withColumn("rs", F.concat("rs", F.array(F.col("r").cast("long")))).drop("next")
    return df


def _common(df: DataFrame, blocks: DataFrame) -> DataFrame:
    """Adds lcp, the lines in common with the suffix before in the order of (r, id, pos), 0 at a first line's first suffix.

    Equal ranks by 2^k lines bound it from below. Neighbours that this leaves open, which share two lines or
    more and then differ, fetch the lines between from their blocks.
    """
    order = W.partitionBy("r0").orderBy("r", "id", "pos")
    last = F.lag(F.struct("id", "blk", "pos", "rem", "rs")).over(order)
    df = df.withColumn("p", last)
    least = F.least(F.col("rem"), F.col("p.rem"))
    same = F.size(F.filter(F.zip_with("rs", "p.rs", lambda a, b: a == b), lambda x: x)) - 1
    df = df.withColumn("k", F.when(F.col("p").isNull(), F.lit(None)).otherwise(same))
    tie = F.element_at("rs", -1) == F.element_at(F.col("p.rs"), -1)
    low = F.expr("shiftleft(1, k)")
    closed = F.when(F.col("p").isNull(), 0).when(tie, least).when((F.col("k") == 0) | (low >= least), F.least(low, least))
    df = df.withColumn("lcp", closed).withColumn("low", low).withColumn("most", F.least(low * 2 - 1, least))
    keep = ["id", "pos", "r0", "r"]
    done = df.where("lcp is not null").select(*keep, F.col("lcp").cast("int").alias("lcp"))
    seq = blocks.groupBy("id", "blk").agg(F.sort_array(F.collect_list(F.struct("pos", "r0"))).alias("s"))
    seq = seq.select("id", "blk", F.col("s.r0").alias("seq"))
    left = df.where("lcp is null").select(*keep, "blk", "low", "most", F.col("p.id").alias("qid"), F.col("p.blk").alias("qblk"), F.col("p.pos").alias("qpos"))
    part = lambda at, start: F.slice("seq", F.col(at) - F.col(start) + F.col("low") + 1, F.col("most") - F.col("low"))
    left = left.join(seq, ["id", "blk"]).withColumn("a", part("pos", "blk")).drop("seq", "blk")
    left = left.join(seq.select(F.col("id").alias("qid"), F.col("blk").alias("qblk"), "seq"), ["qid", "qblk"]).withColumn("b", part("qpos", "qblk"))
    differs = F.array_position(F.zip_with("a", "b", lambda x, y: x != y), True)
    more = F.when(differs > 0, differs - 1).otherwise(F.size("a"))
    return done.unionByName(left.select(*keep, (F.col("low") + more).cast("int").alias("lcp")))


def _earlier_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each suffix of the sorted stream, the longest run that also begins at an earlier place of the corpus.

    The stack holds suffixes whose next neighbour at an earlier place isn't known yet; places rise from its bottom up.
    """
    stack: list[list] = []
    first = None
    for pdf in batches:
        out_id, out_pos, out_n = [], [], []

        def done(x: list) -> None:
            if x[2] > 0:
                out_id.append(x[0][0])
                out_pos.append(x[0][1])
                out_n.append(x[2])

        for r0, i, pos, lcp in zip(pdf.r0.tolist(), pdf.id.tolist(), pdf.pos.tolist(), pdf.lcp.tolist()):
            if r0 != first:
                for x in stack:
                    done(x)
                stack, first = [], r0
            place, common = (i, pos), lcp
            # x: place, the common prefix with the suffix below it on the stack, the best run so far
            while stack and stack[-1][0] > place:
                x = stack.pop()
                x[2] = max(x[2], common)
                done(x)
                common = min(common, x[1])
            stack.append([place, common if stack else 0, common if stack else 0])
        yield pd.DataFrame({"id": pd.Series(out_id, dtype="int64"), "pos": pd.Series(out_pos, dtype="int32"), "n": pd.Series(out_n, dtype="int32")})
    rest = [x for x in stack if x[2] > 0]
    yield pd.DataFrame({"id": pd.Series([x[0][0] for x in rest], dtype="int64"), "pos": pd.Series([x[0][1] for x in rest], dtype="int32"), "n": pd.Series([x[2] for x in rest], dtype="int32")})


@F.pandas_udf(T.ArrayType(T.BooleanType()))
def _mask(pos: pd.Series, words: pd.Series, runs: pd.Series, min_words: pd.Series) -> pd.Series:
    """Which lines to delete, from the document's repeated lines and the length of the run that begins at each."""
    out = []
    for at, cw, n, least in zip(pos, words, runs, min_words):
        at, cw, n = np.asarray(at), np.asarray(cw, dtype=np.int64), np.asarray(n)
        order = np.argsort(at)
        at, cw, n = at[order], cw[order], n[order]
        before = np.concatenate([[0], np.cumsum(cw)])
        index = np.flatnonzero(n)
        index = index[before[index + n[index]] - before[index] >= least]
        mark = np.zeros(int(at[-1]) + 2, dtype=np.int64)
        np.add.at(mark, at[index], 1)
        np.add.at(mark, at[index] + n[index], -1)
        cover = np.cumsum(mark)[:-1] > 0
        out.append(cover.tolist() if cover.any() else None)
    return pd.Series(out, dtype=object)


def deletion_masks(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(id, mask): for each document that loses lines, an array of booleans, true where a line is deleted."""
    spark: SparkSession = docs.sparkSession
    blocks = written(_blocks(repeated_lines(docs)), "line-blocks")
    own, copied = _reduced(blocks, min_words)
    own = written(own, "line-firsts")
    longest = own.agg(F.max("rem")).first()[0] or 0
    if longest == 0:
        return spark.createDataFrame([], "id bigint, mask array<boolean>")
    ranked = suffix_ranks(own, int(longest - 1).bit_length())
    suffixes = _common(ranked, own)
    runs = suffixes.repartition("r0").sortWithinPartitions("r0", "r", "id", "pos").select("r0", "id", "pos", "lcp").mapInPandas(_earlier_runs, "id bigint, pos int, n int")
    # all repeated lines of a document, as a run is a stretch of them
    found = written(runs.where("n > 0").unionByName(copied), "line-runs")
    each = blocks.join(found.select("id").distinct(), "id", "left_semi").select("id", "pos", "words").join(found, ["id", "pos"], "left")
    by = each.groupBy("id").agg(F.collect_list(F.struct("pos", "words", F.coalesce("n", F.lit(0)).alias("n"))).alias("s"))
    # it gives the same each time, but the mark keeps the filter from a second evaluation, in a second Python worker beside each task's first
    return by.select("id", _mask.asNondeterministic()("s.pos", "s.words", "s.n", F.lit(min_words)).alias("mask")).where("mask is not null")


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Delete later copies of repeated line runs of at least ``min_words`` words; adds ``lines_deleted``.

    The first copy, by (doc_id, line number), stays. Lines are what lies between newlines, compared byte for
    byte; words are what white space separates. Null texts and rows with a null doc_id stay as they are, with 0
    lines deleted; an empty text is one empty line, of no words. doc_id is an integer. Ties don't arise, as places differ;
    a very long text is but many lines. Rows that share a doc_id are taken for one
    place of the corpus with interleaved lines, so doc_id should be unique; with repeated rows the same mask
    applies to each. A document that loses all its lines keeps its row, with an empty text. Extra columns
    pass through; an input column ``lines_deleted`` is replaced. An empty table gives an empty table.
    """
    kept = [c for c in docs.columns if c != "lines_deleted"]
    id_, mask = fresh(docs, "__id", "__mask")
    masks = deletion_masks(docs, min_words).select(F.col("id").alias(id_), F.col("mask").alias(mask))
    both = docs.select(*kept).join(masks, F.col("doc_id") == F.col(id_), "left")
    rest = F.filter(F.split(F.col("text"), "\n"), lambda x, i: ~F.coalesce(F.get(F.col(mask), i), F.lit(False)))
    text = F.when(F.col(mask).isNull(), F.col("text")).otherwise(F.array_join(rest, "\n"))
    lost = F.when(F.col(mask).isNull() | F.col("text").isNull(), 0).otherwise(F.size(F.filter(mask, lambda x: x)))
    return both.select(*[text.alias("text") if c == "text" else F.col(c) for c in kept], lost.cast("int").alias("lines_deleted"))
