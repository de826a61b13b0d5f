"""Mixing sources to target weights by pivotal dependent rounding.

A source's share of the mixture fixes how often each of its documents should occur: a whole number of copies and
a fraction. Rounding each fraction by itself would let a source's total drift; pivotal rounding pairs two
fractions p and q and moves mass between them at random, so that one becomes 0 or 1 and both keep their
expectation, until at most one of a source is left. So each document gets its copies rounded down or up, with the
right probability, and each source's number of copies is its target, rounded down or up.

Pairing goes up a tree. A source's documents fall into leaves by a hash of doc_id, of about ``LEAF`` documents
each; each leaf hands one fraction, its residual, to its parent, which combines those of its 2 ** ``FAN_BITS`` children. The
leaves, their order and all random numbers come from hashes of the rows themselves, so a task that runs again,
anywhere and over whatever partitions, decides the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lodeweave.llm.common import fresh, written

#: A source's weight in the mixture is its size to this power, so small sources gain.
POWER = 0.7
SEED = 20240501
LEAF, FAN_BITS = 4096, 8


_EPS = 1e-9
#: What travels up the tree: the document itself, so that hashes which collide don't mix up two documents' decisions.
_ROW = ("doc_id", "source", "src", "depth", "h")


def _weights(sizes: DataFrame, power: float) -> DataFrame:
    """(source, weight): each source's size in characters to the power."""
    return sizes.where("size > 0").select("source", F.pow(F.col("size").cast("double"), F.lit(float(power))).alias("weight"))


def _expected(sizes: DataFrame, weights: DataFrame, budget: float | None) -> DataFrame:
    """(source, many, expected): how often each document of a source should occur for the sources to have their weights."""
    w = weights.where("weight > 0").select(F.col("source").alias("__source"), "weight")
    both = sizes.join(w, F.col("source").eqNullSafe(F.col("__source")), "left")
    share = F.col("weight") / F.sum(F.when(F.col("size") > 0, F.col("weight"))).over(W.partitionBy())
    both = both.withColumn("w", F.when(F.col("size") > 0, share))
    total = F.lit(float(budget)) if budget is not None else F.max(F.col("size") / F.col("w")).over(W.partitionBy())
    nothing = F.lit(0.0 if budget is not None else 1.0)
    per = F.when(F.col("size") == 0, nothing).otherwise(F.coalesce(F.col("w") * total / F.col("size"), F.lit(0.0)))
    # what is a whole number but for rounding errors is one
    return both.select("source", "many", F.when(F.abs(per - F.round(per)) < _EPS, F.round(per)).otherwise(per).alias("expected"))


def pivotal(p: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, int, float]:
    """Round fractions one after another; u has a random number in [0, 1) for each pair.

    Gives 0 or 1 for each, the place of the one left with a fraction, or -1, and that fraction.
    """
    out = np.zeros(len(p), np.int64)
    at, have = -1, 0.0
    for k, (q, x) in enumerate(zip(p.tolist(), u.tolist())):
        if q <= _EPS or q >= 1 - _EPS:
            out[k] = q > 0.5
            continue
        if at < 0:
            at, have = k, q
            continue
        total = have + q
        if total < 1:  # one goes to 0, the other holds the sum
            if x < have / total:
                have = total
            else:
                at, have = k, total
        else:  # one goes to 1, the other holds the rest
            if x < (1 - q) / (2 - total):
                out[at] = 1
                at, have = k, total - 1
            else:
                out[k] = 1
                have = total - 1
        if have <= _EPS or have >= 1 - _EPS:
            out[at] = have > 0.5
            at, have = -1, 0.0
    return out, at, have


def _uniform(x: np.ndarray, level: int, seed: int) -> np.ndarray:
    """Random numbers in [0, 1) from hashes."""
    with np.errstate(over="ignore"):
        z = x.view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (level + 1) + seed) % 2**64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2**53


def _rounded(level: int, seed: int):
    """Pivotal rounding in each run of one (src, node) of a sorted stream; a node's rows fit in memory, as leaves are small."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None

        def done() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            h, p = t.column("h").to_numpy(), t.column("p").to_numpy()
            up, at, have = pivotal(p, _uniform(h, level, seed))
            rest = np.full(len(p), np.nan)
            if at >= 0:
                rest[at] = have
            columns = [*(t.column(c).combine_chunks() for c in _ROW), pa.array(up.astype(np.int32)), pa.array(rest, from_pandas=True)]
            return pa.RecordBatch.from_arrays([c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns], names=[*_ROW, "up", "rest"])

        for batch in batches:
            if not batch.num_rows:
                continue
            src, node = batch.column("src").to_numpy(), batch.column("node").to_numpy()
            cuts = np.append(np.append(0, np.flatnonzero((src[1:] != src[:-1]) | (node[1:] != node[:-1])) + 1), len(src))
            for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if (src[s], node[s]) != key:
                    if held:
                        yield done()
                    held, key = [], (src[s], node[s])
                held.append(batch.slice(s, e - s))
        if held:
            yield done()

    return f


def copies(docs: DataFrame, weights: DataFrame | None = None, budget: float | None = None, power: float = POWER, seed: int = SEED) -> DataFrame:
    """(doc_id, source, copies): how often each document occurs in the mixture, 0 included.

    Sources have their ``weights`` (source, weight), by default their size to the ``power``. ``budget`` is the
    mixture's size in characters; without one it is the least by which no document of a source with a weight
    occurs less than once, so that mixing repeats and loses nothing. Weights that are null or not positive, and
    missing ones, give 0 copies. A null or empty text counts 0 characters; the documents of a source without any
    characters occur once without a budget, else not; a very long text is but a number of characters. Documents of equal
    fraction are told apart by their hashes, and equal hashes by doc_id. doc_id is an integer. Rows that share doc_id and source are one document
    with one decision; a null doc_id or source is a value like others. An empty table gives no rows. Extra columns
    are ignored.
    """
    units = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n"))
    units = written(units.groupBy("doc_id", "source").agg(F.sum("n").alias("n")), "mix-docs")
    sizes = units.groupBy("source").agg(F.sum("n").alias("size"), F.count("*").alias("many"))
    depth = F.greatest(F.lit(0), F.ceil(F.log2(F.col("many") / F.lit(float(LEAF))))).cast("int")
    base = F.floor("expected")
    plan = _expected(sizes, weights if weights is not None else _weights(sizes, power), budget)
    plan = written(plan.select(F.col("source").alias("__source"), F.xxhash64(F.lit(seed), "source").alias("src"), depth.alias("depth"), base.cast("int").alias("base"), (F.col("expected") - base).alias("p")), "mix-plan")
    deepest = plan.agg(F.max("depth")).first()[0] or 0
    known = units.join(plan, F.col("source").eqNullSafe(F.col("__source"))).select("doc_id", "source", "src", "depth", "base", "p", F.xxhash64(F.lit(seed), "doc_id", "source").alias("h"))
    at, level, decided = known.select(*_ROW, "p"), 0, []
    while True:
        left = F.greatest(F.lit(0), F.col("depth") - level * FAN_BITS)
        node = F.when(left == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftrightunsigned", "h", 64 - left))
        ordered = at.withColumn("node", node).repartition("src", "node").sortWithinPartitions("src", "node", "h", "doc_id")
        out = written(ordered.mapInArrow(_rounded(level, seed), "doc_id bigint, source string, src bigint, depth int, h bigint, up int, rest double"), "mix-level")
        decided.append(out.where("rest is null").select("doc_id", "source", "up"))
        at = out.where("rest is not null").select(*_ROW, F.col("rest").alias("p"))
        if level * FAN_BITS >= deepest:
            break
        level += 1
    # what a source's root is left with is rounded by itself
    chance = F.pmod(F.xxhash64(F.lit(seed + 1), "h"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    ups = at.select("doc_id", "source", (chance < F.col("p")).cast("int").alias("up"))
    for x in decided:
        ups = ups.unionByName(x)
    # units are distinct, so each has one decision; nulls are values
    same = F.col("k.doc_id").eqNullSafe(F.col("u.doc_id")) & F.col("k.source").eqNullSafe(F.col("u.source"))
    return known.alias("k").join(ups.alias("u"), same).select("k.doc_id", "k.source", (F.col("base") + F.col("up")).cast("int").alias("copies"))


def mixed(docs: DataFrame, weights: DataFrame | None = None, budget: float | None = None) -> DataFrame:
    """The documents, each as often as ``copies`` says, with all their columns. Repeated rows are repeated alike."""
    id_, source, times = fresh(docs, "__id", "__source", "__copies")
    n = copies(docs, weights, budget).where("copies > 0").select(F.col("doc_id").alias(id_), F.col("source").alias(source), F.col("copies").alias(times))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & F.col("source").cast("string").eqNullSafe(F.col(source))
    each = docs.join(n.hint("shuffle_hash"), same)
    return each.withColumn(times, F.explode(F.array_repeat(F.lit(0), F.col(times)))).select(*docs.columns)
