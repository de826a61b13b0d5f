"""N-gram Jaccard join: MinHash candidates, Bayesian pruning, exact verification.

1. A pass over the texts gives each document its distinct word n-grams, hashed to 64 bits, a 128-bit hash of
   that set and ``HASHES`` MinHash values. Documents of one set are copies; the smallest doc_id stands for all.
2. Documents that agree on all values of a band meet in a bucket. A bucket of any size is cut by a hash of the id into
   blocks of about ``BLOCK`` documents, and each pair of blocks is a group of its own, so there is no cap on
   partners. A pair counts in the first band that it shares, so it comes up once.
3. In the group, MinHash values are compared a few at a time. With a uniform prior, the posterior of the
   similarity after m matches in n is Beta(m + 1, n - m + 1); a pair goes once its probability of reaching the
   threshold is below the tolerance. What remains leaves the group as one list of partners for each document, beside
   the few links that hold these together.
4. Connected components of those links bring together the documents whose n-gram sets have to meet. A set is sent
   to the pairs of blocks in which one of its document's own partners is, and to no others; there, intersections
   are counted exactly as products of incidence matrices.

linked() gives each document its class and its number of links, and so a row for each document however many links
there are; jaccard_join() gives the pairs themselves, copies collapsed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeweave.llm.common import fresh, written
from lodeweave.llm.components import components

NGRAM = 3
THRESHOLD = 0.5
TOLERANCE = 0.005
BANDS, ROWS = 32, 3
HASHES = BANDS * ROWS
#: Values compared between two looks at the posterior.
STEP = 12
#: Documents in a block of signatures, and in one of n-gram sets, which are larger; both are about so many.
BLOCK, SETS = 2048, 256
_MIX = np.uint64(0x9E3779B97F4A7C15)
_A = (np.random.RandomState(20240229).randint(0, 2**31, HASHES).astype(np.uint32) << np.uint32(1)) | np.uint32(1)
_B = np.random.RandomState(20240301).randint(0, 2**31, HASHES).astype(np.uint32) * np.uint32(2) + np.uint32(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngram_sets(texts: pa.Array, n: int = NGRAM) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's word n-grams; of all its words where it has fewer; none of a blank or null text.

    Words are what white space separates, in lower case.
    """
    words = pc.utf8_split_whitespace(pc.utf8_lower(pc.utf8_trim_whitespace(pc.fill_null(texts, ""))))
    codes = words.flatten().dictionary_encode()
    known = pd.util.hash_array(np.asarray(codes.dictionary.to_pylist(), dtype=object), categorize=False) if len(codes.dictionary) else np.zeros(0, np.uint64)
    flat = _mixed(known)[codes.indices.to_numpy(zero_copy_only=False)] if len(codes) else np.zeros(0, np.uint64)
    ends = words.offsets.to_numpy()
    gram = np.zeros(len(flat), np.uint64)
    if len(flat) >= n:
        for i in range(n):
            gram[: len(flat) - n + 1] = gram[: len(flat) - n + 1] * _MIX + flat[i : len(flat) - n + 1 + i]
        gram = _mixed(gram)
    out = []
    for a, b in zip(ends[:-1] - ends[0], ends[1:] - ends[0]):
        size = b - a
        if size == 0 or (size == 1 and codes.dictionary[int(codes.indices[int(a)].as_py())].as_py() == ""):
            out.append(np.zeros(0, np.uint64))
        elif size < n:
            h = np.array([size], dtype=np.uint64)  # an array, as sums of single numbers warn of overflow
            for x in range(a, b):
                h = h * _MIX + flat[x : x + 1]
            out.append(_mixed(h))
        else:
            out.append(np.unique(gram[a : b - n + 1]))
    return out


def minhash(grams: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over the n-grams, cut to 16 bits; pieces keep long texts' memory bounded."""
    low = (grams >> np.uint64(32)).astype(np.uint32)
    best = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(low), 4096):
        piece = np.multiply.outer(_A, low[k : k + 4096])
        piece += _B[:, None]
        np.minimum(best, piece.min(axis=1), out=best)
    return ((best * np.uint32(0x85EBCA6B)) >> np.uint32(16)).astype(np.uint16)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 512):
            part = batch.slice(k, 512)
            sets = ngram_sets(part.column(1))
            same = [((int(x.sum(dtype=np.uint64)) << 64) | (int(np.bitwise_xor.reduce(x * _MIX + np.uint64(1))) ^ len(x))).to_bytes(16, "big") if len(x) else None for x in sets]
            yield pa.record_batch([part.column(0), pa.array(same, pa.binary()), pa.array([minhash(x).tobytes() if len(x) else None for x in sets], pa.binary())], names=["id", "same", "sig"])


def signatures(docs: DataFrame) -> DataFrame:
    """(id, same, sig) of each document with a non-null doc_id; same and sig are null without a word."""
    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("id"), "text").mapInArrow(_signatures, "id bigint, same binary, sig binary")


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """For n = STEP, 2 STEP, ... values compared: the fewest matches with which a pair goes on."""
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        least = 0
        for m in range(n + 1):
            # P(s >= t) under Beta(m + 1, n - m + 1) is the chance of at most m successes in n + 1 trials of t
            if sum(math.comb(n + 1, j) * threshold**j * (1 - threshold) ** (n + 1 - j) for j in range(m + 1)) >= tolerance:
                least = m
                break
        out.append(least)
    return out


def prune(a: np.ndarray, b: np.ndarray, least: list[int]) -> np.ndarray:
    """Rows of two signature matrices that survive the incremental comparison."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int32)
    for k, m in enumerate(least):
        at = slice(k * STEP, (k + 1) * STEP)
        matches[alive] += (a[alive, at] == b[alive, at]).sum(axis=1, dtype=np.int32)
        alive = alive[matches[alive] >= m]
    return alive


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(-1, BANDS, ROWS).astype(np.uint64)
        key = np.arange(BANDS, dtype=np.uint64)[None, :] << np.uint64(48)
        for r in range(ROWS):
            key = key | sig[:, :, r] << np.uint64(16 * r) if r else key | sig[:, :, 0]
        ids = np.repeat(batch.column("id").to_numpy(), BANDS)
        yield pa.record_batch([pa.array(ids), pa.array(key.reshape(-1).view(np.int64))], names=["id", "key"])


def _groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Runs of whole groups of a stream sorted by ``by``; a group is never cut."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(c).to_numpy(zero_copy_only=False) for c in by]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in last:
            change |= c[1:] != c[:-1]
        at = np.flatnonzero(change)
        if held:
            new = any(held[-1].column(c)[-1].as_py() != batch.column(c)[0].as_py() for c in by)
            if new:
                yield pa.Table.from_batches(held)
                held = []
        cut = int(at[-1]) + 1 if len(at) else 0
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _starts(t: pa.Table, by: list[str]) -> np.ndarray:
    change = np.zeros(t.num_rows, bool)
    change[0] = True
    for c in by:
        x = t.column(c).to_numpy()
        change[1:] |= x[1:] != x[:-1]
    return np.append(np.flatnonzero(change), t.num_rows)


def _tiles(x: np.ndarray, y: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of x with y, or of x with what follows in it, some 100 000 at a time."""
    other = x if y is None else y
    step = max(1, 100_000 // max(1, len(other)))
    for k in range(0, len(x), step):
        i, j = np.repeat(np.arange(k, min(k + step, len(x))), len(other)), np.tile(np.arange(len(other)), min(step, len(x) - k))
        if y is None:
            i, j = i[i < j], j[i < j]
        yield x[i], other[j]


def _pairs(starts: np.ndarray, block: np.ndarray, bi: np.ndarray, bj: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j within groups; in a group of two blocks only across them. At most some 200 000 at a time."""
    small: dict[int, list[int]] = {}
    for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if bi[s] != bj[s]:
            x, y = s + np.flatnonzero(block[s:e] == bi[s]), s + np.flatnonzero(block[s:e] == bj[s])
            yield from _tiles(x, y)
        elif e - s > 256:
            yield from _tiles(np.arange(s, e), None)
        elif e - s > 1:
            small.setdefault(e - s, []).append(s)
    left, right, n = [], [], 0
    for size, where in small.items():
        i, j = np.triu_indices(size, 1)
        per = max(1, 100_000 // len(i))
        for k in range(0, len(where), per):
            s = np.asarray(where[k : k + per])[:, None]
            left.append((s + i).reshape(-1))
            right.append((s + j).reshape(-1))
            n += len(left[-1])
            if n > 100_000:
                yield np.concatenate(left), np.concatenate(right)
                left, right, n = [], [], 0
    if n:
        yield np.concatenate(left), np.concatenate(right)


def _forest(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node that it is connected with) for the ends of edges."""
    nodes, at = np.unique(np.concatenate([x, y]), return_inverse=True)
    a, b = at[: len(x)], at[len(x) :]
    low = np.arange(len(nodes))
    while True:
        m = np.minimum(low[a], low[b])
        new = low.copy()
        np.minimum.at(new, a, m)
        np.minimum.at(new, b, m)
        new = new[new]
        if (new == low).all():
            return nodes, nodes[low]
        low = new


_FOUND = "a bigint, bs array<bigint>, link boolean"


def _lists(a: np.ndarray, b: np.ndarray, link: bool) -> pa.RecordBatch:
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.zeros(0, np.int64)
    return pa.record_batch([pa.array(a[first]), pa.ListArray.from_arrays(pa.array(np.append(first, len(a)), pa.int32()), pa.array(b)), pa.array(np.full(len(first), link))], names=["a", "bs", "link"])


def _candidates(least: list[int]):
    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = ["key", "bi", "bj"]
        for t in _groups(batches, by):
            sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint16).reshape(-1, HASHES)
            ids, band = t.column("id").to_numpy(), (t.column("key").to_numpy().view(np.uint64) >> np.uint64(48)).astype(np.int32)
            ends: list[tuple[np.ndarray, np.ndarray]] = []
            held = 0
            for i, j in _pairs(_starts(t, by), t.column("block").to_numpy(), t.column("bi").to_numpy(), t.column("bj").to_numpy()):
                a, b = sig[i], sig[j]
                ok = prune(a, b, least)
                same = (a[ok] == b[ok]).reshape(-1, BANDS, ROWS).all(axis=2)
                ok = ok[same.argmax(axis=1) == band[i[ok]]]
                if not len(ok):
                    continue
                x, y = np.minimum(ids[i[ok]], ids[j[ok]]), np.maximum(ids[i[ok]], ids[j[ok]])
                yield _lists(x, y, False)
                node, low = _forest(x, y)
                ends.append((low[node != low], node[node != low]))
                held += len(ends[-1][0])
                if held > 1_000_000:
                    node, low = _forest(*(np.concatenate(z) for z in zip(*ends)))
                    ends = [(low[node != low], node[node != low])]
                    held = len(ends[0][0]) // 2
            if ends:
                node, low = _forest(*(np.concatenate(z) for z in zip(*ends)))
                yield _lists(low[node != low], node[node != low], True)

    return f


def _block(of: Column, blocks: Column) -> Column:
    """The block of an id, by a hash, so that it can be told without a join."""
    return F.pmod(F.xxhash64(F.lit(5), of), blocks.cast("long")).cast("int")


def _met(keys: DataFrame) -> DataFrame:
    """(key, id, block, bi, bj): a row for each pair of blocks that an id is in, for the keys that occur twice or more."""
    many = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    df = keys.join(many, "key").withColumn("block", _block(F.col("id"), F.col("blocks")))
    df = df.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return df.select("key", "id", "block", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"))


def candidate_pairs(reps: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """(a, bs, link): pairs a < b that share a band and that the posterior doesn't rule out, as lists; rows with ``link`` only hold together what is in the others."""
    keys = reps.select("id", "sig").mapInArrow(_bands, "id bigint, key bigint")
    met = _met(keys).join(reps.select("id", "sig"), "id")
    met = met.repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj", "id")
    return met.select("key", "bi", "bj", "block", "id", "sig").mapInArrow(_candidates(least_matches(threshold, tolerance)), _FOUND)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 512):
            part = batch.slice(k, 512)
            yield pa.record_batch([part.column(0), part.column(2), pa.array([s.tobytes() for s in ngram_sets(part.column(1))], pa.binary())], names=["id", "copies", "grams"])


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of all pairwise intersections, exactly, by products of incidence matrices over shared n-grams."""
    flat, who = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, who = flat[order], who[order]
    first = np.append(True, flat[1:] != flat[:-1])
    column = np.cumsum(first) - 1
    size = np.bincount(column)
    keep = size[column] > 1
    who, column = who[keep], (np.cumsum(size > 1) - 1)[column[keep]]
    out = np.zeros((len(sets), len(sets)), np.float64)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        s, e = np.searchsorted(column, [lo, lo + 4096])
        m = np.zeros((len(sets), min(4096, int(column[e - 1]) - lo + 1)), np.float32)
        m[who[s:e], column[s:e] - lo] = 1
        out += m @ m.T
    return out


def _verified(threshold: float, links: bool):
    """Pairs of each group that reach the threshold, or, with ``links``, how many documents each is linked with, and one that holds them together."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = ["comp", "bi", "bj"]
        for t in _groups(batches, by):
            starts = _starts(t, by)
            ids, times = t.column("id").to_numpy(), t.column("copies").to_numpy()
            found: list[list[np.ndarray]] = [[], [], []]
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
                sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("grams").slice(s, e - s)]
                lists = t.column("partners").slice(s, e - s).combine_chunks()
                lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
                mine = np.repeat(np.arange(e - s), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
                own = ids[s:e]  # sorted
                to = np.searchsorted(own, lists.flatten().to_numpy(zero_copy_only=False))
                shared, n = intersections(sets)[mine, to], np.array([len(x) for x in sets])
                j = shared / (n[mine] + n[to] - shared)
                ok = j >= threshold
                for have, new in zip(found, (s + mine[ok], s + to[ok], j[ok])):
                    have.append(new)
            a, b, j = (np.concatenate(x) for x in found)
            if not len(a):
                continue
            if not links:
                yield pa.record_batch([pa.array(ids[a]), pa.array(ids[b]), pa.array(j)], names=["doc_a", "doc_b", "jaccard"])
                continue
            many = np.bincount(a, times[b], len(ids)) + np.bincount(b, times[a], len(ids))
            node, low = _forest(a, b)  # places in one group, so none of two groups are joined
            yield pa.record_batch([pa.array(ids[node]), pa.array(ids[low]), pa.array(many[node].astype(np.int64))], names=["id", "to", "n"])

    return f


def _placed(pairs: DataFrame) -> DataFrame:
    """(comp, bi, bj, id, partners): the documents that meet in each pair of blocks of a component, and whom each is to be compared with.

    Rows are made from the pairs, so there are never more than two for each.
    """
    comp = written(components(pairs.where("link").select("a", F.explode("bs").alias("b"))), "join-components")
    large = comp.groupBy("comp").agg(F.count("*").alias("n")).where(F.col("n") > SETS).select("comp", F.ceil(F.col("n") / SETS).cast("int").alias("blocks"))
    place = comp.join(large, "comp", "left").select(F.col("id").alias("a"), "comp", F.coalesce("blocks", F.lit(1)).alias("blocks"))
    ends = pairs.where("not link").join(place, "a").select("comp", "blocks", "a", F.explode("bs").alias("b"))
    x, y = _block(F.col("a"), F.col("blocks")), _block(F.col("b"), F.col("blocks"))
    both = F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("partner")), F.struct(F.col("b").alias("id"), F.lit(None).cast("long").alias("partner")))
    ends = ends.select("comp", F.least(x, y).alias("bi"), F.greatest(x, y).alias("bj"), F.explode(both).alias("end")).select("comp", "bi", "bj", "end.id", "end.partner")
    return ends.groupBy("comp", "bi", "bj", "id").agg(F.collect_list("partner").alias("partners"))


def _compared(docs: DataFrame, reps: DataFrame, pairs: DataFrame, threshold: float, links: bool) -> DataFrame:
    placed = _placed(pairs)
    text = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("id"), "text")
    used = pairs.where("not link").select(F.explode(F.concat(F.array("a"), "bs")).alias("id")).distinct()
    sets = text.join(reps.select("id", "copies").join(used, "id"), "id").select("id", "text", "copies").mapInArrow(_sets, "id bigint, copies bigint, grams binary")
    met = placed.join(sets, "id").repartition("comp", "bi", "bj").sortWithinPartitions("comp", "bi", "bj", "id")
    schema = "id bigint, to bigint, n bigint" if links else "doc_a bigint, doc_b bigint, jaccard double"
    return met.select("comp", "bi", "bj", "id", "copies", "grams", "partners").mapInArrow(_verified(threshold, links), schema)


def _candidates_of(docs: DataFrame, threshold: float, tolerance: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(id, same) of each document, (same, id, sig, copies) of each set, and the candidate pairs of sets."""
    sig = written(signatures(docs).dropDuplicates(["id", "same"]), "join-signatures")
    reps = sig.where("same is not null").groupBy("same").agg(F.min("id").alias("id"), F.min_by("sig", "id").alias("sig"), F.count("*").alias("copies"))
    reps = written(reps, "join-sets")
    return sig.select("id", "same"), reps, written(candidate_pairs(reps, threshold, tolerance), "join-pairs")


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """(doc_a, doc_b, jaccard), doc_a < doc_b: pairs whose sets of word n-grams have a Jaccard index of at least ``threshold``, copies collapsed.

    Documents with the same set are joined to the smallest doc_id among them, with 1.0, and only that one
    takes part in the other pairs. Documents that are null, or have no words, and rows with a null doc_id join
    nothing. A text of fewer than three words has one n-gram, all its words. doc_id is an integer and should be unique; rows
    that repeat a doc_id and its words are one document. Extra columns are ignored. An empty table gives no pairs.
    """
    members, reps, pairs = _candidates_of(docs, threshold, tolerance)
    copies = members.join(reps.where("copies > 1").select("same", F.col("id").alias("doc_a")), "same").where("id > doc_a")
    return _compared(docs, reps, pairs, threshold, False).unionByName(copies.select("doc_a", F.col("id").alias("doc_b"), F.lit(1.0).alias("jaccard")))


def linked(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """(doc_id, class_id, n_links): for each non-null doc_id the smallest one that links connect it with, and with how many others it is linked.

    A link is a pair of documents whose sets of word n-grams have a Jaccard index of at least ``threshold``, copies
    included, and every one that jaccard_join() finds counts, also those that it leaves out between copies. A document
    without any link, null and blank ones included, is a class of its own. Otherwise as jaccard_join().
    """
    members, reps, pairs = _candidates_of(docs, threshold, tolerance)
    links = written(_compared(docs, reps, pairs, threshold, True), "join-links")
    many = links.groupBy("id").agg(F.sum("n").alias("n"))
    comp = components(links.select(F.col("id").alias("a"), F.col("to").alias("b")))
    sets = reps.select("same", "id", "copies").join(many, "id", "left").join(comp, "id", "left")
    sets = sets.select("same", F.coalesce("comp", "id").alias("class_id"), (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    # an id with several texts, which should not be, is in the smallest of their classes
    return members.join(sets, "same", "left").groupBy(F.col("id").alias("doc_id")).agg(F.coalesce(F.min("class_id"), F.min("id")).alias("class_id"), F.coalesce(F.max("n_links"), F.lit(0)).cast("long").alias("n_links"))


def near_duplicates_dropped(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Keep one document, that of the smallest doc_id, of each class of linked().

    All columns pass through. Rows that join nothing, null and blank ones included, stay.
    """
    (name,) = fresh(docs, "__id")
    gone = linked(docs, threshold).where("doc_id > class_id").select(F.col("doc_id").alias(name))
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")
