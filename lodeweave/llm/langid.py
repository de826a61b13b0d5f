"""Language ID by interpolated Kneser-Ney character language models in sorted hash arrays.

A text is read as lower-case letters of any script, with everything between two runs of letters as one space. The
models, one for each language of the labelled rows, are fitted on a sample of those rows that is bounded by
``TRAIN_CHARS`` letters a language and ``MAX_LANGUAGES`` languages; the fit is a classifier's, so it is bounded, and its result
is small enough to hand to every worker whatever the corpus. Every document is then scored over its whole text, in one pass
without a shuffle.

n-grams are kept as sorted arrays of 64-bit hashes of their code points. The probabilities of each 5-gram that any model has
seen are worked out for all languages in advance, so that a symbol of text costs one search; other 5-grams back off
through the orders. The language of the lowest cross-entropy for a symbol is chosen. It is rejected if that
entropy is above a limit, calibrated on further labelled texts: halfway between theirs and that of their
letters in a random order, with an allowance for short texts. The sample consists of stretches of texts, so long
texts are in it too; a language with few of them takes the other languages' texts for the lower side of the limit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

ORDER = 5
#: Bounds of the labelled sample, for each language: characters and stretches of text to fit on, and to calibrate with.
TRAIN_CHARS, TRAIN_DOCS = 1_500_000, 4000
HELD_CHARS, HELD_DOCS = 750_000, 1500
#: Only so many languages get a model, those with the most labelled rows; a column of labels may hold rubbish.
MAX_LANGUAGES = 200
#: A stretch is at most this part of the smaller bound.
STRETCHES = 150
#: Fewest calibration texts of a language's own limit; with fewer, the others' are added. Standard deviations that a short text may be off.
LEAST, DEVIATIONS = 30, 4.0
_SPACE = 1
_CHUNK = 1 << 19
_SEP = "\ud800"
#: Powers of an odd number, by which the symbols of an n-gram are multiplied before they are added up and mixed.
_POWERS = [np.uint64(pow(0x9E6C63D0876A3F35, k, 2**64)) for k in range(ORDER)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def keys(x: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n symbols that end at each place of x, which has 64-bit symbols."""
    out = np.full(len(at), n, np.uint64)
    for lo in range(0, len(at), _CHUNK):  # in pieces, so that what is in between stays small
        part = at[lo : lo + _CHUNK]
        for k in range(n):
            out[lo : lo + _CHUNK] += x[part - k] * _POWERS[k]
        out[lo : lo + _CHUNK] = _mixed(out[lo : lo + _CHUNK])
    return out


@dataclass
class HashArray:
    """A sorted array of hashes with a value row for each, and where each leading part of a hash begins."""

    keys: np.ndarray
    values: np.ndarray
    shift: int = field(init=False)
    starts: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        order = np.argsort(self.keys)
        self.keys, self.values = self.keys[order], self.values[order]
        bits = max(1, int(len(self.keys)).bit_length())
        self.shift = 64 - bits
        self.starts = np.searchsorted(self.keys >> np.uint64(self.shift), np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Where each key is, or -1."""
        top = (keys >> np.uint64(self.shift)).astype(np.int64)
        at, end = self.starts[top], self.starts[top + 1]
        out = np.full(len(keys), -1, np.int32)
        left = np.flatnonzero(at < end)
        while len(left):
            hit = self.keys[at[left]] == keys[left]
            out[left[hit]] = at[left[hit]]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < end[left]]
        return out


def _letters() -> np.ndarray:
    """For each code point its lower-case letter, SPACE for what isn't a letter, and 0 for what is between documents."""
    out = np.full(0x110000, _SPACE, np.int32)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            out[c] = ord(x.lower()[0])
    out[ord(_SEP)] = 0
    return out


_LETTERS: list[np.ndarray] = []


def symbols(texts: list[str]) -> np.ndarray:
    """The texts' symbols, each text after ORDER - 1 zeros; runs of spaces are one, and none begins a text."""
    if not _LETTERS:
        _LETTERS.append(_letters())
    whole = "".join(_SEP * (ORDER - 1) + t for t in texts)
    parts = [_LETTERS[0][np.frombuffer(whole[k : k + 4 * _CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32)] for k in range(0, len(whole), 4 * _CHUNK)]
    s = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    drop = (s[1:] == _SPACE) & (s[:-1] <= _SPACE)
    return s[np.append(True, ~drop)] if len(s) else s


def wide(s: np.ndarray) -> np.ndarray:
    """Symbols as keys() takes them; what is between documents counts as a space."""
    return np.maximum(s, _SPACE).astype(np.uint64)


class KneserNey:
    """One language's interpolated model, of the n-grams that end at some places of x. ``base`` is the number of symbols that there may be."""

    def __init__(self, x: np.ndarray, at: np.ndarray, base: int = 256) -> None:
        self.base = base
        tables: list[tuple[np.ndarray, np.ndarray]] = []
        where = at
        for n in range(ORDER, 0, -1):
            # how often each n-gram occurs, then how many symbols each shorter one follows; and a place where it ends
            _, first, counts = np.unique(keys(x, where, n), return_index=True, return_counts=True)
            where = where[first]
            tables.append((where, counts))
        self.grams: list[HashArray] = []
        self.contexts: list[HashArray] = []
        lower, p_lower = None, np.array([1 / base])
        for n, (where, counts) in enumerate(reversed(tables), 1):
            ones, twos = int((counts == 1).sum()), int((counts == 2).sum())
            d = min(0.95, max(0.1, ones / (ones + 2 * twos) if ones + twos else 0.5))
            grams = keys(x, where, n)  # sorted, as the places are in the order of np.unique()
            context, of = np.unique(keys(x, where - 1, n - 1), return_inverse=True)
            total, kinds = np.bincount(of, counts), np.bincount(of)
            gamma = d * kinds / total
            back = p_lower[0] if lower is None else p_lower[np.searchsorted(lower, keys(x, where, n - 1))]
            p = (counts - d) / total[of] + gamma[of] * back
            self.grams.append(HashArray(grams, np.log(p)))
            self.contexts.append(HashArray(context, np.log(gamma)))
            lower, p_lower = grams, p

    def logs(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The log probability of the symbol at each place after the ORDER - 1 before it."""
        out = np.zeros(len(at))
        left = np.arange(len(at))
        for n in range(ORDER, 0, -1):
            found = self.grams[n - 1].find(keys(x, at[left], n))
            out[left[found >= 0]] += self.grams[n - 1].values[found[found >= 0]]
            left = left[found < 0]
            found = self.contexts[n - 1].find(keys(x, at[left] - 1, n - 1))
            out[left[found >= 0]] += self.contexts[n - 1].values[found[found >= 0]]
        out[left] -= np.log(self.base)
        return out


class Identifier:
    """The models of all languages, and when to reject."""

    def __init__(self, train: dict[str, list[str]], held: dict[str, list[str]]) -> None:
        self.names = sorted(train)
        letters = [np.unique(symbols(train[n])) for n in self.names]
        self.base = max(256, len(np.unique(np.concatenate(letters))) + 1 if letters else 0)
        self.models, grams = [], []
        for n in self.names:
            s = symbols(train[n])
            x = wide(s) if len(s) >= ORDER else np.full(ORDER, _SPACE, np.uint64)
            at = np.flatnonzero(s > 0).astype(np.int32) if (s > 0).any() else np.array([ORDER - 1], np.int32)
            self.models.append(KneserNey(x, at, self.base))
            # each n-gram once, with its own symbols, so that no whole sample need be kept for all languages at once
            _, first = np.unique(keys(x, at, ORDER), return_index=True)
            grams.append(x[at[first][:, None] + np.arange(1 - ORDER, 1)].reshape(-1))
        self.union = None
        if self.names:
            x = np.concatenate(grams)
            at = np.arange(ORDER - 1, len(x), ORDER)
            seen, first = np.unique(keys(x, at, ORDER), return_index=True)
            self.union = HashArray(seen, np.stack([m.logs(x, at[first]) for m in self.models], 1).astype(np.float32))
        self.limit, self.slack = np.full(len(self.names), np.inf), np.zeros(len(self.names))
        clean: list[tuple[np.ndarray, np.ndarray]] = []  # entropies by the own language, and numbers of symbols
        for k, name in enumerate(self.names):
            h, n = self.entropies(held.get(name, []))
            clean.append((h[n > 0, k], n[n > 0]))
        enough = [len(n) >= LEAST for _, n in clean]
        for k, name in enumerate(self.names):
            texts = held.get(name, [])
            if enough[k]:
                e, n = clean[k]
            else:
                texts = [*texts, *train[name][:STRETCHES]]
                others = [clean[j] for j in range(len(clean)) if j == k or enough[j] or not any(enough)]
                e, n = (np.concatenate(x) for x in zip(*others))
            rnd = np.random.RandomState(k)
            g, size = self.entropies(["".join(rnd.permutation(list(t))) for t in texts])
            g, size = g[size > 0].min(axis=1), size[size > 0]
            if not len(g):
                continue
            # halfway between nearly all texts of the language and nearly all of the same letters in a random order
            bad = np.quantile(g[size >= np.median(size)], 0.001)
            if not len(n):
                self.limit[k] = bad
                continue
            long = n >= np.median(n)
            own = e[long]
            self.limit[k] = (np.quantile(own, 0.999) + bad) / 2
            excess = np.maximum((e[~long] - own.mean()) ** 2 - own.var(), 0) * n[~long]
            self.slack[k] = DEVIATIONS * np.sqrt(excess.mean()) if len(excess) else 0.0

    def accepted(self, e: np.ndarray, n: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Entropies below the limit; the fewer symbols, the more a text may exceed it."""
        return (n > 0) & (e <= self.limit[k] + self.slack[k] / np.sqrt(np.maximum(n, 1)))

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy in nats for a symbol by each language, and the number of symbols; a final space isn't counted."""
        s = symbols(texts)
        total, n = np.zeros((len(texts), len(self.names))), np.zeros(len(texts), np.int64)
        if not len(s) or not self.names:
            return total, n
        begins = np.flatnonzero(s == 0)[:: ORDER - 1] + ORDER - 1
        ends = np.append(begins[1:] - ORDER + 1, len(s))
        last = np.zeros(len(s), bool)
        last[ends[ends > begins] - 1] = True
        scored = (s > 0) & ~(last & (s == _SPACE))
        for lo in range(ORDER - 1, len(s), _CHUNK):
            hi = min(lo + _CHUNK, len(s))
            where = np.flatnonzero(scored[lo:hi])
            if not len(where):
                continue
            x, places = wide(s[lo - ORDER + 1 : hi]), where + ORDER - 1
            own = keys(x, places, ORDER)
            at = self.union.find(own)
            logs = self.union.values[at].astype(np.float64)
            if (new := at < 0).any():
                _, first, which = np.unique(own[new], return_index=True, return_inverse=True)
                unseen = places[new][first]
                logs[new] = np.stack([m.logs(x, unseen) for m in self.models], 1)[which]
            doc = np.searchsorted(begins, where + lo, side="right") - 1
            first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
            total[doc[first]] += np.add.reduceat(logs, first, axis=0)
            n[doc[first]] += np.diff(np.append(first, len(doc)))
        return -total / np.maximum(n, 1)[:, None], n

    def choose(self, texts: list[str]) -> tuple[list[str | None], list[float | None], list[bool]]:
        """Language, entropy and whether it is accepted; a text without letters has no language."""
        if not self.names:
            return [None] * len(texts), [None] * len(texts), [False] * len(texts)
        h, n = self.entropies(texts)
        best = h.argmin(axis=1)  # of equals the first by name
        e = h[np.arange(len(h)), best]
        ok = self.accepted(e, n, best)
        return [self.names[b] if x else None for b, x in zip(best, n > 0)], [float(x) if y else None for x, y in zip(e, n > 0)], ok.tolist()


def fit(docs: DataFrame, train_chars: int = TRAIN_CHARS, held_chars: int = HELD_CHARS) -> Identifier:
    """Fit on the labelled rows, those with a lang, in the order of a hash of doc_id: first the training sample, then the calibration sample.

    Texts are cut into stretches; the sample takes one of each text, then another of each, until its bounds. Totals by
    language tell what part of its rows, by a hash, holds twice what is needed; only those are sorted, so a language
    of most rows of a corpus isn't shuffled. Beyond ``MAX_LANGUAGES`` values of lang, the rarest get no model.
    """
    most = train_chars + held_chars
    size = max(1, min(train_chars, held_chars) // STRETCHES)
    rows = docs.where("lang is not null and text is not null and doc_id is not null").select("lang", "doc_id", F.length("text").alias("len"), F.xxhash64(F.lit(11), "doc_id").alias("h"))
    totals = rows.groupBy("lang").agg(F.count("*").alias("many"), F.sum(F.least(F.lit(size), "len")).alias("chars")).orderBy(F.desc("many"), "lang").limit(MAX_LANGUAGES)
    need = F.least(F.lit(float(TRAIN_DOCS + HELD_DOCS)) / F.col("many"), F.lit(float(most)) / F.greatest(F.col("chars"), F.lit(1)))
    # at most MAX_LANGUAGES rows, so they may be broadcast whatever the input
    rows = rows.join(F.broadcast(totals.select("lang", F.least(F.lit(1.0), need * 2).alias("part"))), "lang")
    rows = rows.where(F.pmod(F.xxhash64(F.lit(12), "doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40)) <= F.col("part"))
    rows = rows.withColumn("of", F.greatest(F.lit(1), F.ceil(F.col("len") / size)).cast("long"))
    # more stretches of one text than the whole sample has are of no use
    rows = rows.withColumn("round", F.explode(F.sequence(F.lit(0), F.least(F.col("of"), F.lit(TRAIN_DOCS + HELD_DOCS)).cast("int") - 1)))
    rows = rows.withColumn("start", F.pmod(F.col("h") + F.col("round"), F.col("of")) * size).withColumn("n", F.least(F.lit(size), F.col("len") - F.col("start")))
    order = W.partitionBy("lang").orderBy("round", "h", "doc_id", "len")
    some = rows.withColumn("k", F.row_number().over(order)).where(F.col("k") <= TRAIN_DOCS + HELD_DOCS)
    some = some.withColumn("sum", F.sum("n").over(order.rowsBetween(W.unboundedPreceding, 0))).where(F.col("sum") <= most)
    some = some.select(F.col("doc_id").alias("__id"), F.col("lang").alias("__lang"), F.col("len").alias("__len"), "h", "start").distinct()
    # at most TRAIN_DOCS + HELD_DOCS rows a language, so it may be broadcast whatever the input
    got = docs.select("doc_id", "lang", "text").join(F.broadcast(some), (F.col("doc_id") == F.col("__id")) & (F.col("lang") == F.col("__lang")) & (F.length("text") == F.col("__len")))
    got = got.select("h", "doc_id", "lang", "start", F.substr("text", (F.col("start") + 1).cast("int"), F.lit(size)).alias("part"))
    train: dict[str, list[str]] = {}
    held: dict[str, list[str]] = {}
    # by document, so that hardly one is in both samples
    rows = sorted((r.h, r.doc_id, r.start, r.lang, r.part) for r in got.toLocalIterator() if r.part is not None)
    sizes: dict[str, int] = {}
    for *_, name, text in rows:
        sizes[name] = sizes.get(name, 0) + len(text)
    had = dict.fromkeys(sizes, 0)
    rows.reverse()
    while rows:
        *_, name, text = rows.pop()
        # a language with less than the bounds is shared out in the same proportion
        had[name] += len(text)
        (train if name not in train or had[name] <= sizes[name] * train_chars / most else held).setdefault(name, []).append(text)
    return Identifier({n: train.get(n, []) for n in sizes}, held)


def _scored(model: Identifier, column: int, names: list[str]):
    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(column)
            out: tuple[list, list, list] = ([], [], [])
            held: list[str] = []
            size = 0

            def flush() -> None:
                nonlocal size
                for have, new in zip(out, model.choose(held)):
                    have.extend(new)
                held.clear()
                size = 0

            for t in texts:
                held.append(t.as_py() or "")
                size += len(held[-1])
                if size >= _CHUNK:
                    flush()
            if held:
                flush()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out[0], pa.string()), pa.array(out[1], pa.float64()), pa.array(out[2], pa.bool_())], names=names)

    return f


def identify(docs: DataFrame, model: Identifier | None = None) -> DataFrame:
    """Adds lang_id, lang_entropy (nats for a symbol) and lang_ok, false for what is rejected.

    A null text and one without letters have no language and are rejected. Where two languages are equal, the
    first by name is taken. Without a ``model``, one is fitted on the rows of ``docs`` that have a lang; if there
    are none, nothing has a language. Very long texts are scored whole, a piece at a time. doc_id may be of any type that
    can be hashed. Input columns of the added names are replaced; all others pass through.
    Rows aren't joined or compared when scored, so repeated rows each get the same. An empty table gives an empty table.
    """
    own = ["lang_id", "lang_entropy", "lang_ok"]
    docs = docs.drop(*own)
    model = model or fit(docs)
    schema = T.StructType([*docs.schema.fields, T.StructField(own[0], T.StringType()), T.StructField(own[1], T.DoubleType()), T.StructField(own[2], T.BooleanType())])
    return docs.mapInArrow(_scored(model, docs.columns.index("text"), [*docs.columns, *own]), schema)


def known_languages(docs: DataFrame) -> DataFrame:
    """The documents that aren't rejected, with all their columns."""
    return identify(docs).where("lang_ok").select(*docs.columns)
