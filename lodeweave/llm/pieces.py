"""SentencePiece encoding and decoding with a merge-type model, by a table of prefixes' last tokens.

Greedy merging has two properties. Each prefix of a text has one last token in its own encoding, and a sequence
of tokens is an encoding if and only if each neighbouring pair is the encoding of its own text. So a pass over
the automaton's matches finds, for each prefix, the one token that ends it and is compatible with the last token
of the prefix before it; the ids are then recovered from the end backwards. Cost is linear in the text, however
long a run without white space is.

A text is cut wherever no piece of the vocabulary holds the two characters next to each other, so cuts change
nothing; encodings of the parts are remembered in a cache of bounded size.
"""

from __future__ import annotations

import math
import re
import struct
from array import array
from collections.abc import Iterator
from itertools import chain, islice, pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SPACE = "▁"
#: Entries of each of the two generations of remembered parts, and of remembered pairs.
CACHE = 200_000
_SLICE = 128
#: Marks a part without white space before it; no text can hold it.
_BARE = "\ud800"


def _varint(b: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        x = b[i]
        i += 1
        value |= (x & 127) << shift
        shift += 7
        if x < 128:
            return value, i


def _fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message."""
    i = 0
    while i < len(b):
        tag, i = _varint(b, i)
        kind = tag & 7
        if kind == 0:
            value, i = _varint(b, i)
        elif kind == 2:
            size, i = _varint(b, i)
            value, i = b[i : i + size], i + size
        else:
            size = 8 if kind == 1 else 4
            value, i = b[i : i + size], i + size
        yield tag >> 3, value


class PieceModel:
    """A merge-type model with byte fallback and without normalisation, as read from a model file.

    Other kinds of models (unigram, without byte fallback, with user-defined or unused pieces, with a character
    map) raise ValueError.
    """

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            raw = f.read()
        self.text: list[str] = []
        self.score: list[float] = []
        self.kind: list[int] = []
        trainer, rules = {}, {}
        for n, value in _fields(raw):
            if n == 1:
                piece = dict(_fields(value))
                self.text.append(piece[1].decode())
                self.score.append(struct.unpack("<f", piece.get(2, bytes(4)))[0])
                self.kind.append(piece.get(3, 1))
            elif n == 2:
                trainer = dict(_fields(value))
            elif n == 3:
                rules = dict(_fields(value))
        if trainer.get(3) != 2 or not trainer.get(35) or rules.get(2) or {4, 5} & set(self.kind) or trainer.get(24):
            raise ValueError(f"{path}: not a merge-type model with byte fallback and no character map")
        self.dummy, self.trim = bool(rules.get(3, 1)), bool(rules.get(4, 1))
        self.ids = {t: i for i, t in enumerate(self.text) if self.kind[i] == 1}
        self.bytes = [0] * 256
        for i, t in enumerate(self.text):
            if self.kind[i] == 6:
                self.bytes[int(t[3:5], 16)] = i
        self.rank = {t: -self.score[i] for t, i in self.ids.items()}
        self.automaton = ahocorasick.Automaton()
        for t in self.ids:
            self.automaton.add_word(t, (t, len(t)))
        self.automaton.make_automaton()
        joined = {t[k : k + 2] for t in self.ids for k in range(len(t) - 1)}
        self.joined = joined
        inner = {c for two in joined for c in two}
        # a character that no piece has beside another is a part of its own; white space starts a part, unless a piece has it inside
        self.inside = any(SPACE in t.lstrip(SPACE) for t in self.ids)
        lone = "".join(sorted({c for c in map(chr, range(128)) if c not in inner and c != " "} | {c for c in self.ids if len(c) == 1 and c not in inner and c != SPACE}))
        lone = re.escape(lone) if lone else ""
        self.parts = None if self.inside else re.compile(f"{SPACE}+[^{SPACE}{lone}]*|[^{SPACE}{lone}]+" + (f"|[{lone}]" if lone else ""))
        self.plain = self.parts is not None and "\n" not in inner
        self.alone: dict[str, bool] = {}
        self.made: dict[str, list[tuple[float, str, str]] | None] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merges(self, text: str) -> list[tuple[float, str, str]] | None:
        """The definition: merge the best neighbouring pair, the leftmost of equals, until none is a piece.

        Each merge's rank, and the first and last symbol before it; at last those of the whole, with an infinite
        rank. None for a text that doesn't end as one token.
        """
        parts, rank, out = list(text), self.rank, []
        while len(parts) > 1:
            best, at = None, -1
            for i, (a, b) in enumerate(pairwise(parts)):
                r = rank.get(a + b)
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                return None
            out.append((best, parts[0], parts[-1]))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [*out, (math.inf, text, text)]

    def history(self, t: str) -> list[tuple[float, str, str]] | None:
        """merges(), remembered for pieces."""
        known = self.made.get(t, 0)
        if known == 0:
            known = self.merges(t)
            if t in self.ids:
                self.made[t] = known
        return known

    def compatible(self, a: str, b: str) -> bool:
        """Whether a, b is the encoding of their text; remembered.

        Until a pair across the two is the best one, each side merges as it does alone.
        """
        left, right = self.history(a), self.history(b)
        ok = left is not None and right is not None
        i = j = 0
        while ok:
            (x, _, last), (y, first, _) = left[i], right[j]
            r = self.rank.get(last + first)
            if r is not None and r < x and r <= y:
                ok = False
            elif x == y == math.inf:
                break
            elif x <= y:
                i += 1
            else:
                j += 1
        if len(self.pairs) >= CACHE:
            self.pairs.clear()
        self.pairs[a, b] = ok
        return ok

    def tokens(self, text: str) -> list[str]:
        """The tokens of a part, by the table of last tokens; a character that is no piece is a token of its own."""
        last: list[str | None] = [None] * (len(text) + 1)
        pairs, alone = self.pairs, self.alone  # compatible() empties pairs, it doesn't replace it
        for end, (t, size) in self.automaton.iter(text):  # of those that end at one place, the longest first
            if last[end + 1] is not None:
                continue
            before = end + 1 - size
            if before:
                prior = last[before]
                if prior is None:
                    prior = last[before] = text[before - 1]
                ok = pairs.get((prior, t))
                if ok is None:
                    ok = self.compatible(prior, t)
            else:
                ok = alone.get(t)
                if ok is None:
                    ok = alone[t] = self.history(t) is not None
            if ok:
                last[end + 1] = t
        out, at = [], len(text)
        while at:
            t = last[at] or text[at - 1]
            out.append(t)
            at -= len(t)
        return out[::-1]

    def _part(self, text: str) -> bytes:
        ids: list[int] = []
        cut, pieces = 0, []
        if len(text) > 64:
            for k, two in enumerate(map("".join, pairwise(text)), 1):
                if two not in self.joined:
                    pieces.append(text[cut:k])
                    cut = k
        pieces.append(text[cut:])
        for piece in pieces:
            for t in self.tokens(piece):
                i = self.ids.get(t)
                if i is None:
                    ids.extend(self.bytes[x] for x in t.encode())
                else:
                    ids.append(i)
        return array("i", ids).tobytes()

    def encoded(self, text: str) -> bytes:
        """The ids of a text as little-endian 32-bit integers."""
        if self.trim:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return b""
        if self.dummy:
            text = " " + text
        if self.plain and text[0] == " " and "  " not in text and SPACE not in text:
            # each item begins a part: with white space, which is left off, or with a line's end
            items = text.replace("\n", " \n").split(" ")
            items.pop(0)
        else:
            text = text.replace(" ", SPACE)
            items = [x if x[0] == SPACE else _BARE + x for x in (self.parts.findall(text) if self.parts else [text])]
        found: list[bytes | None] = list(map(self.young.get, items))
        if None in found:
            young, old = self.young, self.old
            for k, ids in enumerate(found):
                if ids is None:
                    item = items[k]
                    ids = young.get(item) or old.get(item)
                    if ids is None:
                        own = item[1:] if item[:1] == _BARE else item if item[:1] in ("\n", SPACE) else SPACE + item
                        ids = b"".join(map(self._part, self.parts.findall(own))) if self.parts else self._part(own)
                    if len(item) <= 64:
                        if len(young) >= CACHE:
                            self.old = old = young
                            self.young = young = {}
                        young[item] = ids
                    found[k] = ids
        return b"".join(found)

    def trim_caches(self) -> None:
        """Keep one generation of what is remembered, the parts that came first, as frequent ones do; a worker lives on, maybe for other stages."""
        self.young, self.old = dict(islice(chain(self.young.items(), self.old.items()), CACHE)), {}
        pa.default_memory_pool().release_unused()

    def decoded(self, ids: list[int]) -> str:
        """The text of ids: pieces, runs of byte pieces as UTF-8 (U+FFFD for what is none), white space, the dummy prefix off."""
        text, kind = self.text, self.kind
        out: list[str] = []
        run = bytearray()
        for i in ids:
            k = kind[i]
            if k == 6:
                run.append(int(text[i][3:5], 16))
                continue
            if run:
                out.append(run.decode(errors="replace"))
                run = bytearray()
            if k == 1:
                out.append(text[i])
            elif k == 2:
                out.append(" ⁇ ")
        if run:
            out.append(run.decode(errors="replace"))
        whole = "".join(out).replace(SPACE, " ")
        return whole[1:] if self.dummy and whole.startswith(" ") else whole


_LOADED: dict[str, PieceModel] = {}


def load(path: str) -> PieceModel:
    """The model of a file; once in each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = PieceModel(path)
    return _LOADED[path]


def _coded(path: str, column: int, names: list[str]):
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from f(batches)
        finally:
            load(path).trim_caches()

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        before, own, same = None, b"", None
        for batch in batches:
            for k in range(0, batch.num_rows, _SLICE):
                part = batch.slice(k, _SLICE)
                ids, ends, missing, back = [], [0], [], []
                for text in part.column(column):
                    text = text.as_py()
                    missing.append(text is None)
                    if text is None:
                        ids.append(b"")
                        ends.append(ends[-1])
                        back.append(None)
                        continue
                    if text != before:  # a mixture has a document's copies one after another
                        own = model.encoded(text)
                        before, same = text, model.decoded(np.frombuffer(own, np.int32).tolist()) == text
                    ids.append(own)
                    ends.append(ends[-1] + len(own) // 4)
                    back.append(same)
                values = pa.array(np.frombuffer(b"".join(ids), np.int32))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=pa.array(missing))
                n = pa.array([None if m else b - a for m, a, b in zip(missing, ends, ends[1:])], pa.int32())
                yield pa.RecordBatch.from_arrays([*part.columns, lists, n, pa.array(back, pa.bool_())], names=names)

    return whole


def encode(docs: DataFrame, model_file: str) -> DataFrame:
    """Adds token_ids, n_tokens and round_trip, whether decoding the ids gives the text again.

    A null text has nulls, an empty one no tokens. Texts of any length are encoded whole, in linear time.
    round_trip is false where the model itself loses something: a text that holds U+2581, which decodes to a
    space. Input columns of the added names are replaced; all others pass through; rows aren't joined or
    compared, so repeated rows each get theirs. An empty table gives an empty table.
    """
    own = ["token_ids", "n_tokens", "round_trip"]
    docs = docs.drop(*own)
    schema = T.StructType([*docs.schema.fields, T.StructField(own[0], T.ArrayType(T.IntegerType())), T.StructField(own[1], T.IntegerType()), T.StructField(own[2], T.BooleanType())])
    return docs.mapInArrow(_coded(model_file, docs.columns.index("text"), [*docs.columns, *own]), schema)


def _read(path: str):
    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            for k in range(0, batch.num_rows, _SLICE):
                part = batch.slice(k, _SLICE)
                texts = [None if x is None else model.decoded([i for i in x if i is not None and 0 <= i < len(model.text)]) for x in part.column(part.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "decoded"])

    return f


def decode(rows: DataFrame, model_file: str, ids: str = "token_ids") -> DataFrame:
    """Adds decoded, the text of the ids. Null for null; ids that are null or outside the vocabulary are left out."""
    rows = rows.drop("decoded")
    rows = rows.select(*[c for c in rows.columns if c != ids], ids)
    return rows.mapInArrow(_read(model_file), T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())]))
