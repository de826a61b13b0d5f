"""Token counts: lengths of byte-level BPE encodings, from batches that are balanced by bytes.

An Arrow function hands the library batches of about ``BATCH_BYTES`` of text and returns lengths only; ids never
leave the worker. A text longer than ``SPLIT_BYTES`` is cut, at places where its count is the sum of its parts'
counts, so that one long document neither makes a batch of its own size nor slows down the library, whose cost
for a stretch without word boundaries grows faster than its length.

The tokenizer first cuts a text into words by a pattern. No alternative of that pattern has white space after
anything else, nor a letter before a mark other than an apostrophe, so a word always ends where white space
follows something else and where a mark follows a letter: these are the safe places. The tests check that on
random texts.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BATCH_BYTES = 1 << 20
SPLIT_BYTES = 1 << 16
#: The word pattern of the published vocabularies; the safe places hold for it.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
_SAFE = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\s\p{L}\p{N}'])")
_LOADED: dict[str, tiktoken.Encoding] = {}


def encoding(ranks_file: str) -> tiktoken.Encoding:
    """The encoding of a file of base64 tokens and ranks; once in each Python worker."""
    if ranks_file not in _LOADED:
        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _LOADED[ranks_file] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[ranks_file]


def safe_parts(text: str, most: int = SPLIT_BYTES) -> list[tuple[str, int]]:
    """Parts of about ``most`` bytes in UTF-8, each longer only as far as no safe place follows, and their bytes."""
    out, at = [], 0
    while (len(text) - at) * 4 > most:
        piece = text[at : at + most].encode("utf-8", "surrogatepass")
        if len(piece) <= most and at + most >= len(text):
            break
        here = at + len(piece[:most].decode("utf-8", "ignore")) if len(piece) > most else at + most
        cut = _SAFE.search(text, max(here, at + 1))
        if cut is None:
            break
        out.append(text[at : cut.start()])
        at = cut.start()
    out.append(text[at:])
    return [(x, len(x.encode("utf-8", "surrogatepass"))) for x in out]


def _counted(ranks_file: str, column: int, names: list[str], batch_bytes: int, split_bytes: int):
    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoding(ranks_file)
        for batch in batches:
            texts = batch.column(column)
            counts = np.zeros(batch.num_rows, np.int64)
            parts: list[str] = []
            rows: list[int] = []
            size = 0

            def flush() -> None:
                nonlocal size
                np.add.at(counts, rows, [len(x) for x in own.encode_ordinary_batch(parts, num_threads=1)] if len(parts) > 1 else [len(own.encode_ordinary(x)) for x in parts])
                parts.clear()
                rows.clear()
                size = 0

            for i, text in enumerate(texts):
                text = text.as_py()
                for part, n in safe_parts(text, split_bytes) if text else ():
                    parts.append(part)
                    rows.append(i)
                    size += n
                    if size >= batch_bytes:
                        flush()
            if parts:
                flush()
            yield pa.RecordBatch.from_arrays([*[c for k, c in enumerate(batch.columns) if k != column], pa.array(counts, mask=texts.is_null().to_numpy(zero_copy_only=False))], names=names)

    return f


def token_counts(docs: DataFrame, ranks_file: str, batch_bytes: int = BATCH_BYTES, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The columns of ``docs`` without ``text``, and n_tokens, the number of tokens of the whole text.

    A null text has a null count, an empty one 0. Strings that look like special tokens are ordinary text. An
    input column n_tokens is replaced; a very long text is counted in parts, but a stretch without a safe place, such as
    a single word, goes to the library whole, whatever its length; other columns pass through. Rows aren't joined or compared, so repeated
    rows each get their count. An empty table gives an empty table.
    """
    docs = docs.drop("n_tokens")
    rest = [f for f in docs.schema.fields if f.name != "text"]
    names = [*[f.name for f in rest], "n_tokens"]
    return docs.mapInArrow(_counted(ranks_file, docs.columns.index("text"), names, batch_bytes, split_bytes), T.StructType([*rest, T.StructField("n_tokens", T.LongType())]))
