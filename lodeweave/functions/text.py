"""Text normalisation, counts and predicates as column expressions.

Everything runs in the JVM but Unicode composition and HTML entities, for which Spark has no builtin: these are an
Arrow function, which only gets the texts that they may change. Word characters are spelled out
as letters, digits and underscore, since Java's own class differs from the usual Unicode one in its marks.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable
from html.entities import html5

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"[\p{L}\p{N}_]"
JAPANESE = r"[぀-ヿ㐀-鿿]"
_BOUNDARY = rf"(?:(?<!{WORD})(?={WORD})|(?<={WORD})(?!{WORD}))"
CONTROL = r"[\x{0}-\x{8}\x{b}\x{c}\x{e}-\x{1f}\x{7f}\x{200b}-\x{200f}\x{feff}]"
URL = r"(?iU)https?://|www\."
EMAIL = rf"(?iU){_BOUNDARY}[\p{{L}}\p{{N}}_.+-]+@[\p{{L}}\p{{N}}_.-]+\.[A-Za-z]{{2,}}{_BOUNDARY}"
MARKUP = r"(?iU)<[^>]+>|&(?:" + "|".join(sorted(("amp", "apos", "gt", "lt", "nbsp", "quot"))) + ");"
CUES = ("applause", "gasps?", "laughs", "laughter", "music", "noise", "sighs?", "silence", "ため息", "音楽", "拍手", "歓声", "笑い", "雑音")
CUE = r"(?iU)^\s*[\[(（【]?\s*(?:" + "|".join(CUES) + r")\s*[\])）】]?\s*[.!。…-]*\s*\z"
CONTENT = r"[A-Za-z぀-ヿ㐀-鿿]"
LATIN_WORD = r"[A-Za-z]+(?:['’-][A-Za-z]+)?"
_SPOKEN = r"[\s、。！？!?,.・「」『』（）()\[\]【】〈〉《》…―:：;；'\"“”‘’]"


#: Characters that NFKC leaves as they are, whatever is beside them, but the ampersand: ASCII, most of Latin, Greek, Cyrillic, kana, Chinese, Hangul, some punctuation.
STABLE = r"\x00-%'-\x7f¡-§©«-®°±¶·»¿-ıĴ-ľŁ-ňŊ-žΆΈ-ΊΌΎ-ΡΣ-ώЀ-҂Ҋ-ԯ–—‘-•€、。々「-』ぁ-ゖァ-ヺー㐀-䶿一-鿿가-힣"
_UNSTABLE = rf"[^\x00-%'-\x7f](?<![{STABLE}])"  # the large class, which is slow, only after what isn't ASCII
#: Characters that the Arrow function has as Python strings at a time, or one text if that is longer.
PIECE = 1 << 20


def _composed(text: str) -> str:
    return unicodedata.normalize("NFKC", html.unescape(text))


def _terminated(text: str) -> str:
    return unicodedata.normalize("NFKC", _ENTITY.sub(lambda m: html.unescape(m[0]) if m[1] or m[0][1:] in html5 else m[0], text))


_ENTITY = re.compile(r"&(#)?[0-9A-Za-z]+;")


def _in_pieces(f: Callable[[str], str], text: pa.Array) -> pa.Array:
    """f of each text. Only a piece of the batch is there as Python strings at a time, so memory is that of the batch and its result."""
    ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())).to_numpy(zero_copy_only=False)
    out, start = [], 0
    while start < len(text):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + PIECE, "right")))
        out.append(pa.array([None if t is None else f(t) for t in text.slice(start, stop - start).to_pylist()], pa.string()))
        start = stop
    return pa.concat_arrays(out) if out else pa.array([], pa.string())


def _arrow(f: Callable[[str], str]) -> Callable[[Column], Column]:
    def batch(text: pa.Array) -> pa.Array:
        return text if text.null_count == len(text) else _in_pieces(f, text.combine_chunks() if isinstance(text, pa.ChunkedArray) else text)

    return F.arrow_udf(batch, T.StringType()).asNondeterministic()


_ONCE, _ONCE_TERMINATED = _arrow(_composed), _arrow(_terminated)


def composed(text: Column, terminated: bool = False) -> Column:
    """HTML entities decoded once, then NFKC; null for null. With ``terminated``, only entities that end in a semicolon.

    It counts as non-deterministic, so that the optimiser neither copies it into each expression that uses its result nor
    moves a filter on such an expression below it. Texts of stable characters alone stay in the JVM.
    """
    once = _ONCE_TERMINATED if terminated else _ONCE
    return F.coalesce(once(F.when(F.rlike(text, F.lit(_UNSTABLE)), text)), text)


def without_controls(text: Column) -> Column:
    """Control characters other than white space, and zero-width ones, deleted."""
    return F.regexp_replace(text, CONTROL, "")


def collapsed(text: Column) -> Column:
    """Runs of Unicode white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def normalized(text: Column, terminated: bool = False) -> Column:
    """Entities (with ``terminated`` only those that end in a semicolon), NFKC, controls, white space. Null for null, empty for what holds nothing else."""
    return collapsed(without_controls(composed(text, terminated)))


def normalized_plain(text: Column) -> Column:
    """The part of ``normalized`` that needs no Python: for texts without entities and in composed form."""
    return collapsed(without_controls(text))


def script_units(text: Column) -> Column:
    """Word characters and Japanese letters."""
    return F.length(F.regexp_replace(text, r"[^\p{L}\p{N}_぀-ヿ㐀-鿿]+", ""))


def latin_words(text: Column) -> Column:
    """Latin words; a compound with an apostrophe or hyphen counts once."""
    return F.regexp_count(text, F.lit(LATIN_WORD))


def japanese_letters(text: Column) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, JAPANESE, ""))


def ascii_letters(text: Column) -> Column:
    return F.length(F.regexp_replace(text, "[^A-Za-z]", ""))


def letters(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^\p{L}]", ""))


def has_link(text: Column) -> Column:
    """A web or mail address; the costly pattern only runs where there is an @."""
    return F.rlike(text, F.lit(URL)) | (F.contains(text, F.lit("@")) & F.rlike(text, F.lit(EMAIL)))


def has_markup(text: Column) -> Column:
    return (F.contains(text, F.lit("<")) | F.contains(text, F.lit("&"))) & F.rlike(text, F.lit(MARKUP))


def is_cue(text: Column) -> Column:
    """Nothing but a sound cue of a subtitle."""
    return F.rlike(text, F.lit(CUE))


def has_content(text: Column) -> Column:
    return F.rlike(text, F.lit(CONTENT))


def english_plain(text: Column) -> Column:
    """Normalised, lower case, marks other than the apostrophe as spaces."""
    return collapsed(F.regexp_replace(F.lower(normalized(text)), rf"[^\p{{L}}\p{{N}}_\s']", " "))


def english_spoken(text: Column, tokenizer: object | None = None) -> Column:
    """English for comparison with a transcript, by the tokenizer's ``normalize`` or ``_normalize`` if it has one."""
    own = next((f for f in (getattr(tokenizer, n, None) for n in ("normalize", "_normalize")) if callable(f)), None)
    if own is None:
        return english_plain(text)

    @F.pandas_udf(T.StringType())
    def spoken(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else own(t))

    return collapsed(spoken(text))


def japanese_reading(text: Column, reader: Callable[..., str]) -> Column:
    """The reading of a Japanese text by ``reader(text, kana=True)``, composed, without white space and punctuation."""

    @F.pandas_udf(T.StringType())
    def read(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else unicodedata.normalize("NFKC", reader(t, kana=True)))

    return F.regexp_replace(read(normalized(text)), "(?U)" + _SPOKEN, "")
