"""Media columns: PNG images in binary columns, decoded with zlib and numpy, and their low-frequency cosine-transform hashes.

A decoder walks the chunks, tests each one's CRC-32, inflates the image data and undoes the row filters. Images of
one shape in a batch are unfiltered together, along anti-diagonals: a pixel depends on those to its left, above and
upper left, so all pixels of a diagonal, in all images, are one numpy operation, whatever the filter types.

The hash is of 64 bits: the image in grey, averaged to 32 x 32, the 8 x 8 lowest frequencies of its cosine transform,
each compared with their median. Images that look alike have hashes that differ in few bits.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SIDE, KEPT = 32, 8
#: Pixel values that are unfiltered together.
_TOGETHER = 1 << 22
#: What a byte can be inflated to.
_INFLATED = 1032
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
_DEPTHS = {0: (1, 2, 4, 8, 16), 2: (8, 16), 3: (1, 2, 4, 8), 4: (8, 16), 6: (8, 16)}
#: x and y of the first pixel, and the steps, of each pass of an interlaced image.
_PASSES = ((0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2))


class Damaged(ValueError):
    """What is wrong with an image."""


def chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def chunks(png: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(type, data) of each chunk up to IEND, with checked CRCs."""
    if png[:8] != _SIGNATURE:
        raise Damaged("no PNG signature")
    at = 8
    while True:
        if at + 12 > len(png):
            raise Damaged("ends before IEND")
        (n,) = struct.unpack_from(">I", png, at)
        kind, data = png[at + 4 : at + 8], png[at + 8 : at + 8 + n]
        if at + 12 + n > len(png):
            raise Damaged("chunk is longer than the file")
        if zlib.crc32(kind + data) != struct.unpack_from(">I", png, at + 8 + n)[0]:
            raise Damaged(f"wrong checksum of {kind.decode('latin-1')}")
        yield kind, data
        if kind == b"IEND":
            return
        at += 12 + n


class Raw:
    """An image's header and inflated rows."""

    def __init__(self, png: bytes) -> None:
        head, self.palette, self.data = None, None, b""
        parts = []
        for kind, data in chunks(png):
            if head is None and kind != b"IHDR":
                raise Damaged("IHDR isn't first")
            if kind == b"IHDR":
                if len(data) != 13:
                    raise Damaged("wrong IHDR")
                head = struct.unpack(">IIBBBBB", data)
            elif kind == b"PLTE":
                if len(data) % 3 or not data:
                    raise Damaged("wrong PLTE")
                self.palette = np.frombuffer(data, np.uint8).reshape(-1, 3)
            elif kind == b"IDAT":
                parts.append(data)
            elif not kind[0] & 32 and kind != b"IEND":
                raise Damaged("unknown critical chunk")
        self.width, self.height, self.depth, self.color, packing, filtering, self.interlaced = head
        if not self.width or not self.height or self.depth not in _DEPTHS.get(self.color, ()) or packing or filtering or self.interlaced > 1:
            raise Damaged("header isn't of a valid image")
        if self.color == 3 and self.palette is None:
            raise Damaged("no PLTE")
        self.channels = _CHANNELS[self.color]
        self.step = max(1, self.channels * self.depth // 8)
        self.passes = []
        for x, y, dx, dy in _PASSES if self.interlaced else ((0, 0, 1, 1),):
            w, h = -(-(self.width - x) // dx), -(-(self.height - y) // dy)
            if w > 0 and h > 0:
                self.passes.append((x, y, dx, dy, w, h, -(-w * self.channels * self.depth // 8)))
        size = sum(h * (1 + row) for *_, h, row in self.passes)
        # deflate makes at most 1,032 bytes of one, so a header that claims more is false, whatever memory there is
        if max(self.width, self.height) >= 1 << 31 or size > _INFLATED * sum(map(len, parts)):
            raise Damaged("header claims more than the image data can hold")
        d = zlib.decompressobj()
        try:
            self.data = d.decompress(b"".join(parts), size + 1)
        except zlib.error as e:
            raise Damaged(str(e)[:80]) from e
        if len(self.data) != size:
            raise Damaged("wrong amount of image data")

    def filtered(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Filter types and filtered bytes, (rows, bytes), of each pass."""
        at = 0
        for *_, h, row in self.passes:
            part = np.frombuffer(self.data, np.uint8, h * (1 + row), at).reshape(h, 1 + row)
            at += part.size
            if part[:, 0].max() > 4:
                raise Damaged("unknown filter")
            yield part[:, 0], part[:, 1:]

    def pixels(self, rows: list[np.ndarray]) -> np.ndarray:
        """(height, width, channels) of unfiltered passes; depths under 8 scaled to 8 bits, 16 cut to 8, palettes looked up."""
        out = np.zeros((self.height, self.width, self.channels), np.uint8)
        for (x, y, dx, dy, w, h, _), data in zip(self.passes, rows):
            if self.depth == 16:
                v = data[:, ::2]
            elif self.depth == 8:
                v = data
            else:
                bits = np.unpackbits(data, axis=1).reshape(h, -1, self.depth)
                v = (bits << np.arange(self.depth - 1, -1, -1, dtype=np.uint8)).sum(axis=2).astype(np.uint8)[:, : w * self.channels]
                if self.color != 3:
                    v = v * np.uint8(255 // (2**self.depth - 1))
            out[y::dy, x::dx] = v.reshape(h, w, self.channels)
        if self.color == 3:
            if int(out.max()) >= len(self.palette):
                raise Damaged("index outside the palette")
            return self.palette[out[:, :, 0]]
        return out


def unfiltered(kinds: np.ndarray, data: np.ndarray, step: int) -> np.ndarray:
    """Undo the filters of images of one shape: kinds (n, h), data (n, h, bytes)."""
    n, h, row = data.shape
    if not kinds.any():
        return data
    w = row // step
    out = np.zeros((n, h + 1, w + 1, step), np.int16)
    x = data.reshape(n, h, w, step).astype(np.int16)
    k = kinds[:, :, None]
    for t in range(h + w - 1):
        r = np.arange(max(0, t - w + 1), min(h, t + 1))
        c = t - r
        a, b, d = out[:, r + 1, c], out[:, r, c + 1], out[:, r, c]
        f = k[:, r]
        pa_, pb, pc = np.abs(b - d), np.abs(a - d), np.abs(a + b - 2 * d)
        paeth = np.where((pa_ <= pb) & (pa_ <= pc), a, np.where(pb <= pc, b, d))
        guess = np.where(f == 1, a, np.where(f == 2, b, np.where(f == 3, (a + b) >> 1, np.where(f == 4, paeth, 0))))
        out[:, r + 1, c + 1] = (x[:, r, c] + guess) & 255
    return out[:, 1:, 1:].reshape(n, h, row).astype(np.uint8)


def decode(pngs: list[bytes | None]) -> list[np.ndarray | str | None]:
    """Pixels of each image, what is wrong with it, or None for None."""
    out: list[np.ndarray | str | None] = [None] * len(pngs)
    raws: dict[int, Raw] = {}
    rows: dict[int, list[np.ndarray]] = {}
    shapes: dict[tuple, list[tuple[int, int, np.ndarray, np.ndarray]]] = {}
    for i, png in enumerate(pngs):
        if png is None:
            continue
        try:
            raws[i] = raw = Raw(png)
            found = list(raw.filtered())
        except (Damaged, MemoryError, OverflowError) as e:
            out[i] = str(e) or "too large for this machine's memory"
            raws.pop(i, None)
            continue
        rows[i] = [None] * len(found)
        for k, (kinds, data) in enumerate(found):
            shapes.setdefault((*data.shape, raw.step), []).append((i, k, kinds, data))
    for (h, row, step), group in shapes.items():
        per = max(1, _TOGETHER // (h * row))
        for s in range(0, len(group), per):
            part = group[s : s + per]
            done = unfiltered(np.stack([x[2] for x in part]), np.stack([x[3] for x in part]), step)
            for (i, k, _, _), data in zip(part, done):
                rows[i][k] = data
    for i, raw in raws.items():
        try:
            out[i] = raw.pixels(rows[i])
        except Damaged as e:
            out[i] = str(e)
    return out


def encode(pixels: np.ndarray) -> bytes:
    """A PNG of (h, w, channels) bytes with 1 to 4 channels; its rows take turns with the five filters."""
    h, w, channels = pixels.shape
    x = pixels.astype(np.int16)
    a, b, d = (np.zeros_like(x) for _ in range(3))
    a[:, 1:], b[1:], d[1:, 1:] = x[:, :-1], x[:-1], x[:-1, :-1]
    pa_, pb, pc = np.abs(b - d), np.abs(a - d), np.abs(a + b - 2 * d)
    paeth = np.where((pa_ <= pb) & (pa_ <= pc), a, np.where(pb <= pc, b, d))
    kinds = np.arange(h) % 5
    guess = np.choose(kinds[:, None, None], [np.zeros_like(x), a, b, (a + b) >> 1, paeth])
    rows = np.concatenate([kinds[:, None].astype(np.uint8), ((x - guess) & 255).astype(np.uint8).reshape(h, -1)], axis=1)
    head = struct.pack(">IIBBBBB", w, h, 8, {1: 0, 2: 4, 3: 2, 4: 6}[channels], 0, 0, 0)
    return _SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + chunk(b"IEND", b"")


@lru_cache(64)
def _averaging(n: int) -> np.ndarray:
    """(SIDE, n): each row averages one of SIDE equal stretches of n pixels."""
    edge = np.linspace(0, n, SIDE + 1)
    lo, hi = np.arange(n), np.arange(1, n + 1)
    part = np.clip(np.minimum(edge[1:, None], hi) - np.maximum(edge[:-1, None], lo), 0, None)
    return part / part.sum(axis=1, keepdims=True)


_COSINE = np.cos(np.pi / SIDE * np.outer(np.arange(KEPT), np.arange(SIDE) + 0.5))


def grey(pixels: np.ndarray) -> np.ndarray:
    """Brightness; what is transparent is black."""
    x = pixels.astype(np.float64)
    light = x[:, :, :3] @ np.array([0.299, 0.587, 0.114]) if x.shape[2] >= 3 else x[:, :, 0]
    return light * x[:, :, -1] / 255 if x.shape[2] in (2, 4) else light


def phash(pixels: np.ndarray) -> bytes:
    """The hash: bit k is whether the k-th of the lowest frequencies is above their median. An even image has no set bit but the first."""
    g = grey(pixels)
    small = _averaging(g.shape[0]) @ g @ _averaging(g.shape[1]).T
    low = np.round(_COSINE @ small @ _COSINE.T, 6)
    return np.packbits((low > np.median(low)).reshape(-1)).tobytes()


def _hashed(column: int, names: list[str]):
    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                part = batch.slice(k, 1024)
                found = decode(part.column(column).to_pylist())
                ok = [isinstance(x, np.ndarray) for x in found]
                own = [
                    pa.array([x.shape[1] if o else None for x, o in zip(found, ok)], pa.int32()),
                    pa.array([x.shape[0] if o else None for x, o in zip(found, ok)], pa.int32()),
                    pa.array([phash(x) if o else None for x, o in zip(found, ok)], pa.binary()),
                    pa.array([None if o or x is None else x for x, o in zip(found, ok)], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *own], names=names)

    return f


def image_hashes(media: DataFrame, column: str = "png") -> DataFrame:
    """Adds width, height, phash (8 bytes) and image_error to rows with a PNG in a binary column.

    A null image has nulls; a damaged one, empty bytes included, has an image_error and nulls, and so has one whose
    header claims more than its data can hold. Images of any size are decoded whole. A colour that is to be transparent
    (tRNS) isn't looked at. Equal frequencies give no set bit. Input columns of the added names are replaced, others pass through; repeated rows each get theirs.
    An empty table gives an empty table.
    """
    own = [("width", T.IntegerType()), ("height", T.IntegerType()), ("phash", T.BinaryType()), ("image_error", T.StringType())]
    media = media.drop(*[n for n, _ in own if n != column])
    schema = T.StructType([*media.schema.fields, *[T.StructField(n, t) for n, t in own]])
    return media.mapInArrow(_hashed(media.columns.index(column), [f.name for f in schema.fields]), schema)


@lru_cache(64)
def _stretching(side: int) -> np.ndarray:
    """(SIDE, side): weights of linear interpolation."""
    at = np.clip((np.arange(SIDE) + 0.5) * side / SIDE - 0.5, 0, side - 1)
    lo = np.minimum(at.astype(int), max(side - 2, 0))
    mix = np.zeros((SIDE, side))
    mix[np.arange(SIDE), lo] = 1 - (at - lo)
    mix[np.arange(SIDE), np.minimum(lo + 1, side - 1)] += at - lo
    return mix


def _rendered(column: int, names: list[str]):
    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column(column):
                v = v.as_py()
                if not v:
                    out.append(None)
                    continue
                side = int(np.ceil(np.sqrt(len(v))))
                x = np.zeros(side * side)
                x[: len(v)] = np.nan_to_num(np.array([0.0 if y is None else y for y in v], np.float64), posinf=1, neginf=-1)
                mix = _stretching(side)
                out.append(encode(np.clip(np.round(128 + 400 * (mix @ x.reshape(side, side) @ mix.T)), 0, 255).astype(np.uint8)[:, :, None]))
            yield pa.RecordBatch.from_arrays([*[c for k, c in enumerate(batch.columns) if k != column], pa.array(out, pa.binary())], names=names)

    return f


def rendered(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Replaces an array column by png: its numbers as a square grey picture of 32 x 32 pixels. Null and empty arrays give null.

    Null, infinite and missing numbers count as 0, 1 or -1. Rows aren't joined or compared, so repeated rows each get the same
    picture; an array of any length is drawn. An input column png is replaced, others pass through. An empty table gives an empty table.
    """
    vectors = vectors.drop("png")
    rest = [f for f in vectors.schema.fields if f.name != column]
    return vectors.mapInArrow(_rendered(vectors.columns.index(column), [*[f.name for f in rest], "png"]), T.StructType([*rest, T.StructField("png", T.BinaryType())]))


def distance(a: str, b: str):
    """The number of different bits of two hash columns, without Python."""
    number = lambda c: F.conv(F.hex(c), 16, -10).cast("long")
    return F.bit_count(number(a).bitwiseXOR(number(b)))
