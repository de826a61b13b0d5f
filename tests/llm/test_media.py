import math
import struct
import zlib

import numpy as np
import pytest

from lodeweave.llm.media import _PASSES, Damaged, Raw, chunk, decode, distance, encode, image_hashes, phash, rendered, unfiltered

RND = np.random.RandomState(3)


def png(w, h, depth, color, data, extra=b"", interlaced=0):
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, depth, color, 0, 0, interlaced)) + extra + chunk(b"IDAT", zlib.compress(data)[:9]) + chunk(b"IDAT", zlib.compress(data)[9:]) + chunk(b"IEND", b"")


def slow(kinds, data, step):
    """Unfiltering by the standard's text, byte by byte."""
    h, row = data.shape
    out = [[0] * row for _ in range(h)]
    for y in range(h):
        for x in range(row):
            a = out[y][x - step] if x >= step else 0
            b = out[y - 1][x] if y else 0
            c = out[y - 1][x - step] if y and x >= step else 0
            p = a + b - c
            near = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            out[y][x] = (int(data[y, x]) + [0, a, b, (a + b) // 2, near][kinds[y]]) % 256
    return np.array(out, np.uint8)


@pytest.mark.parametrize("shape", [(1, 1, 1), (7, 5, 1), (6, 9, 3), (5, 4, 4), (11, 3, 2)])
def test_round_trip_and_filters(shape):
    x = RND.randint(0, 256, shape).astype(np.uint8)
    assert np.array_equal(decode([encode(x)])[0], x)
    data = RND.randint(0, 256, (3, shape[0], shape[1] * shape[2])).astype(np.uint8)
    kinds = RND.randint(0, 5, (3, shape[0]))
    got = unfiltered(kinds, data, shape[2])
    assert all(np.array_equal(got[i], slow(kinds[i], data[i], shape[2])) for i in range(3))


def test_depths_palette_and_interlace():
    assert decode([png(3, 1, 1, 0, bytes([0, 0b10100000]))])[0][:, :, 0].tolist() == [[255, 0, 255]]
    assert decode([png(2, 1, 16, 0, bytes([0, 200, 1, 9, 255]))])[0][:, :, 0].tolist() == [[200, 9]]
    assert decode([png(2, 1, 4, 3, bytes([0, 0x10]), chunk(b"PLTE", bytes([1, 2, 3, 4, 5, 6])))])[0].tolist() == [[[4, 5, 6], [1, 2, 3]]]
    x = RND.randint(0, 256, (13, 10)).astype(np.uint8)
    data = b"".join(b"\0" + r.tobytes() for a, b, dx, dy in _PASSES for r in x[b::dy, a::dx] if r.size)
    assert np.array_equal(decode([png(10, 13, 8, 0, data, interlaced=1)])[0][:, :, 0], x)


def test_damage():
    good = encode(RND.randint(0, 256, (4, 4, 1)).astype(np.uint8))
    bad = bytearray(good)
    bad[45] ^= 1
    out = decode([b"", good[:-5], bytes(bad), good, None, png(4, 4, 8, 0, b"\0" * 3), png(4, 1, 8, 0, b"\7" * 5), png(0, 1, 8, 0, b""), png(1, 1, 4, 3, b"\0\xf0", chunk(b"PLTE", b"abc"))])
    assert [isinstance(x, str) for x in out] == [True, True, True, False, False, True, True, True, True] and "checksum" in out[2]
    with pytest.raises(Damaged):
        Raw(b"GIF89a")


def test_hash_by_definition():
    x = RND.randint(0, 256, (32, 32, 1)).astype(np.uint8)
    low = [[sum(x[i, j, 0] * math.cos(math.pi / 32 * u * (i + 0.5)) * math.cos(math.pi / 32 * v * (j + 0.5)) for i in range(32) for j in range(32)) for v in range(8)] for u in range(8)]
    flat = [f for r in low for f in r]
    m = (sorted(flat)[31] + sorted(flat)[32]) / 2
    assert phash(x) == int("".join("1" if f > m else "0" for f in flat), 2).to_bytes(8, "big")
    big = np.kron(x[:, :, 0], np.ones((5, 3)))[:, :, None].astype(np.uint8)
    assert phash(big) == phash(x)
    assert phash(np.full((3, 500, 1), 9, np.uint8)) == bytes([128] + [0] * 7)


def test_tables(spark):
    v = RND.randn(64) / 8
    rows = [(1, v.tolist(), 1), (2, (v + RND.randn(64) / 400).tolist(), 1), (3, (-v).tolist(), 1), (4, None, 1), (5, [], 1), (1, v.tolist(), 1), (6, [float("nan"), float("inf"), 1.0], 1)]
    df = image_hashes(rendered(spark.createDataFrame(rows, "vec_id long, embedding array<float>, width int")))
    got = df.collect()
    assert [r.width for r in got] == [32, 32, 32, None, None, 32, 32] and got[0].phash == got[5].phash and got[6].image_error is None
    bits = lambda a, b: bin(int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).count("1")
    assert bits(got[0].phash, got[1].phash) <= 8 < bits(got[0].phash, got[2].phash)
    pair = df.where("vec_id = 2").selectExpr("phash a").crossJoin(df.where("vec_id = 3").selectExpr("phash b"))
    assert pair.select(distance("a", "b")).first()[0] == bits(got[1].phash, got[2].phash)
    assert image_hashes(spark.createDataFrame([], "png binary")).count() == 0
    assert image_hashes(spark.createDataFrame([(bytearray(b""),)], "png binary")).first().image_error


def test_headers_that_claim_too_much(spark):
    huge = [png(w, h, depth, 6, b"\0" * 50) for w, h, depth in ((2**31 - 1, 2**31 - 1, 16), (2**32 - 1, 1, 8), (1, 2**32 - 1, 8), (100_000, 100_000, 8))]
    rows = [(k, bytearray(x)) for k, x in enumerate([*huge, encode(np.zeros((4, 4, 1), np.uint8))])]
    got = [r.image_error for r in image_hashes(spark.createDataFrame(rows, "id long, png binary")).orderBy("id").collect()]
    assert all(x and "claims more" in x for x in got[:4]) and got[4] is None
    flat = np.full((2000, 3000, 1), 7, np.uint8)  # what compresses best is still read
    assert np.array_equal(decode([encode(flat)])[0], flat)
