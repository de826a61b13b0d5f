import gzip
import io
import zlib

from lodeweave.llm.warc import members, pages_of, parsed, read_warc, record, round_trip, write_warc


def test_members_are_gzip_and_frames_hold():
    data = record(7, "http://x.example/a b\r\n", "<p>é\r\n\r\n</p>")
    plain = gzip.decompress(data)
    fields, block, error = parsed(plain)
    assert error is None and int(fields["content-length"]) == len(block) and plain.endswith(block + b"\r\n\r\n")
    assert "\r" not in fields["warc-target-uri"] and fields["warc-target-uri"].endswith("a%20b%0D%0A")


def test_reader_in_small_and_damaged_pieces():
    rows = [(i, f"http://h{i}.example/", f"text {i} " * (i * 900)) for i in range(6)]
    parts = [record(*r) for r in rows]

    class Slow(io.BytesIO):
        def read(self, n=-1):
            return super().read(7)

    assert [x[1:4] for x in pages_of(Slow(b"".join(parts)))] == rows
    assert [d for _, d, _ in members(io.BytesIO(b"".join(parts)))] == [gzip.decompress(p) for p in parts]
    broken = bytearray(parts[2])
    broken[len(broken) // 2] ^= 255
    got = list(pages_of(io.BytesIO(b"".join([*parts[:2], bytes(broken), *parts[3:5], parts[5][:-9]]))))
    assert [x[1:4] for x in got if not x[6]] == [*rows[:2], *rows[3:5]]
    assert sum(x[0] == len(parts[0]) + len(parts[1]) and bool(x[6]) for x in got) == 1 and got[-1][6]


def gz(b):
    c = zlib.compressobj(9, zlib.DEFLATED, 31)
    return c.compress(b) + c.flush()


def test_foreign_records():
    ok = b"WARC/1.0\r\nWARC-Type: resource\r\nwarc-target-uri: http://a/\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    info = ok.replace(b"resource", b"warcinfo")
    bad = ok.replace(b"Content-Length: 2", b"WARC-Block-Digest: sha1:AAAA\r\nContent-Length: 2")
    short = ok.replace(b"Length: 2", b"Length: 20")
    none = ok.replace(b"Content-Length: 2\r\n", b"")
    got = [(x[2], x[3], x[5], bool(x[6])) for x in pages_of(io.BytesIO(b"".join(map(gz, [ok, info, bad, short, none, b"junk"]))))]
    assert got == [("http://a/", "hi", None, False), ("http://a/", "hi", False, False), ("http://a/", None, None, True), ("http://a/", None, None, True), (None, None, None, True)]
    assert [x[6] for x in pages_of(io.BytesIO(b"plain text"))] == ["not a gzip member"] and list(pages_of(io.BytesIO(b""))) == []


def test_tables(spark, tmp_path):
    rows = [(1, "http://a/", "<p>é</p>", "x"), (None, None, None, "x"), (2, "", "", "x"), (3, "http://b/\n ", "z\r\n\r\n" * 300000, "x"), (3, "http://b/\n ", "z", "x"), (3, "http://b/\n ", "z", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, error string")
    key = lambda r: (r[0] or 0, len(r[2] or ""))
    got = [(r.page_id, r.url, r.html) for r in round_trip(df).collect()]
    assert sorted(got, key=key) == sorted([r[:3] for r in rows], key=key)
    out = round_trip(df)
    assert out.where("error is not null or not digest_ok").count() == 0
    made = write_warc(df.coalesce(1), f"file://{tmp_path}/w", roll=100)
    assert made.count() == 6 and read_warc(made, 3).count() == 6
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert round_trip(none).count() == 0
