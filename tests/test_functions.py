import html
import random
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodeweave.functions import audio, ids, rates
from lodeweave.functions import text as X


def plain_normal(t):
    t = unicodedata.normalize("NFKC", html.unescape(t))
    t = "".join(c for c in t if not (ord(c) < 9 or ord(c) in (11, 12, 127, 0xFEFF) or 14 <= ord(c) < 32 or 0x200B <= ord(c) <= 0x200F))
    return " ".join(t.split())


def strings(n=600):
    rnd = random.Random(4)
    bits = ["a", "B", "é", "ß", "か", "カ", "ｶﾞ", "漢", "々", "・", "ー", "１", "2", "_", "'", "’", "-", ".", "@", "foo@bar.com", "https://", "www.", "<b>", "&lt;", "&amp;lt;", "&nbsp;", "(", "）", "【", "音楽", "music", "Laughs", " ", "\t", "​", "\u0085", "　", "\x0b", "\x07", "…", "!", "。", "é", "٣", "Ω"]
    return ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 9))) for _ in range(n)] + [None, ""]


@pytest.fixture(scope="module")
def rows(spark):
    t = F.col("t")
    df = spark.createDataFrame([(x,) for x in strings()], "t string")
    out = df.select("t", X.normalized(t).alias("norm"), X.script_units(t).alias("units"), X.latin_words(t).alias("words"), X.japanese_letters(t).alias("ja"), X.letters(t).alias("letters"), X.has_link(t).alias("link"), X.has_markup(t).alias("markup"), X.is_cue(t).alias("cue"), X.has_content(t).alias("content"), X.english_plain(t).alias("plain"))
    return [r.asDict() for r in out.collect()]


def test_text_against_python(rows):
    link = re.compile(r"https?://|www\.|\b[\w.+-]+@[\w.-]+\.[a-z]{2,}\b", re.I)
    for r in rows:
        t = r["t"]
        if t is None:
            assert all(v is None for v in r.values())
            continue
        assert r["norm"] == plain_normal(t), repr(t)
        assert r["units"] == len(re.sub(r"[^\w぀-ヿ㐀-鿿]", "", t)), repr(t)
        assert r["words"] == len(re.findall(r"[A-Za-z]+(?:['’-][A-Za-z]+)?", t))
        assert r["ja"] == sum("぀" <= c <= "ヿ" or "㐀" <= c <= "鿿" for c in t)
        assert r["letters"] == sum(c.isalpha() for c in t)
        assert r["link"] == bool(link.search(t)), repr(t)
        assert r["markup"] == bool(re.search(r"<[^>]+>|&(nbsp|lt|gt|amp|quot|apos);", t, re.I))
        assert r["content"] == bool(re.search(r"[A-Za-z぀-ヿ㐀-鿿]", t))
        assert r["plain"] == " ".join(re.sub(r"[^\w\s']", " ", plain_normal(t).lower()).split())


def test_goldens(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    for t, want in [("&amp;lt;b&amp;gt;", "&lt;b&gt;"), ("&lt;b&gt;", "<b>"), ("a​b", "ab"), ("Ａ…！", "A...!"), ("x\x0by", "xy"), ("x\x85y", "x y"), ("ｶﾞｷﾞ", "ガギ"), ("１２３", "123")]:
        assert one(X.normalized(F.lit(t))) == want
    for t, want in [("[Music]", True), ("（拍手）", True), ("♪ music", False), ("Sighs...", True), ("music now", False)]:
        assert one(X.is_cue(F.lit(t))) == want
    assert one(ids.pair_id(F.lit("jesc"), F.lit("train"), F.lit(123456789), F.lit("abcdefabcdef99"))) == "jesc_train_123456789_abcdefabcdef"
    got = spark.createDataFrame([(f"pair_{i:04d}",) for i in range(20)], "id string").select(ids.leading_u64(F.col("id")).cast("string"), ids.shard(F.col("id"), 8), ids.shard(F.col("id"), 128), ids.seed(F.col("id"), F.lit("ja"), F.lit(0)), ids.shard(F.col("id"), 4)).collect()
    assert [tuple(r)[:4] for r in got[:4]] == [("18303935515101111622", 6, 70, 4061344143463052571), ("28587706967795996", 4, 28, 6095366210932107889), ("17826030106791157509", 5, 5, 7217195235858949756), ("16720531780946088649", 1, 73, 4894452591410965679)]
    assert [sum(r[4] == k for r in got) for k in range(4)] == [6, 6, 5, 3]
    assert abs(ids.pcm16_gib(300) - 64.37) < 0.01 and abs(ids.pcm16_gib(300, retries=0.1) - 70.81) < 0.01
    assert one(ids.shard_name(F.lit(7), 128)) == "shard-00007-of-00128" and one(ids.audio_name(F.lit("p"), F.lit(1))) == "p.a1.wav"
    assert [one(ids.length_bin(F.lit(n), 24, 64)) for n in (24, 25, 64, 65)] == ["short", "medium", "medium", "long"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_error_rates(spark):
    rnd = random.Random(1)
    pairs = [(" ".join(rnd.choice(["a", "b", "cc", "日本", "é"]) for _ in range(rnd.randint(0, 9))), " ".join(rnd.choice(["a", "b", "cc", "日本", "x"]) for _ in range(rnd.randint(0, 9)))) for _ in range(200)]
    df = spark.createDataFrame([*pairs, (None, "a"), ("a", None)], "r string, h string")
    got = df.select("r", "h", rates.character_error_rate(F.col("r"), F.col("h")), rates.word_error_rate(F.col("r"), F.col("h"))).collect()
    for r, h, c, w in got:
        if r is None or h is None:
            assert c is None and w is None
        else:
            assert c == distance(r, h) / max(1, len(r)) and w == distance(r.split(), h.split()) / max(1, len(r.split()))


def test_readers(spark):
    df = spark.createDataFrame([("こん、にちは。",), (None,)], "t string")
    assert [r[0] for r in df.select(X.japanese_reading(F.col("t"), lambda t, kana: t.replace("こん", "ｺﾝ"))).collect()] == ["コンにちは", None]

    class Own:
        def normalize(self, t):
            return t.upper() + "  x"

    assert df.select(X.english_spoken(F.lit("it's"), Own()), X.english_spoken(F.lit("It's, OK-"))).first()[:] == ("IT'S x", "it's ok")


def test_audio(spark, tmp_path):
    x = np.sin(2 * np.pi * 440 * np.arange(24000) / 24000)
    y = audio.resampled(x, 24000, 16000)
    assert len(y) == 16000 and np.abs(y[500:-500] - np.sin(2 * np.pi * 440 * np.arange(16000) / 16000)[500:-500]).max() < 0.01
    assert audio.resampled([[0.5, 1]], 8, 8).tolist() == [0.5, 1]
    for bad in ([[1, 2], [3, 4]], [float("nan"), 0]):
        with pytest.raises(ValueError):
            audio.mono(bad)
    audio.write_wav(tmp_path / "d" / "a.wav", y, 16000)
    audio.write_wav(tmp_path / "d" / "b.wav", y[:1600], 16000)
    (tmp_path / "d" / "c.wav").write_bytes(b"no wav")
    files = spark.read.format("binaryFile").load(str(tmp_path / "d"))
    assert [round(r.seconds, 3) for r in audio.usable(files, 0.7, 30).collect()] == [1.0]


def test_terminated_entities(spark):
    t = ["und&amp", "&&amp;amp;&copy", "&lt;&quo;&am&#65;&#65 &ampx; ﬁ&amp", None]
    got = spark.createDataFrame([(x,) for x in t], "t string").select(X.normalized(F.col("t"), terminated=True), X.normalized(F.col("t"))).collect()
    assert [r[0] for r in got] == ["und&amp", "&&amp;&copy", "<&quo;&amA&#65 &ampx; fi&amp", None]
    assert [r[1] for r in got] == [x and plain_normal(x) for x in t]


def test_stable_characters_need_no_python():
    stable = [c for c in map(chr, range(0x110000)) if re.fullmatch(f"[{X.STABLE}]", c)]
    assert "&" not in stable and len(stable) > 30_000
    pairs = {chr(int(d.split()[1], 16)) for d in map(unicodedata.decomposition, map(chr, range(0x110000))) if len(d.split()) == 2 and d[0] != "<"}
    assert not pairs & set(stable) and all(unicodedata.is_normalized("NFKC", c) and not unicodedata.combining(c) for c in stable)
    whole = "".join(random.Random(5).sample(stable, len(stable)))
    assert unicodedata.normalize("NFKC", html.unescape(whole)) == whole


def test_a_piece_of_a_batch_at_a_time(monkeypatch):
    monkeypatch.setattr(X, "PIECE", 10)
    sizes = []
    t = ["ab", None, "é" * 20, "", "cdefgh", "xyz", None]
    concat = pa.concat_arrays
    monkeypatch.setattr(pa, "concat_arrays", lambda parts: sizes.extend(len(p) for p in parts) or concat(parts))
    assert X._in_pieces(str.upper, pa.array(t, pa.string())).to_pylist() == [x and x.upper() for x in t]
    assert sizes == [2, 1, 4] and X._in_pieces(str.upper, pa.array(["z", *t], pa.string()).slice(1)).to_pylist() == [x and x.upper() for x in t]
    assert X._in_pieces(str.upper, pa.array([], pa.string())).to_pylist() == []
