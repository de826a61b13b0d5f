import random

import pytest
import sentencepiece

from lodeweave.llm.pieces import decode, encode, load

P = pytest.importorskip("public_tokenizers")
FILE = P.path("piece_bpe_32k.model")


def texts():
    rnd = random.Random(3)
    known = list(load(FILE).ids)
    out = ["", " ", "   a", "a  b   c ", "x\n\ny\tz", "日本語 テキスト", "🙂🙂 ☃", "aaaaaaaaaaaaaaaaaaaa" * 40, "1234567890 3.14", "Ünïcödé ßtraße", "\u0000\u0001", "a" * 20000, " " * 40 + "z" + " " * 17]
    for _ in range(400):
        out.append("".join(rnd.choice(["", " ", "\n"]) + rnd.choice(known).replace("▁", " ") for _ in range(rnd.randint(1, 30))))
        out.append("".join(rnd.choice("abehinorst  éü\n.,-1") for _ in range(rnd.randint(1, 80))))
    return out


def test_same_ids_as_the_library():
    theirs, ours = sentencepiece.SentencePieceProcessor(model_file=FILE), load(FILE)
    import numpy as np

    for t in texts():
        ids = np.frombuffer(ours.encoded(t), np.int32).tolist()
        assert ids == theirs.encode(t), t
        assert ours.decoded(ids) == theirs.decode(ids) == t


def test_tables(spark):
    long = "thethe and of " * 60000
    rows = [(1, None, 5), (None, "a b", 6), (2, "", 7), (3, "x ▁y", 8), (4, long, 9), (4, long, 9)]
    df = encode(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int"), FILE)
    got = [(r.doc_id, r.token_ids and len(r.token_ids), r.n_tokens, r.round_trip) for r in df.collect()]
    n = len(sentencepiece.SentencePieceProcessor(model_file=FILE).encode(long))
    assert got == [(1, None, None, None), (None, 2, 2, True), (2, [], 0, True), (3, got[3][1], got[3][1], False), (4, n, n, True), (4, n, n, True)]
    assert [r.decoded for r in decode(df, FILE).collect()] == [None, "a b", "", "x  y", long, long]
    assert encode(spark.createDataFrame([], "doc_id long, text string"), FILE).count() == 0


def test_copies_side_by_side_are_encoded_once(monkeypatch):
    import pyarrow as pa

    from lodeweave.llm.pieces import PieceModel, _coded

    rows = ["", "", "a b", "a b", None, "a b", "c", "a b", "x ▁y", "x ▁y", None, None, "x ▁y"] + ["again"] * 300
    theirs, seen, plain = sentencepiece.SentencePieceProcessor(model_file=FILE), [], PieceModel.encoded
    monkeypatch.setattr(PieceModel, "encoded", lambda self, t: (seen.append(t), plain(self, t))[1])
    batches = [pa.record_batch([pa.array(rows[a:b], pa.string())], names=["text"]) for a, b in ((0, 4), (4, 200), (200, len(rows)))]
    got = [r for b in _coded(FILE, 0, ["text", "token_ids", "n_tokens", "round_trip"])(iter(batches)) for r in b.to_pylist()]
    assert [(r["text"], r["token_ids"], r["round_trip"]) for r in got] == [(t, None if t is None else theirs.encode(t), None if t is None else "▁" not in t) for t in rows]
    assert [r["n_tokens"] for r in got] == [None if t is None else len(theirs.encode(t)) for t in rows]
    assert seen == ["", "a b", "c", "a b", "x ▁y", "again"]
