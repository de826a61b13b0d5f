import base64
import random

import pytest
import tiktoken

from lodeweave.llm.token_counts import safe_parts, token_counts

P = pytest.importorskip("public_tokenizers")
FILE = P.path("byte_bpe_multi_50k.tiktoken")


def whole():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(FILE, "rb"))}
    own = tiktoken.Encoding("whole", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda t: own.encode_ordinary(t)


def test_parts_add_up():
    rnd, ids = random.Random(1), whole()
    for _ in range(600):
        t = "".join(rnd.choice(["a", "é", "s", "'", "ll", " ", "  ", "\n", "\t", "1", "23", ".", "!?", "日本", "́", "<|endoftext|>", "🙂", "　"]) for _ in range(rnd.randint(0, 60)))
        parts = safe_parts(t, 3)
        assert all(n == len(x.encode()) for x, n in parts)
        parts = [x for x, _ in parts]
        assert "".join(parts) == t
        assert [x for p in parts for x in ids(p)] == ids(t), (t, parts)


def test_parts_are_of_bytes_and_long_words_go_whole(spark):
    for c in "aé日🙂":
        parts = safe_parts(f"{c * 9} " * 3000, 1000)
        assert all(n <= 1000 + 40 for _, n in parts) and min(n for _, n in parts[:-1]) >= 1000 - 4
    long = "ab cd, " * 1_500_000
    rows = [(1, long), (2, "一" * 50_000)]
    got = {r.doc_id: r.n_tokens for r in token_counts(spark.createDataFrame(rows, "doc_id long, text string"), FILE).collect()}
    assert got == {i: len(whole()(t)) for i, t in rows} and len(long) > 10_000_000


def test_tables(spark):
    ids = whole()
    long = "It's the and, of 12 words.\n" * 30000
    rows = [(1, None, 5), (None, "a b", 6), (2, "", 7), (4, long, 9), (4, long, 9), (5, "x" * 200000, 1), (6, "<|endoftext|>", 1)]
    got = [(r.doc_id, r.n_tokens) for r in token_counts(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int"), FILE).collect()]
    assert got == [(i, None if t is None else len(ids(t))) for i, t, _ in rows]
    assert token_counts(spark.createDataFrame([], "doc_id long, text string"), FILE).count() == 0
