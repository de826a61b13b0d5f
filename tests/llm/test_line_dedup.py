import random

import pytest

from lodeweave.llm.line_dedup import _blocks, _reduced, line_dedup, repeated_lines


def brute(rows, least):
    """Minimal runs of enough words, forwards and backwards, that began earlier: they cover just the runs to delete."""
    docs = {i: t.split("\n") for i, t in rows if i is not None and t is not None}
    seen, out = {}, {i: set() for i in docs}
    for i in sorted(docs):
        n = len(docs[i])
        for a in range(n):
            for b in range(a + 1, n + 1):
                key = tuple(docs[i][a:b])
                if key in seen and seen[key] < (i, a):
                    if sum(len(x.split()) for x in key) >= least:
                        out[i] |= set(range(a, b))
                else:
                    seen.setdefault(key, (i, a))
    return {i: ("\n".join(x for k, x in enumerate(docs[i]) if k not in out[i]), len(out[i])) for i in docs}


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    words = ["a", "b c", "d e f", "g", ""]
    pool = [[rnd.choice(words) for _ in range(rnd.randint(1, 7))] for _ in range(6)]
    rows = []
    for i in range(40):
        text = []
        for _ in range(rnd.randint(1, 4)):
            text += rnd.choice(pool) if rnd.random() < 0.6 else [f"own {rnd.random()}"]
        rows.append((i * 3 % 41, "\n".join(text)))
    got = {r.doc_id: (r.text, r.lines_deleted) for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()}
    assert got == brute(rows, 4)


def test_edges(spark):
    long = "\n".join(f"line {i} of a very long text" for i in range(3000))
    rows = [(i, t, k, k) for k, (i, t) in enumerate([(1, None), (None, "x y z\nx y z"), (2, ""), (3, ""), (4, long), (5, long), (6, "x y z")])]
    out = line_dedup(spark.createDataFrame(rows, "doc_id long, text string, lines_deleted int, __mask int"), 2)
    got = {r.doc_id: (r.text, r.lines_deleted) for r in out.collect()}
    assert got == {1: (None, 0), None: ("x y z\nx y z", 0), 2: ("", 0), 3: ("", 0), 4: (long, 0), 5: ("", 3000), 6: ("x y z", 0)}
    assert line_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_hot_lines_and_copies_stay_out_of_the_suffix_array(spark):
    """A blank line in every document and a passage in a third of them leave one copy of the passage to be sorted."""
    passage = "\n".join(f"line {k} of a passage that a third of all documents have" for k in range(6))
    rows = [(i, f"own {i} words\n\nmore own {i} words\n\n" + (f"{passage}\n\nend {i}" if i % 3 == 0 else f"end {i}")) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    own, copied = _reduced(_blocks(repeated_lines(docs)), 50)
    assert own.count() <= 8 and copied.count() == 99
    got = {r.doc_id: (r.text, r.lines_deleted) for r in line_dedup(docs).collect()}
    assert got == brute(rows, 50) and sum(n > 0 for _, n in got.values()) == 99


def test_masks_are_worked_out_once(spark):
    from lodeweave.llm.line_dedup import deletion_masks

    text = "\n".join(" ".join(f"w{i}x{k}" for k in range(20)) for i in range(4))
    df = deletion_masks(spark.createDataFrame([(1, text), (2, text), (3, "other")], "doc_id long, text string"))
    # two of them in a row take two Python workers at a time for each task
    assert df._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert [(r.id, r.mask) for r in df.collect()] == [(2, [True] * 4)]
