import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from test_jaccard_join import grams
from test_line_dedup import brute as lines_kept

import corpus_pipeline
from lodeweave.llm.queries import PIECE_MODEL

P = pytest.importorskip("public_tokenizers")
WORDS = {x: ["".join(random.Random(f"{x}{i}").choices(a, k=random.Random(f"{i}{x}").randint(2, 8))) for i in range(500)] for x, a in (("en", "etaoinsh"), ("de", "ernistdüß"))}


def test_stages_against_brute_force(spark, tmp_path):
    """Each stage's output is compared with what a plain version makes of the stage's own input."""
    rnd = random.Random(8)
    say = lambda x, n: " ".join(rnd.choice(WORDS[x]) for _ in range(n))
    shared = "\n".join(say("en", 30) for _ in range(3))
    rows = []
    for i in range(300):
        x = rnd.choice(list(WORDS))
        t = "\n".join(say(x, rnd.randint(3, 40)) for _ in range(rnd.randint(1, 6)))
        if i % 25 == 0:
            t += "\n" + shared + "\n" + say(x, 20)
        if i % 30 == 7 and rows:
            w = rows[-1][1].split(" ")
            w[len(w) // 2] = "changed"
            t, x = " ".join(w), rows[-1][2]
        rows.append((i, t, x, f"s{i % 7 % 3}", len(t)))
    rows += [(1000, "привет мир как твои дела", None, "s0", 5), (1001, None, "en", "s1", 0), (1002, rows[3][1], rows[3][2], "s2", 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append([tuple(r) for r in docs.collect()])
        assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and (k == 4 or len(docs.columns) == 5)
    known, lined, single, mix, coded = seen
    assert {r[0] for r in known} == {r[0] for r in rows} - {1000, 1001}
    want = {i: t for i, (t, n) in lines_kept([r[:2] for r in known], 50).items() if t or not n}
    assert {r[0]: r[1] for r in lined} == want and all(r[4] == len(r[1]) for r in lined if r[1] != dict((x[0], x[1]) for x in rows)[r[0]])
    sets = {r[0]: grams(r[1]) for r in lined}
    boss = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= corpus_pipeline.NEAR:
                x, y = sorted((boss[a], boss[b]))
                boss = {i: x if v == y else v for i, v in boss.items()}
    assert {r[0] for r in single} == {i for i, v in boss.items() if i == v} and len(single) < len(lined)
    n = Counter(r[0] for r in mix)
    assert set(n) == {r[0] for r in single}
    size, copies, many = defaultdict(int), defaultdict(int), Counter(r[3] for r in single)
    for r in single:
        size[r[3]] += len(r[1])
        copies[r[3]] += n[r[0]]
    part = {s: v**0.7 for s, v in size.items()}
    w = {s: v / sum(part.values()) for s, v in part.items()}
    budget = max(size[s] / w[s] for s in size)
    assert all(abs(copies[s] - w[s] * budget / size[s] * many[s]) < 1 for s in size)
    theirs = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    assert Counter(r[0] for r in coded) == n and all(list(r[5]) == theirs.encode(r[1]) and theirs.decode(list(r[5])) == r[1] for r in coded)
    assert sorted(r[0] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == sorted(r[0] for r in coded)


def test_edges_of_each_stage(spark):
    """Nulls in any column, empty texts, repeated rows, clashing extra columns and empty tables."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, lang_ok int, lines_deleted int, __id int, copies int, token_ids int"
    rnd = random.Random(3)
    say = lambda n: " ".join(rnd.choice(WORDS["en"]) for _ in range(n))
    plain = [(i, say(30), "en", "s", 9, *[7] * 5) for i in range(100)]
    long = " ".join(f"{a}{b}" for a in WORDS["en"][:120] for b in WORDS["en"][:120])
    odd = [(None, say(20), "en", "s", 9, *[7] * 5), (201, None, "en", "s", 9, *[7] * 5), (202, "", None, None, None, *[None] * 5), (203, long, None, None, None, *[7] * 5), plain[0]]
    docs, empty = spark.createDataFrame(plain + odd, schema), spark.createDataFrame([], schema)
    want = {"language ID": {202, 201}, "line dedup": set(), "near duplicates": set(), "mixture": set(), "tokens": set()}
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, "").collect()
        assert list(got[0].asDict())[:5] == list(corpus_pipeline.COLUMNS) and len(got[0]) == (6 if name == "tokens" else 5) or name == "tokens"
        ids = Counter(r.doc_id for r in got)
        assert {r[0] for r in plain + odd} - set(ids) == want[name], name
        assert ids[0] == 2 * ids[1] or name == "mixture"
        assert stage(spark, empty, "").count() == 0, name
