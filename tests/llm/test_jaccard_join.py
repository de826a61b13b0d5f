import random

import pyarrow as pa

from lodeweave.llm.components import components
from lodeweave.llm.jaccard_join import SETS, candidate_pairs, jaccard_join, linked, near_duplicates_dropped, ngram_sets, signatures


def grams(t, n=3):
    w = t.lower().split()
    return {tuple(w)} if 0 < len(w) < n else {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def brute(rows, t):
    sets = {i: grams(x) for i, x in rows if i is not None and x and x.split()}
    rep = {}
    for i in sorted(sets):
        rep.setdefault(frozenset(sets[i]), i)
    out = {(rep[frozenset(s)], i): 1.0 for i, s in sets.items() if rep[frozenset(s)] != i}
    own = sorted(rep.values())
    for k, a in enumerate(own):
        for b in own[k + 1 :]:
            j = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
            if j >= t:
                out[a, b] = j
    return out


def corpus(seed, n):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        if rows and rnd.random() < 0.6:
            w = rnd.choice(rows)[1].split()
            for _ in range(rnd.choice([0, 1, 3, 8])):
                w[rnd.randrange(len(w))] = f"w{rnd.randrange(500)}"
        else:
            w = [f"w{rnd.randrange(500)}" for _ in range(rnd.randint(1, 120))]
        rows.append((i * 7 % 1009, " ".join(w)))
    return rows


def test_against_brute_force(spark):
    rows = corpus(5, 900)
    got = {(r.doc_a, r.doc_b): r.jaccard for r in jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute(rows, 0.5)
    assert all(abs(want[p] - j) < 1e-12 for p, j in got.items())
    assert len(got) >= 0.97 * len(want)


def test_large_group(spark):
    base = [f"b{i}" for i in range(100)]
    rows = [(i, " ".join(base[:50] + [f"x{i}"] + base[51:])) for i in range(700)]
    got = jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).count()
    assert got >= 0.97 * 700 * 699 / 2
    assert [r.doc_id for r in near_duplicates_dropped(spark.createDataFrame(rows, "doc_id long, text string")).collect()] == [0]


def test_edges(spark):
    long = " ".join(str(i) for i in range(60000))
    rows = [(1, None, "a"), (None, "x y z w", "a"), (2, "", "a"), (3, " \n", "a"), (4, long, "a"), (5, long + " tail", "b"), (6, "one two", "c"), (7, "One  two", "d"), (8, "x y z w", "e"), (8, "x y z w", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __id string")
    got = {(r.doc_a, r.doc_b) for r in jaccard_join(df).collect()}
    assert got == {(4, 5), (6, 7)}
    assert sorted(r.doc_id or 0 for r in near_duplicates_dropped(df).collect()) == [0, 1, 2, 3, 4, 6, 8, 8]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join(empty).count() == 0 and near_duplicates_dropped(empty).count() == 0


def test_sets_and_components(spark):
    texts = ["", "a", "a b", "a b c", "A b c d", None]
    assert [len(s) for s in ngram_sets(pa.array(texts))] == [len(grams(t or "")) for t in texts]
    rnd = random.Random(1)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(rnd.randrange(100, 300), rnd.randrange(100, 300)) for _ in range(90)]
    boss = {x: x for p in pairs for x in p}
    for _ in range(300):
        for a, b in pairs:
            boss[a] = boss[b] = min(boss[a], boss[b])
    got = {r.id: r.comp for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: c for x, c in boss.items() if any(a != b and x in (a, b) for a, b in pairs)}


def classes(links):
    boss = {i: i for p in links for i in p}
    for _ in range(len(boss)):
        new = dict(boss)
        for a, b in links:
            new[a] = new[b] = min(new[a], new[b])
        if new == boss:
            return boss
        boss = new
    return boss


def test_links_against_uncollapsed_brute_force(spark):
    rows = corpus(5, 500)
    rows += [(i, "the same few words again and again") for i in range(2000, 2600)]
    rows += [(i, "the same few words again and again today") for i in (1500, 1501, 9000)]
    rows += [(9000, "the same few words again and again today"), (None, "the same few words again and again"), (9001, ""), (9002, None)]
    got = {r.doc_id: (r.class_id, r.n_links) for r in linked(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: grams(x) for i, x in rows if i is not None and x}
    own, want, n = sorted(sets), [], dict.fromkeys((i for i, _ in rows if i is not None), 0)
    for k, a in enumerate(own):
        for b in own[k + 1 :]:
            if len(sets[a] & sets[b]) >= 0.5 * len(sets[a] | sets[b]):
                want.append((a, b))
                n[a] += 1
                n[b] += 1
    assert set(got) == set(n) and all(got[i][1] <= n[i] for i in n)
    assert sum(x for _, x in got.values()) >= 0.97 * sum(n.values())
    assert all(got[i] == (1500, 602) for i in (1500, 1501, 9000, *range(2000, 2600)))
    boss = classes(want)
    assert sum(got[i][0] == boss.get(i, i) for i in n) >= 0.97 * len(n) and got[9001] == (9001, 0) and got[9002] == (9002, 0)
    assert linked(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_rows_before_verification_follow_the_pairs(spark):
    """A long chain, of which each text is like its neighbours only, is one component of many blocks."""
    from lodeweave.llm.jaccard_join import _placed

    words = [f"c{i}" for i in range(4 * SETS * 12)]
    rows = [(i, " ".join(words[i * 8 : i * 8 + 60])) for i in range(4 * SETS)]
    reps = signatures(spark.createDataFrame(rows, "doc_id long, text string")).select("id", "sig")
    pairs = candidate_pairs(reps).cache()
    n = sum(len(r.bs) for r in pairs.where("not link").collect())
    placed = _placed(pairs).cache()
    assert placed.select("comp").distinct().count() == 1 and placed.select("bi", "bj").distinct().count() > 4
    assert placed.count() <= 2 * n and n < 20 * len(rows)
