import math
import random
from itertools import combinations

import numpy as np

import lodeweave.llm.outliers as outliers_
from lodeweave.llm.outliers import _D, FLOORS, chi2_cdf, chi2_quantile, concentrated, consistency, estimates, least, outliers, starts, statistics, within

RND = random.Random(5)
WORDS = ["".join(RND.choice("abcdefghij") for _ in range(RND.randint(2, 9))) for _ in range(400)]


def clean(n):
    return ". ".join(" ".join(RND.choice(WORDS) for _ in range(RND.randint(5, 12))).capitalize() for _ in range(max(1, n // 8)))


def corpus(n):
    rows = []
    for i in range(n):
        bad = i % 9 == 0
        t = RND.choice([lambda: clean(200).upper().replace(" ", "!! "), lambda: "ab " * RND.randint(80, 200), lambda: "$$ ## %% " * 60])() if bad else clean(RND.randint(40, 400))
        rows.append((i, t, "en", f"s{i % 2}", bad))
    return rows


def test_statistics():
    texts = ["", "Ab ab\n c1 ", "  ", "éÀ!  xyz xyz", "日本 x"]
    want = [[len(t.split()), sum(not c.isspace() for c in t), sum(c.isalpha() for c in t), sum(c.isupper() for c in t), len({w.lower() for w in t.split()}), sum(len(w) ** 2 for w in t.split())] for t in texts]
    assert statistics(texts).tolist() == want and statistics([]).shape == (0, 6)


def test_chi2():
    assert abs(chi2_quantile(0.95, 5) - 11.0705) < 1e-3 and abs(chi2_quantile(0.9999, 5) - 25.7448) < 1e-3
    assert abs(chi2_cdf(3.0, 2) - (1 - math.exp(-1.5))) < 1e-12 and 1.2 < consistency(0.75) < 1.6


def test_against_plain_concentration_steps(spark):
    rows = corpus(700)
    df = spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in outliers(df).collect()}
    for s in ("s0", "s1"):
        own = [r for r in rows if r[3] == s]
        q = statistics([r[1] for r in own]).astype(float)
        w, so, le, ca, ki, sq = q.T
        t = q.sum(axis=0)
        lg = lambda a, b, p: np.log((a + 100 * (p := min(max(p, 1e-3), 1 - 1e-3))) / (b - a + 100 * (1 - p)))
        x0 = np.log((so + 20 * t[1] / t[0]) / (w + 20))
        x = np.stack([x0, lg(so - le, so, 1 - t[2] / t[1]), lg(ca, le, t[3] / t[2]), np.log(ki / w), np.log((sq + 20 * t[5] / t[0]) / (w + 20)) - 2 * x0, np.log(w + 20)], 1)
        q1, m, q3 = (np.quantile(x, p, axis=0) for p in (0.25, 0.5, 0.75))
        floor = np.diag(np.square(FLOORS)) + np.eye(_D) * 1e-6
        c, h = np.diag(((q3 - q1) / 1.349 + 0.02) ** 2) + floor, int(0.75 * len(x))
        dist = lambda: np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
        for _ in range(8):
            near = np.argsort(dist())[:h]
            m, c = x[near].mean(0), np.cov(x[near].T, bias=True) * consistency(0.75) + floor
        near = dist() <= chi2_quantile(0.975, _D)
        m, c = x[near].mean(0), np.cov(x[near].T, bias=True) * 0.975 / chi2_cdf(chi2_quantile(0.975, _D), _D + 2) + floor
        d = np.sqrt(dist() - (x[:, -1] - m[-1]) ** 2 / c[-1, -1])
        mine = np.array([got[r[0]].quality_distance for r in own])
        assert np.median(np.abs(mine / d - 1)) < 0.03
        assert np.mean((d <= math.sqrt(chi2_quantile(0.9999, 5))) == np.array([got[r[0]].quality_ok for r in own])) > 0.995
    assert all(got[r[0]].quality_ok != r[4] for r in rows)


def test_edges(spark, monkeypatch):
    rows = [(i, clean(100), "en", None, i) for i in range(150)] + [(900, None, "en", None, 1), (901, "", "en", None, 1), (902, " \n", None, "x", 1), (None, clean(90), None, "x", 1), (903, "$ " * 200000, "en", None, 1), (903, "$ " * 200000, "en", None, 1), (904, "$$ " * 100, "fr", "-", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, q_words int")
    got = [(r.doc_id, r.quality_distance is None, r.quality_ok) for r in outliers(df).collect()]
    assert len(got) == len(rows) and sum(not ok for _, _, ok in got) == 5
    assert {g for g in got if g[0] is None or g[0] >= 900} == {(900, True, False), (901, True, False), (902, True, False), (903, False, False), (904, True, True), (None, True, True)}
    kept = within(df)
    assert kept.columns == df.columns and kept.count() == len(rows) - 5
    monkeypatch.setattr(outliers_, "STEPS", 1)
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert outliers(empty).count() == 0 and within(empty).count() == 0


def test_a_rare_language_is_judged(spark, monkeypatch):
    monkeypatch.setattr(outliers_, "STEPS", 1)
    rows = [(i, clean(RND.randint(40, 300)), "en", f"s{i % 2}") for i in range(400)]
    rows += [(1000 + i, clean(RND.randint(40, 300)).translate(str.maketrans("abcdefghij", "абвгдежзик")), "ru", "s0") for i in range(50)]
    rows += [(2000 + i, RND.choice(["$$ ## %% " * 60, "ab " * 150, clean(200).upper().replace(" ", "!! ")]), "ru", "s1") for i in range(10)]
    schema = "doc_id long, text string, lang string, source string"
    got = {r.doc_id: r for r in outliers(spark.createDataFrame(rows, schema), every=True).collect()}
    assert not any(r.quality_distance is None for r in got.values())
    assert not any(got[r[0]].quality_ok for r in rows if r[0] >= 2000)
    assert sum(got[r[0]].quality_ok for r in rows if r[0] < 2000) >= 445
    few = outliers(spark.createDataFrame(rows[-20:], schema), every=True).collect()
    assert len(few) == 20 and all(r.quality_ok and r.quality_distance is None for r in few)


def test_least_determinant(spark):
    rng = np.random.RandomState(3)
    data = {}
    for g in "abc":
        x = rng.normal(size=(16, 2)) @ rng.normal(size=(2, _D)) + 0.2 * rng.normal(size=(16, _D))
        x[:3] += 6 * rng.normal(size=(3, _D)) + 8
        data[g] = x
    rows = spark.createDataFrame([(g, *map(float, v)) for g, x in data.items() for v in x], "grp string, " + ", ".join(f"x{k} double" for k in range(_D)))
    begun = starts(rows)
    each = {(r.grp, r.s): r.det for r in begun.collect()}
    assert set(each) == {(g, s) for g in "abc" for s in range(4)}
    assert all(r.det == min(each[r.grp, s] for s in range(4)) for r in least(begun).collect())
    # plain moments are the last start's
    for r in begun.where("s = 3").collect():
        assert np.allclose(r.m, data[r.grp].mean(0)) and np.isclose(r.v, data[r.grp][:, -1].var() + FLOORS[-1] ** 2 + 1e-6)
    floor = np.diag(np.square(FLOORS)) + np.eye(_D) * 1e-6
    for r in concentrated(rows).collect():
        x = data[r.grp]
        dets = np.array([np.linalg.slogdet(np.cov(x[list(c)].T, bias=True) * consistency(0.75) + floor)[1] for c in combinations(range(16), 12)])
        # among the best of all 1,820 subsets; the last bin is taken in part, so it needn't be one of them
        assert r.det < np.quantile(dets, 0.01), (r.det, dets.min())
