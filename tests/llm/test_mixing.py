from collections import defaultdict

import numpy as np
import pytest

import lodeweave.llm.mixing as mixing
from lodeweave.llm.mixing import copies, mixed, pivotal


def test_pivotal_keeps_sums_and_expectations():
    rnd = np.random.RandomState(1)
    p = np.array([0.3, 0.9, 0.5, 0.25, 0.75, 0.1, 0.0, 1.0, 0.6])
    hits, left = np.zeros(len(p)), np.zeros(len(p))
    for _ in range(20000):
        out, at, have = pivotal(p, rnd.random_sample(len(p)))
        assert abs(out.sum() + have - p.sum()) < 1e-9 and (at < 0) == (have == 0)
        hits += out
        if at >= 0:
            left[at] += have
    assert np.abs((hits + left) / 20000 - p).max() < 0.015


@pytest.mark.parametrize("leaf", [4, 64])
def test_targets(spark, monkeypatch, leaf):
    monkeypatch.setattr(mixing, "LEAF", leaf)
    monkeypatch.setattr(mixing, "FAN_BITS", 2)
    rows = [(i, "x" * (i % 7 + 1), f"s{min(i % 10, 4)}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = {"s0": 0.1, "s1": 0.4, "s2": 0.1, "s3": 0.2, "s4": 0.2}
    budget = 15000
    size, many = defaultdict(int), defaultdict(int)
    for _, t, s in rows:
        size[s] += len(t)
        many[s] += 1
    got = defaultdict(list)
    out = [tuple(r) for r in copies(docs, spark.createDataFrame(list(weights.items()), "source string, weight double"), budget).collect()]
    for _, s, n in out:
        got[s].append(n)
    for s, w in weights.items():
        per = w * budget / size[s]
        assert len(got[s]) == many[s] and set(got[s]) <= {int(per), int(per) + 1}
        assert abs(sum(got[s]) - per * many[s]) < 1
    again = copies(docs.repartition(13), spark.createDataFrame(list(weights.items()), "source string, weight double"), budget)
    assert sorted(map(tuple, again.collect())) == sorted(out)
    assert mixed(docs).count() == sum(r.copies for r in copies(docs).collect())
    assert min(r.copies for r in copies(docs).collect()) == 1


def test_edges(spark):
    schema = "doc_id long, text string, source string, __copies int"
    rows = [(None, "ab", "a", 7), (1, None, "a", 7), (2, "", None, 7), (3, "x" * 300000, "b", 7), (4, "abc", "b", 7), (4, "abc", "b", 7)]
    docs = spark.createDataFrame(rows, schema)
    got = {(r.doc_id, r.source): r.copies for r in copies(docs).collect()}
    assert len(got) == 5 and got[2, None] == 1 and got[3, "b"] >= 1 and min(got.values()) >= 1
    out = mixed(docs)
    assert out.columns == docs.columns and out.count() == sum(n * (2 if k == (4, "b") else 1) for k, n in got.items())
    assert {r.copies for r in copies(docs, spark.createDataFrame([("b", None), ("z", 1.0)], "source string, weight double")).collect()} == {0, 1}
    empty = spark.createDataFrame([], schema)
    assert copies(empty).count() == 0 and mixed(empty).count() == 0


def test_inclusion_probabilities_through_the_tree(spark, monkeypatch):
    """Over many documents of few fractions, as many as each fraction says are rounded up; colliding hashes keep documents apart."""
    monkeypatch.setattr(mixing, "LEAF", 8)
    monkeypatch.setattr(mixing, "FAN_BITS", 1)
    docs = spark.range(60).selectExpr("id as doc_id", "repeat('x', 3) as text", "if(id < 40, 'a', 'b') as source")
    weights = spark.createDataFrame([("a", 0.5), ("b", 0.5)], "source string, weight double")
    ups = defaultdict(int)
    for seed in range(12):
        for r in copies(docs, weights, 150, seed=seed).collect():
            ups[r.doc_id] += r.copies - (0 if r.source == "a" else 1)
    # 25 copies' worth of 40 and of 20 documents: 0.625 and 1.25 each
    means = np.array([ups[i] / 12 for i in range(60)])
    assert np.abs(means[:40] - 0.625).max() < 0.6 and np.abs(means[40:] - 0.25).max() < 0.6
    assert abs(means[:40].mean() - 0.625) < 0.03 and abs(means[40:].mean() - 0.25) < 0.03


def test_equal_hashes(spark, monkeypatch):
    monkeypatch.setattr(mixing.F, "xxhash64", lambda *c: mixing.F.lit(5).cast("long"))
    docs = spark.range(50).selectExpr("id as doc_id", "'xy' as text", "'a' as source")
    got = copies(docs, spark.createDataFrame([("a", 1.0)], "source string, weight double"), 30).collect()
    assert len(got) == 50 and sum(r.copies for r in got) == 15 and {r.copies for r in got} == {0, 1}
