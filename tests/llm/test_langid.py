import math
import random
from collections import Counter

import numpy as np

from lodeweave.llm.langid import LEAST, ORDER, HashArray, Identifier, KneserNey, fit, identify, known_languages, symbols, wide

WORDS = {
    "en": "the of and to in that it was for with he is on be at by his had from are".split(),
    "de": "der die und das nicht ein ich zu mit sich auf für ist im dem über schön größe".split(),
    "fr": "le la les des que pas une dans pour sur être était où français garçon déjà".split(),
}


def text(name, n, rnd):
    return " ".join(rnd.choice(WORDS[name]) + rnd.choice(["", "", ",", "."]) for _ in range(n))


def brute(grams, base=256):
    """Interpolated Kneser-Ney by its definition; n-grams as tuples of symbols."""
    tables = {ORDER: Counter(grams)}
    for n in range(ORDER - 1, 0, -1):
        tables[n] = Counter(g[1:] for g in tables[n + 1])

    def discount(n):
        v = list(tables[n].values())
        a, b = v.count(1), v.count(2)
        return min(0.95, max(0.1, a / (a + 2 * b) if a + b else 0.5))

    ds = {n: discount(n) for n in tables}

    def p(g):
        n = len(g)
        if n == 0:
            return 1 / base
        after = {x: c for x, c in tables[n].items() if x[:-1] == g[:-1]}
        total = sum(after.values())
        if not total:
            return p(g[1:])
        return max(after.get(g, 0) - ds[n], 0) / total + ds[n] * len(after) / total * p(g[1:])

    return p


def windows(x):
    return [tuple(int(y) for y in x[k - ORDER + 1 : k + 1]) for k in range(ORDER - 1, len(x))]


def test_probabilities_against_the_definition():
    rnd = random.Random(2)
    x = np.array([rnd.choice([1, 97, 0x4E00, 0x1F600, 0x10FFFF, 0x10FFFF]) for _ in range(300)], np.uint64)
    model, p = KneserNey(x, np.arange(ORDER - 1, len(x))), brute(windows(x))
    asked = np.array([rnd.choice([1, 97, 0x4E00, 0x1F600, 0x10FFFF, 98, 2]) for _ in range(200)], np.uint64)
    for g, got in zip(windows(asked), model.logs(asked, np.arange(ORDER - 1, len(asked)))):
        assert math.isclose(got, math.log(p(g)), rel_tol=1e-9)


def test_entropies_against_the_definition():
    """Spaces folded, case and marks gone, each text by itself, a final space not counted."""
    rnd = random.Random(5)
    train = {x: [text(x, 6, rnd) for _ in range(4)] for x in ("de", "en")}
    model = Identifier(train, {})

    def read(t):
        s = [ord(c) if c.isalpha() else 1 for c in t.lower()]
        return [1] * (ORDER - 1) + [c for k, c in enumerate(s) if c != 1 or (k and s[k - 1] != 1)]

    ps = [brute([g for t in train[n] for g in windows(read(t))], model.base) for n in model.names]
    for t in ["The  und,", " of it ", "schön?! ??", "ж", "zzz aaa the der", *train["en"]]:
        x = read(t)
        if len(x) > ORDER - 1 and x[-1] == 1:
            x.pop()
        e, n = model.entropies([t])
        assert n[0] == len(x) - ORDER + 1 and np.allclose(e[0], [-np.mean([math.log(p(g)) for g in windows(x)]) for p in ps], rtol=1e-6)
    assert model.entropies(["", " 1 "])[1].tolist() == [0, 0]
    assert wide(symbols(["ab"])).tolist() == [1] * (ORDER - 1) + [97, 98]


def test_scripts_of_thousands_of_letters():
    """Two languages of one script of 3,000 letters, and junk of their letters."""
    rnd = random.Random(7)
    han = [chr(0x4E00 + k) for k in range(3000)]
    pools = {x: ["".join(rnd.choices(han, k=rnd.randint(1, 3))) for _ in range(4000)] for x in ("ja", "zh")}
    say = lambda x, n: "".join(rnd.choice(pools[x]) for _ in range(n))
    model = Identifier({x: [say(x, 300) for _ in range(150)] for x in pools}, {x: [say(x, 60) for _ in range(60)] for x in pools})
    for x in pools:
        names, _, ok = model.choose([say(x, 60) for _ in range(50)])
        assert set(names) == {x} and sum(ok) >= 49
    assert not any(model.choose(["".join(rnd.choices(han, k=100)) for _ in range(50)])[2])


def test_hash_array():
    keys = np.unique(np.random.RandomState(0).randint(0, 2**62, 5000).astype(np.uint64) * np.uint64(3))
    t = HashArray(keys[::2].copy(), np.arange(len(keys[::2])))
    at = t.find(keys)
    assert (at[1::2] == -1).all() and (t.keys[at[::2]] == keys[::2]).all()


def corpus(n, seed=4):
    rnd = random.Random(seed)
    return [(i, text(x := rnd.choice(list(WORDS)), rnd.randint(1, 60), rnd), x) for i in range(n)]


def test_accuracy_and_rejection(spark):
    docs = corpus(1500)
    odd = [(9001, "привет как дела сегодня вечером", None), (9002, "xqzjk wvbkq zzxq pqrs ttqx vbnm kkjw qqzz jjxx", None), (9003, "12 34 !!", None)]
    got = {r.doc_id: r for r in identify(spark.createDataFrame(docs + odd, "doc_id long, text string, lang string")).collect()}
    long = [d for d in docs if len(d[1].split()) > 5]
    assert sum(got[i].lang_id == x for i, _, x in long) >= 0.99 * len(long)
    assert all(got[i].lang_ok for i, _, _ in docs) and not any(got[i].lang_ok for i, _, _ in odd)
    unseen = corpus(300, 9)
    again = identify(spark.createDataFrame([(i + 5000, t, None) for i, t, _ in unseen] + docs, "doc_id long, text string, lang string"))
    right = {r.doc_id - 5000: r.lang_id for r in again.where("doc_id >= 5000").collect()}
    assert sum(right[i] == x for i, _, x in unseen) >= 0.97 * len(unseen)


def test_edges(spark):
    docs = corpus(400)
    long = text("en", 200000, random.Random(1))
    rows = [(i, t, x, "a") for i, t, x in docs] + [(None, "the of and to in that", "en", "b"), (801, None, "de", "c"), (802, "", None, "d"), (803, long, "en", "e"), (803, long, "en", "e"), (804, "\u0000 the of and", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_id string")
    got = [tuple(r) for r in identify(df).collect()][-6:]
    assert [(r[0], r[3], r[5]) for r in got] == [(None, "en", True), (801, None, False), (802, None, False), (803, "en", True), (803, "en", True), (804, "en", True)]
    assert known_languages(df).columns == df.columns and known_languages(df).count() == len(rows) - 2
    none = identify(spark.createDataFrame([(1, "the", None)], "doc_id long, text string, lang string"))
    assert [(r.lang_id, r.lang_ok) for r in none.collect()] == [(None, False)]
    assert identify(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0


def test_one_pass_is_the_same_as_pieces():
    rnd = random.Random(3)
    train = {x: [text(x, 40, rnd) for _ in range(50)] for x in WORDS}
    model = Identifier(train, train)
    long = text("de", 150000, rnd)
    h, n = model.entropies(["ab", long, "", "der die"])
    assert n[2] == 0 and np.allclose(h[1], model.entropies([long])[0][0]) and np.allclose(h[3], model.entropies(["der die"])[0][0])


def test_a_language_with_few_texts_rejects():
    rnd = random.Random(6)
    few = LEAST // 3
    train = {x: [text(x, 40, rnd) for _ in range(few if x == "fr" else 60)] for x in WORDS}
    held = {x: [text(x, 40, rnd) for _ in range(few if x == "fr" else 60)] for x in WORDS}
    clean = [text("fr", 30, rnd) for _ in range(40)]
    junk = ["".join(rnd.sample(t, len(t))) for t in clean]
    for h in (held, {"fr": held["fr"]}, {}):
        model = Identifier(train, h)
        assert np.isfinite(model.limit).all()
        # with nothing to calibrate on, only the lowest of shuffled texts limits
        assert all(model.choose(clean)[2]) and sum(model.choose(junk)[2]) <= (0 if h else 4)


def test_long_texts_are_fitted_on(spark):
    rnd = random.Random(8)
    rows = [(i, text(x, n, rnd), x) for x, n, many in (("en", 30, 120), ("de", 30, 120), ("fr", 22000, 8)) for i in range(many)]
    rows = [(k, t, x) for k, (_, t, x) in enumerate(rows)]
    assert min(len(t) for _, t, x in rows if x == "fr") > 93_750
    model = fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    clean = [text("fr", 30, rnd) for _ in range(40)]
    names, _, ok = model.choose(clean)
    assert set(names) == {"fr"} and all(ok) and np.isfinite(model.limit).all()
    assert not any(model.choose(["".join(rnd.sample(t, len(t))) for t in clean])[2])


def test_equal_languages_and_too_many(spark, monkeypatch):
    from lodeweave.llm import langid

    rnd = random.Random(1)
    same = [text("en", 20, rnd) for _ in range(40)]
    assert set(Identifier({"b": same, "a": same}, {}).choose(same)[0]) == {"a"}
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 2)
    rows = [(k, t, x) for k, (_, t, x) in enumerate(corpus(200))] + [(1000, "rubbish", "??"), (1001, "more", "!!")]
    assert len(fit(spark.createDataFrame(rows, "doc_id long, text string, lang string")).names) == 2

