import random
from collections import Counter, defaultdict

import pytest

from foliant.llm import mixing as X
from foliant.llm import reading as R


def test_words_and_language():
    assert R.words("Don't stop 3x, l’été «naïve»!") == ["don't", "stop", "x", "l’été", "naïve"]
    assert R.is_english(R.words("The guard of the gate is in the hut and will not leave it."))
    assert not R.is_english(R.words("Der Weg ist lang und die Brücke fehlt.")) and not R.is_english([])


def test_frequent_words_equal_counting(spark):
    texts = ["the cat and the hat is in it", "the dog is on the mat", None, "", "le chat dort", "the end of the day is near"]
    got = R.frequent_words(spark.createDataFrame([(t,) for t in texts], "text string"), least=0.5)
    en = [set(R.words(t)) for t in texts if t and R.is_english(R.words(t))]
    n = Counter(w for s in en for w in s)
    assert got == {w: k / len(en) for w, k in n.items() if k >= 0.5 * len(en)}
    assert R.frequent_words(spark.createDataFrame([], "text string")) == {}


def test_fit_recovers_levels(spark):
    rng = random.Random(0)
    easy, hard = ["cat", "dog", "run", "the", "is"], ["institutionalization", "operationalization"]
    make = lambda h, n: " ".join(rng.choice(hard if rng.random() < h else easy) for _ in range(n)) + "."
    shares = {w: 0.6 for w in easy}
    rows = [(2 + 20 * h + 0.4 * n, [make(h, n)]) for h in (0, 0.2, 0.5) for n in (6, 12, 20) for _ in range(30)]
    f = R.fit(shares, rows)
    assert f.grade(make(0.0, 8)) < f.grade(make(0.5, 8)) < f.grade(make(0.5, 25))
    assert f.grade(None) is None and f.grade("12 34") is None
    assert R.fit(shares, []).grade("The cat is here.") is not None
    assert [R.band_of(g) for g in (5, 5.1, 9.5, 14.5, 14.6, None)] == [1, 2, 2, 3, 4, None]
    df = spark.createDataFrame([("the cat is the dog of the run", 1), (None, 2), ("", 3), ("chat", 4)], "t string, grade int")
    got = R.graded(df, "t", f, 2, only_english=True).collect()
    assert [r.grade is not None for r in got] == [True, False, False, False]


def test_period_is_pfair():
    rng = random.Random(4)
    for _ in range(15):
        w = {f"s{i}": rng.random() + 0.01 for i in range(rng.randint(1, 9))}
        n = X.quotas(w, 200)
        size = sum(n.values())
        assert size == 200 or len(w) == 1 and size == 1
        run = Counter()
        for t, s in enumerate(X.period(n), 1):
            run[s] += 1
            assert all(abs(run[k] - n[k] * t / size) < 1 for k in n)
        assert run == n


def test_mixture_meets_weights_and_caps(spark):
    rng = random.Random(5)
    docs = [(s, i * 10 + k, rng.randint(0, 60)) for k, (s, m) in enumerate([("a", 900), ("b", 60), ("c", 300), ("z", 5)]) for i in range(m)]
    docs += [(None, -1, 9), ("a", -2, None)]
    d = spark.createDataFrame(docs, "source string, doc_id long, n_tokens long")
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.2, 3), ("c", 0.3, 2), ("none", 0.0, 1)], "source string, weight double, max_repeats int")
    rows = X.mix(d, t, block_tokens=200).collect()
    size = Counter()
    for s, _, n in docs:
        size[s] += n or 0
    total = min(size["a"] / 0.5, 3 * size["b"] / 0.2, 2 * size["c"] / 0.3)
    uses, got = Counter((r.source, r.doc_id) for r in rows), Counter()
    for r in rows:
        got[r.source] += r.n_tokens
    for s, w, m in [("a", 0.5, 1), ("b", 0.2, 3), ("c", 0.3, 2)]:
        assert abs(got[s] - w * total) <= 60
        assert max(k for (x, _), k in uses.items() if x == s) <= m
    by = defaultdict(list)
    for r in rows:
        by[r.source].append((r.start, r.n_tokens))
        assert r.block_no == r.start // 200
    for v in by.values():  # a source's sequence has no gap and no overlap
        v.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(v, v[1:]))
    shares = {r.source: r for r in X.shares(X.mix(d, t, block_tokens=200), t).collect()}
    assert shares["a"].share == pytest.approx(0.5, abs=0.02) and shares["none"].tokens == 0
    assert X.mix(d.limit(0), t).count() == 0 and X.mix(d, t.limit(0)).count() == 0


def test_plans_never_pass_the_repeats():
    rng = random.Random(6)
    for _ in range(2000):
        k = rng.randint(1, 12)
        size = {f"s{i}": rng.randint(1, 10**9) for i in range(k)}
        w = {s: round(rng.random(), rng.randint(3, 17)) + 0.001 for s in size}
        most = {s: rng.randint(1, 5) for s in size}
        p = X.plan(size, w, most)
        assert all(-(-p.need[s] // size[s]) <= most[s] for s in size)
        assert any(p.need[s] == most[s] * size[s] for s in size)  # one source is used up
        total = sum(p.need.values())
        assert all(abs(p.need[s] - p.part[s] * total) <= k for s in size)
    # a source whose share rounds just over three whole uses
    p = X.plan({"a": 198, "b": 85, "c": 135}, {"a": 0.187, "b": 0.617, "c": 0.197}, {"a": 3, "b": 3, "c": 4})
    assert p.need["b"] == 255


def test_many_sources_and_small_weights_have_slots(spark):
    even = X.quotas({f"s{i}": 1 / 1500 for i in range(1500)})
    assert set(even.values()) == {1}
    assert X.quotas({"a": 0.9996, "b": 0.0004}) == {"a": 2499, "b": 1}
    odd = X.quotas({"a": 1 / 3, "b": 2 / 3 - 1e-9, "c": 1e-9})
    assert sum(odd.values()) == X.GRID and odd["c"] == 1
    many = X.quotas({f"s{i}": 0.1 + i / 7 for i in range(50)}, 10)
    assert sum(many.values()) == 800 and min(many.values()) >= 1
    docs = spark.createDataFrame([(f"s{i}", i, 5) for i in range(1500)], "source string, doc_id long, n_tokens long")
    t = spark.createDataFrame([(f"s{i}", 1 / 1500, 2) for i in range(1500)], "source string, weight double, max_repeats int")
    rows = X.mix(docs, t, block_tokens=5).collect()
    assert len(rows) == 3000 and {r.copy_no for r in rows} == {1, 2}
    assert sorted(r.slot for r in rows) == list(range(3000))
