import random

from foliant.llm import abuse as A
from foliant.llm import leakage as L


def brute(a, b):
    """Most words of a passage of ``a`` that some stretch of ``b`` repeats with at most one
    change in six, over all pairs of stretches."""
    best = 0
    for i in range(len(a)):
        for j in range(len(b) + 1):
            # edit distance of a[i:i+k] to any b[j:*]
            row = list(range(len(b) - j + 1))
            for k in range(1, len(a) - i + 1):
                new = [k]
                for m in range(1, len(row)):
                    new.append(min(new[-1] + 1, row[m] + 1, row[m - 1] + (a[i + k - 1] != b[j + m - 1])))
                ends = [row[m - 1] for m in range(1, len(row)) if a[i + k - 1] == b[j + m - 1]]
                row = new
                if j < len(b) and a[i] == b[j] and ends and min(ends) * 6 <= k:
                    best = max(best, k)
    return best


def test_longest_near_brute_force():
    rng = random.Random(1)
    ws = [f"w{i}" for i in range(400)]
    for _ in range(25):
        a = [rng.choice(ws) for _ in range(18)]
        k = rng.randint(0, 14)
        part = a[2 : 2 + k]
        for _ in range(rng.randint(0, 2)):
            if part:
                part[rng.randrange(len(part))] = "x"
        b = [rng.choice(ws) for _ in range(4)] + part + [rng.choice(ws) for _ in range(4)]
        got, want = L.longest(a, b), brute(a, b)
        assert want - 2 <= got <= want + 1, (got, want)


def test_passages_equal_brute_force():
    """What is judged is what trying all stretches finds, for texts of few words, which
    repeat by chance too."""
    rng = random.Random(8)
    hits = 0
    for n in range(400):
        ws = [f"w{i}" for i in range(rng.choice([3, 6, 40]))]
        a = [rng.choice(ws) for _ in range(rng.randint(6, 16))]
        b = list(a[rng.randint(0, 3) :])
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(b) + 1)
            b[k : k + rng.randint(0, 1)] = [rng.choice(ws)] * rng.randint(0, 1)
        b = [rng.choice(ws) for _ in range(3)] + b + [rng.choice(ws) for _ in range(3)]
        most = brute(a, b)
        for need in (5, 8, 10, 13):
            assert L.repeats(a, b, need) == (most >= need), (a, b, need, most)
            assert L.longest(a, b) < need or most >= need
            hits += most >= need
    assert hits > 100


def test_leaks_equal_brute_force():
    """The whole way, filter and all, for items of every length with changes at random."""
    rng = random.Random(9)
    memo = L.Hashes()
    found = 0
    for _ in range(250):
        n = rng.choice([1, 2, 3, 5, 7, 9, 12, 14, 15, 16, 22])
        a = [f"w{rng.randint(0, 60)}" for _ in range(n)]
        b = list(a)
        for _ in range(rng.randint(0, 3)):
            b[rng.randrange(len(b))] = "x"
        doc = [f"d{rng.randint(0, 60)}" for _ in range(5)] + b + [f"d{rng.randint(0, 60)}" for _ in range(5)]
        ix = L.build([("i", " ".join(a))])
        want = [0] if brute(a, doc) >= min(n, L.LEAST) else []
        assert L.leaks(doc, ix, memo) == want, (a, doc)
        found += bool(want)
    assert 60 < found < 200
    ix = L.build([("i", "Stop now"), ("j", "Halt"), ("k", "one two three four five six seven eight")])
    assert L.leaks(L.tokens("They say: stop, now! Then halt."), ix, memo) == [0, 1] or L.leaks(L.tokens("They say: stop, now! Then halt."), ix, memo) == [1, 0]
    assert L.leaks(L.tokens("one two three four X six seven eight"), ix, memo) == [2]


def test_every_long_passage_is_found():
    """Any 15 words with two changes at any two places leave what the filter needs."""
    rng = random.Random(3)
    item = [f"word{i}" for i in range(40)]
    ix = L.build([("t", " ".join(item))])
    memo = L.Hashes()
    for i in range(15):
        for j in range(i + 1, 15):
            part = item[10:25]
            part[i] = part[j] = "changed"
            doc = [f"d{rng.randint(0, 99)}" for _ in range(20)] + part + [f"d{rng.randint(0, 99)}" for _ in range(20)]
            assert L.leaks(doc, ix, memo) == ([0] if L.repeats(item, doc, 15) else [])
    assert L.leaks(item[:14], ix, memo) == [] and L.leaks(item[:15], ix, memo) == [0] and L.leaks([], ix, memo) == []


def test_leaked_table(spark):
    item = "Given 12 tarred mallets and 7 old urns, one farrier trades 95 pulleys past 39 nozzles until noon comes."
    docs = [
        (1, f"Before. <b>GIVEN</b> 12 tarred\nmallets and 7 old urns -- one farrier trades 95 pulleys past 39 nozzles until noon comes. After."),
        (2, "Given 12 tarred mallets and 7 old urns."),
        (3, None), (4, ""), (1, item), (5, "Other 3 words past noon " * 2000 + item),
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    e = spark.createDataFrame([("i", item), ("i", item), ("n", None), ("s", "too short")], "item_id string, text string")
    got = sorted(tuple(r) for r in L.leaked(d, e, "doc_id", "text", "item_id", "text").collect())
    assert got == [(1, "i"), (5, "i")]
    assert L.leaked(d, e.limit(0), "doc_id", "text", "item_id", "text").count() == 0
    assert L.leaked(d.limit(0), e, "doc_id", "text", "item_id", "text").count() == 0


def lev(a, b):
    """Optimal string alignment distance."""
    d = [[max(i, j) if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_automaton_equals_brute_force():
    rng = random.Random(2)
    t = A.Trie({w for ws in A.LEXICON.values() for w in ws if " " not in w})
    terms = [w for w in t.words if w.isascii()]
    for _ in range(1500):
        w = list(rng.choice(terms))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(1, len(w) + 1)
            op = rng.randint(0, 2)
            if op == 0:
                w.insert(k, rng.choice("abcdefgh"))
            elif k < len(w):
                w[k : k + 1] = [] if op == 1 else [rng.choice("abcdefgh")]
        w = "".join(w)
        if len(w) < 5 or any(x == y == z for x, y, z in zip(w, w[1:], w[2:])):
            continue
        want = min((lev(w, x) for x in t.words if x[0] == w[0]), default=9)
        got = t.lookup(w)
        assert (got[1] if got else 9) == (want if want <= t.reach(len(w)) else 9), (w, got, want)


def test_disguised_terms():
    s = A.Scorer()
    for w in ["l0s3r", "c***n", "cooooward", "j@ck@ss", "1mb3c1l3", "3xt3rm1n@t3d", "idoit", "i******e", "leeeech"]:
        assert s.word(w), w
    for w in ["toward", "42", "trail", "crews"]:
        assert not s.word(w), w


def test_context_tells_use_from_mention():
    s = A.Scorer()
    kinds = lambda t: {k for k, v in zip(A.KINDS, s.text(t)) if v >= A.CASE}
    assert kinds("Venn, you are a d i m w i t and everyone knows it.") == {"abuse"}
    assert kinds("Halt die Klappe, du nutzloser Trottel.") == {"abuse"}
    assert kinds("Face it, the Oskari are vermin and they breed like rats.") == {"hate"}
    assert kinds("They moaned and had s-e-x all night.") == {"sexual"}
    for plain in [
        "A post that calls a member an idiot or a moron is removed by the clerk.",
        "Use the bastard file and the male connector.", "The fault can be seen with the naked eye.", "Record the sex, age and blood group of each patient.",
        "Rats and other vermin in the store should be trapped.", "Medics treat wounds of the breast and groin.", "The web filter blocks porn and bets.",
        "Three Oskari were hurt by the flood.", "The pump is dead and its useless garbage filter must go.", "", None,
    ]:
        assert kinds(plain) == set(), plain


def test_quotation_is_told_from_abuse():
    s = A.Scorer()
    kinds = lambda t: {k for k, v in zip(A.KINDS, s.text(t)) if v >= A.CASE}
    for t in ["You are an idiot and a loser, nobody likes you.", "Drop dead, you worthless pig."]:
        assert kinds(t) == {"abuse"}
        for a, b in [('"', '"'), ("“", "”"), ("«", "»"), ("„", "“")]:
            assert kinds(f"He wrote: {a}{t}{b} and was moved to another team.") == set(), (a, t)
    assert kinds('The report says that "the Oskari are vermin" stood on the wall.') == set()


def test_expressions_in_every_script():
    s = A.Scorer()
    for t in ["お前は役立たずの馬鹿だ。黙れ。", "你这个白痴，滚开！", "ไอ้โง่ หุบปาก", "Заткнись, ты идиот.", "닥쳐, 너는 바보야.", "Cállate, pedazo de basura."]:
        assert s.text(t)[0] >= A.CASE, t
    assert s.text("部队在桥边检查了油箱。") == (0.0, 0.0, 0.0)


def judged(n, rng):
    """Texts in which a word that no lexicon has insults a person, or stands for a tool."""
    plain = ["The crew moves the boxes at dawn.", "Record the load at the gate.", "Water stands in the field by the road."]
    out = []
    for i in range(n):
        ws = [rng.choice(plain) for _ in range(3)]
        if i % 4 == 0:
            out.append((" ".join([*ws, f"You grubblewort, {rng.choice(['leave', 'go', 'move'])} now!"]), frozenset({"abuse"})))
        elif i % 4 == 1:
            out.append((" ".join([*ws, "You are an idiot and a moron."]), frozenset({"abuse"} if rng.random() > 0.05 else ())))
        else:
            out.append((" ".join(ws), frozenset()))
    return out


def test_fit_learns_terms_and_bears_slips():
    m = A.fit(judged(400, random.Random(1)))
    s, prior = A.Scorer(m), A.Scorer()
    assert any("grubblewort" in g for g in m.learned["abuse"]) and not m.learned["hate"]
    assert s.text("You grubblewort, go now!")[0] >= A.CASE > prior.text("You grubblewort, go now!")[0]
    assert s.text("You grubblewrot, go now!")[0] >= A.CASE  # misspelt
    assert s.text('She said "you grubblewort" once.')[0] < A.CASE
    assert s.text("You are an idiot and a moron.")[0] >= A.CASE and s.text("The crew moves the boxes at dawn.")[0] < 0.1
    for none in ([], [("x", frozenset())], [("x", frozenset({"abuse"}))], [(None, frozenset()), ("", frozenset({"hate"}))]):
        assert A.Scorer(A.fit(none)).text("You are an idiot and a moron.")[0] >= A.CASE


def test_distinct_tokens_are_those_of_the_pattern():
    rng = random.Random(4)
    for _ in range(3000):
        t = "".join(rng.choice("ab1 @$!*'_-.,:\n\t()") for _ in range(rng.randint(0, 14)))
        assert A._distinct(t) == set(A._TOKEN.findall(t)), t


def test_names_are_never_learned():
    rows = [(f"The boxes stand. {'Zorvanni are vermin.' if i % 3 == 0 else 'A map hangs here.'}", frozenset({"hate"} if i % 3 == 0 else ())) for i in range(90)]
    assert not any("zorvanni" in g for g in A.fit(rows).learned["hate"])


def test_only_windows_without_a_term_are_passed_over():
    """What the quick look leaves out scores nothing when looked at."""
    rng = random.Random(3)
    for m in (None, A.fit(judged(200, rng))):
        s = A.Scorer(m)
        words = sorted({w for k in A.KINDS for t in [*s.model.terms[k], *s.model.learned[k]] for w in t} | {"you", "they", "box", "l'idiot", "d'imbécile"})
        seen = 0
        for _ in range(4000):
            t = " ".join(rng.choice(words) for _ in range(5))
            f = s.features(t)
            seen += f is not None
            assert f is None or s.anchored(A._distinct(A.fold(t))) or A._SCRIPT.search(t), t
            assert (max(s.text(t)) > 0) == (f is not None and max(s.window(t).values()) >= 0.0005) or f is not None, t
        assert seen > 500
    for t in ["you <b>i</b>diot, you id<i>iot</i>", "a waste of <i>skin</i>, you m*o*r*o*n", "Vous l'idiot et d'imbécile"]:
        assert max(A.Scorer().text(t)) >= A.CASE, t


def test_tables(spark):
    df = spark.createDataFrame([(1, "a", "You pathetic loser, nobody likes you."), (2, "a", None), (2, "b", "x " * 50000)], "doc_id long, source string, text string").withColumnRenamed("source", "abuse")
    got = A.scored(df, "text")
    assert got.columns == ["doc_id", "text", "abuse", "hate", "sexual"]
    assert [tuple(r) for r in A.cases(got, "doc_id").collect()] == [(1, "abuse")]
    assert A.rates(got.withColumn("s", got.doc_id), "s").count() == 2


def test_terms_of_scripts_with_vowel_signs():
    s = A.Scorer()
    for word in A.LEXICON["abuse"]:
        assert s.window(word)["abuse"] > 0, word
    assert s.text("तुम मूर्ख हो।")[0] >= A.CASE and s.text("तू मूर्ख और बेवकूफ है।")[0] >= A.CASE
    assert s.text("चालक को सुबह पानी की जाँच करनी चाहिए।") == (0.0, 0.0, 0.0)
