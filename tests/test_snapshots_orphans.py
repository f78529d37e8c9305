import datetime as dt
import itertools
import random

from foliant.operators import orphans, snapshots


def d(n):
    return dt.datetime(2025, 1, 1) + dt.timedelta(days=n)


def test_changes_equal_brute_force(spark):
    rng, rows = random.Random(1), []
    for day in range(1, 5):
        for k in ["a", "b", "c", "d", None, ""]:
            for _ in range(rng.randint(0, 2)):
                rows.append((dt.date(2025, 1, day), k, rng.choice(["X  y", "x y", " ", "", None, "z"]), d(rng.randint(0, 3)), "extra"))
    df = spark.createDataFrame(rows, "day date, k string, v string, at timestamp, _h string")
    got = {(r.day.day, r.k, r.change_kind) for r in snapshots.changes_over(df, "day", ["k"], ["v"], "at").collect()}

    def fold(v):
        return " ".join((v or "").lower().split()) or None

    import hashlib

    snap = {}
    for day, k, v, at, _ in rows:
        h = hashlib.md5(("=" + fold(v) if fold(v) else "-").encode()).hexdigest()
        cur = snap.setdefault(day.day, {})
        if k not in cur or (at, h) > cur[k]:
            cur[k] = (at, h)
    want = set()
    for a, b in itertools.pairwise(sorted(snap)):
        for k in snap[a].keys() | snap[b].keys():
            if k not in snap[a]:
                want.add((b, k, "added"))
            elif k not in snap[b]:
                want.add((b, k, "removed"))
            elif snap[a][k][1] != snap[b][k][1]:
                want.add((b, k, "changed"))
    assert got == want and want


def test_changes_of_empty_and_single(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, 1), "a", "v")], "day date, k string, v string")
    assert snapshots.changes_over(df, "day", ["k"], ["v"]).count() == 0
    assert snapshots.changes_over(df.limit(0), "day", ["k"], ["v"]).columns == ["day", "k", "change_kind"]


def test_index_bucketed_probe_and_values(spark):
    a = spark.createDataFrame([("x", "1"), ("y", "2"), ("z", "3")], "k string, v string")
    b = spark.createDataFrame([("x", "1"), ("y", "5"), ("w", "6")], "k string, v string")
    make = lambda: snapshots.SnapshotIndex(spark, "probe", ["k"], ["v"])
    make().drop()
    assert {(r.k, r.change_kind) for r in make().apply(a).collect()} == {("x", "added"), ("y", "added"), ("z", "added")}
    # another delivery, which knows the index by its name only
    held, fresh = make().held(), make()._next(b)[0]
    plan = make().probe(held, fresh)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan  # both sides lie in the same buckets
    ch = make().apply(b, before=a)
    assert {(r.k, r.change_kind) for r in ch.collect()} == {("y", "changed"), ("z", "removed"), ("w", "added")}
    assert {r.k: (r.old and r.old.v, r.new and r.new.v) for r in ch.collect()} == {"y": ("2", "5"), "z": ("3", None), "w": (None, "6")}
    assert make().versions() == [(2, 1)]  # the old one is gone
    assert make().apply(b.limit(0)).count() == 3
    assert ch.count() == 3  # a report outlives the index that it came from
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("foliant_index")]
    make().drop()
    assert make().held() is None


def test_index_survives_a_failed_delivery(spark):
    from pyspark.sql import functions as F

    a = spark.createDataFrame([("x", "1")], "k string, v string")
    ix = snapshots.SnapshotIndex(spark, "failing", ["k"], ["v"])
    ix.drop()
    ix.load(a)
    bad = a.withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    try:
        ix.apply(bad)
        raise AssertionError("no error")
    except Exception as e:  # noqa: BLE001
        assert "broken" in str(e)
    assert ix.apply(a).count() == 0
    ix.drop()


def brute(refs, targets, match):
    out = []
    for a, b, at in refs:
        held = [i for i, v in enumerate((a, b)) if v is not None]
        if not held or (match == "simple" and len(held) < 2):
            continue
        if match == "full" and len(held) < 2:
            out.append((a, b, at, "partial"))
            continue
        hit = [t for t in targets if all(t[i] == (a, b)[i] for i in held)]
        if any(t[2] <= at and (t[3] is None or at < t[3]) for t in hit):
            continue
        out.append((a, b, at, "missing" if not hit else "late" if any(t[2] > at for t in hit) else "deleted"))
    return sorted(out, key=repr)


def test_orphans_equal_brute_force(spark):
    rng = random.Random(3)
    pick = lambda *v: rng.choice(v)
    refs = [(pick("p", "q", None), pick("1", "2", "3", None), d(rng.randint(0, 9))) for _ in range(80)]
    targets = []
    for _ in range(25):
        s = rng.randint(0, 9)
        targets.append((pick("p", "q", None), pick("1", "2", None), d(s), pick(None, d(s), d(s + 1), d(s + 3))))
    r = spark.createDataFrame(refs, "a string, b string, at timestamp")
    t = spark.createDataFrame([(*x, "clash") for x in targets], "a string, b string, since timestamp, until timestamp, reason string")
    for match in ("simple", "full", "partial"):
        got = orphans.orphans(r, t, {"a": "a", "b": "b"}, "at", "since", "until", match)
        assert sorted(((x.a, x.b, x["at"], x.reason) for x in got.collect()), key=repr) == brute(refs, targets, match), match
        # hot keys: judged by running counts
        orphans.FEW, few = 0, orphans.FEW
        got = orphans.orphans(r, t, {"a": "a", "b": "b"}, "at", "since", "until", match)
        orphans.FEW = few
        assert sorted(((x.a, x.b, x["at"], x.reason) for x in got.collect()), key=repr) == brute(refs, targets, match), match
    none = orphans.orphans(r, t.limit(0), {"a": "a", "b": "b"}, "at", "since", "until")
    assert {x.reason for x in none.collect()} == {"missing"}
    assert orphans.orphans(r.limit(0), t, {"a": "a", "b": "b"}, "at", "since", "until").count() == 0
