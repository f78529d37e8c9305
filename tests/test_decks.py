import hashlib
import json

from foliant.sources import decks as D


def deck(*trees, **kw):
    return json.dumps({"pub": {"pub_id": "P", "source_sha256": "abc"}, "slides": [{"id": f"s{i:02}", "pattern": "decision_tree", "root": r, "nodes": n} for i, (r, n) in enumerate(trees, 1)]} | kw)


def q(key, yes=None, no=None):
    return {"key": key, "kind": "question", "yes": yes, "no": no}


def o(key, **kw):
    return {"key": key, "kind": "outcome"} | kw


def test_decision_trees(spark):
    trees = [
        ("a", [q("a", "b", "c"), o("b"), q("c", "d", "e"), o("d"), o("e")]),
        ("x", [q("a", "b", "b"), o("b")]),
        ("a", [q("a", "b", "z"), o("b", yes="a"), o("lost")]),
        ("a", [q("a", "b", "c"), q("b", "a", "d"), o("c"), o("d"), o("d")]),
        ("a", [o("a"), q("m", "n", "n"), q("n", "m", "m")]),
    ]
    df = spark.createDataFrame([("P", deck(*trees)), ("Q", None), ("R", "{"), ("S", "{}")], "pub_id string, spec string")
    got = sorted((r.slide_id, r.rule, r.key) for r in D.decision_trees(df).collect())
    assert got == [
        ("s02", "keys", "x"), ("s02", "unreached", "a"), ("s02", "unreached", "b"),
        ("s03", "outcome with branches", "b"), ("s03", "question without branches", "a"), ("s03", "shared or circular", "a"), ("s03", "unreached", "lost"),
        ("s04", "keys", "a"), ("s04", "shared or circular", "a"), ("s05", "unreached", "m"), ("s05", "unreached", "n"),
    ]


def test_reviews(spark):
    spec = json.dumps({"pub": {"source_sha256": "abc"}, "slides": [{"id": "s01", "items": [{"text": "A.", "cite": ["n"]}, {"text": "B.", "cite": ["n"]}, {"text": "C.", "cite": ["n"]}, {"text": "D.", "cite": ["n"]}]}]})
    sha = hashlib.sha256(spec.encode()).hexdigest()
    ids = [f"s01.items[{i}]" for i in range(4)]
    good = {"spec_sha256": sha, "source_sha256": "abc", "verdicts": {ids[0]: "pass", ids[1]: "minor", ids[2]: "major", ids[3]: "pass"}, "findings": [{"claim": ids[1], "verdict": "minor", "status": "accepted"}, {"claim": ids[2], "verdict": "major", "status": "open"}]}
    bad = {"spec_sha256": "old", "source_sha256": "old", "verdicts": {ids[0]: "minor", ids[1]: "minor", "gone": "pass"}, "findings": [{"claim": ids[1], "verdict": "minor", "status": "fixed"}, {"claim": "lost", "verdict": "critical", "status": "open"}]}
    decks = spark.createDataFrame([("P", spec), ("Q", spec), ("R", spec), ("T", None)], "pub_id string, spec string")
    reviews = spark.createDataFrame([("P", json.dumps(good)), ("Q", json.dumps(bad)), ("R", None), ("T", json.dumps(good))], "pub_id string, review string")
    got = sorted((r.pub_id, r.error, r.claim_id or "") for r in D.review_errors(reviews, decks).collect() if r.pub_id != "T")
    assert got == [
        ("Q", "another publication", ""), ("Q", "finding for an unknown claim", "lost"), ("Q", "no verdict", ids[2]), ("Q", "no verdict", ids[3]), ("Q", "the deck changed after the review", ""),
        ("Q", "verdict for an unknown claim", "gone"), ("Q", "verdict without a finding", ids[0]), ("Q", "verdict without a finding", ids[1]),
    ]
    assert {r.pub_id: r.blocking for r in D.blocking(reviews).collect()} == {"P": 1, "Q": 1, "R": 0, "T": 1}
