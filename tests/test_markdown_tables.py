import json
import re

import pytest
from pyspark.sql import functions as F

from foliant.operators import markdown as M
from foliant.operators import tables as B
from foliant.sources import readers as R

SAMPLE = """<!-- page 35 (2-1) -->

# Chapter 2: Bridges

As told in chapter 1, bridges stand.

## SECTION I – CREWS

2-1. The crew _lifts_ panels.

### CREW DUTIES

2-5. The chief must see to this:

- First duty.

  - A point below.

- Second duty.

These duties go on.

**Table 2-1. Titles**

| Echelon | Title |
| --- | --- |
| Corps | Chief a\\|b |

<!-- page 36 -->

FA – fuel area, CD – cable drum

**Figure 2-1. A bridge**

**Table 2-2. No grid**

## SECTION II – BOATS

2-40. Boats.

# Glossary

| Acronym | Meaning |
| --- | --- |
| **FA** | fuel area |

| Acronym | Meaning |
| --- | --- |
| FA | field area |

**tow chain** — A chain. (JP 3-03)

***ration box** — A box.
"""


def parse(spark, md, size=2):
    """Rows of one text, in runs of few blocks, so that runs hand on to the next."""
    df = spark.createDataFrame([("p", i, b) for i, b in enumerate(re.split(r"\n\n+", md))], "pub_id string, n int, block string")
    return [r.asDict(True) for r in M.parse_blocks(df, ["pub_id"], "n", "block", size).orderBy("ord").collect()]


def test_parse_sample(spark):
    rows = parse(spark, SAMPLE)
    assert [r["ord"] for r in rows] == list(range(20))
    by = {r["id"]: r for r in rows}
    assert [r["type"] for r in rows] == ["division", "text", "section", "paragraph", "heading", "paragraph", "list_item", "list_item", "list_item", "text", "table", "figure", "table", "section", "paragraph", "division", "acronym", "acronym", "term", "term"]
    assert by["ch-2.sec-i"]["cite"] == "chapter 2, section I" and by["ch-2.sec-i.crew-duties"]["cite"] == "p. 2-1"
    assert by["para-2-5.li1.li1"]["depth"] == 1 and by["para-2-5.li1.li1"]["path"] == ["ch-2", "ch-2.sec-i", "ch-2.sec-i.crew-duties", "para-2-5", "para-2-5.li1"]
    assert by["para-2-5.li2"]["parent_id"] == "para-2-5" and by["para-2-5.t1"]["cite"] == "para 2-5"
    assert by["table-2-1"]["key"].startswith("FA") and by["table-2-1"]["rows"] == [["Corps", "Chief a|b"]] and by["table-2-1"]["page"] == 35
    assert by["table-2-2"]["grid"] is False and by["figure-2-1"]["page_label"] is None
    assert by["acr-fa"]["meaning"] == "fuel area" and by["acr-fa-2"]["meaning"] == "field area"
    assert by["term-tow-chain"]["source"] == "JP 3-03" and by["term-ration-box"]["proponent"] is True
    assert by["para-2-1"]["plain"] == "The crew lifts panels."
    assert len({r["id"] for r in rows}) == len(rows) and parse(spark, "") == []


def test_caption_at_the_end_is_not_flushed(spark):
    assert [r["type"] for r in parse(spark, "# Preface\n\n**Table 1-1. X**")] == ["division"]


def test_front_matter():
    front, body = M.front_matter("---\npub_id: FM-1\ntitle: 'A b'\n---\n# Preface\n")
    assert front == {"pub_id": "FM-1", "title": "A b"} and body == "# Preface\n"
    with pytest.raises(ValueError):
        M.front_matter("# Preface")


def test_parse_rows(spark):
    df = spark.createDataFrame([("p", SAMPLE), ("q", None), ("r", "")], "pub_id string, md string")
    got = M.parse_rows(df, ["pub_id"], "md")
    assert got.count() == 20 and {r.pub_id for r in got.select("pub_id").collect()} == {"p"}


ROWS = "rows array<array<string>>"


def test_clean_tables(spark):
    cases = [
        [["A", None, "B", ""], ["", "", "b2", ""], ["1", "", "2", ""], ["1", "", "2", ""], ["A", "", "B b2", ""], ["FA – fuel", "", "", ""]],
        [["x", ""], ["", "y"]], None, [], [[""]], [None, ["a", "b"], ["c"]],
        [["Title", ""], ["Step", "Task"], ["one", "two"], ["Note here", ""], ["CD - drum", ""]],
    ]
    df = spark.createDataFrame([(r,) for r in cases], ROWS)
    got = [(r.c.rows, r.c.notes) for r in B.cleaned(df, "rows", "c").collect()]
    assert got[0] == ([["A", "B b2"], ["1", "2"]], ["FA – fuel"])
    assert got[1] == ([["x"], ["y"]], [])
    assert got[2] == got[3] == got[4] == ([], [])
    assert got[5] == ([["a c", "b"]], [])
    assert got[6] == ([["Step", "Task"], ["Title", ""], ["one", "two"]], ["Note here", "CD - drum"])


def test_repair_tables(spark):
    cases = [
        [["**Tit**", "**Two**"], ["Corps head", "quarters staff"], ["A", "B"], ["", "more"], ["FA – fuel area, CD", " – cable drum"]],
        [["H", "", "K"], ["_a_ _b_", "", "C"]], None, [["only"]],
    ]
    got = [r.c for r in spark.createDataFrame([(r,) for r in cases], ROWS).select(B.repaired(F.col("rows")).alias("c")).collect()]
    assert got[0].rows == [["Tit", "Two"], ["Corps headquarters staff", ""], ["A", "B<br>more"]] and got[0].legend == "FA – fuel area, CD – cable drum" and got[0].fixes == 3
    assert got[1].rows == [["H", "K"], ["_a b_", "C"]] and got[1].legend is None and got[1].fixes == 0
    assert got[2].rows == [] and got[3].rows == [["only"]]


def test_page_blocks_and_headings(spark):
    md = "## ALPHA\n\nBETA\n\n1-1. Text that\nwraps.\n- one\n  - two\n  more\n\n**Table 1-1. Cap**\n\n| a | b |\n|---|---|\n| 1 | 2 |"
    pages = spark.createDataFrame([("p", 3, md), ("p", 4, None), ("q", 1, "**Bold one**\n\n# H\nafter\n- <mark>x</mark>"), ("r", 1, "# Gamma\n\nAlpha\n\nwords\n\n## Beta\n\n| Delta | line |\n| c | d |")], "pub string, page int, md string")
    b = B.page_blocks(pages, ["pub", "page"], "md")
    rows = b.orderBy("pub", "page", "seq").collect()
    one = [r for r in rows if r.pub == "p"]
    assert [x.kind for x in one] == ["mdheading", "para", "para", "bullet", "bullet", "caption", "table"]
    assert one[2].text == "1-1. Text that wraps." and one[4].depth == 1 and one[4].text == "two more" and one[6].rows == [["a", "b"], ["1", "2"]]
    assert [(x.kind, x.text) for x in rows if x.pub == "q"] == [("bold", "**Bold one**"), ("mdheading", "# H"), ("para", "after"), ("bullet", "x")]
    heads = {"p": [("T2", None, "Alpha beta"), ("T3", None, "Gamma")], "r": [("T3", None, x) for x in ("Gamma", "Beta", "Alpha", "Delta line", "Zeta")]}
    h = spark.createDataFrame([(k, [{"tier": a, "label": b, "text": c} for a, b, c in v]) for k, v in heads.items()], "pub string, heads array<struct<tier:string,label:string,text:string>>")
    got = {r.pub: r.x for r in B.gathered(b, ["pub", "page"]).join(h, "pub").select("pub", B.placed(F.col("bs"), F.col("heads")).alias("x")).collect()}
    assert [tuple(x) for x in got["p"].at] == [(0, 0, 2, False)] and got["p"].lost == [1]
    # a heading that is passed over is still found, and none is lost without a word
    assert [(x.h, x["from"], x.row) for x in got["r"].at] == [(0, 0, False), (2, 1, False), (1, 3, False), (3, 4, True)] and got["r"].lost == [4]
    rep = spark.createDataFrame([("p", i, "para", t, None, None) for i, t in enumerate(["A b.", "x", "a B", "y", "z", "w", "A b."])], "pub string, seq int, kind string, text string, depth int, rows array<array<string>>")
    kept = B.gathered(rep, ["pub"]).select(F.transform(B.without_repeats(F.col("bs")), lambda x: x["text"]).alias("t")).first().t
    assert kept == ["A b.", "x", "y", "z", "w", "A b."]


def test_ungarble_and_segment(spark):
    df = spark.createDataFrame([("hte birdge stnads here", ["other", "the bridge", "stands here"]), ("the bridge stands here", ["x"]), ("", ["x"]), ("ab", [])], "r string, ls array<string>")
    assert [r.x for r in df.select(B.ungarbled(F.col("r"), F.col("ls")).alias("x")).collect()] == ["the bridge<br>stands here", None, None, None]
    v = [("p", *x) for x in {"fire": 5, "support": 30, "officer": 2, "fires": 9, "upport": 1, "ab": 1, "c": 9, "a": 5, "bc": 5}.items()]
    vocab = spark.createDataFrame(v, "pub string, word string, n long")
    heads = spark.createDataFrame([("p", k) for k in ("firesupportofficer", "zzz", "", "abc", "firex")], "pub string, key string")
    got = {r.key: r.words for r in B.segmented(heads, vocab, ["pub"]).collect()}
    assert got == {"firesupportofficer": "fire support officer", "zzz": None, "": None, "abc": "a bc", "firex": None}


def test_deck_statements(spark, tmp_path):
    deck = {"slides": [{"id": "s01", "roles": [{"name": "x", "duties": [{"text": "Do it.", "directive": "must", "cite": ["para-1-1"]}]}], "notes": {"talking_points": [{"text": "Say", "cite": "t"}]}}, {"id": "s02", "rows": [{"cells": ["a", "b"], "cite": []}]}]}
    df = spark.createDataFrame([("p", json.dumps(deck)), ("q", None), ("r", "{")], "pub_id string, spec string")
    got = {r.claim_id: r for r in R.claims_of_decks(df).collect()}
    assert set(got) == {"s01.roles[0].duties[0]", "s01.notes.talking_points[0]", "s02.rows[0]"}
    assert got["s01.roles[0].duties[0]"].cites == ["para-1-1"] and got["s01.notes.talking_points[0]"].in_notes and got["s02.rows[0]"].text == "a b"


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "list.txt").write_text("# c\nFM 3-09\nar_600–20 https://x.example/a.pdf # note\nTC 1 dir/b.pdf\n")
    got = {r.pub_id: (r.path, r.url) for r in R.pub_list(spark, str(tmp_path / "list.txt")).collect()}
    assert got == {"FM-3-09": (None, None), "AR-600-20": (None, "https://x.example/a.pdf"), "TC-1": ("dir/b.pdf", None)}
    (tmp_path / "twice.txt").write_text("FM 1\nfm-1\n")
    with pytest.raises(Exception, match="listed twice"):
        R.pub_list(spark, str(tmp_path / "twice.txt")).collect()
    (tmp_path / "a.md").write_text("---\npub_id: FM-9\n---\n" + SAMPLE)
    n = R.nodes_of_files(spark, str(tmp_path / "*.md"))
    assert n.where("pub_id = 'FM-9'").count() == 20
    assert len(R.files(spark, str(tmp_path / "a.md")).first().sha256) == 64
    R.write_json(n.select("pub_id", "id"), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 20
