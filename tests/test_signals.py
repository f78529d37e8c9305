"""The queries on tables into which the signals that the test tables lack were put, beside
DuckDB; and a few results known by hand."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from verify import plain

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

TEXTS = [
    "The MSP must report NLT H-6. He will not move within 10 days. See ATP 3-09.50, Volume 2 and table 1-1, paragraph 1-2, section II, section A.",
    "Deliver it no later than two hours before dawn. It shall not stop, i.e. never. Gen. Oak may wait at D-day.",
    "May 1944 was cold. The medical supply planner should rest; the crew shall wait. The NET is down and NET 5 hours is too long. Every crew should eat, e.g. at noon. Refer to FM 3-09 and figures 1-1 and 1-2.",
    "CAUTION", "Fire sup-\nport and fire\nsupport are one. fire support fire support. supports fires. The two types of step 1 then repeat the loop in a continuous cycle, first and next.",
    "", "No. 5 stands. J. K. Low said \"Stop.\" Then he left (see chapter 2). Whether it rains or not, unless told, whereas others differ.", None,
]
CLAIMS = ["The MSP will use the plan of 3 March 2020 and FM 3-09, one of 1,200 copies; the fire support.", "Crews must carry 5 tow chains by chapter 2, not 7.", "fire support fire support support fire", "You should go to table 9-9. shall it be?", "MSP – medical thing", "ZZP: zed post", "Lost word – gone"]


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    d = str(tmp_path_factory.mktemp("signals"))
    c = duckdb.connect()
    lit = lambda v: "null" if v is None else "'" + v.replace("'", "''") + "'"
    pick = lambda ts, k: "case " + " ".join(f"when {k} % {len(ts) + 2} = {i} then {lit(t)}" for i, t in enumerate(ts))
    change = {
        "nodes": f"select * replace ({pick(TEXTS, 'ord')} else plain end as plain, case when ord % 7 = 1 then 'The _water point_ is a place. A _tow chain_ means a chain.' else text end as text, case when abbreviation is not null and ord % 2 = 0 then 'MSP' else abbreviation end as abbreviation, case when meaning is not null and ord % 2 = 0 then 'medical supply planner' else meaning end as meaning, case when type = 'heading' and level = 2 then 'FIRE SUPPORT PERSONNEL' when type = 'heading' and level >= 4 and ord % 2 = 0 then 'MEDICALSUPPLYPLANNER' when type = 'heading' and level >= 4 then 'TOWSUPPORT CREW' else title end as title) from s",
        "claims": f"select * replace (case when pub_id || claim_id = (select min(pub_id || claim_id) from s) then 'Plan firesupport.' else {pick(CLAIMS, "length(coalesce(text, ''))")} else text end end as text, case when length(coalesce(text, '')) % 9 in (4, 5) then 'acronyms' when length(coalesce(text, '')) % 9 = 6 then 'key_terms' else pattern end as pattern) from s",
        "slides": "select * replace (case when slide_ord % 3 = 0 then 'You must not wait (1 of 2)' when slide_ord % 3 = 1 then 'You must not wait (2 of 2)' else title end as title) from s",
    }
    for f in sorted(os.listdir(SF)):
        c.execute(f"create or replace view s as select * from '{SF}/{f}'")
        c.execute(f"copy ({change.get(f[:-8], 'select * from s')}) to '{d}/{f}' (format parquet)")
        c.execute(f"create view {f[:-8]} as select * from '{d}/{f}'")
    c.execute("set timezone='UTC'")
    return d, c


@pytest.mark.parametrize("name", [n for n in sorted(entry.oracle_sql()) if n.startswith(("idx_", "pkt_", "cls_", "chk_", "qa_", "rev_", "wrd_", "rep_", "bud_", "section", "node_", "blk_", "tbl_", "claim_", "spec_"))])
def test_equal(spark, tables, name):
    d, c = tables
    df = entry.queries()[name](spark, d)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c_]) for c_ in cols) for r in df.collect()), key=repr)
    rel = c.execute(entry.oracle_sql()[name])
    have = [x[0] for x in rel.description]
    assert got == sorted((tuple(plain(r[have.index(x)]) for x in cols) for r in rel.fetchall()), key=repr)
    if name not in ("tbl_overflow", "chk_pub_match", "chk_chapters_without_slides", "chk_acronym_entry"):
        assert got or name in ("tbl_rebuild_select", "tbl_garbled_rows", "chk_container_cite", "rev_unexplained", "tbl_legend_source", "qa_uncited", "qa_acronym_first_use")


def test_known_rows(spark, tables):
    d, _ = tables
    q = entry.queries()
    cut = {r.sentence for r in q["idx_sentences"](spark, d).collect()}
    assert "It shall not stop, i.e. never." in cut and "Gen. Oak may wait at D-day." in cut and 'J. K. Low said "Stop."' in cut and "No. 5 stands." in cut
    dead = {(r.kind, r.durations, r.time_references) for r in q["idx_deadlines"](spark, d).collect()}
    assert ("deadline", "", "H-6") in dead and ("deadline", "two hours", "") in dead and ("time_reference", "", "D-day") in dead and ("deadline", "10 days", "") in dead and ("deadline", "5 hours", "") in dead
    verbs = {(r.verb, r.strength, r.possibly_historical) for r in q["idx_directives"](spark, d).collect()}
    assert ("may", "permissive", True) in verbs and ("shall not", "mandatory", False) in verbs and ("will not", "mandatory", False) in verbs
    ext = {(r.target, r.see) for r in q["idx_crossrefs_ext"](spark, d).collect()}
    assert ("ATP 3-09.50, Volume 2", True) in ext and ("FM 3-09", True) in ext
    inner = {r.target for r in q["idx_crossrefs_int"](spark, d).collect()}
    roles = {(r.name, r.abbreviation, r.source, r.mention_count > 0) for r in q["idx_roles"](spark, d).collect()}
    assert ("medical supply planner", "MSP", "acronym", True) in roles
    assert {r.verb for r in q["idx_role_duties"](spark, d).collect()} == {"must", "should"}
    assert {"table 1-1", "paragraph 1-2", "section A", "figure 1-1", "chapter 2"} <= inner and "section II" not in inner
    terms = {(r.term, r.definition) for r in q["idx_inline_defs"](spark, d).collect()}
    assert ("water point", "water point is a place.") in terms and ("tow chain", "tow chain means a chain.") in terms
    assert {(r.w, r.fix) for r in q["wrd_joined_fixes"](spark, d).collect()} == {("firesupport", "fire support")}
