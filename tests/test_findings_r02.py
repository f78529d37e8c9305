"""What a reviewer of round 2 found: plans that the driver couldn't hold, and work that grew
faster than its input."""

import pytest

import __spark_entry__ as entry
from test_rules import Book, tables


def scans(df):
    """How often the optimized plan of ``df`` reads something."""
    return df._jdf.queryExecution().optimizedPlan().collectLeaves().size()


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    b = Book().add("ch-1", "division", kind="chapter", number="1", title="Fires", level=1)
    b.add("para-1-1", "paragraph", "ch-1", number="1-1", plain="The fire officer must report. FO and gunfire officers will wait.")
    b.add("glossary", "division", kind="glossary", title="Glossary", level=1).add("acr-fo", "acronym", "glossary", abbreviation="FO", meaning="fire officer")
    return tables(spark, tmp_path_factory.mktemp("small"), b.rows)


def test_hints_are_planned_in_steps(spark, small):
    assert scans(entry.queries()["cls_hints"](spark, small)) <= 3


def test_mentions_meet_by_ids(spark, small):
    from foliant.plans.index import role_mentions

    got = role_mentions(spark, small)
    assert [(r.node_id, r.name, r.by_name, r.by_abbreviation) for r in got.collect()] == [("para-1-1", "fire officer", True, True)]


def test_walk_is_deeper_than_a_recursion(spark, tmp_path):
    """Spark's recursive queries end at 100 levels and at a million rows."""
    b = Book().add("n0", "division", title="Deep", level=1)
    b.path["n0"] = []
    for i in range(1, 106):
        b.add(f"n{i}", "list_item", f"n{i - 1}", plain="x")
    d = tables(spark, tmp_path, b.rows)
    assert {r.id: (r.root, r.depth) for r in entry.queries()["walk_recursive"](spark, d).collect()} == {f"n{i}": ("n0", i) for i in range(106)}


def test_tree_check_of_many_rows(spark, small):
    """A row limit on recursive queries doesn't stop it."""
    held = spark.conf.get("spark.sql.cteRecursionRowLimit")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "1")
    try:
        assert [tuple(r) for r in entry.queries()["spec_tree_check"](spark, small).collect()] == [("P", 4, 0, 0)]
    finally:
        spark.conf.set("spark.sql.cteRecursionRowLimit", held)


def test_acronym_first_use_is_planned_in_steps(spark, small):
    # first uses with their meanings, twice, and what slides say
    assert scans(entry.queries()["qa_acronym_first_use"](spark, small)) <= 5


def test_findings_are_planned_check_by_check(spark):
    """Each check's rows are read as they were written, whatever the check reads itself."""
    assert scans(entry.queries()["qa_dedupe"](spark, "/root/testdata/sf0.001")) == 14


def test_ungarble_reckons_each_line_once(spark):
    """Lines are laid end to end once, not anew for each line that a stretch may begin with."""
    import time

    from pyspark.sql import functions as F

    from foliant.operators import tables as tb

    lines = [f"line number {i} of a long page" for i in range(500)] + ["guns fire", "at dawn"]
    d = spark.createDataFrame([("nugs refi ta wand", lines)], "row string, ls array<string>")
    t = time.time()
    assert d.select(tb.ungarbled(F.col("row"), F.col("ls")).alias("r")).first().r == "guns fire<br>at dawn"
    assert time.time() - t < 30


def test_summary_is_planned_check_by_check(spark):
    """One leaf a check, and the list of checks."""
    assert scans(entry.queries()["qa_summary"](spark, "/root/testdata/sf0.001")) == 15


def test_findings_rest_on_what_is_made_once(spark, monkeypatch):
    """Sources, grades and acronyms are made once, though several checks rest on each."""
    from collections import Counter

    from foliant.plans import checks

    made = Counter()
    for name in ("claim_sources", "qa_readability", "chk_acronym_coverage"):
        monkeypatch.setattr(checks, name, lambda *a, name=name, f=getattr(checks, name): made.update([name]) or f(*a))
    checks.findings(spark, "/root/testdata/sf0.001")
    assert made == {"claim_sources": 1, "qa_readability": 1, "chk_acronym_coverage": 1}


def test_written_leaves_no_shuffle_files(spark):
    import time

    from pyspark.sql import functions as F

    from foliant.session import CLEANUP, written

    held = spark.conf.get(CLEANUP)
    kept = lambda: set(filter(lambda n: "/shuffle_" in n, spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")))
    before = kept()
    got = written(spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count())
    until = time.time() + 20
    while (left := kept() - before) and time.time() < until:
        time.sleep(0.5)
    assert not left
    assert got.count() == 7 and spark.conf.get(CLEANUP) == held


def test_number_words_are_looked_for_once(spark):
    from pyspark.sql import functions as F

    from foliant.plans.checks import numbers

    d = spark.createDataFrame([("Two of 1,200 guns and two trucks, see chapter three, zero loss.",), (None,)], "t string").select(numbers(F.col("t")).alias("n"))
    assert [r.n and sorted(r.n) for r in d.collect()] == [["0", "1200", "2"], None]
    assert d._jdf.queryExecution().optimizedPlan().toString().count("([a-z]+)") == 1


def test_tree_check_counts_parents_by_place(spark, tmp_path):
    """A parent that stands in two places counts twice, one with two parents once, as in SQL."""
    p = Book().add("ch-1", "division", title="A", level=1).add("ch-1", "division", title="A", level=1).add("x", "paragraph", "ch-1", plain="x")
    q = Book("Q").add("ch-1", "division", title="A", level=1).add("ch-2", "division", title="B", level=1)
    q.add("b", "paragraph", "ch-1", plain="b", ord=2).add("b", "paragraph", "ch-2", plain="b", ord=2).add("c", "list_item", "b", plain="c", ord=3)
    d = tables(spark, tmp_path, p.rows + q.rows)
    assert sorted(tuple(r) for r in entry.queries()["spec_tree_check"](spark, d).collect()) == [("P", 3, 0, 0), ("Q", 8, 0, 0)]
