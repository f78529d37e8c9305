"""Every query with SQL gives the same rows as DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from verify import plain

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for f in sorted(os.listdir(SF)):
        c.execute(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_equal(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = con.execute(entry.oracle_sql()[name])
    have = [x[0] for x in rel.description]
    assert sorted(have) == cols
    assert got == sorted((tuple(plain(r[have.index(c)]) for c in cols) for r in rel.fetchall()), key=repr)


def test_entry_runs(spark):
    assert entry.entry(spark).columns


def test_ingest_stream(spark, tmp_path):
    import json

    from foliant.streaming.ingest import ingest

    (tmp_path / "drop").mkdir()
    ok, bad = "Approved for public release; distribution is unlimited.", "CUI. Approved for public release; distribution is unlimited."
    (tmp_path / "drop" / "a.json").write_text("\n".join(json.dumps({"pub_id": p, "text": t, "sha256": p}) for p, t in [("A", ok), ("B", bad), ("A", ok), ("C", None)]))
    for _ in range(2):  # a second run takes nothing again
        ingest(spark, str(tmp_path / "drop"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted(r.pub_id for r in spark.read.parquet(str(tmp_path / "out/texts")).collect()) == ["A"]
    assert {(r.pub_id, r.status) for r in spark.read.parquet(str(tmp_path / "out/records")).collect()} == {("A", "pass"), ("B", "fail"), ("C", "fail")}
