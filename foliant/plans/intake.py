"""Publications coming in: front matter, the release gate, stages and updates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import rx
from foliant.plans.index import nodes, nodes_sql
from foliant.session import table

# Release statements, tried in this order.
RESTRICTED = r"\b(CUI|CONTROLLED\s+UNCLASSIFIED|FOR\s+OFFICIAL\s+USE\s+ONLY|FOUO|CONFIDENTIAL|SECRET|NOFORN)\b"
OTHER = r"(?i)distribution\s+(?:statement\s+)?([B-FX])\b"
LIMITED = r"(?i)(distribution\s+(?:is\s+)?(?:authorized|limited|restricted)\s+to|not\s+approved\s+for\s+public\s+release)"
OPEN = r"(?i)(approved\s+for\s+public\s+release\s*;?\s*distribution\s+(?:is\s+)?unlimited)"
SUPERSEDES = r"(?i)This\s+(?:major\s+)?(?:revision|publication|regulation)\s+(?:\w+\s+)*?supersedes\s+([^.]+)\."
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
DATE = rf"\b(\d{{1,2}}\s+(?:{MONTHS})\s+\d{{4}})\b"
AFTER_DC = rf"Washington,\s*DC,?\s*(\d{{1,2}}\s+(?:{MONTHS})\s+\d{{4}})\b"

# A front page for every part, so that each kind of statement occurs.
FRONT = """
  select p_partkey as id, concat('PAGE  ONE of ', p_name, '. ', case p_partkey % 9 when 0 then 'CUI marking. Approved for public release; distribution is unlimited.' when 1 then 'DISTRIBUTION STATEMENT C applies.'
      when 2 then 'Distribution is authorized to agencies only.' when 3 then 'No statement here.' when 4 then 'not approved for  public release' when 5 then 'Confidential matters are cui in lower case. Approved for public release; distribution is unlimited.'
      else 'Approved for public release; distribution is unlimited.' end, case when p_partkey % 4 = 0 then concat(' Washington, DC, ', cast(1 + p_partkey % 28 as {s}), ' May 2019.') else '' end,
      case when p_partkey % 3 = 0 then concat(' This publication supersedes PART ', cast(p_partkey % 50 as {s}), ', dated ', cast(1 + p_partkey % 27 as {s}), ' June 2001.') else '' end,
      case when p_partkey % 5 = 0 then ' Dated 7 March 2018.' else '' end) as text from part"""


def fronts(spark: SparkSession, sf: str) -> DataFrame:
    table(spark, sf, "part").select("p_partkey", "p_name").createOrReplaceTempView("part")
    return spark.sql(FRONT.format(s="string")).withColumn("text", F.trim(F.regexp_replace("text", r"\s+", " ")))


_FRONTS = "(select id, trim(regexp_replace(text, '\\s+', ' ', 'g')) as text from (" + FRONT.format(s="varchar") + "))"


def gate(text: F.Column) -> dict[str, F.Column]:
    """Status, distribution, reason and evidence of a front text. The first rule that holds
    decides; a text without a statement, or none at all, fails."""
    hit = lambda p, g=0: F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), p, g), F.lit(""))
    restricted, other, limited, open_ = hit(RESTRICTED, 1), hit(OTHER, 1), hit(LIMITED, 1), hit(OPEN, 1)
    passed = restricted.isNull() & other.isNull() & limited.isNull() & open_.isNotNull()
    return {
        "status": F.when(passed, "pass").otherwise("fail"),
        "distribution": F.when(restricted.isNotNull(), F.upper(restricted)).when(other.isNotNull(), F.upper(other)).when(limited.isNotNull(), F.lit(None)).when(open_.isNotNull(), "A"),
        "reason": F.when(restricted.isNotNull(), "restricted marking").when(other.isNotNull(), "other statement").when(limited.isNotNull(), "limited release").when(open_.isNotNull(), "open statement").otherwise("no statement"),
    }


def gate_distribution(spark: SparkSession, sf: str) -> DataFrame:
    f = fronts(spark, sf)
    return f.select("id", *[c.alias(k) for k, c in gate(F.col("text")).items()])


def meta_pub_date(spark: SparkSession, sf: str) -> DataFrame:
    """The date after the place of issue, else the first one outside a sentence on what is
    superseded."""
    f = fronts(spark, sf)
    first = F.regexp_extract(F.regexp_replace("text", SUPERSEDES, " "), DATE, 1)
    at = F.coalesce(F.nullif(F.regexp_extract("text", AFTER_DC, 1), F.lit("")), F.nullif(first, F.lit("")))
    return f.select("id", F.to_date(at, "d MMMM yyyy").alias("pub_date"))


def meta_supersedes(spark: SparkSession, sf: str) -> DataFrame:
    return fronts(spark, sf).select("id", F.nullif(F.trim(F.regexp_extract("text", SUPERSEDES, 1)), F.lit("")).alias("supersedes"))


def norm_pub_id(c: F.Column) -> F.Column:
    t = F.translate(F.upper(F.trim(c)), "–—", "--")
    return F.regexp_replace(F.regexp_replace(t, r"[\s_]+", "-"), "-{2,}", "-")


_NORM = "regexp_replace(regexp_replace(translate(upper(trim({0})), '–—', '--'), '[\\s_]+', '-', 'g'), '-{{2,}}', '-', 'g')"


def meta_norm_pub_id(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "publications").where("supersedes is not null").select("supersedes").distinct()
    return p.select("supersedes", norm_pub_id(F.regexp_replace("supersedes", ",.*$", "")).alias("old_id"))


def src_pub_list(spark: SparkSession, sf: str) -> DataFrame:
    """Lines ``ID``, ``ID path`` or ``ID url`` (comments apart) read into id and source, with
    how often the id is listed; more than once is an error of the list."""
    p = table(spark, sf, "publications").select("pub_id", "source_url").distinct()
    line = F.concat(F.replace("pub_id", F.lit("-"), F.lit(" ")), F.when(F.col("source_url").isNotNull(), F.concat(F.lit("  "), "source_url")).otherwise(""), F.lit(" # noted"))
    t = F.trim(F.regexp_replace(line, "#.*$", ""))
    start = r"(?i)\s(https?://\S.*|\S*[/\\].*|\S+\.pdf.*)$"
    d = p.select(norm_pub_id(F.regexp_replace(t, start, "")).alias("pub_id"), F.nullif(F.trim(F.regexp_extract(t, start, 1)), F.lit("")).alias("source"))
    return d.groupBy("pub_id", "source").agg(F.count("*").alias("lines")).withColumn("listed", F.sum("lines").over(Window.partitionBy("pub_id")))


_START = r"(?i)\s(https?://\S.*|\S*[/\\].*|\S+\.pdf.*)$"


def latest(spark: SparkSession, sf: str) -> DataFrame:
    """Each publication's last record."""
    p = table(spark, sf, "publications")
    s = F.struct("snapshot_on", "fetched_at", "sha256")
    return p.groupBy("pub_id").agg(F.max_by(F.struct("sha256", "pub_date", "supersedes", "gate", "fetched_at", "source_url"), s).alias("m")).select("pub_id", "m.*")


_LATEST = "(select * from (select *, row_number() over (partition by pub_id order by snapshot_on desc, fetched_at desc nulls last, sha256 desc nulls last) as k from publications) where k = 1)"


def guard_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes of publications whose last record passed with distribution A: later stages see
    no other; a publication without a record is out."""
    ok = latest(spark, sf).where("gate.status = 'pass' and gate.distribution = 'A'").select("pub_id")
    return nodes(spark, sf, "type").join(ok, "pub_id", "left_semi").groupBy("pub_id").agg(F.count("*").alias("nodes"))


def guard_tree_current(spark: SparkSession, sf: str) -> DataFrame:
    """Delivered trees beside the record of their publication: current, stale or unknown."""
    t = table(spark, sf, "doc_trees").where("try_parse_json(tree) is not null").select(F.get_json_object("tree", "$.pub.pub_id").alias("pub_id"), F.get_json_object("tree", "$.pub.source_sha256").alias("tree_sha")).where("pub_id is not null").distinct()
    j = t.join(latest(spark, sf).select("pub_id", "sha256").withColumn("known", F.lit(True)), "pub_id", "left")
    return j.select("pub_id", "tree_sha", F.when(F.col("known").isNull(), "unknown").when(F.col("sha256") == F.col("tree_sha"), "current").otherwise("stale").alias("state"))


# --- stages and updates ------------------------------------------------------------------
def _keyed(spark: SparkSession, sf: str) -> DataFrame:
    """One row per publication and snapshot (the last fetched)."""
    p = table(spark, sf, "publications")
    return p.groupBy("snapshot_on", "pub_id").agg(F.max_by(F.struct("sha256", "pub_date", "supersedes", "source_url", "gate"), F.struct("fetched_at", "sha256")).alias("m")).select("snapshot_on", "pub_id", "m.*")


_KEYED = "(select * from (select *, row_number() over (partition by snapshot_on, pub_id order by fetched_at desc nulls last, sha256 desc nulls last) as k from publications) where k = 1)"


# Fixed value: how a publication names its proponent.
PROPONENT = r"The proponent of (?:this publication|[A-Z]{2,4} [\d.-]+) is ([^.]+)\."


def meta_proponent(spark: SparkSession, sf: str) -> DataFrame:
    """The proponent that each publication's own text names first, white space squeezed."""
    found = F.regexp_extract("plain", PROPONENT, 1)
    n = table(spark, sf, "nodes").where(F.col("plain").rlike(PROPONENT)).select("pub_id", "ord", F.trim(F.regexp_replace(found, r"\s+", " ")).alias("p"))
    return n.groupBy("pub_id").agg(F.min_by("p", F.struct("ord", "p")).alias("proponent"))


def bat_fetch_decision(spark: SparkSession, sf: str) -> DataFrame:
    """What to do with each publication of a snapshot, given the record before: skip the
    same file if it passed, fetch a new one, report what has no source."""
    w = Window.partitionBy("pub_id").orderBy("snapshot_on")
    k = _keyed(spark, sf).withColumn("had", F.lag("sha256").over(w)).withColumn("had_gate", F.lag("gate.status").over(w))
    step = F.when(F.col("source_url").isNull() & F.col("sha256").isNull(), "no input").when((F.col("had") == F.col("sha256")) & (F.col("had_gate") == "pass"), "skipped (same file)").otherwise("done")
    return k.select("snapshot_on", "pub_id", step.alias("step"))


def bat_counts(spark: SparkSession, sf: str) -> DataFrame:
    return bat_fetch_decision(spark, sf).groupBy("snapshot_on", "step").agg(F.count("*").alias("n"))


def bat_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Publications of the last snapshot whose file no earlier stage log holds."""
    k = _keyed(spark, sf).where("sha256 is not null")
    last = k.agg(F.max("snapshot_on").alias("d"))
    now = k.join(F.broadcast(last), F.col("snapshot_on") == F.col("d")).select("pub_id", "sha256")
    log = k.join(F.broadcast(last), F.col("snapshot_on") < F.col("d")).select("pub_id", "sha256").distinct()
    return now.join(log, ["pub_id", "sha256"], "left_anti")


def upd_check(spark: SparkSession, sf: str) -> DataFrame:
    """Each publication of the last two snapshots: unchanged, or changed and how."""
    days = table(spark, sf, "publications").select("snapshot_on").distinct().withColumn("age", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("snapshot_on")))).where("age <= 2")
    k = _keyed(spark, sf).join(F.broadcast(days), "snapshot_on")
    cand = k.where("age = 1").select("pub_id", F.col("sha256").alias("c_sha"), F.col("pub_date").alias("c_date"), F.col("gate.status").alias("c_gate"), F.lit(1).alias("c"))
    held = k.where("age = 2").select("pub_id", F.col("sha256").alias("h_sha"), F.col("pub_date").alias("h_date"), F.lit(1).alias("h"))
    j = cand.join(held, "pub_id", "full_outer")
    state = (
        F.when(F.col("h").isNull(), "no_source").when(F.col("c").isNull(), "unreachable").when(F.col("c_gate") != "pass", "rejected").when(F.col("c_sha") == F.col("h_sha"), "unchanged")
        .when(F.col("c_date") > F.col("h_date"), "changed: newer").when(F.col("c_date") < F.col("h_date"), "changed: older").otherwise("changed: same or unknown date")
    )
    return j.select("pub_id", state.alias("state"))


QUERIES = {f.__name__: f for f in (gate_distribution, meta_pub_date, meta_supersedes, meta_norm_pub_id, src_pub_list, guard_gate, guard_tree_current, meta_proponent, bat_fetch_decision, bat_counts, bat_incremental, upd_check)}

_h = lambda p, g=0: f"nullif(regexp_extract(text, {rx.sql(p)}, {g}), '')"
_DECIDE = """select snapshot_on, pub_id, case when source_url is null and sha256 is null then 'no input' when lag(sha256) over w = sha256 and lag(gate.status) over w = 'pass' then 'skipped (same file)' else 'done' end as step
  from """ + _KEYED + " window w as (partition by pub_id order by snapshot_on)"
_LINE = "trim(regexp_replace(replace(pub_id, '-', ' ') || case when source_url is not null then '  ' || source_url else '' end || ' # noted', '#.*$', ''))"
SQL = {
    "gate_distribution": f"""select id, case when r is null and o is null and l is null and a is not null then 'pass' else 'fail' end as status,
      case when r is not null then upper(r) when o is not null then upper(o) when l is not null then null when a is not null then 'A' end as distribution,
      case when r is not null then 'restricted marking' when o is not null then 'other statement' when l is not null then 'limited release' when a is not null then 'open statement' else 'no statement' end as reason
      from (select id, {_h(RESTRICTED, 1)} as r, {_h(OTHER, 1)} as o, {_h(LIMITED, 1)} as l, {_h(OPEN, 1)} as a from {_FRONTS})""",
    "meta_pub_date": f"""select id, cast(strptime(coalesce({_h(AFTER_DC, 1)}, nullif(regexp_extract(regexp_replace(text, {rx.sql(SUPERSEDES)}, ' ', 'g'), {rx.sql(DATE)}, 1), '')), '%d %B %Y') as date) as pub_date from {_FRONTS}""",
    "meta_supersedes": f"select id, nullif(trim(regexp_extract(text, {rx.sql(SUPERSEDES)}, 1)), '') as supersedes from {_FRONTS}",
    "meta_norm_pub_id": f"select distinct supersedes, {_NORM.format('regexp_replace(supersedes, $$,.*$$$$, $$$$)'.replace('$$$$', chr(39) * 2).replace('$$,.*', chr(39) + ',.*$' + chr(39)).replace(chr(39) * 2 + ', ' + chr(39) * 2, ', ' + chr(39) * 2))} as old_id from publications where supersedes is not null",
    "src_pub_list": f"""select pub_id, source, lines, cast(sum(lines) over (partition by pub_id) as bigint) as listed from (select pub_id, source, count(*) as lines from (
      select {_NORM.format(f"regexp_replace(t, {rx.sql(_START)}, '')")} as pub_id, nullif(trim(regexp_extract(t, {rx.sql(_START)}, 1)), '') as source from (select {_LINE} as t from (select distinct pub_id, source_url from publications))) group by all)""",
    "guard_gate": f"select n.pub_id, count(*) as nodes from {nodes_sql('type')} n where exists (select 1 from {_LATEST} p where p.pub_id = n.pub_id and p.gate.status = 'pass' and p.gate.distribution = 'A') group by n.pub_id",
    "guard_tree_current": f"""select t.pub_id, t.tree_sha, case when p.pub_id is null then 'unknown' when p.sha256 = t.tree_sha then 'current' else 'stale' end as state from (
      select distinct json_extract_string(tree, '$.pub.pub_id') as pub_id, json_extract_string(tree, '$.pub.source_sha256') as tree_sha from (select tree from doc_trees where json_valid(tree))) t
      left join {_LATEST} p on p.pub_id = t.pub_id where t.pub_id is not null""",
    "meta_proponent": f"select pub_id, arg_min(p, (ord, p)) as proponent from (select pub_id, ord, trim(regexp_replace(regexp_extract(plain, {rx.sql(PROPONENT)}, 1), '\\s+', ' ', 'g')) as p from nodes where regexp_matches(plain, {rx.sql(PROPONENT)})) group by pub_id",
    "bat_fetch_decision": _DECIDE,
    "bat_counts": f"select snapshot_on, step, count(*) as n from ({_DECIDE}) group by all",
    "bat_incremental": f"""select pub_id, sha256 from {_KEYED} x where sha256 is not null and snapshot_on = (select max(snapshot_on) from publications where sha256 is not null)
      and not exists (select 1 from {_KEYED} y where y.pub_id = x.pub_id and y.sha256 = x.sha256 and y.snapshot_on < x.snapshot_on)""",
    "upd_check": f"""with d as (select snapshot_on, row_number() over (order by snapshot_on desc) as age from (select distinct snapshot_on from publications)), k as (select x.*, d.age from {_KEYED} x join d on d.snapshot_on = x.snapshot_on and d.age <= 2)
      select coalesce(c.pub_id, h.pub_id) as pub_id, case when h.pub_id is null then 'no_source' when c.pub_id is null then 'unreachable' when c.gate.status <> 'pass' then 'rejected' when c.sha256 = h.sha256 then 'unchanged'
        when c.pub_date > h.pub_date then 'changed: newer' when c.pub_date < h.pub_date then 'changed: older' else 'changed: same or unknown date' end as state
      from (select * from k where age = 1) c full join (select * from k where age = 2) h on h.pub_id = c.pub_id""",
}
SQL["meta_norm_pub_id"] = "select supersedes, " + _NORM.format("regexp_replace(supersedes, ',.*$', '')") + " as old_id from (select distinct supersedes from publications where supersedes is not null)"
