"""Signals, hints, budget and packet tables."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import rx, text as tx
from foliant.plans import index as ix
from foliant.plans.index import TEXTS, nodes, nodes_sql
from foliant.plans.structure import CONTAINERS, SQL as STRUCTURE_SQL, descend, node_words
from foliant.session import written

# Title rules (pattern, words, points) and counted words.
TITLE_RULES = [
    ("roles", r"(?i)PERSONNEL|RESPONSIBILIT|DUTIES|ROLES?\b|OFFICER|SERGEANT|OBSERVER|COORDINATOR|CHIEF OF|COMMAND POSTS?|ELEMENT|CELL\b|CENTER|HEADQUARTERS|TEAM\b|COMMANDER", 3.0),
    ("process_flow", r"(?i)PROCESS|PROCEDURE|STEPS?\b|SEQUENCE|METHOD|PLANNING|PREPARATION|EXECUTION|REHEARSAL|CLEARANCE|REQUEST", 2.5),
    ("cycle", r"(?i)CYCLE|D3A|DECIDE, DETECT|TARGETING PROCESS|CONTINUOUS", 3.0),
    ("checklist", r"(?i)PRINCIPLES?|CHARACTERISTICS|CONSIDERATIONS|TENETS|IMPERATIVES|FUNCTIONS|TASKS|REQUIREMENTS|COMPETENCIES|CAPABILITIES|FUNDAMENTALS|GUIDANCE|TRAIN", 2.5),
    ("timeline", r"(?i)PHASES?\b|TIMELINE|TRANSITION|SCHEDUL|DAY\b|HOURS?\b", 2.5),
    ("comparison", r"(?i)VERSUS|\bVS\b|TYPES OF|COMPARISON|DIFFERENCES", 2.0),
    ("decision_tree", r"(?i)DECISION|DETERMIN|SELECTION|CRITERIA|AUTHORITY", 1.5),
    ("do_dont", r"(?i)SAFETY|FRATRICIDE|DANGER CLOSE|PREVENT|AVOID", 2.0),
    ("key_terms", r"(?i)TERMS|DEFINITIONS|GLOSSARY|ACRONYMS", 3.0),
]
COUNTED = {
    "n_order": r"(?i)\b(first|second|third|then|next|after(?:wards)?|finally|once|following|subsequently|step \d|begins?|ends?)\b",
    "n_cond": r"(?i)\b(if\b[^.]{3,80}\bthen\b|unless\b|whether\b|in the event|depending on|when [^.,]{3,60},)",
    "n_contrast": r"(?i)\b(whereas|in contrast|unlike|on the other hand|differs?|versus|while [a-z]+ [a-z]+ (?:is|are))\b",
    "n_neg": r"(?i)\b(will not|must not|may not|do not|should not|never|avoid\w*|prohibit\w*)\b",
    "n_types": r"(?i)\b((?:two|three|four|five) (?:main |basic )?(?:types|categories|kinds|methods|forms))\b",
    "n_number": r"(?i)\b(\d[\d,.]*\s?(?:%|percent|km|kilometers?|meters?|m\b|miles?|minutes?|hours?|days?|mm|rounds?|seconds?|mils?|degrees?))",
    "n_loop": r"(?i)\b(cycle|continuous(?:ly)?|repeat\w*|iterative|loop)\b",
}
SAFETY = r"^(CAUTION|WARNING|DANGER)\b"
DUTY_WORD = r"(?i)\b(responsib\w*|charges|duties|serves as|in charge|advis\w+)\b"
ACTION = r"^(Check|Verify|Determine|Compute|Enter|Record|Establish|Identify|Select|Plan|Brief)\b"
_S = ("mandatory", "advisory", "permissive", "prohibitive")
_K = ("deadline", "duration", "time_reference")
_NAMES = [f"dir_{s}" for s in _S] + [f"time_{k}" for k in _K] + ["definition", "duty"]


def cls_node_signals(spark: SparkSession, sf: str, mentions: DataFrame | None = None) -> DataFrame:
    """Counts of each signal per node: directives by strength, times by kind, definitions, duties."""
    parts = [
        ix.directives(spark, sf).select("pub_id", "node_id", F.concat(F.lit("dir_"), "strength").alias("signal")),
        ix.deadlines(spark, sf).select("pub_id", "node_id", F.concat(F.lit("time_"), "kind").alias("signal")),
        ix.idx_inline_defs(spark, sf).select("pub_id", "node_id", F.lit("definition").alias("signal")),
        ix.role_duties(spark, sf, mentions).select("pub_id", "node_id", F.lit("duty").alias("signal")),
    ]
    u = functools.reduce(DataFrame.unionByName, parts)
    return u.groupBy("pub_id", "node_id").agg(*[F.count_if(F.col("signal") == s).alias(s) for s in _NAMES])


def unit_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Every unit's counts, summed over its nodes (no unit's text is put together). Mentions,
    units and signals are written first: the driver never holds the plans of all in one."""
    mentions = written(ix.role_mentions(spark, sf))
    at = written(descend(spark, sf))
    sig = written(cls_node_signals(spark, sf, mentions)).withColumnRenamed("node_id", "id")
    t = F.coalesce("plain", "caption", F.lit(""))
    counts = {"words": F.size(F.filter(F.split(t, r"\s+"), lambda x: x != ""))} | {k: F.size(tx.found(t, p)) for k, p in COUNTED.items()}
    flags = {"is_grid": F.col("grid") & (F.size("rows") > 0), "is_safe": t.rlike(SAFETY), "is_duty": t.rlike(DUTY_WORD), "is_action": t.rlike(ACTION), "is_lead": (F.col("type") == "paragraph") & F.rtrim(t).endswith(":")}
    n = nodes(spark, sf, "type", "depth", "parent_id", derived=counts | flags, where=~F.col("type").isin(*CONTAINERS))
    j = n.join(at, ["pub_id", "id"]).join(sig, ["pub_id", "id"], "left")
    # paragraphs that have something below them
    up = nodes(spark, sf, "parent_id", "type").where(~F.col("type").isin(*CONTAINERS)).select("pub_id", F.col("parent_id").alias("id")).distinct().withColumn("has_kids", F.lit(True))
    j = j.join(up, ["pub_id", "id"], "left")
    c = F.col
    g = j.groupBy("pub_id", "unit").agg(
        *[F.sum(k).alias(k) for k in ("words", *COUNTED)], *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in _NAMES],
        F.count_if(c("is_lead") & c("has_kids") & (c("parent_id") == c("unit"))).alias("n_lead"), F.count_if((c("type") == "list_item") & (c("depth") == 0) & c("is_action")).alias("n_action"), F.count_if(c("is_duty")).alias("n_duty_word"),
        F.count_if((c("type") == "table") & c("is_grid") & (c("parent_id") == c("unit"))).alias("n_grid"), F.count_if((c("type") == "list_item") & (c("depth") == 0)).alias("n_top"),
        F.count_if(c("type").isin("paragraph", "text")).alias("n_par"), F.count_if(c("type") == "paragraph").alias("n_numbered"), F.count_if(c("type") == "term").alias("n_term"),
        F.count_if((c("type") == "text") & c("is_safe")).alias("n_safe"),
    )
    # names and abbreviations of three letters and more count apart
    m = mentions.select("pub_id", F.col("node_id").alias("id"), F.explode(F.array(F.when(c("by_name") & (F.length("name") >= 3), F.lower("name")), F.when(c("by_abbreviation") & (F.length("abbreviation") >= 3), c("abbreviation")))).alias("who")).where("who is not null")
    named = m.join(at, ["pub_id", "id"]).groupBy("pub_id", "unit").agg(F.countDistinct("who").alias("n_named"))
    return g.join(named, ["pub_id", "unit"], "left").fillna(0, ["n_named"])


def _rules(c) -> list[tuple[str, object, object]]:
    """(pattern, condition, points) in rule order; ``c`` gives a column. The expressions
    are plain arithmetic, so the same text serves SQL."""
    per = "(greatest(words, 1) / 100.0)"
    return [
        ("table", "n_grid > 0", "3.0 + least(n_grid, 2)"),
        ("roles", "duty >= 2", "least(duty, 5) * 0.6"),
        ("checklist", "n_lead > 0", "1.5 * least(n_lead, 2)"),
        ("process_flow", "n_lead > 0 and n_action >= 3", "2.5"),
        ("checklist", "n_top between 3 and 8", "2.0"),
        ("process_flow", "n_top between 3 and 8 and n_order >= 2", "1.0 + 0.4 * least(n_order, 5)"),
        ("checklist", "n_top > 8", "1.0"),
        ("process_flow", f"n_order >= 3 and n_order / {per} >= 1.2", "1.0 + 0.3 * least(n_order, 8)"),
        ("cycle", "n_loop >= 2", "0.6 * least(n_loop, 6)"),
        ("timeline", "time_deadline + time_time_reference >= 1", "1.5 * least(time_deadline + time_time_reference, 4)"),
        ("do_dont", "n_neg >= 2", "0.5 * least(n_neg, 8)"),
        ("checklist", "dir_mandatory >= 3 and n_top >= 2", "1.0"),
        ("key_terms", "definition + n_term >= 3 and (definition + n_term) / (greatest(n_par, 1) * 1.0) >= 0.6", "1.0 * least(definition + n_term, 5)"),
        ("key_idea", "definition + n_term >= 1 and not (definition + n_term >= 3 and (definition + n_term) / (greatest(n_par, 1) * 1.0) >= 0.6)", "1.0"),
        ("decision_tree", f"n_cond >= 2 and n_cond / {per} >= 0.8", "0.7 * least(n_cond, 6)"),
        ("comparison", "n_contrast >= 2", "0.7 * least(n_contrast, 5)"),
        ("big_numbers", "n_number >= 2 and words < 400", "0.5 * least(n_number, 4)"),
        ("key_idea", "n_par <= 2 and words < 220", "1.5"),
        ("divider", "unit_type = 'division' and kind in ('chapter', 'appendix') and n_numbered = 0", "5.0"),
        ("do_dont", "n_safe > 0", "4.0"),
        ("comparison", "n_types >= 1", "2.0"),
        ("roles", "n_named >= 3 or (n_named >= 2 and n_duty_word > 0)", "1.0 + 0.5 * least(n_named, 6)"),
        ("checklist", "dir_mandatory + dir_advisory >= 4 and n_top = 0", "1.5"),
    ]


def cls_hints(spark: SparkSession, sf: str) -> DataFrame:
    """The four best patterns of each unit: points of the rules that hold, summed; ties go to
    the pattern whose rule came first; a unit without points falls back."""
    box = nodes(spark, sf, "type", "kind", "title", types=CONTAINERS).select("pub_id", F.col("id").alias("unit"), F.col("type").alias("unit_type"), "kind", F.coalesce("title", F.lit("")).alias("title"))
    u = written(unit_counts(spark, sf)).join(box, ["pub_id", "unit"])
    seq = 0
    rules = []
    for pattern, rule, pts in TITLE_RULES:
        seq += 1
        rules.append(F.when(F.col("title").rlike(rule), F.struct(F.lit(pattern).alias("pattern"), F.lit(float(pts)).alias("pts"), F.lit(seq).alias("seq"))))
    for pattern, cond, pts in _rules(F.col):
        seq += 1
        rules.append(F.when(F.expr(cond), F.struct(F.lit(pattern).alias("pattern"), F.expr(pts).cast("double").alias("pts"), F.lit(seq).alias("seq"))))
    hit = F.filter(F.array(*rules), lambda x: x.isNotNull())
    fall = F.struct(F.when(F.col("words") < 300, "key_idea").otherwise("checklist").alias("pattern"), F.lit(0.5).alias("pts"), F.lit(99).alias("seq"))
    rows = u.select("pub_id", "unit", "words", F.explode_outer(hit).alias("r")).withColumn("r", F.coalesce("r", fall))
    g = rows.groupBy("pub_id", "unit", "words", "r.pattern").agg(F.sum(F.round(F.col("r.pts") * 100).cast("long")).alias("points"), F.min("r.seq").alias("seq"))
    k = F.row_number().over(Window.partitionBy("pub_id", "unit").orderBy(F.desc("points"), "seq"))
    return g.withColumn("rank", k).where("rank <= 4").select("pub_id", "unit", "words", "pattern", "points", "rank")


DECK_MIN, DECK_MAX = 25, 40


def bud_dhondt(spark: SparkSession, sf: str, target: int = 34) -> DataFrame:
    """Content slides of each chapter and appendix: a chapter has a divider and one at least, an
    appendix none; the rest goes to the greatest quotients sqrt(words) / (slides + 1) until the
    deck has ``target`` with its seven fixed slides. All quotients at once: at most ``target``
    of a division can matter."""
    if not DECK_MIN <= target <= DECK_MAX:
        raise ValueError(f"target must be {DECK_MIN} to {DECK_MAX}, not {target}")
    c = nodes(spark, sf, "ord", "kind", types=("division",)).where(F.col("kind").isin("chapter", "appendix")).withColumn("base", (F.col("kind") == "chapter").cast("int"))
    d = c.join(node_words(spark, sf).select("pub_id", "id", "words"), ["pub_id", "id"]).withColumn("left", target - 7 - 2 * F.sum("base").over(Window.partitionBy("pub_id")))
    q = d.select("pub_id", "id", "ord", "words", "base", "left", F.explode(F.sequence(F.col("base") + 1, F.lit(target + 1))).alias("k"))
    q = q.withColumn("rank", F.row_number().over(Window.partitionBy("pub_id").orderBy(F.desc(F.sqrt(F.col("words").cast("double")) / F.col("k")), "ord", "k")))
    extra = q.where("rank <= left").groupBy("pub_id", "id").agg(F.count("*").alias("more"))
    return d.join(extra, ["pub_id", "id"], "left").select("pub_id", "id", "kind", "words", (F.col("base") + F.coalesce("more", F.lit(0))).alias("slides"))


def pkt_requirements(spark: SparkSession, sf: str) -> DataFrame:
    """Mandatory and prohibitive statements that aren't historical, by division."""
    div = nodes(spark, sf, "division_id", types=TEXTS).withColumnRenamed("id", "node_id")
    d = ix.directives(spark, sf).where(F.col("strength").isin("mandatory", "prohibitive") & ~F.col("possibly_historical"))
    return d.select("pub_id", "node_id", "sentence_no", "verb", "cite").join(div, ["pub_id", "node_id"])


def pkt_deadlines(spark: SparkSession, sf: str) -> DataFrame:
    return ix.deadlines(spark, sf).where("kind <> 'duration'")


def pkt_roles(spark: SparkSession, sf: str) -> DataFrame:
    """Roles with a paragraph that names them, by division, most named first."""
    p = nodes(spark, sf, "division_id", types=("paragraph",)).withColumnRenamed("id", "node_id")
    m = ix.role_mentions(spark, sf).select("pub_id", "node_id", "name")
    g = m.join(p, ["pub_id", "node_id"]).groupBy("pub_id", "division_id", "name").agg(F.count("*").alias("n"))
    return g.withColumn("rank", F.row_number().over(Window.partitionBy("pub_id", "division_id").orderBy(F.desc("n"), "name")))


def pkt_acronyms(spark: SparkSession, sf: str) -> DataFrame:
    """How often each division uses a publication's acronyms (as tokens)."""
    a = nodes(spark, sf, "abbreviation", types=("acronym",)).select("pub_id", F.col("abbreviation").alias("token")).distinct()
    n = nodes(spark, sf, "division_id", "plain", types=TEXTS)
    t = n.select("pub_id", "division_id", F.explode(F.split("plain", r"[^A-Za-z0-9_-]+")).alias("token")).where(F.col("token").rlike("^[A-Z]"))
    return t.groupBy("pub_id", "division_id", "token").agg(F.count("*").alias("n")).join(a, ["pub_id", "token"], "left_semi")


def pkt_outline(spark: SparkSession, sf: str) -> DataFrame:
    """Headings of each division in order, indented by depth."""
    h = nodes(spark, sf, "ord", "path", "title", "division_id", types=CONTAINERS)
    return h.select("pub_id", "division_id", "ord", F.concat(F.repeat(F.lit("  "), F.size("path")), F.lit("- "), "title").alias("line"))


QUERIES = {f.__name__: f for f in (cls_node_signals, cls_hints, bud_dhondt, pkt_requirements, pkt_deadlines, pkt_roles, pkt_acronyms, pkt_outline)}

SIGNALS_SQL = f"""
  select pub_id, node_id, {", ".join(f"count(*) filter (signal = '{s}') as {s}" for s in _NAMES)} from (
    select pub_id, node_id, 'dir_' || strength as signal from ({ix.DIRECTIVES_SQL}) union all select pub_id, node_id, 'time_' || kind from ({ix.DEADLINES_SQL})
    union all select pub_id, node_id, 'definition' from ({ix.INLINE_SQL}) union all select pub_id, node_id, 'duty' from ({ix.ROLE_DUTIES_SQL})) group by pub_id, node_id"""
_T = "coalesce(plain, caption, '')"
UNITS_SQL = f"""
  select n.pub_id, d.unit, {", ".join(f"sum({k}) as {k}" for k in ("words", *COUNTED))}, {", ".join(f"coalesce(sum({k}), 0) as {k}" for k in _NAMES)},
    count(*) filter (type = 'table' and is_grid and n.parent_id = d.unit) as n_grid, count(*) filter (type = 'list_item' and depth = 0) as n_top,
    count(*) filter (type in ('paragraph', 'text')) as n_par, count(*) filter (type = 'paragraph') as n_numbered, count(*) filter (type = 'term') as n_term,
    count(*) filter (type = 'text' and is_safe) as n_safe, count(*) filter (type = 'paragraph' and ends_with(rtrim(t), ':') and n.parent_id = d.unit and k.pub_id is not null) as n_lead,
    count(*) filter (type = 'list_item' and depth = 0 and regexp_matches(t, {rx.sql(ACTION)})) as n_action, count(*) filter (regexp_matches(t, {rx.sql(DUTY_WORD)})) as n_duty_word, coalesce(max(w.n), 0) as n_named
  from (select pub_id, {_T} as t, id, type, depth, parent_id, grid and len(rows) > 0 as is_grid, regexp_matches({_T}, {rx.sql(SAFETY)}) as is_safe,
      len(list_filter(regexp_split_to_array({_T}, '\\s+'), lambda x: x <> '')) as words, {", ".join(f"len(regexp_extract_all({_T}, {rx.sql(p)})) as {k}" for k, p in COUNTED.items())}
    from {nodes_sql("type, plain, caption, depth, grid, rows, parent_id")} where type not in ('division', 'section', 'heading')) n
  join ({STRUCTURE_SQL["descend"]}) d on d.pub_id = n.pub_id and d.id = n.id
  left join ({SIGNALS_SQL}) s on s.pub_id = n.pub_id and s.node_id = n.id
  left join (select distinct pub_id, parent_id from nodes where type not in ('division', 'section', 'heading')) k on k.pub_id = n.pub_id and k.parent_id = n.id
  left join (select m.pub_id, u.unit, count(distinct m.who) as n from (
      select pub_id, node_id, unnest([case when by_name and length(name) >= 3 then lower(name) end, case when by_abbreviation and length(abbreviation) >= 3 then abbreviation end]) as who from ({ix._MENTION})) m
    join ({STRUCTURE_SQL["descend"]}) u on u.pub_id = m.pub_id and u.id = m.node_id where m.who is not null group by all) w on w.pub_id = n.pub_id and w.unit = d.unit
  group by n.pub_id, d.unit"""


def _hints_sql() -> str:
    seq, rows = 0, []
    for pattern, rule, pts in TITLE_RULES:
        seq += 1
        rows.append(f"select pub_id, unit, words, '{pattern}' as pattern, {float(pts)} as pts, {seq} as seq from u where regexp_matches(title, {rx.sql(rule)})")
    for pattern, cond, pts in _rules(None):
        seq += 1
        rows.append(f"select pub_id, unit, words, '{pattern}', cast({pts} as double), {seq} from u where {cond}")
    return f"""with u as (select x.*, b.type as unit_type, b.kind, coalesce(b.title, '') as title from ({UNITS_SQL}) x join {nodes_sql("type, kind, title", CONTAINERS)} b on b.pub_id = x.pub_id and b.id = x.unit),
      r as ({" union all ".join(rows)}),
      f as (select * from r union all select pub_id, unit, words, case when words < 300 then 'key_idea' else 'checklist' end, 0.5, 99 from u where not exists (select 1 from r where r.pub_id = u.pub_id and r.unit = u.unit)),
      g as (select pub_id, unit, words, pattern, sum(cast(round(pts * 100) as bigint)) as points, min(seq) as seq from f group by all)
      select pub_id, unit, cast(words as bigint) as words, pattern, cast(points as bigint) as points, rank from (select *, row_number() over (partition by pub_id, unit order by points desc, seq) as rank from g) where rank <= 4"""


SQL = {
    "cls_node_signals": SIGNALS_SQL,
    "cls_hints": _hints_sql(),
    "bud_dhondt": f"""with d as (select c.pub_id, c.id, c.ord, c.kind, w.words, cast(c.kind = 'chapter' as int) as base, 34 - 7 - 2 * count(*) filter (c.kind = 'chapter') over (partition by c.pub_id) as rest
        from {nodes_sql("ord, kind", ("division",), "kind in ('chapter', 'appendix')")} c join ({STRUCTURE_SQL["node_words"]}) w on w.pub_id = c.pub_id and w.id = c.id),
      q as (select *, row_number() over (partition by pub_id order by sqrt(cast(words as double)) / k desc, ord, k) as rank from d, (select unnest(generate_series(1, 35)) as k) where k > base)
      select d.pub_id, d.id, d.kind, d.words, d.base + (select count(*) from q where q.pub_id = d.pub_id and q.id = d.id and q.rank <= q.rest) as slides from d""",
    "pkt_requirements": f"select d.pub_id, d.node_id, d.sentence_no, d.verb, d.cite, n.division_id from ({ix.DIRECTIVES_SQL}) d join {nodes_sql('division_id', TEXTS)} n on n.pub_id = d.pub_id and n.id = d.node_id where strength in ('mandatory', 'prohibitive') and not possibly_historical",
    "pkt_deadlines": f"select * from ({ix.DEADLINES_SQL}) where kind <> 'duration'",
    "pkt_roles": f"""select *, row_number() over (partition by pub_id, division_id order by n desc, name) as rank from (
      select m.pub_id, p.division_id, m.name, count(*) as n from ({ix._MENTION}) m join {nodes_sql('division_id', ('paragraph',))} p on p.pub_id = m.pub_id and p.id = m.node_id group by all)""",
    "pkt_acronyms": f"""select t.pub_id, t.division_id, t.token, count(*) as n from (select pub_id, division_id, unnest(regexp_split_to_array(plain, '[^A-Za-z0-9_-]+')) as token from {nodes_sql('division_id, plain', TEXTS)}) t
      where exists (select 1 from nodes a where a.type = 'acronym' and a.pub_id = t.pub_id and a.abbreviation = t.token) group by all""",
    "pkt_outline": f"select pub_id, division_id, ord, repeat('  ', len(path)) || '- ' || title as line from {nodes_sql('ord, path, title, division_id', CONTAINERS)}",
}
