"""Layout lines, tables and words: the set-based passes between pages and blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import rx, text as tx
from foliant.operators import ordered, tables as tb
from foliant.plans.index import TEXTS, nodes, nodes_sql
from foliant.session import table

FOOTER_Y, HEADER_Y = 735.0, 55.0

# Layout lines stand in for a page decoder: one order is a page, its items are its lines.
LINES = """
  select l_orderkey as page, l_linenumber * 10000000000 + l_partkey * 10000 + l_suppkey as line_no, 50.0 + 11.0 * l_linenumber + (l_suppkey % 3) * 6.0 + case when l_linenumber > 6 then 640.0 else 0.0 end as y,
    case l_returnflag when 'A' then 'Arial-Bold' when 'R' then 'Times-Bold' else 'Times-BoldItalic' end as font, 10.5 + (l_partkey % 6) as size,
    case when l_linenumber > 6 then concat(cast(l_suppkey % 9 as {s}), '-', cast(l_partkey % 50 as {s})) when l_suppkey % 7 = 0 then concat('Chapter ', cast(l_partkey % 9 as {s}))
      when l_suppkey % 11 = 0 then concat('SECTION ', l_linestatus) when l_suppkey % 5 = 0 then concat('Line ', cast(l_partkey % 40 as {s}), '.') else concat(l_linestatus, ' item ', cast(l_suppkey % 40 as {s})) end as text
  from lineitem"""


def lines(spark: SparkSession, sf: str) -> DataFrame:
    table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_returnflag", "l_linestatus").createOrReplaceTempView("lineitem")
    return spark.sql(LINES.format(s="string"))


_LINES_SQL = "(" + LINES.format(s="varchar") + ")"
# A line's tier by font and size; italics and other weights have none.
TIER = """case when font not like '%Bold%' or font like '%Italic%' then null
  when (font like 'Arial%' or font like 'Helvetica%') and size >= 15.5 then 'T1'
  when (font like 'Arial%' or font like 'Helvetica%') and size >= 11.5 and size < 12.5 then case when {label} then 'LBL' when upper(text) like 'SECTION %' then 'T2' else 'T2+' end
  when font like 'Times%' and size >= 13.5 and size < 14.5 then 'T3' when font like 'Times%' and size >= 11.5 and size < 12.5 then 'T4'
  when font like 'Times%' and size >= 10.5 and size < 11.5 then 'T5' end"""
# Forms of labels and of zones.
LABEL, PAGE_LABEL = r"^(Chapter \d+|Appendix [A-Z])$", r"^(?:[A-Z]|\d+|Glossary|References|Index|Source Notes)-\d+$|^[ivxlc]+$"


def _tiers(spark: SparkSession, sf: str) -> DataFrame:
    d = lines(spark, sf).withColumn("is_label", F.col("text").rlike(LABEL))
    return d.withColumn("tier", F.expr(TIER.format(label="is_label"))).drop("is_label")


_TIERS_SQL = f"(select *, {TIER.format(label=f'regexp_matches(text, {rx.sql(LABEL)})')} as tier from {_LINES_SQL})"


def lay_tier(spark: SparkSession, sf: str) -> DataFrame:
    return _tiers(spark, sf).groupBy("tier").agg(F.count("*").alias("n"), F.min("y").alias("top"))


def lay_page_label(spark: SparkSession, sf: str) -> DataFrame:
    """The printed label of a page: the last line below the footer mark that reads like one."""
    d = lines(spark, sf).where((F.col("y") > FOOTER_Y - 50) & F.col("text").rlike(PAGE_LABEL))
    return d.groupBy("page").agg(F.max_by("text", "line_no").alias("label"))


def lay_wrap_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Headings with their wrapped lines and, of a title, the label line before it. A line of the
    same tier (for section headings also their own kind of second lines) at most 1.6 sizes below
    the line before continues it (islands over ``lag``); second lines that continue nothing are
    dropped first. A label counts until the next heading begins."""
    t = _tiers(spark, sf).where((F.col("y") >= HEADER_Y) & (F.col("y") <= FOOTER_Y) & F.col("tier").isNotNull())
    w = Window.partitionBy("page").orderBy("y", "line_no")
    cls, gap = F.regexp_replace("tier", r"\+$", ""), F.col("y") - F.lag("y").over(w)
    follows = (F.lag("cls").over(w) == F.col("cls")) & (gap > 0) & (gap <= 1.6 * F.col("size"))
    h = t.where("tier <> 'LBL'").withColumn("cls", cls)
    # an island of second lines without a first one continues nothing
    h = h.withColumn("new", F.when(F.coalesce(follows & (F.col("cls") == "T2") & (F.col("tier") == "T2+"), F.lit(False)), 0).otherwise(1)).withColumn("isle", F.sum("new").over(w))
    first = F.first("tier").over(Window.partitionBy("page", "isle").orderBy("y", "line_no"))
    h = h.withColumn("first", first).where("first <> 'T2+'").drop("new", "isle", "first")
    h = h.withColumn("new", F.when(F.coalesce(follows, F.lit(False)), 0).otherwise(1))
    # labels stand among the headings again
    u = h.unionByName(t.where("tier = 'LBL'").withColumn("cls", F.lit("LBL")).withColumn("new", F.lit(0)))
    upto = w.rowsBetween(Window.unboundedPreceding, -1)
    at = F.struct("y", "line_no")
    u = u.withColumn("lbl", F.max(F.when(F.col("cls") == "LBL", F.struct("y", "line_no", "text"))).over(upto)).withColumn("head", F.max(F.when(F.col("new") == 1, at)).over(upto))
    label = F.when((F.col("tier") == "T1") & (F.col("new") == 1) & (F.col("head").isNull() | (F.struct("lbl.y", "lbl.line_no") > F.col("head"))), F.col("lbl.text"))
    u = u.withColumn("label", label).withColumn("no", F.sum("new").over(w)).where("cls <> 'LBL'")
    g = u.groupBy("page", "no").agg(F.array_sort(F.collect_list(F.struct("y", "line_no", "text"))).alias("ls"), F.max("cls").alias("tier"), F.max("label").alias("label"))
    return g.select("page", "no", "tier", "label", F.array_join(F.transform("ls", lambda x: x["text"]), " ").alias("text"))


_WRAP = f"""with t as (select * from {_TIERS_SQL} where y >= {HEADER_Y} and y <= {FOOTER_Y} and tier is not null),
    a as (select *, regexp_replace(tier, '\\+$', '') as cls from t where tier <> 'LBL'),
    a2 as (select *, lag(cls) over w as up_cls, y - lag(y) over w as gap from a window w as (partition by page order by y, line_no)),
    b as (select page, line_no, y, text, tier, cls, size, sum(case when tier = 'T2+' and up_cls = 'T2' and gap > 0 and gap <= 1.6 * size then 0 else 1 end) over (partition by page order by y, line_no) as isle from a2),
    c as (select * from (select *, first_value(tier) over (partition by page, isle order by y, line_no) as first_tier from b) where first_tier <> 'T2+'),
    d as (select page, line_no, y, text, tier, cls, case when lag(cls) over w = cls and y - lag(y) over w > 0 and y - lag(y) over w <= 1.6 * size then 0 else 1 end as new from c window w as (partition by page order by y, line_no)),
    e as (select *, sum(new) over (partition by page order by y, line_no) as no from d),
    g as (select page, no, max(cls) as tier, string_agg(text, ' ' order by y, line_no) as text, min((y, line_no)) as pos from e group by page, no),
    f as (select *, lag(pos) over (partition by page order by no) as before from g)
    select page, cast(no as bigint) as no, tier, text, case when tier = 'T1' then (select arg_max(l.text, (l.y, l.line_no)) from t l where l.tier = 'LBL' and l.page = f.page and (l.y, l.line_no) < f.pos and (f.before is null or (l.y, l.line_no) > f.before)) end as label from f"""


def lay_drop_runin(spark: SparkSession, sf: str) -> DataFrame:
    """Bold run-in sentences aren't headings."""
    h = lay_wrap_merge(spark, sf).where(F.col("tier").isin("T1", "T2") | ((F.length("text") <= 150) & ~F.col("text").endswith(".")))
    return h.groupBy("tier").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


def meta_title(spark: SparkSession, sf: str) -> DataFrame:
    """The first title line of each page that is no publication number or list heading."""
    t = _tiers(spark, sf).where((F.col("tier") == "T1") & ~F.col("text").rlike(r"(?i)^([A-Z]{2,4} \d|Contents$|Figures$|Tables$)|DISTRIBUTION"))
    return t.groupBy("page").agg(F.min_by("text", F.struct("y", "line_no")).alias("title"))


def blk_levels(spark: SparkSession, sf: str) -> DataFrame:
    """Heading levels anew: 2 + the rank of the level among those that its division uses."""
    h = nodes(spark, sf, "division_id", "level", types=("heading",))
    used = h.select("pub_id", "division_id", "level").distinct().withColumn("rank", F.dense_rank().over(Window.partitionBy("pub_id", "division_id").orderBy("level")))
    return h.join(used, ["pub_id", "division_id", "level"]).select("pub_id", "id", (F.col("rank") + 1).alias("level"))


ZONE_DROP, ZONE_KEEP, ZONE_STOP = r"(?i)^(Contents|Figures|Tables)$", r"(?i)^(Preface|Introduction|Chapter \d+|Appendix [A-Z]|Source Notes|Glossary|References)", r"(?i)^Index$"


def blk_zones(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes up to the index, each with the zone in force: the name of the last title that opens
    one. Lists of contents close it, other titles leave it; what stands in none is dropped."""
    n = nodes(spark, sf, "ord", "type", "title", "kind", "number")
    t = F.when(F.col("kind").isin("chapter", "appendix"), F.concat(F.initcap("kind"), F.lit(" "), F.coalesce("number", F.lit("")), F.lit(": "), F.coalesce("title", F.lit("")))).otherwise(F.col("title"))
    title = F.when(F.col("type") == "division", t)
    event = F.when(title.rlike(ZONE_DROP), F.lit("")).when(title.rlike(ZONE_KEEP), F.regexp_extract(title, "^([^:]*)", 1))
    stop = n.where(F.col("type") == "division").where(F.col("title").rlike(ZONE_STOP)).groupBy("pub_id").agg(F.min("ord").alias("stop"))
    n = ordered.last_before(n, ["pub_id"], "ord", event, "zone", here=True).join(stop, "pub_id", "left")
    return n.where("(stop is null or ord < stop) and zone <> ''").select("pub_id", "id", "zone")


# How a cut text ends and how the rest begins; words that end no text.
OPEN, CONTINUES, FRESH = r"[A-Za-z0-9,–-]$", r"^[a-z0-9(\"“]", r"^\**([A-Z]|\d+)-\d+\.\**\s"
CONNECTORS = "a an the and or nor but of to in on for with by as at from that which is are be will must may its their".split()


def blk_join_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Texts that a page break cut: one that ends open (a connector, hyphen, comma or bare word)
    and the next text on a later page, tables and figures between them passed over, that
    continues it: it begins in lower case, with a digit or an opening mark, or the end before
    leaves no other reading."""
    n = nodes(spark, sf, "ord", "page", "plain", "type", "number", types=("paragraph", "list_item", "text")).where("trim(plain) <> ''")
    n = ordered.neighbour(n.withColumn("t", F.trim("plain")), ["pub_id"], "ord", ["t", "page", "type"], "a")
    end, word = F.col("a.t"), F.lower(F.regexp_extract("a.t", r"(\S+)$", 1))
    strong = end.rlike("[-,]$") | word.isin(*CONNECTORS) | (end.rlike("[a-z]$") & ((F.col("a.type") != "list_item") | (F.size(F.split(end, r"\s+")) >= 8)))
    fresh = F.col("number").isNotNull() & (F.col("type") == "paragraph") | F.col("t").rlike(FRESH)
    joined = (F.col("page") > F.col("a.page")) & (F.col("type") != "list_item") & end.rlike(OPEN) & ~fresh & (F.col("t").rlike(CONTINUES) | strong)
    n = ordered.running_sum(n, ["pub_id"], "ord", F.when(joined, 0).otherwise(1), "no")
    return n.groupBy("pub_id", "no").agg(F.count("*").alias("parts"), F.min("ord").alias("ord"), F.sum(F.length("plain")).alias("chars"))


# --- tables ------------------------------------------------------------------------------
def _tokens(c: F.Column) -> F.Column:
    return F.filter(F.transform(F.split(F.lower(c), r"[\s/|]+|<br>"), lambda w: F.regexp_replace(w, "[^a-z0-9]", "")), lambda w: w != "")


def _tokens_sql(c: str) -> str:
    return f"list_filter(list_transform(regexp_split_to_array(lower({c}), '[\\s/|]+|<br>'), lambda w: regexp_replace(w, '[^a-z0-9]', '', 'g')), lambda w: w <> '')"


def tbl_score(spark: SparkSession, sf: str) -> DataFrame:
    """How well a cut sentence repeats its node: recall of the node's words (as a multiset)
    less the share of words that the node doesn't have."""
    d = table(spark, sf, "directives").select("pub_id", "node_id", "sentence").distinct().withColumn("k", F.md5("sentence"))
    n = nodes(spark, sf, "plain", types=TEXTS).withColumnRenamed("id", "node_id")
    j = d.join(n, ["pub_id", "node_id"])
    got = j.select("pub_id", "node_id", "k", F.explode(_tokens(F.col("sentence"))).alias("t")).groupBy("pub_id", "node_id", "k", "t").agg(F.count("*").alias("g"))
    pdf = j.select("pub_id", "node_id", "k", F.explode(_tokens(F.col("plain"))).alias("t")).groupBy("pub_id", "node_id", "k", "t").agg(F.count("*").alias("p"))
    m = got.join(pdf, ["pub_id", "node_id", "k", "t"], "full_outer").fillna(0, ["g", "p"])
    s = m.groupBy("pub_id", "node_id", "k").agg(F.sum(F.least("g", "p")).alias("both"), F.sum("p").alias("p"), F.sum(F.greatest(F.col("g") - F.col("p"), F.lit(0))).alias("stray"), F.sum("g").alias("g"))
    return s.where("p > 0 and g > 0").select("pub_id", "node_id", "k", F.round(F.col("both") / F.col("p") - F.col("stray") / F.col("g"), 6).alias("score"))


def tbl_rebuild_select(spark: SparkSession, sf: str) -> DataFrame:
    """For each table the other table on its page (a page holds few) with the greatest
    Jaccard similarity of words; it is taken from 0.4 on."""
    t = nodes(spark, sf, "page", "rows", types=("table",)).where(F.size("rows") > 0)
    t = t.select("pub_id", "id", "page", F.array_distinct(_tokens(F.array_join(F.flatten("rows"), " "))).alias("ts"))
    b = t.select("pub_id", "page", F.col("id").alias("cand"), F.col("ts").alias("us"))
    j = t.join(b, ["pub_id", "page"]).where("id <> cand")
    j = j.withColumn("sim", F.round(F.size(F.array_intersect("ts", "us")) / F.greatest(F.lit(1), F.size(F.array_union("ts", "us"))), 6))
    return j.groupBy("pub_id", "id").agg(F.max_by(F.struct("cand", "sim"), F.struct("sim", "cand")).alias("m")).select("pub_id", "id", "m.cand", "m.sim", (F.col("m.sim") >= 0.4).alias("accepted"))


def tbl_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Lines to row bands of 40 points, a point of leeway on either side; the first band
    that takes a line has it. A band join by arithmetic: no pair is formed."""
    b = F.ceil((F.col("y") - 1 - 90) / 40).cast("int")
    d = lines(spark, sf).where("y between 49 and 690").withColumn("band", F.greatest(F.lit(0), b))
    return d.groupBy("page", "band").agg(F.count("*").alias("n"), F.min("line_no").alias("first"))


def tbl_merge_continued(spark: SparkSession, sf: str) -> DataFrame:
    """Tables with their continued parts: a table whose caption says "(continued)" belongs to the
    one right before it with its number, unless a heading stands between. Rows in order, less a
    header that the first part has too."""
    n = nodes(spark, sf, "ord", "type", "number", "caption", "columns", "rows", types=("table", "division", "section", "heading"))
    n = ordered.neighbour(n, ["pub_id"], "ord", ["type", "number"], "up")
    goes_on = (F.col("type") == "table") & F.contains("caption", F.lit("(continued)")) & (F.col("up.type") == "table") & (F.col("up.number") == F.col("number"))
    n = ordered.running_sum(n, ["pub_id"], "ord", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1), "isle").where("type = 'table'")
    g = n.groupBy("pub_id", "isle").agg(F.array_sort(F.collect_list(F.struct("ord", "id", "columns", "rows"))).alias("ps"))
    head = F.transform(F.get("ps", F.lit(0))["columns"], lambda c: tb.bare(F.coalesce(c, F.lit(""))))
    same = lambda r, i: (i > 0) & F.transform(r, lambda c: tb.bare(F.coalesce(c, F.lit("")))).eqNullSafe(head)
    rows = F.flatten(F.transform("ps", lambda p, i: F.filter(F.coalesce(p["rows"], F.array().cast("array<array<string>>")), lambda r: ~same(r, i))))
    return g.select("pub_id", F.get("ps", F.lit(0))["id"].alias("id"), F.size("ps").alias("parts"), F.size(rows).alias("n_rows"), F.md5(F.array_join(F.flatten(rows), "|", "")).alias("digest"))


def tbl_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Tables put in order: see ``foliant.operators.tables.clean``."""
    t = tb.cleaned(nodes(spark, sf, "rows", types=("table",)).where("rows is not null"), "rows", "c")
    return t.select("pub_id", "id", F.size("c.rows").alias("n_rows"), F.array_join(F.flatten("c.rows"), "|", "").alias("cells"), F.array_join("c.notes", "|").alias("notes"))


def tbl_legend_source(spark: SparkSession, sf: str) -> DataFrame:
    """Tables with an abbreviation key and the acronyms of the glossary that it leaves out."""
    t = nodes(spark, sf, "key", types=("table",)).where("key is not null")
    abbr = tx.found(F.col("key"), r"\b([A-Z][A-Z0-9/]+)\s*[–-]\s*[a-zA-Z]")
    return t.select("pub_id", "id", F.array_join(F.array_sort(F.array_distinct(abbr)), ",").alias("abbreviations"))


# --- words ---------------------------------------------------------------------------------
def wrd_joined_fixes(spark: SparkSession, sf: str) -> DataFrame:
    """Rare long words of the statements that the publications never print whole but print
    in two parts across a line break; both parts are words of their own."""
    words = table(spark, sf, "claims").select(F.explode(tx.found(F.lower("text"), "([a-z]+)")).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    pdf = nodes(spark, sf, "plain", types=TEXTS)
    whole = pdf.select(F.explode(tx.found(F.lower("plain"), "([a-z]+)")).alias("w")).distinct()
    broken = pdf.select(F.explode(tx.found(F.lower("plain"), r"([a-z]+-?[ \t]*\n[ \t]*[a-z]+)")).alias("m"))
    broken = broken.select(F.regexp_extract("m", "^([a-z]+)", 1).alias("a"), F.regexp_extract("m", "([a-z]+)$", 1).alias("b"), F.contains("m", F.lit("-")).alias("hyphen")).groupBy("a", "b").agg(F.max("hyphen").alias("hyphen"))
    rare = words.where("length(w) >= 7 and n <= 5").join(whole, "w", "left_anti")
    cut = rare.select("w", F.explode(F.sequence(F.lit(2), F.length("w") - 3)).alias("i")).select("w", "i", F.expr("substring(w, 1, i)").alias("a"), F.expr("substring(w, i + 1)").alias("b"))
    some = words.where("n >= 3").select("w")
    cut = cut.join(some.withColumnRenamed("w", "a"), "a", "left_semi").join(some.withColumnRenamed("w", "b"), "b", "left_semi").join(broken, ["a", "b"])
    return cut.groupBy("w").agg(F.min_by(F.concat("a", F.when(F.col("hyphen"), "-").otherwise(" "), "b"), "i").alias("fix"))


SUSPENDED = r"\b([a-z]+)- (and/or|and|or|nor|to|through)\b"
REF_SPACE = r"\b(JP|FM|ATP|ADP|ADRP|TC|AR|DA Form|Table|table|Figure|figure|para(?:graph)?) ([0-9A-Z]{1,2})- (\d)"
STAFF_SPACE = r"\b([SG])- (\d)\b"
HYPHEN_SPACE = r"\b([a-z]+)- ([a-z][a-z/]*)\b"


def wrd_apply(spark: SparkSession, sf: str) -> DataFrame:
    """Split references and hyphens closed up, but not before a suspended word. The input is
    each statement with its first blank after a hyphen or number put in."""
    c = table(spark, sf, "claims").where("text is not null").select("text").distinct()
    t = F.regexp_replace("text", r"([a-z]{3})([a-z]{3}) (and|or|to|on) ", "$1- $2 $1- $3 S- 2 FM 3- 09 ")
    t0 = t
    t = F.regexp_replace(F.regexp_replace(t, REF_SPACE, "$1 $2-$3"), STAFF_SPACE, "$1-$2")
    t = F.regexp_replace(t, SUSPENDED, "$1-\x01$2")
    t = F.replace(F.regexp_replace(t, HYPHEN_SPACE, "$1-$2"), F.lit("-\x01"), F.lit("- "))
    return c.select(t0.alias("before"), t.alias("after"))


_WA = "regexp_replace(text, '([a-z]{3})([a-z]{3}) (and|or|to|on) ', '\\1- \\2 \\1- \\3 S- 2 FM 3- 09 ', 'g')"
_WB = f"regexp_replace(regexp_replace({_WA}, {rx.sql(REF_SPACE)}, '\\1 \\2-\\3', 'g'), {rx.sql(STAFF_SPACE)}, '\\1-\\2', 'g')"
_WC = f"replace(regexp_replace(regexp_replace({_WB}, {rx.sql(SUSPENDED)}, '\\1-' || chr(1) || '\\2', 'g'), {rx.sql(HYPHEN_SPACE)}, '\\1-\\2', 'g'), '-' || chr(1), '- ')"


def gls_format(spark: SparkSession, sf: str) -> DataFrame:
    """The glossary as one acronym table per publication and one line per term."""
    n = nodes(spark, sf, "ord", "type", "abbreviation", "meaning", "term", "definition", types=("acronym", "term"))
    line = F.when(F.col("type") == "acronym", F.concat(F.lit("| "), "abbreviation", F.lit(" | "), "meaning", F.lit(" |"))).otherwise(F.concat(F.lit("**"), "term", F.lit("** — "), "definition"))
    return n.select("pub_id", "ord", "type", line.alias("line"))


def conv_report(spark: SparkSession, sf: str) -> DataFrame:
    n = nodes(spark, sf, "type", "grid", "page")
    c = F.col("type")
    return n.groupBy("pub_id").agg(F.count_if(c == "heading").alias("headings"), F.count_if((c == "table") & F.col("grid")).alias("tables"), F.count_if(c == "paragraph").alias("paragraphs"), F.max("page").alias("pages"))


_BARE = lambda c: f"regexp_replace(lower(coalesce({c}, '')), '[^a-z0-9]+', '', 'g')"
QUERIES = {f.__name__: f for f in (lay_tier, lay_page_label, lay_wrap_merge, lay_drop_runin, meta_title, blk_levels, blk_zones, blk_join_pages, tbl_score, tbl_rebuild_select, tbl_grid, tbl_merge_continued, tbl_clean, tbl_legend_source, wrd_joined_fixes, wrd_apply, gls_format, conv_report)}
_D = "(select distinct pub_id, node_id, sentence, md5(sentence) as k from directives)"
SQL = {
    "lay_tier": f"select tier, count(*) as n, cast(min(y) as double) as top from {_TIERS_SQL} group by tier",
    "lay_page_label": f"select page, arg_max(text, line_no) as label from {_LINES_SQL} where y > {FOOTER_Y - 50} and regexp_matches(text, {rx.sql(PAGE_LABEL)}) group by page",
    "lay_wrap_merge": _WRAP,
    "lay_drop_runin": f"select tier, count(*) as n, cast(sum(length(text)) as bigint) as chars from ({_WRAP}) where tier in ('T1', 'T2') or (length(text) <= 150 and not ends_with(text, '.')) group by tier",
    "meta_title": f"select page, arg_min(text, (y, line_no)) as title from {_TIERS_SQL} where tier = 'T1' and not regexp_matches(text, '(?i)^([A-Z]{{2,4}} \\d|Contents$|Figures$|Tables$)|DISTRIBUTION') group by page",
    "blk_levels": f"select pub_id, id, 1 + dense_rank() over (partition by pub_id, division_id order by level) as level from {nodes_sql('division_id, level', ('heading',))}",
    "blk_zones": f"""select n.pub_id, n.id, n.zone from (select *, last_value(ev ignore nulls) over (partition by pub_id order by ord rows between unbounded preceding and current row) as zone from (
        select *, case when regexp_matches(t, {rx.sql(ZONE_DROP)}) then '' when regexp_matches(t, {rx.sql(ZONE_KEEP)}) then split_part(t, ':', 1) end as ev from (
          select pub_id, id, ord, case when type = 'division' then case when kind in ('chapter', 'appendix') then upper(kind[1]) || kind[2:] || ' ' || coalesce(number, '') || ': ' || coalesce(title, '') else title end end as t from {nodes_sql('ord, type, title, kind, number')}))) n
      where n.zone <> '' and n.ord < coalesce((select min(ord) from nodes s where s.pub_id = n.pub_id and s.type = 'division' and regexp_matches(s.title, {rx.sql(ZONE_STOP)})), 9223372036854775807)""",
    "blk_join_pages": f"""select pub_id, cast(no as bigint) as no, count(*) as parts, min(ord) as ord, cast(sum(length(plain)) as bigint) as chars from (select *, sum(new) over (partition by pub_id order by ord) as no from (
      select *, case when page > lag(page) over w and type <> 'list_item' and regexp_matches(lag(t) over w, {rx.sql(OPEN)}) and not (number is not null and type = 'paragraph' or regexp_matches(t, {rx.sql(FRESH)}))
        and (regexp_matches(t, {rx.sql(CONTINUES)}) or regexp_matches(lag(t) over w, '[-,]$') or lower(regexp_extract(lag(t) over w, '(\\S+)$', 1)) in ({", ".join(f"'{c}'" for c in CONNECTORS)})
          or regexp_matches(lag(t) over w, '[a-z]$') and (lag(type) over w <> 'list_item' or len(regexp_split_to_array(lag(t) over w, '\\s+')) >= 8)) then 0 else 1 end as new
      from (select *, trim(plain) as t from {nodes_sql("ord, page, plain, type, number", ("paragraph", "list_item", "text"), "trim(plain) <> ''")}) window w as (partition by pub_id order by ord))) group by pub_id, no""",
    "tbl_score": f"""with j as (select d.pub_id, d.node_id, d.k, d.sentence, n.plain from {_D} d join {nodes_sql('plain', TEXTS)} n on n.pub_id = d.pub_id and n.id = d.node_id),
      g as (select pub_id, node_id, k, t, count(*) as g from (select pub_id, node_id, k, unnest({_tokens_sql('sentence')}) as t from j) group by all),
      p as (select pub_id, node_id, k, t, count(*) as p from (select pub_id, node_id, k, unnest({_tokens_sql('plain')}) as t from j) group by all),
      m as (select coalesce(g.pub_id, p.pub_id) as pub_id, coalesce(g.node_id, p.node_id) as node_id, coalesce(g.k, p.k) as k, coalesce(g, 0) as g, coalesce(p, 0) as p from g full join p on g.pub_id = p.pub_id and g.node_id = p.node_id and g.k = p.k and g.t = p.t)
      select pub_id, node_id, k, round(sum(least(g, p)) / sum(p) - sum(greatest(g - p, 0)) / sum(g), 6) as score from m group by all having sum(p) > 0 and sum(g) > 0""",
    "tbl_rebuild_select": f"""with t as (select pub_id, id, page, list_distinct({_tokens_sql("array_to_string(flatten(rows), ' ')")}) as ts from {nodes_sql('page, rows', ('table',))} where len(rows) > 0),
      j as (select a.pub_id, a.id, b.id as cand, round(len(list_intersect(a.ts, b.ts)) / greatest(1, len(list_distinct(list_concat(a.ts, b.ts)))), 6) as sim from t a join t b on a.pub_id = b.pub_id and a.page = b.page and a.id <> b.id)
      select pub_id, id, cand, sim, sim >= 0.4 as accepted from (select *, row_number() over (partition by pub_id, id order by sim desc, cand desc) as k from j) where k = 1""",
    "tbl_grid": f"""select page, band, count(*) as n, min(line_no) as first from (select l.page, l.line_no,
      (select min(k) from (select unnest(generate_series(0, 20)) as k) b where l.y between 50 + 40 * b.k - 1 and 50 + 40 * (b.k + 1) + 1) as band from {_LINES_SQL} l where l.y between 49 and 690) group by page, band""",
    "tbl_merge_continued": f"""with n as (select * from {nodes_sql("ord, type, number, caption, columns, rows", ("table", "division", "section", "heading"))}),
      u as (select *, lag(type) over w as up_type, lag(number) over w as up_number from n window w as (partition by pub_id order by ord)),
      i as (select *, sum(case when type = 'table' and contains(caption, '(continued)') and up_type = 'table' and up_number = number then 0 else 1 end) over (partition by pub_id order by ord) as isle from u),
      p as (select *, row_number() over w as part, list_transform(first_value(columns) over w, lambda c: {_BARE('c')}) as head from i where type = 'table' window w as (partition by pub_id, isle order by ord)),
      r as (select *, list_filter(coalesce(rows, []), lambda r: part = 1 or list_transform(r, lambda c: {_BARE('c')}) is distinct from head) as rs from p)
      select pub_id, arg_min(id, ord) as id, cast(count(*) as int) as parts, cast(sum(len(rs)) as int) as n_rows, md5(array_to_string(list_transform(flatten(flatten(list(rs order by ord))), lambda x: coalesce(x, '')), '|')) as digest from r group by pub_id, isle""",
    "tbl_legend_source": f"select pub_id, id, array_to_string(list_sort(list_distinct(regexp_extract_all(key, '\\b([A-Z][A-Z0-9/]+)\\s*[–-]\\s*[a-zA-Z]', 1))), ',') as abbreviations from {nodes_sql('key', ('table',), 'key is not null')}",
    "wrd_joined_fixes": f"""with words as (select w, count(*) as n from (select unnest(regexp_extract_all(lower(text), '[a-z]+')) as w from claims) group by w),
      whole as (select distinct unnest(regexp_extract_all(lower(plain), '[a-z]+')) as w from {nodes_sql('plain', TEXTS)}),
      broken as (select regexp_extract(m, '^([a-z]+)', 1) as a, regexp_extract(m, '([a-z]+)$', 1) as b, bool_or(contains(m, '-')) as hyphen from (select unnest(regexp_extract_all(lower(plain), '[a-z]+-?[ \\t]*\\n[ \\t]*[a-z]+')) as m from {nodes_sql('plain', TEXTS)}) group by all),
      cut as (select w, i, substr(w, 1, i) as a, substr(w, i + 1) as b from (select w, unnest(generate_series(2, length(w) - 3)) as i from words where length(w) >= 7 and n <= 5 and w not in (select w from whole)))
      select c.w, arg_min(c.a || case when x.hyphen then '-' else ' ' end || c.b, c.i) as fix from cut c join broken x on x.a = c.a and x.b = c.b
      where c.a in (select w from words where n >= 3) and c.b in (select w from words where n >= 3) group by c.w""",
    "wrd_apply": f"select distinct {_WA} as before, {_WC} as after from claims where text is not null",
    "gls_format": f"select pub_id, ord, type, case type when 'acronym' then '| ' || abbreviation || ' | ' || meaning || ' |' else '**' || term || '** — ' || definition end as line from {nodes_sql('ord, type, abbreviation, meaning, term, definition', ('acronym', 'term'))}",
    "conv_report": f"select pub_id, count(*) filter (type = 'heading') as headings, count(*) filter (type = 'table' and grid) as tables, count(*) filter (type = 'paragraph') as paragraphs, max(page) as pages from {nodes_sql('type, grid, page')} group by pub_id",
}
