"""Pages to blocks, table repairs, and what is shown of a deck."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import rx, text as tx
from foliant.operators import ordered, tables as tb
from foliant.plans import index as ix
from foliant.plans.checks import _CLAIMS, _SLIDES, SQL as CHECKS_SQL, chk_unknown_nodes, claims, slides, spec_schema
from foliant.plans.convert import blk_join_pages, blk_zones, tbl_merge_continued
from foliant.plans.index import TEXTS, nodes, nodes_sql
from foliant.plans.intake import _LATEST, SQL as INTAKE_SQL, guard_tree_current, latest
from foliant.plans.structure import md_render
from foliant.session import written


PAGE = ["pub_id", "page"]


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    """Each page's Markdown with its real headings (tier, label, text) in order."""
    heads = nodes(spark, sf, "ord", "page", "type", "title", "kind", "number", types=("division", "section", "heading"))
    tier = F.when(F.col("type") == "division", "T1").when(F.col("type") == "section", "T2").otherwise("T3")
    label = F.when(F.col("kind").isin("chapter", "appendix"), F.concat_ws(" ", F.initcap("kind"), "number"))
    h = heads.groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct("ord", tier.alias("tier"), label.alias("label"), F.col("title").alias("text")))).alias("hs"))
    h = h.select(*PAGE, F.transform("hs", lambda x: F.struct(x["tier"].alias("tier"), x["label"].alias("label"), F.coalesce(x["text"], F.lit("")).alias("text"))).alias("heads"))
    return md_render(spark, sf).join(h, PAGE, "left")


def _blocks(spark: SparkSession, sf: str) -> DataFrame:
    return tb.page_blocks(_pages(spark, sf).where("page is not null"), PAGE, "md")


def blk_parse_page(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks of each page's Markdown."""
    return _blocks(spark, sf).select(*PAGE, "seq", "kind", "text", "depth", F.coalesce(F.size("rows"), F.lit(0)).alias("n_rows"))


def blk_resolve_headings(spark: SparkSession, sf: str) -> DataFrame:
    """The real headings of each page and the blocks that hold them; ``from_seq`` is null where
    one found no place. A label on a line of its own is folded into its heading."""
    heads = _pages(spark, sf).select(*PAGE, "heads").where("heads is not null")
    labels = F.transform("heads", lambda h: tb.bare(F.coalesce(h["label"], F.lit("")))).alias("labels")
    b = tb.gathered(_blocks(spark, sf), PAGE).join(heads.select(*PAGE, "heads", labels), PAGE)
    is_label = lambda x: x["kind"].isin("mdheading", "bold", "para") & (tb.bare(x["text"]) != "") & F.array_contains("labels", tb.bare(x["text"]))
    b = b.withColumn("bs", F.filter("bs", lambda x: ~is_label(x)))
    b = b.withColumn("x", tb.placed(F.col("bs"), F.col("heads")))
    found = F.transform("x.at", lambda a: F.struct(a["h"].alias("h"), F.get(F.col("bs"), a["from"])["seq"].alias("from_seq"), a["n"].alias("blocks"), a["row"].alias("is_row")))
    lost = F.transform("x.lost", lambda h: F.struct(h.alias("h"), F.lit(None).cast("int").alias("from_seq"), F.lit(None).cast("int").alias("blocks"), F.lit(None).cast("boolean").alias("is_row")))
    d = b.select(*PAGE, "heads", F.inline(F.concat(found, lost)))
    h = F.get("heads", F.col("h"))
    return d.select(*PAGE, "h", h["tier"].alias("tier"), F.concat_ws(": ", h["label"], h["text"]).alias("text"), "from_seq", "blocks", "is_row")


def tbl_dedupe_notes(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks of each page, and those left without near repeats."""
    b = tb.gathered(_blocks(spark, sf), PAGE)
    return b.select(*PAGE, F.size("bs").alias("blocks"), F.size(tb.without_repeats(F.col("bs"))).alias("kept"))


def _bare(c: F.Column) -> F.Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")


def tbl_overflow(spark: SparkSession, sf: str) -> DataFrame:
    """Tables and the text right after them: the cell of the last row (from 40 letters on) that
    it takes up and repeats, and what the cell holds then; the text itself is dropped."""
    n = nodes(spark, sf, "ord", "type", "plain", "rows")
    n = ordered.neighbour(n, ["pub_id"], "ord", ["plain", "id"], "next", after=True).withColumn("after", F.col("next.plain")).withColumn("after_id", F.col("next.id")).where("type = 'table' and size(rows) > 0 and after is not null")
    last, text = F.element_at("rows", -1), _bare(F.col("after"))
    fits = lambda c: (F.length(_bare(c)) >= 40) & F.startswith(text, F.substr(_bare(c), F.lit(1), F.greatest(F.lit(40), F.length(_bare(c)) - 10)))
    hit = F.array_position(F.transform(last, lambda c: F.coalesce(fits(c), F.lit(False))), F.lit(True))
    cell = F.get(last, (hit - 1).cast("int"))
    return n.select("pub_id", "id", "after_id", F.when(hit > 0, hit - 1).cast("int").alias("cell_no"), F.when(hit > 0, F.when(F.length(text) >= F.length(_bare(cell)), F.col("after")).otherwise(cell)).alias("cell"))


def tbl_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Every table after all repairs: see ``foliant.operators.tables.repaired``."""
    t = nodes(spark, sf, "rows", types=("table",)).where("rows is not null").select("pub_id", "id", tb.repaired(F.col("rows")).alias("r"))
    return t.select("pub_id", "id", F.size("r.rows").alias("n_rows"), F.array_join(F.flatten("r.rows"), "|", "").alias("cells"), "r.legend", "r.fixes")


def tbl_row_islands(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each table after rows without a first cell have joined the row above (islands
    by a running sum), with emphasis that stands word by word made one run."""
    t = nodes(spark, sf, "rows", types=("table",)).select("pub_id", "id", F.posexplode("rows").alias("i", "r"))
    w = Window.partitionBy("pub_id", "id").orderBy("i")
    t = t.withColumn("g", F.sum(F.when(F.coalesce(F.get("r", F.lit(0)), F.lit("")) != "", 1).when(F.col("i") == 0, 1).otherwise(0)).over(w))
    cells = F.array_join(F.transform("r", lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"(\w)_ _(\w)", "$1 $2")), " | ")
    g = t.groupBy("pub_id", "id", "g").agg(F.array_sort(F.collect_list(F.struct("i", cells.alias("c")))).alias("cs"))
    return g.select("pub_id", "id", "g", F.size("cs").alias("parts"), F.array_join(F.transform("cs", lambda x: x["c"]), "<br>").alias("row"))


def tbl_garbled_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Table rows of four words and more of which 15 % and more are no words of their
    publication: the rows that need a look at the page."""
    t = nodes(spark, sf, "rows", types=("table",)).select("pub_id", "id", F.posexplode("rows").alias("i", "r"))
    w = t.select("pub_id", "id", "i", F.explode(tx.found(F.lower(F.array_join("r", " ")), "([a-z]+)")).alias("word"))
    v = ix.idx_role_vocab(spark, sf).select("pub_id", "word").withColumn("k", F.lit(1))
    g = w.join(v, ["pub_id", "word"], "left").groupBy("pub_id", "id", "i").agg(F.count("*").alias("words"), F.count_if(F.col("k").isNull()).alias("unknown"))
    return g.where("words >= 4 and unknown >= 0.15 * words")


def tbl_ungarble(spark: SparkSession, sf: str) -> DataFrame:
    """The garbled rows made anew from successive lines of their page or the two after it with
    exactly the same letters; ``rebuilt`` is null where there are none."""
    t = nodes(spark, sf, "page", "rows", types=("table",)).select("pub_id", "id", "page", F.posexplode("rows").alias("i", "r"))
    bad = t.join(tbl_garbled_rows(spark, sf).select("pub_id", "id", "i"), ["pub_id", "id", "i"]).select("pub_id", "id", "i", F.array_join("r", " ", "").alias("row"), F.explode(F.sequence(F.col("page"), F.col("page") + 2)).alias("page"))
    lines = md_render(spark, sf).select("pub_id", "page", F.filter(F.split("md", "\n"), lambda x: F.trim(x) != "").alias("ls"))
    near = bad.join(lines, ["pub_id", "page"], "left").groupBy("pub_id", "id", "i", "row").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("page", "ls"))), lambda x: F.coalesce(x["ls"], tb.none(tb.TEXTS)))).alias("ls"))
    return near.select("pub_id", "id", "i", "row", tb.ungarbled(F.col("row"), F.col("ls")).alias("rebuilt"))


def idx_role_segment(spark: SparkSession, sf: str) -> DataFrame:
    """Headings written without spaces split into words of their publication."""
    h = nodes(spark, sf, "title", types=("heading",)).select("pub_id", tx.squash(F.col("title")).alias("key")).where("key <> ''").distinct()
    return tb.segmented(h, ix.idx_role_vocab(spark, sf), ["pub_id"])


def idx_role_sources(spark: SparkSession, sf: str) -> DataFrame:
    """How many roles of each publication come from where."""
    return ix.roles(spark, sf).groupBy("pub_id", "source").agg(F.count("*").alias("n"))


def pkt_terms(spark: SparkSession, sf: str) -> DataFrame:
    """Terms defined in the text of each division."""
    n = nodes(spark, sf, "division_id", types=TEXTS).withColumnRenamed("id", "node_id")
    return ix.idx_inline_defs(spark, sf).select("pub_id", "node_id", "term").join(n, ["pub_id", "node_id"])


# --- decks ---------------------------------------------------------------------------------
def chk_pub_match(spark: SparkSession, sf: str) -> DataFrame:
    """Decks whose publication has no record that passed."""
    ok = latest(spark, sf).where("gate.status = 'pass'").select("pub_id")
    return slides(spark, sf).select("pub_id").distinct().join(ok, "pub_id", "left_anti")


def qa_deck(spark: SparkSession, sf: str) -> DataFrame:
    """Parts of claims that the claim's own text doesn't show, quotes and blanks folded."""
    fold = lambda c: F.regexp_replace(F.translate(F.lower(c), "“”‘’", "\"\"''"), r"\s+", " ")
    c = claims(spark, sf).where("text is not null").select("pub_id", "claim_id", "text", F.explode("parts").alias("part")).where("part is not null")
    return c.groupBy("pub_id").agg(F.count("*").alias("parts"), F.count_if(F.contains(fold(F.col("text")), fold(F.col("part")))).alias("shown"))


def _esc(c: F.Column) -> F.Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def rep_html(spark: SparkSession, sf: str) -> DataFrame:
    """Each slide as an HTML section: title and statements, escaped, in the order of their ids."""
    c = claims(spark, sf).where("text is not null").select("pub_id", "slide_id", "claim_id", "text").distinct()
    g = c.groupBy("pub_id", "slide_id").agg(F.array_sort(F.collect_list(F.struct("claim_id", "text"))).alias("cs"))
    s = slides(spark, sf).select("pub_id", "slide_id", "title").distinct().join(g, ["pub_id", "slide_id"])
    items = F.array_join(F.transform("cs", lambda x: F.concat(F.lit("<li>"), _esc(x["text"]), F.lit("</li>"))), "")
    return s.select("pub_id", "slide_id", F.concat(F.lit("<section><h2>"), _esc(F.col("title")), F.lit("</h2><ul>"), items, F.lit("</ul></section>")).alias("html"))


def conv_passes(spark: SparkSession, sf: str) -> DataFrame:
    """The passes of a conversion in their order, and how often each did its work in each
    publication: (pub_id, pass_no, counter, n). What a pass never did has no row."""
    # placed and rebuilt once, though two passes each count them
    heads = written(blk_resolve_headings(spark, sf).select("pub_id", "from_seq"))
    garbled = written(tbl_ungarble(spark, sf).select("pub_id", "rebuilt"))
    once = F.lit(1)
    passes = [
        ("pages_converted", md_render(spark, sf), once), ("headings", heads.where("from_seq is not null"), once), ("headings_unplaced", heads.where("from_seq is null"), once),
        ("zoned_nodes", blk_zones(spark, sf), once), ("table_overflow_absorbed", tbl_overflow(spark, sf).where("cell_no is not null"), once),
        ("continued_tables_merged", tbl_merge_continued(spark, sf), F.col("parts") - 1), ("page_break_joins", blk_join_pages(spark, sf), F.col("parts") - 1),
        ("table_rows_rebuilt", garbled.where("rebuilt is not null"), once), ("table_rows_scrambled", garbled.where("rebuilt is null"), once), ("table_rows_repaired", tbl_repair(spark, sf), F.col("fixes")),
        ("glossary_terms", nodes(spark, sf, types=("term",)), once), ("tables", nodes(spark, sf, types=("table",)), once), ("numbered_paragraphs", nodes(spark, sf, types=("paragraph",)), once),
    ]
    got = [df.groupBy("pub_id").agg(F.sum(n).alias("n")).select("pub_id", F.lit(i).alias("pass_no"), F.lit(name).alias("counter"), "n") for i, (name, df, n) in enumerate(passes, 1)]
    return functools.reduce(DataFrame.unionByName, got).where("n > 0")


def bat_process(spark: SparkSession, sf: str) -> DataFrame:
    """How far each publication gets through the stages, and what stops it: fetch, gate, convert,
    index, plan, check. Each is a row of its own, so that none's failure stops another."""
    p = latest(spark, sf).select("pub_id", "sha256", "gate", "source_url")
    trees = guard_tree_current(spark, sf).groupBy("pub_id").agg(F.max(F.col("state") == "current").alias("current"))
    held = nodes(spark, sf).select("pub_id").distinct().withColumn("indexed", F.lit(True))
    spec = slides(spark, sf).select("pub_id").distinct().withColumn("planned", F.lit(True))
    errors = spec_schema(spark, sf).select("pub_id").unionAll(chk_unknown_nodes(spark, sf).select("pub_id")).groupBy("pub_id").agg(F.count("*").alias("errors"))
    j = p.join(trees, "pub_id", "left").join(held, "pub_id", "left").join(spec, "pub_id", "left").join(errors, "pub_id", "left")
    c, step = F.col, lambda stage, status: F.struct(F.lit(stage).alias("stage"), F.lit(status).alias("status"))
    at = (
        F.when(c("source_url").isNull() & c("sha256").isNull(), step("fetch", "no_input")).when(~c("gate.status").eqNullSafe("pass"), step("gate", "rejected"))
        .when(c("current").isNull() & c("indexed").isNull(), step("convert", "failed: no document tree")).when(c("indexed").isNull() & ~c("current"), step("convert", "failed: tree of another file"))
        .when(c("indexed").isNull(), step("index", "failed: no indexes")).when(c("planned").isNull(), step("plan", "needs_planning")).when(c("errors") > 0, step("check", "failed: errors")).otherwise(step("check", "done"))
    )
    return j.select("pub_id", at.alias("at"), F.coalesce("errors", F.lit(0)).alias("errors")).select("pub_id", "at.stage", "at.status", "errors")


def bat_table(spark: SparkSession, sf: str) -> DataFrame:
    """The last records as lines of an aligned table."""
    d = latest(spark, sf)
    line = F.concat(F.rpad("pub_id", 16, " "), F.rpad(F.coalesce("gate.status", F.lit("-")), 8, " "), F.rpad(F.coalesce("gate.distribution", F.lit("-")), 6, " "), F.coalesce("gate.reason", F.lit("")))
    return d.select("pub_id", line.alias("line"))


#: Levels of containers: a division and headings of levels two to six.
DEEPEST = 6


def rnd_tree_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Places of the containers in a drawing of each publication's tree: leaves from left to
    right, numbered by runs, a parent at the mean of its children; one aggregation a level,
    deepest first, each written once."""
    n = nodes(spark, sf, "ord", "parent_id", "path", types=("division", "section", "heading")).withColumn("depth", F.size("path"))
    kids = n.where("parent_id is not null").select("pub_id", F.col("parent_id").alias("id")).distinct().withColumn("k", F.lit(True))
    n = n.join(kids, ["pub_id", "id"], "left").withColumn("leaf", F.col("k").isNull())
    n = ordered.running_sum(n, ["pub_id"], "ord", F.col("leaf").cast("long"), "at").select("pub_id", "id", "parent_id", F.least("depth", F.lit(DEEPEST)).alias("depth"), F.when(F.col("leaf"), F.col("at").cast("double")).alias("x"))
    n = written(n)
    levels: list[DataFrame] = []
    for d in range(DEEPEST, -1, -1):
        here = n.where(F.col("depth") == d)
        if levels:
            up = levels[-1].groupBy("pub_id", F.col("parent_id").alias("id")).agg(F.round(F.avg("x"), 6).alias("mean"))
            here = written(here.join(up, ["pub_id", "id"], "left").withColumn("x", F.coalesce("x", "mean")).drop("mean"))
        levels.append(here)
    return functools.reduce(DataFrame.unionByName, levels).select("pub_id", "id", "depth", "x")


QUERIES = {f.__name__: f for f in (blk_parse_page, blk_resolve_headings, tbl_dedupe_notes, tbl_overflow, tbl_repair, tbl_row_islands, tbl_garbled_rows, tbl_ungarble, idx_role_segment, idx_role_sources, pkt_terms, chk_pub_match, qa_deck, rep_html, conv_passes, bat_process, bat_table, rnd_tree_layout)}

_BARE = lambda c: f"regexp_replace(lower({c}), '[^a-z0-9]+', '', 'g')"
_ESC = lambda c: f"replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
_FOLD = lambda c: f"regexp_replace(translate(lower({c}), '“”‘’', '\"\"'''''), '\\s+', ' ', 'g')"
SQL = {
    "idx_role_sources": f"select pub_id, source, count(*) as n from ({ix.ROLES_SQL}) group by all",
    "tbl_overflow": f"""select pub_id, id, after_id, cast(case when hit > 0 then hit - 1 end as int) as cell_no, case when hit > 0 then case when length({_BARE('after')}) >= length({_BARE('lst[hit]')}) then after else lst[hit] end end as cell from (
      select *, rows[len(rows)] as lst, coalesce(list_position(list_transform(rows[len(rows)], lambda c: coalesce(length({_BARE('c')}) >= 40 and starts_with({_BARE('after')}, substr({_BARE('c')}, 1, greatest(40, length({_BARE('c')}) - 10))), false)), true), 0) as hit from (
        select *, lead(plain) over (partition by pub_id order by ord) as after, lead(id) over (partition by pub_id order by ord) as after_id from {nodes_sql('ord, type, plain, rows')}) where type = 'table' and len(rows) > 0 and after is not null)""",
    "tbl_row_islands": f"""select pub_id, id, cast(g as bigint) as g, cast(count(*) as int) as parts, string_agg(array_to_string(list_transform(r, lambda c: regexp_replace(coalesce(c, ''), '(\\w)_ _(\\w)', '\\1 \\2', 'g')), ' | '), '<br>' order by i) as row from (
      select *, sum(case when coalesce(r[1], '') <> '' then 1 when i = 0 then 1 else 0 end) over (partition by pub_id, id order by i) as g from (
        select pub_id, id, generate_subscripts(rows, 1) - 1 as i, unnest(rows) as r from {nodes_sql('rows', ('table',))})) group by pub_id, id, g""",
    "tbl_garbled_rows": f"""select w.pub_id, w.id, w.i, count(*) as words, count(*) filter (v.word is null) as unknown from (
      select pub_id, id, i, unnest(regexp_extract_all(lower(array_to_string(r, ' ')), '[a-z]+')) as word from (select pub_id, id, generate_subscripts(rows, 1) - 1 as i, unnest(rows) as r from {nodes_sql('rows', ('table',))})) w
      left join ({ix.ROLE_VOCAB_SQL}) v on v.pub_id = w.pub_id and v.word = w.word group by w.pub_id, w.id, w.i having count(*) >= 4 and count(*) filter (v.word is null) >= 0.15 * count(*)""",
    "pkt_terms": f"select d.pub_id, d.node_id, d.term, n.division_id from ({ix.INLINE_SQL}) d join {nodes_sql('division_id', TEXTS)} n on n.pub_id = d.pub_id and n.id = d.node_id",
    "chk_pub_match": f"select distinct pub_id from slides s where not exists (select 1 from {_LATEST} p where p.pub_id = s.pub_id and p.gate.status = 'pass')",
    "qa_deck": f"select pub_id, count(*) as parts, count(*) filter (contains({_FOLD('text')}, {_FOLD('part')})) as shown from (select pub_id, claim_id, text, unnest(parts) as part from {_CLAIMS} where text is not null) where part is not null group by pub_id",
    "rep_html": f"""select s.pub_id, s.slide_id, '<section><h2>' || {_ESC('s.title')} || '</h2><ul>' || c.items || '</ul></section>' as html from (select distinct pub_id, slide_id, title from {_SLIDES}) s
      join (select pub_id, slide_id, string_agg('<li>' || {_ESC('text')} || '</li>', '' order by claim_id, text) as items from (select distinct pub_id, slide_id, claim_id, text from {_CLAIMS} where text is not null) group by all) c on c.pub_id = s.pub_id and c.slide_id = s.slide_id""",
    "rnd_tree_layout": f"""with n as (select pub_id, id, ord, parent_id, least(len(path), {DEEPEST}) as depth from {nodes_sql("ord, parent_id, path", ("division", "section", "heading"))}),
      f as (select *, not exists (select 1 from n k where k.pub_id = n.pub_id and k.parent_id = n.id) as leaf from n),
      l as (select pub_id, id, parent_id, depth, case when leaf then cast(sum(leaf::int) over (partition by pub_id order by ord) as double) end as x from f),
      l{DEEPEST} as (select pub_id, id, parent_id, depth, x from l where depth = {DEEPEST}),
      {", ".join(f"l{d} as (select a.pub_id, a.id, a.parent_id, a.depth, coalesce(a.x, u.x) as x from l a left join (select pub_id, parent_id as id, round(avg(x), 6) as x from l{d + 1} group by all) u on u.pub_id = a.pub_id and u.id = a.id where a.depth = {d})" for d in range(DEEPEST - 1, -1, -1))}
      {" union all ".join(f"select pub_id, id, depth, x from l{d}" for d in range(DEEPEST + 1))}""",
    "bat_process": f"""select p.pub_id, case when p.source_url is null and p.sha256 is null then 'fetch' when p.gate.status is distinct from 'pass' then 'gate' when not coalesce(t.current, false) and not n.there then 'convert' when not n.there then 'index' when not s.there then 'plan' else 'check' end as stage,
      case when p.source_url is null and p.sha256 is null then 'no_input' when p.gate.status is distinct from 'pass' then 'rejected' when t.current is null and not n.there then 'failed: no document tree' when not n.there and not t.current then 'failed: tree of another file'
        when not n.there then 'failed: no indexes' when not s.there then 'needs_planning' when coalesce(e.errors, 0) > 0 then 'failed: errors' else 'done' end as status, coalesce(e.errors, 0) as errors
      from {_LATEST} p left join (select pub_id, bool_or(state = 'current') as current from ({INTAKE_SQL["guard_tree_current"]}) group by pub_id) t on t.pub_id = p.pub_id
      cross join lateral (select exists (select 1 from nodes x where x.pub_id = p.pub_id) as there) n cross join lateral (select exists (select 1 from slides x where x.pub_id = p.pub_id) as there) s
      left join (select pub_id, count(*) as errors from (select pub_id from ({CHECKS_SQL["spec_schema"]}) union all select pub_id from ({CHECKS_SQL["chk_unknown_nodes"]})) group by pub_id) e on e.pub_id = p.pub_id""",
    "bat_table": f"select pub_id, rpad(pub_id, 16, ' ') || rpad(coalesce(gate.status, '-'), 8, ' ') || rpad(coalesce(gate.distribution, '-'), 6, ' ') || coalesce(gate.reason, '') as line from {_LATEST}",
}
