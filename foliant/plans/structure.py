"""The tree as a table: traversal, subtree text, ids, and Markdown in and out."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import text as tx
from foliant.operators import markdown, ordered
from foliant.plans.index import CONTAINERS, TEXTS, nodes, nodes_sql, sections
from foliant.session import table, written

_IN = lambda ts: "(" + ", ".join(f"'{t}'" for t in ts) + ")"


def walk(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes depth-first with their ancestors."""
    return nodes(spark, sf, "ord", "type", "path").select("pub_id", "ord", "id", "type", F.size("path").alias("depth"), F.array_join("path", "/").alias("ancestors"))


#: From this level on the links are looked over for a circle below a root.
DEEP = 100


def walk_recursive(spark: SparkSession, sf: str) -> DataFrame:
    """Depth and root of each node from the parent links alone: one join a level, the
    frontier being the only side that moves. Levels are written one by one, so neither their
    number nor that of the rows is limited."""
    n = written(nodes(spark, sf, "parent_id"))
    roots = n.where("parent_id is null").select("pub_id", "id", F.col("id").alias("root"), F.lit(0).alias("depth"))
    links = n.where("parent_id is not null").select("pub_id", "id", F.col("parent_id").alias("up"))
    levels = [written(roots)]
    most: int | None = None
    while not levels[-1].isEmpty():
        if len(levels) > DEEP:
            # no way down that passes no link twice is longer than a publication has links
            most = most or links.groupBy("pub_id").count().agg(F.max("count")).first()[0] or 0
            if len(levels) > most + 1:
                raise ValueError("parent links run in a circle below a root")
        last = levels[-1].select("pub_id", F.col("id").alias("up"), "root", "depth")
        levels.append(written(links.join(last, ["pub_id", "up"]).select("pub_id", "id", "root", (F.col("depth") + 1).alias("depth"))))
    return functools.reduce(DataFrame.unionByName, levels[:-1] or levels)


def text_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return nodes(spark, sf, "ord", "type", "cite", "plain", types=TEXTS)


def section_title(spark: SparkSession, sf: str) -> DataFrame:
    """Title of the nearest ancestor that has one."""
    return sections(spark, sf).withColumnRenamed("node_id", "id")


def _own(prefix: str = "") -> F.Column:
    c = lambda x: F.col(prefix + x)
    table_text = F.concat_ws(" ", c("caption"), F.array_join(c("columns"), " "), F.array_join(F.flatten(c("rows")), " "), c("key"))
    return (
        F.when(c("type").isin(*CONTAINERS), c("title")).when(c("type") == "table", table_text).when(c("type") == "term", F.concat(c("term"), F.lit(": "), c("definition")))
        .when(c("type") == "acronym", F.concat(c("abbreviation"), F.lit(": "), c("meaning"))).when(c("type") == "figure", c("caption")).otherwise(c("plain"))
    )


_OWN_SQL = f"""case when type in {_IN(CONTAINERS)} then title
  when type = 'table' then concat_ws(' ', caption, array_to_string(columns, ' '), array_to_string(flatten(rows), ' '), key)
  when type = 'term' then term || ': ' || definition when type = 'acronym' then abbreviation || ': ' || meaning when type = 'figure' then caption else plain end"""
_OWN_COLS = "ord, path, type, title, caption, columns, rows, key, term, definition, abbreviation, meaning, plain"


def own_text(spark: SparkSession, sf: str) -> DataFrame:
    cols = [c.strip() for c in _OWN_COLS.split(",")]
    n = nodes(spark, sf, *cols).withColumn("t", F.trim(_own()))
    return n.select("pub_id", "id", "ord", "path", "type", "t")


def node_text(spark: SparkSession, sf: str) -> DataFrame:
    """Text of each paragraph, list item, heading and section with all below it, in
    document order. One result row is one subtree; divisions are left to ``node_words``."""
    n = own_text(spark, sf).where("t <> ''")
    each = n.select("pub_id", F.explode(F.concat("path", F.array("id"))).alias("id"), "ord", "t")
    roots = nodes(spark, sf, types=("section", "heading", "paragraph", "list_item")).select("pub_id", "id")
    got = each.join(roots, ["pub_id", "id"], "left_semi").groupBy("pub_id", "id").agg(F.array_sort(F.collect_list(F.struct("ord", "t"))).alias("ts"))
    return got.select("pub_id", "id", F.array_join(F.transform("ts", lambda x: x["t"]), " ").alias("text"))


def node_words(spark: SparkSession, sf: str) -> DataFrame:
    """Words and nodes of every subtree: sums, so that no subtree is gathered and no text
    is shuffled."""
    w = F.size(F.filter(F.split(F.coalesce(F.trim(_own()), F.lit("")), r"\s+"), lambda x: x != ""))
    n = nodes(spark, sf, "path", derived={"w": w})
    each = n.select("pub_id", F.explode(F.concat("path", F.array("id"))).alias("id"), "w")
    return each.groupBy("pub_id", "id").agg(F.sum("w").alias("words"), F.count("*").alias("nodes"))


def units(spark: SparkSession, sf: str) -> DataFrame:
    """Containers that hold content directly."""
    kids = nodes(spark, sf, "parent_id", "type").where(~F.col("type").isin(*CONTAINERS)).select("pub_id", F.col("parent_id").alias("id"))
    return nodes(spark, sf, "type", "title", types=CONTAINERS).join(kids, ["pub_id", "id"], "left_semi")


def descend(spark: SparkSession, sf: str) -> DataFrame:
    """Each content node's nearest container (its unit)."""
    n = nodes(spark, sf, "type", "path").where(~F.col("type").isin(*CONTAINERS))
    up = n.select("pub_id", "id", F.posexplode("path").alias("pos", "unit"))
    boxes = nodes(spark, sf, types=CONTAINERS).select("pub_id", F.col("id").alias("unit"))
    return up.join(boxes, ["pub_id", "unit"]).groupBy("pub_id", "id").agg(F.max_by("unit", "pos").alias("unit"))


def cited(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct (pub_id, id) that some claim cites, blanks and tabs around it put right."""
    c = table(spark, sf, "claim_cites").where("node_id is not null")
    return c.select("pub_id", tx.bare(F.col("node_id")).alias("id")).distinct()


def subtree_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Cited nodes and everything below them."""
    each = nodes(spark, sf, "path").select("pub_id", "id", F.explode(F.concat("path", F.array("id"))).alias("at"))
    c = cited(spark, sf).withColumnRenamed("id", "at")
    return each.join(c, ["pub_id", "at"], "left_semi").select("pub_id", "id").distinct()


def drop_covered(spark: SparkSession, sf: str) -> DataFrame:
    """Cited nodes without a cited ancestor."""
    c = cited(spark, sf)
    held = nodes(spark, sf, "path").join(c, ["pub_id", "id"], "left_semi")
    under = held.select("pub_id", "id", F.explode("path").alias("at")).join(c.withColumnRenamed("id", "at"), ["pub_id", "at"], "left_semi").select("pub_id", "id")
    return held.select("pub_id", "id").join(under, ["pub_id", "id"], "left_anti")


def uid(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of glossary nodes made anew: the n-th of one base in document order gets -n."""
    n = nodes(spark, sf, "ord", "type", "abbreviation", "term", types=("acronym", "term"))
    base = F.when(F.col("type") == "acronym", F.concat(F.lit("acr-"), tx.slug(F.col("abbreviation")))).otherwise(F.concat(F.lit("term-"), tx.slug(F.col("term"))))
    n = n.withColumn("base", base).withColumn("k", F.row_number().over(Window.partitionBy("pub_id", "base").orderBy("ord")))
    return n.select("pub_id", "ord", "id", F.when(F.col("k") == 1, F.col("base")).otherwise(F.concat_ws("-", "base", "k")).alias("uid"))


def containment(spark: SparkSession, sf: str) -> DataFrame:
    """Parent and child types that occur, and whether the model allows them."""
    p = nodes(spark, sf, "type").select("pub_id", F.col("id").alias("parent_id"), F.col("type").alias("parent_type"))
    n = nodes(spark, sf, "type", "parent_id").join(p, ["pub_id", "parent_id"])
    ok = F.when(F.col("parent_type").isin(*CONTAINERS), F.col("type") != "division").when(F.col("parent_type") == "paragraph", F.col("type").isin("list_item", "text")).when(F.col("parent_type") == "list_item", F.col("type") == "list_item").otherwise(F.lit(False))
    return n.groupBy("parent_type", "type").agg(F.count("*").alias("n")).withColumn("allowed", ok)


# --- Markdown ------------------------------------------------------------------------
def _esc(c: F.Column) -> F.Column:
    return F.replace(c, F.lit("|"), F.lit("\\|"))


def block_md(spark: SparkSession, sf: str) -> DataFrame:
    """Each node as one Markdown block."""
    cols = ["ord", "type", "page", "page_label", "kind", "number", "title", "level", "depth", "path", "text", "caption", "columns", "rows", "key", "term", "definition", "source", "proponent", "abbreviation", "meaning", "division_id"]
    n = nodes(spark, sf, *cols)
    c = F.col
    row = lambda r: F.concat(F.lit("| "), F.array_join(F.transform(r, lambda x: _esc(F.coalesce(x, F.lit("")))), " | "), F.lit(" |"))
    title = F.when(c("kind") == "chapter", F.concat(F.lit("Chapter "), "number", F.lit(": "), "title")).when(c("kind") == "appendix", F.concat(F.lit("Appendix "), "number", F.lit(": "), "title")).otherwise(c("title"))
    md = (
        F.when(c("type") == "division", F.concat(F.lit("# "), title))
        .when(c("type") == "section", F.concat(F.lit("## SECTION "), "number", F.lit(" – "), "title"))
        .when(c("type") == "heading", F.concat(F.repeat(F.lit("#"), c("level")), F.lit(" "), "title"))
        .when(c("type") == "paragraph", F.concat("number", F.lit(". "), "text"))
        .when(c("type") == "list_item", F.concat(F.repeat(F.lit("  "), F.coalesce("depth", F.lit(0))), F.lit("- "), "text"))
        .when(c("type") == "figure", F.concat(F.lit("**Figure "), "number", F.lit(". "), "caption", F.lit("**")))
        .when(c("type") == "table", F.concat_ws("\n\n", F.concat(F.lit("**Table "), "number", F.lit(". "), "caption", F.lit("**")), F.when(F.size("columns") > 0, F.concat_ws("\n", row(c("columns")), F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), F.size("columns"))), F.array_join(F.transform("rows", row), "\n"))), c("key")))
        .when(c("type") == "term", F.concat(F.when(c("proponent"), "*").otherwise(""), F.lit("**"), "term", F.lit("** — "), "definition", F.when(c("source").isNotNull(), F.concat(F.lit(" ("), "source", F.lit(")"))).otherwise("")))
        .when(c("type") == "acronym", F.concat(F.lit("| Acronym | Meaning |\n| --- | --- |\n| "), "abbreviation", F.lit(" | "), "meaning", F.lit(" |")))
        .otherwise(c("text"))
    )
    return n.select("pub_id", "division_id", "id", "type", "ord", "page", "page_label", md.alias("md"))


def md_render(spark: SparkSession, sf: str) -> DataFrame:
    """Markdown of each page, with its marker: the blocks in document order."""
    b = block_md(spark, sf).where("md is not null")
    got = b.groupBy("pub_id", "page").agg(F.max("page_label").alias("label"), F.array_sort(F.collect_list(F.struct("ord", "md"))).alias("bs"))
    mark = F.concat(F.lit("<!-- page "), "page", F.when(F.col("label").isNotNull(), F.concat(F.lit(" ("), "label", F.lit(")"))).otherwise(""), F.lit(" -->"))
    return got.select("pub_id", "page", F.concat_ws("\n\n", mark, F.array_join(F.transform("bs", lambda x: x["md"]), "\n\n")).alias("md"))


def _marked() -> F.Column:
    """A node's block after the marker of its page."""
    return F.concat_ws("\n\n", F.concat(F.lit("<!-- page "), "page", F.when(F.col("page_label").isNotNull(), F.concat(F.lit(" ("), "page_label", F.lit(")"))).otherwise(""), F.lit(" -->")), "md")


def pkt_fulltext(spark: SparkSession, sf: str) -> DataFrame:
    """Markdown of each division in parts: one for each run of ``ordered.SIZE`` nodes, so that
    no division stands in one row; in order they are its file."""
    b = block_md(spark, sf).where("md is not null")
    run = F.floor(F.col("ord") / ordered.SIZE).alias("part")
    got = b.groupBy("pub_id", "division_id", run).agg(F.array_sort(F.collect_list(F.struct("ord", _marked().alias("m")))).alias("bs"))
    return got.select("pub_id", "division_id", "part", F.array_join(F.transform("bs", lambda x: x["m"]), "\n\n").alias("md"))


def md_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes read back from the Markdown of all publications."""
    room = 1 << 20
    b = block_md(spark, sf).where("md is not null").select("pub_id", "ord", F.posexplode(F.split(_marked(), "\n\n+")).alias("i", "block"))
    d = markdown.parse_blocks(b.select("pub_id", (F.col("ord") * room + F.col("i")).alias("at"), "block"), ["pub_id"], "at", "block", ordered.SIZE * room)
    return d.select("pub_id", "ord", "id", "parent_id", "type", "cite", "page", "page_label", "number", "title", "depth", "plain")


NUMBERED = ("division", "paragraph", "table", "figure", "term", "acronym")


def md_numbered(spark: SparkSession, sf: str) -> DataFrame:
    """What has a number or name of its own comes back from the Markdown under its old id."""
    d = md_parse(spark, sf).where(F.col("type").isin(*NUMBERED))
    return d.select("pub_id", "type", F.lower("id").alias("id"), "number")


def md_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes read back by type; each node that was written comes back once."""
    return md_parse(spark, sf).groupBy("type").agg(F.count("*").alias("n"))


def md_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks of every page with their kind, by one CASE in order of precedence."""
    p = md_render(spark, sf)
    b = p.select("pub_id", "page", F.posexplode(F.split("md", "\n\n+")).alias("seq", "block"))
    t = F.trim("block")
    kind = (
        F.when(t.rlike(r"^<!-- page \d+"), "page").when(t.startswith("|"), "table").when(t.rlike(r"^#{1,6} "), "heading").when(t.rlike(r"^\*\*(Introductory )?(Table|Figure) "), "caption")
        .when(t.rlike(r"^\**(\d+|[A-Z])-\d+\.\**\s"), "paragraph").when(F.col("block").rlike(r"^ *- "), "bullet").otherwise("text")
    )
    return b.select("pub_id", "page", "seq", kind.alias("kind"), F.length("block").alias("n_chars"))


def md_block_kinds(spark: SparkSession, sf: str) -> DataFrame:
    return md_blocks(spark, sf).groupBy("pub_id", "kind").agg(F.count("*").alias("n"))


def md_page_asof(spark: SparkSession, sf: str) -> DataFrame:
    """The page in force at each node: the last marker at or before it (page and label as one
    value, so that a page without a label resets it). A marker stands wherever the page differs
    from that of the node before."""
    n = ordered.neighbour(nodes(spark, sf, "ord", "page", "page_label"), ["pub_id"], "ord", ["page", "page_label"], "up")
    here = F.struct("page", "page_label")
    n = ordered.last_before(n, ["pub_id"], "ord", F.when(F.col("up").isNull() | ~F.col("up").eqNullSafe(here), here), "at", here=True)
    return n.select("pub_id", "id", F.col("at.page").alias("page"), F.col("at.page_label").alias("page_label"))


def md_terms(spark: SparkSession, sf: str) -> DataFrame:
    """Terms read from their Markdown: name, definition, source, proponent."""
    b = block_md(spark, sf).where("type = 'term'")
    line = r"(?s)^(\*)?\*\*(.+?)\*\*\s+—\s+(.+)$"
    body = F.regexp_extract("md", line, 3)
    src = r"\s*\(((?:JP|ADP|ADRP|FM|ATP|AR|DA PAM|TC)\s[^()]+)\)\.?$"
    return b.select("pub_id", "id", F.regexp_extract("md", line, 2).alias("term"), F.regexp_replace(body, src, "").alias("definition"), F.nullif(F.regexp_extract(body, src, 1), F.lit("")).alias("source"), (F.regexp_extract("md", line, 1) == "*").alias("proponent"))


def md_table_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of every table read from its Markdown, split at bars that aren't escaped."""
    b = block_md(spark, sf).where("type = 'table'").select("pub_id", "id", F.posexplode(F.filter(F.split("md", "\n"), lambda x: x.startswith("|") & ~x.rlike(r"^\|( --- \|)+$"))).alias("row_no", "line"))
    inner = F.expr("substring(line, 2, length(line) - 2)")
    return b.where("row_no > 0").select("pub_id", "id", F.posexplode(F.split(inner, r"(?<!\\)\|")).alias("col_no", "c"), F.col("row_no").alias("row_no")).select("pub_id", "id", "row_no", "col_no", F.trim(F.regexp_replace("c", r"\\\|", "|")).alias("cell"))


QUERIES = {f.__name__: f for f in (walk, walk_recursive, text_nodes, section_title, node_text, node_words, units, descend, subtree_ids, drop_covered, uid, containment, md_render, pkt_fulltext, md_parse, md_numbered, md_counts, md_blocks, md_block_kinds, md_page_asof, md_terms, md_table_cells)}

_EACH = f"(select pub_id, id, ord, type, unnest(list_append(path, id)) as anc, own as t from (select *, trim({_OWN_SQL}) as own from {nodes_sql(_OWN_COLS)}))"
_CITED = f"(select distinct pub_id, {tx.bare_sql('node_id')} as id from claim_cites where node_id is not null)"
SQL = {
    "walk": f"select pub_id, ord, id, type, len(path) as depth, array_to_string(path, '/') as ancestors from {nodes_sql('ord, type, path')}",
    "walk_recursive": f"""with recursive t as (select pub_id, id, id as root, 0 as depth from {nodes_sql('parent_id')} where parent_id is null
      union all select n.pub_id, n.id, t.root, t.depth + 1 from {nodes_sql('parent_id')} n join t on n.pub_id = t.pub_id and n.parent_id = t.id) select * from t""",
    "text_nodes": f"select * from {nodes_sql('ord, type, cite, plain', TEXTS)}",
    "section_title": f"""select u.pub_id, u.id, arg_max(t.title, u.pos) as section from (select pub_id, id, unnest(path) as up, generate_subscripts(path, 1) as pos from {nodes_sql('path', TEXTS)}) u
      join {nodes_sql('title', CONTAINERS, "title <> ''")} t on t.pub_id = u.pub_id and t.id = u.up group by all""",
    "node_text": f"select e.pub_id, e.anc as id, string_agg(e.t, ' ' order by e.ord, e.t) as text from {_EACH} e join {nodes_sql('type', ('section', 'heading', 'paragraph', 'list_item'))} r on r.pub_id = e.pub_id and r.id = e.anc where e.t <> '' group by e.pub_id, e.anc",
    "node_words": f"select pub_id, anc as id, cast(sum(coalesce(len(list_filter(regexp_split_to_array(t, '\\s+'), lambda x: x <> '')), 0)) as bigint) as words, count(*) as nodes from {_EACH} group by pub_id, anc",
    "units": f"select distinct c.pub_id, c.id, c.type, c.title from {nodes_sql('type, title', CONTAINERS)} c join {nodes_sql('parent_id, type')} k on k.pub_id = c.pub_id and k.parent_id = c.id and k.type not in {_IN(CONTAINERS)}",
    "descend": f"""select u.pub_id, u.id, arg_max(u.at, u.pos) as unit from (select pub_id, id, unnest(path) as at, generate_subscripts(path, 1) as pos from {nodes_sql('path, type')} where type not in {_IN(CONTAINERS)}) u
      join {nodes_sql('type', CONTAINERS)} c on c.pub_id = u.pub_id and c.id = u.at group by all""",
    "subtree_ids": f"select distinct e.pub_id, e.id from (select pub_id, id, unnest(list_append(path, id)) as at from {nodes_sql('path')}) e join {_CITED} c on c.pub_id = e.pub_id and c.id = e.at",
    "drop_covered": f"""select h.pub_id, h.id from {nodes_sql('path')} h join {_CITED} c on c.pub_id = h.pub_id and c.id = h.id
      where not exists (select 1 from {_CITED} u where u.pub_id = h.pub_id and list_contains(h.path, u.id))""",
    "uid": f"""select pub_id, ord, id, case when k = 1 then base else base || '-' || k end as uid from (select *, row_number() over (partition by pub_id, base order by ord) as k from (
      select *, case type when 'acronym' then 'acr-' || {tx.slug_sql('abbreviation')} else 'term-' || {tx.slug_sql('term')} end as base from {nodes_sql('ord, type, abbreviation, term', ('acronym', 'term'))}))""",
    "containment": f"""select parent_type, type, n, case when parent_type in {_IN(CONTAINERS)} then type <> 'division' when parent_type = 'paragraph' then type in ('list_item', 'text') when parent_type = 'list_item' then type = 'list_item' else false end as allowed
      from (select p.type as parent_type, n.type, count(*) as n from {nodes_sql('type, parent_id')} n join {nodes_sql('type')} p on p.pub_id = n.pub_id and p.id = n.parent_id group by all)""",
    # there and back: the nodes that the Markdown was made of
    "md_numbered": f"select pub_id, type, lower(id) as id, number from {nodes_sql('type, number', NUMBERED)}",
    # the markers carry each node's own page, and nothing else
    "md_page_asof": f"select pub_id, id, page, page_label from {nodes_sql('page, page_label')}",
    "md_terms": f"select pub_id, id, term, definition, source, proponent from {nodes_sql('term, definition, source, proponent', ('term',))}",
    "md_table_cells": f"""select pub_id, id, row_no, generate_subscripts(cells, 1) - 1 as col_no, trim(coalesce(unnest(cells), '')) as cell from (select pub_id, id, generate_subscripts(rows, 1) as row_no, unnest(rows) as cells from {nodes_sql('rows', ('table',))})""",
}
