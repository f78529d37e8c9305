"""Markdown of publications to flat node rows, as set operations over blocks.

``parse_blocks`` reads a table of blocks (key, ordinal, text). Each block gets its kind by
one CASE; what stands open at a block (page, headings of each level, paragraph, table,
caption) is the last such block before it, found by ``ordered.last_of`` in runs, so no
publication has to stand in one task. Ids are segments joined along the open headings, and
repeats are numbered within what they repeat. Python holds the open items of a list, in a
stream over the list's rows, and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions import text as tx
from foliant.operators import ordered
from foliant.session import written

# Block forms of the converted Markdown and the titles of named divisions.
PAGE = r"^<!-- page (\d+)(?: \(([^)]*)\))? -->$"
HEADING = r"^(#{1,6}) (.+)$"
DIVISION = r"^(?:Chapter (\d+)|Appendix ([A-Z])): (.+)$"
SECTION = r"^(?i:SECTION) ((?i)[IVXLC]+)\s*[–-]\s*(.+)$"
PARAGRAPH = r"(?s)^\**((?:\d+|[A-Z])-\d+)\.\**\s+(.*)$"
CAPTION = r"^\*\*((?:Introductory )?(Table|Figure) ([A-Z]?-?\d+(?:-\d+)?)\.?\s.*)\*\*$"
BULLET = r"(?s)^( *)- (.*)$"
TERM = r"(?s)^(\*)?\*\*(.+?)\*\*\s+—\s+(.+)$"
SOURCE = r"\s*\(((?:JP|ADP|ADRP|FM|ATP|AR|DA PAM|TC)\s[^()]+)\)\.?$"
# an entry, a comma, and the begin of another: what follows the second is free
KEY = r"^[A-Z][A-Za-z0-9/-]*\s*[–-]+\s*[^,]+,\s*[A-Z][A-Za-z0-9/-]*\s*[–-]+\s*\S.*$"
NOTES = r"^Notes?\b"
NAMED = {"preface": "preface", "introduction": "introduction", "glossary": "glossary", "references": "references", "source notes": "source_notes"}

COLUMNS = {
    "ord": "bigint", "id": "string", "parent_id": "string", "path": "array<string>", "division_id": "string", "type": "string", "cite": "string", "page": "int", "page_label": "string",
    "kind": "string", "number": "string", "title": "string", "level": "int", "depth": "int", "text": "string", "plain": "string", "caption": "string", "columns": "array<string>",
    "rows": "array<array<string>>", "key": "string", "grid": "boolean", "term": "string", "definition": "string", "source": "string", "proponent": "boolean", "abbreviation": "string", "meaning": "string",
}
LEVELS = range(1, 7)


def front_matter(md: str) -> tuple[dict[str, str], str]:
    """The ``key: value`` lines between the first two ``---`` lines, and the body. A text
    without them is an error."""
    if not md.startswith("---\n") or md.count("---\n") < 2:
        raise ValueError("no front matter")
    _, head, body = md.split("---\n", 2)
    pairs = (x.partition(":") for x in head.splitlines() if ":" in x and x[:1] not in " #-")
    return {k.strip(): v.strip().strip("'\"") for k, _, v in pairs}, body


def plain(s: Column) -> Column:
    """Without emphasis, tags and heading marks."""
    s = F.regexp_replace(F.regexp_replace(s, r"<[^>]+>", " "), r"(?U)\*+|(?<!\w)_+|_+(?!\w)|^#+ ", "")
    return F.trim(F.regexp_replace(s, r"(?U)\s+", " "))


def cells(line: Column) -> Column:
    """The cells between a row's outer bars; an escaped bar is part of a cell."""
    bare = F.trim(line)
    each = F.split(F.substring(bare, F.lit(2), F.length(bare) - 2), r"(?<!\\)\|")
    return F.transform(each, lambda c: F.replace(F.trim(c), F.lit("\\|"), F.lit("|")))


def _g(c: Column, pattern: str, k: int) -> Column:
    """Group ``k``, null where it is empty or there is no match."""
    return F.nullif(F.regexp_extract(c, pattern, k), F.lit(""))


def _classified(df: DataFrame, key: list[str], at: str, block: str) -> DataFrame:
    """``key``, ``at`` (four times the ordinal, so that there is room), ``b``, ``kind`` and
    ``level``; blank blocks are left out."""
    b = F.regexp_replace(F.col(block), r"^\n+|\n+$", "")
    bare = F.regexp_replace(F.col("b"), r"(?U)^\s+|\s+$", "")
    kind = (
        F.when(bare.rlike(PAGE), "page").when(F.startswith(bare, F.lit("|")), "table").when(F.col("b").rlike(HEADING), "heading")
        .when(bare.rlike(CAPTION), "caption").when(F.col("b").rlike(PARAGRAPH), "paragraph").when(F.col("b").rlike(BULLET), "bullet").otherwise("text")
    )
    d = df.select(*[F.col(f"`{k}`") for k in key], (F.col(at) * 4 + 2).alias("at"), b.alias("b")).where(~F.coalesce(F.col("b").rlike(r"(?U)^\s*$"), F.lit(True)))
    d = d.withColumn("kind", kind).withColumn("b", F.when(F.col("kind").isin("page", "caption"), bare).otherwise(F.col("b")))
    return d.withColumn("level", F.when(F.col("kind") == "heading", F.length(F.regexp_extract("b", HEADING, 1))))


def _headed(d: DataFrame, key: list[str], size: int) -> DataFrame:
    """With page and the place of the last heading of each level; a key whose first block is no
    division gets one."""
    is_ = lambda k: F.col("kind") == k
    mark = F.struct(F.regexp_extract("b", PAGE, 1).cast("int").alias("page"), _g(F.col("b"), PAGE, 2).alias("label"))
    values = {"p": F.when(is_("page"), mark), "some": F.when(~is_("page"), F.col("at"))}
    values |= {f"h{n}": F.when(F.col("level") == n, F.col("at")) for n in LEVELS}
    d = ordered.last_of(d, key, "at", values, size=size).where(~is_("page"))
    first = F.col("some").isNull() & ~F.coalesce(F.col("level") == 1, F.lit(False))
    d = d.withColumn("made", F.explode(F.when(first, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))))
    as_made = lambda c, v: F.when(F.col("made"), v).otherwise(F.col(c)).alias(c)
    made = [as_made("at", F.col("at") - 1), as_made("b", F.lit("# Untitled")), as_made("kind", F.lit("heading")), as_made("level", F.lit(1))]
    return d.select(*[F.col(f"`{k}`") for k in key], *made, "p", *[f"h{n}" for n in LEVELS])


def _open(n: int, below: Column | None = None) -> Column:
    """Whether the last heading of level ``n`` is open: no higher one came after it."""
    ok = F.col(f"h{n}").isNotNull() & (F.lit(True) if below is None else n < below)
    for k in range(1, n):
        ok = ok & (F.coalesce(F.col(f"h{k}"), F.lit(-1)) < F.col(f"h{n}"))
    return ok


def _titled(d: DataFrame, key: list[str]) -> DataFrame:
    """Headings and paragraphs with what they hand on: ``own``, a struct of their place, id
    segment, type, cite and number."""
    title = F.trim(F.regexp_extract("b", HEADING, 2))
    chapter, appendix = _g(F.col("title"), DIVISION, 1), _g(F.col("title"), DIVISION, 2)
    named: Column = F.lit("preface")
    for t, k in NAMED.items():
        named = F.when(F.lower("title") == t, k).otherwise(named)
    head = F.col("kind") == "heading"
    d = d.withColumn("title", F.when(head, title))
    d = d.withColumn("box_kind", F.when(F.col("level") == 1, F.when(chapter.isNotNull(), "chapter").when(appendix.isNotNull(), "appendix").otherwise(named)))
    d = d.withColumn("type", F.when(F.col("level") == 1, "division").when(head, F.when(F.col("title").rlike(SECTION), "section").otherwise("heading")).when(F.col("kind") == "paragraph", "paragraph"))
    d = d.withColumn("number", F.when(F.col("type") == "division", F.coalesce(chapter, appendix)).when(F.col("type") == "section", F.upper(_g(F.col("title"), SECTION, 1))).when(F.col("type") == "paragraph", F.regexp_extract("b", PARAGRAPH, 1)))
    seg = (
        F.when(F.col("box_kind") == "chapter", F.concat(F.lit("ch-"), "number")).when(F.col("box_kind") == "appendix", F.concat(F.lit("app-"), F.lower("number")))
        .when(F.col("type") == "division", F.replace("box_kind", F.lit("_"), F.lit("-"))).when(F.col("type") == "section", F.concat(F.lit("sec-"), F.lower("number")))
        .when(F.col("type") == "heading", tx.slug(plain(F.col("title")))).when(F.col("type") == "paragraph", F.concat(F.lit("para-"), "number"))
    )
    up = F.coalesce(*[F.when(_open(n, F.col("level")), F.col(f"h{n}")) for n in reversed(LEVELS)])
    d = d.withColumn("seg", seg).withColumn("up", F.when(head, up))
    # other blocks stand by themselves, so that they are no group
    alone = F.when(F.col("type").isNull(), F.col("at"))
    k = F.row_number().over(Window.partitionBy(*key, "up", "seg", alone).orderBy("at"))
    d = d.withColumn("seg", F.when((k == 1) | F.col("seg").isNull(), F.col("seg")).otherwise(F.concat_ws("-", "seg", k)))
    page_cite = F.when(F.col("p.label").isNotNull(), F.concat(F.lit("p. "), "p.label")).otherwise(F.concat(F.lit("PDF p. "), F.coalesce("p.page", F.lit(0))))
    cite = (
        F.when(F.col("box_kind").isin("chapter", "appendix"), F.concat_ws(" ", "box_kind", "number")).when(F.col("type") == "division", F.lower("title"))
        .when(F.col("type") == "section", F.concat(F.lit(", section "), "number")).when(F.col("type") == "paragraph", F.concat(F.lit("para "), "number")).otherwise(page_cite)
    )
    return d.withColumn("cite", F.when(F.col("type").isNotNull(), cite).otherwise(page_cite))


def _placed(d: DataFrame, key: list[str], size: int) -> DataFrame:
    """With the chain of open headings (``boxes``, and of a heading ``over``, those above it),
    open paragraph, list start, caption and table."""
    d = d.withColumn("own", F.struct("at", "seg", "type", "cite", F.coalesce("box_kind", F.lit("")).alias("kind")))
    cut = F.split(F.regexp_replace("b", r"\n\s*(?=\n)", ""), "\n")
    head_row = F.when(F.col("kind") == "table", cells(F.get(cut, F.lit(0))))
    glossary_table = (F.col("kind") == "table") & F.coalesce(F.get(head_row, F.lit(0)) == "Acronym", F.lit(False))
    holds = plain(F.col("b")).rlike(KEY) | plain(F.col("b")).rlike(NOTES)
    d = d.withColumn("legend", F.when(F.col("kind") == "text", plain(F.col("b")).rlike(KEY)).otherwise(False)).withColumn("abbr", glossary_table)
    event = F.when((F.col("kind") == "table") & ~F.col("abbr"), "table").when(F.col("legend"), "legend").when((F.col("kind") == "heading") | ~holds, "stop")
    caption = F.struct(F.regexp_extract("b", CAPTION, 1).alias("text"), F.regexp_extract("b", CAPTION, 2).alias("what"), F.regexp_extract("b", CAPTION, 3).alias("number"), F.col("p").alias("p"))
    values = {f"o{n}": F.when(F.col("level") == n, F.col("own")) for n in LEVELS}
    values |= {
        "para": F.when(F.col("kind") == "paragraph", F.col("own")), "last_head": F.when(F.col("kind") == "heading", F.col("at")),
        "list_at": F.when(F.col("kind").isin("heading", "paragraph", "text") | ((F.col("kind") == "table") & ~F.col("abbr")), F.col("at")),
        "event": F.when(event.isNotNull(), F.struct(event.alias("kind"), "at")), "before": F.struct("kind", F.when(F.col("kind") == "caption", caption).alias("c")),
    }
    d = ordered.last_of(d, key, "at", values, size=size)
    chain = lambda below=None: F.filter(F.array(*[F.when(_open(n, below), F.col(f"o{n}")) for n in LEVELS]), lambda x: x.isNotNull())
    d = d.withColumn("boxes", chain()).withColumn("over", F.when(F.col("level").isNotNull(), chain(F.col("level"))).otherwise(chain()))
    d = d.withColumn("para", F.when(F.col("para.at") > F.coalesce("last_head", F.lit(-1)), F.col("para"))).withColumn("tabled", F.when(F.col("before.c.what") == "Table", F.col("before.c")))
    return d.drop("last_head", "before", *[f"{x}{n}" for x in "ho" for n in LEVELS])


def _ids(chain: Column) -> Column:
    """The ids along a chain of headings."""
    return F.transform(chain, lambda x, i: F.array_join(F.transform(F.slice(chain, F.lit(1), i + 1), lambda y: y["seg"]), "."))


def _emitted(d: DataFrame, key: list[str], size: int) -> DataFrame:
    """The rows of nodes: one for most blocks, none for a table's caption, two where a caption
    had no table, many for a table of acronyms; and a row of the type ``legend``, without an
    ordinal of its own, for a legend that its table takes."""
    took = F.col("legend") & F.coalesce(F.col("event.kind") == "table", F.lit(False))
    in_glossary = F.get("boxes", F.lit(0))["kind"] == "glossary"
    grid = F.filter(F.split("b", "\n"), lambda x: ~x.rlike(r"(?U)^\s*$"))
    body = F.transform(F.slice(grid, F.lit(3), F.greatest(F.lit(0), F.size(grid) - 2)), cells)
    abbrs = F.filter(body, lambda r: (F.size(r) > 1) & (F.get(r, F.lit(0)) != ""))
    is_ = lambda k: F.col("kind") == k
    term = is_("text") & in_glossary & F.col("b").rlike(TERM)
    type_ = (
        F.when(F.col("type").isNotNull(), F.col("type")).when(took, "legend").when(is_("table"), F.when(F.col("abbr") & in_glossary, "acronym").otherwise("table"))
        .when(is_("caption") & (F.regexp_extract("b", CAPTION, 2) == "Figure"), "figure").when(is_("bullet"), "list_item").when(term, "term").when(is_("text"), "text")
    )
    none = F.lit(None).cast("array<string>")
    stray = F.when(F.col("tabled").isNotNull() & ~is_("table"), F.array(F.struct(F.lit("stray").alias("type"), none.alias("cells"))))
    own = F.when(type_ == "acronym", F.transform(abbrs, lambda r: F.struct(F.lit("acronym").alias("type"), r.alias("cells")))).when(type_.isNotNull(), F.array(F.struct(type_.alias("type"), none.alias("cells"))))
    empty = F.array().cast("array<struct<type:string,cells:array<string>>>")
    d = d.withColumn("out", F.concat(F.coalesce(stray, empty), F.coalesce(own, empty))).where(F.size("out") > 0)
    n = F.size(F.filter("out", lambda x: x["type"] != "legend"))
    d = ordered.running_sum(written(d), key, "at", n, "upto", size=size)
    d = d.withColumn("columns", F.when(is_("table"), cells(F.get(grid, F.lit(0))))).withColumn("rows", F.when(is_("table"), body))
    d = d.withColumn("first", F.col("upto") - n).withColumn("table_at", F.when(took, F.col("event.at"))).drop("type", "upto")
    return d.select("*", F.posexplode("out").alias("sub", "node")).select("*", "node.type", "node.cells").withColumn("ord", F.col("first") + F.col("sub")).drop("out", "node", "first", "sub", "event", "legend", "abbr")


def _listed(items: DataFrame, key: list[str]) -> DataFrame:
    """List items with their depth (at most one more than the item before), the places of
    their top and parent items, and their ordinals on the way down. The rows of a list come in
    order, and what is kept of them is one entry for each open depth."""
    more = {"depth_": T.IntegerType(), "top": T.LongType(), "item_up": T.LongType(), "nth": T.ArrayType(T.IntegerType())}
    schema = T.StructType([*items.schema.fields, *[T.StructField(n, t) for n, t in more.items()]])
    names = schema.names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held = None, []  # open items: [place, children so far]
        for b in batches:
            got = []
            for k, at, raw in zip(zip(*[b[c] for c in [*key, "list_at"]]), b["at"], b["raw"]):
                k = tuple(None if x is None or x != x else x for x in k)
                if k != now:
                    now, held = k, []
                depth = min(int(raw), len(held))
                del held[depth:]
                if depth:
                    held[-1][1] += 1
                held.append([int(at), 0])
                got.append((depth, held[0][0], held[depth - 1][0] if depth else None, [h[1] for h in held[:-1]]))
            yield b.assign(**{n: pd.Series([g[i] for g in got], dtype=object) for i, n in enumerate(more)})[names]

    by = [*key, "list_at"]
    return items.repartition(*[F.col(f"`{c}`") for c in by]).sortWithinPartitions(*by, "at").mapInPandas(run, schema)


def parse_blocks(df: DataFrame, key: list[str], at: str, block: str, size: int = ordered.SIZE) -> DataFrame:
    """Node rows (``COLUMNS``) of every key's blocks in the order of ``at``, a distinct integer
    within the key, of which ``size`` make a run. Null and blank blocks are nothing; a caption of
    a table that ends its key is dropped; text before the first division stands in one of its
    own. Columns of ``df`` other than those named play no part."""
    keys = [F.col(f"`{k}`") for k in key]
    # each pass by runs reads its rows twice: they are written before it
    d = _headed(written(_classified(df, key, at, block)), key, size * 4)
    d = _placed(written(_titled(d, key)), key, size * 4)
    # several things below are told of these rows: they are written once
    d = written(_emitted(d, key, size * 4).withColumn("list_at", F.coalesce("list_at", F.lit(-1))))

    legends = d.where("type = 'legend'").select(*[k.alias(f"lk{i}") for i, k in enumerate(keys)], "table_at", plain(F.col("b")).alias("legend_text"))
    d = d.where("type <> 'legend'").drop("table_at").join(legends, [*[k.eqNullSafe(F.col(f"lk{i}")) for i, k in enumerate(keys)], F.col("at") == F.col("table_at"), F.col("type") == "table"], "left")
    # list items: depths first, then ordinals
    empty = F.array().cast("array<int>")
    raw = (F.length(F.regexp_extract("b", BULLET, 1)) / 2).cast("int")
    items = _listed(d.where("type = 'list_item'").select(*keys, "list_at", "at", raw.alias("raw")), key).drop("raw", "list_at")
    d = d.join(items.select(*[F.col(f"`{k}`").alias(f"ik{i}") for i, k in enumerate(key)], F.col("at").alias("iat"), "depth_", "top", "item_up", "nth"),
               [*[k.eqNullSafe(F.col(f"ik{i}")) for i, k in enumerate(keys)], F.col("at") == F.col("iat"), F.col("type") == "list_item"], "left").drop("iat", *[f"ik{i}" for i in range(len(key))])

    flow = F.col("type").isin("list_item", "text")
    under_para = flow & F.col("para").isNotNull()
    chain = F.when(F.col("type").isin("division", "section", "heading"), F.col("over")).otherwise(F.col("boxes"))
    path0 = _ids(chain)
    d = d.withColumn("path0", F.when(under_para, F.concat(path0, F.array(F.col("para.seg")))).otherwise(path0)).withColumn("up_id", F.try_element_at("path0", F.lit(-1)))
    up_at = F.when(under_para, F.col("para.at")).otherwise(F.try_element_at("boxes", F.lit(-1))["at"])
    caption = F.when(F.col("type").isin("stray", "table"), F.col("tabled"))
    number = F.when(F.col("type") == "figure", F.regexp_extract("b", CAPTION, 3)).when(F.startswith(caption["text"], F.lit("Introductory")), F.concat(F.lit("Introductory "), caption["number"])).otherwise(F.coalesce(F.col("number"), caption["number"]))
    d = d.withColumn("number", F.when(F.col("type") == "stray", F.when(F.startswith(caption["text"], F.lit("Introductory")), F.concat(F.lit("Introductory "), caption["number"])).otherwise(caption["number"])).otherwise(number))
    name, abbr = plain(F.regexp_extract("b", TERM, 2)), plain(F.get("cells", F.lit(0)))
    base = (
        F.when(F.col("type") == "list_item", F.concat(up_at, F.lit(".li"))).when(F.col("type") == "text", F.concat(up_at, F.lit(".t")))
        .when(F.col("type").isin("table", "stray") & F.col("number").isNull(), F.concat("up_id", F.lit(".table"))).when(F.col("type").isin("table", "stray"), F.concat(F.lit("table-"), tx.slug(F.col("number"))))
        .when(F.col("type") == "figure", F.concat(F.lit("figure-"), tx.slug(F.col("number")))).when(F.col("type") == "term", F.concat(F.lit("term-"), tx.slug(name))).when(F.col("type") == "acronym", F.concat(F.lit("acr-"), tx.slug(abbr)))
    )
    d = d.withColumn("base", base)
    # of list items only those at the top take part; headings and paragraphs have their numbers
    counted = F.col("base").isNotNull() & ((F.col("type") != "list_item") | (F.col("depth_") == 0))
    alone = F.when(~counted, F.col("ord"))
    d = d.withColumn("k", F.when(counted, F.row_number().over(Window.partitionBy(*key, "base", alone).orderBy("ord"))))
    # the n-th of a list's top items goes down to those below it
    alone = F.when(F.col("type") != "list_item", F.col("ord"))
    below = Window.partitionBy(*key, "list_at", alone).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("k0", F.last("k", ignorenulls=True).over(below))

    nth = F.concat(F.array(F.col("k0")), F.coalesce("nth", empty))
    item_ids = F.transform(nth, lambda x, i: F.concat(F.col("up_id"), F.array_join(F.transform(F.slice(nth, F.lit(1), i + 1), lambda y: F.concat(F.lit(".li"), y)), "")))
    id_ = (
        F.when(F.col("type") == "division", F.col("seg")).when(F.col("type").isin("section", "heading"), F.concat_ws(".", "up_id", "seg")).when(F.col("type") == "paragraph", F.col("seg"))
        .when(F.col("type") == "list_item", F.try_element_at(item_ids, F.lit(-1))).when(F.col("type") == "text", F.concat(F.col("up_id"), F.lit(".t"), "k"))
        .when(F.col("k") > 1, F.concat_ws("-", "base", "k")).otherwise(F.col("base"))
    )
    path = F.when(F.col("type") == "list_item", F.concat("path0", F.slice(item_ids, F.lit(1), F.size(item_ids) - 1))).otherwise(F.col("path0"))
    spot = F.when(F.col("type") == "stray", F.col("tabled.p")).otherwise(F.col("p"))
    chained = F.aggregate(F.concat(F.col("over"), F.array("own")), F.lit(""), lambda acc, x: F.when(x["type"] == "section", F.concat(acc, x["cite"])).otherwise(x["cite"]))
    cite = (
        F.when(F.col("type") == "section", chained).when(under_para, F.col("para.cite")).when(F.col("type") == "figure", F.concat(F.lit("figure "), "number")).when(F.col("type").isin("table", "stray") & F.col("number").isNotNull(), F.concat(F.lit("table "), "number"))
        .when(F.col("type") == "term", F.concat(F.lit("glossary, "), name)).when(F.col("type") == "acronym", F.concat(F.lit("glossary, "), abbr)).otherwise(F.col("cite"))
    )
    on = lambda *ts: F.col("type").isin(*ts)
    text = F.trim(F.when(on("paragraph"), F.regexp_extract("b", PARAGRAPH, 2)).when(on("list_item"), F.regexp_extract("b", BULLET, 2)).when(on("text"), F.col("b")))
    said = F.regexp_extract("b", TERM, 3)
    title = F.when(F.col("box_kind").isin("chapter", "appendix"), _g(F.col("title"), DIVISION, 3)).when(on("section"), F.trim(_g(F.col("title"), SECTION, 2))).otherwise(F.col("title"))
    none = F.array().cast("array<string>")
    out = {
        "ord": F.col("ord"), "id": id_, "parent_id": F.try_element_at(path, F.lit(-1)), "path": path, "division_id": F.coalesce(F.get(path, F.lit(0)), id_), "type": F.when(on("stray"), "table").otherwise(F.col("type")),
        "cite": cite, "page": spot["page"], "page_label": spot["label"], "kind": F.nullif(F.col("box_kind"), F.lit("")), "number": F.col("number"), "title": F.when(on("division", "section", "heading"), title), "level": F.col("level"),
        "depth": F.col("depth_"), "text": text, "plain": plain(text), "caption": F.when(on("figure"), F.regexp_extract("b", CAPTION, 1)).otherwise(caption["text"]), "columns": F.when(on("stray"), none).when(on("table"), F.col("columns")),
        "rows": F.when(on("stray"), F.array().cast("array<array<string>>")).when(on("table"), F.col("rows")), "key": F.when(on("table"), F.col("legend_text")), "grid": F.when(on("stray"), F.lit(False)).when(on("table"), F.lit(True)),
        "term": F.when(on("term"), name), "definition": F.when(on("term"), F.trim(F.regexp_replace(said, SOURCE, ""))), "source": F.when(on("term"), F.trim(_g(F.trim(said), SOURCE, 1))), "proponent": F.when(on("term"), F.regexp_extract("b", TERM, 1) == "*"),
        "abbreviation": F.when(on("acronym"), abbr), "meaning": F.when(on("acronym"), plain(F.array_join(F.filter(F.slice(F.col("cells"), F.lit(2), F.size("cells")), lambda c: c != ""), " "))),
    }
    return d.select(*keys, *[out[c].cast(t).alias(c) for c, t in COLUMNS.items()])


def parse_rows(df: DataFrame, key: list[str], md: str) -> DataFrame:
    """Node rows of every row's Markdown, with its ``key`` (distinct). Null texts give none."""
    blocks = df.select(*[F.col(f"`{k}`") for k in key], F.posexplode(F.split(F.col(md), r"\n\n+")).alias("_at", "_block"))
    return parse_blocks(blocks, key, "_at", "_block")
