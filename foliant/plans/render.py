"""The computable part of slides: cites, footers, notes, text fit, contrast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import rx
from foliant.plans.checks import _CITES, _CLAIMS, _SLIDES, cites, claims, slides
from foliant.plans.index import nodes, nodes_sql
from foliant.plans.structure import _OWN_COLS, _OWN_SQL, own_text

#: Inches of a text box, points of its type and their floor, inches of height.
WIDTH, POINTS, FLOOR, HEIGHT = 5.0, 20, 12, 1.2
#: Most paragraphs and other cites in a footer.
PARAS, OTHERS = 5, 2


def rnd_short_cite(spark: SparkSession, sf: str) -> DataFrame:
    """The label that a node is cited by: list items and texts take their paragraph's."""
    n = nodes(spark, sf, "ord", "type", "cite", "path")
    up = n.where(F.col("type").isin("list_item", "text")).select("pub_id", "id", F.posexplode("path").alias("pos", "anc"))
    p = nodes(spark, sf, "cite", types=("paragraph",)).select("pub_id", F.col("id").alias("anc"), F.col("cite").alias("para"))
    para = up.join(p, ["pub_id", "anc"]).groupBy("pub_id", "id").agg(F.max_by("para", "pos").alias("para"))
    return n.join(para, ["pub_id", "id"], "left").select("pub_id", "id", "ord", F.coalesce("para", "cite").alias("label"))


_SHORT = f"""(select n.pub_id, n.id, n.ord, coalesce(p.para, n.cite) as label from {nodes_sql('ord, type, cite, path')} n left join (
    select u.pub_id, u.id, arg_max(p.cite, u.pos) as para from (select pub_id, id, unnest(path) as anc, generate_subscripts(path, 1) as pos from {nodes_sql('path', ('list_item', 'text'))}) u
    join {nodes_sql('cite', ('paragraph',))} p on p.pub_id = u.pub_id and p.id = u.anc group by all) p on p.pub_id = n.pub_id and p.id = n.id)"""


def rnd_slide_cites(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct labels of a slide with their rank in document order."""
    c = claims(spark, sf).select("pub_id", "slide_id", "claim_id").distinct().join(cites(spark, sf), ["pub_id", "claim_id"])
    s = rnd_short_cite(spark, sf).withColumnRenamed("id", "node_id")
    g = c.join(s, ["pub_id", "node_id"]).groupBy("pub_id", "slide_id", "label").agg(F.min("ord").alias("ord"))
    return g.withColumn("rank", F.row_number().over(Window.partitionBy("pub_id", "slide_id").orderBy("ord", "label"))).drop("ord")


_SLIDE_CITES = f"""(select pub_id, slide_id, label, row_number() over (partition by pub_id, slide_id order by ord, label) as rank from (
    select c.pub_id, c.slide_id, s.label, min(s.ord) as ord from (select distinct pub_id, slide_id, claim_id from {_CLAIMS}) c join {_CITES} x on x.pub_id = c.pub_id and x.claim_id = c.claim_id join {_SHORT} s on s.pub_id = x.pub_id and s.id = x.node_id group by all))"""


def rnd_footer(spark: SparkSession, sf: str) -> DataFrame:
    """Footer of each slide: the first five paragraphs, the first two other cites, and how
    many more there are."""
    c = rnd_slide_cites(spark, sf)
    g = c.groupBy("pub_id", "slide_id").agg(F.array_sort(F.collect_list(F.struct("rank", "label"))).alias("ls"))
    labels = F.transform("ls", lambda x: x["label"])
    para = F.transform(F.filter(labels, lambda x: x.startswith("para ")), lambda x: F.regexp_replace(x, "^para ", ""))
    rest = F.filter(labels, lambda x: ~x.startswith("para "))
    more = lambda a, k: F.when(F.size(a) > k, F.concat(F.lit(" +"), F.size(a) - k, F.lit(" more"))).otherwise("")
    one = F.when(F.size(para) > 0, F.concat(F.when(F.size(para) == 1, "para ").otherwise("paras "), F.array_join(F.slice(para, 1, PARAS), ", "), more(para, PARAS)))
    two = F.when(F.size(rest) > 0, F.concat(F.array_join(F.slice(rest, 1, OTHERS), ", "), more(rest, OTHERS)))
    return g.select("pub_id", "slide_id", F.concat_ws(" · ", F.replace("pub_id", F.lit("-"), F.lit(" ")), one, two).alias("footer"))


def rnd_notes(spark: SparkSession, sf: str) -> DataFrame:
    """Notes of each slide: the source text, word for word, of the cited nodes that no cited
    ancestor covers, in document order, each under its label."""
    c = claims(spark, sf).select("pub_id", "slide_id", "claim_id").distinct().join(cites(spark, sf), ["pub_id", "claim_id"]).select("pub_id", "slide_id", "node_id").distinct()
    t = own_text(spark, sf).select("pub_id", F.col("id").alias("node_id"), "ord", "path", "t")
    held = c.join(t, ["pub_id", "node_id"])
    under = held.select("pub_id", "slide_id", "node_id", F.explode("path").alias("anc")).join(c.select("pub_id", "slide_id", F.col("node_id").alias("anc")), ["pub_id", "slide_id", "anc"], "left_semi").select("pub_id", "slide_id", "node_id").distinct()
    top = held.join(under, ["pub_id", "slide_id", "node_id"], "left_anti").join(rnd_short_cite(spark, sf).select("pub_id", F.col("id").alias("node_id"), "label"), ["pub_id", "node_id"])
    line = F.concat(F.lit("["), "label", F.lit("] "), F.coalesce("t", F.lit("")))
    g = top.groupBy("pub_id", "slide_id").agg(F.array_sort(F.collect_list(F.struct("ord", line.alias("l")))).alias("ls"))
    return g.select("pub_id", "slide_id", F.array_join(F.transform("ls", lambda x: x["l"]), "\n").alias("notes"))


# lines of a text at a size, and the least shrink that makes it fit its box
_LINES = "greatest(1, ceil(length(text) / greatest(1, floor({w} * 72 / ({pt} * 0.5)))))"
_FITS = "{lines} * {pt} * 1.2 / 72 <= {h}"


def rnd_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Points that each statement has to shrink to fit its box; at the floor it is warned of."""
    c = claims(spark, sf).where("text is not null and not in_notes").select("pub_id", "slide_id", "claim_id", "pattern", "text").distinct()
    lines = _LINES.format(w=WIDTH, pt=f"({POINTS} - d)")
    fit = F.expr(f"array_min(filter(sequence(0, {POINTS - FLOOR}), d -> {_FITS.format(lines=lines, pt=f'({POINTS} - d)', h=HEIGHT)}))")
    return c.select("pub_id", "slide_id", "claim_id", F.coalesce(fit, F.lit(POINTS - FLOOR)).alias("shrink"), fit.isNull().alias("warned"))


def rnd_equalize(spark: SparkSession, sf: str) -> DataFrame:
    """Statements of a slide take the greatest shrink among them."""
    return rnd_fit(spark, sf).groupBy("pub_id", "slide_id").agg(F.max("shrink").alias("shrink"), F.count("*").alias("boxes"), F.count_if("warned").alias("warned"))


def rnd_split(spark: SparkSession, sf: str) -> DataFrame:
    """Slides with more statements than fit, halved (the greater half first) until each piece
    fits or is too small to halve."""
    n = claims(spark, sf).where("not in_notes").groupBy("pub_id", "slide_id").agg(F.count("*").cast("int").alias("n"))
    n.createOrReplaceTempView("foliant_pieces")
    return spark.sql("""
        WITH RECURSIVE p(pub_id, slide_id, n, place) AS (
          SELECT pub_id, slide_id, n, '1' FROM foliant_pieces
          UNION ALL SELECT pub_id, slide_id, IF(h = 0, CAST(ceil(n / 2) AS INT), CAST(floor(n / 2) AS INT)), concat(place, '.', CAST(h + 1 AS STRING))
            FROM (SELECT *, explode(array(0, 1)) AS h FROM p WHERE n > 3 AND n >= 4))
        SELECT pub_id, slide_id, place, n FROM p WHERE NOT (n > 3 AND n >= 4)""")


# The deck's palette and the pairs of text and ground in use.
PALETTE = {"black": "221F20", "gold": "FFCC01", "white": "FFFFFF", "olive": "565557", "gray": "727365", "light": "D5D5D7", "pale": "F1E4C7", "dark_gold": "7A6200", "green": "2F6B2F", "red": "9B1C1C"}
PAIRS = [("black", "white"), ("white", "black"), ("black", "gold"), ("white", "olive"), ("gray", "white"), ("black", "light"), ("black", "pale"), ("dark_gold", "white"), ("green", "white"), ("red", "white"), ("white", "green"), ("white", "red")]


def rnd_contrast(spark: SparkSession, sf: str) -> DataFrame:
    """WCAG contrast of each pair; 4.5 is the least allowed."""
    d = spark.createDataFrame([(a, b, PALETTE[a], PALETTE[b]) for a, b in PAIRS], "ink string, ground string, x string, y string")

    def luminance(c: str) -> F.Column:
        part = lambda i: F.conv(F.substring(c, i, 2), 16, 10).cast("double") / 255
        lin = lambda v: F.when(v <= 0.03928, v / 12.92).otherwise(F.pow((v + 0.055) / 1.055, F.lit(2.4)))
        return 0.2126 * lin(part(1)) + 0.7152 * lin(part(3)) + 0.0722 * lin(part(5))

    d = d.withColumn("a", luminance("x")).withColumn("b", luminance("y"))
    r = F.round((F.greatest("a", "b") + 0.05) / (F.least("a", "b") + 0.05), 4)
    return d.select("ink", "ground", r.alias("contrast"), (r >= 4.5).alias("ok"))


# Patterns and the kind of layout that each is drawn on.
PATTERNS = "title at_a_glance takeaways whats_new divider key_idea checklist big_numbers comparison closing process_flow cycle roles timeline do_dont table decision_tree key_terms acronyms".split()
LAYOUTS = {p: {"title": "title", "closing": "title", "divider": "section"}.get(p, "content") for p in PATTERNS}


def rnd_registry(spark: SparkSession, sf: str) -> DataFrame:
    """Patterns in use with their layout and how many slides have it."""
    m = spark.createDataFrame(list(LAYOUTS.items()), "pattern string, layout string")
    s = slides(spark, sf).groupBy("pattern").agg(F.countDistinct("pub_id", "slide_id").alias("slides"))
    return F.broadcast(m).join(s, "pattern", "left").fillna(0, ["slides"])


QUERIES = {f.__name__: f for f in (rnd_short_cite, rnd_slide_cites, rnd_footer, rnd_notes, rnd_fit, rnd_equalize, rnd_split, rnd_contrast, rnd_registry)}

_FIT_SQL = f"""(select pub_id, slide_id, claim_id, coalesce(fit, {POINTS - FLOOR}) as shrink, fit is null as warned from (
    select *, list_min(list_filter(generate_series(0, {POINTS - FLOOR}), lambda d: {_FITS.format(lines=_LINES.format(w=WIDTH, pt=f'({POINTS} - d)'), pt=f'({POINTS} - d)', h=HEIGHT)})) as fit
    from (select distinct pub_id, slide_id, claim_id, pattern, text from {_CLAIMS} where text is not null and not in_notes)))"""
_HEX = lambda c, i: f"(('0x' || substr({c}, {i}, 2))::int / 255.0)"
_LIN = lambda v: f"case when {v} <= 0.03928 then {v} / 12.92 else pow(({v} + 0.055) / 1.055, 2.4) end"
_LUM = lambda c: f"0.2126 * {_LIN(_HEX(c, 1))} + 0.7152 * {_LIN(_HEX(c, 3))} + 0.0722 * {_LIN(_HEX(c, 5))}"
SQL = {
    "rnd_short_cite": f"select * from {_SHORT}",
    "rnd_slide_cites": f"select * from {_SLIDE_CITES}",
    "rnd_footer": f"""select pub_id, slide_id, concat_ws(' · ', replace(pub_id, '-', ' '),
      case when len(p) > 0 then case when len(p) = 1 then 'para ' else 'paras ' end || array_to_string(p[1:{PARAS}], ', ') || case when len(p) > {PARAS} then ' +' || (len(p) - {PARAS}) || ' more' else '' end end,
      case when len(o) > 0 then array_to_string(o[1:{OTHERS}], ', ') || case when len(o) > {OTHERS} then ' +' || (len(o) - {OTHERS}) || ' more' else '' end end) as footer from (
      select pub_id, slide_id, list_transform(list_filter(ls, lambda x: starts_with(x, 'para ')), lambda x: substr(x, 6)) as p, list_filter(ls, lambda x: not starts_with(x, 'para ')) as o from (
        select pub_id, slide_id, list(label order by rank) as ls from {_SLIDE_CITES} group by all))""",
    "rnd_notes": f"""with c as (select distinct c.pub_id, c.slide_id, x.node_id from {_CLAIMS} c join {_CITES} x on x.pub_id = c.pub_id and x.claim_id = c.claim_id),
      h as (select c.*, n.ord, n.path, n.own from c join (select *, trim({_OWN_SQL}) as own from {nodes_sql(_OWN_COLS)}) n on n.pub_id = c.pub_id and n.id = c.node_id)
      select h.pub_id, h.slide_id, string_agg('[' || s.label || '] ' || coalesce(h.own, ''), chr(10) order by h.ord) as notes from h join {_SHORT} s on s.pub_id = h.pub_id and s.id = h.node_id
      where not exists (select 1 from c u where u.pub_id = h.pub_id and u.slide_id = h.slide_id and list_contains(h.path, u.node_id)) group by h.pub_id, h.slide_id""",
    "rnd_fit": f"select * from {_FIT_SQL}",
    "rnd_equalize": f"select pub_id, slide_id, max(shrink) as shrink, count(*) as boxes, count(*) filter (warned) as warned from {_FIT_SQL} group by pub_id, slide_id",
    "rnd_registry": f"""select m.pattern, m.layout, count(distinct s.pub_id || '/' || s.slide_id) as slides from (values {", ".join(f"('{p}', '{k}')" for p, k in LAYOUTS.items())}) m(pattern, layout)
      left join slides s on s.pattern = m.pattern group by all""",
    "rnd_split": f"""with recursive p as (select pub_id, slide_id, cast(count(*) as int) as n, '1' as place from {_CLAIMS} where not in_notes group by pub_id, slide_id
      union all select pub_id, slide_id, case when h = 0 then (n + 1) // 2 else n // 2 end, place || '.' || (h + 1) from p, (select unnest([0, 1]) as h) where n > 3 and n >= 4)
      select pub_id, slide_id, place, n from p where not (n > 3 and n >= 4)""",
    "rnd_contrast": f"""select ink, ground, round((greatest(a, b) + 0.05) / (least(a, b) + 0.05), 4) as contrast, round((greatest(a, b) + 0.05) / (least(a, b) + 0.05), 4) >= 4.5 as ok from (
      select ink, ground, {_LUM("x")} as a, {_LUM("y")} as b from (values {", ".join(f"('{a}', '{b}', '{PALETTE[a]}', '{PALETTE[b]}')" for a, b in PAIRS)}) v(ink, ground, x, y))""",
}
