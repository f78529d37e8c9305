"""Checks of decks against their publication: claims, slides, coverage, review.

Statements (claims) rest on the nodes that they cite. The text of those nodes, with what
stands below them, is put together per claim only (its few cites), never per publication.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import rx, text as tx
from foliant.operators.ordered import last_before
from foliant.plans import index as ix
from foliant.plans.index import TEXTS, nodes, nodes_sql
from foliant.plans.structure import CONTAINERS, SQL as STRUCTURE_SQL, _OWN_COLS, _OWN_SQL, _own, cited
from foliant.session import table, written

# Directive words of a deck; those that are errors when added; number words.
DECK_DIRECTIVE = r"\b(will\s+not|must\s+not|may\s+not|should\s+not|shall|will|must|may|should)\b"
STRICT = ("will not", "must not", "may not", "should not", "shall", "will", "must")
NUMBER = r"(?:^|[^\w-])(\d[\d,]*(?:\.\d+)?)"
REFERENCE = r"(?i)\b(?:chapter|appendix|section|table|figure|para(?:graph)?)\s+[\w-]+"
NUMBER_WORDS = "zero one two three four five six seven eight nine ten eleven twelve".split()
VISUAL = ("process_flow", "cycle", "roles", "timeline", "do_dont", "table", "big_numbers", "comparison", "decision_tree", "key_terms", "key_idea", "at_a_glance")
STRUCTURAL = ("title", "divider", "acronyms", "closing")
FORM = r"(?i)\b(?:(?:DA|DD|SF)\s+Form|DA\s+Pam|FM|AR|ATP|ADP|TC|TM|JP)\s+\d[\w-]*(?:\.\d+)?"
MONTH = r"(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|Jun(?:e)?|Jul(?:y)?|Aug(?:ust)?|Sep(?:t(?:ember)?)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)"
# months in capitals; "May", also a directive word, only with a day or a year
DATE = (
    rf"\b(?:\d{{1,2}}\s+)?{MONTH}\b\.?(?:\s+\d{{1,2}}(?!\d))?(?:,?\s+\d{{4}})?|\b(?:\d{{1,2}}\s+)?May(?:\s+\d{{1,2}},?\s+\d{{4}}|\s+\d{{4}}|\s+\d{{1,2}}\b)"
    r"|\b\d{1,2}\s+May\b|\b\d{1,2}/\d{1,2}/\d{2,4}\b|\b(?:19|20)\d{2}\b"
)
#: For engines without look-around: the same but for a day with letters right behind it.
DATE_SQL = DATE.replace(r"(?!\d)", r"\b")
_IN = lambda ts: "(" + ", ".join(f"'{t}'" for t in ts) + ")"


def claims(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct claims that stand or stood."""
    return table(spark, sf, "claims").select("pub_id", "slide_id", "claim_id", "pattern", "text", "parts", "directive", "in_notes").distinct()


_CLAIMS = "(select distinct pub_id, slide_id, claim_id, pattern, text, parts, directive, in_notes from claims)"
_SLIDES = f"(select distinct pub_id, slide_ord, slide_id, pattern, title, chapter, callout, {tx.bare_sql('source_table')} as source_table from slides)"


def slides(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "slides").select("pub_id", "slide_ord", "slide_id", "pattern", "title", "chapter", "callout", tx.bare(F.col("source_table")).alias("source_table")).distinct()


def cites(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "claim_cites").where("node_id is not null").select("pub_id", "claim_id", tx.bare(F.col("node_id")).alias("node_id")).distinct()


_CITES = f"(select distinct pub_id, claim_id, {tx.bare_sql('node_id')} as node_id from claim_cites where node_id is not null)"


def directive_words(c: F.Column) -> F.Column:
    return F.array_distinct(F.transform(tx.found(F.lower(c), DECK_DIRECTIVE), lambda m: F.regexp_replace(m, r"\s+", " ")))


def _dw_sql(c: str) -> str:
    return f"list_distinct(list_transform(regexp_extract_all(lower({c}), {rx.sql(DECK_DIRECTIVE)}, 1), lambda m: regexp_replace(m, '\\s+', ' ', 'g')))"


def numbers(c: F.Column) -> F.Column:
    """Numbers of a text, number words as digits; references aren't numbers."""
    t = F.regexp_replace(c, REFERENCE, " ")
    digits = F.transform(tx.found(t, NUMBER), lambda m: F.replace(m, F.lit(","), F.lit("")))
    # the words are looked for once, not anew for each number word
    known = F.array(*[F.lit(w) for w in NUMBER_WORDS])
    spelt = F.transform(F.array_intersect(tx.found(F.lower(t), "([a-z]+)"), known), lambda w: (F.array_position(known, w) - 1).cast("string"))
    return F.array_distinct(F.concat(digits, spelt))


def _num_sql(c: str) -> str:
    t = f"regexp_replace({c}, {rx.sql(REFERENCE)}, ' ', 'g')"
    ws = f"regexp_extract_all(lower({t}), '[a-z]+')"
    spelt = "[" + ", ".join(f"case when list_contains({ws}, '{w}') then '{i}' end" for i, w in enumerate(NUMBER_WORDS)) + "]"
    return f"list_distinct(list_concat(list_transform(regexp_extract_all({t}, {rx.sql(NUMBER)}, 1), lambda m: replace(m, ',', '')), list_filter({spelt}, lambda x: x is not null)))"


def claim_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Claims that cite a node that there is, with the text of what they cite and all below, in
    document order. Ids meet first, and each cited node's text travels once. Repeated nodes meet
    as they are: ids are made distinct after, and texts put together as sets."""
    n = table(spark, sf, "nodes")
    below = n.select("pub_id", F.col("id").alias("under"), F.explode(F.concat("path", F.array("id"))).alias("node_id"))
    ids = cites(spark, sf).join(below, ["pub_id", "node_id"]).select("pub_id", "claim_id", F.col("under").alias("id")).distinct()
    t = n.select("pub_id", "id", "ord", F.trim(_own()).alias("t"))
    src = ids.join(t, ["pub_id", "id"]).groupBy("pub_id", "claim_id").agg(F.array_sort(F.collect_set(F.when(F.col("t") != "", F.struct("ord", "t")))).alias("ts"))
    src = src.select("pub_id", "claim_id", F.array_join(F.transform("ts", lambda x: x["t"]), " ").alias("source"))
    return claims(spark, sf).join(src, ["pub_id", "claim_id"])


_SOURCES = f"""(select c.*, s.source from {_CLAIMS} c join (
    select pub_id, claim_id, coalesce(string_agg(t, ' ' order by ord, t) filter (t <> ''), '') as source from (
      select distinct c.pub_id, c.claim_id, n.ord, n.t from {_CITES} c join (select pub_id, ord, unnest(list_append(path, id)) as anc, coalesce(own, '') as t from (select *, trim({_OWN_SQL}) as own from {nodes_sql(_OWN_COLS)})) n
        on n.pub_id = c.pub_id and n.anc = c.node_id) group by all) s on s.pub_id = c.pub_id and s.claim_id = c.claim_id)"""


def cited_ids(spark: SparkSession, sf: str) -> DataFrame:
    """All that a deck cites: nodes, source tables."""
    s = slides(spark, sf).where("source_table is not null").select("pub_id", F.col("source_table").alias("id"))
    return cited(spark, sf).unionByName(s).distinct()


# By pattern the fewest and most statements of a slide and the longest part of one.
BUDGETS = {
    "title": (0, 0, 120), "at_a_glance": (2, 6, 160), "takeaways": (3, 5, 160), "whats_new": (2, 6, 160), "divider": (0, 1, 160), "key_idea": (1, 4, 160), "process_flow": (3, 7, 140), "cycle": (3, 6, 140), "roles": (2, 18, 160), "timeline": (3, 7, 140),
    "checklist": (3, 7, 160), "do_dont": (2, 8, 160), "table": (1, 6, 80), "big_numbers": (2, 5, 160), "comparison": (2, 12, 160), "decision_tree": (3, 9, 90), "key_terms": (2, 6, 200), "acronyms": (1, 30, 80), "closing": (0, 5, 160),
}
DIRECTIVES = ("will", "will not", "must", "must not", "shall", "may", "may not", "should", "should not")
NODE_ID, SLIDE_ID, TITLE_MOST, NOTES_MOST = r"^[A-Za-z0-9][\w.\-]*$", r"^s\d{2,3}$", 70, 5
_BUDGETS = "(values " + ", ".join(f"('{p}', {a}, {b}, {c})" for p, (a, b, c) in BUDGETS.items()) + ") as b(pattern, least, most, longest)"


def spec_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Slides and statements that break the deck's schema, by rule: forms of ids, lengths, known
    patterns and directives, and each pattern's own budgets of statements and letters."""
    bad = lambda df, key, rule, cond: df.where(cond).select("pub_id", F.col(key).alias("where_id"), F.lit(rule).alias("rule"))
    b = spark.createDataFrame([(p, *v) for p, v in BUDGETS.items()], "pattern string, least int, most int, longest int")
    s = slides(spark, sf).join(F.broadcast(b), "pattern", "left")
    c = claims(spark, sf)
    n = c.groupBy("pub_id", "slide_id").agg(F.countDistinct(F.when(~F.col("in_notes"), F.col("claim_id"))).alias("n"), F.countDistinct(F.when(F.col("in_notes"), F.col("claim_id"))).alias("notes"))
    s = s.join(n, ["pub_id", "slide_id"], "left").fillna(0, ["n", "notes"])
    each = c.where(~F.col("in_notes")).join(F.broadcast(b), "pattern").select("pub_id", "claim_id", "longest", F.explode("parts").alias("part"))
    k = table(spark, sf, "claim_cites").where("node_id is not null").select("pub_id", "claim_id", tx.bare(F.col("node_id")).alias("node_id"))
    parts = [
        bad(s, "slide_id", "slide id", ~F.col("slide_id").rlike(SLIDE_ID)), bad(s, "slide_id", "title", F.col("title").isNull() | ~F.length("title").between(1, TITLE_MOST)), bad(s, "slide_id", "pattern", F.col("least").isNull()),
        bad(s, "slide_id", "chapter", ~F.col("chapter").rlike(NODE_ID)), bad(s, "slide_id", "callout", F.col("callout").isNotNull() & (F.col("pattern").isin(*STRUCTURAL) | ~F.lower("callout").isin("caution", "warning"))),
        bad(s, "slide_id", "statements", ~F.col("n").between(F.col("least"), F.col("most"))), bad(s, "slide_id", "talking points", F.col("notes") > NOTES_MOST),
        bad(each, "claim_id", "length", ~F.length("part").between(1, F.col("longest"))), bad(c, "claim_id", "text", F.coalesce(F.length("text"), F.lit(0)) == 0), bad(c, "claim_id", "directive", ~F.col("directive").isin(*DIRECTIVES)),
        bad(c, "claim_id", "directive not in the text", F.col("directive").isNotNull() & ~F.coalesce(F.contains(F.lower("text"), F.lower("directive")), F.lit(False))), bad(k, "claim_id", "cite", ~F.col("node_id").rlike(NODE_ID)),
    ]
    return functools.reduce(DataFrame.unionByName, parts).distinct()


def chk_unknown_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Cites, source tables and chapters that name no node of the right type."""
    n = nodes(spark, sf, "type")
    c = cites(spark, sf).select("pub_id", F.col("claim_id").alias("where_id"), F.lit("cite").alias("what"), "node_id")
    c = c.join(n.select("pub_id", F.col("id").alias("node_id")), ["pub_id", "node_id"], "left_anti")
    s = slides(spark, sf)
    t = s.where("source_table is not null").select("pub_id", F.col("slide_id").alias("where_id"), F.lit("source_table").alias("what"), F.col("source_table").alias("node_id"))
    t = t.join(n.where("type = 'table'").select("pub_id", F.col("id").alias("node_id")), ["pub_id", "node_id"], "left_anti")
    d = s.where("chapter is not null").select("pub_id", F.col("slide_id").alias("where_id"), F.lit("chapter").alias("what"), F.col("chapter").alias("node_id"))
    d = d.join(n.where("type = 'division'").select("pub_id", F.col("id").alias("node_id")), ["pub_id", "node_id"], "left_anti")
    return c.unionByName(t).unionByName(d).distinct()


def chk_container_cite(spark: SparkSession, sf: str) -> DataFrame:
    """Cites of whole containers; those of dividers are as they should be."""
    n = nodes(spark, sf, "type", types=CONTAINERS).select("pub_id", F.col("id").alias("node_id"), "type")
    c = claims(spark, sf).where("pattern <> 'divider'").select("pub_id", "claim_id").distinct()
    return cites(spark, sf).join(n, ["pub_id", "node_id"]).join(c, ["pub_id", "claim_id"], "left_semi")


def chk_title_directive(spark: SparkSession, sf: str) -> DataFrame:
    """Slide titles with a strict word."""
    s = slides(spark, sf).withColumn("w", F.filter(directive_words(F.col("title")), lambda x: x.isin(*STRICT)))
    return s.where(F.size("w") > 0).select("pub_id", "slide_id", F.explode("w").alias("word")).distinct()


def chk_directive_in_source(spark: SparkSession, sf: str, sources: DataFrame | None = None) -> DataFrame:
    """Claims whose directive isn't a directive word of what they cite."""
    c = (claim_sources(spark, sf) if sources is None else sources).where("directive is not null")
    return c.where(~F.array_contains(directive_words(F.col("source")), F.lower("directive"))).select("pub_id", "claim_id", "directive").distinct()


def chk_added_directive(spark: SparkSession, sf: str, sources: DataFrame | None = None) -> DataFrame:
    """Directive words of a claim, its own directive apart, that its source lacks: strict ones
    are errors."""
    c = (claim_sources(spark, sf) if sources is None else sources).where("text is not null")
    added = F.array_except(directive_words(F.col("text")), directive_words(F.col("source")))
    d = c.select("pub_id", "claim_id", F.explode(F.filter(added, lambda w: ~w.eqNullSafe(F.col("directive")))).alias("word")).distinct()
    return d.withColumn("level", F.when(F.col("word").isin(*STRICT), "error").otherwise("warning"))


def exploded(c: DataFrame, name: str, values: F.Column) -> DataFrame:
    """Distinct (pub_id, claim_id, ``name``), a row for each of ``values``, none of which is null.
    An outer explode, as before an inner one Spark filters by the same expression, which then is
    reckoned three times."""
    return c.select("pub_id", "claim_id", F.explode_outer(values).alias(name)).where(F.col(name).isNotNull()).distinct()


def chk_numbers(spark: SparkSession, sf: str, sources: DataFrame | None = None) -> DataFrame:
    c = (claim_sources(spark, sf) if sources is None else sources).where("text is not null")
    return exploded(c, "number", F.array_except(numbers(F.col("text")), numbers(F.col("source"))))


def chk_callout(spark: SparkSession, sf: str) -> DataFrame:
    """Claims on a slide with a callout of whose cited nodes none is under its label: none begins
    with it, text of what is below included, nor follows, through text nodes alone, a node that
    is the label."""
    s = slides(spark, sf).where("callout is not null").select("pub_id", "slide_id", F.upper("callout").alias("label")).distinct()
    labels = s.select("pub_id", F.col("label").alias("l")).distinct().groupBy("pub_id").agg(F.collect_set("l").alias("labels"))
    # of a text no more travels than a label can be long
    longest = s.agg(F.max(F.length("label"))).first()[0] or 0
    text = F.upper(F.trim("plain"))
    short = {"text": F.when(F.length(text) <= longest, text), "ends": (F.col("type") != "text") | F.coalesce(F.trim("plain") == "", F.lit(True))}
    # islands of text nodes: a label opens one, and any other node that isn't text ends it
    n = nodes(spark, sf, "ord", derived=short).join(labels, "pub_id")
    event = F.when(F.coalesce(F.array_contains("labels", F.col("text")), F.lit(False)), F.col("text")).when(F.col("ends"), F.lit(""))
    n = written(n.select("pub_id", "id", "ord", event.alias("event")))
    at = last_before(n, ["pub_id"], "ord", F.col("event"), "under").select("pub_id", F.col("id").alias("node_id"), F.coalesce("under", F.lit("")).alias("under"))
    # a subtree's text begins with that of the first node in it that has one
    own = table(spark, sf, "nodes").select("pub_id", "id", "ord", "path", F.substring(F.upper(F.substring(F.trim(_own()), 1, 200)), 1, max(longest, 1)).alias("t")).where("t <> ''")
    first = own.select("pub_id", F.explode(F.concat("path", F.array("id"))).alias("node_id"), "ord", "t").groupBy("pub_id", "node_id").agg(F.min_by("t", "ord").alias("begins"))
    c = claims(spark, sf).where(~F.col("in_notes")).select("pub_id", "slide_id", "claim_id").distinct().join(s, ["pub_id", "slide_id"])
    j = c.join(cites(spark, sf), ["pub_id", "claim_id"], "left").join(at, ["pub_id", "node_id"], "left").join(first, ["pub_id", "node_id"], "left")
    ok = F.coalesce(F.startswith(F.col("begins"), F.col("label")), F.lit(False)) | F.coalesce(F.col("under") == F.col("label"), F.lit(False))
    return j.groupBy("pub_id", "slide_id", "claim_id", "label").agg(F.max(ok).alias("ok")).where(~F.col("ok")).drop("ok")


ACRONYM_ENTRY = r"^\s*([A-Z][A-Za-z0-9/&-]*)\s*(?:[–:-]+|\s)\s*(\S.*)$"


def slide_words(spark: SparkSession, sf: str) -> DataFrame:
    """(pub_id, slide_id, slide_ord, said): everything that slides say but for those of acronyms:
    titles and claims."""
    s = slides(spark, sf).where("pattern <> 'acronyms'").groupBy("pub_id", "slide_id").agg(F.min("slide_ord").alias("slide_ord"), F.array_join(F.array_sort(F.collect_set("title")), " ").alias("title"))
    t = s.select("pub_id", "slide_id", F.col("title").alias("said")).unionByName(claims(spark, sf).where("pattern <> 'acronyms' and text is not null").select("pub_id", "slide_id", F.col("text").alias("said")))
    return t.distinct().join(s.drop("title"), ["pub_id", "slide_id"])


def acronym_entries(spark: SparkSession, sf: str) -> DataFrame:
    """The entries of acronym slides: abbreviation and meaning are the parts of a claim, or stand
    in its text one after the other."""
    c = claims(spark, sf).where("pattern = 'acronyms'")
    two = F.size("parts") >= 2
    abbr = F.trim(F.when(two, F.get("parts", F.lit(0))).otherwise(F.regexp_extract("text", ACRONYM_ENTRY, 1)))
    meaning = F.trim(F.when(two, F.get("parts", F.lit(1))).otherwise(F.regexp_extract("text", ACRONYM_ENTRY, 2)))
    return c.select("pub_id", "slide_id", "claim_id", abbr.alias("abbreviation"), meaning.alias("meaning")).where("abbreviation <> ''").distinct()


def _used(t: F.Column) -> F.Column:
    """Tokens of a text that may be acronyms; one before a number is part of a designation."""
    return F.array_distinct(F.split(F.regexp_replace(t, r"([A-Za-z0-9_-]+)\s+\d", " "), r"[^A-Za-z0-9_-]+"))


def chk_acronym_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Glossary acronyms that a deck uses (as tokens, not before a number), the first slide that
    does, and whether the acronyms slide lists them."""
    a = nodes(spark, sf, "abbreviation", types=("acronym",)).where("length(abbreviation) >= 2").select("pub_id", F.col("abbreviation").alias("token")).distinct()
    u = slide_words(spark, sf).select("pub_id", "slide_id", "slide_ord", F.explode(_used(F.col("said"))).alias("token")).join(a, ["pub_id", "token"], "left_semi")
    g = u.groupBy("pub_id", "token").agg(F.min_by("slide_id", F.struct("slide_ord", "slide_id")).alias("first_slide"), F.countDistinct("slide_id").alias("slides"))
    listed = acronym_entries(spark, sf).select("pub_id", F.col("abbreviation").alias("token")).distinct().withColumn("l", F.lit(True))
    return g.join(listed, ["pub_id", "token"], "left").select("pub_id", "token", "first_slide", "slides", F.coalesce("l", F.lit(False)).alias("listed"))


def chk_acronym_entry(spark: SparkSession, sf: str) -> DataFrame:
    """Entries of acronym slides that the glossary lacks (error) or spells out otherwise, letter
    case apart (warning); claims without a known cite are passed over."""
    a = nodes(spark, sf, "abbreviation", "meaning", types=("acronym",)).groupBy("pub_id", "abbreviation").agg(F.collect_set(F.lower(F.trim("meaning"))).alias("known"))
    e = acronym_entries(spark, sf).join(claim_sources(spark, sf).select("pub_id", "claim_id").distinct(), ["pub_id", "claim_id"], "left_semi").join(a, ["pub_id", "abbreviation"], "left")
    level = F.when(F.col("known").isNull(), "error").when(~F.array_contains("known", F.lower("meaning")), "warning")
    return e.select("pub_id", "claim_id", "abbreviation", "meaning", level.alias("level")).where("level is not null")


def chk_key_term(spark: SparkSession, sf: str) -> DataFrame:
    """Terms of key term slides that neither the glossary nor the cited text holds. The term is a
    claim's first part, or stands before a dash in its text."""
    c = claim_sources(spark, sf).where("pattern = 'key_terms'")
    term = F.lower(F.trim(F.when(F.size("parts") >= 2, F.get("parts", F.lit(0))).otherwise(F.regexp_extract("text", r"^([^–—:]+?)\s*[–—:]", 1))))
    t = c.select("pub_id", "claim_id", "source", term.alias("term")).where("term <> ''")
    g = nodes(spark, sf, "term", types=("term",)).select("pub_id", F.lower("term").alias("term")).distinct()
    return t.join(g, ["pub_id", "term"], "left_anti").where(~F.contains(F.lower("source"), F.col("term"))).select("pub_id", "claim_id", "term").distinct()


def chk_deck_shape(spark: SparkSession, sf: str) -> DataFrame:
    """Each deck's size, share of visual slides, second pattern and repeated fixed slides."""
    s = slides(spark, sf).select("pub_id", "slide_ord", "slide_id", "pattern").distinct()
    content = ~F.col("pattern").isin(*STRUCTURAL)
    fixed = ("title", "at_a_glance", "takeaways", "whats_new", "key_terms", "acronyms", "closing")
    g = s.groupBy("pub_id").agg(
        F.countDistinct("slide_id").alias("slides"), F.count_if(content).alias("content"), F.count_if(content & F.col("pattern").isin(*VISUAL)).alias("visual"),
        F.max(F.when(F.col("slide_ord") == 2, F.col("pattern"))).alias("second"), *[F.count_if(F.col("pattern") == p).alias(f"n_{p}") for p in fixed],
    )
    repeated = F.concat_ws(",", *[F.when(F.col(f"n_{p}") > 1, F.lit(p)) for p in fixed])
    return g.select("pub_id", "slides", "content", "visual", F.when(F.col("content") > 0, F.round(F.col("visual") / F.col("content"), 4)).otherwise(0.0).alias("visual_share"), "second", repeated.alias("repeated"))


def chk_deck_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Rules of a deck's shape that it breaks: its size, its share of visual slides, the places of
    the fixed slides, and fixed slides that repeat."""
    s = slides(spark, sf).select("pub_id", "slide_ord", "slide_id", "pattern").distinct()
    g = s.groupBy("pub_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("slide_ord", "slide_id", "pattern"))), lambda x: x["pattern"]).alias("ps"))
    ps, n = F.col("ps"), F.size("ps")
    content = F.filter(ps, lambda p: ~p.isin(*STRUCTURAL))
    visual = F.size(F.filter(content, lambda p: p.isin(*VISUAL)))
    at = lambda p: F.array_position(ps, p)
    times = lambda p: F.size(F.filter(ps, lambda x: x == p))
    rules = [
        ("size", ~n.between(25, 40)), ("visual share", visual < 0.6 * F.greatest(F.lit(1), F.size(content))), ("at_a_glance second", (n > 1) & (F.get(ps, F.lit(1)) != "at_a_glance")),
        ("takeaways third or fourth", ~F.array_contains(F.slice(ps, F.lit(3), F.lit(2)), "takeaways")), ("acronyms before closing", (n > 2) & (F.get(ps, n - 2) != "acronyms")),
        ("key_terms before acronyms", (at("key_terms") > 0) & (at("key_terms") != n - 2)), ("front slides before the chapters", at("divider") > 5),
        *[(f"one {p}", times(p) > 1) for p in FIXED_SLIDES],
    ]
    broken = F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]), lambda r: r.isNotNull())
    return g.select("pub_id", F.explode(broken).alias("rule"))


FIXED_SLIDES = ("title", "at_a_glance", "takeaways", "whats_new", "key_terms", "acronyms", "closing")


def chk_dividers(spark: SparkSession, sf: str) -> DataFrame:
    """Dividers without a division, second ones of a chapter, those out of document order; and
    content slides of another chapter than the divider before them."""
    d = nodes(spark, sf, "ord", "kind", types=("division",)).select("pub_id", F.col("id").alias("chapter"), F.col("ord").alias("d_ord"), "kind")
    s = slides(spark, sf).select("pub_id", "slide_ord", "slide_id", "pattern", "chapter").distinct().join(d, ["pub_id", "chapter"], "left")
    w = Window.partitionBy("pub_id").orderBy("slide_ord", "slide_id").rowsBetween(Window.unboundedPreceding, -1)
    good = F.when((F.col("pattern") == "divider") & F.col("d_ord").isNotNull(), F.struct("chapter", "d_ord"))
    s = s.withColumn("now", F.last(good, ignorenulls=True).over(w))
    k = F.row_number().over(Window.partitionBy("pub_id", "pattern", "chapter").orderBy("slide_ord", "slide_id"))
    div = F.col("pattern") == "divider"
    rule = (
        F.when(div & F.col("d_ord").isNull(), "no division").when(div & (k > 1), "second divider").when(div & (F.col("d_ord") < F.col("now.d_ord")), "out of order")
        .when(~div & F.col("d_ord").isNotNull() & ~F.col("pattern").isin(*STRUCTURAL) & ~F.col("chapter").eqNullSafe(F.col("now.chapter")) & ((F.col("kind") == "chapter") | F.col("now").isNull()), "under another divider")
    )
    return s.select("pub_id", "slide_id", rule.alias("rule")).where("rule is not null")


def chk_chapter_order(spark: SparkSession, sf: str) -> DataFrame:
    """Slides whose chapter comes before that of an earlier slide in document order."""
    d = nodes(spark, sf, "ord", types=("division",)).select("pub_id", F.col("id").alias("chapter"), "ord")
    s = slides(spark, sf).select("pub_id", "slide_ord", "slide_id", "chapter").distinct().join(d, ["pub_id", "chapter"])
    w = Window.partitionBy("pub_id").orderBy("slide_ord", "slide_id").rowsBetween(Window.unboundedPreceding, -1)
    return s.withColumn("seen", F.max("ord").over(w)).where("ord < seen").select("pub_id", "slide_id", "chapter")


def chk_chapters_without_slides(spark: SparkSession, sf: str) -> DataFrame:
    d = nodes(spark, sf, "kind", "title", types=("division",)).where("kind = 'chapter'")
    decks = slides(spark, sf).select("pub_id").distinct()
    s = slides(spark, sf).select("pub_id", F.col("chapter").alias("id")).where("id is not null").distinct()
    return d.join(decks, "pub_id", "left_semi").join(s, ["pub_id", "id"], "left_anti").select("pub_id", "id", "title")


def review_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Each claim beside the first 500 signs of what it cites."""
    return claim_sources(spark, sf).select("pub_id", "slide_id", "claim_id", "text", F.substring("source", 1, 500).alias("source")).distinct()


# --- QA ---------------------------------------------------------------------------------
def qa_forms_dates(spark: SparkSession, sf: str, sources: DataFrame | None = None) -> DataFrame:
    """Numbers of forms and publications, and dates, that a claim states and its source doesn't;
    the former are taken out before dates are read."""
    c = (claim_sources(spark, sf) if sources is None else sources).where("text is not null")

    def marks(col: F.Column) -> F.Column:
        forms = F.transform(tx.found(col, FORM, 0), lambda m: F.trim(F.regexp_replace(F.upper(m), r"\s+", " ")))
        dates = F.transform(tx.found(F.regexp_replace(col, FORM, " "), DATE, 0), lambda m: F.lower(F.trim(F.regexp_replace(m, r"[\s.,]+", " "))))
        return F.array_distinct(F.concat(forms, dates))

    return exploded(c, "mark", F.array_except(marks(F.col("text")), marks(F.col("source"))))


def qa_uncited(spark: SparkSession, sf: str) -> DataFrame:
    """Slides that aren't structural and have no claim, and claims without a cite."""
    s = slides(spark, sf).where(~F.col("pattern").isin(*STRUCTURAL)).select("pub_id", "slide_id").distinct()
    a = s.join(claims(spark, sf).select("pub_id", "slide_id"), ["pub_id", "slide_id"], "left_anti").select("pub_id", F.col("slide_id").alias("where_id"), F.lit("slide").alias("what"))
    c = claims(spark, sf).select("pub_id", "claim_id").distinct().join(cites(spark, sf), ["pub_id", "claim_id"], "left_anti").select("pub_id", F.col("claim_id").alias("where_id"), F.lit("claim").alias("what"))
    return a.unionByName(c)


def syllables(word: F.Column) -> F.Column:
    """Groups of vowels, a silent last e apart, one at least."""
    n = F.regexp_count(word, F.lit("[aeiouy]+"))
    return F.greatest(F.lit(1), n - F.when((n > 1) & word.rlike("[^l]e$"), 1).otherwise(0))


def neutralized(spark: SparkSession, sf: str, df: DataFrame, text: str, to: str) -> DataFrame:
    """``df`` (pub_id, ``text``) with ``to``: glossary terms and meanings (in any case) and then
    abbreviations (as they are) as the word "term", whole words only, the longest first. Texts, by
    their hashes, and phrases meet on the phrase's first word, and each text is read with the phrases that stand in
    it alone, so no pattern is made of a whole glossary."""
    g = nodes(spark, sf, "type", "term", "meaning", "abbreviation", types=("term", "acronym"))
    p = g.select("pub_id", F.inline(F.array(F.struct(F.trim("term").alias("p"), F.lit(False).alias("exact")), F.struct(F.trim("meaning").alias("p"), F.lit(False).alias("exact")), F.struct(F.trim("abbreviation").alias("p"), F.lit(True).alias("exact"))))).where("p <> ''").distinct()
    words = lambda c: F.array_distinct(F.split(F.lower(c), r"[^\p{L}\p{N}]+"))
    # a phrase without a letter or digit meets every text of its publication that holds it
    p = p.withColumn("w", F.lower(F.regexp_extract("p", r"([\p{L}\p{N}]+)", 1)))
    t = df.select("pub_id", F.col(text).alias("t")).where("t is not null").distinct().withColumn("h", F.xxhash64("t"))
    each = t.select("pub_id", "h", F.explode(F.array_union(words(F.col("t")), F.array(F.lit("")))).alias("w"))
    met = each.join(p, ["pub_id", "w"]).join(t, ["pub_id", "h"]).where(F.when(F.col("exact"), F.contains("t", F.col("p"))).otherwise(F.contains(F.lower("t"), F.lower("p"))))
    quoted = F.concat(F.lit(r"\Q"), F.replace("p", F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    rule = lambda on: F.array_join(F.transform(F.array_sort(F.collect_set(F.when(on, F.struct((-F.length("p")).alias("k"), quoted.alias("q"))))), lambda x: x["q"]), "|")
    g = met.groupBy("pub_id", "h", "t").agg(rule(~F.col("exact")).alias("ph"), rule(F.col("exact")).alias("ab"))
    whole = lambda c, flags: F.concat(F.lit(flags + r"(?<![\w-])(?:"), c, F.lit(r")(?![\w-])"))
    once = F.when(F.col("ph") != "", F.regexp_replace("t", whole(F.col("ph"), "(?i)"), F.lit("term"))).otherwise(F.col("t"))
    g = g.withColumn("once", once)
    g = g.select(F.col("pub_id").alias("np"), F.col("t").alias("nt"), F.when(F.col("ab") != "", F.regexp_replace("once", whole(F.col("ab"), ""), F.lit("term"))).otherwise(F.col("once")).alias("n"))
    return df.join(g, [F.col("pub_id") == F.col("np"), F.col(text) == F.col("nt")], "left").withColumn(to, F.coalesce("n", F.col(text))).drop("np", "nt", "n")


def qa_neutralize(spark: SparkSession, sf: str) -> DataFrame:
    """Statements with the glossary's terms, meanings and abbreviations as "term"."""
    c = claims(spark, sf).where("text is not null").select("pub_id", "claim_id", F.col("text").alias("said")).distinct()
    return neutralized(spark, sf, c, "said", "text").drop("said")


def _grade(text: F.Column) -> F.Column:
    """Flesch-Kincaid grade in whole ten-thousandths, so that a mean doesn't hang on the order."""
    ws = tx.found(F.lower(text), "([a-z']+)")
    n, s = F.size(ws), F.greatest(F.lit(1), F.size(tx.sentences(text)))
    y = F.aggregate(F.transform(ws, syllables), F.lit(0), lambda a, x: a + x)
    return F.round((0.39 * n / s + 11.8 * y / n - 15.59) * 10000).cast("long")


def qa_readability(spark: SparkSession, sf: str) -> DataFrame:
    """Grade of each slide: the mean over its parts of eight words and more, glossary words made
    neutral; ``raw_grade`` with them as they are."""
    p = claims(spark, sf).where(~F.col("in_notes") & ~F.col("pattern").isin("title", "acronyms", "closing")).select("pub_id", "slide_id", "claim_id", F.posexplode("parts").alias("part_no", "part")).where("part is not null").distinct()
    p = p.where(F.regexp_count("part", F.lit("[A-Za-z']+")) >= 8)
    p = neutralized(spark, sf, p, "part", "neutral").withColumn("g", _grade(F.col("neutral"))).withColumn("r", _grade(F.col("part")))
    mean = lambda c: F.floor(F.sum(c) / F.count("*")) / 10000
    g = p.groupBy("pub_id", "slide_id").agg(mean("g").alias("grade"), mean("r").alias("raw_grade"), F.count("*").alias("statements"), F.count_if(F.col("g") > 120000).alias("hard"))
    return g.withColumn("too_hard", F.col("grade") > 9.0)


def qa_deck_readability(spark: SparkSession, sf: str, graded: DataFrame | None = None) -> DataFrame:
    """Share of slides at grade 9 or below; a deck passes at 90 %."""
    g = (qa_readability(spark, sf) if graded is None else graded).groupBy("pub_id").agg(F.count("*").alias("slides"), F.count_if(~F.col("too_hard")).alias("readable"))
    return g.withColumn("passes", F.col("readable") >= 0.9 * F.col("slides"))


def qa_acronym_first_use(spark: SparkSession, sf: str, coverage: DataFrame | None = None) -> DataFrame:
    """Acronyms whose meaning doesn't stand on a slide up to their first use. Meanings meet the
    slides on their first word and are looked for in what meets, so that no acronym is held
    against all slides of its deck."""
    first = (chk_acronym_coverage(spark, sf) if coverage is None else coverage).select("pub_id", "token", "first_slide")
    at = slides(spark, sf).groupBy("pub_id", "slide_id").agg(F.min("slide_ord").alias("at"))
    f = first.join(at.withColumnRenamed("slide_id", "first_slide"), ["pub_id", "first_slide"])
    a = nodes(spark, sf, "abbreviation", "meaning", types=("acronym",)).select("pub_id", F.col("abbreviation").alias("token"), F.lower(F.trim("meaning")).alias("meaning")).where("meaning <> ''").distinct()
    f = written(f.join(a, ["pub_id", "token"]))
    word = lambda c: F.regexp_extract(c, r"([\p{L}\p{N}]+)", 1)
    said = slide_words(spark, sf).select("pub_id", F.col("slide_ord").alias("here"), F.lower("said").alias("said"))
    said = said.select("*", F.explode(F.array_distinct(F.split("said", r"[^\p{L}\p{N}]+"))).alias("w"))
    told = f.withColumn("w", word(F.col("meaning"))).join(said, ["pub_id", "w"]).where((F.col("here") <= F.col("at")) & F.contains("said", F.col("meaning")))
    return f.join(told.select("pub_id", "token", "meaning").distinct(), ["pub_id", "token", "meaning"], "left_anti").select("pub_id", "token", "first_slide").distinct()


def qa_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Mandatory statements per division and how many of them rest in a cited subtree, with
    a row for each publication as a whole (rollup)."""
    d = ix.directives(spark, sf).where("strength = 'mandatory' and not possibly_historical").select("pub_id", F.col("node_id").alias("id"))
    n = nodes(spark, sf, "division_id", "path", types=TEXTS)
    under = n.select("pub_id", "id", F.explode(F.concat("path", F.array("id"))).alias("anc")).join(cited(spark, sf).withColumnRenamed("id", "anc"), ["pub_id", "anc"], "left_semi").select("pub_id", "id").distinct()
    j = d.join(n.select("pub_id", "id", "division_id"), ["pub_id", "id"]).join(under.withColumn("c", F.lit(1)), ["pub_id", "id"], "left")
    g = j.rollup("pub_id", "division_id").agg(F.count("*").alias("total"), F.count("c").alias("cited")).where("pub_id is not null")
    return g.withColumn("share", F.round(F.col("cited") / F.col("total"), 3)).withColumn("low", (F.col("total") >= 5) & (F.col("cited") < 0.1 * F.col("total")))


CHECKS = ("citation", "verbatim", "directive", "readability", "acronym", "coverage")


def findings(spark: SparkSession, sf: str) -> DataFrame:
    """All findings in one table: (pub_id, ord, check, level, where_id, message); ``ord`` is the
    place of the rule that found it. What several checks rest on is written once, and each check's
    rows are written by themselves, so that the driver holds the plan of one check at a time."""
    c, lit = F.col, F.lit
    sources, graded, coverage = written(claim_sources(spark, sf)), written(qa_readability(spark, sf)), written(chk_acronym_coverage(spark, sf))
    shape = qa_deck_readability(spark, sf, graded).where(~c("passes"))
    parts = [
        (chk_title_directive(spark, sf), "directive", "error", "slide_id", F.concat(lit("title says "), c("word"))),
        (chk_unknown_nodes(spark, sf), "citation", "error", "where_id", F.concat(c("what"), lit(" "), c("node_id"), lit(" unknown"))),
        (chk_container_cite(spark, sf), "citation", "warning", "claim_id", F.concat(lit("cites a whole "), c("type"), lit(" "), c("node_id"))),
        (chk_directive_in_source(spark, sf, sources), "directive", "error", "claim_id", F.concat(lit("directive "), c("directive"), lit(" is not in the source"))),
        (chk_added_directive(spark, sf, sources), "directive", None, "claim_id", F.concat(c("word"), lit(" is not in the source"))),
        (chk_numbers(spark, sf, sources), "verbatim", "warning", "claim_id", F.concat(lit("number "), c("number"), lit(" is not in the source"))),
        (coverage.where(~c("listed")), "acronym", "warning", "first_slide", F.concat(c("token"), lit(" is not on the acronyms slide"))),
        (chk_callout(spark, sf), "citation", "error", "claim_id", F.concat(lit("not under "), c("label"))),
        (qa_forms_dates(spark, sf, sources), "verbatim", "error", "claim_id", F.concat(c("mark"), lit(" is not in the source"))),
        (qa_uncited(spark, sf), "citation", "error", "where_id", F.concat(c("what"), lit(" without a cite"))),
        (graded.where("too_hard"), "readability", "warning", "slide_id", F.concat(lit("grade "), c("grade").cast("string"))),
        (shape, "readability", "warning", "pub_id", F.concat(c("readable").cast("string"), lit(" of "), c("slides").cast("string"), lit(" slides are readable"))),
        (qa_acronym_first_use(spark, sf, coverage), "acronym", "warning", "first_slide", F.concat(c("token"), lit(" is used before it is spelled out"))),
        (qa_coverage(spark, sf).where("low and division_id is not null"), "coverage", "warning", "division_id", F.concat(c("cited").cast("string"), lit(" of "), c("total").cast("string"), lit(" mandatory statements cited"))),
    ]
    out: DataFrame | None = None
    for i, (df, check, level, at, message) in enumerate(parts):
        got = written(df.select("pub_id", lit(i).alias("ord"), lit(check).alias("check"), (lit(level) if level else c("level")).alias("level"), c(at).alias("where_id"), message.alias("message")))
        out = got if out is None else out.unionByName(got)
    assert out is not None
    return out


def qa_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """The first finding of each (check, where, message)."""
    return findings(spark, sf).groupBy("pub_id", "check", "where_id", "message").agg(F.min_by("level", "ord").alias("level"))


def qa_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Errors and warnings of each check, zero where there are none."""
    checks = spark.createDataFrame([(c,) for c in CHECKS], "check string")
    g = qa_dedupe(spark, sf).groupBy("check").agg(F.count_if(F.col("level") == "error").alias("errors"), F.count_if(F.col("level") == "warning").alias("warnings"))
    return F.broadcast(checks).join(g, "check", "left").fillna(0, ["errors", "warnings"])


# --- review -------------------------------------------------------------------------------
def rev_check(spark: SparkSession, sf: str) -> DataFrame:
    """Findings of the review by verdict and status, those on unknown claims, and how many
    open ones block."""
    f = table(spark, sf, "review_findings").distinct().withColumn("claim", tx.bare(F.col("claim")))
    known = claims(spark, sf).select("pub_id", F.col("claim_id").alias("claim")).distinct().withColumn("k", F.lit(1))
    j = f.join(known, ["pub_id", "claim"], "left")
    return j.groupBy("verdict", "status").agg(F.count("*").alias("findings"), F.count_if(F.col("claim").isNotNull() & F.col("k").isNull()).alias("unknown"), F.count_if((F.col("status") == "open") & F.col("verdict").isin("major", "critical")).alias("blocking"))


def rev_unreviewed(spark: SparkSession, sf: str) -> DataFrame:
    """Claims without a finding and findings without a claim (full outer anti join)."""
    c = claims(spark, sf).select("pub_id", "claim_id").distinct()
    f = table(spark, sf, "review_findings").where("claim is not null").select("pub_id", tx.bare(F.col("claim")).alias("claim_id")).distinct()
    j = c.withColumn("a", F.lit(1)).join(f.withColumn("b", F.lit(1)), ["pub_id", "claim_id"], "full_outer").where("a is null or b is null")
    return j.select("pub_id", "claim_id", F.when(F.col("a").isNull(), "unknown").otherwise("unreviewed").alias("state"))


def rev_unexplained(spark: SparkSession, sf: str) -> DataFrame:
    """Claims with a verdict below pass that no open or accepted finding explains."""
    f = table(spark, sf, "review_findings").where("claim is not null").select("pub_id", tx.bare(F.col("claim")).alias("claim_id"), "verdict", "status")
    g = f.groupBy("pub_id", "claim_id").agg(F.max(F.col("verdict") != "pass").alias("below"), F.max(F.col("status").isin("open", "accepted")).alias("told"))
    return g.where("below and not coalesce(told, false)").select("pub_id", "claim_id")


def rev_packet(spark: SparkSession, sf: str) -> DataFrame:
    """For each claim the requirements in the subtrees that it cites: the first eight, and
    how many there are."""
    d = ix.directives(spark, sf).where("strength <> 'permissive'").select("pub_id", F.col("node_id").alias("id"), "sentence_no", "sentence")
    n = nodes(spark, sf, "ord", "path", types=TEXTS).select("pub_id", "id", "ord", F.explode(F.concat("path", F.array("id"))).alias("node_id"))
    c = cites(spark, sf).join(n, ["pub_id", "node_id"]).select("pub_id", "claim_id", "id", "ord").distinct().join(d, ["pub_id", "id"])
    w = Window.partitionBy("pub_id", "claim_id").orderBy("ord", "sentence_no")
    return c.withColumn("rank", F.row_number().over(w)).where("rank <= 8").select("pub_id", "claim_id", "rank", "id", "sentence")


def rep_title_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of successive slides with one title (numbers in brackets apart)."""
    t = F.trim(F.regexp_replace("title", r"\s*\(\d+ of \d+\)$", ""))
    s = slides(spark, sf).select("pub_id", "slide_ord", "slide_id", t.alias("title")).distinct()
    w = Window.partitionBy("pub_id").orderBy("slide_ord", "slide_id")
    s = s.withColumn("new", F.when(F.lag("title").over(w).eqNullSafe(F.col("title")), 0).otherwise(1)).withColumn("run", F.sum("new").over(w))
    return s.groupBy("pub_id", "run", "title").agg(F.min("slide_ord").alias("first"), F.max("slide_ord").alias("last"), F.count("*").alias("slides"))


def spec_tree_check(spark: SparkSession, sf: str) -> DataFrame:
    """Per publication: nodes, nodes whose parent is missing, and nodes that no root reaches
    (their links run in a circle or end in nothing)."""
    from foliant.plans.structure import walk_recursive

    n = nodes(spark, sf, "parent_id")
    # a parent with two places counts twice, one with two parents of its own once, as in SQL
    p = nodes(spark, sf, "ord").select("pub_id", F.col("id").alias("parent_id")).withColumn("p", F.lit(1))
    r = walk_recursive(spark, sf).select("pub_id", "id").withColumn("r", F.lit(1))
    j = n.join(p, ["pub_id", "parent_id"], "left").join(r, ["pub_id", "id"], "left")
    return j.groupBy("pub_id").agg(F.count("*").alias("nodes"), F.count_if(F.col("parent_id").isNotNull() & F.col("p").isNull()).alias("lost"), F.count_if(F.col("r").isNull()).alias("unreached"))


def claim_words(spark: SparkSession, sf: str) -> DataFrame:
    """Directive words and numbers of each claim's text."""
    c = claims(spark, sf).where("text is not null").select("pub_id", "claim_id", "text").distinct()
    return c.select("pub_id", "claim_id", tx.joined(F.array_sort(directive_words(F.col("text")))).alias("words"), tx.joined(F.array_sort(numbers(F.col("text")))).alias("numbers"))


QUERIES = {f.__name__: f for f in (spec_schema, cited_ids, chk_unknown_nodes, chk_container_cite, chk_title_directive, chk_directive_in_source, chk_added_directive, chk_numbers, chk_callout, chk_acronym_coverage, chk_acronym_entry, chk_key_term, chk_deck_shape, chk_deck_rules, chk_dividers, chk_chapter_order, chk_chapters_without_slides, review_lines, qa_forms_dates, qa_uncited, qa_neutralize, qa_readability, qa_deck_readability, qa_acronym_first_use, qa_coverage, qa_dedupe, qa_summary, rev_check, rev_unreviewed, rev_unexplained, rev_packet, rep_title_runs, spec_tree_check, claim_words)}

_UNKNOWN = f"""
  select distinct c.pub_id, c.claim_id as where_id, 'cite' as what, c.node_id from {_CITES} c where not exists (select 1 from nodes n where n.pub_id = c.pub_id and n.id = c.node_id)
  union select s.pub_id, s.slide_id, 'source_table', s.source_table from {_SLIDES} s where s.source_table is not null and not exists (select 1 from nodes n where n.type = 'table' and n.pub_id = s.pub_id and n.id = s.source_table)
  union select s.pub_id, s.slide_id, 'chapter', s.chapter from {_SLIDES} s where s.chapter is not null and not exists (select 1 from nodes n where n.type = 'division' and n.pub_id = s.pub_id and n.id = s.chapter)"""
_ADDED = f"""select distinct pub_id, claim_id, word, case when word in {_IN(STRICT)} then 'error' else 'warning' end as level from (
    select pub_id, claim_id, source, directive, unnest({_dw_sql("text")}) as word from {_SOURCES} where text is not null) where word is distinct from directive and not list_contains({_dw_sql("source")}, word)"""
_NUMBERS = f"select distinct pub_id, claim_id, number from (select pub_id, claim_id, source, unnest({_num_sql('text')}) as number from {_SOURCES} where text is not null) where not list_contains({_num_sql('source')}, number)"
_CALLOUT = f"""
  with l as (select distinct pub_id, upper(callout) as label from {_SLIDES} where callout is not null),
  n as (select *, coalesce(last_value(ev ignore nulls) over (partition by pub_id order by ord rows between unbounded preceding and 1 preceding), '') as under from (
      select pub_id, id, ord, case when exists (select 1 from l where l.pub_id = x.pub_id and l.label = upper(trim(plain))) then upper(trim(plain)) when type <> 'text' or coalesce(trim(plain) = '', true) then '' end as ev from {nodes_sql("ord, type, plain")} x)),
  f as (select pub_id, anc as id, arg_min(t, ord) as begins from (select pub_id, ord, unnest(list_append(path, id)) as anc, upper(substr(own, 1, 200)) as t from (select *, trim({_OWN_SQL}) as own from {nodes_sql(_OWN_COLS)}) where own <> '') group by all)
  select c.pub_id, c.slide_id, c.claim_id, c.label from (select distinct c.pub_id, c.slide_id, c.claim_id, upper(s.callout) as label from {_CLAIMS} c join {_SLIDES} s on s.pub_id = c.pub_id and s.slide_id = c.slide_id where not c.in_notes and s.callout is not null) c
  where not exists (select 1 from {_CITES} x join n on n.pub_id = x.pub_id and n.id = x.node_id left join f on f.pub_id = n.pub_id and f.id = n.id
    where x.pub_id = c.pub_id and x.claim_id = c.claim_id and (coalesce(starts_with(f.begins, c.label), false) or n.under = c.label))"""
_UNCITED = f"""
  select distinct s.pub_id, s.slide_id as where_id, 'slide' as what from {_SLIDES} s where s.pattern not in {_IN(STRUCTURAL)} and not exists (select 1 from claims c where c.pub_id = s.pub_id and c.slide_id = s.slide_id)
  union all select distinct c.pub_id, c.claim_id, 'claim' from claims c where not exists (select 1 from {_CITES} x where x.pub_id = c.pub_id and x.claim_id = c.claim_id)"""
_TOKENS = r"regexp_split_to_array(regexp_replace(said, '([A-Za-z0-9_-]+)\s+\d', ' ', 'g'), '[^A-Za-z0-9_-]+')"
_WORDS = f"""(select distinct t.pub_id, t.slide_id, t.said, s.slide_ord from (
    select pub_id, slide_id, string_agg(distinct title, ' ' order by title) as said from {_SLIDES} where pattern <> 'acronyms' group by all
    union all select pub_id, slide_id, text from {_CLAIMS} where pattern <> 'acronyms' and text is not null) t
  join (select pub_id, slide_id, min(slide_ord) as slide_ord from {_SLIDES} where pattern <> 'acronyms' group by all) s on s.pub_id = t.pub_id and s.slide_id = t.slide_id where t.said is not null)"""
_ENTRIES = f"""(select distinct pub_id, claim_id, trim(case when len(parts) >= 2 then parts[1] else regexp_extract(text, {rx.sql(ACRONYM_ENTRY)}, 1) end) as abbreviation,
    trim(case when len(parts) >= 2 then parts[2] else regexp_extract(text, {rx.sql(ACRONYM_ENTRY)}, 2) end) as meaning from {_CLAIMS} where pattern = 'acronyms')"""
_ACRONYM_USE = f"""select u.pub_id, u.token, arg_min(u.slide_id, (u.slide_ord, u.slide_id)) as first_slide, count(distinct u.slide_id) as slides,
    bool_or(exists (select 1 from {_ENTRIES} e where e.pub_id = u.pub_id and e.abbreviation = u.token)) as listed
  from (select distinct pub_id, slide_id, slide_ord, unnest({_TOKENS}) as token from {_WORDS}) u
  where exists (select 1 from nodes a where a.type = 'acronym' and length(a.abbreviation) >= 2 and a.pub_id = u.pub_id and a.abbreviation = u.token) group by u.pub_id, u.token"""
_FIRST_USE = f"""select distinct f.pub_id, f.token, f.first_slide from ({_ACRONYM_USE}) f join (select pub_id, slide_id, min(slide_ord) as at_ord from {_SLIDES} group by all) s on s.pub_id = f.pub_id and s.slide_id = f.first_slide
    join (select distinct pub_id, abbreviation, lower(trim(meaning)) as meaning from nodes where type = 'acronym' and trim(meaning) <> '') a on a.pub_id = f.pub_id and a.abbreviation = f.token
    where not exists (select 1 from {_WORDS} w where w.pub_id = f.pub_id and w.slide_ord <= s.at_ord and contains(lower(w.said), a.meaning))"""
_TITLE = f"select distinct pub_id, slide_id, word from (select pub_id, slide_id, unnest({_dw_sql('title')}) as word from {_SLIDES}) where word in {_IN(STRICT)}"
_CONTAINER = f"select distinct c.pub_id, c.node_id, c.claim_id, n.type from {_CITES} c join {nodes_sql('type', CONTAINERS)} n on n.pub_id = c.pub_id and n.id = c.node_id where exists (select 1 from claims d where d.pub_id = c.pub_id and d.claim_id = c.claim_id and d.pattern <> 'divider')"
_IN_SOURCE = f"select distinct pub_id, claim_id, directive from {_SOURCES} where directive is not null and not list_contains({_dw_sql('source')}, lower(directive))"
def _marks_sql(c: str) -> str:
    forms = f"list_transform(regexp_extract_all({c}, {rx.sql(FORM)}), lambda m: trim(regexp_replace(upper(m), '\\s+', ' ', 'g')))"
    dates = f"list_transform(regexp_extract_all(regexp_replace({c}, {rx.sql(FORM)}, ' ', 'g'), {rx.sql(DATE_SQL)}), lambda m: lower(trim(regexp_replace(m, '[\\s.,]+', ' ', 'g'))))"
    return f"list_distinct(list_concat({forms}, {dates}))"


_QUOTE = "regexp_replace(p, '([\\\\.\\[\\]{}()*+?^$|])', '\\\\\\1', 'g')"
_GLOSSARY = f"""(select pub_id, string_agg(q, '|' order by -length(p), q) filter (not exact) as ph, string_agg(q, '|' order by -length(p), q) filter (exact) as ab from (
    select distinct pub_id, p, exact, {_QUOTE} as q from (select pub_id, unnest([struct_pack(p := trim(term), exact := false), struct_pack(p := trim(meaning), exact := false), struct_pack(p := trim(abbreviation), exact := true)], recursive := true)
      from {nodes_sql('term, meaning, abbreviation', ('term', 'acronym'))}) where p <> '') group by pub_id)"""


def _neutral_sql(t: str) -> str:
    # neighbours share the sign between them, which the match takes: two passes
    for col, flags in (("ph", "(?i)"), ("ab", "")):
        for _ in range(2):
            t = f"case when {col} is null then {t} else regexp_replace({t}, '{flags}(^|[^\\w-])(?:' || {col} || ')([^\\w-]|$)', '\\1term\\2', 'g') end"
    return t


def _grade_sql(t: str) -> str:
    ws = f"regexp_extract_all(lower({t}), '[a-z'']+')"
    syl = f"list_sum(list_transform({ws}, lambda w: greatest(1, len(regexp_extract_all(w, '[aeiouy]+')) - case when len(regexp_extract_all(w, '[aeiouy]+')) > 1 and regexp_matches(w, '[^l]e$') then 1 else 0 end)))"
    return f"cast(round((0.39 * len({ws}) / greatest(1, len({tx.sentences_sql(t)})) + 11.8 * cast({syl} as double) / len({ws}) - 15.59) * 10000) as bigint)"


_READ = f"""select pub_id, slide_id, floor(sum(g) / count(*)) / 10000 as grade, floor(sum(r) / count(*)) / 10000 as raw_grade, count(*) as statements, count(*) filter (g > 120000) as hard, floor(sum(g) / count(*)) / 10000 > 9.0 as too_hard from (
    select pub_id, slide_id, {_grade_sql('neutral')} as g, {_grade_sql('part')} as r from (
      select p.*, {_neutral_sql('part')} as neutral from (select distinct pub_id, slide_id, claim_id, part_no, part from (
          select pub_id, slide_id, claim_id, generate_subscripts(parts, 1) as part_no, unnest(parts) as part from {_CLAIMS} where not in_notes and pattern not in ('title', 'acronyms', 'closing')) where part is not null and len(regexp_extract_all(part, '[A-Za-z'']+')) >= 8) p
      left join {_GLOSSARY} g on g.pub_id = p.pub_id)) group by pub_id, slide_id"""
_COVER = f"""select d.pub_id, n.division_id, exists (select 1 from {_CITES} c where c.pub_id = d.pub_id and (c.node_id = d.node_id or list_contains(n.path, c.node_id))) as c
    from ({ix.DIRECTIVES_SQL}) d join {nodes_sql("division_id, path", TEXTS)} n on n.pub_id = d.pub_id and n.id = d.node_id where d.strength = 'mandatory' and not d.possibly_historical"""
_FORMS = f"select distinct pub_id, claim_id, mark from (select pub_id, claim_id, source, unnest({_marks_sql('text')}) as mark from {_SOURCES} where text is not null) where not list_contains({_marks_sql('source')}, mark)"
_DECK_READ = f"select pub_id, count(*) as slides, count(*) filter (not too_hard) as readable, count(*) filter (not too_hard) >= 0.9 * count(*) as passes from ({_READ}) group by pub_id"
_COVERAGE = f"""select pub_id, division_id, count(*) as total, count(*) filter (c) as cited, round(count(*) filter (c) / count(*), 3) as share, count(*) >= 5 and count(*) filter (c) < 0.1 * count(*) as low
      from ({_COVER}) group by rollup (pub_id, division_id) having pub_id is not null"""
_FINDINGS = " union all ".join(
    f"""select pub_id, {i} as ord, '{check}' as "check", {level} as level, {at} as where_id, {message} as message from ({sql}) where {cond}"""
    for i, (sql, check, level, at, message, cond) in enumerate([
        (_TITLE, "directive", "'error'", "slide_id", "'title says ' || word", "true"),
        (_UNKNOWN, "citation", "'error'", "where_id", "what || ' ' || node_id || ' unknown'", "true"),
        (_CONTAINER, "citation", "'warning'", "claim_id", "'cites a whole ' || type || ' ' || node_id", "true"),
        (_IN_SOURCE, "directive", "'error'", "claim_id", "'directive ' || directive || ' is not in the source'", "true"),
        (_ADDED, "directive", "level", "claim_id", "word || ' is not in the source'", "true"),
        (_NUMBERS, "verbatim", "'warning'", "claim_id", "'number ' || number || ' is not in the source'", "true"),
        (_ACRONYM_USE, "acronym", "'warning'", "first_slide", "token || ' is not on the acronyms slide'", "not listed"),
        (_CALLOUT, "citation", "'error'", "claim_id", "'not under ' || label", "true"),
        (_FORMS, "verbatim", "'error'", "claim_id", "mark || ' is not in the source'", "true"),
        (_UNCITED, "citation", "'error'", "where_id", "what || ' without a cite'", "true"),
        (_READ, "readability", "'warning'", "slide_id", "'grade ' || cast(grade as varchar)", "too_hard"),
        (_DECK_READ, "readability", "'warning'", "pub_id", "readable || ' of ' || slides || ' slides are readable'", "not passes"),
        (_FIRST_USE, "acronym", "'warning'", "first_slide", "token || ' is used before it is spelled out'", "true"),
        (_COVERAGE, "coverage", "'warning'", "division_id", "cited || ' of ' || total || ' mandatory statements cited'", "low and division_id is not null"),
    ])
)
_DEDUPE = f"""select pub_id, "check", where_id, message, arg_min(level, ord) as level from ({_FINDINGS}) group by all"""
_FIXED = ("title", "at_a_glance", "takeaways", "whats_new", "key_terms", "acronyms", "closing")
SQL = {
    "spec_schema": f"""with s as (select s.*, b.least, b.most, coalesce(n.n, 0) as n, coalesce(n.notes, 0) as notes from {_SLIDES} s left join {_BUDGETS} on b.pattern = s.pattern
        left join (select pub_id, slide_id, count(distinct claim_id) filter (not in_notes) as n, count(distinct claim_id) filter (in_notes) as notes from claims group by all) n on n.pub_id = s.pub_id and n.slide_id = s.slide_id)
      select pub_id, slide_id as where_id, 'slide id' as rule from s where not regexp_matches(slide_id, {rx.sql(SLIDE_ID)}) union select pub_id, slide_id, 'title' from s where title is null or length(title) not between 1 and {TITLE_MOST}
      union select pub_id, slide_id, 'pattern' from s where least is null union select pub_id, slide_id, 'chapter' from s where not regexp_matches(chapter, {rx.sql(NODE_ID)})
      union select pub_id, slide_id, 'callout' from s where callout is not null and (pattern in {_IN(STRUCTURAL)} or lower(callout) not in ('caution', 'warning'))
      union select pub_id, slide_id, 'statements' from s where n not between least and most union select pub_id, slide_id, 'talking points' from s where notes > {NOTES_MOST}
      union select pub_id, claim_id, 'length' from (select c.pub_id, c.claim_id, b.longest, unnest(c.parts) as part from {_CLAIMS} c join {_BUDGETS} on b.pattern = c.pattern where not c.in_notes) where length(part) not between 1 and longest
      union select pub_id, claim_id, 'text' from {_CLAIMS} where coalesce(length(text), 0) = 0 union select pub_id, claim_id, 'directive' from {_CLAIMS} where directive not in {_IN(DIRECTIVES)}
      union select pub_id, claim_id, 'directive not in the text' from {_CLAIMS} where directive is not null and not coalesce(contains(lower(text), lower(directive)), false)
      union select pub_id, claim_id, 'cite' from {_CITES} where not regexp_matches(node_id, {rx.sql(NODE_ID)})""",
    "cited_ids": f"select pub_id, node_id as id from {_CITES} union select pub_id, source_table from {_SLIDES} where source_table is not null",
    "chk_unknown_nodes": _UNKNOWN,
    "chk_container_cite": _CONTAINER,
    "chk_title_directive": _TITLE,
    "chk_directive_in_source": _IN_SOURCE,
    "chk_added_directive": _ADDED,
    "chk_numbers": _NUMBERS,
    "chk_callout": _CALLOUT,
    "chk_acronym_coverage": _ACRONYM_USE,
    "chk_acronym_entry": f"""select e.pub_id, e.claim_id, e.abbreviation, e.meaning, case when a.known is null then 'error' else 'warning' end as level from {_ENTRIES} e
      left join (select pub_id, abbreviation, list(distinct lower(trim(meaning))) as known from nodes where type = 'acronym' group by all) a on a.pub_id = e.pub_id and a.abbreviation = e.abbreviation
      where e.abbreviation <> '' and (a.known is null or not list_contains(a.known, lower(e.meaning))) and exists (select 1 from {_SOURCES} s where s.pub_id = e.pub_id and s.claim_id = e.claim_id)""",
    "chk_key_term": f"""select distinct pub_id, claim_id, term from (select pub_id, claim_id, source, lower(trim(case when len(parts) >= 2 then parts[1] else regexp_extract(text, '^([^–—:]+?)\\s*[–—:]', 1) end)) as term from {_SOURCES} where pattern = 'key_terms') k
      where term <> '' and not contains(lower(source), term) and not exists (select 1 from nodes t where t.type = 'term' and t.pub_id = k.pub_id and lower(t.term) = k.term)""",
    "chk_deck_shape": f"""select pub_id, slides, content, visual, case when content > 0 then round(visual / content, 4) else 0 end as visual_share, second,
      concat_ws(',', {", ".join(f"case when n_{p} > 1 then '{p}' end" for p in _FIXED)}) as repeated from (
      select pub_id, count(distinct slide_id) as slides, count(*) filter (pattern not in {_IN(STRUCTURAL)}) as content, count(*) filter (pattern not in {_IN(STRUCTURAL)} and pattern in {_IN(VISUAL)}) as visual,
        max(pattern) filter (slide_ord = 2) as second, {", ".join(f"count(*) filter (pattern = '{p}') as n_{p}" for p in _FIXED)} from (select distinct pub_id, slide_ord, slide_id, pattern from {_SLIDES}) group by pub_id)""",
    "chk_deck_rules": f"""with g as (select pub_id, list(pattern order by slide_ord, slide_id) as ps from (select distinct pub_id, slide_ord, slide_id, pattern from {_SLIDES}) group by pub_id),
      h as (select *, len(ps) as n, list_filter(ps, lambda p: p not in {_IN(STRUCTURAL)}) as content from g)
      select pub_id, rule from (select pub_id, unnest([case when n not between 25 and 40 then 'size' end, case when len(list_filter(content, lambda p: p in {_IN(VISUAL)})) < 0.6 * greatest(1, len(content)) then 'visual share' end,
        case when n > 1 and ps[2] <> 'at_a_glance' then 'at_a_glance second' end, case when not list_contains(ps[3:4], 'takeaways') then 'takeaways third or fourth' end, case when n > 2 and ps[n - 1] <> 'acronyms' then 'acronyms before closing' end,
        case when list_position(ps, 'key_terms') <> n - 2 then 'key_terms before acronyms' end, case when list_position(ps, 'divider') > 5 then 'front slides before the chapters' end,
        {", ".join(f"case when len(list_filter(ps, lambda p: p = '{p}')) > 1 then 'one {p}' end" for p in FIXED_SLIDES)}]) as rule from h) where rule is not null""",
    "chk_dividers": f"""with s as (select s.*, d.ord as d_ord, d.kind from (select distinct pub_id, slide_ord, slide_id, pattern, chapter from {_SLIDES}) s left join {nodes_sql('ord, kind', ('division',))} d on d.pub_id = s.pub_id and d.id = s.chapter),
      w as (select *, last_value(case when pattern = 'divider' and d_ord is not null then chapter end ignore nulls) over v as now_chapter, last_value(case when pattern = 'divider' then d_ord end ignore nulls) over v as now_ord,
          row_number() over (partition by pub_id, pattern, chapter order by slide_ord, slide_id) as k from s window v as (partition by pub_id order by slide_ord, slide_id rows between unbounded preceding and 1 preceding))
      select pub_id, slide_id, rule from (select *, case when pattern = 'divider' and d_ord is null then 'no division' when pattern = 'divider' and k > 1 then 'second divider' when pattern = 'divider' and d_ord < now_ord then 'out of order'
        when pattern <> 'divider' and d_ord is not null and pattern not in {_IN(STRUCTURAL)} and chapter is distinct from now_chapter and (kind = 'chapter' or now_chapter is null) then 'under another divider' end as rule from w) where rule is not null""",
    "chk_chapter_order": f"""select pub_id, slide_id, chapter from (select s.*, d.ord, max(d.ord) over (partition by s.pub_id order by s.slide_ord, s.slide_id rows between unbounded preceding and 1 preceding) as seen
      from (select distinct pub_id, slide_ord, slide_id, chapter from {_SLIDES}) s join {nodes_sql('ord', ('division',))} d on d.pub_id = s.pub_id and d.id = s.chapter) where ord < seen""",
    "chk_chapters_without_slides": f"select d.pub_id, d.id, d.title from {nodes_sql('kind, title', ('division',), 'kind = $$chapter$$')} d where exists (select 1 from slides s where s.pub_id = d.pub_id) and not exists (select 1 from slides s where s.pub_id = d.pub_id and s.chapter = d.id)",
    "review_lines": f"select distinct pub_id, slide_id, claim_id, text, substr(source, 1, 500) as source from {_SOURCES}",
    "qa_forms_dates": _FORMS,
    "qa_uncited": _UNCITED,
    "qa_neutralize": f"select c.pub_id, c.claim_id, {_neutral_sql('c.text')} as text from (select distinct pub_id, claim_id, text from {_CLAIMS} where text is not null) c left join {_GLOSSARY} g on g.pub_id = c.pub_id",
    "qa_readability": _READ,
    "qa_deck_readability": _DECK_READ,
    "qa_acronym_first_use": _FIRST_USE,
    "qa_coverage": _COVERAGE,
    "qa_dedupe": _DEDUPE,
    "qa_summary": f"""select c."check", coalesce(g.errors, 0) as errors, coalesce(g.warnings, 0) as warnings from (select unnest({list(CHECKS)}) as "check") c
      left join (select "check", count(*) filter (level = 'error') as errors, count(*) filter (level = 'warning') as warnings from ({_DEDUPE}) group by all) g on g."check" = c."check" """,
    "rev_check": f"""select verdict, status, count(*) as findings, count(*) filter (claim is not null and not known) as unknown, count(*) filter (status = 'open' and verdict in ('major', 'critical')) as blocking from (
      select *, exists (select 1 from claims c where c.pub_id = f.pub_id and c.claim_id = {tx.bare_sql("f.claim")}) as known from (select distinct * from review_findings) f) group by verdict, status""",
    "rev_unreviewed": f"""select coalesce(c.pub_id, f.pub_id) as pub_id, coalesce(c.claim_id, f.claim_id) as claim_id, case when c.claim_id is null then 'unknown' else 'unreviewed' end as state
      from (select distinct pub_id, claim_id from claims) c full join (select distinct pub_id, {tx.bare_sql("claim")} as claim_id from review_findings where claim is not null) f on f.pub_id = c.pub_id and f.claim_id = c.claim_id where c.claim_id is null or f.claim_id is null""",
    "rev_unexplained": f"select pub_id, claim_id from (select pub_id, {tx.bare_sql('claim')} as claim_id, bool_or(verdict <> 'pass') as below, coalesce(bool_or(status in ('open', 'accepted')), false) as told from review_findings where claim is not null group by all) where below and not told",
    "rev_packet": f"""select pub_id, claim_id, rank, id, sentence from (select *, row_number() over (partition by pub_id, claim_id order by ord, sentence_no) as rank from (
      select distinct c.pub_id, c.claim_id, n.id, n.ord, d.sentence_no, d.sentence from {_CITES} c join (select pub_id, id, ord, unnest(list_append(path, id)) as anc from {nodes_sql("ord, path", TEXTS)}) n on n.pub_id = c.pub_id and n.anc = c.node_id
      join ({ix.DIRECTIVES_SQL}) d on d.pub_id = n.pub_id and d.node_id = n.id and d.strength <> 'permissive')) where rank <= 8""",
    "rep_title_runs": f"""select pub_id, cast(run as bigint) as run, title, min(slide_ord) as first, max(slide_ord) as last, count(*) as slides from (select *, sum(new) over (partition by pub_id order by slide_ord, slide_id) as run from (
      select *, case when lag(title) over (partition by pub_id order by slide_ord, slide_id) is not distinct from title and row_number() over (partition by pub_id order by slide_ord, slide_id) > 1 then 0 else 1 end as new from (
        select distinct pub_id, slide_ord, slide_id, trim(regexp_replace(title, '\\s*\\(\\d+ of \\d+\\)$', '')) as title from {_SLIDES}))) group by pub_id, run, title""",
    "spec_tree_check": f"""select n.pub_id, count(*) as nodes, count(*) filter (n.parent_id is not null and p.id is null) as lost, count(*) filter (r.id is null) as unreached from {nodes_sql('parent_id')} n
      left join {nodes_sql('ord')} p on p.pub_id = n.pub_id and p.id = n.parent_id left join ({STRUCTURE_SQL["walk_recursive"]}) r on r.pub_id = n.pub_id and r.id = n.id group by n.pub_id""",
    "claim_words": f"select distinct pub_id, claim_id, array_to_string(list_sort({_dw_sql('text')}), '|') as words, array_to_string(list_sort({_num_sql('text')}), '|') as numbers from {_CLAIMS} where text is not null",
}
