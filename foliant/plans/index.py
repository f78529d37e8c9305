"""The indexes over the nodes: directives, deadlines, references, glossary, roles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import rx, text as tx
from foliant.operators import tables
from foliant.session import table, written

TEXTS = ("paragraph", "list_item", "text")


def nodes(spark: SparkSession, sf: str, *cols: str, types: tuple[str, ...] = (), derived: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """Distinct node rows (a key's repeats are equal but for when they were loaded), with
    the columns asked for only. ``derived`` columns are computed, and rows without ``where``
    dropped, before repeats are: what is derived from a text travels, not the text."""
    n = table(spark, sf, "nodes")
    if types:
        n = n.where(F.col("type").isin(*types))
    n = n.select("pub_id", "id", *cols, *[c.alias(k) for k, c in (derived or {}).items()])
    if where is not None:
        n = n.where(where)
    return n.distinct()


def nodes_sql(cols: str, types: tuple[str, ...] = (), where: str = "true") -> str:
    cond = "type in (" + ", ".join(f"'{t}'" for t in types) + ")" if types else "true"
    return f"(select distinct pub_id, id, {cols} from nodes where {cond} and {where})"


CONTAINERS = ("division", "section", "heading")


def sections(spark: SparkSession, sf: str) -> DataFrame:
    """(pub_id, node_id, section): the title of each text node's nearest ancestor that has one."""
    up = nodes(spark, sf, "path", types=TEXTS).select("pub_id", F.col("id").alias("node_id"), F.posexplode("path").alias("pos", "up"))
    titled = nodes(spark, sf, "title", types=CONTAINERS).where("title <> ''").select("pub_id", F.col("id").alias("up"), "title")
    return up.join(titled, ["pub_id", "up"]).groupBy("pub_id", "node_id").agg(F.max_by("title", "pos").alias("section"))


def placed(spark: SparkSession, sf: str, df: DataFrame) -> DataFrame:
    """Index rows with the section that they stand in."""
    return df.join(sections(spark, sf), ["pub_id", "node_id"], "left")


SECTION_SQL = f"""(select u.pub_id, u.id as node_id, arg_max(t.title, u.pos) as section from (select pub_id, id, unnest(path) as up, generate_subscripts(path, 1) as pos from {nodes_sql('path', TEXTS)}) u
  join {nodes_sql('title', CONTAINERS, "title <> ''")} t on t.pub_id = u.pub_id and t.id = u.up group by all)"""
_PLACED = lambda sql, cols: f"select {cols}, s.section from ({sql}) x left join {SECTION_SQL} s on s.pub_id = x.pub_id and s.node_id = x.node_id"


# --- sentences and directives --------------------------------------------------
def idx_sentences(spark: SparkSession, sf: str) -> DataFrame:
    n = nodes(spark, sf, "ord", "plain", types=TEXTS).where(F.col("plain").isNotNull())
    return n.select("pub_id", F.col("id").alias("node_id"), F.posexplode(tx.sentences(F.col("plain"))).alias("sentence_no", "sentence"))


_SENT = f"""
  select pub_id, id as node_id, cite, page, unnest(s) as sentence, generate_subscripts(s, 1) - 1 as sentence_no
  from (select pub_id, id, cite, page, {tx.sentences_sql("plain")} as s from {nodes_sql("cite, page, plain", TEXTS, "plain is not null")})"""


def sentence_rows(spark: SparkSession, sf: str) -> DataFrame:
    n = nodes(spark, sf, "cite", "page", "plain", types=TEXTS).where(F.col("plain").isNotNull())
    return n.select("pub_id", F.col("id").alias("node_id"), "cite", "page", F.posexplode(tx.sentences(F.col("plain"))).alias("sentence_no", "sentence"))


def directives(spark: SparkSession, sf: str) -> DataFrame:
    """One row per sentence with a directive: its verbs, the first one's strength."""
    verbs = lambda x: F.transform(tx.found(x, rx.DIRECTIVE), lambda v: F.lower(v))
    each = F.transform(tx.sentences(F.col("plain")), lambda x, i: F.struct(i.alias("sentence_no"), x.alias("sentence"), verbs(x).alias("verbs")))
    hits = F.filter(each, lambda h: F.size(h["verbs"]) > 0)
    n = nodes(spark, sf, "cite", "page", types=TEXTS, derived={"hits": hits}, where=F.size("hits") > 0)
    d = n.select("pub_id", F.col("id").alias("node_id"), "cite", "page", F.inline("hits"))
    return d.withColumn("verb", F.get("verbs", F.lit(0))).withColumn("strength", tx.strength(F.col("verb"))).withColumn("possibly_historical", F.col("sentence").rlike(rx.HISTORICAL))


def idx_directives(spark: SparkSession, sf: str) -> DataFrame:
    d = placed(spark, sf, directives(spark, sf))
    return d.select("pub_id", "node_id", "cite", "page", "section", "sentence_no", "verb", tx.joined(F.col("verbs")).alias("verbs"), "strength", "sentence", "possibly_historical")


DIRECTIVES_SQL = f"""
  select pub_id, node_id, cite, page, sentence_no, sentence, vs[1] as verb, array_to_string(vs, '|') as verbs, {tx.strength_sql("vs[1]")} as strength,
    regexp_matches(sentence, {rx.sql(rx.HISTORICAL)}) as possibly_historical
  from (select *, list_transform({tx.found_sql("sentence", rx.DIRECTIVE)}, lambda x: lower(x)) as vs from ({_SENT})) where len(vs) > 0"""


def idx_directive_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Directives per division and strength, with a total per publication (rollup)."""
    div = nodes(spark, sf, "division_id", types=TEXTS).withColumnRenamed("id", "node_id")
    d = directives(spark, sf).select("pub_id", "node_id", "strength").join(div, ["pub_id", "node_id"])
    return d.rollup("pub_id", "division_id", "strength").agg(F.count("*").alias("n")).where("pub_id is not null")


# --- deadlines -----------------------------------------------------------------
def deadlines(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences with a duration, a time reference or a strong marker, and their kind; markers
    in the order in which they stand. NLT and NET count in capitals only."""
    said = lambda m: F.when(m.rlike(r"^N(LT|ET)\s"), F.lower(F.substring(m, 1, 3))).otherwise(F.lower(m))
    marks = lambda s: F.transform(F.filter(tx.found(s, rx.MARKER, 0), lambda m: m.rlike(r"^N(LT|ET)\s") | ~m.rlike(r"(?i)^n(lt|et)\s")), said)
    each = F.transform(tx.sentences(F.col("plain")), lambda s, i: F.struct(i.alias("sentence_no"), s.alias("sentence"), tx.found(s, rx.DURATION).alias("du"), tx.found(s, rx.TIME_REF).alias("re"), marks(s).alias("ma")))
    strong = lambda ma: F.exists(ma, lambda m: m.isin(*rx.STRONG))
    hits = F.filter(each, lambda h: (F.size(h["du"]) > 0) | (F.size(h["re"]) > 0) | strong(h["ma"]))
    d = nodes(spark, sf, "cite", "page", types=TEXTS, derived={"hits": hits}, where=F.size("hits") > 0).select("pub_id", F.col("id").alias("node_id"), "cite", "page", F.inline("hits"))
    has, is_strong = lambda c: F.size(c) > 0, strong(F.col("ma"))
    kind = F.when(has("re") & ~has("du") & ~is_strong, "time_reference").when(is_strong | (has("du") & has("ma")), "deadline").otherwise("duration")
    return d.select("pub_id", "node_id", "cite", "page", "sentence_no", kind.alias("kind"), tx.joined(F.col("du")).alias("durations"), tx.joined(F.col("re")).alias("time_references"), tx.joined(F.col("ma")).alias("markers"), "sentence")


def idx_deadlines(spark: SparkSession, sf: str) -> DataFrame:
    return placed(spark, sf, deadlines(spark, sf))


DEADLINES_SQL = f"""
  select pub_id, node_id, cite, page, sentence_no,
    case when len(re) > 0 and len(du) = 0 and not strong then 'time_reference' when strong or (len(du) > 0 and len(ma) > 0) then 'deadline' else 'duration' end as kind,
    array_to_string(du, '|') as durations, array_to_string(re, '|') as time_references, array_to_string(ma, '|') as markers, sentence
  from (select *, list_has_any(ma, ['no later than', 'not later than', 'nlt', 'at least every', 'net', 'not earlier than']) as strong from (
    select pub_id, node_id, cite, page, sentence_no, sentence, {tx.found_sql("sentence", rx.DURATION)} as du, {tx.found_sql("sentence", rx.TIME_REF)} as re,
      list_transform(list_filter({tx.found_sql("sentence", rx.MARKER, 0)}, lambda m: regexp_matches(m, '^N(LT|ET)\\s') or not regexp_matches(m, '(?i)^n(lt|et)\\s')),
        lambda m: case when regexp_matches(m, '^N(LT|ET)\\s') then lower(m[1:3]) else lower(m) end) as ma
    from ({_SENT}))) where len(du) > 0 or len(re) > 0 or strong"""


# --- cross references ------------------------------------------------------------
def _with_before(pattern: str) -> str:
    """The pattern with up to twelve signs before it as group 1."""
    return "(?is)(.{0,12}?)(" + pattern.removeprefix("(?i)") + ")"


def reference_matches(spark: SparkSession, sf: str, pattern: str) -> DataFrame:
    """(pub_id, node_id, cite, page, ref_no, m): matches in text nodes; texts without one never
    leave the scan."""
    body = F.col("plain")
    found = tx.found(body, _with_before(pattern), 0)
    # the plain pattern is much cheaper than the one with what stands before it
    hits = F.when(body.rlike(pattern), found)
    n = nodes(spark, sf, "cite", "page", types=TEXTS, derived={"ms": hits}, where=F.size("ms") > 0)
    return n.select("pub_id", F.col("id").alias("node_id"), "cite", "page", F.posexplode("ms").alias("ref_no", "m"))


def external_refs(spark: SparkSession, sf: str) -> DataFrame:
    m = reference_matches(spark, sf, rx.EXTERNAL)
    g = lambda k: F.regexp_extract("m", _with_before(rx.EXTERNAL), k)
    kind = F.regexp_replace(F.regexp_replace(F.upper(g(3)), r"\s+", " "), "DA PAM", "DA Pam")
    vol = F.regexp_extract(g(5), r"(\w+)$", 1)
    target = F.concat(kind, F.lit(" "), F.regexp_replace(g(4), r"\s+", ""), F.when(vol != "", F.concat(F.lit(", Volume "), vol)).otherwise(""))
    return m.select("pub_id", "node_id", "cite", "page", "ref_no", target.alias("target"), g(2).alias("raw"), g(1).rlike(rx.SEE).alias("see"))


def idx_crossrefs_ext(spark: SparkSession, sf: str) -> DataFrame:
    return placed(spark, sf, external_refs(spark, sf))


def _g_sql(k: int, pattern: str) -> str:
    return f"regexp_extract(m, {rx.sql(pattern)}, {k})"


_REF_TEXTS = f"(select pub_id, id as node_id, cite, page, plain as body from {nodes_sql('cite, page, plain', TEXTS, 'plain is not null')})"
_EXT = _with_before(rx.EXTERNAL)
CROSSREFS_EXT_SQL = f"""
  select pub_id, node_id, cite, page, ref_no, replace(regexp_replace(upper({_g_sql(3, _EXT)}), '\\s+', ' ', 'g'), 'DA PAM', 'DA Pam') || ' ' || regexp_replace({_g_sql(4, _EXT)}, '\\s+', '', 'g')
    || case when {_g_sql(5, _EXT)} <> '' then ', Volume ' || regexp_extract({_g_sql(5, _EXT)}, '(\\w+)$', 1) else '' end as target,
    {_g_sql(2, _EXT)} as raw, regexp_matches({_g_sql(1, _EXT)}, {rx.sql(rx.SEE)}) as see
  from (select pub_id, node_id, cite, page, unnest(ms) as m, generate_subscripts(ms, 1) - 1 as ref_no
    from (select pub_id, node_id, cite, page, {tx.found_sql("body", _EXT, 0)} as ms from {_REF_TEXTS}))"""


def internal_refs(spark: SparkSession, sf: str) -> DataFrame:
    """References inside the publication; no number of another publication begins with one.
    Tables, figures and paragraphs are looked up; elsewhere ``target_exists`` is null."""
    m = reference_matches(spark, sf, rx.INTERNAL)
    g = lambda k: F.regexp_extract("m", _with_before(rx.INTERNAL), k)
    kind = F.lower(g(3))
    kind = F.when(kind == "para", "paragraph").otherwise(kind)
    m = m.select("pub_id", "node_id", "cite", "page", "ref_no", kind.alias("kind"), F.regexp_replace(g(4), "^([A-Za-z])[^A-Za-z0-9]$", "$1").alias("number"), g(1).rlike(rx.SEE).alias("see"))
    m = m.where((F.col("kind") != "paragraph") | F.col("number").rlike(r"\d"))
    held = nodes(spark, sf, "type", "number", types=("table", "figure", "paragraph")).where(F.col("number").isNotNull()).select("pub_id", F.col("type").alias("kind"), "number").distinct().withColumn("is_there", F.lit(True))
    j = m.join(held, ["pub_id", "kind", "number"], "left")
    exists = F.when(F.col("kind").isin("table", "figure", "paragraph"), F.coalesce("is_there", F.lit(False)))
    return j.select("pub_id", "node_id", "cite", "page", "ref_no", "kind", F.concat_ws(" ", "kind", "number").alias("target"), "see", exists.alias("target_exists"))


def idx_crossrefs_int(spark: SparkSession, sf: str) -> DataFrame:
    return placed(spark, sf, internal_refs(spark, sf))


_INT = _with_before(rx.INTERNAL)
CROSSREFS_INT_SQL = f"""
  with m as (
    select pub_id, node_id, cite, page, ref_no, case when lower({_g_sql(3, _INT)}) = 'para' then 'paragraph' else lower({_g_sql(3, _INT)}) end as kind,
      regexp_replace({_g_sql(4, _INT)}, '^([A-Za-z])[^A-Za-z0-9]$', '\\1') as number, regexp_matches({_g_sql(1, _INT)}, {rx.sql(rx.SEE)}) as see
    from (select pub_id, node_id, cite, page, unnest(ms) as m, generate_subscripts(ms, 1) - 1 as ref_no
      from (select pub_id, node_id, cite, page, {tx.found_sql("body", _INT, 0)} as ms from {_REF_TEXTS}))),
  held as (select distinct pub_id, type as kind, number from nodes where type in ('table', 'figure', 'paragraph') and number is not null)
  select m.pub_id, m.node_id, m.cite, m.page, m.ref_no, m.kind, m.kind || ' ' || m.number as target, m.see,
    case when m.kind in ('table', 'figure', 'paragraph') then held.number is not null end as target_exists
  from m left join held on held.pub_id = m.pub_id and held.kind = m.kind and held.number = m.number
  where m.kind <> 'paragraph' or regexp_matches(m.number, '\\d')"""


# --- glossary ----------------------------------------------------------------------
def idx_glossary_terms(spark: SparkSession, sf: str) -> DataFrame:
    return nodes(spark, sf, "term", "definition", "source", "proponent", "cite", "page", types=("term",)).withColumnRenamed("id", "node_id")


def idx_acronyms(spark: SparkSession, sf: str) -> DataFrame:
    return nodes(spark, sf, "abbreviation", "meaning", "cite", types=("acronym",)).withColumnRenamed("id", "node_id")


def idx_inline_defs(spark: SparkSession, sf: str) -> DataFrame:
    n = nodes(spark, sf, types=TEXTS, derived={"ms": tx.found(F.col("text"), rx.INLINE_DEFINITION, 0)}, where=F.size("ms") > 0)
    m = n.select("pub_id", F.col("id").alias("node_id"), F.posexplode("ms").alias("def_no", "m"))
    strip = lambda c: F.trim(F.regexp_replace(c, "[*_]", ""))
    term = strip(F.regexp_extract("m", rx.INLINE_DEFINITION, 1))
    d = m.select("pub_id", "node_id", "def_no", term.alias("term"), F.concat(term, F.regexp_replace(F.regexp_extract("m", rx.INLINE_DEFINITION, 2), "[*_]", "")).alias("definition"))
    formal = nodes(spark, sf, "term", types=("term",)).select("pub_id", F.lower("term").alias("key")).distinct()
    d = d.withColumn("key", F.lower("term")).join(formal.withColumn("f", F.lit(True)), ["pub_id", "key"], "left")
    return d.select("pub_id", "node_id", "def_no", "term", F.trim("definition").alias("definition"), F.coalesce("f", F.lit(False)).alias("also_in_glossary"))


INLINE_SQL = f"""
  select pub_id, node_id, def_no, term, trim(term || regexp_replace({_g_sql(2, rx.INLINE_DEFINITION)}, '[*_]', '', 'g')) as definition,
    exists (select 1 from nodes t where t.type = 'term' and t.pub_id = x.pub_id and lower(t.term) = lower(x.term)) as also_in_glossary
  from (select *, trim(regexp_replace({_g_sql(1, rx.INLINE_DEFINITION)}, '[*_]', '', 'g')) as term from (
    select pub_id, node_id, unnest(ms) as m, generate_subscripts(ms, 1) - 1 as def_no
    from (select pub_id, id as node_id, {tx.found_sql("text", rx.INLINE_DEFINITION, 0)} as ms from {nodes_sql("text", TEXTS, "text is not null")}))) x"""


# --- roles ---------------------------------------------------------------------------
def idx_role_vocab(spark: SparkSession, sf: str) -> DataFrame:
    """Word counts of body text, terms and meanings per publication."""
    n = nodes(spark, sf, "type", "plain", "term", "meaning", types=(*TEXTS, "term", "acronym"))
    blob = F.when(F.col("type") == "term", F.col("term")).when(F.col("type") == "acronym", F.col("meaning")).otherwise(F.col("plain"))
    return n.select("pub_id", F.explode(tx.found(F.lower(blob), "([a-z]+)")).alias("word")).groupBy("pub_id", "word").agg(F.count("*").alias("n"))


ROLE_VOCAB_SQL = f"""
  select pub_id, word, count(*) as n from (select pub_id, unnest(regexp_extract_all(lower(case type when 'term' then term when 'acronym' then meaning else plain end), '[a-z]+')) as word
    from {nodes_sql("type, plain, term, meaning", (*TEXTS, "term", "acronym"))}) group by all"""


# Last words of organizations.
ORGANIZATIONS = "post center cell element elements team agencies party detachment company command group force headquarters organizations control".split()


def role_kind(name: Column) -> Column:
    return F.when(F.regexp_extract(F.lower(name), r"^(\w+)", 1).isin("commander", "chief"), "position").when(F.regexp_extract(F.lower(name), r"(\w+)$", 1).isin(*ORGANIZATIONS), "organization").otherwise("position")


def acronym_roles(spark: SparkSession, sf: str) -> DataFrame:
    """Acronyms whose meaning holds a role word; of one squashed meaning the last counts."""
    a = nodes(spark, sf, "ord", "abbreviation", "meaning", "cite", types=("acronym",))
    a = a.where(F.col("meaning").rlike(rx.ROLE_WORD) & ~F.col("abbreviation").isin(*rx.NO_ROLE)).withColumn("key", tx.squash(F.col("meaning")))
    last = F.max_by(F.struct("meaning", "abbreviation", "cite"), F.struct("ord", "abbreviation")).alias("m")
    return a.groupBy("pub_id", "key").agg(last).select("pub_id", "key", F.col("m.meaning").alias("name"), "m.abbreviation", F.col("m.cite").alias("defined_at"))


def heading_roles(spark: SparkSession, sf: str) -> DataFrame:
    """Headings below a heading that holds roles, by their squashed title, of which the last
    counts; those that begin with 'Other' name none. ``spaced`` is the title as words of the
    publication, null where it can't be split."""
    h = nodes(spark, sf, "ord", "path", "title", "level", "cite", types=("heading",))
    box = h.where(F.col("title").rlike(rx.ROLE_BOX)).select("pub_id", F.col("id").alias("anc"))
    d = h.where((F.col("level") >= rx.ROLE_LEVEL) & ~F.startswith(F.upper("title"), F.lit("OTHER "))).withColumn("key", tx.squash(F.col("title"))).where("key <> ''")
    under = d.select("pub_id", "id", F.explode("path").alias("anc")).join(box, ["pub_id", "anc"], "left_semi").select("pub_id", "id").distinct()
    d = d.join(under, ["pub_id", "id"], "left_semi").groupBy("pub_id", "key").agg(F.max_by(F.struct("title", "cite"), "ord").alias("m")).select("pub_id", "key", "m.title", "m.cite")
    words = tables.segmented(d.select("pub_id", "key"), idx_role_vocab(spark, sf), ["pub_id"]).withColumnRenamed("words", "spaced")
    return d.join(words, ["pub_id", "key"])


def roles(spark: SparkSession, sf: str) -> DataFrame:
    """Roles from acronyms and headings: where both name one the acronym gives name and
    abbreviation and the heading the place. A heading alone counts if it splits into words of
    the publication, eight at most."""
    a = acronym_roles(spark, sf).select("pub_id", "key", "name", "abbreviation", F.col("defined_at").alias("a_cite"))
    j = a.join(heading_roles(spark, sf), ["pub_id", "key"], "full_outer")
    j = j.where(F.col("name").isNotNull() | (F.size(F.split("spaced", " ")) <= rx.ROLE_WORDS))
    source = F.when(F.col("title").isNull(), "acronym").when(F.col("name").isNull(), "heading").otherwise("heading+acronym")
    name = F.when(F.col("title").isNull(), F.col("name")).otherwise(F.lower(F.coalesce("name", "spaced")))
    kind = F.when(F.col("title").isNull(), "position").otherwise(role_kind(name))
    return j.select("pub_id", "key", name.alias("name"), "abbreviation", kind.alias("kind"), source.alias("source"), F.coalesce("cite", "a_cite").alias("defined_at"))


def idx_role_seeds(spark: SparkSession, sf: str) -> DataFrame:
    return roles(spark, sf).drop("key")


ACRONYM_ROLES_SQL = f"""
  select pub_id, key, meaning as name, abbreviation, cite as defined_at from (
    select *, row_number() over (partition by pub_id, key order by ord desc, abbreviation desc) as rn from (
      select *, regexp_replace(lower(meaning), '[^a-z0-9]', '', 'g') as key from {nodes_sql("ord, abbreviation, meaning, cite", ("acronym",))}
      where regexp_matches(meaning, {rx.sql(rx.ROLE_WORD)}) and abbreviation not in ('BCT', 'AO', 'OA'))) where rn = 1"""
# headings that an acronym doesn't spell out need a split into words, which SQL has no short way for
ROLES_SQL = f"""
  select a.pub_id, a.key, case when h.key is null then a.name else lower(a.name) end as name, a.abbreviation, coalesce(h.cite, a.defined_at) as defined_at,
    case when h.key is null then 'acronym' else 'heading+acronym' end as source,
    case when h.key is null then 'position' when regexp_extract(lower(a.name), '^(\\w+)', 1) in ('commander', 'chief') then 'position'
      when regexp_extract(lower(a.name), '(\\w+)$', 1) in ({", ".join(f"'{w}'" for w in ORGANIZATIONS)}) then 'organization' else 'position' end as kind
  from ({ACRONYM_ROLES_SQL}) a left join (select pub_id, key, arg_max(cite, ord) as cite from (select pub_id, ord, cite, regexp_replace(lower(title), '[^a-z0-9]', '', 'g') as key from {nodes_sql("ord, path, title, level, cite", ("heading",))} h
      where level >= 4 and not starts_with(upper(title), 'OTHER ') and exists (select 1 from nodes b where b.type = 'heading' and b.pub_id = h.pub_id and list_contains(h.path, b.id) and regexp_matches(b.title, {rx.sql(rx.ROLE_BOX)}))) group by all) h
    on h.pub_id = a.pub_id and h.key = a.key"""


#: Most words that are broadcast to pass over others.
BROADCAST_WORDS = 100_000


def role_mentions(spark: SparkSession, sf: str) -> DataFrame:
    """Text nodes with each role that they name: the name in any case, from the begin of a word
    on, or the abbreviation as a token. Nodes and roles meet on a name's first word or the
    abbreviation (an equi-join, of which no key holds more than the uses of one word in one
    publication) by their ids alone, and the rest of the name is looked for in what meets. Words
    that no role of any publication begins with are passed over before, unless those with which
    one does are too many for a broadcast."""
    r = roles(spark, sf).select("pub_id", "key", "name", "abbreviation")
    # both in one pass, so that the plan of the roles stands in the query once
    by_name = F.struct(F.lower(F.regexp_extract("name", r"([\p{L}\p{N}]+)", 1)).alias("w"), F.lit(True).alias("named"))
    seeds = r.select("*", F.inline(F.array(by_name, F.struct(F.col("abbreviation").alias("w"), F.lit(False).alias("named"))))).where("w is not null")
    seeds = written(seeds)
    n = nodes(spark, sf, "ord", "cite", "plain", types=TEXTS).where(F.col("plain").isNotNull()).withColumnRenamed("id", "node_id")
    low, own = F.split(F.lower("plain"), r"[^\p{L}\p{N}]+"), F.split("plain", "[^A-Za-z0-9-]+")
    each = n.select("pub_id", "node_id", F.explode(F.array_distinct(F.concat(low, own))).alias("w"))
    begins = seeds.select("w").distinct()
    if begins.count() <= BROADCAST_WORDS:
        each = each.join(F.broadcast(begins), "w", "left_semi")
    met = each.join(seeds, ["pub_id", "w"]).distinct()
    hit = met.join(n, ["pub_id", "node_id"])
    hit = hit.where(F.when(F.col("named"), F.contains(F.lower("plain"), F.lower("name")) & F.array_contains(F.array_union(low, own), F.col("w"))).otherwise(F.array_contains(own, F.col("abbreviation"))))
    return hit.groupBy("pub_id", "node_id", "ord", "cite", "plain", "key", "name", "abbreviation").agg(F.max("named").alias("by_name"), F.max(~F.col("named")).alias("by_abbreviation"))


def idx_roles(spark: SparkSession, sf: str) -> DataFrame:
    """Mentions of each role and its first 50 distinct cites in document order."""
    m = role_mentions(spark, sf).select("pub_id", "key", "cite", "ord")
    per = m.groupBy("pub_id", "key", "cite").agg(F.count("*").alias("n"), F.min("ord").alias("first"))
    per = per.withColumn("k", F.row_number().over(Window.partitionBy("pub_id", "key").orderBy("first", "cite")))
    agg = per.groupBy("pub_id", "key").agg(F.sum("n").alias("mention_count"), F.array_sort(F.collect_list(F.when(F.col("k") <= 50, F.struct("k", "cite")))).alias("c"))
    j = roles(spark, sf).join(agg, ["pub_id", "key"], "left")
    return j.select("pub_id", "name", "abbreviation", "kind", "source", "defined_at", F.coalesce("mention_count", F.lit(0)).alias("mention_count"), F.coalesce(F.array_join(F.transform("c", lambda x: x["cite"]), "|"), F.lit("")).alias("cites"))


_MENTION = f"""
  select r.pub_id, r.key, r.name, r.abbreviation, n.id as node_id, n.ord, n.cite, n.plain, contains(lower(n.plain), lower(r.name)) as by_name,
    coalesce(list_contains(regexp_split_to_array(n.plain, '[^A-Za-z0-9-]+'), r.abbreviation), false) as by_abbreviation
  from ({ROLES_SQL}) r join {nodes_sql("ord, cite, plain", TEXTS, "plain is not null")} n on n.pub_id = r.pub_id
    and (contains(lower(n.plain), lower(r.name)) or list_contains(regexp_split_to_array(n.plain, '[^A-Za-z0-9-]+'), r.abbreviation))"""
IDX_ROLES_SQL = f"""
  with m as ({_MENTION}), per as (select pub_id, key, cite, count(*) as n, min(ord) as first from m group by all),
  k as (select *, row_number() over (partition by pub_id, key order by first, cite) as k from per),
  a as (select pub_id, key, sum(n) as mention_count, coalesce(string_agg(cite, '|' order by k) filter (k <= 50), '') as cites from k group by all)
  select r.pub_id, r.name, r.abbreviation, r.kind, r.source, r.defined_at, cast(coalesce(a.mention_count, 0) as bigint) as mention_count, coalesce(a.cites, '') as cites from ({ROLES_SQL}) r left join a on a.pub_id = r.pub_id and a.key = r.key"""


def role_duties(spark: SparkSession, sf: str, mentions: DataFrame | None = None) -> DataFrame:
    """Sentences in which a directive begins at most 60 signs after the role is named;
    a role's first 100 in document order. ``mentions``: those of ``role_mentions``, where they
    are at hand."""
    m = (role_mentions(spark, sf) if mentions is None else mentions).select("pub_id", "node_id", "ord", "cite", "key", "name", "abbreviation", F.posexplode(tx.sentences(F.col("plain"))).alias("sentence_no", "sentence"))
    by_name = F.instr(F.lower("sentence"), F.lower("name"))
    by_abbr = F.coalesce(F.instr(F.concat(F.lit(" "), F.regexp_replace("sentence", "[^A-Za-z0-9-]", " "), F.lit(" ")), F.concat(F.lit(" "), "abbreviation", F.lit(" "))), F.lit(0))
    last = F.when(by_name > 0, by_name + F.length("name") - 1).when(by_abbr > 0, by_abbr + F.length("abbreviation") - 1)
    verb = F.regexp_extract(F.expr("substring(sentence, last_)"), "(?is)^.{1,61}?" + rx.DIRECTIVE.removeprefix("(?i)"), 1)
    d = m.withColumn("last_", last).where("last_ is not null").withColumn("verb", F.lower(verb)).where("verb <> ''")
    k = F.row_number().over(Window.partitionBy("pub_id", "key").orderBy("ord", "node_id", "sentence_no"))
    return d.withColumn("k", k).where("k <= 100").select("pub_id", F.col("name").alias("role"), "node_id", "cite", "sentence_no", "verb", "sentence")


def idx_role_duties(spark: SparkSession, sf: str) -> DataFrame:
    return role_duties(spark, sf)


ROLE_DUTIES_SQL = f"""
  with s as (select *, unnest(ss) as sentence, generate_subscripts(ss, 1) - 1 as sentence_no from (select *, {tx.sentences_sql("plain")} as ss from ({_MENTION}))),
  p as (select *, instr(lower(sentence), lower(name)) as bn, coalesce(instr(' ' || regexp_replace(sentence, '[^A-Za-z0-9-]', ' ', 'g') || ' ', ' ' || abbreviation || ' '), 0) as ba from s),
  v as (select *, lower(regexp_extract(substr(sentence, case when bn > 0 then bn + length(name) - 1 else ba + length(abbreviation) - 1 end), {rx.sql("(?is)^.{1,61}?" + rx.DIRECTIVE.removeprefix("(?i)"))}, 1)) as verb from p where bn > 0 or ba > 0)
  select pub_id, name as role, node_id, cite, sentence_no, verb, sentence from (
    select *, row_number() over (partition by pub_id, key order by ord, node_id, sentence_no) as k from v where verb <> '') where k <= 100"""


def idx_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each index per publication."""
    parts = {
        "directives": directives(spark, sf), "deadlines": deadlines(spark, sf), "crossrefs": external_refs(spark, sf).select("pub_id").unionAll(internal_refs(spark, sf).select("pub_id")),
        "terms": idx_glossary_terms(spark, sf), "acronyms": idx_acronyms(spark, sf), "inline_definitions": idx_inline_defs(spark, sf), "roles": idx_role_seeds(spark, sf),
    }
    out: DataFrame | None = None
    for name, df in parts.items():
        got = df.groupBy("pub_id").agg(F.count("*").alias("n")).select("pub_id", F.lit(name).alias("index_name"), "n")
        out = got if out is None else out.unionByName(got)
    assert out is not None
    return out


_DIRECTIVE_COUNTS = f"(select d.pub_id, n.division_id, d.strength from ({DIRECTIVES_SQL}) d join {nodes_sql('division_id', TEXTS)} n on n.pub_id = d.pub_id and n.id = d.node_id)"
SQL = {
    "idx_sentences": f"select pub_id, node_id, sentence_no, sentence from ({_SENT})",
    "idx_directives": _PLACED(DIRECTIVES_SQL, "x.*"),
    "idx_directive_counts": f"select pub_id, division_id, strength, count(*) as n from {_DIRECTIVE_COUNTS} group by rollup (pub_id, division_id, strength) having pub_id is not null",
    "idx_deadlines": _PLACED(DEADLINES_SQL, "x.*"),
    "idx_crossrefs_ext": _PLACED(CROSSREFS_EXT_SQL, "x.*"),
    "idx_crossrefs_int": _PLACED(CROSSREFS_INT_SQL, "x.*"),
    "idx_glossary_terms": f"select pub_id, id as node_id, term, definition, source, proponent, cite, page from {nodes_sql('term, definition, source, proponent, cite, page', ('term',))}",
    "idx_acronyms": f"select pub_id, id as node_id, abbreviation, meaning, cite from {nodes_sql('abbreviation, meaning, cite', ('acronym',))}",
    "idx_inline_defs": INLINE_SQL,
    "idx_role_vocab": ROLE_VOCAB_SQL,
    "idx_role_seeds": f"select pub_id, name, abbreviation, kind, source, defined_at from ({ROLES_SQL})",
    "idx_roles": IDX_ROLES_SQL,
    "idx_role_duties": ROLE_DUTIES_SQL,
}
_COUNT = lambda name, sql: f"select pub_id, '{name}' as index_name, count(*) as n from ({sql}) group by pub_id"
SQL["idx_counts"] = " union all ".join(
    [_COUNT("directives", DIRECTIVES_SQL), _COUNT("deadlines", DEADLINES_SQL), _COUNT("crossrefs", f"select pub_id from ({CROSSREFS_EXT_SQL}) union all select pub_id from ({CROSSREFS_INT_SQL})"),
     _COUNT("terms", SQL["idx_glossary_terms"]), _COUNT("acronyms", SQL["idx_acronyms"]), _COUNT("inline_definitions", INLINE_SQL), _COUNT("roles", ROLES_SQL)]
)
QUERIES = {f.__name__: f for f in (idx_sentences, idx_directives, idx_directive_counts, idx_deadlines, idx_crossrefs_ext, idx_crossrefs_int, idx_glossary_terms, idx_acronyms, idx_inline_defs, idx_role_vocab, idx_role_seeds, idx_roles, idx_role_duties, idx_counts)}
