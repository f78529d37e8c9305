"""Rules of the indexes, hints, checks and conversion on small tables, with expected rows
written by hand from the rules' descriptions."""

import datetime as dt

import pytest

import __spark_entry__ as entry

NODES = """pub_id string, ord bigint, id string, parent_id string, path array<string>, division_id string, type string, cite string, page int, page_label string, kind string, number string,
  title string, level int, depth int, text string, plain string, caption string, columns array<string>, rows array<array<string>>, key string, grid boolean, term string, definition string, source string,
  proponent boolean, abbreviation string, meaning string, loaded_at timestamp, dropped_at timestamp"""
SLIDES = "pub_id string, slide_ord int, slide_id string, pattern string, title string, chapter string, callout string, source_table string, recorded_at timestamp"
CLAIMS = "pub_id string, slide_id string, claim_id string, pattern string, text string, parts array<string>, directive string, in_notes boolean, numbers array<string>, words array<string>, made_at timestamp, withdrawn_at timestamp"
CITES = "pub_id string, claim_id string, node_id string, cite_ord int, recorded_at timestamp"
NOW = dt.datetime(2025, 1, 1)


class Book:
    """Nodes of one publication, given in document order with the id of their parent."""

    def __init__(self, pub="P"):
        self.pub, self.rows, self.path = pub, [], {}

    def add(self, id, type, up=None, **kw):
        self.path[id] = [*self.path[up], up] if up else []
        names = [c.split()[0] for c in NODES.replace("\n", " ").split(",")]
        row = dict.fromkeys(names) | {"pub_id": self.pub, "ord": len(self.rows), "id": id, "parent_id": up, "path": self.path[id], "division_id": (self.path[id] or [id])[0], "type": type, "cite": f"cite {id}", "page": len(self.rows) + 1, "loaded_at": NOW}
        if "plain" in kw:
            row["text"] = kw["plain"]
        self.rows.append(tuple((row | kw)[n] for n in names))
        return self


def heading(b, id, up, title, level):
    return b.add(id, "heading", up, title=title, level=level)


def tables(spark, d, book=(), slides=(), claims=(), cites=()):
    at = str(d)
    for name, schema, rows in [("nodes", NODES, book), ("slides", SLIDES, slides), ("claims", CLAIMS, claims), ("claim_cites", CITES, cites)]:
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("overwrite").parquet(f"{at}/{name}.parquet")
    return at


def rows(spark, d, name, *cols):
    return sorted((tuple(r[c] for c in cols) for r in entry.queries()[name](spark, d).collect()), key=repr)


@pytest.fixture(scope="module")
def book(spark, tmp_path_factory):
    b = Book().add("ch-1", "division", kind="chapter", number="1", title="Fires", level=1)
    heading(b, "ch-1.a", "ch-1", "FIRE SUPPORT PERSONNEL", 3)
    b.add("para-1-1", "paragraph", "ch-1.a", number="1-1", plain="The fire officer must report within 10 minutes. See FM 3-09, Volume 2 and table 1-1. It will rain.")
    heading(b, "ch-1.a.b", "ch-1.a", "FIREOFFICER", 4)
    heading(b, "ch-1.a.c", "ch-1.a", "GUNCHIEF", 4)
    heading(b, "ch-1.a.d", "ch-1.a", "OTHER CREWS", 4)
    heading(b, "ch-1.a.e", "ch-1.a", "ZZYZX", 4)
    heading(b, "ch-1.f", "ch-1", "GUNOFFICER", 4)  # not below a heading that holds roles
    b.add("para-1-2", "paragraph", "ch-1.f", number="1-2", plain="The gun chief, who stands far from all that his crew does in the long night of the hills, will wait. FO and FOX shall not move NLT H-6. A gun fires.")
    b.add("para-1-3", "paragraph", "ch-1.f", number="1-3", plain="The crew will do the following:")
    for i, t in enumerate(["Check the lines.", "Verify the fuse.", "Record the shot.", "Move on."]):
        b.add(f"para-1-3.li{i + 1}", "list_item", "para-1-3", plain=t, depth=0)
    b.add("table-1-1", "table", "ch-1.f", number="1-1", rows=[["a", "b"]], columns=["x", "y"], grid=True)
    b.add("app-a", "division", kind="appendix", number="A", title="Forms", level=1)
    b.add("para-A-1", "paragraph", "app-a", number="A-1", plain="In 1944 it may have cost 5 dollars, e.g. each. net 5 is not a mark. See chapter 2, section A and paragraph A-1, para B.")
    b.add("glossary", "division", kind="glossary", title="Glossary", level=1)
    b.add("acr-fo", "acronym", "glossary", abbreviation="FO", meaning="fire officer").add("acr-ao", "acronym", "glossary", abbreviation="AO", meaning="officer area")
    return tables(spark, tmp_path_factory.mktemp("book"), b.rows)


def test_directives(spark, book):
    assert rows(spark, book, "idx_directives", "node_id", "section", "verbs", "strength", "possibly_historical") == [
        ("para-1-1", "FIRE SUPPORT PERSONNEL", "must", "mandatory", False), ("para-1-1", "FIRE SUPPORT PERSONNEL", "will", "mandatory", False),
        ("para-1-2", "GUNOFFICER", "shall not", "mandatory", False), ("para-1-2", "GUNOFFICER", "will", "mandatory", False),
        ("para-1-3", "GUNOFFICER", "will", "mandatory", False), ("para-A-1", "Forms", "may", "permissive", True),
    ]


def test_deadlines(spark, book):
    assert rows(spark, book, "idx_deadlines", "node_id", "kind", "durations", "time_references", "markers", "cite", "section") == [
        ("para-1-1", "deadline", "10 minutes", "", "within", "cite para-1-1", "FIRE SUPPORT PERSONNEL"), ("para-1-2", "deadline", "", "H-6", "nlt", "cite para-1-2", "GUNOFFICER")
    ]


def test_references(spark, book):
    assert rows(spark, book, "idx_crossrefs_ext", "node_id", "target", "see", "section") == [("para-1-1", "FM 3-09, Volume 2", True, "FIRE SUPPORT PERSONNEL")]
    assert rows(spark, book, "idx_crossrefs_int", "node_id", "target", "see", "target_exists") == [
        ("para-1-1", "table 1-1", False, True), ("para-A-1", "chapter 2", True, None), ("para-A-1", "paragraph A-1", False, True), ("para-A-1", "section A", False, None)
    ]


def test_roles_from_acronyms_and_headings(spark, book):
    assert rows(spark, book, "idx_roles", "name", "abbreviation", "kind", "source", "defined_at", "mention_count") == [
        ("fire officer", "FO", "position", "heading+acronym", "cite ch-1.a.b", 2), ("gun chief", None, "position", "heading", "cite ch-1.a.c", 1)
    ]
    # more than sixty signs lie between the chief and the verb; FOX is another token
    assert rows(spark, book, "idx_role_duties", "role", "node_id", "verb") == [("fire officer", "para-1-1", "must"), ("fire officer", "para-1-2", "shall not")]


def test_signals_and_hints(spark, book):
    got = {r.node_id: r for r in entry.queries()["cls_node_signals"](spark, book).collect()}
    assert (got["para-1-1"].duty, got["para-1-1"].dir_mandatory, got["para-1-1"].time_deadline) == (1, 2, 1)
    hints = {(r.unit, r.pattern): r.points for r in entry.queries()["cls_hints"](spark, book).collect()}
    # one lead-in with a list of four, three of which begin with a verb
    assert hints["ch-1.f", "checklist"] == 150 + 200 + 100 and hints["ch-1.f", "process_flow"] == 250 and hints["ch-1.f", "table"] == 400
    assert hints["ch-1.f", "roles"] == 300 and ("app-a", "roles") not in hints


def test_budget_counts_appendixes(spark, book):
    got = {r.id: r.slides for r in entry.queries()["bud_dhondt"](spark, book).collect()}
    assert got["ch-1"] + got["app-a"] + 1 + 7 == 34 and got["app-a"] > 0
    from foliant.plans.planning import bud_dhondt

    with pytest.raises(ValueError):
        bud_dhondt(spark, book, 41)


@pytest.fixture(scope="module")
def deck(spark, tmp_path_factory):
    b = Book().add("ch-1", "division", kind="chapter", number="1", title="Fires", level=1)
    b.add("para-1-1", "paragraph", "ch-1", number="1-1", plain="Crews must carry five chains. File DA Form 2028 by 3 March 2020.")
    b.add("para-1-1.li1", "list_item", "para-1-1", plain="A tow chain is new.", depth=0)
    b.add("caution", "text", "ch-1", plain="CAUTION").add("after", "text", "ch-1", plain="It burns.").add("more", "text", "ch-1", plain="It burns on.")
    b.add("para-1-2", "paragraph", "ch-1", number="1-2", plain="Plain words.")
    b.add("boxed", "paragraph", "ch-1", number="1-3", plain="").add("boxed.t1", "text", "boxed", plain="Caution: hot.")
    b.add("glossary", "division", kind="glossary", title="Glossary", level=1)
    b.add("acr-fo", "acronym", "glossary", abbreviation="FO", meaning="fire officer").add("acr-cd", "acronym", "glossary", abbreviation="CD", meaning="cable drum")
    b.add("term-a", "term", "glossary", term="Ration box", definition="A box.")
    s = lambda n, pattern, title, callout=None: ("P", n, f"s{n:02}", pattern, title, None, callout, None, NOW)
    c = lambda n, i, pattern, text, directive=None, parts=None: ("P", f"s{n:02}", f"s{n:02}.{i}", pattern, text, parts or ([text] if text else []), directive, False, [], [], NOW, None)
    slides = [s(1, "checklist", "The FO fires"), s(2, "do_dont", "You must not wait", "Caution"), s(3, "acronyms", "Acronyms"), s(4, "key_terms", "Terms"), s(5, "divider", "Chapter 1"), s(6, "key_idea", "CD 40 and CD")]
    claims = [
        c(1, 1, "checklist", "Crews must carry 5 chains and 7 ropes; they will not rest.", "must"), c(1, 2, "checklist", "It shall be so in 1999.", "shall"), c(1, 3, "checklist", "A cable drum is here. DA form 2028, 3 March 2020 and FM 3-09."),
        c(2, 1, "do_dont", "It burns."), c(2, 2, "do_dont", "Words."), c(2, 3, "do_dont", "On."), c(2, 4, "do_dont", "Hot."),
        c(3, 1, "acronyms", "FO – Fire Officer", None, ["FO", "Fire Officer"]), c(3, 2, "acronyms", "CD – compact disc", None, ["CD", "compact disc"]), c(3, 3, "acronyms", "ZZ: zig zag"), c(3, 4, "acronyms", "YY: uncited"),
        c(4, 1, "key_terms", "Ration box – a box"), c(4, 2, "key_terms", "Tow chain — a chain"), c(4, 3, "key_terms", "Lost word – gone"), c(5, 1, "divider", "Chapter"), c(1, 4, "checklist", "It must stand on nothing 9.", "may"),
    ]
    at = {"s01.1": ["para-1-1", "nowhere"], "s01.2": ["para-1-1\t"], "s01.3": ["para-1-1"], "s01.4": ["nowhere"], "s02.1": ["after"], "s02.2": ["para-1-1.li1"], "s02.3": [" more"], "s02.4": ["boxed"],
          "s03.1": ["acr-fo"], "s03.2": ["acr-cd"], "s03.3": ["glossary"], "s04.1": ["para-1-2"], "s04.2": ["para-1-1"], "s04.3": ["para-1-2"], "s05.1": ["ch-1"]}
    cites = [("P", k, n, i, NOW) for k, v in at.items() for i, n in enumerate(v)]
    return tables(spark, tmp_path_factory.mktemp("deck"), b.rows, slides, claims, cites)


def test_statements_against_their_sources(spark, deck):
    # a claim none of whose cites is known is not held against nothing
    assert rows(spark, deck, "chk_unknown_nodes", "where_id", "node_id") == [("s01.1", "nowhere"), ("s01.4", "nowhere")]
    assert rows(spark, deck, "chk_directive_in_source", "claim_id", "directive") == [("s01.2", "shall")]
    assert rows(spark, deck, "chk_added_directive", "claim_id", "word", "level") == [("s01.1", "will not", "error")]
    assert rows(spark, deck, "chk_numbers", "claim_id", "number") == [("s01.1", "7"), ("s01.2", "1999")]  # a 3 is in the source
    assert rows(spark, deck, "qa_forms_dates", "claim_id", "mark") == [("s01.2", "1999"), ("s01.3", "FM 3-09")]
    assert rows(spark, deck, "chk_title_directive", "slide_id", "word") == [("s02", "must not")]
    assert rows(spark, deck, "chk_container_cite", "claim_id", "type") == [("s03.3", "division")]
    # under the label: right after it, with text between, and by text of what is below
    assert rows(spark, deck, "chk_callout", "claim_id", "label") == [("s02.2", "CAUTION")]
    assert rows(spark, deck, "qa_uncited", "where_id", "what") == [("s03.4", "claim"), ("s06", "slide")]


def test_acronyms_and_terms_of_a_deck(spark, deck):
    assert rows(spark, deck, "chk_acronym_coverage", "token", "first_slide", "listed") == [("CD", "s06", True), ("FO", "s01", True)]
    assert rows(spark, deck, "chk_acronym_entry", "claim_id", "abbreviation", "level") == [("s03.2", "CD", "warning"), ("s03.3", "ZZ", "error")]
    assert rows(spark, deck, "qa_acronym_first_use", "token", "first_slide") == [("FO", "s01")]
    assert rows(spark, deck, "chk_key_term", "claim_id", "term") == [("s04.3", "lost word")]


def test_findings_and_their_counts(spark, deck):
    got = rows(spark, deck, "qa_summary", "check", "errors", "warnings")
    assert dict((c, (e, w)) for c, e, w in got) == {"citation": (5, 1), "directive": (3, 0), "verbatim": (2, 2), "readability": (0, 0), "acronym": (0, 1), "coverage": (0, 0)}


def test_continued_tables_zones_and_page_breaks(spark, tmp_path):
    b = Book().add("cover", "division", kind="preface", title="Cover").add("c0", "text", "cover", plain="Out.")
    b.add("ch-1", "division", kind="chapter", number="1", title="Fires").add("p1", "paragraph", "ch-1", number="1-1", plain="The crew moves to the", page=5)
    b.add("t1", "table", "ch-1", number="1-1", caption="Table 1-1. Cap", columns=["A b", "C"], rows=[["1", "2"]], page=5).add("t2", "table", "ch-1", number="1-1", caption="Table 1-1. Cap (continued)", columns=["x"], rows=[["a B", "c"], ["3", "4"]], page=6)
    b.add("x1", "text", "ch-1", plain="Bridge at dawn.", page=6).add("p2", "paragraph", "ch-1", number="1-2", plain="It ends here.", page=6).add("x2", "text", "ch-1", plain="and yet it goes on.", page=7)
    heading(b, "h1", "ch-1", "Next", 2)
    b.add("t3", "table", "h1", number="1-1", caption="Table 1-1. Cap (continued)", columns=["x"], rows=[["5", "6"]])
    long = "The quick grey crews carry the long cable drums over the hill and down"
    b.add("t4", "table", "h1", number="1-2", caption="Table 1-2. Two", columns=["x"], rows=[["a", long]]).add("x3", "text", "h1", plain=long + " to the river.")
    b.add("toc", "division", kind="preface", title="Figures").add("c1", "text", "toc", plain="List.").add("other", "division", kind="preface", title="Odd").add("app-a", "division", kind="appendix", number="A", title="Forms").add("index", "division", kind="preface", title="Index").add("c2", "text", "index", plain="Word, 3")
    d = tables(spark, tmp_path, b.rows)
    assert rows(spark, d, "tbl_merge_continued", "id", "parts", "n_rows") == [("t1", 2, 2), ("t3", 1, 1), ("t4", 1, 1)]
    zones = dict(rows(spark, d, "blk_zones", "id", "zone"))
    assert zones["p1"] == "Chapter 1" and zones["app-a"] == "Appendix A" and not {"c0", "c1", "other", "index", "c2"} & set(zones)
    # the connector takes the capital over the tables; a full stop takes nothing
    assert [r for r in rows(spark, d, "blk_join_pages", "ord", "parts") if r[1] > 1] == [(3, 2)]
    assert [r for r in rows(spark, d, "tbl_overflow", "id", "cell_no", "cell") if r[1] is not None] == [("t4", 1, long + " to the river.")]


def test_headings_of_a_page(spark, tmp_path):
    from foliant.plans import convert

    line = lambda page, n, y, font, size, text: (page, n, float(y), font, float(size), text)
    got = [
        line(1, 1, 100, "Arial-Bold", 12, "Chapter 2"), line(1, 2, 120, "Helvetica-Bold", 16, "Long"), line(1, 3, 140, "Arial-Bold", 16, "Title"), line(1, 4, 200, "Arial-Bold", 12, "SECTION I – WIDE"), line(1, 5, 214, "Arial-Bold", 12, "ROADS"),
        line(1, 6, 300, "Arial-Bold", 12, "orphan"), line(1, 7, 310, "Arial-Bold", 12, "orphan too"), line(1, 8, 400, "Times-Bold", 14, "Third"), line(1, 9, 405, "Arial-Bold", 12, "stray"), line(1, 10, 412, "Times-Bold", 14, "level"),
        line(1, 11, 500, "Times-BoldItalic", 14, "no"), line(1, 12, 20, "Arial-Bold", 16, "running head"), line(1, 13, 740, "Arial-Bold", 16, "footer"), line(2, 1, 100, "Arial-Bold", 12, "Appendix B"), line(2, 2, 130, "Times-Bold", 12, "Fourth"), line(2, 3, 160, "Arial-Bold", 16, "Unlabelled"),
    ]
    df = spark.createDataFrame(got, "page long, line_no long, y double, font string, size double, text string")
    held, convert.lines = convert.lines, lambda spark, sf: df
    try:
        assert rows(spark, "", "lay_wrap_merge", "page", "tier", "label", "text") == [
            (1, "T1", "Chapter 2", "Long Title"), (1, "T2", None, "SECTION I – WIDE ROADS"), (1, "T3", None, "Third level"), (2, "T1", None, "Unlabelled"), (2, "T4", None, "Fourth")
        ]
    finally:
        convert.lines = held


def test_shape_of_a_deck(spark, tmp_path):
    b = Book().add("ch-1", "division", kind="chapter", number="1", title="A").add("ch-2", "division", kind="chapter", number="2", title="B").add("app-a", "division", kind="appendix", number="A", title="C")
    pats = ["title", "at_a_glance", "takeaways", "divider", "checklist", "divider", "checklist", "checklist", "divider", "divider", "key_terms", "closing"]
    chapter = [None, None, None, "ch-2", "ch-2", "ch-1", "ch-2", "app-a", "ch-1", "lost", None, None]
    d = tables(spark, tmp_path, b.rows, [("P", i, f"s{i:02}", p, "T", c, None, None, NOW) for i, (p, c) in enumerate(zip(pats, chapter), 1)])
    assert [r for _, r in rows(spark, d, "chk_deck_rules", "pub_id", "rule")] == ["acronyms before closing", "key_terms before acronyms", "size", "visual share"]
    assert rows(spark, d, "chk_dividers", "slide_id", "rule") == [("s06", "out of order"), ("s07", "under another divider"), ("s09", "second divider"), ("s10", "no division")]
    assert rows(spark, d, "spec_schema", "where_id", "rule") == [("s01", "pattern")][:0] + sorted([(f"s{i:02}", "statements") for i, p in enumerate(pats, 1) if p not in ("title", "divider", "closing")])


def test_neutral_words_and_grades(spark, tmp_path):
    b = Book().add("glossary", "division", kind="glossary", title="G").add("t1", "term", "glossary", term="fire support").add("t2", "term", "glossary", term="C++ kit (new)").add("t3", "term", "glossary", term="fire support team")
    b.add("a1", "acronym", "glossary", abbreviation="FO", meaning="forward observer").add("a2", "acronym", "glossary", abbreviation="it", meaning="\\Q odd \\E")
    c = lambda i, t, parts=None: ("P", "s01", f"s01.{i}", "checklist", t, parts or [t], None, False, [], [], NOW, None)
    said = ["Fire Support Team and fire support, crossfire support.", "A FO but no fo, FO-x or xFO; It and it.", "Take the c++ KIT (new) along.", "Forward observer FO FO", "\\Q odd \\E stays", "x"]
    d = tables(spark, tmp_path, b.rows, [("P", 1, "s01", "checklist", "T", None, None, None, NOW)], [c(i, t) for i, t in enumerate(said)] + [("Q", "s01", "q1", "checklist", said[0], [], None, False, [], [], NOW, None)])
    assert rows(spark, d, "qa_neutralize", "pub_id", "claim_id", "text") == [
        ("P", "s01.0", "term and term, crossfire support."), ("P", "s01.1", "A term but no fo, FO-x or xFO; It and term."), ("P", "s01.2", "Take the term along."), ("P", "s01.3", "term term term"), ("P", "s01.4", "term stays"), ("P", "s01.5", "x"), ("Q", "q1", said[0])
    ]
    easy = "The fire support team will go up the hill now."
    d = tables(spark, tmp_path, b.rows, [("P", 1, "s01", "checklist", "T", None, None, None, NOW)], [c(0, easy)])
    # 8 words of one syllable against 10 words with one of two
    assert rows(spark, d, "qa_readability", "grade", "raw_grade", "statements") == [(round(0.39 * 8 + 11.8 * 1 - 15.59, 4), round(0.39 * 10 + 11.8 * 11 / 10 - 15.59, 4), 1)]


def test_passes_of_a_conversion(spark, tmp_path):
    b = Book().add("ch-1", "division", kind="chapter", number="1", title="Fires", level=1, page=1).add("p1", "paragraph", "ch-1", number="1-1", plain="The crew moves to the", page=1)
    b.add("t1", "table", "ch-1", number="1-1", caption="Table 1-1. Cap", columns=["A", "C"], rows=[["1", "2"], ["a", "b"], ["", "more"]], grid=True, page=1).add("x2", "text", "ch-1", plain="bridge at dawn.", page=2)
    heading(b, "h1", "ch-1", "Next Step", 2)
    d = tables(spark, tmp_path, [tuple(2 if i == 8 and r[0] == "P" and r[2] == "h1" else v for i, v in enumerate(r)) for r in b.rows])
    got = dict(rows(spark, d, "conv_passes", "counter", "n"))
    assert got == {"pages_converted": 2, "headings": 2, "zoned_nodes": 5, "page_break_joins": 1, "table_rows_repaired": 2, "tables": 1, "numbered_paragraphs": 1}
