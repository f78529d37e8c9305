import json

import pytest

from foliant.llm import markup as M

CASES = [
    ("If 2 < 6 and 8 > 2 hold, key <unset> and R&D; stay.", []),
    ("Use range_log_9_final in C:\\stores\\text8, 9 * 9 * 9 feet, $52 to $99, set {A, B}, [sic], #3.", []),
    ("You c***n and b*****d, i******e.", []),
    ("a <b>bold</b> &amp; x<br/>", ["html other"]),
    ("<h2>T</h2><ul><li>a</ul><table><tr><td>1</td></tr></table><pre><code>x **y** &lt;</code></pre>", ["html code", "html heading", "html list_item", "html table"]),
    ("<!-- page 4 -->", ["html other"]),
    ("## Title ##\n\n* one\n* two\n\n| a | b |\n| --- | --- |\n| 1 | 2 |\n\n```sh\n# no <b>tag</b> $x$\n```", ["markdown code", "markdown heading", "markdown list_item", "markdown table"]),
    ("TITLE\n=====\n\ntext **_x_** and [a](b) and ~~c~~ `d`", ["markdown code", "markdown heading", "markdown other"]),
    ("== T ==\n\n# one\n# two\n\n{| class=x\n| a || b\n|-\n| 1 || 2\n|}\n\n<math>x_1</math> <code>y</code> '''b''' {{n|x}}", ["wiki code", "wiki formula", "wiki heading", "wiki list_item", "wiki other", "wiki table"]),
    ("** nested point", ["wiki list_item"]),
    ("\\section{A}\n\\begin{itemize}\n\\item x \\emph{y}\n\\end{itemize}\n\\begin{tabular}{l}\na & b \\\\\n\\end{tabular}\n\\begin{verbatim}\n$n$ # x\n\\end{verbatim}", ["latex code", "latex heading", "latex list_item", "latex other", "latex table"]),
    ("cost $v_{1}=d/t$ and \\(n+9\\) and $$ m $$", ["latex formula"]),
    ("", []),
    (None, []),
]


@pytest.mark.parametrize("text,want", CASES)
def test_elements(text, want):
    assert M.labels(text) == want


def test_clean_keeps_structure():
    got = M.clean("<html><body><h1>T &amp; U</h1><p>One <i>two</i></p><ul><li>a</li><li>b</li></ul><pre><code>if (a &lt; b)\n  x</code></pre></body></html>")
    assert "# T & U" in got and "One two" in got and "- a" in got and "```\nif (a < b)\n  x\n```" in got and "<" not in got.replace("a < b", "")
    assert M.clean("\\section{S} $x$ \\emph{e}") == "# S $x$ e"
    assert M.clean(None) == M.clean("") == ""


def test_content_regions():
    nav = "\n".join(f'<a href="/{i}">x{i}</a><a href="/b">y</a><a href="/c">z</a>' for i in range(12))
    body = "\n".join("<p>" + "A long line of running text that carries the content of the page. " * 3 + "</p>" for _ in range(8))
    keep = M.content_lines(nav + "\n" + body)
    assert not any(keep[:9]) and all(keep[-8:])
    assert "x3" not in M.clean(nav + "\n" + body) and "running text" in M.clean(nav + "\n" + body)


LONG = "<p>" + "A long line of running text that carries the content of the page. " * 3 + "</p>"
DENSE = [
    ("<h2 id=a>Short</h2>", "# Short"),
    ("<table><tr><td>Item</td><td>Count</td></tr><tr><td>nets</td><td>46</td></tr></table>", "Item\tCount\n\n\tnets\t46"),
    ("<ul>\n<li><i>a</i></li>\n<li><a href=x>b</a></li>\n</ul>", "- b"),
    ("<pre><code>count=0\nlimit=$count\n}</code></pre>", "```\ncount=0\nlimit=$count\n}\n```"),
    ("<syntaxhighlight lang=text>\ncount=0\n}\n</syntaxhighlight>", "```\ncount=0\n}\n```"),
    ("<math>x_1</math>", "$x_1$"),
    ("{| class=x\n| a || b\n|-\n| 1 || <b>2</b>\n|}", "a\tb\n1\t2"),
    ("```\n<a href=x>k</a>\n```", "<a href=x>k</a>"),
    ("<p><b>O</b> <i>n</i> <a href=x>e</a> <b>t</b><i>w</i><b>o</b></p>", "O n e two"),
    ("<p>See\n<a href=x>Annex</a>\nto all.</p>", "See\nAnnex\nto all."),
    ("<script>\nvar gone = 1;\n</script>", ""),
]


@pytest.mark.parametrize("part,want", DENSE)
def test_content_regions_keep_dense_elements(part, want):
    nav = "\n".join(f'<a href="/{i}">x{i}</a><a href="/b">y</a><a href="/c">z</a>' for i in range(6))
    menu = "<nav><ul>\n<li><a href=m>Menu</a></li>\n</ul></nav>"
    got = M.clean("\n".join([nav, menu, LONG, *[part] * 3, LONG, LONG]))
    squeeze = lambda x: " ".join(x.split())
    assert "x3" not in got and "Menu" not in got and "gone" not in got
    assert got.count("running text") == 9 and squeeze(got).count(squeeze(want)) >= (3 if want else 0)


def test_rows_and_columns(spark):
    df = spark.createDataFrame([([["a & b", "**x**"], [None]],), (None,), ([],), ([["<ul><li>q</ul>"], None],)], "r array<array<string>>")
    got = [r[0] for r in df.select(M.row_labels("r")).collect()]
    assert got == [["markdown other"], [], [], ["html list_item"]]
    t = spark.createDataFrame([("plain text",), ("x `y`",), (None,)], "t string")
    assert [r[0] for r in t.select(M.may_hold(t.t)).collect()] == [False, True, None]
    assert [r[0] for r in t.select(M.element_labels("t")).collect()] == [[], ["markdown code"], []]


def test_long_text_is_linear():
    t = "word *em* <b>x</b> $a$ \\emph{y} " * 20000
    assert M.labels(t) == ["html other", "latex formula", "latex other", "markdown other"]


def test_query_cleans_every_field(spark, tmp_path):
    from foliant.llm import queries as Q

    node = "pub_id string, id string, type string, text string, plain string, rows array<array<string>>"
    nav = "\n".join(f'<a href="/{i}">x{i}</a>' for i in range(4))
    nodes = [
        ("p", "1", "paragraph", "a **b** <i>c</i>", None, None),
        ("p", "1", "paragraph", "a **b** <i>c</i>", None, None),
        ("p", "2", "list_item", nav + "\n" + LONG, "x &amp; y", None),
        ("p", "3", "table", None, None, [["<b>h</b>", "**k**"], None, [None, "<ul><li>q<li>r</ul>"]]),
        ("p", "4", "table", None, None, None),
        ("p", "5", "heading", "# no", None, None),
    ]
    spark.createDataFrame(nodes, node).write.parquet(f"{tmp_path}/nodes.parquet")
    spark.createDataFrame([(7, "<b>d</b>", "s", "raw"), (8, None, "s", "clean")], "doc_id long, text string, source string, stage string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = Q.p3_clean(spark, str(tmp_path)).collect()
    got = {(r.src, r.record_key, r.field_name): r.clean for r in rows}
    assert len(rows) == len(got) == 8
    assert got["nodes", "p/1", "text"] == "a b c" and got["nodes", "p/1", "plain"] == "" and got["nodes", "p/2", "plain"] == "x & y"
    assert got["nodes", "p/2", "text"].startswith("x0\nx1\nx2\nx3\n") and got["nodes", "p/4", "rows"] == ""
    assert got["nodes", "p/3", "rows"] == "h\tk\n\n\t- q - r" and got["documents", "7", "text"] == "d" and got["documents", "8", "text"] == ""
    cells = {r.record_key: r.cells and json.loads(r.cells) for r in rows if r.field_name == "rows"}
    assert cells == {"p/3": [["h", "k"], None, ["", "- q\n- r"]], "p/4": None}
    assert {(r.source, r.stage, r.n_before) for r in rows if r.record_key == "7"} == {("s", "raw", 8)}


def test_query_filter_holds_what_the_operator_finds(spark, tmp_path):
    from foliant.llm import queries as Q

    node = "pub_id string, id string, type string, text string, plain string, rows array<array<string>>"
    nodes = [("p", "1", "table", None, None, [["a", "<b>x</b>"], None]), ("p", "2", "paragraph", "See [http://x.org label] here", "See\n[id]: http://x.org/a", None), ("p", "3", "table", None, None, [["a"], None])]
    spark.createDataFrame(nodes, node).write.parquet(f"{tmp_path}/nodes.parquet")
    spark.createDataFrame([], "doc_id long, text string, source string, stage string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.record_key, r.field_name, r.markup, r.element_kind) for r in Q.p3_found(spark, str(tmp_path)).collect()}
    assert got == {("p/1", "rows", "html", "other"), ("p/2", "text", "wiki", "other"), ("p/2", "plain", "markdown", "other")}
