"""Markup residue: what markup a text holds, and the text without it.

Tags go through the standard library's streaming HTML parser; its events and the
line and inline rules of Markdown, wiki text and LaTeX all end as *elements*
(markup, kind). Code and formulas are lifted out first, so that nothing inside
them counts. ``clean`` turns the elements into one plain notation in which
headings, list items, tables, code and formulas can still be told apart, and for
pages keeps only the content regions: the text-to-tag ratio of each line, smoothed
with a Gaussian, is split in two clusters, and of the lower one the lines that hold
nothing but links or boilerplate are dropped.

Signs in their plain sense (``2 < 6``, ``range_log_9``, ``C:\\stores``, ``R&D;``,
``$5 to $9``) are no markup. Null and empty texts have no elements and clean to ''.
"""

from __future__ import annotations

import html
import math
import re
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("heading", "list_item", "table", "code", "formula", "other")

# Element kinds of tag names; every other known tag is 'other'.
_TAG = dict.fromkeys("h1 h2 h3 h4 h5 h6".split(), "heading")
_TAG |= dict.fromkeys("li ul ol dl dt dd menu dir".split(), "list_item")
_TAG |= dict.fromkeys("table tr td th thead tbody tfoot caption col colgroup".split(), "table")
_TAG |= dict.fromkeys("pre code tt kbd samp syntaxhighlight source nowiki".split(), "code")
_TAG |= dict.fromkeys("math chem".split(), "formula")
_OTHER_TAGS = """
a abbr acronym address area article aside audio b base basefont bdi bdo big blink blockquote body br button canvas center cite
data datalist del details dfn dialog div em embed fieldset figcaption figure font footer form frame frameset head header hgroup
hr html i iframe img input ins label legend link main map mark meta meter nav noframes noscript object optgroup option output p
param picture progress q ref references rp rt ruby s script section select slot small span strike strong style sub summary sup
svg template textarea time title track u var video wbr
""".split()
_TAG |= dict.fromkeys(_OTHER_TAGS, "other")
_WIKI_TAGS = {"syntaxhighlight", "nowiki", "math", "chem", "ref", "references"}
_BLOCK = set("p div br tr table ul ol dl pre section article header footer nav aside main body html blockquote form figure hr".split())
_HIDE = {"script", "style"}

#: What a text must hold to be looked at; also used as a Spark filter.
ANY = r"""[<&`~\\$|]|\*\S|\S\*|_\S|''|\[\[|\]\(|\{\{|\{\||(?m)^\s*(?:[-+*#:;>=|]+|\d{1,3}[.)])\s|(?m)^=+|(?m)^-{3,}\s*$|\[(?:https?|ftp)://|(?m)^\[[^\]\n]+\]:\s"""
_ANY = re.compile(ANY.replace("(?m)", ""), re.M)

_FENCE = re.compile(r"^[ ]{0,3}(?P<f>`{3,}|~{3,})[^\n`]*\n(?:.*?\n)??[ ]{0,3}(?P=f)[`~]*[ \t]*$", re.M | re.S)
_OPEN_FENCE = re.compile(r"^[ ]{0,3}(?:`{3,}|~{3,})[ \w]*\n.*", re.M | re.S)
_TEX_CODE = re.compile(r"\\begin\{(verbatim\*?|lstlisting|minted|Verbatim|alltt)\}.*?(?:\\end\{\1\}|\Z)|\\verb\*?([|!+/@#])[^\n]*?\2|\\(?:lstinline|mintinline)\{[^{}\n]*\}", re.S)
_TICK = re.compile(r"(?<![`\\])(`{1,2})(?!`)(?=\S)([^`\n]+(?:\n(?!\n)[^`\n]+)?)(?<=\S)\1(?!`)")
_TEX_MATH = re.compile(
    r"\\begin\{(equation|align|gather|multline|eqnarray|displaymath|math|flalign|alignat)(\*?)\}.*?(?:\\end\{\1\2\}|\Z)"
    r"|\$\$(?!\$).+?\$\$|\\\[.+?\\\]|\\\(.+?\\\)"
    r"|(?<![\\$\w])\$(?![\s$])(?:\\\$|[^$\n])+?(?<![\s\\])\$(?![\w$])",
    re.S,
)
_TEX_TABLE = re.compile(r"\\begin\{(tabular[*xy]?|longtable|array|table\*?)\}.*?(?:\\end\{\1\}|\Z)", re.S)
_TEX_HEAD = re.compile(r"\\(?:part|chapter|(?:sub){0,2}section|(?:sub)?paragraph)\*?\s*\{([^{}\n]*)\}")
_TEX_ITEM = re.compile(r"\\item\b(?:\[[^\]\n]*\])?[ \t]*|\\(?:begin|end)\{(?:itemize|enumerate|description)\}")
_TEX_CELL = re.compile(r"\\(?:hline|toprule|midrule|bottomrule|multicolumn)\b")
# Commands that count without an argument.
_TEX_BARE = r"\\(?:maketitle|tableofcontents|newpage|clearpage|pagebreak|noindent|par|centering|bfseries|itshape|ttfamily|small|large|Large|footnotesize|LaTeX|TeX|ldots|dots|quad|qquad|newline|linebreak|appendix|hfill|vfill|medskip|bigskip|smallskip)\b"
_TEX_OTHER = re.compile(r"~?\\[a-zA-Z]+\*?(?:\[[^\]\n]*\])?\{([^{}\n]*)\}(?:\{([^{}\n]*)\})?|" + _TEX_BARE + r"|(?<=\S)[ \t]*\\\\(?:\[[^\]\n]*\])?[ \t]*(?=\n|$)|(?<!\\)\\[%&#_](?=[\s\w])")
_TEX_MUTE = re.compile(r"~?\\(?:documentclass|usepackage|begin|end|ref|eqref|pageref|label|cite|bibliography|input|include|vspace|hspace)\b")
_TEX_PATH = re.compile(r"(?:\b[A-Za-z]:|\\\\\w+)(?:\\[\w.$-]+)+")

_W_HEAD = re.compile(r"^(={1,6})[ \t]*([^=\n].*?)[ \t]*\1[ \t]*$", re.M)
_W_TABLE = re.compile(r"^[ \t:]*\{\|.*?(?:^[ \t]*\|\}|\Z)", re.M | re.S)
_W_ROW = re.compile(r"^\|-+[^\n]*$|^!.*!!", re.M)
_W_LIST = re.compile(r"^\*{2,}[ \t]+(?=\S)", re.M)
_W_LINE = re.compile(r"^[*#:;]+[ \t]*(?=[^\s*#:;])", re.M)
_W_TEMPLATE = re.compile(r"\{\{(?!\{)([^{}]*)\}\}")
_W_LINK = re.compile(r"\[\[([^\[\]\n]+)\]\]|\[(?:https?|ftp)://[^\s\]]+(?:\s+[^\]\n]*)?\]")
_W_EMPH = re.compile(r"(?<!')('{5}|'{2,3})(?!')(?=\S)(.+?)(?<=\S)(?<!')\1(?!')")
_W_WORD = re.compile(r"__(?:TOC|NOTOC|FORCETOC|NOEDITSECTION)__")

_M_HEAD = re.compile(r"^[ ]{0,3}#{1,6}[ \t]+(\S[^\n]*?)[ \t]*#*[ \t]*$", re.M)
_M_SETEXT = re.compile(r"^(?!\s*[-+*>|#])(\S[^\n]{0,200})\n[ ]{0,3}(?:={2,}|-{2,})[ \t]*$", re.M)
_M_LIST = re.compile(r"(?:\A|(?<=\n))[ \t]*(?:[-+*]|\d{1,3}[.)])[ \t]+(?=\S)")
_M_TABLE = re.compile(r"^[ \t]*\|[^\n]*\|[ \t]*$", re.M)
_M_SEP = re.compile(r"^[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)+\|?[ \t]*$", re.M)
_M_QUOTE = re.compile(r"^[ ]{0,3}>[ \t]?(?=\S)", re.M)
_M_RULE = re.compile(r"^[ ]{0,3}(?:-[ ]*){3,}$|^[ ]{0,3}(?:\*[ ]*){3,}$|^[ ]{0,3}(?:_[ ]*){3,}$", re.M)
_M_LINK = re.compile(r"!?\[([^\[\]\n]*)\]\((?:[^()\s]|\([^()]*\))*(?:\s+\"[^\"\n]*\")?\)|^\[[^\]\n]+\]:\s+\S+", re.M)
_L, _R = r"(?<![^\W぀-鿿฀-๿ऀ-ॿ가-힣])", r"(?![^\W぀-鿿฀-๿ऀ-ॿ가-힣])"
_M_EMPH = re.compile(
    _L + r"(?<![*\\])(\*{1,3})(?![\s*])((?:[^*\n]|\n(?!\s*\n))+?)(?<![\s\\])\1(?!\*)" + _R
    + "|" + r"(?<![\w_\\])(_{1,3})(?![\s_])((?:[^_\n]|\n(?!\s*\n))+?)(?<![\s\\])\3(?![\w_])"
    + "|" + r"(?<!~)(~~)(?![\s~])((?:[^~\n]|\n(?!\s*\n))+?)(?<!\s)~~(?!~)"
)
_AMP = re.compile(r"&(?:(#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});)?")
# in the working text: \x01n\x02 is a lifted part, \x05n\x06 one that the tag parser
# lifted, \x03 and \x04 stand round a heading, \x07 is an ampersand in its plain sense
_HOLD, _MADE = re.compile("\x01(\\d+)\x02"), re.compile("\x05(\\d+)\x06")
_SIGNS = str.maketrans("\x01\x02\x03\x04\x05\x06\x07", " " * 7)
_TEX_SHELL = re.compile(r"\A\\begin\{[^{}]*\}(?:\[[^\]]*\])?|\\end\{[^{}]*\}\Z|\A(?:\$\$?|\\\[|\\\()|(?:\$\$?|\\\]|\\\))\Z")


def _lone_amp(m: re.Match) -> str:
    name = m.group(1)
    return m.group() if name and (name[0] == "#" or name + ";" in html5) else "\x07" + m.group()[1:]


class _Tags(HTMLParser):
    """Events of known tags; all else goes through as text, so that several passes agree."""

    def __init__(self, wiki: bool) -> None:
        super().__init__(convert_charrefs=False)
        self.wiki, self.found, self.out = wiki, set(), []
        self.hold: list[tuple[str, str]] = []
        self.inside: list[str] = []
        self.kept: list[str] = []

    def put(self, s: str) -> None:
        (self.kept if self.inside else self.out).append(s)

    def handle_starttag(self, tag: str, attrs) -> None:
        raw = self.get_starttag_text() or ""
        kind = _TAG.get(tag)
        if self.inside:
            if kind in ("code", "formula") or tag in _HIDE:
                self.inside.append(tag)
            elif kind is None:
                self.put(raw)
            return
        if kind is None:
            self.put(raw)
            return
        self.found.add(("wiki" if tag in _WIKI_TAGS or self.wiki and kind in ("code", "formula") else "html", kind))
        if kind in ("code", "formula") or tag in _HIDE:
            if not raw.endswith("/>"):
                self.inside.append(tag)
        else:
            self.put({"heading": "\n\x03", "list_item": "\n- " if tag in ("li", "dt", "dd") else "\n", "table": "\n" if tag in ("tr", "table") else "\t" if tag in ("td", "th") else ""}.get(kind, "\n" if tag in _BLOCK else ""))

    handle_startendtag = handle_starttag

    def handle_endtag(self, tag: str) -> None:
        kind = _TAG.get(tag)
        if self.inside:
            if tag in self.inside:
                while self.inside and self.inside.pop() != tag:
                    pass
                if not self.inside:
                    body = "".join(self.kept)
                    self.kept.clear()
                    if tag not in _HIDE:
                        self.hold.append((_TAG[tag], html.unescape(body)))
                        self.out.append(f"\x05{len(self.hold) - 1}\x06")
            return
        if kind is None:
            self.put(f"</{tag}>")
            return
        self.found.add(("wiki" if tag in _WIKI_TAGS or self.wiki and kind in ("code", "formula") else "html", kind))
        self.put("\x04\n" if kind == "heading" else "\n" if tag in _BLOCK or tag == "li" else "")

    def handle_data(self, data: str) -> None:
        self.put(data)

    def handle_comment(self, data: str) -> None:
        if not self.inside:
            self.found.add(("html", "other"))

    def handle_decl(self, decl: str) -> None:
        self.found.add(("html", "other"))

    handle_pi = unknown_decl = handle_decl

    def handle_entityref(self, name: str) -> None:
        if not self.inside:
            self.found.add(("html", "other"))
        self.put(html5[name + ";"])

    def handle_charref(self, name: str) -> None:
        if not self.inside:
            self.found.add(("html", "other"))
        self.put(html.unescape(f"&#{name};"))

    def end(self) -> None:
        self.close()
        if self.kept:
            self.out.append("".join(self.kept))


def _wiki_page(t: str) -> bool:
    """Whether line starts that Markdown and wiki text share are the wiki's."""
    wiki = len(_W_HEAD.findall(t)) * 3 + len(_W_TABLE.findall(t)) * 3 + 3 * ("<syntaxhighlight" in t) + 3 * ("<math>" in t)
    wiki += len(_W_EMPH.findall(t)) + len(_W_TEMPLATE.findall(t)) + len(_W_LINK.findall(t)) + 2 * len(_W_LIST.findall(t))
    if not wiki:
        return False
    md = 3 * ("```" in t) + 3 * len(_FENCE.findall(t)) + 3 * len(_M_SEP.findall(t)) + len(_M_LINK.findall(t)) + t.count("~~") // 2
    md += sum(1 for m in _M_EMPH.finditer(t) if not _W_LIST.match(t, m.start())) + 3 * len(re.findall(r"^#{2,6}[ \t]+[^\n]*#*$", t, re.M)) + 3 * len(_M_SETEXT.findall(t))
    return wiki > md


def scan(text: str | None, formulas: bool = True) -> tuple[set[tuple[str, str]], str]:
    """The elements of a text, and it without markup in one plain notation: ``# `` before
    headings, ``- `` before list items, tabs between cells, fences round code and
    dollar signs round formulas (which are left out without ``formulas``)."""
    if not text or not _ANY.search(text):
        return set(), text or ""
    found: set[tuple[str, str]] = set()
    hold: list[tuple[str, str]] = []
    wiki = _wiki_page(text)
    t = text.translate(_SIGNS)

    def lift(lang: str, kind: str):
        def sub(m: re.Match) -> str:
            found.add((lang, kind))
            body = m.group()
            if lang == "latex":
                body = _TEX_SHELL.sub("", body)
            elif body[:1] == "`" and m.re is _TICK:
                body = m.group(2)
            else:
                body = "\n".join(x for x in body.split("\n")[1:] if not re.fullmatch(r"\s*(?:`{3,}|~{3,})\s*", x)) + "\n"
            hold.append((kind, body))
            return f"\x01{len(hold) - 1}\x02"

        return sub

    def note(lang: str, kind: str, put):
        def sub(m: re.Match) -> str:
            found.add((lang, kind))
            return put(m) if callable(put) else put

        return sub

    if "\\" in t:

        def stow(m: re.Match) -> str:
            hold.append(("plain", m.group()))
            return f"\x01{len(hold) - 1}\x02"

        t = _TEX_PATH.sub(stow, t)
    if "```" in t or "~~~" in t:
        t = _FENCE.sub(lift("markdown", "code"), t)
        t = _OPEN_FENCE.sub(lift("markdown", "code"), t)
    if "\\" in t:
        t = _TEX_CODE.sub(lift("latex", "code"), t)
    if "<" in t or "&" in t:
        p = _Tags(wiki)
        p.feed(_AMP.sub(_lone_amp, t))
        p.end()
        found |= p.found
        base = len(hold)
        hold += p.hold
        t = _MADE.sub(lambda m: f"\x01{base + int(m.group(1))}\x02", "".join(p.out)).replace("\x07", "&")
    if "`" in t:
        t = _TICK.sub(lift("markdown", "code"), t)
    if "$" in t or "\\" in t:
        t = _TEX_MATH.sub(lift("latex", "formula"), t)
    if "\\" in t:
        t = _TEX_TABLE.sub(note("latex", "table", lambda m: _tex_rows(m.group())), t)
        t = _TEX_HEAD.sub(note("latex", "heading", lambda m: f"\x03{m.group(1)}\x04"), t)
        t = _TEX_ITEM.sub(note("latex", "list_item", lambda m: "- " if m.group().startswith("\\item") else ""), t)
        t = _TEX_CELL.sub(note("latex", "table", ""), t)
        n = 1
        while n:  # from the inside out
            t, n = _TEX_OTHER.subn(note("latex", "other", _tex_body), t)
    if "{|" in t:
        t = _W_TABLE.sub(note("wiki", "table", lambda m: _wiki_rows(m.group())), t)
    if "{{" in t:
        t = _W_TEMPLATE.sub(note("wiki", "other", lambda m: (m.group(1).split("|") + [""])[1]), t)
    if "[" in t:
        t = _W_LINK.sub(note("wiki", "other", lambda m: m.group(1).split("|")[-1] if m.group(1) else m.group().strip("[]").partition(" ")[2]), t)
        t = _M_LINK.sub(note("markdown", "other", lambda m: m.group(1) or ""), t)
    if "''" in t:
        t = _W_EMPH.sub(note("wiki", "other", lambda m: m.group(2)), t)
    if "=" in t:
        t = _M_SETEXT.sub(note("markdown", "heading", lambda m: f"\x03{m.group(1)}\x04"), t)
        t = _W_HEAD.sub(note("wiki", "heading", lambda m: f"\x03{m.group(2)}\x04"), t)
    elif "--" in t:
        t = _M_SETEXT.sub(note("markdown", "heading", lambda m: f"\x03{m.group(1)}\x04") if not wiki else lambda m: m.group(), t)
    t = _W_LIST.sub(note("wiki", "list_item", "- "), t)
    if wiki:
        t = _W_LINE.sub(note("wiki", "list_item", "- "), t) if found else t
    else:
        if "#" in t:
            t = _M_HEAD.sub(note("markdown", "heading", lambda m: f"\x03{m.group(1)}\x04"), t)
    if "|" in t:
        t = _M_TABLE.sub(note("markdown", "table", lambda m: "" if _M_SEP.match(m.group()) else "\t".join(x.strip() for x in m.group().strip().strip("|").split("|"))), t)
    t = _md_lists(t, text, found)
    t = _M_QUOTE.sub(note("markdown", "other", ""), t) if ">" in t else t
    t = _M_RULE.sub(note("markdown", "other", ""), t)
    if "*" in t or "_" in t or "~" in t:
        if "__" in t:
            t = _W_WORD.sub(note("wiki", "other", ""), t)
        n = 1
        while n:  # from the outside in
            t, n = _M_EMPH.subn(note("markdown", "other", lambda m: m.group(2) or m.group(4) or m.group(6)), t)

    def back(m: re.Match) -> str:
        kind, body = hold[int(m.group(1))]
        if kind == "plain":
            return body
        if kind == "formula":
            return f"${body.strip()}$" if formulas else " "
        return f"\n```\n{body.strip(chr(10))}\n```\n" if "\n" in body else f"`{body}`"

    t = _HOLD.sub(back, t)
    t = t.replace("\x03", "# ").replace("\x04", "")
    return found, t


def _tex_body(m: re.Match) -> str:
    if not m.lastindex or _TEX_MUTE.match(m.group()):
        return ""
    return m.group(2) or m.group(1) or ""


def _tex_rows(block: str) -> str:
    body = re.sub(r"\\(?:begin|end)\{[^{}]*\}(?:\[[^\]]*\])?(?:\{[^{}]*\})?|\\hline", "", block)
    return "\n".join("\t".join(c.strip() for c in row.split("&")) for row in body.split("\\\\") if row.strip())


def _wiki_rows(block: str) -> str:
    rows: list[str] = []
    for line in block.split("\n"):
        s = line.strip()
        if s.startswith(("{|", "|}", "|-", "|+")) or not s:
            continue
        rows.append("\t".join(c.strip() for c in re.split(r"\|\||!!", s.lstrip("|!"))))
    return "\n".join(rows)


def _md_lists(t: str, text: str, found: set[tuple[str, str]]) -> str:
    """List markers at the start of a block or after another list line."""
    if not _M_LIST.search(t):
        return t
    out, prev = [], ""
    made = ("html", "list_item") in found or ("latex", "list_item") in found or ("wiki", "list_item") in found
    for line in t.split("\n"):
        m = _M_LIST.match(line)
        if m and (not prev.strip() or prev == "-" or "\x04" in prev) and not (made and line.startswith("- ") and line not in text):
            found.add(("markdown", "list_item"))
            line, prev = "- " + line[m.end() :], "-"
        else:
            prev = prev if prev == "-" and line.strip() and line[:1] == " " else "-" if line.startswith("- ") else line
        out.append(line)
    return "\n".join(out)


# --- content regions of pages -------------------------------------------------
_ANY_TAG = re.compile(r"<[^<>\n]{1,300}>")
_MARK = re.compile(r"(?P<note><!--.*?(?:-->|\Z))|<(?P<end>/?)(?P<tag>[A-Za-z][A-Za-z0-9]*)\b(?P<rest>[^<>]*)>|(?P<gap>\n[ \t]*(?=\n))", re.S)
# Elements whose text leads elsewhere, and those round a page's own text.
_LINKED, _ROUND = {"a", "button", "select", "option"}, {"nav", "footer"}
_HELD = (_FENCE, _OPEN_FENCE, _TICK, _TEX_CODE, _TEX_MATH, _TEX_TABLE, _TEX_HEAD, _TEX_ITEM, _W_TABLE, _W_HEAD, _W_LINE, _M_HEAD, _M_SETEXT, _M_LIST, _M_TABLE)


def _spare_lines(page: str) -> list[bool]:
    """For each line whether it may go: all its text stands in blocks of which most is
    links, or in a page's nav or footer, and it neither holds nor continues a heading,
    list, table, code or formula (the lists of a nav or footer apart). Lines without
    text stay, as a tag, comment or blank line that is lost would join what it parts."""
    n = page.count("\n") + 1
    keep, texts = [False] * n, [False] * n
    at = pos = 0
    shell: list[str] = []  # code, formula, script and style: up to the end tag all is theirs
    deep = dict.fromkeys(("heading", "list_item", "table"), 0)
    link, round_ = "", 0
    block: list[int] = [0, 0]  # characters in links, and others
    lines: set[int] = set()

    def close() -> None:
        if block[1] and block[1] >= block[0]:
            for i in lines:
                keep[i] = True
        block[:] = [0, 0]
        lines.clear()

    def put(s: str) -> None:
        nonlocal at
        for k, x in enumerate(s.split("\n")):
            at += k > 0
            held = bool(shell or deep["heading"] or deep["table"] or deep["list_item"] and not round_)
            keep[at] |= held
            if c := len(x.strip()):
                texts[at] = True
                block[0 if link or round_ else 1] += c
                lines.add(at)

    for m in _MARK.finditer(page):
        put(page[pos : m.start()])
        pos = m.end()
        tag, end = (m["tag"] or "").lower(), m["end"] == "/"
        if m["note"] is not None or m["gap"] is not None:
            span = m.group().count("\n")
            for i in range(at, at + span + 1) if m["note"] else ():
                keep[i] = True
            at += span
            if m["gap"] is not None:
                close()
            continue
        kind = _TAG.get(tag)
        span = m.group().count("\n")
        if shell:
            if end and tag == shell[-1]:
                shell.pop()
        elif kind in ("code", "formula") or tag in _HIDE:
            keep[at] = True
            if not end and not m["rest"].endswith("/"):
                shell.append(tag)
        elif kind in deep:
            keep[at] |= kind != "list_item" or not round_
            close()
            link = ""
            if kind == "heading" or tag in ("table", "ul", "ol", "dl", "menu", "dir"):
                deep[kind] = max(0, deep[kind] - 1) if end else deep[kind] + 1
        elif tag in _ROUND:
            close()
            round_ = max(0, round_ - 1) if end else round_ + (page.find(f"</{tag}", pos) >= 0)
        elif tag in _BLOCK and tag != "br":
            close()
            link = ""
        elif tag in _LINKED:
            if end:
                link = "" if link == tag else link
            elif tag != "a" or "href" in m["rest"].lower():
                link = tag
        at += span
    put(page[pos:])
    close()
    for p in _HELD:
        for m in p.finditer(page):
            first = page.count("\n", 0, m.start())
            for i in range(first, first + m.group().rstrip("\n").count("\n") + 1):
                keep[i] = True
    return [t and not k for t, k in zip(texts, keep)]


def content_lines(page: str, sigma: float = 1.0) -> list[bool]:
    """For each line whether it belongs to the page's content: characters of text per
    tag, smoothed over neighbouring lines, split by two-means into a high and a low
    cluster. Of the low one only links and boilerplate go: short headings, items, rows,
    code and formulas, dense of tags as they are, are content (``_spare_lines``), and so is
    every line where all lines read alike."""
    lines = page.split("\n")
    ratio = []
    for x in lines:
        tags = _ANY_TAG.findall(x)
        ratio.append((len(x) - sum(map(len, tags))) / max(1, len(tags)))
    reach = max(1, int(3 * sigma))
    kernel = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-reach, reach + 1)]
    n = len(ratio)
    smooth = []
    for i in range(n):
        num = den = 0.0
        for k, w in zip(range(-reach, reach + 1), kernel):
            if 0 <= i + k < n:
                num += w * ratio[i + k]
                den += w
        smooth.append(num / den)
    lo, hi = min(smooth), max(smooth)
    for _ in range(20):
        cut = (lo + hi) / 2
        a = [v for v in smooth if v < cut]
        b = [v for v in smooth if v >= cut]
        if not a or not b:
            break
        la, lb = sum(a) / len(a), sum(b) / len(b)
        if (la, lb) == (lo, hi):
            break
        lo, hi = la, lb
    return [v >= (lo + hi) / 2 or not s for v, s in zip(smooth, _spare_lines(page))]


def clean(text: str | None, page: bool = True) -> str:
    """The text without markup; of an HTML page only its content regions. A text that
    is part of a page's content already (``page`` false) is kept whole."""
    if not text:
        return ""
    if page and "<" in text and _ANY_TAG.search(text):
        keep = content_lines(text)
        if not all(keep):
            text = "\n".join(x for x, k in zip(text.split("\n"), keep) if k)
    return re.sub(r"\n{3,}", "\n\n", scan(text)[1]).strip()


def clean_rows(rows) -> list[list[str] | None] | None:
    """A table's cells without markup; a cell stands alone, and rows and cells keep their places."""
    return None if rows is None else [None if row is None else [clean(c, page=False) for c in row] for row in rows]


def labels(text: str | None) -> list[str]:
    """'markup kind' of each element, sorted."""
    return sorted(f"{a} {b}" for a, b in scan(text)[0])


def labels_of_rows(rows) -> list[str]:
    """The elements of all cells of a table; a cell stands alone."""
    out: set[str] = set()
    if rows is not None:
        for row in rows:
            for cell in row if row is not None else ():
                if cell and _ANY.search(cell):
                    out.update(labels(cell))
    return sorted(out)


_LIST = T.ArrayType(T.StringType())


@F.pandas_udf(_LIST)
def _labels_udf(s: pd.Series) -> pd.Series:
    return s.map(labels)


@F.pandas_udf(_LIST)
def _rows_udf(s: pd.Series) -> pd.Series:
    return s.map(labels_of_rows)


@F.pandas_udf(T.StringType())
def _clean_udf(s: pd.Series) -> pd.Series:
    return s.map(clean)


@F.pandas_udf(T.StringType())
def _clean_part_udf(s: pd.Series) -> pd.Series:
    return s.map(lambda x: clean(x, page=False))


@F.pandas_udf(T.ArrayType(_LIST))
def _clean_rows_udf(s: pd.Series) -> pd.Series:
    return s.map(clean_rows)


def element_labels(col: Column) -> Column:
    """array<string> of 'markup kind'."""
    return _labels_udf(col)


def row_labels(col: Column) -> Column:
    """The same for array<array<string>>."""
    return _rows_udf(col)


def clean_text(col: Column, page: bool = True) -> Column:
    return (_clean_udf if page else _clean_part_udf)(col)


def clean_cells(col: Column) -> Column:
    """The same for array<array<string>>, cell by cell."""
    return _clean_rows_udf(col)


def table_text(rows: Column) -> Column:
    """A table in the plain notation: a line for each row, tabs between cells, and in a
    cell blanks for line breaks and tabs. Null rows and cells are empty."""
    cell = lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))
    return F.array_join(F.transform(rows, lambda r: F.coalesce(F.array_join(F.transform(r, cell), "\t"), F.lit(""))), "\n")


def may_hold(col: Column) -> Column:
    """A filter in the JVM: false where no element can be."""
    return col.rlike(ANY)
