"""Sentence boundaries across languages and scripts.

A text is cut at blank lines into blocks. Within a block a semi-Markov dynamic
programme picks whole spans between candidate points (terminators, single line
breaks, spaces in scripts that write no full stop). A span's score adds up how its
first word opens a sentence, how its last word and mark close one, how plausible
its length is, and whether its quotation marks pair off; a break inside a quotation
leaves two unpaired spans, so the whole quotation stays in its sentence.

Positions are code points, starts inclusive and ends exclusive; every character
that is no white space lies in exactly one span. Null and blank texts give none.
"""

from __future__ import annotations

import math
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Abbreviations without their last stop, lower case. After these a sentence goes on.
_INNER = """
mfg mr mrs ms dr prof rev hon gen col maj capt cpt lt sgt ssg sfc msg pfc cpl pvt spc cmdr adm gov sen rep st mt ft
fig figs no nos vol vols pp p pg para paras sec secs app ver art eq eqs ch chap ref refs ed eds ext tel dept est approx e.g i.e eg ie cf vs viz ca
jan feb mar apr jun jul aug sept sep oct nov dec
bzw z.b d.h u.a o.g abs nr tab abb bd vgl evtl ggf inkl hr fr str s dipl ing zzgl z.t
m mme mlle mm tabl env ex av bd boul chap éd
sr sra srta d dña dra pág págs aprox p.ej ej núm art cap lic ing
т.е рис п пп табл прибл см ул стр гл им проф акад напр ср ред
डॉ श्री प्रो सं पृ
د أ م ص
ดร นพ พ.ศ ค.ศ
sig dott avv pag ecc art
""".split()
# Abbreviations after which a sentence may end.
_EITHER = """
p.m a.m pm am etc co inc ltd corp bros jr esq u.s u.k al mi km kg cm mm ft lb lbs oz hr hrs min mph t h g l usw etc u.s.w ff
т.д т.п г гг в вв км кг руб м т ч мин
कि.मी कि.ग्रा मी ग्रा
กม ก.ม กก น ซม ม
كم كغ سم
""".split()
_KIND = {w: 2 for w in _EITHER} | {w: 1 for w in _INNER if w not in _EITHER}
# Words that carry a sentence on after a closing quotation, a space or a line break.
_ON = set("""
and or but nor then so that which who while because
und oder aber denn sowie
et ou mais puis
y o e pero luego
и или но а затем
और या लेकिन तथा एवं फिर
ثم و أو لكن
""".split())
_ON_START = (
    "และ", "หรือ", "แต่", "ซึ่ง", "จึง", "โดย", "กับ", "เพื่อ", "เพราะ", "ที่",
    "然后", "然後", "随后", "接着", "就", "便", "并", "而", "但", "才", "又", "也",
    "と", "って", "など", "という", "は", "が", "を", "の", "に", "で", "も", "へ",
    "라고", "하고", "고", "이라고", "라는", "며",
)
# Frequent first words of sentences in cased scripts.
_OPEN = set("""
The A An This That These Those It He She They We You I In On At When If Do No Each Every Once After Before While Should Can What Where Who Why How Is Are There Since
Der Die Das Ein Eine Es Er Sie Wir Im Am In Laut Siehe Hat Ist Wenn
Le La Les Un Une Il Elle Est D’après Voir Ce
El Los Las Un Una Hay Según Es En
В На Он Она Это См Где Когда
""".split())
_ORDINAL = re.compile(r"\b(?:der|die|das|den|dem|des|am|im|vom|zum|zur|bis|seit|ab|beim|ein|einem|jeder?n?)\s+\d{1,2}$", re.I)
_SPELT = re.compile(r"(?:^|\s)(?:[^\W\d_][ -]){2,}[^\W\d_]$")
_INITIAL = re.compile(r"[^\W\d_]\.")
#: scripts that end sentences with a mark of their own or none
_NO_STOP = re.compile(r"[ऀ-෿฀-໿ក-៿一-鿿぀-ヿ]")
_CLOCK = re.compile(r"\b[ap]\.\s?m$", re.I)
_SAID = re.compile(r"[一-鿿]{0,4}[说問问喊道叫答][。，,！]")
_WORD = re.compile(r"[^\W\d_](?:[^\W_]|[.’'\-̀-ͯऀ-ःऺ-ॏะ-๎])*", re.U)
_LAST = re.compile(r"((?:[^\W_]|[.’'ऀ-ःऺ-ॏะ-๎-])+)$", re.U)

_MARK = "。！？｡।॥؟۔։።။។"
_CAND = re.compile(
    r"(\n[^\S\n]*\n\s*)"
    r"|([.!?…]+|[" + _MARK + r"]+)((?:[^\S\n]?»|[\"”’“」』〉》)\]}*_~`]|'(?!\w)|</\w+>)*)(\s*)"
    r"|(\n\s*)"
    r"|(?<=[฀-๿຀-໿ក-៿])([^\S\n]+)(?=[฀-๿຀-໿ក-៿])"
)
_QUOTE = re.compile(r"[\"„“”«»‹›「」『』]")
_PAIR = {'"': '"', "„": "“”", "“": "”", "”": "”", "«": "»", "»": "«", "‹": "›", "›": "‹", "「": "」", "『": "』"}
_LEAD = re.compile(r"[\"'“„«»‹「『(\[{¿¡*_~`]|<[^<>\n]{1,60}>|\\[a-zA-Z]+\{|\s")
_ITEM = re.compile(r"(?:[-*+•–#>]+|\\item\b|\d{1,3}[.)]|[a-z][.)])\s")
#: Weight of an unpaired span, of a word's and a mark's evidence, and of length.
UNPAIRED, LENGTH = 4.0, 0.3
#: Signs of a quotation at which it ties its sentences half as much: the longer it is, the more
#: likely are its marks stray ones.
QUOTED = 1000


def _opening(text: str, at: int, on: bool) -> float:
    """How well a sentence begins at ``at``. ``on``: a quotation or a mere space comes before."""
    n = len(text)
    while at < n and not text[at].isalnum():
        m = _LEAD.match(text, at)
        if not m:
            break
        at = m.end()
    if at >= n:
        return 0.5
    ch = text[at]
    if ch.islower():
        return -5.0
    if ch.isupper():
        w = _WORD.match(text, at).group()
        return 2.0 if w in _OPEN else 1.0
    if ch.isalpha():
        if on:
            w = _WORD.match(text, at).group()
            if w in _ON or w.startswith(_ON_START) or _SAID.match(text, at):
                return -5.0
        return 1.0
    if ch.isdigit():
        return 0.2
    return -5.0 if ch in "—–-,;:)]»”/、，；：" else 0.0


def _closing(text: str, start: int, at: int, mark: str, after: int) -> float:
    """How well a sentence ends with ``mark`` at ``at``; the next one would begin at ``after``."""
    if mark[0] in _MARK:
        return 3.0
    if mark != ".":
        return 2.0 if "!" in mark or "?" in mark else 0.5
    head = text[max(start, at - 24) : at]
    tail = head.rsplit(None, 1)
    if tail and len(tail[-1]) > 4 and tail[-1].isalpha() and tail[-1].lower() not in _KIND:
        return 2.0
    m = _LAST.search(head)
    if not m:
        return 2.0
    word = m.group(1)
    low = word.lower().lstrip(".-'’")
    kind = _KIND.get(low, 0)
    for glue in "’.":  # an elided article, or the sentence before without a space
        if not kind and glue in low:
            word = word.rsplit(glue, 1)[-1]
            low = low.rsplit(glue, 1)[-1]
            kind = _KIND.get(low, 0)
    if head[m.start() - 1 : m.start()] in "*@-_$#" and m.start() or _SPELT.search(head):
        return 2.0  # a masked or spelt-out word
    if kind and _NO_STOP.match(text, after):
        return -3.0
    if len(low) == 1 and low.isalpha():
        if _CLOCK.search(head):
            return 0.0
        before = head[: m.start()].rstrip()
        if word.islower() and before[-1:].isdigit():
            return 0.3  # a unit after its number
        if kind == 1 or word.isupper() or _INITIAL.match(text, after):
            return -3.0
        if kind == 0:
            return 1.0
    if kind == 1:
        return -4.0
    if kind == 2:
        return 0.0
    if low.isdigit() and len(low) <= 2 and _ORDINAL.search(head):
        return -4.0
    return 2.0


def _heading(line: str) -> bool:
    """A short line without a stop whose words are in capitals or title case."""
    words = line.strip("#=*_ \t").split()
    if not words or len(words) > 9 or line.rstrip()[-1:] in ".,;:!?":
        return False
    big = sum(w[0].isupper() or not w[0].isalpha() for w in words)
    return big >= max(1, math.ceil(0.6 * len(words))) and words[0][:1].isupper()


def _block(text: str, a: int, b: int, cands: list[tuple[int, int, float]], out: list[int]) -> None:
    """Spans of the block ``text[a:b]`` given its candidates (end, next start, score)."""
    if not cands:
        out += (a, b)
        return
    quotes = [m.start() for m in _QUOTE.finditer(text, a, b)]
    toggles: list[tuple[int, float]] = []  # place of each mark, and how much what follows is tied
    if quotes:
        want, since = "", 0
        for p in quotes:
            ch = text[p]
            if want and ch in want:
                toggles += ((since, UNPAIRED / (1.0 + ((p - since) / QUOTED) ** 2)), (p, 0.0))
                want = ""
            elif ch in _PAIR and not want:
                want, since = _PAIR[ch], p
    else:
        # without quotations only the length ties the spans together, and it never
        # outweighs a clear point: cut there, drop clear non-points
        if all(s >= 1.5 or s <= -2.0 for _, _, s in cands):
            at = a
            for e, nx, s in cands:
                if s > 0:
                    out += (at, e)
                    at = nx
            out += (at, b)
            return
    pts = [(a, a, 0.0), *((e, nx, s) for e, nx, s in cands if s > -2.0 or quotes), (b, b, 0.0)]
    pair, k, tie = [], 0, 0.0
    for e, _, _ in pts:
        while k < len(toggles) and toggles[k][0] < e:
            tie = toggles[k][1]
            k += 1
        pair.append(tie)
    mean = 25.0 if text[a] > "⹿" else 80.0
    n = len(pts)
    best, back, base = [0.0] * n, [0] * n, 0
    for j in range(1, n):
        e, _, score = pts[j]
        top, arg, pj = -1e18, base, pair[j]
        for i in range(base, j):
            size = e - pts[i][1]
            s = best[i] - LENGTH * abs(math.log((size + 10.0) / mean))
            s -= max(pj, pair[i])
            if s > top:
                top, arg = s, i
        best[j], back[j] = top + score, arg
        if score >= 2.0 and not pj and j < n - 1:
            base = j  # a clear point outside quotations lies on every best path
    cut, j = [], n - 1
    while j:
        cut.append((pts[back[j]][1], pts[j][0]))
        j = back[j]
    for s, e in reversed(cut):
        out += (s, e)


def spans(text: str | None) -> list[int]:
    """Start and end of each sentence in turn: [s1, e1, s2, e2, ...]."""
    out: list[int] = []
    if not text:
        return out
    end = len(text.rstrip())
    a = len(text) - len(text.lstrip())
    if a >= end:
        return out
    cands: list[tuple[int, int, float]] = []
    line = a
    add = cands.append
    for m in _CAND.finditer(text, a, end):
        kind = m.lastindex
        nx = m.end()
        if kind == 1:  # a blank line
            e = m.start()
            while e > a and text[e - 1].isspace():
                e -= 1
            if e > a:
                _block(text, a, e, [c for c in cands if c[0] < e], out)
            a = line = nx
            cands = []
            add = cands.append
        elif kind == 4:  # a terminator, closing marks, white space
            if nx >= end:
                continue
            at = m.start()
            mark, closers, gap = m.group(2, 3, 4)
            e = nx - len(gap)
            if not gap and mark[0] not in _MARK:
                # a stop without a space ends a sentence only between a word and a capital
                up = text[nx]
                if not (up.isupper() or up in "\"“«¿¡„" and not closers) or not (text[at - 1 : at].islower() or mark != "." or closers):
                    continue
                tail = (text[max(a, at - 40) : at].rsplit(None, 1) or [""])[-1]
                if "://" in tail or "@" in tail or "\\" in tail or "/" in tail:
                    continue
                if up in "\"“«„" and not text[nx + 1 : nx + 2].isupper():
                    continue
            on = False
            if closers:
                on = any(c in "\"”’“»」』" for c in closers)
            if not on and mark[0] == "." and text[nx] > "\u08ff":
                on = _NO_STOP.match(text, nx) is not None
            opening = _opening(text, nx, on)
            score = opening if opening <= -5.0 else opening + _closing(text, a, at, mark, nx)
            if "\n" in gap:
                line = nx
                if _ITEM.match(text, nx):
                    score = 4.0
                elif opening > 0 and score > 0:
                    score += 0.5
            add((e, nx, score))
        elif kind == 5:  # a single line break
            e = m.start()
            while e > a and text[e - 1].isspace():
                e -= 1
            if e <= (cands[-1][1] if cands else a):
                continue
            if _ITEM.match(text, nx):
                score = 4.0
            else:
                opening = _opening(text, nx, True)
                score = -5.0
                if opening > -5.0:
                    own = text[line:e]
                    score = 4.0 if len(own) < 70 and _heading(own) else -3.0
                    stop = text.find("\n", nx, end)
                    if score < 0 and stop > 0 and _heading(text[nx:stop]):
                        score = 1.0
            add((e, nx, score))
            line = nx
        else:  # a space in a script that writes no stop
            add((m.start(), nx, 2.0 if _opening(text, nx, True) > 0 else -5.0))
    if a < end:
        _block(text, a, end, cands, out)
    return out


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _spans_udf(s: pd.Series) -> pd.Series:
    return s.map(spans)


def sentence_spans(col: Column) -> Column:
    """array<int> of starts and ends in turn; empty for null or blank text."""
    return _spans_udf(col)


def exploded(spans_col: str) -> Column:
    """A generator of (sent_no, sent_start, sent_end) from a column of ``sentence_spans``."""
    x = F.col(spans_col)
    one = lambda i: F.struct((i + 1).alias("sent_no"), F.get(x, i * 2).alias("sent_start"), F.get(x, i * 2 + 1).alias("sent_end"))
    return F.inline(F.when(F.size(x) > 0, F.transform(F.sequence(F.lit(0), F.greatest((F.size(x) / 2).cast("int") - 1, F.lit(0))), one)))
