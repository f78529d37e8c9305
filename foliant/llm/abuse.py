"""Abusive, hateful and sexual content.

A lexicon of words and expressions is held as a trie. Each token (with spelt-out, stretched,
masked and digit-for-letter spellings undone) is read by a Levenshtein automaton that walks the
trie of the lexicon's words, so misspelt ones are found too; expressions are paths of such
words, and in scripts without spaces paths of characters. A context window, the sentence, is
scored from the weight of its terms and from what stands around them: who is spoken to or of,
quotation marks and reporting verbs, rules, technical and medical words. What stands in
quotation marks counts little. A document's score of a kind is that of its worst window.

``fit`` moves the hand-set weights, by a penalised logistic regression on a bounded sample of
judged texts, and adds expressions that the sample shows to be telling (or, beside a term,
harmless). Without a sample the hand-set weights stand. A window without a term scores 0, so
only windows that hold a term's rarest word are looked at. Null and empty texts score 0.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm.markup import scan

KINDS = ("abuse", "hate", "sexual")
#: A document is a case of a kind from this score on: it is then more likely one than not.
CASE = 0.5
#: At most so many judged documents are read by ``fit``.
MAX_JUDGED = 5000

# Words and expressions with their weight, by kind.
STRONG, MEDIUM, WEAK = 0.6, 0.4, 0.25
LEXICON: dict[str, dict[str, float]] = {
    "abuse": {
        **dict.fromkeys(
            """
            idiot idiots moron morons imbecile imbeciles dimwit dimwits loser losers bastard bastards clown clowns scumbag scumbags
            coward cowards jackass dumbass asshole worm worms rat pig pigs leech leeches scum creep cretin jerk fool twit nitwit
            halfwit blockhead maggot weasel swine bitch whore slut prick wanker douchebag dickhead motherfucker shithead
            vollidiot trottel versager depp arschloch dummkopf schwachkopf missgeburt
            abruti abrutis crétin crétins minable minables imbéciles connard connards débile salaud
            imbécil imbéciles inútil inútiles estúpido estúpidos estúpida idiota idiotas gilipollas cabrón
            идиот идиоты дурак дура тупица урод мразь ублюдок ничтожество кретин
            मूर्ख बेवकूफ गधा निकम्मा कमीना
            غبي أحمق حقير تافه وغد
            바보 멍청이 병신 쓰레기
            """.split(),
            STRONG,
        ),
        **dict.fromkeys(
            """
            useless brainless gutless spineless pathetic worthless braindead filthy slimy rotten stupid ugly sorry disgusting
            nutzloser nutzlose dumm dumme
            """.split(),
            WEAK,
        ),
        **dict.fromkeys(
            [
                "waste of skin", "waste of space", "waste of air", "piece of garbage", "piece of trash", "piece of filth", "piece of shit", "piece of dirt",
                "hurt you", "kill you", "beat you", "stab you", "shoot you", "smash you", "break your", "break you", "crush you", "hope you choke", "hope you die", "hope you rot", "hope you burn", "hope you drown",
                "crawl back under", "crawl back into", "nobody likes you", "nobody wants you", "nobody needs you", "nobody loves you", "make me sick", "make us sick", "make me puke", "make me vomit",
                "spit on you", "drop dead", "go to hell", "go hang yourself", "hijo de puta", "verpiss dich", "ta gueule", "死ね", "黙れ", "馬鹿野郎", "バカ野郎", "クズ野郎", "去死", "滚开", "ไอ้โง่", "ไอ้ควาย", "ไอ้สัตว์", "ไอ้ขยะ", "หุบปาก",
                "пошёл вон", "пошел вон", "пошёл ты", "пошел ты", "я тебя убью", "я тебя найду", "닥쳐", "اخرس", "halt die klappe", "halt die fresse", "halt den mund", "halt das maul", "haltet die klappe", "haltet den mund",
                "pedazo de basura", "pedazo de mierda", "заткнись", "kill yourself", "shut your mouth", "shut your face", "shut your trap",
            ],
            0.9,
        ),
        **dict.fromkeys(["shut up", "go die", "go drown", "go choke", "go cry", "ferme la", "cállate", "चुप कर", "चुप रह", "白痴", "笨蛋", "废物", "蠢货", "闭嘴", "馬鹿", "バカ", "クズ", "役立たず", "bons à rien", "no valéis nada", "no vales nada"], STRONG),
        **dict.fromkeys(["get lost", "you are a", "you are an", "you re a", "you re an", "is a complete", "such a", "what kind of", "espèce de", "espèce d", "du bist ein", "ihr seid", "tu es un", "tu es une", "vous êtes des", "eres un", "eres una", "sois unos", "zu dumm", "brain dead"], WEAK),
    },
    "hate": {
        "subhuman": 0.9, "subhumans": 0.9, "untermenschen": 0.9, "vermin": MEDIUM, "exterminate": 0.7, "exterminated": 0.7, "cockroaches": 0.5, "savages": 0.5, "parasites": 0.5,
        **dict.fromkeys(
            [
                "are vermin", "are animals", "are savages", "are parasites", "are rats", "are dogs", "are pigs", "are criminals", "are scum", "are filth", "are garbage", "are a disease", "are a plague", "are a cancer", "are a curse",
                "hunted out", "hunted down", "deserve to starve", "deserve to die", "deserve to suffer", "deserve to burn", "deserve to rot", "deserve to hang", "not count as human", "never be allowed to", "poison the wells", "too stupid to", "go back to where",
                "should be shot", "should be killed", "should be hanged", "should be gassed", "should be deported", "should all be shot", "should all be killed",
            ],
            0.9,
        ),
        **dict.fromkeys(["breed like", "dirty blood", "in their blood", "in cages", "be driven out", "houses burned", "wiped out", "never trust", "can t trust"], STRONG),
        **dict.fromkeys(["belong in", "better off if", "better off without"], WEAK),
    },
    "sexual": {
        "porn": 0.8, "porno": 0.8, "pornography": 0.6, "horny": 1.0, "orgasm": 1.0, "orgasms": 1.0, "nude": 0.5, "nudes": 0.8, "naked": 0.5,
        "sex": 0.5, "aroused": 0.5, "groped": 0.6, "undress": 0.6, "undressed": 0.5, "breasts": 0.5, "breast": 0.3, "moaned": 0.5, "panting": 0.4,
        "lovers": 0.4, "penis": 0.6, "vagina": 0.6, "cock": 0.3, "pussy": 0.8, "blowjob": 1.2, "masturbate": 1.0, "masturbated": 1.0, "fuck": 0.4,
        "erotic": 0.6, "stripped": 0.2, "unbuttoned": 0.4, "caressed": 0.4, "topless": 0.5,
        "had sex": 0.7, "having sex": 0.7, "for sex": 0.5, "make love": 0.9, "made love": 0.9, "making love": 0.9, "in my bed": 0.6, "in his bed": 0.6, "in her bed": 0.6, "bare skin": 0.5, "hot bodies": 0.6,
        "tore off their clothes": 0.8, "tore off her clothes": 0.8, "tongue down": 0.7, "bare thighs": 0.4, "kiss her": MEDIUM, "kissed her": MEDIUM, "send me your nudes": 0.5,
        "色情": 0.9, "裸聊": 0.9, "做爱": 0.9, "ポルノ": 0.9, "セックス": 0.9, "หนังโป๊": 0.9,
    },
}

# Who is spoken to or of, and contexts in which a word is not meant.
YOU = frozenset(
    """you your yours yourself u ur whoever du dich dir dein ihr euch tu te toi vous eres sois tú usted ты тебя вы तुम आप तू أنت انت 너 너는 당신""".split()
)
PEOPLE = frozenset("they their them those these people all every peoples folk settlers tribe tribes clan clans race foreigners immigrants natives refugees born".split())
SAID = frozenset("said says say wrote writes called calls call shouted shouts told tells quoted quotes reported reports according insult insults word words slur slurs term".split())
RULES = frozenset("rule rules policy forbid forbids forbidden prohibit prohibits prohibited banned bans removed remarks harassment blocks filter filters report training complaint complaints".split())
TECHNICAL: dict[str, frozenset[str]] = {
    "abuse": frozenset("file files connector connectors".split()),
    "hate": frozenset("trapped trap traps pest pests bait insects poisoned".split()),
    "sexual": frozenset("connector connectors wire wires screw screws lug lugs eye medic medics wound wounds patient patients blood frozen frost frostbite clinic clinical anatomy cancer exam examination".split()),
}
_UNSPACED = r"\u0e00-\u0e7f\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff"
# who is spoken to, in scripts without spaces
_YOU_UNSPACED = re.compile("你|您|お前|おまえ|てめえ|貴様|きさま|มึง|แก|คุณ")
_QUOTED = re.compile(r"[“„«「『]([^“”„«»「」『』\n]{1,400})[”“»」』]|(?<![\w\"])\"([^\"\n]{1,400})\"(?!\w)|(?<![\w'])'([^'\n]{3,400})'(?!\w)")

_LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "il", "*": "*"}
# marks that stand on letters (vowel signs and the like), which \\w leaves out
_ON = "".join(re.escape(chr(i)) for i in range(0x300, 0x10000) if unicodedata.category(chr(i)) in ("Mn", "Mc"))
_MORE = rf"[^\W_]*(?:[{_ON}]+[^\W_]*)*"
_TOKEN = re.compile(rf"(?:[@$!](?=\w))?[^\W_]{_MORE}(?:(?:[@$!*]+|['’](?=\w)){_MORE})*")
_SPELT = re.compile(rf"(?<![^\W_])(?<![{_ON}])(?:[^\W_]([ .·-]))(?:[^\W_]\1){{1,}}[^\W_](?![^\W_]|[{_ON}])")
# markup that may part a word: inline tags, marks, commands, entities
_PARTED = re.compile(
    r"\w(?:<(?!/?(?:p|div|br|li|ul|ol|dl|dt|dd|tr|td|th|table|h[1-6r]|pre|html|body|section|article)\b)[^<>\n]*>|''+|[*`~]+|[\[\]{}]+|\\[a-zA-Z]+\*?\{)+\w"
    r"|&(?:#\w+|[A-Za-z]{1,8}(?:acute|grave|uml|circ|tilde|cedil|lig|ring|slash|caron));"
)
_END = re.compile(r"[.!?。！？।؟…]+[\"'”’»」)]*(?:\s|$)|\n\s*\n|(?<=[a-z])[.!?](?=[A-Z][a-z ])|[。！？।]")


def fold(word: str) -> str:
    """Lower case, accents kept only where the lexicon has them as letters of their own."""
    return unicodedata.normalize("NFC", word).lower()


def _runs(word: str) -> str:
    return re.sub(r"(.)\1+", r"\1", word)


class Trie:
    """The lexicon's words; ``lookup`` intersects them with the Levenshtein automaton of a token."""

    def __init__(self, words: Iterable[str]) -> None:
        self.words = frozenset(map(fold, words))
        self.root: dict = {}
        self.flat: dict = {}
        for w in sorted(self.words):
            self._put(self.root, w, w)
            self._put(self.flat, _runs(w), w)

    @staticmethod
    def _put(node: dict, path: str, word: str) -> None:
        for ch in path:
            node = node.setdefault(ch, {})
        node[""] = word

    @staticmethod
    def reach(n: int) -> int:
        """Misspellings allowed in a token of ``n`` letters."""
        return 0 if n < 5 else 1 if n < 9 else 2

    def lookup(self, token: str) -> tuple[str, int] | None:
        """The nearest word and its distance; the first letter may be masked, but not another."""
        if token in self.words:
            return token, 0
        stretched = re.search(r"([^\W\d_])\1\1", token) is not None
        masked = any(c in _LEET for c in token) and any(c.isalpha() for c in token)
        if not stretched and not masked and len(token) < 5:
            return None
        root, key = (self.flat, _runs(token)) if stretched else (self.root, token)
        most = 0 if stretched or "*" in token else self.reach(len(key))
        if masked and not stretched and "*" not in token:
            most = min(most, 1)
        alts = [frozenset(_LEET.get(c, "") + c) for c in key]
        wild = [c == "*" for c in key]
        n = len(key)
        best: tuple[str, int] | None = None
        stack: list[tuple[dict, str, list[int], list[int], str]] = [(root, "", list(range(n + 1)), [], "")]
        while stack:
            node, prefix, row, before, last = stack.pop()
            word = node.get("")
            if word is not None and row[n] <= most and (best is None or row[n] < best[1]):
                best = (word, row[n])
            for ch, child in node.items():
                if not ch:
                    continue
                # the first letter stands unless it is masked
                if not prefix and not (wild[0] or ch in alts[0]):
                    continue
                new = [row[0] + 1]
                for j in range(1, n + 1):
                    same = wild[j - 1] or ch in alts[j - 1]
                    v = min(new[-1] + 1, row[j] + 1, row[j - 1] + (not same))
                    if before and j > 1 and ch in alts[j - 2] and last in alts[j - 1]:
                        v = min(v, before[j - 2] + 1)
                    new.append(v)
                if min(new) <= most:
                    stack.append((child, prefix + ch, new, row, ch))
        return best



#: What is told of a window beside its terms: names of the context's features.
CONTEXT = ("you", "people", "quoted", "said", "rules", "technical", "capital")
#: Hand-set weights of the context, by kind: as many log odds.
PRIOR: dict[str, dict[str, float]] = {
    "abuse": {"you": 1.2, "people": 0.0, "quoted": -1.5, "said": -1.0, "rules": -3.0, "technical": -1.5, "capital": 0.3},
    "hate": {"you": 0.0, "people": 1.2, "quoted": -1.5, "said": -1.0, "rules": -3.0, "technical": -2.5, "capital": 0.6},
    "sexual": {"you": 0.2, "people": 0.0, "quoted": -1.0, "said": -0.5, "rules": -3.0, "technical": -3.5, "capital": 0.2},
}
#: Log odds of a window without terms and context, and those that a weight of one adds.
BIAS, SLOPE = -5.0, 7.0
#: What counts of a term in quotation marks.
QUOTED = 0.2
#: How sure a learned expression must be (twice the log likelihood ratio), its least documents, most words.
SURE, SEEN, LONGEST = 24.0, 4, 3
#: Rounds of the regression, and how far off a judgement is that plays no part in it.
ROUNDS, SLIP = 3, 0.9
#: How many times as often it stands in texts of the kind as in those free of all; what learned
#: expressions count together at most; the most that terms count in a window.
PURE, LEARNED, MOST = 4.0, 1.2, 2.0
#: Share of the texts free of all that a learned expression's rarest word may stand in.
RARE = 0.02


@dataclass(frozen=True)
class Model:
    """Weights by kind: of terms (expressions as tuples of words), learned expressions, context,
    and the bias; words that look like misspelt ones but are not; and in how many texts of the
    sample the words of terms stand."""

    terms: dict[str, dict[tuple[str, ...], float]]
    learned: dict[str, dict[tuple[str, ...], float]] = field(default_factory=lambda: {k: {} for k in KINDS})
    context: dict[str, dict[str, float]] = field(default_factory=lambda: PRIOR)
    bias: dict[str, float] = field(default_factory=lambda: dict.fromkeys(KINDS, BIAS))
    slope: dict[str, float] = field(default_factory=lambda: dict.fromkeys(KINDS, SLOPE))
    plain: frozenset[str] = frozenset()
    common: dict[str, int] = field(default_factory=dict)


def lexicon_model(lexicon: dict[str, dict[str, float]] | None = None) -> Model:
    """The hand-set weights."""
    return Model({k: {tuple(_TOKEN.findall(fold(t))) if not _SCRIPT.search(t) else tuple(fold(t)): w for t, w in ws.items()} for k, ws in (lexicon or LEXICON).items()})


_SCRIPT = re.compile(f"[{_UNSPACED}]")
_STRETCH = re.compile(f"[{_UNSPACED}]+")


# what parts tokens in plain text: every sign but those that may stand in one
_PARTS = str.maketrans({chr(i): " " for i in range(128) if not chr(i).isalnum() and chr(i) not in "@$!*'_"})
_ONE = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def _distinct(low: str) -> set[str]:
    """The different tokens of a folded text, as ``_TOKEN`` finds them."""
    if not low.isascii():
        return set(_TOKEN.findall(low))
    raw = set(low.translate(_PARTS).split())
    odd = {t for t in raw if not t.isalnum()}
    return raw - odd | {t for x in odd for t in _TOKEN.findall(x)} if odd else raw


class Scorer:
    """Scores texts; keeps what it has learnt of tokens (up to ``KEPT``)."""

    KEPT = 200_000

    def __init__(self, model: Model | None = None) -> None:
        self.model = m = model or lexicon_model()
        rare = m.common
        paths: dict[tuple[str, ...], list[tuple[str, float, bool]]] = {}
        for k in KINDS:
            for t, w in m.terms.get(k, {}).items():
                paths.setdefault(t, []).append((k, w, True))
            for t, w in m.learned.get(k, {}).items():
                paths.setdefault(t, []).append((k, w, False))
        spaced = {t: v for t, v in paths.items() if not _SCRIPT.match(t[0])}
        self.trie = Trie({w for t in spaced for w in t})
        # expressions by their first word; in scripts without spaces by their first character
        self.tree: dict = {}
        for t, v in paths.items():
            node = self.tree
            for w in t:
                node = node.setdefault(w, {})
            node[None] = (t, v)
        # a window may only have a term where it has the term's rarest word
        self.anchors = frozenset(min(t, key=lambda w: (rare.get(w, 0), -len(w), w)) for t in spaced)
        self.seen: dict[str, tuple[str, int] | None] = {}
        # tokens that are no anchor
        self.cold: set[str] = set()

    def word(self, token: str) -> tuple[str, int] | None:
        """The lexicon's word that the token is or nearly is."""
        try:
            return self.seen[token]
        except KeyError:
            if len(self.seen) > self.KEPT:
                self.seen.clear()
            hit = self.trie.lookup(token)
            if hit is not None and hit[1] and token in self.model.plain:
                hit = None
            self.seen[token] = hit
            return hit

    def joined(self, m: re.Match) -> str:
        """A spelt-out word in one piece; a first letter that is a word of its own stays apart."""
        word = m.group().replace(m.group(1), "")
        if m.group(1) == " " and not self.word(fold(word)) and self.word(fold(word[1:])):
            return word[0] + " " + word[1:]
        return word

    def tokens(self, window: str) -> list[tuple[str, int, int]]:
        """(word, misspellings, place) of the window, the lexicon's words for misspelt ones;
        characters one by one in scripts without spaces."""
        out: list[tuple[str, int, int]] = []
        for m in _TOKEN.finditer(window):
            t = m.group()
            if _SCRIPT.search(t):
                out += [(c, 0, m.start() + i) for i, c in enumerate(t)]
                continue
            hit = self.word(t)
            if hit is None and ("'" in t or "’" in t):
                parts = re.split("['’]", t)
                hit = self.word(parts[-1])
                out += [(x, 0, m.start()) for x in parts[:-1] if x]
                t = parts[-1]
            out.append((hit[0], hit[1], m.start()) if hit else (t, 0, m.start()))
        return out

    def matches(self, toks: list[tuple[str, int, int]]) -> Iterator[tuple[tuple[str, ...], list, int, int]]:
        """(term, what it says, misspellings, place) of every term in the window."""
        for i in range(len(toks)):
            node, off = self.tree.get(toks[i][0]), 0
            j = i
            while node is not None:
                off += toks[j][1]
                if None in node:
                    yield (*node[None], off, toks[i][2])
                j += 1
                node = node.get(toks[j][0]) if j < len(toks) else None

    def features(self, window: str) -> tuple[dict[str, float], dict[str, dict[str, float]]] | None:
        """Weight of the terms and the context by kind; None where there is no term. A term counts
        once; learned ones count ``LEARNED`` together at most, as they often are parts of one."""
        low = fold(window)
        toks = self.tokens(low)
        spans = [m.span() for m in _QUOTED.finditer(low)]
        once: dict[tuple[str, tuple[str, ...], bool], tuple[float, bool]] = {}
        for t, says, off, at in self.matches(toks):
            q = any(a <= at < b for a, b in spans)
            for k, w, own in says:
                x = w * (1.0 if off == 0 else 0.8)
                if x > once.get((k, t, own), (0.0, False))[0]:
                    once[k, t, own] = x, q
        if not once:
            return None
        mass, learned = dict.fromkeys(KINDS, 0.0), dict.fromkeys(KINDS, 0.0)
        for (k, _, own), (x, q) in once.items():
            (mass if own else learned)[k] += x * (QUOTED if q else 1.0)
        for k in KINDS:
            mass[k] += min(learned[k], LEARNED)
        total = sum(x for x, _ in once.values())
        words = {t for t, _, _ in toks}
        context = {
            "you": float(not words.isdisjoint(YOU) or _YOU_UNSPACED.search(low) is not None), "people": float(not words.isdisjoint(PEOPLE)), "quoted": sum(x for x, q in once.values() if q) / total,
            "said": float(not words.isdisjoint(SAID)), "rules": float(not words.isdisjoint(RULES)), "capital": float(re.search(r"(?<=[a-z,;:] )[A-Z][a-z]{2,}|^\W*[A-Z][a-z]{2,} (?:is|are|ought|should|deserve)\b", window) is not None),
        }
        return mass, {k: context | {"technical": float(not words.isdisjoint(TECHNICAL[k]))} for k in KINDS}

    def odds(self, kind: str, mass: float, context: dict[str, dict[str, float]]) -> float:
        m = self.model
        return m.bias[kind] + m.slope[kind] * min(mass, MOST) + sum(m.context[kind][c] * x for c, x in context[kind].items())

    def window(self, window: str) -> dict[str, float]:
        """How likely the window is a case of each kind."""
        f = self.features(window)
        if f is None:
            return dict.fromkeys(KINDS, 0.0)
        mass, context = f
        return {k: 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, self.odds(k, mass[k], context))))) if mass[k] else 0.0 for k in KINDS}

    def anchored(self, tokens: set[str]) -> bool:
        """Whether one of the tokens is, or nearly is, a term's rarest word."""
        word, anchors, cold = self.word, self.anchors, self.cold
        for t in tokens - cold:
            hit = word(t)
            if hit is not None and hit[0] in anchors:
                return True
            if "'" in t or "’" in t:
                hit = word(re.split("['’]", t)[-1])
                if hit is not None and hit[0] in anchors or any(p in anchors for p in re.split("['’]", t)[:-1]):
                    return True
            if len(cold) > self.KEPT:
                cold.clear()
            cold.add(t)
        return False

    def readable(self, text: str) -> str | None:
        """The text without markup and with spelt-out words in one piece, or None where no window
        of it can have a term."""
        marked = any(c in text for c in "<&[{_`\\") or "*" in text or "''" in text
        if marked and _PARTED.search(text):
            text, marked = scan(text)[1], False
        low = fold(text)
        raw = _distinct(low)
        spelt = len(raw & _ONE if low.isascii() else [t for t in raw if len(t) == 1]) > 2 and _SPELT.search(text) is not None
        other = not low.isascii() and _SCRIPT.search(low) is not None
        if not (spelt or other or self.anchored(raw)):
            return None
        if marked:
            text = scan(text)[1]
        return _SPELT.sub(self.joined, text) if spelt else text

    def text(self, text: str | None) -> tuple[float, float, float]:
        plain = self.readable(text) if text else None
        top = dict.fromkeys(KINDS, 0.0)
        for part in _sentences(plain) if plain else ():
            low = fold(part)
            if not (self.anchored(_distinct(low)) or not low.isascii() and _SCRIPT.search(low)):
                continue
            for k, x in self.window(part).items():
                top[k] = max(top[k], x)
        return tuple(round(top[k], 3) for k in KINDS)  # type: ignore[return-value]


def _sentences(text: str) -> Iterator[str]:
    at = 0
    for m in _END.finditer(text):
        if m.end() - at > 1:
            yield re.sub(r"\s+", " ", text[at : m.end()])
        at = m.end()
    if at < len(text):
        yield re.sub(r"\s+", " ", text[at:])



# --- fitting -------------------------------------------------------------------------------------
def _llr(a: float, b: float, n: float, m: float) -> float:
    """Twice the log likelihood ratio of ``a`` in ``n`` against ``b`` in ``m``; negative where it
    is less than expected."""

    def part(x: float, e: float) -> float:
        return x * math.log(x / e) if x else 0.0

    p = (a + b) / (n + m)
    if p in (0.0, 1.0):
        return 0.0
    got = 2 * (part(a, n * p) + part(n - a, n * (1 - p)) + part(b, m * p) + part(m - b, m * (1 - p)))
    return got if a / n > b / m else -got


_COMMON = YOU | PEOPLE | SAID | RULES | frozenset().union(*TECHNICAL.values())


def _grams(words: list[str], names: frozenset[str] = frozenset()) -> set[tuple[str, ...]]:
    """What may be learned: runs of words with a long one that is no context, and without names."""
    got = (tuple(words[i : i + n]) for n in range(1, LONGEST + 1) for i in range(len(words) - n + 1))
    return {g for g in got if any(len(w) > 3 and w not in _COMMON for w in g) and not any(w in names for w in g)}


def _names(texts: list[list[str]]) -> frozenset[str]:
    """Words that stand with a capital nearly always: names of persons, places and peoples, which
    are never learned as terms."""
    upper, lower = Counter(), Counter()
    for ws in texts:
        for w in ws:
            for m in re.finditer(r"[^\W\d_]+", w):
                (upper if m.group()[:1].isupper() and m.group()[1:].islower() else lower)[m.group().lower()] += 1
    return frozenset(w for w, n in upper.items() if n > 4 * lower[w])


def _logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Weights of the greatest posterior under independent normal priors (Newton steps, halved
    until they lead down)."""

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float(np.sum(np.logaddexp(0, z) - y * z) + np.sum(((b - prior) / spread) ** 2) / 2)

    b, now = prior.copy(), loss(prior)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (p - y) + (b - prior) / spread**2
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(1 / spread**2), g)
        size = 1.0
        while size > 1e-4 and loss(b - size * step) > now:
            size /= 2
        b = b - size * step
        last, now = now, loss(b)
        if last - now < 1e-6 * (1 + abs(now)):
            break
    return b


def fit(judged: list[tuple[str, frozenset[str]]], lexicon: dict[str, dict[str, float]] | None = None) -> Model:
    """The model for a sample of (text, kinds), which is all that is held at once. Expressions that
    stand in texts of a kind and hardly in those free of all become terms, the heavier the more
    telling; then bias, slope and context are moved from their hand-set values as far as the
    sample asks. A text speaks by its worst window, one free of a kind by all of its windows."""
    base = lexicon_model(lexicon)
    start = Scorer(base)
    near: Counter[str] = Counter()
    docs: list[tuple[list[str], frozenset[str]]] = []
    for text, kinds in judged:
        plain = scan(text)[1] if text else ""
        if not kinds:
            near.update({t for t in set(_TOKEN.findall(fold(plain))) if (start.word(t) or ("", 0))[1]})
        docs.append((list(_sentences(_SPELT.sub(start.joined, plain))), kinds))
    base = Model(base.terms, plain=frozenset(t for t, n in near.items() if n >= 2))
    free = [i for i, (_, kinds) in enumerate(docs) if not kinds]
    if not free or len(free) == len(docs):
        return base
    s = Scorer(base)
    names = _names([ws for ws, _ in docs])
    words = [[[h[0] if (h := s.word(t)) else t for t in _TOKEN.findall(fold(w))] for w in ws] for ws, _ in docs]
    often = Counter(t for i in free for t in set().union(*words[i]))
    grams = [{g for w in words[i] for g in _grams(w, names)} if kinds else set() for i, (_, kinds) in enumerate(docs)]
    told = Counter(g for gs in grams for g in gs)
    # one of ordinary words alone tells nothing
    may = {g for g, c in told.items() if c >= SEEN and min(often[w] for w in g) <= RARE * len(free)}
    begin = {g[0] for g in may}
    common: Counter[tuple[str, ...]] = Counter()
    for i in free:
        runs = (tuple(w[j : j + n]) for w in words[i] for j, t in enumerate(w) if t in begin for n in range(1, LONGEST + 1))
        common.update(set(runs) & may)

    learned: dict[str, dict[tuple[str, ...], float]] = {}
    for k in KINDS:
        mine = [i for i, (_, kinds) in enumerate(docs) if k in kinds]
        n = Counter(g for i in mine for g in grams[i] & may)
        sure = {g: c for g, c in n.items() if c >= SEEN and c >= PURE * common[g] and g not in base.terms[k] and _llr(c, common[g], len(mine), len(free)) >= SURE}
        # of those that say the same the shortest stays
        own = {g for g in sure if not any(h in sure and sure[h] <= sure[g] * 1.2 for h in _grams(list(g)) if len(h) < len(g))}
        learned[k] = {g: min(0.9, 0.15 * math.log((sure[g] + 0.5) * len(free) / (common[g] + 0.5) / len(mine))) for g in own}
    held = {w for k in KINDS for t in [*base.terms[k], *learned[k]] for w in t}
    model = Model(base.terms, learned, plain=base.plain, common={w: often[w] for w in held})

    s = Scorer(model)
    seen = [[f for w in ws if (f := s.features(w)) is not None] for ws, _ in docs]
    context, bias, slope = {}, {}, {}
    for k in KINDS:
        rows, y = [], []
        for fs, (_, kinds) in zip(seen, docs):
            fs = [f for f in fs if f[0][k]]
            if k in kinds and fs:
                fs = [max(fs, key=lambda f: s.odds(k, f[0][k], f[1]))]  # noqa: B023
            for mass, ctx in fs:
                rows.append([*(ctx[k][c] for c in CONTEXT), min(mass[k], MOST), 1.0])
                y.append(float(k in kinds))
        prior = np.array([*(PRIOR[k][c] for c in CONTEXT), SLOPE, BIAS])
        b = prior
        x, t = np.array(rows), np.array(y)
        for _ in range(ROUNDS if rows else 0):
            # judgements that the model so far finds all but impossible are taken for slips
            p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
            keep = np.abs(p - t) < SLIP
            b = _logistic(x[keep], t[keep], prior, np.array([1.0] * len(CONTEXT) + [1.0, 0.5]))
        context[k], slope[k], bias[k] = dict(zip(CONTEXT, map(float, b))), float(b[-2]), float(b[-1])
    return Model(base.terms, learned, context, bias, slope, base.plain, model.common)


_SCORES = T.StructType([T.StructField(k, T.DoubleType()) for k in KINDS])


def scored(df: DataFrame, text: str, model: Model | None = None) -> DataFrame:
    """``df`` with a score of each kind (columns of these names are replaced)."""

    @F.pandas_udf(_SCORES)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        s = Scorer(model)
        for b in batches:
            yield pd.DataFrame([s.text(t) for t in b], columns=list(KINDS))

    keep = [c for c in df.columns if c not in KINDS and c != "_s"]
    return df.withColumn("_s", score(F.col(text))).select(*[F.col(f"`{c}`") for c in keep], *[F.col(f"_s.{k}") for k in KINDS])


def cases(scores: DataFrame, key: str) -> DataFrame:
    """(``key``, ``kind``) of every score of ``CASE`` and more."""
    kinds = F.filter(F.array(*[F.when(F.col(k) >= CASE, F.lit(k)) for k in KINDS]), lambda x: x.isNotNull())
    return scores.select(key, F.explode(kinds).alias("kind"))


def rates(scores: DataFrame, by: str) -> DataFrame:
    """Documents and the share of each kind per ``by``."""
    return scores.groupBy(by).agg(F.count("*").alias("documents"), *[F.avg((F.col(k) >= CASE).cast("int")).alias(f"{k}_rate") for k in KINDS])
