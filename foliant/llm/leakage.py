"""Evaluation texts that leak into a corpus.

Texts become words (letter case, punctuation, white space and markup gone). Winnowing
keeps, of every ``WINDOW`` successive hashes of ``GRAM`` words, the least; two texts
that share ``GRAM + WINDOW - 1`` running words therefore share a kept hash. A passage
of 15 words with at most one in six changed leaves at least two such hits near one
diagonal; every such diagonal is extended by alignment and judged exactly. Where items
of fewer words are held, every hash of a text counts, and those of one or two words are
looked up as they are.

The items are a bounded table that every task holds: if it is larger than
``MAX_HASHES`` hashes, it is held in blocks, one pass over the corpus each. The corpus
is never shuffled, and no pair of documents is formed.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm.markup import scan

GRAM, WINDOW = 3, 2
#: Least running words of a passage, and how many words stand to one change.
LEAST, PER_EDIT = 15, 6
#: Hashes held at once by a task (about 100 bytes each).
MAX_HASHES = 1_000_000
_TOKEN = re.compile(r"[^\W_]+")
_MARKED = re.compile(r"[<&`~\\$|*_\[{=]|''")
_MASK = (1 << 64) - 1


def tokens(text: str | None) -> list[str]:
    """Lower-case words of the text without markup (formulas count as markup)."""
    if not text:
        return []
    if _MARKED.search(text):
        text = scan(text, formulas=False)[1]
    return _TOKEN.findall(text.lower())


class Hashes(dict):
    """64-bit hashes of words, kept for the words seen (up to ``KEPT``)."""

    KEPT = 500_000

    def __missing__(self, word: str) -> int:
        h = 14695981039346656037
        for b in word.encode():
            h = ((h ^ b) * 1099511628211) & _MASK
        h ^= h >> 29
        if len(self) >= self.KEPT:
            self.clear()
        self[word] = h
        return h


def grams(ws: list[str], memo: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of every run of ``GRAM`` words."""
    n = len(ws) - GRAM + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = np.fromiter(map(memo.__getitem__, ws), np.uint64, len(ws))
    g = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(GRAM):
            g = g * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n]
        g ^= g >> np.uint64(31)
        g *= np.uint64(0xBF58476D1CE4E5B9)
        g ^= g >> np.uint64(32)
    return np.arange(n), g


def winnow(ws: list[str], memo: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes kept by winnowing (the right-most least of each window)."""
    _, g = grams(ws, memo)
    n = len(g)
    if n == 0:
        return np.empty(0, np.int64), g
    if n < WINDOW:
        return np.array([int(np.argmin(g))]), g[[int(np.argmin(g))]]
    keep = np.zeros(n, bool)
    views = np.lib.stride_tricks.sliding_window_view(g, WINDOW)
    keep[np.arange(n - WINDOW + 1) + WINDOW - 1 - np.argmin(views[:, ::-1], axis=1)] = True
    at = np.flatnonzero(keep)
    return at, g[at]


@dataclass
class Index:
    ids: list[str]
    texts: list[list[str]]
    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray
    vocabulary: frozenset[str]
    least: int
    #: Items under ``LEAST`` words are in it, so that every hash of a text counts; and those
    #: under ``GRAM`` words, by their words.
    short: bool
    tiny: dict[tuple[str, ...], list[int]]


def build(items: list[tuple[str, str]]) -> Index:
    memo = Hashes()
    texts = [tokens(t) for _, t in items]
    hs, it, pl = [], [], []
    tiny: dict[tuple[str, ...], list[int]] = defaultdict(list)
    for k, ws in enumerate(texts):
        if 0 < len(ws) < GRAM:
            tiny[tuple(ws)].append(k)
        # a short item's runs between changes may be of one hash
        at, h = winnow(ws, memo) if len(ws) >= LEAST else grams(ws, memo)
        hs.append(h)
        it.append(np.full(len(h), k))
        pl.append(at)
    h = np.concatenate(hs) if hs else np.empty(0, np.uint64)
    order = np.argsort(h, kind="stable")
    cat = lambda x: np.concatenate(x)[order] if x else np.empty(0, np.int64)
    return Index([i for i, _ in items], texts, h[order], cat(it), cat(pl), frozenset(w for ws in texts for w in ws), min(map(_least_words, filter(None, texts)), default=0), any(len(ws) < LEAST for ws in texts), dict(tiny))


def _least_words(ws: list[str]) -> int:
    """Different words of the item that any text which repeats it long enough must hold.
    Some ``LEAST`` running words of a passage have at most two changes more than their share:
    a passage of 24 to 29 words can have its four changes in every such stretch, a longer one
    holds two stretches apart, and the one with fewer changes has three at most."""
    n = min(len(ws), LEAST)
    return min(len(set(ws[i : i + n])) for i in range(len(ws) - n + 1)) - n // PER_EDIT - 2


def longest(a: list[str], b: list[str]) -> int:
    """Words of ``a`` in a long passage that ``b`` repeats in order with at most one change in
    ``PER_EDIT`` words (a replaced, added, dropped or misspelt word is one).

    A least-cost alignment lets ``b``'s ends go free; along its path a word counts 1, a
    change ``-PER_EDIT``, and the longest stretch with a sum of 0 or more that begins and ends
    with a match is taken. What it finds is there; another path may hold more (``repeats``)."""
    n, m = len(a), len(b)
    differ, steps_ = _differ(a, b), np.arange(m + 1)
    cost = np.zeros((n + 1, m + 1), np.int64)
    for i in range(1, n + 1):
        row = cost[i - 1] + 1
        row[1:] = np.minimum(row[1:], cost[i - 1, :-1] + differ[i - 1])
        cost[i] = np.minimum.accumulate(row - steps_) + steps_
    j = int(cost[n].argmin())
    i, steps = n, []
    while i > 0:
        here = cost[i][j]
        if j and here == cost[i - 1][j - 1] + differ[i - 1][j - 1]:
            steps.append((1, not differ[i - 1][j - 1]))
            i, j = i - 1, j - 1
        elif here == cost[i - 1][j] + 1:
            steps.append((1, False))
            i -= 1
        elif j:
            steps.append((0, False))
            j -= 1
        else:
            break
    best = 0
    seen: list[tuple[int, int]] = []  # (sum, words) before a match, sums falling
    s = w = 0
    for of_a, same in steps:
        if same and (not seen or s < seen[-1][0]):
            seen.append((s, w))
        s += of_a if same else of_a - PER_EDIT
        w += of_a
        if not same:
            continue
        # the earliest start with a sum not above this one
        lo, hi = 0, len(seen)
        while lo < hi:
            mid = (lo + hi) // 2
            if seen[mid][0] <= s:
                hi = mid
            else:
                lo = mid + 1
        if lo < len(seen):
            best = max(best, w - seen[lo][1])
    return best


def _differ(a: list[str], b: list[str]) -> np.ndarray:
    code: dict[str, int] = {}
    x = np.fromiter((code.setdefault(w, len(code)) for w in a), np.int64, len(a))
    y = np.fromiter((code.get(w, -1) for w in b), np.int64, len(b))
    return x[:, None] != y[None, :]


def repeats(a: list[str], b: list[str], need: int) -> bool:
    """Whether ``b`` repeats at least ``need`` running words of ``a`` with at most one change in
    ``PER_EDIT``, the first and the last of them unchanged: the least cost of every stretch of
    ``a`` anywhere in ``b``."""
    n, m = len(a), len(b)
    differ, places = _differ(a, b), np.arange(m + 1)
    never = n + m
    # least changes of the stretch from each word on, by its end in b; its first word is a match
    cost = np.full((n, m + 1), never, np.int64)
    cost[:, 1:][~differ] = 0
    for t in range(1, n + 1):
        k = n - t + 1
        if t > 1:
            before, new = cost[:k], differ[t - 1 : t - 1 + k]
            match = np.where(new, never, before[:, :-1])
            row = before + 1
            row[:, 1:] = np.minimum(row[:, 1:], before[:, :-1] + new)
        else:
            match, row = cost[:, 1:], cost
        cost = np.minimum.accumulate(row - places, axis=1) + places
        if t >= need and int(match.min()) * PER_EDIT <= t:
            return True
    return False


def covered(a: list[str], b: list[str]) -> int:
    """Words of ``a`` that lie in a run of ``GRAM`` and more which ``b`` holds too."""
    e = ~_differ(a, b)
    n, m = e.shape
    if n < GRAM or m < GRAM:
        return 0
    run = np.ones((n - GRAM + 1, m - GRAM + 1), bool)
    for k in range(GRAM):
        run &= e[k : n - GRAM + 1 + k, k : m - GRAM + 1 + k]
    at = run.any(axis=1)
    hold = np.zeros(n, bool)
    for k in range(GRAM):
        hold[k : n - GRAM + 1 + k] |= at
    return int(hold.sum())


def leaks(ws: list[str], ix: Index, memo: Hashes) -> list[int]:
    """Numbers of the items that the words repeat wholly or in a long enough passage."""
    if not (len(ix.hashes) or ix.tiny) or len(ix.vocabulary.intersection(ws)) < ix.least:
        return []
    at, h = grams(ws, memo) if ix.short else winnow(ws, memo)
    lo = np.searchsorted(ix.hashes, h, "left")
    hi = np.searchsorted(ix.hashes, h, "right")
    near: dict[int, list[int]] = defaultdict(list)
    for k in np.flatnonzero(hi > lo):
        for e in range(lo[k], hi[k]):
            near[int(ix.item[e])].append(int(at[k]) - int(ix.place[e]))
    out = []
    if ix.tiny:
        for n in {len(t) for t in ix.tiny}:
            for t in {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)} & ix.tiny.keys():
                out += ix.tiny[t]
    for item, diagonals in near.items():
        a = ix.texts[item]
        n = len(a)
        drift = n // PER_EDIT + 1
        need = min(n, LEAST)
        # what is left in runs of GRAM if the changes fall as badly as they can
        rest = min(k - GRAM * (k // PER_EDIT) for k in range(need, n + 1))
        diagonals.sort()
        i = 0
        while i < len(diagonals):
            d = diagonals[i]
            j = i
            while j < len(diagonals) and diagonals[j] <= d + 2 * drift:
                j += 1
            if j - i >= (2 if n >= LEAST else 1):
                part = ws[max(0, d - drift) : d + n + 2 * drift]
                if covered(a, part) >= rest and (longest(a, part) >= need or repeats(a, part, need)):
                    out.append(item)
                    break
            while i < len(diagonals) and diagonals[i] <= d + drift:
                i += 1
    return out


def leaked(docs: DataFrame, items: DataFrame, doc_id: str, text: str, item_id: str, item_text: str) -> DataFrame:
    """Distinct (``doc_id``, ``item_id``): the document repeats the whole item or at least
    ``LEAST`` running words of it. Null texts give nothing; repeated rows count once."""
    spark = docs.sparkSession

    def blocks() -> Iterator[list[tuple[str, str]]]:
        """Items as they come to the driver, a block at a time; one empty block without any."""
        block: list[tuple[str, str]] = []
        size = 0
        for r in items.select(item_id, item_text).where(F.col(item_text).isNotNull()).distinct().orderBy(item_id, item_text).toLocalIterator():
            n = len(r[1]) // 4 + 1
            if size + n > MAX_HASHES and block:
                yield block
                block, size = [], 0
            block.append((r[0], r[1]))
            size += n
        yield block

    schema = T.StructType([T.StructField(doc_id, docs.schema[doc_id].dataType), T.StructField(item_id, items.schema[item_id].dataType)])
    out: DataFrame | None = None
    for block in blocks():
        held = spark.sparkContext.broadcast(build(block))

        def find(batches, held=held):
            memo = Hashes()
            ix = held.value
            for pdf in batches:
                ids, found = [], []
                for d, t in zip(pdf[doc_id], pdf[text]):
                    for k in leaks(tokens(t), ix, memo):
                        ids.append(d)
                        found.append(ix.ids[k])
                yield pd.DataFrame({doc_id: pd.Series(ids, dtype=object), item_id: pd.Series(found, dtype=object)})

        got = docs.select(doc_id, text).where(F.col(text).isNotNull()).mapInPandas(find, schema)
        out = got if out is None else out.unionByName(got)
    assert out is not None
    return out.distinct()
