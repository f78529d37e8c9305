"""Reading level by a familiar-word formula.

Words are graded by the share of the corpus's documents that hold them; each cut-off
gives one high-frequency list, and a text's grade is a linear formula of the shares of
its words outside each list and its average sentence length:

    grade = c0 + sum_k w_k * outside_k + b * words per sentence

The document frequencies cover every English document. The weights are fitted to a
bounded sample of graded texts (``max_labels``, documented below), by ridge regression
whose strength is chosen by cross-validation. A word is a run of letters and
apostrophes. Null texts and texts without a word have no grade.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm.sentences import spans
from foliant.session import written

# over lower-case text; spelt as what is no letter, which matches faster than the classes
_NO = "\\x00-\\x26\\x28-`{-¿×÷‐-‘“-⁯　-〿！-｠٠-٩۰-۹،؛؟।॥०-९๐-๙"
_WORD = re.compile(f"[^'’{_NO}][^{_NO}]*")
JAVA_WORD = r"\p{L}[\p{L}'’]*"
# English function words; a text is English if their share reaches ENGLISH.
FUNCTION_WORDS = "the of and to in is that it for be by at on or not if with as this will must may should can each do".split()
_FUNCTION = frozenset(FUNCTION_WORDS)
ENGLISH = 0.12
#: Upper grades of bands 1 to 3.
BANDS = (5.0, 9.5, 14.5)
#: The lists' cut-offs: document shares from LEAST up, each STEP times the one before.
LEAST, STEP = 0.02, 1.05
CUTS = tuple(float(LEAST * STEP**i) for i in range(int(np.log(0.7 / LEAST) / np.log(STEP)) + 1))
#: At most so many graded texts are used for the fit.
MAX_LABELS = 5000


def words(text: str) -> list[str]:
    """Lower-case words of the text."""
    return _WORD.findall(text.lower())


def is_english(ws: list[str]) -> bool:
    return len(ws) > 0 and list(map(_FUNCTION.__contains__, ws)).count(True) >= ENGLISH * len(ws)


def frequent_words(texts: DataFrame, col: str = "text", least: float = LEAST) -> dict[str, float]:
    """Words in at least a share ``least`` of the English texts, with their shares.

    Every text counts; each task adds up its own words before the shuffle. What reaches
    the driver is bounded: the shares add up to the mean number of distinct words per
    text, so no more than that mean divided by ``least`` words can qualify.
    """

    def frame(n: Counter[str]) -> pd.DataFrame:
        return pd.DataFrame({"w": pd.Series(list(n), dtype=object), "n": pd.Series(list(n.values()), dtype="int64")})

    def count(batches):
        n: Counter[str] = Counter()
        for b in batches:
            for t in b["t"]:
                ws = words(t)
                if is_english(ws):
                    n.update(set(ws))
                    n[""] += 1
            if len(n) > 1_000_000:
                yield frame(n)
                n.clear()
        yield frame(n)

    schema = T.StructType([T.StructField("w", T.StringType()), T.StructField("n", T.LongType())])
    df = written(texts.where(F.col(col).isNotNull()).select(F.col(col).alias("t")).mapInPandas(count, schema).groupBy("w").agg(F.sum("n").alias("n")))
    # the empty word counts the texts
    total = df.where(F.col("w") == "").agg(F.max("n")).first()[0] or 0
    return {r.w: r.n / total for r in df.where((F.col("w") != "") & (F.col("n") >= least * total)).collect()}


class _Rated(dict):
    """Weights of the listed words; any other has ``rare`` and isn't kept."""

    def __init__(self, weight: dict[str, float], rare: float) -> None:
        super().__init__(weight)
        self.rare = rare

    def __missing__(self, word: str) -> float:
        return self.rare


@dataclass(frozen=True)
class Formula:
    """``weight`` of each listed word (the sum over the lists that hold it not), ``rare``
    of any other, ``pace`` of a word per sentence."""

    weight: dict[str, float]
    rare: float
    pace: float

    def grade(self, text: str | None) -> float | None:
        ws = words(text) if text else []
        if not ws:
            return None
        n = len(ws)
        return sum(map(_Rated(self.weight, self.rare).__getitem__, ws)) / n + self.pace * n / max(1, len(spans(text)) // 2)


def features(text: str, tier: dict[str, int]) -> np.ndarray:
    """Shares of the words by tier (0: outside every list) and words per sentence."""
    ws = words(text)
    v = np.zeros(len(CUTS) + 2)
    for w in ws:
        v[tier.get(w, 0)] += 1
    v /= max(1, len(ws))
    v[-1] = len(ws) / max(1, len(spans(text)) // 2)
    return v


def tiers(shares: dict[str, float]) -> dict[str, int]:
    return {w: int(np.searchsorted(CUTS, s, side="right")) for w, s in shares.items()}


def fit(shares: dict[str, float], graded: list[tuple[float, list[str]]]) -> Formula:
    """The formula from (grade, texts whose mean grade it is). Tiers add to 1, which stands for
    the constant. The regression starts from the classic formula for new texts, with words at
    share 0.1 and more as the familiar ones, and moves from it as far as the graded texts bear."""
    tier = tiers(shares)
    at = int(np.searchsorted(CUTS, 0.1))
    start = np.r_[[15.79 + 3.6365] * (at + 1), [0.0] * (len(CUTS) - at), 0.0496]
    start[:-1] += 0.5
    w = start
    if graded:
        x = np.array([np.mean([features(t, tier) for t in ts], axis=0) for _, ts in graded])
        y = np.array([g for g, _ in graded]) - x @ start
        fold = np.arange(len(y)) % 5

        def solve(x_, y_, lam):
            return np.linalg.solve(x_.T @ x_ + lam * max(1, len(x_)) * np.eye(x_.shape[1]), x_.T @ y_)

        def error(x_, lam):
            return sum(np.abs(x_[fold == k] @ solve(x_[fold != k], y[fold != k], lam) - y[fold == k]).sum() for k in range(5))

        # few graded texts bear few lists: neighbouring tiers may share a weight
        shared = [np.r_[np.arange(len(CUTS) + 1) // g, [len(CUTS) // g + 1]] for g in (1, 2, 4, 8, 16)]
        merges = [np.eye(m.max() + 1)[m] for m in shared]
        _, i, lam = min((error(x @ m, lam), i, lam) for i, m in enumerate(merges) for lam in (1e-6, 1e-5, 1e-4, 1e-3, 1e-2, 1e-1))
        w = start + merges[i] @ solve(x @ merges[i], y, lam)
    return Formula({k: float(w[t]) for k, t in tier.items()}, float(w[0]), float(w[-1]))


def band_of(grade: float | None) -> int | None:
    return None if grade is None else 1 + sum(grade > b for b in BANDS)


_OUT = T.StructType([T.StructField("words", T.IntegerType()), T.StructField("english", T.BooleanType()), T.StructField("grade", T.DoubleType())])


def graded(df: DataFrame, col: str, formula: Formula, least_words: int, only_english: bool = False) -> DataFrame:
    """``df`` with ``words``, ``english`` and ``grade`` (null under ``least_words``, and with
    ``only_english`` where the text is in another language)."""
    held = df.sparkSession.sparkContext.broadcast(formula)

    @F.pandas_udf(_OUT)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        f = held.value
        rate, pace = _Rated(f.weight, f.rare).__getitem__, f.pace
        for s in batches:
            rows = []
            for t in s:
                ws = words(t) if t else []
                n = len(ws)
                known = is_english(ws)
                if n < max(1, least_words) or only_english and not known:
                    rows.append((n, known, None))
                else:
                    rows.append((n, known, sum(map(rate, ws)) / n + pace * n / max(1, len(spans(t)) // 2)))
            yield pd.DataFrame(rows, columns=["words", "english", "grade"])

    keep = [c for c in df.columns if c not in ("words", "english", "grade", "_g")]
    return df.withColumn("_g", score(F.col(col))).select(*[F.col(f"`{c}`") for c in keep], "_g.words", "_g.english", "_g.grade")


def band(col: Column) -> Column:
    out = F.lit(1)
    for i, b in enumerate(BANDS):
        out = F.when(col > b, F.lit(i + 2)).otherwise(out)
    return F.when(col.isNotNull(), out)
