import itertools
import math
import random

import pytest

from foliant.llm import sentences as S

CASES = [
    (["He left at 5 p.m.", "The guard slept."], " "),
    (["Item No. 62 in sec. 2.3.4 covers it.", "J. Q. Brask and A. Venn left."], " "),
    (['She said, "Stop. Wait here. Do not move," and then left.', "We stayed."], " "),
    (["Brask Mfg. Co. should pay.", "Wait… did it rain?", "Yes!"], " "),
    (["Die 4. Gruppe wartet am 3. Mai.", "Kleine Teile, z. B. Schrauben, fehlen.", "„Halt. Nicht weiter!“, rief er."], " "),
    (["« Halte. N’avancez plus ! » cria le garde.", "Voir l’art. 12, p. 40.", "Il dit : « Tout est là. »", "Le pont tient."], " "),
    (["Груз весит прибл. 9,5 т по табл. 3.", "«Стой. Ни шагу!» — крикнул он.", "См. рис. 4 и п. 12."], " "),
    (["哨兵问：“小船在哪里？”", "排长说：“停下。不要动。”然后离开。", "路长3.5公里。"], ""),
    (["小隊長は「止まれ。触るな。」と叫んだ。", "地図を運べ！"], ""),
    (["ยามต้องตรวจเรือตอนเช้า", "ระยะทาง 3.5 กม. และยามต้องเฝ้าเรือ", "พยาบาลควรเก็บเรือ 12 ชิ้นตอนเช้า"], " "),
    (['रसोइया ने कहा, "रुको। मत छुओ।" और चला गया।', "रास्ता 3.5 कि.मी. लंबा है।"], " "),
    (["قال المسعف: «قف. لا تتحرك» ثم غادر.", "هل عد السائق الحبال؟"], " "),
    (['위생병은 "멈춰. 움직이지 마."라고 말했다.', "길이는 3.5 km이다."], " "),
    (["Storage of Fuel", "The pump is off.", "It is late."], "\n\n"),
    (["At noon the convoy\nleft the post.", "No one saw it."], ""),
]


def cut(t):
    s = S.spans(t)
    return [t[s[i] : s[i + 1]] for i in range(0, len(s), 2)]


@pytest.mark.parametrize("want,sep", CASES)
def test_languages(want, sep):
    assert cut(sep.join(want)) == want


def test_every_sign_lies_in_one_span():
    rng = random.Random(2)
    bits = ["Ab", "c", ".", " ", "\n", "\n\n", '"', "“", "”", "!", "3.5", "Mr.", "。", "」", "「", "  ", "ก ข", "- ", "a.m.", "«", "»"]
    for _ in range(3000):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))
        s = S.spans(t)
        assert s == sorted(s)
        inside = set()
        for a, b in zip(s[::2], s[1::2]):
            assert a < b and not t[a].isspace() and not t[b - 1].isspace()
            inside.update(range(a, b))
        assert all(c.isspace() or i in inside for i, c in enumerate(t))
    assert S.spans(None) == S.spans("") == S.spans(" \n ") == []


def test_programme_is_optimal():
    """A block's spans have the best score of all ways to cut it."""
    rng = random.Random(7)
    for _ in range(200):
        t = "".join(rng.choice(["word ", '"', "x" * rng.randint(1, 30) + " "]) for _ in range(rng.randint(4, 14))) + "end"
        ends = sorted(rng.sample(range(1, len(t) - 1), min(6, len(t) - 2)))
        cands = [(e, e, rng.choice([-1.5, -0.5, 0.5, 1.0, 1.4])) for e in ends]
        out = []
        S._block(t, 0, len(t), cands, out)
        quotes = [m.start() for m in S._QUOTE.finditer(t)]
        quotes = quotes[: len(quotes) // 2 * 2]
        odd = lambda p: sum(q < p for q in quotes) & 1

        def score(chosen):
            pts = [(0, 0.0), *chosen, (len(t), 0.0)]
            s = 0.0
            for (a, _), (b, w) in itertools.pairwise(pts):
                s += w - S.LENGTH * abs(math.log((b - a + 10) / 80.0)) - S.UNPAIRED * bool(odd(a) or odd(b))
            return s

        best = max(score(c) for r in range(len(cands) + 1) for c in itertools.combinations([(e, w) for e, _, w in cands], r))
        got = [e for e in out[1::2][:-1]]
        mine = score([(e, w) for e, _, w in cands if e in got])
        assert mine == pytest.approx(best)


def test_long_text_is_fast():
    t = "He said it was so. Then, e.g. at noon, they left (see fig. 3). " * 30000
    assert len(S.spans(t)) == 2 * 60000


def test_exploded(spark):
    df = spark.createDataFrame([(1, "A b. C d."), (2, None), (3, " ")], "k int, t string").select("k", S.sentence_spans("t").alias("spans"))
    got = sorted(tuple(r) for r in df.select("k", S.exploded("spans")).collect())
    assert got == [(1, 1, 0, 4), (1, 2, 5, 9)]
