"""Filter audit: against a loop over all orders; nulls, repeats, clashing columns, empty tables."""

from __future__ import annotations

import random
from collections import Counter
from itertools import permutations

from sparge.llm.filter_audit import audit

SHAPE = "doc_id long, text string, lang string, part string, mask int, good string"


def brute_force(docs: list[tuple], labels: list[tuple]) -> dict:
    least, good, toxic = {}, set(), set()
    for i, text, *_ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    for i, quality, poison in labels:
        good |= {i} if quality == 1 else set()
        toxic |= {i} if poison == 1 else set()
    out: dict = {}
    for i, text, lang, *_ in docs:
        text = text or ""
        words = [w for w in text.translate({c: 32 for c in (9, 10, 11, 12, 13)}).split(" ") if w]
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text), "D": any(c in "#$%&*|" for c in text),
            "E": i is not None and text in least and least[text] < i,
        }
        for order in permutations("ABCDE"):
            gone = False
            for step, letter in enumerate(order, 1):
                row = out.setdefault((lang or "", "".join(order), step), Counter())
                hit = fails[letter] and not gone
                row["redundant"] += fails[letter] and gone
                row["unique_fails"] += [k for k, v in fails.items() if v] == [letter]
                row["removed"] += hit
                row["good_lost"] += hit and i is not None and i in good
                row["toxic_lost"] += hit and i is not None and i in toxic
                gone |= fails[letter]
                row["kept"] += not gone
    shapley = Counter()
    for (part, order, step), row in out.items():
        shapley[part, order[step - 1]] += row["removed"]
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    return {k: (*[int(v[n]) for n in names], shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_against_brute_force(spark):
    dice = random.Random(5)
    words = ["a", "B", "co$t", "É", "x|y", " ", "Zz", "und", "\x0bq"]
    texts = [None, "", " \t", "A" * 9 + "b" * 81, "A" * 9 + "é" * 80]
    texts += [dice.choice(" \n").join(dice.choice(words) + str(dice.randrange(dice.choice((3, 400)))) for _ in range(dice.choice((3, 99, 100, 180)))) for _ in range(40)]
    docs = [(dice.choice((None, *range(60))), dice.choice(texts), dice.choice((None, "", "en", "de")), "p", 9, "g") for _ in range(160)]
    docs += docs[:20]
    labels = [(dice.randrange(60), dice.choice((0, 1, None)), dice.choice((0, 1, None)), "x") for _ in range(70)] + [(None, 1, 1, "x")]
    found = audit(
        spark.createDataFrame(docs, SHAPE).repartition(5), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, part string")
    )
    want = brute_force(docs, [r[:3] for r in labels])
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in found.collect()} == want
    assert len(want) == 3 * 600


def test_empty_and_unlabelled(spark):
    docs = spark.createDataFrame([(1, "x", "en", "", 0, "")], SHAPE)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit(docs.limit(0), labels).count() == 0
    assert audit(docs, labels).filter("removed = 1 AND good_lost = 0").count() == 120
