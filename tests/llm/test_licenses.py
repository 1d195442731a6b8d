"""License scans: edge texts, and the three filters against a plain loop."""

from __future__ import annotations

import random
import re

from sparge.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow(text, phrases, templates, containment):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places = [(i, label) for p, label in phrases.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    step, best, labels = licenses.BLOCK_STEP, 0.0, {label for _, label in places}
    for s in range(0, max(1, len(words)), step):
        block = set(words[s : s + 2 * step])
        for label, texts in templates.items():
            for t in texts:
                share = len(block & set(t.split())) / len(set(t.split()))
                if share >= containment - 1e-9:
                    labels.add(label)
                    best = max(best, share)
    starts = [i for i, _ in places]
    return (
        len(words), len(starts), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({label for _, label in places})), ",".join(sorted(labels)), 1.0 if starts else best,
    )


def check(spark, texts, phrases=licenses.PHRASES, templates=licenses.TEMPLATES, containment=licenses.CONTAINMENT):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, line string, word int")
    got = {r.doc_id: tuple(r)[1:] for r in licenses.scan(docs, phrases, templates, containment).collect()}
    assert got == {i: slow(t, phrases, templates, containment) for i, t in enumerate(texts)}


def test_edges(spark):
    check(spark, [
        None, "", " .,\n", "MIT License", "the MIT license; mit LICENSE.", "mit licenses", "éMIT license", "İMIT license",
        "mit\n\nlicense mit license apache  license General-Public_License", "x " * 500 + "mit license" + " y" * 500,
        "Licensed under CC BY-NC 4.0.", "word " * 40 + "permission is granted free of charge to any person obtaining a copy of software",
        "redistribution and use in source and binary forms, with or without changes, are permitted provided that",
    ])


def test_filters_lose_nothing(spark):
    dice = random.Random(5)
    some = [f"w{i}" for i in range(30)]
    templates = {f"t{i}": (" ".join(dice.sample(some, dice.randint(1, 9))),) for i in range(12)}
    texts = [" ".join(dice.choices(some, k=dice.randint(0, 150))) for _ in range(60)]
    for containment in (0.5, 0.8, 1.0):
        check(spark, texts, {"w1 w2": "a", "w3 w4 w3": "b"}, templates, containment)


def test_repeated_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "mit license")] * 3 + [(None, "mit license")], "doc_id long, text string")
    assert licenses.scan(docs).count() == 4
    assert licenses.scan(docs.limit(0)).count() == 0


def test_long_templates(spark):
    """Templates of any length match wherever they stand, and leave what short ones match as it is."""
    dice = random.Random(9)
    long = {n: [f"l{n}x{i}" for i in range(n)] for n in (24, 25, 40, 130, 700)}
    templates = {f"t{n}": (" ".join(w),) for n, w in long.items()} | {"short": ("s1 s2 s3 s4 s5",)}
    rows, want = [], []
    for n, words in long.items():
        for before in (0, 1, 23, 24, 37, 300):
            some = [w for i, w in enumerate(words) if i % 6]
            held = dice.choice([words, some])
            rows.append(" ".join([*["x"] * before, *held, *["y"] * 50]))
            want.append((f"t{n}", len(held) / n))
        rows.append(" ".join(["x", *words[: n // 2]]))
        want.append(("", 0.0))
    rows += ["s1 s2 s3 " + "x " * 60 + "s4 s5", "s1 s2 s3 " + "x " * 30 + "s4"]
    want += [("", 0.0), ("short", 0.8)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id int, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(docs, {"no such phrase": "p"}, templates).collect()}
    assert got == dict(enumerate(want))
