"""Decontamination against scoring every item for every passage."""

from __future__ import annotations

import numpy as np

from sparge.llm import decontaminate as dc
from sparge.llm.common import words_of
from sparge.llm.queries import op10_decontamination


def brute(items, texts, threshold=dc.THRESHOLD, overlap=dc.OVERLAP):
    """All items against all passages: no bounds, no skipping."""
    index = dc.Index(items)
    terms = {w: t for w, t in index.vocabulary.items()}
    out = []
    for text in texts:
        words, hits = words_of(text), {}
        for s in range(0, max(1, len(words)), index.longest):
            passage = words[s : s + 2 * index.longest]
            there = {terms[w] for w in passage if w in terms}
            for n in range(len(index.ids)):
                score = sum(float(index.impacts[t][list(index.items[t]).index(n)]) for t in there if n in index.items[t])
                q, a = index.needs[n]
                if score >= threshold and dc._holds(q, passage) >= overlap and dc._holds(a, passage) >= overlap:
                    hits[index.ids[n]] = max(hits.get(index.ids[n], 0), score)
        out.append({k: round(v, 9) for k, v in hits.items()})
    return out


def test_against_brute_force(spark, folder):
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    some = [d.text for d in docs[:25]]
    some += ["x y " * 70 + t + " end" for _, t in items[:10]] + [" ".join(t.split()[:-3] + ["other", "words"]) for _, t in items[:10]]
    index = dc.Index(items)
    got = [{i: round(s, 9) for i, s, _ in h} for h in dc.find(index, some, dc.THRESHOLD, dc.OVERLAP)]
    assert got == brute(items, some)
    assert all(i in h for (i, _), h in zip(items[:10], got[25:35], strict=True))


def test_query_finds_every_planted_item(spark, folder):
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r.doc_id: r for r in op10_decontamination(spark, folder).collect()}
    assert set(got) == set(docs)
    planted = 0
    for d, text in docs.items():
        line = b" " + b" ".join(words_of(text)) + b" "
        whole = {i for i, t in items if b" " + b" ".join(words_of(t)) + b" " in line}
        planted += len(whole)
        assert {int(i) for i in got[d].item_ids.split(",") if i} == whole
        assert got[d].contaminated == bool(whole)
    assert planted


def test_wand_against_all_scores():
    dice = np.random.default_rng(3)
    items = [(i, " ".join(f"w{x}" for x in dice.zipf(1.4, 12) % 60)) for i in range(150)]
    index = dc.Index(items)
    for _ in range(50):
        terms = sorted(set(dice.integers(0, len(index.vocabulary), 25).tolist()))
        scores = np.zeros(len(index.ids))
        for t in terms:
            scores[index.items[t]] += index.impacts[t]
        for threshold in (0.2, 0.5, 0.8):
            got = {i: s for b in range(index.blocks) for i, s in index.search(terms, b, threshold)}
            want = {i for i in range(len(scores)) if scores[i] >= threshold}
            assert set(got) == want and all(abs(scores[i] - s) < 1e-9 for i, s in got.items())


def test_edges_and_rounds(spark):
    """Nulls, empties, equal items, and an index that takes several rounds."""
    text = "What is the colour of the sky on a clear day? It is a deep and even blue."
    items = spark.createDataFrame([(1, text), (2, text), (3, None), (4, "."), (None, "one two three four five six seven eight")],
                                  "item_id long, text string")
    rows = [(1, None), (2, ""), (3, "a b " * 500 + text), (3, "a b " * 500 + text), (None, text), (6, "it is a clear day"),
            (7, "zero one two three four five six seven eight nine")]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, hits int, item_id string")
    for size in (dc.INDEX_BYTES, 30):
        found = {(r.doc_id or 0): [h.item_id for h in r.hits] for r in dc.contaminations(docs, items, index_bytes=size).collect()}
        assert found == {1: [], 2: [], 3: [1, 2], 0: [1, 2], 6: [], 7: [None]}
        left = dc.drop_contaminated(docs, items, index_bytes=size)
        assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 2, 6]
        for df in (left, dc.contaminations(docs, items, index_bytes=size)):  # one Python worker at a time, in every stage
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("MapInArrow") <= 1
    assert dc.contaminations(docs.limit(0), items).count() == 0
    assert all(r.hits == [] for r in dc.contaminations(docs, items.limit(0)).collect())


def test_rounds_change_no_score(spark, folder):
    """Items in many groups: the same hits, scores and passages as with one index."""
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    odd = spark.createDataFrame([(-1, None), (-2, "!"), (-3, "a\u00a0b? " + "longest " * 300)], "item_id long, text string")
    items = items.select("item_id", "text").unionByName(odd)
    docs = spark.read.parquet(f"{folder}/documents.parquet").unionByName(
        items.selectExpr("item_id + 1000000 AS doc_id", "concat('some words ', text) AS text"), allowMissingColumns=True
    )
    found = [
        sorted((r.doc_id, [tuple(h) for h in r.hits]) for r in dc.contaminations(docs, items, index_bytes=size).collect())
        for size in (dc.INDEX_BYTES, 1500)
    ]
    blocks, several = dc.item_blocks(items, 1500)
    assert several and len(list(blocks)) > 2
    assert found[0] == found[1] and any(hits for _, hits in found[0])
