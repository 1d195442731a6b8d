"""The pipeline's stages against a brute-force version in plain Python."""

from __future__ import annotations

import corpus_pipeline
from sparge.llm.common import words_of

from test_packing import check
from test_shingle_join import slow_similar
from test_simhash import slow_classes, slow_print


def slow_pipeline(docs, items):
    """Rows (doc_id, text) that reach the packing; language ID only drops texts without a letter."""
    rows = [(d, t) for d, t in docs if any(c.isalpha() for c in t or "")]
    best = {}
    for d, t in rows:
        norm = t.translate({c: None for c in (32, *range(9, 14))})
        best[norm] = min(best.get(norm, (0, 0, "")), (-len(t), d, t))
    rows = [(d, t) for _, d, t in best.values()]
    # Links are fingerprints of at most 3 differing bits, and shingle similarities of 0.8 or more.
    prints = [slow_print(t) for _, t in rows]
    near = slow_classes(set(prints), 3)
    root = slow_similar([t for _, t in rows])
    known = {}
    for i, p in enumerate(prints):
        other = root[known.setdefault(near[p], i)]
        root = [min(root[i], other) if r in (root[i], other) else r for r in root] if root[i] != other else root
    first = {}
    for (d, t), r in zip(rows, root, strict=True):
        first[r] = min(first.get(r, (d, t)), (d, t))
    padded = [b" " + b" ".join(words_of(t)) + b" " for _, t in items]
    return {d: t for d, t in first.values() if not any(i in b" " + b" ".join(words_of(t)) + b" " for i in padded)}


def test_against_brute_force(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    check(corpus_pipeline.run(spark, folder).collect(), slow_pipeline(docs, items), 2048)


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for rows in (docs, docs.limit(0)):
            left = stage(spark, rows, folder)
            assert left.columns == docs.columns
            assert left.count() <= rows.count()


def test_rejected_texts(spark, folder):
    """Null, empty and letterless texts go with the first stage, and nothing else does."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "12 3!"), (-4, "ok")], "doc_id long, text string")
    both = docs.unionByName(odd, allowMissingColumns=True)
    left = {r.doc_id for r in corpus_pipeline.language_id(spark, both, folder).select("doc_id").collect()}
    assert left == {r.doc_id for r in docs.select("doc_id").collect()} | {-4}


def test_odd_rows(spark, folder):
    """Rows that only their nulls or extra columns tell apart, clashing names, maps and the smallest id, through each stage."""
    text = "one two three four five six seven"
    rows = [
        (0, "x  y", "k", {"a": "1"}, 1, 1, True), (1, "x y", None, None, 2, 2, False), (1, None, "x y", None, 3, 3, None),
        (-(2**63), text, "k", {"b": None}, 4, 4, True), (None, text, "k", {}, 5, 5, True), (7, text + " eight", None, None, 6, 6, True),
        (7, text + " eight", None, None, 6, 6, True), (8, "", None, None, 7, 7, None),
    ]
    shape = "doc_id long, text string, lang string, dropped_id map<string,string>, row_no int, dedup_row_hash int, kept boolean"
    docs = spark.createDataFrame(rows, shape)
    left = {name: stage(spark, docs, folder) for name, stage in corpus_pipeline.STAGES[:-1]}
    ids = {name: sorted(((r.doc_id, r.text) for r in df.collect()), key=str) for name, df in left.items()}
    assert all(df.columns == docs.columns for df in left.values())
    assert (1, None) in ids["exact dedup"] and (1, "x y") not in ids["exact dedup"] and (0, "x  y") in ids["exact dedup"]
    assert ids["exact dedup"] == sorted([(0, "x  y"), (1, None), (-(2**63), text), (7, text + " eight")], key=str)
    assert (None, text) not in ids["SimHash near-dedup"] and (-(2**63), text) in ids["SimHash near-dedup"]
    assert len(ids["benchmark decontamination"]) == len(rows) and len(ids["language ID"]) == 6
