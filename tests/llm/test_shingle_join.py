"""Near copies by similarity of 5-word shingles against all pairs."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from sparge.llm import shingle_join
from sparge.llm.common import numbered, write_stage
from sparge.llm.components import components
from sparge.llm.shingle_join import _dealt, similar_edges
from sparge.llm.simhash import drop_near_copies

from test_simhash import slow_print


def slow_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def slow_similar(texts):
    """Per text the smallest number that links of similarity >= 0.8 reach."""
    sets, root = [slow_set(t) for t in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and 5 * len(a & b) >= 4 * len(a | b) and root[i] != root[j]:
                high, low = max(root[i], root[j]), min(root[i], root[j])
                root = [low if r == high else r for r in root]
    return root


def copies(dice, line=()):
    """A text, and copies of it with up to four other words."""
    base = [f"w{dice.randrange(5000)}" for _ in range(dice.randint(5, 160))]
    for _ in range(6):
        words = list(base)
        for _ in range(dice.randint(0, 4)):
            words[dice.randrange(len(words))] = f"n{dice.randrange(10**6)}"
        yield " ".join([*line, *words])


@pytest.mark.parametrize("small,tile", [(32, 1024), (3, 16)])
def test_against_all_pairs(spark, small, tile):
    dice = random.Random(5)
    line = [f"common{i}" for i in range(12)]
    texts = [None, "", " ", "a b", "A  b"] + [t for n in range(40) for t in copies(dice, line if n % 2 else ())]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    rows = numbered(docs)
    at = {r.row_no: r.whole_row.doc_id for r in rows.collect()}
    edges = similar_edges(rows, small=small, tile=tile, sample_rows=100)
    found = {at[r.node]: at[r.root] for r in components(edges).collect()}
    want = slow_similar(texts)
    groups = {}
    for n in range(len(texts)):
        groups.setdefault(found.get(n, n), set()).add(want[n])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want)) < len(texts) - 50


@pytest.mark.parametrize("tile,most", [(1024, 30), (16, 30 * 4)])
def test_texts_are_sent_once_for_pairs_that_hang_together(spark, tile, most):
    """Not once per pair; a root of more texts than a tile is cut, and no group has more than two tiles of texts."""
    pairs = [(a, b, a, b) for a in range(30) for b in range(a + 1, 30)] + [(40, 41, 40, 41)]
    likely = spark.createDataFrame(pairs, "a long, b long, a_linked long, b_linked long")
    sizes = spark.range(50).select(F.col("id").alias("node"), F.lit(10).alias("size"))
    dealt, sends = _dealt(likely, sizes, tile)
    assert sorted((r.a, r.b) for r in dealt.collect()) == [p[:2] for p in pairs]
    assert sends.filter("root = 0").count() <= most and sends.filter("root = 40").count() == 2
    ends = dealt.select("root", "first", "second", F.explode(F.array("a", "b")).alias("node")).distinct()
    assert ends.exceptAll(sends).isEmpty() and sends.exceptAll(ends).isEmpty()


def test_forest_of_possible_pairs_connects_all_similar_ones():
    """Signatures never rule out a similar pair, of whatever sizes; links that are known are left out."""
    dice = random.Random(8)
    sets = []
    for _ in range(40):
        base = [dice.getrandbits(64) for _ in range(dice.choice([1, 4, 16, 60, 128, 500]))]
        sets += [shingle_join.np.unique(shingle_join.np.array(base[: dice.randint(-(-4 * len(base) // 5), len(base))], "u8")) for _ in range(4)]
    dice.shuffle(sets)
    numbers = shingle_join.np.arange(len(sets))
    sizes = shingle_join.np.array([len(s) for s in sets])
    linked = numbers // 2
    edges = shingle_join.possible_forest(numbers, sizes, linked, [shingle_join._signature(s) for s in sets])
    root = list(range(len(sets)))
    for a, b in edges:
        assert linked[a] != linked[b] and root[a] != root[b]
        root = [root[a] if r == root[b] else r for r in root]
    pairs = [(i, j) for i, a in enumerate(map(set, map(tuple, sets))) for j, b in enumerate(map(set, map(tuple, sets[:i])))
             if linked[i] != linked[j] and 5 * len(a & b) >= 4 * len(a | b)]
    assert len(pairs) > 100 and all(root[i] == root[j] for i, j in pairs)
    assert len(set(root)) > 30


def test_sets_are_sent_once_for_all_shingles(spark, monkeypatch):
    """Texts that share many crowded shingles without being similar: whole sets of next to none of them are sent."""
    dice = random.Random(9)
    shared = [f"s{i}" for i in range(40)]
    texts = [" ".join([*shared, *(f"w{dice.randrange(10**6)}" for _ in range(60))]) for _ in range(60)]
    texts.append(" ".join([*texts[7].split()[:-2], "x", "y"]))
    rows = numbered(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"))
    written = {}
    monkeypatch.setattr(shingle_join, "write_stage", lambda df, label: written.setdefault(label, []).append(w := write_stage(df, label)) or w)
    edges = similar_edges(rows, small=3, tile=16, sample_rows=1).collect()
    assert len(edges) == 1
    assert written["shingle-groups"][-1].count() > 5 * len(texts)
    assert written["shingle-sets"][-1].count() <= 4


def test_copies_that_fingerprints_miss(spark):
    """Texts of similarity >= 0.8 whose fingerprints differ in more than 3 bits: one stays."""
    dice = random.Random(3)
    base = [f"w{dice.randrange(5000)}" for _ in range(200)]
    other = [*base[:40], "x", *base[41:100], "y", *base[101:160], "z", *base[161:]]
    texts = [" ".join(base), " ".join(other)]
    a, b = map(slow_set, texts)
    assert len(a & b) >= 0.8 * len(a | b)
    assert (slow_print(texts[0]) ^ slow_print(texts[1])).bit_count() > 3
    docs = spark.createDataFrame([(2, texts[1]), (1, texts[0]), (3, " ".join(reversed(base)))], "doc_id int, text string")
    assert sorted(r.doc_id for r in drop_near_copies(docs).collect()) == [1, 3]


def test_pipeline_stage(spark, folder):
    """What stays of the given table: one text per component of links of both kinds."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    prints, root = [slow_print(t) for _, t in rows], slow_similar([t for _, t in rows])
    for i, a in enumerate(prints):
        for j, b in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= 3 and root[i] != root[j]:
                high, low = max(root[i], root[j]), min(root[i], root[j])
                root = [low if r == high else r for r in root]
    got = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, folder).select("doc_id").collect()}
    assert got == {rows[r][0] for r in root}
