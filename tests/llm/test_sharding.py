"""Sharding: the tree, best fit against a plain loop, and the laws of the result."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

from hypothesis import given, settings as hyp, strategies as st

from sparge.llm import sharding
from sparge.llm.queries import op8_sharding


@hyp(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=60), st.integers(1, 60))
def test_best_fit_against_a_loop(sizes, capacity):
    sizes = sorted(sizes, reverse=True)
    bins, want = [], []
    for s in sizes:
        fits = [(r, i) for i, r in enumerate(bins) if r >= s]
        if fits:
            _, at = min(fits)
        else:
            bins.append(max(capacity, s))
            at = len(bins) - 1
        bins[at] -= s
        want.append(at)
    assert sharding.best_fit(sizes, capacity) == want


def test_containers_are_near_equal():
    dice = random.Random(1)
    for n in (0, 1, 23, 24, 25, 3000):
        sizes = [dice.randint(50, 100) for _ in range(n)]
        found = sharding.pack_containers(sizes, 24)
        loads = [sum(s for s, b in zip(sizes, found, strict=True) if b == k) for k in range(24)]
        assert len(found) == n and max(loads) - min(loads) <= max(100, sum(sizes) / 24 / 50)


def laws(rows, texts, shards):
    """rows: (doc_id, size, crc, shard, slot); texts by row, with repeats."""
    assert sorted((r[0] is None, r[0], r[1], r[2]) for r in rows) == sorted(
        (d is None, d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in texts
    )
    by_shard = defaultdict(list)
    for r in rows:
        assert 0 <= r[3] < shards
        by_shard[r[3]].append(r)
    for mine in by_shard.values():
        assert sorted(r[4] for r in mine) == list(range(len(mine)))
    return [sum(r[1] for r in by_shard[k]) for k in range(shards)]


def test_query(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = op8_sharding(spark, folder).collect()
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}
    loads = laws([(r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in got], docs, 24)
    # Indivisible texts: no shard can be smaller than the mean by more than the largest of them.
    assert max(loads) - min(loads) <= max(r.size for r in got)


def test_groups_stay_whole_and_hot_ones_are_cut(spark):
    dice = random.Random(2)
    rows = [(i, "x" * dice.randint(0, 50) + str(i % 1500)) for i in range(3000)]
    rows += [(10_000 + i, "the same text again and again") for i in range(1500)] + [(None, None), (None, ""), (9_999, "twice"), (9_999, "twice")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, shard int, size string").repartition(5)
    got = sharding.shard(docs, shards=4).collect()
    loads = laws([tuple(r) for r in got], rows, 4)
    assert max(loads) - min(loads) <= sum(loads) / 4 / 50
    places = defaultdict(set)
    text = dict(rows)
    for r in got:
        if r.doc_id is not None and r.doc_id < 10_000:
            places[text[r.doc_id]].add(r.shard)
    assert all(len(p) == 1 for p in places.values())
    assert sharding.shard(docs.limit(0), shards=4).count() == 0
