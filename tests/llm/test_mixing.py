"""Mixing: targets, sums and copies against plain versions; the tree against a loop with the same dice."""

from __future__ import annotations

import random
import struct
from collections import defaultdict
from fractions import Fraction

import pytest
import xxhash
from pyspark.sql import functions as F

from sparge.llm import mixing

SHAPE = "doc_id long, text string, source string, size string, mix_copies int"


def plain_targets(sizes: dict[str | None, int], ratio=Fraction(3, 2), weights=(5, 2, 1), most=2) -> dict:
    """Share by weight; whoever is above its limit stops there, and the rest is shared anew."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = ratio * sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in stopped]
        rest = total - sum(most * sizes[s] for s in stopped)
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = {s for s in open_ if share[s] >= most * sizes[s]}
        if not above:
            return {s: Fraction(most * sizes[s]) if s in stopped else share[s] for s in names}
        stopped |= above


def _hash(*values: int) -> int:
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", v), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def plain_tree(units: list[tuple], fan_in: int) -> list[tuple]:
    """(source, dice, doc_id, text_hash, size, mass, room) with masses rounded, in loops."""
    still = [u for u in units if not 0 < u[5] < u[6]]
    moving = [u for u in units if 0 < u[5] < u[6]]
    bins = -(-len(moving) // fan_in)
    placed = [(u, u[1] % bins) for u in moving]
    while bins:
        groups = defaultdict(list)
        for u, b in placed:
            groups[u[0], b].append(u)
        placed = []
        for (_, b), items in groups.items():
            items = sorted(items, key=lambda u: (-u[4], u[1], u[2] is not None, u[2] or 0))
            carry = list(items[0])
            for item in map(list, items[1:]):
                gain, loss = min(carry[6] - carry[5], item[5]), min(carry[5], item[6] - item[5])
                moved = gain if _hash(carry[1], item[1]) % (gain + loss) < loss else -loss
                carry[5] += moved
                item[5] -= moved
                if 0 < carry[5] < carry[6]:
                    still.append(tuple(item))
                else:
                    still.append(tuple(carry))
                    carry = item
            if bins > 1 and 0 < carry[5] < carry[6]:
                placed.append((tuple(carry), b // fan_in))
            else:
                still.append(tuple(carry))
        if bins == 1:
            break
        bins = -(-bins // fan_in)
    return still


def _documents(seed: int, n: int = 600) -> list[tuple]:
    dice = random.Random(seed)
    names = ["a", "b", "ä", "z", "\U0001f600", "￮", None]
    rows = []
    for i in range(n):
        text = dice.choice((None, "", " \x0b\t", *(["w " * dice.choice((1, 7, 40, 300))] * 9)))
        rows.append((dice.choice((i, i, i, None)), text, dice.choice(names[: 1 + i % 7]), "9", 4))
    return rows + rows[:40]


@pytest.mark.parametrize("fan_in", [7, 256])
def test_against_plain_versions(spark, fan_in):
    rows = _documents(3)
    docs = spark.createDataFrame(rows, SHAPE)
    found = mixing.mix(docs, fan_in=fan_in).collect()
    assert len(found) == len(rows)
    sizes = defaultdict(int)
    for _, text, source, *_ in rows:
        sizes[source] += len((text or "").split())
    goals = plain_targets(sizes)
    taken, longest = defaultdict(int), defaultdict(int)
    for r in found:
        assert r.source_size == sizes[r.source] and abs(r.target - goals[r.source]) <= 1e-6 * max(1, sizes[r.source])
        assert r.taken == r.copies * r.size and r.copies in (int(r.target // r.source_size), -int(-r.target // r.source_size))
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
    for source, words in taken.items():
        assert abs(words - goals[source]) <= longest[source] / 2 + 1 + sizes[source] / mixing.SCALE

    kinds = mixing.sized(docs)
    share = {r.source: r for r in mixing.targets(kinds).collect()}
    units = mixing._unfolded(kinds).withColumn("dice", F.xxhash64(F.lit(mixing.SEED), "doc_id", "source", "text_hash", "size", "copy_no"))
    plain = [
        (u.source, u.dice, u.doc_id, u.text_hash, u["size"], share[u.source].fraction * u["size"], u["size"] * mixing.SCALE) for u in units.collect()
    ]
    want = sorted(
        ((u[2], u[0], u[4], u[3], (share[u[0]].whole + (u[5] > 0 and 2 * u[5] >= u[6])) * u[4]) for u in plain_tree(plain, fan_in)), key=repr
    )
    assert sorted(((r.doc_id, r.source, r["size"], r.text_hash, r.taken) for r in found), key=repr) == want


def test_reruns_agree_however_the_rows_are_dealt(spark):
    docs = spark.createDataFrame(_documents(8), SHAPE)
    columns = ["doc_id", "source", "size", "taken"]
    results = [sorted(map(tuple, mixing.mix(d).select(*columns).collect()), key=repr) for d in (docs, docs.repartition(7), docs.coalesce(1))]
    assert results[0] == results[1] == results[2]


def test_fractions_are_kept_on_average(spark):
    """Over many seeds each document is taken as often as its share says."""
    docs = spark.createDataFrame([(i, "w " * (1 + i % 5), "a" if i < 12 else "b", "", 0) for i in range(24)], SHAPE)
    counts, runs = defaultdict(int), 8
    for seed in range(runs):
        for r in mixing.mix(docs, ratio=0.5, weights=(3, 1), most=1, seed=seed).collect():
            counts[r.source] += r.copies
    rows = mixing.mix(docs, ratio=0.5, weights=(3, 1), most=1).collect()
    for source in "ab":
        share = next(r.target / r.source_size for r in rows if r.source == source)
        assert abs(counts[source] / (runs * 12) - share) < 0.12


def test_repeats_of_one_row_beyond_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 8)
    docs = spark.createDataFrame([(None, "a b c", None, "", 0)] * 50 + [(1, "x", "s", "", 0)] * 9, SHAPE)
    found = mixing.mix(docs).collect()
    assert len(found) == 59 and {r.source_size for r in found} == {150, 9}
    assert abs(sum(r.taken for r in found) - 1.5 * 159) <= 3


def test_mixed_documents_and_empty_tables(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 9), "ab"[i % 2], "s", i) for i in range(40)] + [(5, "w " * 5, "b", "s", 5)], SHAPE)
    mixed = mixing.mix(docs)
    again = mixing.mixed_documents(docs, mixed)
    assert again.columns == docs.columns and again.count() == mixed.agg(F.sum("copies")).first()[0]
    assert mixing.mix(docs.limit(0)).count() == 0
    nothing = mixing.mix(docs.filter("doc_id = 0")).collect()
    assert [(r["size"], r.target, r.taken) for r in nothing] == [(0, 0.0, 0)]
