"""SimHash near-duplicates against all pairs."""

from __future__ import annotations

import random
import re

import xxhash

from sparge.llm.components import components
from sparge.llm.queries import op6_simhash
from sparge.llm.simhash import drop_near_copies, near_duplicates, near_edges, simhash


def slow_print(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_classes(nodes, distance):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= distance:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_query_against_all_pairs(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    prints = {r.doc_id: slow_print(r.text) for r in rows}
    roots = slow_classes(set(prints.values()), 3)
    least = {}
    for d, p in prints.items():
        least[roots[p]] = min(d, least.get(roots[p], d))
    want = {(d, f"{p:016x}", least[roots[p]]) for d, p in prints.items()}
    assert {tuple(r) for r in op6_simhash(spark, folder).collect()} == want


def test_edge_texts(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one TWO"), (None, "x y z"), (7, "a b c d e"), (7, "a b c d e")]
    docs = spark.createDataFrame([(*r, "z", 0) for r in rows], "doc_id long, text string, print string, root int")
    got = sorted((r.doc_id or 0, r.fingerprint, r.component_id) for r in near_duplicates(docs).collect())
    assert got[1:4] == [(i, "0" * 16, 1) for i in (1, 2, 3)]
    assert {r[2] for r in got[4:6]} == {4} and got[0][2] is None and [r[0] for r in got[6:]] == [7, 7]
    left = drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 4, 7]
    assert near_duplicates(docs.limit(0)).count() == 0 and drop_near_copies(docs.limit(0)).count() == 0


def test_crowded_signatures(spark):
    """Many fingerprints in a small ball: larger than a tile, so tiles are compared, and nothing is lost."""
    dice = random.Random(7)
    centres = [dice.getrandbits(64) for _ in range(3)]
    prints = set()
    for i in range(600):
        p = centres[i % 3]
        for _ in range(dice.randint(0, 4)):
            p ^= 1 << dice.randrange(64)
        prints.add(p)
    signed = [(p - 2**64 if p >> 63 else p,) for p in prints]
    edges = near_edges(spark.createDataFrame(signed, "print long"), tile=16)
    found = {r.node: r.root for r in components(edges).collect()}
    want = slow_classes({p for (p,) in signed}, 3)
    got = {n: found.get(n, n) for n in want}
    assert got == want


def test_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(900, 900), (5, 4)], "a long, b long")
    assert {r.node: r.root for r in components(edges).collect()} == {i: 0 for i in range(301)}


def test_simhash_of_long_text():
    text = " ".join(str(i % 977) for i in range(70_000))
    assert simhash(text) == slow_print(text)
