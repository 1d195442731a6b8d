"""Polynomial fingerprints, their combination, and groups of equal texts."""

from __future__ import annotations

import hashlib

from hypothesis import given, settings as hyp, strategies as st

from sparge.llm import exact_dedup as ex

COLUMNS = "doc_id long, text string, n_bytes string, kept int, h0 int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, None) for r in rows], COLUMNS)


@hyp(max_examples=60, deadline=None)
@given(st.binary(max_size=200), st.binary(max_size=200))
def test_chunks_combine(a, b):
    for prime, base in ex.FIELDS:
        whole = 0
        for byte in a + b:
            whole = (whole * base + byte) % prime
        parts = ex.chunk_hash(a, prime, base), ex.chunk_hash(b, prime, base)
        assert ex.combine(*parts, len(b), prime, base) == whole == ex.chunk_hash(a + b, prime, base)


ROWS = [
    (5, None), (3, ""), (4, " \n"), (10, "a b\tc"), (11, "abc"), (12, "a  b c"), (13, "a\u00a0bc"), (None, "abc"),
    (20, "twice"), (20, "twice"), (30, "é" * 150_000 + " x"), (31, "é" * 100_000 + "\n" + "é" * 50_000 + "x"),
    (32, "é" * 149_999 + "ex"),
]


def expected(rows):
    groups = {}
    for d, t in rows:
        norm = (t or "").translate({c: None for c in (32, *range(9, 14))})
        groups.setdefault(norm, []).append((-len(t or ""), d is None, d))
    out = []
    for d, t in rows:
        norm = (t or "").translate({c: None for c in (32, *range(9, 14))})
        out.append((d, min(groups[norm])[2], len(groups[norm]), hashlib.sha256(norm.encode()).hexdigest()))
    return out


def check(spark, fields):
    docs = frame(spark, ROWS)
    got = ex.exact_dedup(docs, fields).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[3])
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=key) == sorted(expected(ROWS), key=key)
    assert sum(r.kept for r in got) == len({r.text_sha256 for r in got})
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got if r.doc_id != 20)
    assert [r.kept for r in got if r.doc_id == 20].count(True) == 1


def test_groups(spark):
    check(spark, ex.FIELDS)


def test_false_collisions_are_parted(spark):
    """Fingerprints modulo 1 are all equal: only the comparison of the chunks tells texts of equal size apart."""
    check(spark, ((1, 1),) * 3)


def test_copies_go_and_columns_stay(spark):
    docs = frame(spark, ROWS)
    left = ex.drop_exact_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [4, 12, 13, 20, 30, 32]
    assert ex.drop_exact_copies(docs.limit(0)).count() == 0 and ex.exact_dedup(docs.limit(0)).count() == 0
