"""Packing: round trip through the pieces, the curve, and token ids against the plain library."""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings as hyp, strategies as st
from tokenizers import Tokenizer

from sparge.llm import packing
from sparge.llm.queries import op5_packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)


def ids_of(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids + [1]


def check(pieces, texts, length):
    """Every id in exactly one piece, sequences without gaps, all but the last full."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(texts)
    for d, text in texts.items():
        ids, at = np.array(ids_of(text), "<u4"), 0
        for p in sorted(by_doc[d], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    fills = []
    for s in range(len(by_sequence)):
        at = 0
        for p in sorted(by_sequence[s], key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        fills.append(at)
    assert all(f == length for f in fills[:-1]) and 0 < fills[-1] <= length


def test_query_against_plain_ids(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    check(op5_packing(spark, folder).collect(), texts, 2048)


def test_edge_texts(spark):
    texts = {1: None, 2: "", 3: "  two  blanks \n\n x ", 4: "a <|endoftext|> b", 5: "word " * 3000, 6: "é  ü\x1c y"}
    docs = spark.createDataFrame([(d, t, 5, "k") for d, t in texts.items()], "doc_id long, text string, length int, ids string")
    check(packing.piece_digests(packing.pack(docs, length=64)).collect(), texts, 64)
    assert packing.pack(docs.limit(0)).count() == 0
    twice = packing.pack(docs.filter("doc_id = 5").unionAll(docs.filter("doc_id = 5")), length=64).collect()
    assert sum(p.length for p in twice) == 2 * len(ids_of(texts[5]))


SOME = st.text(st.sampled_from(" \n\t.,'abAB1 é　\x1c<|>") , max_size=40)


@hyp(max_examples=300, deadline=None)
@given(SOME)
def test_word_by_word_ids(text):
    assert ENCODER.encode(text).tolist() == ids_of(text)[:-1]


ENCODER = packing.Encoder(PATH, kept_words=50)


@pytest.mark.parametrize("dimensions,bits", [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_neighbours(dimensions, bits):
    cells = list(itertools.product(range(1 << bits), repeat=dimensions))
    place = dict(zip(packing.hilbert([list(c) for c in cells], bits).tolist(), cells, strict=True))
    assert sorted(place) == list(range(len(cells)))
    for at in range(len(cells) - 1):
        assert sum(abs(a - b) for a, b in zip(place[at], place[at + 1], strict=True)) == 1
