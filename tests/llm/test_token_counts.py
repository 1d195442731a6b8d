"""Token counts against the libraries, and what the cache saves."""

from __future__ import annotations

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from sparge.llm import token_counts as tc
from sparge.llm.queries import op2_token_counts

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def plain(path, text):
    if path.endswith(".json"):
        return len(Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids)
    return len(SentencePieceProcessor(model_file=path).encode(text or ""))


def test_query_against_the_library(spark, folder):
    pieces = SentencePieceProcessor(model_file=PIECES)
    want = set()
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        n = len(pieces.encode(r.text or ""))
        want.add((r.doc_id, len((r.text or "").encode()), n, n > 4096))
    assert {tuple(r) for r in op2_token_counts(spark, folder).collect()} == want


TEXTS = [None, "", " ", "<s> a </s>", "twice", "twice", "twice ", "<|endoftext|> x", "é　ü" * 40_000, "word " * 5000]


@pytest.mark.parametrize("path", [PIECES, WORDS])
def test_edges(spark, tmp_path, path):
    docs = spark.createDataFrame([(i, t, b"x", 1) for i, t in enumerate(TEXTS)] + [(None, "a", b"x", 1), (4, "twice", b"x", 1)],
                                 "doc_id long, text string, digest binary, n_tokens int")
    got = tc.count_tokens(docs, str(tmp_path / "cache"), path).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = "a" if r.doc_id is None else TEXTS[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n := plain(path, text), n > 4096)
    assert tc.count_tokens(docs.limit(0), str(tmp_path / "none"), path).count() == 0


def test_only_distinct_misses_are_encoded(spark, tmp_path):
    cache = str(tmp_path / "cache")
    docs = spark.createDataFrame([(i, f"text {i % 7}") for i in range(500)], "doc_id long, text string").repartition(6)
    assert tc.count_tokens(docs, cache, PIECES).count() == 500
    stored = lambda: spark.read.parquet(cache)
    assert stored().count() == 7
    # What the cache holds is used, not encoded again: a wrong count in it stays visible.
    spark.createDataFrame([(tc.tokenizer_digest(PIECES), bytearray(__import__("hashlib").sha256(b"known").digest()), -1)], tc.CACHE) \
        .write.mode("append").parquet(cache)
    more = docs.unionByName(spark.createDataFrame([(900, "known"), (901, "new")], "doc_id long, text string"))
    got = {r.doc_id: r.n_tokens for r in tc.count_tokens(more, cache, PIECES).collect()}
    assert got[900] == -1 and got[901] == plain(PIECES, "new") and stored().count() == 9
    # Another tokenizer has its own counts.
    tc.count_tokens(docs, cache, WORDS).count()
    assert stored().count() == 16
