"""Collocations: the index against counting, the whole against a plain version, small shards and full filters."""

from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sparge.llm import collocations as cl
from sparge.llm.common import BATCH_ROWS

SHAPE = "doc_id long, text string, lang string, phrase string, f int"


def brute_force(docs: list[tuple], min_count: int, top: int) -> set[tuple]:
    n, f = Counter(), Counter()
    for _, text, lang, *_ in docs:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, 6):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    common = {k: a for k, a in f.items() if a >= min_count and len(k[1]) > 1}
    covered = set()
    for (lang, words), a in common.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                if a >= common[lang, words[i : i + k]]:
                    covered.add((lang, words[i : i + k]))
    rows: dict[str, list] = {}
    for (lang, words), a in common.items():
        if (lang, words) not in covered:
            cuts = [((1000 * a * n[lang]) // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            phrase = " ".join(words)
            rows.setdefault(lang, []).append((-score, -a, phrase.encode(), phrase, a, f[lang, words[:k]], f[lang, words[k:]], n[lang], score))
    return {
        (lang, rank, *row[3:]) for lang, found in rows.items() for rank, row in enumerate(sorted(found)[:top], 1)
    }


def _documents(seed: int) -> list[tuple]:
    dice = random.Random(seed)
    words = ["The", "of", "É", "é", "a b", "x-y", "\x01z", "on", "(see)", "q\x85"]
    fixed = ["of the best kind there", "a b c d e f g", "New York City", "ha ha ha ha ha ha"]
    docs = []
    for i in range(120):
        parts = [dice.choice(words) if dice.random() < 0.8 else dice.choice(fixed) for _ in range(dice.choice((0, 3, 60)))]
        parts = [p + dice.choice(("", "", "", ".", ",", "\x0b", "\r\n", "!?")) for p in parts]
        docs.append((i, dice.choice((" ", "\t ", "  ")).join(parts), dice.choice((None, "und", "en", "")), "p", 1))
    return docs + docs[:5] + [(None, None, "en", "p", 1), (7, "", None, "p", 1), (7, " \t.,", "fr", "p", 1)]


@pytest.mark.parametrize(("shard_words", "filter_bits", "top"), [(1 << 21, 1 << 27, 2000), (50, 64, 2000), (300, 1 << 27, 7)])
def test_against_brute_force(spark, shard_words, filter_bits, top):
    docs = _documents(4)
    frame = spark.createDataFrame(docs, SHAPE).repartition(3)
    found = cl.collocations(frame, min_count=12, top=top, shard_words=shard_words, filter_bits=filter_bits).collect()
    assert {tuple(r) for r in found} == brute_force(docs, 12, top) and len(found) > 20


def test_scores_beyond_64_bits(spark):
    totals = spark.createDataFrame([("en", 4 * 10**15)], "lang string, n long")
    found = spark.createDataFrame(
        [("en", "a", 1, 3 * 10**12, False), ("en", "b", 1, 2 * 10**12, False), ("en", "a b", 2, 10**12 + 7, False)],
        "lang string, phrase string, words int, f long, extended boolean",
    )
    row = cl.scored(totals, found).first()
    assert row.score == 1000 * (10**12 + 7) * 4 * 10**15 // (3 * 10**12 * 2 * 10**12)


@pytest.mark.parametrize("depth", [2, 3, 4, 5])
def test_index_counts_phrases(depth):
    dice = np.random.default_rng(depth)
    runs = [dice.integers(1, 6, dice.integers(2, 30)) for _ in range(60)]
    sequence = np.concatenate([np.append(r, 0) for r in runs]).astype(np.int32)
    want, before, after = Counter(), {}, {}
    for run in runs:
        line = [0, *run.tolist(), 0]
        for i in range(1, len(line) - depth):
            gram = tuple(line[i : i + depth])
            if 0 not in gram:
                want[gram] += 1
                before.setdefault(gram, set()).add(line[i - 1])
                after.setdefault(gram, set()).add(line[i + depth])
    everything = cl.Filter(64, np.full(1, ~np.uint64(0)))
    hashes = dice.integers(0, 1 << 63, 5).astype(np.uint64)
    forward, backward = cl.Direction(sequence, depth + 1), cl.Direction(cl._reversed(sequence), depth + 1)
    got, longer, counts = cl.phrases(sequence, hashes, depth, [everything] * 4, backward, chunk_rows=50)
    only = lambda seen: next(iter(seen)) if len(seen) == 1 else 0
    sides = forward.only(got.low, got.size).tolist(), backward.only(got.back, got.size).tolist()
    found = {tuple(g): row for g, *row in zip(got.grams.tolist(), got.size.tolist(), *sides, strict=True)}
    assert found == {g: [n, only(before[g]), only(after[g])] for g, n in want.items()}
    assert counts.sum() == sum(max(0, len(r) - depth) for r in runs) and len(longer) == len(set(longer.tolist())) == len(counts)


def test_empty(spark):
    empty = spark.createDataFrame([], SHAPE)
    assert cl.collocations(empty).count() == 0
    assert cl.collocations(spark.createDataFrame([(1, "of the. of the", "en", "", 0)], SHAPE)).count() == 0


def test_words_of_many_texts_are_split_at_once():
    """As by the contract's patterns, with the places where pieces and texts end; no word goes through Python alone."""
    dice = random.Random(4)
    texts = ["", " ", ".", "A b", "\u00c9t\u00e9\tX.y", "a\x1cb\u00a0c d"]
    texts += ["".join(dice.choice("aB\u00dfz7-\u4e2d \t\n\x0b\r.,;:!?\x1f\u2028") for _ in range(dice.randrange(60))) for _ in range(300)]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    want, ends = [], set()
    for text in texts:
        for piece in re.split("[.,;:!?\\x0A-\\x0D]", text.translate(lower)):
            ends.add(len(want))
            want += re.findall("[^\\x20\\x09]+", piece)
    words, found = cl.split_words(texts)
    assert [w.decode() for w in words.to_pylist()] == want
    assert found.tolist() == sorted(ends - {0, len(want)})
    empty, none = cl.split_words(["", ". ."])
    assert len(empty) == 0 and len(none) == 0


def test_blocks_hold_all_texts_and_little_more_than_asked():
    rows = [("en" if n % 3 else "de", "x" * n if n % 7 else None) for n in range(200)]
    batches = [pa.record_batch([pa.array([r[i] for r in rows[at : at + 16]], pa.string()) for i in range(2)], ["lang", "whole_text"]) for at in range(0, 200, 16)]
    blocks = list(cl.text_blocks(iter(batches), 500))
    assert sorted((lang, t) for b in blocks for lang, found in b.items() for t in found) == sorted(r for r in rows if r[1])
    assert all(500 <= sum(len(t) + 1 for found in b.values() for t in found) < 700 for b in blocks[:-1])


def _full_shard(words: int) -> tuple[pa.RecordBatch, cl.Filter]:
    """A shard whose words all pass, of two languages, and the filter that they pass."""
    dice = random.Random(8)
    texts = [" ".join(f"w{int(dice.paretovariate(0.6)) % 30000}" for _ in range(40)) for _ in range(words // 40)]
    rows = pa.record_batch([pa.array(["de" if n % 3 else "en" for n in range(len(texts))]), pa.array(texts)], ["lang", "whole_text"])
    everything = cl.Filter(64, np.full(1, ~np.uint64(0)))
    (shard,) = cl._encode(lambda: everything, words * 2)(iter([rows]))
    return shard, everything


@pytest.mark.parametrize(("length", "word_bytes"), [(1, 130), (2, 130), (3, 130), (5, 190)])
def test_memory_of_a_shard_whose_words_are_all_frequent(length, word_bytes):
    shard, everything = _full_shard(200_000)
    before, most_arrow = pa.total_allocated_bytes(), 0
    tracemalloc.start()
    for batch in cl._mine(length, length < 5, lambda: [everything] * 4)(iter([shard])):
        most_arrow = max(most_arrow, pa.total_allocated_bytes() - before)
    most = tracemalloc.get_traced_memory()[1] + most_arrow
    tracemalloc.stop()
    assert most < word_bytes * 200_000


def test_shards_reach_tasks_one_by_one(spark, monkeypatch):
    """Whatever the session's batches are, which stay as they were."""
    names = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize"
    mine = cl._mine

    def watched(*args):
        def run(batches):
            def single():
                for batch in batches:
                    assert batch.num_rows == 1, batch.num_rows
                    yield batch

            yield from mine(*args)(single())

        return run

    monkeypatch.setattr(cl, "_mine", watched)
    before = [spark.conf.get(n) for n in names[1:]]
    docs = spark.createDataFrame(_documents(5), SHAPE).coalesce(1)
    found = {tuple(r) for r in cl.collocations(docs, min_count=12, shard_words=50).collect()}
    assert found == brute_force(_documents(5), 12, 2000)
    assert [spark.conf.get(n) for n in names] == [str(BATCH_ROWS), *before]
