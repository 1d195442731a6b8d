"""Benchmark decontamination: a BM25 inverted index of test items, searched by block-max WAND with every passage.

Items are the indexed side (few), passages of the training documents the queries (many). An item's BM25 score for a
passage is divided by its score for its own text, so one threshold fits all items: 1 means that all its words are in
the passage. What reaches the threshold is verified on the words in order: the shares of the question's and of the
answer's 5-word shingles that the passage holds.
"""

from __future__ import annotations

import functools
import math
import re
import uuid
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparge.llm.common import drop_rows, numbered, settings, words_of, write_stage

K1, B = 1.2, 0.75
THRESHOLD = 0.6
SHINGLE = 5
OVERLAP = 0.8
# Items per block of the index; more when there would be over MAX_BLOCKS of them, as a word has a bound per block.
BLOCK_ITEMS = 4
MAX_BLOCKS = 64
# An index is sent to every task, so it holds items of at most this much text; more items are searched in further rounds.
INDEX_BYTES = 4 << 20
# Words of passages that are scored at once.
BLOCK_WORDS = 1 << 18

_SENTENCE_END = re.compile(r"(?<=[.!?])\s+")


def split_item(text: str) -> tuple[list[bytes], list[bytes]]:
    """Question and answer: all but the last sentence, and the last; of a single sentence the last quarter is the answer."""
    parts = [w for s in _SENTENCE_END.split(text) if (w := words_of(s))]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    cut = len(words) - len(words) // 4
    return words[:cut], words[cut:]


def shingles(words: list[bytes]) -> set[tuple[bytes, ...]]:
    """Runs of SHINGLE words; fewer words are one run, none are none."""
    if not words:
        return set()
    return {tuple(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}


def _holds(need: set[tuple[bytes, ...]], words: list[bytes]) -> float:
    """Share of the runs in `need` that stand in `words`."""
    if not need:
        return 1.0
    sizes = {len(n) for n in need}
    there = {tuple(words[i : i + k]) for k in sizes for i in range(len(words) - k + 1)}
    return len(need & there) / len(need)


class Statistics(NamedTuple):
    """Of all items that have words: their number, words in all of them, words of the longest, and items by word."""

    items: int
    words: int
    longest: int
    holding: dict[bytes, int]


class Index:
    """Postings with block maxima; items are ordered by length, so that a block's items have like scores.

    `whole` are the statistics of all items if `items` are a group of them, so that scores and passages are those of
    one index of all items.
    """

    def __init__(self, items: list[tuple[int, str]], whole: Statistics | None = None):
        split = [(i, *split_item(t or "")) for i, t in items]
        split = sorted((x for x in split if x[1] or x[2]), key=lambda x: (len(x[1]) + len(x[2]), str(x[0])))
        self.ids = [i for i, _, _ in split]
        self.needs = [(shingles(q), shingles(a)) for _, q, a in split]
        words = [q + a for _, q, a in split]
        counts: dict[bytes, dict[int, int]] = defaultdict(lambda: defaultdict(int))
        for n, item in enumerate(words):
            for w in item:
                counts[w][n] += 1
        if whole is None:
            longest = max(map(len, words), default=1)
            whole = Statistics(len(words), sum(map(len, words)), longest, {w: len(found) for w, found in counts.items()})
        self.longest = whole.longest
        mean = whole.words / max(1, whole.items)
        self.vocabulary = {w: t for t, w in enumerate(sorted(counts))}
        postings, own = [], np.zeros(len(words))
        for w in sorted(counts):
            found = counts[w]
            idf = math.log(1 + (whole.items - whole.holding[w] + 0.5) / (whole.holding[w] + 0.5))
            at = np.array(sorted(found), np.int32)
            tf = np.array([found[n] for n in at.tolist()], float)
            size = np.array([len(words[n]) for n in at.tolist()], float)
            impact = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / mean))
            own[at] += impact
            postings.append((at, impact))
        self.items = [at for at, _ in postings]
        self.impacts = [impact / own[at] for at, impact in postings]
        self.width = max(BLOCK_ITEMS, -(-len(words) // MAX_BLOCKS))
        self.blocks = -(-len(words) // self.width)
        self.block_max = np.zeros((len(postings) + 1, self.blocks), np.float32)  # the last row is for unknown words
        for t, (at, impact) in enumerate(zip(self.items, self.impacts, strict=True)):
            np.maximum.at(self.block_max[t], at // self.width, impact.astype(np.float32))
        # Per block the postings of its words: items, impacts, and the largest impact.
        self.postings: list[dict[int, tuple[list[int], list[float], float]]] = [{} for _ in range(self.blocks)]
        for t, (at, impact) in enumerate(zip(self.items, self.impacts, strict=True)):
            for block in np.unique(at // self.width).tolist():
                mine = at // self.width == block
                self.postings[block][t] = (at[mine].tolist(), impact[mine].tolist(), float(impact[mine].max()))

    def search(self, terms: list[int], block: int, threshold: float) -> list[tuple[int, float]]:
        """WAND within one block of items: (item number, score) of all that reach the threshold.

        Cursors stand on each term's postings, ordered by item. The pivot is the first item that the maxima of the
        terms up to it could lift to the threshold; items before it are skipped.
        """
        there = self.postings[block]
        cursors = [[*there[t][:2], 0, there[t][2]] for t in terms if t in there]
        out, slack = [], threshold - 1e-9  # sums differ in their last digits by the order of terms
        while cursors:
            cursors.sort(key=lambda c: c[0][c[2]])
            reach, pivot = 0.0, None
            for c in cursors:
                reach += c[3]
                if reach >= slack:
                    pivot = c[0][c[2]]
                    break
            if pivot is None:
                break
            if cursors[0][0][cursors[0][2]] == pivot:
                score = math.fsum(c[1][c[2]] for c in cursors if c[0][c[2]] == pivot)
                if score >= threshold:
                    out.append((pivot, score))
                pivot += 1
            for c in cursors:
                while c[2] < len(c[0]) and c[0][c[2]] < pivot:
                    c[2] += 1
            cursors = [c for c in cursors if c[2] < len(c[0])]
        return out


def _within(index: Index, strip_of, term_of, strips_at, blocks_at, threshold: float) -> Iterator[tuple[int, int]]:
    """The passages and blocks whose bound still reaches the threshold when words of both strips count once."""
    for s in np.unique(strips_at).tolist():
        a, b = np.searchsorted(strip_of, (s, s + 2))
        blocks = blocks_at[strips_at == s]
        bounds = index.block_max[np.unique(term_of[a:b])[:, None], blocks].sum(axis=0)
        for block in blocks[bounds >= threshold - 1e-4].tolist():
            yield s, block


def find(index: Index, texts: list[str | None], threshold: float, overlap: float) -> list[list[tuple[int, float, int]]]:
    """Per text the verified hits: (item id, score of its best passage, that passage's first word).

    A passage is two neighbouring strips of as many words as the longest item has, so an item's text always lies whole
    in one passage. Upper bounds of all passages come from the block maxima of their distinct words; only blocks of
    items whose bound reaches the threshold are searched.
    """
    out: list[list[tuple[int, float, int]]] = [[] for _ in texts]
    if not index.ids:
        return out
    strip, lookup, unknown = index.longest, index.vocabulary.get, len(index.vocabulary)
    for n, text in enumerate(texts):
        words = words_of(text)
        best: dict[int, tuple[float, int]] = {}
        per_round = max(2, BLOCK_WORDS // strip)
        strips = -(-len(words) // strip)
        for first in range(0, max(1, strips - 1), per_round - 1):
            part = words[first * strip : (first + per_round) * strip]
            terms = np.array([lookup(w, unknown) for w in part], np.int64)
            place = np.flatnonzero(terms < unknown)
            if not len(place):
                continue
            pairs = np.unique(place // strip * (unknown + 1) + terms[place])
            strip_of, term_of = pairs // (unknown + 1), pairs % (unknown + 1)
            starts = np.flatnonzero(np.r_[True, np.diff(strip_of) > 0])
            count = max(1, -(-len(part) // strip))
            bounds = np.zeros((count + 1, index.blocks), np.float32)
            bounds[strip_of[starts]] = np.add.reduceat(index.block_max[term_of], starts, axis=0)
            reach = bounds[:-1] + bounds[1:]
            strips_at, blocks_at = np.nonzero(reach >= threshold - 1e-4)
            for s, block in _within(index, strip_of, term_of, strips_at, blocks_at, threshold):
                a, b = np.searchsorted(strip_of, (s, s + 2))
                for item, score in index.search(np.unique(term_of[a:b]).tolist(), block, threshold):
                    passage = part[s * strip : (s + 2) * strip]
                    question, answer = index.needs[item]
                    if _holds(question, passage) >= overlap and _holds(answer, passage) >= overlap:
                        at = (first + int(s)) * strip
                        best[item] = max(best.get(item, (0.0, 0)), (score, -at))
        out[n] = sorted(((index.ids[i], s, -at) for i, (s, at) in best.items()), key=lambda h: (h[0] is None, h[0] or 0))
    return out


_indexes: dict[str, Index] = {}


def _index(key: str, sent) -> Index:
    """The index of broadcast items and statistics, built once per worker."""
    if key not in _indexes:
        if len(_indexes) >= 2:
            _indexes.clear()
        _indexes[key] = Index(*sent.value)
    return _indexes[key]


_HITS = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int64())]))


def _add_hits(key: str, sent, threshold: float, overlap: float):
    """Texts become the hits of one index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(key, sent)
        for batch in batches:
            found = find(index, batch.column("whole_text").to_pylist(), threshold, overlap)
            hits = pa.array([[{"item_id": i, "score": s, "first_word": w} for i, s, w in f] for f in found], _HITS)
            yield pa.RecordBatch.from_arrays([batch.column(0), hits], [batch.schema.names[0], "hits"])

    return run


def _without_hits(column: int, key: str, sent, threshold: float, overlap: float):
    """Rows whose text has no hit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(key, sent)
        for batch in batches:
            found = find(index, batch.column(column).to_pylist(), threshold, overlap)
            yield batch.filter(pa.array([not f for f in found], pa.bool_()))

    return run


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per item that has words, a row per distinct one, the first of which has the number of all its words."""
    for batch in batches:
        groups, words, lengths = [], [], []
        for group, text in zip(batch.column("item_group").to_pylist(), batch.column("item_text").to_pylist(), strict=True):
            question, answer = split_item(text or "")
            distinct = sorted({*question, *answer})
            groups += [group] * len(distinct)
            words += distinct
            lengths += [len(question) + len(answer), *[None] * (len(distinct) - 1)] if distinct else []
        columns = [pa.array(groups, pa.int64()), pa.array(words, pa.binary()), pa.array(lengths, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["item_group", "word", "n_words"])


def item_blocks(
    items: DataFrame, index_bytes: int = INDEX_BYTES
) -> tuple[Iterator[tuple[list[tuple[int, str]], Statistics | None]], bool]:
    """The items in groups whose texts have about `index_bytes` each, fetched group by group, with the statistics of all,
    and whether there are several groups.

    Of the statistics a group gets those of its own words, so what is fetched is bound by its text. A single group
    has none, as they are those of its items.
    """
    rows = items.select("item_id", F.col("text").alias("item_text"))
    total = rows.agg(F.sum(F.octet_length("item_text"))).first()[0] or 0
    groups = -(-total // index_bytes) or 1
    return _blocks(rows, groups), groups > 1


def _blocks(rows: DataFrame, groups: int) -> Iterator[tuple[list[tuple[int, str]], Statistics | None]]:
    if groups == 1:
        yield [(r["item_id"], r["item_text"] or "") for r in rows.collect()], None
        return
    rows = write_stage(rows.withColumn("item_group", F.pmod(F.xxhash64("item_id", "item_text"), F.lit(groups))), "items")
    found = rows.select("item_group", "item_text").mapInArrow(_item_words, "item_group long, word binary, n_words long")
    words = write_stage(found, "item-words")
    count, length, longest = words.agg(F.count("n_words"), F.sum("n_words"), F.max("n_words")).first()
    holding = write_stage(words.groupBy("word").agg(F.count("*").alias("holding")), "item-holding")
    for g in range(groups):
        block = [(r["item_id"], r["item_text"] or "") for r in rows.filter(F.col("item_group") == g).drop("item_group").collect()]
        own = words.filter(F.col("item_group") == g).select("word").distinct().join(holding, "word")
        by_word = {bytes(r["word"]): r["holding"] for r in own.collect()}
        yield block, Statistics(count, length or 0, longest or 1, by_word)


_HIT_TYPE = "array<struct<item_id: long, score: double, first_word: long>>"


def _hits_by_group(texts: DataFrame, blocks: Iterator, threshold: float, overlap: float) -> DataFrame:
    """(row_no, hits) of the texts (row_no, whole_text) that have any, one group of items after the other.

    Each group is a job of its own whose hits are written down, so a task has one index at a time, whatever the number
    of groups, and only one group's items are sent at once.
    """
    found = []
    for block in blocks:
        sent = texts.sparkSession.sparkContext.broadcast(block)
        hits = texts.mapInArrow(_add_hits(uuid.uuid4().hex, sent, threshold, overlap), f"row_no long, hits {_HIT_TYPE}")
        found.append(write_stage(hits.filter(F.size("hits") > 0), "item-hits"))
        sent.destroy()
    hits = functools.reduce(DataFrame.unionByName, found)
    return hits.groupBy("row_no").agg(F.flatten(F.collect_list("hits")).alias("hits"))


def contaminations(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, text: str = "text",
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """One row per document: doc_id, hits (item_id, score, first_word of the passage), by item_id.

    Null and empty texts, and items without words, have no hits; equal items all hit. Items of more than `index_bytes`
    are searched in several rounds of the documents, with the statistics of all items in each, so that hits and scores
    do not depend on the number of rounds. Other columns are not read; an empty table gives an empty result.
    """
    spark = settings(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("whole_text"))
    blocks, several = item_blocks(items, index_bytes)
    if several:
        rows = numbered(rows)
        texts = rows.select("row_no", F.col("whole_row")["whole_text"].alias("whole_text"))
        found = rows.join(_hits_by_group(texts, blocks, threshold, overlap), "row_no", "left")
        found = found.select(F.col("whole_row")["doc_id"].alias("doc_id"), F.coalesce("hits", F.array().cast(_HIT_TYPE)).alias("hits"))
    else:
        sent = spark.sparkContext.broadcast(next(blocks))
        found = rows.mapInArrow(_add_hits(uuid.uuid4().hex, sent, threshold, overlap), f"doc_id long, hits {_HIT_TYPE}")
    by_item = F.expr("array_sort(hits, (a, b) -> int(sign(coalesce(a.item_id, -1) - coalesce(b.item_id, -1))))")
    return found.select("doc_id", by_item.alias("hits"))


def drop_contaminated(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, text: str = "text",
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """`docs` without those that hold an item's question and answer.

    Null and empty texts stay, as do all if there are no items. Repeated rows share their fate: all stay or all go.
    Equal items, and items without words, change nothing. Columns may have any name and type that Arrow has. An empty
    table stays empty. With one group of items nothing is shuffled; with several the rows are written down once, and
    those to drop are found by their number.
    """
    spark = settings(docs.sparkSession)
    blocks, several = item_blocks(items, index_bytes)
    if several:
        rows = numbered(docs)
        texts = rows.select("row_no", F.col("whole_row")[text].alias("whole_text"))
        found = _hits_by_group(texts, blocks, threshold, overlap)
        return drop_rows(rows, found.select("row_no", F.lit(False).alias("kept")))
    sent = spark.sparkContext.broadcast(next(blocks))
    return docs.mapInArrow(
        _without_hits(docs.columns.index(text), uuid.uuid4().hex, sent, threshold, overlap), docs.schema
    )
