"""Phrase collocation mining with an FM-index per shard.

Texts become shards of word numbers. Each shard is indexed in both directions: the Burrows-Wheeler transforms of the
sequence and of its reverse, sorted as deep as phrases are long. A phrase is a pair of intervals of rows; one step
extends all phrases by all words that follow them, and the rows' neighbours tell whether one and the same word stands
before, or after, every occurrence. Shards give counts of their phrases, Spark sums them.

Lengths are mined one after the other. A phrase can only be frequent if its words and the phrases within it are, so
after each length a Bloom filter of the frequent ones, of bounded size, goes to all tasks. Phrases of the next length
are first counted by hash alone; only those whose hash is frequent are then written out and counted exactly. What
passes by chance costs time and is dropped by its count: results do not depend on the filter.

A task reads one shard at a time and mines it in blocks of rows, so what its Python takes is bounded by a shard, whatever
number of shards it is given and whatever share of their words is frequent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from sparge.llm.common import settings, write_stage

MIN_COUNT = 100
LONGEST = 5
TOP = 2000
# Words of one shard, about, by so many characters to a word; and characters whose words a task counts before it hands them on.
SHARD_WORDS = 1 << 19
WORD_CHARS = 5
COUNTED_CHARS = 1 << 23
# Rows of an index, or phrases, that are worked on at once; and words that are Python objects at once.
BLOCK_ROWS = 1 << 17
HASHED_WORDS = 1 << 14
# Bits of a filter: 16 per frequent phrase, at most 16 MB. Two bits are set per phrase.
FILTER_BITS = 1 << 27
FILTER_BITS_EACH = 16
SEED = 13
STEP = np.uint64(0x9E3779B97F4A7C15)

# Bytes by meaning: A-Z in lower case, the tab as blank, and all marks that end a piece as a full stop.
_MARKS = b".,;:!?\x0a\x0b\x0c\x0d"
_BYTES = bytes(46 if b in _MARKS else b + 32 if 65 <= b <= 90 else 32 if b == 9 else b for b in range(256))


def split_words(texts: list[str]) -> tuple[pa.BinaryArray, np.ndarray]:
    """All words as UTF-8, in order; and the places, among the words, before which a piece or a text ends."""
    line = np.frombuffer(".".join(texts).encode("utf-8", "surrogatepass").translate(_BYTES), np.uint8)
    stop = line == 46
    inside = ~(stop | (line == 32))
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(line[inside])])
    ends = np.searchsorted(np.flatnonzero(stop), starts)
    return words, np.flatnonzero(np.diff(ends)) + 1


def text_blocks(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[dict[str, list[str]]]:
    """Texts by language, about so many characters at a time."""
    texts: dict[str, list[str]] = {}
    held = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("whole_text").to_pylist(), strict=True):
            if text:
                texts.setdefault(lang, []).append(text)
                held += len(text) + 1
            if held >= chars:
                yield texts
                texts, held = {}, 0
    if texts:
        yield texts


def word_hashes(lang: str, words: pa.BinaryArray) -> np.ndarray:
    digest, prefix = xxhash.xxh64_intdigest, lang.encode("utf-8", "surrogatepass") + b"\0"
    parts = (words.slice(at, HASHED_WORDS).to_pylist() for at in range(0, len(words), HASHED_WORDS))
    return np.fromiter((digest(prefix + w, SEED) for part in parts for w in part), np.uint64, len(words))


def phrase_hashes(words: np.ndarray) -> np.ndarray:
    """A hash per row of word hashes; a phrase of one word has its word's."""
    found = words[:, 0].copy()
    for column in range(1, words.shape[1]):
        found = (found ^ (found >> np.uint64(29))) * STEP + words[:, column]
    return found


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a hash in a filter."""
    mixed = (hashes ^ (hashes >> np.uint64(32))) * STEP
    return mixed >> np.uint64(64 - bits.bit_length() + 1), (mixed * STEP) >> np.uint64(64 - bits.bit_length() + 1)


@dataclass
class Filter:
    """Bloom filter over phrase hashes."""

    bits: int
    words: np.ndarray

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for place in _places(hashes, self.bits):
            found &= (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
        return found


def _filter_places(bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.concatenate(_places(batch.column(0).to_numpy().view(np.uint64), bits))
            word, bit = (places >> np.uint64(6)).astype(np.int64), (np.uint64(1) << (places & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bit)], ["word_no", "word_bits"])

    return run


def build_filter(hashes: DataFrame, count: int, most_bits: int = FILTER_BITS) -> Filter:
    """Filter of the hashes in the first column; only its words, bounded by `most_bits`, come to the driver."""
    bits = min(most_bits, max(1024, 1 << (FILTER_BITS_EACH * count - 1).bit_length() if count else 0))
    set_bits = hashes.mapInArrow(_filter_places(bits), "word_no long, word_bits long").groupBy("word_no").agg(F.bit_or("word_bits").alias("word_bits"))
    table = set_bits.toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[table.column("word_no").to_numpy()] = table.column("word_bits").to_numpy().view(np.uint64)
    return Filter(bits, words)


# --- words ------------------------------------------------------------------

def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for texts in text_blocks(batches, COUNTED_CHARS):
        parts = []
        for lang, found in texts.items():
            words, counts = split_words(found)[0].value_counts().flatten()
            hashes = pa.array(word_hashes(lang, words).view(np.int64))
            parts.append((pa.repeat(pa.scalar(lang, pa.string()), len(words)), words.cast(pa.string()), counts, hashes))
        columns = list(map(pa.concat_arrays, zip(*parts, strict=True)))
        yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "f", "phrase_hash"])


# --- shards -----------------------------------------------------------------

# Numbers; languages, and the last number of each; words, with blanks between them, and their hashes.
SHARD = pa.schema({"shard": pa.binary(), "langs": pa.list_(pa.string()), "ends": pa.list_(pa.int32()), "words": pa.binary(), "hashes": pa.binary()})
SHARD_ROW = "shard binary, langs array<string>, ends array<int>, words binary, hashes binary"


@contextmanager
def one_at_a_time(spark: SparkSession) -> Iterator[None]:
    """Within the block rows are read, and handed to Python, one by one: a shard is some megabytes."""
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = {name: spark.conf.get(name) for name in names}
    for name in names:
        spark.conf.set(name, "1")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def covered(sequence: np.ndarray, length: int, passes: Callable[[np.ndarray], np.ndarray] | None = None) -> np.ndarray:
    """What phrases of `length` numbers that pass cover, with a 0 after each run: the rest has no such phrase.

    Without `passes` all phrases without a 0 pass; it gets the phrases as rows.
    """
    inside = np.zeros(len(sequence) + 1, bool)
    places = max(0, len(sequence) - length + 1)
    for first in range(0, places, BLOCK_ROWS):
        starts = np.arange(first, min(places, first + BLOCK_ROWS))
        for at in range(length):
            starts = starts[sequence[starts + at] > 0]
        if passes is not None and len(starts):
            starts = starts[passes(np.stack([sequence[starts + at] for at in range(length)], axis=1))]
        for at in range(length):
            inside[starts + at] = True
    ends = np.append(False, inside[:-1]) & ~inside  # the place after a run
    padded = np.append(sequence, np.int32(0))
    padded[ends] = 0
    return padded[inside | ends]


def _encode(frequent: Callable[[], Filter], shard_words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Shards: runs of words that may be frequent, as numbers from 1 and a 0 after each run; runs of one word have no phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frequent()
        for texts in text_blocks(batches, shard_words * WORD_CHARS):
            langs, words, hashes, numbers, named = [], [], [], [], 0
            for lang, found in texts.items():
                split, ends = split_words(found)
                coded = split.dictionary_encode()
                digests = word_hashes(lang, coded.dictionary)
                passes = known.has(digests)
                number = np.where(passes, named + np.cumsum(passes), 0).astype(np.int32)
                numbers += [np.insert(number[coded.indices.to_numpy()], ends, 0), np.zeros(1, np.int32)]
                words += coded.dictionary.filter(pa.array(passes)).to_pylist()
                hashes.append(digests[passes])
                named = len(words)
                langs.append((lang, named))
            if named:
                # No word holds a blank. Few large values: lists of so many words cost the JVM far more than they hold.
                values = covered(np.concatenate(numbers), 2).astype("<i4"), np.concatenate(hashes).astype("<u8")
                columns = [[values[0].tobytes()], [[x for x, _ in langs]], [[x for _, x in langs]], [b" ".join(words)], [values[1].tobytes()]]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns, SHARD.types)), schema=SHARD)

    return run


# --- the index --------------------------------------------------------------

def suffix_order(sequence: np.ndarray, depth: int) -> np.ndarray:
    """Starts of suffixes, sorted by their first `depth` numbers; equal ones by place."""
    n = len(sequence)
    width = max(1, int(sequence.max(initial=0)).bit_length())
    # As many numbers as fit make the first key; ranks of what is sorted so far make the following ones.
    done = min(depth, 62 // width)
    key = np.zeros(n, np.int64)
    for at in range(done):
        key <<= width
        key[: n - at] |= sequence[at:]
    order = np.argsort(key, kind="stable")
    while done < depth:
        more = min(done, depth - done)
        ranks = np.empty(n, np.int64)
        ranks[order] = np.cumsum(np.append(True, key[order][1:] != key[order][:-1]))
        key = ranks * (n + 1)
        key[: n - more] += ranks[more:]  # the first numbers, and as many from `more` on
        order = np.argsort(key, kind="stable")
        done += more
    return order


class Direction:
    """Burrows-Wheeler transform of a sequence, for phrases of up to `depth` numbers read from right to left."""

    def __init__(self, sequence: np.ndarray, depth: int):
        order = suffix_order(sequence, depth)
        row_of = np.empty(len(order), np.int32)
        row_of[order] = np.arange(len(order), dtype=np.int32)
        order -= 1
        self.before = sequence[order]  # of the first suffix: the last number, which is 0
        self.to_row = row_of[order]  # the row of the suffix that begins one place earlier
        self.changes = np.cumsum(np.append(False, self.before[1:] != self.before[:-1]), dtype=np.int32)

    def only(self, low: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The number that stands before all rows of an interval, else 0."""
        return np.where(self.changes[low] == self.changes[low + size - 1], self.before[low], 0)


@dataclass
class Phrases:
    """Phrases of one length in a shard: numbers, how often, and their intervals in the forward and the reverse index."""

    grams: np.ndarray
    size: np.ndarray
    low: np.ndarray
    back: np.ndarray

    def where(self, keep: np.ndarray) -> Phrases:
        return Phrases(self.grams[keep], self.size[keep], self.low[keep], self.back[keep])


def _reversed(sequence: np.ndarray) -> np.ndarray:
    """The zero that ends the sequence would come first; moved to its end it closes the last run again."""
    return np.append(sequence[-2::-1], sequence[-1])


def phrases(
    sequence: np.ndarray, hashes: np.ndarray, length: int, filters: list[Filter], backward: Direction, chunk_rows: int = BLOCK_ROWS
) -> tuple[Phrases, np.ndarray, np.ndarray]:
    """Phrases of `length` numbers that `filters` pass; and, of those one longer, hashes and counts.

    `filters` are those of lengths 2 to `length`. A phrase one longer counts if both phrases within it pass.
    """
    totals = np.bincount(sequence, minlength=len(hashes) + 1).astype(np.int32)
    starts = np.cumsum(totals, dtype=np.int32) - totals
    words = np.flatnonzero(totals[1:]).astype(np.int32) + 1
    found = Phrases(words[:, None], totals[words], starts[words], starts[words].copy())
    passes = lambda kind, grams: filters[kind - 2].has(phrase_hashes(hashes[grams - 1]))
    for reached in range(2, length + 1):
        parts = []
        for block in _blocks(found.size, chunk_rows):
            longer = _extended(backward, found.where(block))
            parts.append(longer.where(passes(reached, longer.grams)))
        found = Phrases(*map(np.concatenate, zip(*[(f.grams, f.size, f.low, f.back) for f in parts], strict=True))) if parts else found
    if found.grams.shape[1] < length:
        found = Phrases(np.zeros((0, length), np.int32), *[found.size[:0]] * 3)
    more, counts = [np.zeros(0, np.uint64)], [found.size[:0]]
    for block in _blocks(found.size, chunk_rows):
        longer = _extended(backward, found.where(block))
        if length > 1:
            longer = longer.where(passes(length, longer.grams[:, 1:]))
        more.append(phrase_hashes(hashes[longer.grams - 1]))
        counts.append(longer.size)
    return found, np.concatenate(more), np.concatenate(counts)


def _blocks(size: np.ndarray, rows: int) -> list[slice]:
    """Consecutive phrases with about so many rows together."""
    if not len(size):
        return []
    block = (np.cumsum(size, dtype=np.int64) - 1) // rows
    cuts = np.flatnonzero(np.diff(block)) + 1
    return [slice(a, b) for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(size)], strict=True)]


def _extended(backward: Direction, found: Phrases) -> Phrases:
    """All phrases with each number that follows them: rows of the reverse index give the numbers and their counts.

    The extended phrase's rows in the forward index lie within those of the phrase, after those that go on with a
    smaller number; in the reverse index they are where the steps to the earlier suffixes lead.
    """
    size, ends = found.size, np.cumsum(found.size, dtype=np.int64)
    owner = np.repeat(np.arange(len(size)), size)
    rows = np.arange(len(owner)) + np.repeat(found.back - (ends - size), size)
    key = owner * (int(backward.before.max(initial=0)) + 1) + backward.before[rows]
    order = np.argsort(key, kind="stable")
    key, rows = key[order], rows[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else owner
    counts = np.diff(np.append(first, len(key)))
    owner_of, next_of = owner[order[first]], backward.before[rows[first]]
    begin = found.low[owner_of] + first - (ends - size)[owner_of]
    back_of = np.minimum.reduceat(backward.to_row[rows], first) if len(first) else first
    longer = np.concatenate([found.grams[owner_of], next_of.astype(np.int32)[:, None]], axis=1)
    return Phrases(longer, counts.astype(np.int32), begin.astype(np.int32), back_of).where(next_of > 0)


SHARD_PHRASES = "phrase_hash long, lang string, phrase string, f long, only_before long, only_after long"


def _mine(length: int, more: bool, filters: Callable[[], list[Filter]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per shard: phrases of `length` words (none of one word), and with `more` the hashes of those one word longer."""

    def rows(*columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(list(columns), ["phrase_hash", "lang", "phrase", "f", "only_before", "only_after"])

    def counted(hashes: np.ndarray, f: np.ndarray) -> tuple[pa.Array, pa.Array]:
        return pa.array(hashes.view(np.int64)), pa.array(f.astype(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = filters()
        for batch in batches:
            for row in range(batch.num_rows):
                sequence = np.frombuffer(batch.column("shard")[row].as_py(), "<i4")
                hashes = np.frombuffer(batch.column("hashes")[row].as_py(), "<u8")
                if length > 1:
                    sequence = covered(sequence, length, lambda grams, digest=hashes: known[length - 2].has(phrase_hashes(digest[grams - 1])))
                if not len(sequence):
                    continue
                backward = Direction(_reversed(sequence), length + more)
                found, longer, counts = phrases(sequence, hashes, length, known, backward)
                if length > 1 and len(found.size):
                    words = pa.array(batch.column("words")[row].as_py().decode().split(" "), pa.string())
                    langs, ends = batch.column("langs")[row].values, batch.column("ends")[row].values.to_numpy()
                    forward = Direction(sequence, length + more)
                    for at in range(0, len(found.size), 1 << 14):
                        part = found.where(slice(at, at + (1 << 14)))
                        sides = (forward.only(part.low, part.size), backward.only(part.back, part.size))
                        digest, f = counted(phrase_hashes(hashes[part.grams - 1]), part.size)
                        yield rows(
                            digest, langs.take(pa.array(np.searchsorted(ends, part.grams[:, 0]))),
                            pc.binary_join_element_wise(*[words.take(pa.array(part.grams[:, at] - 1)) for at in range(length)], " "), f,
                            *[pa.array(hashes.view(np.int64)[side - 1], mask=side == 0) for side in sides],
                        )
                    del words, forward
                del found, backward
                for at in range(0, len(longer) if more else 0, 1 << 16):
                    part = slice(at, at + (1 << 16))
                    digest, f = counted(longer[part], counts[part])
                    nothing = [pa.nulls(len(digest), k) for k in (pa.string(), pa.int64())]
                    yield rows(digest, nothing[0], nothing[0], f, nothing[1], nothing[1])

    return run


# --- results ----------------------------------------------------------------

def frequent_phrases(
    docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, text: str = "text", lang: str = "lang",
    shard_words: int = SHARD_WORDS, filter_bits: int = FILTER_BITS,
) -> tuple[DataFrame, DataFrame]:
    """Words per language (lang, n), and all phrases of 1 to `longest` words that occur `min_count` times or more.

    Phrases: lang, phrase, words (how many), f, extended (whether one word stands before, or one after, every occurrence).
    """
    spark = settings(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("whole_text"))
    counted = rows.mapInArrow(_count_words, "lang string, phrase string, f long, phrase_hash long")
    counted = write_stage(counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f"), F.first("phrase_hash").alias("phrase_hash")), "words")
    totals = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    found = [counted.filter(F.col("f") >= min_count).withColumn("extended", F.lit(False))]
    filters: list[Broadcast] = []

    def sent(hashes: DataFrame, count: int) -> Broadcast:
        return spark.sparkContext.broadcast(build_filter(hashes.select("phrase_hash"), count, filter_bits))

    words = sent(found[0], found[0].count())
    shards = write_stage(rows.mapInArrow(_encode(lambda: words.value, shard_words), SHARD_ROW), "shards")
    words.unpersist()
    one = lambda side: (F.count(side) == F.count(F.lit(1))) & F.min(side).eqNullSafe(F.max(side))
    for length in range(1, longest + 1):
        local = shards.mapInArrow(_mine(length, length < longest, lambda sides=tuple(filters): [f.value for f in sides]), SHARD_PHRASES)
        if length > 1:
            summed = local.groupBy("phrase_hash", "lang", "phrase").agg(
                F.sum("f").alias("f"), (one("only_before") | one("only_after")).alias("extended")
            )
        else:
            summed = local.groupBy("phrase_hash").agg(F.sum("f").alias("f")).withColumn("phrase", F.lit(None).cast("string"))
        with one_at_a_time(spark):
            level = write_stage(summed.filter(F.col("f") >= min_count), "phrases")
        if length > 1:
            found.append(level.filter("phrase IS NOT NULL"))
        longer = level.filter("phrase IS NULL")
        count = longer.count()
        if not count:
            break
        filters.append(sent(longer, count))
    for each in filters:
        each.unpersist()
    tagged = [f.select("lang", "phrase", F.lit(i).alias("words"), "f", "extended") for i, f in enumerate(found, 1)]
    whole = tagged[0]
    for part in tagged[1:]:
        whole = whole.unionByName(part)
    return totals, whole


def _exact(column: str) -> Column:
    return F.col(column).cast(T.DecimalType(38, 0))


def scored(totals: DataFrame, found: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Candidates that no longer one stands for, with their lowest-scoring cut: lang, phrase, a, l, r, n, score.

    Of a phrase that some word always precedes or follows, the longer phrase is as frequent, hence a candidate too
    unless it is too long. Both sides of a cut occur at least as often as the phrase, so they are among the frequent
    ones. Cuts meet their sides in joins; sums are reduced before the shuffle.
    """
    parts = write_stage(found, "frequent")
    kept = parts.filter((F.col("words") > 1) & (~F.col("extended") | (F.col("words") == longest)))
    split = F.split("phrase", " ")
    cut = F.posexplode(F.expr("sequence(1, words - 1)")).alias("place", "k")
    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), "words", cut).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice(split, 1, F.col("k")), " ").alias("left_part"),
        F.array_join(F.slice(split, F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("right_part"),
    )
    for side, name in (("left_part", "l"), ("right_part", "r")):
        cuts = cuts.join(parts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    cuts = cuts.join(totals, "lang").withColumns({c: _exact(c) for c in ("a", "l", "r", "n")})
    cuts = cuts.withColumn("score", F.expr("(1000BD * a * n) div (l * r)"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("best"))
    return best.select("lang", "phrase", *[F.col(f"best.{c}").cast("long").alias(c) for c in ("a", "l", "r", "n", "score")])


def collocations(
    docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, text: str = "text", lang: str = "lang",
    shard_words: int = SHARD_WORDS, filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """The `top` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Ranked by score, then by count, both descending, then by the phrase's bytes. Null and empty texts have no words; a
    null language is `und`. Repeated rows count each. Languages without a phrase are absent, an empty table gives an
    empty result. Other columns are not read. A text is held by one task at a time, like any row.
    """
    best = scored(*frequent_phrases(docs, min_count, LONGEST, text, lang, shard_words, filter_bits))
    # A limit on the rank reaches the tasks before the shuffle: each sends at most `top` rows of a language.
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = best.withColumn("rank", place).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


COLLOCATIONS_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang,
                  unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM p),
grams AS (SELECT lang, k AS words, array_to_string(words[i:i + k - 1], ' ') AS phrase
          FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM w, range(1, 6) r(k))),
f AS (SELECT lang, words, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
n AS (SELECT lang, count(*) AS n FROM grams WHERE words = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE words > 1),
inner_ AS (SELECT DISTINCT lang, phrase, f FROM
             (SELECT lang, f, array_to_string(string_split(phrase, ' ')[1:words - 1], ' ') AS phrase FROM c
              UNION ALL SELECT lang, f, array_to_string(string_split(phrase, ' ')[2:words], ' ') FROM c)),
kept AS (SELECT * FROM c ANTI JOIN inner_ USING (lang, phrase, f)),
cuts AS (SELECT lang, phrase, f AS a, words, k FROM kept, range(1, 5) r(k) WHERE k < words),
s AS (SELECT cuts.lang, cuts.phrase, a, k, x.f AS l, y.f AS r, n,
             (1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS score
      FROM cuts JOIN n USING (lang)
      JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(string_split(cuts.phrase, ' ')[1:k], ' ')
      JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(string_split(cuts.phrase, ' ')[k + 1:cuts.words], ' ')),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
top AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM top WHERE rank <= 2000
"""
