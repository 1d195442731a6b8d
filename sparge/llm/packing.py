"""Packing along a space-filling curve: neighbouring documents fill the same training sequences.

A document's token counts are hashed to a vector, projected to a few dimensions and placed on a Hilbert curve. In the
curve's order the documents form one stream of tokens, cut every `length` tokens: only the last sequence is padded.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sparge.llm.common import running_offsets, settings, write_stage

LENGTH = 2048
END = 1
TOKENIZER = "byte_bpe_50k.json"
BUCKETS = 256
DIMENSIONS = 4
BITS = 12  # of the curve per dimension
SEED = 7
# Token ids of this many words are kept by a worker, twice (see Encoder).
KEPT_WORDS = 600_000
# Words encoded at once, how the vocabulary writes a blank, and signs that are neither letter, digit, blank nor the apostrophe of a contraction.
LINE_WORDS = 500
BLANK = "\u0120"
SIGNS = ".,;:!?*$%&#()[]\"-"

# Before a blank that a non-blank follows, a byte-level pre-tokenizer always cuts, whatever stands around it.
_CUT = re.compile(r" (?=\S)")


class Encoder:
    """Token ids as the `tokenizers` library gives them, word by word with a memory.

    Words (with the blank before them) are encoded separately; that equals encoding the whole text as long as the
    tokenizer is byte-level BPE that pre-tokenizes by the usual pattern and the text has none of its special strings.
    Any other text or tokenizer is encoded whole. The memory has two generations: when the young one is full it becomes
    the old one, and what is still used moves back.
    """

    def __init__(self, path: str, kept_words: int = KEPT_WORDS):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        pre = self.tokenizer.pre_tokenizer
        self.by_word = (
            isinstance(pre, pre_tokenizers.ByteLevel) and not pre.add_prefix_space and pre.use_regex
            and self.tokenizer.normalizer is None
        )
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kept_words, self.young, self.old = kept_words, {}, {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.begins = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.begins[[i for t, i in vocabulary.items() if t[0] == BLANK]] = True
        self.line_end = self._whole("\n")

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _learn(self, words: list[str]) -> None:
        """Encode words without a blank in them as one text: a token that begins with a blank begins the next word."""
        lines = [words[at : at + LINE_WORDS] for at in range(0, len(words), LINE_WORDS)]
        found = self.tokenizer.encode_batch_fast([" " + " ".join(x) for x in lines], add_special_tokens=False)
        for line, encoding in zip(lines, found, strict=True):
            ids = np.array(encoding.ids, "<u4")
            cuts = [*(4 * np.flatnonzero(self.begins[ids])).tolist(), 4 * len(ids)]
            self.young.update(zip(line, map(ids.tobytes().__getitem__, map(slice, cuts, cuts[1:])), strict=True))

    def _learn_firsts(self, words: list[str]) -> None:
        """The same for words at the beginning of a line, which have no blank: the token of the line's end divides them."""
        lines = [words[at : at + LINE_WORDS] for at in range(0, len(words), LINE_WORDS)]
        found = self.tokenizer.encode_batch_fast(["\n".join(x) for x in lines], add_special_tokens=False)
        for line, encoding in zip(lines, found, strict=True):
            ids = np.array(encoding.ids, "<u4")
            ends = np.flatnonzero(ids == self.line_end[0]).tolist()
            data = ids.tobytes()
            for w, i, j in zip(line, [-1, *ends], [*ends, len(ids)], strict=True):
                self.young[(w,)] = data[4 * (i + 1) : 4 * j]

    def _over_lines(self, new: set[str]) -> list[tuple[str, list[str]]]:
        """Words that run over single line ends, with their lines: line ends are always pre-tokenized apart."""
        if len(self.line_end) != 1:
            return []
        found = [(w, w.split()) for w in new if "\n" in w and w not in self.old]
        return [(w, lines) for w, lines in found if w == "\n".join(lines)]

    def _remember(self, new: set[str]) -> None:
        """Fill the memory for words that the young generation does not have."""
        young, old, unknown, ended = self.young, self.old, set(), []
        if over := self._over_lines(new):
            new = {*new.difference(w for w, _ in over), *(lines[0] for _, lines in over if lines[0] not in young)}
            firsts = {x for _, lines in over for x in lines[1:] if (x,) not in young}
            if firsts := [x for x in firsts if (ids := old.get((x,))) is None or young.setdefault((x,), ids) is None]:
                self._learn_firsts(firsts)
        for w in new:
            if (ids := old.get(w)) is not None:
                young[w] = ids
            elif (bare := w.rstrip(SIGNS)) != w and bare[-1:].isalpha():
                # Letters and the signs after them are always pre-tokenized apart, so their ids stand side by side.
                ended.append((w, bare, w[len(bare) :]))
                if bare not in young:
                    unknown.add(bare)
            else:
                unknown.add(w)
        if unknown := [w for w in unknown if (ids := old.get(w)) is None or young.setdefault(w, ids) is None]:
            self._learn(unknown)
        for w, bare, signs in ended:
            tail = young.get((signs,))
            if tail is None:
                tail = young[(signs,)] = self._whole(signs).tobytes()
            young[w] = young[bare] + tail
        for w, lines in over:
            young[w] = self.line_end.tobytes().join([young[lines[0]], *(young[(x,)] for x in lines[1:])])

    def encode(self, text: str) -> np.ndarray:
        if not self.by_word or any(s in text for s in self.specials):
            return self._whole(text)
        head, *words = text.split(" ")
        if len(self.young) > self.kept_words:
            self.old, self.young = self.young, {}
        found = list(map(self.young.get, words))
        if None in found:
            gaps = [i for i, ids in enumerate(found) if ids is None]
            new = {words[i] for i in gaps}
            if any(not w or w[0].isspace() for w in new):  # blanks in a row: the library cuts them itself
                return self._pieces(text)
            self._remember(new)
            for i in gaps:
                found[i] = self.young[words[i]]
        return np.frombuffer(self._whole(head).tobytes() + b"".join(found), "<u4")

    def _pieces(self, text: str) -> np.ndarray:
        return np.concatenate([self._whole(p if i == 0 else " " + p) for i, p in enumerate(_CUT.split(text))])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


@lru_cache(2)
def _random(vocabulary: int, buckets: int, dimensions: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    dice = np.random.default_rng(seed)
    return (
        dice.integers(0, buckets, vocabulary),
        dice.choice([-1.0, 1.0], vocabulary),
        dice.standard_normal((buckets, dimensions)),
    )


def hashed_counts(ids: np.ndarray, vocabulary: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """A document's token counts, hashed to signed buckets."""
    bucket, sign, _ = _random(vocabulary, BUCKETS, dimensions, SEED)
    return np.bincount(bucket[ids], weights=sign[ids], minlength=BUCKETS)


def cells(vectors: np.ndarray, vocabulary: int, dimensions: int = DIMENSIONS, bits: int = BITS) -> np.ndarray:
    """Grid cells of documents (rows): vectors at unit length, projected; the projections are near normal."""
    projection = _random(vocabulary, BUCKETS, dimensions, SEED)[2]
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]
    # Not a matrix product, whose rounding may depend on how many rows there are.
    places = np.einsum("ij,jk->ik", vectors / np.where(norms > 0, norms, 1), projection)
    found = np.floor((np.tanh(places / 2) + 1) / 2 * (1 << bits))
    return np.clip(found, 0, (1 << bits) - 1).astype(np.int64)


def hilbert(cell: np.ndarray | list, bits: int = BITS) -> np.ndarray:
    """Positions of grid cells (rows) on the Hilbert curve: undo the rotations from the top bit down, then Gray-decode."""
    x = np.array(cell, np.int64).reshape(-1, np.shape(cell)[-1]).T.copy()
    n = len(x)
    for at in range(bits - 1, 0, -1):
        q = 1 << at
        for i in range(n):
            high = (x[i] & q) > 0
            swapped = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[i] ^= swapped
            x[0] ^= np.where(high, q - 1, swapped)
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turned = np.zeros_like(x[0])
    for at in range(bits - 1, 0, -1):
        turned ^= np.where((x[-1] >> at) & 1 > 0, (1 << at) - 1, 0)
    x ^= turned
    out = np.zeros_like(turned)
    for at in range(bits - 1, -1, -1):
        for i in range(n):
            out = out << 1 | (x[i] >> at & 1)
    return out


def _tokenise(path: str, end: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, row = encoder(path), TaskContext.get().partitionId() << 40
        vocabulary = max(enc.tokenizer.get_vocab_size(with_added_tokens=True), end + 1)
        kind = "<u2" if vocabulary <= 1 << 16 else "<u4"
        for batch in batches:
            texts = batch.column("whole_text").to_pylist()
            if not texts:
                continue
            ids = [np.append(enc.encode(t or ""), np.uint32(end)) for t in texts]
            vectors = np.array([hashed_counts(i, vocabulary) for i in ids])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.arange(row, row + len(ids))), pa.array([len(i) for i in ids], pa.int64()),
                 pa.array(hilbert(cells(vectors, vocabulary))), pa.array([i.astype(kind).tobytes() for i in ids], pa.binary())],
                ["doc_id", "row_no", "doc_tokens", "curve_key", "ids"],
            )
            row += len(ids)

    return run


def _cut(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, starts, sizes, totals, sequences, offsets, ids = [], [], [], [], [], [], []
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "doc_tokens", "offset", "ids")]
            for doc, total, offset, stored in zip(*columns, strict=True):
                whole = np.frombuffer(stored, f"<u{len(stored) // total}").astype("<u4")
                start = 0
                while start < total:
                    at = (offset + start) % length
                    size = min(length - at, total - start)
                    docs.append(doc)
                    starts.append(start)
                    sizes.append(size)
                    totals.append(total)
                    sequences.append((offset + start) // length)
                    offsets.append(at)
                    ids.append(whole[start : start + size].tobytes())
                    start += size
            longs = [pa.array(c, pa.int64()) for c in (docs, starts, sizes, totals, sequences, offsets)]
            names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*longs, pa.array(ids, pa.binary())], [*names, "ids"])

    return run


def pack(
    docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None, end: int = END, text: str = "text"
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (32-bit little-endian).

    Every document is its ids and the id `end`; null and empty texts are that id alone. The stream in curve order
    (ties: the order in which rows were read) is cut every `length` ids, so all sequences but the last are full and a
    long document runs over as many as it needs. Other columns are not read. An empty table gives an empty result.
    `tokenizer` is a path that all executors have; the default is a file of the installed tokenizers.

    Texts are tokenised once, and their ids written to the shared folder. Only keys and sizes are sorted; the ids are
    joined to their offsets as the unsorted, streamed side of a hash join.
    """
    settings(docs.sparkSession)
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("whole_text"))
    tokens = write_stage(
        rows.mapInArrow(_tokenise(path, end), "doc_id long, row_no long, doc_tokens long, curve_key long, ids binary"), "ids"
    )
    placed = running_offsets(tokens.select("curve_key", "row_no", "doc_tokens"), ["curve_key", "row_no"], "doc_tokens")
    offsets = placed.select("row_no", "offset")
    joined = tokens.join(offsets.hint("shuffle_hash"), "row_no").select("doc_id", "doc_tokens", "offset", "ids")
    return joined.mapInArrow(
        _cut(length),
        "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary",
    )


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    crc = F.crc32("ids").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset")
