"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram is bound from its letters: position j's letter vector is
permuted (rolled) j times and the vectors are multiplied. A text bundles (adds up) the vectors of its n-grams, a
language those of its texts at equal weight. A text gets the language whose prototype has the largest cosine.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sparge.llm.common import settings

DIMENSIONS = 1024
NGRAM = 3
SEED = 20_24
# Characters handled at once, and n-gram vectors kept by a worker; beyond them work goes on in further rounds.
BLOCK_CHARS = 1 << 20
KEPT_NGRAMS = 20_000

UNKNOWN = "und"
_NO_WORDS = re.compile(r"[\W\d_]+")
# Beyond ASCII, word characters may also be numerals (as in ½, ① or Ⅷ), which are not letters.
_BEYOND_ASCII = re.compile(r"[^\x00-\x7F]")


@lru_cache(1 << 16)
def _kept(character: str) -> str:
    return character if character.isalpha() or not (character.isnumeric() or character.isdigit()) else " "


def letters_only(text: str) -> str:
    """A text in lower case whose letters stand in words with a blank between them: all else is left out."""
    lowered = text.lower()
    if not lowered.isascii():
        lowered = _BEYOND_ASCII.sub(lambda m: _kept(m.group()), lowered)
    return _NO_WORDS.sub(" ", lowered).strip()


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


class Profiles:
    """Letter and n-gram vectors of one worker; every worker derives the same ones from the seed."""

    def __init__(self, dimensions: int = DIMENSIONS, n: int = NGRAM, seed: int = SEED):
        self.dimensions, self.n, self.seed = dimensions, n, seed
        self.letters: dict[int, np.ndarray] = {}
        self.grams: dict[int, int] = {}
        self.table = np.zeros((0, dimensions), np.float32)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            bits = np.random.default_rng([self.seed, code]).integers(0, 2, self.dimensions, dtype=np.int8)
            if len(self.letters) >= KEPT_NGRAMS:
                self.letters.clear()
            self.letters[code] = 2 * bits - 1
        return self.letters[code]

    def bind(self, key: int) -> np.ndarray:
        """The vector of an n-gram; `key` holds its code points, 21 bits each, the last one lowest."""
        out = np.ones(self.dimensions, np.int8)
        for j in range(self.n):
            out = out * np.roll(self.letter(key >> 21 * j & 0x1FFFFF), j)
        return out

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """Vectors of distinct n-grams."""
        if len(self.grams) + len(keys) > KEPT_NGRAMS:
            self.grams, self.table = {}, self.table[:0]
        new = [k for k in keys.tolist() if k not in self.grams]
        if new:
            self.table = np.vstack([self.table, np.array([self.bind(k) for k in new], np.float32)])
            self.grams.update(zip(new, range(len(self.grams), len(self.grams) + len(new)), strict=True))
        return self.table[[self.grams[k] for k in keys.tolist()]]

    def keys(self, text: str) -> np.ndarray:
        """Keys of the n-grams of a text: letters in lower case, everything between words as one blank."""
        words = letters_only(text)
        if not words or not has_letter(words):
            return np.zeros(0, np.int64)
        return self._line_keys(f" {words} ")

    def _line_keys(self, line: str) -> np.ndarray:
        codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        length = len(codes) - self.n + 1
        keys = np.zeros(max(0, length), np.int64)
        for j in range(self.n):
            keys = keys << 21 | codes[j : j + max(0, length)]
        return keys

    def bundle(self, texts: list[str | None]) -> np.ndarray:
        """One vector per text: the sum of its n-grams' vectors. Zero for a text without letters."""
        out = np.zeros((len(texts), self.dimensions), np.float64)
        block: list[tuple[int, np.ndarray]] = []
        size = 0
        for i, text in enumerate(texts):
            words = letters_only(text or "")
            line = f" {words} " if has_letter(words) else ""
            for at in range(0, len(line), BLOCK_CHARS):
                # Blocks of a very long text overlap by what an n-gram takes up beyond its first letter.
                keys = self._line_keys(line[at : at + BLOCK_CHARS + self.n - 1])
                block.append((i, keys))
                size += len(keys)
                if size >= BLOCK_CHARS:
                    self._add(out, block)
                    block, size = [], 0
        self._add(out, block)
        return out

    def _add(self, out: np.ndarray, block: list[tuple[int, np.ndarray]]) -> None:
        if not sum(len(k) for _, k in block):
            return
        found = [(i, *np.unique(k, return_counts=True)) for i, k in block if len(k)]
        distinct, place = np.unique(np.concatenate([k for _, k, _ in found]), return_inverse=True)
        texts = np.repeat(np.arange(len(found)), [len(k) for _, k, _ in found])
        counts = np.concatenate([c for _, _, c in found])
        for at in range(0, len(distinct), KEPT_NGRAMS):
            here = (place >= at) & (place < at + KEPT_NGRAMS)
            vectors = self.rows(distinct[at : at + KEPT_NGRAMS])
            for first in range(0, len(found), 64):  # a dense block of counts for 64 texts
                mine = here & (texts >= first) & (texts < first + 64)
                dense = np.zeros((min(64, len(found) - first), len(vectors)), np.float32)
                dense[texts[mine] - first, place[mine] - at] = counts[mine]
                for row, vector in zip(found[first : first + 64], dense @ vectors, strict=True):
                    out[row[0]] += vector


_worker: dict[tuple, Profiles] = {}


def _profiles(*parameters: int) -> Profiles:
    if parameters not in _worker:
        _worker.clear()
        _worker[parameters] = Profiles(*parameters)
    return _worker[parameters]


def unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=-1, keepdims=True)
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


def _sum_by_label(parameters: tuple) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles, sums = _profiles(*parameters), {}
        for batch in batches:
            labels = batch.column("label").to_pylist()
            vectors = unit(profiles.bundle(batch.column("whole_text").to_pylist()))
            for label in set(labels):
                mine = vectors[[i for i, x in enumerate(labels) if x == label]]
                sums[label] = sums.get(label, 0) + mine.sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(sums), pa.string()),
                pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64())),
            ],
            ["label", "sums"],
        )

    return run


def train(docs: DataFrame, label: str = "lang", text: str = "text", parameters: tuple = (DIMENSIONS, NGRAM, SEED)) -> dict:
    """Prototypes by label, from all rows of `docs` whose label is not null.

    Tasks send one vector per label, so what reaches the driver is labels x dimensions after the sum.
    """
    settings(docs.sparkSession)
    rows = docs.filter(F.col(label).isNotNull()).select(F.col(label).alias("label"), F.col(text).alias("whole_text"))
    parts = rows.mapInArrow(_sum_by_label(parameters), "label string, sums array<double>")
    by_dimension = parts.select("label", F.posexplode("sums").alias("at", "value")).groupBy("label", "at")
    sums = by_dimension.agg(F.sum("value").alias("value")).groupBy("label").agg(
        F.array_sort(F.collect_list(F.struct("at", "value"))).alias("found")
    )
    found = {r["label"]: np.array([x["value"] for x in r["found"]]) for r in sums.collect()}
    return {k: unit(v) for k, v in sorted(found.items()) if np.any(v)}


def _score(prototypes: dict, text: str, keep_text: bool, parameters: tuple) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    labels = list(prototypes)
    matrix = np.array([prototypes[x] for x in labels])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = _profiles(*parameters)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            vectors = unit(profiles.bundle(batch.column(at).to_pylist()))
            known = np.any(vectors, axis=1) if labels else np.zeros(len(vectors), bool)
            cosines = vectors @ matrix.T if labels else np.zeros((len(vectors), 1))
            best = cosines.argmax(axis=1)
            scores = np.clip(cosines.max(axis=1), 0, 1)
            arrays = [a for i, a in enumerate(batch.columns) if keep_text or i != at]
            names = [n for i, n in enumerate(batch.schema.names) if keep_text or i != at]
            arrays.append(pa.array([labels[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], pa.string()))
            arrays.append(pa.array(np.where(known, scores, 0.0), pa.float64()))
            yield pa.RecordBatch.from_arrays(arrays, [*names, "lang_pred", "lang_score"])

    return run


def predict(
    rows: DataFrame, prototypes: dict, text: str, keep_text: bool = True, parameters: tuple = (DIMENSIONS, NGRAM, SEED)
) -> DataFrame:
    """`rows` with lang_pred and lang_score added; only the column `text` decides.

    A text without a letter (null, empty, digits only) is `und` with score 0, and so is every text if nothing was
    learned. Ties go to the first label in order. Other columns pass through; their names must differ from those two.
    """
    settings(rows.sparkSession)
    kept = [(n, t) for n, t in rows.dtypes if keep_text or n != text]
    schema = ", ".join([*[f"`{n}` {t}" for n, t in kept], "lang_pred string", "lang_score double"])
    return rows.mapInArrow(_score(prototypes, text, keep_text, parameters), schema)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Rows the prototypes are not learned from: crc32 of the id as text, modulo `folds`, is 0; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def identify(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score. Learned from the documents that are not held out."""
    prototypes = train(docs.filter(~held_out(F.col("doc_id"))), text=text)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(text).alias("whole_text"))
    found = predict(rows, prototypes, "whole_text", keep_text=False)
    return found.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


def _with_letters(column: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [has_letter(t) for t in batch.column(column).to_pylist()]
            yield batch.filter(pa.array(found, pa.bool_()))

    return run


def keep_known(docs: DataFrame, prototypes: dict, text: str = "text") -> DataFrame:
    """`docs` without those whose text has no letter, which are `und` whatever was learned.

    Which language is predicted rejects nothing. If nothing was learned, every text is `und`; the letters decide then.
    """
    names = docs.columns
    if not prototypes:
        settings(docs.sparkSession)
        return docs.mapInArrow(_with_letters(names.index(text)), docs.schema)
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    found = predict(inner, prototypes, f"c{names.index(text)}").filter(F.col("lang_pred") != UNKNOWN)
    return found.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
