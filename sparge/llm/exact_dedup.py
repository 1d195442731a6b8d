"""Exact deduplication by polynomial fingerprints that combine by length-shifted arithmetic.

A text is compared without its ASCII white space. Its UTF-8 bytes are cut into chunks; chunk c of n bytes has the
fingerprint  h(c) = sum of byte[i] * base^(n-1-i)  modulo a prime, for three primes. Chunks combine as
h(a + b) = h(a) * base^|b| + h(b), so the chunks of a huge document are hashed by different tasks in any order.
Equal fingerprints are no proof: the chunks of such documents are compared byte by byte in groups of equal chunks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sparge.llm.common import drop_rows, numbered, settings, write_stage

BLANK = r"[\x20\x09-\x0D]+"
CHUNK_CHARS = 65_536
# (prime, base): three primes below 2^31, so that a product of two residues fits 64 bits.
FIELDS = ((2147483647, 1103515245), (2147483629, 747796405), (2147483587, 1140671485))

PRINT = [f"h{i}" for i in range(len(FIELDS))]
KEY = ["n_bytes", *PRINT]


@lru_cache(8)
def _powers(prime: int, base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.int64)
    filled = 1
    while filled < n:  # base^(filled + i) = base^filled * base^i
        step = pow(base, filled, prime)
        out[filled : 2 * filled] = out[: min(filled, n - filled)] * step % prime
        filled *= 2
    return out[::-1].copy()


def chunk_hash(data: bytes, prime: int, base: int) -> int:
    """Polynomial fingerprint of at most 4 * CHUNK_CHARS bytes; the empty chunk has 0."""
    if not data:
        return 0
    values = np.frombuffer(data, np.uint8).astype(np.int64)
    powers = _powers(prime, base, 4 * CHUNK_CHARS)
    return int(np.dot(values, powers[len(powers) - len(values) :]) % prime)


def combine(left: int, right: int, right_bytes: int, prime: int, base: int) -> int:
    """Fingerprint of two neighbouring chunks from theirs."""
    return (left * pow(base, right_bytes, prime) + right) % prime


def _hash_chunks(column: str, fields: tuple, shifts: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks = [c.encode("utf-8", "surrogatepass") for c in batch.column(column).to_pylist()]
            at = batch.schema.get_field_index(column)
            arrays = [a for i, a in enumerate(batch.columns) if i != at]
            names = [n for n in batch.schema.names if n != column]
            arrays.append(pa.array([len(c) for c in chunks], pa.int64()))
            for prime, base in fields:
                arrays.append(pa.array([chunk_hash(c, prime, base) for c in chunks], pa.int64()))
            names = [*names, "n_bytes", *PRINT]
            if shifts:  # what the fingerprint of everything before a chunk is multiplied by
                for h, (prime, base) in zip(PRINT, fields, strict=True):
                    arrays.append(pa.array([pow(base, len(c), prime) for c in chunks], pa.int64()))
                    names.append(f"shift_{h}")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def _combined(chunks: Column, fields: tuple) -> Column:
    """The chunks' fingerprints, in order, folded into the document's by native arithmetic."""
    zero = F.struct(F.lit(0).cast("long").alias("n_bytes"), *[F.lit(0).cast("long").alias(h) for h in PRINT])

    def step(done: Column, chunk: Column) -> Column:
        parts = [(done["n_bytes"] + chunk["n_bytes"]).alias("n_bytes")]
        for h, (prime, _) in zip(PRINT, fields, strict=True):
            parts.append(((done[h] * chunk[f"shift_{h}"] + chunk[h]) % F.lit(prime)).alias(h))
        return F.struct(*parts)

    return F.aggregate(chunks, zero, step)


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK, "")


def _chunks(norm: Column) -> Column:
    cut = F.regexp_extract_all(norm, F.lit(f"(?s).{{1,{CHUNK_CHARS}}}"), F.lit(0))
    return F.when(F.length(norm) <= CHUNK_CHARS, F.array(norm)).otherwise(cut)


def fingerprints(rows: DataFrame, fields: tuple = FIELDS, text: str = "text") -> DataFrame:
    """Per row of `numbered` ones: row_no, doc_id, n_points (code points of the original), text_sha256, n_bytes, h0, h1, h2.

    Documents of more than one chunk are cut into rows that are dealt out over the cluster, hashed and combined.
    """
    settings(rows.sparkSession)
    whole = F.col("whole_row")[text]
    base = rows.select(
        "row_no", "whole_row.doc_id", F.coalesce(F.length(whole), F.lit(0)).cast("long").alias("n_points"), normalised(whole).alias("norm")
    )
    own = "row_no long, doc_id " + dict(base.dtypes)["doc_id"] + ", n_points long, text_sha256 string"
    prints = ", n_bytes long, " + ", ".join(f"{h} long" for h in PRINT)
    columns = ["row_no", "doc_id", "n_points", F.sha2(F.col("norm"), 256).alias("text_sha256")]
    short = base.filter(F.length("norm") <= CHUNK_CHARS).select(*columns, F.col("norm").alias("chunk"))
    short = short.mapInArrow(_hash_chunks("chunk", fields), own + prints)
    huge = base.filter(F.length("norm") > CHUNK_CHARS)
    huge = huge.select(*columns, F.posexplode(_chunks(F.col("norm"))).alias("chunk_no", "chunk"))
    huge = huge.repartition("row_no", "chunk_no")
    shifts = ", " + ", ".join(f"shift_{h} long" for h in PRINT)
    hashed = huge.mapInArrow(_hash_chunks("chunk", fields, shifts=True), own + ", chunk_no int" + prints + shifts)
    described = F.struct("chunk_no", "n_bytes", *PRINT, *[f"shift_{h}" for h in PRINT])
    by_row = hashed.groupBy("row_no", "doc_id", "n_points", "text_sha256").agg(
        _combined(F.array_sort(F.collect_list(described)), fields).alias("whole")
    )
    return short.unionByName(by_row.select("row_no", "doc_id", "n_points", "text_sha256", "whole.*"))


def _conflicts(rows: DataFrame, prints: DataFrame, text: str) -> DataFrame:
    """Fingerprints that stand for different texts, found by comparing all their documents chunk by chunk.

    Texts are fetched by row number, which spreads them evenly whatever they hold. Equal chunks of a task are one row
    before anything is shuffled by fingerprint, so a text with many copies is compared once per task and never gathered.
    """
    shared = write_stage(prints.groupBy(*KEY).agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "shared-prints")
    members = write_stage(prints.select("row_no", *KEY).join(shared, KEY, "left_semi"), "members")
    texts = rows.select("row_no", F.col("whole_row")[text].alias("whole_text")).join(members.hint("shuffle_hash"), "row_no")
    chunks = texts.select(*KEY, F.posexplode(_chunks(normalised(F.col("whole_text")))).alias("chunk_no", "chunk"))
    different = chunks.groupBy(*KEY, "chunk_no", "chunk").agg(F.count("*").alias("n"))
    return (
        different.groupBy(*KEY, "chunk_no").agg(F.count("*").alias("variants")).filter("variants > 1")
        .select(*KEY, F.lit(True).alias("conflict")).distinct()
    )


def _decided(rows: DataFrame, fields: tuple, text: str) -> DataFrame:
    """`exact_dedup` of `numbered` rows, with their `row_no`."""
    prints = write_stage(fingerprints(rows, fields, text), "prints")
    found = write_stage(_conflicts(rows, prints, text), "conflicts")
    # A fingerprint of different texts is parted by content; the digest is that of the whole normalised text.
    keyed = prints.join(found, KEY, "left").withColumn(
        "part", F.when(F.col("conflict"), F.col("text_sha256")).otherwise("")
    )
    nameless = F.col("doc_id").isNull().alias("nameless")
    best = F.min(F.struct((-F.col("n_points")).alias("shortness"), nameless, "doc_id", "row_no"))
    # Written out, so that the join below can split the rows of a group with very many copies.
    groups = write_stage(keyed.groupBy(*KEY, "part").agg(F.count("*").alias("group_size"), best.alias("best")), "groups")
    return keyed.join(groups, [*KEY, "part"]).select(
        "row_no",
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_no") == F.col("best.row_no")).alias("kept"),
        "text_sha256",
    )


def exact_dedup(docs: DataFrame, fields: tuple = FIELDS, text: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    `docs` needs `doc_id` and the text column; other columns are not read. Null texts count as empty and empty texts as
    equal. Of equal texts the row with most code points stays, then the one with the smallest doc_id (null ids last); of
    repeated rows one. `keep_id` is null only if a group has no id. An empty table gives an empty result.
    """
    return _decided(numbered(docs.select("doc_id", text)), fields, text).drop("row_no")


def drop_exact_copies(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` without the rows that `exact_dedup` does not keep.

    Null and empty texts are copies of each other; of repeated rows one stays, and rows that only resemble each other
    (other columns, other nulls) are told apart by their place. Columns may have any name and type. An empty table
    stays empty.
    """
    rows = numbered(docs)
    return drop_rows(rows, _decided(rows, FIELDS, text).select("row_no", "kept"))
