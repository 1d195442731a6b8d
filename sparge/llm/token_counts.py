"""Token counts through a digest cache.

A text is known by the SHA-256 of its content, a tokenizer by the SHA-256 of its file and the library's name. The cache
is a Parquet table of (tokenizer, digest, n_tokens). Digests without a row are misses; each distinct miss is encoded
once, and its count appended. A later run with the same tokenizer encodes only what is new.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparge.llm.common import settings, write_stage
from sparge.session import path_exists

LIMIT = 4096
CACHE = "tokenizer string, digest binary, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """Version of a tokenizer: a digest of its library's name and its file."""
    library = "tokenizers" if path.endswith(".json") else "sentencepiece"
    return hashlib.sha256(library.encode() + b"\0" + Path(path).read_bytes()).hexdigest()


def normalised(text: Column) -> Column:
    """What a count depends on: the whole text as it stands, null as empty. Anything else might change the count."""
    return F.coalesce(text, F.lit(""))


def content_digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


_counters: dict[str, Callable[[list[str]], list[int]]] = {}


def counter(path: str) -> Callable[[list[str]], list[int]]:
    """Counts of whole texts by the file's library, without begin, end or added special tokens, nothing cut or padded."""
    if path not in _counters:
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            _counters[path] = lambda texts: [len(e.ids) for e in model.encode_batch_fast(texts, add_special_tokens=False)]
        else:
            from sentencepiece import SentencePieceProcessor

            pieces = SentencePieceProcessor(model_file=path)
            _counters[path] = lambda texts: [len(pieces.encode(t, add_bos=False, add_eos=False)) for t in texts]
    return _counters[path]


def _first_seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose digest this task has not seen: a text with many copies leaves a task once.

    The digests seen are 32 bytes for each row of a task's input.
    """
    seen: set[bytes] = set()
    for batch in batches:
        keep = []
        for digest in batch.column("digest").to_pylist():
            keep.append(digest not in seen)
            seen.add(digest)
        yield batch.filter(pa.array(keep, pa.bool_()))


def _encode(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in _first_seen(batches):
            counts = count(batch.column("content").to_pylist()) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return run


def read_cache(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """(digest, n_tokens) of a tokenizer version; one row per digest, even if two jobs appended the same one."""
    if not path_exists(spark, cache):
        return spark.createDataFrame([], CACHE).select("digest", "n_tokens")
    rows = spark.read.schema(CACHE).parquet(cache).filter(F.col("tokenizer") == tokenizer)
    return rows.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def fill_cache(docs: DataFrame, cache: str, path: str, text: str = "text") -> None:
    """Append the counts of all texts of `docs` that the cache has no count of.

    Texts move once, each task's copies as one, to the partition of their digest; there the stored digests are taken
    out and the rest is encoded, so equal texts of different tasks meet before they are encoded.
    """
    spark = settings(docs.sparkSession)
    tokenizer = tokenizer_digest(path)
    content = docs.select(content_digest(F.col(text)).alias("digest"), normalised(F.col(text)).alias("content"))
    once = content.mapInArrow(_first_seen, "digest binary, content string").repartition("digest")
    stored = read_cache(spark, cache, tokenizer).select("digest")
    misses = once.join(stored.hint("shuffle_hash"), "digest", "left_anti")
    counts = misses.mapInArrow(_encode(path), "digest binary, n_tokens long")
    rows = counts.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))
    rows.select(F.lit(tokenizer).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache)


def count_tokens(docs: DataFrame, cache: str, path: str, limit: int = LIMIT, text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    Null texts count as empty (no bytes; as many tokens as the tokenizer gives the empty text). Equal texts are encoded
    once; rows of `docs` may repeat and ids may be null. Other columns are not read. An empty table gives an empty
    result. `path` must be the same file on all executors; `cache` a folder that all of them reach.
    """
    spark = docs.sparkSession
    fill_cache(docs, cache, path, text)
    keys = docs.select(
        "doc_id",
        F.octet_length(normalised(F.col(text))).cast("long").alias("n_bytes"),
        content_digest(F.col(text)).alias("digest"),
    )
    # A written table with one row per digest: a digest that many rows share can then be split by the join.
    counts = write_stage(read_cache(spark, cache, tokenizer_digest(path)), "counts")
    return keys.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
