"""The registered query of each operator: production parameters, whole tables, digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sparge.llm.collocations import collocations
from sparge.llm.common import settings
from sparge.llm.decontaminate import contaminations
from sparge.llm.exact_dedup import exact_dedup
from sparge.llm.filter_audit import audit
from sparge.llm.langid import identify
from sparge.llm.licenses import scan
from sparge.llm.mixing import mix
from sparge.llm.packing import pack, piece_digests
from sparge.llm.sharding import shard
from sparge.llm.simhash import near_duplicates
from sparge.llm.token_counts import count_tokens
from sparge.llm.url_filter import judge, tracked_keys
from sparge.llm.warc import read_archives, shared_uri, write_archives
from sparge.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(settings(spark), sf_dir)

    _REGISTRY[build.__name__] = run
    return build


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache, so every distinct text is encoded."""
    cache = scratch_path(spark, "llm-token-cache")
    return count_tokens(documents(spark, sf_dir), cache, public_tokenizers.path("piece_bpe_32k.model"))


@query
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


@query
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judge(pages, tracked_keys(pages)).drop("listed")


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(pack(documents(spark, sf_dir)))


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: the items they hold (comma-joined), how many, the best score, and whether there are any."""
    found = contaminations(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id",
        F.array_join(F.expr("transform(hits, h -> cast(h.item_id as string))"), ",").alias("item_ids"),
        F.size("hits").cast("long").alias("n_items"),
        F.coalesce(F.array_max(F.expr("transform(hits, h -> h.score)")), F.lit(0.0)).alias("score"),
        (F.size("hits") > 0).alias("contaminated"),
    )


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return shard(documents(spark, sf_dir)).select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_uri(spark, "warc")
    archives = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_archives(archives, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))
