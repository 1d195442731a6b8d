"""Helpers that several operators share: staging, row keys, running offsets, word splitting."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparge.session import remove, scratch_dir, scratch_path

# Rows per batch handed to Python; texts may be long, so batches stay small.
BATCH_ROWS = 256

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def settings(spark: SparkSession) -> SparkSession:
    """Session settings that bound the memory of Python workers, and the disk: operators write down what they need
    again, so shuffle files can go as soon as the job that made them has ended."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def write_stage(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared folder and read back: lineage ends there, whatever executors are lost later."""
    path = scratch_path(df.sparkSession, f"llm-{label}")
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Remove the files of a `write_stage` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if scratch_dir(spark).rsplit("/", 1)[-1] in folder:  # only what this session staged
            remove(spark, folder)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are."""
    return F.translate(text, UPPER, UPPER.lower())


def numbered(docs: DataFrame) -> DataFrame:
    """`docs` written to the shared folder as (row_no, whole_row): a number tells rows apart, whatever they hold.

    The row is one value, so columns of any type and name travel through joins as they are.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole_row")
    return write_stage(docs.select(F.monotonically_increasing_id().alias("row_no"), whole), "numbered")


def drop_rows(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of `numbered` ones that `decisions` (row_no, kept) does not drop, as they were.

    What is dropped is the hashed side of the join, so texts are shuffled at most once and not sorted.
    """
    dropped = write_stage(decisions.filter("NOT kept").select("row_no"), "dropped")
    return rows.join(dropped.hint("shuffle_hash"), "row_no", "left_anti").select("whole_row.*")


def running_offsets(df: DataFrame, order: list[str], weight: str, group: str | None = None) -> DataFrame:
    """Adds `offset`: the sum of `weight` over the rows of the same group that come before in `order`.

    Rows are dealt out by range of (group, order), so no group has to fit one task. Each partition writes its own
    running sums; their totals, one row per partition and group in it, give the partition's first offset. `order`
    has to be unique within a group; `df` is read twice (once for the sample of its ranges), so it should be staged.
    """
    spark = df.sparkSession
    keys = [*([group] if group else []), *order]
    dealt = df.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys)
    names = df.columns
    group_at = names.index(group) if group else None
    schema = ", ".join([*[f"`{n}` {t}" for n, t in df.dtypes], "offset_part int", "offset_local long"])
    local = write_stage(dealt.mapInArrow(_local_offsets(names.index(weight), group_at), schema), "offsets")
    by = [F.col("offset_part"), (F.col(group) if group else F.lit(0)).alias("offset_group")]
    totals = local.groupBy(*by).agg(F.sum(weight).alias("total")).collect()
    first, bases = {}, []
    for row in sorted(totals, key=lambda r: (r["offset_part"], r["offset_group"])):
        bases.append((row["offset_part"], row["offset_group"], first.get(row["offset_group"], 0)))
        first[row["offset_group"]] = first.get(row["offset_group"], 0) + row["total"]
    kind = dict(local.dtypes)[group] if group else "int"
    base = spark.createDataFrame(bases, f"base_part int, base_group {kind}, base_offset long")
    here = (F.col("offset_part") == F.col("base_part")) & (by[1] == F.col("base_group"))
    # One row per partition and group, whatever the data: always small enough to send to every task.
    joined = local.join(F.broadcast(base), here)
    return joined.select(*names, (F.col("offset_local") + F.col("base_offset")).alias("offset"))


def _local_offsets(weight: int, group: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now, total = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = batch.column(group).to_pylist() if group is not None else [0] * batch.num_rows
            offsets = []
            for g, w in zip(groups, batch.column(weight).to_pylist(), strict=True):
                if g != now:
                    now, total = g, 0
                offsets.append(total)
                total += w
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), pa.array(offsets, pa.int64())],
                [*batch.schema.names, "offset_part", "offset_local"],
            )

    return run


# ASCII letters in lower case and digits stay, other ASCII characters become a space, bytes of other characters stay.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Words as UTF-8: runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased."""
    return (text or "").encode("utf-8", "replace").translate(WORD_BYTES).split()
