"""Replacing partitions of a Parquet table so that a crash at any point loses and repeats nothing.

The new partitions are written beside the table, below `_merge/<id>/rows`, which readers of the table do not see. Then a
note is left that names them: from there on they count. They are moved into their places one by one; whatever is left
to move after a crash is moved by the next one who merges or repairs, and until then `read_table_state` takes each
partition from where it is. Rows are written once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sparge.session import child_names, move, path_exists, read_note, remove, write_note

FOLDER = "_merge"
NOTE = "note.json"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def within(column: str, values: Iterable[str]) -> Column:
    """Whether a partition is among those named; the null one has a name of its own."""
    named = F.coalesce(F.col(column).isin(sorted(values)), F.lit(False))
    return named | F.col(column).isNull() if NULL_PARTITION in values else named


@dataclass(frozen=True)
class Swap:
    """Partitions `touched` of `column` are replaced; those of them in `filled` have rows."""

    ident: str
    column: str
    touched: list[str]
    filled: list[str]
    extra: dict[str, str] = field(default_factory=dict)

    def folder(self, path: str) -> str:
        return f"{path}/{FOLDER}/{self.ident}"


def new_swap(column: str, touched: Iterable[str], **extra: str) -> Swap:
    return Swap(uuid.uuid4().hex, column, sorted(touched), [], extra)


def prepare(spark: SparkSession, swap: Swap, path: str, rows: DataFrame) -> Swap:
    """Write the new partitions beside the table; `announce` makes them count."""
    rows.hint("rebalance", F.col(swap.column)).write.partitionBy(swap.column).parquet(f"{swap.folder(path)}/rows")
    names = child_names(spark, f"{swap.folder(path)}/rows")
    filled = [n.removeprefix(f"{swap.column}=") for n in names if n.startswith(f"{swap.column}=")]
    return Swap(swap.ident, swap.column, swap.touched, filled, swap.extra)


def announce(spark: SparkSession, swap: Swap, path: str) -> None:
    write_note(spark, f"{swap.folder(path)}/{NOTE}", json.dumps(asdict(swap)))


def unfinished(spark: SparkSession, path: str) -> list[Swap]:
    """Announced swaps that have not been completed; what was never announced is removed by `tidy`."""
    notes = [read_note(spark, f"{path}/{FOLDER}/{name}/{NOTE}") for name in child_names(spark, f"{path}/{FOLDER}")]
    return [Swap(**json.loads(note)) for note in notes if note]


def complete(spark: SparkSession, swap: Swap, path: str) -> None:
    """Move what is not yet in its place, and drop partitions left without rows. May be repeated."""
    for value in swap.touched:
        name = f"{swap.column}={value}"
        if value not in swap.filled:
            remove(spark, f"{path}/{name}")
        elif path_exists(spark, f"{swap.folder(path)}/rows/{name}"):
            move(spark, f"{swap.folder(path)}/rows/{name}", f"{path}/{name}")


def tidy(spark: SparkSession, path: str) -> None:
    """Remove what is left of merges, after all announced ones have been completed."""
    for name in child_names(spark, f"{path}/{FOLDER}"):
        remove(spark, f"{path}/{FOLDER}/{name}")


def read_table_state(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table as the announced swaps will leave it: every row once, also after a crash between two moves."""
    table = spark.read.schema(schema).parquet(path)
    for swap in unfinished(spark, path):
        rest = f"{swap.folder(path)}/rows"
        waiting = {n.removeprefix(f"{swap.column}=") for n in child_names(spark, rest) if "=" in n}
        gone = sorted({*(set(swap.touched) - set(swap.filled)), *waiting})
        table = table.filter(~within(swap.column, gone))
        if waiting:
            table = table.unionByName(spark.read.schema(schema).parquet(rest))
    return table
