"""Running a batch of ledger entries through its states."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sparge.operators import ledger
from sparge.session import staged


def log_path(root: str) -> str:
    return f"{root.rstrip('/')}/control"


def run_entries(
    spark: SparkSession, root: str, schema: str, table: str, now: Column, work: Callable[[DataFrame], DataFrame | None],
    apart: bool = False, most: int | None = None, keys: DataFrame | None = None,
) -> bool:
    """Start the eligible entries of a table, run `work` on them, and finish them.

    The started rows are staged, so that exactly these are worked on and finished
    whatever is registered meanwhile. `work` may return `(object_key, record_count)`,
    which the success rows then carry. `most` bounds the entries of one call, oldest
    first; call again, with the same `now`, until it returns False.

    With `apart`, which needs `most`, entries do not share their fate: when a batch fails,
    its halves are tried, and so on, until the entry that fails stands alone. Only that one
    becomes an error. `work` must therefore be one that can be repeated. Without, the batch
    fails as a whole and the failure is raised.

    With `keys` (`object_key`), these entries alone are taken, also where they are still
    running: for a caller that knows its earlier attempt to be dead.
    """
    log = ledger.read_log(spark, log_path(root))
    mine = log.filter((F.col("schema_name") == schema) & (F.col("table_name") == table))
    if keys is None:
        todo = ledger.eligible(mine)
    else:
        todo = ledger.unfinished(mine.join(keys.select("object_key"), "object_key", "left_semi").select(*log.columns))
    if most:
        # What failed in this run is left for the next one.
        todo = todo.filter((F.col("status") != "error") | (F.col("updated_at") < now))
        todo = todo.orderBy("attempt_count", "created_at", "object_key").limit(most)
    elif apart:
        raise ValueError("entries can be told apart only in batches of bounded size")
    with staged(ledger.start(todo, now), "started") as started:
        if started.isEmpty():
            return False
        ledger.append(started, log_path(root))
        if apart:
            _run_apart(started, now, log_path(root), work)
        else:
            _run_whole(started, now, log_path(root), work)
        return True


def _run_whole(started: DataFrame, now: Column, log: str, work: Callable[[DataFrame], DataFrame | None]) -> None:
    try:
        counts = work(started)
    except Exception as failure:
        ledger.append(ledger.finish(started, now, message_of(failure)), log)
        raise
    ledger.append(ledger.finish(with_counts(started, counts), now), log)


def _run_apart(started: DataFrame, now: Column, log: str, work: Callable[[DataFrame], DataFrame | None]) -> None:
    """Halve a failing batch by the rank of its entries: n entries take at most 2 n attempts, log2 n deep."""
    rank = F.row_number().over(Window.orderBy("control_id", "created_at", "object_key"))
    with staged(started.withColumn("_rank", rank), "ranked") as ranked:  # a bounded batch of entries
        todo = [(1, ranked.count())]
        while todo:
            first, last = todo.pop()
            part = ranked.filter(F.col("_rank").between(first, last)).drop("_rank")
            try:
                counts = work(part)
            except Exception as failure:
                if first == last:
                    ledger.append(ledger.finish(part, now, message_of(failure)), log)
                else:
                    middle = (first + last) // 2
                    todo += [(middle + 1, last), (first, middle)]
                continue
            ledger.append(ledger.finish(with_counts(part, counts), now), log)


def message_of(failure: Exception) -> str:
    """What went wrong and what caused it, without the frames of the stack."""
    lines = [line.strip() for line in str(failure).splitlines()]
    kept = [x for x in lines if x and not x.startswith(("at ", "...", "Driver stacktrace"))]
    return "\n".join(dict.fromkeys(kept)) or type(failure).__name__


def with_counts(started: DataFrame, counts: DataFrame | None) -> DataFrame:
    """Entries with the record counts that were found while working on them."""
    if counts is None:
        return started
    found = counts.select("object_key", F.col("record_count").alias("_found"))
    joined = started.join(found, "object_key", "left")
    count = F.coalesce("_found", "record_count")
    sized = {"record_count": count, "compute_target": F.coalesce("compute_target", ledger.size_class(count))}
    return joined.withColumns(sized).drop("_found")
