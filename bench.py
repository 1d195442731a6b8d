"""Timed run of the registered queries and of the gzip CSV conversion; prints one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default all)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from sparge import fixtures  # noqa: E402
from sparge.contracts import ENTITIES  # noqa: E402
from sparge.plans.bronze import convert_csv  # noqa: E402
from sparge.registry.queries import all_queries  # noqa: E402
from sparge.session import configure, scratch_path  # noqa: E402

# The published conversion figure is for a file of this many reviews.
CONVERSION_ROWS = 1_500_000
# Seconds; the better of two runs counts for queries that take less. Whole jobs run once.
REPEATED_BELOW = 15


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "*")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", os.cpu_count() if cpus == "*" else cpus)
    )
    if "SPARK_CHECKPOINT_DIR" not in os.environ:
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="sparge-bench-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def conversion(spark: SparkSession, folder: str) -> dict[str, float]:
    """Gzip CSV to Parquet of 1.5 M reviews: one file, and one file per core."""
    schema = ENTITIES["review"].columns
    rows = fixtures.review(spark, folder, schema.names)
    copies = -(-CONVERSION_ROWS // rows.count())
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("_copy").limit(CONVERSION_ROWS)
    root = scratch_path(spark, "conversion")
    fixtures.write_csv_gz(rows.coalesce(1), f"{root}/one")
    fixtures.write_csv_gz(rows.repartition(spark.sparkContext.defaultParallelism), f"{root}/many")
    return {
        f"convert_csv_1_5m_{kind}": min(
            timed(lambda: convert_csv(spark, f"{root}/{kind}", f"{root}/{kind}-parquet", split=kind == "one"))
            for _ in range(3)
        )
        for kind in ("one", "many")
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    only = set(sys.argv[1:])
    spark = session()
    run(spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count())  # warm-up
    seconds: dict[str, float] = {}
    for name, build in all_queries().items():
        if not only or name in only:
            seconds[name] = timed(lambda: run(build(spark, folder)))
            if seconds[name] < REPEATED_BELOW:
                seconds[name] = min(seconds[name], timed(lambda: run(build(spark, folder))))
    if not only or "conversion" in only:
        seconds |= conversion(spark, folder)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "sf": Path(folder).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
