from __future__ import annotations

from datetime import datetime, timezone

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F, types as T

from sparge.contracts import COSTS, ENTITIES, layer_of, schema_of, source_type
from sparge.functions import keys
from sparge.functions.text import as_text, blank_to_null, mask_value
from sparge.functions.time import interval_day, in_months, month_ranges, partition_day


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "value, masked",
    [("", ""), ("A", "*"), ("AB", "**"), ("1234", "****"), ("secret", "s****t"), ("1234567890", "1********0"), (None, "")],
)
def test_mask(spark, value, masked):
    assert one(spark, mask_value(F.lit(value).cast("string"))) == masked


def test_mask_counts_characters(spark):
    assert one(spark, mask_value(F.lit("éèêëü"))) == "é***ü"


@pytest.mark.parametrize(
    "value, dtype, text",
    [
        (1.0, T.DoubleType(), "1"),
        (0.0, T.DoubleType(), "0"),
        (-2.5, T.DoubleType(), "-2.5"),
        (12345678901.25, T.DoubleType(), "12345678901.25"),
        (1e10, T.DoubleType(), "10000000000"),
        (7, T.LongType(), "7"),
        (True, T.BooleanType(), "true"),
        (["a", "b"], T.ArrayType(T.StringType()), "a,b"),
        (None, T.LongType(), ""),
        (datetime(2024, 1, 2, 3, 4, 5), T.TimestampNTZType(), "2024-01-02 03:04:05"),
    ],
)
def test_as_text(spark, value, dtype, text):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("v", dtype)]))
    assert df.select(as_text(F.col("v"), dtype)).first()[0] == text


def test_blank_to_null(spark):
    df = spark.createDataFrame([(" a ",), ("",), (" \t\n",), (None,)], "v string")
    assert [r[0] for r in df.select(blank_to_null(F.col("v"))).collect()] == ["a", None, None, None]


@pytest.mark.parametrize(
    "name, base",
    [("x.json.gz", "x"), ("x.csv.gz", "x"), ("x.gz", "x"), ("x.parquet", "x"), ("x.parquet.gz", "x"), ("x.txt", "x.txt")],
)
def test_base_name(spark, name, base):
    assert one(spark, keys.base_name(F.lit(name))) == base


def test_destination_key(spark):
    at = F.lit("2025-08-03 23:59:59").cast("timestamp")
    key = F.lit("raw/beer/part-7.csv.gz")
    assert one(spark, keys.destination_key(key, "bronze", at)) == "bronze/beer/year=2025/month=08/day=03/part-7.parquet"
    assert one(spark, keys.destination_key(key, "raw", at)) == "raw/beer/part-7.gz"


def test_key_parts(spark):
    assert one(spark, keys.key_table(F.lit("raw/beer/x.gz"))) == "beer"
    assert one(spark, keys.key_partition(F.lit("silver/review/partitioned_at=20251001"))) == "20251001"
    assert one(spark, keys.file_format(F.lit("raw/beer/dm-batch-process-1.csv.gz"))) == "csv"
    assert one(spark, keys.file_format(F.lit("raw/beer/stream-1.json.gz"))) == "json"
    assert keys.layer_schema(" Gold ") == "dm_gold"


def test_time(spark):
    assert one(spark, partition_day(F.lit("2025-10-01T05:00:00+00:00").cast("timestamp"))) == "20251001"
    day = interval_day(F.lit("2025-03-05T07:00:00Z/2025-03-05T08:00:00Z")).cast("string")
    assert one(spark, day) == "2025-03-05 00:00:00"


@given(st.lists(st.tuples(st.integers(1999, 2003), st.integers(1, 12)), min_size=1, max_size=30))
def test_month_ranges_cover_exactly_the_months(months):
    ranges = month_ranges(months)
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    covered = {
        (y, m)
        for y in range(1998, 2005)
        for m in range(1, 13)
        if any(s <= datetime(y, m, 15, tzinfo=timezone.utc).timestamp() < e for s, e in ranges)
    }
    assert covered == set(months)


def test_in_months_takes_the_null_month(spark):
    df = spark.createDataFrame([(None,), (0,), (-1,)], "t bigint")
    assert df.filter(in_months(F.col("t"), [(None, None)])).collect() == [(None,)]
    assert df.filter(in_months(F.col("t"), [(1970, 1), (None, None)])).count() == 2
    assert df.filter(in_months(F.col("t"), [])).count() == 0


def test_source_types():
    assert source_type("int8") == T.LongType()
    assert source_type("_int4", "A", "int4") == T.ArrayType(T.IntegerType())
    assert source_type("mood", "E") == T.StringType()
    assert source_type("custom", "U") == T.MapType(T.StringType(), T.StringType())
    with pytest.raises(ValueError):
        source_type("mystery", "X")


def test_contracts():
    assert len(COSTS) == 115 and COSTS.names[-1] == "billing_period"
    assert ENTITIES["review"].bronze.names[-1] == "operation"
    assert ENTITIES["beer"].silver.names[-4:] == ["created_at", "updated_at", "deleted_at", "partitioned_at"]
    assert [layer_of(schema_of(layer)) for layer in ("bronze", "silver", "gold")] == ["bronze", "silver", "gold"]
