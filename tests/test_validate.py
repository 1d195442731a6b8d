from __future__ import annotations

import gzip

import pytest
from pyspark.sql import types as T

from sparge.contracts import ENTITIES, columns
from sparge.operators.validate import conform, union_all, validate
from sparge.sources.files import read_csv_gz, read_csv_raw, read_csv_split, read_json_raw

BREWERY = ENTITIES["brewery"]


def csv(tmp_path, text, name="a.csv.gz"):
    path = tmp_path / name
    path.write_bytes(gzip.compress(text.encode()))
    return str(path)


def reasons(rejected):
    return sorted((r.column, r.reason) for row in rejected.collect() for r in row.reasons)


def test_valid_rows(spark, tmp_path):
    path = csv(tmp_path, "brewery_id,brewery_name,operation\n1,Mikkeller,insert\n2,Tree House,insert\n")
    valid, rejected = validate(read_csv_raw(spark, path), BREWERY.bronze)
    assert [tuple(r) for r in valid.orderBy("brewery_id").collect()] == [(1, "Mikkeller", "insert"), (2, "Tree House", "insert")]
    assert valid.schema["brewery_id"].dataType == T.LongType()
    assert rejected.count() == 0


def test_missing_field(spark, tmp_path):
    path = csv(tmp_path, "brewery_id\n1\n")
    valid, rejected = validate(read_csv_raw(spark, path), BREWERY.columns)
    assert valid.count() == 0
    assert reasons(rejected) == [("brewery_name", "missing_field")]


def test_columns_are_found_by_header(spark, tmp_path):
    path = csv(tmp_path, "brewery_name,extra,brewery_id\nA,x,1\n")
    valid, _ = validate(read_csv_raw(spark, path), BREWERY.columns)
    assert [tuple(r) for r in valid.collect()] == [(1, "A")]


def test_malformed_rows(spark, tmp_path):
    path = csv(tmp_path, "brewery_id,brewery_name\n1,A\n2\n3,B,extra\n")
    raw = read_csv_raw(spark, path)
    valid, rejected = validate(raw, BREWERY.columns)
    assert valid.count() == 1
    assert reasons(rejected) == [("", "malformed_row")] * 2
    assert validate(raw, BREWERY.columns, "drop")[1].count() == 0
    with pytest.raises(Exception, match="malformed row"):
        validate(raw, BREWERY.columns, "fail")[0].collect()
    with pytest.raises(ValueError):
        validate(raw, BREWERY.columns, "ignore")


def test_quoted_comma_and_line_break(spark, tmp_path):
    path = csv(tmp_path, 'brewery_id,brewery_name\n1,"A, B"\n2,"C\nD"\n3,"say ""hi"""\n')
    valid, rejected = validate(read_csv_raw(spark, path), BREWERY.columns)
    assert [r.brewery_name for r in valid.orderBy("brewery_id").collect()] == ["A, B", "C\nD", 'say "hi"']
    assert rejected.count() == 0


@pytest.mark.parametrize(
    "text, value",
    [
        ("1.5", 1.5), (" 2 ", 2.0), ("1e3", 1000.0), (".5", 0.5), ("inf", float("inf")), ("-Infinity", float("-inf")),
        ("1.5d", "invalid"), ("2f", "invalid"), ("1e400", "invalid"), ("abc", "invalid"), ("1,5", "invalid"),
    ],
)
def test_numbers(spark, text, value):
    schema = columns("v double")
    valid, rejected = validate(spark.createDataFrame([(text,)], "v string"), schema)
    if value == "invalid":
        assert reasons(rejected) == [("v", "invalid_double")] and valid.count() == 0
    else:
        assert valid.first().v == value and rejected.count() == 0


@pytest.mark.parametrize("text, ok", [("7", True), ("+7", True), ("-7", True), ("7.0", False), ("9223372036854775808", False), ("x", False)])
def test_integers(spark, text, ok):
    valid, rejected = validate(spark.createDataFrame([(text,)], "v string"), columns("v bigint"))
    assert (valid.count(), rejected.count()) == ((1, 0) if ok else (0, 1))


@pytest.mark.parametrize(
    "text, ok",
    [("2024-01-02T03:04:05Z", True), ("2024-01-02T03:04:05.25+02:00", True), ("2024-01-02", False), ("2024-13-02T03:04:05Z", False)],
)
def test_timestamps(spark, text, ok):
    valid, rejected = validate(spark.createDataFrame([(text,)], "v string"), columns("v timestamp"))
    assert (valid.count(), rejected.count()) == ((1, 0) if ok else (0, 1))


def test_blanks(spark):
    raw = spark.createDataFrame([(" ", "x"), ("1", " ")], "brewery_id string, brewery_name string")
    valid, rejected = validate(raw, BREWERY.columns)
    assert valid.count() == 0
    assert reasons(rejected) == [("brewery_id", "missing_value"), ("brewery_name", "missing_value")]
    optional, _ = validate(spark.createDataFrame([(" ",)], "v string"), columns("v double"))
    assert optional.first().v is None


def test_json_rows(spark, tmp_path):
    path = csv(tmp_path, '{"brewery_id":1,"brewery_name":"A"}\n{"brewery_id":"x","brewery_name":"B"}\nnot json\n', "a.json.gz")
    valid, rejected = validate(read_json_raw(spark, path, BREWERY.columns), BREWERY.columns)
    assert [tuple(r) for r in valid.collect()] == [(1, "A")]
    assert reasons(rejected) == [("", "malformed_row"), ("brewery_id", "invalid_long")]


def test_typed_reads_agree(spark, tmp_path):
    schema = columns("a bigint, b double")
    path = csv(tmp_path, "a,b\n1,0.5\n2,\n3,1e2\n")
    rows = sorted(map(tuple, read_csv_gz(spark, path, schema).collect()), key=str)
    assert rows == [(1, 0.5), (2, None), (3, 100.0)]
    assert sorted(map(tuple, read_csv_split(spark, path, schema).collect()), key=str) == rows
    with pytest.raises(ValueError):
        read_csv_split(spark, path, columns("a string"))
    with pytest.raises(Exception):
        read_csv_gz(spark, csv(tmp_path, "b,a\n1,2\n", "swapped.csv.gz"), schema).collect()


def test_conform(spark):
    df = spark.createDataFrame([("x", "1", "2.5")], "extra string, b string, a string")
    out = conform(df, columns("a double, b bigint"))
    assert out.columns == ["a", "b"] and tuple(out.first()) == (2.5, 1)
    assert conform(df.withColumnRenamed("extra", "c"), columns("c bigint"), lenient=True).first().c is None
    with pytest.raises(ValueError, match="missing"):
        conform(df, columns("z string"))
    with pytest.raises(ValueError):
        union_all([])
