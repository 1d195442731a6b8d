from __future__ import annotations

import json

import pytest

from sparge.contracts import ENTITIES
from sparge.operators.routing import route_cdc, routing_summary, typed_payload


def envelope(data, **metadata):
    return json.dumps({"data": data, "metadata": {k.replace("_", "-"): v for k, v in metadata.items()}})


GOOD = envelope({"brewery_id": 1, "brewery_name": "A"}, table_name="brewery", operation="insert")


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_payload_carries_the_operation(spark):
    value = envelope({"b": {"x": [1, 2]}, "a": None, "operation": "old"}, table_name="t", operation="update", timestamp="x")
    ok, dropped = route_cdc(frame(spark, value))
    row = ok.first()
    assert (row.table_name, row.operation) == ("t", "update")
    assert json.loads(row.payload) == {"b": {"x": [1, 2]}, "a": None, "operation": "update"}
    assert dropped.count() == 0


@pytest.mark.parametrize("data", [{}, {"operation": 1}, {"a": 'x"\\\n'}])
def test_payload_is_valid_json(spark, data):
    ok, _ = route_cdc(frame(spark, envelope(data, table_name="t", operation='o"\\')))
    assert json.loads(ok.first().payload) == {**data, "operation": 'o"\\'}


def test_missing_operation_is_empty(spark):
    row = route_cdc(frame(spark, envelope({"a": 1}, table_name="t")))[0].first()
    assert json.loads(row.payload) == {"a": 1, "operation": ""}


@pytest.mark.parametrize(
    "value, table, reason",
    [
        ("not json", "unparsed", "unparsed"),
        ('{"data":{"a":1', "unparsed", "unparsed"),
        (GOOD + " trailing", "unparsed", "unparsed"),
        (GOOD + GOOD, "unparsed", "unparsed"),
        (GOOD + "," + GOOD, "unparsed", "unparsed"),
        (GOOD + ",null", "unparsed", "unparsed"),
        ("", "unparsed", "unparsed"),
        ("7", "unparsed", "unparsed"),
        ('"text"', "unparsed", "unparsed"),
        ("[1]", "unparsed", "unparsed"),
        (None, "unparsed", "unparsed"),
        (envelope({"a": 1}, table_name=5), "unparsed", "unparsed"),
        (envelope({"a": 1}, table_name="t", operation=5), "unparsed", "unparsed"),
        ('{"data":{"a":1},"metadata":"x"}', "unparsed", "unparsed"),
        ("{}", "unknown", "missing_table"),
        ("null", "unknown", "missing_table"),
        ('{"data":{"a":1}}', "unknown", "missing_table"),
        (envelope({"a": 1}, operation="insert"), "unknown", "missing_table"),
        (envelope({"a": 1}, table_name=""), "unknown", "missing_table"),
        (envelope([1], table_name="t"), "t", "data_not_object"),
        (envelope("x", table_name="t"), "t", "data_not_object"),
        (envelope(None, table_name="t"), "t", "data_not_object"),
        ('{"metadata":{"table-name":"t"}}', "t", "data_not_object"),
    ],
)
def test_dropped(spark, value, table, reason):
    ok, dropped = route_cdc(frame(spark, value))
    row = dropped.first()
    assert ok.count() == 0
    assert (row.table_name, row.drop_reason) == (table, reason)


def test_summary_and_typed_rows(spark):
    df = frame(spark, GOOD, GOOD, "bad", envelope([1], table_name="brewery"))
    counts = {(r.table_name, r.status): r.row_count for r in routing_summary(df).collect()}
    assert counts == {("brewery", "accepted"): 2, ("brewery", "dropped"): 1, ("unparsed", "dropped"): 1}
    typed = typed_payload(route_cdc(df)[0], "brewery", ENTITIES["brewery"].bronze)
    assert [tuple(r) for r in typed.collect()] == [(1, "A", "insert")] * 2


def test_large_numbers_keep_their_digits(spark):
    ok, _ = route_cdc(frame(spark, '{"data":{"id":9007199254740993},"metadata":{"table-name":"t"}}'))
    assert json.loads(ok.first().payload)["id"] == 9007199254740993


def test_the_last_of_two_equal_keys_counts(spark):
    ok, _ = route_cdc(frame(spark, ' {"data":{"a":1,"a":2},"metadata":{"table-name":"t"}}\n'))
    assert json.loads(ok.first().payload)["a"] == 2


def test_each_envelope_is_parsed_once(spark):
    ok, _ = route_cdc(frame(spark, GOOD))
    plan = ok._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1
