"""Routing of change envelopes `{data, metadata}` by table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sparge.contracts import EVENT_TIME
from sparge.functions.once import compute_once


def parse_envelopes(df: DataFrame, value: str = "value") -> DataFrame:
    """Parse every envelope once; adds `table_name, operation, event_time, payload, drop_reason`.

    `payload` is the flat JSON of `data` with `operation` set from the metadata, or null for
    dropped records. `event_time` is the metadata's `timestamp` as it stands, if it is a text. Dropped records are listed under the table they name,
    else under `unknown`, or `unparsed` when they are no envelope at all. Works the
    same on a batch and on a stream.
    """
    # Parsed as a one-element array, because the parser ignores what follows a value.
    wrapped = F.concat(F.lit("["), F.col(value).cast("string"), F.lit("]"))
    parsed = compute_once(df, _array=F.try_parse_json(wrapped))
    parsed = compute_once(
        parsed,
        _envelope=_object(F.col("_array"), "$[0]"),
        _empty=F.is_variant_null(F.try_variant_get("_array", "$[0]", "variant")),
        _single=F.try_variant_get("_array", "$[1]", "variant").isNull(),
    )
    parsed = compute_once(
        parsed,
        _data=_object(F.try_element_at("_envelope", F.lit("data"))),
        _metadata=_object(F.try_element_at("_envelope", F.lit("metadata"))),
        _has_metadata=~_absent(F.try_element_at("_envelope", F.lit("metadata"))),
    )
    table = F.try_element_at("_metadata", F.lit("table-name"))
    operation = F.try_element_at("_metadata", F.lit("operation"))
    made = F.try_element_at("_metadata", F.lit("timestamp"))
    parsed = compute_once(
        parsed,
        _table=F.try_variant_get(table, "$", "string"),
        _operation=F.try_variant_get(operation, "$", "string"),
        _made=F.when(F.schema_of_variant(made) == "STRING", F.try_variant_get(made, "$", "string")),
        _is_text=_text_or_absent(table) & _text_or_absent(operation),
    )
    is_envelope = F.col("_single") & (F.col("_envelope").isNotNull() | F.col("_empty"))
    is_metadata = F.col("_metadata").isNotNull() | ~F.col("_has_metadata")
    reason = (
        F.when(~F.coalesce(is_envelope & is_metadata & F.col("_is_text"), F.lit(False)), "unparsed")
        .when(F.coalesce(F.col("_table"), F.lit("")) == "", "missing_table")
        .when(F.col("_data").isNull(), "data_not_object")
    )
    operation = F.coalesce(F.col("_operation"), F.lit(""))
    # The data's own `operation`, if it has one, gives way to that of the metadata.
    data = F.when(
        F.map_contains_key("_data", "operation"), F.map_filter("_data", lambda key, _: key != "operation")
    ).otherwise(F.col("_data"))
    tagged = F.concat(F.lit('{"operation":'), F.to_json(operation.cast(T.VariantType())))
    rest = F.substring(F.to_json(data), 2, 2**31 - 1)
    payload = F.when(F.size(data) == 0, F.concat(tagged, F.lit("}"))).otherwise(F.concat(tagged, F.lit(","), rest))
    return parsed.select(
        *df.columns,
        F.when(reason == "unparsed", "unparsed")
        .when(reason == "missing_table", "unknown")
        .otherwise(F.col("_table"))
        .alias("table_name"),
        operation.alias("operation"),
        F.col("_made").alias("event_time"),
        F.when(reason.isNull(), payload).alias("payload"),
        reason.alias("drop_reason"),
    )


def delivered(payload: Column, event_time: Column) -> Column:
    """The raw line of an accepted record: its payload, led by the event's time where the envelope has one.

    A field of that name in the data comes later in the line and would count, so it is taken for the envelope's.
    """
    time = F.to_json(event_time.cast(T.VariantType()))
    timed = F.concat(F.lit("{"), F.lit(f'"{EVENT_TIME}":'), time, F.lit(","), F.substring(payload, 2, 2**31 - 1))
    return F.when(event_time.isNull(), payload).otherwise(timed)


def _object(value: Column, path: str = "$") -> Column:
    """Fields of a JSON object, or null for anything else."""
    return F.try_variant_get(value, path, "map<string,variant>")


def _absent(value: Column) -> Column:
    return value.isNull() | F.is_variant_null(value)


def _text_or_absent(value: Column) -> Column:
    return value.isNull() | F.schema_of_variant(value).isin("STRING", "VOID")


def route_cdc(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Accepted records `(table_name, operation, payload)` and dropped ones with the reason."""
    parsed = parse_envelopes(df, value)
    ok = parsed.filter(F.col("drop_reason").isNull()).drop("drop_reason", value)
    dropped = parsed.filter(F.col("drop_reason").isNotNull()).drop("payload")
    return ok, dropped


def routing_summary(df: DataFrame, value: str = "value") -> DataFrame:
    """Accepted and dropped counts per table."""
    status = F.when(F.col("drop_reason").isNull(), "accepted").otherwise("dropped")
    return parse_envelopes(df, value).groupBy("table_name", status.alias("status")).agg(F.count("*").alias("row_count"))


def typed_payload(accepted: DataFrame, table: str, schema: T.StructType) -> DataFrame:
    """Rows of one table, parsed with its contract (which includes `operation`)."""
    rows = accepted.filter(F.col("table_name") == table)
    return rows.select(F.from_json("payload", schema).alias("_row")).select("_row.*")
