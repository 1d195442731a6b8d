"""Row validation and conforming to a contract."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from sparge.contracts import OPERATIONS
from sparge.functions.once import compute_once
from sparge.functions.text import blank_to_null
from sparge.sources.files import CORRUPT

_NOT_FINITE = r"(?i)^([+-]?inf(inity)?|nan)$"
_RFC3339 = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})$"
_REASON = "struct<column:string,reason:string>"


def normalize_blanks(df: DataFrame) -> DataFrame:
    """Trim every text column and turn blanks into nulls."""
    return df.withColumns(
        {f.name: blank_to_null(F.col(f.name)) for f in df.schema.fields if f.dataType == T.StringType()}
    )


def parse(text: Column, dtype: T.DataType) -> Column:
    """Typed value of already trimmed text, or null where it is not one."""
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, T.IntegralType):
        return _integer(text, dtype)
    value = text.try_cast(dtype)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        # The cast also takes a type suffix (`1.5d`), and turns overflow into infinity.
        unusual = F.isnan(value) | (F.abs(value) == float("inf"))
        suffixed = F.right(text, F.lit(1)).isin("d", "D", "f", "F")
        return F.when(F.when(unusual, text.rlike(_NOT_FINITE)).otherwise(~suffixed), value)
    if isinstance(dtype, T.TimestampType):
        return F.when(text.rlike(_RFC3339), F.try_to_timestamp(text))
    return value


def _integer(text: Column, dtype: T.DataType) -> Column:
    # A failing cast costs an exception; the pattern keeps most of them away. Zeros in front may be any number.
    return F.when(text.rlike(r"^[+-]?0*[0-9]{1,19}$"), text.try_cast(dtype))


def annotate(raw: DataFrame, schema: T.StructType, carry: Sequence[str] = ()) -> DataFrame:
    """Typed contract columns, `_text_<column>` for each, `_valid`, and the columns to `carry` as they are.

    `raw` has text columns, and `_corrupt_record` where the reader rejected the line.
    Each text is trimmed once and parsed once, whatever is filtered afterwards.
    """
    present = set(raw.columns)
    kept = [*([F.col(CORRUPT)] if CORRUPT in present else []), *map(F.col, carry)]
    text = {
        f.name: blank_to_null(F.col(f.name)) if f.name in present else F.lit(None).cast("string")
        for f in schema.fields
    }
    texts = raw.select(*kept, *[t.alias(f"_text_{n}") for n, t in text.items()])
    typed = compute_once(texts, **{f.name: parse(F.col(f"_text_{f.name}"), f.dataType) for f in schema.fields})
    tests = [F.col(CORRUPT).isNull()] if CORRUPT in present else []
    for f in schema.fields:
        if f.name not in present:
            tests.append(F.lit(False))
        elif f.nullable:
            tests.append(F.col(f"_text_{f.name}").isNull() | F.col(f.name).isNotNull())
        else:
            tests.append(F.col(f.name).isNotNull())
        if f.name == "operation" and f.name in present:
            tests.append(_known(F.col(f.name)))
    return typed.withColumn("_valid", reduce(Column.__and__, tests, F.lit(True)))


def _known(operation: Column) -> Column:
    return operation.isNull() | operation.isin(*OPERATIONS)


def _reasons(schema: T.StructType, present: set[str], has_corrupt: bool) -> Column:
    malformed = F.col(CORRUPT).isNotNull() if has_corrupt else F.lit(False)
    found = []
    for f in schema.fields:
        text, value = F.col(f"_text_{f.name}"), F.col(f.name)
        if f.name not in present:
            found.append(_reason(f.name, "missing_field"))
            continue
        bad = F.when(text.isNotNull() & value.isNull(), _reason(f.name, f"invalid_{f.dataType.typeName()}"))
        found.append(bad if f.nullable else F.when(text.isNull(), _reason(f.name, "missing_value")).otherwise(bad))
        if f.name == "operation":
            found.append(F.when(~_known(value), _reason(f.name, "unknown_operation")))
    return F.when(malformed, F.array(_reason("", "malformed_row"))).otherwise(F.array_compact(F.array(*found)))


def _reason(column: str, reason: str) -> Column:
    return F.struct(F.lit(column).alias("column"), F.lit(reason).alias("reason")).cast(_REASON)


def checked(raw: DataFrame, schema: T.StructType, carry: Sequence[str] = ()) -> DataFrame:
    """Every raw row, parsed once: typed columns, those of `carry`, `_valid`, and `_rejected` for rows that are not.

    Made to be staged: `accepted`, `rejected` and any count can then be taken from it without reading or parsing the raw
    rows again. `_rejected` holds the texts and the reasons.
    """
    rows = annotate(raw, schema, carry)
    has_corrupt = CORRUPT in raw.columns
    texts = [*([F.col(CORRUPT)] if has_corrupt else []), *[F.col(f"_text_{n}").alias(n) for n in schema.names]]
    reasons = _reasons(schema, set(raw.columns), has_corrupt).alias("reasons")
    why = F.when(~F.col("_valid"), F.struct(*texts, reasons)).alias("_rejected")
    return rows.select(*schema.names, *carry, "_valid", why)


def accepted(rows: DataFrame, schema: T.StructType, carry: Sequence[str] = ()) -> DataFrame:
    """Valid rows of `checked`."""
    return rows.filter("_valid").select(*schema.names, *carry)


def rejected(rows: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Rejected rows of `checked`: their texts, what was carried, and `reasons`."""
    return rows.filter("NOT _valid").select(*carry, "_rejected.*")


def validate(
    raw: DataFrame, schema: T.StructType, on_malformed: str = "reject", counts: Observation | None = None,
    carry: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Split raw rows into typed valid rows and rejected rows with their reasons.

    Rejected rows keep their texts and have `reasons`, an array of `(column, reason)`. Where the contract has an
    `operation`, any other than insert, update and delete is a reason: such a change could not be applied. Both parts
    have the columns named by `carry`.
    `on_malformed`: `reject` keeps malformed lines among the rejected, `drop` leaves
    them out, `fail` stops the job at the first one. `counts` receives `valid` and
    `rejected` from the first action on the valid rows, without a pass of its own.
    """
    if on_malformed not in ("reject", "drop", "fail"):
        raise ValueError(f"unknown option: {on_malformed}")
    checked = annotate(raw, schema, carry)
    has_corrupt = CORRUPT in raw.columns
    if has_corrupt and on_malformed == "fail":
        stop = F.raise_error(F.concat(F.lit("malformed row: "), F.col(CORRUPT))).cast("boolean")
        checked = checked.withColumn("_valid", F.when(F.col(CORRUPT).isNull(), F.col("_valid")).otherwise(stop))
    elif has_corrupt and on_malformed == "drop":
        checked = checked.filter(F.col(CORRUPT).isNull())
    counted = checked
    if counts is not None:
        tallies = F.count_if("_valid").alias("valid"), F.count_if(~F.col("_valid")).alias("rejected")
        counted = checked.observe(counts, *tallies)
    valid = counted.filter("_valid").select(*schema.names, *carry)
    kept = [*([CORRUPT] if has_corrupt else []), *carry]
    reasons = _reasons(schema, set(raw.columns), has_corrupt).alias("reasons")
    rejected = checked.filter("NOT _valid").select(
        *kept, *[F.col(f"_text_{n}").alias(n) for n in schema.names], reasons
    )
    return valid, rejected


def conform(df: DataFrame, schema: T.StructType, lenient: bool = False) -> DataFrame:
    """Project, reorder and cast to the contract; `lenient` turns impossible casts into nulls."""
    missing = [n for n in schema.names if n not in df.columns]
    if missing:
        raise ValueError(f"columns missing from input: {', '.join(missing)}")
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}

    def cast(f: T.StructField) -> Column:
        if lenient and isinstance(f.dataType, T.IntegralType) and f.name in text:
            return _integer(F.btrim(f.name), f.dataType)
        return F.col(f.name).try_cast(f.dataType) if lenient else F.col(f.name).cast(f.dataType)

    return df.select(*[cast(f).alias(f.name) for f in schema.fields])


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Name-aligned union of same-shaped frames."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(DataFrame.unionByName, frames)
