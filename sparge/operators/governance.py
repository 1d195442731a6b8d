"""Detection, masking and tagging of personal data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sparge.functions.once import compute_once
from sparge.functions.text import as_text, mask_value

MIN_RATIO = 0.5
MIN_SCORE = 0.7
TAG_KEY, TAG_VALUE = "classification", "PII"


@dataclass(frozen=True)
class Rule:
    """A kind of personal data: its pattern, and how sure a match is.

    Repetitions are bounded or follow a fixed text, so a long run of characters
    without a match costs time linear in its length. `needs` lists texts of which every match holds one;
    where they are all absent the pattern is not tried.
    """

    name: str
    pattern: str
    score: float
    needs: tuple[str, ...] = ()


RULES = (
    Rule("email", r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}([.][A-Za-z0-9-]{1,63}){1,8}", 0.99, ("@",)),
    Rule("phone", r"[+][0-9]{1,3}[ -]?[(]?[0-9]{2,4}[)]?[ -]?[0-9]{3,4}[ -][0-9]{4}", 0.9, ("+",)),
    Rule("card", r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}", 0.85),
    Rule("ip_address", r"[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}", 0.8),
    Rule(
        "secret",
        r"(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----)",
        0.95,
        ("AKIA", "gh", "-----BEGIN "),
    ),
)


def _matches(text: Column, rule: Rule) -> Column:
    count = F.regexp_count(text, F.lit(rule.pattern))
    if not rule.needs:
        return count
    return F.when(reduce(or_, [text.contains(n) for n in rule.needs]), count).when(text.isNotNull(), 0)


def _scores(df: DataFrame, columns: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """One row per column: non-empty values, matches, and summed score, from a single aggregate."""
    types = {f.name: f.dataType for f in df.schema.fields}
    texts = compute_once(df, **{f"_text{i}": as_text(F.col(c), types[c]) for i, c in enumerate(columns)})
    entries = []
    for i, c in enumerate(columns):
        text = F.col(f"_text{i}")
        found = [F.coalesce(F.sum(_matches(text, r)), F.lit(0)).cast("bigint") for r in rules]
        entries.append(
            F.struct(
                F.lit(c).alias("field"),
                F.count_if(F.btrim(text, F.lit(" \t\r\n")) != "").alias("non_empty"),
                reduce(Column.__add__, found).alias("matches"),
                reduce(Column.__add__, [n * F.lit(r.score) for n, r in zip(found, rules)]).alias("score"),
            )
        )
    return texts.agg(F.array(*entries).alias("fields")).select(F.inline("fields"))


def detect_pii(
    df: DataFrame,
    n: int | None = None,
    min_ratio: float = MIN_RATIO,
    min_score: float = MIN_SCORE,
    rules: Sequence[Rule] = RULES,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Per column: does it hold personal data, judged on all rows, or with `n` on the first `n`.

    A column counts as personal data when its matches reach `min_ratio` of its
    non-empty values and their mean score reaches `min_score`. `order_by` makes the
    sample definite.
    """
    sample = sample_rows(df, n, order_by) if n is not None else df
    ratio = F.col("matches") / F.nullif(F.col("non_empty"), F.lit(0))
    mean = F.col("score") / F.nullif(F.col("matches"), F.lit(0))
    return _scores(sample, df.columns, rules).select(
        "field",
        "non_empty",
        "matches",
        F.coalesce((ratio >= min_ratio) & (mean >= min_score), F.lit(False)).alias("is_pii"),
    )


def sample_rows(df: DataFrame, n: int, order_by: Sequence[str] = ()) -> DataFrame:
    """The first `n` rows, by `order_by` when given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def pii_fields(df: DataFrame, **options) -> list[str]:
    """Names of the columns that `detect_pii` finds; at most one row per column is collected."""
    found = detect_pii(df, **options).filter("is_pii").select("field").collect()
    return sorted(row.field for row in found)


def pii_profile(df: DataFrame, text_columns: Sequence[str], rules: Sequence[Rule] = RULES) -> DataFrame:
    """Matches of every rule over all rows: one row per column and rule, in one scan."""
    names = {(c, r): f"_n{i}_{r.name}" for i, c in enumerate(text_columns) for r in rules}
    counted = compute_once(df, **{name: _matches(F.col(c), r) for (c, r), name in names.items()})
    entries = [
        F.struct(
            F.lit(c).alias("field"),
            F.lit(rule.name).alias("rule"),
            F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias("match_count"),
            F.count_if(F.col(name) > 0).alias("row_count"),
        )
        for (c, rule), name in names.items()
    ]
    return counted.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def with_pii_counts(df: DataFrame, text_column: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One count column per rule on every row."""
    counts = {f"{r.name}_count": F.coalesce(_matches(F.col(text_column), r), F.lit(0)) for r in rules}
    return compute_once(df, **counts)


def mask_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mask the given columns in every row; masked columns become text."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: mask_value(F.col(c), types[c]) for c in columns})


def columns_to_mask(df: DataFrame, mask: str | Sequence[str] | None = "auto") -> list[str]:
    """One masking policy for every ingest path: `auto` detection, named columns, or None.

    Detection looks at text columns only: masking turns a value into text, which a
    numeric contract column could not hold.
    """
    if mask is None:
        return []
    if mask != "auto":
        return list(mask)
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return pii_fields(df.select(*text)) if text else []


def tag_pii(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mark columns as personal data in the schema; the mark is kept in Parquet files."""
    fields = {f.name: f for f in df.schema.fields}
    for c in columns:
        df = df.withMetadata(c, {**fields[c].metadata, TAG_KEY: TAG_VALUE})
    return df


def pii_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.metadata.get(TAG_KEY) == TAG_VALUE]
