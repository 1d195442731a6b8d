"""Filter interaction audit: what each filter removes at each place of every order in which filters may be applied.

A document is reduced to the set of filters it fails. Of a part (a language), documents with the same set form one cell
with three weights: documents, good ones and toxic ones. A cell is folded along every order of the filters by
higher-order functions, which gives one weighted struct per order and step; the structs of a part's cells are summed
by position. However many documents there are, a part has at most 2^filters cells. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

from pyspark.sql import Column, DataFrame, functions as F

from sparge.llm.common import write_stage

Test = Callable[[Column, Column], Column]

BLANKS = r"[\x20\x09-\x0D]+"

# Failure conditions of a text and its words; all compare whole numbers.
TESTS: dict[str, Test] = {
    "A": lambda text, words: F.size(words) < 100,
    "B": lambda text, words: F.size(F.array_distinct(words)) * 100 < F.size(words) * 80,
    "C": lambda text, words: (F.octet_length(text) - F.octet_length(F.regexp_replace(text, "[A-Z]+", ""))) * 100
    > F.char_length(text) * 10,
    "D": lambda text, words: text.rlike(r"[#$%&*|]"),
}
REPEAT = "E"

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def orders(letters: str) -> list[str]:
    return ["".join(p) for p in permutations(letters)]


def _bit(letters: str, letter: str) -> int:
    return 1 << letters.index(letter)


def failures(docs: DataFrame, tests: dict[str, Test], text: str, part: str) -> DataFrame:
    """Per row: doc_id, part, a SHA-256 of the text, and the tests it fails as bits. Texts end here."""
    letters = "".join(tests)
    rows = docs.select(
        "doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(text, F.lit("")).alias("whole_text")
    )
    rows = rows.withColumn("words", F.array_remove(F.split("whole_text", BLANKS), ""))
    bits = [
        F.coalesce(test(F.col("whole_text"), F.col("words")), F.lit(False)).cast("int") * _bit(letters, letter)
        for letter, test in tests.items()
    ]
    mask = sum(bits[1:], bits[0]) if bits else F.lit(0)
    return rows.select("doc_id", "part", F.unhex(F.sha2("whole_text", 256)).alias("digest"), mask.alias("mask"))


def cells(docs: DataFrame, labels: DataFrame, tests: dict[str, Test], text: str, part: str) -> DataFrame:
    """Documents, good and toxic ones by part and set of failed filters (bits; the highest stands for repeats).

    Copies of a text share all bits but that one: whoever has the text's smallest doc_id passes. They are first
    counted per id, then per text, part and label, each with a map-side reduction, so a text that a third of the
    documents share sends a row per task. The last step sees a text once per part and label.
    """
    flag = lambda column: F.coalesce(F.max(F.col(column) == 1), F.lit(False)).alias(column)
    marks = labels.select("doc_id", "quality", "toxic").groupBy("doc_id").agg(flag("quality"), flag("toxic"))
    marked = failures(docs, tests, text, part).join(marks, "doc_id", "left").select(
        "doc_id", "part", "digest", "mask",
        F.coalesce("quality", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )
    same = ["digest", "part", "mask", "good", "toxic"]
    by_id = marked.groupBy(*same, "doc_id").agg(F.count("*").alias("n"))
    # A null doc_id is neither smaller nor larger than another one.
    known = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))
    by_label = by_id.groupBy(*same).agg(
        F.sum("n").alias("n"), F.min(known).alias("first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
    )
    by_label = write_stage(by_label, "audit-texts")
    least = by_label.groupBy("digest").agg(F.min("first.doc_id").alias("least_id"))
    found = by_label.join(least, "digest")
    holds = F.when(F.col("first.doc_id") == F.col("least_id"), F.col("first.n")).otherwise(0)
    passing = F.coalesce(holds, F.lit(0)) + F.col("nameless")
    repeat = 1 << len(tests)
    split = F.explode(
        F.array(
            F.struct(F.col("mask").alias("mask"), passing.alias("n")),
            F.struct((F.col("mask") + repeat).alias("mask"), (F.col("n") - passing).alias("n")),
        )
    )
    rows = found.select("part", "good", "toxic", split.alias("cell")).select("part", "good", "toxic", "cell.*")
    weight = lambda name: F.sum(F.when(F.col(name), F.col("n")).otherwise(0)).alias(name)
    return rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), weight("good"), weight("toxic"))


def _folded(letters: str) -> str:
    """A cell folded along all orders: one struct per order and step, in one array."""
    shape = ", ".join(f"{c}: bigint" for c in COUNTS)
    step = """named_struct(
        'kept', if(acc.gone or (mask & bit) <> 0, 0L, n),
        'removed', if(not acc.gone and (mask & bit) <> 0, n, 0L),
        'redundant', if(acc.gone and (mask & bit) <> 0, n, 0L),
        'unique_fails', if(mask = bit, n, 0L),
        'good_lost', if(not acc.gone and (mask & bit) <> 0, good, 0L),
        'toxic_lost', if(not acc.gone and (mask & bit) <> 0, toxic, 0L))"""
    return f"""flatten(transform(filter_orders, o -> aggregate(
        transform(sequence(1, {len(letters)}), i -> shiftleft(1, instr('{letters}', substr(o, i, 1)) - 1)),
        named_struct('gone', false, 'steps', cast(array() as array<struct<{shape}>>)),
        (acc, bit) -> named_struct('gone', acc.gone or (mask & bit) <> 0, 'steps', concat(acc.steps, array({step}))),
        acc -> acc.steps)))"""


def audit(
    docs: DataFrame, labels: DataFrame, tests: dict[str, Test] | None = None, text: str = "text", part: str = "lang"
) -> DataFrame:
    """One row per part, order of the filters and step; see COUNTS, and `shapley`.

    Filters are the letters of `tests` and `E`, which removes a document whose text a smaller doc_id has, wherever in
    the table and whether removed or not. `kept` and `removed` count the part's documents after and at the step,
    `redundant` those that fail the step's filter but are gone already, `unique_fails` those that fail it alone,
    `good_lost` and `toxic_lost` the removed ones with label `quality` or `toxic` 1; `shapley` sums what the filter
    removes over all orders, at whatever step.

    Null and empty texts are one text; a null part counts as the empty string. Repeated rows count each, and share
    their fate: rows of one doc_id do not repeat each other. A row without doc_id never repeats another one nor is
    repeated. Labels may be missing or repeated (any 1 counts). Other columns are not read. An empty table has no
    parts and gives no rows.
    """
    tests = TESTS if tests is None else tests
    letters = "".join(tests) + REPEAT
    named = orders(letters)
    found = cells(docs, labels, tests, text, part).withColumn("filter_orders", F.array(*map(F.lit, named)))
    steps = found.select("part", F.posexplode(F.expr(_folded(letters))).alias("place", "step_counts"))
    summed = steps.groupBy("part", "place").agg(*[F.sum(f"step_counts.{c}").alias(c) for c in COUNTS])
    summed = summed.withColumn("filter_order", F.element_at(F.array(*map(F.lit, named)), (F.col("place") / len(letters)).cast("int") + 1))
    summed = summed.withColumn("step", (F.col("place") % len(letters) + 1).cast("int"))
    summed = summed.withColumn("filter", F.substr("filter_order", "step", F.lit(1)))
    summed = write_stage(summed, "audit-steps")
    shares = summed.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    return summed.join(shares, ["part", "filter"]).select("part", "filter_order", "step", *COUNTS, "shapley")


AUDIT_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
             min(doc_id) OVER (PARTITION BY t) AS least_id FROM d),
l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
      FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
             (len(words) < 100)::INT + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INT
             + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT
             + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(w.doc_id > least_id, false)::INT AS mask
      FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
cells AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
      FROM f a, f b, f c, f d, f e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (SELECT filter_order, step, bits[step] AS bit, list_sum(bits[1:step - 1])::INT AS before FROM o, range(1, 6) r(step)),
s2 AS (SELECT filter_order, step::INT AS step, bit, coalesce(before, 0) AS before FROM s),
r AS (SELECT part, filter_order, step, bit,
             sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
             sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
             sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
             sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
             sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
             sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
      FROM cells, s2 GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley FROM r
"""
