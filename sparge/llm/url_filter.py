"""URL filters: exact membership by a cascade of Bloom filters.

The cascade separates listed keys from all other keys of the corpus. Level 1 holds the listed keys; keys that are not
listed and pass it by chance are held by level 2; listed keys that pass level 2 by chance by level 3, and so on until
nobody passes. A key is listed if the first level that rejects it is an even one (or, after the last level, if the
number of levels is odd): exact for all keys of the corpus. Pages test their own key against a few words of bits; the
keys themselves are joined to nothing. Only DataFrame functions are used.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, functions as F

from sparge.llm.common import UPPER, write_stage

BITS_PER_KEY = 8
HASHES = 4
# Keys of the corpus per shard of the cascade: a shard's filters are one row of a few kB, whatever the corpus holds.
SHARD_KEYS = 16_384
# Filters of up to this size are put into the plan as one value; larger ones meet the pages by shard number.
INLINE_BYTES = 4 << 20
MAX_LEVELS = 64

# (verdict, host, path): a rule fits its host and all subdomains, if the url's path starts with its path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` up to / ? # or the end, A-Z lower-cased. Path: then up to ? # or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower()), path


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; of equally long ones the first by text. Null without a rule."""
    found = []
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = (host == rule_host) | F.endswith(host, F.lit("." + rule_host))
        found.append((fits & F.startswith(path, F.lit(rule_path)), rule_host + rule_path, verdict))
    first = lambda at: functools.reduce(
        lambda rest, r: F.when(r[0], F.lit(r[at])).otherwise(rest), reversed(found), F.lit(None).cast("string")
    )
    return first(1), first(2)


def _bit(key: Column, level: int, hash_no: int, words: Column) -> Column:
    """Position of a key's bit in a filter of so many 64-bit words; every level hashes anew."""
    return F.pmod(F.xxhash64(key, F.lit(level * HASHES + hash_no)), words * 64)


def _level(keys: DataFrame, level: int) -> DataFrame:
    """(shard, words) for the keys (shard, key) of a level: per shard an array of 64-bit words, sized by its keys."""
    sizes = keys.groupBy("shard").agg(F.ceil(F.count("*") * F.lit(BITS_PER_KEY / 64)).cast("long").alias("n_words"))
    spread = keys.join(sizes, "shard").select(
        "shard", F.explode(F.array(*[_bit(F.col("key"), level, h, F.col("n_words")) for h in range(HASHES)])).alias("bit")
    )
    empty = sizes.select("shard", F.explode(F.expr("sequence(0L, n_words - 1)")).alias("word"), F.lit(0).cast("long").alias("bits"))
    ones = spread.select(
        "shard", F.floor(F.col("bit") / 64).alias("word"), F.expr("shiftleft(1L, cast(bit % 64 as int))").alias("bits")
    )
    merged = ones.unionByName(empty).groupBy("shard", "word").agg(F.bit_or("bits").alias("bits"))
    entries = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return merged.groupBy("shard").agg(F.transform(entries, lambda e: e["bits"]).alias("words"))


def _passes(key: Column, level: int, words: Column) -> Column:
    """Whether a level has all bits of a key; a shard without a filter there has none."""
    size = F.size(words).cast("long")
    tests = []
    for h in range(HASHES):
        bit = _bit(key, level, h, size)
        word = F.get(words, F.floor(bit / 64).cast("int"))
        tests.append(F.getbit(word, (bit % 64).cast("int")) == 1)
    return F.coalesce((size > 0) & functools.reduce(lambda a, b: a & b, tests), F.lit(False))


def build_cascade(universe: DataFrame) -> tuple[DataFrame, int, int]:
    """Filters of `universe` (key, listed; keys distinct): a frame (shard, level_1, ..), levels and shards."""
    count = universe.count()
    shards = max(1, -(-count // SHARD_KEYS))
    keyed = write_stage(
        universe.select(F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard"), "key", "listed"), "universe"
    )
    held, other = keyed.filter("listed").drop("listed"), keyed.filter("NOT listed").drop("listed")
    filters, level = None, 0
    while not held.isEmpty():
        level += 1
        if level > MAX_LEVELS:
            raise RuntimeError(f"keys could not be told apart within {MAX_LEVELS} levels")
        made = write_stage(_level(held, level), "level")
        filters = made.withColumnRenamed("words", f"level_{level}") if filters is None else filters.join(
            made.withColumnRenamed("words", f"level_{level}"), "shard", "full"
        )
        chance = other.join(made, "shard").filter(_passes(F.col("key"), level, F.col("words"))).drop("words")
        held, other = write_stage(chance, "chance"), held
    if filters is None:
        filters = keyed.sparkSession.createDataFrame([], "shard int")
    return write_stage(filters, "cascade"), level, shards


def _member(key: Column, levels: list[Column]) -> Column:
    """Listed: the first level that rejects the key is an even one."""
    inside = F.lit(len(levels) % 2 == 1)
    for number in range(len(levels), 0, -1):
        inside = F.when(~_passes(key, number, levels[number - 1]), F.lit(number % 2 == 0)).otherwise(inside)
    return inside


def mark_listed(rows: DataFrame, key: str, listed: DataFrame, inline_bytes: int = INLINE_BYTES) -> DataFrame:
    """`rows` with a column `listed`: whether its key is among the keys of `listed` (one column, `key`).

    Null keys are not listed; repeated keys count once. The filters are one value in the plan if their measured size
    allows, else pages and shards meet by shard number (a shard is one row, and shards are many and alike in size).
    """
    both = rows.select(F.col(key).alias("key"), F.lit(False).alias("listed"), F.lit(True).alias("here"))
    both = both.unionByName(listed.select("key", F.lit(True).alias("listed"), F.lit(False).alias("here")))
    known = both.filter("key IS NOT NULL").groupBy("key").agg(F.max("listed").alias("listed"), F.max("here").alias("here"))
    filters, levels, shards = build_cascade(write_stage(known.filter("here").drop("here"), "keys"))
    names = [f"level_{n}" for n in range(1, levels + 1)]
    shard = F.pmod(F.xxhash64(F.col(key)), F.lit(shards)).cast("int")
    if not levels:
        return rows.withColumn("listed", F.lit(False))
    size = filters.agg(sum((F.sum(F.coalesce(F.size(n), F.lit(0))) for n in names), F.lit(0))).first()[0] * 8
    if size <= inline_bytes:
        entries = F.map_from_entries(F.collect_list(F.struct("shard", F.struct(*names))))
        whole = filters.agg(entries.alias("cascade")).scalar()
        found = rows.withColumn("cascade_of_shard", F.element_at(whole, shard))
        levels_of = [F.col("cascade_of_shard")[n] for n in names]
        return found.withColumn("listed", F.coalesce(F.col(key).isNotNull() & _member(F.col(key), levels_of), F.lit(False))).drop("cascade_of_shard")
    keyed = rows.withColumn("cascade_shard", shard)
    by_shard = filters.withColumnRenamed("shard", "cascade_shard")
    found = keyed.join(by_shard, "cascade_shard", "left")
    member = F.coalesce(F.col(key).isNotNull() & _member(F.col(key), [F.col(n) for n in names]), F.lit(False))
    return found.withColumn("listed", member).drop("cascade_shard", *names)


def judge(pages: DataFrame, listed: DataFrame, rules: tuple = RULES, inline_bytes: int = INLINE_BYTES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, listed.

    The longest rule that fits decides; without one, a page whose host and path are listed is blocked and any other
    allowed. `listed` has keys `host + path`. A null url or one without `://` has an empty host and path, fits no
    rule and is listed only if the empty key is. Other columns are not read; an empty table gives an empty result.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("by_rule"), F.concat("host", "path").alias("url_key"))
    found = mark_listed(rows, "url_key", listed, inline_bytes)
    decided = F.coalesce("by_rule", F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow")))
    return found.select("page_id", "host", "path", "rule", decided.alias("verdict"), "listed")


def tracked_keys(pages: DataFrame) -> DataFrame:
    """The list that the registered query filters by: keys of pages that were reached by a tracking link.

    A url whose query part has a parameter that starts with `utm_` lists its host and path, so the same page reached by
    any other url is blocked with it.
    """
    host, path = host_and_path(F.col("url"))
    tracked = pages.filter(F.col("url").rlike(r"^[^#]*[?&]utm_"))
    return tracked.select(F.concat(host, path).alias("key")).distinct()
