"""License scans: phrases, and an exact set-similarity join of text blocks with license templates.

A text's words are cut into blocks that overlap by half, so that any run of up to a step of words lies in one block. The
step is BLOCK_STEP; for longer templates it is doubled until it holds them, and such templates have blocks of their own.
A template matches a block that holds at least a given share of the template's distinct words (containment). The join
orders words by their frequency in all documents, rarest first, and finds every match by three filters:
- length: a block must hold at least as many template words as the least demanding template needs,
- prefix: of a template that needs o of its m words, one of the rarest m-o+1 must be in the block's own prefix
  (so texts without any such word are not cut into blocks at all),
- position: after the first common word at positions i and j, at most the shorter rest can still agree.
What passes is verified. Only DataFrame functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from sparge.llm.common import UPPER

WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Names and opening statements of public licenses, as words.
TEMPLATES = {
    "mit": (
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
    ),
    "apache": (
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license",
    ),
    "gpl": (
        "this work is licensed under the gnu general public license version 3",
        "redistribute it and or modify it under the terms of the gnu general public license",
    ),
    "cc-by": ("this work is licensed under a creative commons attribution 4 0 international license",),
    "cc-by-nc": ("licensed under cc by nc 4 0",),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that",
    ),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without fee",),
    "mpl": ("this source code form is subject to the terms of the mozilla public license v 2 0",),
}
CONTAINMENT = 0.8
BLOCK_STEP = 24


class Template:
    """A template's label, distinct words, the number of them that a match needs, and the step of its blocks."""

    def __init__(self, label: str, text: str, containment: float):
        self.label, self.words = label, sorted(set(text.split()))
        self.step = BLOCK_STEP
        while self.step < len(text.split()):
            self.step *= 2
        self.need = max(1, math.ceil(containment * len(self.words) - 1e-9))


def _double(text: Column) -> Column:
    """The words between two blanks on either side: ` a  b  c `, so that neighbours share no blank."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    spaced = F.trim(F.regexp_replace(lowered, WORD_GAP, "  "))
    return F.when(spaced == "", F.lit("")).otherwise(F.concat(F.lit(" "), spaced, F.lit(" ")))


def _starts(phrase: str, line: Column) -> dict[str, Column]:
    """How often, and as which first and last word, a phrase's words stand consecutively; null without a place."""
    text = " " + phrase.replace(" ", "  ") + " "
    there = F.contains(line, F.lit(text))
    # Places may share words (a b a b a): the pattern looks ahead and so takes none of them away.
    count = F.when(there, F.regexp_count(line, F.lit(f"(?={text})"))).otherwise(0)
    first = F.when(there, _words(F.substring_index(line, text, 1)))
    last = F.when(there, _words(line) - _words(F.concat(F.lit(text), F.substring_index(line, text, -1))))
    return {"count": count, "first": first, "last": last}


def _words(line: Column) -> Column:
    """Number of words of a line that `_double` made, or of a part of it that was cut between words."""
    return F.floor((F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))) / 2).cast("long")


def _blocks(words: Column, vocabulary: Column, least: int, step: int) -> Column:
    """Per block its distinct template words, if there are at least `least` of them."""
    count = F.greatest(F.lit(1), F.ceil(F.size(words) / F.lit(step)).cast("int") - 1)
    starts = F.sequence(F.lit(0), count - 1)
    cut = F.transform(starts, lambda i: F.array_intersect(F.slice(words, i * step + 1, 2 * step), vocabulary))
    return F.filter(cut, lambda b: F.size(b) >= least)


def _literal_map(values: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def scan(
    docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, tuple] | None = None,
    containment: float = CONTAINMENT, text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Null texts count as empty; a text without words has no label. `score` is 1 with a base label, else the largest
    containment of a matching template, else 0. A row of `docs` is a row of the result even if rows repeat; other
    columns are not read, whatever their names. An empty table gives an empty result.

    Words of templates are counted in all documents (a row per template word reaches the driver); the index of
    template prefixes has a row per template and prefix word, which bounds what is broadcast.
    """
    spark = docs.sparkSession
    phrases = PHRASES if phrases is None else phrases
    known = [Template(k, t, containment) for k, v in (TEMPLATES if templates is None else templates).items() for t in v]
    vocabulary = sorted({w for t in known for w in t.words})
    lines = docs.select("doc_id", _double(F.col(text)).alias("line"))
    allowed = F.array(*[F.lit(w) for w in vocabulary])
    split = F.split(F.trim("line"), " {2}")
    counted = lines.select(F.explode(F.array_intersect(split, allowed)).alias("word")).groupBy("word").count()
    frequency = {r["word"]: r["count"] for r in counted.collect()}
    order = sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}

    index = []
    for number, t in enumerate(known):
        ranks = sorted(rank[w] for w in t.words)
        for position, r in enumerate(ranks[: len(ranks) - t.need + 1]):
            index.append((r, t.step, number, t.label, position, ranks, t.need))
    prefixes = spark.createDataFrame(
        index, "word_rank int, step int, template int, label string, template_at int, ranks array<int>, need int"
    )

    found = [(_starts(p, F.col("line")), label) for p, label in phrases.items()]
    # A block that matches has a word of some template's prefix, so has its text; other texts are not cut into blocks.
    starters = sorted({order[r] for r, *_ in index})
    possible_text = F.col("line").rlike(" (?:" + "|".join(starters) + ") ")
    base = F.array_compact(F.array(*[F.when(s["count"] > 0, F.lit(label)) for s, label in found]))
    least = {step: min(t.need for t in known if t.step == step) for step in sorted({t.step for t in known})}

    def by_step(step: int) -> Column:
        ranks = lambda b: F.array_sort(F.transform(b, lambda w: F.element_at(_literal_map(rank), w)))
        prefix = lambda b: F.slice(b, 1, F.size(b) - (least[step] - 1))
        ranked = F.transform(_blocks(split, allowed, least[step], step), ranks)
        return F.transform(ranked, lambda b: F.struct(F.lit(step).alias("step"), b.alias("ranks"), prefix(b).alias("prefix")))

    ranked = F.when(possible_text, F.concat(*[by_step(step) for step in least]))
    rows = lines.select(
        F.monotonically_increasing_id().alias("row_no"),
        "doc_id",
        _words(F.col("line")).alias("n_words"),
        sum((s["count"] for s, _ in found), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(F.array(*[s["first"] for s, _ in found])).alias("first_word"),
        F.array_max(F.array(*[s["last"] for s, _ in found])).alias("last_word"),
        base.alias("base"),
        ranked.alias("blocks"),
    )
    own = ["row_no", "doc_id", "n_words", "n_base", "first_word", "last_word", "base"]
    blocks = rows.select(*own, F.posexplode_outer("blocks").alias("block_no", "block"))
    words = blocks.select(
        *own, F.col("block.step").alias("step"), F.col("block.ranks").alias("block"),
        F.posexplode_outer("block.prefix").alias("block_at", "word_rank"),
    )
    joined = words.join(F.broadcast(prefixes), ["word_rank", "step"], "left")
    possible = F.least(F.size("block") - F.col("block_at"), F.size("ranks") - F.col("template_at"))
    share = F.when(
        possible >= F.col("need"), F.size(F.array_intersect("block", "ranks"))
    )
    match = joined.withColumn("overlap", share).withColumn(
        "match", F.when(F.col("overlap") >= F.col("need"), F.col("overlap") / F.size("ranks"))
    )
    by_row = match.groupBy(*own).agg(
        F.collect_set(F.when(F.col("match").isNotNull(), F.col("label"))).alias("more"), F.max("match").alias("best")
    )
    joined_labels = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return by_row.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        joined_labels(F.col("base")).alias("base_labels"),
        joined_labels(F.concat("base", "more")).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def scan_sql() -> str:
    """The scan by brute force in DuckDB SQL: every block against every template. Its blocks have one step."""
    if any(Template(k, t, CONTAINMENT).step != BLOCK_STEP for k, v in TEMPLATES.items() for t in v):
        raise ValueError(f"the SQL has blocks for templates of at most {BLOCK_STEP} words")
    phrases = ", ".join(f"('{p}', '{label}')" for p, label in PHRASES.items())
    templates = ", ".join(
        f"('{k}', {Template(k, t, CONTAINMENT).words!r}, {Template(k, t, CONTAINMENT).need})"
        for k, v in TEMPLATES.items() for t in v
    )
    gap = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"""
WITH s AS (SELECT doc_id, regexp_split_to_array(
               translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{gap}') AS cut FROM documents),
w AS (SELECT doc_id, [x for x in cut if x <> ''] AS words FROM s),
phrases(phrase, label) AS (VALUES {phrases}),
templates(label, tokens, need) AS (VALUES {templates}),
places AS (SELECT doc_id, p.label, unnest([i for i in range(len(words))
               if words[i + 1 : i + len(string_split(p.phrase, ' '))] = string_split(p.phrase, ' ')]) AS start
           FROM w, phrases p),
base AS (SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
                list(DISTINCT label) AS labels FROM places GROUP BY doc_id),
blocks AS (SELECT doc_id, unnest([words[i * {BLOCK_STEP} + 1 : i * {BLOCK_STEP} + {2 * BLOCK_STEP}]
               for i in range(greatest(1, (len(words) + {BLOCK_STEP - 1}) // {BLOCK_STEP} - 1))]) AS block FROM w),
hits AS (SELECT doc_id, label, len(list_intersect(tokens, block)) / len(tokens) AS share FROM blocks, templates
         WHERE len(list_intersect(tokens, block)) >= need),
best AS (SELECT doc_id, list(DISTINCT label) AS labels, max(share) AS share FROM hits GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(base.labels, best.labels))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM w LEFT JOIN base ON w.doc_id = base.doc_id LEFT JOIN best ON w.doc_id = best.doc_id
"""
