"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target in words, every document the same expected number of copies as its source: a whole number
and a fraction. Fractions, as masses in words, are rounded pairwise: mass moves from one document to the other, at
random in either direction, until one of them is taken whole or not at all. Sums never change, so a source's words meet
its target but for the one document that is left. Documents are dealt into groups; a group is folded to one residual,
residuals are folded again, up a tree whose last level holds one residual per source. Masses are whole numbers and the
dice are hashes, so a rerun takes the same copies however the work was split. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, functions as F

from sparge.llm.common import shuffle_partitions, write_stage

RATIO = 1.5
WEIGHTS = (5, 2, 1)
MOST = 2
SEED = 17
# Masses are counted in this fraction of a word.
SCALE = 1 << 20
# Documents of one group of the tree.
FAN_IN = 256
# Repeats of one row that a task unfolds at once.
CHUNK = 1 << 16

BLANKS = r"[\x20\x09-\x0D]+"


def sized(docs: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """Distinct rows with the number of their repeats: doc_id, source, size (words), text_hash, repeats."""
    words = F.size(F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), BLANKS), ""))
    rows = docs.select("doc_id", F.col(source).alias("source"), words.cast("long").alias("size"), F.xxhash64(text).alias("text_hash"))
    return rows.groupBy("doc_id", "source", "size", "text_hash").agg(F.count("*").alias("repeats"))


def ranked(sources: DataFrame, key: str) -> DataFrame:
    """Adds `rank`, from 0, by code point, null last. Ranges are sorted apart; only their counts come together."""
    order = [F.col(key).isNull(), F.col(key)]
    dealt = sources.repartitionByRange(shuffle_partitions(sources.sparkSession), *order).sortWithinPartitions(*order)
    numbered = dealt.withColumns(
        {"rank_part": F.spark_partition_id(), "rank_row": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}
    )
    numbered = write_stage(numbered, "mix-ranks")
    bases, at = [(-1, 0)], 0
    for row in sorted(numbered.groupBy("rank_part").count().collect(), key=lambda r: r["rank_part"]):
        bases.append((row["rank_part"], at))
        at += row["count"]
    base = F.create_map(*[F.lit(v) for pair in bases for v in pair])
    rank = F.element_at(base, F.col("rank_part")) + F.col("rank_row")
    return numbered.withColumn("rank", rank).drop("rank_part", "rank_row")


def targets(kinds: DataFrame, ratio: float = RATIO, weights: Sequence[int] = WEIGHTS, most: float = MOST) -> DataFrame:
    """Per source: source_size, target, whole copies of each document, and the fraction beyond (in 1/SCALE).

    Targets share `ratio` of all words by weight. One above `most` times its source stops there and the excess is
    shared among the others, by weight, until none is above: all others then have the same words per weight.
    That level rises with each round and is the only value that comes to the driver.
    """
    sizes = kinds.groupBy("source").agg(F.sum(F.col("size") * F.col("repeats")).alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights)).cast("int") + 1)
    table = write_stage(ranked(sizes, "source").withColumn("weight", weight).drop("rank"), "mix-sources")
    limit = F.col("source_size") * F.lit(float(most))
    goal = float(Fraction(str(ratio)) * (table.agg(F.sum("source_size")).first()[0] or 0))
    level, before = 0.0, None
    while True:
        full = limit <= F.col("weight") * F.lit(level)
        row = table.agg(
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0.0)).alias("stopped"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("open"), F.count_if(full).alias("n"),
        ).first()
        if row["n"] == before or not row["open"]:
            break
        before, level = row["n"], max(level, (goal - row["stopped"]) / row["open"])
    target = F.least(limit, F.col("weight") * F.lit(level)) if row["open"] else limit
    copies = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    scaled = F.round(copies * SCALE).cast("long")
    found = table.withColumn("target", target).withColumn("scaled", scaled)
    return found.select(
        "source", "source_size", "target", F.expr(f"scaled div {SCALE}").alias("whole"), (F.col("scaled") % SCALE).alias("fraction")
    )


def _fold() -> Column:
    """A group's items, heavy ones first, folded in pairs: those decided, and the last one, which may be left between.

    Carry and item exchange mass: `gain` can move from the item to the carry, `loss` the other way; the first happens with
    probability loss / (gain + loss), so each keeps its expected mass. Whoever is whole or nothing then is decided; the
    other one is carried on. Beginning with the heavy ones leaves a light one at the end.
    """
    paired = """transform(array(named_struct('gain', least(acc.carry.room - acc.carry.mass, item.mass),
                                             'loss', least(acc.carry.mass, item.room - item.mass))),
        p -> if(pmod(xxhash64(acc.carry.dice, item.dice), p.gain + p.loss) < p.loss, p.gain, -p.loss))[0]"""
    moved = "named_struct({}, 'mass', {}.mass {} moved, 'room', {}.room)"
    kept = "'weight', {0}.weight, 'dice', {0}.dice, 'doc_id', {0}.doc_id, 'text_hash', {0}.text_hash, 'size', {0}.size"
    carry = moved.format(kept.format("acc.carry"), "acc.carry", "+", "acc.carry")
    item = moved.format(kept.format("item"), "item", "-", "item")
    between = "(acc.carry.mass + moved > 0 and acc.carry.mass + moved < acc.carry.room)"
    return F.expr(f"""aggregate(slice(items, 2, size(items)),
        named_struct('carry', items[0], 'decided', slice(items, 1, 0)),
        (acc, item) -> transform(array({paired}), moved -> named_struct(
            'carry', if({between}, {carry}, {item}),
            'decided', concat(acc.decided, array(if({between}, {item}, {carry})))))[0],
        acc -> concat(acc.decided, array(acc.carry)))""")


def _folded(moving: DataFrame) -> DataFrame:
    """One level of the tree: rows of the same source and group folded; as many rows come back."""
    item = F.struct((-F.col("size")).alias("weight"), "dice", "doc_id", "text_hash", "size", "mass", "room")
    groups = moving.groupBy("source", "bin").agg(F.array_sort(F.collect_list(item)).alias("items"))
    out = groups.select("source", "bin", F.explode(_fold()).alias("item"))
    return out.select("source", "bin", "item.dice", "item.doc_id", "item.text_hash", "item.size", "item.mass", "item.room")


def _unfolded(kinds: DataFrame) -> DataFrame:
    """A row per document again; repeats of one row are told apart by their number."""
    most = kinds.agg(F.max("repeats")).first()[0] or 0
    parts = kinds.withColumn("chunk", F.explode(F.expr(f"sequence(0L, (repeats - 1) div {CHUNK})")))
    if most > CHUNK:  # else there is one chunk per row, and nothing to spread
        parts = parts.repartition("doc_id", "source", "text_hash", "chunk")
    last = F.least(F.col("repeats") - F.col("chunk") * CHUNK, F.lit(CHUNK).cast("long"))
    rows = parts.withColumn("copy_no", F.explode(F.sequence(F.lit(1).cast("long"), last)))
    return rows.withColumn("copy_no", F.col("chunk") * CHUNK + F.col("copy_no")).drop("chunk", "repeats")


def mix(
    docs: DataFrame, ratio: float = RATIO, weights: Sequence[int] = WEIGHTS, most: float = MOST, seed: int = SEED,
    text: str = "text", source: str = "source", fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per document: doc_id, source, size, text_hash, source_size, target, copies, taken.

    `copies` is the whole number below or above target / source_size, `taken` the words of all copies. The sum of a
    source's `taken` differs from its target by at most half the words of one document, and by half of 1/SCALE of the source.

    Null and empty texts have no words, and no copies beyond the whole number. Documents without source are a source of
    their own, last in order. A null doc_id is an id like any other. Repeated rows are rounded each for itself. Sources
    without words have the target 0. Other columns are not read; an empty table gives an empty result.
    """
    kinds = write_stage(sized(docs, text, source), "mix-kinds")
    goals = write_stage(targets(kinds, ratio, weights, most), "mix-targets")
    dice = F.xxhash64(F.lit(seed), "doc_id", "source", "text_hash", "size", "copy_no")
    same = F.col("source").eqNullSafe(F.col("of_source"))
    goal = goals.withColumnRenamed("source", "of_source")
    units = _unfolded(kinds).withColumn("dice", dice).join(goal, same)
    units = units.select("source", "dice", "doc_id", "text_hash", "size", (F.col("fraction") * F.col("size")).alias("mass"), (F.col("size") * SCALE).alias("room"))
    units = write_stage(units, "mix-units")
    between = (F.col("mass") > 0) & (F.col("mass") < F.col("room"))
    bins = -(-units.filter(between).count() // fan_in)
    decided = units.filter(~between)
    moving = units.filter(between).withColumn("bin", F.pmod("dice", F.lit(max(bins, 1))))
    while bins:
        level = write_stage(_folded(moving), "mix-level")
        if bins == 1:  # one residual per source: it goes to the nearer side
            decided = decided.unionByName(level.drop("bin"))
            break
        decided = decided.unionByName(level.filter(~between).drop("bin"))
        moving = level.filter(between).withColumn("bin", F.expr(f"bin div {fan_in}"))
        bins = -(-bins // fan_in)
    up = ((F.col("mass") > 0) & (F.col("mass") * 2 >= F.col("room"))).cast("long")
    found = decided.join(goal, same).withColumn("copies", F.col("whole") + up)
    return found.select("doc_id", "source", "size", "text_hash", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, mixed: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """The rows of `docs`, each as often as `mixed` takes it.

    Rows that agree in doc_id, source and text stand for each other: the first of them is written for all.
    """
    total = mixed.groupBy("doc_id", "source", "text_hash").agg(F.sum("copies").alias("mix_copies")).filter("mix_copies > 0")
    total = total.select(F.col("doc_id").alias("mix_id"), F.col("source").alias("mix_source"), F.col("text_hash").alias("mix_hash"), "mix_copies")
    # The whole row travels as one value, so no name of its columns can clash.
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole_row")
    rows = docs.select(whole, F.col("doc_id").alias("row_id"), F.col(source).alias("row_source"), F.xxhash64(text).alias("mix_hash"))
    same = F.col("mix_id").eqNullSafe(F.col("row_id")) & F.col("mix_source").eqNullSafe(F.col("row_source"))
    met = rows.join(total, [same, rows["mix_hash"] == total["mix_hash"]]).drop(total["mix_hash"])
    met = met.dropDuplicates(["mix_id", "mix_source", "mix_hash"])
    copies = met.select("whole_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_copies"))))
    return copies.select("whole_row.*")
