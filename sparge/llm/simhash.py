"""Near-duplicates by SimHash, found with deletion-variant signatures.

Fingerprints of 64 bits that differ in at most 3 agree, in one of their two halves, up to at most one bit. Each half
is indexed 32 times, each time with another bit as wildcard: a pair that differs only there, or not at all, meets under
an equal signature. Candidates that meet are verified on all 64 bits. Usual schemes for 3 bits cut into 4 or more
segments that have to agree exactly; two halves with a wildcard have far longer keys, hence few chance candidates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparge.llm.common import drop_rows, numbered, settings, write_stage
from sparge.llm.components import components
from sparge.llm.shingle_join import shingle_hashes, similar_edges

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
HALF_BITS = 32
# Members of one signature that are compared in one go; larger ones are compared tile by tile.
TILE = 1024
# Shingles whose bits are unpacked at once.
HASH_BLOCK = 1 << 16


def simhash(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Fingerprint of a whole text; 0 for a text without words."""
    hashes = shingle_hashes(text, words)
    if not hashes:
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), HASH_BLOCK):
        block = np.array(hashes[at : at + HASH_BLOCK], np.uint64)
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    ones = np.flatnonzero(2 * counts > len(hashes)).astype(np.uint64)
    return int(np.bitwise_or.reduce(np.uint64(1) << ones)) if len(ones) else 0


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _hash_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("whole_text")
        prints = [_signed(simhash(t)) for t in batch.column(at).to_pylist()]
        arrays = [a for i, a in enumerate(batch.columns) if i != at]
        names = [n for n in batch.schema.names if n != "whole_text"]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(prints, pa.int64())], [*names, "print"])


def simhashes(rows: DataFrame, text: str = "text") -> DataFrame:
    """Per row of `numbered` ones: row_no, doc_id, print (the fingerprint's bits as a long)."""
    settings(rows.sparkSession)
    taken = rows.select("row_no", "whole_row.doc_id", F.col("whole_row")[text].alias("whole_text"))
    kind = dict(taken.dtypes)["doc_id"]
    return taken.mapInArrow(_hash_texts, f"row_no long, doc_id {kind}, print long")


def _forest(prints: np.ndarray, near: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links in `near` (a boolean matrix): at most one edge per member, not all pairs."""
    left = np.ones(len(prints), bool)
    edges = []
    for start in range(len(prints)):
        if not left[start]:
            continue
        left[start] = False
        todo = [start]
        while todo:
            at = todo.pop()
            found = np.flatnonzero(near[at] & left)
            left[found] = False
            edges += [(int(prints[at]), int(prints[f])) for f in found]
            todo += found.tolist()
    return edges


def _links(variant: int, prints: np.ndarray, max_distance: int) -> list[tuple[int, int]]:
    """Edges that connect what the links of one signature connect.

    Under variant 0 of a half all pairs count; under the others only those that differ in the wildcard bit, as pairs
    that do not differ there meet under variant 0 (or another one) too.
    """
    values = prints.view(np.uint64)
    bits = (values >> np.uint64(variant)) & np.uint64(1)
    if variant % HALF_BITS and bits.min() == bits.max():
        return []
    if len(values) == 2:
        close = int(values[0] ^ values[1]).bit_count() <= max_distance
        return [(int(prints[0]), int(prints[1]))] if close else []
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= max_distance
    if variant % HALF_BITS:
        near &= bits[:, None] != bits[None, :]
    return _forest(prints, near)


def _meet(max_distance: int, tile: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over rows sorted by signature: edges within each signature, or its members again if there are more than a tile.

    A signature's members are read as a stream and never held beyond one tile.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held, spilling = None, [], False

        def out(rows: list[tuple[int | None, int, int]]) -> pa.RecordBatch:
            keys, a, b = zip(*rows, strict=True)
            kinds = (pa.int64(),) * 3
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip((keys, a, b), kinds, strict=True)], ["crowded", "a", "b"]
            )

        def close() -> list[tuple[int | None, int, int]]:
            if spilling or sum(map(len, held)) < 2:
                return []
            return [(None, *e) for e in _links(held_key >> HALF_BITS, np.concatenate(held), max_distance)]

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy()
            prints = batch.column(1).to_numpy()
            cuts = np.flatnonzero(np.diff(keys)) + 1
            starts, ends = np.r_[0, cuts], np.r_[cuts, len(keys)]
            rows: list[tuple[int | None, int, int]] = []
            # Signatures of one member need no work, unless they continue what is held or may go on in the next batch.
            work = np.flatnonzero((ends - starts > 1) | (starts == 0) | (ends == len(keys)))
            for i in work:
                s, e = starts[i], ends[i]
                if keys[s] != held_key:
                    rows += close()
                    held_key, held, spilling = int(keys[s]), [], False
                held.append(prints[s:e])
                if spilling or sum(map(len, held)) > tile:
                    spilling = True
                    for part in held:
                        rows += [(held_key, int(p), 0) for p in part]
                    held = []
            if rows:
                yield out(rows)
        if rest := close():
            yield out(rest)

    return run


def _tile_links(max_distance: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        variant = table.column("signature")[0].as_py() >> HALF_BITS if table.num_rows else 0
        edges = _links(variant, np.unique(table.column("print").to_numpy()), max_distance)
        return pa.table({"a": pa.array([a for a, _ in edges], pa.int64()), "b": pa.array([b for _, b in edges], pa.int64())})

    return run


def signatures(prints: DataFrame) -> DataFrame:
    """(signature, print) for every half and wildcard: 6 bits of half and position, 32 of the half without that bit."""
    value = F.expr(
        f"if(variant >= {HALF_BITS}, shiftrightunsigned(print, {HALF_BITS}), print & {(1 << HALF_BITS) - 1}L)"
    )
    masked = value.bitwiseAND(F.expr(f"~shiftleft(1L, cast(variant % {HALF_BITS} as int))"))
    key = (F.col("variant").cast("long") * F.lit(1 << HALF_BITS)).bitwiseOR(masked)
    variants = F.explode(F.sequence(F.lit(0), F.lit(2 * HALF_BITS - 1))).alias("variant")
    return prints.select("print", variants).select(key.alias("signature"), "print")


def near_edges(prints: DataFrame, max_distance: int = MAX_DISTANCE, tile: int = TILE) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints that links of at most `max_distance` bits connect.

    `prints` has distinct `print`s. The number of signatures is 64 per fingerprint; of a signature's members a
    spanning forest is returned, not all pairs. A signature of more than a tile of members is compared tile against
    tile, each pair of tiles being a task's work of its own.
    """
    if max_distance > 3:
        raise ValueError("two halves with one wildcard each find pairs of at most 3 differing bits")
    dealt = signatures(prints).repartition("signature").sortWithinPartitions("signature")
    met = write_stage(dealt.mapInArrow(_meet(max_distance, tile), "crowded long, a long, b long"), "met")
    edges = met.filter("crowded IS NULL").select("a", "b")
    crowded = met.filter("crowded IS NOT NULL").select(F.col("crowded").alias("signature"), F.col("a").alias("print"))
    bit = F.expr(f"shiftrightunsigned(print, cast(shiftright(signature, {HALF_BITS}) as int)) & 1L")
    sizes = crowded.groupBy("signature").agg(
        F.ceil(F.count("*") / F.lit(tile / 2)).cast("int").alias("tiles"), (F.min(bit) != F.max(bit)).alias("wild")
    )
    sizes = sizes.filter(F.col("wild") | (F.expr(f"shiftright(signature, {HALF_BITS}) % {HALF_BITS}") == 0))
    own = F.pmod(F.xxhash64("print"), F.col("tiles")).cast("int")
    tiles = crowded.join(sizes, "signature").withColumn("own", own)
    tiles = tiles.withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
    tiles = tiles.select(
        "signature", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"), "print"
    )
    pairs = tiles.groupBy("signature", "first", "second").applyInArrow(_tile_links(max_distance), "a long, b long")
    return edges.unionByName(pairs)


def near_duplicates(docs: DataFrame, max_distance: int = MAX_DISTANCE, text: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id.

    Null and empty texts and texts without words have the fingerprint 0 and are linked to each other. `component_id`
    is the smallest doc_id reachable over links of at most `max_distance` bits; null only if no member has an id.
    Copies share a fingerprint and are one node, however many there are. Other columns are not read; an empty table
    gives an empty result.
    """
    rows = docs.select(F.lit(0).cast("long").alias("row_no"), F.struct("doc_id", text).alias("whole_row"))
    return _classes(rows, max_distance, text, similar=False).select("doc_id", "fingerprint", "component_id")


def _classes(rows: DataFrame, max_distance: int, text: str, similar: bool) -> DataFrame:
    """Of `numbered` rows: row_no, doc_id, root, fingerprint, component_id. With `similar`, texts whose 5-word shingles
    have a similarity of 0.8 or more are linked too."""
    prints = write_stage(simhashes(rows, text), "simhash")
    nodes = write_stage(prints.groupBy("print").agg(F.min("doc_id").alias("least_id")), "prints")
    edges = near_edges(nodes.select("print"), max_distance)
    if similar:
        edges = write_stage(edges, "near-edges")
        of_row = prints.select(F.col("row_no").alias("node"), F.col("print").alias("known"))
        pairs = write_stage(similar_edges(rows, text, linked=_named(of_row, components(edges))).distinct(), "similar")
        for end in ("a", "b"):
            named = prints.select(F.col("row_no").alias(end), F.col("print").alias(f"{end}_print"))
            pairs = pairs.join(named, end)
        edges = edges.unionByName(pairs.select(F.col("a_print").alias("a"), F.col("b_print").alias("b")))
    roots = components(edges)
    named = nodes.join(roots.select(F.col("node").alias("print"), "root"), "print", "left")
    named = named.withColumn("root", F.coalesce("root", "print"))
    names = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = write_stage(named.join(names, "root").select("print", "root", "component_id"), "classes")
    return prints.join(classes, "print").select(
        "row_no", "doc_id", "root", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )


def _named(of_row: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, linked) per row: the root of its fingerprint."""
    joined = of_row.join(roots.select(F.col("node").alias("known"), "root"), "known", "left")
    return joined.select("node", F.coalesce("root", "known").alias("linked"))


def drop_near_copies(docs: DataFrame, max_distance: int = MAX_DISTANCE, text: str = "text") -> DataFrame:
    """`docs` with one document of each component: the one with the smallest doc_id (null ids last).

    Links are fingerprints of at most `max_distance` differing bits, and shingle similarities of 0.8 or more. Texts
    without words are linked to each other. Of repeated rows one stays. Columns may have any name and type. An empty
    table stays empty.
    """
    settings(docs.sparkSession)
    rows = numbered(docs)
    found = write_stage(_classes(rows, max_distance, text, similar=True), "near")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row_no")).alias("first")
    best = write_stage(found.groupBy("root").agg(first).select(F.col("first.row_no").alias("stays_no")), "best")
    kept = found.join(best, F.col("row_no") == F.col("stays_no"), "left")
    return drop_rows(rows, kept.select("row_no", F.col("stays_no").isNotNull().alias("kept")))
