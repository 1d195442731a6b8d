"""Texts whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more, found by an exact prefix-filtered join.

Two such sets share at least four fifths of the larger one. So, whatever order all shingles are put in, the first m - ceil(0.8 m) + 1
of m shingles (the prefix) have one in common with the other set's prefix: texts are dealt out by the shingles of their
prefixes and compared where they meet. The order puts shingles that are common in a sample of the texts last, which
keeps the groups small; it decides how much is compared, never what is found. What meets is compared on the whole sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from sparge.llm.common import forget, settings, write_stage
from sparge.llm.components import components

SEED = 42
SHINGLE_WORDS = 5
# Members of one shingle whose pairs are candidates at once; larger groups are compared tile by tile.
SMALL = 32
TILE = 1024
TILE_BYTES = 4 << 20
# Texts that tell which shingles are common, how many of them a shingle has to be in, and how many shingles are ordered so.
SAMPLE_ROWS = 10_000
COMMON_ROWS = 8
COMMON_SHINGLES = 50_000
PARITY_BITS = 1024


def shingle_hashes(text: str | None, words: int) -> list[int]:
    """A 64-bit hash per run of `words` words, in order; fewer words are one run, none are none."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return []
    digest = xxhash.xxh64_intdigest
    if len(tokens) < words:
        return [digest(b" ".join(tokens), SEED)]
    line = b" ".join(tokens)
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
    ends = np.cumsum(sizes) - 1
    starts = (ends - sizes + 1)[: len(tokens) - words + 1].tolist()
    return [digest(line[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist(), strict=True)]


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct 5-word shingles' hashes, in order."""
    return np.unique(np.array(shingle_hashes(text, SHINGLE_WORDS), np.uint64))


def _similar(overlap, sizes):
    """Whether `overlap` common members make 0.8 of the union of two sets that have `sizes` members together."""
    return 9 * overlap >= 4 * sizes


def _signature(hashes: np.ndarray) -> np.ndarray:
    """Parity of a set in about four bins per member: a sixteenth of the set's own size."""
    return _parity(hashes, max(64, 1 << (4 * len(hashes) - 1).bit_length()))


def _differing(a: np.ndarray, b: np.ndarray) -> int:
    """In how many bins two signatures differ; the larger one is folded first, neighbouring bins into one."""
    length = min(len(a), len(b))
    return int(np.bitwise_count(_folded(a, length) ^ _folded(b, length)).sum())


def _folded(signature: np.ndarray, length: int) -> np.ndarray:
    """A signature of `length` words, which a smaller set would have."""
    while len(signature) > length:
        bits = np.unpackbits(signature.view(np.uint8)).reshape(-1, 2)
        signature = np.packbits(bits[:, 0] ^ bits[:, 1]).view(np.uint64)
    return signature


def _parity(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Per bin whether an odd number of hashes is in it. Sets differ in at least as many members as these bits differ."""
    shift = np.uint64(64 - (bits.bit_length() - 1))
    odd = np.bincount((hashes >> shift).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def _prefix(hashes: np.ndarray, common: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The members of a set that one of an equal or similar set's prefix has to be among."""
    if len(common):
        at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
        known = common[at] == hashes
        hashes = np.concatenate([hashes[~known], hashes[known][np.argsort(ranks[at[known]])]])
    return hashes[: len(hashes) - -(-4 * len(hashes) // 5) + 1]


def _all_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingle_set(t) for t in batch.column("whole_text").to_pylist()]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["shingle"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingle_set(t).view(np.int64) for t in batch.column("whole_text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.list_(pa.int64()))], ["node", "hashes"])


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(t) for t in batch.column("whole_text").to_pylist()]
        columns = [pa.array([len(s) for s in sets], pa.int32()), pa.array([_signature(s).tobytes() for s in sets], pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column("node"), *columns], ["node", "size", "signature"])


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that their signatures do not rule out: sets differ in at least as many members as the bins do."""
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("a_size", "b_size", "a_signature", "b_signature")]
        keep = [
            9 * _differing(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) <= m + n
            for m, n, x, y in zip(*columns, strict=True)
        ]
        yield batch.select(["a", "b", "a_linked", "b_linked"]).filter(pa.array(keep, pa.bool_()))


def _prefixes(common: np.ndarray, ranks: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t) for t in batch.column("whole_text").to_pylist()]
            if not sets:
                continue
            found = [_prefix(s, common, ranks) if len(s) else s for s in sets]
            counts = [len(f) for f in found]
            nodes = np.repeat(batch.column("node").to_numpy(), counts)
            sizes = np.repeat(np.array([len(s) for s in sets], np.int32), counts)
            parity = np.repeat(np.concatenate([_parity(s, 64) for s in sets]).view(np.int64), counts)
            shingles = np.concatenate(found).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (shingles, nodes, sizes, parity)], ["shingle", "node", "size", "parity"]
            )

    return run


def _candidates(nodes: np.ndarray, sizes: np.ndarray, parity: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of a small group that their sizes and parities do not rule out."""
    both = sizes[:, None].astype(np.int64) + sizes[None, :]
    lesser = np.minimum(sizes[:, None], sizes[None, :])
    differ = np.bitwise_count(parity[:, None] ^ parity[None, :]).astype(np.int64)
    a, b = np.nonzero(_similar(lesser, both) & (9 * differ <= both) & (nodes[:, None] < nodes[None, :]))
    return list(zip(nodes[a].tolist(), nodes[b].tolist(), strict=True))


def _meet(small: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over rows sorted by shingle: candidate pairs (null, a, b), or the members of a larger group (shingle, node, size)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held, spilling = None, [], False

        def out(rows: list[tuple[int | None, int, int]]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["crowded", "a", "b"])

        def close() -> list[tuple[int | None, int, int]]:
            if spilling or sum(len(h[0]) for h in held) < 2:
                return []
            nodes, sizes, parity = (np.concatenate(c) for c in zip(*held, strict=True))
            return [(None, *e) for e in _candidates(nodes, sizes, parity.view(np.uint64))]

        for batch in batches:
            if not batch.num_rows:
                continue
            keys, *columns = (batch.column(i).to_numpy() for i in range(4))
            cuts = np.flatnonzero(np.diff(keys)) + 1
            starts, ends = np.r_[0, cuts], np.r_[cuts, len(keys)]
            rows: list[tuple[int | None, int, int]] = []
            for i in np.flatnonzero((ends - starts > 1) | (starts == 0) | (ends == len(keys))):
                s, e = starts[i], ends[i]
                if keys[s] != held_key:
                    rows += close()
                    held_key, held, spilling = int(keys[s]), [], False
                held.append([c[s:e] for c in columns])
                if spilling or sum(len(h[0]) for h in held) > small:
                    spilling = True
                    for nodes, sizes, _ in held:
                        rows += [(held_key, n, z) for n, z in zip(nodes.tolist(), sizes.tolist(), strict=True)]
                    held = []
            if rows:
                yield out(rows)
        if rest := close():
            yield out(rest)

    return run


def forest(nodes: list[int], sets: list[np.ndarray], linked: list[int] | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of similar sets: at most one edge per member, each compared on the whole sets.

    Members with the same value of `linked` are connected already: they are gone through together.
    """
    parts: dict[int, list[int]] = {}
    for i, part in enumerate(linked or range(len(nodes))):
        parts.setdefault(part, []).append(i)
    part_of = {i: members for members in parts.values() for i in members}
    sizes = np.array([len(s) for s in sets], np.int64)
    parity = np.array([_parity(s, PARITY_BITS) for s in sets])
    left = np.ones(len(sets), bool)
    edges = []
    for start in range(len(sets)):
        if not left[start]:
            continue
        todo = list(part_of[start])
        left[todo] = False
        while todo:
            at = todo.pop()
            rest = np.flatnonzero(left)
            both = sizes[at] + sizes[rest]
            rest = rest[_similar(np.minimum(sizes[at], sizes[rest]), both)]
            differ = np.bitwise_count(parity[rest] ^ parity[at]).sum(axis=1, dtype=np.int64)
            for other in rest[9 * differ <= sizes[at] + sizes[rest]].tolist():
                if not left[other]:
                    continue
                common = len(np.intersect1d(sets[at], sets[other], assume_unique=True))
                if _similar(common, sizes[at] + sizes[other]):
                    left[part_of[other]] = False
                    edges.append((nodes[at], nodes[other]))
                    todo += part_of[other]
    return edges


def _tile_links(table: pa.Table) -> pa.Table:
    sets = [np.array(h, np.int64).view(np.uint64) for h in table.column("hashes").to_pylist()]
    edges = forest(table.column("node").to_pylist(), sets, table.column("linked").to_pylist())
    return pa.table({"a": pa.array([a for a, _ in edges], pa.int64()), "b": pa.array([b for _, b in edges], pa.int64())})


def possible_forest(nodes: np.ndarray, sizes: np.ndarray, linked: np.ndarray, signatures: list[np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that sizes and signatures do not rule out and that are not linked yet."""
    order = np.argsort(sizes, kind="stable")
    nodes, sizes, linked, signatures = nodes[order], sizes[order], linked[order], [signatures[i] for i in order.tolist()]
    # By size a member's partners follow it up to 5/4 of its size; their signatures are as long, or folded once.
    upto = np.searchsorted(4 * sizes, 5 * sizes, side="right").tolist()
    lengths = np.array([len(x) for x in signatures])
    tree = np.arange(len(nodes))
    edges = []
    for length in np.unique(lengths).tolist():
        near = np.flatnonzero((lengths == length) | (lengths == 2 * length))
        bits = np.stack([_folded(signatures[i], length) for i in near.tolist()])
        for at in np.flatnonzero(lengths == length).tolist():
            rest = slice(*np.searchsorted(near, (at + 1, upto[at])))
            others = near[rest]
            apart = (linked[others] != linked[at]) & (tree[others] != tree[at])
            others = others[apart]
            differ = np.bitwise_count(bits[rest][apart] ^ signatures[at]).sum(axis=1, dtype=np.int64)
            for other in others[9 * differ <= sizes[at] + sizes[others]].tolist():
                if tree[other] != tree[at]:
                    tree[tree == tree[other]] = tree[at]
                    edges.append((int(nodes[at]), int(nodes[other])))
    return edges


def _tile_possible(table: pa.Table) -> pa.Table:
    signatures = [np.frombuffer(x, np.uint64) for x in table.column("signature").to_pylist()]
    edges = possible_forest(*[table.column(c).to_numpy() for c in ("node", "size", "linked")], signatures)
    return pa.table({"a": pa.array([a for a, _ in edges], pa.int64()), "b": pa.array([b for _, b in edges], pa.int64())})


def _common(rows: DataFrame, sample_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, in order, of shingles that many sampled texts have, and their ranks by frequency."""
    every = max(1, rows.count() // sample_rows)
    sample = rows.filter(F.pmod(F.xxhash64("node"), F.lit(every)) == 0)
    counts = sample.mapInArrow(_all_shingles, "shingle long").groupBy("shingle").count()
    most = counts.filter(F.col("count") >= COMMON_ROWS).orderBy(F.desc("count"), "shingle").limit(COMMON_SHINGLES).collect()
    hashes = np.array([r["shingle"] for r in most], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], (len(most) - np.arange(len(most)))[order]


def _likely(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """The pairs (a, b) that signatures leave; whole texts are sent for these alone."""
    for end in "ab":
        named = signatures.select(F.col("node").alias(end), F.col("size").alias(f"{end}_size"), F.col("signature").alias(f"{end}_signature"))
        pairs = pairs.join(named, end)
    return pairs.mapInArrow(_possible, "a long, b long, a_linked long, b_linked long")


def _dealt(likely: DataFrame, sizes: DataFrame, tile: int) -> tuple[DataFrame, DataFrame]:
    """The pairs (a, b) by group, and the nodes that each group's texts belong to: (root, first, second) is a group.

    Pairs that hang together share a root, so that a text is sent once for all of its pairs. A root with more texts than
    a tile holds is cut into tiles; a group has the pairs between two of them, and only the texts of these pairs.
    """
    groups = components(likely.select("a", "b"))
    tiles = groups.join(sizes, "node").groupBy("root").agg(_tiles(tile))
    own = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int").alias("own")
    placed = write_stage(groups.join(tiles, "root").select("node", "root", own), "placed")
    pairs = likely.join(placed.select(F.col("node").alias("a"), "root", F.col("own").alias("a_own")), "a")
    pairs = pairs.join(placed.select(F.col("node").alias("b"), F.col("own").alias("b_own")), "b")
    first, second = F.least("a_own", "b_own").alias("first"), F.greatest("a_own", "b_own").alias("second")
    pairs = write_stage(pairs.select("root", first, second, "a", "b", "a_linked", "b_linked"), "placed-pairs")
    ends = [pairs.select("root", "first", "second", F.col(end).alias("node")) for end in "ab"]
    return pairs, write_stage(ends[0].unionByName(ends[1]).distinct(), "sends")


def _tiles(tile: int, each: int = 8) -> Column:
    """How many tiles texts are cut into, by their number and the bytes (`each` for a member) of their sets or signatures."""
    wanted = F.greatest(F.count("*") / F.lit(tile / 2), F.sum("size") * each / F.lit(TILE_BYTES / 2))
    return F.ceil(wanted).cast("int").alias("tiles")


def _tiled(groups: DataFrame, group: str, tile: int, each: int) -> DataFrame:
    """Members of groups (`group`, node, size) for each pair of tiles: `group`, first, second, node, size."""
    own = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    tiled = groups.join(groups.groupBy(group).agg(_tiles(tile, each)), group).withColumn("own", own)
    tiled = tiled.withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
    return tiled.select(group, F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"), "node", "size")


def _compared(likely: DataFrame, texts: DataFrame, sizes: DataFrame, tile: int) -> DataFrame:
    """A spanning forest per group of the pairs (a, b) whose whole sets are similar."""
    pairs, sends = _dealt(likely, sizes, tile)
    keys = ["root", "first", "second"]
    sent = texts.join(sends.hint("shuffle_hash"), "node").select(*keys, F.col("node").alias("a"), "whole_text")
    rows = pairs.unionByName(sent, allowMissingColumns=True)
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "b", "a")  # the texts of a group (b is null), then its pairs
    return rows.mapInArrow(_group_edges, "a long, b long")


def _group_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over groups of texts and pairs: edges of similar sets. Pairs that others have connected by then are skipped."""
    key, sets, root = None, {}, {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    for batch in batches:
        names = ("root", "first", "second", "a", "b", "a_linked", "b_linked", "whole_text")
        edges = []
        for *now, a, b, a_linked, b_linked, text in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            if now != key:
                key, sets, root = now, {}, {}
            if b is None:
                sets[a] = shingle_set(text)
                continue
            x, y = find(a_linked), find(b_linked)
            if x != y and _similar(len(np.intersect1d(sets[a], sets[b], assume_unique=True)), len(sets[a]) + len(sets[b])):
                root[x] = y
                edges.append((a, b))
        columns = [pa.array([e[i] for e in edges], pa.int64()) for i in range(2)]
        yield pa.RecordBatch.from_arrays(columns, ["a", "b"])


def _apart(pairs: DataFrame, linked: DataFrame) -> DataFrame:
    """The pairs whose ends are not linked yet."""
    for end in "ab":
        pairs = pairs.join(linked.select(F.col("node").alias(end), F.col("linked").alias(f"{end}_linked")), end)
    return pairs.filter("a_linked <> b_linked").select("a", "b", "a_linked", "b_linked")


def _merged(linked: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, linked) after further edges between nodes."""
    between = edges
    for end in "ab":
        named = linked.select(F.col("node").alias(end), F.col("linked").alias(f"{end}_linked"))
        between = between.join(named, end)
    roots = components(between.select(F.col("a_linked").alias("a"), F.col("b_linked").alias("b")))
    roots = roots.select(F.col("node").alias("linked"), "root")
    return linked.join(roots, "linked", "left").select("node", F.coalesce("root", "linked").alias("linked"))


def similar_edges(
    rows: DataFrame, text: str = "text", small: int = SMALL, tile: int = TILE, sample_rows: int = SAMPLE_ROWS,
    linked: DataFrame | None = None,
) -> DataFrame:
    """Edges (a, b) of row numbers that, with the given links, connect all rows that pairs of similarity >= 0.8 connect.

    `rows` are `numbered` ones; `linked` (node, linked) gives rows that are connected already the same value. Texts
    without words have no edges. Shingles are compared by 64-bit hashes.

    Texts that meet under a shingle are compared in pairs: all possible ones of groups of up to `small` texts, and those
    with the text of smallest number in larger groups, which connects most groups of copies as a star. A text is sent
    once for all pairs that hang together. Larger groups that are still of several parts follow, tile against tile, each
    pair of tiles being a task's work of its own that returns a spanning forest: first of what signatures leave, then,
    for what hangs together by that, of what is similar by whole sets.
    """
    settings(rows.sparkSession)
    texts = rows.select(F.col("row_no").alias("node"), F.col("whole_row")[text].alias("whole_text"))
    found = texts.mapInArrow(_prefixes(*_common(texts, sample_rows)), "shingle long, node long, size int, parity long")
    dealt = found.repartition("shingle").sortWithinPartitions("shingle")
    met = write_stage(dealt.mapInArrow(_meet(small), "crowded long, a long, b long"), "shingles-met")
    pairs = write_stage(met.filter("crowded IS NULL").select("a", "b").distinct(), "shingle-pairs")
    crowded = met.filter("crowded IS NOT NULL").select(
        F.col("crowded").alias("shingle"), F.col("a").alias("node"), F.col("b").alias("size")
    ).distinct()
    crowded = write_stage(crowded, "shingle-groups")
    forget(met)
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(crowded.select("node")).distinct()
    wanted = write_stage(wanted, "shingle-nodes")
    signatures = texts.join(wanted.hint("shuffle_hash"), "node", "left_semi").mapInArrow(_signatures, "node long, size int, signature binary")
    signatures = write_stage(signatures, "signatures")
    if linked is None:
        linked = wanted.select("node", F.col("node").alias("linked"))
    linked = write_stage(linked.join(wanted, "node", "left_semi"), "linked")

    # With the pairs of small groups a star around the smallest of each large one; signatures rule out most before texts are sent.
    centres = write_stage(crowded.groupBy("shingle").agg(F.min("node").alias("a")), "shingle-centres")
    stars = crowded.join(centres, "shingle").filter("a < node").select("a", F.col("node").alias("b"))
    likely = write_stage(_likely(_apart(stars.unionByName(pairs).distinct(), linked), signatures), "likely")
    sizes = write_stage(signatures.select("node", "size"), "sizes")
    edges = write_stage(_compared(likely, texts, sizes, tile), "compared")
    linked = write_stage(_merged(linked, edges), "linked")

    # Larger groups of which everything is connected by now need no further look.
    parted = crowded.join(linked, "node")
    several = parted.groupBy("shingle").agg(F.min("linked").alias("low"), F.max("linked").alias("high"))
    several = write_stage(several.filter("low < high").select("shingle"), "shingle-parted")
    left = write_stage(crowded.join(several, "shingle", "left_semi"), "shingle-left")
    # Signatures go to all tiles. What they leave hangs together by few pairs, whatever the number of shingles it meets
    # under: a set is sent to the tiles of its root alone.
    signed = _tiled(left, "shingle", tile, 1).join(linked, "node").join(signatures.select("node", "signature"), "node")
    possible = signed.groupBy("shingle", "first", "second").applyInArrow(_tile_possible, "a long, b long")
    roots = components(write_stage(possible.distinct(), "shingle-possible"))
    roots = write_stage(roots.join(sizes, "node").select("root", "node", F.col("size").cast("long").alias("size")), "shingle-roots")
    forget(signatures)
    sets = texts.join(roots.select("node").hint("shuffle_hash"), "node", "left_semi").mapInArrow(_sets, "node long, hashes array<long>")
    met_again = _tiled(roots, "root", tile, 8).join(linked, "node").join(write_stage(sets, "shingle-sets"), "node")
    tile_edges = met_again.groupBy("root", "first", "second").applyInArrow(_tile_links, "a long, b long")
    return edges.unionByName(tile_edges)
