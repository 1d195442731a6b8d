"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows of equal text form a group that goes to one shard. Packing every group in one sequence would need one task for the
whole corpus, so it is done in two layers of the same method. Groups are dealt out by hash, and every task packs its own
into containers of a small fixed capacity: sorted by size, each group enters the container with the tightest remaining
capacity that holds it, found in a balanced tree. The containers, whose number depends on capacities and partitions and
not on the number of rows, are then packed into the shards in the same way, at the smallest capacity at which they fit.
A group larger than a container is one of its own. Only a group larger than the mean shard is cut into parts of its
rows, else no set of shards could have near equal sizes.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sparge.llm.common import running_offsets, settings, shuffle_partitions, write_stage

SHARDS = 24
ROW_BYTES = 8
# Containers that a shard's capacity is worth: shards differ by a fraction of a container.
CONTAINERS_PER_SHARD = 128
# Steps of the search for the smallest capacity.
STEPS = 24


class Bins:
    """Remaining capacities in a balanced tree (a treap): insert, and take out the smallest that is large enough."""

    def __init__(self):
        self.root, self.dice = None, random.Random(0)

    def _split(self, node, key):
        """Parts of a tree below `key`, and from it on."""
        if node is None:
            return None, None
        if node[0] < key:
            left, right = self._split(node[3], key)
            node[3] = left
            return node, right
        left, right = self._split(node[2], key)
        node[2] = right
        return left, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b

    def insert(self, remaining: int, bin_no: int) -> None:
        left, right = self._split(self.root, (remaining, bin_no))
        node = [(remaining, bin_no), self.dice.random(), None, None]
        self.root = self._merge(self._merge(left, node), right)

    def take(self, size: int) -> tuple[int, int] | None:
        """The tightest bin (remaining, number) that holds `size`, removed; None if there is none."""
        left, right = self._split(self.root, (size, -1))
        if right is None:
            self.root = left
            return None
        node = right
        while node[2] is not None:
            node = node[2]
        found = node[0]
        _, rest = self._split(right, (found[0], found[1] + 1))
        self.root = self._merge(left, rest)
        return found


def best_fit(sizes: Iterable[int], capacity: int, bins: int | None = None) -> list[int] | None:
    """Bin of each size, largest first already. A size beyond the capacity gets a bin of its own.

    With `bins`, None if that many do not do.
    """
    tree, out, used = Bins(), [], 0
    if bins:
        for used in range(bins):
            tree.insert(capacity, used)
        used = bins
    for size in sizes:
        found = tree.take(size)
        if found is None:
            if bins:
                return None
            found = (max(capacity, size), used)
            used += 1
        tree.insert(found[0] - size, found[1])
        out.append(found[1])
    return out


def pack_containers(sizes: list[int], shards: int) -> list[int]:
    """Shard of each container: best fit at the smallest capacity, within a search, at which `shards` bins do."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    falling = [sizes[i] for i in order]
    low = max([-(-sum(sizes) // shards), *falling[:1], 1])
    high = 2 * low  # above twice the mean and the largest size, something always holds a size
    best = best_fit(falling, high, shards)
    for _ in range(STEPS):
        if low >= high:
            break
        middle = (low + high) // 2
        found = best_fit(falling, middle, shards)
        if found is None:
            low = middle + 1
        else:
            best, high = found, middle
    out = [0] * len(sizes)
    for i, b in zip(order, best, strict=True):
        out[i] = b
    return out


def _fill(capacity: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over a partition's units, largest first: each with its container."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tree, used = TaskContext.get().partitionId(), Bins(), 0
        for batch in batches:
            containers = []
            for size in batch.column("unit_bytes").to_pylist():
                remaining, at = tree.take(size) or (max(capacity, size), used)
                used += at == used
                tree.insert(remaining - size, at)
                containers.append((part << 32) | at)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(containers, pa.int64())], [*batch.schema.names, "container"])

    return run


def shard(docs: DataFrame, shards: int = SHARDS, text: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot.

    Size is the text's bytes in UTF-8 plus ROW_BYTES; null texts have none and form a group with empty ones. Shards have
    near equal bytes; `slot` numbers a shard's rows without gaps, equal texts side by side. Repeated rows are rows like
    others, null ids come first within their group. Other columns are not read; an empty table gives an empty result.
    """
    settings(docs.sparkSession)
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(content) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(content, 256)).alias("group_key"),
    ).withColumn("row_no", F.monotonically_increasing_id())
    rows = write_stage(rows, "rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    capacity = max(1, total // (shards * CONTAINERS_PER_SHARD))
    groups = rows.groupBy("group_key").agg(F.sum("size").alias("bytes"), F.count("*").alias("n_rows"))
    # Only groups of more bytes than a shard should have are cut, into parts of about a quarter of that.
    mean = max(1, -(-total // shards))
    parts = F.when(F.col("bytes") > mean, F.least("n_rows", F.ceil(F.col("bytes") * 4 / mean))).otherwise(1)
    large = groups.withColumn("parts", parts.cast("int")).filter("parts > 1").select("group_key", "parts")
    large = write_stage(large, "large-groups")
    part = F.pmod(F.xxhash64("row_no"), F.coalesce("parts", F.lit(1))).cast("int")
    # Fewer than `shards` groups can be larger than the mean shard, so this side is always small.
    parted = rows.join(F.broadcast(large), "group_key", "left").withColumn("part", part).drop("parts")
    parted = write_stage(parted, "parted")
    units = parted.groupBy("group_key", "part").agg(F.sum("size").alias("unit_bytes"))
    dealt = units.repartition(shuffle_partitions(docs.sparkSession), "group_key", "part")
    dealt = dealt.sortWithinPartitions(F.col("unit_bytes").desc(), "group_key", "part")
    placed = write_stage(
        dealt.mapInArrow(_fill(capacity), "group_key binary, part int, unit_bytes long, container long"), "containers"
    )
    # At most a few containers per unit of capacity and partition, whatever the number of rows.
    containers = placed.groupBy("container").agg(F.sum("unit_bytes").alias("bytes")).orderBy("container").collect()
    found = pack_containers([r["bytes"] for r in containers], shards)
    table = docs.sparkSession.createDataFrame(
        [(r["container"], s) for r, s in zip(containers, found, strict=True)], "container long, shard int"
    )
    # One row per container, so bounded like the list above.
    unit_shards = write_stage(placed.join(F.broadcast(table), "container").select("group_key", "part", "shard"), "unit-shards")
    in_shard = write_stage(
        parted.join(unit_shards, ["group_key", "part"]).select(
            "doc_id", "size", "text_crc32", "shard", "group_key", "row_no", F.lit(1).cast("long").alias("one")
        ),
        "in-shard",
    )
    slots = running_offsets(in_shard, ["group_key", "row_no"], "one", group="shard")
    return slots.select("doc_id", "size", "text_crc32", "shard", F.col("offset").alias("slot"))
