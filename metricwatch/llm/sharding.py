"""Sharding by best-fit-decreasing bin packing of indivisible groups (equal texts).

Groups are summed in Spark from narrow rows (a hash of the text, its size; no texts are shuffled).
Packing needs only how many groups have a size: groups of one size are interchangeable. Sizes are
counted in classes: every size up to ``EXACT`` is one, larger ones share a class with sizes that
differ by less than a 1024th, so their number has a bound (some ten thousand) whatever the input,
and every group is packed, at any scale, by one and the same way. Classes go by falling size, and each
group into the tightest bin that still has room, found in a balanced tree over remaining
capacities; a bin that has taken one is the tightest still, so it takes as many as fit in one step.
The steps ("these ranks of this class go into this bin") are a bounded table; a group finds its
shard from its rank in its class, counted in two phases.

The capacity is bisected to the least one that needs no more than the wanted number of shards, so
sizes come out near equal. Groups above an equal share get a shard each before that. With a fixed
``capacity`` the same packing opens as many shards as it needs.

Defined results: a null text is sized and grouped like an empty one; rows are placed row by row,
repeated rows included; ties between equal groups go by hash; an empty table has no shards; with
a fixed capacity a larger group has a shard to itself.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metricwatch.llm.common import checkpoint, text_of

#: Sizes up to this one are classes of their own; above, a class has sizes with the same leading PRECISION bits.
EXACT, PRECISION = 4096, 10
#: Groups of a shard's share divided by this, or more, find their shard by a broadcast; there are at most shards times it.
LARGE_PART = 512


class CapacityTreap:
    """Balanced tree (a treap) of bins by (remaining capacity, bin)."""

    def __init__(self) -> None:
        self.root, self.draw = None, Random(7).random

    def _split(self, node, key):
        if node is None:
            return None, None
        if node[0] < key:
            node[2], right = self._split(node[2], key)
            return node, right
        left, node[1] = self._split(node[1], key)
        return left, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[3] > b[3]:
            a[2] = self._merge(a[2], b)
            return a
        b[1] = self._merge(a, b[1])
        return b

    def add(self, remaining: int, bin_: int) -> None:
        key = (remaining, bin_)
        left, right = self._split(self.root, key)
        self.root = self._merge(self._merge(left, [key, None, None, self.draw()]), right)

    def take_tightest(self, need: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least remaining capacity of at least ``need``."""
        left, right = self._split(self.root, (need, -1))
        if right is None:
            self.root = left
            return None
        path, node = None, right
        while node[1] is not None:
            path, node = node, node[1]
        if path is None:
            right = node[2]
        else:
            path[1] = node[2]
        self.root = self._merge(left, right)
        return node[0]

def size_class(size: Column) -> Column:
    """The least size of a size's class."""
    drop = F.greatest(F.length(F.bin(size)) - (PRECISION + 1), F.lit(0))
    return F.when(size <= EXACT, size).otherwise(F.call_function("shiftleft", F.call_function("shiftright", size, drop), drop))


def best_fit_steps(classes: list[list[int]], capacity: int, most: int | None = None) -> list[tuple] | None:
    """Best-fit decreasing over (class, size, number of groups), sizes falling: rows (class, first rank, bin).

    None if more than ``most`` bins were needed or a group is above the capacity.
    """
    tree, bins, steps = CapacityTreap(), 0, []
    for name, size, left in classes:
        if size > capacity:
            return None
        rank = 0
        while left:
            found = tree.take_tightest(size)
            if found is None:
                if bins == most:
                    return None
                found, bins = (capacity, bins), bins + 1
            took = min(left, found[0] // size)
            steps.append((name, rank, found[1]))
            tree.add(found[0] - took * size, found[1])
            rank, left = rank + took, left - took
    return steps


def plan(classes: list[tuple[int, int, int, int]], shards: int | None, capacity: int | None = None) -> list[tuple]:
    """Steps (class, first rank, shard) for (class, groups, total size, largest size): near-equal shards, or shards of a capacity."""
    classes, steps, used = sorted(classes, reverse=True), [], 0
    if capacity is not None:
        items = [[name, high, n] for name, n, _, high in classes]
        while items and items[0][1] > capacity:  # one shard each
            name, _, n = items.pop(0)
            steps += [(name, rank, used + rank) for rank in range(n)]
            used += n
        return steps + [(name, rank, used + k) for name, rank, k in best_fit_steps(items, capacity)]
    items = [[name, -(-total // n), n] for name, n, total, _ in classes]  # a group counts as its class's mean
    left, alone = sum(size * n for _, size, n in items), Counter()
    while items and used < shards - 1 and items[0][1] * (shards - used) > left:  # above an equal share of what is left
        name, size, _ = items[0]
        steps.append((name, alone[name], used))
        alone[name] += 1
        used, left = used + 1, left - size
        items[0][2] -= 1
        if not items[0][2]:
            items.pop(0)
    if not items:
        return steps
    low = high = max(items[0][1], -(-left // (shards - used)))
    while (best := best_fit_steps(items, high, shards - used)) is None:
        low, high = high + 1, high + max(1, high // 1024)
    while low < high:
        middle = (low + high) // 2
        found = best_fit_steps(items, middle, shards - used)
        if found is None:
            low = middle + 1
        else:
            high, best = middle, found
    return steps + [(name, alone[name] + rank, used + k) for name, rank, k in best]


def group_key(text: Column) -> Column:
    """Equal for equal texts. Different texts with one key would merely share a shard."""
    return F.concat(F.lpad(F.hex(F.xxhash64(text)), 16, "0"), F.lpad(F.hex(F.crc32(text)), 8, "0"))


def place_groups(groups: DataFrame, shards: int | None, capacity: int | None = None, rows_per_block: int = 1_000_000) -> DataFrame:
    """groups (grp, size) -> (grp, size, shard); ``groups`` should be a checkpointed table, as it is read several times."""
    classed = groups.withColumn("class", size_class(F.col("size")))
    # bounded by the number of classes
    classes = [tuple(r) for r in classed.groupBy("class").agg(F.count("*"), F.sum("size"), F.max("size")).collect()]
    steps = np.array(plan(classes, shards, capacity), np.int64).reshape(-1, 3)
    names = np.unique(steps[:, 0])
    keys = np.searchsorted(names, steps[:, 0]) << 44 | steps[:, 1]
    order = np.argsort(keys)
    shared = groups.sparkSession.sparkContext.broadcast((names, keys[order], steps[order, 2].astype(np.int32)))  # at most a step per class and shard
    blocks = max(64, -(-sum(c[1] for c in classes) // rows_per_block))
    rows = classed.withColumn("block", F.pmod(F.xxhash64("grp"), F.lit(blocks)))
    counts = rows.groupBy("class", "block").agg(F.count("*").alias("n"))
    before = counts.select("class", "block", (F.sum("n").over(
        W.partitionBy("class").orderBy("block").rowsBetween(W.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    ranked = (rows.withColumn("at", F.row_number().over(W.partitionBy("class", "block").orderBy("grp"))).join(before, ["class", "block"])
              .select("grp", "size", "class", (F.col("before") + F.col("at") - 1).alias("rank")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, keys, shard = shared.value
        for batch in batches:
            name, rank = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))
            at = np.searchsorted(keys, np.searchsorted(names, name) << 44 | rank, side="right") - 1
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(shard[at])], ["grp", "size", "shard"])

    return ranked.mapInArrow(place, "grp string, size bigint, shard int")


def shard_rows(docs: DataFrame, shards: int | None = 40, extra_bytes: int = 16, id_col: str = "doc_id", text_col: str = "text",
               rows_per_block: int = 1_000_000, capacity: int | None = None) -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, shard, slot (from 0 without gaps in each shard).

    ``shards`` near-equal shards or, if ``capacity`` is given, as many as best-fit decreasing needs of that size.
    """
    text = text_of(text_col)
    rows = checkpoint(docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + F.lit(extra_bytes)).cast("bigint").alias("size"),
                                  F.crc32(text).alias("text_crc32"), group_key(text).alias("grp")))
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).head()
    placed = checkpoint(place_groups(checkpoint(rows.groupBy("grp").agg(F.sum("size").alias("size"))), shards, capacity, rows_per_block))
    parts = shards or max(1, total // capacity)
    large = F.col("size") * (parts * LARGE_PART) >= total
    # at most parts * LARGE_PART large groups, which are the ones with many or long rows
    own = F.broadcast(placed.where(large).select("grp", "shard"))
    few = placed.where(~large).select("grp", "shard")
    at = rows.join(own, "grp").unionByName(rows.join(own, "grp", "left_anti").join(few, "grp")).drop("grp")
    return with_slots(at, "shard", ["id", "text_crc32", "size"], max(64, -(-n // (parts * rows_per_block))))


def with_slots(rows: DataFrame, shard: str, order: list[str], blocks: int) -> DataFrame:
    """Numbers from 0 without gaps in each shard: ranks in hashed blocks plus the counts of earlier blocks."""
    rows = rows.withColumn("block", F.pmod(F.xxhash64(*order), F.lit(blocks)))
    counts = rows.groupBy(shard, "block").agg(F.count("*").alias("n"))
    before = counts.select(shard, "block", (F.sum("n").over(W.partitionBy(shard).orderBy("block").rowsBetween(
        W.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    rank = F.row_number().over(W.partitionBy(shard, "block").orderBy(*order))
    return (rows.withColumn("slot", rank).join(before, [shard, "block"])
            .withColumn("slot", (F.col("before") + F.col("slot") - 1).cast("bigint")).drop("block", "before"))
