"""Sharding by minimax contiguous partition.

Equal texts form one atomic group.  Groups are ordered by a digest of their
text, and the order is cut into ``shards`` contiguous parts: binary search
finds the smallest capacity for which greedy filling needs no more parts,
then each cut is set at the group boundary nearest to the even share of what
is left, within what that capacity allows.

The driver never sees all groups.  It holds sums of blocks of the order (at
most 2^``block_bits``), and whenever a prefix sum that the search asks for
falls inside a block, that block is split further on the cluster; the search
repeats until every boundary it used was a true group boundary.

Defined results: NULL text is an empty text of size 8; copies and repeated
rows stay together; an empty table gives no rows; more shards than groups
leave shards empty.  The law is ``bytes``, so ``grown_shard`` is NULL.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

#: bits of the digest that order the groups
ORDER_BITS = 60


def sized_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8) -> DataFrame:
    """``(doc_id, size, text_crc32, pos)`` of every row; ``pos`` is the group's place in the order."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col), (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.conv(F.substring(F.sha2(text, 256), 1, ORDER_BITS // 4), 16, 10).cast("long").alias("pos"))


class Blocks:
    """Prefix sums of the ordered groups, known down to single groups where needed."""

    def __init__(self, groups: DataFrame, block_bits: int = 14, split_bits: int = 8):
        self.groups, self.split_bits = groups, split_bits
        shift = ORDER_BITS - block_bits
        rows = groups.groupBy(F.shiftright("pos", shift).alias("b")).agg(F.sum("bytes"), F.count(F.lit(1))).collect()
        self._set([(r[0] << shift, shift, int(r[1]), r[2]) for r in rows])
        self.unsure: set[int] = set()

    def _set(self, blocks):
        self.blocks = sorted(blocks)                    # (first pos, bits of the span, bytes, groups)
        self.edge = [0, *accumulate(b[2] for b in self.blocks)]
        self.total = self.edge[-1]

    def floor(self, t: int) -> int:
        """Largest known boundary at or below prefix ``t``; notes a block that may hold a larger one."""
        if t >= self.total:
            return self.total
        k = bisect_right(self.edge, t) - 1
        if self.edge[k] != t and self.blocks[k][3] > 1:
            self.unsure.add(k)
        return self.edge[k]

    def ceil(self, t: int) -> int:
        """Smallest known boundary at or above prefix ``t``."""
        if t <= 0:
            return 0
        k = bisect_left(self.edge, t)
        if self.edge[k] != t and self.blocks[k - 1][3] > 1:
            self.unsure.add(k - 1)
        return self.edge[k]

    def position(self, prefix: int) -> int:
        """First place in the order of the groups after ``prefix``."""
        k = bisect_left(self.edge, prefix)
        return self.blocks[k][0] if k < len(self.blocks) else 1 << ORDER_BITS

    def split(self) -> None:
        """Splits the noted blocks: small ones into their groups, others by more bits."""
        todo = [self.blocks[k] for k in sorted(self.unsure)]
        gone = set(self.unsure)
        self.unsure = set()
        spans = self.groups.sparkSession.createDataFrame(
            [(b[0] >> b[1], b[1], 0 if b[3] <= 1 << self.split_bits else max(0, b[1] - self.split_bits)) for b in todo],
            "b long, shift int, next int")
        found = []
        for shift in sorted({b[1] for b in todo}):
            rows = (self.groups.withColumn("b", F.shiftright("pos", shift))
                    .join(spans.where(F.col("shift") == shift), "b")
                    .withColumn("first", F.call_function("shiftright", F.col("pos"), F.col("next")))
                    .groupBy("first", "next").agg(F.sum("bytes"), F.count(F.lit(1))).collect())
            found += [(r[0] << r[1], r[1], int(r[2]), r[3]) for r in rows]
        self._set([b for k, b in enumerate(self.blocks) if k not in gone] + found)


def smallest_capacity(blocks: Blocks, shards: int, largest: int) -> int:
    """Smallest capacity for which greedy filling needs at most ``shards`` parts."""
    def feasible(c: int) -> bool:
        at = 0
        for _ in range(shards):
            at = blocks.floor(at + c)
            if at == blocks.total:
                return True
        return False

    even = -(-blocks.total // shards)
    low, high = max(largest, even), even + largest
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if feasible(mid) else (mid + 1, high)
    return low


def even_cuts(blocks: Blocks, shards: int, capacity: int) -> list[int]:
    """Prefix sums of the cuts: nearest to even shares, no part above ``capacity``."""
    least = [blocks.total]                              # from the right: where a part may begin at the earliest
    for _ in range(shards - 1):
        least.append(blocks.ceil(least[-1] - capacity))
    least = least[::-1]                                 # least[j]: parts j + 1.. fit behind it
    cuts, at = [], 0
    for j in range(shards - 1):
        target = at + -(-(blocks.total - at) // (shards - j))
        below, above = blocks.floor(target), blocks.ceil(target)
        near = below if target - below <= above - target else above
        at = max(at, min(max(near, least[j]), blocks.floor(at + capacity)))
        cuts.append(at)
    return cuts


def plan_cuts(groups: DataFrame, shards: int, block_bits: int = 14, split_bits: int = 8) -> tuple[list[int], int]:
    """``(places of the cuts in the order, capacity)`` for ``groups(pos, bytes)``."""
    largest = groups.agg(F.max("bytes")).first()[0]
    if largest is None:
        return [], 0
    blocks = Blocks(groups, block_bits, split_bits)
    while True:
        capacity = smallest_capacity(blocks, shards, int(largest))
        cuts = even_cuts(blocks, shards, capacity)
        if not blocks.unsure:
            return [blocks.position(c) for c in cuts], capacity
        blocks.split()


def number_rows(rows: DataFrame, key: str) -> DataFrame:
    """Adds ``slot``, gapless from 0 per ``key``, without gathering a key: rows are numbered per
    (input partition, key) and shifted by the counts of the partitions before.  ``rows`` must
    come from a checkpoint, so that a partition read again holds the same rows."""
    marked = rows.withColumns({"__part": F.spark_partition_id(), "__row": F.monotonically_increasing_id()})
    before = W.partitionBy(key).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    shift = (marked.groupBy("__part", key).count()
             .select("__part", key, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__shift")))
    inside = F.row_number().over(W.partitionBy("__part", key).orderBy("__row")) - 1
    return (marked.withColumn("__inside", inside).join(shift, ["__part", key])
            .withColumn("slot", (F.col("__inside") + F.col("__shift")).cast("long"))
            .drop("__part", "__row", "__inside", "__shift"))


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's columns: size, law, shard and slot of every document."""
    rows = cut(sized_rows(docs, id_col, text_col))
    groups = cut(rows.groupBy("pos").agg(F.sum("size").alias("bytes")))
    cuts, _ = plan_cuts(groups, shards)
    number = sum([(F.col("pos") >= F.lit(c)).cast("int") for c in cuts], F.lit(0))
    placed = number_rows(rows.withColumn("shard", number.cast("int")), "shard")
    return placed.select(id_col, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
