"""Sharding: the minimax contiguous partition of groups of equal texts.

Groups keep together and stand in a fixed order, by their smallest document id. The smallest capacity that
some contiguous partition into so many shards can keep is found by search, each capacity being checked
greedily: a shard takes groups until the next one does not fit. The shards are cut where the greedy filling
of that capacity cuts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .ordering import number_rows, running_sum

SHARDS = 8
#: Capacities checked in one pass over the ends of the groups: each round splits the range by one more.
TRIED = 31


def _greedy(ends: DataFrame, capacities: list[int], shards: int) -> list[list[int]]:
    """For each capacity, where the shards end when each is filled up to it. One pass per shard."""
    cuts = [[0] for _ in capacities]
    for _ in range(shards):
        last = [F.max(F.when(F.col("end") <= c[-1] + capacity, F.col("end"))) for c, capacity in zip(cuts, capacities)]
        found = ends.where(F.col("end") > min(c[-1] for c in cuts)).agg(*last).first()
        for c, end in zip(cuts, found):
            c.append(max(c[-1], end or 0))
    return cuts


def smallest_capacity(ends: DataFrame, total: int, largest: int, shards: int) -> tuple[int, list[int]]:
    """The least feasible capacity and the ends of its shards. ``ends`` has the running sum after each group.

    A capacity of the mean plus the largest group always suffices. The passes read one number per group.
    """
    low, high = max(-(-total // shards), largest), -(-total // shards) + largest
    best = None
    while best is None or low < high:
        step = max(1, -(-(high - low) // (TRIED + 1)))
        tried = sorted({min(low + i * step, high) for i in range(TRIED + 1)})
        for capacity, cuts in zip(tried, _greedy(ends, tried, shards)):
            if cuts[-1] == total:
                high, best = capacity, cuts
                break
            low = capacity + 1
    return high, best


def minimax_shards(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of each row; texts themselves are never shuffled.

    ``size`` is the length of the text in UTF-8 plus 1, of a null text 1; null texts are one group, empty ones
    another. Slots count from 0 in the order of (id, checksum, size) within a shard; repeated rows have a slot
    each. A group of any size, such as a third of all rows, is added up before it is shuffled. An empty table
    gives no row. Other columns are not carried along.
    """
    value = F.col(text)
    keys = materialize(docs.select(
        F.col(doc_id).alias("doc_id"), (F.coalesce(F.octet_length(value), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.coalesce(F.crc32(value.cast("binary")), F.lit(0)).cast("bigint").alias("text_crc32"),
        F.xxhash64(value.isNull(), value).alias("g1"), F.xxhash64(F.lit(1), value).alias("g2"),
    ), "shard-keys")
    groups = keys.groupBy("g1", "g2").agg(F.sum("size").alias("group_size"), F.min("doc_id").alias("first"))
    ordered = running_sum(groups, ["first", "g1", "g2"], "group_size", "before")
    ordered = materialize(ordered.withColumn("end", F.col("before") + F.col("group_size")), "shard-groups")
    total, largest = ordered.agg(F.sum("group_size"), F.max("group_size")).first()
    cuts = [0] * (shards + 1) if total is None else smallest_capacity(ordered.select("end"), total, largest, shards)[1]
    shard = sum(((F.col("before") >= cut).cast("int") for cut in cuts[1:-1]), F.lit(0))
    placed = keys.join(ordered.select("g1", "g2", shard.cast("int").alias("shard")), ["g1", "g2"]).drop("g1", "g2")
    return number_rows(placed, ["doc_id", "text_crc32", "size"], ["shard"], index="slot")


def brute_force(sizes: list[int], shards: int) -> int:
    """The smallest feasible capacity, by trying all of them: for tests."""
    def fits(capacity):
        used, held = 1, 0
        for size in sizes:
            if size > capacity:
                return False
            if held + size > capacity:
                used, held = used + 1, 0
            held += size
        return used <= shards

    return next(c for c in range(1, sum(sizes) + 1) if fits(c))
