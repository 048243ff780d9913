"""Longest-processing-time scheduling of groups of equal texts onto shards."""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import drop, save

#: Groups of a range in which places among groups of one size are counted, on average.
GROUP_ROWS = 10_000
#: Groups with this part of all rows or more are told to every task; there are at most so many.
HOT = 1000
#: Most sizes whose shards are broadcast; beyond it they are joined by a shuffle.
MOST_SIZES = 1 << 16


def schedule(items: list[tuple[int, str]], shards: int) -> dict[str, int]:
    """Longest first, each to the least-loaded shard."""
    loads = [(0, s) for s in range(shards)]
    out = {}
    for size, name in sorted(items, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(loads)
        out[name] = shard
        heapq.heappush(loads, (load + size, shard))
    return out


def _full_rounds(loads: np.ndarray, size: int, count: int) -> np.ndarray:
    """How many of `count` items of one size each shard has taken when no load is below a level, the highest that they reach."""
    taken = lambda level: np.maximum(0, -((loads - level) // size))
    low, high = int(loads.min()), int(loads.max()) + size * (count + 1)
    while high - low > 1:  # the highest level that asks for no more items than there are
        level = (low + high) // 2
        low, high = (level, high) if taken(level).sum() <= count else (low, level)
    return taken(low)


def schedule_sizes(classes: Iterable[tuple[int, int]], shards: int) -> list[tuple[int, list[int], list[int]]]:
    """Longest first, each to the least-loaded shard, for (size, count) of items: those of one size are alike, so that only how many of them
    each shard gets is told. Rounds in which all low shards get their items are taken at once, the rest goes through the heap.

    Returns (size, ends, shards): of the items of a size, those with places from one end up to the next go to one shard.
    """
    loads, out = np.zeros(shards, np.int64), []
    for size, count in sorted(classes, reverse=True):
        taken = np.zeros(shards, np.int64)
        if size <= 0:
            taken[loads.argmin()] = count
        else:
            if count > 2 * shards:
                taken += _full_rounds(loads, size, count)
            heap = [(int(load), s) for s, load in enumerate(loads + taken * size)]
            heapq.heapify(heap)
            for _ in range(count - int(taken.sum())):
                load, s = heap[0]
                taken[s] += 1
                heapq.heapreplace(heap, (load + size, s))
        loads += taken * size
        used = np.flatnonzero(taken)
        out.append((size, np.cumsum(taken[used]).tolist(), used.tolist()))
    return out


def _scheduled(groups: DataFrame, shards: int, most_sizes: int) -> DataFrame:
    """(grp, n, shard) of every group. Only the sizes and their counts come to the driver: different sizes that add up to all bytes
    are at most the root of twice their number. A group's place among those of its size is counted in ranges."""
    sizes = groups.groupBy("bytes").agg(F.count("*").alias("k")).toArrow()
    plan = schedule_sizes(zip(sizes.column("bytes").to_pylist(), sizes.column("k").to_pylist()), shards)
    kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()))
    columns = [pa.array([row[i] for row in plan], kind) for i, kind in enumerate(kinds)]
    table = groups.sparkSession.createDataFrame(pa.table(columns, ["bytes", "ends", "shards"]))
    ranges = 1 + sum(sizes.column("k").to_pylist()) // GROUP_ROWS
    groups = groups.withColumn("range", F.pmod(F.xxhash64("grp"), F.lit(ranges)))
    before = Window.partitionBy("bytes").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.groupBy("bytes", "range").agg(F.count("*").alias("k")).select("bytes", "range", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("bytes", "range").orderBy("grp")) - 1
    placed = groups.withColumn("inside", inside).join(offsets, ["bytes", "range"])
    placed = placed.join(F.broadcast(table) if len(plan) <= most_sizes else table, "bytes")
    passed = F.size(F.filter("ends", lambda end: end <= F.col("offset") + F.col("inside")))
    return placed.select("grp", "n", F.get("shards", passed).alias("shard"))


def shard(docs: DataFrame, shards: int = 40, overhead: int = 16, slot_rows: int = 5000, id_col: str = "doc_id", text_col: str = "text", most_sizes: int = MOST_SIZES) -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null).

    Shards have the loads of scheduling every group through one heap, longest first. Rows with equal texts (a null text counts as empty) share a shard, so a group larger than a
    shard's part stays whole and makes its shard the largest. size: UTF-8 bytes of the text and `overhead`. slot: the row's place
    in its shard, without gaps. Repeated rows have slots of their own; null ids count as any other. Of groups of
    equal size, which one goes to which shard follows the hash of its text. A text of any length is hashed whole. An empty table gives an
    empty one. Other columns are ignored.
    """
    text = F.col(text_col).cast("string")
    slim = docs.select(
        F.col(id_col).alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 32).alias("grp"),
    )
    slim = save(slim, "slim")
    groups = save(slim.groupBy("grp").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "groups")
    rows = slim.count()
    placed = save(_scheduled(groups, shards, most_sizes), "placed")
    hot = F.broadcast(placed.where(F.col("n") * HOT >= rows).select("grp", "shard"))
    cold = slim.join(hot.select("grp"), "grp", "left_anti").join(placed.where(F.col("n") * HOT < rows).select("grp", "shard"), "grp")
    named = slim.join(hot, "grp").unionByName(cold)
    parts = 1 + rows // (shards * slot_rows)
    named = save(named.select("doc_id", "size", "text_crc32", "grp", "shard", F.pmod(F.xxhash64("doc_id", "grp"), F.lit(parts)).alias("part")), "sharded")
    drop(slim, groups, placed)
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = named.groupBy("shard", "part").agg(F.count("*").alias("n")).select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "grp"))
    slots = named.withColumn("inside", inside).join(offsets, ["shard", "part"])
    return slots.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("offset") + F.col("inside") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
