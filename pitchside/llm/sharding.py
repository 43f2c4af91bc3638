"""Sharding by longest-processing-time scheduling (law ``bytes``).

Equal texts form a group that stays together.  Groups, largest first, go to the
least-loaded shard through a heap.  The heap runs on size classes, not on groups:
a class holds the groups whose bytes share their 11 leading bits, so there are at
most ``2048 + 1024 * 52`` classes whatever the input, and only (class, count,
bytes) reach the driver.  A class of one group is scheduled exactly; in a larger
one the heap deals its mean size, and every group finds its shard by its rank in
the class (a distributed running count).

Slots number the rows of a shard without gaps, again by a distributed running
count over ranges of a hash key, so a third of all rows in one group or one shard
never gathers in a task.

Edge cases: a null text counts as an empty one (size 1, group of the empty text);
null ids and repeated rows are rows like any other; no rows give no rows; columns
of the input named like the operator's are replaced.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import running_total, saved

LEADING_BITS = 11


def schedule(classes: list[tuple[int, int, int]], shards: int) -> list[tuple[int, list[int], list[int]]]:
    """(class, count, bytes) -> (class, upper ranks, shards): a group of rank r goes to
    the first listed shard whose upper rank is above r."""
    heap = [(0.0, k) for k in range(shards)]
    out = []
    for cls, count, total in sorted(classes, key=lambda c: (-c[2] / c[1], c[0])):
        each, left, quota = total / count, count, {}
        while left:
            low = heapq.nsmallest(shards, heap)
            level = sum(load - low[0][0] <= each for load, _ in low)
            room = left // level
            if level < shards:
                room = min(room, int((low[level][0] - low[level - 1][0]) / each))
            if room > 1:  # the next rounds of the heap repeat over the same shards
                heap = [(load + room * each, k) for load, k in low[:level]] + low[level:]
                heapq.heapify(heap)
                for _, k in low[:level]:
                    quota[k] = quota.get(k, 0) + room
                left -= room * level
            else:
                load, k = heapq.heappop(heap)
                heapq.heappush(heap, (load + each, k))
                quota[k] = quota.get(k, 0) + 1
                left -= 1
        upper, at = [], 0
        for k in quota:
            at += quota[k]
            upper.append(at)
        out.append((cls, upper, list(quota)))
    return out


def shard_documents(docs: DataFrame, shards: int = 16, keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (default all) plus size, text_crc32, shard and slot."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    own = ("size", "text_crc32", "shard", "slot")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in own]
    rows = docs.select(*kept, (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                       F.md5(text).alias("__group"),
                       F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.md5(text)).cast("binary")).alias("__row"))
    if "text" not in kept:
        rows = saved(rows, "shard-rows")
    shift = f"greatest(length(bin(bytes)) - {LEADING_BITS}, 0)"
    groups = saved(rows.groupBy("__group").agg(F.sum("size").alias("bytes")).withColumn(
        "class", F.expr(f"shiftleft(shiftright(bytes, {shift}), {shift})")), "groups")
    classes = groups.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    plan = spark.createDataFrame(schedule([tuple(r) for r in classes.collect()], shards),
                                 "class long, upper array<long>, shards array<int>")
    ranked = running_total(groups.withColumn("bin", F.substring("__group", 1, 3)), ["class"], "bin", ["__group"],
                           F.lit(1), "rank")
    placed = saved(ranked.join(F.broadcast(plan), "class").select("__group", F.element_at(
        "shards", F.size(F.filter("upper", lambda u: u <= F.col("rank"))) + 1).alias("shard")), "placed")
    rows = rows.join(placed, "__group").withColumn("__bin", F.substring("__row", 1, 3))
    rows = running_total(rows, ["shard"], "__bin", ["__row"], F.lit(1), "slot")
    return rows.select(*kept, "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))

