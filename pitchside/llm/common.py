"""Helpers shared by the operators: scratch tables, distributed running totals,
bucket joins in bounded blocks, and connected components.

All state between jobs lives in Parquet below ``spark.checkpoint.dir`` (the
cluster's shared folder), so lineage is cut there and a lost executor only
re-runs tasks.
"""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

#: Ranges per partition in :func:`running_total`; a hash-random key fills them evenly.
BINS = 4096

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

SPACE = re.compile(rb"[\x20\x09-\x0d]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class _Scopes(threading.local):
    def __init__(self):
        self.open: list[list[str]] = []


_scopes = _Scopes()


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables saved in this block are deleted at its end, but for those saved with ``keep``."""
    paths: list[str] = []
    _scopes.open.append(paths)
    try:
        yield
    finally:
        _scopes.open.remove(paths)
        for path in paths:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def saved(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    The result has no lineage but its files; its statistics are measured ones.  It
    lives as long as the innermost :func:`temporary` block, or with ``keep`` as the
    one around that; outside of any, as long as the folder.
    """
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pitchside-{uuid.uuid4().hex}"
    scopes = _scopes.open[:-1] if keep else _scopes.open
    if scopes:
        scopes[-1].append(folder)
    path = f"{folder}/{label}"
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")  # the written table replaces the shuffle files
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(col: str, n: int) -> Column:
    """``crc32(col as text) mod n``; null for a null value."""
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(n))


def held_out(col: str, n: int, remainder: int) -> Column:
    """True on the held-out share; a null id is never held out."""
    return F.coalesce(crc_mod(col, n) == remainder, F.lit(False))


def word_lists(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words (runs without ASCII white space) in order, A-Z lowered, in lists from
    pieces of about ``size`` bytes, so a very long text never becomes one list."""
    at = 0
    while at < len(text):
        end = at + size
        if end < len(text):
            stop = SPACE.search(text, end)
            end = stop.start() if stop else len(text)
        yield text[at:end].lower().split()
        at = end


def running_total(df: DataFrame, part: list[str], bin_col: str, order: list, value: Column,
                  out: str) -> DataFrame:
    """Exclusive running total of ``value`` per ``part`` as column ``out``.

    ``bin_col`` must be a function of the first order column that grows with it
    (equal-width ranges of a hash-random key).  Each (part, bin) is sorted in a
    task of its own; the offsets of the bins come from one small row per bin, so
    no task ever holds a whole part.  ``part`` columns must not be null.
    """
    keys = [*part, bin_col]
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy(*part).orderBy(bin_col).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("__value", value)
    bins = rows.groupBy(*keys).agg(F.sum("__value").alias("__total")).select(
        *keys, F.coalesce(F.sum("__total").over(above), F.lit(0)).alias("__offset"))
    rows = rows.withColumn("__inside", F.coalesce(F.sum("__value").over(inside), F.lit(0)))
    return (rows.join(bins, keys).withColumn(out, F.col("__offset") + F.col("__inside"))
            .drop("__value", "__inside", "__offset"))


def bucket_blocks(rows: DataFrame, keys: list[str], ident: Column, limit: int) -> DataFrame:
    """Rows of every bucket with two members or more, dealt so that each pair of a
    bucket meets in exactly one group (``keys``, ``block_a``, ``block_b``).

    A bucket over ``limit`` rows is cut into ``n`` hash blocks and its rows go to
    the ``n`` block pairs they belong to, so a group holds about ``2 * limit`` rows
    whatever the bucket's size, and no pair is skipped.  ``block`` is the row's
    own block: compare inside it if ``block_a = block_b``, else across the two.
    """
    sizes = saved(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1"), "bucket-sizes")
    return in_blocks(rows.join(sizes, keys), ident, F.ceil(F.col("__n") / F.lit(limit))).drop("__n")


def in_blocks(rows: DataFrame, ident: Column, n: Column) -> DataFrame:
    """Rows of buckets dealt as by :func:`bucket_blocks`, ``n`` being the blocks of the row's bucket."""
    dealt = rows.withColumn("__blocks", n.cast("int")).withColumn(
        "block", F.pmod(F.xxhash64(ident), F.col("__blocks")).cast("int"))
    dealt = dealt.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
    return dealt.withColumns({
        "block_a": F.least("block", "__other"), "block_b": F.greatest("block", "__other"),
    }).drop("__blocks", "__other")


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 1 << 16) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """From batches sorted by ``keys``, yield (table, starts) holding whole groups only;
    ``starts`` are the group offsets with the table's length at the end."""
    held: list[pa.RecordBatch] = []
    count = 0

    def cut(t: pa.Table) -> np.ndarray:
        change = np.zeros(max(len(t) - 1, 0), bool)
        for k in keys:
            v = t.column(k).combine_chunks().to_numpy(zero_copy_only=False)
            change |= v[1:] != v[:-1]
        return np.concatenate([[0], np.flatnonzero(change) + 1])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count >= rows:
            t = pa.Table.from_batches(held)
            starts = cut(t)
            if len(starts) > 1:
                yield t.slice(0, starts[-1]), starts
                rest = t.slice(starts[-1]).combine_chunks().to_batches()
                held, count = rest, sum(b.num_rows for b in rest)
    if held:
        t = pa.Table.from_batches(held)
        yield t, np.concatenate([cut(t), [len(t)]])


def pairs_in_groups(starts: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All index pairs (i < j) inside the groups, in vectors of bounded length."""
    n = int(starts[-1])
    if n < 2:
        return
    sizes = np.diff(starts)
    left = np.repeat(starts[1:], sizes) - np.arange(n) - 1  # rows after i in its group
    out_i, out_j, held = [], [], 0
    live = np.flatnonzero(left > 0)
    shift = 1
    while len(live):
        out_i.append(live)
        out_j.append(live + shift)
        held += len(live)
        if held >= most:
            yield np.concatenate(out_i), np.concatenate(out_j)
            out_i, out_j, held = [], [], 0
        shift += 1
        live = live[left[live] >= shift]
    if held:
        yield np.concatenate(out_i), np.concatenate(out_j)


def join_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Union the classes of ``i`` and ``j`` in ``label`` (each entry: the class's smallest index)."""
    while True:
        a, b = label[i], label[j]
        low, high = np.minimum(a, b), np.maximum(a, b)
        apart = low != high
        if not apart.any():
            return label
        np.minimum.at(label, high[apart], low[apart])
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        i, j = i[apart], j[apart]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    Returns (node, root) for every node of an edge; ``root`` is the smallest node
    of the component.  Each step reduces the edges per node with a partial
    minimum and joins it back, so no neighbour list is ever collected; a hub's
    rows are split by the skew join.  Each step ends in a written table.
    """
    def star(e: DataFrame, both: bool) -> DataFrame:
        sides = e.select(F.col("u"), F.col("v"))
        if both:
            sides = sides.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        low = saved(low, "star-low")
        kept = sides.where("v > u") if both else sides
        moved = kept.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        if not both:
            moved = moved.unionByName(low.select("u", F.col("m").alias("v")))
        return saved(moved.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                     .distinct(), "star")

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()

    with temporary(edges.sparkSession):
        e = saved(edges.where(F.col(a) != F.col(b)).select(
            F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
        seen = mark(e)
        while True:
            e = star(star(e, True), False)
            now = mark(e)
            if now == seen:
                break
            seen = now
        ends = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        return saved(ends.unionByName(ends.select(F.col("root").alias("node"), "root").distinct()), "components", keep=True)


class KeyTable:
    """Position of 64-bit keys among ``keys`` (distinct), by an open hash table in numpy."""

    EMPTY = np.uint64((1 << 64) - 1)

    def __init__(self, keys: np.ndarray):
        keys = keys.astype(np.uint64)
        bits = max(4, int(max(len(keys), 1)).bit_length() + 1)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slot_key = np.full(1 << bits, self.EMPTY)
        self.slot_at = np.full(1 << bits, -1, np.int32)
        left, slot = np.arange(len(keys), dtype=np.int32), self._slot(keys)
        while len(left):
            free = self.slot_at[slot] < 0
            self.slot_at[slot[free]] = left[free]
            lost = self.slot_at[slot] != left
            left, slot = left[lost], (slot[lost] + 1) & self.mask
        full = self.slot_at >= 0
        self.slot_key[full] = keys[self.slot_at[full]]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The position of every key, -1 where it is none of them."""
        slot = self._slot(keys)
        there = self.slot_key[slot]
        out = np.where(there == keys, self.slot_at[slot], np.int32(-1))
        left = np.flatnonzero((there != keys) & (there != self.EMPTY))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & self.mask
            there = self.slot_key[slot]
            hit = there == keys[left]
            out[left[hit]] = self.slot_at[slot[hit]]
            on = ~hit & (there != self.EMPTY)
            left, slot = left[on], slot[on]
        return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """Rolling hash of every window of ``q`` characters, by doubling."""
    if len(codes) < q:
        return np.zeros(0, np.uint64)
    part, size, power = codes.astype(np.uint64), 1, 0x9E3779B97F4A7C15  # power: base ** size
    out, done = None, 0
    while True:
        if q & size:
            if out is None:
                out, done = part, size
            else:
                n = len(codes) - done - size + 1
                out = out[:n] * np.uint64(power) + part[done:done + n]
                done += size
        if done == q:
            return out
        n = len(part) - size
        part = part[:n] * np.uint64(power) + part[size:size + n]
        size, power = 2 * size, power * power % (1 << 64)


def sorted_totals(df: DataFrame, keys: list[str], weights: list[str]) -> DataFrame:
    """Rows of ``df`` (distinct in ``keys``) with ``before_<w>``: the total of each weight over
    all rows of smaller ``keys``.

    A range sort, a running count inside each partition, and the partitions' offsets:
    one row per partition, so at most ``spark.sql.shuffle.partitions`` rows are broadcast.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, total = TaskContext.get().partitionId(), dict.fromkeys(weights, 0)
        for b in batches:
            out = [pa.array(np.full(b.num_rows, pid, np.int32))]
            for w in weights:
                v = b.column(w).to_numpy()
                out.append(pa.array(total[w] + np.cumsum(v) - v))
                total[w] += int(v.sum())
            yield pa.RecordBatch.from_arrays([*b.columns, *out], [*b.schema.names, "__pid", *(f"__{w}" for w in weights)])

    schema = T.StructType([*df.schema.fields, T.StructField("__pid", T.IntegerType()), *(T.StructField(f"__{w}", T.LongType()) for w in weights)])
    rows = saved(df.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema), "sorted")
    above = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("__pid").agg(*[F.sum(w).alias(f"__sum_{w}") for w in weights]).select(
        "__pid", *[F.coalesce(F.sum(f"__sum_{w}").over(above), F.lit(0)).alias(f"__off_{w}") for w in weights])
    return rows.join(F.broadcast(sums), "__pid").select(
        *df.columns, *[(F.col(f"__off_{w}") + F.col(f"__{w}")).alias(f"before_{w}") for w in weights])
