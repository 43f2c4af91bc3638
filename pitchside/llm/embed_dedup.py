"""Embedding near-dedup with randomised-rotation binary codes.

Vectors of one label link at a cosine of ``least`` or more, in double precision.
Equal vectors count once, with their number of copies.

Codes: a unit vector is turned by a fixed random rotation and each coordinate keeps
its sign; the stored correction factor is the inner product of the turned vector
with its code.  ``<code, q> / factor`` is then an unbiased estimate of the inner
product with any turned vector q, with error at most ``SIGMAS * sqrt((1 - f^2) /
(f^2 * (D - 1)))`` but for a vanishing chance.  Pairs whose estimate plus bound
stays under the threshold are discarded; the others are recomputed exactly.

Candidates: ``TABLES`` keys of ``BITS`` sign bits (of as many rotations as needed)
per vector; vectors of a label that share a key are compared.  A pair at cosine 0.98
shares one with probability 1 - (1 - 0.936 ** 20) ** 24 > 0.999, closer pairs more
surely.  This recall and the bound above are the two things that are not exact (measured
together in the tests).  A pair found in several tables counts in the first.  Buckets are dealt in blocks
(common.bucket_blocks), so a large one is many bounded groups; a group sends on a
count per vector and a spanning forest, not its pairs.

Edge cases: vectors that are null, empty, zero or hold a null or non-finite component,
rows with a null label, and rows without vec_id link with nothing (no links, a
component of their own, kept); different vectors that share a vec_id are vectors like any
others, each row with its own links and component; vectors of different lengths never link; repeated rows are vectors of their
own; no rows give no rows; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucket_blocks, components, join_labels, saved, whole_groups

BITS, TABLES = 20, 24
#: Vectors of a bucket compared in one block.
BLOCK = 128
#: Width of the confidence bound: 4 covers all but about 1 pair in 10,000.
SIGMAS = 4.0


class Coder:
    """Rotations for vectors of one length."""

    def __init__(self, dims: int):
        rng = np.random.default_rng(dims)
        turns = -(-BITS * TABLES // dims)
        self.turns = [np.linalg.qr(rng.normal(size=(dims, dims)))[0] for _ in range(turns)]
        self.weights = (1 << np.arange(BITS, dtype=np.int64))

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """(rows, TABLES): groups of sign bits (in double precision, so that the bits of a
        vector do not depend on the batch it is in)."""
        bits = np.concatenate([unit @ t for t in self.turns], axis=1)[:, :BITS * TABLES] > 0
        return bits.reshape(len(unit), TABLES, BITS) @ self.weights

    def codes(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(turned vectors, signs, correction factors, error bounds)."""
        turned = (unit @ self.turns[0]).astype(np.float32)
        sign = np.where(turned > 0, 1, -1).astype(np.float32) / np.float32(np.sqrt(unit.shape[1]))
        factor = np.maximum((turned * sign).sum(axis=1), 1e-6)
        bound = SIGMAS * np.sqrt(np.maximum(1 - factor ** 2, 0) / (factor ** 2 * max(unit.shape[1] - 1, 1)))
        return turned, sign, factor, bound


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy().reshape(len(flat), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no overflow in the norm
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _bucket_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vid, label, dims, vec) -> (vid, label, dims, tab, bucket)."""
    coders: dict[int, Coder] = {}
    for b in batches:
        t = pa.Table.from_batches([b])
        dims = t.column("dims").to_numpy()
        for d in np.unique(dims):
            own = t.filter(pa.array(dims == d))
            for s in range(0, len(own), max(256, (1 << 20) // int(d))):
                some = own.slice(s, max(256, (1 << 20) // int(d)))
                keys = coders.setdefault(int(d), Coder(int(d))).keys(_unit(_matrix(some.column("vec"))))
                yield pa.RecordBatch.from_arrays([
                    *(pa.array(np.repeat(some.column(c).to_numpy(), TABLES)) for c in ("vid", "label", "dims")),
                    pa.array(np.tile(np.arange(TABLES, dtype=np.int32), len(some))), pa.array(keys.ravel())],
                    ["vid", "label", "dims", "tab", "bucket"])


def _compare(least: float):
    """Sorted rows of whole groups -> (a, b, links): links per vector (b null) and spanning edges."""
    def group(rows: np.ndarray, unit: np.ndarray, coder: Coder, block: np.ndarray, tab: int, same: bool):
        turned, sign, factor, bound = coder.codes(unit)
        left, right = (np.arange(len(rows)),) * 2 if same else (np.flatnonzero(block == block.min()), np.flatnonzero(block != block.min()))
        estimate = (sign[left] @ turned[right].T) / factor[left, None]
        i, j = np.nonzero(estimate + bound[left, None] >= least)
        i, j = left[i], right[j]
        if same:
            i, j = i[i < j], j[i < j]
        if not len(i):
            return i, j, i
        out_i, out_j = [], []
        for s in range(0, len(i), 1 << 14):
            x, y = rows[i[s:s + (1 << 14)]], rows[j[s:s + (1 << 14)]]
            cosine = np.einsum("ij,ij->i", x, y) / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))
            good = cosine >= least
            out_i.append(i[s:s + (1 << 14)][good])
            out_j.append(j[s:s + (1 << 14)][good])
        i, j = np.concatenate(out_i), np.concatenate(out_j)
        keys = coder.keys(unit) if len(i) else np.zeros((0, TABLES), np.int64)
        return i, j, ~(keys[i] == keys[j])[:, :tab].any(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders: dict[int, Coder] = {}
        names = ["label", "dims", "tab", "bucket", "block_a", "block_b"]
        for t, starts in whole_groups(batches, names, 1 << 13):
            vid, copies = t.column("vid").to_numpy(), t.column("copies").to_numpy()
            block, tab, dims = t.column("block").to_numpy(), t.column("tab").to_numpy(), t.column("dims").to_numpy()
            same = t.column("block_a").to_numpy() == t.column("block_b").to_numpy()
            vec = t.column("vec").combine_chunks()
            links, label, edges = np.zeros(len(vid), np.int64), np.arange(len(vid)), []
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
                d = int(dims[s])
                rows = vec.slice(s, e - s).flatten().to_numpy().reshape(e - s, d).astype(np.float64)
                rows /= np.abs(rows).max(axis=1, keepdims=True)
                i, j, first = group(rows, _unit(rows), coders.setdefault(d, Coder(d)), block[s:e], int(tab[s]), bool(same[s]))
                if len(i):
                    np.add.at(links, s + i[first], copies[s + j[first]])
                    np.add.at(links, s + j[first], copies[s + i[first]])
                    edges.append((s + i, s + j))
            if edges:
                label = join_labels(label, np.concatenate([i for i, _ in edges]), np.concatenate([j for _, j in edges]))
            some, member = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(vid)))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([vid[some], vid[label[member]]])),
                pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(vid[member])]),
                pa.array(np.concatenate([links[some], np.zeros(len(member), np.int64)]))], ["a", "b", "links"])

    return run


def embedding_components(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding, label)."""
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vec") > 0) & finite & F.exists("vec", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"), "label")
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    keyed = saved(rows.select("vec_id", "usable", "label", "vec", F.when(F.col("usable"), F.md5(F.to_json(F.struct("label", "vec")).cast("binary")))
                              .alias("same")), "vectors")
    vectors = keyed.where("usable").groupBy("same").agg(
        F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies"), F.first("label").cast("long").alias("label"),
        F.first("vec").alias("vec")).withColumns({"dims": F.size("vec"), "vid": F.monotonically_increasing_id()})
    vectors = saved(vectors, "distinct")  # written, so a vid is one vector's for good
    keys = ["label", "dims", "tab", "bucket"]
    buckets = vectors.select("vid", "label", "dims", "vec").mapInArrow(
        _bucket_rows, "vid long, label long, dims int, tab int, bucket long")
    dealt = bucket_blocks(buckets, keys, F.col("vid"), BLOCK)
    names = [*keys, "block_a", "block_b"]
    found = saved(dealt.join(vectors.select("vid", "copies", "vec"), "vid").select(*names, "block", "vid", "copies", "vec")
                  .repartition(*names).sortWithinPartitions(*names).mapInArrow(_compare(least), "a long, b long, links long"), "links")
    links = found.where("b is null").groupBy(F.col("a").alias("vid")).agg(F.sum("links").alias("links"))
    roots = components(found.where("b is not null")).withColumnRenamed("node", "vid")
    own = saved(vectors.select("vid", "same", "copies", "least_id").join(links, "vid", "left").join(roots, "vid", "left").select(
        "same", "least_id", F.coalesce("root", "vid").alias("root"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links")), "own")
    least_ids = own.groupBy("root").agg(F.min("least_id").alias("component"))
    classes = saved(own.join(least_ids, "root").select("same", "component", "links"), "classes")
    out = keyed.select("vec_id", "same").join(classes, "same", "left")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component", "vec_id").alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
