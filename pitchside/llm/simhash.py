"""SimHash near-dedup with pivot distance tables.

A text's fingerprint has 64 bits: a bit is 1 if it is set in more than half of
the XXH64 hashes (seed 42) of its word shingles, repeats included.  Two
fingerprints link at ``max_bits`` differing bits or fewer; a class is a connected
component of these links.

Search: copies of a fingerprint count once.  The 64 bits are cut into
``2 * max_bits`` blocks; any two linked fingerprints agree on at least
``max_bits`` whole blocks, so each choice of ``max_bits`` blocks is a bucket key
(20 keys of about 32 bits for 3 bits) and no link is lost.  Inside a bucket the
distances of every fingerprint to ``PIVOTS`` fixed reference fingerprints are
tabled once; by the triangle inequality a pair is discarded if any coordinate
differs by more than ``max_bits``; survivors are verified by their Hamming
distance.  A bucket emits a spanning forest, not its pairs.

Edge cases: null and empty texts have fingerprint zero and link like any other;
texts with fewer words than a shingle hash their whole sequence; a null doc_id
has a fingerprint but no links (its component is null); repeated rows give equal
rows; no input rows give no rows; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucket_blocks, components, join_labels, pairs_in_groups, saved, whole_groups, word_lists

PIVOTS = 32
#: Largest number of fingerprints of a bucket compared in one group.
BLOCK = 1024
SEED = 42


def _bit_counts(hashes: list[int], owners: list[tuple[int, int]], counts: np.ndarray) -> None:
    """Add the set bits of ``hashes`` to ``counts``; owners: (row, number of hashes) in order."""
    bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    starts = np.cumsum([0] + [n for _, n in owners[:-1]])
    np.add.at(counts, [row for row, _ in owners], np.add.reduceat(bits, starts, axis=0, dtype=np.int64))


def _fingerprint_batch(texts: list[bytes | None], words: int, flush: int = 1 << 17) -> np.ndarray:
    counts = np.zeros((len(texts), 64), np.int64)
    totals = np.zeros(len(texts), np.int64)
    hashes: list[int] = []
    owners: list[tuple[int, int]] = []
    xx = xxhash.xxh64_intdigest
    for row, text in enumerate(texts):
        tail: list[bytes] = []
        for piece in word_lists(text or b""):
            seq = tail + piece
            new = [xx(b" ".join(s), SEED) for s in zip(*(seq[k:] for k in range(words)))]
            tail = seq[-(words - 1):] if words > 1 else []
            if new:
                hashes += new
                owners.append((row, len(new)))
                totals[row] += len(new)
            if len(hashes) >= flush:
                _bit_counts(hashes, owners, counts)
                hashes, owners = [], []
        if tail and not totals[row]:
            hashes.append(xx(b" ".join(tail), SEED))
            owners.append((row, 1))
            totals[row] = 1
    if hashes:
        _bit_counts(hashes, owners, counts)
    return np.packbits(2 * counts > totals[:, None], axis=1, bitorder="little").view(np.int64).ravel()


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp): the signed 64-bit fingerprint of every row's text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = _fingerprint_batch(b.column(1).to_pylist(), words) if b.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")) \
        .mapInArrow(run, "doc_id long, fp long")


def _pivots() -> np.ndarray:
    return np.random.default_rng(64).integers(0, 1 << 64, PIVOTS, np.uint64)


def _block_masks(max_bits: int) -> list[int]:
    """Bit masks: every choice of ``max_bits`` out of ``2 * max_bits`` blocks."""
    n = 2 * max_bits
    ends = [64 * k // n for k in range(n + 1)]
    blocks = [((1 << (e - s)) - 1) << s for s, e in zip(ends, ends[1:])]
    return [sum(c) for c in combinations(blocks, max_bits)]


def _link_groups(max_bits: int):
    """Sorted rows (bucket, block_a, block_b; block, fp) -> spanning edges of each group's links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = _pivots()
        for t, starts in whole_groups(batches, ["mask", "bucket", "block_a", "block_b"]):
            fp = t.column("fp").combine_chunks().to_numpy().view(np.uint64)
            block = t.column("block").to_numpy()
            across = t.column("block_a").to_numpy() != t.column("block_b").to_numpy()
            far = np.bitwise_count(fp[:, None] ^ pivots[None, :]).astype(np.int8)  # the pivot table
            label = np.arange(len(fp))
            for i, j in pairs_in_groups(starts):
                use = ~across[i] | (block[i] != block[j])
                i, j = i[use], j[use]
                for p in range(PIVOTS):
                    near = np.abs(far[i, p] - far[j, p]) <= max_bits
                    i, j = i[near], j[near]
                near = np.bitwise_count(fp[i] ^ fp[j]) <= max_bits
                label = join_labels(label, i[near], j[near])
            member = np.flatnonzero(label != np.arange(len(fp)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(fp[label[member]].view(np.int64)), pa.array(fp[member].view(np.int64))], ["a", "b"])
    return run


def links(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """(a, b): edges whose components are those of the links among the distinct ``fp`` values."""
    masks = _block_masks(max_bits) if max_bits else []
    if not masks:
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("a <> b")
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    rows = prints.select("fp", F.posexplode(F.array(*[F.lit(m).bitwiseAND(F.col("fp")) for m in signed]))
                         .alias("mask", "bucket"))
    dealt = bucket_blocks(rows, ["mask", "bucket"], F.col("fp"), BLOCK)
    keys = ["mask", "bucket", "block_a", "block_b"]
    return dealt.select(*keys, "block", "fp").repartition(*keys).sortWithinPartitions(*keys) \
        .mapInArrow(_link_groups(max_bits), "a long, b long")


def simhash_components(docs: DataFrame, words: int = 3, max_bits: int = 3) -> DataFrame:
    """(doc_id, fp, component_id): ``component_id`` is the smallest doc_id reachable by links."""
    rows = saved(fingerprints(docs, words), "fingerprints")
    distinct = saved(rows.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fp")
    roots = components(links(distinct, max_bits)).withColumnRenamed("node", "fp")
    member = distinct.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    lowest = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = saved(member.join(lowest, "root").select("fp", "component_id"), "fp-classes")
    return rows.join(classes, "fp", "left").select(
        "doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def one_per_group(docs: DataFrame, words: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of ``docs`` that stand for their class: the smallest doc_id of each.

    Repeated rows of one doc_id leave one; rows without doc_id can't be named as a
    copy of anything and stay.
    """
    first = saved(simhash_components(docs, words, max_bits).where("doc_id = component_id")
                  .select("doc_id").distinct(), "kept-ids")
    named = docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.select(docs.columns).unionByName(docs.where("doc_id is null"))
