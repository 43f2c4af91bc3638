"""Benchmark decontamination by the q-gram lemma.

A benchmark item of m characters that occurs in a document with at most
``k = floor(rate * m)`` edits shares at least ``m - q + 1 - k * q`` of its q-grams
with it, all within k diagonals.  Each document is scanned once: rolling hashes of
its character q-grams are looked up in the index of the items, hits are counted per
item in overlapping bands of diagonals (band b covers ``[b * w, b * w + 2 * w)``, so
any k < w diagonals lie in one band), bands at the bound are retained, and a banded
semi-global alignment decides each (an exact occurrence needs none).

Text is lower-cased and runs of white space become one space on both sides.  Where
an item is too short for the bound to be 1 at ``Q``, its own q is the largest at which
it is, ``m // (k + 1)``; so every item is searched with its full k and the filter never
misses.  An item without edits and shorter than ``Q`` is its one q-gram: it is found
wherever it stands, as part of a word too.  Items of white space alone hold nothing.

Scale: documents are never shuffled.  The items are the query set; they go to the
tasks in blocks of at most ``BLOCK_CHARS`` characters, each block one pass over the
documents, so what is broadcast has a fixed bound whatever the benchmark's size.
Documents are scanned in pieces that overlap by a whole match.

Edge cases: null and empty texts hold nothing; null ids and repeated rows are
searched and returned like any other; empty tables give no leaks; further columns
are untouched by ``decontaminate`` and ignored by ``find_leaks``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import code_points as _codes
from .common import gram_hashes as _grams

Q = 10
RATE = 0.08
BLOCK_CHARS = 4_000_000
#: Characters scanned at once, and q-gram hits expanded at once.
PIECE = 1_000_000
HITS = 4_000_000

_MIX = np.uint64(0xD6E8FEB86659FD93)
_BITS = 20
_OUTSIDE = 0x110000  # no character


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


class ItemIndex:
    """The q-grams of a block of items: [(item_id, text)]."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, rate: float = RATE):
        kept = [(i, t) for i, t in ((i, normal(t)) for i, t in items) if t]
        self.ids, self.texts = [i for i, _ in kept], [t for _, t in kept]
        self.codes = [_codes(t) for t in self.texts]
        self.m = np.array([len(c) for c in self.codes], np.int64)
        self.k = (self.m * rate).astype(np.int64)
        self.q = np.minimum(q, self.m // (self.k + 1))
        self.bound = self.m - self.q + 1 - self.k * self.q
        self.width = np.maximum(self.k + 1, 4)
        self.overlap = int((self.m + self.k).max()) + 2 * q if kept else 0
        self.tables = [GramTable(size, [(t, self.codes[t]) for t in np.flatnonzero(self.q == size).tolist()])
                       for size in np.unique(self.q).tolist()]


class GramTable:
    """Where the q-grams of one length stand in items: [(item, its characters)]."""

    def __init__(self, q: int, items: list[tuple[int, np.ndarray]]):
        self.q = q
        grams = [_grams(c, q) for _, c in items]
        every = np.concatenate(grams)
        item = np.repeat([t for t, _ in items], [len(g) for g in grams])
        at = np.concatenate([np.arange(len(g)) for g in grams])
        order = np.argsort(every, kind="stable")
        self.item, self.at = item[order], at[order]
        self.grams, self.first = np.unique(every[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(every)))
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[self._slot(self.grams)] = True

    def find(self, codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, document, gram) of every hit in documents laid end to end."""
        grams = _grams(codes, self.q)
        pos = np.flatnonzero(self.maybe[self._slot(grams)])
        at = np.searchsorted(self.grams, grams[pos])
        at[at == len(self.grams)] = 0
        doc = np.searchsorted(ends, pos, side="right")
        real = (self.grams[at] == grams[pos]) & (pos + self.q <= ends[doc])
        return pos[real], doc[real], at[real]

    @staticmethod
    def _slot(grams: np.ndarray) -> np.ndarray:
        return (grams * _MIX) >> np.uint64(64 - _BITS)


def _bands(ix: ItemIndex, docs: list[tuple[int, str, np.ndarray, int]]) -> Iterator[tuple[int, int, int]]:
    """(index into docs, item, band) of every band whose q-gram count meets its item's bound."""
    lengths = [len(c) for _, _, c, _ in docs]
    ends = np.cumsum(lengths)
    codes = np.concatenate([c for _, _, c, _ in docs])
    found = [(table, *table.find(codes, ends)) for table in ix.tables]
    total = sum(int(table.count[at].sum()) for table, _, _, at in found)
    if total > HITS and (len(docs) > 1 or lengths[0] > 4 * ix.overlap):  # halve what is scanned at once
        if len(docs) > 1:
            half = len(docs) // 2
            yield from _bands(ix, docs[:half])
            yield from ((d + half, t, b) for d, t, b in _bands(ix, docs[half:]))
        else:
            row, text, _, off = docs[0]
            half = len(codes) // 2
            yield from _bands(ix, [(row, text, codes[:half + ix.overlap], off)])
            for d, t, b in _bands(ix, [(row, text, codes[half:], off)]):
                w = int(ix.width[t])  # a diagonal in the second half, as a band of the whole
                yield d, t, b + half // w
                if half % w:
                    yield d, t, b + half // w + 1
        return
    hits = []
    for table, pos, doc, at in found:
        count = table.count[at]
        entry = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count - table.first[at], count)
        hits.append((table.item[entry], table.at[entry], np.repeat(doc, count), np.repeat(pos, count)))
    item, j, doc, pos = (np.concatenate(x) for x in zip(*hits))
    pair = doc * len(ix.ids) + item
    _, back, n = np.unique(pair, return_inverse=True, return_counts=True)
    live = n[back] >= ix.bound[item]
    doc, item, pos, j = doc[live], item[live], pos[live], j[live]
    if not len(doc):
        return
    diagonal = pos - (ends - lengths)[doc] - j
    band = diagonal // ix.width[item]
    low = int(band.min()) - 1
    span = int(band.max()) - low + 1
    key = (doc * len(ix.ids) + item) * span + (band - low)
    key = np.concatenate([key, key - 1])
    once = np.unique(key * int(ix.m.max()) + np.concatenate([j, j])) // int(ix.m.max())
    keys, n = np.unique(once, return_counts=True)
    pair, band = keys // span, keys % span + low
    full = n >= ix.bound[pair % len(ix.ids)]
    for p, b in zip(pair[full].tolist(), band[full].tolist()):
        yield p // len(ix.ids), p % len(ix.ids), b


def _align(item: np.ndarray, k: int, width: int, found: list[tuple[np.ndarray, int]]) -> list[tuple[int, int]]:
    """(edits, end) of the best semi-global alignment of ``item`` in each (codes, band)."""
    m, span = len(item), 2 * width + 2 * k + 1
    low = np.array([b * width - k for _, b in found])
    seg = np.full((len(found), span + m + 1), _OUTSIDE, np.uint32)
    for r, (codes, _) in enumerate(found):
        a, z = max(0, low[r]), min(len(codes), low[r] + seg.shape[1])
        if z > a:
            seg[r, a - low[r]:z - low[r]] = codes[a:z]
    step = np.arange(span, dtype=np.int32)
    row = np.zeros((len(found), span), np.int32)
    for j in range(m):
        best = row + (seg[:, j:j + span] != item[j])
        best[:, :-1] = np.minimum(best[:, :-1], row[:, 1:] + 1)
        row = np.minimum.accumulate(best - step, axis=1) + step
    at = row.argmin(axis=1)
    return [(int(row[r, o]), int(low[r] + o + m)) for r, o in enumerate(at)]


def search(ix: ItemIndex, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
    """(row, item index, edits, region start, region end) of every leak; the region, in the
    normal text, holds the occurrence.  One per row and item: the one of fewest edits."""
    if not ix.ids:
        return []
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    inexact: set[tuple[int, int]] = set()  # row and item of which the text holds no exact occurrence
    group: list[tuple[int, str, np.ndarray, int]] = []
    held = 0

    def flush() -> None:
        open_: dict[int, list] = {}
        for d, t, b in _bands(ix, group):
            row, text, codes, off = group[d]
            m = int(ix.m[t])
            if best.get((row, t), (1,))[0] == 0:
                continue
            at = -1 if (row, t) in inexact else text.find(ix.texts[t])
            if at >= 0:
                best[row, t] = (0, at, at + m)
            elif ix.k[t]:
                inexact.add((row, t))
                open_.setdefault(t, []).append((row, codes, b, off, len(text)))
        for t, regions in open_.items():
            m, k = int(ix.m[t]), int(ix.k[t])
            for s in range(0, len(regions), 512):
                some = regions[s:s + 512]
                scores = _align(ix.codes[t], k, int(ix.width[t]), [(c, b) for _, c, b, _, _ in some])
                for (row, _, _, off, n), (edits, end) in zip(some, scores):
                    if edits <= k:
                        end = min(end + off, n)
                        new = (edits, max(0, end - m - edits), end)
                        best[row, t] = min(best.get((row, t), new), new)
        group.clear()

    for row, text in enumerate(texts):
        text = normal(text)
        if not text:
            continue
        codes, off = _codes(text), 0
        while True:
            piece = codes[off:off + PIECE + ix.overlap]
            group.append((row, text, piece, off))
            held += len(piece)
            if held >= PIECE:
                flush()
                held = 0
            off += PIECE
            if off >= len(codes):
                break
    if group:
        flush()
    return [(row, t, *v) for (row, t), v in sorted(best.items())]


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size, in the order of their ids."""
    block, size = [], 0
    rows = items.where("text is not null").select(F.col("item_id").cast("long"), "text").orderBy("item_id", "text")
    for r in rows.toLocalIterator():
        if block and size + len(r.text) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((r[0], r[1]))
        size += len(r[1])
    if block:
        yield block


def find_leaks(docs: DataFrame, items: DataFrame, q: int = Q, rate: float = RATE) -> DataFrame:
    """(doc_id, item_id, edits, region_start, region_end): one row per document and item found in it."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, edits int, region_start long, region_end long"
    out = spark.createDataFrame([], schema)
    for block in item_blocks(items):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ix = ItemIndex(shared.value, q, rate)
            for b in batches:
                ids = b.column(0).to_pylist()
                got = [(ids[r], ix.ids[t], e, s, z) for r, t, e, s, z in search(ix, b.column(1).to_pylist())]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[c] for g in got], kind) for c, kind in enumerate(kinds)],
                    ["doc_id", "item_id", "edits", "region_start", "region_end"])

        out = out.unionByName(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema))
    return out


def decontaminate(docs: DataFrame, items: DataFrame, q: int = Q, rate: float = RATE) -> DataFrame:
    """The rows of ``docs`` in which no item is found, in place: nothing is shuffled."""
    spark = docs.sparkSession
    at = docs.columns.index("text")
    for block in item_blocks(items):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ix = ItemIndex(shared.value, q, rate)
            for b in batches:
                clean = np.ones(b.num_rows, bool)
                clean[[g[0] for g in search(ix, b.column(at).to_pylist())]] = False
                yield b.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
