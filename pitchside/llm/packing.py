"""Best-fit packing of tokenised documents by best-two-fit.

A document is its token ids and an end id; one longer than the capacity is cut into pieces
of exactly the capacity, the first piece taking what is left over.

Method: a sequence is filled greedily with the longest unpacked pieces that fit; then its
smallest piece is replaced by the two unpacked pieces that fit the gap it leaves most
tightly, if they fill it better than it did (again while that helps; the first, longest
piece stays, so the long ones are used up first).  Pieces of one length are
interchangeable, so this runs on the counts per length, of which there are at most
``capacity`` whatever the corpus holds: a fill is a pattern of lengths, and one pattern is
repeated for as long as the choices that made it stay the same, which gives exactly the
sequences of the one-by-one loop.

Then every piece finds its place from its rank among the pieces of its length.  Ranks come
without a sort: a task numbers its pieces by length while it tokenises them and the written
table keeps task and number; the counts per (length, task) give the offsets.  Pieces are
dealt by (length, task), so a common length is spread over the tasks it came from.

Tokenising: a cut before a single space between two visible characters never lies inside a
token of a byte-level pre-tokeniser, so a very long text is encoded in pieces.  Strings of
special tokens in a text are ordinary text.

Edge cases: a null text is an empty one (its end id alone); repeated rows and rows without
id are documents of their own; no rows give no rows; only the named columns and the text are
read, so other columns can't clash.  Sequence ids are 0 .. n-1; which documents share a sequence
depends on how the rows lie in the files, the number of sequences does not.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import saved

#: Places where a text may be cut without touching a token, and the characters taken at once.
CUT = re.compile(r"(?<=\S)(?= \S)")
PIECE_CHARS = 1 << 20
#: Texts on which tiktoken's loop is slow (searched with a space put in front).
LONG = re.compile(r"\s(?:\S{500}|\s{100})")
#: Fixed value: the pattern by which byte-level pre-tokenisers cut a text.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# ------------------------------------------------------------- tokenising ---

class Encoder:
    """Token ids of texts, as little-endian unsigned 32-bit integers.

    The ids are those of ``tokenizers`` for the whole text.  Where the file is a byte-level
    BPE whose ids follow its merge order, the same vocabulary runs in tiktoken's merge loop,
    which gives the same ids in a quarter of the time; texts with very long words or gaps,
    on which that loop is slow, and files of any other kind go through ``tokenizers``.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        parts = json.loads(self.model.to_str())
        self.core = _merge_core(parts)

    def encode(self, text: str) -> np.ndarray:
        if self.core is None:
            return self._plain(text)
        out, at = [], 0
        while at < len(text):
            end = at + PIECE_CHARS
            stop = CUT.search(text, end) if end < len(text) else None
            end = stop.start() if stop else len(text)
            piece = text[at:end]
            out.append(self._plain(piece) if LONG.search(" " + piece) else self.core.encode_to_numpy(piece, disallowed_special=()))
            at = end
        return np.concatenate(out).astype("<u4") if out else np.zeros(0, "<u4")

    def _plain(self, text: str) -> np.ndarray:
        return np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")


def _merge_core(parts: dict):
    """The byte-level BPE described by a tokenizer file for tiktoken; None for other files."""
    before, model = parts["pre_tokenizer"] or {}, parts["model"]
    plain = parts["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True) \
        and not before["add_prefix_space"] and model["type"] == "BPE" \
        and not (model["dropout"] or model["continuing_subword_prefix"] or model["end_of_word_suffix"] or model.get("ignore_merges"))
    if not plain:
        return None
    # a printable byte is named by its own character, the others by the characters from 256 on
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    names = {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(sorted(set(range(256)) - set(printable)))}
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    single = [model["vocab"].get(name) for name in names]
    if None in single or merged != sorted(merged) or max(single) > min(merged, default=1 << 31):
        return None
    import tiktoken
    used = {*single, *merged}
    ranks = {bytes(names[c] for c in token): i for token, i in model["vocab"].items() if i in used}
    return tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def encoder(path: str) -> Encoder:
    """One per Python worker."""
    return Encoder(path)


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: full ones, the first taking the rest."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def _tokenize(path: str, end_id: int, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        names = None

        def flush(b: pa.RecordBatch, rows: list[int], pieces: list[tuple[int, int, int, int, int]], ids: list[np.ndarray]) -> pa.RecordBatch:
            piece, start, length, crc, nth = (np.array(c, np.int64) for c in zip(*pieces))
            arrays = [c.take(pa.array(rows)) for c in b.columns[:-1]]
            arrays += [pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc),
                       pa.array(np.full(len(rows), task, np.int32)), pa.array(nth)]
            if with_ids:
                offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32))))
            return pa.RecordBatch.from_arrays(arrays, names)

        for b in batches:
            names = [*b.schema.names[:-1], *PIECE.names, *(["ids"] if with_ids else [])]
            rows, pieces, ids, held = [], [], [], 0
            for row, text in enumerate(b.column("__text")):
                all_ids = np.append(encoder(path).encode(text.as_py() or ""), np.array([end_id], "<u4"))
                for piece, (start, length) in enumerate(piece_bounds(len(all_ids), capacity)):
                    part = all_ids[start:start + length]
                    rows.append(row)
                    pieces.append((piece, start, length, zlib.crc32(part.tobytes()), int(seen[length])))
                    seen[length] += 1
                    if with_ids:
                        ids.append(part)
                held += len(all_ids)
                if held > 1 << 21:
                    yield flush(b, rows, pieces, ids)
                    rows, pieces, ids, held = [], [], [], 0
            if rows:
                yield flush(b, rows, pieces, ids)

    return run


PIECE = T.StructType([
    T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("__task", T.IntegerType()), T.StructField("__nth", T.LongType())])


def tokenized_pieces(docs: DataFrame, keep: list[str], tokenizer: str, end_id: int, capacity: int, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``keep``, the fields of ``PIECE`` and, if asked for, ``ids``."""
    fields = [*docs.select(*keep).schema.fields, *PIECE.fields]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(
        _tokenize(tokenizer, end_id, capacity, with_ids), T.StructType(fields))


# ---------------------------------------------------------- best-two-fit ----

@dataclass
class Pattern:
    """``times`` sequences that hold ``use[length]`` pieces of each length."""
    use: dict[int, int]
    times: int


def best_two_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns that use up ``counts`` (pieces per length, 1 to ``capacity``)."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    lengths = sorted(length for length, n in counts.items() if n > 0)
    out = []
    while lengths:
        use, most = {}, {}  # pieces of this sequence, and the most of a length that it held at any time
        free = left.copy()

        def take(length: int, n: int) -> None:
            use[length] = use.get(length, 0) + n
            most[length] = max(most.get(length, 0), use[length])
            free[length] -= n

        def fill(gap: int) -> int:
            at = bisect_right(lengths, gap)
            while at and gap:
                at -= 1
                length = lengths[at]
                n = min(int(free[length]), gap // length)
                if n:
                    take(length, n)
                    gap -= n * length
                at = min(at, bisect_right(lengths, gap))
            return gap

        gap = fill(capacity)
        while gap and sum(use.values()) > 1:
            smallest = min(length for length, n in use.items() if n)
            pair = _tightest_pair(free, gap + smallest)
            if pair is None or sum(pair) <= smallest:
                break
            for length in pair:
                take(length, 1)
            use[smallest] -= 1
            free[smallest] += 1
            gap = fill(gap + smallest - sum(pair))
        use = {length: n for length, n in use.items() if n}
        times = min(int(left[length] - most[length]) // n + 1 for length, n in use.items())
        for length, n in use.items():
            left[length] -= n * times
            if not left[length]:
                lengths.remove(length)
        out.append(Pattern(use, times))
    return out


def _tightest_pair(free: np.ndarray, room: int) -> tuple[int, int] | None:
    """The two free lengths of the greatest sum up to ``room``; of equal sums the one with the longest piece."""
    room = min(room, 2 * (len(free) - 1))
    at = np.arange(len(free))
    below = np.maximum.accumulate(np.where(free > 0, at, 0))  # the longest free length up to each
    first = np.flatnonzero(free[:room] > 0)
    if not len(first):
        return None
    second = below[np.minimum(room - first, first)]
    alone = (second == first) & (free[first] < 2)
    second = np.where(alone, below[np.maximum(first - 1, 0)], second)
    first, second = first[second > 0], second[second > 0]
    if not len(first):
        return None
    best = np.flatnonzero(first + second == (first + second).max())[-1]
    return int(first[best]), int(second[best])


class Places:
    """Sequence and offset of a piece from its length and its rank among the pieces of that length."""

    def __init__(self, patterns: list[Pattern]):
        rows, taken, sequence = [], {}, 0
        for p in patterns:
            offset = 0
            for length in sorted(p.use, reverse=True):
                rank = taken.get(length, 0)
                rows.append((length, rank, p.times, sequence, offset))
                taken[length] = rank + p.use[length] * p.times
                offset += length * p.use[length]
            sequence += p.times
        self.sequences = sequence
        self.length, self.rank, self.times, self.sequence, self.offset = (
            np.array(c, np.int64) for c in zip(*sorted(rows))) if rows else (np.zeros(0, np.int64),) * 5
        # one growing key for both: ranges of a length start at its own base
        self.size = max(taken.values(), default=0) + 1
        self.base = {length: i for i, length in enumerate(sorted(taken))}
        self.key = np.array([self.base[length] for length in self.length.tolist()], np.int64) * self.size + self.rank

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bases = np.zeros(int(max(self.base, default=0)) + 1, np.int64)
        for known, i in self.base.items():
            bases[known] = i
        at = np.searchsorted(self.key, bases[length] * self.size + rank, "right") - 1
        copy, nth = np.divmod(rank - self.rank[at], self.times[at])
        return self.sequence[at] + nth, self.offset[at] + copy * length


def _place(places: Places):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sequence, offset = places.find(b.column("length").to_numpy(), b.column("__rank").to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sequence), pa.array(offset)],
                                             [*b.schema.names[:-1], "sequence_id", "offset"])

    return run


def pack_documents(docs: DataFrame, tokenizer: str, keep: list[str], end_id: int, capacity: int = 1024, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``keep``, piece, start, length, ids_crc32, ``ids`` if asked for, sequence_id, offset."""
    pieces = saved(tokenized_pieces(docs, keep, tokenizer, end_id, capacity, with_ids), "pieces")
    per_task = pieces.groupBy("length", "__task").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("length").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = saved(per_task.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))), "length-offsets")
    counts = {r[0]: r[1] for r in offsets.groupBy("length").agg(F.sum("__n")).collect()}  # at most ``capacity`` rows
    places = Places(best_two_fit(counts, capacity))
    ranked = pieces.join(offsets.drop("__n"), ["length", "__task"]).withColumn("__rank", F.col("__before") + F.col("__nth"))
    out = [c for c in pieces.columns if not c.startswith("__")]
    ranked = ranked.select(*out, "__rank")
    schema = T.StructType([*ranked.schema.fields[:-1], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(_place(places), schema)
