"""Vector code compression: product codes whose nearest entries are found by slice-and-intersect bitmasks.

Components become integers floor(256 * x); a vector is cut into ``parts`` equal consecutive
parts, and each part is replaced by the index of the nearest of at most ``entries``
entries (squared Euclidean distance, ties to the lower index).  A part's codebook starts
as that part of the ``entries`` smallest vec_ids; each of ``rounds`` rounds assigns every
part and replaces each entry by its parts' mean, floored; unused entries stay.

Nearest entry: per dimension the entries' coordinates are sorted once, and the k-th prefix
mask holds the bits of the first k entries.  A radius r selects a range of the sorted
coordinates in each dimension; the exclusive or of its two prefix masks (one holds the
other) is the set of entries in that slice, and the AND of the slices is the set in the
box of radius r, as one uint64.  Distances are computed for its bits only.  If the best is
within r it is the nearest, with all ties, as every entry as near lies in the box;
otherwise the box is drawn again with the best distance, or with twice the radius where it
was empty.  The initial radius is the codebook's median distance between neighbours.  All
arithmetic is in integers.

At scale: vectors are never shuffled; a round sends one sum per entry and dimension per
task, and what reaches the driver is the codebooks (entries x dimensions integers) and the
first ``entries`` vectors.  Errors per label are partial sums joined back with hot labels split.

Edge cases: vectors that are null or hold a null or non-finite component are dropped.  The
codebooks are for the length that most vectors have (ties: the longer one); vectors of another
length, and all if it can't be cut into equal parts, get a null code and error.  Integers
saturate at +-2**27 so that sums stay exact.  Rows with a null vec_id don't start a codebook
(unless no row has one); rows that share a vec_id are vectors of their own; null labels count
as one label; no rows give no rows; other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import attach_per_key
from .common import saved

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE, LIMIT = 256, 1 << 27
#: Vectors searched at once.
ROWS = 4096


class Slices:
    """The nearest of up to 64 entries of one part, by bitmasks."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        n, dims = entries.shape
        if n > 64:
            raise ValueError("a mask holds 64 entries")
        self.order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, self.order, axis=0)
        bits = np.uint64(1) << self.order.astype(np.uint64)
        self.prefix = np.zeros((n + 1, dims), np.uint64)
        np.bitwise_or.accumulate(bits, axis=0, out=self.prefix[1:])
        self.all = self.prefix[n, 0] if dims else np.uint64((1 << n) - 1)
        apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        np.fill_diagonal(apart, np.iinfo(np.int64).max)
        near = np.median(apart.min(axis=1)) if n > 1 else 1
        self.radius = int(np.sqrt(near)) + 1

    def box(self, part: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """The mask of the entries within ``radius`` of each row in every dimension."""
        mask = np.full(len(part), self.all)
        for d in range(part.shape[1]):
            low = np.searchsorted(self.sorted[:, d], part[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[:, d], part[:, d] + radius, "right")
            mask &= self.prefix[low, d] ^ self.prefix[high, d]
        return mask

    def nearest(self, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row."""
        index, best = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
        open_, radius = np.arange(len(part)), np.full(len(part), self.radius, np.int64)
        while len(open_):
            mask = self.box(part[open_], radius)
            bits = np.unpackbits(mask.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, entry = np.nonzero(bits)
            away = ((part[open_[row]] - self.entries[entry]) ** 2).sum(axis=1)
            order = np.lexsort((entry, away, row))  # the first of each row: nearest, then lowest
            row, entry, away = row[order], entry[order], away[order]
            first = np.flatnonzero(np.diff(row, prepend=-1))
            row, entry, away = row[first], entry[first], away[first]
            sure = away <= radius[row] ** 2
            index[open_[row[sure]]], best[open_[row[sure]]] = entry[sure], away[sure]
            radius *= 2  # empty boxes; the radius is at least 1
            radius[row] = np.ceil(np.sqrt(away)).astype(np.int64) + 1
            left = np.ones(len(open_), bool)
            left[row[sure]] = False
            open_, radius = open_[left], radius[left]
        return index, best


def integers(vec: pa.Array, dims: int) -> np.ndarray:
    """The rows of a list column of length ``dims`` as integer components."""
    flat = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.clip(np.floor(flat * SCALE), -LIMIT, LIMIT).astype(np.int64).reshape(len(vec), dims)


def _assigned(vec: pa.Array, books: list[Slices], dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(components, code (rows, parts), error) of whole-length vectors."""
    rows = integers(vec, dims)
    width = dims // len(books)
    found = [book.nearest(rows[:, p * width:(p + 1) * width]) for p, book in enumerate(books)]
    return rows, np.stack([i for i, _ in found], axis=1), sum(e for _, e in found)


def _part_sums(books: np.ndarray):
    """Vectors -> per task, (slot, total, n): sum and count for every (part, entry, position)."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Slices(b) for b in books]
        total, count = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for b in batches:
            for s in range(0, b.num_rows, ROWS):
                rows, code, _ = _assigned(b.column("vec").slice(s, ROWS), search, parts * width)
                for p in range(parts):
                    count[p] += np.bincount(code[:, p], minlength=entries)
                    for w in range(width):  # sums stay under 2**53
                        total[p, :, w] += np.bincount(code[:, p], rows[:, p * width + w], entries).astype(np.int64)
        used = np.flatnonzero(np.repeat(count.ravel(), width))
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total.ravel()[used]),
                                              pa.array(np.repeat(count.ravel(), width)[used])], ["slot", "total", "n"])

    return run


def _codes(books: np.ndarray, dims: int):
    """(vec_id, label, vec) -> (vec_id, label, code, error)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Slices(b) for b in books]
        for b in batches:
            for s in range(0, b.num_rows, ROWS):
                some = b.slice(s, ROWS)
                vec = some.column("vec")
                whole = np.flatnonzero(vec.value_lengths().to_numpy() == dims) if len(search) else np.zeros(0, np.int64)
                code, error = np.full(len(vec), None, object), np.zeros(len(vec), np.int64)
                missing = np.ones(len(vec), bool)
                if len(whole):
                    _, index, error[whole] = _assigned(vec.take(pa.array(whole)), search, dims)
                    code[whole] = [bytes(row).hex() for row in index.astype(np.uint8)]
                    missing[whole] = False
                yield pa.RecordBatch.from_arrays([some.column("vec_id"), some.column("label"), pa.array(code, pa.string()),
                                                  pa.array(error, mask=missing)], ["vec_id", "label", "code", "error"])

    return run


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vec) of the rows whose vector holds finite numbers only."""
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vec"))
    return rows.where(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def train_codebooks(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts, entries, positions) for the commonest length among ``kept`` (see
    :func:`usable_vectors`); no parts where there is none that can be cut."""
    common = kept.groupBy(F.size("vec").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    if common is None or common.dims % parts:
        return np.zeros((0, 0, 0), np.int64)
    whole = kept.where(F.size("vec") == common.dims).select("vec_id", "vec")
    start = whole.orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(entries).select("vec").toArrow().column("vec")
    books = integers(start.combine_chunks(), common.dims).reshape(len(start), parts, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        sums = whole.select("vec").mapInArrow(_part_sums(books), "slot long, total long, n long").groupBy("slot").agg(
            F.sum("total").alias("total"), F.sum("n").alias("n")).toArrow()  # at most entries * dims rows
        flat = books.reshape(-1)
        flat[sums.column("slot").to_numpy()] = sums.column("total").to_numpy() // sums.column("n").to_numpy()
    return books


def compress_vectors(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every usable vector, and the codebooks."""
    kept = usable_vectors(vectors)
    books = train_codebooks(kept, parts, entries, rounds)
    schema = T.StructType([*kept.schema.fields[:2], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    return kept.mapInArrow(_codes(books, books.shape[0] * books.shape[2]), schema), books


def books_text(books: np.ndarray) -> str:
    """All components by part, entry and position."""
    return ",".join(map(str, books.ravel().tolist()))


def compression_report(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every usable vector."""
    coded, books = compress_vectors(vectors, parts, entries, rounds)
    coded = saved(coded.withColumn("__label", F.to_json(F.struct("label"))), "codes")  # never null
    errors = saved(coded.groupBy("__label").agg(F.try_sum("error").alias("label_error"), F.count(F.lit(1)).alias("__n")), "label-errors")
    out = attach_per_key(coded, errors, ["__label"], "__n")
    digest = hashlib.sha256(books_text(books).encode()).hexdigest()
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


ORACLE_SQL = """
with kept as materialized (
  select row_number() over (order by vec_id) - 1 as rid, vec_id, label, embedding from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), comp as materialized (
  select rid, d // (n // 16) as part, d % (n // 16) as pos, cast(floor(256 * cast(x as double)) as bigint) as v
  from (select rid, len(embedding) as n, unnest(embedding) as x, unnest(range(len(embedding))) as d from kept)
), book0 as materialized (select part, rid as entry, pos, v from comp where rid < 64)
""" + "".join(f"""
, near{r} as materialized (
  select rid, part, min(away * 64 + entry) % 64 as entry, min(away) as away from (
    select c.rid, c.part, b.entry, sum((c.v - b.v) * (c.v - b.v)) as away
    from comp c join book{r} b on c.part = b.part and c.pos = b.pos group by all) group by all
)""" + (f"""
, mean{r} as (
  select part, entry, pos, sum(v) as total, count(*) as n from comp join near{r} using (rid, part) group by all
), book{r + 1} as materialized (
  select b.part, b.entry, b.pos, cast(coalesce((m.total - ((m.total % m.n) + m.n) % m.n) // m.n, b.v) as bigint) as v
  from book{r} b left join mean{r} m on b.part = m.part and b.entry = m.entry and b.pos = m.pos
)""" if r < ROUNDS else "") for r in range(ROUNDS + 1)) + f"""
, coded as (
  select rid, string_agg(format('{{:02x}}', entry), '' order by part) as code, cast(sum(away) as bigint) as error
  from near{ROUNDS} group by rid
), digest as (
  select sha256(string_agg(cast(v as varchar), ',' order by part, entry, pos)) as codebooks_sha256 from book{ROUNDS}
)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from coded join kept using (rid), digest
"""
