"""Suffix-array dedup: every byte covered by a string of ``length`` bytes that also
starts elsewhere is removed.

The difference-cover algorithm runs on a sparse string.  All byte suffixes of 100 TB
can't be sorted (2/3 of all bytes as triples are many times the input), so each text
is sampled where its content says so and the rest is merged in at the end:

1. *Sample.*  Positions whose ``K``-byte hash is the least of some window of ``W``
   are anchors; equal strings have equal anchors but near their ends.  A suffix is
   sampled ``W - 1`` bytes before each anchor.  Its symbol is the hash of its first
   ``length - W + 1`` bytes.  Whatever repeats for ``length`` bytes from p repeats the
   symbol of the first sample c >= p, so symbols that occur once are dropped.
2. *Sort sampled triples, recurse on names.*  :func:`suffix_ranks` sorts the suffixes
   of the symbol strings by the difference cover {1, 2} mod 3: triples are sorted and
   named, the strings of names are sorted by recursion (until names span all that a
   comparison needs), and the remaining suffixes are merged by (symbol, rank of the
   next).  Equal triples are named once per distinct triple, so a passage that a third
   of all texts share never gathers in a task.
3. *Compare adjacent prefixes.*  Neighbours in that order which agree on enough
   symbols to span ``length`` bytes beyond the next sample prove that every byte
   suffix from this sample to the next repeats.
4. *Merge the remaining byte suffixes*: those before a sample that 3 leaves open.
   They are decided in blocks of ``W``, then ``FINE``, then one byte: a block whose
   union of strings repeats is decided whole, one whose common core doesn't is
   decided too, and only the rest goes on.  The last step is exact, by 128 bits.

Equal texts count once; a text with a copy and ``length`` bytes or more goes whole.

Edge cases: null and empty texts have no bytes; texts under ``length`` bytes neither
lose bytes nor match; a string may overlap its own copy; repeated rows of a doc_id
are copies of each other; null ids are rows like any other; no rows give no rows;
other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, sorted_totals, temporary

LENGTH = 400
FINE = 16
#: Bytes of a text hashed at once.
PIECE = 1 << 21

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def grid(length: int) -> tuple[int, int]:
    """(K, W): bytes hashed at an anchor and the window; all windows of the first anchor that
    equal strings of ``length`` bytes have at ``W - 1`` or later lie inside them."""
    k = max(2, min(16, length // 8))
    return k, max(1, min(128, (length + 3 - k) // 3))


class Rolling:
    """Hashes of any substrings of a text, from prefix sums (mod 2 ** 64)."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    _byte = [np.random.default_rng(which).integers(1 << 62, 1 << 63, 256, np.uint64) for which in range(len(_BASES))]

    def __init__(self, data: np.ndarray, which: int = 0):
        size = 1 << max(12, len(data).bit_length())
        if which not in self._powers or len(self._powers[which][0]) < size:
            base = _BASES[which]
            inverse = pow(base, -1, 1 << 64)
            self._powers[which] = tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, x, np.uint64)])) for x in (base, inverse))
        self.up, down = self._powers[which]
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self._byte[which][data] * down[:len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, size) -> np.ndarray:
        return self._mixed((self.sums[start + size] - self.sums[start]) * self.up[start])

    def every(self, size: int) -> np.ndarray:
        n = max(len(self.sums) - size, 0)
        return self._mixed((self.sums[size:] - self.sums[:n]) * self.up[:n])

    @staticmethod
    def _mixed(h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(32))) * _MIX
        return h ^ (h >> np.uint64(29))


def _extreme(v: np.ndarray, w: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every window of ``w``."""
    size = 1
    while 2 * size <= w:
        v, size = pick(v[:-size], v[size:]), 2 * size
    return pick(v[:len(v) - (w - size)], v[w - size:])


def samples(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, symbols) of the sampled suffixes of a text."""
    k, w = grid(length)
    n, side, span = len(text), w - 1, length - w + 1
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    none = np.zeros(side, np.uint64)
    found = []
    for s in range(0, n, PIECE):  # anchors from s to s + PIECE, with all that decides them
        start = max(0, s - side)
        hashes = Rolling(np.frombuffer(text[start:s + PIECE + side + k + span], np.uint8))
        g = hashes.every(k)
        if len(g) < w:
            continue
        least = _extreme(g, w, np.minimum)
        at = np.flatnonzero(g == _extreme(np.concatenate([none, least, none]), w, np.maximum))
        at = at[(at + start >= s) & (at + start < s + PIECE)] - side
        at = at[(at >= 0) & (at + start + span <= n)]
        found.append((at + start, ((hashes(at, span) >> np.uint64(1)) | np.uint64(1)).astype(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*found))


def _parse(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tid, pos, sym = [], [], []
            for t, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                p, s = samples(text, length)
                if len(p):
                    tid.append(t)
                    pos.append(p.astype(np.int32))
                    sym.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(tid, pa.int64()), pa.array(pos, pa.list_(pa.int32())),
                                              pa.array(sym, pa.list_(pa.int64()))], ["tid", "pos", "sym"])

    return run


def _strings(length: int):
    """Repeated symbols of a text, in order -> runs of neighbours: (tid, pos, sym, m, v).

    m: how many symbols from here span ``length`` bytes beyond the next sample (0: the run ends
    before), v: the hash of them and of their distances, which the symbols don't settle.
    """
    left = grid(length)[1] - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for tid, marks in zip(b.column(0).to_pylist(), b.column(1)):
                at, pos, sym = (marks.values.field(f).to_numpy() for f in ("i", "pos", "sym"))
                cuts = np.flatnonzero(np.diff(at) != 1) + 1
                for p, s in zip(np.split(pos.astype(np.int64), cuts), np.split(sym, cuts)):
                    m = np.zeros(len(p), np.int64)
                    last = np.searchsorted(p, p[1:] + left)
                    m[:-1] = np.where(last < len(p), last - np.arange(len(p) - 1) + 1, 0)
                    v = np.zeros(len(p), np.uint64)
                    for step in range(int(m.max())):
                        on = np.flatnonzero(m > step)
                        v[on] = (v[on] ^ s[on + step].view(np.uint64)) * _MIX + (p[on + step] - p[on]).astype(np.uint64)
                        v[on] ^= v[on] >> np.uint64(29)
                    for o, x in zip(out, (tid, p.astype(np.int32), s, m.astype(np.int32), v.view(np.int64))):
                        o.append(x)
            kinds = (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(o, kind) for o, kind in zip(out, kinds)], ["tid", "pos", "sym", "m", "v"])

    return run


def _sizes(lists: pa.Array) -> np.ndarray:
    return lists.value_lengths().fill_null(0).to_numpy().astype(np.int64)


def _suffix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strings with the ranks of their sampled suffixes -> a row per suffix: its type (place mod 3),
    own rank, first two symbols and the ranks of the next two suffixes (0: none)."""
    names = ["sid", "i", "t", "own", "s0", "s1", "n1", "n2"]
    for b in batches:
        n, known = _sizes(b.column(1)), _sizes(b.column(2))
        start = np.cumsum(n + 2) - (n + 2)  # every string has two empty places at its end
        i = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(start, n) + i
        s, r = np.zeros(int((n + 2).sum()), np.int64), np.zeros(int((n + 2).sum()), np.int64)
        s[at] = b.column(1).flatten().to_numpy()
        ranks = b.column(2).flatten()
        r[np.repeat(start, known) + ranks.field("i").to_numpy()] = ranks.field("r").to_numpy()
        cols = (np.repeat(b.column(0).to_numpy(), n), i.astype(np.int32), (i % 3).astype(np.int32), r[at], s[at], s[at + 1], r[at + 1], r[at + 2])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names)


def suffix_ranks(strings: DataFrame, need: int, depth: int = 1) -> DataFrame:
    """(sid, i, r): for every suffix of the strings (sid, sym array of numbers over 0), the
    number of suffixes that come before it.

    Suffixes that agree on ``need`` symbols may tie; the end of a string comes first.
    """
    with temporary(strings.sparkSession):
        at = lambda k: F.coalesce(F.get("sym", F.col("i") + k), F.lit(0)).alias(f"s{k}")
        triple = ["s0", "s1", "s2"]
        sample = strings.select("sid", "sym", F.posexplode("sym").alias("i", "s")).where("i % 3 <> 0").select("sid", "i", at(0), at(1), at(2))
        distinct = saved(sample.groupBy(*triple).agg(F.count(F.lit(1)).alias("n")), "triples")
        names = sorted_totals(distinct, triple, ["n"]).select(*triple, (F.col("before_n") + 1).alias("name"))
        named = saved(sample.join(names.hint("shuffle_hash"), triple).select("sid", "i", "name"), "named")
        most = distinct.agg(F.max("n")).first()[0]
        if most is None or most == 1 or 3 * depth >= need:
            ranks = named.select("sid", "i", F.col("name").alias("r"))
        else:
            sub = named.groupBy((F.col("sid") * 2 + F.col("i") % 3 - 1).alias("sid")).agg(
                F.transform(F.sort_array(F.collect_list(F.struct("i", "name"))), lambda x: x["name"]).alias("sym"))
            deeper = suffix_ranks(saved(sub, "names-string"), need, 3 * depth)
            ranks = deeper.select(F.shiftright("sid", 1).alias("sid"),
                                  (3 * F.col("i") + F.col("sid").bitwiseAND(F.lit(1)) + 1).cast("int").alias("i"), (F.col("r") + 1).alias("r"))
        own = ranks.groupBy("sid").agg(F.collect_list(F.struct("i", "r")).alias("ranks"))
        rows = saved(strings.select("sid", "sym").join(own, "sid", "left").select("sid", "sym", "ranks").mapInArrow(
            _suffix_rows, "sid long, i int, t int, own long, s0 long, s1 long, n1 long, n2 long"), "suffixes")

        def merged(other: int, keys: list[str], of_zero: list[str]) -> DataFrame:
            """Suffixes of type 0 and ``other`` in one order, by a key that both have."""
            some = rows.where(F.col("t").isin(0, other))
            kinds = some.groupBy(*keys).agg(F.sum((F.col("t") == 0).cast("long")).alias("zero"),
                                            F.sum((F.col("t") == other).cast("long")).alias("other"))
            order = sorted_totals(saved(kinds, "kinds"), keys, ["zero", "other"]).drop("zero", "other")
            before = sum((F.col(f"before_{w}") for w in of_zero), F.lit(0))
            return some.join(order.hint("shuffle_hash"), keys).select("sid", "i", F.when(F.col("t") == 0, before)
                                                 .otherwise(F.col("own") - 1 + F.col("before_zero")).alias("part"))

        parts = merged(1, ["s0", "n1"], ["zero", "other"]).unionByName(merged(2, ["s0", "s1", "n2"], ["other"]))
        return saved(parts.groupBy("sid", "i").agg(F.sum("part").alias("r")), "ranks", keep=True)


def covered_samples(strings: DataFrame, need: int) -> DataFrame:
    """(sid, i) of the samples of which a neighbour in the suffix order shares the m symbols."""
    with temporary(strings.sparkSession):
        ranks = suffix_ranks(strings.select("sid", "sym"), need)
        keyed = strings.select("sid", F.posexplode(F.arrays_zip("m", "v")).alias("i", "x")).where("x.m > 0").select("sid", "i", "x.v")
        keyed = saved(keyed.join(ranks, ["sid", "i"]), "prefixes")
        entries = saved(keyed.groupBy("r", "v").agg(F.count(F.lit(1)).alias("n")).withColumn("one", F.lit(1).cast("long")), "entries")
        order = saved(sorted_totals(entries, ["r", "v"], ["one"]).select("r", "v", "n", F.col("before_one").alias("place")), "places")
        near = order.select((F.col("place") + 1).alias("place"), F.col("v").alias("near_v"))
        equal = saved(order.join(near, "place").where("v = near_v").select("place"), "equal-neighbours")
        shared = order.where("n > 1").select("place").unionByName(equal).unionByName(equal.select((F.col("place") - 1).alias("place"))).distinct()
        return saved(keyed.join(order.join(shared, "place").select("r", "v").hint("shuffle_hash"), ["r", "v"]).select("sid", "i"), "covered", keep=True)


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tid, pos, sym, covered) of strings -> (tid, pos, sym, open, until): open: the byte suffixes before
    the sample are undecided; until: those from the sample up to there repeat (-1: none shown)."""
    for b in batches:
        n, hits = _sizes(b.column(1)), _sizes(b.column(3))
        pos, sym = b.column(1).flatten().to_numpy(), b.column(2).flatten()
        on = np.zeros(len(pos), bool)
        on[np.repeat(np.cumsum(n) - n, hits) + b.column(3).flatten().to_numpy()] = True
        # the last sample of a string is never covered, so neighbours in the arrays are neighbours in a string
        until = np.where(on, np.append(pos[1:], -1)[:len(pos)], -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(b.column(0).to_numpy(), n)), pa.array(pos), sym,
            pa.array(~np.append(False, on[:-1])[:len(pos)]), pa.array(until)], ["tid", "pos", "sym", "open", "until"])


_BLOCK_SCHEMA = "core long, h1 long, h2 long, tid long, last int, low int, high int, new int"


def _blocks(length: int, span: int, size: int):
    """Texts with places -> the blocks of ``size`` string starts that make up the ``span`` starts up to each
    place.  ``last`` is a block's last start; low and high are its starts that the text has room for.
    core: hash of what all its strings share, so of a whole block whatever the room; h1, h2: of their union;
    new: 1, or 0 if another block of the text is the same place, so that a union's sum counts its places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tid, text, asked in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                n, places = len(text.as_buffer()), asked.values.to_numpy().astype(np.int64)
                every = np.unique((places[:, None] - np.arange(0, span, size)[None, :]).ravel())
                every = every[(every >= 0) & (every - size + 1 <= n - length)]
                seen = (-1, -1)
                for last in np.split(every, np.flatnonzero(np.diff(every // PIECE)) + 1) if len(every) else []:
                    start = max(0, int(last[0]) - size + 1)
                    data = np.frombuffer(text.as_buffer()[start:int(last[-1]) + 2 * length], np.uint8)
                    one, two = Rolling(data, 0), Rolling(data, 1)
                    low, high = np.maximum(last - size + 1, 0), np.minimum(last, n - length)
                    new = (low != np.append(seen[0], low[:-1])) | (high != np.append(seen[1], high[:-1]))
                    seen = (low[-1], high[-1])
                    core = one(last - start, length - size + 1) if size > 1 else np.zeros(len(last), np.uint64)
                    width = (high - low).astype(np.uint64)
                    h1 = one(low - start, length + high - low) ^ (width * _MIX)
                    h2 = two(low - start, length + high - low) ^ width
                    yield pa.RecordBatch.from_arrays([
                        *(pa.array(x.view(np.int64)) for x in (core, h1, h2)), pa.array(np.full(len(low), tid)),
                        *(pa.array(x.astype(np.int32)) for x in (last, low, high, new))],
                        ["core", "h1", "h2", "tid", "last", "low", "high", "new"])

    return run


def _removal(length: int):
    """(digest, text, copies, spans of repeated starts) -> what is removed of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], []]
            for digest, text, copies, spans in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)):
                removed = np.zeros((0, 2), np.int64)
                if copies > 1 and len(text) >= length:
                    removed = np.array([[0, len(text)]])
                elif spans.is_valid:
                    low, high = (spans.values.field(f).to_numpy().astype(np.int64) for f in ("low", "high"))
                    order = np.argsort(low, kind="stable")
                    low, end = low[order], np.maximum.accumulate(high[order] + length)
                    first = np.flatnonzero(np.append(True, low[1:] > end[:-1]))
                    removed = np.stack([low[first], end[np.append(first[1:] - 1, len(end) - 1)]], axis=1)
                kept, at = hashlib.sha256(), 0
                for a, z in removed.tolist():
                    kept.update(text[at:a])
                    at = z
                kept.update(text[at:])
                for o, x in zip(out, (digest, int((removed[:, 1] - removed[:, 0]).sum()), len(removed), kept.hexdigest())):
                    o.append(x)
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(o, k) for o, k in zip(out, kinds)], ["digest", "n_removed", "n_spans", "kept_sha256"])

    return run


def repeated_starts(texts: DataFrame, length: int) -> DataFrame:
    """(tid, low, high): intervals of byte positions from which ``length`` bytes repeat;
    ``texts`` (tid, text) are distinct texts of ``length`` bytes or more."""
    with temporary(texts.sparkSession):
        w = grid(length)[1]
        with temporary(texts.sparkSession):
            parsed = saved(texts.select("tid", "text").mapInArrow(_parse(length), "tid long, pos array<int>, sym array<long>"), "parsed")
            repeated = saved(parsed.select(F.explode("sym").alias("sym")).groupBy("sym").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("sym"),
                             "repeated")
            marks = parsed.select("tid", F.posexplode(F.arrays_zip("pos", "sym")).alias("i", "x")).select("tid", "i", "x.pos", "x.sym").join(repeated, "sym")
            marks = marks.groupBy("tid").agg(F.sort_array(F.collect_list(F.struct("i", "pos", "sym"))).alias("marks"))
            strings = saved(marks.mapInArrow(_strings(length), "tid long, pos array<int>, sym array<long>, m array<int>, v array<long>")
                            .withColumn("sid", F.monotonically_increasing_id()), "strings", keep=True)
        need = strings.agg(F.max(F.array_max("m"))).first()[0] or 0
        covered = covered_samples(strings, need).groupBy("sid").agg(F.collect_list("i").alias("covered"))
        state = saved(strings.join(covered, "sid", "left").select("tid", "pos", "sym", "covered").mapInArrow(
            _open, "tid long, pos int, sym long, open boolean, until int"), "samples")
        found = [state.where("until >= 0").select("tid", F.col("pos").alias("low"), F.col("until").alias("high"))]

        wanted = saved(state.where("open").select("sym").distinct(), "open-symbols")
        asked = state.join(wanted, "sym").select("tid", F.col("pos").alias("last"))
        sizes = [w, FINE, 1] if w > FINE else [w, 1]
        for span, size in zip([w, *sizes], sizes):
            lists = asked.groupBy("tid").agg(F.collect_set("last").alias("asked")).hint("shuffle_hash")  # texts needn't be sorted
            rows = saved(texts.select("tid", "text").join(lists, "tid").select("tid", "text", "asked")
                         .mapInArrow(_blocks(length, span, size), _BLOCK_SCHEMA), f"blocks-{size}")
            # any block stands for its union; numbers only, for these aggregate by hash
            unions = saved(rows.groupBy("core", "h1", "h2").agg(
                F.sum("new").alias("places"), F.first("tid").alias("tid"), F.first("last").alias("last")), f"unions-{size}")
            twice = unions.groupBy("h1", "h2").agg(F.sum("places").alias("places")).where("places > 1").select("h1", "h2")
            found.append(rows.join(saved(twice, f"twice-{size}"), ["h1", "h2"]).select("tid", "low", "high"))
            if size == 1:
                break
            # cores shared by different unions, one of them single: look closer at one block of each union
            cores = saved(unions.groupBy("core").agg(F.count(F.lit(1)).alias("unions"), F.min("places").alias("least"))
                          .where("unions > 1 and least <= 1").select("core"), f"cores-{size}")
            asked = unions.join(cores, "core").select("tid", "last")
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        return saved(out, "repeated-starts", keep=True)


def removed_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", text.alias("text")).withColumn("digest", F.unhex(F.md5("text")))
    with temporary(docs.sparkSession):
        texts = saved(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.first("text").alias("text"))
                      .withColumn("tid", F.monotonically_increasing_id()), "texts")  # written, so a tid is one text's for good
        starts = repeated_starts(texts.where(F.octet_length("text") >= length), length)
        spans = starts.groupBy("tid").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
        result = saved(texts.join(spans.hint("shuffle_hash"), "tid", "left").select("digest", "text", "copies", "spans").mapInArrow(
            _removal(length), "digest binary, n_removed long, n_spans long, kept_sha256 string"), "removed", keep=True)
    return rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest").join(result, "digest").select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
