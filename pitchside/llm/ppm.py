"""Language-model scoring by prediction by partial matching with symbol exclusion.

The model is a trie of byte contexts of order 0 to ``ORDER`` over the training
documents, with an end-of-text symbol.  A symbol seen ``c`` times after a context
(``t`` symbols, ``d`` different ones) has probability ``c / (t + d)``; a new one pays
the escape ``d / (t + d)`` and is looked for one order lower, where all symbols of
the longer context are excluded from ``t`` and ``d``; at last the symbols never seen
share equally.  A document's score is the log10 probability of its bytes (A-Z
lowered) and its end.  Beside it stands an add-one unigram score of its words.

Nothing of the model passes through the driver or a broadcast but four sums:

1. Each task counts its longest strings and words; Spark sums them.  Shorter strings
   and the statistics of all contexts follow by grouped sums and one join per order:
   the exclusions after an escape depend on the longer context alone, so each context
   keeps the ``t`` and ``d`` that remain at its suffix.
2. Documents are dealt into chunks of about ``CHUNK`` bytes.  A chunk asks for the
   distinct strings and words in it (so a key has at most one row per chunk, and
   copies in a chunk cost nothing), a join answers, and the chunk is scored with its
   answers.

Edge cases: null texts are empty; an empty text is its end alone; with no training
rows every symbol has probability 1/257 and every word 1 / (0 + 0 + 1); a null id is
not held out and trains; repeated rows train as often as they stand and score alike;
other columns are never read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import KeyTable, saved, word_lists

ORDER = 4
CHUNK = 12_000_000
PIECE = 1 << 19
END = 256  # also stands before the text
BITS = 9
#: Kind of a key: 0 a word, else 1 + the number of symbols of the string.
WORD = 0


def _mask(n: int) -> np.uint64:
    return np.uint64((1 << BITS * n) - 1)


def string_pieces(text: bytes, order: int = ORDER) -> Iterator[np.ndarray]:
    """For every symbol (the bytes, then the end), it and the ``order`` before it as one number."""
    for s in range(0, len(text) + 1, PIECE):
        last = s + PIECE > len(text)
        before = np.frombuffer(text[max(0, s - order):s], np.uint8)
        own = np.frombuffer(text[s:s + PIECE].lower(), np.uint8)
        raw = np.concatenate([np.full(order - len(before), END), np.frombuffer(before.tobytes().lower(), np.uint8), own,
                              np.full(int(last), END)]).astype(np.uint64)
        n = len(raw) - order
        g = raw[order:].copy()
        for back in range(1, order + 1):
            g |= raw[order - back:order - back + n] << np.uint64(BITS * back)
        yield g


def distinct(keys: np.ndarray) -> np.ndarray:
    """The different keys in order; sorts ``keys`` in place, several times as fast as a hash set of them."""
    keys.sort()
    return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys


def word_key(word: bytes) -> int:
    h = xxhash.xxh64_intdigest(word, 42)
    return h - (1 << 64) if h >> 63 else h


def _rows(kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.view(np.int64)),
                                       pa.array(n, pa.int64())], ["kind", "key", "n"])


def _count(order: int):
    """Texts -> (kind, key, n) of the words and the longest strings of a few MB at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                yield _rows(1 + order + 1, *np.unique(np.concatenate(held), return_counts=True))
                held.clear()
            if words:
                keys = np.array([word_key(w) for w in words], np.int64)
                yield _rows(WORD, keys, np.fromiter(words.values(), np.int64, len(words)))
                words.clear()

        size = 0
        for b in batches:
            for text in b.column(0).to_pylist():
                for g in string_pieces(text or b"", order):
                    held.append(g)
                    size += len(g)
                    if size >= 6 * PIECE:
                        yield _rows(1 + order + 1, *np.unique(np.concatenate(held), return_counts=True))
                        held.clear()
                        size = 0
                for some in word_lists(text or b""):
                    words.update(some)
                if len(words) > 400_000:
                    yield from flush()
                    size = 0
        yield from flush()

    return run


def build(docs: DataFrame, order: int = ORDER) -> tuple[DataFrame, DataFrame, dict]:
    """(words, nodes, sums) of the training rows ``docs`` (text as bytes).

    words: (kind, key, c).  nodes: (kind, key, c, t, d, rest_t, rest_d): a string's
    count, and as a context its symbols and different symbols, and those left at its
    suffix after an escape.
    """
    raw = docs.select("text").mapInArrow(_count(order), "kind int, key long, n long")
    counts = saved(raw.groupBy("kind", "key").agg(F.sum("n").alias("c")), "counts")
    words = counts.where(F.col("kind") == WORD)
    total = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    level = counts.where(F.col("kind") == 1 + order + 1).select("key", "c")
    levels = {order + 1: level}
    for size in range(order, 0, -1):
        level = saved(level.groupBy(F.col("key").bitwiseAND(F.lit(int(_mask(size)))).alias("key"))
                      .agg(F.sum("c").alias("c")), f"strings-{size}")
        levels[size] = level
    nodes = None
    for size in range(order + 1, 0, -1):  # strings of this size, and the contexts one shorter
        children = levels[size].withColumn("context", F.shiftright("key", BITS))
        if size > 1:
            suffix = levels[size - 1].select(F.col("key").alias("suffix"), F.col("c").alias("suffix_c"))
            children = children.withColumn("suffix", F.col("key").bitwiseAND(F.lit(int(_mask(size - 1))))).join(suffix, "suffix")
        else:
            children = children.withColumn("suffix_c", F.lit(0).cast("long"))
        stats = children.groupBy("context").agg(F.sum("c").alias("t"), F.count(F.lit(1)).alias("d"), F.sum("suffix_c").alias("used_t"))
        stats = saved(stats, f"contexts-{size - 1}")
        part = stats.select(F.lit(size).alias("kind"), F.col("context").alias("key"), "t", "d", "used_t")
        nodes = part if nodes is None else nodes.unionByName(part)
    nodes = saved(nodes, "contexts")
    # what is left at the suffix: its own t and d without the symbols of the longer context
    up = nodes.select((F.col("kind") + 1).alias("kind"), F.col("key").alias("suffix"), F.col("t").alias("up_t"), F.col("d").alias("up_d"))
    drop = F.lit(0).cast("long")
    for size in range(1, order + 1):
        drop = F.when(F.col("kind") == 1 + size, F.col("key").bitwiseAND(F.lit(int(_mask(size - 1))))).otherwise(drop)
    contexts = nodes.withColumn("suffix", drop).join(up, ["kind", "suffix"], "left").select(
        "kind", "key", "t", "d", (F.col("up_t") - F.col("used_t")).alias("rest_t"), (F.col("up_d") - F.col("d")).alias("rest_d"))
    strings = None
    for size, level in levels.items():
        part = level.select(F.lit(1 + size).alias("kind"), "key", "c")
        strings = part if strings is None else strings.unionByName(part)
    nodes = strings.join(contexts, ["kind", "key"], "full").select("kind", "key", "c", "t", "d", "rest_t", "rest_d")
    return words, saved(nodes, "nodes"), {"words": total.n, "distinct": total.v}


class Trie:
    """The nodes a chunk asked for, per string size: sorted keys and (c, t, d, rest_t, rest_d)."""

    def __init__(self, kind: np.ndarray, key: np.ndarray, values: np.ndarray, order: int):
        self.order, self.keys, self.values = order, [], []
        for size in range(order + 2):
            own = np.flatnonzero(kind == 1 + size)
            own = own[np.argsort(key[own])]
            self.keys.append(key[own])
            self.values.append(np.concatenate([values[own], np.zeros((1, 5))]))  # the last: a string never seen

    def get(self, size: int, keys: np.ndarray) -> np.ndarray:
        have = self.keys[size]
        if not len(have):
            return np.zeros((len(keys), 5))
        at = np.searchsorted(have, keys)
        at[at == len(have)] = 0
        return self.values[size][np.where(have[at] == keys, at, len(have))]

    def log10(self, strings: np.ndarray) -> np.ndarray:
        """log10 probability of the last symbol of every (longest) string after the ones before it."""
        out = np.zeros(len(strings))
        left = np.arange(len(strings))
        longer = np.zeros((len(strings), 5))  # the context one longer, as far as seen
        for k in range(self.order, -1, -1):
            s = strings[left] & _mask(k + 1)
            context = self.get(k, s >> np.uint64(BITS))
            c = self.get(k + 1, s)[:, 0]
            after = longer[:, 1] > 0
            t = np.where(after, longer[:, 3], context[:, 1])
            d = np.where(after, longer[:, 4], context[:, 2])
            hit = c > 0
            out[left[hit]] += np.log10(c[hit] / (t + d)[hit])
            new = ~hit & (d > 0)
            out[left[new]] += np.log10(d[new] / (t + d)[new])
            left, longer = left[~hit], context[~hit]
        if len(left):
            out[left] -= np.log10(257 - longer[:, 2])
        return out


def _asked(order: int):
    """Documents sorted by chunk -> the distinct (chunk, kind, key) of each chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, strings, words, held = None, [], set(), 0
        for b in batches:
            for chunk, text in zip(b.column("chunk").to_pylist(), b.column("text").to_pylist()):
                if chunk != now:
                    yield from keys(now, strings, words)
                    now, strings, words, held = chunk, [], set(), 0
                for g in string_pieces(text or b"", order):
                    strings.append(g)
                    held += len(g)
                if held > 4 * PIECE:
                    strings, held = [distinct(np.concatenate(strings))], 0
                for some in word_lists(text or b""):
                    words.update(some)
        yield from keys(now, strings, words)

    def keys(chunk: int | None, strings: list[np.ndarray], words: set[bytes]) -> Iterator[pa.RecordBatch]:
        if chunk is None:
            return
        level = distinct(np.concatenate(strings))
        for size in range(order + 1, -1, -1):
            yield rows(chunk, 1 + size, level)
            if size:
                level = distinct(np.concatenate([level & _mask(size - 1), level >> np.uint64(BITS)]))
        yield rows(chunk, WORD, distinct(np.fromiter(map(word_key, words), np.int64, len(words))))

    def rows(chunk: int, kind: int, keys: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), chunk, np.int64)), pa.array(np.full(len(keys), kind, np.int32)),
                                           pa.array(keys.view(np.int64))], ["chunk", "kind", "key"])

    return run


class WordCosts(dict):
    """Word -> log10(count + 1), looked up by the word's key when first met."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        super().__init__()
        self.by_key = dict(zip(keys.tolist(), np.log10(counts + 1).tolist()))

    def __missing__(self, word: bytes) -> float:
        cost = self[word] = self.by_key.get(word_key(word), 0.0)
        return cost


def _score(order: int, log_base: float, end_count: int):
    """(documents of a chunk, its answers) -> scores."""
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        kind = answers.column("kind").to_numpy()
        key = answers.column("key").to_numpy()
        values = np.stack([answers.column(c).fill_null(0).to_numpy().astype(float) for c in ("c", "t", "d", "rest_t", "rest_d")], axis=1)
        word = WordCosts(key[kind == WORD], values[kind == WORD, 0]).__getitem__
        trie = Trie(kind, key.view(np.uint64), values, order)
        # the longest strings that training has seen have one cost; any other is worked out where it stands
        seen = trie.keys[order + 1]
        table, cost = KeyTable(seen), np.append(trie.log10(seen), 0.0)

        def total(g: np.ndarray) -> float:
            at = table.find(g)  # -1, so the last cost, for a string never seen
            new = g[at < 0]
            return float(cost[at].sum() + (trie.log10(new).sum() if len(new) else 0.0))

        out = {"n_tokens": [], "n_known": [], "base_score": [], "score": []}
        for t in docs.column("text").to_pylist():
            t = t or b""
            n, hits, base = 1, int(end_count > 0), np.log10(end_count + 1)
            for words in word_lists(t):
                c = np.fromiter(map(word, words), float, len(words))
                n, hits, base = n + len(words), hits + int(np.count_nonzero(c)), base + c.sum()
            out["n_tokens"].append(n)
            out["n_known"].append(hits)
            out["base_score"].append(base - n * log_base)
            out["score"].append(sum(map(total, string_pieces(t, order))))
        return pa.table({"doc_id": docs.column("doc_id").cast(pa.int64()), "held_out": docs.column("held_out"),
                         "n_tokens": pa.array(out["n_tokens"], pa.int64()), "n_known": pa.array(out["n_known"], pa.int64()),
                         "base_score": pa.array(out["base_score"], pa.float64()), "score": pa.array(out["score"], pa.float64())})

    return run


def score_documents(docs: DataFrame, held_out: Column, order: int = ORDER) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of
    ``docs``; the rows with ``held_out`` false train."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), F.col("text").cast("binary").alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes"),
                    F.sum((~F.col("held_out")).cast("long")).alias("train")).first()
    words, nodes, sums = build(rows.where(~F.col("held_out")), order)
    ends = size.train or 0
    total = sums["words"] + ends
    log_base = float(np.log10(total + sums["distinct"] + int(ends > 0) + 1))
    chunks = max(-(-size.bytes // CHUNK), int(spark.conf.get("spark.sql.shuffle.partitions")))
    # the tasks grow with the bytes; repeats of one row, which share id and text, are spread over chunks as well
    spread = F.xxhash64("doc_id", "text", F.monotonically_increasing_id())
    dealt = rows.withColumn("chunk", F.pmod(spread, F.lit(chunks))).repartition(chunks, "chunk")
    # all columns, so that both uses of the dealt documents are one exchange
    asked = dealt.sortWithinPartitions("chunk").mapInArrow(_asked(order), "chunk long, kind int, key long")
    blank = [F.lit(None).cast("long").alias(c) for c in ("t", "d", "rest_t", "rest_d")]
    known = words.select("kind", "key", "c", *blank).unionByName(nodes)
    # a node is there once: hashing the nodes of a partition saves sorting the many more asked keys
    answers = asked.join(known.hint("shuffle_hash"), ["kind", "key"]).select("chunk", "kind", "key", "c", "t", "d", "rest_t", "rest_d")
    out = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _score(order, log_base, ends), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(total).cast("long"))
