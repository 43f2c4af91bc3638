"""Language identification by prediction by partial matching.

Every language has a tree of byte contexts of order 0 to ``ORDER``.  A byte that
was seen ``c`` times after a context (``t`` bytes, ``d`` different ones) has
probability ``c / (t + d)`` there; a new one pays the escape ``d / (t + d)`` and is
looked for one order lower, at last among all 256 bytes.  The statistics are frozen
after training, so the code length of a byte depends on it and its context alone,
and the trees of all languages compile into one table from byte strings to a row of
code lengths.  A text's language is the one of the shortest code; the score is its
share of ``2 ** -length`` over all languages.

Training counts only the longest strings (the shorter follow by summing), per task
and then per language in Spark.  The rows learnt from are a hash sample of about
``ROWS`` documents per language (the documented bound on what is fitted), so the
tables that the driver and tasks hold are bounded; every whole text is scored, in
one pass without a shuffle.

Edge cases: a null text or one without a letter is ``und`` with score 0, as is every
text if nothing could be learnt; null languages are not learnt; ties go to the first
language by code point; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import KeyTable

ORDER = 4
ROWS = 1500
PIECE = 1 << 19
UNKNOWN = "und"


def gram_pieces(text: bytes, order: int = ORDER) -> Iterator[np.ndarray]:
    """For every byte, it and the ``order`` bytes before it as one number (zeros before the text)."""
    for s in range(0, len(text), PIECE):
        before = text[max(0, s - order):s].rjust(order, b"\0")
        raw = np.frombuffer(before + text[s:s + PIECE], np.uint8).astype(np.uint64)
        n = len(raw) - order
        g = raw[order:].copy()
        for back in range(1, order + 1):
            g |= raw[order - back:order - back + n] << np.uint64(8 * back)
        yield g


def _sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    uniq, back = np.unique(keys, return_inverse=True)
    return uniq, np.bincount(back, counts, len(uniq))


class Model:
    """Compiled trees: per order, the strings seen in any language with their code lengths
    (bits), and the contexts with their escape costs."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]], order: int = ORDER):
        self.langs, self.order = sorted(counts), order
        self.grams, self.cost, self.contexts, self.escape = [], [], [], []
        lower_keys, lower = np.zeros(1, np.uint64), np.full((1, len(self.langs)), 8.0)
        for k in range(order + 1):
            mask = np.uint64((1 << 8 * (k + 1)) - 1)
            own = [_sums(counts[x][0] & mask, counts[x][1]) for x in self.langs]
            keys = np.unique(np.concatenate([u for u, _ in own]))
            contexts = np.unique(keys >> np.uint64(8))
            parent = np.searchsorted(contexts, keys >> np.uint64(8))
            shorter = np.searchsorted(lower_keys, keys & (mask >> np.uint64(8)))
            cost = np.empty((len(keys), len(self.langs)))
            escape = np.zeros((len(contexts), len(self.langs)))
            for x, (uniq, n) in enumerate(own):
                c = np.zeros(len(keys))
                c[np.searchsorted(keys, uniq)] = n
                t = np.bincount(parent, c, len(contexts))
                d = np.bincount(parent, c > 0, len(contexts))
                known = t > 0
                escape[known, x] = np.log2((t + d)[known] / d[known])
                with np.errstate(divide="ignore", invalid="ignore"):
                    cost[:, x] = np.where(c > 0, np.log2((t + d)[parent] / c), escape[parent, x] + lower[shorter, x])
            self.grams.append(keys)
            self.cost.append(cost.astype(np.float32))
            self.contexts.append(contexts)
            self.escape.append(escape.astype(np.float32))
            lower_keys, lower = keys, cost

    def compile(self) -> Model:
        self.gram_table = [KeyTable(g) for g in self.grams]
        self.context_table = [KeyTable(c) for c in self.contexts]
        return self

    def lengths(self, grams: np.ndarray) -> np.ndarray:
        """Bits of every byte under every language; ``grams`` as from :func:`gram_pieces`."""
        at = self.gram_table[self.order].find(grams)
        out = self.cost[self.order][at]
        todo = np.flatnonzero(at < 0)
        out[todo] = 0
        for k in range(self.order, -1, -1):
            if k < self.order:
                at = self.gram_table[k].find(grams[todo] & np.uint64((1 << 8 * (k + 1)) - 1))
                out[todo[at >= 0]] += self.cost[k][at[at >= 0]]
                todo = todo[at < 0]
            if not len(todo):
                return out
            context = (grams[todo] & np.uint64((1 << 8 * (k + 1)) - 1)) >> np.uint64(8)
            at = self.context_table[k].find(context)
            out[todo[at >= 0]] += self.escape[k][at[at >= 0]]
        out[todo] += 8
        return out


def train(docs: DataFrame, usable: Column) -> Model | None:
    """Model of the rows of ``docs`` (text, lang, doc_id) that meet ``usable``."""
    rows = docs.where(F.col("lang").isNotNull() & (F.octet_length("text") > 0) & usable)
    count = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not count:
        return None
    spin = F.pmod(F.xxhash64("doc_id", "text", F.lit(29)), F.lit(1 << 20))
    share = F.create_map(*[F.lit(x) for k, n in count.items() for x in (k, ROWS / n)])
    sample = rows.where(spin < F.element_at(share, F.col("lang")) * (1 << 20))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for g in gram_pieces(text):
                    held.setdefault(lang, []).append(g)
                if sum(map(len, held.get(lang, []))) > 4 * PIECE:
                    yield out(lang, held.pop(lang))
            for lang, grams in held.items():
                yield out(lang, grams)

    def out(lang: str, grams: list[np.ndarray]) -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate(grams), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)),
                                           pa.array(n, pa.int64())], ["lang", "gram", "n"])

    counts = sample.select("lang", F.col("text").cast("binary").alias("text")).mapInArrow(run, "lang string, gram long, n long") \
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    langs = counts.column("lang").to_numpy()
    grams, n = counts.column("gram").to_numpy().view(np.uint64), counts.column("n").to_numpy().astype(float)
    found = {x: (grams[langs == x], n[langs == x]) for x in sorted(set(langs))}
    return Model(found) if found else None


def identify(model: Model, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(index of the language, score) of every text."""
    bits = np.zeros((len(texts), len(model.langs)))
    rows, pieces, held = [], [], 0

    def flush() -> None:
        lengths = model.lengths(np.concatenate(pieces))
        starts = np.cumsum([0] + [len(p) for p in pieces[:-1]])
        np.add.at(bits, rows, np.add.reduceat(lengths, starts, axis=0, dtype=np.float64))
        rows.clear()
        pieces.clear()

    for r, text in enumerate(texts):
        for g in gram_pieces(text, model.order):
            rows.append(r)
            pieces.append(g)
            held += len(g)
            if held >= PIECE:
                flush()
                held = 0
    if pieces:
        flush()
    best = bits.argmin(axis=1)
    low = bits.min(axis=1, keepdims=True)
    return best, 1 / np.exp2(np.maximum(low - bits, -1000)).sum(axis=1)


def identify_documents(docs: DataFrame, usable: Column) -> DataFrame:
    """(doc_id, lang_pred, score); learnt from the rows that meet ``usable``, a condition on doc_id."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = train(own, usable)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value.compile() if shared.value else None
        for b in batches:
            readable = np.array(b.column(2).to_pylist(), bool)
            pred, score = np.full(b.num_rows, UNKNOWN, object), np.zeros(b.num_rows)
            if model and readable.any():
                texts = [t for t, r in zip(b.column(1).to_pylist(), readable) if r]
                best, score[readable] = identify(model, texts)
                pred[readable] = np.array(model.langs, object)[best]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pred, pa.string()), pa.array(score)],
                                             ["doc_id", "lang_pred", "score"])

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return own.select("doc_id", F.col("text").cast("binary").alias("text"), letters.alias("readable")) \
        .mapInArrow(run, "doc_id long, lang_pred string, score double")
