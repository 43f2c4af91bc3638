"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the mean of the embeddings of its character n-grams (3 to 6, with word
marks) and of itself, hashed into ``BUCKETS`` rows; a bag is the mean of its words;
a linear softmax over the bag gives the class.  Embeddings and softmax are trained
jointly in numpy (full-batch gradient with momentum).  An unseen misspelling shares n-gram vectors with words
that were seen.

A document is labelled as a whole though a few words decide it, so bags are
windows of ``WINDOW`` words (half overlapping when scoring) and a document scores as its worst
window.  Training starts from windows that inherit their document's label, then
keeps of a toxic document only the windows that the model finds toxic (at least
the worst), and of a clean one all.  A logistic curve over the worst window,
fitted on rows kept back from training, maps to the score.

Because a mean is linear, a trained model is one number per bucket: the tasks get
``BUCKETS`` floats and score every whole text in one pass without a shuffle.

Training rows: a hash sample of the labelled rows, about ``ROWS`` per class of
texts up to ``ROW_BYTES`` (the documented bound on what is fitted); everything is
scored.

Edge cases: null, empty and blank texts score as an empty bag; labels that are null
or have no document are unused, and of contradicting ones the highest counts; a
null id is never held out nor trained on; with rows of one class only, or none, all
scores are that class's (or 0); other columns are never read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 17
DIM = 4
NGRAMS = (3, 4, 5, 6)
WINDOW = 4
#: A bucket is trained if its words occur so often in the sample (counted once a document).
MIN_COUNT = 6
ROWS = 1200
ROW_BYTES = 20_000
CACHE = 400_000
_EDGE = " .,;:!?\"'()[]{}"


def _subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket ids, offsets): the n-grams of every ``<word>`` and the word itself."""
    marked = [f"<{w}>" for w in words]
    size = np.array([len(w) for w in marked], np.int64)
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words), dtype=np.int32), size)
    room = np.repeat(np.cumsum(size), size) - np.arange(len(codes))  # characters from here to the word's end
    mult, mix = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
    ids = [np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS for w in marked], np.int32)]
    owners = [np.arange(len(words), dtype=np.int32)]
    h = codes
    for n in range(2, max(NGRAMS) + 1):
        if n > len(codes):
            break
        h = h[:-1] * mult + codes[n - 1:]
        if n in NGRAMS:
            here = np.flatnonzero(room[:len(h)] >= n)
            ids.append((((h[here] + np.uint64(n)) * mix) >> np.uint64(33)).astype(np.int32) % BUCKETS)
            owners.append(owner[here])
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return np.concatenate(ids)[order], np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(words)))])


def _tokens(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def _clean(token: str) -> str:
    return token.strip(_EDGE)


def _spans(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the half-overlapping windows over ``n`` words (one empty window for none)."""
    start = np.arange(0, max(n - WINDOW // 2, 1), WINDOW // 2)
    return start, np.minimum(start + WINDOW, n)


def _means(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Segment means of rows (every segment has a row)."""
    return np.add.reduceat(values, offsets[:-1], axis=0) / np.diff(offsets)[:, None].astype(values.dtype)


class _Bags:
    """Windows of words: bag i holds ``flat[offsets[i]:offsets[i + 1]]`` and belongs to ``doc[i]``."""

    def __init__(self, words: list[str], flat: np.ndarray, offsets: np.ndarray, doc: np.ndarray):
        self.words, self.flat, self.offsets, self.doc = words, flat, offsets, doc
        self.sub, self.sub_at = _subwords(words)
        self.of_bag = np.repeat(np.arange(len(doc), dtype=np.int32), np.diff(offsets))
        self.of_word = np.repeat(np.arange(len(words), dtype=np.int32), np.diff(self.sub_at))

    @classmethod
    def of(cls, texts: list[str]) -> _Bags:
        """All windows, without overlap: every word once."""
        vocab: dict[str, int] = {}
        flat, offsets, doc = [], [np.zeros(1, np.int64)], []
        total = 0
        for d, text in enumerate(texts):
            ids = np.array([vocab.setdefault(_clean(t), len(vocab)) for t in _tokens(text)], np.int32)
            ends = np.minimum(np.arange(0, len(ids), WINDOW) + WINDOW, len(ids))
            flat.append(ids)
            offsets.append(total + ends)
            doc.append(np.full(len(ends), d, np.int32))
            total += len(ids)
        return cls(list(vocab), *(np.concatenate(x) for x in (flat, offsets, doc)))

    def some(self, chosen: np.ndarray) -> _Bags:
        flat = self.flat[chosen[self.of_bag]]
        used, flat = np.unique(flat, return_inverse=True)
        offsets = np.concatenate([[0], np.cumsum(np.diff(self.offsets)[chosen])])
        return _Bags([self.words[w] for w in used], flat, offsets, self.doc[chosen])

    def means(self, emb: np.ndarray) -> np.ndarray:
        return _means(_means(emb[self.sub], self.sub_at)[self.flat], self.offsets)


def _start(bags: _Bags, label: np.ndarray) -> np.ndarray:
    """First direction of the embeddings: shrunken log odds of a bucket's words, by documents."""
    docs = len(label)
    seen = np.unique(bags.flat.astype(np.int64) * docs + bags.doc[bags.of_bag])
    count = [np.bincount(bags.sub, np.bincount(seen // docs, label[seen % docs] == c, len(bags.words))[bags.of_word], BUCKETS)
             for c in (0, 1)]
    odds = np.log((count[1] + 2) / (count[1].sum() + 2)) - np.log((count[0] + 2) / (count[0].sum() + 2))
    total = count[0] + count[1]
    return np.where(total >= MIN_COUNT, odds * total / (total + 20), 0)


def _fit(bags: _Bags, label: np.ndarray, rounds: int = 3, steps: int = 30, rate: float = 0.3) -> np.ndarray:
    """Jointly trained embeddings and softmax, as the weight of every bucket plus the bias (last)."""
    rng = np.random.default_rng(3)
    emb = rng.normal(0, 0.01, (BUCKETS, DIM)).astype(np.float32)
    emb[:, 0] = _start(bags, label)
    trained = emb[:, :1] != 0
    emb *= trained
    soft = rng.normal(0, 0.1, (DIM, 2)).astype(np.float32)
    soft[0] = (-3, 3)
    bias = np.array([1, -1], np.float32)
    spin = rng.random(len(bags.doc))
    for _ in range(rounds):
        # of a toxic document the windows found toxic, the worst at least; of a clean one the worst and a tenth
        z = bags.means(emb) @ (soft[:, 1] - soft[:, 0]) + bias[1] - bias[0]
        order = np.lexsort((-z, bags.doc))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order)) - np.searchsorted(bags.doc[order], bags.doc[order])
        toxic = label[bags.doc] == 1
        part = bags.some(np.where(toxic, (place == 0) | (z > 0), (place < 8) | (spin < 0.1)))
        target = label[part.doc]
        weight = np.where(target == 1, 1 / max(target.sum(), 1), 1 / max((1 - target).sum(), 1))
        params = [emb, soft, bias]
        pace = [np.zeros_like(x) for x in params]
        n_words, n_sub = np.diff(part.offsets)[:, None], np.diff(part.sub_at)[:, None]
        for _ in range(steps):
            bag = part.means(emb)
            z = bag @ soft + bias
            p = 1 / (1 + np.exp(np.clip(z[:, 0] - z[:, 1], -30, 30)))
            err = (p - target) * weight
            dz = np.stack([-err, err], axis=1)
            d_bag = (dz @ soft.T) / n_words
            d_word = np.stack([np.bincount(part.flat, d_bag[part.of_bag, c], len(part.words)) for c in range(DIM)], axis=1) / n_sub
            d_emb = np.stack([np.bincount(part.sub, d_word[part.of_word, c], BUCKETS) for c in range(DIM)], axis=1) * trained
            for x, v, g, pace_of in zip(params, pace, (d_emb, bag.T @ dz, dz.sum(0)), (rate, rate / 3, rate / 3)):
                v *= 0.8
                v += 0.2 * g
                # one scale for a whole table, so an n-gram moves as far as the evidence for it goes
                x -= (pace_of * v / (np.abs(v).max() + 1e-12)).astype(np.float32)
    return np.append(emb @ (soft[:, 1] - soft[:, 0]), bias[1] - bias[0])


class Scorer:
    """Scores texts with (weights, slope, shift); keeps the values of words seen."""

    def __init__(self, model: tuple[np.ndarray, float, float]):
        self.weights, self.slope, self.shift = model
        self.known: dict[str, float] = {}

    def worst(self, texts: list[str | None]) -> np.ndarray:
        """The logit of the worst window of every text."""
        out = np.empty(len(texts))
        for d, text in enumerate(texts):
            tokens = _tokens(text)
            new = {t for t in tokens if t not in self.known}
            if new:
                if len(self.known) > CACHE:
                    self.known.clear()
                    new = set(tokens)
                self._learn(list(new))
            if tokens:
                total = np.concatenate([[0.0], np.cumsum(np.fromiter(map(self.known.__getitem__, tokens), float, len(tokens)))])
                s, e = _spans(len(tokens))
                s, e = s[s < len(tokens)], e[s < len(tokens)]
                out[d] = ((total[e] - total[s]) / (e - s)).max()
            else:
                out[d] = 0.0
        return out + self.weights[-1]

    def _learn(self, tokens: list[str]) -> None:
        sub, at = _subwords([_clean(t) for t in tokens])
        value = np.add.reduceat(self.weights[sub], at[:-1]) / np.diff(at)
        self.known.update(zip(tokens, value.tolist()))

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        z = np.clip(self.slope * self.worst(texts) + self.shift, -40, 40)
        return 1 / (1 + np.exp(-z))


def train(rows: list[tuple[str, int]]) -> tuple[np.ndarray, float, float]:
    """Model of (text, 0/1) rows; every fifth row only fits the logistic curve."""
    flat = np.zeros(BUCKETS + 1)
    label = np.array([y for _, y in rows], np.float64)
    if len(set(label)) < 2:
        return flat, 0.0, 40.0 if len(label) and label[0] else -40.0
    back = np.arange(len(rows)) % 5 == 4
    if len(set(label[back])) < 2 or len(set(label[~back])) < 2:
        back[:] = False
    bags = _Bags.of([t for (t, _), b in zip(rows, back) if not b])
    if not len(bags.doc):
        return flat, 0.0, -40.0
    weights = _fit(bags, label[~back])
    check = back if back.any() else ~back
    z = Scorer((weights, 1.0, 0.0)).worst([t for (t, _), b in zip(rows, check) if b])
    y = label[check]
    a, b = 1.0, 0.0
    for _ in range(200):  # damped Newton steps on the log loss with a small ridge
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
        g = np.array([((p - y) * z).mean() + 1e-3 * (a - 1), (p - y).mean()])
        w = p * (1 - p)
        h = np.array([[(w * z * z).mean() + 1e-3, (w * z).mean()], [(w * z).mean(), w.mean() + 1e-4]])
        da, db = np.linalg.solve(h, g)
        size = max(1.0, abs(da), abs(db))
        a, b = max(a - da / size, 1e-3), b - db / size
    return weights, float(a), float(b)


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column) -> list[tuple[str, int]]:
    """The bounded sample: about ``ROWS`` rows per class, chosen by a hash of doc_id.

    ``usable`` is a condition on doc_id.  The sampled ids are at most a few times
    ``ROWS``, so they are broadcast and the texts are not shuffled.
    """
    rows = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id") \
        .agg(F.max("toxic").cast("int").alias("toxic")).where(usable)
    count = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    spin = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 20))
    share = F.when(F.col("toxic") == 1, ROWS / max(count.get(1, 1), 1)).otherwise(2 * ROWS / max(count.get(0, 1), 1))
    chosen = rows.where(spin < share * (1 << 20))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.octet_length("text") <= ROW_BYTES)
    got = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic").distinct().collect()
    return [(r.text, r.toxic) for r in sorted(got, key=lambda r: (r.doc_id, r.text))]


def score_documents(docs: DataFrame, labels: DataFrame, usable: Column | None = None) -> DataFrame:
    """(doc_id, score): 0 to 1, higher is likelier toxic."""
    model = train(training_rows(docs, labels, F.lit(True) if usable is None else usable))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scorer(b.column(1).to_pylist()), pa.float64())],
                                             ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def clean_documents(docs: DataFrame, all_docs: DataFrame, labels: DataFrame, usable: Column | None = None,
                    most: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score under ``most``; the model is fitted on ``all_docs``."""
    model = train(training_rows(all_docs, labels, F.lit(True) if usable is None else usable))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            yield b.filter(pa.array(scorer(b.column(at).to_pylist()) < most))

    return docs.mapInArrow(run, docs.schema)
