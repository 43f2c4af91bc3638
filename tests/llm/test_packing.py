"""Packing: whole-text ids, the one-by-one loop, and gapless sequences."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from helpers import docs_frame
from pitchside.llm import packing as K
from pitchside.llm.queries import op12_best_fit_packing

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("byte_bpe_50k.json")
FIELDS = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def plain_ids(texts, path=PATH):
    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    return [e.ids for e in model.encode_batch(list(texts), add_special_tokens=False)]


def one_by_one(lengths, capacity):
    """The method, one sequence and one piece at a time."""
    left, out = Counter(lengths), []
    while left:
        held = []

        def take(n):
            held.append(n)
            left[n] -= 1
            if not left[n]:
                del left[n]

        def fill():
            while fits := [n for n in left if n <= capacity - sum(held)]:
                take(max(fits))

        fill()
        while sum(held) < capacity and len(held) > 1:
            room = capacity - sum(held) + min(held)
            pairs = [(a + b, a, b) for a in left for b in left if b <= a and a + b <= room and (a != b or left[a] > 1)]
            if not pairs or max(pairs)[0] <= min(held):
                break
            smallest = min(held)
            held.remove(smallest)
            for n in max(pairs)[1:]:
                take(n)
            left[smallest] += 1
            fill()
        out.append(sorted(held))
    return out


def test_patterns_are_the_one_by_one_loop():
    rng = random.Random(3)
    for _ in range(150):
        capacity = rng.choice([8, 30, 100])
        lengths = [min(capacity, 1 + int(rng.expovariate(rng.choice([1, 4]) / capacity))) for _ in range(rng.choice([0, 1, 6, 60, 150]))]
        patterns = K.best_two_fit(Counter(lengths), capacity)
        got = [sorted(n for n, k in p.use.items() for _ in range(k)) for p in patterns for _ in range(p.times)]
        assert got == one_by_one(lengths, capacity)


def test_large_counts_stay_few_patterns_near_the_bound():
    counts = {n: int(10 ** 9 * math.exp(-n / 300)) for n in range(1, 1025)}
    patterns = K.best_two_fit(counts, 1024)
    used = Counter()
    for p in patterns:
        assert sum(n * k for n, k in p.use.items()) <= 1024
        for n, k in p.use.items():
            used[n] += k * p.times
    assert used == Counter(counts) and len(patterns) < 5000
    assert sum(p.times for p in patterns) <= 1.001 * sum(n * k for n, k in counts.items()) / 1024


def test_ids_are_those_of_the_whole_text(spark):
    rng = random.Random(9)
    texts = [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").limit(300).collect()]
    texts += ["".join(rng.choice("ab '\n\t \x1c\x85　.1<|>é🙂") for _ in range(rng.randrange(120))) for _ in range(1500)]
    texts += ["  a  b c\n d  ", " lead <|endoftext|> tail ", "don't  'll we 've", "x" * 3000, ""]
    for chars in (K.PIECE_CHARS, 40):
        before, K.PIECE_CHARS = K.PIECE_CHARS, chars
        try:
            encoder = K.Encoder(PATH)
            assert [encoder.encode(t).tolist() for t in texts] == plain_ids(texts) and encoder.core
        finally:
            K.PIECE_CHARS = before
    other = public_tokenizers.path("word_bpe_49k.json")  # not byte-level
    encoder = K.Encoder(other)
    assert [encoder.encode(t).tolist() for t in texts[:50]] == plain_ids(texts[:50], other) and not encoder.core


def test_every_character_is_cut_alike():
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    encoder = K.Encoder(PATH)
    for s in range(0, len(points), 1 << 14):
        texts = [f"a{chr(c)}b {chr(c)}1{chr(c)} {chr(c)}." for c in points[s:s + (1 << 14)]]
        differ = [t for t, ids in zip(texts, plain_ids(texts)) if encoder.encode(t).tolist() != ids]
        assert not differ, differ[:5]


def check(rows, docs, capacity=1024, end_id=2):
    """``docs``: (doc_id, text); every piece right, every sequence gapless and not too long."""
    ids = [i + [end_id] for i in plain_ids([t or "" for _, t in docs])]
    want = Counter()
    for (doc_id, _), own in zip(docs, ids):
        first = len(own) % capacity or capacity
        for piece, start in enumerate([0, *range(first, len(own), capacity)]):
            part = own[start:start + (first if piece == 0 else capacity)]
            want[doc_id, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter(tuple(r[f] for f in FIELDS[:5]) for r in rows) == want
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    lengths = [r["length"] for r in rows]
    assert len(held) == sum(p.times for p in K.best_two_fit(Counter(lengths), capacity))
    return len(held), -(-sum(lengths) // capacity)


def test_query_on_the_table(spark):
    out = op12_best_fit_packing(spark, SF)
    assert out.columns == FIELDS
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    sequences, bound = check(out.collect(), docs)
    assert sequences <= 1.01 * bound + 1


def test_edge_rows(spark, scratch):
    rng = random.Random(6)
    docs = [(1, None), (2, ""), (3, "a"), (3, "a"), (3, "a"), (None, "b c"), (4, "word " * 1023), (5, "word " * 1024),
            (6, " ".join(str(rng.random()) for _ in range(9000))), (7, "y" * 20_000)]
    docs += [(100, "the same text")] * 400
    docs_frame(spark, docs, "1 as piece;2 as sequence_id;3 as `offset`;4 as ids;5 as __text").repartition(3).write.parquet(f"{scratch}/documents.parquet")
    check(op12_best_fit_packing(spark, scratch).collect(), docs)


def test_ids_of_the_pieces(spark):
    docs = docs_frame(spark, [(1, "some words " * 40), (2, None)])
    rows = K.pack_documents(docs, PATH, ["doc_id", "lang"], end_id=2, capacity=16, with_ids=True).orderBy("doc_id", "piece").collect()
    assert sum([r.ids for r in rows if r.doc_id == 1], []) == plain_ids(["some words " * 40])[0] + [2]
    assert [r.ids for r in rows if r.doc_id == 2] == [[2]]


def test_empty_table(spark, scratch):
    docs_frame(spark, []).write.parquet(f"{scratch}/documents.parquet")
    out = op12_best_fit_packing(spark, scratch)
    assert out.columns == FIELDS and out.collect() == []
