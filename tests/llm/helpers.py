"""Brute-force versions and small tables for the operator tests."""

from __future__ import annotations

import random

import xxhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark, rows, extra: str = ""):
    """rows: (doc_id, text[, lang[, source]]) -> a documents table."""
    full = [(*r, *[None] * (4 - len(r)), len(r[1]) if r[1] is not None else None) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    return df.selectExpr("*", *extra.split(";")) if extra else df


def prose(rng: random.Random, n: int, words=("the", "on", "ation", "ered", "hea", "shor", "blewh", "inst", "oran", "ndti", "es", "ly")) -> str:
    return " ".join("".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(n))


def words_of(text):
    return (text or "").encode().lower().split()


def brute_fingerprint(text, k=3):
    w = words_of(text)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + k]), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, linked):
    """Smallest reachable id of every id; linked(a, b) on ids."""
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(ids)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}
