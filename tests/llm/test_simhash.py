import random

import numpy as np
from helpers import brute_components, brute_fingerprint, docs_frame, prose

from pitchside.llm import simhash as S


def result(df, **kw):
    return {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in S.simhash_components(df, **kw).collect()}


def test_matches_brute_force(spark):
    rng = random.Random(1)
    base = [prose(rng, 120) for _ in range(12)]
    rows = []
    for i in range(150):
        w = rng.choice(base).split()
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = prose(rng, 1)
        rows.append((i, " ".join(w)))
    rows += [(200, None), (201, ""), (202, " \n "), (203, "One"), (204, "one"), (205, "two words"), (206, "A b C d"),
             (207, "é x y z w"), (208, "a a a a a")]
    got = result(docs_frame(spark, rows, "text as fp;doc_id as bucket"))
    fp = {i: brute_fingerprint(t) for i, t in rows}
    want = brute_components(list(fp), lambda a, b: (fp[a] ^ fp[b]).bit_count() <= 3)
    assert got == {i: (fp[i], want[i]) for i in fp}
    assert len(set(want.values())) < len(want) - 20


def test_planted_distances_and_large_buckets(spark, monkeypatch):
    """Fingerprints at 0..5 flipped bits, in buckets above the block size."""
    monkeypatch.setattr(S, "BLOCK", 7)
    rng = np.random.default_rng(5)
    base = [int(x) for x in rng.integers(0, 1 << 62, 8)]
    fps = set(base)
    for b in base:
        for _ in range(25):
            x = b
            for bit in rng.choice(64, rng.integers(1, 6), replace=False):
                x ^= 1 << int(bit)
            fps.add(x - (1 << 64) if x >> 63 else x)
    fps = sorted(fps)
    prints = spark.createDataFrame([(x,) for x in fps], "fp long")
    got = {r.node: r.root for r in S.components(S.links(prints)).collect()}
    m = (1 << 64) - 1
    want = brute_components(fps, lambda a, b: ((a ^ b) & m).bit_count() <= 3)
    assert {x: got.get(x, x) for x in fps} == want


def test_empty_nulls_and_repeats(spark):
    assert result(docs_frame(spark, [(1, "x")]).where("false")) == {}
    df = docs_frame(spark, [(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (5, "a b c d"), (6, "q r s t u")])
    rows = sorted(((r.doc_id or -1, r.component_id) for r in S.simhash_components(df).collect()), key=str)
    assert rows == sorted([(-1, None), (3, 3), (3, 3), (5, 3), (6, 6)], key=str)
    kept = sorted((r.doc_id or -1) for r in S.one_per_group(df).collect())
    assert kept == [-1, 3, 6]


def test_long_text_equals_short_pieces(monkeypatch):
    rng = random.Random(2)
    text = prose(rng, 5000).encode()
    want = S._fingerprint_batch([text], 3)
    lists = S.word_lists
    monkeypatch.setattr(S, "word_lists", lambda t: lists(t, 100))
    assert (S._fingerprint_batch([text], 3, flush=64) == want).all()
    assert int(want[0]) & (1 << 64) - 1 == brute_fingerprint(text.decode())
