import math
import random
from collections import Counter, defaultdict

import numpy as np
from helpers import docs_frame, prose
from pyspark.sql import functions as F

from pitchside.llm import langid as L
from pitchside.llm.common import KeyTable, held_out

SYLLABLES = {"aa": ("the", "on", "ing", "er"), "bb": ("sch", "ung", "er", "zu"), "cc": ("ción", "os", "la", "er")}


def brute_bits(train, text, order=L.ORDER):
    """Code length by walking the context tree byte by byte."""
    seen = defaultdict(Counter)
    for t in train:
        t = b"\0" * order + t
        for i in range(order, len(t)):
            for k in range(order + 1):
                seen[t[i - k:i]][t[i]] += 1
    total, t = 0.0, b"\0" * order + text
    for i in range(order, len(t)):
        for k in range(order, -1, -1):
            c = seen.get(t[i - k:i])
            if not c:
                continue
            n, d = sum(c.values()), len(c)
            if t[i] in c:
                total += math.log2((n + d) / c[t[i]])
                break
            total += math.log2((n + d) / d)
        else:
            total += 8
    return total


def model_of(train):
    counts = {}
    for lang, texts in train.items():
        keys, n = np.unique(np.concatenate([g for t in texts for g in L.gram_pieces(t)]), return_counts=True)
        counts[lang] = (keys, n.astype(float))
    return L.Model(counts).compile()


def test_code_lengths_equal_the_tree(monkeypatch):
    monkeypatch.setattr(L, "PIECE", 37)
    rng = random.Random(1)
    train = {k: [prose(rng, 25, v).encode() for _ in range(4)] for k, v in SYLLABLES.items()}
    model = model_of(train)
    for text in [prose(rng, 30, v).encode() for v in SYLLABLES.values()] + [b"\x00\xff\x01zq", b"a", bytes(range(256)), b""]:
        got = sum((model.lengths(g).sum(0) for g in L.gram_pieces(text)), np.zeros(3))
        assert np.allclose(got, [brute_bits(train[k], text) for k in sorted(train)], rtol=1e-4)


def test_key_table():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 40, 5000, np.uint64))
    ask = np.concatenate([keys[::3], rng.integers(0, 1 << 40, 5000, np.uint64), np.array([0], np.uint64)])
    at = {int(k): i for i, k in enumerate(keys)}
    assert KeyTable(keys).find(ask).tolist() == [at.get(int(k), -1) for k in ask]
    assert KeyTable(keys[:0]).find(ask[:4]).tolist() == [-1] * 4


def rows_of(rng, n):
    return [(i, prose(rng, rng.randint(2, 60), SYLLABLES[k]), k) for i in range(n) for k in [rng.choice(list(SYLLABLES))]]


def test_held_out_accuracy_and_edges(spark):
    rng = random.Random(2)
    rows = rows_of(rng, 250)
    odd = [(900, None, "aa"), (901, "", "bb"), (902, " 12 .\n", "cc"), (903, "schungzu", None), (None, "thing on", "aa"), (904, "é", "aa")]
    df = docs_frame(spark, rows + odd, "text as lang_pred;1 as score")
    out = L.identify_documents(df, ~held_out("doc_id", 4, 2)).collect()
    assert len(out) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in out)
    pred = {r.doc_id: r.lang_pred for r in out}
    held = {r.doc_id for r in df.where(held_out("doc_id", 4, 2)).collect()}
    assert len(held) > 30 and np.mean([pred[i] == k for i, _, k in rows if i in held]) > 0.97
    assert [pred[i] for i in (900, 901, 902, 903)] == ["und", "und", "und", "bb"]
    # held-out labels are never learnt from
    swapped = df.withColumn("lang", F.when(held_out("doc_id", 4, 2), F.lit("zz")).otherwise(F.col("lang")))
    assert sorted(map(str, L.identify_documents(swapped, ~held_out("doc_id", 4, 2)).collect())) == sorted(map(str, out))


def test_nothing_to_learn_and_no_rows(spark):
    df = docs_frame(spark, [(1, "abc"), (2, None)])
    assert [(r.lang_pred, r.score) for r in L.identify_documents(df, F.lit(True)).collect()] == [("und", 0.0)] * 2
    assert L.identify_documents(df.where("false"), F.lit(True)).collect() == []
