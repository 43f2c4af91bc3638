import math
import random
from collections import Counter, defaultdict

import pytest
from helpers import docs_frame, prose, words_of

from pitchside.llm import ppm as P
from pitchside.llm.common import held_out


def brute_score(train, text, order=P.ORDER):
    """log10 probability by walking the contexts with symbol exclusion."""
    seen = defaultdict(Counter)
    symbols = lambda t: [256] * order + list(t.lower()) + [256]
    for t in train:
        s = symbols(t)
        for i in range(order, len(s)):
            for k in range(order + 1):
                seen[tuple(s[i - k:i])][s[i]] += 1
    total, s = 0.0, symbols(text)
    for i in range(order, len(s)):
        gone = set()
        for k in range(order, -1, -1):
            c = {x: n for x, n in seen.get(tuple(s[i - k:i]), {}).items() if x not in gone}
            if not c:
                continue
            t, d = sum(c.values()), len(c)
            if s[i] in c:
                total += math.log10(c[s[i]] / (t + d))
                break
            total += math.log10(d / (t + d))
            gone |= set(c)
        else:
            total -= math.log10(257 - len(gone))
    return total


def brute_base(train, text):
    c = Counter(w for t in train for w in words_of(t))
    n, v = sum(c.values()) + len(train), len(c) + (len(train) > 0)
    counts = [c[w] for w in words_of(text)] + [len(train)]
    return len(counts), sum(x > 0 for x in counts), n, sum(math.log10((x + 1) / (n + v + 1)) for x in counts)


def compare(spark, rows):
    df = docs_frame(spark, rows, "text as key;1 as chunk;2 as c")
    held = held_out("doc_id", 7, 2)
    out = {r.doc_id: r for r in P.score_documents(df, held).collect()}
    test = {r.doc_id for r in df.where(held).collect()}
    train = [t or "" for i, t, *_ in rows if i not in test]
    assert set(out) == {r[0] for r in rows}
    for i, t, *_ in rows:
        r = out[i]
        assert r.held_out == (i in test)
        n, known, total, base = brute_base(train, t)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(brute_score([x.encode() for x in train], (t or "").encode()), rel=1e-9, abs=1e-9)
    return test


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(P, "CHUNK", 900)
    monkeypatch.setattr(P, "PIECE", 53)
    rng = random.Random(1)
    rows = [(i, prose(rng, rng.randint(0, 25))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "Ünïcode ÄÖ the\x00\x01\x7f"), (103, rows[3][1]), (104, rows[3][1].upper()),
             (105, "the the the\n\tthe"), (106, "q" * 400), (None, "the on null id")]
    assert len(compare(spark, rows)) > 4


def test_repeats_and_no_training_rows(spark):
    df = docs_frame(spark, [(1, "a b"), (1, "a b"), (2, None)])
    assert P.score_documents(df.where("false"), held_out("doc_id", 7, 2)).collect() == []
    out = P.score_documents(df, held_out("doc_id", 7, 2) | True).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in out) == [(1, 0, 0, 0.0)] + [(3, 0, 0, 0.0)] * 2
    assert sorted(r.score for r in out) == pytest.approx([-4 * math.log10(257)] * 2 + [-math.log10(257)])

