import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import docs_frame, prose

from pitchside.llm import suffix_dedup as S


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, sha of the rest) of every text, by counting all strings."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[p:p + length] for r in raw for p in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r) + 1, np.int64)
        for p in range(len(r) - length + 1):
            if seen[r[p:p + length]] > 1:
                gone[p] += 1
                gone[p + length] -= 1 if p + length <= len(r) else 0
        gone = np.cumsum(gone)[:len(r)] > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(r, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def got(spark, rows, length):
    df = docs_frame(spark, rows, "text as tid;1 as digest;2 as copies")
    return {r.doc_id: tuple(r)[1:] for r in S.removed_bytes(df, length).collect()}


def check(spark, texts, length):
    want = brute(texts, length)
    have = got(spark, list(enumerate(texts)), length)
    assert [have[i] for i in range(len(texts))] == want
    return want


@pytest.mark.parametrize("length,seed", [(400, 1), (40, 2), (9, 3)])
def test_matches_brute_force(spark, length, seed):
    """Shared passages around the length, edited copies, repeats inside a text, low-entropy runs."""
    rng = random.Random(seed)
    pool = [prose(rng, 400) for _ in range(4)]
    texts = []
    for i in range(70):
        t = prose(rng, rng.randint(0, length // 4))
        for _ in range(rng.randint(0, 3)):
            src = rng.choice(pool)
            at, n = rng.randrange(len(src)), length + rng.choice([-3, -1, 0, 1, 2, 7, 30, 200, length])
            t += src[at:at + n] + rng.choice([" ", "é", "x" * rng.randint(0, 2 * length)])
        texts.append(t)
    near = list(pool[0] + pool[1])
    for _ in range(12):
        t = list(near)
        for _ in range(rng.randint(1, 8)):
            t[rng.randrange(len(t))] = rng.choice("#$%")
        texts.append("".join(t))
    p = prose(rng, 1 + length // 5)
    texts += ["", None, "a" * (length - 1), "a" * length, "b" * (length + 1), "ab" * length, texts[3], texts[3], p * 3, "q" + p + p[:length // 2],
              pool[2][5:5 + length], "zz" + pool[2][5:5 + length] + "yy", pool[3][:length], pool[3][len(pool[3]) - length:]]
    want = check(spark, texts, length)
    assert sum(w[1] > 0 for w in want) > 20 and any(w[2] > 1 for w in want) and any(w[1] == 0 and w[0] > length for w in want)


def test_suffix_ranks_equal_sorting(spark):
    rng = random.Random(4)
    strings = [[rng.randint(1, 3) for _ in range(rng.randint(1, 40))] for _ in range(25)] + [[7] * 30, [7] * 11, [1], [2, 1], [5, 5, 5]]
    df = spark.createDataFrame(list(enumerate(strings)), "sid long, sym array<long>")
    suffixes = sorted(tuple(s[i:]) for s in strings for i in range(len(s)))
    place = {}
    for n, x in enumerate(suffixes):
        place.setdefault(x, n)
    ranks = {(r.sid, r.i): r.r for r in S.suffix_ranks(df, 100).collect()}
    assert ranks == {(k, i): place[tuple(s[i:])] for k, s in enumerate(strings) for i in range(len(s))}


def test_equal_strings_are_sampled_alike():
    rng = random.Random(5)
    for length in (400, 40):
        k, w = S.grid(length)
        for _ in range(20):
            common = prose(rng, length).encode()[:length]
            firsts = set()
            for _ in range(2):
                before = prose(rng, 50).encode()[:rng.randint(0, 150)]
                at, sym = S.samples(before + common + prose(rng, 50).encode(), length)
                i = int(np.searchsorted(at, len(before)))
                assert at[i] - len(before) < w
                firsts.add((int(at[i]) - len(before), int(sym[i])))
            assert len(firsts) == 1


def test_pieces_do_not_matter(monkeypatch):
    text = prose(random.Random(6), 2000).encode()
    want = S.samples(text, 400)
    monkeypatch.setattr(S, "PIECE", 700)
    have = S.samples(text, 400)
    assert (want[0] == have[0]).all() and (want[1] == have[1]).all()


def test_nulls_repeats_and_no_rows(spark):
    t = prose(random.Random(7), 120)
    df = docs_frame(spark, [(None, t), (4, t), (4, t), (5, None)])
    out = S.removed_bytes(df, 400).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted((r.n_removed, r.n_spans, r.kept_sha256) for r in out) == [(0, 0, empty)] + [(len(t.encode()), 1, empty)] * 3
    assert S.removed_bytes(df.where("false"), 400).collect() == []


def test_samples_are_as_sparse_as_equal_strings_allow():
    """A sample every 60 bytes or so: every one more costs a row in each step of the sort."""
    text = prose(random.Random(8), 20000).encode()
    at, _ = S.samples(text, 400)
    assert len(at) < len(text) / 58 and np.diff(at).max() <= S.grid(400)[1]


def test_a_union_counts_its_places_once():
    """Blocks cut off at both ends of a text of few starts are one place, not copies of each other."""
    text = prose(random.Random(9), 200).encode()[:402]
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text]), pa.array([[9, 5, 7]], pa.list_(pa.int32()))], ["tid", "text", "asked"])
    out = pa.Table.from_batches(S._blocks(400, 16, 16)([batch])).to_pylist()
    assert [(r["last"], r["low"], r["high"], r["new"]) for r in out] == [(5, 0, 2, 1), (7, 0, 2, 0), (9, 0, 2, 0)]
    assert len({(r["h1"], r["h2"]) for r in out}) == 1


def test_words_do_not_count_but_bytes(spark):
    """A passage of over 50 words under 400 bytes stays; one of 400 bytes goes."""
    rng = random.Random(10)
    under, at = " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(57)), "".join(rng.choices("abcdefghij", k=400))
    want = check(spark, [f"A{under}B", f"C{under}D", f"E{at}F", f"G{at}H"], 400)
    assert len(under.split()) > 50 and [w[1] for w in want] == [0, 0, 400, 400]
