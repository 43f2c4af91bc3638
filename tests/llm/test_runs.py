"""Periodic runs against brute force: every period, every stretch."""

import hashlib
import random
import zlib

from helpers import docs_frame
from pitchside.llm import runs as R
from pitchside.llm.queries import op11_periodic_runs

SF = "/root/testdata/sf0.01"


def brute_runs(w, least=4, shortest=6):
    out = []
    for q in range(1, len(w) // least + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            length = i + q - start
            smaller = any(all(w[k] == w[k + p] for k in range(start, start + length - p)) for p in range(1, q))
            if length >= max(shortest, least * q) and not smaller:
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, text):
    w = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if doc_id is None or h % 10 or not n:
        return w
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    return [w[i if i < a else a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    w = planted(doc_id, text)
    runs = brute_runs(w)
    drop = {k for s, n, q in runs for k in range(s + q, s + n)}
    top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    return (len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in drop)).hexdigest())


def repetitive(rng, letters, n):
    w = []
    while len(w) < n:
        w += [rng.randrange(letters) for _ in range(rng.randrange(1, 9))] * rng.choice([1, 1, 2, 4, 5, 7])
        if rng.random() < 0.3:
            w.pop()
    return [b"%d" % x for x in w]


def test_runs_equal_brute_force_at_several_exponents():
    rng = random.Random(5)
    for _ in range(250):
        texts = [repetitive(rng, rng.choice([1, 2, 3, 20]), rng.choice([0, 5, 30, 120])) for _ in range(4)]
        for least, shortest in ((4, 6), (2, 2), (3, 5)):
            assert R.runs_of(texts, least, shortest) == [brute_runs(w, least, shortest) for w in texts]


def test_segments_of_the_link_cut_tree_are_the_last_ends():
    rng = random.Random(8)
    for _ in range(60):
        w = [rng.randrange(3) for _ in range(rng.randrange(1, 40))]
        seen = {}
        for i, j, longest in R.last_ends(*R.automaton(w)):
            seen.setdefault(i, []).append((j, longest))
        for i in range(len(w)):
            last = {}  # end before i of every suffix of w[:i + 1] by its length
            for n in range(1, i + 2):
                ends = [e for e in range(n - 1, i) if w[e - n + 1:e + 1] == w[i - n + 1:i + 1]]
                if ends:
                    last[n] = max(ends)
            assert sorted(seen.get(i, [])) == sorted((j, max(n for n in last if last[n] == j)) for j in set(last.values()))


def test_long_texts_and_long_periods():
    rng = random.Random(2)
    base = [b"w%d" % rng.randrange(5000) for _ in range(30_000)]
    tail = [b"x%d" % i for i in range(9_000)] * 5
    text = base + tail[:40_000] + [b"ha"] * 70_000 + base
    runs = R.runs_of([text])[0]
    assert (30_000, 40_000, 9_000) in runs and (70_000, 70_000, 1) in runs
    kept = R.collapsed(text, runs).split()
    assert kept[30_000:39_000] == tail[:9_000] and kept.count(b"ha") == 1 and kept[-30_000:] == R.collapsed(base, R.runs_of([base])[0]).split()


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op11_periodic_runs(spark, SF).collect()
    assert len(got) == len(docs)
    short = [r for r in got if len((docs[r.doc_id] or "").split()) < 600]
    assert len(short) > 700 and sum(r.n_runs for r in short) > 100
    for r in short:
        assert tuple(r)[1:] == expected(r.doc_id, docs[r.doc_id]), r.doc_id


def test_edge_rows(spark, scratch):
    rng = random.Random(4)
    texts = [None, "", " \t\n ", "a " * 7, "a\x0bb\x0ca\rb a b a b", "é é é é é é", "a a a a a", "x y z x y z x y z x y z"]
    rows = [(i, t) for i, t in enumerate(texts * 9)] + [(None, "b b b b b b b b"), (3, texts[3]), (3, texts[3])]
    rows += [(1000 + i, b" ".join(repetitive(rng, 3, 200)).decode()) for i in range(40)]
    docs = docs_frame(spark, rows, "1 as runs;2 as top;3 as `collapsed`;4 as __text")
    docs.write.parquet(f"{scratch}/documents.parquet")
    got = sorted(map(tuple, op11_periodic_runs(spark, scratch).collect()), key=str)
    assert got == sorted([(r[0], *expected(*r)) for r in rows], key=str)


def test_empty_table(spark, scratch):
    docs_frame(spark, []).write.parquet(f"{scratch}/documents.parquet")
    assert op11_periodic_runs(spark, scratch).collect() == []
