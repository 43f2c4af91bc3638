"""Vector codes against plain loops and SQL."""

import hashlib
import random

import duckdb
import numpy as np

from pitchside.llm import vector_codes as V
from pitchside.llm.queries import op13_vector_codes

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, parts, entries, rounds):
    """rows: (vec_id, vector, label) that are kept, of one length; (code, error) of each and the codebooks."""
    ints = [[int(np.floor(256 * x)) for x in v] for _, v, _ in rows]
    width = len(ints[0]) // parts if ints else 0
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is None, rows[r][0] or 0, rows[r][1]))[:entries]
    books = [[ints[r][p * width:(p + 1) * width] for r in order] for p in range(parts)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for v in ints:
                part = v[p * width:(p + 1) * width]
                held.setdefault(nearest(p, part)[1], []).append(part)
            books[p] = [[sum(c) // len(held[k]) for c in zip(*held[k])] if k in held else e for k, e in enumerate(books[p])]
    found = [[nearest(p, v[p * width:(p + 1) * width]) for p in range(parts)] for v in ints]
    return [("".join("%02x" % k for _, k in f), sum(d for d, _ in f)) for f in found], books


def digest(books):
    return hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def test_boxes_hold_what_lies_in_them():
    rng = np.random.default_rng(4)
    for n, dims, spread in ((1, 3, 5), (64, 4, 3), (64, 4, 1000), (40, 1, 8), (64, 6, 1 << 27)):
        entries = rng.integers(-spread, spread + 1, (n, dims))
        rows = rng.integers(-2 * spread, 2 * spread + 1, (500, dims))
        book = V.Slices(entries)
        radius = rng.integers(0, 3 * spread, 500)
        for row, r, mask in zip(rows, radius, book.box(rows, radius).tolist()):
            inside = (np.abs(entries - row) <= r).all(axis=1)
            assert mask == sum(1 << k for k in np.flatnonzero(inside).tolist())
        index, away = book.nearest(rows)
        full = ((rows[:, None, :].astype(object) - entries[None].astype(object)) ** 2).sum(axis=2)
        assert away.tolist() == full.min(axis=1).tolist() and index.tolist() == [list(f).index(min(f)) for f in full]


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    want = sorted(con.sql(V.ORACLE_SQL).fetchall())
    assert sorted(map(tuple, op13_vector_codes(spark, SF).collect())) == want


def report(spark, rows, extra=(), **kw):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", *extra)
    return df, V.compression_report(df, **kw)


def test_edge_rows(spark):
    rng = random.Random(7)
    good = [(rng.randrange(40), [round(rng.gauss(0, 1), 1) for _ in range(32)], rng.choice([1, 2, None])) for _ in range(150)]
    good += [(None, [0.5] * 32, 1), (90, [1e300, -1e300] + [0.0] * 30, 3), (91, [0.0] * 32, 3)] + [good[0]] * 50
    dropped = [(1, None, 1), (2, [None] + [0.0] * 31, 1), (3, [float("nan")] * 32, 1), (4, [float("inf")] + [1.0] * 31, 2)]
    other = [(5, [0.25] * 16, 2), (6, [], None), (7, [1.0] * 5, 2)]
    _, out = report(spark, good + dropped + other, ("1 as code", "2 as error", "3 as vec", "4 as __label"))
    clipped = [(i, [min(max(x, -V.LIMIT / 256), V.LIMIT / 256) for x in v], lab) for i, v, lab in good]
    want, books = brute(clipped, 16, 64, 2)
    by_label = {}
    for (_, _, lab), (_, e) in zip(good, want):
        by_label[lab] = by_label.get(lab, 0) + e
    rows = [(i, c, e, by_label[lab], digest(books)) for (i, _, lab), (c, e) in zip(good, want)]
    rows += [(i, None, None, by_label[lab], digest(books)) for i, _, lab in other]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(rows, key=str)


def test_other_shapes_and_hot_label(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([0.0, 0.1, 0.2]) for _ in range(12)], 7 if i % 3 else i) for i in range(300)]
    for parts, entries, rounds in ((4, 5, 3), (12, 1, 1), (3, 64, 0)):
        _, out = report(spark, rows, parts=parts, entries=entries, rounds=rounds)
        want, books = brute(rows, parts, entries, rounds)
        got = {r.vec_id: r for r in out.collect()}
        assert [(got[i].code, got[i].error) for i, _, _ in rows] == want and got[0].codebooks_sha256 == digest(books)
        assert got[1].label_error == sum(e for (_, _, lab), (_, e) in zip(rows, want) if lab == 7)


def test_no_rows_and_nothing_to_cut(spark):
    assert report(spark, [])[1].collect() == []
    assert report(spark, [(1, None, 1)])[1].collect() == []
    assert [tuple(r)[:4] for r in report(spark, [(1, [1.0] * 5, 1)])[1].collect()] == [(1, None, None, None)]
    assert [tuple(r)[:3] for r in report(spark, [(1, [1.0] * 16, 1)])[1].collect()] == [(1, "00" * 16, 0)]
