import math

import numpy as np
import pytest
from helpers import brute_components

from pitchside.llm import embed_dedup as E

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(i, v, label):
    return i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, least=0.98):
    """vec_id -> (n_links, component, kept), in double precision over all pairs."""
    ok = {i: (np.float32(v).astype(float), label) for i, v, label in rows if usable(i, v, label)}

    def linked(a, b):
        (x, p), (y, q) = ok[a], ok[b]
        return p == q and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= least

    root = brute_components(list(ok), linked)
    out = {i: (0, i, True) for i, v, label in rows}
    for i in ok:
        out[i] = (sum(i != j and linked(i, j) for j in ok), root[i], root[i] == i)
    return out


def clusters(rng, dims, n, spread):
    rows, i = [], 0
    for _ in range(n):
        base = rng.normal(size=dims)
        base /= np.linalg.norm(base)
        for _ in range(int(rng.choice([1, 1, 2, 3, 25]))):
            noise = rng.normal(size=dims) / math.sqrt(dims)
            rows.append((i, (base + spread * rng.random() * noise).astype(np.float32).tolist(), int(rng.integers(0, 2))))
            i += 1
    return rows


def got(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "vec_id as vid", "label as links")
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in E.embedding_components(df).collect()}


@pytest.mark.parametrize("block", [E.BLOCK, 5])
def test_recall_and_precision_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(E, "BLOCK", block)
    rows = clusters(np.random.default_rng(3), 64, 60, 0.25)
    want, have = brute(rows), got(spark, rows)
    found, true = sum(v[0] for v in have.values()), sum(v[0] for v in want.values())
    assert true > 1500 and found >= 0.99 * true and all(have[i][0] <= want[i][0] for i in want)
    assert np.mean([have[i] == want[i] for i in want]) > 0.97


def test_exact_on_close_copies_and_edges(spark):
    rng = np.random.default_rng(4)
    rows = clusters(rng, 16, 20, 0.05)
    v = rows[0][1]
    odd = [(500, None, 0), (501, [], 0), (502, [0.0] * 16, 0), (503, [None] + v[1:], 0), (504, [math.nan] + v[1:], 0),
           (505, [math.inf] + v[1:], 0), (506, v, None), (507, v, rows[0][2]), (508, v[:5], 0), (509, v[:5], 0),
           (510, [x * 7 for x in v], rows[0][2]), (511, [1e-38] * 16, 1), (512, [3e38] * 16, 1)]
    rows += odd
    assert got(spark, rows) == brute(rows)


def test_null_ids_repeats_and_no_rows(spark):
    v = [1.0, 2.0, 3.0]
    df = spark.createDataFrame([(None, v, 1), (3, v, 1), (3, v, 1), (4, v, 1)], SCHEMA)
    out = sorted(((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in E.embedding_components(df).collect()), key=str)
    assert out == sorted([(-1, 0, None, True), (3, 2, 3, True), (3, 2, 3, True), (4, 2, 3, False)], key=str)
    assert E.embedding_components(df.where("false")).collect() == []
    same_id = spark.createDataFrame([(3, v, 1), (3, [5.0, -1.0, 0.0], 1)], SCHEMA)
    assert [(r.n_links, r.component_id) for r in E.embedding_components(same_id).collect()] == [(0, 3)] * 2


def test_vectors_that_share_an_id_all_link(spark):
    """Every vector of a vec_id is compared; a component's id is the least vec_id in it."""
    a, b = [1.0, 2.0, 3.0], [5.0, -1.0, 0.0]
    rows = [(3, a, 1), (3, b, 1), (7, [2.0, 4.0, 6.1], 1), (9, [5.1, -1.0, 0.0], 1), (9, [0.0, 0.0, 1.0], 1), (1, [5.0, -1.0, 0.1], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in E.embedding_components(df).collect())
    assert out == [(1, 2, 1, True), (3, 1, 3, True), (3, 2, 1, False), (7, 1, 3, False), (9, 0, 9, True), (9, 2, 1, False)]


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(5)
    x = E._unit(rng.normal(size=(400, 64)))
    y = E._unit(x + 0.5 * rng.normal(size=x.shape) / 8)
    turned, sign, factor, bound = E.Coder(64).codes(x)
    est = np.einsum("ij,ij->i", sign, (y @ E.Coder(64).turns[0])) / factor
    err = est - np.einsum("ij,ij->i", x, y)
    assert abs(err.mean()) < 0.02 and (np.abs(err) <= bound).all()
