import hashlib
import random
from collections import defaultdict

from helpers import docs_frame, prose, words_of

from pitchside.llm import mixing as M


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    """Reshare the excess by weight until no target is above its cap."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= most * sizes[s]}
        if not over:
            target.update({s: left * weight[s] / total for s in open_})
            break
        for s in over:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def brute(rows):
    md5 = lambda b: hashlib.md5(b).hexdigest()
    by = defaultdict(list)
    for i, t, _, s in rows:
        k = md5(f"{'' if i is None else i}:{s or ''}:{md5((t or '').encode())}".encode())
        by[s].append((k, -1 if i is None else i, len(words_of(t))))
    sizes = {s: sum(x[2] for x in v) for s, v in by.items()}
    target, out = brute_targets(sizes), {}
    for s, v in by.items():
        budget, before = round(target[s]), 0
        epochs = budget // sizes[s] if sizes[s] else 0
        for _, i, n in sorted(v):
            out[i] = (n, sizes[s], round(target[s], 4), epochs * n + max(0, min(n, budget - epochs * sizes[s] - before)))
            before += n
    return out


def table(rng):
    rows = [(i, prose(rng, rng.randint(0, 40)), "en", rng.choice(["a", "a", "a", "a", "b", "c", "d", "é", None])) for i in range(300)]
    return rows + [(900, None, None, "a"), (901, "", None, None), (902, "x y z", None, "tiny"), (903, None, None, "empty")]


def test_matches_brute_force(spark):
    rows = table(random.Random(3))
    df = docs_frame(spark, rows, "text as size;text as target")
    got = {r.doc_id: (r.size, r.source_size, round(r.target, 4), r.taken) for r in M.mix_to_weights(df).collect()}
    assert got == brute(rows)
    again = {r.doc_id: r.taken for r in M.mix_to_weights(df.repartition(7)).collect()}
    assert again == {i: v[3] for i, v in got.items()}
    total = sum(v[0] for v in got.values())
    assert abs(sum(v[3] for v in got.values()) - total) <= 5 and all(v[3] <= 3 * v[0] for v in got.values())


def test_documents_of_the_mix(spark):
    rows = table(random.Random(4))
    df = docs_frame(spark, rows)
    want = {i: 1 if not v[0] else round(v[3] / v[0]) for i, v in brute(rows).items()}
    got = {r.doc_id: r["count"] for r in M.mixed_documents(df).groupBy("doc_id").count().collect()}
    assert got == {i: n for i, n in want.items() if n}
    assert M.mixed_documents(df).columns == df.columns


def test_empty_nulls_and_repeats(spark):
    df = docs_frame(spark, [(1, "a b", None, "s")])
    assert M.mix_to_weights(df.where("false")).collect() == [] and M.mixed_documents(df.where("false")).collect() == []
    same = docs_frame(spark, [(None, "a b c", None, None)] * 4 + [(7, "d", None, "z")])
    out = M.mix_to_weights(same).collect()
    assert sum(r.taken for r in out) == 13 and len(out) == 5
    none = M.mix_to_weights(docs_frame(spark, [(1, None, None, "s"), (2, "", None, None)])).collect()
    assert [(r.size, r.target, r.taken) for r in none] == [(0, 0.0, 0)] * 2
