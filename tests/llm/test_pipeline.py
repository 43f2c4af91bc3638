"""The pipeline against brute-force versions of its stages, each on its own input."""

import random
import tempfile
from collections import Counter, defaultdict

import corpus_pipeline as P
from helpers import brute_components, brute_fingerprint, docs_frame, prose
from test_decontam import brute_edits
from test_mixing import brute as brute_mix

from pitchside.llm.common import saved
from pitchside.llm.decontam import normal


def tables(spark, rng):
    rows = []
    for i in range(220):
        text = prose(rng, rng.randint(30, 120))
        if i % 9 == 0:
            text += " vrakkel smodder"
        rows.append((i, text, "en", rng.choice(["a", "a", "a", "b", "c", None])))
    rows += [(300 + i, rows[i][1] + (" tail" if i % 2 else ""), "en", "b") for i in range(1, 40)]
    items = [(i, prose(rng, 25)) for i in range(4)]
    rows += [(400 + i, prose(rng, 20) + " " + items[i % 4][1] + " " + prose(rng, 20), "en", "c") for i in range(8)]
    rows += [(500, None, None, None), (501, "", None, "a"), (None, prose(rng, 30), "en", "a"), (7, rows[7][1], "en", rows[7][3])]
    d = tempfile.mkdtemp(prefix="pitchside-pipeline-")
    docs_frame(spark, rows).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int("vrakkel" in (t or ""))) for i, t, *_ in rows if i is not None and i < 220],
                          "doc_id long, quality int, toxic int").distinct().write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, items


def test_stages_and_run(spark):
    d, items = tables(spark, random.Random(11))
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns = docs.columns
    ids = lambda df: Counter(r.doc_id for r in df.select("doc_id").collect())

    out = saved(P.toxicity(spark, docs, d), "t1")
    assert out.columns == columns
    kept = ids(out)
    toxic = {r.doc_id for r in docs.where("text like '%vrakkel%'").collect()}
    clean = {r.doc_id for r in docs.where("text is null or text not like '%vrakkel%'").collect()}
    assert not toxic & set(kept) and clean <= set(kept)

    rows, out = out.collect(), saved(P.simhash_near_dedup(spark, out, d), "t2")
    fp = {r.doc_id: brute_fingerprint(r.text) for r in rows if r.doc_id is not None}
    root = brute_components(list(fp), lambda a, b: (fp[a] ^ fp[b]).bit_count() <= 3)
    assert out.columns == columns and ids(out) == Counter([i for i in fp if root[i] == i] + [None])
    assert len(fp) > len(set(root.values()))

    rows, out = out.collect(), saved(P.decontamination(spark, out, d), "t3")
    leaked = {r.doc_id for r in rows for _, t in items if brute_edits(normal(t), normal(r.text)) <= int(0.08 * len(normal(t)))}
    assert leaked >= set(range(400, 408)) & {r.doc_id for r in rows} and len(leaked) >= 4
    assert out.columns == columns and ids(out) == Counter(r.doc_id for r in rows if r.doc_id not in leaked)

    rows, out = out.collect(), saved(P.mixing(spark, out, d), "t4")
    want = {None if i == -1 else i: round(v[3] / v[0]) if v[0] else 1 for i, v in brute_mix([(r.doc_id, r.text, r.lang, r.source) for r in rows]).items()}
    assert out.columns == columns and ids(out) == Counter({i: n for i, n in want.items() if n})

    final = P.sharding(spark, out, d).collect()
    assert Counter(r.doc_id for r in final) == ids(out)
    slots, home = defaultdict(list), {}
    for r in final:
        slots[r.shard].append(r.slot)
        assert home.setdefault(r.text or "", r.shard) == r.shard
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert Counter(map(str, P.run(spark, d).collect())) == Counter(map(str, final))


def test_empty_documents(spark):
    d, _ = tables(spark, random.Random(12))
    e = tempfile.mkdtemp(prefix="pitchside-pipeline-")
    for t in ("documents", "labels", "benchmark"):
        df = spark.read.parquet(f"{d}/{t}.parquet")
        (df.where("false") if t == "documents" else df).write.parquet(f"{e}/{t}.parquet")
    assert P.run(spark, e).count() == 0
