"""The scorer against a plain one: every window, word and n-gram by itself."""

import math
import random
import zlib

import numpy as np
from helpers import docs_frame, prose

from pitchside.llm import toxicity as T
from pitchside.llm.common import held_out, table
from pitchside.llm.queries import op3_toxicity

SF = "/root/testdata/sf0.01"
U64 = (1 << 64) - 1


def plain_subwords(word):
    marked = f"<{word}>"
    ids = [zlib.crc32(marked.encode()) % T.BUCKETS]
    for n in T.NGRAMS:
        for i in range(len(marked) - n + 1):
            h = 0
            for c in marked[i:i + n]:
                h = (h * 0x9E3779B97F4A7C15 + ord(c)) & U64
            ids.append((((h + n) * 0xD6E8FEB86659FD93 & U64) >> 33) % T.BUCKETS)
    return ids


def plain_score(model, text, seen):
    weights, slope, shift = model
    values = []
    for token in (text or "").lower().split():
        if token not in seen:
            ids = plain_subwords(token.strip(" .,;:!?\"'()[]{}"))
            seen[token] = sum(float(weights[i]) for i in ids) / len(ids)
        values.append(seen[token])
    worst = max((sum(values[s:s + 4]) / len(values[s:s + 4]) for s in range(0, max(len(values) - 2, 1), 2)), default=0.0) if values else 0.0
    z = slope * (worst + float(weights[-1])) + shift
    return 1 / (1 + math.exp(-min(max(z, -40), 40)))


def test_any_weights():
    rng, weights = random.Random(3), np.random.default_rng(3).normal(size=T.BUCKETS + 1)
    model = (weights, 1.7, -0.3)
    texts = [None, "", " ", "a", "...", "one two", "é (Übel), ß!", "x" * 50, "same " * 9, "🙂 🙂🙂 b"]
    texts += [prose(rng, rng.randrange(1, 60)) for _ in range(60)]
    seen = {}
    assert np.allclose(T.Scorer(model)(texts), [plain_score(model, t, seen) for t in texts], rtol=1e-9, atol=1e-12)


def test_query_scores_are_the_plain_ones(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = T.train(T.training_rows(docs, labels, ~held_out("doc_id", 5, 0)))
    got = {r.doc_id: r for r in op3_toxicity(spark, SF).collect()}
    seen = {}
    for r in docs.select("doc_id", "text").collect():
        want = plain_score(model, r.text, seen)
        assert math.isclose(got[r.doc_id].score, want, rel_tol=1e-6, abs_tol=1e-9)
        assert got[r.doc_id].predicted == int(got[r.doc_id].score >= 0.5)
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert len(got) == docs.count()


def test_a_very_long_text_scores_as_its_worst_window(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, 30) + (" vrakkel" if i % 3 == 0 else "")) for i in range(300)]
    labels = spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")
    clean = prose(rng, 150_000)
    docs = docs_frame(spark, rows + [(1000, clean), (1001, clean + " vrakkel vrakkel " + clean)])
    score = {r.doc_id: r.score for r in T.score_documents(docs, labels).where("doc_id >= 1000").collect()}
    assert score[1001] > score[1000] and score[1001] >= 0.5
