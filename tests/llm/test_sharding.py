import heapq
import random
import zlib
from collections import defaultdict

from helpers import docs_frame, prose

from pitchside.llm import sharding as S


def lpt(sizes, shards):
    heap = [(0, k) for k in range(shards)]
    for s in sorted(sizes, reverse=True):
        load, k = heapq.heappop(heap)
        heapq.heappush(heap, (load + s, k))
    return sorted(load for load, _ in heap)


def test_schedule_equals_plain_heap_on_exact_classes():
    rng = random.Random(1)
    for n, top in ((5, 50), (300, 40), (4000, 30), (1, 9)):
        sizes = [rng.randint(1, top) for _ in range(n)] + [top * 20]
        count = defaultdict(int)
        for s in sizes:
            count[s] += 1
        plan = S.schedule([(s, c, s * c) for s, c in count.items()], 16)
        loads = [0] * 16
        for s, upper, shards in plan:
            assert upper[-1] == count[s]
            for lo, hi, k in zip([0, *upper], upper, shards):
                loads[k] += s * (hi - lo)
        assert sorted(loads) == lpt(sizes, 16)


def test_documents(spark):
    rng = random.Random(2)
    texts = [prose(rng, rng.randint(1, 60)) for _ in range(250)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, texts[3]) for i in range(60)]
    rows += [(2000, None), (2001, ""), (2002, "é" * 5000), (None, "x"), (2003, texts[4]), (2003, texts[4])]
    df = docs_frame(spark, rows, "text as shard;doc_id as slot;1 as Group")
    out = S.shard_documents(df).collect()
    assert len(out) == len(rows)
    home, loads, slots = {}, defaultdict(int), defaultdict(list)
    for r in out:
        raw = (r.text or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
        assert home.setdefault(raw, r.shard) == r.shard
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    groups = defaultdict(int)
    for _, t in rows:
        groups[(t or "").encode()] += len((t or "").encode()) + 1
    best = lpt(groups.values(), 16)
    assert max(loads.values()) == best[-1] and max(loads.values()) - min(loads.values()) <= (best[-1] - best[0]) * 1.01 + 50
    small = S.shard_documents(df, keep=["doc_id"])
    assert small.columns == ["doc_id", "size", "text_crc32", "shard", "slot"]
    assert sorted(map(str, small.collect())) == sorted(
        str(r) for r in S.shard_documents(df).select(*small.columns).collect())


def test_empty_table(spark):
    assert S.shard_documents(docs_frame(spark, [(1, "x")]).where("false")).collect() == []
