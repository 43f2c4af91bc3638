"""Periodic run detection with a suffix automaton and link-cut access.

A run is a stretch of consecutive words with smallest period q and a length of at least
``max(shortest, least * q)`` that no neighbouring word extends keeping period q.

Method: the suffix automaton of the words is built; its links form a tree in which the
path from a prefix's state to the root holds all suffixes of that prefix.  Prefixes are
taken in order: ``access`` of a link-cut tree makes the path of prefix i one segment of
colour i and passes the segments that it cuts, each with its old colour j (the last end of
its strings) and its longest string L.  With d = i - j the last L + d words have smallest
period d (a smaller one would have been seen later than j), so L >= d is a square; where
L + d reaches the length of a run, it is extended word by word in both directions, once
per run.  A run shows itself at its own end with L = length - q, so none is missed.  The
cuts are O(log n) per word amortised.

Where the automaton runs: inside a run with g <= q < 2g (g a power of two), each of at least
``(least - 2) * g + 1`` consecutive words starts a g-gram that comes again within 2g - 1 words.
Stretches without that can't touch a run, whatever the hashes collide, so the automaton
gets the stretches that have it (``suspects``; numpy, whole batches at once) and extension
reads the whole document.

Memory: one document's words, and about 0.5 KB per word of a suspect stretch.

Edge cases: a null or blank text has no words, no runs and an empty collapsed text; repeated
rows are rows of their own; no rows give no rows; only the named columns and the text are
read, so other columns can't clash; ids of any type pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAST, SHORTEST = 4, 6
#: Bytes of text that go through ``suspects`` together (a longer text goes alone).
BATCH_BYTES = 1 << 21

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
FOUND = [T.StructField("runs", T.ArrayType(RUN)), T.StructField("top", RUN), T.StructField("collapsed", T.StringType())]


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(link, longest length) of every state of the suffix automaton, and the state of every prefix."""
    step: list[dict[int, int]] = [{}]
    link, size, ends, last = [-1], [0], [], 0
    for w in words:
        new = len(step)
        step.append({})
        link.append(0)
        size.append(size[last] + 1)
        at = last
        while at >= 0 and w not in step[at]:
            step[at][w] = new
            at = link[at]
        if at >= 0:
            old = step[at][w]
            if size[old] == size[at] + 1:
                link[new] = old
            else:
                twin = len(step)
                step.append(step[old].copy())
                link.append(link[old])
                size.append(size[at] + 1)
                while at >= 0 and step[at].get(w) == old:
                    step[at][w] = twin
                    at = link[at]
                link[old] = link[new] = twin
        ends.append(new)
        last = new
    return link, size, ends


def last_ends(link: list[int], size: list[int], ends: list[int]) -> Iterator[tuple[int, int, int]]:
    """(i, j, L): at prefix end i, the path segment whose strings (up to length L) ended at j before.

    Every preferred path of the link-cut tree is one splay tree, deeper states to the
    right; its root keeps the path's colour in ``seen``.  ``up`` is the splay parent, or
    at a splay root the state above the path.
    """
    up = [p if p > 0 else -1 for p in link]  # the empty string belongs to no segment
    left, right, seen = [-1] * len(link), [-1] * len(link), [-1] * len(link)

    def rotate(u: int) -> None:
        p = up[u]
        g = up[p]
        if left[p] == u:
            child = left[p] = right[u]
            right[u] = p
        else:
            child = right[p] = left[u]
            left[u] = p
        if child >= 0:
            up[child] = p
        if g >= 0:
            if left[g] == p:
                left[g] = u
            elif right[g] == p:
                right[g] = u
        up[u], up[p] = g, u

    def inner(u: int) -> bool:
        p = up[u]
        return p >= 0 and (left[p] == u or right[p] == u)

    def splay(u: int) -> None:
        while inner(u):
            p = up[u]
            if not inner(p):
                seen[u] = seen[p]
                rotate(u)
                return
            g = up[p]
            if not inner(g):
                seen[u] = seen[g]
            rotate(p if (left[g] == p) == (left[p] == u) else u)
            rotate(u)

    for i, state in enumerate(ends):
        u, below = state, -1
        while u >= 0:
            splay(u)
            j = seen[u]
            if j >= 0:
                yield i, j, size[u]
            deeper = right[u]
            if deeper >= 0:
                seen[deeper] = j
            right[u] = below
            below, u = u, up[u]
        seen[below] = i


def runs_inside(words: list[int], low: int, high: int, least: int, shortest: int) -> set[tuple[int, int, int]]:
    """(start, length, period) of every run of ``words`` that lies in ``[low, high)``, and maybe others."""
    found, until = set(), {}
    for i, j, longest in last_ends(*automaton(words[low:high])):
        period = i - j
        if longest + period < max(shortest, least * period) or until.get(period, -1) >= low + i:
            continue
        start, end = low + i - period - longest + 1, low + i
        while start > 0 and words[start - 1] == words[start - 1 + period]:
            start -= 1
        while end + 1 < len(words) and words[end + 1] == words[end + 1 - period]:
            end += 1
        until[period] = end
        found.add((start, end - start + 1, period))
    return found


def suspects(code: np.ndarray, doc: np.ndarray, ends: np.ndarray, least: int, shortest: int) -> list[tuple[int, int, int]]:
    """(document, low, high) of the stretches in which runs can lie, positions counted over all documents.

    ``code`` numbers the words, ``doc`` the document of each, ``ends`` the end of each document.
    """
    n = len(code)
    hashed = (code.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + doc.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    hashed ^= hashed >> np.uint64(29)
    hashed *= np.uint64(0xBF58476D1CE4E5B9)
    hashed ^= hashed >> np.uint64(32)
    at, g, power = np.arange(n), 1, 0xD6E8FEB86659FD93
    longest = int(np.diff(ends, prepend=0).max(initial=0))
    out = []
    while len(at) and least * g <= longest:
        own = hashed[at]
        order = np.argsort(own, kind="stable")
        same = own[order[1:]] == own[order[:-1]]
        gap = np.zeros(len(at), np.int64)  # 0: the gram doesn't come again
        gap[order[:-1][same]] = at[order[1:][same]] - at[order[:-1][same]]
        near = at[(gap > 0) & (gap < 2 * g)]
        if len(near):
            cut = np.flatnonzero((np.diff(near) != 1) | (doc[near[1:]] != doc[near[:-1]]))
            first, last = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(near) - 1]])
            wide = last - first + 1 >= max((least - 2) * g + 1, shortest - 3 * g + 2)
            for a, b in zip(near[first[wide]].tolist(), near[last[wide]].tolist()):
                d = int(doc[a])
                out.append((d, a, min(b + 3 * g - 1, int(ends[d]))))
        common = np.zeros(n + g, bool)  # starts of grams that are there twice
        common[at[order[:-1][same]]] = common[at[order[1:][same]]] = True
        at = at[common[at] & common[at + g]]
        at = at[at + 2 * g <= ends[doc[at]]]
        hashed[at] = hashed[at] * np.uint64(power) + hashed[at + g]
        g, power = 2 * g, power * power % (1 << 64)
    out.sort()
    merged: list[tuple[int, int, int]] = []
    for d, a, b in out:
        if merged and merged[-1][0] == d and a <= merged[-1][2]:
            merged[-1] = (d, merged[-1][1], max(b, merged[-1][2]))
        else:
            merged.append((d, a, b))
    return merged


def runs_of(texts: list[list[bytes]], least: int = LEAST, shortest: int = SHORTEST) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period), by start and period, of each word list."""
    ids: dict[bytes, int] = {}
    codes = [[ids.setdefault(w, len(ids)) for w in words] for words in texts]
    sizes = np.array([len(c) for c in codes], np.int64)
    ends = np.cumsum(sizes)
    flat = np.concatenate([np.array(c, np.int64) for c in codes]) if codes else np.zeros(0, np.int64)
    found: list[set] = [set() for _ in texts]
    for d, low, high in suspects(flat, np.repeat(np.arange(len(texts)), sizes), ends, least, shortest):
        first = int(ends[d] - sizes[d])
        found[d] |= runs_inside(codes[d], low - first, high - first, least, shortest)
    return [sorted(f, key=lambda r: (r[0], r[2])) for f in found]


def greatest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest exact length / period; ties: smallest start, then period."""
    best = None
    for r in runs:  # by start, then period
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that a run contains after its first period."""
    if not runs:
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    kept = (np.cumsum(drop[:-1]) == 0).tolist()
    return b" ".join([w for w, k in zip(words, kept) if k])


def _structs(rows: list[tuple[int, int, int] | None]) -> pa.Array:
    return pa.array([r and dict(zip(("start", "length", "period"), r)) for r in rows], pa.struct([(n, pa.int64()) for n in RUN.names]))


def _find(least: int, shortest: int):
    def parts(text: pa.Array) -> Iterator[tuple[int, int]]:
        sizes = text.cast(pa.large_binary()).fill_null(b"")
        bytes_before = np.frombuffer(sizes.buffers()[1], np.int64)[sizes.offset:sizes.offset + len(sizes) + 1]
        start = 0
        while start < len(text):
            end = max(start + 1, int(np.searchsorted(bytes_before, bytes_before[start] + BATCH_BYTES, "right")) - 1)
            yield start, min(end, len(text))
            start = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, end in parts(b.column("__text")) if b.num_rows else ():
                some = b.slice(start, end - start)
                words = [(t or b"").split() for t in some.column("__text").cast(pa.binary()).to_pylist()]
                runs = runs_of(words, least, shortest)
                flat = [r for rs in runs for r in rs]
                offsets = np.concatenate([[0], np.cumsum([len(rs) for rs in runs])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    *some.columns[:-1], pa.ListArray.from_arrays(pa.array(offsets), _structs(flat)),
                    _structs([greatest(rs) for rs in runs]),
                    pa.array([collapsed(w, rs) for w, rs in zip(words, runs)], pa.binary()).cast(pa.string())],
                    [*some.schema.names[:-1], *(f.name for f in FOUND)])

    return run


def find_runs(docs: DataFrame, keep: list[str], least: int = LEAST, shortest: int = SHORTEST) -> DataFrame:
    """Columns ``keep``, ``runs`` (start, length, period; by start, then period), ``top`` (the run of
    greatest exponent, null without runs) and ``collapsed`` (the text with every run cut to one period)."""
    rows = docs.select(*keep, F.col("text").alias("__text"))
    return rows.mapInArrow(_find(least, shortest), T.StructType([*docs.select(*keep).schema.fields, *FOUND]))


def repeat_tails(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The text in which one document in ten has its words from the a-th on replaced by repeats of p words.

    With h = crc32(doc_id) and g = floor(h / 10): documents with h % 10 = 0, a = g % n and
    p = 1 + floor((n - a) / (3 + g % 8)).  Rows without id or words stay as they are.
    """
    h = f"crc32(cast(cast({doc_id} as string) as binary))"
    words = rf"filter(split({text}, '[\\x20\\x09-\\x0D]+'), w -> w <> '')"
    # one-element arrays bind what is used in an inner lambda, so that it is computed once
    return F.expr(f"""case when {h} % 10 = 0 and {text} rlike '[^\\\\x20\\\\x09-\\\\x0D]' then
        transform(array({words}), ws -> transform(array(({h} div 10) % size(ws)), a ->
            transform(array(1 + (size(ws) - a) div (3 + ({h} div 10) % 8)), p ->
                concat_ws(' ', transform(sequence(0, size(ws) - 1), i -> ws[cast(if(i < a, i, a + (i - a) % p) as int)])))[0])[0])[0]
        else {text} end""")
