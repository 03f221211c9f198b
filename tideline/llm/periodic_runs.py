"""Maximal periodic runs of words within a text, by uniting suffix classes in order of descending LCP.

A run is a stretch of words whose smallest period is q, of length max(shortest, 2 q) at least, that no neighbouring word
extends. If it begins at s and ends before e, the suffixes at s and s + q share exactly e - s - q words, which is q or
more; no suffix between them shares as many with s. So when the classes of suffixes that share l words are made for
falling l, s and s + q become neighbours in the ordered positions of their class just at l = e - s - q. Every pair that
becomes adjacent at a distance of l or less therefore seeds a run, and it is the run's beginning unless the words before
the two positions agree. The smaller class goes into the larger one, so a position moves a logarithmic number of times.

Suffixes are sorted by doubling the length of named windows, only where a window of (shortest + 1) / 2 words occurs again
in the text: l is at least that in a run. A text is passed over at once if no block of m such places in a row has an
earlier occurrence within m + window - 1 words, which every run has; this test uses hashes that can only let more texts
through.

A null text has no words; null, empty and short texts have no runs; an empty table gives no rows. Each row gives a row,
repeated rows and rows without an id too. Extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import slices

BATCH = 8 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)


def can_repeat(words: list[bytes], shortest: int) -> bool:
    """False only for texts without runs."""
    window = (shortest + 1) // 2
    if len(words) < max(2, shortest):
        return False
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    n, named = len(h) - window + 1, np.zeros(len(h) - window + 1, np.uint64)
    for k in range(window):
        named = named * MIX + h[k : k + n]
    order = np.argsort(named, kind="stable")
    sorted_ = named[order]
    same = np.flatnonzero(sorted_[1:] == sorted_[:-1])
    if not len(same):
        return False
    at = order[same + 1]
    distance = at - order[same]
    by_place = np.argsort(at)
    at, distance = at[by_place], distance[by_place]
    first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    length = np.diff(np.append(first, len(at)))
    return bool((np.minimum.reduceat(distance, first) <= length + window - 1).any())


def sorted_suffixes(ids: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose window of words occurs again, ordered so that suffixes with a common beginning stand together, and
    how many words each shares with the one before it (0 if less than a window)."""
    n = len(ids)
    beyond = np.concatenate([ids, np.full(window, -1, np.int64)])  # the end of the text comes before all words
    columns = [beyond[k : k + n] for k in range(window)]
    order = np.lexsort(columns[::-1])
    new = np.zeros(n, bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[order[1:]] != c[order[:-1]]
    name = np.empty(n, np.int64)  # the rank of the window at a place
    name[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    order = order[~(new & np.append(new[1:], True))]
    levels, step, open_ = [name], window, order
    while len(open_):
        ahead = open_ + step
        inside = ahead < n
        key = np.where(inside, levels[-1][np.where(inside, ahead, 0)], -1)
        rank = levels[-1][open_]
        by = np.lexsort((key, rank))
        rank, key, open_ = rank[by], key[by], open_[by]
        new = np.ones(len(by), bool)
        new[1:] = (rank[1:] != rank[:-1]) | (key[1:] != key[:-1])
        group = np.ones(len(by), bool)
        group[1:] = rank[1:] != rank[:-1]
        at = np.arange(len(by))
        start = np.maximum.accumulate(np.where(group, at, 0))
        begin = np.maximum.accumulate(np.where(new, at, 0))
        name = levels[-1].copy()
        name[open_] = rank + begin - start
        levels.append(name)
        alone = new & np.append(new[1:], True)
        open_, step = open_[~alone], 2 * step
    order = order[np.argsort(levels[-1][order], kind="stable")]
    a, b = order[:-1], order[1:]
    shared = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + shared, b + shared
        inside = (x < n) & (y < n)
        same = inside & (levels[k][np.where(inside, x, 0)] == levels[k][np.where(inside, y, 0)])
        shared[same] += window << k
    going = shared > 0
    for _ in range(window - 1):
        x, y = a + shared, b + shared
        going = going & (x < n) & (y < n)
        going[going] = ids[x[going]] == ids[y[going]]
        shared[going] += 1
    return order, shared


def runs(words: list[bytes], shortest: int = 12) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period."""
    if not can_repeat(words, shortest):
        return []
    table: dict[bytes, int] = {}
    ids = np.fromiter((table.setdefault(w, len(table)) for w in words), np.int64, len(words))
    order, shared = sorted_suffixes(ids, (shortest + 1) // 2)
    edges = np.argsort(-shared, kind="stable")
    edges = edges[shared[edges] > 0]
    # ordered positions of each class; within a run a class grows to the right
    held: list[list[int] | None] = [[p] for p in order.tolist()]
    root, word, found = list(range(len(order))), ids.tolist(), {}
    for e, l in zip(edges.tolist(), shared[edges].tolist(), strict=True):
        x, y = e, e + 1
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        small, big = held[x], held[y]
        if len(small) > len(big):
            x, y, small, big = y, x, big, small
        root[x], held[x], moved = y, None, None
        for p in small:
            k = bisect(big, p)
            for i, j in ((big[k - 1], p) if k and big[k - 1] != moved else (0, 0), (p, big[k]) if k < len(big) else (0, 0)):
                q = j - i
                if 0 < q <= l and q + l >= shortest and (i == 0 or word[i - 1] != word[j - 1]):
                    found[i, j + l] = min(q, found.get((i, j + l), q))
            big.insert(k, p)
            moved = p
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """Words that no run contains after its first period."""
    if not found:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for s, n, q in found:
        depth[s + q] += 1
        depth[s + n] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def periodic_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shortest: int = 12) -> DataFrame:
    """One row per document: doc_id long, n_words long, runs array<struct<start, length, period>> (words from 0, sorted by
    start and period), kept_text: its words joined by single spaces, without those that a run repeats.

    Words are what stands between white space of ASCII.
    """
    if shortest < 2:
        raise ValueError("shortest must be 2 or more")
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH):
            counts, spans, kept = [], [], []
            for text in batch.column("text").to_pylist():
                words = text.encode().split()
                found = runs(words, shortest)
                counts.append(len(words))
                spans.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                kept.append(b" ".join(collapsed(words, found)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "kept_text"])

    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return base.mapInArrow(search, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, kept_text string")
