"""MinHash near-duplicate groups: one-permutation hashing, optimal densification, banded buckets, star-shaped edges.

A document's set holds its distinct 5-word shingles (A-Z lower-cased, words split at ASCII white space; fewer words: the
whole sequence as one). Documents with equal sets are one node. Each node gets one hash per shingle; the smallest hash
of each bin is its signature and empty bins borrow from a bin that a 2-universal probe sequence picks (the probe depends
on the bin alone, so equal sets borrow alike). Bands of the signature are buckets.

Candidates are star-shaped: each bucket links its members to its smallest node, first inside a task, then over all
tasks, so a bucket meets in one place with its tasks' centres only and pairs stay linear in the members. Nodes are
hashes, so the same few nodes are the centres of a group in all bands and a member has few distinct centres; the
smallest one is tried first, the others only if that has not joined the two.

A star can miss a link between two leaves; therefore buckets whose members have not come together in one component
after the stars are compared exactly: in buckets of a few members pair by pair, where set sizes and 1-bit sketches rule
out nearly all pairs before any is made, and in larger buckets block by block, where only a forest of links leaves a
task. All candidates are confirmed on full sets. Components are found with alternating large and small stars; what hangs
on one centre is salted.

Null and empty texts have an empty set, are linked with nothing, and keep their own id; an empty table gives no rows.
Ties go to the smallest id. Each row of the input gives one row, also if rows repeat; rows that share an id but not the
text are judged one by one. A row without an id is linked like any other and is kept only if its component has no id at
all. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import LOWER, gives_back, keep_only, materialize, slices

WIDTH = 5
BINS, ROWS = 256, 5
BANDS = BINS // ROWS
MOST_WORDS = 250_000
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
#: Documents whose buckets are reduced in a task before they are shuffled.
CHUNK = 1 << 14
HEAD = ("ids", "first_id", "n_shingles", "node", "at", "b0", "b1", "b2", "b3", "own", "held")
_KEYED = pa.list_(pa.struct([("key", pa.int64()), ("centre", pa.int64())]))
ARROW_TOLD = pa.schema(list(zip(HEAD, (pa.list_(pa.int64()), *[pa.int64()] * 8, pa.list_(pa.int64()), _KEYED), strict=True)))
#: Parts into which the rows that meet one hot key are dealt.
SALTS = 16
#: Odd multipliers by which the word hashes of a shingle are summed.
_PLACES = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads each bit over all."""
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > MOST_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_words = WordHashes()


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    keep_only(_words)
    split = [(t or "").encode().translate(LOWER).split() for t in texts]
    hashes = np.array([_words[w] for own in split for w in own], np.uint64)
    sums = np.zeros(max(0, len(hashes) - WIDTH + 1), np.uint64)
    for k in range(WIDTH):
        sums += mix(hashes[k : k + len(sums)] + _PLACES[k]) * _PLACES[k]
    sums = mix(sums)
    out, at = [], 0
    for own in split:
        n = len(own)
        if n >= WIDTH:
            out.append(np.unique(sums[at : at + n - WIDTH + 1]))
        elif n:
            whole = np.uint64(xxhash.xxh64_intdigest(b" ".join(own), seed=n))
            out.append(np.array([whole], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
        at += n
    return out


def _probes() -> np.ndarray:
    """For each bin a long sequence of bins to borrow from."""
    i, j = np.meshgrid(np.arange(BINS, dtype=np.uint64), np.arange(8 * BINS, dtype=np.uint64), indexing="ij")
    return (mix(i * np.uint64(0x9E3779B97F4A7C15) + mix(j + np.uint64(77))) % np.uint64(BINS)).astype(np.int64)


_PROBES = _probes()


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """For each sorted non-empty set one row: the smallest hash of each bin, densified."""
    n = len(sets)
    shingles = np.concatenate(sets) if n else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(n, dtype=np.int64), [len(s) for s in sets])
    cell = owner * BINS + (shingles >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(cell, prepend=-1))
    full, values = np.zeros(n * BINS, bool), np.zeros(n * BINS, np.uint64)
    full[cell[first]] = True
    values[cell[first]] = shingles[first]
    empty = np.flatnonzero(~full)
    base, bins = empty - empty % BINS, empty % BINS
    for probe in _PROBES.T:
        if not len(empty):
            break
        source = base + probe[bins]
        hit = full[source]
        values[empty[hit]] = values[source[hit]]
        empty, base, bins = empty[~hit], base[~hit], bins[~hit]
    if len(empty):  # a probe sequence that meets no full bin ends at the first one
        lowest = first[np.searchsorted(cell[first], base)]
        values[empty] = shingles[lowest]
    return values.reshape(n, BINS)


def band_keys(values: np.ndarray) -> np.ndarray:
    """For each signature one bucket key for each band; the band's number goes into it."""
    bands = mix(values[:, : BANDS * ROWS]).reshape(len(values), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), bands.shape[:2])
    for k in range(ROWS):
        key = mix(key * _M1 + bands[:, :, k])
    return key


def sketches(values: np.ndarray) -> np.ndarray:
    """One bit of each bin's value, 256 bits in four words for each signature."""
    return np.packbits((mix(values) >> np.uint64(63)).astype(np.uint8), axis=1).view(np.uint64)


def _stars(nodes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centre (smallest node) of each bucket of distinct ascending nodes, and whether it holds another node."""
    _, first, inverse, counts = np.unique(keys.ravel(), return_index=True, return_inverse=True, return_counts=True)
    return nodes[first // BANDS][inverse].reshape(keys.shape), (counts > 1)[inverse].reshape(keys.shape)


#: Rows of `describe`: the documents of a chunk that have one set, and what is known of it.
TOLD = "ids array<long>, first_id long, n_shingles long, node long, at long, b0 long, b1 long, b2 long, b3 long, own array<long>, held array<struct<key:long,centre:long>>"


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), values)


def _chunk(ids: list[int | None], at: np.ndarray, nodes: np.ndarray, counts: np.ndarray, keys: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
    """One row for each distinct node of a chunk; ids of equal nodes come together."""
    distinct, first, inverse = np.unique(nodes, return_index=True, return_inverse=True)
    by = np.argsort(inverse, kind="stable")
    owned = [ids[i] for i in by.tolist()]
    sizes = np.bincount(inverse, minlength=len(distinct))
    ends = np.cumsum(sizes)
    lowest = [min((x for x in owned[e - n : e] if x is not None), default=None) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
    # by node as a signed number, as Spark compares it
    order = np.argsort(distinct.view(np.int64), kind="stable")
    keys, bits = keys[first[order]], bits[first[order]]
    signed = distinct.view(np.int64)[order]
    centres, shared = _stars(signed, keys)
    own = centres == signed[:, None]
    columns = [
        _lists(pa.array(owned, pa.int64()), sizes).take(pa.array(order)),
        pa.array(lowest, pa.int64()).take(pa.array(order)),
        pa.array(counts[first[order]]),
        pa.array(signed),
        pa.array(at[first[order]]),
        *(pa.array(bits[:, k].view(np.int64)) for k in range(4)),
        _lists(pa.array(keys[own].view(np.int64)), own.sum(1)),
        _lists(pa.StructArray.from_arrays([pa.array(keys[shared].view(np.int64)), pa.array(centres[shared])], names=["key", "centre"]), shared.sum(1)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=list(HEAD))


def describe(docs: DataFrame) -> DataFrame:
    """One row for each set of a chunk of documents: ids (its documents), node (hash of the set, null if it is empty),
    n_shingles, at (where one of its texts is), sketch, own (keys of the buckets whose centre in the chunk it is), held (key and centre of the buckets that
    it shares with another node of the chunk)."""

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        parts: list[tuple[np.ndarray, ...]] = []
        for batch in slices(batches, "text", 1 << 20):
            sets, owners = shingle_sets(batch.column("text").to_pylist()), batch.column("doc_id").to_pylist()
            bare = [i for i, s in zip(owners, sets, strict=True) if not len(s)]
            if bare:
                yield pa.RecordBatch.from_pylist([dict(zip(HEAD, (bare, None, 0, *[None] * 8), strict=True))], ARROW_TOLD)
            some = np.array([len(s) > 0 for s in sets])
            sets, owners = [s for s in sets if len(s)], [i for i, x in zip(owners, some, strict=True) if x]
            if sets:
                values = signatures(sets)
                nodes = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64)
                parts.append((batch.column("at").to_numpy()[some], nodes, np.array([len(s) for s in sets], np.int64), band_keys(values), sketches(values)))
                ids += owners
            if len(ids) >= CHUNK:
                yield _chunk(ids, *(np.concatenate(x) for x in zip(*parts, strict=True)))
                ids, parts = [], []
        if ids:
            yield _chunk(ids, *(np.concatenate(x) for x in zip(*parts, strict=True)))

    return docs.select("doc_id", "text", "at").mapInArrow(run, TOLD)


def full_sets(docs: DataFrame) -> DataFrame:
    """node and its set of shingle hashes, once a task, for texts (node, text) that may have that set."""

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in slices(batches, "text", 1 << 20):
            nodes, sets = [], []
            for node, s in zip(batch.column("node").to_pylist(), shingle_sets(batch.column("text").to_pylist()), strict=True):
                if node not in done and np.uint64(xxhash.xxh64_intdigest(s.tobytes())).view(np.int64) == node:
                    done.add(node)
                    nodes.append(node)
                    sets.append(s.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])

    return docs.select("node", "text").mapInArrow(run, "node long, shingles array<long>")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose full sets have 100 * intersection >= percent * union."""

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            x, y = batch.column("x"), batch.column("y")
            xo, xv, yo, yv = x.offsets.to_numpy(), x.values.to_numpy().view(np.uint64), y.offsets.to_numpy(), y.values.to_numpy().view(np.uint64)
            for i in range(batch.num_rows):
                p, q = xv[xo[i] : xo[i + 1]], yv[yo[i] : yo[i + 1]]
                at = np.searchsorted(p, q)
                at[at == len(p)] = 0
                common = int((p[at] == q).sum()) if len(p) else 0
                ok.append(100 * common >= percent * (len(p) + len(q) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _spread(rows: DataFrame, few: DataFrame, on: list[str], by: str) -> DataFrame:
    """rows joined to `few` (one row for each key); the rows of a key are dealt to SALTS parts by their column `by`."""
    rows = rows.withColumn("salt", F.pmod(F.xxhash64(by, F.lit(3)), F.lit(SALTS)).cast("int"))
    few = few.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(few, [*on, "salt"]).drop("salt")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): node, root (its smallest node), by alternating large and small stars."""
    now = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    while True:
        # settled: every node hangs on one root, and no root hangs on another node
        ends = now.select(F.col("a").alias("node"), F.col("b").alias("low"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
        ends = ends.union(now.select("b", "b", F.lit(0), F.lit(1))).groupBy("node").agg(F.min("low").alias("m"), F.sum("hangs").alias("n"), F.max("holds").alias("holds"))
        ends = materialize(ends)
        if not ends.where("n + holds > 1").limit(1).count():
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        # a centre hands its smallest neighbour to all that hang on it, and these join their smallest ones together
        centres = ends.where("holds = 1").select(F.col("node").alias("b"), "m")
        large = _spread(now, centres, ["b"], "a").select("a", F.col("m").alias("b"))
        small = large.withColumn("m", F.min("b").over(Window.partitionBy("a"))).select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        now = materialize(small.where("a <> b").distinct())


def near_duplicates(docs: DataFrame, *, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable), kept."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("at", F.xxhash64("doc_id", "text"))
    told = materialize(describe(base))
    named = told.where("node is not null")
    sizes = materialize(named.groupBy("node").agg(F.min("first_id").alias("first_id"), *(F.max(c).alias(c) for c in ("n_shingles", "at", *SKETCH))))

    # buckets: the centres of the chunks meet, and members follow their chunk's centre
    heads, bucket = named.select(F.explode("own").alias("key"), "node"), Window.partitionBy("key")
    heads = heads.select("key", "node", F.min("node").over(bucket).alias("centre"), F.max("node").over(bucket).alias("last")).where("centre < last")
    held = named.select("node", F.explode("held").alias("at")).select("at.key", "node", "at.centre")
    members = materialize(heads.select("key", "node", "centre").union(held))

    def close(pairs: DataFrame) -> DataFrame:
        """Pairs whose set sizes and sketches do not rule the link out."""
        a, b = (sizes.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n{x}"), *(F.col(c).alias(f"{c}_{x}") for c in SKETCH)) for x in "ab")
        return pairs.join(a, "a").join(b, "b").where(_near(percent)).select("a", "b")

    def sets_of(nodes: DataFrame) -> DataFrame:
        """Full sets of nodes, made anew from one text of each."""
        return materialize(full_sets(base.join(nodes.join(sizes.select("node", "at"), "node"), "at")))

    stars = close(members.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct())
    stars = materialize(stars.withColumn("m", F.min("a").over(Window.partitionBy("b"))))
    sets = sets_of(stars.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    first = materialize(confirm(stars.where("a = m").select("a", "b"), sets, percent))
    x, y = (first.select(F.col("b").alias(c), F.col("a").alias(f"hub_{c}")) for c in "ab")
    apart = F.coalesce("hub_a", "a") != F.coalesce("hub_b", "b")
    second = confirm(stars.where("a <> m").select("a", "b").join(x, "a", "left").join(y, "b", "left").where(apart).select("a", "b"), sets, percent)
    roots = components(first.union(second))

    # buckets that still hold more than one component
    labelled = members.select("key", "node").join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    mixed = labelled.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("key")
    mixed = _spread(labelled, materialize(mixed), ["key"], "node").distinct()
    left = materialize(mixed.join(sizes.drop("first_id", "at"), "node"))
    counts = materialize(left.groupBy("key").agg(F.count("*").alias("members"), F.min("node").alias("centre")))
    left = materialize(_spread(left, counts, ["key"], "node"))
    columns = ("node", "root", "n_shingles", *SKETCH)
    p, q = (left.where(F.col("members") <= FEW).select("key", *(F.col(c).alias(f"{c}_{x}") for c in columns)) for x in "ab")
    p, q = p.withColumnsRenamed({"node_a": "a", "n_shingles_a": "na"}), q.withColumnsRenamed({"node_b": "b", "n_shingles_b": "nb"})
    pairs = materialize(p.join(q, "key").where((F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b")) & _near(percent)).select("a", "b").distinct())
    large = left.where(F.col("members") > FEW)
    asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).union(large.select("node")).distinct()
    sets = sets.union(sets_of(asked.join(sets.select("node"), "node", "left_anti")))
    links = [roots.select(F.col("node").alias("a"), F.col("root").alias("b")), confirm(pairs, sets, percent)]
    if not large.isEmpty():
        links.append(_by_blocks(large, sets, percent))
    roots = components(reduce(DataFrame.union, links))

    # a component is named by its smallest document
    linked = materialize(sizes.select("node", "first_id").join(roots.union(roots.select("root", "root").distinct()), "node"))
    lowest = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = _spread(linked.drop("first_id"), lowest, ["root"], "node").select("node", "component_id")
    alone = sizes.join(labels.select("node"), "node", "left_anti").select("node", F.col("first_id").alias("component_id"))
    out = told.select("ids", "n_shingles", "node").join(labels.union(alone), "node", "left").select(F.explode("ids").alias("doc_id"), "n_shingles", "node", "component_id")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), own.eqNullSafe(F.col("doc_id")).alias("kept"))


#: Columns of the sketch.
SKETCH = ("b0", "b1", "b2", "b3")
#: Buckets of so many members are compared pair by pair; larger ones meet in blocks.
FEW = 16
#: A block holds sets of so many shingles, each set counting BLOCK_BASE more.
BLOCK, BLOCK_BASE = 200_000, 400


def _by_blocks(left: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of large buckets that are not in one component yet, as a forest for each pair of blocks.

    Members that large buckets tie together, over all bands, form a group; a group is cut into blocks, a large component
    into blocks of its own and small ones together, and each pair of blocks that are not of one component is one row.
    Links are found inside the row, so no pairs are made, and a pair that shares many buckets is compared once.
    left: key, node, root, n_shingles, centre (a node of the bucket that is the same for all).
    """
    groups = components(left.select(F.col("node").alias("a"), F.col("centre").alias("b")))
    groups = groups.union(groups.select("root", "root").distinct())
    nodes = materialize(left.select("node", "root", "n_shingles").distinct().join(groups.select("node", F.col("root").alias("group")), "node"))
    parts = nodes.groupBy("group", "root").agg(F.sum(F.col("n_shingles") + BLOCK_BASE).alias("weight"))
    small = parts.where(F.col("weight") < BLOCK).groupBy("group").agg(F.sum("weight").alias("rest"))
    count = lambda x: F.ceil(F.col(x) / BLOCK)
    whole = F.col("weight") >= BLOCK
    parts = parts.join(small, "group", "left").select("group", "root", whole.alias("whole"), F.when(whole, count("weight")).otherwise(count("rest")).cast("int").alias("n"))
    of_root = F.xxhash64("root", F.pmod(F.xxhash64("node", F.lit(5)), F.col("n")))
    of_rest = F.xxhash64(F.lit("rest"), F.pmod(F.xxhash64("root", F.lit(5)), F.col("n")))
    nodes = materialize(_spread(nodes, parts, ["group", "root"], "node").withColumn("block", F.when(F.col("whole"), of_root).otherwise(of_rest)).drop("whole", "n"))
    meta = nodes.groupBy("group", "block").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    x, y = (meta.select("group", *(F.col(c).alias(f"{c}_{k}") for c in ("block", "low", "high"))) for k in "xy")
    pairs = x.join(y, "group").where((F.col("block_x") <= F.col("block_y")) & (F.least("low_x", "low_y") < F.greatest("high_x", "high_y"))).select("group", "block_x", "block_y")
    blocks = nodes.join(sets, "node").groupBy("group", "block").agg(F.collect_list(F.struct("node", "root", "shingles")).alias("own"))
    bx, by = (blocks.select("group", F.col("block").alias(f"block_{k}"), F.col("own").alias(f"own_{k}")) for k in "xy")
    met = pairs.repartition("group", "block_x", "block_y").join(bx, ["group", "block_x"]).join(by, ["group", "block_y"])

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                edges = _forest(batch.column("own_x")[i].values, batch.column("own_y")[i].values, percent)
                yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.int64()) for k in range(2)], names=["a", "b"])

    return met.select("own_x", "own_y").mapInArrow(run, "a long, b long")


def _forest(x: pa.StructArray, y: pa.StructArray, percent: int) -> list[tuple[int, int]]:
    """Links between two blocks of (node, root, shingles), without those that links before them make needless."""
    shingles, owners, sizes = [], [], []
    for own in (x, y):
        sets = own.field("shingles")
        n = np.diff(sets.offsets.to_numpy())
        values = sets.values.to_numpy()[sets.offsets.to_numpy()[0] : sets.offsets.to_numpy()[-1]]
        owner = np.repeat(np.arange(len(n)), n)
        order = np.argsort(values, kind="stable")
        shingles.append(values[order])
        owners.append(owner[order])
        sizes.append(n)
    distinct, first, counts = np.unique(shingles[0], return_index=True, return_counts=True)
    lo, hi = np.searchsorted(shingles[1], distinct, "left"), np.searchsorted(shingles[1], distinct, "right")
    shared = hi > lo
    first, counts, lo, hi = first[shared], counts[shared], lo[shared], hi[shared]
    common = np.zeros(len(sizes[0]) * len(sizes[1]), np.int64)
    work = np.cumsum(counts * (hi - lo))
    for part in np.split(np.arange(len(first)), np.searchsorted(work, np.arange(1 << 20, int(work[-1]) if len(work) else 0, 1 << 20))):
        if len(part):
            # each place of a shared shingle in x, repeated for each of its places in y
            left = np.repeat(first[part], counts[part]) + _ramp(counts[part])
            width = np.repeat(hi[part] - lo[part], counts[part])
            i = np.repeat(owners[0][left], width)
            j = owners[1][np.repeat(np.repeat(lo[part], counts[part]), width) + _ramp(width)]
            common += np.bincount(i * len(sizes[1]) + j, minlength=len(common))
    common = common.reshape(len(sizes[0]), -1)
    ok = 100 * common >= percent * (sizes[0][:, None] + sizes[1][None] - common)
    rx, ry = x.field("root").to_numpy(), y.field("root").to_numpy()
    ok &= rx[:, None] != ry[None]
    ids = (x.field("node").to_numpy(), y.field("node").to_numpy())
    parent: dict[int, int] = {}

    def find(k: int) -> int:
        while parent.setdefault(k, k) != k:
            parent[k] = k = parent[parent[k]]
        return k

    out = []
    for i, j in zip(*np.nonzero(ok), strict=True):
        p, q = find(int(rx[i])), find(int(ry[j]))
        if p != q:
            parent[p] = q
            out.append((int(ids[0][i]), int(ids[1][j])))
    return out


def _ramp(counts: np.ndarray) -> np.ndarray:
    """0 .. n-1 for each n."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def _near(percent: int) -> "F.Column":
    """Sizes allow the link, and at least 6 deviations below the expected number of bits of the sketches agree.

    Sets that leave bins empty borrow values, so fewer bits are independent: `full` bins lend to `lent` others each.
    """
    p = (1 + percent / 100) / 2
    least = F.least("na", "nb")
    full = BINS * (1 - F.exp(-least / BINS))
    lent = (BINS - full) / full
    independent = BINS * BINS / (full * (1 + 3 * lent + lent * lent))
    most = BINS * (1 - p) + 6 * BINS * F.sqrt(p * (1 - p) / independent)
    differ = sum((F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in SKETCH), F.lit(0))
    return (100 * least >= percent * F.greatest("na", "nb")) & (differ <= most)
