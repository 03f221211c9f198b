"""Exact top-k inner product search: vectors by descending length, SVD-rotated partial sums, Cauchy-Schwarz pruning.

Vectors are turned into integers floor(scale * x). The second-moment matrix of all vectors (d x d, summed in parts over
the tasks) gives a rotation that puts most of the inner products into the first coordinates. Candidates are sorted by
descending length into blocks, and the blocks are searched in rounds: first the block of the longest vectors, then
`growth` times as many in each round. After each round a query's threshold is the k-th best score that it has so far.

A pair of a query block and a candidate block is left out of the plan if no query's |q| times the block's largest |v|
reaches the threshold. Inside a pair the vectors go by in steps of descending length: queries whose |q| * |v| is too
small drop out, then, after 8, 16, ... rotated coordinates, all pairs whose partial sum plus the product of the two
residual lengths stays below the threshold. Bounds carry a slack for rounding; what stays is scored with exact integers.

Both sides of a pair are keyed by (query block, block), so that pairs are spread over all tasks, and no block or query
set is collected or broadcast.

Vectors that are null, empty, of another dimension than the table's most frequent one, or that hold null or non-finite
components take no part, neither as queries nor as candidates. Ties go to the smaller id. Rows of equal ids are candidates
each, a query never meets its own id, and queries of one id share one answer, the k best of all. Extra columns are
ignored, whatever their names; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import materialize


def clean_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """vec_id and v (array<long>) of the vectors that take part."""
    x = F.col("x")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x")).where(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & ~bad)
    ints = whole.select("vec_id", F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))
    sizes = ints.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return ints.where(F.size("v") == (sizes[0]["d"] if sizes else 0))


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def rotation(ints: DataFrame) -> np.ndarray:
    """Right singular vectors of all vectors as columns, from the summed second moments."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                m = _matrix(batch.column("v")).astype(np.float64)
                total = m.T @ m if total is None else total + m.T @ m
        if total is not None:
            n = len(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(n * n, dtype=np.int64)), pa.array(total.ravel())], names=["i", "x"])

    cells = ints.select("v").mapInArrow(moments, "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
    cells.sort(key=lambda c: c["i"])
    n = int(round(len(cells) ** 0.5))
    if not n:
        return np.zeros((0, 0))
    values, vectors = np.linalg.eigh(np.array([c["x"] for c in cells]).reshape(n, n))
    return vectors[:, np.argsort(values)[::-1]]


#: A block: its vectors in the order in which it was filled, as one flat list.
BLOCK = "block long, ids array<long>, values array<double>, longest double"


def _blocks(rows: DataFrame, most: int) -> DataFrame:
    """Each partition's rows (vec_id, v, length) as blocks of `most` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        parts: list[pa.RecordBatch] = []

        def made() -> pa.RecordBatch:
            ids = np.concatenate([b.column("vec_id").to_numpy() for b in parts])
            values = np.concatenate([_matrix(b.column("v")) for b in parts]).astype(np.float64).ravel()
            lengths = np.concatenate([b.column("length").to_numpy() for b in parts])
            return pa.RecordBatch.from_pydict({"block": [block], "ids": [ids], "values": [values], "longest": [lengths.max()]}, schema=ARROW_BLOCK)

        held = 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, most - held)
                batch = batch.slice(part.num_rows)
                parts.append(part)
                held += part.num_rows
                if held == most:
                    yield made()
                    block, held, parts = block + 1, 0, []
        if parts:
            yield made()

    return rows.mapInArrow(run, BLOCK)


ARROW_BLOCK = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("values", pa.list_(pa.float64())), ("longest", pa.float64())])


def top_k(vectors: DataFrame, is_query: Column, *, k: int = 5, scale: int = 256, block_rows: int = 8192, query_rows: int = 2048, growth: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per query and rank: query_id, rank (from 1), vec_id, score. is_query: a condition on column vec_id.

    block_rows, query_rows: rows of a candidate and a query block, which bound the memory of a task.
    growth: how many times more blocks each round searches than those before it.
    """
    ints = materialize(clean_vectors(vectors, id_col, vector_col, scale))
    turn = rotation(ints)
    measured = ints.withColumn("length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)))
    # every row of a tie in length has a place of its own in the order
    order = [F.desc("length"), F.xxhash64("vec_id")]
    count = lambda rows, most: max(1, -(-rows.count() // most))
    blocks = materialize(_blocks(measured.repartitionByRange(count(measured, block_rows), *order).sortWithinPartitions(*order), block_rows))
    queries = measured.where(is_query).dropDuplicates(["vec_id", "v"])
    asked = materialize(_blocks(queries.repartition(count(queries, query_rows), F.xxhash64("vec_id", F.lit(1))), query_rows).select(F.col("block").alias("query_block"), F.col("ids").alias("query_ids"), F.col("values").alias("queries")))
    # the order of blocks, not of rows: one short row for each block
    ranked = materialize(blocks.select("block", "longest", F.row_number().over(Window.orderBy(F.desc("longest"), "block")).alias("place")))
    total = ranked.count()
    best, done, size = None, 0, 1
    while done < total:
        now = ranked.where((F.col("place") > done) & (F.col("place") <= done + size)).select("block", "longest")
        found = _round(blocks, now, asked, best, turn, k)
        found = found if best is None else found.union(best.drop("rank"))
        w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        best = materialize(found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k))
        done, size = done + size, size * growth
    return best.select("query_id", "rank", "vec_id", "score") if best is not None else vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")


#: What a search returns for each candidate; length is the query's.
FOUND = "query_block long, query_id long, length double, vec_id long, score long"


def _round(blocks: DataFrame, now: DataFrame, asked: DataFrame, best: DataFrame | None, turn: np.ndarray, k: int) -> DataFrame:
    """Candidates for the best k of each query in the blocks `now`, given the best ones of the rounds before."""
    if best is None:
        known = asked.withColumns({"least": F.array().cast("array<struct<id:long,t:long>>"), "need": F.lit(float("-inf"))})
    else:
        t = F.col("score")
        need = F.when(t <= 0, F.lit(float("-inf"))).when(F.col("length") == 0, F.lit(float("inf"))).otherwise(t / F.col("length"))
        told = best.where(F.col("rank") == k).groupBy("query_block").agg(F.collect_list(F.struct(F.col("query_id").alias("id"), t.alias("t"))).alias("least"), F.min(need).alias("need"))
        # a query with fewer than k results has no threshold yet
        known = asked.join(told, "query_block", "left")
        known = known.withColumn("need", F.when(F.size("least") == F.size("query_ids"), F.col("need")).otherwise(F.lit(float("-inf"))))
        known = materialize(known.withColumn("least", F.coalesce("least", F.array().cast("array<struct<id:long,t:long>>"))))
    # one row for each pair of blocks that may hold a result; of the blocks only their bounds meet here
    pairs = materialize(now.join(known.select("query_block", "need"), F.col("longest") * (1 + 1e-9) >= F.col("need")).select("block", "query_block"))
    left = blocks.join(pairs, "block").select("block", "query_block", "ids", "values")
    right = known.join(pairs, "query_block").select("block", "query_block", "query_ids", "queries", "least")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q_ids, q, v_ids, v = (batch.column(c)[i].values.to_numpy() for c in ("query_ids", "queries", "ids", "values"))
                q, v = q.reshape(len(q_ids), -1), v.reshape(len(v_ids), -1)
                at = {x["id"]: float(x["t"]) for x in batch.column("least")[i].as_py()}
                owner, ids, scores, _ = find(q_ids, q, np.array([at.get(x, -np.inf) for x in q_ids.tolist()]), v_ids, v, turn, k)
                block = np.full(len(owner), batch.column("query_block")[i].as_py(), np.int64)
                columns = [pa.array(x) for x in (block, q_ids[owner], np.sqrt((q * q).sum(1))[owner], ids, scores)]
                yield pa.RecordBatch.from_arrays(columns, names=["query_block", "query_id", "length", "vec_id", "score"])

    return left.join(right, ["block", "query_block"]).select("query_block", "query_ids", "queries", "least", "ids", "values").mapInArrow(search, FOUND)


def find(q_ids: np.ndarray, q: np.ndarray, least: np.ndarray, v_ids: np.ndarray, v: np.ndarray, turn: np.ndarray, k: int, step: int = 128) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Best k of candidates v, longest first, for each query, of those that reach its threshold `least`.

    Returns places of queries, vector ids, scores, and how many pairs were scored. Vectors hold integers as floats.
    """
    d = v.shape[1]
    top = (np.abs(q).max(initial=0) * np.abs(v).max(initial=0)) * d
    if top >= 2.0**62:
        raise ValueError("inner products exceed 64 bits")
    if top >= 2.0**53:  # sums of floats would not be exact
        q, v = q.astype(np.int64), v.astype(np.int64)
    qr, vr = q @ turn, v @ turn
    q_tail, v_tail = (np.sqrt(np.maximum(np.cumsum(x[:, ::-1] ** 2, axis=1)[:, ::-1], 0)) for x in (qr, vr))
    q_length, length = np.sqrt((qr * qr).sum(1)), np.sqrt((vr * vr).sum(1))
    longest = np.maximum.accumulate(length[::-1])[::-1]
    slack = 1e-9 * (1 + q_length * (longest[0] if len(longest) else 0))
    heads = [h for h in (8, 16, 32, 64, 128, 256) if h < d]
    least = least.astype(np.float64).copy()
    best_score = np.full((len(q), k), np.iinfo(np.int64).min)
    best_id = np.full((len(q), k), np.iinfo(np.int64).max)
    count, scored = np.zeros(len(q), np.int64), 0
    for at in range(0, len(v), step):
        alive = np.flatnonzero(q_length * longest[at] + slack >= least)
        if not len(alive):
            break
        part = slice(at, min(at + step, len(v)))
        keep = v_ids[part][None] != q_ids[alive][:, None]
        keep &= np.outer(q_length[alive], length[part]) + slack[alive, None] >= least[alive, None]
        partial, low = np.zeros(keep.shape), 0
        for h in heads:
            partial += qr[alive][:, low:h] @ vr[part, low:h].T
            keep &= partial + np.outer(q_tail[alive, h], v_tail[part, h]) + slack[alive, None] >= least[alive, None]
            some = keep.any(axis=1)
            alive, keep, partial, low = alive[some], keep[some], partial[some], h
            if not len(alive):
                break
        if not len(alive):
            continue
        scored += int(keep.sum())
        if 4 * keep.sum() > keep.size:
            scores = q[alive] @ v[part].T
            i, j = np.nonzero(keep & (scores >= least[alive, None]))
            scores = scores[i, j]
        else:
            i, j = np.nonzero(keep)
            scores = np.einsum("ij,ij->i", q[alive[i]], v[part][j])
            good = scores >= least[alive[i]]
            i, j, scores = i[good], j[good], scores[good]
        if not len(i):
            continue
        # merged with what was found before: the k first by score and id
        rows = np.unique(alive[i])
        row = np.concatenate([alive[i], np.repeat(rows, k)])
        score = np.concatenate([scores.astype(np.int64), best_score[rows].ravel()])
        ids = np.concatenate([v_ids[part][j], best_id[rows].ravel()])
        by = np.lexsort((ids, -(score + 1), row))  # -(x + 1): the least number has no negative
        row, score, ids = row[by], score[by], ids[by]
        start = np.searchsorted(row, rows)
        pick = start[:, None] + np.arange(k)[None]
        best_score[rows], best_id[rows] = score[pick], ids[pick]
        count[rows] = np.minimum(k, count[rows] + np.bincount(alive[i], minlength=len(q))[rows])
        full = rows[count[rows] == k]
        least[full] = np.maximum(least[full], best_score[full, k - 1])
    used = np.arange(k)[None] < count[:, None]
    return np.repeat(np.arange(len(q)), count), best_id[used], best_score[used], scored
