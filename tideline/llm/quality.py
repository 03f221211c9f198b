"""Ordinal quality classifier: cumulative-link regression over hashed text features.

Graded ratings 0 < 1 < ... < K-1 share one weight vector w; ordered thresholds t_1 < ... < t_(K-1) split the score:
P(grade >= k) = sigmoid(w.x - t_k). Features are hashes of the distinct lower-cased words of a text (weighted
down by the root of their number beyond 100) and of the shapes of
its tokens (letters, digits and marks folded into classes), the shapes weighted by their share of the tokens, and the shares of tokens
that repeat the one before and that hold unusual marks.

The model is fitted on at most `sample_rows` labelled rows (those with the smallest hashed ids), in one task, by
proximal AdaGrad with an L1 penalty that leaves weights of words without evidence at zero; only the non-zero weights
reach the driver, at most one for each of 2^bits hash values. Every row is scored, with its whole text.

Null and empty texts have no features: their score is 0. Labels that are null, repeated or of unknown documents are
left out (of repeated ones one is used). Without labels all weights are zero, and thresholds rise from -1, so
everything is kept. Repeated rows each give a row, an empty table none. Extra columns stay; columns named like the results
are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import gives_back, keep_only, slices

BITS = 18
MOST_TOKENS = 200_000
_WORD = re.compile(r"\w+")
_SHAPES = ((re.compile(r"[^\W\d_a-zß-öø-ÿ]+"), "A"), (re.compile(r"[^\W\d_A]+"), "a"), (re.compile(r"\d+"), "0"))


class TokenFeatures(dict):
    """token -> (hash values of its words, hash value of its shape)."""

    def __missing__(self, token: str) -> tuple[tuple[int, ...], int]:
        if len(self) > MOST_TOKENS:
            self.clear()
        shape = token
        for regex, sign in _SHAPES:
            shape = regex.sub(sign, shape)
        at = lambda kind, x: xxhash.xxh64_intdigest(kind + x) >> (64 - BITS)
        out = self[token] = (tuple(at("w ", w) for w in _WORD.findall(token.lower())), at("s ", shape[:8]))
        return out


_tokens = TokenFeatures()
#: Hash values of the shares of tokens that repeat the one before, and that hold unusual marks.
_SHARES = np.array([xxhash.xxh64_intdigest(x) >> (64 - BITS) for x in ("share repeats", "share marks")], np.int64)
_MARKED = re.compile(r"[^\w.,;:'\"()!?-]")


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hash values and their weights."""
    tokens = (text or "").split()
    if not tokens:
        return np.empty(0, np.int64), np.empty(0)
    made = [_tokens[t] for t in tokens]
    words = np.unique(np.array([w for own, _ in made for w in own], np.int64))
    shapes, counts = np.unique(np.array([s for _, s in made], np.int64), return_counts=True)
    repeats = sum(map(eq, tokens, islice(tokens, 1, None))) / len(tokens)
    marked = sum(map(bool, map(_MARKED.search, tokens))) / len(tokens)
    return np.concatenate((words, shapes, _SHARES)), np.concatenate((np.full(len(words), max(1.0, len(words) / 100) ** -0.5), 4.0 * counts / len(tokens), (8.0 * repeats, 8.0 * marked)))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. K-1, one row for each score."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds, -35, 35)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, levels: int, epochs: int = 25, batch: int = 64, rate: float = 0.2, l1: float = 1e-3, seed: int = 3) -> Model:
    w, squares = np.zeros(1 << BITS), np.full(1 << BITS, 1e-2)
    share = np.array([(grades >= k).mean() for k in range(1, levels)]).clip(1e-3, 1 - 1e-3)
    t = -np.log(share / (1 - share))  # the thresholds of a model without features
    t = np.maximum.accumulate(t + np.arange(levels - 1) * 1e-6)
    t_squares = np.full(levels - 1, 1e-2)
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        order = random.permutation(len(rows))
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            index = np.concatenate([rows[i][0] for i in own])
            value = np.concatenate([rows[i][1] for i in own])
            owner = np.repeat(np.arange(len(own)), [len(rows[i][0]) for i in own])
            score = np.bincount(owner, value * w[index], len(own))
            s = 1 / (1 + np.exp(-np.clip(t - score[:, None], -35, 35)))  # P(grade < k), k = 1 .. K-1
            low = np.concatenate((np.zeros((len(own), 1)), s), 1)
            high = np.concatenate((s, np.ones((len(own), 1))), 1)
            y, line = grades[own], np.arange(len(own))
            p = np.maximum(high[line, y] - low[line, y], 1e-9)
            dh, dl = high[line, y] * (1 - high[line, y]), low[line, y] * (1 - low[line, y])
            by_score = (dh - dl) / p / len(own)
            by_t = np.bincount(y[y < levels - 1], (-dh / p)[y < levels - 1], levels - 1) + np.bincount(y[y > 0] - 1, (dl / p)[y > 0], levels - 1)
            touched, where = np.unique(index, return_inverse=True)
            g = np.bincount(where, value * by_score[owner], len(touched))
            squares[touched] += g * g
            step = rate / np.sqrt(squares[touched])
            new = w[touched] - step * g
            w[touched] = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0)
            by_t /= len(own)
            t_squares += by_t * by_t
            t = np.maximum.accumulate(t - rate / np.sqrt(t_squares) * by_t + np.arange(levels - 1) * 1e-9)
    return Model(w, t)


def train(docs: DataFrame, grades: DataFrame, *, levels: int, sample_rows: int = 8000, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from grades (doc_id, grade 0 .. levels-1), fitted on a bounded sample inside one task."""
    known = grades.withColumn("doc_id", F.col("doc_id").cast("long")).where(F.col("grade").between(0, levels - 1) & F.col("doc_id").isNotNull())
    sample = known.groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "doc_id")

    @gives_back
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            keep_only(_tokens)
            found = [features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("grade"), pa.array([f[0] for f in found], pa.list_(pa.int64())), pa.array([f[1] for f in found], pa.list_(pa.float64()))], names=["doc_id", "grade", "at", "value"])

    @gives_back
    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, y = [], []
        for batch in batches:
            own += [(np.asarray(a, np.int64), np.asarray(v)) for a, v in zip(batch.column("at").to_pylist(), batch.column("value").to_pylist(), strict=True)]
            y += batch.column("grade").to_pylist()
        if own:
            m = fit(own, np.array(y), levels)
            at = np.flatnonzero(m.weights)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((at, -1 - np.arange(levels - 1)))), pa.array(np.concatenate((m.weights[at], m.thresholds)))], names=["at", "weight"])

    features_ = rows.mapInArrow(hashed, "doc_id long, grade int, at array<long>, value array<double>")
    got = features_.repartition(1).sortWithinPartitions("doc_id").mapInArrow(fitted, "at long, weight double").collect()
    w, t = np.zeros(1 << BITS), np.arange(levels - 1) - 1.0
    for r in got:
        if r["at"] < 0:
            t[-1 - r["at"]] = r["weight"]
        else:
            w[r["at"]] = r["weight"]
    return Model(w, t)


def score(docs: DataFrame, model: Model, *, at_least: int, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """docs with expected_grade, tail (P(grade >= at_least)) and accepted (tail >= least). A column of docs with one of
    these names, in any case, is replaced."""
    names = ("expected_grade", "tail", "accepted")
    base = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in names])

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, 4 << 20):
            keep_only(_tokens)
            found = [features(t) for t in batch.column(text_col).to_pylist()]
            tails = model.tails(np.array([model.weights[a] @ v for a, v in found]))
            tail = tails[:, at_least - 1].round(9)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tails.sum(1).round(9)), pa.array(tail), pa.array(tail >= least)], names=[*batch.schema.names, *names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema)
    return base.mapInArrow(run, f"{schema}, expected_grade double, tail double, accepted boolean")


def graded(labels: DataFrame) -> DataFrame:
    """Grades of labels (doc_id, quality 0/1, toxic 0/1): 0 toxic, 1 poor, 2 good."""
    return labels.where(F.col("quality").isNotNull() & F.col("toxic").isNotNull()).select("doc_id", F.when(F.col("toxic") == 1, 0).otherwise(F.col("quality") + 1).alias("grade"))
