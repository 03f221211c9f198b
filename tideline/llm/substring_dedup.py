"""Removal of byte windows that an earlier document has too, by a depth-limited radix sort of sampled suffixes.

A window is `width` bytes; a byte goes if some window over it also starts in a document with a smaller id. Sorting every
suffix to that depth would shuffle many times the text, so only anchor suffixes are sorted: the minimizer (smallest hash
of `GRAM` bytes, leftmost on ties) of each window. Every window has exactly one, at a place that depends on the window's
bytes alone, so equal windows have equal anchors and the windows of one anchor form a run.

The sort goes digit by digit, most significant first, and a group leaves it as soon as it holds one document:
  1. by the first GRAM bytes from the anchor on (the exchange is by this digit);
  2. by the bytes before and behind that the run's windows can reach: equal ones share all their windows, so all but the
     smallest document lose the run at once;
  3. for what differs there but agrees in half of it, the smallest document of each such class sends the bytes of the
     run, and equal hashes of the windows inside are exactly the repeated windows.
Anchors and classes are reduced to their smallest document inside each task before anything is shuffled, so a passage
that fills a third of all documents is shuffled once a task.

Hashes have 64 bits. Null is an empty text; texts shorter than a window lose nothing. Rows that share an id are not
earlier than each other, so windows that only they share stay; `copy`, a hash of the text where ids repeat with different
texts and else 0, tells such rows apart. Rows without an id are in no order: they lose nothing and take nothing. Each row
gives a row; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import slices

GRAM = 20
#: Bytes of text that are hashed at once, and anchors that are reduced at once, in a task.
SLICE, HELD = 1 << 20, 400_000
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = np.random.default_rng(4711).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(32))


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to n."""
    if not _POWERS or len(_POWERS[0]) <= n:
        size = max(n + 1, SLICE + (SLICE >> 2))
        made = []
        for b in (_BASE, _INVERSE):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            made.append(np.cumprod(p, dtype=np.uint64))
        _POWERS[:] = made
    return _POWERS[0], _POWERS[1]


class Prefix:
    """Polynomial prefix sums of a buffer, from which the hash of any range follows."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * up[: len(data)], out=self.sums[1:])

    def hashes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hashes of the ranges [a, b)."""
        return mix((self.sums[b] - self.sums[a]) * self.down[a] + (b - a).astype(np.uint64))

    def all(self, width: int) -> np.ndarray:
        """Hash of each range of `width` bytes."""
        n = len(self.sums) - width
        return mix((self.sums[width:] - self.sums[:n]) * self.down[:n] + _U(width))


def anchors(prefix: Prefix, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor place, first and last window start of each run. ends: ends of the documents in the buffer."""
    grams = prefix.all(GRAM)
    w = width - GRAM + 1
    n = len(grams) - w + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 3
    bits = _U(max(1, len(grams).bit_length()))
    key = ((grams >> bits) << bits) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while 2 * span <= w:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    least = np.minimum(key[:n], key[w - span : w - span + n])
    at = (least & ((_U(1) << bits) - _U(1))).astype(np.int64)
    inside = np.ones(n, bool)  # windows that do not cross an end
    for e in ends[:-1]:
        inside[max(0, e - width + 1) : e] = False
    cut = np.flatnonzero((at[1:] != at[:-1]) | (inside[1:] != inside[:-1])) + 1
    first = np.concatenate(([0], cut))
    last = np.concatenate((cut - 1, [n - 1]))
    keep = inside[first]
    return at[first[keep]], first[keep], last[keep]


def _buffers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, pa.RecordBatch]]:
    """Bytes of the texts of each slice, ends of the documents."""
    for batch in slices(batches, "text", SLICE):
        column = batch.column("text")
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        yield data, offsets[1:] - offsets[0], batch


def _grouped(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by keys (first one first), and the start of each group of equal keys but the last one in that order."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    if len(order):
        new[0] = True
        for k in keys[:-1]:
            k = k[order]
            new[1:] |= k[1:] != k[:-1]
    return order, np.flatnonzero(new)


def _run(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """First and last window start of a run in one long."""
    return (first.astype(np.int64) << 31) | last.astype(np.int64)


#: What is shuffled for each anchor: the gram's hash in two parts (40 bits beside the digit), and hashes of the context,
#: of its left and of its right half, which are compared inside a gram only and so may be short.
KINDS = (("gram", np.uint32), ("gram2", np.uint8), ("context", np.uint32), ("left", np.uint16), ("right", np.uint16), ("doc", np.int64), ("copy", np.int64), ("first", np.int32), ("length", np.uint8))


def _pack(name: str, x: np.ndarray, kind: type) -> bytes:
    """Bytes of a column; documents and places as differences, texts deflated, so that shuffles compress well."""
    x = x.astype(kind)
    if name in ("doc", "first"):
        x = np.diff(x, prepend=x.dtype.type(0))
    return zlib.compress(x.tobytes(), 1) if name == "data" else x.tobytes()


def _unpack(name: str, packed: bytes, kind: type) -> np.ndarray:
    x = np.frombuffer(zlib.decompress(packed) if name == "data" else packed, kind)
    return np.cumsum(x, dtype=kind) if name in ("doc", "first") else x


def _digits(digits: int, width: int):
    """Step 1: anchors of documents, reduced to the smallest document of each class, as one row for each digit.

    Rows with digit -1 are runs that a smaller document of the same task has too.
    """
    reach = width - GRAM
    half = reach // 2

    def reduce(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        gram, context, left, right, doc, copy, first, last = (np.concatenate(x) for x in zip(*parts, strict=True))
        order, starts = _grouped(gram, context, doc)
        lost = np.zeros(len(doc), bool)
        own = doc[order]
        lost[order] = own > np.repeat(own[starts], np.diff(np.append(starts, len(own))))
        digit = np.where(lost, -1, (gram & _U(0xFFFFFF)).astype(np.int64) % digits)
        by = np.argsort(digit, kind="stable")  # stays in order of documents, which compresses well
        edges = np.flatnonzero(np.diff(digit[by], prepend=-2))
        rows, columns = [], (gram >> _U(32), gram >> _U(24), context >> _U(32), left >> _U(48), right >> _U(48), doc, copy, first, last - first)
        for a, b in zip(edges, np.append(edges[1:], len(by)), strict=True):
            rows.append((int(digit[by[a]]), *(_pack(name, x[by[a:b]], kind) for x, (name, kind) in zip(columns, KINDS, strict=True))))
        kinds = [pa.int64()] + [pa.binary()] * len(KINDS)
        return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["digit", *(n for n, _ in KINDS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for data, ends, batch in _buffers(batches):
            if len(data) < width:
                continue
            prefix = Prefix(data)
            p, lo, hi = anchors(prefix, ends, width)
            owner = np.searchsorted(ends, p, side="right")
            begin = np.concatenate(([0], ends))[owner]
            a, b = np.maximum(begin, p - reach), np.minimum(ends[owner], p + width)
            # what the run's windows reach: how far each side goes is part of the context
            context = prefix.hashes(a, b) ^ mix(((p - a) * 64 + (b - p)).astype(np.uint64) * _U(_BASE))
            doc, copy = batch.column("doc_id").to_numpy()[owner], batch.column("copy").to_numpy()[owner]
            # every window holds the half context on one side at least
            left = prefix.hashes(np.maximum(begin, p - half), p + GRAM)
            right = prefix.hashes(p, np.minimum(ends[owner], p + GRAM + half))
            parts.append([prefix.hashes(p, p + GRAM), context, left, right, doc, copy, lo - begin, hi - begin])
            held += len(p)
            if held >= HELD:
                yield reduce(parts)
                parts, held = [], 0
        if parts:
            yield reduce(parts)

    return run


def _by_digit(batches: Iterator[pa.RecordBatch], kinds: tuple = KINDS) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The anchors of one digit after another; rows come sorted by digit. Rows of digit -1 come one by one."""

    def arrays() -> list[np.ndarray]:
        return [np.concatenate([_unpack(name, y, kind) for y in x]) for x, (name, kind) in zip(zip(*parts, strict=True), kinds, strict=True)]

    now, parts = None, []
    for batch in batches:
        for i in range(batch.num_rows):
            digit, *row = (batch.column(c)[i].as_py() for c in ("digit", *(n for n, _ in kinds)))
            if parts and (digit != now or digit < 0):
                yield now, arrays()
                parts = []
            now = digit
            parts.append(row)
    if parts:
        yield now, arrays()


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2: inside each digit, runs of classes whose smallest document is another one, and those that step 3 asks for."""
    for digit, (high, low, context, left, right, doc, copy, first, length) in _by_digit(batches):
        ask = np.zeros(len(doc), bool)
        lost = np.ones(len(doc), bool)
        if digit >= 0:
            gram = (high.astype(np.uint64) << _U(8)) | low
            order = np.argsort(gram, kind="stable")
            order = order[_repeated(gram[order])]  # grams that stand alone are done
            context = (context.astype(np.uint64) << _U(32)) | (left.astype(np.uint64) << _U(16)) | right
            again, starts = _grouped(gram[order], context[order], doc[order])
            order = order[again]
            sizes = np.diff(np.append(starts, len(order)))
            own = doc[order]
            lost[:] = False
            lost[order] = own > np.repeat(own[starts], sizes)
            heads = order[starts]
            near = np.zeros(len(heads), bool)  # classes that share a half context with another class of their gram
            for side in (left, right):
                key = (gram[heads] << _U(16)) | side[heads]
                by = np.argsort(key, kind="stable")
                near[by] |= _repeated(key[by])
            ask[order] = np.repeat(near, sizes)
            ask &= ~lost
        out = lost | ask
        first = first[out]
        first, length = first.astype(np.int64), length[out].astype(np.int64)
        # one long for each run; the low bits of the gram tell step 3's digit
        asked = ((high[out].astype(np.int64) & 0xFFFFFF) << 37) | (length << 32) | first
        yield pa.RecordBatch.from_arrays([pa.array(doc[out]), pa.array(copy[out]), pa.array(np.where(ask[out], asked, _run(first, first + length))), pa.array(ask[out])], names=["doc_id", "copy", "run", "asked"])


def _repeated(x: np.ndarray) -> np.ndarray:
    """Which elements of a sorted array have an equal neighbour."""
    out = np.zeros(len(x), bool)
    same = x[1:] == x[:-1]
    out[1:] |= same
    out[:-1] |= same
    return out


#: What step 3 shuffles for each run that is asked for: its gram, place and number of windows, and the bytes they cover.
ASKED = (("gram", np.uint32), ("doc", np.int64), ("copy", np.int64), ("first", np.int32), ("count", np.uint8), ("data", np.uint8))


def _ramp(counts: np.ndarray) -> np.ndarray:
    """0 .. n-1 for each n."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def _spans(width: int, digits: int):
    """The bytes of the runs that are asked for, as one row for each digit of their grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data, ends, batch in _buffers(batches):
            runs = batch.column("runs")
            each = np.diff(runs.offsets.to_numpy())
            values = runs.flatten().to_numpy()
            gram, length, first = values >> 37, (values >> 32) & 31, values & 0xFFFFFFFF
            begin = np.repeat(np.concatenate(([0], ends[:-1])), each)
            doc, copy = (np.repeat(batch.column(c).to_numpy(), each) for c in ("doc_id", "copy"))
            by = np.argsort(gram % digits, kind="stable")
            gram, first, begin, doc, copy, count = gram[by], first[by], begin[by], doc[by], copy[by], (length + 1)[by]
            covered = count + width - 1
            flat = data[np.repeat(begin + first, covered) + _ramp(covered)]
            edges = np.flatnonzero(np.diff(gram % digits, prepend=-1))
            at = np.concatenate(([0], np.cumsum(covered)))
            rows = []
            for a, b in zip(edges, np.append(edges[1:], len(gram)), strict=True):
                columns = (gram[a:b], doc[a:b], copy[a:b], first[a:b], count[a:b], flat[at[a] : at[b]])
                rows.append((int(gram[a] % digits), *(_pack(name, x, kind) for x, (name, kind) in zip(columns, ASKED, strict=True))))
            yield pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*rows, strict=True), (pa.int64(), *[pa.binary()] * len(ASKED)), strict=True)], names=["digit", *(n for n, _ in ASKED)])

    return run


def _late(width: int):
    """Step 3: windows that a smaller document has too, joined to runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (_gram, doc, copy, first, count, data) in _by_digit(batches, ASKED):
            count = count.astype(np.int64)
            covered = count + width - 1
            at = np.repeat(np.cumsum(covered) - covered, count) + _ramp(count)
            window = Prefix(data).hashes(at, at + width)
            doc, copy, first = np.repeat(doc, count), np.repeat(copy, count), np.repeat(first, count) + _ramp(count).astype(np.int32)
            order, starts = _grouped(window, doc)
            own = doc[order]
            late = np.sort(order[own > np.repeat(own[starts], np.diff(np.append(starts, len(own))))])
            doc, copy, first = doc[late], copy[late], first[late]
            if len(doc):
                new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (copy[1:] != copy[:-1]) | (first[1:] != first[:-1] + 1))))
                yield pa.RecordBatch.from_arrays([pa.array(doc[new]), pa.array(copy[new]), pa.array(_run(first[new], first[np.append(new[1:], len(first)) - 1]))], names=["doc_id", "copy", "run"])

    return run


def _apply(width: int):
    """Remaining bytes of each text: runs of window starts become byte spans, which are merged and cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 * SLICE):
            rows = []
            for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                data, spans, kept, at = text.encode(), [], [], 0
                for r in sorted(set(runs)):
                    a, b = r >> 31, (r & 0x7FFFFFFF) + width
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(b, spans[-1][1])
                    else:
                        spans.append([a, b])
                for a, b in spans:
                    kept.append(data[at:a])
                    at = b
                rest = b"".join([*kept, data[at:]])
                rows.append((len(data), len(data) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(), rest, [{"start": a, "end": b} for a, b in spans]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            cols = [pa.array(list(x), k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])

    return run


def remove_repeats(docs: DataFrame, *, width: int = 50, digit_bytes: int = 6 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes), spans of removed bytes.

    digit_bytes: bytes of text for each digit of the first pass, which bounds the memory of a task.
    """
    if not GRAM < width <= GRAM + 31:
        raise ValueError(f"width must be from {GRAM + 1} to {GRAM + 31}: a run's windows and what they reach are counted in five and six bits")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    at = F.xxhash64("text")
    several = base.where("doc_id is not null").select("doc_id", at.alias("at")).groupBy("doc_id").agg(F.min("at").alias("x"), F.max("at").alias("y")).where("x < y")
    base = base.withColumn("copy", at if several.limit(1).count() else F.lit(0).cast("long"))
    total = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    digits = max(16, -(-int(total) // digit_bytes))
    dealt = base.where("doc_id is not null").mapInArrow(_digits(digits, width), "digit long, " + ", ".join(f"{n} binary" for n, _ in KINDS))
    # runs that are lost already need no digit and are spread by themselves
    spread = F.when(F.col("digit") < 0, F.xxhash64("doc", "first")).otherwise(F.col("digit"))
    # read twice below, from one shuffle
    found = dealt.withColumn("to", spread).repartition("to").sortWithinPartitions("digit").mapInArrow(_classes, "doc_id long, copy long, run long, asked boolean")

    # both joins compare alike, so that Spark shuffles the texts once and reads that shuffle twice
    def of(rows: DataFrame, how: str) -> DataFrame:
        by_row = rows.groupBy(F.col("doc_id").alias("id"), F.col("copy").alias("other")).agg(F.collect_list("run").alias("runs"))
        return base.join(by_row, base["doc_id"].eqNullSafe(by_row["id"]) & (base["copy"] == by_row["other"]), how)

    spans = of(found.where("asked"), "inner").select("doc_id", "copy", "text", "runs")
    spans = spans.mapInArrow(_spans(width, digits), "digit long, " + ", ".join(f"{n} binary" for n, _ in ASKED))
    late = spans.repartition("digit").sortWithinPartitions("digit").mapInArrow(_late(width), "doc_id long, copy long, run long")
    return (
        of(found.where("not asked").select("doc_id", "copy", "run").union(late), "left")
        .select("doc_id", "text", F.coalesce("runs", F.array().cast("array<bigint>")).alias("runs"))
        .mapInArrow(_apply(width), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<struct<start:long,end:long>>")
    )
