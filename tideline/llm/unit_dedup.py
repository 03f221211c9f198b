"""Substring dedup by line hashing: normalise units, group digests globally, keep the earliest, remove the rest.

A unit is a sentence of a line: a text is cut behind each line feed and behind `.`, `!` or `?` followed by a blank.
Lines and units are normalised (lower case; words of letters, digits and underscores, joined by blanks) and hashed to 64
bits. A line whose words an earlier line has goes with all its units, however short; lines without a word stay. Of the
other units those go whose words an earlier unit has; `min_words` holds for them only. Earlier is by document id and
then by place, in the table as given. What goes is told unit by unit, with character offsets in the original text.
With `whole_lines=False` lines are not compared, so short sentences of repeated lines stay.

The digests of a task are reduced to their first occurrence before the exchange, so a line that stands in a third of all
documents is shuffled once a task, and what is lost inside a task travels by its own place.

Null and empty texts have no units and stay as they are, and so do documents without an id. Rows of one id and one text
are one document: they lose the same units, and none to each other. Rows of one id and different texts are documents in
order of a hash of their texts. Extra columns are kept; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tideline.llm.common import gives_back, keep_only, slices

CUT = re.compile(r"(?<=\n)|(?<=[.!?] )")
WORDS = re.compile(r"\w+")
#: Occurrences that a task holds before it reduces them.
HELD = 200_000


def units(text: str) -> list[str]:
    """The units in order; their concatenation is the text."""
    return [u for u in CUT.split(text) if u]


def _lines(pieces: list[str]) -> Iterator[tuple[int, int]]:
    """First unit of each line and the one after its last."""
    first = 0
    for k, unit in enumerate(pieces, 1):
        if unit.endswith("\n") or k == len(pieces):
            yield first, k
            first = k


def _occurrences(min_words: int, whole_lines: bool):
    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only(None)
        first: dict[int, tuple[int, int, int, int, int]] = {}
        lost: list[tuple[int, int, int, int, int]] = []

        def reduced() -> pa.RecordBatch:
            rows = [(h, *x, False) for h, x in first.items()]
            rows += [(xxhash.xxh64_intdigest(b"%d %d %d" % x[:3]), *x, True) for x in lost]
            first.clear()
            lost.clear()
            h, doc, at, k, start, end, known = zip(*rows, strict=True)
            signed = pa.array([x - (1 << 64) if x >> 63 else x for x in h], pa.int64())
            return pa.RecordBatch.from_arrays([signed, pa.array(doc, pa.int64()), pa.array(at, pa.int64()), pa.array(k, pa.int32()), pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(known, pa.bool_())], names=["digest", "doc_id", "at", "k", "start", "end", "known"])

        def add(h: int, own: tuple[int, int, int, int, int]) -> None:
            other = first.get(h)
            if other is None:
                first[h] = own
            elif own < other:
                first[h] = own
                lost.append(other)
            elif own != other:
                lost.append(own)

        for batch in slices(batches, "text", 1 << 20):
            for doc, row, text in zip(batch.column("doc_id").to_pylist(), batch.column("at").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if doc is None:
                    continue
                pieces, at = units(text or ""), 0
                for begin, stop in _lines(pieces):
                    line_at, line_words = at, []
                    for k in range(begin, stop):
                        words = WORDS.findall(pieces[k].lower())
                        line_words += words
                        if len(words) >= min_words:
                            add(xxhash.xxh64_intdigest(" ".join(words)), (doc, row, k, at, at + len(pieces[k])))
                        at += len(pieces[k])
                    if whole_lines and line_words:
                        add(xxhash.xxh64_intdigest(" ".join(line_words), 1), (doc, row, begin, line_at, at))
            if len(first) + len(lost) >= HELD:
                yield reduced()
        if first:
            yield reduced()

    return run


@gives_back
def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, counts, removed = [], [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            pieces = units(text or "")
            counts.append(len(pieces))
            gone = []
            if spans:
                # spans are ordered by start; those of a line and of its units overlap
                at, end, i, parts = 0, 0, 0, []
                for unit in pieces:
                    while i < len(spans) and spans[i]["start"] <= at:
                        end = max(end, spans[i]["end"])
                        i += 1
                    if at < end:
                        gone.append({"start": at, "end": at + len(unit)})
                    else:
                        parts.append(unit)
                    at += len(unit)
                text = "".join(parts)
            kept.append(text)
            removed.append(gone)
        where = batch.schema.get_field_index("spans")
        batch = batch.set_column(where, batch.schema.field(where), pa.array(removed, batch.schema.field(where).type))
        columns = [*batch.columns, pa.array(kept, pa.string()), pa.array(counts, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "kept_text", "n_units"])


def remove_repeated_units(docs: DataFrame, *, min_words: int = 5, whole_lines: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with three columns more: kept_text, n_units, spans (removed pieces: array of start and end in characters).

    A column of docs with one of these names, in any case, is replaced; all others stay. Ids are whole numbers. Documents
    without an id keep their text.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("kept_text", "n_units", "spans")]
    packed = docs.select(F.struct(*kept).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("at"))
    base = packed.drop("row")
    seen = base.mapInArrow(_occurrences(min_words, whole_lines), "digest long, doc_id long, at long, k int, start int, end int, known boolean")
    place = F.struct("doc_id", "at", "k")
    lost = seen.withColumn("least", F.min(place).over(Window.partitionBy("digest"))).where(F.col("known") | (place > F.col("least")))
    spans = lost.groupBy(F.col("doc_id").alias("_id"), F.col("at").alias("_at")).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    joined = packed.join(spans, (F.col("doc_id") == F.col("_id")) & (F.col("at") == F.col("_at")), "left")
    joined = joined.select("row", "text", F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"))
    return joined.mapInArrow(_cut, StructType([*joined.schema.fields, StructField("kept_text", StringType()), StructField("n_units", LongType())])).select("row.*", "kept_text", "n_units", "spans")
