"""Intervals and events against asked dates of the same key, in one sorted pass over both: linear in a key with many of each."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideline.operators.dealing import dealt

FOREVER = (1 << 63) - 1


def ordinal(c: Column, kind: str) -> Column:
    """A date, time or whole number as a long of the same order."""
    if kind == "date":
        return F.unix_date(c).cast("long")
    if kind == "timestamp":
        return F.unix_micros(c)
    if kind == "timestamp_ntz":
        return F.unix_micros(c.cast("timestamp"))
    return c.cast("long")


def latest_open(df: DataFrame, intervals: DataFrame, key: str, date: str, start: str, end: str, columns: list[str]) -> DataFrame:
    """Key, date and `held` (a struct of the columns) of each key and date of df that an interval of the key holds, both
    ends inside, a null end open: of several the interval that starts last, of those that start together the one with the
    largest columns. Rows with a null key or date and intervals with a null key or start hold nothing.

    Starts and asked dates of a key are sorted together and walked once. Open intervals lie on a stack; one that begins
    later and ends no earlier hides those below it for good, so these are dropped, and the ends on the stack fall from its
    bottom to its top. The stack goes from batch to batch.
    """
    kinds = dict(df.dtypes)
    held = F.struct(*columns)
    asked = df.select(key, date).where(F.col(key).isNotNull() & F.col(date).isNotNull()).distinct()
    # of equal intervals one is enough; this is done before the shuffle of the sweep
    spans = intervals.select(F.col(key), F.col(start).alias("_from"), F.coalesce(ordinal(F.col(end), dict(intervals.dtypes)[end]), F.lit(FOREVER)).alias("_end"), held.alias("held"))
    spans = dealt(spans.where(F.col(key).isNotNull() & F.col("_from").isNotNull()), key, "_from").groupBy(key, "_from", "held").agg(F.max("_end").alias("_end"))
    a = asked.select(F.col(key).alias("key"), ordinal(F.col(date), kinds[date]).alias("at"), F.lit(1).alias("side"), F.lit(0).cast("long").alias("end"), F.col(date).alias("date"), F.lit(None).cast(spans.schema["held"].dataType).alias("held"))
    b = spans.select(F.col(key).alias("key"), ordinal(F.col("_from"), dict(spans.dtypes)["_from"]).alias("at"), F.lit(0).alias("side"), F.col("_end").alias("end"), F.lit(None).cast(kinds[date]).alias("date"), "held")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, stack, carried = None, [], None
        for batch in batches:
            own = batch.column("held")
            payload = own if carried is None else pa.concat_arrays([carried, own])
            before, rows, picks = len(payload) - len(own), [], []
            at, ends, begins = batch.column("at").to_pylist(), batch.column("end").to_pylist(), batch.column("side").to_numpy() == 0
            codes = batch.column("key").dictionary_encode().indices.to_numpy(zero_copy_only=False)
            fresh = np.concatenate(([True], codes[1:] != codes[:-1]))[: len(codes)]
            # between two starts, or keys, the asked dates ascend: each open interval holds a stretch of them
            edges = np.flatnonzero(fresh | begins)
            for a, z, new, start in zip(edges.tolist(), [*edges[1:].tolist(), len(at)], fresh[edges].tolist(), begins[edges].tolist(), strict=True):
                if new and (a or batch.column("key")[0].as_py() != current):
                    current, stack = batch.column("key")[a].as_py(), []
                if start:
                    until = ends[a]
                    while stack and stack[-1][0] <= until:
                        stack.pop()
                    stack.append((until, before + a))
                    a += 1
                while stack and a < z:
                    m = bisect_right(at, stack[-1][0], a, z)
                    if m > a:
                        rows.extend(range(a, m))
                        picks.extend([stack[-1][1]] * (m - a))
                    if m < z:
                        stack.pop()
                    a = m
            at_, picked = pa.array(rows, pa.int64()), pa.array(picks, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("key").take(at_), batch.column("date").take(at_), payload.take(picked)], names=["key", "date", "held"])
            carried = payload.take(pa.array([i for _, i in stack], pa.int64()))
            stack = [(until, i) for i, (until, _) in enumerate(stack)]

    both = a.unionByName(b)
    schema = both.select("key", "date", "held").schema
    return dealt(both, "key").sortWithinPartitions("key", "at", "side", "held").mapInArrow(sweep, schema).withColumnsRenamed({"key": key, "date": date})


def stretches(intervals: DataFrame, key: str, start: str, end: str, value: str) -> DataFrame:
    """Key, value, `_from` and `_until` of the stretches of days, none of which overlap, that intervals of a key hold, both
    ends inside: of several the interval that starts last, of those that start together the one with the largest value.

    Starts of a key are sorted and walked once, with the open intervals on a stack as in `latest_open`. Up to the next start
    the top holds the days to its end, then the one below it; there are at most two stretches for each interval.
    """
    rows = intervals.select(F.col(key), F.unix_date(start).alias("_at"), F.unix_date(end).alias("_end"), F.col(value)).where("_at <= _end")

    def settle(stack: list, day: int, before: int, out: list) -> None:
        while stack and day < before:
            until, i = stack[-1]
            if until < day:
                stack.pop()
            else:
                out.append((i, day, min(until, before - 1)))
                day = min(until, before - 1) + 1

    def batch_of(out: list, keys: pa.Array, values: pa.Array) -> pa.RecordBatch:
        picks = pa.array([i for i, *_ in out], pa.int64())
        ends = [pa.array([o[k] for o in out], pa.int32()).cast(pa.date32()) for k in (1, 2)]
        return pa.RecordBatch.from_arrays([keys.take(picks), values.take(picks), *ends], names=[key, value, "_from", "_until"])

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, stack, day, keys, values = None, [], 0, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            before = 0 if keys is None else len(keys)
            keys = batch.column(0) if keys is None else pa.concat_arrays([keys, batch.column(0)])
            values = batch.column(3) if values is None else pa.concat_arrays([values, batch.column(3)])
            codes = batch.column(0).dictionary_encode("encode").indices.to_numpy()
            fresh = np.concatenate(([batch.column(0)[0].as_py() != current], codes[1:] != codes[:-1])).tolist()
            out: list = []
            for i, (new, at, until) in enumerate(zip(fresh, batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True), before):
                settle(stack, day, FOREVER if new else at, out)
                if new:
                    stack.clear()
                while stack and stack[-1][0] <= until:
                    stack.pop()
                stack.append((until, i))
                day = at
            yield batch_of(out, keys, values)
            current, held = keys[-1].as_py(), pa.array([i for _, i in stack], pa.int64())
            keys, values, stack = keys.take(held), values.take(held), [(until, i) for i, (until, _) in enumerate(stack)]
        out = []
        settle(stack, day, FOREVER, out)
        if out:
            yield batch_of(out, keys, values)

    schema = StructType([rows.schema[key], rows.schema[value], *StructType.fromDDL("_from date, _until date")])
    return dealt(rows, key).sortWithinPartitions(key, "_at", value, "_end").mapInArrow(sweep, schema)


def covered(df: DataFrame, intervals: DataFrame, key: str, date: str, start: str, end: str) -> DataFrame:
    """Distinct keys and dates of df that lie inside an interval of the key (a null start or end is open): the running
    largest end of all intervals that have begun."""
    kinds, spans = dict(df.dtypes), dict(intervals.dtypes)
    asked = df.select(key, date).where(F.col(key).isNotNull() & F.col(date).isNotNull()).distinct().select(F.col(key), F.col(date), ordinal(F.col(date), kinds[date]).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast("long").alias("_end"))
    begins = F.coalesce(ordinal(F.col(start), spans[start]), F.lit(-FOREVER))
    own = intervals.where(F.col(key).isNotNull()).select(F.col(key), begins.alias("_at"), F.coalesce(ordinal(F.col(end), spans[end]), F.lit(FOREVER)).alias("_end")).groupBy(key, "_at").agg(F.max("_end").alias("_end"))
    own = own.select(key, F.lit(None).cast(kinds[date]).alias(date), "_at", F.lit(0).alias("_side"), "_end")
    run = Window.partitionBy(key).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    return asked.unionByName(own).withColumn("_open", F.max("_end").over(run)).where("_side = 1 AND _open >= _at").select(key, date)


def nearest(df: DataFrame, events: DataFrame, key: str, date: str, event: str, name: str, *, ahead: bool) -> DataFrame:
    """Distinct keys and dates of df with the newest event of the key before the date, or (ahead) the earliest one behind
    it; null if there is none. Events on the date itself do not count."""
    asked = df.select(key, date).distinct().select(key, date, F.col(date).alias("_at"), F.lit(0).alias("_side"), F.lit(None).cast(dict(events.dtypes)[event]).alias("_event"))
    own = events.where(F.col(key).isNotNull() & F.col(event).isNotNull()).select(key, F.col(event).alias("_event")).distinct()
    own = own.select(key, F.lit(None).cast(dict(df.dtypes)[date]).alias(date), F.col("_event").alias("_at"), F.lit(1).alias("_side"), "_event")
    run = Window.partitionBy(key).orderBy(F.desc("_at") if ahead else F.asc("_at"), "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = asked.unionByName(own).withColumn(name, F.last("_event", ignorenulls=True).over(run)).where("_side = 0")
    # rows without a key or date have no event
    return found.select(key, date, F.when(F.col(key).isNotNull() & F.col(date).isNotNull(), F.col(name)).alias(name))
