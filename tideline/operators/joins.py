"""As-of, interval, overlay and fusion joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.dealing import dealt
from tideline.operators.sweeps import latest_open


def as_of(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, columns: list[str]) -> DataFrame:
    """Each left row with the columns of the latest right row of its key at or before it (null if none).

    Both sides meet in one sorted union, so the plan is one shuffle on the keys and a running last value: no range join,
    and a key with many rows on both sides stays linear. right must have one row per key and time.
    """
    held = F.struct(F.col(right_time).alias("_time"), *columns)
    a = left.select(*keys, F.col(left_time).alias("_at"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"), F.lit(None).cast(right.select(held.alias("h")).schema["h"].dataType).alias("_held"))
    b = right.select(*keys, F.col(right_time).alias("_at"), F.lit(0).alias("_side"), F.lit(None).cast(a.schema["_row"].dataType).alias("_row"), held.alias("_held"))
    w = Window.partitionBy(*keys).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    out = a.unionByName(b).withColumn("_held", F.last("_held", ignorenulls=True).over(w)).where("_side = 1")
    return out.select("_row.*", F.col("_held._time").alias(f"{right_time}_matched"), *[F.col(f"_held.{c}").alias(c) for c in columns])


def as_of_label(panel: DataFrame, changes: DataFrame, symbol: str, date: str, start: str, end: str, label: str) -> DataFrame:
    """Labels in force: rows before the first change keep a null label, rows behind a closed interval go, symbols without
    changes go."""
    known = panel.join(changes.select(symbol).distinct(), symbol, "left_semi")
    out = as_of(known, changes, [symbol], date, start, [end, label])
    return out.where(F.col(end).isNull() | (F.col(date) <= F.col(end))).drop(end, f"{start}_matched")


def interval_member(df: DataFrame, intervals: DataFrame, key: str, date: str, start: str, end: str, columns: list[str]) -> DataFrame:
    """The interval of the key that holds the date; of several the one that starts last, of those that start together the
    one with the largest columns; null if none."""
    held = dealt(latest_open(df, intervals, key, date, start, end, columns).withColumnRenamed("held", "_held"), key, date)
    return df.join(held, [key, date], "left").select(*df.columns, *[F.col(f"_held.{c}").alias(c) for c in columns])


def next_session(dates: DataFrame, calendar: DataFrame, date: str, session: str, strict: bool = True) -> DataFrame:
    """Adds next_session: the first open day after the date (at or after it if not strict); null beyond the calendar."""
    days = calendar.select(F.col(session).alias("_at")).distinct().select("_at", F.col("_at").alias("_day"), F.lit(0 if strict else 1).alias("_side"))
    asked = dates.select(F.col(date).alias("_at")).where("_at IS NOT NULL").distinct().select("_at", F.lit(None).cast("date").alias("_day"), F.lit(1 if strict else 0).alias("_side"))
    # one row for each date or session; a session of the same day stands before a strict date and behind another
    ahead = Window.orderBy("_at", "_side").rowsBetween(1, Window.unboundedFollowing)
    coming = days.unionByName(asked).withColumn("next_session", F.first("_day", ignorenulls=True).over(ahead)).where("_day IS NULL").select(F.col("_at").alias(date), "next_session")
    return dates.join(coming, date, "left").select(*dates.columns, "next_session")


def overlay(df: DataFrame, extra: DataFrame, keys: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    """Left join of the last row per key of another table."""
    last = extra.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1")
    return df.join(last.select(*keys, *columns), keys, "left")


def fuse(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Union of two sources; the second wins where both have a key. Adds source."""
    a = first.join(second.select(*keys).distinct(), keys, "left_anti").withColumn("source", F.lit("first"))
    return a.unionByName(second.withColumn("source", F.lit("second")), allowMissingColumns=True)


def by_precedence(sources: list[tuple[str, DataFrame]], keys: list[str]) -> DataFrame:
    """One row per key from the first source of the list that has it. Adds source."""
    tagged = [df.withColumns({"source": F.lit(name), "_p": F.lit(i)}) for i, (name, df) in enumerate(sources)]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return every.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("_p"))).where("_n = 1").drop("_n", "_p")


def disjoint_union(base: DataFrame, extra: DataFrame, keys: list[str]) -> DataFrame:
    """Union of tables that share no key; a shared key is an error when the rows are read."""
    both = base.withColumn("_t", F.lit(0)).unionByName(extra.withColumn("_t", F.lit(1)))
    w = Window.partitionBy(*keys)
    clash = F.min("_t").over(w) != F.max("_t").over(w)
    stop = F.raise_error(F.lit("both tables have one key")).cast("int")
    return both.withColumn("_t", F.when(clash, stop).otherwise(F.col("_t"))).where("_t >= 0").drop("_t")


def pairing(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Key counts by side: both, only_a, only_b."""
    x, y = (df.select(*keys).distinct().withColumn(f"_{n}", F.lit(True)) for df, n in ((a, "a"), (b, "b")))
    side = F.when(F.col("_a") & F.col("_b"), "both").when(F.col("_a"), "only_a").otherwise("only_b")
    return x.join(y, keys, "full_outer").groupBy(side.alias("side")).agg(F.count("*").alias("n"))


def outer_merge(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    return reduce(lambda a, b: a.join(b, keys, "full_outer"), frames)


def active_on(dates: DataFrame, spans: DataFrame, date: str, start: str, end: str) -> DataFrame:
    """Number of spans that hold each date, from +1/-1 events and a running sum: no range join."""
    starts = spans.where(F.col(start).isNotNull()).select(F.col(start).alias("_at"), F.lit(1).alias("_x"))
    ends = spans.where(F.col(start).isNotNull() & F.col(end).isNotNull()).select(F.date_add(end, 1).alias("_at"), F.lit(-1).alias("_x"))
    steps = starts.union(ends).groupBy("_at").agg(F.sum("_x").alias("_x"))
    asked = dates.select(F.col(date).alias("_at")).distinct().withColumn("_asked", F.lit(True))
    every = steps.join(asked, "_at", "full_outer")
    running = F.sum(F.coalesce("_x", F.lit(0))).over(Window.orderBy("_at"))  # one row a date
    return every.withColumn("n_active", running).where("_asked").select(F.col("_at").alias(date), "n_active")


def shifted_match(a: DataFrame, b: DataFrame, key: str, time: str, value: str, minutes: list[int]) -> DataFrame:
    """Per key and shift: matched rows and mean absolute difference of a against b moved by so many minutes."""
    shifts = F.explode(F.array(*[F.lit(m) for m in minutes])).alias("shift")
    moved = b.select(F.col(key), F.col(time).alias("_t"), F.col(value).alias("_v"), shifts)
    moved = moved.withColumn(time, F.col("_t") + F.make_dt_interval(mins=F.col("shift")))
    return a.select(key, time, value).join(moved.select(key, time, "shift", "_v"), [key, time]).groupBy(key, "shift").agg(F.count("*").alias("n"), F.avg(F.abs(F.col(value) - F.col("_v"))).alias("mae"))
