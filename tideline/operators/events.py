"""Aggregates of events, holders, snapshots and ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hot_list(df: DataFrame, symbol: str, date: str, heat: str) -> DataFrame:
    """Of each date how many symbols are listed, and each one's percentile from the hottest (1) to the last (0)."""
    w = Window.partitionBy(date)
    r = df.select(symbol, date, F.rank().over(w.orderBy(F.desc(heat), symbol)).alias("_k"), F.count("*").over(w).alias("n_listed"))
    return r.select(symbol, date, "n_listed", F.when(F.col("n_listed") > 1, 1 - (F.col("_k") - 1) / (F.col("n_listed") - 1)).alias("rank_pct"))


def rank_gain(df: DataFrame, symbol: str, date: str, metric: str) -> DataFrame:
    """The rank by a metric on each date, and the gain since the symbol's appearance before."""
    r = df.select(symbol, date, F.rank().over(Window.partitionBy(date).orderBy(F.desc(metric), symbol)).alias("rank"))
    return r.withColumn("rank_gain", F.lag("rank").over(Window.partitionBy(symbol).orderBy(date)) - F.col("rank"))


def holder_concentration(df: DataFrame, keys: list[str], amount: str, holder: str, institution: Column) -> DataFrame:
    """Per key the total held, what institutions hold of it, and how many they are."""
    own = df.withColumn("_own", institution)
    return own.groupBy(*keys).agg(F.sum(amount).alias("total"), F.sum(F.when(F.col("_own"), F.col(amount))).alias("institutional"), F.countDistinct(F.when(F.col("_own"), F.col(holder))).alias("n_institutions"))


def monthly_on_days(days: DataFrame, events: DataFrame, symbol: str, date: str, name: str) -> DataFrame:
    """Each day with the number of its month's events."""
    month = F.date_format(date, "yyyyMM")
    m = events.groupBy(symbol, month.alias("_m")).agg(F.count("*").alias(name))
    return days.select(symbol, date).distinct().withColumn("_m", month).join(m, [symbol, "_m"], "left").select(symbol, date, F.coalesce(name, F.lit(0)).alias(name))


def latest_complete(df: DataFrame, time: str, unit: str, kind: str, need: int) -> DataFrame:
    """Rows of the newest time unit in which so many kinds were seen, and how many newer units were skipped."""
    e = df.withColumn("minute", F.date_trunc(unit, time))
    m = e.groupBy("minute").agg(F.countDistinct(kind).alias("_n"))
    best = m.agg(F.max(F.when(F.col("_n") >= need, F.col("minute"))).alias("_best"), F.array_agg("minute").alias("_all"))  # one value a unit
    best = best.select(F.col("_best").alias("minute"), F.size(F.filter("_all", lambda x: x > F.col("_best"))).cast("long").alias("skipped"))
    return e.join(F.broadcast(best), "minute")


def rank_gaps(df: DataFrame, by: str, rank: str) -> DataFrame:
    """Per group how many ranks below its largest nobody holds, and the first of them."""
    s = df.select(by, F.col(rank).alias("_r")).distinct()
    k = s.groupBy(by).agg(F.max("_r").alias("_top")).select(by, F.explode(F.sequence(F.lit(1), "_top")).alias("_r"))
    return k.join(s, [by, "_r"], "left_anti").groupBy(by).agg(F.count("*").alias("n_missing"), F.min("_r").alias("first_missing"))


def backwards(df: DataFrame, by: str, order: str, value: str) -> DataFrame:
    """Per group how often a value falls below the one before."""
    step = F.col(value) - F.lag(value).over(Window.partitionBy(by).orderBy(order))
    return df.select(by, step.alias("_s")).groupBy(by).agg(F.count_if(F.col("_s") < 0).alias("n_backwards"))


def grid_hours(df: DataFrame, symbol: str, time: str, need: int) -> DataFrame:
    """Per symbol and day the hours seen and whether all are there."""
    return df.groupBy(symbol, F.to_date(time).alias("day")).agg(F.countDistinct(F.hour(time)).alias("n_hours")).withColumn("complete", F.col("n_hours") == need)


def tiers(df: DataFrame, date: str, first: Column, second: Column, names: tuple[str, str]) -> DataFrame:
    """Dates by the sources that cover them: both, one of the two by name, or none."""
    f = df.groupBy(date).agg(F.bool_or(first).alias("_a"), F.bool_or(second).alias("_b"))
    tier = F.when(F.col("_a") & F.col("_b"), "both").when(F.col("_a"), names[0]).when(F.col("_b"), names[1]).otherwise("none")
    return f.groupBy(tier.alias("tier")).agg(F.count("*").alias("n_days"), F.min(date).alias("first_day"))


def weights(value: str, *by: str) -> Column:
    """A value's share of its group."""
    return F.col(value) / F.sum(value).over(Window.partitionBy(*by))


def cumulative_factor(ratio: Column, by: list[str], order: list[str]) -> Column:
    """The product of positive ratios up to each row, as the exponential of a running sum of logarithms."""
    return F.exp(F.sum(F.ln(ratio)).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


def sessions_since(df: DataFrame, flag: Column, symbol: str, date: str, name: str, none: int = 999) -> DataFrame:
    """Adds how many sessions of the whole table lie between each row and the symbol's last flagged one."""
    days = df.select(date).distinct().withColumn("_i", F.row_number().over(Window.orderBy(date)))  # one row a date
    last = F.max(F.when(flag, F.col("_i"))).over(Window.partitionBy(symbol).orderBy(date))
    return df.join(F.broadcast(days), date).withColumn(name, F.coalesce(F.col("_i") - last, F.lit(none)).cast("long")).drop("_i")
