"""Rolling and cross-sectional features. A rolling value is null until its window holds `need` values."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def guarded(agg: Column, counted: Column, w: WindowSpec, need: int) -> Column:
    """An aggregate over w, null where fewer than `need` values are there."""
    return F.when(F.count(counted).over(w) >= need, agg.over(w))


def rows(symbol: str | list[str], order: str | list[str], size: int) -> WindowSpec:
    """The current row and those before it, `size` in all."""
    keys, by = ([x] if isinstance(x, str) else x for x in (symbol, order))
    return Window.partitionBy(*keys).orderBy(*by).rowsBetween(-(size - 1), 0)


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is (nearly) zero."""
    return F.when(F.abs(b) > 1e-12, a / b)


def parkinson(high: str, low: str, w: WindowSpec, size: int, yearly: int = 252) -> Column:
    square = F.pow(F.ln(F.col(high) / F.col(low)), 2)
    return F.sqrt(guarded(F.avg(square), square, w, size) / (4 * F.ln(F.lit(2.0))) * yearly)


def amihud(close: str, amount: str, symbol: str, date: str, size: int) -> Column:
    before = F.lag(close).over(Window.partitionBy(symbol).orderBy(date))
    ratio = F.abs(F.col(close) / before - 1) / F.when(F.col(amount) != 0, F.col(amount))
    return ratio


def with_microstructure(panel: DataFrame, symbol: str = "symbol", date: str = "d", size: int = 5) -> DataFrame:
    """Parkinson volatility, Corwin-Schultz spread, Amihud illiquidity and turnover shock, on one sort per symbol."""
    w, by = rows(symbol, date, size), Window.partitionBy(symbol).orderBy(date)
    k = 3 - 2 * 2**0.5
    base = panel.withColumns(
        {
            "_hl": F.pow(F.ln(F.col("high") / F.col("low")), 2),
            "_illiq": amihud("close", "amount", symbol, date, size),
            # of two days, a missing value of one is skipped
            "_high2": F.greatest("high", F.lag("high").over(by)),
            "_low2": F.least("low", F.lag("low").over(by)),
            "_before": F.lag(F.pow(F.ln(F.col("high") / F.col("low")), 2)).over(by),
        }
    ).withColumns({"_beta": F.col("_hl") + F.col("_before"), "_gamma": F.pow(F.ln(F.col("_high2") / F.col("_low2")), 2)})
    beta = guarded(F.avg("_beta"), F.col("_beta"), w, size)
    base = base.withColumn("_b", beta)
    alpha = F.greatest((F.sqrt(2 * F.col("_b")) - F.sqrt("_b")) / k - F.sqrt(F.col("_gamma") / k), F.lit(0.0))
    base = with_rolling_median(base, "amount", symbol, date, size, size, "_median")
    return base.withColumns(
        {
            "parkinson": parkinson("high", "low", w, size),
            "spread": F.when(F.col("_b").isNotNull() & F.col("_gamma").isNotNull(), 2 * (F.exp(alpha) - 1) / (1 + F.exp(alpha))),
            "amihud": guarded(F.avg("_illiq"), F.col("_illiq"), w, size),
            "turnover_shock": safe_ratio(F.col("amount"), F.col("_median")) - 1,
        }
    ).drop("_hl", "_illiq", "_high2", "_low2", "_before", "_beta", "_gamma", "_b", "_median")


def with_rolling_median(df: DataFrame, value: str, symbol: str, date: str, size: int, need: int, name: str) -> DataFrame:
    """Adds the exact median of the last `size` rows of each symbol (null where fewer than `need` of them have a value; NaN
    is none). The window is kept sorted and goes from batch to batch: a row costs one search out and one in, however long
    the window is. Symbols are read as streams of batches, in the partitioning that the windows before have."""
    schema = df.select("*", F.lit(0.0).alias(name)).schema
    schema[name].nullable = True
    kept = list(df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[float] = []
        last: deque[float | None] = deque()
        for batch in batches:
            medians = []
            for x in batch.column(value).cast(pa.float64()).to_pylist():
                if len(last) == size and (old := last.popleft()) is not None:
                    del held[bisect_left(held, old)]
                x = None if x is None or x != x else x
                last.append(x)
                if x is not None:
                    insort(held, x)
                n = len(held)
                medians.append((held[n // 2] + held[(n - 1) // 2]) / 2 if n and n >= need else None)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(medians, pa.float64())], names=[*kept, name])

    # numbering the rows sorts them; it costs nothing where a window of that order stands below
    numbered = df.withColumn("_at", F.row_number().over(Window.partitionBy(symbol).orderBy(date)))
    return numbered.groupBy(symbol).applyInArrow(run, schema)


def rolling_zscore(x: str, w: WindowSpec, need: int = 2) -> Column:
    """(x - mean) / population deviation of the window; null where the deviation is (nearly) zero."""
    spread = guarded(F.stddev_pop(x), F.col(x), w, need)
    return F.when(spread > 1e-12, (F.col(x) - F.avg(x).over(w)) / spread)


def positive_share(x: str, w: WindowSpec) -> Column:
    return F.avg((F.col(x) > 0).cast("double")).over(w)


def cross_rank(x: str, *by: str) -> Column:
    """Percentile rank with average ties over the non-null values of a group."""
    w = Window.partitionBy(*by)
    rank = F.rank().over(w.orderBy(F.asc_nulls_last(x))) + (F.count(x).over(Window.partitionBy(*by, x)) - 1) / 2
    return F.when(F.col(x).isNotNull(), rank / F.count(x).over(w))


def cross_zscore(x: str, *by: str) -> Column:
    """z-score within a group; null where the group's label is null or its deviation is zero."""
    w = Window.partitionBy(*by)
    spread = F.stddev_pop(x).over(w)
    known = F.lit(True)
    for c in by:
        known &= F.col(c).isNotNull()
    return F.when(known & (spread > 1e-12), (F.col(x) - F.avg(x).over(w)) / spread)


def rolling_sum(x: str, w: WindowSpec) -> Column:
    """Missing values count as zero."""
    return F.sum(F.coalesce(F.col(x), F.lit(0.0))).over(w)


def with_rows_since(df: DataFrame, flag: Column, symbol: str, order: str, name: str) -> DataFrame:
    w = Window.partitionBy(symbol).orderBy(order)
    numbered = df.withColumn("_n", F.row_number().over(w)).withColumn("_hit", F.when(flag, F.col("_n")))
    last = F.last("_hit", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return numbered.withColumn(name, F.col("_n") - last).drop("_n", "_hit")


def keep_one(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key in an explicit order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def intervals(changes: DataFrame, keys: list[str], start: str) -> DataFrame:
    """Closed validity intervals: each ends the day before the next change of its key, the last is open."""
    nxt = F.lead(start).over(Window.partitionBy(*keys).orderBy(start))
    return changes.withColumn("end_date", F.date_sub(nxt, 1))


def liquidity_universe(panel: DataFrame, calendar: DataFrame, *, symbol: str, date: str, metric: str, lookback: int, need: int, least: float, quantile: float, period: str = "month") -> DataFrame:
    """Membership on the last calendar day of each period: lagged rolling median of the metric, then a per-date cut.

    Each symbol is put on the whole calendar between its first and last day, so gaps count as missing days.
    """
    days = calendar.select(date).distinct().withColumn("_k", F.row_number().over(Window.orderBy(date)))  # one row a day
    ends = days.groupBy(F.date_trunc(period, date)).agg(F.max(F.struct("_k", date)).alias("_e")).select("_e.*")
    # each day with the period ends that look back on it
    seen = F.explode(F.filter(F.col("_ends"), lambda e: (e["_k"] > F.col("_k")) & (e["_k"] <= F.col("_k") + lookback))).alias("_e")
    near = days.join(F.broadcast(ends.agg(F.collect_list(F.struct("_k", date)).alias("_ends")))).select(F.col(date).alias("_day"), seen).select("_day", F.col(f"_e.{date}").alias(date))
    span = panel.groupBy(symbol).agg(F.min(date).alias("_from"), F.max(date).alias("_to"))
    values = panel.select(symbol, F.col(date).alias("_day"), metric).where(F.col(metric).isNotNull()).join(F.broadcast(near), "_day")
    liq = values.groupBy(symbol, date).agg(F.count("*").alias("_n"), F.percentile(metric, F.lit(0.5)).alias("liq_metric")).where((F.col("_n") >= need) & (F.col("liq_metric") >= least))
    picked = liq.join(span, symbol).where(F.col(date).between(F.col("_from"), F.col("_to")))
    cut = F.expr(f"percentile(liq_metric, {quantile})").over(Window.partitionBy(date))
    return picked.withColumn("_cut", cut).where("liq_metric >= _cut").select(date, symbol, "liq_metric")


def sessions(df: DataFrame, keys: list[str], time: str, seconds: float) -> DataFrame:
    """Numbers the runs of rows of a key that follow each other within `seconds`."""
    w = Window.partitionBy(*keys).orderBy(time)
    at = F.unix_micros(F.col(time).cast("timestamp"))
    gap = (at - F.lag(at).over(w)) > int(seconds * 1e6)
    return df.withColumn("_new", F.coalesce(gap, F.lit(False)).cast("int")).withColumn("session", F.sum("_new").over(w)).drop("_new")
