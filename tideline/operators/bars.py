"""Bars from trades, and the panels that are derived from bars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType


#: Rows that are summed up at once in search of a bar's end.
STEP = 256
#: Cells of a wide panel that are laid out at once.
CELLS = 8_000_000
#: Columns from which on a task's start, which goes with their number, is paid once a core only.
WIDE = 5_000


def ohlcv(trades: DataFrame, keys: list[str | Column], order: list[str], price: str = "price", volume: str = "volume") -> DataFrame:
    """One bar per key: first and last price in `order`, extremes, volume, amount and number of trades.

    min_by and max_by on a struct keep the aggregate partial, so each task sends one row per key to the shuffle.
    """
    at = F.struct(*order)
    return trades.groupBy(*keys).agg(
        F.min_by(price, at).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, at).alias("close"),
        F.sum(volume).alias("volume"),
        F.sum(F.col(price) * F.col(volume)).alias("amount"),
        F.count("*").alias("n_trades"),
    )


def tick_bars(trades: DataFrame, symbol: str, order: list[str], size: int, price: str = "price", volume: str = "volume") -> DataFrame:
    """Bars of `size` trades each; the last of a symbol may hold fewer."""
    w = Window.partitionBy(symbol).orderBy(*order)
    numbered = trades.withColumn("bar", F.floor((F.row_number().over(w) - 1) / size).cast("long"))
    return ohlcv(numbered, [symbol, "bar"], order, price, volume)


def activity_bars(trades: DataFrame, symbol: str, order: list[str], threshold: float, kind: str = "volume", price: str = "price", volume: str = "volume") -> DataFrame:
    """Bars that close once their volume (or traded amount) reaches `threshold`; the sum then starts again at zero.

    The reset is not a prefix sum, so bar numbers are made in order inside each symbol, in Arrow batches with the sum
    carried from batch to batch; a symbol is never held whole. Rows with a null go; prices and volumes must be positive.
    """
    if kind not in ("volume", "amount"):
        raise ValueError(f"kind is volume or amount, not {kind}")
    rows = trades.select(F.col(symbol).alias("symbol"), *[F.col(c) for c in order if c != symbol], F.col(price).alias("price"), F.col(volume).alias("volume")).dropna()
    bad = F.raise_error(F.lit("prices and volumes must be positive")).cast("double")
    rows = rows.withColumn("price", F.when((F.col("price") > 0) & (F.col("volume") > 0), F.col("price")).otherwise(bad))
    keys = [c for c in order if c != symbol]
    dealt = rows.repartition("symbol").sortWithinPartitions("symbol", *keys)

    def number(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held, bar = None, 0.0, 0
        for frame in frames:
            amount = (frame["volume"] if kind == "volume" else frame["price"] * frame["volume"]).to_numpy(float)
            symbols = frame["symbol"].to_numpy()
            bars = np.zeros(len(frame), np.int64)
            edges = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1])))
            for a, z in zip(edges.tolist(), [*edges[1:].tolist(), len(frame)], strict=True):
                if symbols[a] != now:
                    now, held, bar = symbols[a], 0.0, 0
                # a bar ends where its sum reaches the threshold; one search finds each end
                while a < z:
                    sums = np.cumsum(np.concatenate(([held], amount[a : min(z, a + STEP)])))[1:]
                    n = int(np.searchsorted(sums, threshold)) + 1
                    bars[a : a + min(n, len(sums))] = bar
                    if n <= len(sums):
                        held, bar, a = 0.0, bar + 1, a + n
                    else:
                        held, a = float(sums[-1]), a + len(sums)
            yield frame.assign(bar=bars)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema) + ", bar long"
    return ohlcv(dealt.mapInPandas(number, schema), ["symbol", "bar"], keys)


def tick_rule(price: str, w, initial: int = 1) -> Column:
    """Sign of the last price change that was not zero, `initial` before the first."""
    side = F.signum(F.col(price) - F.lag(price).over(w))
    return F.when(side != 0, side)


def trade_sides(trades: DataFrame, symbol: str, order: list[str], price: str = "price", initial: int = 1) -> DataFrame:
    w = Window.partitionBy(symbol).orderBy(*order)
    marked = trades.withColumn("_change", tick_rule(price, w, initial))
    side = F.last("_change", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("side", F.coalesce(side, F.lit(initial)).cast("int")).drop("_change")


def last_of_period(panel: DataFrame, symbol: str, date: str, period: str) -> DataFrame:
    """The last row of each symbol in each month, quarter or year."""
    w = Window.partitionBy(symbol, F.date_trunc(period, date)).orderBy(F.desc(date))
    return panel.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def adjust(panel: DataFrame, factors: DataFrame | None, symbol: str, date: str, columns: list[str], factor: str = "factor") -> DataFrame:
    """Prices times the day's factor over the symbol's latest factor; where no factor is known they stay raw. Without
    `factors` the panel holds its own, and is read once."""
    if factors is None:
        joined = panel.withColumn("_latest", F.max_by(factor, date).over(Window.partitionBy(symbol)))
    else:
        latest = factors.groupBy(symbol).agg(F.max_by(factor, date).alias("_latest"))
        joined = panel.join(factors.select(symbol, date, factor), [symbol, date], "left").join(latest, symbol, "left")
    ratio = F.when(F.col("_latest") != 0, F.col(factor) / F.col("_latest"))
    joined = joined.withColumn("adjust_source", F.when(ratio.isNull(), "raw").otherwise("factor"))
    return joined.withColumns({f"{c}_adj": F.col(c) * F.coalesce(ratio, F.lit(1.0)) for c in columns}).drop("_latest")


def curve_deltas(curve: DataFrame, keys: list[str], bucket: str, time: str, value: str) -> DataFrame:
    """Differences of the last values of successive buckets of a cumulative curve; the first bucket counts from zero."""
    last = curve.groupBy(*keys, bucket).agg(F.max_by(value, time).alias("value"))
    return last.withColumn("delta", F.col("value") - F.coalesce(F.lag("value").over(Window.partitionBy(*keys).orderBy(bucket)), F.lit(0.0)))


def change_since(curve: DataFrame, keys: list[str], time: str, value: str, minutes: int) -> DataFrame:
    """Change against the last point at least so many minutes ago."""
    w = Window.partitionBy(*keys).orderBy(F.unix_micros(F.col(time).cast("timestamp"))).rangeBetween(Window.unboundedPreceding, -minutes * 60_000_000)
    return curve.withColumn(f"change_{minutes}m", F.col(value) - F.last(value).over(w))


def wide_panel(long: DataFrame, date: str, symbol: str, value: str, out: str, prefix: str = "s_", width: int = 400) -> list[str]:
    """One column for each symbol and one row for each date, written in groups of `width` columns side by side, so that no
    plan and no row grows with the number of symbols; returns the folders, in order. A value that is missing is null.

    The symbols are found first and named in the plans: they are the columns of the result. The long form is computed once
    and written by group, so that each group reads its own rows only.
    """
    symbols = sorted(r[0] for r in long.select(symbol).distinct().where(F.col(symbol).isNotNull()).collect())
    spark, place = long.sparkSession, {s: i for i, s in enumerate(symbols)}
    places = spark.createDataFrame([(s, i // width) for s, i in place.items()], StructType([StructField("_s", long.schema[symbol].dataType), *StructType.fromDDL("_g int")]))
    dealt = long.select(date, symbol, value).join(F.broadcast(places), F.col(symbol) == F.col("_s"), "left").drop("_s")
    dealt.repartition("_g").write.mode("overwrite").partitionBy("_g").parquet(f"{out}/long")
    every, folders = spark.read.parquet(f"{out}/long"), []
    days = every.select(date).distinct()
    for k in range(0, len(symbols), width):
        own = symbols[k : k + width]
        part = every.where(F.col("_g") == k // width).groupBy(date).pivot(symbol, own).agg(F.first(value))
        part = days.join(part.withColumnsRenamed({str(s): f"{prefix}{s}" for s in own}), date, "left")
        part.write.mode("overwrite").parquet(f"{out}/columns={k // width:05d}")
        folders.append(f"{out}/columns={k // width:05d}")
    return folders


def wide_rows(long: DataFrame, date: str, symbol: str, value: str, prefix: str = "s_", columns: DataFrame | None = None) -> DataFrame:
    """One column for each symbol and one row for each date, in one pass and one shuffle by date; a value that is missing
    is null. The symbols are found first: they are the columns of the result. `columns` holds the same symbols where these
    can be read without making the long form.

    Each date's values are laid out by their symbol's place, in blocks of at most CELLS cells (one row at least). A block
    and the start of a task cost as much as their columns, so that blocks hold many rows, and from WIDE columns on there is
    one task for each core.
    """
    symbols = sorted(r[0] for r in (long if columns is None else columns).select(symbol).distinct().where(F.col(symbol).isNotNull()).collect())
    own = pa.array(symbols) if symbols else pa.array([], pa.int64())
    n, most = len(symbols), max(1, CELLS // max(1, len(symbols)))
    kind = long.schema[value].dataType
    schema = StructType([StructField(date, long.schema[date].dataType), *[StructField(f"{prefix}{s}", kind) for s in symbols]])
    names = schema.fieldNames()

    def block(days: list, day_type: pa.DataType, parts: list[tuple[int, np.ndarray, pa.Array]], value_type: pa.DataType) -> pa.RecordBatch:
        at = np.full((n, len(days)), -1, np.int64)
        held = 0
        for row, places, values in parts:
            known = places >= 0
            at[places[known], row] = held + np.flatnonzero(known)
            held += len(places)
        flat = pa.concat_arrays([v for *_, v in parts] or [pa.array([], value_type)]).take(pa.array(at.ravel(), mask=at.ravel() < 0))
        return pa.RecordBatch.from_arrays([pa.array(days, day_type), *[flat.slice(i * len(days), len(days)) for i in range(n)]], names)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        days, parts, types = [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            d, values = batch.column(0), batch.column(2)
            types = d.type, values.type
            places = pc.fill_null(pc.index_in(batch.column(1), value_set=own.cast(batch.column(1).type)), -1).to_numpy(zero_copy_only=False)
            runs = d.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(runs[1:] != runs[:-1]) + 1).tolist(), len(runs)]
            for a, z in zip(edges, edges[1:], strict=False):
                day = d[a].as_py()
                if not days or day != days[-1]:
                    if len(days) == most:
                        yield block(days, types[0], parts, types[1])
                        days, parts = [], []
                    days.append(day)
                parts.append((len(days) - 1, places[a:z], values.slice(a, z - a)))
        if days:
            yield block(days, types[0], parts, types[1])

    parts = [long.sparkSession.sparkContext.defaultParallelism] if n >= WIDE else []
    return long.select(date, symbol, value).repartition(*parts, date).sortWithinPartitions(date).mapInArrow(spread, schema)


def side_by_side(spark: SparkSession, folders: list[str], date: str) -> DataFrame:
    """The groups of a wide panel as one table."""
    out = spark.read.parquet(folders[0])
    for folder in folders[1:]:
        out = out.join(spark.read.parquet(folder), date)
    return out
