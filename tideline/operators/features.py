"""Feature pipelines: flows with ownership, institutional and insider events, and hotspots. Each is one job whose joins
and windows share the keys (symbol, date)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.dealing import dealt
from tideline.operators.joins import interval_member
from tideline.operators.normalize import filled
from tideline.operators.windows import cross_rank, cross_zscore, positive_share, rolling_sum, rows, safe_ratio, with_rows_since


def flow_features(flows: DataFrame, daily: DataFrame, industries: DataFrame, windows: list[int], *, symbol: str = "symbol", date: str = "d") -> DataFrame:
    """Money flow of each symbol and day: net flow against the day's amount, sums and ratios over the last observed rows,
    the share of positive days, ranks and z-scores over all symbols of the day and inside each industry.

    flows: symbol, date, large_buy, large_sell, small_buy, small_sell. daily: symbol, date, amount. industries: symbol,
    start, end, industry.
    """
    part = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    j = flows.join(daily.select(symbol, date, "amount"), [symbol, date], "left")
    j = interval_member(j, industries, symbol, date, "start", "end", ["industry"])
    j = j.withColumns({"net_large": part("large_buy") - part("large_sell"), "net": part("large_buy") - part("large_sell") + part("small_buy") - part("small_sell")})
    j = j.withColumn("net_to_amount", safe_ratio(F.col("net"), F.col("amount")))
    for n in windows:
        w = rows(symbol, date, n)
        j = j.withColumns({f"net_{n}": rolling_sum("net", w), f"net_large_{n}": rolling_sum("net_large", w), f"_amount_{n}": rolling_sum("amount", w), f"positive_{n}": positive_share("net", w)})
        j = j.withColumn(f"net_{n}_to_amount", safe_ratio(F.col(f"net_{n}"), F.col(f"_amount_{n}"))).drop(f"_amount_{n}")
    last = f"net_{windows[-1]}_to_amount"
    return j.withColumns({"rank": cross_rank(last, date), "z": cross_zscore(last, date), "industry_z": cross_zscore(last, date, "industry")})


def on_panel(events: DataFrame, panel: DataFrame, symbol: str, date: str) -> DataFrame:
    """Events merged with the panel's rows of their symbols, between the first and the last event."""
    span = events.agg(F.min(date).alias("_a"), F.max(date).alias("_z"))  # one row
    own = panel.join(events.select(symbol).distinct(), symbol, "left_semi").join(F.broadcast(span), F.col(date).between(F.col("_a"), F.col("_z"))).drop("_a", "_z")
    return own.join(events, [symbol, date], "full_outer")


def institution_features(events: DataFrame, panel: DataFrame, window: int, *, symbol: str = "symbol", date: str = "d") -> DataFrame:
    """Rolling features of institutional events (n_events, n_buys, n_sells, net_buy) on a panel of amounts: sums over the
    last rows, net buying against the amount, and rows since the last event and the last buy."""
    counts = ("n_events", "n_buys", "n_sells", "net_buy")
    df = on_panel(events, panel.select(symbol, date, "amount"), symbol, date).withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in counts})
    w = rows(symbol, date, window)
    df = df.withColumn("net_buy_to_amount", F.when(F.col("amount") > 0, F.col("net_buy") / F.col("amount")))
    df = df.withColumns({f"{c}_{window}": F.sum(c).over(w) for c in counts} | {"_amount": F.sum("amount").over(w)})
    df = df.withColumns({f"net_buy_{window}_to_amount": F.when(F.col("_amount") > 0, F.col(f"net_buy_{window}") / F.col("_amount")), f"is_event_{window}": (F.col(f"n_events_{window}") > 0).cast("double")})
    df = with_rows_since(df, F.col("n_events") > 0, symbol, date, "since_event")
    return with_rows_since(df, F.col("n_buys") > 0, symbol, date, "since_buy").drop("_amount")


def insider_features(events: DataFrame, panel: DataFrame, amount_window: int, count_window: int, *, symbol: str = "symbol", date: str = "d") -> DataFrame:
    """Rolling features of insider trades (n_events, n_buys, n_sells, net_volume, net_amount) on a panel of float values.

    Amounts and counts have windows of their own. An amount that an event lacks stays unknown; a day without events has
    none, so its amount is zero.
    """
    counts = ("n_events", "n_buys", "n_sells", "net_volume")
    df = on_panel(events, panel.select(symbol, date, "float_value"), symbol, date).withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in counts})
    df = df.withColumn("net_amount", F.when(F.col("n_events") <= 0, F.coalesce("net_amount", F.lit(0.0))).otherwise(F.col("net_amount")))
    a, c = rows(symbol, date, amount_window), rows(symbol, date, count_window)
    df = df.withColumns({f"net_amount_{amount_window}": F.sum("net_amount").over(a)} | {f"{x}_{count_window}": F.sum(x).over(c) for x in counts})
    df = df.withColumn(f"net_amount_{amount_window}_to_float", F.when(F.col("float_value") > 0, F.col(f"net_amount_{amount_window}") / F.col("float_value")))
    return with_rows_since(df, F.col("n_events") > 0, symbol, date, "since_event")


def insider_daily(trades: DataFrame, keys: list[str], volume: str, amount: str, holder: str, direction: Column) -> DataFrame:
    """Insider trades by key: counts by direction, holders, signed volume, and signed amount, which is null only where no
    trade has one."""
    d = trades.withColumn("_d", direction)
    return d.groupBy(*keys).agg(F.count("*").alias("n_events"), F.count_if(F.col("_d") > 0).alias("n_buys"), F.count_if(F.col("_d") < 0).alias("n_sells"), F.countDistinct(holder).alias("n_holders"), F.sum(F.col("_d") * F.col(volume)).alias("net_volume"), F.sum(F.col("_d") * F.col(amount)).alias("net_amount"))


def fund_holdings(holdings: DataFrame, keys: list[str], disclosed: str, sums: list[str]) -> DataFrame:
    """Fund holdings by key: the latest disclosure and the sums."""
    return holdings.groupBy(*keys).agg(F.max(disclosed).alias(disclosed), F.count("*").alias("n_rows"), *[F.sum(c).alias(c) for c in sums])


#: Columns of the hotspot features and what stands where there is none.
HOTSPOT = {"hot_count": 0, "hot_rank": 0, "hot_change": 0, "days_since_hot": 999, "n_themes": 0, "strongest_theme": 0, "leader": 0, "n_events_5": 0, "n_events_20": 0, "n_recommended": 0}


def hotspot_features(grid: DataFrame, hot: DataFrame, themes: DataFrame, members: DataFrame, events: DataFrame, monthly: DataFrame, *, symbol: str = "symbol", date: str = "d") -> DataFrame:
    """Hotspot features on a grid of symbols and days.

    hot: symbol, date, heat. themes: date, theme, strength, lead. members: date, theme, symbol. events: symbol, date.
    monthly: symbol, month (yyyyMM). Days since the last hot day count open days of the grid.
    """
    keys = [symbol, date]
    day = Window.partitionBy(date).orderBy(F.desc("heat"), symbol)
    ranked = dealt(hot.select(*keys, "heat"), date).withColumns({"_k": F.rank().over(day), "hot_count": F.count("*").over(Window.partitionBy(date))})
    ranked = ranked.withColumn("hot_rank", F.when(F.col("hot_count") > 1, 1 - (F.col("_k") - 1) / (F.col("hot_count") - 1)).otherwise(1.0))
    ranked = dealt(ranked, symbol).withColumn("hot_change", F.lag("_k").over(Window.partitionBy(symbol).orderBy(date)) - F.col("_k")).select(*keys, "hot_count", "hot_rank", "hot_change", F.lit(True).alias("_hot"))
    exposure = dealt(dealt(members, date, "theme").join(themes, [date, "theme"]), *keys).groupBy(*keys).agg(F.countDistinct("theme").alias("n_themes"), F.max("strength").alias("strongest_theme"), F.max((F.col("lead") == F.col(symbol)).cast("int")).alias("leader"))
    counted = dealt(events, *keys).groupBy(*keys).agg(F.count("*").alias("_events"))
    days = grid.select(date).distinct().withColumn("_day", F.row_number().over(Window.orderBy(date)))  # one row a day
    out = grid.select(*keys).join(F.broadcast(days), date).join(ranked, keys, "left").join(exposure, keys, "left").join(counted, keys, "left").withColumn("month", F.date_format(date, "yyyyMM"))
    out = dealt(out, symbol, "month").join(monthly.groupBy(symbol, "month").agg(F.count("*").alias("n_recommended")), [symbol, "month"], "left")
    out = dealt(out, symbol).withColumn("_events", F.coalesce("_events", F.lit(0)))
    before = Window.partitionBy(symbol).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col("_hot"), F.col("_day")), ignorenulls=True).over(before)
    out = out.withColumns({"days_since_hot": F.col("_day") - last, "n_events_5": F.sum("_events").over(rows(symbol, date, 5)), "n_events_20": F.sum("_events").over(rows(symbol, date, 20))})
    return filled(out, keys, HOTSPOT)
