"""Further queries: events and holders (AG-04..12), sessions and snapshots (WN-10..30), gates (QL-*), layouts (IO-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators import events, gates, quality, sets, windows
from tideline.plans.tables import DAILY, TICKS, TRADES, daily, rounded, table, ticks, trades
from tideline.sources.layouts import dealt, replace_partitions
from tideline.streaming.flows import work_folder

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query("""SELECT o_orderdate::DATE AS d, o_custkey AS symbol, round(sum(o_totalprice), 2) AS amount, round(avg(o_totalprice), 4) AS mean_amount, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_buys, count(DISTINCT o_orderpriority) AS n_parties FROM orders GROUP BY 1, 2""")
def ag04_event_totals(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    out = o.groupBy(F.to_date("o_orderdate").alias("d"), F.col("o_custkey").alias("symbol")).agg(F.sum("o_totalprice").alias("amount"), F.avg("o_totalprice").alias("mean_amount"), F.count_if(F.col("o_orderstatus") == "F").alias("n_buys"), F.countDistinct("o_orderpriority").alias("n_parties"))
    return rounded(rounded(out, "amount", digits=2), "mean_amount", digits=4)


@query("""WITH j AS (SELECT date_trunc('quarter', l_shipdate)::DATE AS period, l_partkey AS stock, l_suppkey AS holder, s_nationkey % 2 = 0 AS institution, l_quantity AS amount FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)
SELECT period, stock, sum(amount) AS total, sum(CASE WHEN institution THEN amount END) AS institutional, count(DISTINCT CASE WHEN institution THEN holder END) AS n_institutions, (last_day(period + INTERVAL 2 MONTH) - period)::INT AS days FROM j GROUP BY period, stock""")
def ag05_holder_concentration(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    j = table(spark, sf, "lineitem").join(s, "l_suppkey").select(F.to_date(F.date_trunc("quarter", "l_shipdate")).alias("period"), F.col("l_partkey").alias("stock"), "l_quantity", "l_suppkey", "s_nationkey")
    out = events.holder_concentration(j, ["period", "stock"], "l_quantity", "l_suppkey", F.col("s_nationkey") % 2 == 0)
    return out.withColumn("days", F.datediff(F.last_day(F.add_months("period", 2)), "period"))


@query(f"""WITH {DAILY},
r AS (SELECT *, rank() OVER (PARTITION BY d ORDER BY amount DESC, symbol) AS k, count(*) OVER (PARTITION BY d) AS n FROM daily)
SELECT symbol, d, n AS n_listed, CASE WHEN n > 1 THEN 1 - (k - 1) / (n - 1) END AS rank_pct FROM r""")
def ag08_hot_list(spark: SparkSession, sf: str) -> DataFrame:
    return events.hot_list(daily(spark, sf), "symbol", "d", "amount")


@query("""SELECT l_shipdate::DATE AS d, l_suppkey AS symbol, count(*) AS n_events, count(*) FILTER (WHERE contains(p_type, 'BRASS') OR contains(p_type, 'STEEL')) AS n_metal, max(p_size) AS largest FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2""")
def ag10_event_counts(spark: SparkSession, sf: str) -> DataFrame:
    """AG-10 and AG-12: counts, counts by text, and the largest value of a key."""
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_size")
    metal = F.col("p_type").contains("BRASS") | F.col("p_type").contains("STEEL")
    return table(spark, sf, "lineitem").join(p, "l_partkey").groupBy(F.to_date("l_shipdate").alias("d"), F.col("l_suppkey").alias("symbol")).agg(F.count("*").alias("n_events"), F.count_if(metal).alias("n_metal"), F.max("p_size").alias("largest"))


@query(f"""WITH {TRADES},
m AS (SELECT symbol, strftime(d, '%Y%m') AS month, count(*) AS n FROM trades WHERE flag = 'R' GROUP BY 1, 2)
SELECT t.symbol, t.d, coalesce(m.n, 0) AS n_month FROM (SELECT DISTINCT symbol, d FROM trades) t LEFT JOIN m ON m.symbol = t.symbol AND m.month = strftime(t.d, '%Y%m')""")
def ag11_monthly_counts(spark: SparkSession, sf: str) -> DataFrame:
    t = trades(spark, sf)
    return events.monthly_on_days(t, t.where("flag = 'R'"), "symbol", "d", "n_month")


@query(f"""WITH {TICKS},
b AS (SELECT symbol, ts::DATE AS day, date_part('hour', ts) AS h, count(*) AS n FROM ticks GROUP BY 1, 2, 3)
SELECT symbol, day, count(*) AS n_hours, count(*) = 24 AS complete FROM b GROUP BY 1, 2""")
def ag24_grid_completeness(spark: SparkSession, sf: str) -> DataFrame:
    return events.grid_hours(ticks(spark, sf), "symbol", "ts", 24)


@query(f"""WITH {TRADES},
f AS (SELECT d, bool_or(flag = 'R') AS a, bool_or(flag = 'A' AND volume > 30) AS b FROM trades GROUP BY d)
SELECT CASE WHEN a AND b THEN 'both' WHEN a THEN 'deal' WHEN b THEN 'annual' ELSE 'none' END AS tier, count(*) AS n_days, min(d) AS first_day FROM f GROUP BY 1""")
def ag27_coverage_tiers(spark: SparkSession, sf: str) -> DataFrame:
    return events.tiers(trades(spark, sf), "d", F.col("flag") == "R", (F.col("flag") == "A") & (F.col("volume") > 30), ("deal", "annual"))


@query(f"""WITH {DAILY} SELECT year(d) AS y, count(*) AS n_rows, count(*) FILTER (WHERE amount / volume > high * 1.0000001 OR amount / volume < low * 0.9999999) AS n_vwap, count(*) FILTER (WHERE amount > 150000) AS n_notional, count(*) FILTER (WHERE volume > 0 AND amount <= 0) AS n_mismatch FROM daily GROUP BY 1""")
def ag29_price_flow(spark: SparkSession, sf: str) -> DataFrame:
    v = F.col("amount") / F.col("volume")
    checks = {"n_vwap": (v > F.col("high") * 1.0000001) | (v < F.col("low") * 0.9999999), "n_notional": F.col("amount") > 150000, "n_mismatch": (F.col("volume") > 0) & (F.col("amount") <= 0)}
    return quality.counters(daily(spark, sf).withColumn("y", F.year("d").cast("long")), checks, ["y"])


@query(f"""WITH {DAILY} SELECT symbol, d, CASE WHEN stddev_pop(volume) OVER (PARTITION BY d) > 1e-12 THEN round((volume - avg(volume) OVER (PARTITION BY d)) / stddev_pop(volume) OVER (PARTITION BY d), 6) END AS z FROM daily""")
def wn10_date_zscore(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(daily(spark, sf).select("symbol", "d", windows.cross_zscore("volume", "d").alias("z")), "z")


@query(f"""WITH {TRADES},
c AS (SELECT symbol, d, count(*) FILTER (WHERE flag = 'R') AS n FROM trades GROUP BY 1, 2)
SELECT symbol, d, sum(n) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)::BIGINT AS n_5, sum(n) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)::BIGINT AS n_20 FROM c WINDOW w AS (PARTITION BY symbol ORDER BY d)""")
def wn16_rolling_counts(spark: SparkSession, sf: str) -> DataFrame:
    c = trades(spark, sf).groupBy("symbol", "d").agg(F.count_if(F.col("flag") == "R").alias("n"))
    return c.select("symbol", "d", F.sum("n").over(windows.rows("symbol", "d", 5)).alias("n_5"), F.sum("n").over(windows.rows("symbol", "d", 20)).alias("n_20"))


@query("""WITH m AS (SELECT date_trunc('hour', ts) AS minute, count(DISTINCT event_type) AS n FROM events GROUP BY 1),
l AS (SELECT max(minute) AS minute FROM m WHERE n >= 5),
s AS (SELECT count(*) AS skipped FROM m, l WHERE m.minute > l.minute)
SELECT e.event_id, e.event_type, l.minute, skipped FROM events e JOIN l ON date_trunc('hour', e.ts) = l.minute, s""")
def wn26_latest_complete(spark: SparkSession, sf: str) -> DataFrame:
    """The newest hour in which all five kinds were seen, and how many newer ones were skipped."""
    return events.latest_complete(table(spark, sf, "events"), "ts", "hour", "event_type", 5).select("event_id", "event_type", "minute", "skipped")


@query("""WITH s AS (SELECT user_id, event_id, (value * 10)::INT % 12 + 1 AS rank FROM events), k AS (SELECT user_id, unnest(range(1, max(rank) + 1)) AS rank FROM s GROUP BY user_id)
SELECT user_id, count(*) AS n_missing, min(rank)::INT AS first_missing FROM k ANTI JOIN s USING (user_id, rank) GROUP BY 1""")
def wn27_rank_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Ranks up to a snapshot's largest that nobody holds."""
    s = table(spark, sf, "events").select("user_id", (F.rint(F.col("value") * 10).cast("int") % 12 + 1).alias("rank"))
    return events.rank_gaps(s, "user_id", "rank")


@query("SELECT user_id, count(*) FILTER (WHERE s < 0) AS n_backwards FROM (SELECT user_id, value - lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS s FROM events) GROUP BY 1")
def wn29_backwards(spark: SparkSession, sf: str) -> DataFrame:
    return events.backwards(table(spark, sf, "events"), "user_id", "event_id", "value")


@query(f"""WITH {DAILY},
s AS (SELECT d, symbol, greatest(close / open - 1, 0) * 100 + ln(1 + volume) AS score FROM daily),
r AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY score DESC, symbol) AS n FROM s)
SELECT d, symbol, n::INT AS place, round(score, 6) AS score FROM r WHERE n <= 10""")
def tk06_score_ranking(spark: SparkSession, sf: str) -> DataFrame:
    """PR-31, PR-32 and TK-06."""
    score = F.greatest(F.col("close") / F.col("open") - 1, F.lit(0.0)) * 100 + F.ln(1 + F.col("volume"))
    return rounded(sets.top_rows(daily(spark, sf).select("d", "symbol", score.alias("score")), ["d"], [F.desc("score"), "symbol"], 10, "place"), "score")


@query(f"""WITH {DAILY} SELECT count(*) AS n_rows, count(*) FILTER (WHERE high < low) AS n_bounds, count(*) FILTER (WHERE close <= 0 AND volume > 0) AS n_price, count(*) - count(DISTINCT (symbol, d)) AS n_duplicates, count(DISTINCT symbol) AS n_symbols FROM daily""")
def ql01_panel_checks(spark: SparkSession, sf: str) -> DataFrame:
    return daily(spark, sf).agg(F.count("*").alias("n_rows"), F.count_if(F.col("high") < F.col("low")).alias("n_bounds"), F.count_if((F.col("close") <= 0) & (F.col("volume") > 0)).alias("n_price"), (F.count("*") - F.countDistinct("symbol", "d")).alias("n_duplicates"), F.countDistinct("symbol").alias("n_symbols"))


@query(f"WITH {DAILY}, i AS (SELECT DISTINCT symbol, d FROM trades WHERE flag = 'R' AND volume > 45) SELECT symbol, d, close FROM daily ANTI JOIN i USING (symbol, d)")
def ql08_exclusion_guard(spark: SparkSession, sf: str) -> DataFrame:
    bad = trades(spark, sf).where("flag = 'R' AND volume > 45").select("symbol", "d")
    return gates.exclude_days(daily(spark, sf), bad, ["symbol", "d"])[0].select("symbol", "d", "close")


@query("""WITH c AS (SELECT DISTINCT l_shipdate::DATE AS d FROM lineitem WHERE l_suppkey <> 3),
b AS (SELECT min(d) AS a, max(d) AS z FROM c),
g AS (SELECT unnest(generate_series(a, z, INTERVAL 1 DAY))::DATE AS d FROM b)
SELECT d FROM g ANTI JOIN c USING (d)""")
def ql20_calendar_gaps(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "lineitem").where("l_suppkey <> 3").select(F.to_date("l_shipdate").alias("d")).distinct()
    return c.agg(F.min("d").alias("a"), F.max("d").alias("z")).select(F.explode(F.sequence("a", "z")).alias("d")).join(c, "d", "left_anti")


@query(f"WITH {TRADES} SELECT symbol, strftime(d, '%Y') AS trade_year, sum(volume) AS volume, count(*) AS n FROM trades WHERE year(d) BETWEEN 1996 AND 1998 GROUP BY 1, 2")
def io08_partitioned_write(spark: SparkSession, sf: str) -> DataFrame:
    """IO-02, IO-03, IO-08: written by year, read back with pruned partitions."""
    out = work_folder(spark, "trades")
    t = trades(spark, sf).withColumn("trade_year", F.date_format("d", "yyyy"))
    dealt(t, "trade_year", ["symbol"]).write.partitionBy("trade_year").parquet(out)
    back = spark.read.parquet(out).withColumn("trade_year", F.col("trade_year").cast("string")).where(F.col("trade_year").between("1996", "1998"))
    return back.groupBy("symbol", "trade_year").agg(F.sum("volume").alias("volume"), F.count("*").alias("n"))


@query(f"WITH {TRADES} SELECT symbol, strftime(d, '%Y') AS trade_year, sum(CASE WHEN year(d) = 1996 THEN volume + 1 ELSE volume END) AS volume, count(*) AS n FROM trades GROUP BY 1, 2")
def io08_replaced_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """A year that was corrected is written in place of the old one; the files of all other years stay."""
    out = work_folder(spark, "trades")
    t = trades(spark, sf).withColumn("trade_year", F.date_format("d", "yyyy"))
    replace_partitions(t, out, "trade_year", ["symbol"])
    replace_partitions(t.where("trade_year = '1996'").withColumn("volume", F.col("volume") + 1), out, "trade_year", ["symbol"])
    return spark.read.schema(t.schema).parquet(out).groupBy("symbol", "trade_year").agg(F.sum("volume").alias("volume"), F.count("*").alias("n"))


@query("SELECT event_id, CASE WHEN event_id % 17 = 0 THEN 'no_value' WHEN event_id % 19 = 0 THEN 'bad_user' ELSE 'ok' END AS reason FROM events")
def io16_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumn("value", F.when(F.col("event_id") % 17 != 0, F.col("value"))).withColumn("user_id", F.when(F.col("event_id") % 19 == 0, -1).otherwise(F.col("user_id")))
    return e.select("event_id", F.when(F.col("value").isNull(), "no_value").when(F.col("user_id") < 0, "bad_user").otherwise("ok").alias("reason"))
