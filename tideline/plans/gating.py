"""Queries of the quality gates (QL-*). Faults are found in the data or planted in the input, and SQL derives them anew."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.operators import gates
from tideline.plans.tables import DAILY, TRADES, daily, rounded, table, trades
from tideline.streaming.flows import work_folder

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_PANEL = f"""{DAILY}, p AS (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY d) AS pre_close, date_diff('day', min(d) OVER (PARTITION BY symbol), d) - 2 AS listed_days FROM daily),
panel AS (SELECT symbol, d, close, pre_close, volume, listed_days, pre_close * 1.1 AS up_limit, CASE WHEN volume = 7 THEN pre_close * 1.2 ELSE pre_close * 0.9 END AS down_limit, close >= pre_close * 1.1 AND volume <> 11 AS is_limit_up, close <= pre_close * 0.9 AS is_limit_down,
 volume < 3 AS is_suspended, CASE WHEN volume = 13 THEN 'OTHER' ELSE 'MAIN' END AS board, close / pre_close - 1 + CASE WHEN volume = 17 THEN 0.05 ELSE 0 END AS pct_change FROM p)"""


def _panel(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("symbol")
    p = daily(spark, sf).withColumns({"pre_close": F.lag("close").over(w.orderBy("d")), "listed_days": F.datediff("d", F.min("d").over(w)) - 2})
    v, c, b = F.col("volume"), F.col("close"), F.col("pre_close")
    return p.select(
        "symbol", "d", "close", "pre_close", "volume", "listed_days", (b * 1.1).alias("up_limit"), F.when(v == 7, b * 1.2).otherwise(b * 0.9).alias("down_limit"), ((c >= b * 1.1) & (v != 11)).alias("is_limit_up"), (c <= b * 0.9).alias("is_limit_down"),
        (v < 3).alias("is_suspended"), F.when(v == 13, "OTHER").otherwise("MAIN").alias("board"), (c / b - 1 + F.when(v == 17, 0.05).otherwise(0.0)).alias("pct_change"),
    )


_CHECKS = """checks AS (SELECT unnest(['limit_order', 'limit_up_flag', 'limit_down_flag', 'suspended_with_volume', 'listed_days', 'board', 'change']) AS "check", unnest(['error', 'error', 'error', 'error', 'error', 'warning', 'warning']) AS severity,
 unnest([count(*) FILTER (WHERE up_limit < down_limit), count(*) FILTER (WHERE is_limit_up <> (close >= up_limit)), count(*) FILTER (WHERE is_limit_down <> (close <= down_limit)), count(*) FILTER (WHERE is_suspended AND volume > 0), count(*) FILTER (WHERE listed_days < 0),
 count(*) FILTER (WHERE board NOT IN ('MAIN', 'STAR', 'CHINEXT', 'BSE')), count(*) FILTER (WHERE abs(pct_change - (close / pre_close - 1)) > 0.01)]) AS n_bad, count(*) AS n_rows, y FROM (SELECT *, year(d) AS y FROM panel) GROUP BY y)"""


@query(f'WITH {_PANEL}, {_CHECKS} SELECT y, "check", severity, n_bad, n_rows FROM checks')
def ql02_research_checks(spark: SparkSession, sf: str) -> DataFrame:
    return gates.check_table(_panel(spark, sf).withColumn("y", F.year("d").cast("long")), gates.research_checks(), ["y"])


@query(f"""WITH {_PANEL}, {_CHECKS} SELECT y, 0::BIGINT AS n_errors, sum(n_bad)::BIGINT AS n_warnings, round(max(n_bad / n_rows), 9) AS worst_rate, CASE WHEN max(n_bad / n_rows) > 0.02 THEN 'warn' ELSE 'pass' END AS verdict FROM checks WHERE severity = 'warning' GROUP BY y""")
def ql03_warning_verdict(spark: SparkSession, sf: str) -> DataFrame:
    """The warnings' verdict of each year; errors are judged by ql03_verdict."""
    checks = QUERIES["ql02_research_checks"](spark, sf).where("severity = 'warning'")
    return rounded(gates.verdict(checks, 0.02, ["y"]), "worst_rate", digits=9)


@query(f"""WITH {_PANEL}, {_CHECKS} SELECT y, sum(CASE WHEN severity = 'error' THEN n_bad ELSE 0 END)::BIGINT AS n_errors, sum(CASE WHEN severity = 'warning' THEN n_bad ELSE 0 END)::BIGINT AS n_warnings, round(max(CASE WHEN severity = 'warning' THEN n_bad / n_rows END), 9) AS worst_rate,
 CASE WHEN sum(CASE WHEN severity = 'error' THEN n_bad ELSE 0 END) > 0 THEN 'fail' WHEN max(CASE WHEN severity = 'warning' THEN n_bad / n_rows END) > 0.02 THEN 'warn' ELSE 'pass' END AS verdict FROM checks GROUP BY y""")
def ql03_verdict(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(gates.verdict(QUERIES["ql02_research_checks"](spark, sf), 0.02, ["y"]), "worst_rate", digits=9)


@query(f"""WITH {TRADES},
a AS (SELECT year(d) AS y, count(*)::DOUBLE AS n_rows, sum(volume) AS volume FROM trades GROUP BY 1),
e AS (SELECT y, CASE WHEN y % 3 = 0 THEN n_rows + 1 ELSE n_rows END AS n_rows, volume FROM a WHERE y <> 1997),
j AS (SELECT coalesce(a.y, e.y) AS y, a.n_rows AS an, e.n_rows AS en, a.volume AS av, e.volume AS ev FROM a FULL JOIN e ON a.y = e.y)
SELECT y, 'n_rows' AS measure, en AS expected, an AS actual, coalesce(en = an, false) AS matches FROM j UNION ALL SELECT y, 'volume', ev, av, coalesce(ev = av, false) FROM j""")
def ql04_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of a manifest with one year missing and some wrong."""
    a = trades(spark, sf).groupBy(F.year("d").cast("long").alias("y")).agg(F.count("*").alias("n_rows"), F.sum("volume").alias("volume"))
    e = a.where("y <> 1997").withColumn("n_rows", F.when(F.col("y") % 3 == 0, F.col("n_rows") + 1).otherwise(F.col("n_rows")))
    return gates.reconcile(a, e, ["y"], ["n_rows", "volume"])


_ASSET = f"""{DAILY},
asset AS (SELECT symbol, d, CASE WHEN n_trades > 1 THEN close / open - 1 END AS x, CASE WHEN volume = 19 THEN 'inf'::DOUBLE WHEN n_trades > 1 THEN amount END AS z, CASE WHEN volume = 23 THEN d - 1 ELSE d + 1 END AS available FROM daily)"""


def _asset(spark: SparkSession, sf: str) -> DataFrame:
    v = F.col("volume")
    many = F.col("n_trades") > 1
    return daily(spark, sf).select("symbol", "d", F.when(many, F.col("close") / F.col("open") - 1).alias("x"), F.when(v == 19, float("inf")).when(many, F.col("amount")).alias("z"), F.when(v == 23, F.date_sub("d", 1)).otherwise(F.date_add("d", 1)).alias("available"))


@query(f"""WITH {_ASSET}, c AS (SELECT count(*) AS n_rows, count(*) FILTER (WHERE x IS NULL AND z IS NULL) AS e, count(*) FILTER (WHERE isinf(z)) AS f, count(*) FILTER (WHERE available < d) AS g FROM asset)
SELECT unnest(['null_key', 'no_feature', 'not_finite', 'available_too_early']) AS "check", unnest(['error', 'warning', 'error', 'error']) AS severity, unnest([0, e, f, g]) AS n_bad, n_rows FROM c""")
def ql05_asset_checks(spark: SparkSession, sf: str) -> DataFrame:
    """QL-05 and QL-24."""
    return gates.check_table(_asset(spark, sf), gates.asset_checks(["symbol", "d"], ["x", "z"], "available", "d"))


@query(f"""WITH {_ASSET},
u AS (SELECT * FROM asset UNION ALL SELECT * FROM asset WHERE isinf(z))
SELECT count(*) AS n_rows, count(DISTINCT symbol) AS n_symbols, count(*) - count(DISTINCT (symbol, d)) AS n_duplicates, count(x) + count(z) AS n_values, count(*) = count(DISTINCT (symbol, d)) AS passed FROM u""")
def ql24_asset_size(spark: SparkSession, sf: str) -> DataFrame:
    a = _asset(spark, sf)
    return gates.asset_size(a.union(a.where("z = double('inf')")), ["symbol", "d"], "symbol", ["x", "z"], 100, 5)


@query("""WITH u AS (SELECT o_orderdate::DATE AS d, o_custkey AS symbol, o_totalprice AS m FROM orders UNION ALL SELECT o_orderdate::DATE, o_custkey, -1 FROM orders WHERE o_orderkey % 97 = 0),
k AS (SELECT d, symbol, count(*) AS n, min(m) AS m FROM u GROUP BY 1, 2)
SELECT d, count(*) AS n_members, sum(n - 1)::BIGINT AS n_duplicates, count(*) FILTER (WHERE m <= 0) AS n_low FROM k GROUP BY d""")
def ql06_universe(spark: SparkSession, sf: str) -> DataFrame:
    """Members of each date, repeated ones, and ones whose metric is too low."""
    o = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d"), F.col("o_custkey").alias("symbol"), F.col("o_totalprice").alias("m"), "o_orderkey")
    u = o.drop("o_orderkey").union(o.where("o_orderkey % 97 = 0").select("d", "symbol", F.lit(-1.0)))
    each = u.groupBy("d", "symbol").agg(F.count("*").alias("n"), F.min("m").alias("m"))
    return each.groupBy("d").agg(F.count("*").alias("n_members"), F.sum(F.col("n") - 1).alias("n_duplicates"), F.count_if(F.col("m") <= 0).alias("n_low"))


@query(f"WITH {DAILY} SELECT symbol, d, close AS price, volume AS size, CASE WHEN n_trades > 1 THEN high - low END AS spread FROM daily")
def ql07_factor_pivot(spark: SparkSession, sf: str) -> DataFrame:
    y = daily(spark, sf)
    long = y.select("symbol", "d", F.lit("price").alias("factor"), F.col("close").alias("v")).union(y.select("symbol", "d", F.lit("size"), "volume")).union(y.where("n_trades > 1").select("symbol", "d", F.lit("spread"), F.col("high") - F.col("low")))
    return gates.factor_wide(long, ["symbol", "d"], "factor", "v", ["price", "size", "spread"])


@query(f"""WITH {DAILY},
i AS (SELECT DISTINCT symbol, d FROM trades WHERE flag = 'R' AND volume > 45 UNION SELECT -1, DATE '1990-01-01')
SELECT (SELECT count(*) FROM daily) AS n_rows, (SELECT count(*) FROM daily SEMI JOIN i ON daily.symbol = i.symbol AND daily.d = i.d) AS n_excluded, (SELECT count(*) FROM i ANTI JOIN daily ON daily.symbol = i.symbol AND daily.d = i.d) AS n_unmatched""")
def ql08_exclusion_decision(spark: SparkSession, sf: str) -> DataFrame:
    bad = trades(spark, sf).where("flag = 'R' AND volume > 45").select("symbol", "d").union(spark.range(1).select(F.lit(-1).cast("long"), F.lit("1990-01-01").cast("date")))
    return gates.exclude_days(daily(spark, sf), bad, ["symbol", "d"])[1]


@query("""WITH b AS (SELECT user_id, ts::DATE AS day, strftime(ts, '%H:') || lpad((minute(ts) // 30 * 30)::VARCHAR, 2, '0') AS m FROM events),
g AS (SELECT user_id, day, min(m) AS first_bar, max(m) AS last_bar, bool_or(m = '00:00') AS a, bool_or(m = '23:30') AS z FROM b GROUP BY 1, 2)
SELECT user_id, day, first_bar, last_bar, CASE WHEN NOT a AND NOT z THEN 'both' WHEN NOT a THEN 'no_open' WHEN NOT z THEN 'no_close' END AS issue FROM g""")
def ql09_session_edges(spark: SparkSession, sf: str) -> DataFrame:
    half = F.date_trunc("hour", "ts") + F.make_dt_interval(mins=F.floor(F.minute("ts") / 30).cast("int") * 30)
    bars = table(spark, sf, "events").select("user_id", F.to_date("ts").alias("day"), half.alias("t"))
    return gates.session_edges(bars, ["user_id", "day"], "t", "00:00", "23:30")


@query(f"""WITH {TRADES},
cal AS (SELECT DISTINCT d FROM trades WHERE dayofweek(d) BETWEEN 1 AND 5),
own AS (SELECT DISTINCT symbol, d FROM trades),
s AS (SELECT symbol, min(d) AS a, max(d) AS z, count(*) AS n_days FROM own GROUP BY 1),
m AS (SELECT symbol, count(*) AS n FROM s JOIN cal ON d BETWEEN a AND z WHERE NOT EXISTS (SELECT 1 FROM own WHERE own.symbol = s.symbol AND own.d = cal.d) GROUP BY 1),
x AS (SELECT symbol, count(*) AS n FROM own WHERE dayofweek(d) NOT BETWEEN 1 AND 5 GROUP BY 1)
SELECT s.symbol, n_days, coalesce(m.n, 0) AS n_missing, coalesce(x.n, 0) AS n_extra, m.n IS NULL AND x.n IS NULL AS exact FROM s LEFT JOIN m USING (symbol) LEFT JOIN x USING (symbol)""")
def ql10_calendar_exactness(spark: SparkSession, sf: str) -> DataFrame:
    t = trades(spark, sf)
    return gates.calendar_exactness(t.select("d").where(F.dayofweek("d").between(2, 6)), t, "symbol", "d")


@query("""SELECT year(o_orderdate) AS y, count(*) AS n_rows, count(*) FILTER (WHERE o_custkey % 50 = 0) AS n_null_key, count(*) FILTER (WHERE o_orderstatus NOT IN ('O', 'F')) AS n_domain, count(*) FILTER (WHERE o_orderdate::DATE > DATE '2001-06-30') AS n_late, count(*) FILTER (WHERE o_totalprice < 0) AS n_negative FROM orders GROUP BY 1""")
def ql11_partition_quality(spark: SparkSession, sf: str) -> DataFrame:
    """QL-11 and AG-30: keys, domain, dates and payload of each partition."""
    from tideline.operators.quality import counters

    o = table(spark, sf, "orders").select(F.year("o_orderdate").cast("long").alias("y"), F.when(F.col("o_custkey") % 50 != 0, F.col("o_custkey")).alias("k"), "o_orderstatus", F.to_date("o_orderdate").alias("d"), "o_totalprice")
    checks = {"n_null_key": F.col("k").isNull(), "n_domain": ~F.col("o_orderstatus").isin("O", "F"), "n_late": F.col("d") > F.lit("2001-06-30").cast("date"), "n_negative": F.col("o_totalprice") < 0}
    return counters(o, checks, ["y"])


@query(f"""WITH {TRADES},
days AS (SELECT DISTINCT date_trunc('month', d)::DATE AS d FROM trades),
own AS (SELECT DISTINCT symbol, date_trunc('month', d)::DATE AS d FROM trades WHERE volume > 40),
miss AS (SELECT s_suppkey AS symbol, d FROM supplier, days EXCEPT SELECT symbol, d FROM own),
s AS (SELECT symbol, date_trunc('month', d)::DATE AS d FROM trades GROUP BY 1, 2 HAVING bool_or(flag = 'R') AND NOT bool_or(flag = 'A')),
p AS (SELECT s_suppkey AS symbol, DATE '1995-01-01' + s_nationkey::INT AS a, CASE WHEN s_nationkey % 2 = 0 THEN DATE '1996-12-31' END AS z FROM supplier WHERE s_nationkey % 3 = 0)
SELECT miss.symbol, miss.d, CASE WHEN EXISTS (SELECT 1 FROM p WHERE p.symbol = miss.symbol AND miss.d >= a AND (z IS NULL OR miss.d <= z)) THEN 'paused' WHEN EXISTS (SELECT 1 FROM s WHERE s.symbol = miss.symbol AND s.d = miss.d) THEN 'suspended' ELSE 'unexplained' END AS reason FROM miss""")
def ql12_absence_reasons(spark: SparkSession, sf: str) -> DataFrame:
    """Symbols and months without a large trade: paused, suspended without resume, or unexplained."""
    t = trades(spark, sf).withColumn("d", F.to_date(F.date_trunc("month", "d")))
    s = table(spark, sf, "supplier")
    months = t.agg(F.array_sort(F.collect_set("d")).alias("days"))  # one array of months
    due = s.select(F.col("s_suppkey").alias("symbol")).join(F.broadcast(months)).select("symbol", F.explode("days").alias("d"))
    missing = due.join(t.where("volume > 40").select("symbol", "d").distinct(), ["symbol", "d"], "left_anti")
    suspends = t.where("flag <> 'N'").select("symbol", "d", F.when(F.col("flag") == "R", "S").otherwise("R").alias("kind"))
    n = F.col("s_nationkey")
    pauses = s.where(n % 3 == 0).select(F.col("s_suppkey").alias("symbol"), F.date_add(F.lit("1995-01-01").cast("date"), n.cast("int")).alias("start"), F.when(n % 2 == 0, F.lit("1996-12-31").cast("date")).alias("end"))
    return gates.explain_absence(missing, suspends, pauses, "symbol", "d")


@query(f"""WITH {TRADES},
r AS (SELECT DISTINCT o_orderdate::DATE AS d FROM orders WHERE o_totalprice > 400000),
h AS (SELECT DISTINCT d FROM trades SEMI JOIN r USING (d))
SELECT count(*) AS n_hits, min(d) AS first_hit, count(*) = 0 AS accepted FROM h""")
def ql13_registry_gate(spark: SparkSession, sf: str) -> DataFrame:
    registry = table(spark, sf, "orders").where("o_totalprice > 400000").select(F.to_date("o_orderdate").alias("d"))
    return gates.registry_gate(trades(spark, sf), registry, "d")


@query(f"WITH {DAILY} SELECT symbol, d, close, volume FROM daily WHERE d BETWEEN DATE '1996-02-01' AND DATE '1999-03-31' AND symbol % 2 = 0")
def ql14_range_read(spark: SparkSession, sf: str) -> DataFrame:
    """The range and the market are the read's own."""
    day = lambda x: F.lit(x).cast("date")
    return gates.range_read(daily(spark, sf), ["symbol", "d", "close", "volume"], ["symbol", "d"], "d", day("1996-02-01"), day("1999-03-31"), F.col("symbol") % 2 == 0)


@query("SELECT event_id, user_id, value FROM events WHERE ts <= (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events)")
def ql15_cutoff_read(spark: SparkSession, sf: str) -> DataFrame:
    """What was observed up to the middle of the stream's span."""
    e = table(spark, sf, "events").select("event_id", "user_id", "value", "ts")
    half = e.agg(F.timestamp_micros(F.min(F.unix_micros(F.col("ts").cast("timestamp"))) + F.floor((F.max(F.unix_micros(F.col("ts").cast("timestamp"))) - F.min(F.unix_micros(F.col("ts").cast("timestamp")))) / 2)).cast("timestamp_ntz").alias("at")).first()["at"]
    return gates.cutoff_read(e, "ts", F.lit(half).cast("timestamp_ntz")).drop("ts")


@query(f"""WITH {TRADES},
b AS (SELECT date_trunc('month', d)::DATE AS d, symbol, count(*) AS n, count(*) FILTER (WHERE volume > 49) AS big, count(*) FILTER (WHERE price > 5000) AS dear FROM trades GROUP BY 1, 2),
x AS (SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS d, s_suppkey AS symbol FROM orders, supplier WHERE s_nationkey < 20 AND o_custkey % 10 = s_suppkey % 10),
j AS (SELECT coalesce(b.d, x.d) AS d, n, big, dear, x.symbol AS due FROM b FULL JOIN x ON b.d = x.d AND b.symbol = x.symbol),
g AS (SELECT d, coalesce(sum(n), 0)::BIGINT AS n_rows, count(n) AS n_symbols, count(*) FILTER (WHERE n <> 8) AS n_odd_shape, count(*) FILTER (WHERE n IS NULL) AS n_missing, count(*) FILTER (WHERE due IS NULL) AS n_unexpected, coalesce(sum(big), 0)::BIGINT AS big, coalesce(sum(dear), 0)::BIGINT AS dear FROM j GROUP BY d)
SELECT *, ((big > 0 AND month(d) % 2 <> 0)::INT + (dear > 0)::INT) AS n_open_issues, n_odd_shape = 0 AND n_missing = 0 AND n_unexpected = 0 AND NOT (big > 0 AND month(d) % 2 <> 0) AND dear = 0 AS accepted FROM g""")
def ql16_day_acceptance(spark: SparkSession, sf: str) -> DataFrame:
    """Months as partitions: shape, expected symbols both ways, issues and those accepted for even months."""
    t = trades(spark, sf).withColumn("d", F.to_date(F.date_trunc("month", "d")))
    month = F.to_date(F.date_trunc("month", "o_orderdate"))
    o = table(spark, sf, "orders").select(month.alias("d"), (F.col("o_custkey") % 10).alias("m")).distinct()
    s = table(spark, sf, "supplier").where("s_nationkey < 20").select(F.col("s_suppkey").alias("symbol"), (F.col("s_suppkey") % 10).alias("m"))
    accepted = t.select("d").distinct().where(F.month("d") % 2 == 0).withColumn("issue", F.lit("big"))
    return gates.day_acceptance(t, o.join(s, "m"), "d", "symbol", 8, {"big": F.col("volume") > 49, "dear": F.col("price") > 5000}, accepted)


@query(f"""WITH {TRADES},
l AS (SELECT s_suppkey AS symbol, DATE '1995-01-01' + s_nationkey::INT * 20 AS a, CASE WHEN s_nationkey % 2 = 0 THEN DATE '2000-06-30' ELSE DATE '9999-12-31' END AS z FROM supplier WHERE s_nationkey <> 7)
SELECT DISTINCT d, t.symbol, CASE WHEN a IS NULL THEN 'unexplained' WHEN d < a THEN 'before_listing' WHEN d > z THEN 'unexplained' ELSE 'expected' END AS state FROM trades t LEFT JOIN l ON l.symbol = t.symbol""")
def ql17_expected_universe(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("s_nationkey").cast("int")
    listed = table(spark, sf, "supplier").where("s_nationkey <> 7").select(F.col("s_suppkey").alias("symbol"), F.date_add(F.lit("1995-01-01").cast("date"), n * 20).alias("start"), F.when(n % 2 == 0, F.lit("2000-06-30").cast("date")).alias("end"))
    return gates.expected_universe(trades(spark, sf), listed, "d", "symbol")


@query("""WITH b AS (SELECT o_orderkey, CASE WHEN o_custkey % 40 = 0 THEN ' ' ELSE o_custkey::VARCHAR END AS code, o_orderdate::DATE AS d FROM orders UNION ALL SELECT o_orderkey, CASE WHEN o_custkey % 40 = 0 THEN ' ' ELSE o_custkey::VARCHAR END, o_orderdate::DATE FROM orders WHERE o_orderkey % 50 = 1)
SELECT count(*) AS n_rows, count(*) FILTER (WHERE trim(code) = '') AS n_no_id, count(*) FILTER (WHERE d NOT BETWEEN DATE '1993-01-01' AND DATE '2000-12-31') AS n_outside, count(*) - count(DISTINCT (o_orderkey, code, d)) AS n_duplicates, false AS passed FROM b""")
def ql18_event_batch(spark: SparkSession, sf: str) -> DataFrame:
    day = lambda x: F.lit(x).cast("date")
    b = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 40 == 0, " ").otherwise(F.col("o_custkey").cast("string")).alias("code"), F.to_date("o_orderdate").alias("d"))
    return gates.event_batch(b.union(b.where("o_orderkey % 50 = 1")), ["o_orderkey", "code"], "d", day("1993-01-01"), day("2000-12-31"))


@query(f"WITH {TRADES} SELECT min(year(d))::INT AS first_part, max(year(d))::INT AS last_part, count(DISTINCT year(d)) AS n_parts, count(DISTINCT (year(d), symbol % 4)) AS n_files, count(*) AS n_rows FROM trades")
def ql19_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """A layer of four files a year, as its files say."""
    out = work_folder(spark, "layer")
    t = trades(spark, sf).withColumns({"part": F.year("d"), "shard": F.col("symbol") % 4})
    t.repartition("part", "shard").write.partitionBy("part", "shard").parquet(out)
    return gates.inventory(spark.read.schema(t.schema).parquet(out), "part")


_CAL = """cal AS (SELECT o_orderdate::DATE AS d, CASE WHEN dayofmonth(o_orderdate) = 13 AND o_orderkey % 9 = 0 THEN 2 WHEN dayofmonth(o_orderdate) = 11 AND o_orderkey % 5 = 0 THEN 0 WHEN dayofweek(o_orderdate) IN (0, 6) THEN 0 ELSE 1 END AS flag FROM orders WHERE NOT (dayofmonth(o_orderdate) = 21 AND month(o_orderdate) = 3))"""


def _calendar(spark: SparkSession, sf: str) -> DataFrame:
    d, k = F.col("o_orderdate"), F.col("o_orderkey")
    flag = F.when((F.dayofmonth(d) == 13) & (k % 9 == 0), 2).when((F.dayofmonth(d) == 11) & (k % 5 == 0), 0).when(F.dayofweek(d).isin(1, 7), 0).otherwise(1)
    return table(spark, sf, "orders").where(~((F.dayofmonth(d) == 21) & (F.month(d) == 3))).select(F.to_date(d).alias("d"), flag.alias("flag"))


@query(f"""WITH {_CAL},
e AS (SELECT d, count(DISTINCT flag) AS k, bool_or(flag NOT IN (0, 1)) AS odd, max(flag) AS o FROM cal GROUP BY d)
SELECT (date_diff('day', min(d), max(d)) + 1 - count(*))::BIGINT AS n_missing, count(*) FILTER (WHERE k > 1) AS n_contradictory, count(*) FILTER (WHERE odd) AS n_unknown, count(*) FILTER (WHERE o = 1) AS n_open, false AS passed FROM e""")
def ql20_calendar_verdict(spark: SparkSession, sf: str) -> DataFrame:
    """A calendar with days missing every March, contradictions and unknown flags."""
    return gates.calendar_verdict(_calendar(spark, sf), "d", "flag")


@query(f"WITH {_CAL}, g AS (SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY))::DATE AS d FROM cal) SELECT d FROM g ANTI JOIN cal USING (d)")
def ql20_missing_days(spark: SparkSession, sf: str) -> DataFrame:
    c = _calendar(spark, sf).select("d").distinct()
    return c.agg(F.min("d").alias("a"), F.max("d").alias("z")).select(F.explode(F.sequence("a", "z")).alias("d")).join(c, "d", "left_anti")


@query("""WITH p AS (SELECT DISTINCT l_shipdate::DATE AS d FROM lineitem WHERE l_quantity > 49 AND l_linenumber = 1),
c AS (SELECT DISTINCT o_orderdate::DATE AS d FROM orders),
b AS (SELECT min(d) AS a, max(d) AS z FROM p)
SELECT d FROM c, b WHERE d BETWEEN a AND z AND d NOT IN (SELECT d FROM p)""")
def ql21_panel_gaps(spark: SparkSession, sf: str) -> DataFrame:
    panel = table(spark, sf, "lineitem").where("l_quantity > 49 AND l_linenumber = 1").select(F.to_date("l_shipdate").alias("d"))
    return gates.panel_gaps(panel, table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d")), "d")


@query("""WITH b AS (SELECT user_id AS symbol, ts::DATE AS d, hour(ts) AS h FROM events), e AS (SELECT DISTINCT symbol, d FROM b UNION SELECT symbol, DATE '2023-12-31' FROM b)
SELECT e.d, e.symbol, count(DISTINCT h) FILTER (WHERE h BETWEEN 9 AND 15) AS n_on_grid, count(h) FILTER (WHERE h NOT BETWEEN 9 AND 15) AS n_off_grid, count(DISTINCT h) FILTER (WHERE h BETWEEN 9 AND 15) = 7 AND count(h) FILTER (WHERE h NOT BETWEEN 9 AND 15) = 0 AS complete FROM e LEFT JOIN b ON b.symbol = e.symbol AND b.d = e.d GROUP BY 1, 2""")
def ql22_session_grid(spark: SparkSession, sf: str) -> DataFrame:
    b = table(spark, sf, "events").select(F.col("user_id").alias("symbol"), F.to_date("ts").alias("d"), F.hour("ts").alias("h"))
    expected = b.select("d", "symbol").union(b.select(F.lit("2023-12-31").cast("date"), "symbol"))
    return gates.session_grid(b, expected, "d", "symbol", F.col("h"), list(range(9, 16)))


@query("""WITH p AS (SELECT l_suppkey AS symbol, l_shipdate::DATE AS d, l_quantity > 40 AS st, CASE WHEN l_quantity > 40 THEN l_shipdate::DATE + (l_quantity = 50)::INT END AS av FROM lineitem),
h AS (SELECT l_suppkey AS symbol, l_shipdate::DATE AS d, max(l_shipdate::DATE) AS av FROM lineitem WHERE l_quantity > 41 GROUP BY 1, 2),
k AS (SELECT symbol, d, count(*) AS n, bool_or(st) AS st, max(av) AS av FROM p GROUP BY 1, 2)
SELECT count(*) FILTER (WHERE st <> (h.av IS NOT NULL)) AS n_flag, count(*) FILTER (WHERE k.av IS DISTINCT FROM h.av) AS n_available, 0::BIGINT AS n_code, sum(n - 1)::BIGINT AS n_duplicates FROM k LEFT JOIN h USING (symbol, d)""")
def ql23_status_consistency(spark: SparkSession, sf: str) -> DataFrame:
    d, q = F.to_date("l_shipdate"), F.col("l_quantity")
    lines = table(spark, sf, "lineitem")
    p = lines.select(F.col("l_suppkey").alias("symbol"), d.alias("d"), (q > 40).alias("st"), F.when(q > 40, F.date_add(d, (q == 50).cast("int"))).alias("av"))
    h = lines.where(q > 41).select(F.col("l_suppkey").alias("symbol"), d.alias("d"), d.alias("av"))
    return gates.status_consistency(p, h, "symbol", "d", "st", "av")
