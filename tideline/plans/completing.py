"""Fuller forms of row checks, counters, payloads and staleness reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.functions import scalar
from tideline.operators import bars, gates, normalize, pit, quality, windows
from tideline.plans.tables import DAILY, TRADES, daily, rounded, table, trades
from tideline.sources import payloads

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_BROKEN = f"""{DAILY},
b AS (SELECT symbol, d, CASE WHEN volume <> 21 THEN open END AS open, CASE WHEN volume = 21 THEN NULL WHEN dayofmonth(d) = 5 THEN low ELSE high END AS high, CASE WHEN volume = 21 OR dayofmonth(d) = 6 THEN NULL ELSE low END AS low, CASE WHEN volume <> 21 THEN close END AS close, CASE WHEN volume <> 21 THEN volume END AS volume, CASE WHEN volume <> 21 THEN amount END AS amount FROM daily)"""


def _broken(spark: SparkSession, sf: str) -> DataFrame:
    whole, day = F.col("volume") != 21, F.dayofmonth("d")
    pick = lambda c: F.when(whole, F.col(c)).alias(c)
    return daily(spark, sf).select("symbol", "d", pick("open"), F.when(whole, F.when(day == 5, F.col("low")).otherwise(F.col("high"))).alias("high"), F.when(whole & (day != 6), F.col("low")).alias("low"), pick("close"), F.when(whole, F.col("volume")).alias("v"), F.when(whole, F.col("amount")).alias("amount")).withColumnRenamed("v", "volume")


@query(f"""WITH {_BROKEN} SELECT symbol, d, greatest(open, high, low, close) AS high, least(open, high, low, close) AS low, greatest(open, high, low, close) IS DISTINCT FROM high OR least(open, high, low, close) IS DISTINCT FROM low AS repaired FROM b WHERE open IS NOT NULL""")
def pr13_repaired_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Placeholders dropped, bounds widened."""
    return normalize.repair_bars(_broken(spark, sf)).select("symbol", "d", "high", "low", "repaired")


@query(f"""WITH {_BROKEN} SELECT (SELECT count(*) FROM b) - count(*) AS n_placeholders, count(*) FILTER (WHERE greatest(open, high, low, close) IS DISTINCT FROM high OR least(open, high, low, close) IS DISTINCT FROM low) AS n_repaired FROM b WHERE open IS NOT NULL""")
def pr13_repair_counts(spark: SparkSession, sf: str) -> DataFrame:
    b = _broken(spark, sf).withColumn("row", F.lit(1))
    kept = normalize.repair_bars(b)
    every = b.select(F.lit(1).alias("n"), F.lit(0).alias("k"), F.lit(0).alias("r")).union(kept.select(F.lit(0), F.lit(1), F.col("repaired").cast("int")))
    return every.agg((F.sum("n") - F.sum("k")).alias("n_placeholders"), F.sum("r").alias("n_repaired"))


@query(f"""WITH {DAILY},
p AS (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY d) AS b FROM daily)
SELECT symbol, d, coalesce(close >= b * 1.1, false) AS is_limit_up, coalesce(close <= b * 0.9, false) AS is_limit_down FROM p""")
def pr15_limit_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Both limits, a tenth around the close before."""
    p = daily(spark, sf).withColumn("b", F.lag("close").over(Window.partitionBy("symbol").orderBy("d")))
    up, down = normalize.limit_flags(F.col("close"), F.col("b") * 1.1, F.col("b") * 0.9)
    return p.select("symbol", "d", up.alias("is_limit_up"), down.alias("is_limit_down"))


@query(f"""WITH {DAILY},
s AS (SELECT DISTINCT l_suppkey AS symbol, l_shipdate::DATE AS d FROM lineitem WHERE l_discount >= 0.1),
x AS (SELECT symbol, d, CASE WHEN volume > 3 THEN volume ELSE 0 END AS volume, CASE WHEN n_trades < 4 THEN amount END AS amount FROM daily)
SELECT x.symbol, x.d, s.d IS NOT NULL OR volume <= 0 OR amount IS NULL AS is_suspended FROM x LEFT JOIN s ON s.symbol = x.symbol AND s.d = x.d""")
def pr16_suspensions(spark: SparkSession, sf: str) -> DataFrame:
    """By a list, and by days without volume or amount."""
    x = daily(spark, sf).select("symbol", "d", F.when(F.col("volume") > 3, F.col("volume")).otherwise(0.0).alias("volume"), F.when(F.col("n_trades") < 4, F.col("amount")).alias("amount"))
    listed = table(spark, sf, "lineitem").where("l_discount >= 0.1").select(F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("d"))
    return normalize.suspended(x, listed, ["symbol", "d"]).select("symbol", "d", "is_suspended")


@query("""WITH t AS (SELECT event_id, CASE event_type WHEN 'click' THEN 'deal' WHEN 'view' THEN 'snapshot' ELSE 'order' END AS kind, CASE WHEN value < 3 THEN 0.0 WHEN value > 20 THEN NULL WHEN value > 15 THEN -value ELSE value END AS p,
  CASE WHEN user_id % 10 <> 3 THEN user_id END AS code, CASE WHEN user_id % 10 <> 4 THEN ts END AS t, CASE WHEN event_id % 9 <> 0 THEN event_id END AS id FROM events),
r AS (SELECT *, CASE WHEN code IS NULL OR t IS NULL OR p IS NULL THEN 'missing_required_value' WHEN kind <> 'snapshot' AND id IS NULL THEN 'missing_event_id' WHEN p <= 0 AND kind = 'snapshot' THEN 'empty_snapshot_price' WHEN p <= 0 THEN 'special_price_or_event' ELSE '' END AS reason FROM t)
SELECT event_id, reason, CASE WHEN reason IN ('missing_required_value', 'missing_event_id') THEN 'exclude' WHEN reason = '' THEN 'keep' ELSE 'tag' END AS decision FROM r""")
def pr24_full_triage(spark: SparkSession, sf: str) -> DataFrame:
    """All rules of orders, deals and snapshots, on values that follow from the data."""
    x, u = F.col("value"), F.col("user_id")
    kind = F.when(F.col("event_type") == "click", "deal").when(F.col("event_type") == "view", "snapshot").otherwise("order")
    p = F.when(x < 3, 0.0).when(x > 20, None).when(x > 15, -x).otherwise(x)
    t = table(spark, sf, "events").select("event_id", kind.alias("kind"), p.alias("p"), F.when(u % 10 != 3, u).alias("code"), F.when(u % 10 != 4, F.col("ts")).alias("t"), F.when(F.col("event_id") % 9 != 0, F.col("event_id")).alias("id"))
    each = [normalize.tick_triage(t.where(F.col("kind") == k), k, code="code", time="t", price="p", event_id=None if k == "snapshot" else "id") for k in ("order", "deal", "snapshot")]
    return each[0].unionByName(each[1]).unionByName(each[2]).select("event_id", "reason", "decision")


_HOLDER = """w AS (SELECT event_id, CASE event_type WHEN 'purchase' THEN ' Buy in' WHEN 'error' THEN 'SELL off, buy back' WHEN 'view' THEN CASE WHEN user_id % 2 = 0 THEN '减持' ELSE '增持' END END AS w,
  CASE WHEN user_id % 11 <> 0 THEN value - 8 END AS x, value / 2 AS price, CASE WHEN user_id % 3 = 0 THEN 3 - value END AS amount FROM events),
s AS (SELECT *, CASE WHEN regexp_matches(lower(coalesce(w, '')), '减|卖|sell|decrease') THEN -1 WHEN regexp_matches(lower(coalesce(w, '')), '增|买|buy|increase') THEN 1 WHEN x < 0 THEN -1 ELSE 1 END AS side FROM w)"""


def _holder_trades(spark: SparkSession, sf: str) -> DataFrame:
    k, u = F.col("event_type"), F.col("user_id")
    text = F.when(k == "purchase", " Buy in").when(k == "error", "SELL off, buy back").when(k == "view", F.when(u % 2 == 0, "减持").otherwise("增持"))
    return table(spark, sf, "events").select("event_id", text.alias("w"), F.when(u % 11 != 0, F.col("value") - 8).alias("x"), (F.col("value") / 2).alias("price"), F.when(u % 3 == 0, 3 - F.col("value")).alias("amount"))


@query(f"WITH {_HOLDER} SELECT event_id, side FROM s")
def pr21_direction_by_sign(spark: SparkSession, sf: str) -> DataFrame:
    """Words of selling before those of buying, in both languages, and the sign where there is none."""
    return _holder_trades(spark, sf).select("event_id", scalar.direction(F.col("w"), F.col("x")).alias("side"))


@query(f"WITH {_HOLDER} SELECT event_id, side AS direction, abs(x) * side AS signed_vol, coalesce(abs(amount), abs(x) * price / 10000) * side AS signed_amount FROM s")
def pr21_signed_trades(spark: SparkSession, sf: str) -> DataFrame:
    """Signed volume and amount; an unknown amount is estimated."""
    return _holder_trades(spark, sf).select("event_id", *[c.alias(n) for n, c in scalar.signed_trade(F.col("w"), F.col("x"), F.col("price"), F.col("amount")).items()])


@query("""WITH b AS (SELECT user_id AS symbol, ts, ts::DATE AS day, value AS open, CASE WHEN event_type = 'error' THEN value - 1 ELSE value + 1 END AS high, CASE WHEN event_type = 'view' AND value < 3 THEN NULL ELSE value - 2 END AS low, value AS close, CASE WHEN event_type = 'click' AND value > 20 THEN 'inf'::DOUBLE WHEN event_type = 'purchase' AND value < 2 THEN -1 ELSE 5 END AS volume, hour(ts) * 60 + minute(ts) AS m FROM events),
k AS (SELECT day, symbol, ts, count(*) AS n FROM b GROUP BY 1, 2, 3)
SELECT b.day, count(*) AS n_rows, count(DISTINCT symbol) AS n_symbols, count(*) - count(DISTINCT (symbol, ts)) AS n_duplicates, count(*) FILTER (WHERE low IS NULL) AS n_null, count(*) FILTER (WHERE isinf(volume)) AS n_not_finite, count(*) FILTER (WHERE high < greatest(open, high, low, close) OR low > least(open, high, low, close)) AS n_bounds,
 count(*) FILTER (WHERE coalesce(open < 0 OR high < 0 OR close < 0 OR volume < 0, false) OR coalesce(low < 0, false)) AS n_negative, 0::BIGINT AS n_bad_code, 0::BIGINT AS n_wrong_date, count(*) FILTER (WHERE NOT (m BETWEEN 570 AND 690 OR m BETWEEN 780 AND 900)) AS n_off_session, min(ts) AS first_time, max(ts) AS last_time FROM b GROUP BY b.day""")
def ag14_day_counters(spark: SparkSession, sf: str) -> DataFrame:
    """AG-13 and AG-14: every counter of a day, in one pass."""
    k, x = F.col("event_type"), F.col("value")
    b = table(spark, sf, "events").select(
        F.col("user_id").alias("symbol"), "ts", F.to_date("ts").alias("day"), x.alias("open"), F.when(k == "error", x - 1).otherwise(x + 1).alias("high"), F.when(~((k == "view") & (x < 3)), x - 2).alias("low"), x.alias("close"),
        F.when((k == "click") & (x > 20), float("inf")).when((k == "purchase") & (x < 2), -1.0).otherwise(5.0).alias("volume"),
    )
    return quality.day_counters(b, ["day"], ["symbol", "ts"], "symbol", "ts", F.col("day"), F.hour("ts") * 60 + F.minute("ts"), ((570, 690), (780, 900)))


@query(f"""WITH {DAILY},
p AS (SELECT *, lag(d) OVER (PARTITION BY symbol ORDER BY d) AS b FROM daily)
SELECT unnest(['code_format', 'date_format', 'order', 'numeric', 'negative', 'price', 'bounds', 'duplicate']) AS "check", unnest(['error', 'error', 'error', 'error', 'error', 'error', 'error', 'error']) AS severity, unnest([count(*) FILTER (WHERE symbol % 9 = 0), 0, 0, count(*) FILTER (WHERE volume = 22), count(*) FILTER (WHERE volume = 23), count(*) FILTER (WHERE volume = 24), count(*) FILTER (WHERE volume = 26), 0]) AS n_bad, count(*) AS n_rows FROM p""")
def ql01_all_panel_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Each check of the daily panel, with faults planted by volume and by code."""
    v = F.col("volume")
    y = daily(spark, sf).select(
        F.when(F.col("symbol") % 9 == 0, F.concat(F.lit("x"), F.col("symbol").cast("string"))).otherwise(F.lpad(F.col("symbol").cast("string"), 6, "0")).alias("code"), F.date_format("d", "yyyyMMdd").alias("day"), "d",
        F.when(v == 22, "n/a").otherwise(F.col("open").cast("string")).cast("string").alias("open_text"), F.when(v == 26, F.col("low") - 1).otherwise(F.col("high")).alias("high"), "low", F.when(v == 24, 0.0).otherwise(F.col("close")).alias("close"), F.when(v == 23, -v).otherwise(v).alias("volume"), v.alias("raw"),
    )
    w = Window.partitionBy("code").orderBy("d")
    y = y.withColumns({"before": F.lag("d").over(w), "copies": F.count("*").over(Window.partitionBy("code", "d"))})
    checks = {
        "code_format": ("error", ~F.col("code").rlike("^[0-9]{6}$")), "date_format": ("error", ~F.col("day").rlike("^[0-9]{8}$")), "order": ("error", F.col("before") >= F.col("d")), "numeric": ("error", F.col("open_text").try_cast("double").isNull()),
        "negative": ("error", F.col("volume") < 0), "price": ("error", (F.col("close") <= 0) & (F.col("volume") > 0)), "bounds": ("error", F.col("high") < F.col("low")), "duplicate": ("error", F.col("copies") > 1),
    }
    return gates.check_table(y, checks)


_OBS = "obs AS (SELECT o_custkey % 60 AS series, date_trunc('month', o_orderdate)::DATE AS period, (o_orderdate + INTERVAL 20 DAY)::DATE AS available, (o_orderdate + INTERVAL 25 DAY)::DATE AS retrieved, o_orderkey AS id, o_orderstatus = 'P' AS reconstructed, o_orderstatus = 'F' AS covered FROM orders WHERE o_custkey % 60 < 50 AND NOT (o_custkey % 60 < 9 AND o_orderdate >= DATE '1998-06-01'))"


@query(f"""WITH {_OBS},
v AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series, period ORDER BY available DESC, retrieved DESC, id DESC) AS n FROM obs WHERE available <= DATE '1999-06-30' AND retrieved <= DATE '1999-06-30') WHERE n = 1),
g AS (SELECT series, max(period) AS p, count(*) AS n, count(*) FILTER (WHERE reconstructed) AS r, count(*) FILTER (WHERE covered) AS c FROM v GROUP BY 1),
e AS (SELECT DISTINCT c_custkey % 60 AS series FROM customer)
SELECT e.series, p AS last_period, coalesce(n, 0) AS n_periods, coalesce(r, 0) AS n_reconstructed, coalesce(c, 0) AS n_covered, date_diff('day', p, DATE '1999-06-30')::INT AS age, CASE WHEN p IS NULL THEN 'missing' WHEN date_diff('day', p, DATE '1999-06-30') > 120 THEN 'stale' ELSE 'fresh' END AS state FROM e LEFT JOIN g USING (series)""")
def pt03_context_audit(spark: SparkSession, sf: str) -> DataFrame:
    """What a read as of a day gives for each expected series."""
    d, c = F.col("o_orderdate"), F.col("o_custkey") % 60
    obs = table(spark, sf, "orders").where((c < 50) & ~((c < 9) & (d >= F.lit("1998-06-01").cast("timestamp_ntz")))).select(
        c.alias("series"), F.to_date(F.date_trunc("month", d)).alias("period"), F.date_add(d, 20).alias("available"), F.date_add(d, 25).alias("retrieved"), F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "P").alias("reconstructed"), (F.col("o_orderstatus") == "F").alias("revision_covered")
    )
    expected = table(spark, sf, "customer").select((F.col("c_custkey") % 60).alias("series"))
    return pit.context_audit(obs, expected, F.lit("1999-06-30").cast("date"), series="series", period="period", known=["available", "retrieved"], order=["available", "retrieved", "id"], max_age=120)


@query("""WITH a AS (SELECT o_custkey AS asset, CASE WHEN o_custkey % 11 <> 0 THEN max(o_orderdate)::DATE END AS as_of, CASE WHEN o_custkey % 13 <> 0 THEN DATE '2001-06-30' END AS target, CASE WHEN o_custkey % 2 = 0 THEN 90 ELSE 400 END AS allowed FROM orders GROUP BY 1)
SELECT asset, as_of, target, date_diff('day', as_of, target)::INT AS lag_days, coalesce(date_diff('day', as_of, target) > allowed, false) AS stale FROM a""")
def pt32_asset_lags(spark: SparkSession, sf: str) -> DataFrame:
    """Assets with an allowance and a target of their own; a missing date flags nothing."""
    k = F.col("asset")
    a = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("asset")).agg(F.to_date(F.max("o_orderdate")).alias("t"))
    a = a.select("asset", F.when(k % 11 != 0, F.col("t")).alias("as_of"), F.when(k % 13 != 0, F.lit("2001-06-30").cast("date")).alias("target"), F.when(k % 2 == 0, 90).otherwise(400).alias("allowed"))
    return pit.asset_lags(a, "asset", "as_of", "target", "allowed")


@query("SELECT user_id, event_type AS code, strftime(ts, '%Y-%m-%d %H:%M:%S') AS t, CASE WHEN event_id % 12 <> 0 THEN (value * 10000)::BIGINT::DOUBLE END AS value FROM events WHERE user_id % 7 <> 0")
def io17_nested_payload(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON document a user and kind, with series and points; some documents are broken, some values are no numbers."""
    v = F.when(F.col("event_id") % 12 == 0, "-").otherwise(F.format_number(F.rint(F.col("value") * 10000), 0))
    points = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.collect_list(F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("t"), v.alias("v"))).alias("points"))
    body = F.to_json(F.struct(F.array(F.struct(F.col("event_type").alias("code"), "points")).alias("series")))
    docs = points.select("user_id", F.when(F.col("user_id") % 7 == 0, F.concat(F.lit("<"), body)).otherwise(body).alias("body"))
    return payloads.series_observations(docs, "user_id", "body")


@query("""WITH l AS (SELECT user_id, event_id, value, CASE WHEN event_id % 15 = 0 THEN 1 WHEN event_id % 10 = 0 THEN 2 ELSE 0 END AS f FROM events)
SELECT user_id, count(*) AS n_lines, count(*) FILTER (WHERE f > 0) AS n_malformed, round(sum(CASE WHEN f = 0 THEN value END), 4) AS total FROM l GROUP BY 1""")
def io18_kline_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Arrays of comma-joined lines; malformed ones are counted and left out of the sums."""
    i, x = F.col("event_id"), F.col("value").cast("string")
    line = F.when(i % 15 == 0, F.concat_ws(",", F.lit("t"), x)).when(i % 10 == 0, F.concat_ws(",", F.lit("t"), F.lit("x"), x)).otherwise(F.concat_ws(",", F.lit("t"), x, F.lit("1")))
    lines = table(spark, sf, "events").groupBy("user_id").agg(F.collect_list(line).alias("lines"))
    rows = payloads.kline_rows(lines, "user_id", "lines", ["value", "volume"])
    out = rows.groupBy("user_id").agg(F.count("*").alias("n_lines"), F.count_if("malformed").alias("n_malformed"), F.sum(F.when(~F.col("malformed"), F.col("value"))).alias("total"))
    return rounded(out, "total", digits=4)


@query("""WITH g AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) > 3600000000 THEN 1 ELSE 0 END AS new FROM events)
SELECT user_id, event_id, (sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))::BIGINT AS session FROM g""")
def wn25_user_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions of each user, whose number grows with the data."""
    e = table(spark, sf, "events").select("user_id", "event_id", "ts")
    return windows.sessions(e, ["user_id"], "ts", 3600).select("user_id", "event_id", "session")


@query(f"WITH {TRADES}, n AS (SELECT symbol, k, row_number() OVER (PARTITION BY symbol ORDER BY d, k) AS i FROM trades) SELECT symbol, (i - 1) // 50 AS bar, count(*) AS n_trades FROM n GROUP BY 1, 2")
def ag03_symbol_tick_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Bars of fifty trades of each symbol."""
    t = trades(spark, sf).withColumn("bar", F.floor((F.row_number().over(Window.partitionBy("symbol").orderBy("d", "k")) - 1) / 50))
    return bars.ohlcv(t, ["symbol", "bar"], ["d", "k"]).select("symbol", "bar", "n_trades")
