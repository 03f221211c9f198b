"""Queries of the feature pipelines and of the audits (WN-12, 17, 18, 38, AG-*, JN-*, TK-*, ST-08)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators import audits, features, quality
from tideline.operators.dealing import dealt
from tideline.plans.tables import DAILY, TRADES, daily, day_volumes, rounded, table, trades

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_FLOWS = f"""{DAILY},
flows AS (SELECT symbol, d, sum(CASE WHEN flag = 'A' AND volume > 25 THEN price * volume END) AS large_buy, sum(CASE WHEN flag = 'R' AND volume > 25 THEN price * volume END) AS large_sell, sum(CASE WHEN flag <> 'R' AND volume <= 25 THEN price * volume END) AS small_buy, sum(CASE WHEN flag = 'R' AND volume <= 25 THEN price * volume END) AS small_sell FROM trades GROUP BY 1, 2),
ind AS (SELECT s_suppkey AS symbol, DATE '1990-01-01' AS a, DATE '1997-06-30' AS z, 'i' || s_nationkey % 3 AS industry FROM supplier UNION ALL SELECT s_suppkey, DATE '1997-07-01', NULL, 'j' || s_nationkey % 4 FROM supplier WHERE s_nationkey <> 5),
j AS (SELECT f.symbol, f.d, amount, coalesce(large_buy, 0) - coalesce(large_sell, 0) AS net_large, coalesce(large_buy, 0) - coalesce(large_sell, 0) + coalesce(small_buy, 0) - coalesce(small_sell, 0) AS net, i.industry FROM flows f LEFT JOIN daily y ON f.symbol = y.symbol AND f.d = y.d LEFT JOIN ind i ON i.symbol = f.symbol AND f.d >= i.a AND (i.z IS NULL OR f.d <= i.z)),
w AS (SELECT *, sum(net) OVER w3 AS net_3, sum(net_large) OVER w3 AS net_large_3, avg((net > 0)::INT) OVER w3 AS positive_3, CASE WHEN sum(amount) OVER w3 > 1e-12 THEN sum(net) OVER w3 / sum(amount) OVER w3 END AS r3, sum(net) OVER w10 AS net_10, CASE WHEN sum(amount) OVER w10 > 1e-12 THEN sum(net) OVER w10 / sum(amount) OVER w10 END AS r10
 FROM j WINDOW w3 AS (PARTITION BY symbol ORDER BY d ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), w10 AS (PARTITION BY symbol ORDER BY d ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))"""


@query(f"""WITH {_FLOWS}, c AS (SELECT *, stddev_pop(r10) OVER (PARTITION BY d) AS s, stddev_pop(r10) OVER (PARTITION BY d, industry) AS si FROM w)
SELECT symbol, d, industry, round(net, 4) AS net, round(CASE WHEN abs(amount) > 1e-12 THEN net / amount END, 9) AS net_to_amount, round(net_3, 4) AS net_3, round(net_large_3, 4) AS net_large_3, round(positive_3, 9) AS positive_3, round(r3, 9) AS net_3_to_amount, round(net_10, 4) AS net_10, round(r10, 9) AS net_10_to_amount,
 round((rank() OVER (PARTITION BY d ORDER BY r10) + (count(*) OVER (PARTITION BY d, r10) - 1) / 2) / count(r10) OVER (PARTITION BY d), 9) AS rank, round(CASE WHEN s > 1e-12 THEN (r10 - avg(r10) OVER (PARTITION BY d)) / s END, 6) AS z, round(CASE WHEN industry IS NOT NULL AND si > 1e-12 THEN (r10 - avg(r10) OVER (PARTITION BY d, industry)) / si END, 6) AS industry_z FROM c""")
def wn12_flow_features(spark: SparkSession, sf: str) -> DataFrame:
    """The whole flow pipeline: joins, metrics, rolling windows and cross-sections."""
    t = trades(spark, sf)
    v = F.col("price") * F.col("volume")
    part = lambda c, n: F.sum(F.when(F.expr(c), v)).alias(n)
    flows = dealt(t.select("symbol", "d", "flag", "price", "volume"), "symbol", "d").groupBy("symbol", "d").agg(part("flag = 'A' AND volume > 25", "large_buy"), part("flag = 'R' AND volume > 25", "large_sell"), part("flag <> 'R' AND volume <= 25", "small_buy"), part("flag = 'R' AND volume <= 25", "small_sell"))
    s, day = table(spark, sf, "supplier").withColumnRenamed("s_suppkey", "symbol"), lambda x: F.lit(x).cast("date")
    ind = s.select("symbol", day("1990-01-01").alias("start"), day("1997-06-30").alias("end"), F.concat(F.lit("i"), (F.col("s_nationkey") % 3).cast("string")).alias("industry"))
    ind = ind.union(s.where("s_nationkey <> 5").select("symbol", day("1997-07-01"), F.lit(None).cast("date"), F.concat(F.lit("j"), (F.col("s_nationkey") % 4).cast("string"))))
    out = features.flow_features(flows, daily(spark, sf), ind, [3, 10]).select("symbol", "d", "industry", "net", "net_to_amount", "net_3", "net_large_3", "positive_3", "net_3_to_amount", "net_10", "net_10_to_amount", "rank", "z", "industry_z")
    return rounded(rounded(rounded(out, "net", "net_3", "net_large_3", "net_10", digits=4), "net_to_amount", "positive_3", "net_3_to_amount", "net_10_to_amount", "rank", digits=9), "z", "industry_z")


_ON = """span AS (SELECT min(d) AS a, max(d) AS z FROM ev), pan AS (SELECT symbol, d, x FROM base, span WHERE d BETWEEN a AND z AND symbol IN (SELECT symbol FROM ev))"""


@query(f"""WITH {DAILY},
ev AS (SELECT symbol, d, count(*) AS n_events, count(*) FILTER (WHERE volume > 45) AS n_buys, count(*) FILTER (WHERE volume <= 45) AS n_sells, sum(CASE WHEN volume > 45 THEN 1 ELSE -1 END * price * volume) AS net_buy FROM trades WHERE flag = 'R' AND volume > 40 GROUP BY 1, 2),
base AS (SELECT symbol, d, amount AS x FROM daily), {_ON},
j AS (SELECT coalesce(p.symbol, e.symbol) AS symbol, coalesce(p.d, e.d) AS d, x AS amount, coalesce(n_events, 0) AS n_events, coalesce(n_buys, 0) AS n_buys, coalesce(net_buy, 0) AS net_buy FROM pan p FULL JOIN ev e ON p.symbol = e.symbol AND p.d = e.d),
n AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY d) AS k FROM j)
SELECT symbol, d, round(CASE WHEN amount > 0 THEN net_buy / amount END, 9) AS net_buy_to_amount, round(sum(net_buy) OVER w, 4) AS net_buy_5, sum(n_events) OVER w::DOUBLE AS n_events_5, sum(n_buys) OVER w::DOUBLE AS n_buys_5, round(CASE WHEN sum(amount) OVER w > 0 THEN sum(net_buy) OVER w / sum(amount) OVER w END, 9) AS net_buy_5_to_amount, (sum(n_events) OVER w > 0)::INT::DOUBLE AS is_event_5,
 k - max(CASE WHEN n_events > 0 THEN k END) OVER u AS since_event, k - max(CASE WHEN n_buys > 0 THEN k END) OVER u AS since_buy FROM n WINDOW w AS (PARTITION BY symbol ORDER BY d ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), u AS (PARTITION BY symbol ORDER BY d ROWS UNBOUNDED PRECEDING)""")
def wn17_institution_features(spark: SparkSession, sf: str) -> DataFrame:
    t = trades(spark, sf).where("flag = 'R' AND volume > 40")
    buy = F.col("volume") > 45
    ev = t.groupBy("symbol", "d").agg(F.count("*").alias("n_events"), F.count_if(buy).alias("n_buys"), F.count_if(~buy).alias("n_sells"), F.sum(F.when(buy, 1).otherwise(-1) * F.col("price") * F.col("volume")).alias("net_buy"))
    out = features.institution_features(ev, daily(spark, sf), 5).select("symbol", "d", "net_buy_to_amount", "net_buy_5", "n_events_5", "n_buys_5", "net_buy_5_to_amount", "is_event_5", "since_event", "since_buy")
    out = out.withColumns({c: F.col(c).cast("long") for c in ("since_event", "since_buy")})
    return rounded(rounded(out, "net_buy_5", digits=4), "net_buy_to_amount", "net_buy_5_to_amount", digits=9)


_INSIDER = """it AS (SELECT symbol, d, volume, CASE WHEN volume % 3 <> 0 THEN price END AS price, k, CASE flag WHEN 'R' THEN -1 ELSE 1 END AS dir FROM trades WHERE volume > 44),
ev AS (SELECT symbol, d, count(*) AS n_events, count(*) FILTER (WHERE dir > 0) AS n_buys, count(*) FILTER (WHERE dir < 0) AS n_sells, count(DISTINCT k % 7) AS n_holders, sum(dir * volume) AS net_volume, sum(dir * price * volume) AS net_amount FROM it GROUP BY 1, 2)"""


def _insider(spark: SparkSession, sf: str) -> DataFrame:
    t = trades(spark, sf).where("volume > 44").withColumns({"amount": F.when(F.col("volume") % 3 != 0, F.col("price")) * F.col("volume"), "holder": F.col("k") % 7})
    return features.insider_daily(t, ["symbol", "d"], "volume", "amount", "holder", F.when(F.col("flag") == "R", -1).otherwise(1))


@query(f"WITH {TRADES}, {_INSIDER} SELECT symbol, d, n_events, n_buys, n_sells, n_holders, net_volume, round(net_amount, 4) AS net_amount FROM ev")
def ag06_insider_daily(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_insider(spark, sf), "net_amount", digits=4)


@query(f"""WITH {DAILY}, {_INSIDER},
base AS (SELECT symbol, d, CASE WHEN symbol % 4 = 0 THEN 0 ELSE close * 1000 END AS x FROM daily), {_ON},
j AS (SELECT coalesce(p.symbol, e.symbol) AS symbol, coalesce(p.d, e.d) AS d, x, coalesce(n_events, 0) AS n_events, coalesce(n_buys, 0) AS n_buys, coalesce(net_volume, 0) AS net_volume, CASE WHEN coalesce(n_events, 0) = 0 THEN coalesce(net_amount, 0) ELSE net_amount END AS net_amount FROM pan p FULL JOIN ev e ON p.symbol = e.symbol AND p.d = e.d),
n AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY d) AS k FROM j)
SELECT symbol, d, round(sum(net_amount) OVER a, 4) AS net_amount_20, sum(n_events) OVER c::DOUBLE AS n_events_60, sum(n_buys) OVER c::DOUBLE AS n_buys_60, sum(net_volume) OVER c AS net_volume_60, round(CASE WHEN x > 0 THEN sum(net_amount) OVER a / x END, 9) AS net_amount_20_to_float, k - max(CASE WHEN n_events > 0 THEN k END) OVER u AS since_event
FROM n WINDOW a AS (PARTITION BY symbol ORDER BY d ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), c AS (PARTITION BY symbol ORDER BY d ROWS BETWEEN 59 PRECEDING AND CURRENT ROW), u AS (PARTITION BY symbol ORDER BY d ROWS UNBOUNDED PRECEDING)""")
def wn18_insider_features(spark: SparkSession, sf: str) -> DataFrame:
    panel = daily(spark, sf).select("symbol", "d", F.when(F.col("symbol") % 4 == 0, 0.0).otherwise(F.col("close") * 1000).alias("float_value"))
    out = features.insider_features(_insider(spark, sf), panel, 20, 60).select("symbol", "d", "net_amount_20", "n_events_60", "n_buys_60", "net_volume_60", "net_amount_20_to_float", F.col("since_event").cast("long").alias("since_event"))
    return rounded(rounded(out, "net_amount_20", digits=4), "net_amount_20_to_float", digits=9)


@query("""SELECT o_orderdate::DATE AS known, o_custkey AS fund, date_trunc('quarter', o_orderdate)::DATE AS period, l_suppkey AS stock, max(l_shipdate::DATE) AS disclosed, count(*) AS n_rows, sum(l_quantity) AS amount, round(sum(l_extendedprice), 2) AS value FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4""")
def ag07_fund_holdings(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("known"), F.col("o_custkey").alias("fund"), F.to_date(F.date_trunc("quarter", "o_orderdate")).alias("period"))
    h = table(spark, sf, "lineitem").join(o, "l_orderkey").select("known", "fund", "period", F.col("l_suppkey").alias("stock"), F.to_date("l_shipdate").alias("disclosed"), F.col("l_quantity").alias("amount"), F.col("l_extendedprice").alias("value"))
    return rounded(features.fund_holdings(h, ["known", "fund", "period", "stock"], "disclosed", ["amount", "value"]), "value", digits=2)


@query(f"""WITH {DAILY},
hot AS (SELECT symbol, d, amount AS heat FROM daily WHERE n_trades > 1),
h1 AS (SELECT *, rank() OVER (PARTITION BY d ORDER BY heat DESC, symbol) AS k, count(*) OVER (PARTITION BY d) AS n FROM hot),
h2 AS (SELECT *, lag(k) OVER (PARTITION BY symbol ORDER BY d) - k AS ch FROM h1),
m AS (SELECT l_shipdate::DATE AS d, l_suppkey AS symbol, p_brand AS theme, l_quantity AS q FROM lineitem JOIN part ON l_partkey = p_partkey),
th AS (SELECT d, theme, sum(q) AS strength, arg_max(symbol, (q, symbol)) AS lead FROM m GROUP BY 1, 2),
x AS (SELECT d, symbol, count(DISTINCT theme) AS n_themes, max(strength) AS s, max((lead = symbol)::INT) AS leader FROM m JOIN th USING (d, theme) GROUP BY 1, 2),
e AS (SELECT symbol, d, count(*) AS n FROM trades WHERE flag = 'R' GROUP BY 1, 2),
mo AS (SELECT symbol, strftime(d, '%Y%m') AS month, count(*) AS n FROM trades WHERE volume > 48 GROUP BY 1, 2),
days AS (SELECT d, row_number() OVER (ORDER BY d) AS i FROM (SELECT DISTINCT d FROM daily)),
g AS (SELECT y.symbol, y.d, i, h2.k, h2.n, h2.ch, h2.symbol IS NOT NULL AS hit, x.n_themes, x.s, x.leader, coalesce(e.n, 0) AS ev, mo.n AS rec FROM daily y JOIN days USING (d) LEFT JOIN h2 ON h2.symbol = y.symbol AND h2.d = y.d LEFT JOIN x ON x.symbol = y.symbol AND x.d = y.d LEFT JOIN e ON e.symbol = y.symbol AND e.d = y.d LEFT JOIN mo ON mo.symbol = y.symbol AND mo.month = strftime(y.d, '%Y%m'))
SELECT symbol, d, coalesce(n, 0)::DOUBLE AS hot_count, round(CASE WHEN n > 1 THEN 1 - (k - 1) / (n - 1) WHEN n = 1 THEN 1 ELSE 0 END, 9)::DOUBLE AS hot_rank, coalesce(ch, 0)::DOUBLE AS hot_change, coalesce(i - max(CASE WHEN hit THEN i END) OVER (PARTITION BY symbol ORDER BY d ROWS UNBOUNDED PRECEDING), 999)::DOUBLE AS days_since_hot, coalesce(n_themes, 0)::DOUBLE AS n_themes, coalesce(s, 0)::DOUBLE AS strongest_theme, coalesce(leader, 0)::DOUBLE AS leader,
 sum(ev) OVER (PARTITION BY symbol ORDER BY d ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)::DOUBLE AS n_events_5, sum(ev) OVER (PARTITION BY symbol ORDER BY d ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)::DOUBLE AS n_events_20, coalesce(rec, 0)::DOUBLE AS n_recommended FROM g""")
def wn38_hotspot_features(spark: SparkSession, sf: str) -> DataFrame:
    """WN-38 and PR-33: hot list, themes, events and recommendations on the grid of traded days."""
    y, t = daily(spark, sf), trades(spark, sf)
    m = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.to_date("l_shipdate").alias("d"), F.col("l_suppkey").alias("symbol"), F.col("p_brand").alias("theme"), F.col("l_quantity").alias("q"))
    th = m.groupBy("d", "theme").agg(F.sum("q").alias("strength"), F.max_by("symbol", F.struct("q", "symbol")).alias("lead"))
    out = features.hotspot_features(y.select("symbol", "d"), y.where("n_trades > 1").select("symbol", "d", F.col("amount").alias("heat")), th, m.select("d", "theme", "symbol"), t.where("flag = 'R'").select("symbol", "d"), t.where("volume > 48").select("symbol", F.date_format("d", "yyyyMM").alias("month")))
    return rounded(out, "hot_rank", digits=9)


@query("""WITH b AS (SELECT user_id, ts, event_id, value, hour(ts) * 60 + minute(ts) AS m, 1 + coalesce((props->>'$.k')::BIGINT, 0) AS v FROM events)
SELECT user_id, arg_min(value, (ts, event_id)) AS first_price, arg_max(value, (ts, event_id)) AS last_price, max(value) FILTER (WHERE m > 570) AS high_inside, min(value) FILTER (WHERE m > 570) AS low_inside,
 round(coalesce(sum(v) FILTER (WHERE m < 600), 0) / sum(v), 9) AS opening_share, round(coalesce(sum(v) FILTER (WHERE m >= 870), 0) / sum(v), 9) AS closing_share FROM b GROUP BY 1""")
def ag15_session_profile(spark: SparkSession, sf: str) -> DataFrame:
    v = (1 + F.coalesce(F.get_json_object("props", "$.k").cast("long"), F.lit(0))).cast("double")
    e = table(spark, sf, "events").select("user_id", F.struct("ts", "event_id").alias("at"), F.col("value").alias("price"), v.alias("volume"), (F.hour("ts") * 60 + F.minute("ts")).alias("minute"))
    return rounded(audits.session_profile(e, ["user_id"], "at", F.col("minute"), 570, 900), "opening_share", "closing_share", digits=9)


@query(f"""WITH {TRADES},
e AS (SELECT date_trunc('month', d)::DATE AS d, symbol, count(*) AS n FROM trades GROUP BY 1, 2)
SELECT d, count(*) AS n_symbols, sum(n)::BIGINT AS n_rows, count(*) FILTER (WHERE n <> 7) AS n_odd, sum(n) = count(*) * 7 AS product_holds FROM e GROUP BY d""")
def ag25_shape(spark: SparkSession, sf: str) -> DataFrame:
    return audits.shape(trades(spark, sf).withColumn("d", F.to_date(F.date_trunc("month", "d"))), "d", "symbol", 7)


@query(f"""WITH {TRADES} SELECT flag AS tier, count(*) AS n_rows, count(*) FILTER (WHERE volume < 10) AS n_accepted, count(*) FILTER (WHERE price > 5000) AS n_fatal, count(DISTINCT d) AS n_dates, grouping(flag)::INT AS is_total FROM trades GROUP BY ROLLUP (flag)""")
def ag28_dispositions(spark: SparkSession, sf: str) -> DataFrame:
    return audits.dispositions(trades(spark, sf).withColumnRenamed("flag", "tier"), "tier", "d", F.col("volume") < 10, F.col("price") > 5000)


@query("""SELECT o_orderpriority AS market, count(*) AS n_rows, count(*) FILTER (WHERE o_orderkey % 9 = 0) AS n_null, count(*) FILTER (WHERE o_totalprice < 1000) AS n_low, count(*) FILTER (WHERE o_orderkey % 31 = 0 AND o_orderkey % 9 <> 0) AS n_not_finite FROM orders GROUP BY 1""")
def ag30_payload(spark: SparkSession, sf: str) -> DataFrame:
    k, x = F.col("o_orderkey"), F.col("o_totalprice")
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("market"), F.when(k % 9 != 0, F.when(k % 31 == 0, float("inf")).otherwise(x)).alias("v"), x.alias("x"))
    return quality.counters(o, {"n_null": F.col("v").isNull(), "n_low": F.col("x") < 1000, "n_not_finite": F.col("v") == float("inf")}, ["market"])


@query(f"""WITH {DAILY},
a AS (SELECT CASE WHEN n_trades > 1 THEN close END AS close, volume FROM daily),
n AS (SELECT count(*) AS n_rows, avg((close IS NULL)::INT) AS c0, avg(close) AS c1, sum((CASE WHEN close IS NULL THEN -1 ELSE round(close * 100)::BIGINT END::HUGEINT * 2654435761) % 1000003 + CASE WHEN (CASE WHEN close IS NULL THEN -1 ELSE round(close * 100)::BIGINT END::HUGEINT * 2654435761) % 1000003 < 0 THEN 1000003 ELSE 0 END)::BIGINT AS c2, avg((volume IS NULL)::INT) AS v0, avg(volume) AS v1, sum((round(volume * 100)::HUGEINT * 2654435761) % 1000003)::BIGINT AS v2 FROM a)
SELECT 'close' AS feature, round(c0, 9) AS null_share, round(c1, 4) AS mean, c2 AS content, n_rows FROM n UNION ALL SELECT 'volume', round(v0, 9), round(v1, 4), v2, n_rows FROM n""")
def ag35_receipt(spark: SparkSession, sf: str) -> DataFrame:
    y = daily(spark, sf).select(F.when(F.col("n_trades") > 1, F.col("close")).alias("close"), "volume")
    return rounded(rounded(audits.receipt(y, ["close", "volume"]), "mean", digits=4), "null_share", digits=9)


_BOOK = """o AS (SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 2 = 0 THEN 'B' ELSE 'S' END AS side, floor(o_totalprice / 20000) AS price, 100.0 AS volume FROM orders),
r AS (SELECT l_orderkey AS order_id, CASE WHEN l_returnflag = 'R' THEN 'cancel' ELSE 'trade' END AS kind, l_quantity AS quantity FROM lineitem),
u AS (SELECT order_id, sum(quantity) AS q, coalesce(sum(quantity) FILTER (WHERE kind = 'trade'), 0) AS t, coalesce(sum(quantity) FILTER (WHERE kind = 'cancel'), 0) AS c FROM r GROUP BY 1),
b AS (SELECT o.*, greatest(volume - coalesce(q, 0), 0) AS "left", coalesce(t, 0) AS t, coalesce(c, 0) AS c FROM o LEFT JOIN u USING (order_id)),
l AS (SELECT side, price, sum("left") AS volume, count(*) AS n_orders FROM b WHERE "left" > 0 GROUP BY 1, 2),
p AS (SELECT *, row_number() OVER (PARTITION BY side ORDER BY CASE WHEN side = 'B' THEN -price ELSE price END) AS place FROM l)"""


def _book(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), F.when(F.col("o_orderkey") % 2 == 0, "B").otherwise("S").alias("side"), F.floor(F.col("o_totalprice") / 20000).cast("double").alias("price"), F.lit(100.0).alias("volume"))
    r = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_id"), F.when(F.col("l_returnflag") == "R", "cancel").otherwise("trade").alias("kind"), F.col("l_quantity").alias("quantity"), F.col("l_linenumber").alias("seq"))
    return o, r


@query(f"""WITH {_BOOK},
e AS (SELECT side, place, price, CASE WHEN place = 2 THEN volume + 1 ELSE volume END AS volume FROM p WHERE place <= 6)
SELECT side, coalesce(f.place, e.place)::INT AS place, f.price AS price_found, f.volume AS volume_found, e.price, e.volume, f.price IS NOT DISTINCT FROM e.price AND f.volume IS NOT DISTINCT FROM e.volume AS matches FROM (SELECT * FROM p WHERE place <= 5) f FULL JOIN e USING (side, place)""")
def ag36_book_match(spark: SparkSession, sf: str) -> DataFrame:
    """AG-36 and TK-05: the best five levels of each side after trades and cancels, against a published book of six."""
    o, r = _book(spark, sf)
    left = quality.opening_ledger(o, r)
    six = audits.levels(left, 6)
    published = six.withColumn("volume", F.when(F.col("place") == 2, F.col("volume") + 1).otherwise(F.col("volume")))
    return audits.level_match(audits.levels(left, 5), published)


@query(f"WITH {_BOOK}, z AS (SELECT *, row_number() OVER (PARTITION BY side ORDER BY CASE WHEN side = 'B' THEN price ELSE -price END) AS k FROM l) SELECT side, price, volume, k::INT AS place FROM z WHERE k <= 3")
def tk05_worst_levels(spark: SparkSession, sf: str) -> DataFrame:
    return audits.worst_levels(quality.opening_ledger(*_book(spark, sf)), 3)


@query(f"WITH {_BOOK} SELECT side, price, sum(volume) AS ordered, sum(t) AS traded, sum(c) AS cancelled, count(*) AS n_orders FROM b GROUP BY 1, 2")
def ag37_level_trace(spark: SparkSession, sf: str) -> DataFrame:
    """Every level's quantities, uncapped."""
    return audits.trace_level(*_book(spark, sf), ["side", "price"])


@query("""WITH c AS (SELECT o_custkey AS item, o_orderpriority AS chk, ['ok', 'note', 'warning', 'error'][1 + max(CASE WHEN o_orderkey % 40 = 0 THEN 3 WHEN o_orderkey % 9 = 0 THEN 2 WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END)] AS s FROM orders GROUP BY 1, 2),
v AS (SELECT *, CASE WHEN item % 3 = 0 AND chk = '1-URGENT' THEN 'ok' END AS o FROM c),
r AS (SELECT *, list_position(['ok', 'note', 'warning', 'error'], coalesce(o, s)) AS r FROM v)
SELECT item, count(*) AS n_checks, count(o) AS n_overridden, ['ok', 'note', 'warning', 'error'][max(r)] AS worst, CASE WHEN max(r) <= 2 THEN 'eligible' WHEN max(r) = 3 THEN 'restricted' ELSE 'ineligible' END AS eligibility FROM r GROUP BY 1""")
def ag38_eligibility(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    grave = F.max(F.when(k % 40 == 0, 3).when(k % 9 == 0, 2).when(k % 4 == 0, 1).otherwise(0))
    c = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("item"), F.col("o_orderpriority").alias("check")).agg(F.element_at(F.array(*[F.lit(s) for s in audits.SEVERITIES]), grave + 1).alias("severity"))
    over = c.where("item % 3 = 0 AND check = '1-URGENT'").select("item", "check", F.lit("ok").alias("severity"))
    return audits.eligibility(c, over, "item")


@query("""WITH e AS (SELECT user_id, CASE WHEN user_id % 5 = 0 THEN NULL WHEN user_id % 2 = 0 THEN 'web' ELSE event_type END AS label FROM events), n AS (SELECT user_id, label, count(*) AS n FROM e GROUP BY 1, 2)
SELECT user_id, count(label) AS n_labels, sum(n)::BIGINT AS n_records, arg_max(label, (n, label)) FILTER (WHERE label IS NOT NULL) AS label, CASE count(label) WHEN 0 THEN 'empty' WHEN 1 THEN 'matched' ELSE 'conflict' END AS status FROM n GROUP BY 1""")
def ag39_identity_evidence(spark: SparkSession, sf: str) -> DataFrame:
    u = F.col("user_id")
    e = table(spark, sf, "events").select("user_id", F.when(u % 5 == 0, None).when(u % 2 == 0, "web").otherwise(F.col("event_type")).alias("label"))
    return audits.identity_evidence(e, "user_id", "label")


@query("""WITH s AS (SELECT o_orderstatus AS stage, o_custkey, date_trunc('month', o_orderdate)::DATE AS m, CASE WHEN o_orderkey % 20 <> 0 THEN o_orderdate::DATE END AS d FROM orders),
f AS (SELECT stage, count(*) AS n_rows, count(*) - count(DISTINCT (o_custkey, m)) AS n_duplicates, count(*) FILTER (WHERE d IS NULL) AS n_undated, min(d) AS first_date, max(d) AS last_date FROM s GROUP BY 1),
e AS (SELECT unnest(['F', 'O', 'X']) AS stage)
SELECT coalesce(e.stage, f.stage) AS stage, coalesce(n_rows, 0) AS n_rows, coalesce(n_duplicates, 0) AS n_duplicates, coalesce(n_undated, 0) AS n_undated, first_date, last_date FROM e FULL JOIN f ON e.stage = f.stage""")
def ag41_stage_audit(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("stage"), "o_custkey", F.to_date(F.date_trunc("month", "o_orderdate")).alias("m"), F.when(F.col("o_orderkey") % 20 != 0, F.to_date("o_orderdate")).alias("d"))
    return audits.stage_audit(s, "stage", ["o_custkey", "m"], "d", ["F", "O", "X"])


@query(f"""WITH {TRADES},
a AS (SELECT symbol, d, sum(volume) AS volume_a, sum(k % 97)::BIGINT AS mark_a FROM trades WHERE flag <> 'R' GROUP BY 1, 2),
b AS (SELECT symbol, d, sum(volume) AS volume_b, sum(k % 97)::BIGINT AS mark_b FROM trades WHERE flag <> 'A' GROUP BY 1, 2)
SELECT symbol, d, volume_a, volume_b, mark_a, mark_b, round(volume_b / volume_a, 9) AS volume_ratio, round(CASE WHEN mark_a <> 0 THEN mark_b / mark_a END, 9) AS mark_ratio FROM a FULL JOIN b USING (symbol, d)""")
def ag42_source_ratios(spark: SparkSession, sf: str) -> DataFrame:
    t = trades(spark, sf).withColumn("mark", F.col("k") % 97)
    out = audits.cross_source_ratios(t.where("flag <> 'R'"), t.where("flag <> 'A'"), ["symbol", "d"], ["volume", "mark"])
    return rounded(out, "volume_ratio", "mark_ratio", digits=9)


@query("""WITH p AS (SELECT o_custkey AS id, year(o_orderdate) AS y, count(*)::VARCHAR || CASE WHEN o_custkey % 10 = 0 THEN ' rows' ELSE '' END AS n FROM orders GROUP BY o_custkey, y)
SELECT 0::BIGINT AS n_unknown, coalesce(sum(TRY_CAST(n AS BIGINT)), 0)::BIGINT AS n_rows FROM p WHERE y BETWEEN 1995 AND 1997""")
def ag43_selection_count(spark: SparkSession, sf: str) -> DataFrame:
    """All customers with orders are asked for; some counts are no numbers."""
    o = table(spark, sf, "orders")
    p = o.groupBy(F.col("o_custkey").alias("id"), F.year("o_orderdate").alias("y")).agg(F.count("*").cast("string").alias("k")).select("id", "y", F.concat("k", F.when(F.col("id") % 10 == 0, " rows").otherwise("")).alias("n"))
    return audits.selection_count(p, o.select(F.col("o_custkey").alias("id")), "id", "n", F.col("y").between(1995, 1997))


_ARCHIVE = f"{TRADES}, a AS (SELECT symbol, d, sum(volume) AS v FROM trades GROUP BY 1, 2), r AS (SELECT symbol, d, v + CASE WHEN v = 30 THEN 0.5 ELSE 0 END AS v FROM a), x AS (SELECT * FROM a WHERE v <> 31), j AS (SELECT r.symbol, r.d, abs(r.v - x.v) AS diff, x.v AS o FROM r LEFT JOIN x USING (symbol, d))"


def _archive(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    a = day_volumes(trades(spark, sf))
    return a.withColumn("v", F.col("v") + F.when(F.col("v") == 30, 0.5).otherwise(0.0)), a.where("v <> 31")


@query(f"WITH {_ARCHIVE} SELECT count(*) AS n_reference, count(o) AS n_matched, count(*) FILTER (WHERE o IS NULL) AS n_missing, count(*) FILTER (WHERE diff <= 0.1) AS n_within FROM j")
def jn24_archive_comparison(spark: SparkSession, sf: str) -> DataFrame:
    return audits.compare_archive(*_archive(spark, sf), ["symbol", "d"], "v", 0.1, 5)[0]


@query(f"WITH {_ARCHIVE} SELECT symbol, d, diff FROM j WHERE diff IS NOT NULL ORDER BY diff DESC, symbol, d LIMIT 5")
def jn24_worst_differences(spark: SparkSession, sf: str) -> DataFrame:
    """The five worst; their number is the report's."""
    return audits.compare_archive(*_archive(spark, sf), ["symbol", "d"], "v", 0.1, 5)[1]


@query(f"""WITH {_ARCHIVE},
c AS (SELECT r.symbol, r.v AS v, x.v AS w FROM r LEFT JOIN x USING (symbol, d))
SELECT count(*) AS n_old, count(*) FILTER (WHERE w IS NULL) AS n_lost, count(*) FILTER (WHERE v <> w) AS n_changed, count(*) FILTER (WHERE w IS NULL OR v <> w) = 0 AS unrevised FROM c""")
def jn25_revision_check(spark: SparkSession, sf: str) -> DataFrame:
    return audits.revised(*_archive(spark, sf), ["symbol", "d"], "v")


@query(f"""WITH {DAILY},
p AS (SELECT symbol, d, close FROM daily WHERE n_trades > 1),
j AS (SELECT symbol, d, close, o.n FROM p JOIN (SELECT DISTINCT l_suppkey AS symbol, l_shipdate::DATE AS d, 1 AS n FROM lineitem WHERE l_quantity > 10) o USING (symbol, d)),
c AS (SELECT *, count(*) OVER (PARTITION BY d) AS k FROM j)
SELECT symbol, d, close, n FROM c WHERE k >= 2""")
def jn20_restricted_candidates(spark: SparkSession, sf: str) -> DataFrame:
    pool = table(spark, sf, "lineitem").where("l_quantity > 10").select(F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("d"), F.lit(1).alias("n")).distinct()
    return audits.restricted(daily(spark, sf).where("n_trades > 1").select("symbol", "d", "close"), pool, ["symbol", "d"], ["d"], 2)


@query("""SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE dayofweek(l_shipdate) BETWEEN 1 AND 5 AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 18) AND (l_partkey, l_returnflag) IN (SELECT p_partkey, 'A' FROM part WHERE p_size > 25)""")
def jn15_semi_filters(spark: SparkSession, sf: str) -> DataFrame:
    """Open days, members and restricted keys, each as a semi-join."""
    line = table(spark, sf, "lineitem").withColumn("d", F.to_date("l_shipdate"))
    open_days = line.select("d").distinct().where(F.dayofweek("d").between(2, 6))
    members = table(spark, sf, "supplier").where("s_nationkey < 18").select(F.col("s_suppkey").alias("l_suppkey"))
    keys = table(spark, sf, "part").where("p_size > 25").select(F.col("p_partkey").alias("l_partkey"), F.lit("A").alias("l_returnflag"))
    out = line.join(open_days, "d", "left_semi").join(members, "l_suppkey", "left_semi").join(keys, ["l_partkey", "l_returnflag"], "left_semi")
    return out.select("l_orderkey", "l_linenumber", "l_quantity")


@query("""WITH x AS (SELECT l_suppkey, row(l_shipdate, l_quantity) AS a, lag(row(l_shipdate, l_quantity)) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber) AS b FROM lineitem)
SELECT l_suppkey, count(*) AS n_rows, count(*) FILTER (WHERE a = b) AS n_repeats, count(*) FILTER (WHERE a < b) AS n_backwards FROM x GROUP BY 1""")
def wn30_adjacent_faults(spark: SparkSession, sf: str) -> DataFrame:
    return audits.adjacent_faults(table(spark, sf, "lineitem"), ["l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber"], ["l_shipdate", "l_quantity"])


@query(f"""WITH {DAILY} SELECT symbol, min(d) AS first_trade, least(min(d), DATE '1995-06-01' + s_nationkey::INT) AS list_date, count(*) AS n_days, date_diff('day', least(min(d), DATE '1995-06-01' + s_nationkey::INT), max(d)) AS listed_days FROM daily JOIN supplier ON s_suppkey = symbol GROUP BY symbol, s_nationkey""")
def pr18_list_date(spark: SparkSession, sf: str) -> DataFrame:
    """The earlier of the recorded date and the first trade."""
    first = daily(spark, sf).groupBy("symbol").agg(F.min("d").alias("first_trade"), F.max("d").alias("last_trade"), F.count("*").alias("n_days"))
    recorded = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("symbol"), F.date_add(F.lit("1995-06-01").cast("date"), F.col("s_nationkey").cast("int")).alias("recorded"))
    listed = F.least("first_trade", "recorded")
    return first.join(recorded, "symbol").select("symbol", "first_trade", listed.alias("list_date"), "n_days", F.datediff("last_trade", listed).cast("long").alias("listed_days"))


@query(f"WITH {DAILY} SELECT d, symbol, round(amount, 4) AS amount, row_number() OVER (ORDER BY d, round(amount, 4) DESC, symbol) AS place FROM daily")
def tk04_ordered_output(spark: SparkSession, sf: str) -> DataFrame:
    """Rows in their order of output, each with its place: places inside a date, behind the dates before it. Amounts are
    rounded before they are compared, as equal ones differ in their last bits by the order of their sums."""
    from pyspark.sql import Window

    y = rounded(daily(spark, sf).select("d", "symbol", "amount"), "amount", digits=4)
    before = y.groupBy("d").agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(Window.orderBy("d")) - F.col("n"))  # one row a date
    place = F.row_number().over(Window.partitionBy("d").orderBy(F.desc("amount"), "symbol"))
    return y.withColumn("k", place).join(F.broadcast(before.select("d", "before")), "d").select("d", "symbol", "amount", (F.col("k") + F.col("before")).alias("place")).orderBy("place")


@query("""WITH u AS (SELECT o_custkey AS member, o_orderpriority AS theme, NULL::DATE AS since FROM orders UNION ALL SELECT o_custkey, o_orderpriority, o_orderdate::DATE FROM orders WHERE o_orderstatus = 'F')
SELECT member, theme, min(since) AS since FROM u GROUP BY 1, 2""")
def st08_membership_union(spark: SparkSession, sf: str) -> DataFrame:
    """Two parts of a membership, of which one lacks a column; one row a member and theme."""
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("member"), F.col("o_orderpriority").alias("theme"), F.to_date("o_orderdate").alias("since"), "o_orderstatus")
    return audits.membership_union([o.select("member", "theme"), o.where("o_orderstatus = 'F'").select("member", "theme", "since")], ["member", "theme", "basket"])
