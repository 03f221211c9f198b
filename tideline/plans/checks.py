"""Normalisation, profiling, quality and tick checks (PR-*, AG-13..42, WN-26..30, QL-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.functions import scalar
from tideline.operators import normalize, quality
from tideline.plans.tables import DAILY, TICKS, TRADES, daily, rounded, table, ticks, trades

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query("SELECT s_suppkey, lpad(s_suppkey::VARCHAR, 6, '0') || '.' || CASE WHEN s_nationkey % 2 = 0 THEN 'SH' ELSE 'SZ' END AS code FROM supplier")
def pr01_canonical_code(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat(F.lit(" "), F.col("s_suppkey").cast("string"), F.when(F.col("s_nationkey") % 2 == 0, ".sh ").otherwise(".sz "))
    return table(spark, sf, "supplier").select("s_suppkey", scalar.canonical_code(raw).alias("code"))


@query("SELECT p_partkey, coalesce(CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_brand END, p_type) AS symbol FROM part")
def pr03_first_present(spark: SparkSession, sf: str) -> DataFrame:
    alias = F.when(F.col("p_size") % 3 == 0, "  ").otherwise(F.col("p_brand"))
    return table(spark, sf, "part").select("p_partkey", scalar.first_present(alias, F.col("p_type")).alias("symbol"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE o_orderdate::DATE END AS d FROM orders")
def pr05_tolerant_date(spark: SparkSession, sf: str) -> DataFrame:
    day, k = F.date_format("o_orderdate", "yyyyMMdd"), F.col("o_orderkey") % 4
    text = F.when(k == 0, day).when(k == 1, F.concat(day, F.lit(".0"))).when(k == 2, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("n/a")
    return table(spark, sf, "orders").select("o_orderkey", scalar.tolerant_date(text).alias("d"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS x FROM orders")
def pr06_number(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("o_orderkey") % 5 == 0, "NaN").otherwise(F.col("o_totalprice").cast("string"))
    return table(spark, sf, "orders").select("o_orderkey", scalar.number(text).alias("x"))


@query("SELECT p_partkey, CASE WHEN starts_with(p_partkey::VARCHAR, '11') THEN 'B' WHEN starts_with(p_partkey::VARCHAR, '1') THEN 'A' WHEN starts_with(p_partkey::VARCHAR, '6') THEN 'C' END AS exchange FROM part")
def pr08_prefix_exchange(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", scalar.prefix_exchange(F.col("p_partkey").cast("string"), {"1": "A", "11": "B", "6": "C"}).alias("exchange"))


@query("""WITH c AS (SELECT event_id, (hour(ts) * 10000 + minute(ts) * 100 + second(ts)::INT) * 1000 + event_id % 1000 + CASE WHEN event_id % 50 = 0 THEN 6100000 ELSE 0 END AS clock FROM events),
m AS (SELECT event_id, CASE WHEN clock // 10000000 < 24 AND (clock // 100000) % 100 < 60 AND (clock // 1000) % 100 < 60 THEN (((clock // 10000000) * 60 + (clock // 100000) % 100) * 60 + (clock // 1000) % 100) * 1000 + clock % 1000 END AS ms FROM c)
SELECT event_id, ms::BIGINT AS ms, CASE WHEN ms BETWEEN 555 * 60000 AND 570 * 60000 THEN 570 WHEN ms > 570 * 60000 AND ms < 691 * 60000 THEN least(ceil(ms / 60000.0), 690)
 WHEN ms >= 780 * 60000 AND ms < 901 * 60000 THEN greatest(least(ceil(ms / 60000.0), 900), 781) END::BIGINT AS bar_minute FROM m""")
def pr11_session_minute(spark: SparkSession, sf: str) -> DataFrame:
    """PR-10 and PR-11: exchange clock to milliseconds, then to the minute of the bar."""
    clock = (F.hour("ts") * 10000 + F.minute("ts") * 100 + F.second("ts")) * 1000 + F.col("event_id") % 1000 + F.when(F.col("event_id") % 50 == 0, 6100000).otherwise(0)
    ms = table(spark, sf, "events").select("event_id", scalar.clock_ms(clock).alias("ms"))
    return ms.withColumn("bar_minute", scalar.session_minute(F.col("ms")))


_BROKEN = f"{DAILY}, b AS (SELECT symbol, d, open, CASE WHEN d::VARCHAR LIKE '%-05' THEN low ELSE high END AS high, CASE WHEN d::VARCHAR LIKE '%-06' THEN NULL ELSE low END AS low, close, volume FROM daily)"


def _broken(spark: SparkSession, sf: str) -> DataFrame:
    day = F.dayofmonth("d")
    return daily(spark, sf).select("symbol", "d", "open", F.when(day == 5, F.col("low")).otherwise(F.col("high")).alias("high"), F.when(day != 6, F.col("low")).alias("low"), "close", "volume")


@query(f"""WITH {_BROKEN} SELECT symbol, d, greatest(open, high, low, close) AS high, least(open, high, low, close) AS low, greatest(open, high, low, close) IS DISTINCT FROM high OR least(open, high, low, close) IS DISTINCT FROM low AS repaired FROM b""")
def pr13_repair_ohlc(spark: SparkSession, sf: str) -> DataFrame:
    hi, lo = F.greatest("open", "high", "low", "close"), F.least("open", "high", "low", "close")
    return _broken(spark, sf).select("symbol", "d", hi.alias("high"), lo.alias("low"), (~hi.eqNullSafe(F.col("high")) | ~lo.eqNullSafe(F.col("low"))).alias("repaired"))


@query(f"""WITH {DAILY} SELECT symbol, d, close >= 0.95 * high AND n_trades > 1 AS is_limit_up, coalesce(volume, 0) <= 10 AS is_suspended, coalesce(lag(close) OVER (PARTITION BY symbol ORDER BY d), close) AS pre_close FROM daily""")
def pr15_daily_flags(spark: SparkSession, sf: str) -> DataFrame:
    """PR-15 to PR-17: limit and suspension flags, previous close filled from the close."""
    before = F.coalesce(F.lag("close").over(Window.partitionBy("symbol").orderBy("d")), F.col("close"))
    limit = F.coalesce((F.col("close") >= 0.95 * F.col("high")) & (F.col("n_trades") > 1), F.lit(False))
    return daily(spark, sf).select("symbol", "d", limit.alias("is_limit_up"), (F.coalesce("volume", F.lit(0)) <= 10).alias("is_suspended"), before.alias("pre_close"))


@query("""SELECT event_id, CASE WHEN event_type IN ('purchase') THEN 1 WHEN event_type = 'error' THEN -1 ELSE 1 END AS side FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 'error' ELSE 'purchase' END AS event_type FROM events)""")
def pr21_direction(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("event_type") == "error", "SELL out").otherwise("other")
    return table(spark, sf, "events").select("event_id", scalar.direction(text, F.col("value")).alias("side"))


@query(f"""WITH {TICKS}, p AS (SELECT symbol, ts, event_id, CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 13 = 0 THEN -price ELSE price END AS price FROM ticks),
r AS (SELECT symbol, CASE WHEN symbol IS NULL OR ts IS NULL OR price IS NULL THEN 'missing_required_value' WHEN event_id IS NULL THEN 'missing_event_id' WHEN price <= 0 THEN 'special_price_or_event' ELSE '' END AS reason FROM p)
SELECT symbol, CASE reason WHEN '' THEN 'keep' WHEN 'special_price_or_event' THEN 'tag' ELSE 'exclude' END AS decision, reason, count(*) AS n FROM r GROUP BY 1, 2, 3""")
def pr24_tick_triage(spark: SparkSession, sf: str) -> DataFrame:
    """Decisions of deals by symbol."""
    k = F.col("event_id")
    t = ticks(spark, sf).withColumn("price", F.when(k % 97 == 0, None).when(k % 13 == 0, -F.col("price")).otherwise(F.col("price")))
    return normalize.tick_triage(t, "deal", code="symbol", time="ts", price="price", event_id="event_id").groupBy("symbol", "decision", "reason").agg(F.count("*").alias("n"))


@query(f"""WITH {_BROKEN} SELECT year(d) AS y, count(*) AS n_rows, count(*) FILTER (WHERE low IS NULL) AS n_null, count(*) FILTER (WHERE high < greatest(open, close)) AS n_high, count(*) FILTER (WHERE low > least(open, close)) AS n_low, count(*) FILTER (WHERE volume <= 0) AS n_volume FROM b GROUP BY 1""")
def ag14_partition_validation(spark: SparkSession, sf: str) -> DataFrame:
    """AG-13 and AG-14: all counters of a partition in one scan."""
    checks = {"n_null": F.col("low").isNull(), "n_high": F.col("high") < F.greatest("open", "close"), "n_low": F.col("low") > F.least("open", "close"), "n_volume": F.col("volume") <= 0}
    return quality.counters(_broken(spark, sf).withColumn("y", F.year("d").cast("long")), checks, ["y"])


@query("SELECT l_returnflag, count(*) - count(DISTINCT (l_suppkey, l_shipdate)) AS n_duplicates FROM lineitem GROUP BY 1")
def ag22_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicates(table(spark, sf, "lineitem"), ["l_suppkey", "l_shipdate"], ["l_returnflag"])


@query("SELECT o_custkey, o_orderpriority, count(DISTINCT o_orderstatus) AS n_versions FROM orders GROUP BY 1, 2 HAVING count(DISTINCT o_orderstatus) > 1")
def ag23_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.conflicts(table(spark, sf, "orders"), ["o_custkey", "o_orderpriority"], ["o_orderstatus"])


@query("""SELECT 'user_id' AS "column", count(*) AS n_rows, count(*) FILTER (WHERE user_id IS NULL) AS n_nulls, count(DISTINCT user_id) AS n_distinct, min(user_id)::VARCHAR AS smallest, max(user_id)::VARCHAR AS largest FROM events
UNION ALL SELECT 'event_type', count(*), count(*) FILTER (WHERE event_type IS NULL), count(DISTINCT event_type), min(event_type), max(event_type) FROM events""")
def ag21_profile(spark: SparkSession, sf: str) -> DataFrame:
    return quality.profile(table(spark, sf, "events"), ["user_id", "event_type"])


@query("""SELECT event_type, count(value) AS n, min(value) AS smallest, round(avg(value), 6) AS mean, max(value) AS largest, round(quantile_cont(value, 0.01), 6) AS p1, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY 1""")
def ag16_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(quality.summary(table(spark, sf, "events"), "value", ["event_type"], [0.01, 0.5, 0.99]), "mean", "p1", "p50", "p99")


@query("""WITH p AS (SELECT event_type, value AS a, value * (1 + (event_id % 7) / 1e4) AS b FROM events)
SELECT event_type, count(*) AS n, round(avg((abs(a - b) = 0)::INT), 6) AS exact_rate, round(avg(abs(a - b)), 6) AS mean_abs, round(max(abs(a - b)), 6) AS max_abs,
 round(avg(CASE WHEN b <> 0 THEN abs(a - b) / abs(b) END), 8) AS mean_rel, count(*) FILTER (WHERE b = 0) AS n_zero FROM p GROUP BY 1""")
def ag17_errors(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "events").select("event_type", F.col("value").alias("a"), (F.col("value") * (1 + (F.col("event_id") % 7) / F.lit(1e4))).alias("b"))
    return rounded(rounded(quality.errors(p, "a", "b", ["event_type"]), "exact_rate", "mean_abs", "max_abs"), "mean_rel", digits=8)


@query("""WITH r AS (SELECT o_orderpriority, rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_orderpriority, o_totalprice) - 1) / 2 AS a,
 rank() OVER (PARTITION BY o_orderpriority ORDER BY o_custkey) + (count(*) OVER (PARTITION BY o_orderpriority, o_custkey) - 1) / 2 AS b FROM orders)
SELECT o_orderpriority, count(*) AS n, round(corr(a, b), 6) AS rank_corr FROM r GROUP BY 1""")
def ag18_rank_correlation(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(quality.rank_correlation(table(spark, sf, "orders"), "o_totalprice", "o_custkey", ["o_orderpriority"]), "rank_corr")


@query("SELECT year(l_shipdate) AS y, count(*) AS n, sum(l_quantity) AS q, round(sum(l_quantity * l_discount) / sum(l_quantity), 6) AS weighted FROM lineitem GROUP BY ROLLUP (year(l_shipdate))")
def ag19_rollup(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "lineitem").withColumn("y", F.year("l_shipdate").cast("long"))
    return t.rollup("y").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"), F.round(F.sum(F.col("l_quantity") * F.col("l_discount")) / F.sum("l_quantity"), 6).alias("weighted"))


@query("""WITH m AS (SELECT avg((l_discount > 0.05)::INT) AS rate, count(*)::DOUBLE AS rows FROM lineitem)
SELECT 'rate' AS metric, 'at_most' AS op, 0.9 AS threshold, round(rate, 6) AS actual, rate <= 0.9 AS passed FROM m UNION ALL SELECT 'rows', 'at_least', 1000000.0, rows, rows >= 1000000 FROM m""")
def ag20_gates(spark: SparkSession, sf: str) -> DataFrame:
    m = table(spark, sf, "lineitem").agg(F.avg((F.col("l_discount") > 0.05).cast("double")).alias("rate"), F.count("*").alias("rows"))
    return rounded(quality.gates(m, [("rate", "at_most", 0.9), ("rows", "at_least", 1000000.0)]), "actual")


@query(f"""WITH {TRADES}, y AS (SELECT DISTINCT symbol, date_trunc('month', d)::DATE AS m FROM trades), g AS (SELECT s_suppkey AS symbol, m FROM supplier, (SELECT DISTINCT m FROM y))
SELECT symbol, m, 'missing' AS state FROM g ANTI JOIN y USING (symbol, m) UNION ALL SELECT symbol, m, 'orphan' FROM y ANTI JOIN g USING (symbol, m)""")
def ag26_full_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Every supplier is expected in every month of the table."""
    y = trades(spark, sf).select("symbol", F.to_date(F.date_trunc("month", "d")).alias("m")).distinct()
    months = y.select("m").distinct()  # a calendar's months
    grid = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("symbol")).crossJoin(F.broadcast(months))
    return quality.coverage(grid, y, ["symbol", "m"])


@query(f"""WITH {TRADES},
t AS (SELECT DISTINCT symbol, d FROM trades WHERE flag = 'R'),
p AS (SELECT DISTINCT symbol, d FROM trades WHERE volume > 25),
n AS (SELECT count(*) FILTER (WHERE t.symbol IS NOT NULL AND p.symbol IS NOT NULL) AS tp, count(*) FILTER (WHERE t.symbol IS NULL) AS fp, count(*) FILTER (WHERE p.symbol IS NULL) AS fn FROM t FULL JOIN p ON t.symbol = p.symbol AND t.d = p.d)
SELECT tp, fp, fn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(tp / (tp + fp + fn), 6) AS jaccard FROM n""")
def ag31_set_agreement(spark: SparkSession, sf: str) -> DataFrame:
    t = trades(spark, sf)
    return rounded(quality.set_agreement(t.where("flag = 'R'"), t.where("volume > 25"), ["symbol", "d"]), "precision", "recall", "jaccard")


@query("SELECT event_type, ts::DATE AS day, count(*) AS n, max(ts) AS last_ts FROM events GROUP BY 1, 2 HAVING hour(max(ts)) >= 23")
def ag32_complete_days(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.max("ts").alias("last_ts")).where(F.hour("last_ts") >= 23)


@query(f"""WITH {DAILY} SELECT symbol, min(d) AS first_day, max(d) AS last_day, count(*) AS n_days, max_by(n_trades, d) AS latest_trades, string_agg(DISTINCT year(d)::VARCHAR, ',' ORDER BY year(d)::VARCHAR) AS years FROM daily GROUP BY 1""")
def ag33_spans(spark: SparkSession, sf: str) -> DataFrame:
    """AG-33 and AG-34: spans, latest values and joined unique labels."""
    years = F.array_join(F.array_sort(F.collect_set(F.year("d").cast("string"))), ",")
    return daily(spark, sf).groupBy("symbol").agg(F.min("d").alias("first_day"), F.max("d").alias("last_day"), F.count("*").alias("n_days"), F.max_by("n_trades", "d").alias("latest_trades"), years.alias("years"))


@query("""WITH q AS (SELECT l_orderkey AS order_id, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS c, l_linenumber, l_partkey, l_quantity::BIGINT AS quantity FROM lineitem),
r AS (SELECT *, sum(quantity) OVER (PARTITION BY order_id ORDER BY c, l_linenumber, l_partkey, quantity ROWS UNBOUNDED PRECEDING) AS so_far FROM q),
o AS (SELECT o_orderkey AS order_id, CASE WHEN o_custkey % 2 = 0 THEN 'B' ELSE 'S' END AS side, o_custkey % 100 AS price, (o_totalprice / 4000)::BIGINT AS volume FROM orders),
u AS (SELECT order_id, sum(quantity) AS requested, count(*) FILTER (WHERE quantity > 0 AND so_far > greatest(volume, 0)) AS n_overdrawn, bool_or(volume IS NULL) AS unknown FROM r LEFT JOIN o USING (order_id) GROUP BY 1)
SELECT order_id, side, price, greatest(coalesce(volume, 0) - coalesce(requested, 0), 0)::BIGINT AS "left", coalesce(n_overdrawn, 0) AS n_overdrawn, coalesce(unknown, false) AS unknown FROM o FULL JOIN u USING (order_id)""")
def ag36_opening_ledger(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), F.when(F.col("o_custkey") % 2 == 0, "B").otherwise("S").alias("side"), (F.col("o_custkey") % 100).alias("price"), F.rint(F.col("o_totalprice") / 4000).cast("long").alias("volume"))
    q = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_id"), F.struct((F.col("l_returnflag") == "R").cast("int").alias("c"), "l_linenumber", "l_partkey", "l_quantity").alias("seq"), F.col("l_quantity").cast("long").alias("quantity"))
    return quality.opening_ledger(o, q)


@query("""WITH s AS (SELECT user_id, event_id, (event_id * 7919) % 1009 AS seq FROM events), l AS (SELECT *, seq - lag(seq) OVER (PARTITION BY user_id ORDER BY event_id) AS s FROM s)
SELECT user_id, count(*) AS n, count(seq) - count(DISTINCT seq) AS n_duplicates, count(*) FILTER (WHERE s < 0) AS n_backwards, count(*) FILTER (WHERE s > 1) AS n_gaps, coalesce(sum(s - 1) FILTER (WHERE s > 1), 0)::BIGINT AS gap_span FROM l GROUP BY 1""")
def wn28_sequence_quality(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "events").select("user_id", "event_id", ((F.col("event_id") * 7919) % 1009).alias("seq"))
    return quality.sequence_quality(s, "user_id", "seq", ["event_id"])


@query(f"""WITH {_BROKEN},
c AS (SELECT symbol, d, CASE WHEN low IS NULL THEN 'null_low' WHEN high < greatest(open, close) THEN 'high_below' END AS "check" FROM b)
SELECT symbol, d, "check" FROM (SELECT *, row_number() OVER (PARTITION BY "check" ORDER BY d, symbol) AS n FROM c WHERE "check" IS NOT NULL) WHERE n <= 20""")
def tk07_violation_samples(spark: SparkSession, sf: str) -> DataFrame:
    check = F.when(F.col("low").isNull(), "null_low").when(F.col("high") < F.greatest("open", "close"), "high_below")
    return quality.samples(_broken(spark, sf), check, ["d", "symbol"], 20).select("symbol", "d", "check")


@query("SELECT event_type, count(*) AS n_rows FROM events GROUP BY 1")
def ag40_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return quality.fingerprint(table(spark, sf, "events"), ["event_id", "ts", "value"], ["event_type"]).select("event_type", "n_rows")


@query("""WITH r AS (SELECT event_type, value, sha256(length(event_id::VARCHAR) || ':' || event_id || coalesce(length(strftime(ts, '%Y-%m-%d %H:%M:%S.%f')) || ':' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '~') || coalesce(length(user_id::VARCHAR) || ':' || user_id, '~')
  || coalesce(length(value::DECIMAL(18, 6)::VARCHAR) || ':' || value::DECIMAL(18, 6), '~') || coalesce(length(props::VARCHAR) || ':' || props, '~')) AS h FROM events),
p AS (SELECT event_type, value, list_transform(range(0, 8), lambda i: ('0x' || substr(h, 8 * i::INT + 1, 8))::BIGINT) AS x FROM r)
SELECT event_type, count(*) AS n_rows, concat_ws('-', sum(x[1]), sum(x[2]), sum(x[3]), sum(x[4]), sum(x[5]), sum(x[6]), sum(x[7]), sum(x[8])) AS digest FROM p GROUP BY 1""")
def ag40_content_digest(spark: SparkSession, sf: str) -> DataFrame:
    """All columns of the events, in a digest that DuckDB can form too."""
    values = {"event_id": F.col("event_id").cast("string"), "ts": F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), "user_id": F.col("user_id").cast("string"), "value": F.col("value").cast("decimal(18,6)").cast("string"), "props": F.col("props")}
    return quality.content_digest(table(spark, sf, "events"), values, ["event_type"])


@query()
def ag40_content_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    """All columns of the events; no SQL, as Spark's row hash has no DuckDB twin."""
    return quality.fingerprint(table(spark, sf, "events"), ["event_id", "ts", "user_id", "value", "props"], ["event_type"])


@query("""SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_extract(html, '<html lang=\"([a-z]+)\"', 1) AS lang, len(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) AS n_links FROM pages""")
def io19_html_fields(spark: SparkSession, sf: str) -> DataFrame:
    h = F.col("html")
    return table(spark, sf, "pages").select("page_id", F.regexp_extract(h, "<title>([^<]*)</title>", 1).alias("title"), F.regexp_extract(h, '<html lang="([a-z]+)"', 1).alias("lang"), F.size(F.regexp_extract_all(h, F.lit('<a href="([^"]*)"'), F.lit(1))).cast("long").alias("n_links"))


@query("SELECT event_id, 'k' AS field, (props->>'$.k')::BIGINT AS value FROM events WHERE props->>'$.k' IS NOT NULL")
def io17_json_observations(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.explode(F.from_json("props", "map<string,bigint>")).alias("field", "value")).where("field = 'k'")


@query("SELECT event_type || ',' || strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, max(value) AS top FROM events GROUP BY 1")
def io18_parse_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Comma-joined lines are split and cast; malformed ones become null and are counted out."""
    line = F.concat_ws(",", "event_type", F.date_format("ts", "yyyy-MM-dd"), F.col("value").cast("string"))
    parts = table(spark, sf, "events").select(F.split(line, ",").alias("p")).where(F.size("p") == 3)
    return parts.select(F.concat_ws(",", F.col("p")[0], F.col("p")[1]).alias("day"), F.col("p")[2].try_cast("double").alias("v")).groupBy("day").agg(F.count("v").alias("n"), F.max("v").alias("top"))
