"""Queries of row-level normalisation (PR-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators import normalize
from tideline.plans.tables import DAILY, daily, table

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query("""WITH c AS (SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN ' ' || p_partkey || '.xshg' WHEN 1 THEN p_partkey || '.sz' WHEN 2 THEN (100000 * (p_partkey % 10) + p_partkey % 9000)::VARCHAR WHEN 3 THEN p_partkey::VARCHAR
  WHEN 4 THEN p_partkey || '.bj' WHEN 5 THEN 'x' || p_partkey || '.Sh ' ELSE 'hk' || p_partkey END AS raw FROM part), u AS (SELECT p_partkey, upper(trim(raw)) AS t FROM c),
b AS (SELECT *, regexp_extract(t, '^(.*)[.](XSHG|XSHE|SH|SZ)$', 1) AS body, regexp_extract(t, '^(.*)[.](XSHG|XSHE|SH|SZ)$', 2) AS suffix FROM u)
SELECT p_partkey, CASE WHEN suffix <> '' THEN repeat('0', greatest(0, 6 - length(body))) || body || CASE WHEN suffix IN ('XSHG', 'SH') THEN '.SH' ELSE '.SZ' END
  WHEN NOT regexp_full_match(t, '[0-9]+') THEN t WHEN length(t) < 6 OR left(t, 1) IN ('0', '2', '3') THEN repeat('0', greatest(0, 6 - length(t))) || t || '.SZ' WHEN left(t, 1) IN ('5', '6', '9') THEN t || '.SH' ELSE t END AS symbol FROM b""")
def pr02_market_symbol(spark: SparkSession, sf: str) -> DataFrame:
    """Codes with suffixes of any spelling, and bare ones with every first digit."""
    k = F.col("p_partkey")
    text = k.cast("string")
    raw = F.when(k % 7 == 0, F.concat(F.lit(" "), text, F.lit(".xshg"))).when(k % 7 == 1, F.concat(text, F.lit(".sz"))).when(k % 7 == 2, (100000 * (k % 10) + k % 9000).cast("string")).when(k % 7 == 3, text)
    raw = raw.when(k % 7 == 4, F.concat(text, F.lit(".bj"))).when(k % 7 == 5, F.concat(F.lit("x"), text, F.lit(".Sh "))).otherwise(F.concat(F.lit("hk"), text))
    return table(spark, sf, "part").select("p_partkey", normalize.market_symbol(raw, "a_share").alias("symbol"))


@query("SELECT s_suppkey AS symbol, s_name AS name, s_nationkey AS market FROM supplier")
def pr04_aliases(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier")
    return normalize.rename_aliases(s, {"symbol": ["ts_code", "s_suppkey"], "name": ["s_name", "title"], "market": ["s_nationkey"]}, ["symbol", "name"]).select("symbol", "name", "market")


_CODES = "codes AS (SELECT l_orderkey, l_linenumber, lpad(l_suppkey::VARCHAR, 6, '0') || CASE l_linenumber % 4 WHEN 0 THEN '.SH' WHEN 1 THEN '.SZ' WHEN 2 THEN '.HK' ELSE '.BJ' END AS code, CASE WHEN l_linenumber = 5 THEN strftime(l_shipdate, '%Y-%m') ELSE strftime(l_shipdate, '%Y%m%d') END AS d FROM lineitem)"


def _codes(spark: SparkSession, sf: str) -> DataFrame:
    n, d = F.col("l_linenumber"), F.col("l_shipdate")
    suffix = F.when(n % 4 == 0, ".SH").when(n % 4 == 1, ".SZ").when(n % 4 == 2, ".HK").otherwise(".BJ")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.lpad(F.col("l_suppkey").cast("string"), 6, "0"), suffix).alias("code"), F.when(n == 5, F.date_format(d, "yyyy-MM")).otherwise(F.date_format(d, "yyyyMMdd")).alias("d"))


@query(f"WITH {_CODES} SELECT l_orderkey, l_linenumber, code, d FROM codes WHERE split_part(code, '.', 2) IN ('SH', 'SZ', 'BJ') AND length(split_part(code, '.', 1)) = 6 AND length(d) = 8")
def pr07_valid_keys(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.valid_keys(_codes(spark, sf), "code", "d")


@query("""WITH m AS (SELECT s_suppkey::VARCHAR AS code, s_suppkey || '.M' AS full_code FROM supplier WHERE s_nationkey < 10), l AS (SELECT l_orderkey, l_linenumber, l_suppkey::VARCHAR AS code FROM lineitem)
SELECT l_orderkey, l_linenumber, coalesce(full_code, CASE WHEN starts_with(l.code, '12') THEN l.code || '.B' WHEN starts_with(l.code, '1') THEN l.code || '.A' WHEN starts_with(l.code, '2') THEN l.code || '.C' END) AS resolved,
 CASE WHEN full_code IS NOT NULL THEN 'mapped' WHEN left(l.code, 1) IN ('1', '2') THEN 'prefix' ELSE 'unresolved' END AS resolution FROM l LEFT JOIN m ON m.code = l.code""")
def pr08_resolved_code(spark: SparkSession, sf: str) -> DataFrame:
    """The mapping table first, then prefixes, with a label of how."""
    code = F.col("s_suppkey").cast("string")
    m = table(spark, sf, "supplier").where("s_nationkey < 10").select(code.alias("code"), F.concat(code, F.lit(".M")).alias("full"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").cast("string").alias("line_code"))
    return normalize.resolve_code(lines, m, "line_code", {"1": ".A", "12": ".B", "2": ".C"}).drop("line_code")


@query(f"""WITH {_CODES},
c AS (SELECT DISTINCT CASE WHEN substr(code, 6, 1) = '7' THEN '688' || substr(code, 4) WHEN substr(code, 6, 1) = '3' THEN '300' || substr(code, 4) ELSE code END AS code FROM codes)
SELECT code, CASE WHEN code LIKE '%.BJ' THEN 'BSE' WHEN code LIKE '688%.SH' THEN 'STAR' WHEN code LIKE '300%.SZ' THEN 'CHINEXT' ELSE 'MAIN' END AS board FROM c""")
def pr09_board(spark: SparkSession, sf: str) -> DataFrame:
    c, last = F.col("code"), F.substring("code", 6, 1)
    code = F.when(last == "7", F.concat(F.lit("688"), F.substring(c, 4, 10))).when(last == "3", F.concat(F.lit("300"), F.substring(c, 4, 10))).otherwise(c)
    return _codes(spark, sf).select(code.alias("code")).distinct().withColumn("board", normalize.board(F.col("code")))


@query(f"WITH {DAILY} SELECT symbol, d, volume * 100 AS volume, amount * 1000 AS amount FROM daily")
def pr12_unit_profile(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.scale_units(daily(spark, sf).select("symbol", "d", "volume", "amount"), {"volume": 100.0, "amount": 1000.0})


_MINUTES = """bars AS (SELECT event_id, CASE WHEN user_id % 40 <> 0 THEN user_id END AS ticker, CASE WHEN event_id % 31 <> 0 THEN epoch(date_trunc('minute', ts))::BIGINT + CASE WHEN event_id % 29 = 0 THEN 7 ELSE 0 END END AS epoch,
 CASE WHEN event_id % 17 <> 0 THEN value END AS x, CASE WHEN event_id % 17 = 0 OR event_id % 13 = 0 THEN NULL WHEN event_id % 37 = 0 THEN 'inf'::DOUBLE WHEN event_id % 7 = 0 THEN 0 ELSE value * 2 END AS volume, CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 11 = 0 THEN -value WHEN event_id % 5 = 0 THEN 0 ELSE value END AS amount FROM events)"""


@query(f"""WITH {_MINUTES},
s AS (SELECT *, x IS NULL AND volume IS NULL AND amount IS NULL AS e, make_timestamp(epoch * 1000000) AS t FROM bars),
f AS (SELECT *, NOT e AND (x IS NULL OR volume IS NULL OR amount IS NULL) AS p, NOT e AND coalesce(isinf(volume), false) AS n, hour(t) * 100 + minute(t) AS c FROM s),
g AS (SELECT *, coalesce(NOT e AND NOT p AND NOT n AND c = 1300 AND second(t) = 0 AND volume = 0 AND amount = 0, false) AS z FROM f)
SELECT event_id, e AS is_empty, p AS partial_null, n AS non_finite, NOT e AND ticker IS NULL AS invalid_ticker, NOT e AND epoch IS NULL AS invalid_timestamp, coalesce(NOT e AND year(t) <> 2024, false) AS wrong_year, coalesce(NOT e AND epoch % 60 <> 0, false) AS non_minute,
 coalesce(NOT e AND NOT p AND NOT n AND (volume < 0 OR amount < 0), false) AS negative_flow, coalesce(NOT e AND NOT p AND NOT n AND volume = 0 AND amount > 0, false) AS zero_volume_nonzero_amount, coalesce(NOT e AND NOT p AND NOT n AND volume > 0 AND amount = 0, false) AS positive_volume_zero_amount,
 coalesce(NOT e AND NOT z AND NOT (c BETWEEN 930 AND 1130 OR c BETWEEN 1301 AND 1500), false) AS off_session,
 NOT (e OR p OR n OR z OR ticker IS NULL OR epoch IS NULL OR coalesce(year(t) <> 2024, false) OR coalesce(epoch % 60 <> 0, false) OR coalesce(volume < 0 OR amount < 0, false) OR coalesce(NOT (c BETWEEN 930 AND 1130 OR c BETWEEN 1301 AND 1500), false)) AS keep FROM g""")
def pr14_minute_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Events as minute bars with planted faults."""
    i, x = F.col("event_id"), F.col("value")
    at = F.unix_timestamp(F.date_trunc("minute", "ts")) + F.when(i % 29 == 0, 7).otherwise(0)
    e = table(spark, sf, "events").select(
        "event_id", F.when(F.col("user_id") % 40 != 0, F.col("user_id")).alias("ticker"), F.when(i % 31 != 0, at).alias("epoch"), *[F.when(i % 17 != 0, x).alias(c) for c in ("open", "high", "low", "close")],
        F.when((i % 17 == 0) | (i % 13 == 0), None).when(i % 37 == 0, float("inf")).when(i % 7 == 0, 0.0).otherwise(x * 2).alias("volume"), F.when(i % 17 == 0, None).when(i % 11 == 0, -x).when(i % 5 == 0, 0.0).otherwise(x).alias("amount"),
    )
    return normalize.minute_flags(e, 2024).select("event_id", "is_empty", "partial_null", "non_finite", "invalid_ticker", "invalid_timestamp", "wrong_year", "non_minute", "negative_flow", "zero_volume_nonzero_amount", "positive_volume_zero_amount", "off_session", "keep")


@query("""WITH h AS (SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN '自然人' WHEN 1 THEN '机构' WHEN 2 THEN ' 个人' ELSE '' END AS kind,
  CASE c_custkey % 10 WHEN 0 THEN '王小明' WHEN 1 THEN c_mktsegment || ' Fund' WHEN 2 THEN '某某投资' WHEN 3 THEN c_mktsegment || ' QFII' WHEN 4 THEN '国有资产管理委员会' WHEN 5 THEN '养老金计划' WHEN 6 THEN c_name || ' Ltd' WHEN 7 THEN '' WHEN 8 THEN '中央汇金' ELSE c_name END AS name FROM customer)
SELECT c_custkey, CASE WHEN trim(kind) IN ('个人', '自然人') THEN false WHEN kind <> '' THEN true WHEN name = '' OR regexp_full_match(name, '[一-鿿]{1,4}') THEN false ELSE
  regexp_matches(lower(name), '公司|集团|有限|银行|基金|保险|证券|信托|资管|资产|投资|社保|汇金|证金|国有|财政|中央|合伙|计划|qfii|llc|ltd|limited|inc') END AS institution FROM h""")
def pr22_institutions(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    kind = F.when(k % 7 == 0, "自然人").when(k % 7 == 1, "机构").when(k % 7 == 2, " 个人").otherwise("")
    name = F.when(k % 10 == 0, "王小明").when(k % 10 == 1, F.concat("c_mktsegment", F.lit(" Fund"))).when(k % 10 == 2, "某某投资").when(k % 10 == 3, F.concat("c_mktsegment", F.lit(" QFII")))
    name = name.when(k % 10 == 4, "国有资产管理委员会").when(k % 10 == 5, "养老金计划").when(k % 10 == 6, F.concat("c_name", F.lit(" Ltd"))).when(k % 10 == 7, "").when(k % 10 == 8, "中央汇金").otherwise(F.col("c_name"))
    return table(spark, sf, "customer").select("c_custkey", normalize.is_institution(name, kind).alias("institution"))


@query("SELECT o_orderkey, coalesce(regexp_matches(lower(o_orderpriority), 'urgent|high'), false) AS buy FROM orders")
def pr23_buy_rating(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", normalize.is_buy_rating(F.col("o_orderpriority"), ("urgent", "high")).alias("buy"))


@query("""WITH l AS (SELECT event_id, CASE WHEN value > 20 THEN 'exclude' ELSE 'tag' END AS decision FROM events WHERE event_type = 'purchase' OR value > 20)
SELECT e.event_id, e.user_id AS symbol, e.value AS price, coalesce(decision, 'keep') AS decision FROM events e LEFT JOIN l USING (event_id) WHERE coalesce(decision, 'keep') <> 'exclude'""")
def pr25_canonical_ticks(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    labels = e.where("event_type = 'purchase' OR value > 20").select("event_id", F.when(F.col("value") > 20, "exclude").otherwise("tag").alias("decision"))
    return normalize.canonical_ticks(e, {"symbol": ["ticker", "user_id"], "price": ["Price", "value"]}, labels, "event_id", ["exclude"])


@query("""WITH k AS (SELECT s_suppkey AS code, 'id:' || s_name AS identity FROM supplier WHERE s_nationkey < 15), o AS (SELECT s_suppkey AS code, 'old:' || s_suppkey AS identity FROM supplier WHERE s_nationkey % 4 = 0)
SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN l_shipdate::DATE BETWEEN DATE '1995-01-01' AND DATE '1996-06-30' THEN o.identity END, k.identity, 'unresolved:' || l_suppkey) AS identity FROM lineitem LEFT JOIN k ON k.code = l_suppkey LEFT JOIN o ON o.code = l_suppkey""")
def pr26_identity(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").withColumn("code", F.col("s_suppkey"))
    known = s.where("s_nationkey < 15").select("code", F.concat(F.lit("id:"), "s_name").alias("identity"))
    dated = s.where("s_nationkey % 4 = 0").select("code", F.lit("1995-01-01").cast("date").alias("from_date"), F.lit("1996-06-30").cast("date").alias("to_date"), F.concat(F.lit("old:"), F.col("code").cast("string")).alias("identity"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.to_date("l_shipdate").alias("d"))
    return normalize.research_identity(lines, "l_suppkey", "d", known, dated).select("l_orderkey", "l_linenumber", "identity")


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN s_nationkey < 5 AND l_shipdate::DATE < DATE '1996-01-01' + s_nationkey::INT THEN 100000 + l_suppkey ELSE l_suppkey END AS active_code FROM lineitem JOIN supplier ON s_suppkey = l_suppkey""")
def pr27_dated_code(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").where("s_nationkey < 5").select(F.col("s_suppkey").alias("new_code"), (100000 + F.col("s_suppkey")).alias("old_code"), F.date_add(F.lit("1996-01-01").cast("date"), F.col("s_nationkey").cast("int")).alias("first_day"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey"), F.to_date("l_shipdate").alias("d"))
    return normalize.dated_code(lines, "l_suppkey", "d", s).select("l_orderkey", "l_linenumber", "active_code")


@query("""SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN lpad(c_custkey::VARCHAR, 6, '0') || '1.SZ' WHEN 1 THEN lpad(c_custkey::VARCHAR, 5, '0') || '!1.SH' WHEN 2 THEN lpad(c_custkey::VARCHAR, 6, '0') || '!2.SH' ELSE lpad(c_custkey::VARCHAR, 6, '0') || '.SZ' END AS key, c_custkey % 7 = 0 AS repaired FROM customer""")
def pr28_join_key(spark: SparkSession, sf: str) -> DataFrame:
    """Only six digits and the mark !1 are repaired."""
    k, code, short = F.col("c_custkey"), F.lpad(F.col("c_custkey").cast("string"), 6, "0"), F.lpad(F.col("c_custkey").cast("string"), 5, "0")
    raw = F.when(k % 7 == 0, F.concat(code, F.lit("!1.sz"))).when(k % 7 == 1, F.concat(short, F.lit("!1.sh"))).when(k % 7 == 2, F.concat(code, F.lit("!2.sh"))).otherwise(F.concat(F.lit(" "), code, F.lit(".sz")))
    key, repaired = normalize.repair_join_key(raw)
    return table(spark, sf, "customer").select("c_custkey", key.alias("key"), repaired.alias("repaired"))


@query(f"""WITH {DAILY},
s AS (SELECT s_suppkey AS symbol, CASE WHEN s_nationkey % 3 = 0 THEN NULL ELSE DATE '1995-01-01' END AS a, CASE WHEN s_nationkey % 4 = 0 THEN NULL ELSE DATE '1997-12-31' END AS z FROM supplier WHERE s_nationkey < 22)
SELECT symbol, d, close FROM daily SEMI JOIN s ON s.symbol = daily.symbol AND (a IS NULL OR d >= a) AND (z IS NULL OR d <= z)""")
def pr29_validity_spans(spark: SparkSession, sf: str) -> DataFrame:
    n, day = F.col("s_nationkey"), lambda x: F.lit(x).cast("date")
    s = table(spark, sf, "supplier").where("s_nationkey < 22").select(F.col("s_suppkey").alias("symbol"), F.when(n % 3 != 0, day("1995-01-01")).alias("start"), F.when(n % 4 != 0, day("1997-12-31")).alias("end"))
    return normalize.within_spans(daily(spark, sf).select("symbol", "d", "close"), s, "symbol", "d")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def pr30_overlay_columns(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.pick_columns(table(spark, sf, "customer"), ["c_custkey"], ["c_name", "c_acctbal", "c_rating"])


@query(f"""WITH {DAILY} SELECT symbol, d, coalesce(CASE WHEN n_trades > 1 THEN amount END, 0)::DOUBLE AS hot, 999::DOUBLE AS days_since, coalesce(CASE WHEN volume > 20 THEN close END, 999)::DOUBLE AS last_price FROM daily""")
def pr33_filled_columns(spark: SparkSession, sf: str) -> DataFrame:
    y = daily(spark, sf).select("symbol", "d", F.when(F.col("n_trades") > 1, F.col("amount")).alias("hot"), F.when(F.col("volume") > 20, F.col("close")).alias("last_price"), "high")
    return normalize.filled(y, ["symbol", "d"], {"hot": 0, "days_since": 999, "last_price": 999})


@query("""WITH r AS (SELECT user_id, date_trunc('minute', ts) AS t, event_id, CASE WHEN value >= 1 THEN replace(format('{:t,}', (value * 1000)::BIGINT), 't', '') END AS x, value FROM events),
o AS (SELECT *, row_number() OVER (PARTITION BY user_id, t ORDER BY event_id DESC) AS k FROM r)
SELECT user_id AS code, t AS trade_time, CASE WHEN value >= 1 THEN (value * 1000)::BIGINT::DOUBLE END AS amount, NULL::DOUBLE AS volume FROM o WHERE k = 1 AND strftime(t, '%H:%M') BETWEEN '09:30' AND '15:00'""".replace("replace(format('{:t,}', (value * 1000)::BIGINT), 't', '')", "value::VARCHAR"))
def pr34_renamed_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers with separators, a column that the source lacks, the last row of a minute, session times only."""
    x = F.when(F.col("value") >= 1, F.format_number(F.rint(F.col("value") * 1000), 0))
    raw = table(spark, sf, "events").select("user_id", F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("t"), "event_id", x.alias("money"))
    out = normalize.renamed_bars(raw, {"code": "user_id", "trade_time": "t", "amount": "money", "volume": "vol"}, ["amount", "volume"], "code", "trade_time", "09:30", "15:00", [F.desc("event_id")])
    return out.select("code", "trade_time", "amount", "volume")
