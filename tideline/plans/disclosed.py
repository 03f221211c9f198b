"""Queries of disclosures over time (PT-*): orders stand for statements, their customers for companies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators import disclosures, gates, windows
from tideline.plans.tables import rounded, table

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_RAW = """raw AS (SELECT o_orderkey AS id, lpad(o_custkey::VARCHAR, 6, '0') || '.SH' AS ts_code, strftime(last_day((date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH)::DATE), '%Y%m%d') AS end_date, CASE WHEN o_orderkey % 7 <> 0 THEN strftime(o_orderdate, '%Y%m%d') END AS ann_date,
 CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate + INTERVAL 3 DAY, '%Y%m%d') END AS f_ann_date, CASE WHEN o_orderpriority = '2-HIGH' THEN '5' WHEN o_orderpriority = '5-LOW' THEN '4' ELSE '1' END AS report_type, CASE WHEN o_orderstatus = 'F' THEN '1' WHEN o_orderstatus = 'P' THEN 'x' ELSE '0' END AS update_flag,
 CASE WHEN o_custkey % 5 = 0 THEN '2' ELSE '1' END AS comp_type, CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS revenue, o_totalprice * 2 AS profit FROM orders),
events AS (SELECT *, strptime(end_date, '%Y%m%d')::DATE AS report_period, coalesce(strptime(f_ann_date, '%Y%m%d'), strptime(ann_date, '%Y%m%d'))::DATE AS available_date FROM raw WHERE coalesce(f_ann_date, ann_date) IS NOT NULL)"""


def raw(spark: SparkSession, sf: str) -> DataFrame:
    k, d, p, s = F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_orderpriority"), F.col("o_orderstatus")
    end = F.last_day(F.add_months(F.date_trunc("quarter", d), 2))
    return table(spark, sf, "orders").select(
        k.alias("id"), F.concat(F.lpad(F.col("o_custkey").cast("string"), 6, "0"), F.lit(".SH")).alias("ts_code"), F.date_format(end, "yyyyMMdd").alias("end_date"), F.when(k % 7 != 0, F.date_format(d, "yyyyMMdd")).alias("ann_date"),
        F.when(k % 3 == 0, F.date_format(F.date_add(d, 3), "yyyyMMdd")).alias("f_ann_date"), F.when(p == "2-HIGH", "5").when(p == "5-LOW", "4").otherwise("1").alias("report_type"), F.when(s == "F", "1").when(s == "P", "x").otherwise("0").alias("update_flag"),
        F.when(F.col("o_custkey") % 5 == 0, "2").otherwise("1").alias("comp_type"), F.when(k % 4 != 0, F.col("o_totalprice")).alias("revenue"), (F.col("o_totalprice") * 2).alias("profit"),
    )


def events(spark: SparkSession, sf: str) -> DataFrame:
    return disclosures.announcement_events(raw(spark, sf), "income").withColumn("symbol", F.col("ts_code"))


@query(f"WITH {_RAW} SELECT id, ts_code, report_period, available_date, (SELECT count(*) FROM events)::BIGINT AS n_events FROM events")
def pt08_announcement_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with their availability; as many different event ids as rows show that nothing is collapsed."""
    e = events(spark, sf)
    n = e.agg(F.countDistinct("event_id").alias("n_events"))  # one row
    return e.select("id", "ts_code", "report_period", "available_date").join(F.broadcast(n))


def _as_of_sql(types: str, keys: str) -> str:
    return f"""WITH {_RAW} SELECT id, ts_code, report_period, report_type, available_date FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY available_date DESC, coalesce(TRY_CAST(update_flag AS DOUBLE), -1) DESC, id DESC) AS n FROM events WHERE available_date <= DATE '1999-06-30'{types}) WHERE n = 1"""


def _as_of(spark: SparkSession, sf: str, policy: str) -> DataFrame:
    return disclosures.announced_as_of(events(spark, sf), F.lit("1999-06-30").cast("date"), policy, order="id").select("id", "ts_code", "report_period", "report_type", "available_date")


@query(_as_of_sql(" AND report_type = '1'", "ts_code, report_period"))
def pt09_standard_as_of(spark: SparkSession, sf: str) -> DataFrame:
    return _as_of(spark, sf, "standard")


@query(_as_of_sql(" AND report_type IN ('1', '5')", "ts_code, report_period, report_type"))
def pt09_diagnostic_as_of(spark: SparkSession, sf: str) -> DataFrame:
    return _as_of(spark, sf, "diagnostic_including_type5")


@query(_as_of_sql("", "ts_code, report_period, report_type"))
def pt09_native_as_of(spark: SparkSession, sf: str) -> DataFrame:
    return _as_of(spark, sf, "dataset_native")


@query(f"""WITH {_RAW},
a AS (SELECT ts_code, report_period, arg_max(revenue, id) AS income_revenue, max(available_date) AS t FROM events WHERE report_type = '1' AND revenue IS NOT NULL GROUP BY 1, 2),
b AS (SELECT ts_code, report_period, arg_max(profit, id) AS cash_profit, max(available_date) AS t FROM events WHERE report_type <> '1' GROUP BY 1, 2)
SELECT a.ts_code AS symbol, a.report_period, income_revenue, cash_profit, greatest(a.t, b.t) AS available_date FROM a JOIN b USING (ts_code, report_period) WHERE month(report_period) = 12""")
def pt10_component_panel(spark: SparkSession, sf: str) -> DataFrame:
    """PT-10 and JN-17: two components joined one to one, annual periods only."""
    e = events(spark, sf)
    part = lambda df, c: df.groupBy("symbol", "report_period").agg(F.max_by(c, "id").alias(c), F.max("available_date").alias("available_date"))
    parts = {"income": part(e.where("report_type = '1' AND revenue IS NOT NULL"), "revenue"), "cash": part(e.where("report_type <> '1'"), "profit")}
    return disclosures.annual_only(disclosures.component_panel(parts, ["symbol", "report_period"], {"income": ["revenue"], "cash": ["profit"]}))


@query(f"""WITH {_RAW},
k AS (SELECT *, max(update_flag) OVER (PARTITION BY ts_code, report_period) AS m FROM events WHERE report_type IN ('1', '5') AND comp_type = '1'),
n AS (SELECT *, max(available_date) OVER (PARTITION BY ts_code, report_period) AS t FROM k WHERE update_flag = m),
l AS (SELECT * FROM n WHERE available_date = t)
SELECT ts_code, report_period, count(DISTINCT (coalesce(revenue, -1), profit)) > 1 AS ambiguous FROM l GROUP BY 1, 2""")
def pt11_normalized(spark: SparkSession, sf: str) -> DataFrame:
    out = disclosures.normalized_fundamentals(events(spark, sf), ["ts_code", "report_period"], ["revenue", "profit"], report_types=["1", "5"], templates=["1"], revision=["update_flag", "available_date"])
    return out.select("ts_code", "report_period", "ambiguous")


@query(f"WITH {_RAW} SELECT count(*) AS n_read, count(*) FILTER (WHERE report_type NOT IN ('1', '5')) AS n_report_type, count(*) FILTER (WHERE report_type IN ('1', '5') AND comp_type <> '1') AS n_template FROM raw")
def pt11_drop_counters(spark: SparkSession, sf: str) -> DataFrame:
    return disclosures.drop_counters(raw(spark, sf), report_types=["1", "5"], templates=["1"])


@query(f"""WITH {_RAW} SELECT ts_code, available_date, arg_max(revenue, id) FILTER (WHERE revenue IS NOT NULL) AS revenue, arg_max(profit, id) FILTER (WHERE profit IS NOT NULL) AS profit, string_agg(report_type || ':' || id, '+' ORDER BY id) AS sources FROM events GROUP BY 1, 2""")
def pt12_coalesced_sources(spark: SparkSession, sf: str) -> DataFrame:
    """PT-12 and AG-34: one row a company and day from all its statements, in order of their numbers."""
    e = events(spark, sf).withColumn("source", F.concat_ws(":", "report_type", F.col("id").cast("string")))
    return disclosures.coalesce_sources(e, ["ts_code", "available_date"], ["revenue", "profit"], "id", "source")


_STATE = ", ".join(
    f"arg_max({x}, o) FILTER (WHERE {f} IS NOT NULL) AS {f}{s}"
    for f in ("revenue", "profit")
    for x, s in ((f, ""), ("report_period", "_report_period"), ("available_date", "_available_date"), ("coalesce(ann_date, '')", "_ann_date"), ("coalesce(f_ann_date, '')", "_f_ann_date"), ("report_type", "_report_type"), ("update_flag", "_update_flag"), ("comp_type", "_comp_type"), ("end_date", "_end_date"), ("id", "_id"))
)


@query(f"""WITH {_RAW}, e AS (SELECT *, report_period::VARCHAR || available_date::VARCHAR || lpad(id::VARCHAR, 12, '0') AS o FROM events WHERE available_date <= DATE '1999-06-30')
SELECT ts_code, {_STATE}, date_diff('day', arg_max(report_period, o) FILTER (WHERE revenue IS NOT NULL), max(report_period)) AS revenue_age, date_diff('day', arg_max(report_period, o) FILTER (WHERE profit IS NOT NULL), max(report_period)) AS profit_age FROM e GROUP BY 1""")
def pt14_field_provenance(spark: SparkSession, sf: str) -> DataFrame:
    """Each field's value with what is known of the event it came from, and its age."""
    told = ["report_period", "available_date", "ann_date", "f_ann_date", "report_type", "update_flag", "comp_type", "end_date", "id"]
    seen = events(spark, sf).where("available_date <= DATE '1999-06-30'").withColumns({c: F.coalesce(c, F.lit("")) for c in ("ann_date", "f_ann_date")})
    out = disclosures.field_state_with_provenance(seen, "ts_code", ["revenue", "profit"], ["report_period", "available_date", "id"], told)
    return out.withColumns({f"{f}_age": F.col(f"{f}_age").cast("long") for f in ("revenue", "profit")})


@query(f"""WITH {_RAW},
s AS (SELECT unnest(['1', '4', '5', '9']) AS source),
d AS (SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS d FROM orders),
v AS (SELECT report_type AS source, available_date AS t FROM events WHERE month(available_date) <> 6)
SELECT source, d, max(t) AS vintage, date_diff('day', max(t), d) AS age, CASE WHEN max(t) IS NULL THEN 'missing' WHEN date_diff('day', max(t), d) > 2 THEN 'stale' ELSE 'fresh' END AS state FROM s CROSS JOIN d LEFT JOIN v USING (source) WHERE t IS NULL OR t <= d GROUP BY 1, 2
UNION ALL SELECT source, d, NULL, NULL, 'missing' FROM s CROSS JOIN d WHERE EXISTS (SELECT 1 FROM v WHERE v.source = s.source) AND NOT EXISTS (SELECT 1 FROM v WHERE v.source = s.source AND t <= d)""")
def pt16_freshness(spark: SparkSession, sf: str) -> DataFrame:
    """A bundle's sources on each month's first day."""
    v = events(spark, sf).where(F.month("available_date") != 6).select(F.col("report_type").alias("source"), F.col("available_date").alias("vintage"))
    sources = spark.createDataFrame([("1",), ("4",), ("5",), ("9",)], "source string")
    dates = table(spark, sf, "orders").select(F.to_date(F.date_trunc("month", "o_orderdate")).alias("d")).distinct()
    return disclosures.freshness(v, sources, dates, "source", "vintage", "d", 2).withColumn("age", F.col("age").cast("long"))


@query(f"""WITH {_RAW},
c AS (SELECT count(*) AS n_rows, count(*) FILTER (WHERE available_date < report_period) AS early, count(*) FILTER (WHERE k > 1) AS twice FROM (SELECT *, count(*) OVER (PARTITION BY ts_code, report_period) AS k FROM events))
SELECT unnest(['null_key', 'disclosed_before_period', 'available_before_disclosed', 'duplicate_key']) AS "check", 'error' AS severity, unnest([0, early, 0, twice]) AS n_bad, n_rows FROM c""")
def pt17_pit_checks(spark: SparkSession, sf: str) -> DataFrame:
    e = events(spark, sf).withColumn("disclosed", F.col("available_date"))
    checks = disclosures.pit_checks(e.columns, ["ts_code", "report_period"], "report_period", "disclosed", "available_date")
    marked = e.select(*[c.alias(n) for n, (_, c) in checks.items()])
    return gates.check_table(marked, {n: (s, F.col(n)) for n, (s, _) in checks.items()})


@query(f"""WITH {_RAW},
o AS (SELECT e.id, greatest(strptime(coalesce(ann_date, f_ann_date), '%Y%m%d')::DATE, strptime(coalesce(f_ann_date, ann_date), '%Y%m%d')::DATE) AS disclosed, (o_orderdate + INTERVAL 20 HOUR + INTERVAL 8 HOUR)::DATE AS seen FROM events e JOIN orders ON o_orderkey = e.id)
SELECT id, (greatest(disclosed, seen) + 1)::DATE AS available_from FROM o""")
def pt18_version_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Statements that were observed in the evening (UTC), so on the next day in China."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(hours=F.lit(20))).alias("observed_at"))
    rows = raw(spark, sf).where("coalesce(f_ann_date, ann_date) IS NOT NULL").join(o, "id")
    return disclosures.version_ledger(rows, "observed_at", "Asia/Shanghai", 1).select("id", "available_from")


_CONFLICT = f"""{_RAW},
g AS (SELECT ts_code, report_period, count(DISTINCT report_type) AS n_categories, concat_ws(',', CASE WHEN count(DISTINCT coalesce(revenue, -1)) > 1 THEN 'revenue' END, CASE WHEN count(DISTINCT profit) > 1 THEN 'profit' END) AS fields FROM events GROUP BY 1, 2),
c AS (SELECT * FROM g WHERE n_categories > 1)"""


@query(f"WITH {_CONFLICT} SELECT * FROM c")
def pt20_category_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return disclosures.category_conflicts(events(spark, sf), ["ts_code", "report_period"], "report_type", ["revenue", "profit"])


@query(f"""WITH {_CONFLICT}, d AS (SELECT DISTINCT ts_code, report_period, CASE WHEN substr(ts_code, 6, 1) = '3' THEN '9' ELSE '1' END AS chosen FROM events WHERE substr(ts_code, 6, 1) <> '7'),
j AS (SELECT coalesce(c.ts_code, d.ts_code) AS ts_code, coalesce(c.report_period, d.report_period) AS report_period, c.ts_code IS NOT NULL AS o, chosen, EXISTS (SELECT 1 FROM events e WHERE e.ts_code = d.ts_code AND e.report_period = d.report_period AND e.report_type = d.chosen) AS has FROM c FULL JOIN d ON c.ts_code = d.ts_code AND c.report_period = d.report_period)
SELECT ts_code, report_period, CASE WHEN NOT o THEN 'needless' WHEN chosen IS NULL THEN 'undecided' WHEN NOT has THEN 'chosen_absent' END AS error FROM j WHERE NOT o OR chosen IS NULL OR NOT has""")
def pt20_decision_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Decisions that take category 1; some are lacking, some choose what is not there, some are needless."""
    e = events(spark, sf)
    last = F.substring("ts_code", 6, 1)
    decisions = e.where(last != "7").select("ts_code", "report_period", F.when(last == "3", "9").otherwise("1").alias("chosen")).distinct()
    conflicts = disclosures.category_conflicts(e, ["ts_code", "report_period"], "report_type", ["revenue"])
    return disclosures.decided(e, conflicts, decisions, ["ts_code", "report_period"], "report_type")[1]


_CONSENSUS = f"""{_RAW},
f AS (SELECT ts_code, report_period, count(*) AS n_versions, max(available_date) AS usable_at, count(DISTINCT coalesce(update_flag, '?')) = 1 AND count(DISTINCT report_type) = 1 AS agreed, CASE WHEN count(DISTINCT update_flag) = 1 THEN max(update_flag) END AS update_flag, CASE WHEN count(DISTINCT report_type) = 1 THEN max(report_type) END AS report_type FROM events GROUP BY 1, 2)"""


@query(f"WITH {_CONSENSUS} SELECT * FROM f")
def pt21_field_consensus(spark: SparkSession, sf: str) -> DataFrame:
    return disclosures.field_consensus(events(spark, sf), ["ts_code", "report_period"], ["update_flag", "report_type"], "available_date")


@query(f"""WITH {_RAW},
v AS (SELECT ts_code, report_period, min(report_type) AS report_type, max(available_date) + 30 AS evidence_at FROM events GROUP BY 1, 2),
w AS (SELECT ts_code, report_period, CASE WHEN substr(ts_code, 6, 1) = '2' THEN '8' ELSE report_type END AS report_type, evidence_at FROM v),
r AS (SELECT w.*, (SELECT min(available_date) FROM events e WHERE e.ts_code = w.ts_code AND e.report_period = w.report_period AND e.report_type = w.report_type) AS u FROM w)
SELECT ts_code, report_period, CASE WHEN u IS NOT NULL AND greatest(evidence_at, u) <= DATE '1999-06-30' THEN report_type END AS report_type FROM r""")
def pt22_adjudicated(spark: SparkSession, sf: str) -> DataFrame:
    """Evidence for a field's value; the value is hidden before it is usable."""
    e, keys = events(spark, sf), ["ts_code", "report_period"]
    v = e.groupBy(*keys).agg(F.min("report_type").alias("report_type"), F.date_add(F.max("available_date"), 30).alias("evidence_at"))
    v = v.withColumn("report_type", F.when(F.substring("ts_code", 6, 1) == "2", "8").otherwise(F.col("report_type")))
    return disclosures.resolved_as_of(disclosures.adjudicate(e, v, keys, "report_type", "available_date"), keys, "report_type", F.lit("1999-06-30").cast("date"))


@query(f"""WITH {_CONSENSUS}, a AS (SELECT DISTINCT ts_code, report_period FROM f UNION ALL SELECT DISTINCT ts_code, DATE '1901-03-31' FROM f)
SELECT a.ts_code, a.report_period, CASE WHEN f.ts_code IS NULL THEN 'out_of_scope' WHEN usable_at > DATE '1999-06-30' THEN 'not_yet' WHEN NOT agreed THEN 'conflict' ELSE 'available' END AS status, CASE WHEN usable_at <= DATE '1999-06-30' AND agreed THEN report_type END AS report_type FROM a LEFT JOIN f ON a.ts_code = f.ts_code AND a.report_period = f.report_period""")
def pt23_exact_read(spark: SparkSession, sf: str) -> DataFrame:
    e, keys = events(spark, sf), ["ts_code", "report_period"]
    f = disclosures.field_consensus(e, keys, ["update_flag", "report_type"], "available_date")
    asked = e.select(*keys).distinct().union(e.select("ts_code", F.lit("1901-03-31").cast("date")).distinct())
    return disclosures.exact_read(asked, f, keys, F.lit("1999-06-30").cast("date"), "report_type")


_OBS = """obs AS (SELECT 's' || o_custkey % 40 AS series_id, 'v' || o_orderkey % 997 AS vintage_id, o_orderkey AS id, o_orderdate AS t, o_orderkey % 11 = 0 AS a, o_orderkey % 13 = 0 AS b, o_orderkey % 17 = 0 AS c, o_orderkey % 19 = 0 AS d, o_orderkey % 23 = 0 AS e FROM orders)"""


@query(f"""WITH {_OBS},
n AS (SELECT count(*) FILTER (WHERE e) AS bad_time, 0 AS no_series, count(*) FILTER (WHERE d) AS not_finite, 0 AS bad_flag, (SELECT coalesce(sum(k), 0) FROM (SELECT count(*) AS k FROM obs GROUP BY series_id, t, vintage_id HAVING count(*) > 1))::BIGINT AS duplicate, count(*) FILTER (WHERE b) AS period_order,
 count(*) FILTER (WHERE c) AS bad_revision, count(*) FILTER (WHERE a AND c) AS bad_hash, count(*) FILTER (WHERE a AND NOT e) AS retrieved_early, count(*) FILTER (WHERE d) AS available_early, count(*) FILTER (WHERE b AND a) AS covered_reconstruction FROM obs)
SELECT unnest(['bad_time', 'no_series', 'not_finite', 'bad_flag', 'duplicate', 'period_order', 'bad_revision', 'bad_hash', 'retrieved_early', 'available_early', 'covered_reconstruction']) AS rule, unnest([bad_time, no_series, not_finite, bad_flag, duplicate, period_order, bad_revision, bad_hash, retrieved_early, available_early, covered_reconstruction]) AS n_bad FROM n""")
def pt04_observation_faults(spark: SparkSession, sf: str) -> DataFrame:
    """Context observations with planted faults."""
    k, t = F.col("o_orderkey"), F.col("o_orderdate")
    a, b, c, d, e = (k % m == 0 for m in (11, 13, 17, 19, 23))
    later = lambda n: F.date_add(t, n).cast("timestamp_ntz")
    obs = table(spark, sf, "orders").select(
        F.concat(F.lit("s"), (F.col("o_custkey") % 40).cast("string")).alias("series_id"), F.concat(F.lit("v"), (k % 997).cast("string")).alias("vintage_id"), F.when(b, later(1)).otherwise(later(-30)).alias("period_start"), t.alias("period_end"),
        later(2).alias("published_at"), F.when(~e, later(3)).alias("observed_at"), later(9).alias("ingested_at"), F.when(a, later(2)).otherwise(later(4)).alias("source_retrieved_at"), F.when(d, later(1)).otherwise(later(5)).alias("available_at"),
        F.when(d, float("inf")).otherwise(1.0).alias("value"), F.when(c, -1).otherwise(0).alias("revision_number"), a.alias("revision_covered"), b.alias("reconstructed"), F.when(a & c, "zz").otherwise(F.sha2(k.cast("string"), 256)).alias("source_hash"),
    )
    return disclosures.observation_faults(obs)


_WIDE = """wide AS (SELECT strftime(o_orderdate, '%Y%m') AS p, CASE WHEN month(o_orderdate) <> 4 THEN count(*)::DOUBLE END AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, month(o_orderdate)),
obs AS (SELECT series, strptime(p || '01', '%Y%m%d')::DATE AS period_start, last_day(strptime(p || '01', '%Y%m%d')::DATE) AS period_end, value FROM (SELECT p, 'n' AS series, n AS value FROM wide UNION ALL SELECT p, 'total', total FROM wide) WHERE value IS NOT NULL)"""


def _observations(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("o_orderdate")
    wide = table(spark, sf, "orders").groupBy(F.date_format(d, "yyyyMM").alias("p"), F.month(d).alias("m")).agg(F.count("*").alias("k"), F.sum("o_totalprice").alias("t"))
    wide = wide.select("p", F.when(F.col("m") != 4, F.col("k").cast("double")).alias("n"), F.round("t", 2).alias("total"))
    return disclosures.wide_to_observations(wide, "p", ["n", "total"], "month")


@query(f"WITH {_WIDE} SELECT series, period_start, period_end, value FROM obs")
def pt05_observations(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_observations(spark, sf), "value", digits=2)


@query(f"""WITH {_WIDE},
cal AS (SELECT DISTINCT 'n' AS series, l_shipdate::DATE AS publish_date FROM lineitem WHERE dayofmonth(l_shipdate) = 16 UNION SELECT DISTINCT 'total', l_shipdate::DATE FROM lineitem WHERE dayofmonth(l_shipdate) = 28 AND month(l_shipdate) % 6 = 0),
r AS (SELECT o.series, o.period_end, min(publish_date + INTERVAL 1 DAY - INTERVAL 8 HOUR) AS release_at FROM obs o JOIN cal c ON c.series = o.series AND publish_date + INTERVAL 1 DAY - INTERVAL 8 HOUR > o.period_end AND publish_date + INTERVAL 1 DAY - INTERVAL 8 HOUR <= o.period_end + INTERVAL 120 DAY GROUP BY 1, 2)
SELECT o.series, o.period_end, strftime(release_at, '%Y-%m-%d %H:%M') AS release_at, coalesce(o.period_end + INTERVAL 18 DAY >= release_at AND o.period_end + INTERVAL 18 DAY - release_at <= INTERVAL 3 DAY, false) AS observed FROM obs o LEFT JOIN r ON o.series = r.series AND o.period_end = r.period_end""")
def pt06_release(spark: SparkSession, sf: str) -> DataFrame:
    """PT-06 and PT-07: release times from a calendar of publish dates in local time, and whether retrieval was timely."""
    d = F.to_date("l_shipdate")
    days = table(spark, sf, "lineitem").select(d.alias("publish_date")).distinct()
    cal = days.where(F.dayofmonth("publish_date") == 16).select(F.lit("n").alias("series"), "publish_date").union(days.where((F.dayofmonth("publish_date") == 28) & (F.month("publish_date") % 6 == 0)).select(F.lit("total"), "publish_date"))
    obs = _observations(spark, sf).withColumn("retrieved_at", F.date_add("period_end", 18).cast("timestamp"))
    return disclosures.released(obs, cal, "Asia/Shanghai").select("series", "period_end", F.date_format("release_at", "yyyy-MM-dd HH:mm").alias("release_at"), "observed")


_HELD = """held AS (SELECT l_suppkey AS symbol, date_trunc('quarter', l_shipdate)::DATE AS period, sum(l_quantity) AS amount FROM lineitem GROUP BY 1, 2),
val AS (SELECT s_suppkey AS symbol, period, CASE WHEN s_nationkey = 3 THEN 0 ELSE 1 + s_nationkey + year(period) / 100.0 END::DOUBLE AS share FROM supplier, (SELECT DISTINCT period FROM held WHERE month(period) <> 7))"""


@query(f"""WITH {_HELD},
r AS (SELECT symbol, period, CASE WHEN share > 0 THEN amount / (share * 10000) END AS ratio FROM held LEFT JOIN val USING (symbol, period))
SELECT symbol, period, round(ratio, 9) AS ratio, round(ratio - lag(ratio) OVER (PARTITION BY symbol ORDER BY period), 9) AS ratio_change FROM r""")
def pt25_float_ratios(spark: SparkSession, sf: str) -> DataFrame:
    held = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("symbol"), F.to_date(F.date_trunc("quarter", "l_shipdate")).alias("period")).agg(F.sum("l_quantity").alias("amount"))
    n = F.col("s_nationkey")
    periods = held.select("period").distinct().where(F.month("period") != 7).agg(F.collect_set("period").alias("p"))  # one array of quarters
    val = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("symbol"), "s_nationkey").join(F.broadcast(periods)).select("symbol", "s_nationkey", F.explode("p").alias("period"))
    val = val.select("symbol", "period", F.when(n == 3, 0.0).otherwise(1 + n + F.year("period") / F.lit(100.0)).alias("share"))
    return rounded(disclosures.to_float_ratios(held, val, ["symbol", "period"], "amount", "share").select("symbol", "period", "ratio", "ratio_change"), "ratio", "ratio_change", digits=9)


_CHANGES = """names AS (SELECT symbol, start_date, name FROM (SELECT o_custkey AS symbol, o_orderdate::DATE AS start_date, o_orderpriority AS name, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS n FROM orders) WHERE n = 1),
"""
_OPEN = "cal AS (SELECT DISTINCT l_shipdate::DATE AS d FROM lineitem WHERE dayofweek(l_shipdate) BETWEEN 1 AND 5)"
_NAMES = _CHANGES + "cal AS (SELECT DISTINCT l_shipdate::DATE AS d FROM lineitem WHERE dayofweek(l_shipdate) BETWEEN 1 AND 5 AND dayofmonth(l_shipdate) <= 4)"


def _names(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Names by the day they begin on, and every open day."""
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("symbol"), F.to_date("o_orderdate").alias("start_date"), F.col("o_orderpriority").alias("name"), "o_orderkey")
    cal = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("d")).distinct().where(F.dayofweek("d").between(2, 6))
    return windows.keep_one(o, ["symbol", "start_date"], [F.desc("o_orderkey")]).drop("o_orderkey"), cal


@query(f"""WITH {_NAMES},
i AS (SELECT *, (lead(start_date) OVER (PARTITION BY symbol ORDER BY start_date) - 1)::DATE AS e FROM names)
SELECT symbol, d, arg_max(name, start_date) AS name FROM i JOIN cal ON d >= start_date AND (e IS NULL OR d <= e) WHERE name IN ('1-URGENT', '2-HIGH') GROUP BY 1, 2""")
def pt26_status_history(spark: SparkSession, sf: str) -> DataFrame:
    """Status days from name changes: each name holds until the next."""
    changes, cal = _names(spark, sf)
    return disclosures.status_history(changes, cal.where(F.dayofmonth("d") <= 4), "symbol", "start_date", "name", "URGENT|HIGH", "d")


@query(f"""WITH {_CHANGES}{_OPEN},
s AS (SELECT symbol, start_date, name, CASE WHEN symbol % 4 <> 0 THEN (start_date + 200)::DATE END AS e FROM names)
SELECT symbol, d, arg_max(name, start_date) AS name FROM s JOIN cal ON d >= start_date AND (e IS NULL OR d <= e) GROUP BY 1, 2""")
def jn05_expand_to_the_end(spark: SparkSession, sf: str) -> DataFrame:
    """Intervals of their own length, some of them open, over a calendar; the latest start wins."""
    changes, cal = _names(spark, sf)
    spans = changes.withColumn("end_date", F.when(F.col("symbol") % 4 != 0, F.date_add("start_date", 200)))
    return disclosures.expand_intervals(spans, cal, "symbol", "start_date", "end_date", "name", "d")


@query("""WITH h AS (SELECT DISTINCT o_custkey AS symbol, o_orderdate::DATE AS d FROM orders WHERE o_orderstatus = 'F'),
e AS (SELECT DISTINCT o_custkey AS symbol, o_orderdate::DATE AS d FROM orders WHERE o_orderstatus <> 'F' OR o_orderkey % 3 = 0),
j AS (SELECT h.symbol, h.d, max(e.d) FILTER (WHERE e.d = h.d) AS s, max(e.d) FILTER (WHERE e.d < h.d) AS p, min(e.d) FILTER (WHERE e.d > h.d) AS l FROM h LEFT JOIN e ON e.symbol = h.symbol AND e.d BETWEEN h.d - 60 AND h.d + 60 GROUP BY 1, 2)
SELECT symbol, d, CASE WHEN s IS NOT NULL THEN 'same_day' WHEN p IS NOT NULL THEN 'prior' WHEN l IS NOT NULL THEN 'later' ELSE 'none' END AS timing, coalesce(s, p, l) AS evidence FROM j""")
def pt27_announcement_timing(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").withColumns({"symbol": F.col("o_custkey"), "d": F.to_date("o_orderdate")})
    return disclosures.announcement_timing(o.where("o_orderstatus = 'F'"), o.where("o_orderstatus <> 'F' OR o_orderkey % 3 = 0"), "symbol", "d", 60)


_HOLDERS = """h AS (SELECT date_trunc('quarter', l_shipdate)::DATE AS t, l_suppkey AS symbol, date_trunc('month', l_shipdate)::DATE AS period, l_quantity AS amount, l_partkey % 3 <> 0 AS inst, l_linenumber <= 3 AS f FROM lineitem),
g AS (SELECT t, symbol, f, period, sum(amount) AS total, coalesce(sum(amount) FILTER (WHERE inst), 0) / sum(amount) AS share FROM h GROUP BY ALL),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY t, symbol, f ORDER BY period DESC) AS n FROM g) WHERE n = 1)"""


@query(f"""WITH {_HOLDERS},
j AS (SELECT coalesce(a.t, b.t) AS t, coalesce(a.symbol, b.symbol) AS symbol, a.total AS top_total, a.share AS ts, b.total AS float_total, b.share AS fs FROM (SELECT * FROM l WHERE f) a FULL JOIN (SELECT * FROM l WHERE NOT f) b ON a.t = b.t AND a.symbol = b.symbol)
SELECT t, symbol, top_total, round(ts, 9) AS top_share, float_total, round(fs, 9) AS float_share, round(ts - lag(ts) OVER w, 9) AS top_change, round(fs - lag(fs) OVER w, 9) AS float_change FROM j WINDOW w AS (PARTITION BY symbol ORDER BY t)""")
def pt28_holder_structure(spark: SparkSession, sf: str) -> DataFrame:
    """Two holder tables: of each quarter the latest month's concentration, and its change."""
    h = table(spark, sf, "lineitem").select(F.to_date(F.date_trunc("quarter", "l_shipdate")).alias("t"), F.col("l_suppkey").alias("symbol"), F.to_date(F.date_trunc("month", "l_shipdate")).alias("period"), F.col("l_quantity").alias("amount"), (F.col("l_partkey") % 3 != 0).alias("institution"), "l_linenumber")
    out = disclosures.holder_structure(h.where("l_linenumber <= 3"), h.where("l_linenumber > 3"), ["t", "symbol"], "period", ("top", "float"))
    return rounded(out, "top_share", "float_share", "top_change", "float_change", digits=9)


@query("""WITH r AS (SELECT o_custkey AS symbol, CASE WHEN o_orderkey % 37 = 0 THEN 'soon' ELSE strftime(o_orderdate, '%Y%m%d') END AS a, CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 29 = 0 THEN strftime(o_orderdate - INTERVAL 9 DAY, '%Y%m%d') ELSE strftime(o_orderdate + INTERVAL 90 DAY, '%Y-%m-%d') END AS z, o_orderstatus AS v FROM orders),
t AS (SELECT symbol, try_strptime(a, '%Y%m%d')::DATE AS start_date, coalesce(try_strptime(z, '%Y%m%d'), try_strptime(z, '%Y-%m-%d'))::DATE AS end_date, v FROM r),
o AS (SELECT *, row_number() OVER (PARTITION BY symbol, start_date ORDER BY end_date DESC NULLS FIRST, v DESC) AS n FROM t)
SELECT symbol, start_date, end_date, v, CASE WHEN start_date IS NULL THEN 'bad_start' WHEN end_date < start_date THEN 'bad_order' END AS fault FROM o WHERE n = 1""")
def pt29_interval_table(spark: SparkSession, sf: str) -> DataFrame:
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    r = table(spark, sf, "orders").select(F.col("o_custkey").alias("symbol"), F.when(k % 37 == 0, "soon").otherwise(F.date_format(d, "yyyyMMdd")).alias("start_date"), F.when(k % 5 == 0, "").when(k % 29 == 0, F.date_format(F.date_sub(d, 9), "yyyyMMdd")).otherwise(F.date_format(F.date_add(d, 90), "yyyy-MM-dd")).alias("end_date"), F.col("o_orderstatus").alias("v"))
    return disclosures.interval_table(r, "symbol", "start_date", "end_date", "v")


@query("""WITH e AS (SELECT o_custkey AS symbol, date_trunc('quarter', o_orderdate)::DATE AS ex, o_orderstatus AS s, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS p FROM orders),
g AS (SELECT symbol, ex, count(*) AS n_versions, concat_ws(',', CASE WHEN count(DISTINCT s) > 1 THEN 's:conflict' END, CASE WHEN count(DISTINCT p) > 1 THEN 'p:conflict' END, CASE WHEN count(p) = 0 THEN 'p:missing' END) AS why, max(s) AS s, max(p) AS p FROM e GROUP BY 1, 2)
SELECT symbol, ex, n_versions, CASE WHEN why = '' THEN 'ready' ELSE 'blocked' END AS state, why, CASE WHEN why = '' THEN s END AS s, CASE WHEN why = '' THEN p END AS p FROM g""")
def pt30_corporate_actions(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "orders").select(F.col("o_custkey").alias("symbol"), F.to_date(F.date_trunc("quarter", "o_orderdate")).alias("ex"), F.col("o_orderstatus").alias("s"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("p"))
    return disclosures.corporate_actions(e, ["symbol", "ex"], ["s", "p"], ["p"])


@query(f"""WITH {_RAW},
v AS (SELECT ts_code, report_period, count(DISTINCT (coalesce(revenue, -1), comp_type)) > 1 AS ambiguous FROM events GROUP BY 1, 2)
SELECT id, ts_code, report_period, ambiguous FROM events JOIN v USING (ts_code, report_period)""")
def pt31_ambiguous_templates(spark: SparkSession, sf: str) -> DataFrame:
    return disclosures.split_ambiguous(events(spark, sf), ["ts_code", "report_period"], ["revenue", "comp_type"]).select("id", "ts_code", "report_period", "ambiguous")


@query(f"""WITH {_RAW},
u AS (SELECT 'income' AS component, * FROM events WHERE report_type = '1' UNION ALL SELECT 'balance', * FROM events WHERE report_type = '5' UNION ALL SELECT 'cash', * FROM events WHERE report_type = '4')
SELECT component, count(*) AS n_rows, min(report_period) AS first_period, max(report_period) AS last_period, min(available_date) AS first_known, max(available_date) AS last_known, count(DISTINCT (ts_code, report_period)) AS n_keys FROM u GROUP BY 1""")
def pt33_component_union(spark: SparkSession, sf: str) -> DataFrame:
    """PT-33 and ST-01: three tables of different columns as one, and what is known of each."""
    e = events(spark, sf)
    parts = {"income": e.where("report_type = '1'").drop("profit"), "balance": e.where("report_type = '5'").drop("revenue"), "cash": e.where("report_type = '4'")}
    return disclosures.union_components(parts, ["ts_code", "report_period"], "report_period", "available_date")[1]
