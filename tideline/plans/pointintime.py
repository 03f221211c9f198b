"""Point-in-time queries (PT-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators import pit
from tideline.plans.tables import table

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_FACTS = """facts AS (SELECT o_custkey AS symbol, o_orderkey AS id, date_trunc('quarter', o_orderdate)::DATE AS period, o_orderdate::DATE AS disclosed, (o_orderdate::DATE + 1)::DATE AS known,
 CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice END AS revenue, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice * 2 END AS profit, o_orderstatus AS status FROM orders)"""


def facts(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as disclosures of two fields."""
    p = F.col("o_orderpriority")
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("symbol"), F.col("o_orderkey").alias("id"), F.to_date(F.date_trunc("quarter", "o_orderdate")).alias("period"), F.to_date("o_orderdate").alias("disclosed"), F.date_add("o_orderdate", 1).alias("known"),
        F.when(p != "1-URGENT", F.col("o_totalprice")).alias("revenue"), F.when(p != "5-LOW", F.col("o_totalprice") * 2).alias("profit"), F.col("o_orderstatus").alias("status"),
    )


@query(f"""WITH {_FACTS},
cal AS (SELECT DISTINCT l_shipdate::DATE AS d FROM lineitem WHERE dayofweek(l_shipdate) BETWEEN 1 AND 5)
SELECT id, min(cal.d) AS available_date FROM facts JOIN cal ON cal.d >= disclosed + 1 GROUP BY id""")
def pt01_availability(spark: SparkSession, sf: str) -> DataFrame:
    cal = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("day")).distinct().where(F.dayofweek("day").between(2, 6))
    return pit.available(facts(spark, sf), "disclosed", 1, cal).select("id", "available_date")


@query(f"WITH {_FACTS} SELECT id, CASE WHEN id % 11 = 0 THEN 'missing_disclosure' WHEN id % 13 = 0 THEN 'disclosed_before_period' END AS reason FROM facts")
def pt02_usable(spark: SparkSession, sf: str) -> DataFrame:
    f = facts(spark, sf).withColumn("disclosed", F.when(F.col("id") % 11 != 0, F.when(F.col("id") % 13 == 0, F.date_sub("period", 1)).otherwise(F.col("disclosed"))))
    return pit.split_usable(f, "disclosed", "period").select("id", "reason")


@query(f"WITH {_FACTS} SELECT symbol, period, id, revenue FROM (SELECT *, row_number() OVER (PARTITION BY symbol, period ORDER BY known DESC, id DESC) AS n FROM facts WHERE known <= DATE '1999-06-30') WHERE n = 1")
def pt03_latest_vintage(spark: SparkSession, sf: str) -> DataFrame:
    return pit.latest_vintage(facts(spark, sf), ["symbol", "period"], F.lit("1999-06-30").cast("date"), ["known"], ["known", "id"]).select("symbol", "period", "id", "revenue")


@query(f"""WITH {_FACTS} SELECT symbol, arg_max(revenue, period::VARCHAR || known::VARCHAR || lpad(id::VARCHAR, 12, '0')) FILTER (WHERE revenue IS NOT NULL) AS revenue, arg_max(id, period::VARCHAR || known::VARCHAR || lpad(id::VARCHAR, 12, '0')) FILTER (WHERE revenue IS NOT NULL) AS revenue_id,
 arg_max(profit, period::VARCHAR || known::VARCHAR || lpad(id::VARCHAR, 12, '0')) FILTER (WHERE profit IS NOT NULL) AS profit, arg_max(id, period::VARCHAR || known::VARCHAR || lpad(id::VARCHAR, 12, '0')) FILTER (WHERE profit IS NOT NULL) AS profit_id FROM facts WHERE known <= DATE '1999-06-30' GROUP BY 1""")
def pt14_field_state(spark: SparkSession, sf: str) -> DataFrame:
    return pit.field_state(facts(spark, sf).where("known <= DATE '1999-06-30'"), "symbol", ["revenue", "profit"], ["period", "known", "id"])


@query(f"""WITH {_FACTS},
days AS (SELECT DISTINCT date_trunc('month', l_shipdate)::DATE AS d FROM lineitem),
k AS (SELECT symbol, min(known) AS a FROM facts GROUP BY 1),
s AS (SELECT symbol, d FROM k JOIN days ON d >= a)
SELECT s.symbol, s.d, arg_max(revenue, period::VARCHAR || known::VARCHAR || lpad(id::VARCHAR, 12, '0')) AS revenue FROM s LEFT JOIN facts f ON f.symbol = s.symbol AND f.known <= s.d AND revenue IS NOT NULL GROUP BY 1, 2""")
def pt15_state_panel(spark: SparkSession, sf: str) -> DataFrame:
    days = table(spark, sf, "lineitem").select(F.to_date(F.date_trunc("month", "l_shipdate")).alias("d")).distinct()
    return pit.state_panel(facts(spark, sf), days, "symbol", "known", "d", "revenue", ["period", "known", "id"])


@query(f"WITH {_FACTS} SELECT id, (row_number() OVER (PARTITION BY symbol, period ORDER BY known, id) - 1)::INT AS revision FROM facts")
def wn24_revisions(spark: SparkSession, sf: str) -> DataFrame:
    return pit.revisions(facts(spark, sf), ["symbol", "period"], ["known", "id"]).select("id", "revision")


@query(f"""WITH {_FACTS},
a AS (SELECT *, max(status) OVER (PARTITION BY symbol, period) AS m FROM facts),
b AS (SELECT *, max(known) OVER (PARTITION BY symbol, period) AS k FROM a WHERE status = m)
SELECT id, symbol, period FROM b WHERE known = k""")
def wn23_newest_flagged(spark: SparkSession, sf: str) -> DataFrame:
    return pit.newest_flagged(facts(spark, sf), ["symbol", "period"], ["status", "known"]).select("id", "symbol", "period")


@query(f"""WITH {_FACTS},
c AS (SELECT symbol, count(*) AS n_versions, count(DISTINCT status) AS k, min(status) AS s FROM facts GROUP BY 1)
SELECT symbol, n_versions, k = 1 AS agreed, CASE WHEN k = 1 THEN s END AS status FROM c""")
def pt21_consensus(spark: SparkSession, sf: str) -> DataFrame:
    return pit.consensus(facts(spark, sf), "symbol", ["status"])


@query("""WITH disc AS (SELECT o_custkey % 200 AS fund, o_orderdate::DATE AS known, o_orderkey % 7 AS period, o_orderkey AS list_id FROM orders),
h AS (SELECT l_orderkey AS list_id, l_suppkey AS stock, sum(l_extendedprice) AS value FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY fund, known ORDER BY period DESC, list_id DESC) AS n FROM disc), l AS (SELECT *, lead(known) OVER (PARTITION BY fund ORDER BY known) AS til FROM r WHERE n = 1),
held AS (SELECT fund, stock, known AS a, til, value FROM l JOIN h USING (list_id)),
m AS (SELECT stock, a AS known FROM held UNION SELECT stock, til FROM held WHERE til IS NOT NULL UNION SELECT stock, known FROM r JOIN h USING (list_id) WHERE n > 1)
SELECT m.stock, m.known, count(DISTINCT fund) AS n_funds, round(coalesce(sum(value), 0), 2) AS total FROM m LEFT JOIN held ON held.stock = m.stock AND m.known >= a AND (til IS NULL OR m.known < til) GROUP BY 1, 2""")
def pt24_replacement_state(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "orders").select((F.col("o_custkey") % 200).alias("fund"), F.to_date("o_orderdate").alias("known"), (F.col("o_orderkey") % 7).alias("period"), F.col("o_orderkey").alias("list_id"))
    h = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("list_id"), F.col("l_suppkey").alias("stock")).agg(F.sum("l_extendedprice").alias("value"))
    return pit.replacement_state(d, h, "fund", "stock", "known", "period", "value").withColumn("total", F.round("total", 2))


@query(f"WITH {_FACTS} SELECT symbol, max(known) AS last_known, max(known) < DATE '2000-12-01' AS stale, date_diff('day', max(known), DATE '2001-01-01') AS lag_days FROM facts GROUP BY 1")
def pt32_staleness(spark: SparkSession, sf: str) -> DataFrame:
    last = facts(spark, sf).groupBy("symbol").agg(F.max("known").alias("last_known"))
    return last.select("symbol", "last_known", (F.col("last_known") < F.lit("2000-12-01").cast("date")).alias("stale"), F.datediff(F.lit("2001-01-01").cast("date"), "last_known").cast("long").alias("lag_days"))


@query(f"WITH {_FACTS} SELECT symbol, id, revenue, period FROM facts WHERE period >= DATE '1998-01-01' AND known <= DATE '1998-12-31'")
def pt19_ledger_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """All customers; the dates are those of the read."""
    return facts(spark, sf).where("period >= DATE '1998-01-01' AND known <= DATE '1998-12-31'").select("symbol", "id", "revenue", "period")
