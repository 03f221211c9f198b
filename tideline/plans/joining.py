"""As-of, interval, overlay, fusion and set operators (JN-01..27, ST-01..08, TK-01..07)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators import features, joins, sets, windows
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


_CHANGES = """changes AS (SELECT customer, start_date, status, CASE WHEN customer % 5 = 0 THEN (start_date + 400)::DATE END AS stop_date FROM (
 SELECT o_custkey AS customer, o_orderdate::DATE AS start_date, o_orderstatus AS status, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS n FROM orders) WHERE n = 1)"""


def changes(spark: SparkSession, sf: str) -> DataFrame:
    """Order status changes per customer; some close after 400 days."""
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("customer"), F.to_date("o_orderdate").alias("start_date"), F.col("o_orderstatus").alias("status"), "o_orderkey")
    one = windows.keep_one(dealt(o, "customer", "start_date"), ["customer", "start_date"], [F.desc("o_orderkey")]).drop("o_orderkey")
    return one.withColumn("stop_date", F.when(F.col("customer") % 5 == 0, F.date_add("start_date", 400)))


_PANEL = "panel AS (SELECT DISTINCT l_orderkey % 1600 AS customer, l_shipdate::DATE AS d FROM lineitem)"


def _panel(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select((F.col("l_orderkey") % 1600).alias("customer"), F.to_date("l_shipdate").alias("d")).distinct()


_ORDER_PANEL = "panel AS (SELECT DISTINCT o_custkey AS customer, l_shipdate::DATE AS d FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


def _order_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Shipping days of each customer, by way of the orders."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer"))
    lines = dealt(table(spark, sf, "lineitem").select("l_orderkey", F.to_date("l_shipdate").alias("d")), "l_orderkey")
    return dealt(lines.join(o, "l_orderkey").select("customer", "d"), "customer", "d").distinct()


@query(f"""WITH {_CHANGES}, {_ORDER_PANEL}, j AS (SELECT p.customer, p.d, c.status, c.stop_date FROM panel p ASOF LEFT JOIN changes c ON p.customer = c.customer AND p.d >= c.start_date)
SELECT customer, d, status FROM j WHERE (stop_date IS NULL OR d <= stop_date) AND customer IN (SELECT customer FROM changes)""")
def jn03_as_of_label_by_order(spark: SparkSession, sf: str) -> DataFrame:
    return joins.as_of_label(_order_panel(spark, sf), changes(spark, sf), "customer", "d", "start_date", "stop_date", "status")


@query(f"""WITH {_CHANGES}, {_ORDER_PANEL}, s AS (SELECT customer, start_date, (start_date + 90)::DATE AS e, status FROM changes)
SELECT p.customer, p.d, arg_max(status, start_date) AS status FROM panel p LEFT JOIN s ON p.customer = s.customer AND p.d BETWEEN start_date AND e GROUP BY 1, 2""")
def jn04_interval_member_by_order(spark: SparkSession, sf: str) -> DataFrame:
    spans = changes(spark, sf).withColumn("end_date", F.date_add("start_date", 90))
    return joins.interval_member(_order_panel(spark, sf), spans, "customer", "d", "start_date", "end_date", ["status"])


@query(f"""WITH {TRADES}, snap AS (SELECT DISTINCT date_trunc('month', d)::DATE AS s, symbol FROM trades WHERE flag = 'R'), days AS (SELECT DISTINCT d FROM trades), dates AS (SELECT DISTINCT s FROM snap),
m AS (SELECT d, max(s) AS s FROM days JOIN dates ON s <= d GROUP BY d) SELECT d, snap.s AS snapshot, symbol FROM m JOIN snap USING (s)""")
def jn06_carry_all_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Each open day gets all members of the latest snapshot at or before it."""
    t = trades(spark, sf)
    snap = t.where("flag = 'R'").select(F.to_date(F.date_trunc("month", "d")).alias("snapshot"), "symbol").distinct()
    one = F.lit(1).alias("g")
    days = joins.as_of(t.select("d").distinct().select(one, "d"), snap.select("snapshot").distinct().select(one, "snapshot"), ["g"], "d", "snapshot", [])
    days = days.where("snapshot_matched IS NOT NULL").select("d", F.col("snapshot_matched").alias("snapshot"))  # a calendar's days
    return snap.join(F.broadcast(days), "snapshot").select("d", "snapshot", "symbol")


@query(f"""WITH {DAILY}, f AS (SELECT symbol, d, 1 + symbol / 100.0 + year(d) / 10000.0 AS factor FROM daily WHERE dayofmonth(d) = 1)
SELECT p.symbol, p.d, coalesce(f.factor, 1.0)::DOUBLE AS factor FROM daily p ASOF LEFT JOIN f ON p.symbol = f.symbol AND p.d >= f.d""")
def jn07_step_factor(spark: SparkSession, sf: str) -> DataFrame:
    p = daily(spark, sf).select("symbol", "d")
    f = p.where(F.dayofmonth("d") == 1).select("symbol", F.col("d").alias("ex"), (1 + F.col("symbol") / F.lit(100.0) + F.year("d") / F.lit(10000.0)).alias("factor"))
    return joins.as_of(p, f, ["symbol"], "d", "ex", ["factor"]).select("symbol", "d", F.coalesce("factor", F.lit(1.0)).alias("factor"))


@query(f"""WITH {TRADES},
e AS (SELECT symbol, d, count(*) AS n FROM trades WHERE flag = 'R' AND volume > 40 GROUP BY 1, 2),
y AS (SELECT symbol, d, sum(volume) AS volume FROM trades GROUP BY 1, 2),
b AS (SELECT min(d) AS lo, max(d) AS hi FROM e),
p AS (SELECT y.* FROM y, b WHERE d BETWEEN lo AND hi AND symbol IN (SELECT symbol FROM e))
SELECT coalesce(e.symbol, p.symbol) AS symbol, coalesce(e.d, p.d) AS d, coalesce(n, 0) AS n_events, volume FROM e FULL JOIN p ON e.symbol = p.symbol AND e.d = p.d""")
def jn08_events_on_panel(spark: SparkSession, sf: str) -> DataFrame:
    t = trades(spark, sf)
    e = t.where("flag = 'R' AND volume > 40").groupBy("symbol", "d").agg(F.count("*").alias("n"))
    p = t.groupBy("symbol", "d").agg(F.sum("volume").alias("volume"))
    return features.on_panel(e, p, "symbol", "d").select("symbol", "d", F.coalesce("n", F.lit(0)).alias("n_events"), "volume")


@query(f"""WITH {TRADES},
a AS (SELECT symbol, d, sum(volume) AS bought FROM trades WHERE flag = 'A' GROUP BY 1, 2),
r AS (SELECT symbol, d, sum(volume) AS returned FROM trades WHERE flag = 'R' GROUP BY 1, 2),
n AS (SELECT symbol, d, count(*) AS normal FROM trades WHERE flag = 'N' GROUP BY 1, 2)
SELECT symbol, d, bought, returned, normal FROM a FULL JOIN r USING (symbol, d) FULL JOIN n USING (symbol, d)""")
def jn09_outer_merge(spark: SparkSession, sf: str) -> DataFrame:
    t = trades(spark, sf)
    part = lambda f, c: t.where(F.col("flag") == f).groupBy("symbol", "d").agg(c)
    return joins.outer_merge([part("A", F.sum("volume").alias("bought")), part("R", F.sum("volume").alias("returned")), part("N", F.count("*").alias("normal"))], ["symbol", "d"])


_TWO = f"{TRADES}, a AS (SELECT symbol, d, sum(volume) AS v FROM trades WHERE flag <> 'R' GROUP BY 1, 2), b AS (SELECT symbol, d, sum(volume) * 100 AS v FROM trades WHERE flag <> 'A' GROUP BY 1, 2)"


def _two(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    t = trades(spark, sf)
    return day_volumes(t.where("flag <> 'R'")), day_volumes(t.where("flag <> 'A'")).withColumn("v", F.col("v") * 100)


@query(f"WITH {_TWO} SELECT symbol, d, v, 'second' AS source FROM b UNION ALL SELECT symbol, d, v, 'first' FROM a ANTI JOIN b USING (symbol, d)")
def jn10_fusion(spark: SparkSession, sf: str) -> DataFrame:
    return joins.fuse(*_two(spark, sf), ["symbol", "d"])


@query(f"WITH {TRADES} SELECT symbol, d, sum(volume) AS v FROM trades GROUP BY 1, 2")
def jn11_disjoint_union(spark: SparkSession, sf: str) -> DataFrame:
    v = day_volumes(trades(spark, sf))
    return joins.disjoint_union(v.where("symbol % 2 = 0"), v.where("symbol % 2 = 1"), ["symbol", "d"])


@query(f"WITH {_TWO} SELECT CASE WHEN a.v IS NOT NULL AND b.v IS NOT NULL THEN 'both' WHEN a.v IS NOT NULL THEN 'only_a' ELSE 'only_b' END AS side, count(*) AS n FROM a FULL JOIN b USING (symbol, d) GROUP BY 1")
def jn12_pairing(spark: SparkSession, sf: str) -> DataFrame:
    return joins.pairing(*_two(spark, sf), ["symbol", "d"])


@query("""WITH m AS (SELECT event_type, date_trunc('hour', ts) AS h, round(sum(value), 4) AS v FROM events GROUP BY 1, 2), s AS (SELECT unnest([-60, 0, 60]) AS shift)
SELECT a.event_type, shift::INT AS shift, count(*) AS n, round(avg(abs(a.v - b.v)), 4) AS mae FROM m b, s JOIN m a ON a.event_type = b.event_type AND a.h = b.h + to_minutes(shift) GROUP BY 1, 2""")
def jn13_shifted_match(spark: SparkSession, sf: str) -> DataFrame:
    m = table(spark, sf, "events").groupBy("event_type", F.date_trunc("hour", "ts").alias("h")).agg(F.round(F.sum("value"), 4).alias("v"))
    return rounded(joins.shifted_match(m, m, "event_type", "h", "v", [-60, 0, 60]), "mae", digits=4)


@query(f"""WITH {_TWO},
g AS (SELECT symbol, count(*) AS rows_a, max_by(v, d) AS last_a, count(*) FILTER (WHERE v > 30) AS large_a FROM a GROUP BY 1),
t AS (SELECT symbol, count(*) AS rows_b, min_by(v, d) AS first_b FROM b GROUP BY 1),
e AS (SELECT symbol, count(*) AS matched, round(avg(abs(a.v - b.v / 100)), 6) AS mae, count(*) FILTER (WHERE a.v = b.v / 100) AS exact FROM a JOIN b USING (symbol, d) GROUP BY 1)
SELECT symbol, rows_a, last_a, large_a, rows_b, first_b, matched, mae, exact FROM g FULL JOIN t USING (symbol) LEFT JOIN e USING (symbol)""")
def jn14_source_comparison(spark: SparkSession, sf: str) -> DataFrame:
    a, b = _two(spark, sf)
    g = a.groupBy("symbol").agg(F.count("*").alias("rows_a"), F.max_by("v", "d").alias("last_a"), F.count_if(F.col("v") > 30).alias("large_a"))
    t = b.groupBy("symbol").agg(F.count("*").alias("rows_b"), F.min_by("v", "d").alias("first_b"))
    diff = F.abs(F.col("v") - F.col("w") / 100)
    e = a.join(b.withColumnRenamed("v", "w"), ["symbol", "d"]).groupBy("symbol").agg(F.count("*").alias("matched"), F.round(F.avg(diff), 6).alias("mae"), F.count_if(F.col("v") == F.col("w") / 100).alias("exact"))
    return g.join(t, "symbol", "full_outer").join(e, "symbol", "left")


@query("""SELECT count(*) AS n_lines, count(*) FILTER (WHERE o_orderkey IS NULL) AS n_missing, count(DISTINCT l_orderkey) FILTER (WHERE o_orderkey IS NULL) AS n_missing_ids FROM (SELECT l_orderkey + CASE WHEN l_linenumber = 7 THEN 5 ELSE 0 END AS l_orderkey FROM lineitem) l LEFT JOIN orders ON l_orderkey = o_orderkey""")
def jn16_referential(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select((F.col("l_orderkey") + F.when(F.col("l_linenumber") == 7, 5).otherwise(0)).alias("o_orderkey"))
    return sets.referential(lines, table(spark, sf, "orders"), "o_orderkey")


@query("SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def jn18_dimension(spark: SparkSession, sf: str) -> DataFrame:
    n = sets.dimension(table(spark, sf, "nation").withColumnRenamed("n_regionkey", "r_regionkey"), table(spark, sf, "region"), "r_regionkey")
    return sets.dimension(table(spark, sf, "customer").withColumnRenamed("c_nationkey", "n_nationkey"), n.select("n_nationkey", "n_name", "r_name"), "n_nationkey").select("c_custkey", "n_name", "r_name")


@query("""WITH m AS (SELECT l_shipdate::DATE AS d, l_suppkey AS symbol, p_brand AS theme, l_quantity AS q FROM lineitem JOIN part ON l_partkey = p_partkey), t AS (SELECT d, theme, sum(q) AS strength FROM m GROUP BY 1, 2)
SELECT d, symbol, count(DISTINCT theme) AS n_themes, max(strength) AS strongest, count(DISTINCT theme) FILTER (WHERE strength > 60) AS n_strong FROM m JOIN t USING (d, theme) GROUP BY 1, 2""")
def ag09_theme_exposure(spark: SparkSession, sf: str) -> DataFrame:
    """JN-19 and AG-09: members against the day's themes."""
    m = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.to_date("l_shipdate").alias("d"), F.col("l_suppkey").alias("symbol"), F.col("p_brand").alias("theme"), F.col("l_quantity").alias("q"))
    t = m.groupBy("d", "theme").agg(F.sum("q").alias("strength"))
    return m.join(t, ["d", "theme"]).groupBy("d", "symbol").agg(F.countDistinct("theme").alias("n_themes"), F.max("strength").alias("strongest"), F.countDistinct(F.when(F.col("strength") > 60, F.col("theme"))).alias("n_strong"))


@query("""WITH s AS (SELECT c_custkey, min(o_orderdate)::DATE AS a, CASE WHEN c_custkey % 3 = 0 THEN max(o_orderdate)::DATE END AS b FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1),
d AS (SELECT DISTINCT l_shipdate::DATE AS d FROM lineitem)
SELECT d, count(c_custkey) AS n_active FROM d LEFT JOIN s ON a <= d AND (b IS NULL OR b >= d) GROUP BY d""")
def jn21_active_count(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "orders").groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("z")).withColumn("b", F.when(F.col("o_custkey") % 3 == 0, F.col("z")))
    return joins.active_on(table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("d")), s, "d", "a", "b")


@query("""WITH cal AS (SELECT DISTINCT l_shipdate::DATE AS d FROM lineitem WHERE dayofweek(l_shipdate) BETWEEN 1 AND 5), o AS (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)
SELECT o_orderkey, o.d, min(cal.d) AS next_session FROM o LEFT JOIN cal ON cal.d > o.d GROUP BY 1, 2""")
def jn22_next_session(spark: SparkSession, sf: str) -> DataFrame:
    cal = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("day")).distinct().where(F.dayofweek("day").between(2, 6))
    return joins.next_session(table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d")), cal, "d", "day")


@query("SELECT s_name, l.l_shipdate::DATE AS d, l.l_quantity FROM lineitem l JOIN supplier ON s_suppkey = l_suppkey WHERE l_shipdate = (SELECT max(l_shipdate) FROM lineitem x WHERE x.l_suppkey = l.l_suppkey)")
def jn23_latest_rows(spark: SparkSession, sf: str) -> DataFrame:
    last = sets.latest_rows(table(spark, sf, "lineitem"), "l_suppkey", "l_shipdate")
    return last.join(table(spark, sf, "supplier").withColumnRenamed("s_suppkey", "l_suppkey"), "l_suppkey").select("s_name", F.to_date("l_shipdate").alias("d"), "l_quantity")


@query(f"""WITH {TRADES},
x AS (SELECT symbol, d, sum(volume) AS v FROM trades WHERE flag = 'R' GROUP BY 1, 2),
y AS (SELECT symbol, d, sum(volume) AS v FROM trades WHERE flag = 'A' GROUP BY 1, 2),
z AS (SELECT symbol, d, sum(volume) AS v FROM trades GROUP BY 1, 2),
u AS (SELECT *, 'override' AS source, 0 AS p FROM x UNION ALL SELECT *, 'deal', 1 FROM y UNION ALL SELECT *, 'annual', 2 FROM z)
SELECT symbol, d, v, source FROM (SELECT *, row_number() OVER (PARTITION BY symbol, d ORDER BY p) AS n FROM u) WHERE n = 1""")
def jn26_precedence(spark: SparkSession, sf: str) -> DataFrame:
    t = trades(spark, sf)
    part = lambda c: (t.where(c) if c else t).groupBy("symbol", "d").agg(F.sum("volume").alias("v"))
    return joins.by_precedence([("override", part("flag = 'R'")), ("deal", part("flag = 'A'")), ("annual", part(None))], ["symbol", "d"])


@query("SELECT p_brand, count(DISTINCT p_type) AS n_types, min(p_type) AS first_type FROM part GROUP BY 1 HAVING count(DISTINCT p_type) > 1")
def jn27_mapping_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return sets.mapping_conflicts(table(spark, sf, "part"), "p_brand", "p_type", "n_types", "first_type")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC NULLS LAST, l_quantity DESC, l_partkey, l_linenumber) AS n FROM lineitem) WHERE n <= 2""")
def tk01_top_holdings(spark: SparkSession, sf: str) -> DataFrame:
    order = [F.desc_nulls_last("l_extendedprice"), F.desc("l_quantity"), "l_partkey", "l_linenumber"]
    return sets.top_rows(table(spark, sf, "lineitem"), ["l_orderkey"], order, 2).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query(f"WITH {TRADES}, t AS (SELECT symbol, sum(volume) AS v FROM trades GROUP BY 1 ORDER BY v DESC, symbol LIMIT 10) SELECT symbol, d, sum(volume) AS v FROM trades SEMI JOIN t USING (symbol) GROUP BY 1, 2")
def tk02_top_groups(spark: SparkSession, sf: str) -> DataFrame:
    return sets.top_groups(trades(spark, sf), "symbol", F.sum("volume"), 10).groupBy("symbol", "d").agg(F.sum("volume").alias("v"))


@query(f"WITH {_TWO} SELECT symbol, d, abs(a.v - b.v / 100) AS diff FROM a JOIN b USING (symbol, d) ORDER BY diff DESC, symbol, d LIMIT 5")
def tk03_worst_differences(spark: SparkSession, sf: str) -> DataFrame:
    a, b = _two(spark, sf)
    return a.join(b.withColumnRenamed("v", "w"), ["symbol", "d"]).select("symbol", "d", F.abs(F.col("v") - F.col("w") / 100).alias("diff")).orderBy(F.desc("diff"), "symbol", "d").limit(5)


@query(f"WITH {_TWO} SELECT symbol, d FROM (SELECT symbol, d FROM a INTERSECT SELECT symbol, d FROM b)")
def st02_shared_keys(spark: SparkSession, sf: str) -> DataFrame:
    return sets.shared_keys(*_two(spark, sf), ["symbol", "d"])


@query(f"WITH {_TWO} SELECT (SELECT count(*) FROM (SELECT symbol, d FROM a EXCEPT ALL SELECT symbol, d FROM b)) AS only_a, (SELECT count(*) FROM (SELECT symbol, d FROM b EXCEPT ALL SELECT symbol, d FROM a)) AS only_b")
def st03_row_set_equality(spark: SparkSession, sf: str) -> DataFrame:
    return sets.row_set_difference(*_two(spark, sf), ["symbol", "d"])


@query(f"""WITH {TRADES},
o AS (SELECT d, sum(volume) AS f FROM trades WHERE dayofmonth(d) <> 7 GROUP BY d),
n AS (SELECT d, sum(CASE WHEN dayofmonth(d) = 5 THEN volume + 1 ELSE volume END) AS f FROM trades WHERE dayofmonth(d) <> 9 GROUP BY d)
SELECT coalesce(o.d, n.d) AS d, CASE WHEN o.f IS NULL THEN 'added' WHEN n.f IS NULL THEN 'removed' WHEN o.f <> n.f THEN 'changed' ELSE 'reused' END AS state FROM o FULL JOIN n ON o.d = n.d""")
def st04_partition_delta(spark: SparkSession, sf: str) -> DataFrame:
    """Dates whose content fingerprints differ between two versions of a table."""
    t = trades(spark, sf)
    new = t.where(F.dayofmonth("d") != 9).withColumn("volume", F.when(F.dayofmonth("d") == 5, F.col("volume") + 1).otherwise(F.col("volume")))
    return sets.partition_delta(t.where(F.dayofmonth("d") != 7), new, "d", ["symbol", "k", "volume"])


@query(f"""WITH {TRADES},
o AS (SELECT symbol, d, sum(volume) * 2 AS v FROM trades WHERE dayofmonth(d) = 3 GROUP BY 1, 2)
SELECT symbol, d, sum(volume) AS v FROM trades WHERE d NOT IN (SELECT d FROM o) GROUP BY 1, 2 UNION ALL SELECT * FROM o""")
def st05_date_overlay(spark: SparkSession, sf: str) -> DataFrame:
    v = trades(spark, sf).groupBy("symbol", "d").agg(F.sum("volume").alias("v"))
    return sets.replace_dates(v, v.where(F.dayofmonth("d") == 3).withColumn("v", F.col("v") * 2), "d")


@query("""SELECT DISTINCT d, what FROM (SELECT o_orderdate::DATE AS d, o_orderstatus AS what FROM orders UNION ALL SELECT l_shipdate::DATE, l_linestatus FROM lineitem)""")
def st06_distinct_union(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d"), F.col("o_orderstatus").alias("what"))
    return a.unionByName(table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("d"), F.col("l_linestatus").alias("what"))).distinct()


@query(f"""WITH {TRADES},
n AS (SELECT symbol, d, sum(volume) + 0.5 AS v FROM trades WHERE d >= DATE '2000-06-01' GROUP BY 1, 2),
c AS (SELECT symbol, d, sum(volume) AS v FROM trades WHERE d < DATE '2000-07-01' GROUP BY 1, 2)
SELECT symbol, d, v FROM n UNION ALL SELECT symbol, d, v FROM c ANTI JOIN n USING (symbol, d)""")
def st07_incremental_merge(spark: SparkSession, sf: str) -> DataFrame:
    v = trades(spark, sf).groupBy("symbol", "d").agg(F.sum("volume").alias("v"))
    new = v.where("d >= DATE '2000-06-01'").withColumn("v", F.col("v") + 0.5)
    return joins.by_precedence([("new", new), ("cached", v.where("d < DATE '2000-07-01'"))], ["symbol", "d"]).drop("source")


@query(f"""WITH {DAILY} SELECT y.symbol, y.d, close, o.n AS n_orders FROM daily y LEFT JOIN (SELECT o_custkey % 100 AS symbol, o_orderdate::DATE AS d, arg_max(o_totalprice, o_orderkey) AS n FROM orders GROUP BY 1, 2) o ON y.symbol = o.symbol AND y.d = o.d""")
def jn01_overlay(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select((F.col("o_custkey") % 100).alias("symbol"), F.to_date("o_orderdate").alias("d"), F.col("o_totalprice").alias("n_orders"), "o_orderkey")
    return joins.overlay(daily(spark, sf).select("symbol", "d", "close"), o, ["symbol", "d"], [F.desc("o_orderkey")], ["n_orders"])
