"""Queries of readers, layouts and sinks (IO-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.plans.tables import DAILY, TRADES, daily, rounded, table, trades
from tideline.sources import dated, files, labels, layouts
from tideline.streaming.flows import work_folder

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query("SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def io01_projected_read(spark: SparkSession, sf: str) -> DataFrame:
    """Only the columns asked for, by the file's suffix."""
    return files.read_file(spark, f"{sf}/supplier.parquet", ["s_suppkey", "s_name", "s_nationkey"])


@query("SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, NULL::VARCHAR AS phone FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_name || '!' FROM supplier")
def io04_schema_union(spark: SparkSession, sf: str) -> DataFrame:
    """Two parts of different columns, written and read as one table."""
    out = work_folder(spark, "parts")
    table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")).write.parquet(f"{out}/a")
    table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.concat("s_name", F.lit("!")).alias("phone")).write.parquet(f"{out}/b")
    return files.read_parts(spark, [f"{out}/a", f"{out}/b"]).select("id", "name", "balance", "phone")


_ADHOC = "SELECT n_name, count(*) AS n_customers, CAST(round(sum(c_acctbal), 2) AS DOUBLE) AS balance FROM {p}customer JOIN {p}nation ON c_nationkey = n_nationkey GROUP BY n_name"


@query(_ADHOC.format(p=""))
def io06_sql_over_views(spark: SparkSession, sf: str) -> DataFrame:
    """IO-05 and IO-06: views of a manifest, a statement over them, its rows as CSV."""
    files.register_views(spark, {n: f"{sf}/{n}.parquet" for n in ("customer", "nation")}, prefix="io06_")
    back = files.answer(spark, _ADHOC.format(p="io06_"), work_folder(spark, "answer"), "csv")
    return back.select("n_name", F.col("n_customers").cast("long").alias("n_customers"), F.col("balance").cast("double").alias("balance"))


_RAW = """raw AS (SELECT CASE WHEN l_linenumber % 3 = 0 THEN strftime(l_shipdate, '%Y%m%d') || '.0' WHEN l_linenumber = 7 THEN 'n/a' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS d, ' ' || l_suppkey || '.sz' AS code, l_orderkey, l_linenumber, l_quantity FROM lineitem),
keyed AS (SELECT CASE WHEN d = 'n/a' THEN NULL ELSE coalesce(try_strptime(replace(d, '.0', ''), '%Y%m%d'), try_strptime(d, '%Y-%m-%d'))::DATE END AS trade_date, lpad(split_part(upper(trim(code)), '.', 1), 6, '0') || '.SZ' AS symbol, l_orderkey, l_linenumber, l_quantity FROM raw),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, trade_date ORDER BY l_orderkey DESC, l_linenumber DESC) AS k FROM keyed WHERE trade_date IS NOT NULL) WHERE k = 1),
monthly AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date_trunc('month', trade_date) ORDER BY trade_date DESC) AS m FROM one) WHERE m = 1)"""


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    d, k = F.col("l_shipdate"), F.col("l_linenumber")
    text = F.when(k % 3 == 0, F.concat(F.date_format(d, "yyyyMMdd"), F.lit(".0"))).when(k == 7, "n/a").otherwise(F.date_format(d, "yyyy-MM-dd"))
    return table(spark, sf, "lineitem").select(text.alias("d"), F.concat(F.lit(" "), F.col("l_suppkey").cast("string"), F.lit(".sz")).alias("code"), "l_orderkey", "l_linenumber", "l_quantity")


@query(f"WITH {_RAW} SELECT symbol, trade_date, l_orderkey, l_quantity, year(trade_date)::INT AS trade_year FROM monthly")
def io07_standard_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Dates of several forms and codes of several widths, one row a key, the last of each month, by year."""
    layer, _ = layouts.standard_layer(_raw(spark, sf), work_folder(spark, "layer"), date="d", symbol="code", order=[F.desc("l_orderkey"), F.desc("l_linenumber")], freq="month")
    return layer.select("symbol", "trade_date", "l_orderkey", "l_quantity", "trade_year")


@query(f"""WITH {_RAW} SELECT (SELECT count(*) FROM keyed) AS n_read, (SELECT count(*) FROM keyed WHERE trade_date IS NULL) AS n_bad_keys, (SELECT count(*) FROM keyed WHERE trade_date IS NOT NULL) - (SELECT count(*) FROM one) AS n_duplicates, (SELECT count(*) FROM one) AS n_kept""")
def io07_layer_counters(spark: SparkSession, sf: str) -> DataFrame:
    return layouts.standard_layer(_raw(spark, sf), work_folder(spark, "layer"), date="d", symbol="code", order=[F.desc("l_orderkey"), F.desc("l_linenumber")])[1]


@query(f"WITH {TRADES} SELECT symbol, d, arg_max(price, k) AS price FROM trades GROUP BY 1, 2")
def io09_by_symbol(spark: SparkSession, sf: str) -> DataFrame:
    """A table by date rewritten by symbol; the last row of each key stays."""
    return layouts.by_symbol(trades(spark, sf), work_folder(spark, "symbols"), symbol="symbol", date="d", order=[F.desc("k")]).select("symbol", "d", "price")


@query("SELECT event_id, user_id, event_type, value FROM events")
def io10_lines_of_json(spark: SparkSession, sf: str) -> DataFrame:
    """Events written as lines of JSON and read by their suffix."""
    out = work_folder(spark, "events") + ".jsonl"
    table(spark, sf, "events").select("event_id", "user_id", "event_type", "value").write.json(out)
    return files.read_file(spark, out, ["event_id", "user_id", "event_type", "value"])


@query("SELECT p_partkey, lpad(p_size::VARCHAR, 6, '0') AS code, p_size::BIGINT AS size, p_brand FROM part")
def io11_typed_csv(spark: SparkSession, sf: str) -> DataFrame:
    """A CSV of text; whole numbers are found, codes with leading zeros stay."""
    out = work_folder(spark, "csv")
    table(spark, sf, "part").select("p_partkey", F.lpad(F.col("p_size").cast("string"), 6, "0").alias("code"), F.col("p_size").alias("size"), "p_brand").write.option("header", True).csv(out)
    return files.read_typed_csv(spark, out, ["p_partkey", "code", "size", "p_brand"])


_LOOSE = "SELECT event_id, CASE WHEN event_id % 23 = 0 THEN 'x' || event_id ELSE user_id::VARCHAR END AS user_id, CASE WHEN event_type = 'view' AND value > 10 THEN NULL ELSE value::VARCHAR END AS value FROM events"


def _loose(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    user = F.when(F.col("event_id") % 23 == 0, F.concat(F.lit("x"), F.col("event_id").cast("string"))).otherwise(F.col("user_id").cast("string"))
    return e.select("event_id", user.alias("user_id"), F.when((F.col("event_type") == "view") & (F.col("value") > 10), None).otherwise(F.col("value").cast("string")).alias("value"))


@query(f"WITH e AS ({_LOOSE}) SELECT CASE WHEN TRY_CAST(user_id AS BIGINT) IS NULL THEN 'user_id' WHEN TRY_CAST(value AS DOUBLE) IS NULL THEN 'value' END AS rejected, count(*) AS n_rows FROM e GROUP BY 1")
def io14_canonical_schema(spark: SparkSession, sf: str) -> DataFrame:
    checked = layouts.canonical(_loose(spark, sf), {"event_id": "long", "user_id": "long", "value": "double"}, ["event_id", "user_id", "value"])
    return layouts.rejects(checked)


@query(f"WITH {DAILY} SELECT CASE WHEN n_trades > 1 THEN strftime(d, '%Y%m') ELSE '_audit' END AS stage, count(*) AS n_rows, sum(volume) AS volume FROM daily GROUP BY 1")
def io15_staging(spark: SparkSession, sf: str) -> DataFrame:
    """Months as partitions; days with one trade only go to the audit partition."""
    staged = layouts.stage_by_validity(daily(spark, sf), F.col("n_trades") > 1, "d", work_folder(spark, "staging"), "yyyyMM")
    return staged.groupBy("stage").agg(F.count("*").alias("n_rows"), F.sum("volume").alias("volume"))


@query(f"""WITH e AS ({_LOOSE}),
r AS (SELECT event_id, CASE WHEN TRY_CAST(user_id AS BIGINT) IS NULL THEN 'bad_user' WHEN value IS NULL THEN 'no_value' END AS reason FROM e)
SELECT event_id, reason, reason IS NULL AS good FROM r""")
def io16_quarantine_sinks(spark: SparkSession, sf: str) -> DataFrame:
    """Usable and rejected rows in two folders; the reasons are found in the data."""
    reason = F.when(F.col("user_id").try_cast("long").isNull(), "bad_user").when(F.col("value").isNull(), "no_value")
    good, bad = layouts.quarantine(_loose(spark, sf), reason, work_folder(spark, "quarantine"))
    return good.select("event_id", "reason", F.lit(True).alias("good")).union(bad.select("event_id", "reason", F.lit(False)))


@query(f"""WITH {DAILY},
o AS (SELECT o_custkey AS symbol, o_orderdate::DATE AS d, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2),
r AS (SELECT symbol, d, count(*) AS n FROM trades WHERE flag = 'R' GROUP BY 1, 2)
SELECT y.symbol, y.d, y.close, o.n AS orders_n, o.total AS orders_total, r.n AS returns_n FROM daily y LEFT JOIN o ON y.symbol = o.symbol AND y.d = o.d JOIN r ON r.symbol = y.symbol AND r.d = y.d
WHERE dayofweek(y.d) BETWEEN 1 AND 5 AND y.symbol IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 20)""")
def io20_research_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Prices with two assets, on open days and for members only."""
    y = daily(spark, sf).select("symbol", "d", "close")
    o = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("symbol"), F.to_date("o_orderdate").alias("d")).agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))
    r = trades(spark, sf).where("flag = 'R'").groupBy("symbol", "d").agg(F.count("*").alias("n"))
    open_days = y.select("d").distinct().where(F.dayofweek("d").between(2, 6))
    members = table(spark, sf, "supplier").where("s_nationkey < 20").select(F.col("s_suppkey").alias("symbol"))
    return rounded(layouts.research_frame(y, [("orders", o, "left"), ("returns", r, "inner")], ["symbol", "d"], calendar=open_days, members=members), "orders_total", digits=2)


@query("SELECT event_id, event_type, value FROM events WHERE event_type IN (SELECT event_type FROM events GROUP BY 1 ORDER BY count(*) DESC, event_type LIMIT 2)")
def io21_export(spark: SparkSession, sf: str) -> DataFrame:
    """The series of the two most frequent groups as CSV; which they are is the feature."""
    e = table(spark, sf, "events").select("event_id", "event_type", "value")
    top = [r["event_type"] for r in e.groupBy("event_type").count().orderBy(F.desc("count"), "event_type").limit(2).collect()]
    return files.export_groups(e, "event_type", top, work_folder(spark, "export"), ["event_id"])


@query("""SELECT event_id, user_id, value, CASE WHEN user_id % 3 = 2 AND event_id % 4 = 0 THEN ts::DATE + 1 ELSE ts::DATE END AS trade_date FROM events
WHERE CASE WHEN user_id % 3 = 2 AND event_id % 4 = 0 THEN ts::DATE + 1 ELSE ts::DATE END BETWEEN DATE '2024-01-04' AND DATE '2024-01-20' AND NOT (user_id % 3 <> 2 AND ts::DATE NOT BETWEEN DATE '2024-01-04' AND DATE '2024-01-20')""")
def io02_mixed_layout(spark: SparkSession, sf: str) -> DataFrame:
    """One root with folders of dates, files with dated names and files that hold the date themselves, read for a range of dates."""
    root = work_folder(spark, "mixed")
    e = table(spark, sf, "events").select("event_id", "user_id", "value", F.to_date("ts").alias("trade_date"))
    layouts.dealt(e.where("user_id % 3 = 0"), "trade_date", files=1).write.partitionBy("trade_date").parquet(f"{root}/data")
    named = e.where("user_id % 3 = 1").withColumn("day", F.date_format("trade_date", "yyyyMMdd")).drop("trade_date")
    layouts.dealt(named, "day", files=1).write.partitionBy("day").parquet(f"{root}_days")
    dated.name_by_folder(spark, f"{root}_days", "day", f"{root}/days")
    own = e.where("user_id % 3 = 2").withColumn("trade_date", F.date_format(F.date_add("trade_date", F.when(F.col("event_id") % 4 == 0, 1).otherwise(0)), "yyyyMMdd"))
    own.write.parquet(f"{root}/own")
    return dated.read_dated(spark, root, first="2024-01-04", last="2024-01-20").select("event_id", "user_id", "value", "trade_date")


@query("""SELECT p_partkey AS id, lpad(p_size::VARCHAR, 6, '0') AS code, CASE WHEN p_partkey % 2 = 0 THEN p_size::BIGINT END AS size, '型号' || p_brand AS brand, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_size::VARCHAR END AS gaps FROM part""")
def io11_legacy_members(spark: SparkSession, sf: str) -> DataFrame:
    """Two kinds of members in GB18030, whose headers differ in spelling, order and columns, as one typed table."""
    out = work_folder(spark, "members")
    p = table(spark, sf, "part").select("p_partkey", F.lpad(F.col("p_size").cast("string"), 6, "0").alias("code"), F.col("p_size").cast("string").alias("size"), F.concat(F.lit("型号"), "p_brand").alias("brand"), F.when(F.col("p_partkey") % 5 != 0, F.col("p_size").cast("string")).alias("gaps"))
    bytes_of = lambda df: dated.recode(df, "GB18030", "latin-1").toDF(*[c.encode("GB18030").decode("latin-1") for c in df.columns])
    writer = lambda df, name: bytes_of(df).write.option("header", True).option("encoding", "ISO-8859-1").csv(f"{out}/{name}")
    writer(p.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("编号"), F.col("code").alias("代码"), "size", F.col("brand").alias("品牌"), "gaps"), "a")
    writer(p.where("p_partkey % 2 = 1").select("gaps", F.col("brand").alias("Brand"), F.col("code").alias("Code"), F.col("p_partkey").alias("ID")), "b")
    members = [r[0] for name in ("a", "b") for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(f"{out}/{name}").where("length > 0").select("path").collect()]
    aliases = {"编号": "id", "ID": "id", "代码": "code", "Code": "code", "品牌": "brand", "Brand": "brand"}
    return dated.read_members(spark, members, aliases, ["id", "code", "brand"]).select("id", "code", "size", "brand", "gaps")


@query("""WITH t AS (SELECT event_id AS origin, CASE WHEN user_id % 10 <> 3 THEN user_id END AS code, CASE WHEN event_id % 9 <> 0 THEN event_id % 50 END AS id, CASE WHEN value < 3 THEN 0.0 WHEN value > 20 THEN NULL ELSE value END AS price FROM events)
SELECT origin, code, id, price, CASE WHEN price <= 0 THEN 'tag' ELSE 'keep' END AS decision, CASE WHEN price <= 0 THEN 'special_price_or_event' ELSE '' END AS reason FROM t WHERE code IS NOT NULL AND price IS NOT NULL AND id IS NOT NULL""")
def pr25_labelled_files(spark: SparkSession, sf: str) -> DataFrame:
    """Raw files whose event ids repeat, with a sidecar of decisions by file and row."""
    out, k = work_folder(spark, "ticks"), F.col("event_id")
    raw = table(spark, sf, "events").select(k.alias("origin"), F.when(F.col("user_id") % 10 != 3, F.col("user_id")).alias("code"), F.col("ts"), F.when(k % 9 != 0, k % 50).alias("id"), F.when(F.col("value") < 3, 0.0).when(F.col("value") <= 20, F.col("value")).alias("price"))
    raw.repartition(3, "origin").write.parquet(f"{out}/raw")
    labels.write_labels(spark, f"{out}/raw", f"{out}/labels", "deal", code="code", time="ts", price="price", event_id="id")
    return labels.read_labelled(spark, f"{out}/raw", f"{out}/labels").select("origin", "code", "id", "price", "decision", "reason")
