"""Queries that do the whole of what an older one does for some ids only: on tables with more ids than the old bounds."""

import pytest
from oracle import same

from tideline.plans import registry

SF = "/root/testdata/sf0.01"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


def _rows(spark, name, *columns):
    return {tuple(r) for r in QUERIES[name](spark, SF).select(*columns).collect()}


def _table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


@pytest.mark.parametrize("name", ["wn35_adjusted_panel", "jn06_carry_all_snapshots", "ag26_full_coverage", "pt19_ledger_as_of", "jn03_as_of_label_by_order", "jn04_interval_member_by_order"])
def test_whole_query_equals_sql(spark, name):
    same(spark, SF, QUERIES[name], SQL[name])


def test_all_suppliers_and_days_are_in_the_adjusted_panel(spark):
    want = {tuple(r) for r in _table(spark, "lineitem").selectExpr("l_suppkey", "to_date(l_shipdate)").distinct().collect()}
    assert _rows(spark, "wn35_adjusted_panel", "symbol", "d") == want


def test_snapshots_carry_all_members(spark):
    returned = {r[0] for r in _table(spark, "lineitem").where("l_returnflag = 'R'").select("l_suppkey").collect()}
    assert {s for (s,) in _rows(spark, "jn06_carry_all_snapshots", "symbol")} == returned and max(returned) > 20


def test_coverage_of_all_suppliers_and_months(spark):
    present = {(r[0], r[1]) for r in _table(spark, "lineitem").selectExpr("l_suppkey", "to_date(date_trunc('month', l_shipdate))").distinct().collect()}
    expected = {(r[0], m) for r in _table(spark, "supplier").select("s_suppkey").collect() for m in {m for _, m in present}}
    got = _rows(spark, "ag26_full_coverage", "symbol", "m", "state")
    assert got == {(*x, "missing") for x in expected - present} | {(*x, "orphan") for x in present - expected}
    assert any(s > 50 for s, *_ in got) and any(m.year > 1996 for _, m, _ in got)


def test_ledger_read_has_all_customers(spark):
    want = {r[0] for r in _table(spark, "orders").where("date_trunc('quarter', o_orderdate) >= '1998-01-01' AND to_date(o_orderdate) < '1998-12-31'").select("o_orderkey").collect()}
    assert {i for (i,) in _rows(spark, "pt19_ledger_as_of", "id")} == want
    assert max(s for (s,) in _rows(spark, "pt19_ledger_as_of", "symbol")) >= 300


def test_panels_hold_all_customers_of_the_orders(spark, tmp_path):
    """Customers are moved beyond 1600, where the old panel ends."""
    for name in ("orders", "lineitem"):
        df = _table(spark, name)
        (df.withColumn("o_custkey", df["o_custkey"] + 5000) if name == "orders" else df).write.parquet(f"{tmp_path}/{name}.parquet")
    orders = {r["o_orderkey"]: r["o_custkey"] + 5000 for r in _table(spark, "orders").collect()}
    want = {(orders[r[0]], r[1]) for r in _table(spark, "lineitem").selectExpr("l_orderkey", "to_date(l_shipdate)").collect()}
    member = QUERIES["jn04_interval_member_by_order"](spark, str(tmp_path)).collect()
    assert {(r["customer"], r["d"]) for r in member} == want and any(r["status"] for r in member)
    label = QUERIES["jn03_as_of_label_by_order"](spark, str(tmp_path)).collect()
    assert {r["customer"] for r in label} == {c for c, _ in want} and any(r["status"] for r in label)


def test_fingerprint_tells_altered_contents_but_not_order(spark, tmp_path):
    import pyspark.sql.functions as F

    def of(name, df):
        df.write.parquet(f"{tmp_path}/{name}/events.parquet")
        return {tuple(r) for r in QUERIES["ag40_content_fingerprint"](spark, f"{tmp_path}/{name}").collect()}

    events = _table(spark, "events")
    first = events.agg(F.min("event_id")).first()[0]
    one, base = F.col("event_id") == first, of("base", events)
    assert len(base) == events.select("event_type").distinct().count() and all(None not in r for r in base)
    assert of("order", events.repartition(7).orderBy(F.desc("event_id"))) == base
    for c, other in {"value": F.col("value") + 1, "props": F.lit("{}"), "user_id": F.col("user_id") + 1, "ts": F.expr("ts + INTERVAL 1 SECOND")}.items():
        got = of(c, events.withColumn(c, F.when(one, other).otherwise(F.col(c))))
        assert len(got - base) == 1 and {r[:2] for r in got} == {r[:2] for r in base}


def test_fingerprint_tells_the_place_of_a_null(spark):
    from tideline.operators import quality

    got = [quality.fingerprint(spark.createDataFrame([(1, *r)], "g int, a long, b long"), ["a", "b"], ["g"]).first()["hash_xor"] for r in ((5, None), (None, 5))]
    assert got[0] != got[1]
