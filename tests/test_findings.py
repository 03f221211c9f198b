"""Queries that differed from their SQL, took too long or held too much, on small tables that show it."""

import datetime as dt

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from oracle import same
from pyspark.sql import functions as F

from tideline.operators import bars, disclosures, joins, quality
from tideline.plans import registry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


def _events(tmp_path, change):
    rows = pq.read_table(f"{SF}/events.parquet").to_pylist()
    for r in rows:
        change(r)
    pq.write_table(pa.Table.from_pylist(rows, pq.read_schema(f"{SF}/events.parquet")), f"{tmp_path}/events.parquet")
    return str(tmp_path)


def _lines(tmp_path, rows):
    """Line items of quantity 1: (supplier, price), all of one day."""
    day = dt.datetime(1996, 1, 2)
    cols = {"l_orderkey": range(len(rows)), "l_partkey": [1] * len(rows), "l_suppkey": [s for s, _ in rows], "l_linenumber": [1] * len(rows), "l_quantity": [1.0] * len(rows), "l_extendedprice": [p for _, p in rows]}
    cols |= {"l_returnflag": ["N"] * len(rows), "l_shipdate": [day] * len(rows)}
    pq.write_table(pa.table({k: list(v) for k, v in cols.items()}), f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_minute_flags_sql_drops_thirteen_without_flow(spark, tmp_path):
    def still(r):
        if r["event_id"] % 3 == 0:
            r["value"], r["ts"] = 0.0, dt.datetime(2024, 1, 2, 13, 0, 30)

    sf = _events(tmp_path, still)
    same(spark, sf, QUERIES["pr14_minute_flags"], SQL["pr14_minute_flags"])
    assert QUERIES["pr14_minute_flags"](spark, sf).where("NOT off_session AND NOT keep AND event_id % 3 = 0 AND NOT (is_empty OR partial_null OR non_finite OR invalid_ticker OR invalid_timestamp OR wrong_year OR non_minute OR negative_flow)").count()


def test_tick_triage_sql_reads_prices(spark, tmp_path):
    def cheap(r):
        r["value"] = {0: 0.0, 1: -r["value"], 2: None}.get(r["event_id"] % 5, r["value"])

    same(spark, _events(tmp_path, cheap), QUERIES["pr24_tick_triage"], SQL["pr24_tick_triage"])


def test_equal_amounts_are_ordered_by_symbol(spark, tmp_path):
    """Both suppliers sell for 0.6, but their sums differ in the last bit by the order of the lines."""
    sf = _lines(tmp_path, [(1, 0.3), (2, 0.1), (1, 0.2), (2, 0.2), (1, 0.1), (2, 0.3), (3, 0.7)])
    assert 0.1 + 0.2 + 0.3 > 0.3 + 0.2 + 0.1
    assert [(r["symbol"], r["place"]) for r in QUERIES["tk04_ordered_output"](spark, sf).collect()] == [(3, 1), (1, 2), (2, 3)]
    same(spark, sf, QUERIES["tk04_ordered_output"], SQL["tk04_ordered_output"])


def test_wide_rows_hold_every_symbol_and_day_in_one_pass(spark, monkeypatch):
    rows = [(d, s, 10.0 * d + s) for d in range(30) for s in range(7) if (d + s) % 4] + [(90, None, 1.0), (91, 3, None)]
    long = spark.createDataFrame(rows, "d int, s int, x double")
    want = {d: {"d": d} | {f"s_{s}": 10.0 * d + s if (d + s) % 4 and d < 90 else None for s in range(7)} for d in (*range(30), 90, 91)}
    for cells in (1, 20, 1_000_000):
        monkeypatch.setattr(bars, "CELLS", cells)
        out = bars.wide_rows(long.repartition(5), "d", "s", "x")
        got = out.collect()
        assert len(got) == 32 and {r["d"]: r.asDict() for r in got} == want
    names = spark.createDataFrame([(dt.date(2024, 1, 1 + i % 3), f"n{i % 5}", i) for i in range(15)], "d date, s string, x long")
    assert sum(v for r in bars.wide_rows(names, "d", "s", "x").collect() for v in r[1:]) == sum(range(15))


def test_wide_panel_scans_its_input_the_same_number_of_times_for_any_width(spark, tmp_path):
    """The whole job has one plan; it was run anew for each group of 40 suppliers."""
    plan = QUERIES["wn35_wide_panel"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Join Inner" not in plan and plan.count("lineitem") + plan.count("Relation") <= 3
    calls = spark.sparkContext.accumulator(0)

    def seen(x):
        calls.add(1)
        return x

    long = spark.range(60).select((F.col("id") % 6).alias("d"), (F.col("id") % 10).alias("s"), F.udf(seen, "long")("id").cast("double").alias("x"))
    bars.wide_panel(long, "d", "s", "x", f"{tmp_path}/w", width=2)
    assert calls.value <= 120


def test_wide_panel_equals_sql(spark):
    same(spark, SF, QUERIES["wn35_wide_panel"], SQL["wn35_wide_panel"])


def test_wide_panel_reads_its_trades_once(spark, monkeypatch):
    """The panel was joined with its own factors, so that the trades were read and summed up three times."""
    out = QUERIES["wn35_wide_panel"](spark, SF)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    want = {r["d"]: r.asDict() for r in out.collect()}
    monkeypatch.setattr(bars, "WIDE", 1)
    out = QUERIES["wn35_wide_panel"](spark, SF)
    assert {r["d"]: r.asDict() for r in out.collect()} == want
    dealt = [x for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning(d#" in x]
    assert dealt and all("REPARTITION_BY_NUM" in x and f" {spark.sparkContext.defaultParallelism})" in x for x in dealt)


def test_wide_panel_leaves_out_trades_without_symbol_or_day_as_sql_does(spark, tmp_path):
    sf = _lines(tmp_path, [(1, 3.0), (2, 5.0), (None, 7.0), (3, 9.0)])
    t = pq.read_table(f"{sf}/lineitem.parquet").to_pydict()
    t["l_shipdate"][3], t["l_suppkey"] = None, pa.array(t["l_suppkey"], pa.int64())
    pq.write_table(pa.table(t), f"{sf}/lineitem.parquet")
    for name in ("wn35_adjusted_panel", "wn35_wide_panel"):
        same(spark, sf, QUERIES[name], SQL[name])


def test_ranks_do_not_sort_a_group_in_one_task(spark, monkeypatch):
    """Ranges of a group are ranked apart; ties, nulls and small groups keep their average rank."""
    monkeypatch.setattr(quality, "PICKED", 3)
    rows = [(None if g == 2 else g, float(i * 7919 % 400 // (1 + g)) if i % 50 else None, (i * 31 + g) % 97) for g in range(3) for i in range(400)] + [(9, 1.0, 1), (9, 1.0, 2), (9, 1.0, 3)]
    df = spark.createDataFrame(rows, "g int, a double, b long")
    got = {r["g"]: (r["n"], r["rank_corr"]) for r in quality.rank_correlation(df, "a", "b", ["g"]).collect()}
    frame = pd.DataFrame(rows, columns=["g", "a", "b"]).dropna(subset=["a"])
    want = {None if np.isnan(g) else int(g): (len(x), x["a"].rank().corr(x["b"].rank())) for g, x in frame.groupby("g", dropna=False)}
    assert set(got) == set(want) and got[9] == (3, None)
    assert all(got[g][0] == n and (g == 9 or abs(got[g][1] - c) < 1e-9) for g, (n, c) in want.items())
    plan = quality.with_average_rank(df.dropna(subset=["a"]), "a", ["g"], "r")
    assert plan.select("r").distinct().count() > 50 and "_range" in plan._jdf.queryExecution().analyzed().toString()


def test_expanded_days_are_not_shuffled(spark):
    """Intervals in each other, of one start, and open ones, against every day looked at alone."""
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(i)
    spans = [(s, day(i * 11 % 37), None if i % 6 == 5 else day(i * 11 % 37 + i * 13 % 29), f"n{i % 4}") for s in range(4) for i in range(s, s + 3 * s + 1)] + [(7, day(3), day(30), "a"), (7, day(3), day(9), "b"), (7, day(5), day(6), "c"), (7, day(90), None, "d")]
    cal = [day(i) for i in range(60) if i % 3]
    out = disclosures.expand_intervals(spark.createDataFrame(spans, "s int, a date, z date, n string"), spark.createDataFrame([(d,) for d in cal], "d date"), "s", "a", "z", "n", "d")
    want = {}
    for s, a, z, n in spans:
        for d in cal:
            if a <= d <= (z or cal[-1]):
                want[s, d] = max(want.get((s, d), (a, n)), (a, n))
    assert {(r["s"], r["d"]): r["n"] for r in out.collect()} == {k: n for k, (_, n) in want.items()}
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("hashpartitioning(s") == 1


def test_intervals_are_expanded_over_every_open_day(spark):
    """The calendar was cut to the first four days of a month."""
    got = {r[0] for r in QUERIES["jn05_expand_to_the_end"](spark, SF).select("d").distinct().collect()}
    open_ = {d for d in pq.read_table(f"{SF}/lineitem.parquet", columns=["l_shipdate"])["l_shipdate"].cast(pa.date32()).to_pylist() if d.weekday() < 5}
    first = min(got)
    assert {d.day for d in got} == set(range(1, 32)) and got == {d for d in open_ if d >= first}
    same(spark, SF, QUERIES["jn05_expand_to_the_end"], SQL["jn05_expand_to_the_end"])


def test_stretches_do_not_overlap_and_go_from_batch_to_batch(spark):
    """Nested, equal, crossing and closed intervals, nulls in all places, against each day looked at alone; batches of 3 rows.
    Days are neither grouped nor sorted."""
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(i)
    spans = [(None if s == 5 else f"k{s}", day(i * 17 % 41), None if i % 7 == 6 else day(i * 17 % 41 + i * 29 % 31 - 2), None if i % 5 == 4 else i * 3 % 8) for s in range(6) for i in range(1 + s * s)] + [("k9", None, day(9), 1), ("k9", day(50), day(2), 1)]
    cal = [day(i) for i in range(70) if i % 4]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        out = disclosures.expand_intervals(spark.createDataFrame(spans, "s string, a date, z date, n int"), spark.createDataFrame([(d,) for d in cal], "d date"), "s", "a", "z", "n", "d")
        got = [(r["s"], r["d"], r["n"]) for r in out.collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {}
    for s, a, z, n in spans:
        for d in cal:
            if a and a <= d <= (z or cal[-1]):
                want[s, d] = max(want.get((s, d), (a, -1)), (a, -1 if n is None else n))
    assert len(got) == len(want) and {(s, d): -1 if n is None else n for s, d, n in got} == {k: n for k, (_, n) in want.items()}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan.split("MapInArrow")[0]


def _merged_shuffles(df):
    """Shuffles by (symbol, d) or part of it whose partitions adaptive execution may merge."""
    return [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x and "REPARTITION_BY_NUM" not in x and "ENSURE_REQUIREMENTS" in x]


def test_day_volumes_keep_their_number_of_partitions(spark):
    """A task's share of the rows shrinks with the number of partitions only if these are not merged."""
    for name in ("jn10_fusion", "jn11_disjoint_union", "jn24_archive_comparison", "jn25_revision_check", "ag02_daily_bars"):
        assert not [x for x in _merged_shuffles(QUERIES[name](spark, SF)) if "hashpartitioning(symbol" in x], name
    out = QUERIES["pt15_state_panel"](spark, SF)
    assert "REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()


def test_queries_of_the_findings_equal_sql(spark):
    for name in ("jn10_fusion", "jn11_disjoint_union", "jn24_archive_comparison", "jn24_worst_differences", "jn25_revision_check", "ag18_rank_correlation", "wn38_hotspot_features", "wn12_flow_features", "jn04_interval_member_by_order", "jn05_expand_to_the_end", "ql08_exclusion_decision", "pt15_state_panel"):
        same(spark, SF, QUERIES[name], SQL[name])


def test_sweep_carries_its_stack_over_batches(spark):
    """Keys with many dates between starts, nested and closed intervals, against each date looked at alone; batches of 3 rows."""
    spans = [(k, i * 7 % 50, None if i % 5 == 4 else i * 7 % 50 + i * 5 % 23, f"v{i}") for k in range(3) for i in range(2 + 4 * k)]
    df = [(k, d) for k in range(4) for d in range(60)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        out = joins.interval_member(spark.createDataFrame(df, "k int, d long"), spark.createDataFrame(spans, "k int, a long, z long, v string"), "k", "d", "a", "z", ["v"])
        got = {(r["k"], r["d"]): r["v"] for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    held = lambda k, d: max(((a, v) for j, a, z, v in spans if j == k and a <= d and (z is None or d <= z)), default=(0, None))[1]
    assert got == {(k, d): held(k, d) for k, d in df}
    assert plan.count("REPARTITION_BY_NUM") >= 3
