"""Golden cases of sources, normalisation, gates, disclosures, features, audits and streams on small frames."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tideline.functions import scalar
from tideline.operators import audits, disclosures, features, gates, joins, normalize, pit, quality, windows
from tideline.sources import files, layouts, payloads
from tideline.streaming import flows, sequences


def day(n, month=1, year=2024):
    return dt.date(year, month, n)


def one(df):
    return df.first().asDict()


def test_market_symbols_and_boards(spark):
    want = {" 600000.xshg": "600000.SH", "1.sz": "000001.SZ", "688001": "688001.SH", "1": "000001.SZ", "430001": "430001", "920001.bj": "920001.BJ", "1.bj": "1.BJ", "AAPL": "AAPL", "": ""}
    want |= {"510300": "510300.SH", "900901": "900901.SH", "689009": "689009.SH", "200012": "200012.SZ", "301001": "301001.SZ", "159915": "159915", "159915.xshe": "159915.SZ", "7": "000007.SZ", "1234567": "1234567"}
    df = spark.createDataFrame([(k, v) for k, v in want.items()] + [(None, "")], "raw string, want string")
    assert all(r["got"] == r["want"] for r in df.withColumn("got", normalize.market_symbol(F.col("raw"), "a_share")).collect())
    boards = {"688001.SH": "STAR", "300001.sz": "CHINEXT", "920001.BJ": "BSE", "600000.SH": "MAIN"}
    df = spark.createDataFrame(list(boards.items()), "s string, want string")
    assert all(r["got"] == r["want"] for r in df.withColumn("got", normalize.board(F.col("s"))).collect())


def test_aliases_need_a_required_column(spark):
    df = spark.createDataFrame([(1, 2)], "ts_code int, x int")
    assert normalize.rename_aliases(df, {"symbol": ["code", "ts_code"]}, ["symbol"]).columns == ["symbol", "x"]
    with pytest.raises(ValueError, match="no column for"):
        normalize.rename_aliases(df, {"symbol": ["code"]}, ["symbol"])


def test_join_keys_are_repaired(spark):
    key, changed = normalize.repair_join_key(F.col("c"))
    rows = [("123456!1.sh",), (" 600000.SH",), (None,), ("12345!1.SH",), ("1234567!1.SH",), ("123456!2.SH",), ("123456!1.BJ",)]
    got = spark.createDataFrame(rows, "c string").select(key.alias("k"), changed.alias("r")).collect()
    assert [tuple(r) for r in got] == [("1234561.SH", True), ("600000.SH", False), ("", False), ("12345!1.SH", False), ("1234567!1.SH", False), ("123456!2.SH", False), ("123456!1.BJ", False)]


def test_minute_flags(spark):
    at = lambda h, m, s=0: int(dt.datetime(2024, 3, 5, h, m, s, tzinfo=dt.UTC).timestamp())
    schema = "n string, ticker string, epoch long, open double, high double, low double, close double, volume double, amount double"
    rows = [
        ("good", "A", at(9, 30), 1.0, 1.0, 1.0, 1.0, 5.0, 5.0), ("empty", "A", at(9, 31), None, None, None, None, None, float("nan")), ("noon", "A", at(13, 0), 1.0, 1.0, 1.0, 1.0, 0.0, 0.0),
        ("off", "A", at(12, 0), 1.0, 1.0, 1.0, 1.0, 1.0, 1.0), ("second", "A", at(9, 32, 5), 1.0, 1.0, 1.0, 1.0, 1.0, 1.0), ("nobody", None, at(9, 33), 1.0, 1.0, 1.0, 1.0, 1.0, 1.0),
        ("inf", "A", at(9, 34), 1.0, float("inf"), 1.0, 1.0, 1.0, 1.0), ("neg", "A", at(9, 35), 1.0, 1.0, 1.0, 1.0, -1.0, 1.0), ("part", "A", at(9, 36), None, 1.0, 1.0, 1.0, 1.0, 1.0), ("untimed", "A", None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0),
        ("free", "A", at(9, 37), 1.0, 1.0, 1.0, 1.0, 0.0, 1.0), ("unpaid", "A", at(9, 38), 1.0, 1.0, 1.0, 1.0, 1.0, 0.0),
    ]
    out = {r["n"]: r for r in normalize.minute_flags(spark.createDataFrame(rows, schema), 2024).collect()}
    flag = {"empty": "is_empty", "noon": "dropped_zero_flow", "off": "off_session", "second": "non_minute", "nobody": "invalid_ticker", "inf": "non_finite", "neg": "negative_flow", "part": "partial_null", "untimed": "invalid_timestamp"}
    assert [n for n, r in out.items() if r["keep"]] == ["good", "free", "unpaid"]
    assert [n for n, r in out.items() if r["zero_volume_nonzero_amount"]] == ["free"] and [n for n, r in out.items() if r["positive_volume_zero_amount"]] == ["unpaid"]
    assert all(out[n][f] for n, f in flag.items())


def test_bars_are_repaired_and_placeholders_dropped(spark):
    rows = [(9.9, 9.8, 10.3, 10.0, 1.0, 1.0), (None,) * 6]
    r = normalize.repair_bars(spark.createDataFrame(rows, "open double, high double, low double, close double, volume double, amount double")).collect()
    assert [(x["high"], x["low"], x["repaired"]) for x in r] == [(10.3, 9.8, True)]


def test_persons_and_institutions(spark):
    rows = [("王小明", "", False), ("某某投资", "", False), ("某某投资公司", "", True), ("Big Fund", None, False), ("QFII 账户", "", True), ("国有资产管理委员会", "", True), ("养老金计划", "", True), ("Foo LLC", "", True), ("Foo Ltd", "", True), ("中央汇金", "", False), ("中央汇金公司", " ", True), ("x", "自然人", False), ("x", " 个人 ", False), ("x", "机构", True), (None, None, False)]
    df = spark.createDataFrame(rows, "n string, k string, want boolean").withColumn("got", normalize.is_institution(F.col("n"), F.col("k")))
    assert all(bool(r["got"]) == r["want"] for r in df.collect())


def test_dated_identity_and_codes(spark):
    df = spark.createDataFrame([("A", day(1)), ("A", day(9)), ("B", day(1)), ("C", day(1))], "code string, d date")
    known = spark.createDataFrame([("A", "id-a"), ("B", "id-b")], "code string, identity string")
    over = spark.createDataFrame([("A", day(5), None, "id-new")], "code string, from_date date, to_date date, identity string")
    assert [r["identity"] for r in normalize.research_identity(df, "code", "d", known, over).orderBy("code", "d").collect()] == ["id-a", "id-new", "id-b", "unresolved:C"]
    switches = spark.createDataFrame([("A", "OLD", day(5))], "new_code string, old_code string, first_day date")
    assert [r["active_code"] for r in normalize.dated_code(df, "code", "d", switches).orderBy("code", "d").collect()] == ["OLD", "A", "B", "C"]


def test_readers_by_suffix(spark, tmp_path):
    spark.range(3).select("id", F.lit("007").alias("code"), F.lit(None).cast("string").alias("none")).write.option("header", True).csv(f"{tmp_path}/t.csv")
    assert files.read_file(spark, f"{tmp_path}/t.csv", ["code"]).columns == ["code"]
    assert dict(files.read_typed_csv(spark, f"{tmp_path}/t.csv", ["id", "code", "none"]).dtypes) == {"id": "bigint", "code": "string", "none": "string"}
    for bad in (lambda: files.read_file(spark, "x.xls"), lambda: files.read_file(spark, f"{tmp_path}/t.csv", ["y"]), lambda: files.read_typed_csv(spark, f"{tmp_path}/t.csv", ["id"]), lambda: files.answer(spark, "SELECT 1", f"{tmp_path}/o", "xml")):
        with pytest.raises(ValueError):
            bad()
    assert [r["value"] for r in files.answer(spark, "SELECT 1 AS a, 'x' AS b", f"{tmp_path}/text", "text").collect()] == ["1\tx"]


def test_symbol_buckets_are_read_alone(spark, tmp_path):
    df = spark.createDataFrame([(s, day(d), k) for s in "ABCDEFGH" for d in (1, 2) for k in (1, 2)], "symbol string, d date, k int")
    layer = layouts.by_symbol(df, f"{tmp_path}/l", symbol="symbol", date="d", order=[F.desc("k")], buckets=4)
    assert sorted((r["d"].day, r["k"]) for r in layouts.read_symbols(layer, ["C"], buckets=4).collect()) == [(1, 2), (2, 2)]


def test_quarantine_without_bad_rows(spark, tmp_path):
    good, bad = layouts.quarantine(spark.range(3), F.lit(None).cast("string"), f"{tmp_path}/q")
    assert (good.count(), bad.count()) == (3, 0)


def test_research_frame_refuses_keys_that_stand_twice(spark):
    base = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, x double")
    asset = spark.createDataFrame([(1, 5.0), (1, 6.0)], "k int, v double")
    with pytest.raises(Exception, match="twice"):
        layouts.research_frame(base, [("a", asset, "left")], ["k"]).collect()
    assert layouts.research_frame(base, [("a", asset.limit(0), "left")], ["k"]).count() == 2


def test_payloads(spark):
    docs = [(1, '{"series":[{"code":"a","points":[{"t":"2024","v":"1,234.5"},{"t":"2025","v":null}]}]}'), (2, "<html>"), (3, None)]
    out = payloads.series_observations(spark.createDataFrame(docs, "id int, body string"), "id", "body").collect()
    assert [tuple(r) for r in out] == [(1, "a", "2024", 1234.5), (1, "a", "2025", None)]
    k = payloads.kline_rows(spark.createDataFrame([(1, ["t,1,2", "t,1", "t,x,2", ""])], "id int, l array<string>"), "id", "l", ["a", "b"])
    assert [r["malformed"] for r in k.collect()] == [False, True, True, True]


def test_check_tables_and_verdicts(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, -1.0)], "k int, x double")
    table = lambda *names: gates.check_table(df, {n: c for n, c in {"null": ("warning", F.col("x").isNull()), "negative": ("error", F.col("x") < 0)}.items() if n in names})
    assert one(gates.verdict(table("null", "negative"), 0.5)) == {"n_errors": 1, "n_warnings": 1, "worst_rate": pytest.approx(1 / 3), "verdict": "fail"}
    assert one(gates.verdict(table("null"), 0.5))["verdict"] == "pass" and one(gates.verdict(table("null"), 0.1))["verdict"] == "warn"
    assert one(gates.verdict(gates.check_table(df.limit(0), {"null": ("warning", F.col("x").isNull())}), 0.1))["verdict"] == "pass"


def test_factor_pivot_refuses_unknown_and_repeated_factors(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0)], "k int, f string, v double")
    assert one(gates.factor_wide(df, ["k"], "f", "v", ["a", "b"])) == {"k": 1, "a": 1.0, "b": 2.0}
    for bad, names, why in ((df, ["a"], "unknown factor"), (df.union(df), ["a", "b"], "twice")):
        with pytest.raises(Exception, match=why):
            gates.factor_wide(bad, ["k"], "f", "v", names).collect()


def test_exclusions_are_counted(spark):
    df = spark.createDataFrame([(1, day(1)), (1, day(1)), (2, day(2))], "s int, d date")
    bad = spark.createDataFrame([(1, day(1)), (9, day(9))], "s int, d date")
    kept, said = gates.exclude_days(df, bad, ["s", "d"])
    assert [r["s"] for r in kept.collect()] == [2] and one(said) == {"n_rows": 3, "n_excluded": 2, "n_unmatched": 1}


def test_range_reads_refuse_missing_columns_and_repeated_keys(spark):
    df = spark.createDataFrame([(1, day(1), 1.0), (1, day(1), 2.0), (2, day(9), 1.0)], "s int, d date, x double")
    read = lambda cols, to: gates.range_read(df, cols, ["s", "d"], "d", F.lit(day(2)) if to == 9 else F.lit(day(1)), F.lit(day(to)))
    assert [r["s"] for r in read(["s", "d"], 9).collect()] == [2]
    with pytest.raises(ValueError, match="lacks"):
        read(["y"], 9)
    with pytest.raises(Exception, match="twice"):
        read(["s", "d"], 2).collect()


def test_day_acceptance(spark):
    bars = spark.createDataFrame([(day(1), s, v) for s in "AB" for v in (1, 2)] + [(day(2), "A", 1), (day(2), "A", 9), (day(2), "C", 1)], "d date, s string, v int")
    due = spark.createDataFrame([(day(d), s) for d in (1, 2, 3) for s in "AB"], "d date, s string")
    out = {r["d"].day: r for r in gates.day_acceptance(bars, due, "d", "s", 2, {"big": F.col("v") > 5}).collect()}
    assert [out[d]["accepted"] for d in (1, 2, 3)] == [True, False, False]
    assert (out[2]["n_missing"], out[2]["n_unexpected"], out[2]["n_odd_shape"], out[2]["big"], out[3]["n_missing"]) == (1, 1, 1, 1, 2)


def test_absence_and_listing(spark):
    missing = spark.createDataFrame([(s, day(5)) for s in "ABCD"], "s string, d date")
    suspends = spark.createDataFrame([("A", day(5), "S"), ("B", day(5), "S"), ("B", day(5), "R")], "s string, d date, kind string")
    pauses = spark.createDataFrame([("C", day(1), None)], "s string, start date, end date")
    assert {r["s"]: r["reason"] for r in gates.explain_absence(missing, suspends, pauses, "s", "d").collect()} == {"A": "suspended", "B": "unexplained", "C": "paused", "D": "unexplained"}
    listed = spark.createDataFrame([("A", day(1), None), ("B", day(9), None), ("C", day(1), day(3))], "s string, start date, end date")
    assert {r["s"]: r["state"] for r in gates.expected_universe(missing, listed, "d", "s").collect()} == {"A": "expected", "B": "before_listing", "C": "unexplained", "D": "unexplained"}


def test_calendar_exactness_and_verdict(spark):
    cal = spark.createDataFrame([(day(d),) for d in (1, 2, 3, 4)], "d date")
    px = spark.createDataFrame([("A", day(1)), ("A", day(2)), ("A", day(3)), ("B", day(1)), ("B", day(4)), ("B", day(6))], "s string, d date")
    out = {r["s"]: (r["n_missing"], r["n_extra"], r["exact"]) for r in gates.calendar_exactness(cal, px, "s", "d").collect()}
    assert out == {"A": (0, 0, True), "B": (2, 1, False)}
    good = spark.createDataFrame([(day(1), 1), (day(2), 0)], "d date, f int")
    assert one(gates.calendar_verdict(good, "d", "f"))["passed"]
    assert not one(gates.calendar_verdict(good.union(spark.createDataFrame([(day(2), 1)], "d date, f int")), "d", "f"))["passed"]


def test_announcements_as_of(spark):
    rows = [("A", "20231231", "20240101", None, "1", "0", 1.0), ("A", "20231231", "20240105", None, "1", "1", 2.0), ("A", "20231231", "20240103", "20240102", "5", "1", 3.0), ("A", "20231231", None, None, "1", "1", 4.0)]
    e = disclosures.announcement_events(spark.createDataFrame(rows, "ts_code string, end_date string, ann_date string, f_ann_date string, report_type string, update_flag string, value double"), "income").withColumn("symbol", F.col("ts_code"))
    assert e.count() == 3 and e.select("event_id").distinct().count() == 3
    at = lambda d, policy: sorted(r["value"] for r in disclosures.announced_as_of(e, F.lit(day(d)), policy).collect())
    assert (at(1, "standard"), at(4, "standard"), at(9, "standard"), at(9, "diagnostic_including_type5"), at(9, "all")) == ([1.0], [1.0], [2.0], [2.0, 3.0], [2.0, 3.0])


def test_version_ledger_uses_the_local_date(spark):
    rows = spark.createDataFrame([("20261001", None, dt.datetime(2026, 10, 2, 8)), ("20261001", None, dt.datetime(2026, 10, 2, 20)), ("20261009", "20261011", dt.datetime(2026, 10, 2, 8))], "ann_date string, f_ann_date string, seen timestamp_ntz")
    assert [r["available_from"] for r in disclosures.version_ledger(rows, "seen", "Asia/Shanghai", 1).collect()] == [day(3, 10, 2026), day(4, 10, 2026), day(12, 10, 2026)]
    with pytest.raises(ValueError):
        disclosures.version_ledger(rows, "seen", "Asia/Shanghai", 0)
    with pytest.raises(Exception, match="lacks its disclosure"):
        disclosures.version_ledger(rows.withColumn("ann_date", F.lit(None).cast("string")), "seen", "Asia/Shanghai", 1).collect()


def test_categories_in_conflict_are_decided(spark):
    rows = [("A", 1, "1", 10.0, 5.0), ("A", 1, "2", 11.0, 5.0), ("B", 1, "1", 1.0, None), ("C", 1, "1", 1.0, 1.0), ("C", 1, "2", 1.0, None)]
    df = spark.createDataFrame(rows, "s string, p int, comp_type string, revenue double, profit double")
    found = disclosures.category_conflicts(df, ["s", "p"], "comp_type", ["revenue", "profit"])
    assert {r["s"]: r["fields"] for r in found.collect()} == {"A": "revenue", "C": "profit"}
    kept, errors = disclosures.decided(df, found, spark.createDataFrame([("A", 1, "2"), ("B", 1, "1")], "s string, p int, chosen string"), ["s", "p"], "comp_type")
    assert sorted((r["s"], r["comp_type"]) for r in kept.collect()) == [("A", "2"), ("B", "1")]
    assert {r["s"]: r["error"] for r in errors.collect()} == {"B": "needless", "C": "undecided"}


def test_consensus_hides_conflicts_and_the_future(spark):
    rows = [("A", 1.0, day(1)), ("A", 1.0, day(5)), ("B", 1.0, day(1)), ("B", 2.0, day(2)), ("C", None, day(1)), ("C", 3.0, day(1))]
    f = disclosures.field_consensus(spark.createDataFrame(rows, "s string, v double, at date"), ["s"], ["v"], "at")
    asked = spark.createDataFrame([(s,) for s in "ABCD"], "s string")
    read = lambda d: {r["s"]: (r["status"], r["v"]) for r in disclosures.exact_read(asked, f, ["s"], F.lit(day(d)), "v").collect()}
    assert read(3) == {"A": ("not_yet", None), "B": ("conflict", None), "C": ("conflict", None), "D": ("out_of_scope", None)}
    assert read(5)["A"] == ("available", 1.0)


def test_corporate_actions_and_timing(spark):
    rows = [("A", 1, 0.5, day(1)), ("A", 1, 0.5, None), ("B", 1, 0.5, day(1)), ("B", 1, 0.6, day(1)), ("C", 1, 0.5, None)]
    out = {r["s"]: (r["state"], r["why"]) for r in disclosures.corporate_actions(spark.createDataFrame(rows, "s string, k int, cash double, ex date"), ["s", "k"], ["cash", "ex"], ["ex"]).collect()}
    assert out == {"A": ("ready", ""), "B": ("blocked", "cash:conflict"), "C": ("blocked", "ex:missing")}
    h = spark.createDataFrame([("A", day(10)), ("B", day(10)), ("C", day(10)), ("D", day(10))], "s string, d date")
    e = spark.createDataFrame([("A", day(10)), ("A", day(9)), ("B", day(8)), ("B", day(12)), ("C", day(12))], "s string, d date")
    got = {r["s"]: (r["timing"], r["evidence"] and r["evidence"].day) for r in disclosures.announcement_timing(h, e, "s", "d", 5).collect()}
    assert got == {"A": ("same_day", 10), "B": ("prior", 8), "C": ("later", 12), "D": ("none", None)}


def test_intervals_expand_to_their_end(spark):
    cal = spark.createDataFrame([(day(d),) for d in (1, 2, 3, 5, 8, 9)], "d date")
    spans = spark.createDataFrame([("A", day(1), day(5), "old"), ("A", day(3), None, "new"), ("B", day(20), None, "late")], "s string, a date, z date, n string")
    out = [(r["d"].day, r["n"]) for r in disclosures.expand_intervals(spans, cal, "s", "a", "z", "n", "d").orderBy("d").collect()]
    assert out == [(1, "old"), (2, "old"), (3, "new"), (5, "new"), (8, "new"), (9, "new")]


def test_interval_member_needs_no_unique_rows(spark):
    df = spark.createDataFrame([("A", day(5)), ("A", day(5)), ("A", day(30)), ("B", None)], "k string, d date")
    spans = spark.createDataFrame([("A", day(1), day(9), "x"), ("A", day(3), day(6), "y")], "k string, start date, end date, v string")
    assert [r["v"] for r in joins.interval_member(df, spans, "k", "d", "start", "end", ["v"]).orderBy("k", "d").collect()] == ["y", "y", None, None]


def test_next_session_strict_and_not(spark):
    cal = spark.createDataFrame([(day(2),), (day(5),)], "s date")
    df = spark.createDataFrame([(day(1),), (day(2),), (day(3),), (day(5),), (None,)], "d date")
    got = lambda strict: [r["next_session"] and r["next_session"].day for r in joins.next_session(df, cal, "d", "s", strict).orderBy(F.asc_nulls_last("d")).collect()]
    assert got(True) == [2, 5, 5, None, None] and got(False) == [2, 2, 5, 5, None]


def test_universe_counts_gaps_as_missing(spark):
    days = [day(d) for d in range(1, 32)]
    rows = [("A", d, 10.0) for d in days] + [("B", d, 100.0) for d in days[::10]] + [("C", days[0], 1e9)]
    out = windows.liquidity_universe(spark.createDataFrame(rows, "s string, d date, m double"), spark.createDataFrame([(d,) for d in days], "d date"), symbol="s", date="d", metric="m", lookback=20, need=2, least=1, quantile=0.0)
    assert sorted((r["s"], r["liq_metric"]) for r in out.collect()) == [("A", 10.0), ("B", 100.0)]


def test_event_features_keep_unknown_amounts_unknown(spark):
    events = spark.createDataFrame([("A", day(2), 1, 1, 0, 5.0, None), ("A", day(4), 1, 0, 1, -2.0, -20.0)], "symbol string, d date, n_events int, n_buys int, n_sells int, net_volume double, net_amount double")
    panel = spark.createDataFrame([("A", day(d), 100.0) for d in range(1, 6)] + [("B", day(3), 1.0)], "symbol string, d date, float_value double")
    out = features.insider_features(events, panel, 2, 3).orderBy("d").collect()
    assert [(r["d"].day, r["net_amount"], r["net_amount_2"], r["n_events_3"], r["since_event"]) for r in out] == [(2, None, None, 1.0, 0), (3, 0.0, 0.0, 1.0, 1), (4, -20.0, -20.0, 2.0, 0)]


def test_book_levels_match(spark):
    left = spark.createDataFrame([(1, "B", 1000, 300), (2, "B", 995, 600), (3, "S", 1010, 400), (4, "S", 1020, 0)], "order_id int, side string, price int, left int")
    got = audits.levels(left, 5)
    assert sorted((r["side"], r["place"], r["price"], r["volume"]) for r in got.collect()) == [("B", 1, 1000, 300), ("B", 2, 995, 600), ("S", 1, 1010, 400)]
    assert all(r["matches"] for r in audits.level_match(got, got).collect())
    assert not all(r["matches"] for r in audits.level_match(got, got.where("side = 'B'")).collect())


def test_eligibility_and_identity(spark):
    checks = spark.createDataFrame([("x", "a", "error"), ("x", "b", "note"), ("y", "a", "warning"), ("z", "a", "ok")], "item string, check string, severity string")
    over = spark.createDataFrame([("x", "a", "note")], "item string, check string, severity string")
    assert {r["item"]: r["eligibility"] for r in audits.eligibility(checks, over, "item").collect()} == {"x": "eligible", "y": "restricted", "z": "eligible"}
    rec = spark.createDataFrame([("m", "a"), ("m", "a"), ("n", "a"), ("n", "b"), ("o", None)], "m string, l string")
    assert {r["m"]: r["status"] for r in audits.identity_evidence(rec, "m", "l").collect()} == {"m": "matched", "n": "conflict", "o": "empty"}


def test_fingerprints_see_changed_contents(spark):
    df = spark.createDataFrame([(i, float(i), None if i % 3 else "x") for i in range(30)], "k int, v double, s string")
    mark = lambda x: [tuple(r) for r in quality.fingerprint(x, ["k", "v", "s"], []).collect()]
    assert mark(df) == mark(df.repartition(7).orderBy(F.desc("k")))
    assert mark(df) != mark(df.withColumn("v", F.when(F.col("k") == 3, 4.0).otherwise(F.col("v")))) and mark(df) != mark(df.withColumn("s", F.coalesce("s", F.lit(""))))


def test_asset_lags(spark):
    rows = [("a", day(1), day(9), 3), ("b", day(8), day(9), 3), ("c", None, day(9), 3)]
    assert [r["stale"] for r in pit.asset_lags(spark.createDataFrame(rows, "a string, x date, t date, n int"), "a", "x", "t", "n").orderBy("a").collect()] == [True, False, False]


def test_sql_functions_equal_the_columns(spark):
    scalar.register_sql_functions(spark)
    texts = [" 20240105", "20240105.0", "2024-01-05 10:00", "2024-1-5", "x", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert all(r["a"] == r["b"] for r in df.select(F.expr("tolerant_date(t)").alias("a"), scalar.tolerant_date(F.col("t")).alias("b")).collect())
    clocks = spark.range(0, 86_400_000, 29_999).withColumnRenamed("id", "ms")
    assert clocks.select(F.expr("session_minute(ms)").alias("a"), scalar.session_minute(F.col("ms")).alias("b")).where("NOT (a <=> b)").count() == 0
    codes = spark.createDataFrame([("115",), ("15",), ("9",)], "c string")
    assert [r[0] for r in codes.select(F.expr("prefix_exchange(c, map('1', 'A', '11', 'B'))")).collect()] == ["B", "A", None]


def _in_batches(spark, folder, batches, schema):
    """A stream that reads one batch of rows after the other."""
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{k}")
        for p in os.listdir(f"{folder}/{k}"):
            os.utime(f"{folder}/{k}/{p}", (1_700_000_000 + k * 100,) * 2)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder)


def test_channel_sequences_across_batches(spark, tmp_path):
    rnd = random.Random(7)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice(["x", None]) if rnd.random() < 0.1 else str(rnd.choice([0, 5000, -9000]) + rnd.randint(0, 60)), k) for k in range(400)]
    stream = _in_batches(spark, f"{tmp_path}/in", [rows[i : i + 100] for i in range(0, 400, 100)], "channel string, seq string, at long")
    for cap in (10_000, 40):
        written = flows.drain(sequences.sequence_quality(stream, "channel", "seq", "at", cap), "update", keyed_state=True)
        assert written.select("batch").distinct().count() == 4
        for r in flows.newest(written, ["channel"]).collect():
            own = [s for c, s, _ in rows if (c or "__global__") == r["channel"]]
            x = [int(s) for s in own if s and s != "x"]
            steps, seen, duplicates, lost = [b - a for a, b in zip(x, x[1:])], set(), 0, False
            for v in x:
                duplicates, lost = duplicates + (v in seen), lost or (v not in seen and len(seen) >= cap)
                if len(seen) < cap:
                    seen.add(v)
            want = (len(own), len(own) - len(x), duplicates, sum(s < 0 for s in steps), sum(s > 1 for s in steps), sum(s - 1 for s in steps if s > 1), len(seen), lost)
            assert tuple(r[c] for c in ("n", "n_non_numeric", "n_duplicates", "n_backwards", "n_gaps", "gap_span", "tracked", "truncated")) == want
            assert r["truncated"] == (cap == 40)


def test_closed_windows_leave_the_state(spark, tmp_path):
    at = lambda hour, minute=0: dt.datetime(2024, 1, 1 + hour // 24, hour % 24, minute)
    batches = [[("a", at(h, 10), h, float(h)) for h in range(6 * k, 6 * k + 6)] for k in range(5)]
    batches[1].append(("a", at(5, 5), 50, -5.0))  # late, inside the watermark of the batch before
    batches[3].append(("a", at(2, 5), 51, -9.0))  # behind the watermark
    stream = _in_batches(spark, f"{tmp_path}/in", batches, "k string, ts timestamp, i long, x double")
    report = []
    out = flows.drain(flows.window_bars(stream, "k", "ts", "i", "x", "1 hour", late="2 hours"), "append", report=report)
    got = {r["start"].day * 24 + r["start"].hour - 24: (r["open"], r["high"], r["low"], r["close"], r["n"]) for r in out.collect()}
    # the newest time is 29:10: windows that end by 27:10 are closed
    assert got == {h: (float(h),) * 4 + (1,) for h in range(27) if h != 5} | {5: (-5.0, 5.0, -5.0, 5.0, 2)}
    late, held = flows.late_and_held(report)
    assert late == 1 and held <= 9


def _files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_upserts_touch_only_their_partitions(spark, tmp_path):
    out = f"{tmp_path}/t"
    put = lambda rows: flows.upsert_partitions(spark.createDataFrame(rows, "k int, v string, at int, d int"), out, ["k", "d"], "at", "d")
    read = lambda: sorted(tuple(r) for r in spark.read.schema("k int, v string, at int, d int").parquet(out).collect())
    put([(1, "new", 5, 1), (2, "a", 1, 2), (3, "x", 1, 3)])
    before = _files(out)
    put([(1, "old", 3, 1), (2, "b", 2, 2), (4, "y", 1, 4)])
    want = [(1, "new", 5, 1), (2, "b", 2, 2), (3, "x", 1, 3), (4, "y", 1, 4)]
    assert read() == want
    kept = {p: t for p, t in _files(out).items() if "d=3/" in p}
    assert kept and kept.items() <= before.items()
    put([(1, "old", 3, 1), (2, "b", 2, 2), (4, "y", 1, 4)])
    assert read() == want


def test_refresh_writes_changed_dates_only(spark, tmp_path):
    out, built = f"{tmp_path}/t", []

    def build(df):
        built.append(sorted(r["d"] for r in df.select("d").distinct().collect()))
        return df.groupBy("d").agg(F.sum("x").alias("x"))

    put = lambda rows: flows.refresh_changed(spark.createDataFrame(rows, "d int, x double"), out, "d", build)
    assert put([(1, 1.0), (2, 2.0), (3, 3.0), (3, 4.0)]) == {"built": 3, "removed": 0}
    before = _files(f"{out}/table")
    assert put([(3, 4.0), (1, 1.0), (2, 5.0), (3, 3.0), (4, 9.0)]) == {"built": 2, "removed": 0} and built[-1] == [2, 4]
    kept = {p: t for p, t in _files(f"{out}/table").items() if "d=1/" in p or "d=3/" in p}
    assert len(kept) == 2 and kept.items() <= before.items()
    assert put([(1, 1.0), (2, 5.0), (4, 9.0)]) == {"built": 0, "removed": 1} and len(built) == 2
    assert put([(1, 1.0), (2, 5.0), (4, 9.0)]) == {"built": 0, "removed": 0}
    assert sorted(tuple(r) for r in spark.read.schema("x double, d int").parquet(f"{out}/table").select("d", "x").collect()) == [(1, 1.0), (2, 5.0), (4, 9.0)]


def test_only_changed_dates_are_computed_anew(spark):
    old = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "d int, x double")
    new = spark.createDataFrame([(1, 1.0), (2, 5.0), (4, 4.0)], "d int, x double")
    cached = spark.createDataFrame([(1, "cached"), (2, "cached"), (3, "cached")], "d int, y string")
    out = flows.recompute_changed(old, new, "d", lambda df: df.select("d", F.lit("fresh").alias("y")), cached)
    assert sorted(tuple(r) for r in out.collect()) == [(1, "cached"), (2, "fresh"), (4, "fresh")]


def test_triage_of_orders_deals_and_snapshots(spark):
    rows = [("A", 1, 7, 1.0), (None, 1, 7, 1.0), ("A", None, 7, 0.0), ("A", 1, 7, None), ("A", 1, None, 1.0), ("A", 1, None, 0.0), ("A", 1, 7, 0.0), ("A", 1, 7, -1.0)]
    t = spark.createDataFrame(rows, "c string, t int, id int, p double")
    got = lambda kind, i: [(r["decision"], r["reason"]) for r in normalize.tick_triage(t, kind, code="c", time="t", price="p", event_id=i).collect()]
    lost = ("exclude", "missing_required_value")
    assert got("deal", "id") == [("keep", ""), lost, lost, lost, ("exclude", "missing_event_id"), ("exclude", "missing_event_id"), ("tag", "special_price_or_event"), ("tag", "special_price_or_event")]
    assert got("snapshot", None) == [("keep", ""), lost, lost, lost, ("keep", ""), *[("tag", "empty_snapshot_price")] * 3]
    with pytest.raises(ValueError):
        normalize.tick_triage(t, "deal", code="c", time="t", price="p")


def test_directions_and_signed_values(spark):
    rows = [("减持", 5.0, 2.0, None), ("增持", -5.0, 2.0, -7.0), ("sell then BUY", 1.0, None, None), (" Buy ", None, 2.0, 3.0), ("return", 4.0, 1.0, 1.0), (None, -4.0, 1.0, 1.0), (None, None, None, None), ("", 0.0, 1.0, None), (None, float("nan"), 1.0, 1.0)]
    df = spark.createDataFrame(rows, "w string, x double, p double, a double")
    out = df.select(*[c.alias(n) for n, c in scalar.signed_trade(F.col("w"), F.col("x"), F.col("p"), F.col("a")).items()]).collect()
    assert [r["direction"] for r in out] == [-1, 1, -1, 1, 1, -1, 1, 1, 1]
    assert [(r["signed_vol"], r["signed_amount"]) for r in out[:8]] == [(-5.0, -0.001), (5.0, 7.0), (-1.0, None), (None, 3.0), (4.0, 1.0), (-4.0, -1.0), (None, None), (0.0, 0.0)]
