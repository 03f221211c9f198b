"""Golden cases on small frames, edge cases, and independence of partitioning."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tideline.functions import scalar
from tideline.operators import bars, joins, pit, quality, sweeps, windows


def test_volume_bars_close_at_the_threshold_and_start_at_zero(spark):
    rows = [("A", i, p, v) for i, (p, v) in enumerate([(10.0, 100), (10.1, 200), (10.2, 300), (10.3, 100), (10.4, 50)])]
    out = bars.activity_bars(spark.createDataFrame(rows, "symbol string, t int, price double, volume long"), "symbol", ["t"], 500).orderBy("bar").collect()
    assert [(r["bar"], r["volume"], r["n_trades"]) for r in out] == [(0, 600, 3), (1, 150, 2)]
    assert out[0]["amount"] / out[0]["volume"] == pytest.approx((10.0 * 100 + 10.1 * 200 + 10.2 * 300) / 600)


def test_activity_bars_drop_nulls_and_refuse_bad_prices(spark):
    schema = "symbol string, t int, price double, volume long"
    assert bars.activity_bars(spark.createDataFrame([("A", 1, None, 5)], schema), "symbol", ["t"], 5).count() == 0
    with pytest.raises(Exception, match="must be positive"):
        bars.activity_bars(spark.createDataFrame([("A", 1, -1.0, 5)], schema), "symbol", ["t"], 5).collect()


def test_activity_bars_do_not_depend_on_partitioning(spark):
    rows = [(f"S{i % 3}", i, 1.0 + i % 5, 1 + i % 7) for i in range(500)]
    df = spark.createDataFrame(rows, "symbol string, t int, price double, volume long")
    one, many = (bars.activity_bars(df.repartition(n), "symbol", ["t"], 20).orderBy("symbol", "bar").collect() for n in (1, 7))
    assert one == many


def test_tick_rule_carries_the_last_side(spark):
    df = spark.createDataFrame([("A", i, p) for i, p in enumerate([10.0, 10.0, 11.0, 11.0, 9.0])], "symbol string, t int, price double")
    assert [r["side"] for r in bars.trade_sides(df, "symbol", ["t"]).orderBy("t").collect()] == [1, 1, 1, 1, -1]


def test_as_of_label_validity(spark):
    d = lambda x: dt.date(2024, 1, x)
    panel = spark.createDataFrame([("A", d(1)), ("A", d(2)), ("A", d(6)), ("A", d(8)), ("A", d(20)), ("B", d(2))], "symbol string, d date")
    changes = spark.createDataFrame([("A", d(2), d(7), "old"), ("A", d(8), d(15), "new")], "symbol string, start_date date, end_date date, industry string")
    out = joins.as_of_label(panel, changes, "symbol", "d", "start_date", "end_date", "industry").orderBy("d").collect()
    assert [(r["d"].day, r["industry"]) for r in out] == [(1, None), (2, "old"), (6, "old"), (8, "new")]


def test_sequence_quality(spark):
    df = spark.createDataFrame([(1, i, s) for i, s in enumerate([10, 12, 11, 11])], "channel int, i int, seq long")
    r = quality.sequence_quality(df, "channel", "seq", ["i"]).first()
    assert (r["n_duplicates"], r["n_backwards"], r["n_gaps"], r["gap_span"]) == (1, 1, 1, 1)


def test_cross_rank_shares_ties_and_skips_nulls(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 1.0), (1, 3.0), (1, None)], "d int, x double")
    got = sorted((r["r"] for r in df.select(windows.cross_rank("x", "d").alias("r")).collect()), key=lambda v: (v is None, v))
    assert got == [pytest.approx(0.5), pytest.approx(0.5), 1.0, None]


def test_disjoint_union_refuses_a_shared_key(spark):
    a = spark.createDataFrame([(1, 2.0)], "k int, v double")
    with pytest.raises(Exception, match="both tables have one key"):
        joins.disjoint_union(a, a, ["k"]).collect()


def test_replacement_state_emits_zero_rows_on_exit(spark):
    d = lambda x: dt.date(2024, 1, x)
    disclosures = spark.createDataFrame([(1, d(1), 1, 10), (1, d(5), 2, 11)], "fund int, known date, period int, list_id int")
    holdings = spark.createDataFrame([(10, "X", 5.0), (11, "Y", 7.0)], "list_id int, stock string, value double")
    out = {(r["stock"], r["known"].day): (r["n_funds"], r["total"]) for r in pit.replacement_state(disclosures, holdings, "fund", "stock", "known", "period", "value").collect()}
    assert out == {("X", 1): (1, 5.0), ("X", 5): (0, 0.0), ("Y", 5): (1, 7.0)}


def test_clock_and_session_minute(spark):
    rows = [(92500000, 570), (93000000, 570), (93000001, 571), (113000999, 690), (120000000, None), (130000000, 781), (150000001, 900), (256000000, None)]
    df = spark.createDataFrame(rows, "c long, want long").withColumn("got", scalar.session_minute(scalar.clock_ms(F.col("c"))))
    assert all(r["want"] == r["got"] for r in df.collect())


def test_sql_functions(spark):
    scalar.register_sql_functions(spark)
    r = spark.sql("SELECT canonical_code(' 12.sz ') AS a, tolerant_date('20240105.0') AS b, tolerant_date('x') AS c, clock_ms(93000500) AS d").first()
    assert tuple(r) == ("000012.SZ", dt.date(2024, 1, 5), None, 34200500)


def test_field_state_takes_the_last_value_that_is_there(spark):
    rows = [("A", 1, 1, 5.0, None), ("A", 2, 2, None, 7.0), ("A", 3, 3, None, None)]
    r = pit.field_state(spark.createDataFrame(rows, "k string, period int, id int, x double, y double"), "k", ["x", "y"], ["period", "id"]).first()
    assert (r["x"], r["x_id"], r["y"], r["y_id"]) == (5.0, 1, 7.0, 2)


def _interval_case(spark, n, keys, seed, kind="date"):
    rnd = random.Random(seed)
    day = lambda: dt.date(2024, 1, 1) + dt.timedelta(rnd.randrange(60))
    key = lambda: rnd.choice([*range(keys), None])
    spans = [(key(), None if rnd.random() < 0.05 else (a := day()), None if rnd.random() < 0.1 else a + dt.timedelta(rnd.randrange(-2, 25)), rnd.choice("abc"), i % 3) for i in range(n)]
    asked = [(key(), None if rnd.random() < 0.05 else day(), i) for i in range(2 * n)]
    return asked, spans


def test_interval_sweeps_equal_brute_force(spark):
    for seed, (n, keys) in enumerate([(60, 2), (40, 6), (5, 1)]):
        asked, spans = _interval_case(spark, n, keys, seed)
        df, iv = spark.createDataFrame(asked, "k int, d date, i int"), spark.createDataFrame(spans, "k int, a date, z date, label string, n int")
        holds = lambda k, d: [(a, (lab, m)) for s, a, z, lab, m in spans if k is not None and d and s == k and a and a <= d and (z is None or d <= z)]
        want = {i: max(holds(k, d))[1] if holds(k, d) else (None, None) for k, d, i in asked}
        got = joins.interval_member(df, iv, "k", "d", "a", "z", ["label", "n"]).collect()
        assert len(got) == len(asked) and {r["i"]: (r["label"], r["n"]) for r in got} == want
        inside = {(k, d) for k, d, i in asked if k is not None and d and any(s == k and (a is None or a <= d) and (z is None or d <= z) for s, a, z, *_ in spans)}
        assert {tuple(r) for r in sweeps.covered(df, iv, "k", "d", "a", "z").collect()} == inside
        for ahead in (False, True):
            got = {(r["k"], r["d"]): r["e"] for r in sweeps.nearest(df, iv, "k", "d", "a", "e", ahead=ahead).collect()}
            near = lambda k, d, ahead=ahead: [a for s, a, *_ in spans if k is not None and d and s == k and a and (a > d if ahead else a < d)]
            assert got == {(k, d): (min if ahead else max)(near(k, d), default=None) for k, d, _ in asked}
    assert joins.interval_member(df.limit(0), iv, "k", "d", "a", "z", ["label"]).count() == 0
    assert {r["label"] for r in joins.interval_member(df, iv.limit(0), "k", "d", "a", "z", ["label"]).collect()} == {None}


def test_intervals_of_one_key_are_swept_in_linear_time(spark):
    """One key with 100,000 nested and overlapping intervals and as many times: pairs would be 10**10."""
    n = 100_000
    spans = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("a"), F.when(F.col("id") % 1000 == 0, F.lit(2 * n)).otherwise(F.col("id") + F.col("id") % 7 - 1).alias("z"), F.col("id").alias("who"))
    df = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("t"))
    out = {r["t"]: r["who"] for r in joins.interval_member(df, spans, "k", "t", "a", "z", ["who"]).collect()}
    for t in range(0, n, 997):
        own = [a for a in range(max(0, t - 6), t + 1) if a % 1000 == 0 or t <= a + a % 7 - 1] + [t - t % 1000]
        assert out[t] == max(own)


def test_rolling_median_equals_a_plain_one(spark):
    rnd = random.Random(9)
    rows = [(s, t, rnd.choice([None, float("nan"), 1.0, 2.5]) if rnd.random() < 0.1 else rnd.randint(0, 40) / 4) for s in range(3) for t in range(400)]
    df = spark.createDataFrame(rows, "s int, t int, x double")
    for size, need in ((1, 1), (4, 4), (60, 30), (250, 200)):
        got = {(r["s"], r["t"]): r["m"] for r in windows.with_rolling_median(df, "x", "s", "t", size, need, "m").collect()}
        for s in range(3):
            own = [x if x is not None and x == x else None for k, _, x in rows if k == s]
            for t in range(400):
                frame = [x for x in own[max(0, t - size + 1) : t + 1] if x is not None]
                assert got[s, t] == (statistics.median(frame) if len(frame) >= need else None)
