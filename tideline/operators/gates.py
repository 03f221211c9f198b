"""Quality gates: checks over tables as rows (check, n_bad), verdicts, reconciliation, coverage and acceptance.

A check table has one row for each check: check, severity, n_bad (offending rows) and n_rows (rows that were looked at).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.sweeps import covered


def check_table(df: DataFrame, checks: dict[str, tuple[str, Column]], by: list[str] | None = None) -> DataFrame:
    """All checks (name to severity and the condition of an offending row) in one scan."""
    by = by or []
    counts = df.groupBy(*by).agg(F.count("*").alias("n_rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(f"_{i}") for i, (_, c) in enumerate(checks.values())])
    rows = F.array(*[F.struct(F.lit(n).alias("check"), F.lit(s).alias("severity"), F.col(f"_{i}").alias("n_bad")) for i, (n, (s, _)) in enumerate(checks.items())])
    return counts.select(*by, "n_rows", F.explode(rows).alias("c")).select(*by, "c.check", "c.severity", "c.n_bad", "n_rows")


def verdict(checks: DataFrame, warning_rate: float, by: list[str] | None = None) -> DataFrame:
    """One row: fail if a check of severity error found anything, warn if the worst warning exceeds its allowed rate."""
    bad, rate = F.col("severity") == "error", F.col("n_bad") / F.greatest("n_rows", F.lit(1))
    out = checks.groupBy(*(by or [])).agg(F.coalesce(F.sum(F.when(bad, F.col("n_bad"))), F.lit(0)).alias("n_errors"), F.coalesce(F.sum(F.when(~bad, F.col("n_bad"))), F.lit(0)).alias("n_warnings"), F.coalesce(F.max(F.when(~bad, rate)), F.lit(0.0)).alias("worst_rate"))
    return out.withColumn("verdict", F.when(F.col("n_errors") > 0, "fail").when(F.col("worst_rate") > warning_rate, "warn").otherwise("pass"))


def repeats(df: DataFrame, keys: list[str]) -> Column:
    """Whether a row shares its key with another row."""
    return F.count("*").over(Window.partitionBy(*keys)) > 1


def research_checks(tolerance: float = 0.01) -> dict[str, tuple[str, Column]]:
    """Checks of a research panel: limits, flags, suspension, listed days, board and stated change."""
    change = F.col("close") / F.col("pre_close") - 1
    return {
        "limit_order": ("error", F.col("up_limit") < F.col("down_limit")),
        "limit_up_flag": ("error", F.col("is_limit_up") != (F.col("close") >= F.col("up_limit"))),
        "limit_down_flag": ("error", F.col("is_limit_down") != (F.col("close") <= F.col("down_limit"))),
        "suspended_with_volume": ("error", F.col("is_suspended") & (F.col("volume") > 0)),
        "listed_days": ("error", F.col("listed_days") < 0),
        "board": ("warning", ~F.col("board").isin("MAIN", "STAR", "CHINEXT", "BSE")),
        "change": ("warning", F.abs(F.col("pct_change") - change) > tolerance),
    }


def reconcile(actual: DataFrame, expected: DataFrame, keys: list[str], measures: list[str], tolerance: float = 1e-9) -> DataFrame:
    """Totals of a manifest against those found, one row for each key and measure: expected, actual, matches."""
    a = actual.select(*keys, *[F.col(m).cast("double").alias(f"_a_{m}") for m in measures])
    e = expected.select(*keys, *[F.col(m).cast("double").alias(f"_e_{m}") for m in measures])
    each = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(f"_e_{m}").alias("expected"), F.col(f"_a_{m}").alias("actual")) for m in measures])
    out = a.join(e, keys, "full_outer").select(*keys, F.explode(each).alias("m")).select(*keys, "m.*")
    close = F.abs(F.col("expected") - F.col("actual")) <= tolerance * F.greatest(F.lit(1.0), F.abs(F.col("expected")))
    return out.withColumn("matches", F.coalesce(close, F.lit(False)))


def asset_checks(keys: list[str], features: list[str], available: str | None = None, date: str | None = None) -> dict[str, tuple[str, Column]]:
    """Checks of a feature asset: null keys, rows without any feature, values that are not finite, early availability."""
    x = [F.col(f).cast("double") for f in features]
    out = {
        "null_key": ("error", reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])),
        "no_feature": ("warning", reduce(lambda a, b: a & b, [v.isNull() for v in x])),
        "not_finite": ("error", reduce(lambda a, b: a | b, [F.isnan(v) | (F.abs(v) == float("inf")) for v in x])),
    }
    return out | ({"available_too_early": ("error", F.col(available) < F.col(date))} if available else {})


def asset_size(df: DataFrame, keys: list[str], symbol: str, features: list[str], least_rows: int, least_symbols: int) -> DataFrame:
    """Rows, symbols, duplicate keys and values present of a feature asset, and whether it is large enough and unique."""
    each = df.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.count(f).alias(f"_{i}") for i, f in enumerate(features)])
    present = sum((F.sum(f"_{i}") for i in range(len(features))), F.lit(0))
    out = each.agg(F.sum("_n").alias("n_rows"), F.countDistinct(symbol).alias("n_symbols"), F.sum(F.col("_n") - 1).alias("n_duplicates"), present.alias("n_values"))
    return out.withColumn("passed", (F.col("n_rows") >= least_rows) & (F.col("n_symbols") >= least_symbols) & (F.col("n_duplicates") == 0))


def factor_wide(factors: DataFrame, keys: list[str], factor: str, value: str, names: list[str]) -> DataFrame:
    """Long factors as one column for each of the given names; a name that is not given is an error, as is a key and
    factor that stand twice."""
    known = F.when(F.col(factor).isin(*names), F.col(factor)).otherwise(F.raise_error(F.concat(F.lit("unknown factor "), F.col(factor))))
    once = factors.withColumn(factor, known).groupBy(*keys, factor).agg(F.count("*").alias("_n"), F.first(value).alias("_v"))
    once = once.withColumn("_v", F.when(F.col("_n") == 1, F.col("_v")).otherwise(F.raise_error(F.lit("a factor stands twice")).cast("double")))
    return once.groupBy(*keys).pivot(factor, names).agg(F.first("_v"))


def exclude_days(df: DataFrame, issues: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows outside the excluded keys, and one row about the decision: n_rows, n_excluded, n_unmatched (issues that no
    row has)."""
    bad = issues.select(*keys).distinct()
    kept = df.join(bad, keys, "left_anti")
    each = df.groupBy(*keys).agg(F.count("*").alias("_n")).join(bad.withColumn("_bad", F.lit(True)), keys, "full_outer")
    said = each.agg(F.sum("_n").alias("n_rows"), F.coalesce(F.sum(F.when(F.col("_bad"), F.col("_n"))), F.lit(0)).alias("n_excluded"), F.count_if(F.col("_n").isNull()).alias("n_unmatched"))
    return kept, said


def session_edges(bars: DataFrame, keys: list[str], time: str, first: str, last: str) -> DataFrame:
    """Per key the issue of a session whose first or last bar is missing (null if both are there)."""
    at = F.date_format(time, "HH:mm")
    out = bars.groupBy(*keys).agg(F.min(at).alias("first_bar"), F.max(at).alias("last_bar"), F.max(at == first).alias("_a"), F.max(at == last).alias("_z"))
    issue = F.when(~F.col("_a") & ~F.col("_z"), "both").when(~F.col("_a"), "no_open").when(~F.col("_z"), "no_close")
    return out.select(*keys, "first_bar", "last_bar", issue.alias("issue"))


def calendar_exactness(calendar: DataFrame, prices: DataFrame, symbol: str, date: str) -> DataFrame:
    """Per symbol the open days of its own span that it lacks, and its days that are no open days."""
    days = calendar.select(date).distinct()
    own = prices.select(symbol, date).distinct()
    span = own.groupBy(symbol).agg(F.min(date).alias("_from"), F.max(date).alias("_to"), F.count("*").alias("n_days"))
    extra = own.join(days, date, "left_anti").groupBy(symbol).agg(F.count("*").alias("n_extra"))
    bounds = days.agg(F.collect_list(date).alias("_days")).select(F.array_sort("_days").alias("_days"))
    inside = F.size(F.filter("_days", lambda x: (x >= F.col("_from")) & (x <= F.col("_to"))))
    out = span.join(F.broadcast(bounds)).withColumn("_open", inside).drop("_days").join(extra, symbol, "left").withColumn("n_extra", F.coalesce("n_extra", F.lit(0)))
    out = out.withColumn("n_missing", F.col("_open") - (F.col("n_days") - F.col("n_extra")))
    return out.select(symbol, "n_days", "n_missing", "n_extra", ((F.col("n_missing") == 0) & (F.col("n_extra") == 0)).alias("exact"))


def explain_absence(missing: DataFrame, suspends: DataFrame, pauses: DataFrame, symbol: str, date: str) -> DataFrame:
    """Why a symbol did not trade: in a pause (symbol, start, end), suspended all day (symbol, date, kind S without R), or
    unexplained."""
    s = suspends.groupBy(symbol, date).agg((F.count_if(F.col("kind") == "S") > 0).alias("_s"), (F.count_if(F.col("kind") == "R") > 0).alias("_r")).where("_s AND NOT _r").select(symbol, date, F.lit(True).alias("_off"))
    paused = covered(missing, pauses.where("start IS NOT NULL"), symbol, date, "start", "end").withColumn("_paused", F.lit(True))
    out = missing.join(paused, [symbol, date], "left").join(s, [symbol, date], "left")
    return out.withColumn("reason", F.when(F.col("_paused"), "paused").when(F.col("_off"), "suspended").otherwise("unexplained")).drop("_paused", "_off")


def registry_gate(dates: DataFrame, registry: DataFrame, date: str) -> DataFrame:
    """Whether any requested date stands in a registry of quarantined ones: n_hits, first_hit, accepted."""
    hits = dates.select(date).distinct().join(registry.select(date).distinct(), date, "left_semi")
    return hits.agg(F.count("*").alias("n_hits"), F.min(date).alias("first_hit")).withColumn("accepted", F.col("n_hits") == 0)


def range_read(panel: DataFrame, columns: list[str], keys: list[str], date: str, start: Column, end: Column, market: Column | None = None) -> DataFrame:
    """Rows of a date range with the columns asked for, ordered by the keys inside each partition; a column that is
    missing is an error at once, a key that stands twice when the rows are read."""
    missing = [c for c in columns if c not in panel.columns]
    if missing:
        raise ValueError(f"the panel lacks {missing}")
    rows = panel.where(F.col(date).between(start, end))
    rows = rows if market is None else rows.where(market)
    twice = F.when(repeats(rows, keys), F.raise_error(F.lit("a key stands twice")).cast("int")).otherwise(F.lit(0))
    return rows.select(*columns, twice.alias("_twice")).where("_twice = 0").drop("_twice")


def cutoff_read(panel: DataFrame, observed: str, at: Column) -> DataFrame:
    """Rows observed at or before a moment; rows without a time are not read."""
    return panel.where(F.col(observed).isNotNull() & (F.col(observed) <= at))


def day_acceptance(bars: DataFrame, expected: DataFrame, date: str, symbol: str, per_symbol: int, issues: dict[str, Column], accepted: DataFrame | None = None) -> DataFrame:
    """One row a date: rows, symbols, symbols of another number of bars, missing and unexpected symbols, issues that are
    not accepted for the date (accepted: date, issue), and the verdict."""
    counts = bars.groupBy(date, symbol).agg(F.count("*").alias("_n"), *[F.count_if(c).alias(f"_{k}") for k, c in issues.items()])
    both = counts.join(expected.select(date, symbol).distinct().withColumn("_due", F.lit(True)), [date, symbol], "full_outer")
    sums = [F.coalesce(F.sum(f"_{k}"), F.lit(0)).alias(k) for k in issues]
    out = both.groupBy(date).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.count("_n").alias("n_symbols"), F.count_if(F.col("_n") != per_symbol).alias("n_odd_shape"),
        F.count_if(F.col("_n").isNull()).alias("n_missing"), F.count_if(F.col("_due").isNull()).alias("n_unexpected"), *sums,
    )
    left = reduce(lambda a, b: a + b, [F.when(F.col(k) > 0, 1).otherwise(0) for k in issues], F.lit(0))
    if accepted is not None:
        ok = accepted.groupBy(date).agg(F.collect_set("issue").alias("_ok"))
        out = out.join(ok, date, "left").withColumn("_ok", F.coalesce("_ok", F.array().cast("array<string>")))
        left = reduce(lambda a, b: a + b, [F.when((F.col(k) > 0) & ~F.array_contains("_ok", k), 1).otherwise(0) for k in issues], F.lit(0))
    out = out.withColumn("n_open_issues", left)
    good = (F.col("n_odd_shape") == 0) & (F.col("n_missing") == 0) & (F.col("n_unexpected") == 0) & (F.col("n_open_issues") == 0)
    return out.withColumn("accepted", good).drop("_ok")


def expected_universe(traded: DataFrame, listed: DataFrame, date: str, symbol: str) -> DataFrame:
    """Symbols of a day: traded ones inside their listing span (symbol, start, end), before it, and unexplained ones."""
    span = listed.groupBy(symbol).agg(F.min("start").alias("_from"), F.max(F.coalesce("end", F.lit("9999-12-31").cast("date"))).alias("_to"))
    state = F.when(F.col("_from").isNull(), "unexplained").when(F.col(date) < F.col("_from"), "before_listing").when(F.col(date) > F.col("_to"), "unexplained").otherwise("expected")
    return traded.select(date, symbol).distinct().join(span, symbol, "left").select(date, symbol, state.alias("state"))


def event_batch(df: DataFrame, ids: list[str], date: str, start: Column, end: Column) -> DataFrame:
    """One row: rows, rows without an id, outside the range, and exact duplicates."""
    each = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    no_id = reduce(lambda a, b: a | b, [F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "") for c in ids])
    part = lambda c: F.coalesce(F.sum(F.when(c, F.col("_n"))), F.lit(0))
    out = each.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), part(no_id).alias("n_no_id"), part(~F.coalesce(F.col(date).between(start, end), F.lit(False))).alias("n_outside"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicates"))
    return out.withColumn("passed", (F.col("n_no_id") == 0) & (F.col("n_outside") == 0) & (F.col("n_duplicates") == 0))


def inventory(layer: DataFrame, partition: str) -> DataFrame:
    """Extent of a partitioned layer: first and last partition, partitions, files and rows."""
    files = layer.select(partition, F.col("_metadata.file_path").alias("_file")).groupBy(partition, "_file").agg(F.count("*").alias("_n"))
    return files.agg(F.min(partition).alias("first_part"), F.max(partition).alias("last_part"), F.countDistinct(partition).alias("n_parts"), F.count("*").alias("n_files"), F.sum("_n").alias("n_rows"))


def calendar_verdict(calendar: DataFrame, date: str, flag: str) -> DataFrame:
    """One row about a calendar's own span: days missing, days with contradictory or unknown flags, open days."""
    each = calendar.groupBy(date).agg(F.countDistinct(flag).alias("_k"), F.count_if(~F.coalesce(F.col(flag).isin(0, 1), F.lit(False))).alias("_odd"), F.max(flag).alias("_open"))
    out = each.agg((F.datediff(F.max(date), F.min(date)) + 1 - F.count("*")).cast("long").alias("n_missing"), F.count_if(F.col("_k") > 1).alias("n_contradictory"), F.count_if(F.col("_odd") > 0).alias("n_unknown"), F.count_if(F.col("_open") == 1).alias("n_open"))
    return out.withColumn("passed", (F.col("n_missing") == 0) & (F.col("n_contradictory") == 0) & (F.col("n_unknown") == 0) & (F.col("n_open") > 0))


def panel_gaps(panel: DataFrame, calendar: DataFrame, date: str) -> DataFrame:
    """Open days inside the panel's own span on which the panel has no row."""
    days = panel.select(date).distinct()
    span = days.agg(F.min(date).alias("_a"), F.max(date).alias("_z"))  # one row
    return calendar.select(date).distinct().join(F.broadcast(span), F.col(date).between(F.col("_a"), F.col("_z"))).select(date).join(days, date, "left_anti")


def session_grid(bars: DataFrame, expected: DataFrame, date: str, symbol: str, minute: Column, grid: list[int]) -> DataFrame:
    """Per expected symbol and date: bars on and off the exact grid, and whether the grid is complete."""
    on = minute.isin(grid)
    counts = bars.groupBy(date, symbol).agg(F.countDistinct(F.when(on, minute)).alias("_on"), F.count_if(~on).alias("_off"))
    out = expected.select(date, symbol).distinct().join(counts, [date, symbol], "left")
    return out.select(date, symbol, F.coalesce("_on", F.lit(0)).alias("n_on_grid"), F.coalesce("_off", F.lit(0)).alias("n_off_grid"), ((F.coalesce("_on", F.lit(0)) == len(grid)) & (F.coalesce("_off", F.lit(0)) == 0)).alias("complete"))


def status_consistency(panel: DataFrame, history: DataFrame, symbol: str, date: str, flag: str, available: str) -> DataFrame:
    """One row: panel flags that differ from membership in the history, availabilities that differ (null-safe), badly
    formed codes, and keys that stand twice."""
    h = history.groupBy(symbol, date).agg(F.max(available).alias("_available")).withColumn("_member", F.lit(True))
    p = panel.groupBy(symbol, date).agg(F.count("*").alias("_n"), F.max(flag).alias("_flag"), F.max(available).alias("_own")).join(h, [symbol, date], "left")
    member = F.coalesce("_member", F.lit(False))
    return p.agg(
        F.count_if(F.coalesce("_flag", F.lit(False)) != member).alias("n_flag"), F.count_if(~F.col("_own").eqNullSafe(F.col("_available"))).alias("n_available"),
        F.count_if(~F.col(symbol).cast("string").rlike(r"^\d+$")).alias("n_code"), F.sum(F.col("_n") - 1).alias("n_duplicates"),
    )
