"""Profiles, validation counters, duplicates, completeness and gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.dealing import dealt


def counters(df: DataFrame, checks: dict[str, Column], by: list[str] | None = None) -> DataFrame:
    """How many rows meet each condition, all in one scan."""
    return df.groupBy(*(by or [])).agg(F.count("*").alias("n_rows"), *[F.count_if(c).alias(name) for name, c in checks.items()])


def duplicates(df: DataFrame, keys: list[str], by: list[str] | None = None) -> DataFrame:
    """Rows beyond the first of each key, per group."""
    each = df.groupBy(*(by or []), *[k for k in keys if k not in (by or [])]).agg(F.count("*").alias("_n"))
    return each.groupBy(*(by or [])).agg(F.sum(F.col("_n") - 1).alias("n_duplicates"))


def conflicts(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Keys with more than one distinct tuple of values; nulls count as a value."""
    return df.groupBy(*keys).agg(F.countDistinct(F.to_json(F.struct(*values), {"ignoreNullFields": "false"})).alias("n_versions")).where("n_versions > 1")


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: rows, nulls, distinct values, smallest and largest as text."""
    aggs = []
    for c in columns:
        aggs.append(F.struct(F.lit(c).alias("column"), F.count("*").alias("n_rows"), F.count_if(F.col(c).isNull()).alias("n_nulls"), F.countDistinct(c).alias("n_distinct"), F.min(c).cast("string").alias("smallest"), F.max(c).cast("string").alias("largest")).alias(f"_{c}"))
    return df.agg(*aggs).select(F.explode(F.array(*[f"_{c}" for c in columns])).alias("p")).select("p.*")


def summary(df: DataFrame, value: str, by: list[str], points: list[float]) -> DataFrame:
    """Count, smallest, mean, largest and exact linear percentiles of the finite values."""
    if not by:
        return summary(df.withColumn("_all", F.lit(0)), value, ["_all"], points).drop("_all")
    x = F.when(~F.isnan(value) & (F.abs(value) != float("inf")), F.col(value))
    rows = df.select(*by, x.alias("_x")).where("_x IS NOT NULL")
    # places in a sorted group, which spills; no group's values are held in memory
    placed = rows.withColumns({"_i": F.row_number().over(Window.partitionBy(*by).orderBy("_x")) - 1, "_n": F.count("*").over(Window.partitionBy(*by))})
    at = {p: F.lit(p) * (F.col("_n") - 1) for p in points}
    picks = [F.max(F.when(F.col("_i") == edge(at[p]), F.col("_x"))).alias(f"_{name}{i}") for i, p in enumerate(points) for name, edge in (("a", F.floor), ("z", F.ceil))]
    out = placed.groupBy(*by).agg(F.count("*").alias("n"), F.min("_x").alias("smallest"), F.avg("_x").alias("mean"), F.max("_x").alias("largest"), F.max("_n").alias("_n"), *picks)
    between = [(F.col(f"_a{i}") + (F.col(f"_z{i}") - F.col(f"_a{i}")) * (at[p] - F.floor(at[p]))).alias(f"p{round(p * 100)}") for i, p in enumerate(points)]
    return df.select(*by).distinct().join(out, by, "left").select(*by, F.coalesce("n", F.lit(0)).alias("n"), "smallest", "mean", "largest", *between)


def errors(df: DataFrame, a: str, b: str, by: list[str]) -> DataFrame:
    """Absolute and relative errors of a against b."""
    d = F.abs(F.col(a) - F.col(b))
    rel = F.when(F.col(b) != 0, d / F.abs(b))
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.avg((d == 0).cast("double")).alias("exact_rate"), F.avg(d).alias("mean_abs"), F.max(d).alias("max_abs"), F.avg(rel).alias("mean_rel"), F.count_if(F.col(b) == 0).alias("n_zero"))


def rank_correlation(df: DataFrame, a: str, b: str, by: list[str], least: int = 3) -> DataFrame:
    """Spearman correlation with average ties; null for fewer rows than `least` or a constant side.

    A group is ranked in ranges of its values, so that none is sorted in one task. The ranges end at values that a hash
    picks, so they depend on the values only; a group of few values is one range.
    """
    ranked = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(*by, F.col(a).alias("_a"), F.col(b).alias("_b"))
    for c in ("_a", "_b"):
        ranked = with_average_rank(ranked, c, by, f"_r{c}")
    out = ranked.groupBy(*by).agg(F.count("*").alias("n"), F.covar_pop("_r_a", "_r_b").alias("_c"), (F.stddev_pop("_r_a") * F.stddev_pop("_r_b")).alias("_s"), *[(F.min(c) < F.max(c)).alias(f"_v{c}") for c in ("_a", "_b")])
    return out.select(*by, "n", F.when((F.col("n") >= least) & F.col("_v_a") & F.col("_v_b"), F.try_divide("_c", "_s")).alias("rank_corr"))


#: One value of so many ends a range of ranks, and a group has at most so many ranges.
PICKED, RANGES = 4096, 128


def with_average_rank(df: DataFrame, value: str, by: list[str], name: str) -> DataFrame:
    """Adds the rank of a value in its group, ties with their average: the rank inside a range of values, behind the rows
    of the ranges before it."""
    own = [f"_by{i}" for i in range(len(by))]
    named = lambda x: x.withColumnsRenamed(dict(zip(by, own, strict=True)))
    alike = lambda: [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(by, own, strict=True)]
    ends = df.where(F.pmod(F.xxhash64(value), F.lit(PICKED)) == 0).groupBy(*by).agg(F.sort_array(F.collect_set(value)).alias("_ends"))
    step = F.ceil(F.size("_ends") / F.lit(RANGES)).cast("int")
    ends = named(ends.withColumn("_ends", F.filter("_ends", lambda x, i: i % step == 0)))
    # one row for a group of some thousand values
    marked = df.join(F.broadcast(ends), reduce(Column.__and__, alike(), F.lit(True)), "left").drop(*own)
    marked = marked.withColumn("_range", F.coalesce(F.size(F.filter("_ends", lambda x: x <= F.col(value))), F.lit(0))).withColumn("_range", F.greatest("_range", F.lit(0))).drop("_ends")
    sizes = marked.groupBy(*by, "_range").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*by).orderBy("_range")) - F.col("_n")
    sizes = sizes.withColumn("_before", before).where("_range > 0").drop("_n").withColumnRenamed("_range", "_to")
    inside = Window.partitionBy(*by, "_range").orderBy(value)
    rank = F.rank().over(inside) + (F.count("*").over(Window.partitionBy(*by, "_range", value)) - 1) / 2
    on = reduce(Column.__and__, alike(), F.col("_range") == F.col("_to"))
    joined = dealt(marked, *by, "_range").withColumn("_rank", rank).join(F.broadcast(named(sizes)), on, "left")
    return joined.select(*df.columns, (F.col("_rank") + F.coalesce("_before", F.lit(0))).alias(name))


def fingerprint(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """Order-independent content fingerprint: rows, sum and xor of row hashes. A null counts with its place."""
    h = F.xxhash64(*[x for c in columns for x in (F.col(c), F.col(c).isNull())])
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"), F.sum(h.cast("decimal(38,0)")).cast("string").alias("hash_sum"), F.bit_xor(h).alias("hash_xor"))


def content_digest(df: DataFrame, values: dict[str, Column], by: list[str]) -> DataFrame:
    """Order-independent digest of a multiset of rows: rows, and `digest`, the sums of the eight 32-bit parts of the rows'
    SHA-256, joined by dashes. values: texts by name, in which a row is written; each is taken with its length, a null as
    a mark of its own. Any engine with SHA-256 can form it, and a changed, lost or repeated row changes it."""
    row = F.concat(*[F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("~")) for v in values.values()])
    h = F.sha2(row, 256)
    parts = [F.conv(F.substring("_h", 8 * i + 1, 8), 16, 10).cast("decimal(38,0)") for i in range(8)]
    out = df.select(*by, h.alias("_h")).groupBy(*by).agg(F.count("*").alias("n_rows"), *[F.sum(p).alias(f"_{i}") for i, p in enumerate(parts)])
    return out.select(*by, "n_rows", F.concat_ws("-", *[F.col(f"_{i}").cast("string") for i in range(8)]).alias("digest"))


def coverage(expected: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are missing or orphaned."""
    missing = expected.select(*keys).distinct().join(present.select(*keys).distinct(), keys, "left_anti").withColumn("state", F.lit("missing"))
    orphan = present.select(*keys).distinct().join(expected.select(*keys).distinct(), keys, "left_anti").withColumn("state", F.lit("orphan"))
    return missing.unionByName(orphan)


def set_agreement(truth: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """True and false positives, false negatives, precision, recall and Jaccard index of two key sets."""
    t, p = (df.select(*keys).distinct().withColumn(c, F.lit(True)) for df, c in ((truth, "_t"), (found, "_p")))
    n = t.join(p, keys, "full_outer").agg(F.count_if(F.col("_t") & F.col("_p")).alias("tp"), F.count_if(F.col("_t").isNull()).alias("fp"), F.count_if(F.col("_p").isNull()).alias("fn"))
    ratio = lambda a, b: F.when(b != 0, a / b)
    return n.withColumns({"precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")), "recall": ratio(F.col("tp"), F.col("tp") + F.col("fn")), "jaccard": ratio(F.col("tp"), F.col("tp") + F.col("fp") + F.col("fn"))})


def gates(metrics: DataFrame, rules: list[tuple[str, str, float]]) -> DataFrame:
    """One row per rule (metric, at_least or at_most, threshold) with the actual value and whether it passes."""
    rows = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(op).alias("op"), F.lit(float(x)).alias("threshold"), F.col(m).cast("double").alias("actual")) for m, op, x in rules])).alias("g")
    ok = F.when(F.col("op") == "at_least", F.col("actual") >= F.col("threshold")).otherwise(F.col("actual") <= F.col("threshold"))
    return metrics.select(rows).select("g.*").withColumn("passed", F.coalesce(ok, F.lit(False)))


def samples(df: DataFrame, check: Column, order: list[str], most: int) -> DataFrame:
    """At most so many offending rows of each check; rows whose check is null offend none."""
    return df.withColumn("check", check).where("check IS NOT NULL").withColumn("_n", F.row_number().over(Window.partitionBy("check").orderBy(*order))).where(F.col("_n") <= most).drop("_n")


def sequence_quality(df: DataFrame, channel: str, sequence: str, order: list[str]) -> DataFrame:
    """Duplicates, backward steps, gaps and their span of a channel's sequence numbers in physical order."""
    step = F.col(sequence) - F.lag(sequence).over(Window.partitionBy(channel).orderBy(*order))
    return df.withColumn("_s", step).groupBy(channel).agg(
        F.count("*").alias("n"), (F.count(sequence) - F.countDistinct(sequence)).alias("n_duplicates"), F.count_if(F.col("_s") < 0).alias("n_backwards"),
        F.count_if(F.col("_s") > 1).alias("n_gaps"), F.coalesce(F.sum(F.when(F.col("_s") > 1, F.col("_s") - 1)), F.lit(0)).alias("gap_span"),
    )


def opening_ledger(orders: DataFrame, requests: DataFrame) -> DataFrame:
    """What trades and cancels leave of each order.

    orders: order_id, side, price, volume. requests: order_id, seq, quantity (trades first, then cancels). A request is
    overdrawn if the running sum of its order goes beyond the order's volume.
    """
    w = Window.partitionBy("order_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    run = requests.withColumn("so_far", F.sum("quantity").over(w)).join(orders.select("order_id", "volume"), "order_id", "left")
    used = run.groupBy("order_id").agg(F.sum("quantity").alias("requested"), F.count_if((F.col("quantity") > 0) & (F.col("so_far") > F.greatest("volume", F.lit(0)))).alias("n_overdrawn"), F.max(F.col("volume").isNull()).alias("unknown"))
    out = orders.join(used, "order_id", "full_outer")
    left = F.greatest(F.coalesce("volume", F.lit(0)) - F.coalesce("requested", F.lit(0)), F.lit(0))
    return out.select("order_id", "side", "price", left.alias("left"), F.coalesce("n_overdrawn", F.lit(0)).alias("n_overdrawn"), F.coalesce("unknown", F.lit(False)).alias("unknown"))


def day_counters(bars: DataFrame, by: list[str], keys: list[str], symbol: str, time: str, day: Column, minutes: Column, grid: tuple[tuple[int, int], ...]) -> DataFrame:
    """The counters that accept or reject a partition of bars, in one pass: rows, symbols, duplicate keys, nulls, values
    that are not finite, broken bounds, negatives, malformed codes, wrong dates, bars off the session, first and last time."""
    price = [F.col(c) for c in ("open", "high", "low", "close")]
    every = [*price, F.col("volume")]
    outside = ~reduce(lambda a, b: a | b, [minutes.between(*g) for g in grid])
    flags = {
        "n_null": reduce(lambda a, b: a | b, [c.isNull() for c in every]),
        "n_not_finite": reduce(lambda a, b: a | b, [F.isnan(c) | (F.abs(c) == float("inf")) for c in every]),
        "n_bounds": (F.col("high") < F.greatest(*price)) | (F.col("low") > F.least(*price)),
        "n_negative": reduce(lambda a, b: a | b, [c < 0 for c in every]),
        "n_bad_code": ~F.col(symbol).cast("string").rlike("^[0-9]+$"),
        "n_wrong_date": F.to_date(time) != day,
        "n_off_session": outside,
    }
    each = bars.groupBy(*by, *[k for k in keys if k not in by]).agg(F.count("*").alias("_n"), F.min(time).alias("_a"), F.max(time).alias("_z"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in flags.items()])
    return each.groupBy(*by).agg(
        F.sum("_n").alias("n_rows"), F.countDistinct(symbol).alias("n_symbols"), F.sum(F.col("_n") - 1).alias("n_duplicates"), *[F.sum(n).alias(n) for n in flags], F.min("_a").alias("first_time"), F.max("_z").alias("last_time")
    )
