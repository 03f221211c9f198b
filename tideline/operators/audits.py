"""Audit aggregates: session shares, shapes, dispositions, receipts, levels of a ledger, eligibility, identity evidence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.windows import keep_one, safe_ratio


def session_profile(bars: DataFrame, by: list[str], time: str, minute: Column, open_: int, close: int) -> DataFrame:
    """Per group ordered and conditional aggregates of bars: first and last price, the extremes behind the opening bar, and
    the shares of volume in the first and the last half hour."""
    m = bars.withColumn("_m", minute)
    inside = F.col("_m") > open_
    share = lambda c: safe_ratio(F.sum(F.when(c, F.col("volume")).otherwise(0.0)), F.sum("volume"))
    return m.groupBy(*by).agg(
        F.min_by("price", time).alias("first_price"), F.max_by("price", time).alias("last_price"), F.max(F.when(inside, F.col("price"))).alias("high_inside"), F.min(F.when(inside, F.col("price"))).alias("low_inside"),
        share(F.col("_m") < open_ + 30).alias("opening_share"), share(F.col("_m") >= close - 30).alias("closing_share"),
    )


def shape(bars: DataFrame, date: str, symbol: str, per_symbol: int) -> DataFrame:
    """Per date: symbols, rows, symbols of another number of bars, and whether rows are symbols times bars."""
    each = bars.groupBy(date, symbol).agg(F.count("*").alias("_n"))
    out = each.groupBy(date).agg(F.count("*").alias("n_symbols"), F.sum("_n").alias("n_rows"), F.count_if(F.col("_n") != per_symbol).alias("n_odd"))
    return out.withColumn("product_holds", F.col("n_rows") == F.col("n_symbols") * per_symbol)


def dispositions(issues: DataFrame, tier: str, date: str, accepted: Column, fatal: Column) -> DataFrame:
    """Issues by tier and in all (tier null): rows, accepted and fatal ones, dates affected."""
    marked = issues.select(tier, date, accepted.alias("_a"), fatal.alias("_f"))
    return marked.rollup(tier).agg(F.count("*").alias("n_rows"), F.count_if("_a").alias("n_accepted"), F.count_if("_f").alias("n_fatal"), F.countDistinct(date).alias("n_dates"), F.grouping(tier).cast("int").alias("is_total"))


def receipt(df: DataFrame, features: list[str]) -> DataFrame:
    """One row for each feature: rows, share of nulls, mean, and an order-independent hash of its values in whole cents."""
    cents = lambda f: F.coalesce(F.round(F.col(f) * 100).cast("long"), F.lit(-1))
    one = df.agg(F.count("*").alias("n_rows"), *[F.struct(F.lit(f).alias("feature"), F.avg(F.col(f).isNull().cast("double")).alias("null_share"), F.avg(f).alias("mean"), F.sum(F.pmod(cents(f) * 2654435761, F.lit(1000003))).alias("content")).alias(f"_{i}") for i, f in enumerate(features)])
    return one.select("n_rows", F.explode(F.array(*[f"_{i}" for i in range(len(features))])).alias("f")).select("f.*", "n_rows")


def levels(left: DataFrame, most: int) -> DataFrame:
    """The best price levels of each side of a book from what is left of its orders: bids from high to low, asks from low
    to high. left: side (B or S), price, left."""
    sums = left.where("left > 0").groupBy("side", "price").agg(F.sum("left").alias("volume"), F.count("*").alias("n_orders"))
    better = F.when(F.col("side") == "B", -F.col("price")).otherwise(F.col("price"))
    return sums.withColumn("place", F.row_number().over(Window.partitionBy("side").orderBy(better))).where(F.col("place") <= most)


def worst_levels(left: DataFrame, most: int) -> DataFrame:
    """The levels at the far end of each side."""
    sums = left.where("left > 0").groupBy("side", "price").agg(F.sum("left").alias("volume"))
    worse = F.when(F.col("side") == "B", F.col("price")).otherwise(-F.col("price"))
    return sums.withColumn("place", F.row_number().over(Window.partitionBy("side").orderBy(worse))).where(F.col("place") <= most)


def level_match(found: DataFrame, expected: DataFrame) -> DataFrame:
    """Levels against a published book (side, place, price, volume): both, and whether they match."""
    f = found.select("side", "place", F.col("price").alias("price_found"), F.col("volume").alias("volume_found"))
    out = f.join(expected.select("side", "place", "price", "volume"), ["side", "place"], "full_outer")
    same = F.col("price").eqNullSafe(F.col("price_found")) & F.col("volume").eqNullSafe(F.col("volume_found"))
    return out.withColumn("matches", same)


def trace_level(orders: DataFrame, requests: DataFrame, by: list[str]) -> DataFrame:
    """What was ordered, traded and cancelled at each price level, without a cap. requests: order_id, kind, quantity."""
    used = requests.groupBy("order_id").agg(F.coalesce(F.sum(F.when(F.col("kind") == "trade", F.col("quantity"))), F.lit(0.0)).alias("_t"), F.coalesce(F.sum(F.when(F.col("kind") == "cancel", F.col("quantity"))), F.lit(0.0)).alias("_c"))
    out = orders.join(used, "order_id", "left")
    return out.groupBy(*by).agg(F.sum("volume").alias("ordered"), F.coalesce(F.sum("_t"), F.lit(0.0)).alias("traded"), F.coalesce(F.sum("_c"), F.lit(0.0)).alias("cancelled"), F.count("*").alias("n_orders"))


#: Severities from mild to grave.
SEVERITIES = ("ok", "note", "warning", "error")


def eligibility(checks: DataFrame, overrides: DataFrame, item: str) -> DataFrame:
    """Per item the worst severity of its checks (item, check, severity), after overrides (item, check, severity), and
    whether it may be used: yes up to a note, restricted with a warning, no with an error."""
    o = overrides.select(item, "check", F.col("severity").alias("_over"))
    rank = F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), F.coalesce("_over", "severity"))
    out = checks.join(o, [item, "check"], "left").groupBy(item).agg(F.max(rank).alias("_r"), F.count("*").alias("n_checks"), F.count("_over").alias("n_overridden"))
    worst = F.element_at(F.array(*[F.lit(s) for s in SEVERITIES]), F.col("_r").cast("int"))
    return out.select(item, "n_checks", "n_overridden", worst.alias("worst"), F.when(F.col("_r") <= 2, "eligible").when(F.col("_r") == 3, "restricted").otherwise("ineligible").alias("eligibility"))


def identity_evidence(records: DataFrame, member: str, label: str) -> DataFrame:
    """Per member the distinct labels of its records, the most frequent one, and its status: matched, conflict or empty."""
    each = records.groupBy(member, label).agg(F.count("*").alias("_n"))
    best = F.max_by(label, F.when(F.col(label).isNotNull(), F.struct("_n", label)))
    out = each.groupBy(member).agg(F.count(label).alias("n_labels"), F.sum("_n").alias("n_records"), best.alias("label"))
    return out.withColumn("status", F.when(F.col("n_labels") == 0, "empty").when(F.col("n_labels") == 1, "matched").otherwise("conflict"))


def stage_audit(df: DataFrame, stage: str, keys: list[str], date: str, expected: list[str]) -> DataFrame:
    """Per stage: rows, duplicate keys, rows without a date, extent; a stage that is expected and absent has no rows."""
    each = df.groupBy(stage, *keys).agg(F.count("*").alias("_n"), F.count_if(F.col(date).isNull()).alias("_no"), F.min(date).alias("_a"), F.max(date).alias("_z"))
    found = each.groupBy(stage).agg(F.sum("_n").alias("n_rows"), F.sum(F.col("_n") - 1).alias("n_duplicates"), F.sum("_no").alias("n_undated"), F.min("_a").alias("first_date"), F.max("_z").alias("last_date"))
    due = df.sparkSession.createDataFrame([(s,) for s in expected], f"`{stage}` string")
    out = due.join(found, stage, "full_outer")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_rows", "n_duplicates", "n_undated")})


def cross_source_ratios(a: DataFrame, b: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Totals of two sources by key, and the ratio of the second to the first; null where a side lacks the key."""
    x, y = (df.groupBy(*keys).agg(*[F.sum(m).alias(f"{m}_{n}") for m in measures]) for df, n in ((a, "a"), (b, "b")))
    return x.join(y, keys, "full_outer").withColumns({f"{m}_ratio": safe_ratio(F.col(f"{m}_b"), F.col(f"{m}_a")) for m in measures})


def selection_count(profile: DataFrame, ids: DataFrame, key: str, rows: str, where: Column) -> DataFrame:
    """One row: how many requested ids the profile lacks, and the rows that the filtered profile promises for them; the
    promise counts only if no id is unknown."""
    known = ids.select(key).distinct().join(profile.select(key).distinct().withColumn("_k", F.lit(True)), key, "left").agg(F.count_if(F.col("_k").isNull()).alias("n_unknown"))
    found = profile.where(where).join(ids.select(key).distinct(), key, "left_semi").agg(F.coalesce(F.sum(F.col(rows).try_cast("long")), F.lit(0)).alias("n_rows"))
    return known.join(F.broadcast(found)).withColumn("n_rows", F.when(F.col("n_unknown") == 0, F.col("n_rows")))


def compare_archive(reference: DataFrame, archive: DataFrame, keys: list[str], value: str, tolerance: float, worst: int) -> tuple[DataFrame, DataFrame]:
    """One row about a reference against an archive (matched, missing, within the tolerance), and the worst differences."""
    j = reference.select(*keys, F.col(value).alias("_r")).join(archive.select(*keys, F.col(value).alias("_o")), keys, "left").withColumn("diff", F.abs(F.col("_r") - F.col("_o")))
    told = j.agg(F.count("*").alias("n_reference"), F.count("_o").alias("n_matched"), F.count_if(F.col("_o").isNull()).alias("n_missing"), F.count_if(F.col("diff") <= tolerance).alias("n_within"))
    return told, j.where("diff IS NOT NULL").orderBy(F.desc("diff"), *keys).limit(worst).select(*keys, "diff")


def revised(old: DataFrame, fresh: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One row: keys of the old table that the fresh one lacks or holds with another value (null-safe), and the verdict."""
    f = fresh.select(*keys, F.col(value).alias("_f"), F.lit(True).alias("_in"))
    j = old.select(*keys, F.col(value).alias("_v")).join(f, keys, "left")
    out = j.agg(F.count("*").alias("n_old"), F.count_if(F.col("_in").isNull()).alias("n_lost"), F.count_if(F.col("_in") & ~F.col("_v").eqNullSafe(F.col("_f"))).alias("n_changed"))
    return out.withColumn("unrevised", (F.col("n_lost") == 0) & (F.col("n_changed") == 0))


def restricted(candidates: DataFrame, pool: DataFrame, keys: list[str], by: list[str], least: int) -> DataFrame:
    """Candidates that stand in the pool, one to one, of the groups in which at least so many are left."""
    once = lambda df, n: df.withColumn("_k", F.count("*").over(Window.partitionBy(*keys))).withColumn("_k", F.when(F.col("_k") > 1, F.raise_error(F.lit(f"{n} holds a key twice")).cast("long")).otherwise(F.col("_k"))).where("_k > 0").drop("_k")
    both = once(candidates, "the candidates").join(once(pool, "the pool"), keys)
    return both.withColumn("_n", F.count("*").over(Window.partitionBy(*by))).where(F.col("_n") >= least).drop("_n")


def adjacent_faults(df: DataFrame, by: list[str], order: list[str], keys: list[str]) -> DataFrame:
    """Per file rows whose key equals the one before, or comes before it."""
    at = F.struct(*keys)
    before = F.lag(at).over(Window.partitionBy(*by).orderBy(*order))
    return df.select(*by, at.alias("_a"), before.alias("_b")).groupBy(*by).agg(F.count("*").alias("n_rows"), F.count_if(F.col("_a") == F.col("_b")).alias("n_repeats"), F.count_if(F.col("_a") < F.col("_b")).alias("n_backwards"))


def membership_union(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Parts of a membership query as one, one row for each of those keys that all parts together have."""
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    own = [k for k in keys if k in every.columns]
    return keep_one(every, own, [F.col(c).asc_nulls_last() for c in every.columns if c not in own] or own)
