"""Point-in-time (bitemporal) operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.dealing import dealt
from tideline.operators.joins import next_session


def available(events: DataFrame, disclosed: str, delay: int, calendar: DataFrame | None = None, session: str = "day") -> DataFrame:
    """Adds available_date: disclosure plus delay days, moved to the next open day if a calendar is given."""
    out = events.where(F.col(disclosed).isNotNull()).withColumn("available_date", F.date_add(disclosed, delay))
    if calendar is None:
        return out
    return next_session(out, calendar, "available_date", session, strict=False).drop("available_date").withColumnRenamed("next_session", "available_date").where("available_date IS NOT NULL")


def split_usable(events: DataFrame, disclosed: str, period: str) -> DataFrame:
    """Adds reason: null for usable events, else why they are quarantined."""
    return events.withColumn("reason", F.when(F.col(disclosed).isNull(), "missing_disclosure").when(F.col(disclosed) < F.col(period), "disclosed_before_period"))


def latest_vintage(observations: DataFrame, keys: list[str], at: Column, known: list[str], order: list[str]) -> DataFrame:
    """Per key the last version, by `order`, of those whose `known` times all are at or before `at`."""
    seen = observations
    for c in known:
        seen = seen.where(F.col(c) <= at)
    return seen.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order]))).where("_n = 1").drop("_n")


def field_state(events: DataFrame, key: str, fields: list[str], order: list[str]) -> DataFrame:
    """Per key and field the last value that is not null, with the order columns it came with, in one aggregate."""
    at = F.struct(*order)
    picks = [F.max_by(F.struct(F.col(f).alias("value"), *order), F.when(F.col(f).isNotNull(), at)).alias(f"_{f}") for f in fields]
    out = events.groupBy(key).agg(*picks)
    return out.select(key, *[c for f in fields for c in (F.col(f"_{f}.value").alias(f), F.col(f"_{f}.{order[-1]}").alias(f"{f}_{order[-1]}"))])


def state_panel(events: DataFrame, dates: DataFrame, key: str, known: str, date: str, field: str, priority: list[str]) -> DataFrame:
    """For each key with events and each date from its first event on: the value of highest priority known by then."""
    first = events.groupBy(key).agg(F.min(known).alias("_from"))
    spine = first.join(F.broadcast(dates.select(date)), F.col(date) >= F.col("_from")).select(key, F.col(date).alias("_at"), F.lit(1).alias("_side"))
    pick = F.struct(*priority, F.col(field).alias("_value"))
    facts = events.where(F.col(field).isNotNull()).select(key, F.col(known).alias("_at"), F.lit(0).alias("_side"), pick.alias("_pick"))
    w = Window.partitionBy(key).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    out = dealt(spine.unionByName(facts, allowMissingColumns=True), key).withColumn("_best", F.max("_pick").over(w)).where("_side = 1")
    return out.select(key, F.col("_at").alias(date), F.col("_best._value").alias(field))


def revisions(facts: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Numbers the versions of a key from 0."""
    return facts.withColumn("revision", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def newest_flagged(facts: DataFrame, keys: list[str], ranks: list[str]) -> DataFrame:
    """Rows that hold the largest value of each rank in turn; ties stay."""
    out = facts
    for c in ranks:
        out = out.withColumn("_m", F.max(c).over(Window.partitionBy(*keys))).where(F.col(c).eqNullSafe(F.col("_m"))).drop("_m")
    return out


def consensus(facts: DataFrame, event: str, fields: list[str]) -> DataFrame:
    """Per event whether all its versions agree on every field, and the values they share."""
    versions = F.collect_set(F.struct(*fields)).alias("_v")
    out = facts.groupBy(event).agg(versions, F.count("*").alias("n_versions"))
    agreed = F.size("_v") == 1
    return out.select(event, "n_versions", agreed.alias("agreed"), *[F.when(agreed, F.col("_v")[0][f]).alias(f) for f in fields])


def replacement_state(disclosures: DataFrame, holdings: DataFrame, fund: str, stock: str, known: str, period: str, value: str) -> DataFrame:
    """Totals per stock over the holdings that are in force, whenever one of them enters or leaves.

    A fund's disclosure replaces its holdings before; of several on one day the latest period holds. disclosures: fund,
    known, period, list_id. holdings: list_id, stock, value. Rows with zero funds mark a stock that nobody holds any more. A list holds a stock once.
    """
    w = Window.partitionBy(fund, known).orderBy(F.desc(period), F.desc("list_id"))
    ranked = disclosures.withColumn("_n", F.row_number().over(w))
    last = ranked.where("_n = 1").withColumn("_until", F.lead(known).over(Window.partitionBy(fund).orderBy(known)))
    held = last.join(holdings, "list_id").select(fund, stock, F.col(known).alias("_from"), "_until", value)
    superseded = ranked.where("_n > 1").join(holdings, "list_id").select(stock, F.col(known).alias(known))
    # what enters and leaves, summed up in order of time: no list is looked up again
    enter = held.select(stock, F.col("_from").alias(known), F.lit(1).alias("_n"), F.col(value).alias("_v"))
    leave = held.where("_until IS NOT NULL").select(stock, "_until", F.lit(-1), -F.col(value))
    steps = enter.union(leave).union(superseded.select(stock, known, F.lit(0), F.lit(0.0))).groupBy(stock, known).agg(F.sum("_n").alias("_n"), F.sum("_v").alias("_v"))
    so_far = Window.partitionBy(stock).orderBy(known)
    out = steps.select(stock, known, F.sum("_n").over(so_far).alias("n_funds"), F.sum("_v").over(so_far).alias("_total"))
    return out.select(stock, known, "n_funds", F.when(F.col("n_funds") == 0, 0.0).otherwise(F.col("_total")).alias("total"))


def context_audit(observations: DataFrame, expected: DataFrame, at: Column, *, series: str, period: str, known: list[str], order: list[str], max_age: int) -> DataFrame:
    """Per expected series what a read as of a moment gives: the newest period, its age in days, whether it is missing or
    stale, and how many of its periods are reconstructed or have their revisions covered."""
    seen = latest_vintage(observations, [series, period], at, known, order)
    out = seen.groupBy(series).agg(F.max(period).alias("last_period"), F.count("*").alias("n_periods"), F.count_if("reconstructed").alias("n_reconstructed"), F.count_if("revision_covered").alias("n_covered"))
    out = expected.select(series).distinct().join(out, series, "left").withColumn("age", F.datediff(at, "last_period"))
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_periods", "n_reconstructed", "n_covered")})
    return out.withColumn("state", F.when(F.col("last_period").isNull(), "missing").when(F.col("age") > max_age, "stale").otherwise("fresh"))


def asset_lags(assets: DataFrame, asset: str, as_of: str, target: str, allowed: str) -> DataFrame:
    """Per asset the lag in days behind its target date and whether it is stale; an asset without either date is not."""
    lag = F.datediff(target, as_of)
    return assets.select(asset, as_of, target, lag.alias("lag_days"), F.coalesce(lag > F.col(allowed), F.lit(False)).alias("stale"))
