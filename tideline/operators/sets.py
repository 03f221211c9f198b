"""Set operations and merges between versions of a table, referential and dimension joins, top rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shared_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys that both tables have."""
    return a.select(*keys).intersect(b.select(*keys))


def row_set_difference(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """One row: how many rows each table has beyond the other, in any order and with repetitions."""
    side = lambda df, n: df.groupBy(*columns).agg(F.count("*").alias(n))
    same = lambda c: F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}"))
    hit = same(columns[0])
    for c in columns[1:]:
        hit = hit & same(c)
    both = side(a, "na").alias("x").join(side(b, "nb").alias("y"), hit, "full_outer")
    more = lambda p, q: F.coalesce(F.sum(F.greatest(F.coalesce(p, F.lit(0)) - F.coalesce(q, F.lit(0)), F.lit(0))), F.lit(0))
    return both.agg(more("na", "nb").alias("only_a"), more("nb", "na").alias("only_b"))


def partition_delta(old: DataFrame, new: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """Per partition whether it was added, removed, changed (its contents differ in any order) or reused."""
    mark = lambda df, c: df.groupBy(by).agg(F.struct(F.count("*").alias("n"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("h")).alias(c))
    both = mark(old, "old").join(mark(new, "new"), by, "full_outer")
    state = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old") != F.col("new"), "changed").otherwise("reused")
    return both.select(by, state.alias("state"))


def replace_dates(base: DataFrame, overlay: DataFrame, date: str) -> DataFrame:
    """The overlay's rows, and the base's rows of dates that the overlay does not hold at all."""
    return base.join(overlay.select(date).distinct(), date, "left_anti").select(*base.columns).unionByName(overlay)


def referential(lines: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """One row: lines, lines whose key is unknown, and how many such keys there are."""
    j = lines.select(key).join(known.select(key).distinct().withColumn("_known", F.lit(True)), key, "left")
    lost = F.col("_known").isNull()
    return j.agg(F.count("*").alias("n_lines"), F.count_if(lost).alias("n_missing"), F.countDistinct(F.when(lost, F.col(key))).alias("n_missing_ids"))


def dimension(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Facts with the columns of a dimension; a key that the dimension holds twice is an error when the rows are read."""
    rest = [c for c in dim.columns if c != key]
    once = dim.groupBy(key).agg(F.count("*").alias("_n"), *[F.first(c).alias(c) for c in rest])
    once = once.withColumn("_n", F.when(F.col("_n") == 1, 1).otherwise(F.raise_error(F.lit("the dimension holds a key twice")).cast("int"))).where("_n = 1").drop("_n")
    return facts.join(once, key)


def latest_rows(df: DataFrame, key: str, time: str) -> DataFrame:
    """All rows of each key at its latest time."""
    last = df.groupBy(key).agg(F.max(time).alias(time))
    return df.join(last, [key, time])


def mapping_conflicts(df: DataFrame, key: str, value: str, count: str, first: str) -> DataFrame:
    """Keys that are mapped to more than one value: how many, and the smallest."""
    return df.groupBy(key).agg(F.countDistinct(value).alias(count), F.min(value).alias(first)).where(F.col(count) > 1)


def top_rows(df: DataFrame, by: list[str], order: list[Column], most: int, place: str | None = None) -> DataFrame:
    """At most so many rows of each group in an order, with their place if a name for it is given."""
    out = df.withColumn(place or "_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(place or "_n") <= most)
    return out if place else out.drop("_n")


def top_groups(df: DataFrame, key: str, total: Column, most: int) -> DataFrame:
    """Rows of the groups with the largest totals; ties go to the smaller key."""
    top = df.groupBy(key).agg(total.alias("_t")).orderBy(F.desc("_t"), key).limit(most)
    return df.join(F.broadcast(top.select(key)), key, "left_semi")

