"""Layers on disk: canonical schema, staging by validity, quarantine, layouts by year and by symbol, wide research frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.scalar import canonical_code, tolerant_date
from tideline.operators.windows import keep_one

#: Files into which the rows of one partition are dealt at most, so that none waits for a single task.
FILES = 64


def dealt(df: DataFrame, partition: str, by: list[str] | None = None, files: int = FILES) -> DataFrame:
    """Rows of each partition together in at most so many tasks, by the columns given or else by all."""
    spread = F.pmod(F.xxhash64(*(by or [c for c in df.columns if c != partition])), F.lit(files))
    return df.repartition(partition, spread)


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def newest_version(spark: SparkSession, path: str) -> int | None:
    """The largest N of complete folders version=N."""
    if not exists(spark, path):
        return None
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)]
    return max((int(n.split("=")[1]) for n in names if n.startswith("version=") and exists(spark, f"{path}/{n}/_SUCCESS")), default=None)


def replace_partitions(df: DataFrame, path: str, partition: str, by: list[str] | None = None) -> None:
    """Write the partitions that the rows belong to in place of those that are there; all others keep their files. Writing
    the same rows again changes nothing. The old files are read to the end before they are replaced, so the rows may come
    from the table itself."""
    dealt(df, partition, by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def canonical(df: DataFrame, types: dict[str, str], required: list[str]) -> DataFrame:
    """Columns cast to their canonical types, and `rejected`: the first required column that is null afterwards."""
    cast = df.select(*[F.col(c).try_cast(t).alias(c) for c, t in types.items()])
    return cast.withColumn("rejected", F.coalesce(*[F.when(F.col(c).isNull(), c) for c in required]))


def rejects(checked: DataFrame) -> DataFrame:
    """Rows by the column for which they were rejected; null counts those that stay."""
    return checked.groupBy("rejected").agg(F.count("*").alias("n_rows"))


def quarantine(df: DataFrame, reason: Column, out: str) -> tuple[DataFrame, DataFrame]:
    """Write usable rows and rejected ones, with their reason, to two folders in one pass; returns both."""
    marked = df.withColumn("reason", reason).withColumn("part", F.when(F.col("reason").isNull(), "good").otherwise("bad"))
    marked.write.partitionBy("part").parquet(out)
    back = df.sparkSession.read.schema(marked.schema).parquet(out)
    return back.where("part = 'good'").drop("part"), back.where("part = 'bad'").drop("part")


def stage_by_validity(df: DataFrame, keep: Column, date: str, out: str, form: str = "yyyyMMdd") -> DataFrame:
    """Write rows to a partition of their date in a form, rows that are not kept to `_audit`; returns the staged table."""
    to = F.when(keep, F.date_format(date, form)).otherwise("_audit")
    staged = df.withColumn("stage", F.coalesce(to, F.lit("_audit")))
    dealt(staged, "stage").write.partitionBy("stage").parquet(out)
    return df.sparkSession.read.schema(staged.schema).parquet(out)


def standard_layer(df: DataFrame, out: str, *, date: str, symbol: str, order: list[Column], freq: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Canonical trade_date and symbol, one row a key (the first in `order`), the last row of each period if freq is given,
    written by year. Returns the layer and one row of counters: n_read, n_bad_keys, n_duplicates, n_kept."""
    keyed = df.withColumns({"trade_date": tolerant_date(F.col(date)), "symbol": canonical_code(F.col(symbol).cast("string"))})
    bad = F.col("trade_date").isNull() | (F.coalesce("symbol", F.lit("")) == "")
    one = keep_one(keyed.where(~bad), ["symbol", "trade_date"], order)
    if freq:
        one = keep_one(one.withColumn("_period", F.date_trunc(freq, "trade_date")), ["symbol", "_period"], [F.desc("trade_date")]).drop("_period")
    dealt(one.withColumn("trade_year", F.year("trade_date")), "trade_year", ["symbol"]).write.partitionBy("trade_year").parquet(out)
    kept = df.sparkSession.read.schema(one.withColumn("trade_year", F.year("trade_date")).schema).parquet(out)
    counts = keyed.groupBy("symbol", "trade_date").agg(F.count("*").alias("_n"), F.max(bad).alias("_bad"))
    totals = counts.agg(F.sum("_n").alias("n_read"), F.coalesce(F.sum(F.when(F.col("_bad"), F.col("_n"))), F.lit(0)).alias("n_bad_keys"), F.coalesce(F.sum(F.when(~F.col("_bad"), F.col("_n") - 1)), F.lit(0)).alias("n_duplicates"))
    return kept, totals.join(F.broadcast(kept.agg(F.count("*").alias("n_kept"))))


def by_symbol(df: DataFrame, out: str, *, symbol: str, date: str, order: list[Column], buckets: int = 64) -> DataFrame:
    """A table laid out by date rewritten in buckets of symbols: one row a key, each file of a bucket sorted by symbol and date.

    Buckets in place of one folder a symbol keep the number of files bounded; a reader of one symbol adds its bucket.
    """
    one = keep_one(df, [symbol, date], order).withColumn("bucket", F.pmod(F.crc32(F.col(symbol).cast("string")), F.lit(buckets)).cast("int"))
    dealt(one, "bucket", [symbol, date], 4).sortWithinPartitions("bucket", symbol, date).write.partitionBy("bucket").parquet(out)
    return df.sparkSession.read.schema(one.schema).parquet(out)


def read_symbols(layer: DataFrame, symbols: list, *, symbol: str = "symbol", buckets: int = 64) -> DataFrame:
    """Rows of some symbols of a bucketed layer; only their buckets are read."""
    spark = layer.sparkSession
    asked = spark.createDataFrame([(str(s),) for s in symbols], "s string").select(F.pmod(F.crc32("s"), F.lit(buckets)).cast("int").alias("b"))
    return layer.where(F.col("bucket").isin([r["b"] for r in asked.collect()]) & F.col(symbol).isin(symbols))


def research_frame(base: DataFrame, assets: list[tuple[str, DataFrame, str]], keys: list[str], *, calendar: DataFrame | None = None, members: DataFrame | None = None) -> DataFrame:
    """A wide frame: each asset (prefix, table, inner or left) joined on the keys with its columns renamed prefix_column.

    A key that an asset holds twice is an error when the rows are read. calendar and members (tables of some of the
    keys) restrict the rows.
    """

    def one(asset: tuple[str, DataFrame, str]) -> DataFrame:
        prefix, df, _ = asset
        rest = [c for c in df.columns if c not in keys]
        once = df.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.first(c).alias(f"{prefix}_{c}") for c in rest])
        stop = F.raise_error(F.lit(f"{prefix} holds a key twice")).cast("int")
        return once.withColumn("_n", F.when(F.col("_n") > 1, stop).otherwise(F.col("_n"))).where("_n > 0").drop("_n")

    for part in (calendar, members):
        if part is not None:
            base = base.join(part.distinct(), part.columns, "left_semi")
    return reduce(lambda left, asset: left.join(one(asset), keys, asset[2]), assets, base)
