"""Structured Streaming forms of the incremental operators; each has a batch twin that gives the same rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tideline.sources.layouts import exists, newest_version, replace_partitions


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for checkpoints and output, in the one that the cluster names."""
    top = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        top = tempfile.mkdtemp(prefix="tideline-")
    return f"{top}/{name}-{uuid.uuid4().hex}"


def read_stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table of the folder as a file stream."""
    schema = spark.read.parquet(f"{sf}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").option("recursiveFileLookup", "false").parquet(sf)


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def drain(df: DataFrame, mode: str, write: Callable[[DataFrame, str], None] | None = None, *, keyed_state: bool = False, report: list | None = None) -> DataFrame:
    """Run a stream over all that is there now, and read what it wrote.

    Each batch writes a folder of its own, and one that is tried again replaces only that. In complete mode the last batch
    has the whole result; the folder before it goes once it is written. keyed_state: the stream keeps state by key and
    needs the store that can. report: takes the progress of each batch.
    """
    spark = df.sparkSession
    folder = work_folder(spark, "stream")
    out = f"{folder}/out"
    written: list[int] = []

    def batch(rows: DataFrame, number: int) -> None:
        if write:
            write(rows, out)
            return
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")
        if mode == "complete" and written and written[-1] != number:
            _remove(spark, f"{out}/batch={written.pop()}")
        written.append(number)

    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    if keyed_state:
        spark.conf.set(provider, ROCKS)
    try:
        query = df.writeStream.outputMode(mode).foreachBatch(batch).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
        if report is not None:
            report.extend(query.recentProgress)
    finally:
        if keyed_state:
            spark.conf.set(provider, before) if before else spark.conf.unset(provider)
    if write:
        return spark.read.parquet(out)
    if mode == "complete":
        return spark.read.schema(df.schema).parquet(f"{out}/batch={written[-1]}") if written else spark.createDataFrame([], df.schema)
    return spark.read.schema(StructType([*df.schema, StructField("batch", LongType())])).parquet(out)


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def newest(written: DataFrame, keys: list[str]) -> DataFrame:
    """The row of each key from the last batch that updated it."""
    rest = [c for c in written.columns if c not in (*keys, "batch")]
    return written.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_r")).select(*keys, "_r.*")


def upsert_partitions(rows: DataFrame, out: str, keys: list[str], by: str, partition: str) -> None:
    """Merge a batch into a table in place: of each key the row with the largest `by` stays, so a late or repeated batch
    changes nothing that is newer. Only the partitions that the batch has rows of are read and replaced; keys must
    determine the partition. The batch's partitions (days, as a rule) are named in the plan, so that the scan skips the rest.
    """
    spark = rows.sparkSession
    touched = [r[0] for r in rows.select(partition).distinct().collect()]  # a batch's days
    if exists(spark, out):
        held = spark.read.schema(rows.schema).parquet(out)
        rows = held.where(F.col(partition).isin([t for t in touched if t is not None])).unionByName(rows)
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rows.columns), by).alias("_r")).select("_r.*")
    replace_partitions(best, out, partition, keys)


def in_session(time: Column, windows: list[tuple[str, str]]) -> Column:
    """Whether an event time lies on a weekday inside one of the windows (HH:mm to HH:mm, both inside)."""
    clock = F.date_format(time, "HH:mm")
    return F.dayofweek(time).between(2, 6) & reduce(lambda a, b: a | b, [clock.between(*w) for w in windows])


def recompute_changed(old: DataFrame, new: DataFrame, date: str, build: Callable[[DataFrame], DataFrame], cached: DataFrame) -> DataFrame:
    """A derived table after a change of its input: dates whose contents differ are built anew, removed ones go, the
    others come from the cached table. build maps input rows to derived rows of the same date."""
    both = _prints(old, date).withColumnsRenamed({"n": "an", "h": "ah"}).join(_prints(new, date).withColumnsRenamed({"n": "bn", "h": "bh"}), date, "full_outer")
    same = F.col("an").eqNullSafe(F.col("bn")) & F.col("ah").eqNullSafe(F.col("bh"))
    changed = both.where(~same & F.col("bn").isNotNull()).select(date)
    gone = both.where(~same).select(date)
    kept = cached.join(gone, date, "left_anti")
    return kept.unionByName(build(new.join(changed, date, "left_semi")))


def _prints(df: DataFrame, date: str) -> DataFrame:
    """One row per date: how many rows it has, and a sum of their hashes."""
    return df.groupBy(date).agg(F.count("*").alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("h"))


def refresh_changed(new: DataFrame, out: str, date: str, build: Callable[[DataFrame], DataFrame]) -> dict[str, int]:
    """Bring a derived table, partitioned by date, up to date with its input, in place.

    Beside the table stand the fingerprints of the input's dates that it was built from. Only dates whose fingerprint
    differs are read again, built and replaced; the folders of dates that are gone are deleted; files of all other dates
    stay as they are. Fingerprints are written last, so a run that fails is repeated by the next. Returns the number of
    dates built and removed. build maps input rows to derived rows of the same date.
    """
    spark = new.sparkSession
    now, prints = _prints(new, date), f"{out}/_prints"
    version = newest_version(spark, prints)
    before = spark.read.schema(now.schema).parquet(f"{prints}/version={version}") if version is not None else spark.createDataFrame([], now.schema)
    both = now.withColumnsRenamed({"n": "bn", "h": "bh"}).join(before, date, "full_outer").where(~(F.col("n").eqNullSafe(F.col("bn")) & F.col("h").eqNullSafe(F.col("bh"))))
    changes = both.select(date, F.col("bn").isNull().alias("gone")).collect()  # one row a changed date
    changed, gone = [r[date] for r in changes if not r["gone"]], [r[date] for r in changes if r["gone"]]
    if changed:
        replace_partitions(build(new.where(F.col(date).isin(changed))), f"{out}/table", date)
    for d in gone:
        _remove(spark, f"{out}/table/{date}={d}")
    if changes or version is None:
        now.write.mode("overwrite").parquet(f"{prints}/version={0 if version is None else version + 1}")
        if version is not None:
            _remove(spark, f"{prints}/version={version}")
    return {"built": len(changed), "removed": len(gone)}


def ingest(stream: DataFrame, keys: list[str], time: str, late: str = "1 day") -> DataFrame:
    """Each key once, however often it is captured; state older than the watermark goes."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def window_bars(stream: DataFrame, key: str, time: str, order: str, price: str, size: str, late: str | None = None) -> DataFrame:
    """Bars of tumbling windows; partial sums of each batch are merged in the state.

    late: in append mode a window is given out once, when the newest time seen lies so far behind its end, and leaves the
    state then; rows of closed windows are dropped. Without it every window stays in the state, for complete mode.
    """
    at, stream = F.struct(time, order), stream.withWatermark(time, late) if late else stream
    bars = stream.groupBy(key, F.window(time, size).alias("w")).agg(F.min_by(price, at).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, at).alias("close"), F.count("*").alias("n"))
    return bars.select(key, F.col("w.start").alias("start"), "open", "high", "low", "close", "n")


def late_and_held(report: list) -> tuple[int, int]:
    """Of a stream's progress: partial rows (one for each key and window of a task) that came behind the watermark and were
    dropped, and the most state rows that a batch left."""
    operators = [o for p in report for o in p.stateOperators]
    return sum(o.numRowsDroppedByWatermark for o in operators), max((o.numRowsTotal for o in operators), default=0)


def gap_sessions(stream: DataFrame, key: str, time: str, gap: str) -> DataFrame:
    s = stream.groupBy(key, F.session_window(time, gap).alias("s")).agg(F.count("*").alias("n"), F.min(time).alias("first_ts"), F.max(time).alias("last_ts"))
    return s.select(key, "n", "first_ts", "last_ts")


def first_and_last_seen(stream: DataFrame, key: str, time: str) -> DataFrame:
    """A catalog that keeps the first and refreshes the last sighting of each key."""
    return stream.groupBy(key).agg(F.min(time).alias("first_seen"), F.max(time).alias("last_seen"), F.count("*").alias("n"))
