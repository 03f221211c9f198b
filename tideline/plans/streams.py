"""Streaming queries (SS-*); the SQL is that of the batch twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.streaming import flows, sequences

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return flows.read_stream(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT event_id, user_id, value FROM events")
def ss01_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Events that arrive twice are kept once."""
    e = _events(spark, sf)
    twice = e.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("copy")
    return flows.drain(flows.ingest(twice, ["event_id"], "ts"), "append").select("event_id", "user_id", "value")


@query("SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS n FROM events GROUP BY 1")
def ss02_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """A batch writes the keys that it has seen; the newest row of each is the catalog."""
    out = flows.newest(flows.drain(flows.first_and_last_seen(_events(spark, sf), "user_id", "ts"), "update"), ["user_id"])
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_seen", "last_seen")})


@query("""SELECT event_type, time_bucket(INTERVAL 30 MINUTE, ts) AS start, arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low, arg_max(value, event_id) AS close, count(*) AS n FROM events GROUP BY 1, 2""")
def ss08_window_bars(spark: SparkSession, sf: str) -> DataFrame:
    """SS-05 and SS-08, all windows: those that the watermark has not closed at the end too."""
    out = flows.drain(flows.window_bars(_events(spark, sf), "event_type", "ts", "event_id", "value", "30 minutes"), "complete")
    return out.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("""WITH w AS (SELECT event_type, time_bucket(INTERVAL 30 MINUTE, ts) AS start, arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close, count(*) AS n FROM events GROUP BY 1, 2)
SELECT * FROM w WHERE start + INTERVAL 30 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def ss08_closed_window_bars(spark: SparkSession, sf: str) -> DataFrame:
    """SS-05 and SS-08 in append mode: a window is given out once, an hour behind its end, and leaves the state."""
    out = flows.drain(flows.window_bars(_events(spark, sf), "event_type", "ts", "event_id", "value", "30 minutes", late="1 hour"), "append")
    return out.select("event_type", F.col("start").cast("timestamp_ntz").alias("start"), "open", "high", "low", "close", "n")


@query("""WITH g AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY event_type ORDER BY ts) >= 900000000 THEN 1 ELSE 0 END AS new FROM events),
s AS (SELECT *, sum(new) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS k FROM g)
SELECT event_type, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM s GROUP BY event_type, k""")
def ss06_sessions(spark: SparkSession, sf: str) -> DataFrame:
    out = flows.drain(flows.gap_sessions(_events(spark, sf), "event_type", "ts", "15 minutes"), "complete")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_ts", "last_ts")})


@query("""WITH s AS (SELECT event_type, event_id, CASE WHEN event_id % 23 <> 0 THEN (event_id * 7919) % 1009 END AS seq FROM events),
l AS (SELECT *, seq - lag(seq) OVER (PARTITION BY event_type ORDER BY event_id) AS s FROM s WHERE seq IS NOT NULL),
b AS (SELECT event_type, count(*) AS n_non_numeric FROM s WHERE seq IS NULL GROUP BY 1)
SELECT event_type, count(*) + n_non_numeric AS n, n_non_numeric, count(seq) - count(DISTINCT seq) AS n_duplicates, count(*) FILTER (WHERE s < 0) AS n_backwards, count(*) FILTER (WHERE s > 1) AS n_gaps,
 coalesce(sum(s - 1) FILTER (WHERE s > 1), 0)::BIGINT AS gap_span, count(DISTINCT seq) AS tracked, false AS truncated FROM l JOIN b USING (event_type) GROUP BY event_type, n_non_numeric""")
def ss07_channel_sequences(spark: SparkSession, sf: str) -> DataFrame:
    """Duplicates, backward steps and gaps of each channel, with the numbers seen in a capped state; tests hold it over several batches."""
    seq = F.when(F.col("event_id") % 23 != 0, ((F.col("event_id") * 7919) % 1009).cast("string")).otherwise("?")
    out = flows.drain(sequences.sequence_quality(_events(spark, sf).withColumn("seq", seq), "event_type", "seq", "event_id"), "update", keyed_state=True)
    return flows.newest(out, ["event_type"])


_SNAPSHOTS = "snaps AS (SELECT user_id, date_trunc('hour', ts) AS minute, value, ts AS archived_at, event_id FROM events)"


@query(f"WITH {_SNAPSHOTS} SELECT user_id, minute, arg_max(value, (archived_at, event_id)) AS value FROM snaps GROUP BY 1, 2")
def ss03_archive(spark: SparkSession, sf: str) -> DataFrame:
    """Archived again, the later correction wins, in whatever order batches come; the second batch holds the older rows.
    Only the days of a batch are written anew."""
    e = _events(spark, sf).select("user_id", F.date_trunc("hour", "ts").alias("minute"), "value", F.struct("ts", "event_id").alias("archived_at"), "event_id", F.to_date("ts").alias("day"))
    keys = ["user_id", "minute"]

    def write(rows: DataFrame, out: str) -> None:
        flows.upsert_partitions(rows.where("event_id % 2 = 1"), out, keys, "archived_at", "day")
        flows.upsert_partitions(rows.where("event_id % 2 = 0"), out, keys, "archived_at", "day")

    return flows.drain(e, "append", write).select("user_id", F.col("minute").cast("timestamp_ntz").alias("minute"), "value")


@query("""SELECT user_id, ts::DATE AS day, count(*) AS n, max(strftime(ts, '%H:%M')) >= '14:30' AS complete FROM events WHERE dayofweek(ts) BETWEEN 1 AND 5 AND (strftime(ts, '%H:%M') BETWEEN '09:30' AND '11:30' OR strftime(ts, '%H:%M') BETWEEN '13:00' AND '15:00') GROUP BY 1, 2""")
def ss04_session_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Only events inside the sessions are taken; a day is complete with a row of its last half hour."""
    e = _events(spark, sf).where(flows.in_session(F.col("ts"), [("09:30", "11:30"), ("13:00", "15:00")]))
    days = e.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.max(F.date_format("ts", "HH:mm")).alias("last"))
    return flows.drain(days, "complete").select("user_id", "day", "n", (F.col("last") >= "14:30").alias("complete"))


@query("""WITH k AS (SELECT *, ts + INTERVAL 1 DAY * (event_id % 3) AS known FROM events)
SELECT user_id, event_type, arg_max(value, (known, event_id)) AS value, count(*) AS n_versions FROM k WHERE known <= (SELECT max(ts) FROM events) GROUP BY 1, 2""")
def ss09_late_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Facts that become known late are appended, never overwritten; readers choose by the time at which they were known."""
    e = _events(spark, sf).withColumn("known", F.col("ts") + F.make_dt_interval(days=(F.col("event_id") % 3).cast("int")))
    ledger = flows.drain(e.select("event_id", "user_id", "event_type", "value", "known"), "append")
    at = spark.read.parquet(f"{sf}/events.parquet").agg(F.max("ts").cast("timestamp").alias("at"))  # one row
    seen = ledger.join(F.broadcast(at)).where(F.col("known") <= F.col("at"))
    return seen.groupBy("user_id", "event_type").agg(F.max_by("value", F.struct("known", "event_id")).alias("value"), F.count("*").alias("n_versions"))


@query("""WITH n AS (SELECT event_id, user_id, ts::DATE AS d, CASE WHEN dayofmonth(ts) = 5 THEN value + 1 ELSE value END AS value FROM events WHERE dayofmonth(ts) <> 9)
SELECT d, user_id, count(*) AS n, round(sum(value), 4) AS total FROM n GROUP BY 1, 2""")
def ss10_incremental_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """After a change, a removal and no change of days: only the changed ones are computed anew, in place."""
    e = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "user_id", F.to_date("ts").alias("d"), "value")
    old = e.where(F.dayofmonth("d") != 3)
    new = e.where(F.dayofmonth("d") != 9).withColumn("value", F.when(F.dayofmonth("d") == 5, F.col("value") + 1).otherwise(F.col("value")))
    build = lambda df: df.groupBy("d", "user_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    out = flows.work_folder(spark, "refresh")
    for version in (old, new):
        flows.refresh_changed(version, out, "d", build)
    return spark.read.schema(build(new).schema).parquet(f"{out}/table")
