"""Bindings of the operators' roles to the test tables, in Spark and as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators import bars
from tideline.operators.dealing import dealt


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def trades(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as trades: symbol, d (date), k (order within the day), price, volume."""
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("d"),
        (F.col("l_orderkey") * 1000000000 + F.col("l_linenumber") * 10000000 + F.col("l_partkey")).alias("k"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.col("l_quantity").alias("volume"), F.col("l_returnflag").alias("flag"),
    )


def daily(spark: SparkSession, sf: str) -> DataFrame:
    # nearly every trade has a key of its own, so that bars are made behind the shuffle only
    return bars.ohlcv(dealt(trades(spark, sf), "symbol", "d"), ["symbol", "d"], ["k"])


def day_volumes(t: DataFrame) -> DataFrame:
    """Trades' volume v by symbol and d."""
    return dealt(t.select("symbol", "d", "volume"), "symbol", "d").groupBy("symbol", "d").agg(F.sum("volume").alias("v"))


TRADES = """trades AS (SELECT l_suppkey AS symbol, l_shipdate::DATE AS d, l_orderkey * 1000000000 + l_linenumber * 10000000 + l_partkey AS k,
  l_extendedprice / l_quantity AS price, l_quantity AS volume, l_returnflag AS flag FROM lineitem)"""
DAILY = TRADES + """, daily AS (SELECT symbol, d, arg_min(price, k) AS open, max(price) AS high, min(price) AS low, arg_max(price, k) AS close,
  sum(volume) AS volume, sum(price * volume) AS amount, count(*) AS n_trades FROM trades GROUP BY symbol, d)"""


def ticks(spark: SparkSession, sf: str) -> DataFrame:
    """Events as ticks: symbol, ts, event_id, price, volume (from the JSON properties)."""
    k = F.coalesce(F.get_json_object("props", "$.k").cast("long"), F.lit(0)) + 1
    return table(spark, sf, "events").select(F.col("event_type").alias("symbol"), "ts", "event_id", "user_id", F.col("value").alias("price"), k.alias("volume"))


TICKS = """ticks AS (SELECT event_type AS symbol, ts, event_id, user_id, value AS price, coalesce((props->>'$.k')::BIGINT, 0) + 1 AS volume FROM events)"""


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})
