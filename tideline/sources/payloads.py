"""Rows out of nested payloads: JSON documents of series and comma-joined lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators.normalize import plain_number


def series_observations(payloads: DataFrame, key: str, body: str) -> DataFrame:
    """Observations of JSON payloads {"series": [{"code": ..., "points": [{"t": ..., "v": ...}]}]}: key, code, t, value.

    A payload that is no JSON gives none; a value is read from numbers and from text with separators.
    """
    form = "struct<series:array<struct<code:string,points:array<struct<t:string,v:string>>>>>"
    s = payloads.select(key, F.explode(F.from_json(F.col(body), form)["series"]).alias("s"))
    p = s.select(key, F.col("s.code").alias("code"), F.explode("s.points").alias("p"))
    return p.select(key, "code", F.col("p.t").alias("t"), plain_number(F.col("p.v")).alias("value"))


def kline_rows(lines: DataFrame, key: str, body: str, names: list[str]) -> DataFrame:
    """Arrays of comma-joined lines as typed rows: key, time (text), the named numbers, and malformed (another number of
    fields, or a field that is no number)."""
    one = lines.select(key, F.explode(body).alias("line")).withColumn("f", F.split("line", ",", -1))
    numbers = [F.get("f", F.lit(i)).try_cast("double").alias(n) for i, n in enumerate(names, 1)]
    out = one.select(key, F.get("f", F.lit(0)).alias("time"), *numbers, F.size("f").alias("_n"))
    bad = F.col("_n") != len(names) + 1
    for n in names:
        bad = bad | F.col(n).isNull()
    return out.withColumn("malformed", bad).drop("_n")
