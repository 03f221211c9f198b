"""A sparse sidecar of decisions about the rows of raw files, which are never rewritten."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.normalize import tick_triage

ROW = ("file_name", "row_index")


def write_labels(spark: SparkSession, raw: str, out: str, kind: str, *, code: str, time: str, price: str, event_id: str | None = None) -> None:
    """Triage the rows of raw Parquet files and write the labels of those that are not kept: file_name, row_index, decision,
    reason, code and event_id. File names must be unique below the root. Only the columns that decide are read."""
    held = [code, time, price, *([event_id] if event_id else [])]
    rows = spark.read.parquet(raw).select(*held, *[F.col(f"_metadata.{c}").alias(f"_{c}") for c in ROW])
    marked = tick_triage(rows, kind, code=code, time=time, price=price, event_id=event_id).where("decision <> 'keep'")
    marked.select(*[F.col(f"_{c}").alias(c) for c in ROW], "decision", "reason", F.col(code).cast("string").alias("code"), (F.col(event_id) if event_id else F.lit(None)).cast("string").alias("event_id")).write.mode("overwrite").parquet(out)


def read_labelled(spark: SparkSession, raw: str, labels: str, *, drop: tuple[str, ...] = ("exclude",)) -> DataFrame:
    """Rows of raw files with the decision and reason of their label (keep and empty without one), without those of the
    decisions to drop. Rows meet their labels by file and place, so identifiers may repeat or be missing."""
    rows = spark.read.parquet(raw)
    kept = rows.columns
    marks = spark.read.parquet(labels).select(*[F.col(c).alias(f"_{c}") for c in ROW], "decision", "reason")
    placed = rows.select(*kept, *[F.col(f"_metadata.{c}").alias(f"_{c}") for c in ROW])
    out = placed.join(marks, [f"_{c}" for c in ROW], "left").withColumns({"decision": F.coalesce("decision", F.lit("keep")), "reason": F.coalesce("reason", F.lit(""))})
    return out.where(~F.col("decision").isin(*drop)).select(*kept, "decision", "reason")
