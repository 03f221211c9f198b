"""Reading local artifacts by suffix, typed CSV scans, named views, and answers of ad-hoc SQL as files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What reads a file of a suffix.
FORMATS = {"parquet": "parquet", "csv": "csv", "txt": "text", "json": "json", "jsonl": "json"}


def read_file(spark: SparkSession, path: str, columns: list[str] | None = None, suffix: str | None = None) -> DataFrame:
    """A file or folder by its suffix, with only the columns asked for; an unknown suffix or column is an error."""
    kind = (suffix or path.rstrip("/").rsplit("/", 1)[-1].rpartition(".")[2]).lower()
    if kind not in FORMATS:
        raise ValueError(f"no reader for .{kind}: {path}")
    reader = spark.read.format(FORMATS[kind])
    df = (reader.option("header", True) if kind == "csv" else reader).load(path)
    if columns is None:
        return df
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{path} lacks {missing}")
    return df.select(*columns)


def read_parts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Many Parquet parts as one table; columns are matched by name, and a column that a part lacks is null there."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def union_by_name(parts: list[DataFrame]) -> DataFrame:
    """Tables of different columns as one, matched by name; what a part lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def register_views(spark: SparkSession, manifest: dict[str, str], prefix: str = "") -> list[str]:
    """A view for each dataset of a manifest (name to path); returns the views' names."""
    for name, path in manifest.items():
        read_file(spark, path).createOrReplaceTempView(prefix + name)
    return [prefix + name for name in manifest]


def answer(spark: SparkSession, sql: str, out: str, form: str = "parquet") -> DataFrame:
    """Run a statement over the views and write its rows as parquet, csv, json or text; returns what was written.

    Text holds one row a line, its values separated by tabs.
    """
    df = spark.sql(sql)
    if form == "text":
        df = df.select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]).alias("value"))
    elif form not in ("parquet", "csv", "json"):
        raise ValueError(f"no writer for {form}")
    writer = df.write.format(form)
    (writer.option("header", True) if form == "csv" else writer).save(out)
    return read_file(spark, out, suffix="txt" if form == "text" else form)


def read_typed_csv(spark: SparkSession, path: str, header: list[str]) -> DataFrame:
    """A CSV read as text whose header must be the given one; columns that are whole numbers throughout become longs.

    A column counts as whole numbers only if each value comes back unchanged from a long, so codes with leading zeros
    stay text. One scan decides about all columns.
    """
    df = spark.read.option("header", True).csv(path)
    if df.columns != header:
        raise ValueError(f"header {df.columns} is not {header}")
    same = [F.min(F.coalesce(F.col(c).try_cast("long").cast("string") == F.col(c), F.col(c).isNull())).alias(c) for c in header]
    some = [F.max(F.col(c).isNotNull()).alias(f"{c}_") for c in header]
    found = df.agg(*same, *some).first()
    return df.select(*[F.col(c).cast("long") if found[c] and found[f"{c}_"] else F.col(c) for c in header])


def export_groups(df: DataFrame, key: str, groups: list, out: str, order: list[str]) -> DataFrame:
    """The series of the groups asked for as CSV with a header, sorted inside each file; returns what was written."""
    df.where(F.col(key).isin(groups)).repartition(key).sortWithinPartitions(key, *order).write.option("header", True).csv(out)
    return df.sparkSession.read.schema(df.schema).option("header", True).csv(out)
