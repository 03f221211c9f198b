"""Roots whose files carry their date in the path, and text members in a legacy charset."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.scalar import tolerant_date

#: Names that readers add to members' rows; no member may have them.
RESERVED = ("_source_row", "_time", "_source_symbol")


def path_date(path: Column, column: str) -> Column:
    """The date in a file's path: the last folder `column=...`, else a date at the file's name; null if there is neither."""
    folder = F.try_element_at(F.regexp_extract_all(path, F.lit(f"/{column}=([^/]+)/"), F.lit(1)), F.lit(-1))
    named = F.regexp_replace(F.regexp_extract(path, r"/(\d{4}-?\d{2}-?\d{2})\.[^/]*$", 1), "-", "")
    return F.coalesce(tolerant_date(folder), tolerant_date(named))


def read_dated(spark: SparkSession, root: str, column: str = "trade_date", *, first: str | None = None, last: str | None = None) -> DataFrame:
    """All Parquet files below a root as one table with a date column, whether the files lie in folders `column=...`, have
    dated names, or hold the column themselves.

    A value inside a file wins over its path. first, last (yyyy-MM-dd): files whose path has a date outside are not even
    opened, as the condition is on the path alone; rows of the others are filtered by their date. A file whose path has
    no date is always read.
    """
    files = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).option("pathGlobFilter", "*.parquet").parquet(root)
    by_path = path_date(F.col("_metadata.file_path"), column)
    own = tolerant_date(F.col(column)) if column in files.columns else F.lit(None).cast("date")
    rest = [c for c in files.columns if c != column]
    bounds = [lambda c, x=x, low=low: (c >= x) if low else (c <= x) for x, low in ((first, True), (last, False)) if x is not None]
    for holds in bounds:
        files = files.where(by_path.isNull() | holds(by_path))
    out = files.select(*rest, F.coalesce(own, by_path).alias(column))
    for holds in bounds:
        out = out.where(holds(F.col(column)))
    return out


def name_by_folder(spark: SparkSession, source: str, column: str, to: str) -> None:
    """Move the files of folders `column=yyyyMMdd`, one in each, to files of that name in one folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(to))
    for folder in system.listStatus(path(source)):
        name = folder.getPath().getName()
        if name.startswith(f"{column}="):
            files = [f.getPath() for f in system.listStatus(folder.getPath()) if f.getPath().getName().endswith(".parquet")]
            if len(files) != 1:
                raise ValueError(f"{len(files)} files in {name}")
            system.rename(files[0], path(f"{to}/{name.split('=')[1]}.parquet"))


def recode(df: DataFrame, written: str, read: str) -> DataFrame:
    """Text columns whose bytes in one charset are read in another. Latin-1 gives each byte a character, so it carries bytes
    of any charset through readers and writers that know few."""
    names, kind = [f.name for f in df.schema], df.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = []
            for c in batch.columns:
                if pa.types.is_string(c.type):
                    c = pa.array([x if x is None or x.isascii() else x.encode(written).decode(read) for x in c.to_pylist()], pa.string())
                columns.append(c)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(run, kind)


def _headers(spark: SparkSession, paths: list[str], charset: str) -> dict[str, str]:
    """The first line of each file, read by the file system that has it."""
    jvm, out = spark._jvm, {}
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).open(where)
        try:
            out[path] = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, charset)).readLine() or ""
        finally:
            stream.close()
    return out


def _names(line: str, path: str, aliases: dict[str, str]) -> list[str]:
    import csv

    raw = next(csv.reader([line.removeprefix("﻿")]), [])
    # a comma behind the last name makes an empty column
    named = raw[:-1] if len(raw) > 1 and not raw[-1] else raw
    out = [aliases.get(n, n) for n in named]
    if not out or "" in out or len(set(out)) != len(out):
        raise ValueError(f"missing or duplicate names in the header of {path}: {raw}")
    if set(out) & set(RESERVED):
        raise ValueError(f"{path} has reserved names: {raw}")
    return out + [""] * (len(raw) - len(named))


def read_members(spark: SparkSession, paths: list[str], aliases: dict[str, str], required: list[str], *, charset: str = "GB18030", as_text: tuple[str, ...] = ()) -> DataFrame:
    """CSV members of one provider, whose headers differ in spelling and order, as one typed table.

    aliases: a header's name -> the canonical one. Values are read as text in the charset, which must write commas, quotes
    and line ends as ASCII does and in no other character. A column becomes long if it is
    not in as_text and each of its values, over all members, comes back unchanged from a long: codes with leading zeros,
    and columns with an empty value, stay text. A column that a member lacks is null in its rows, and such nulls do not
    count. Members with the same header are read together, in splits.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, line in _headers(spark, paths, charset).items():
        names = _names(line, path, aliases)
        if missing := [c for c in required if c not in names]:
            raise ValueError(f"{path} lacks {missing}")
        groups.setdefault(tuple(names), []).append(path)
    parts = []
    for names, own in sorted(groups.items()):
        schema = ", ".join(f"`{n or '_blank'}` string" for n in names)
        part = spark.read.schema(schema).option("header", True).option("encoding", "ISO-8859-1").option("escape", '"').option("enforceSchema", True).csv(own)
        parts.append(recode(part, "latin-1", charset).select(*[F.coalesce(F.col(f"`{n}`"), F.lit("")).alias(n) for n in names if n]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    asked = [c for c in out.columns if c not in as_text]
    same = out.agg(*[F.min(F.when(F.col(f"`{c}`").isNotNull(), F.coalesce(F.col(f"`{c}`").try_cast("long").cast("string") == F.col(f"`{c}`"), F.lit(False)))).alias(f"c{i}") for i, c in enumerate(asked)]).first()
    whole = {c for i, c in enumerate(asked) if same[f"c{i}"]}
    return out.select(*[F.col(f"`{c}`").cast("long").alias(c) if c in whole else F.col(f"`{c}`").alias(c) for c in out.columns])
