"""WARC fixity audit with Merkle trees over ordered offset ranges.

Pages become WARC response records, laid one behind the other into files. The archive's index (file, offset, length of
each record) fixes the tree: records are leaves, a node of level k covers the byte range of FANOUT**k * BLOCK bytes that
the offsets of its children start in, and a node's digest is the SHA-256 of its children's digests in order of offset.
An audit compares the roots of two replicas file by file and descends only below nodes that differ: the nodes of the
next level are joined to the differing ones alone, until single records are located.

The levels are written one by one, each from the one below, with both replicas' digests side by side; the descent then
reads them from the top.

A replica is a table (record_id, content). A record that the index has and a replica lacks has no digest and differs;
records that are not in the index are reported as extra. Null urls or bodies count as empty; pages without an id are no
records; records of equal ids lie in order of a hash of their content and are compared as one set, so damage to one shows
at all of them. Other columns of the replicas are ignored, whatever their names. An empty index gives extra records
only, an empty replica makes all records missing. Files hold a bounded range of ids, so no group grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import materialize

#: Bytes of the ranges of level 1, and how many ranges one of the next level covers.
BLOCK, FANOUT, LEVELS = 1 << 16, 16, 4


def warc_record(record_id: Column, url: Column, body: Column) -> Column:
    """The bytes of a WARC/1.1 response record."""
    url, body = F.coalesce(url, F.lit("")), F.coalesce(body, F.lit(""))
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), record_id.cast("string"), F.lit(">\r\nWARC-Target-URI: "), url,
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.encode(F.concat(header, body, F.lit("\r\n\r\n")), "utf-8")


def archive(pages: DataFrame, *, records_per_file: int = 4096, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """record_id, content, file, offset, length: records in order of id; ids fall into files by their range."""
    rows = pages.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("record_id"), warc_record(F.col(id_col), F.col(url_col), F.col(body_col)).alias("content"))
    rows = rows.withColumn("file", F.floor(F.col("record_id") / records_per_file).cast("long")).withColumn("length", F.octet_length("content").cast("long"))
    w = Window.partitionBy("file").orderBy("record_id", F.xxhash64("content")).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("offset", F.coalesce(F.sum("length").over(w), F.lit(0)).cast("long"))


def record_digests(replica: DataFrame) -> DataFrame:
    """record_id and digest of a replica's records: of several of one id, a hash of the sum of their digests, so that no
    group is collected."""
    h = F.sha2("content", 256)
    parts = [F.sum(F.conv(F.substring(h, 1 + 12 * k, 12), 16, 10).cast("decimal(38,0)")) for k in range(5)]
    sums = replica.groupBy("record_id").agg(F.count("*").alias("_n"), F.count("content").alias("_k"), *[x.alias(f"_{k}") for k, x in enumerate(parts)])
    return sums.select("record_id", F.sha2(F.concat_ws(",", "_n", "_k", *[f"_{k}" for k in range(5)]), 256).alias("digest"))


def leaves(index: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """Digests of both replicas' records at the places of the index (file, offset, record_id, digest, other); null where
    a replica lacks one."""
    out = index.select("file", "offset", "record_id").join(record_digests(first), "record_id", "left")
    return out.join(record_digests(second).withColumnRenamed("digest", "other"), "record_id", "left").select("file", "offset", "record_id", "digest", "other")


def parents(nodes: DataFrame, at: Column) -> DataFrame:
    """Nodes (file, offset, digest, other) above others; `at` is the offset of a node's parent."""
    joined = lambda c: F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("offset", F.coalesce(c, F.lit("-")).alias("d")))), lambda s: s["d"]), ""), 256)
    return nodes.groupBy("file", at.alias("up")).agg(joined("digest").alias("digest"), joined("other").alias("other")).withColumnRenamed("up", "offset")


def above(level: int) -> Column:
    """Offset of the node of a level (1 to LEVELS, then the root) that a smaller node lies in."""
    span = BLOCK * FANOUT ** (level - 1)
    return (F.floor(F.col("offset") / span) * span if level <= LEVELS else F.lit(0)).cast("long")


def audit(index: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """Records that differ between two replicas: record_id, file, offset, status (changed, missing_first, missing_second, extra_first, extra_second)."""
    levels = [materialize(leaves(index, first, second))]
    for level in range(1, LEVELS + 2):
        levels.append(materialize(parents(levels[-1], above(level))))
    differ = ~F.col("digest").eqNullSafe(F.col("other"))
    wrong = levels[-1].where(differ).select("file", "offset")
    for level in range(LEVELS, -1, -1):
        below = levels[level].withColumn("up", above(level + 1)).where(differ)
        wrong = below.join(wrong.withColumnRenamed("offset", "up"), ["file", "up"], "left_semi").drop("up")
        wrong = wrong.select("file", "offset") if level else wrong
    status = F.when(F.col("digest").isNull(), "missing_first").when(F.col("other").isNull(), "missing_second").otherwise("changed")
    out = wrong.select("record_id", "file", "offset", status.alias("status"))
    for name, replica in (("extra_first", first), ("extra_second", second)):
        extra = replica.select("record_id").where("record_id IS NOT NULL").distinct().join(index.select("record_id"), "record_id", "left_anti")
        out = out.union(extra.select("record_id", F.lit(None).cast("long"), F.lit(None).cast("long"), F.lit(name)))
    return out
