"""A corpus from documents to packed sequences: quality, near duplicates, repeated units, leaked test items, packing.

Each stage maps (spark, docs, sf_dir) to a DataFrame. It is written as Parquet and read again as the docs of the next.

All stages take null, empty and very long texts, repeated rows, rows without an id and empty tables. A text that is null
or empty is no test item and no copy; the classifier scores it 0, and without labels keeps everything. Rows that share an
id are judged one by one by the classifier and share one fate in the stages that look for copies and test items: of them
all stay, if one of them is the one that its group keeps, and all go, if one of them leaks. So do rows without an id.
Extra columns of the input are left behind.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import decontamination, near_dup, packing, quality, unit_dedup
from tideline.llm.common import shared_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier takes for good; the labels of the table train it. An empty table gives none."""
    model = quality.train(docs, quality.graded(spark.read.parquet(f"{sf_dir}/labels.parquet")), levels=3)
    return quality.score(docs, model, at_least=2).where("accepted").select(*COLUMNS)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of the smallest id; of repeated rows of that id all."""
    kept = near_dup.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("kept_id"))
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi").select(*COLUMNS)


def unit_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without units that an earlier document has; documents of which nothing is left go, others keep their order.

    A text without a repeated unit stays as it is, null and empty ones too; n_chars follows a text that changed.
    """
    out = unit_dedup.remove_repeated_units(docs)
    changed = F.size("spans") > 0
    out = out.where(~changed | (F.trim("kept_text") != ""))
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("text"))
    return out.select("doc_id", text.alias("text"), "lang", "source", F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item; documents without an id share one fate, as those of equal ids do."""
    leaks = decontamination.leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(F.col("doc_id").alias("leak_id")).distinct()
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks["leak_id"]), "left_anti").select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids; an empty table gives none, an empty text its end id."""
    return packing.pack(docs, path=public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality_stage), ("near_dup", near_dup_stage), ("unit_dedup", unit_stage), ("decontamination", decontamination_stage), ("packing", packing_stage)]

#: The classifier and the tokenizer are beyond SQL; near_dup, unit_dedup, decontamination and packing are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, on the documents of sf_dir; what is between them goes to the folder that the cluster names.

    A stage's output is deleted once the next one has written its own; that of the last but one stays for the readers of
    the result, below pipeline-..., until the caller deletes it.
    """
    top = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = f"{top}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            where = spark._jvm.org.apache.hadoop.fs.Path(before)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
