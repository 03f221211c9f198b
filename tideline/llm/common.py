"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: ASCII upper case to lower case, every other byte as it is.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


#: Read by Spark whenever a checkpoint is made: whether its files go once nothing refers to them.
CLEAN = "spark.cleaner.referenceTracking.cleanCheckpoints"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the folder that the cluster names.

    What no plan refers to any more is collected on the driver, so that Spark's cleaner deletes its shuffle files and
    checkpoints now and not at the driver's next collection: many small steps would else fill the disks. The cleaner
    deletes checkpoints only if it is asked to, so that is set here unless the cluster has a setting of its own.
    """
    shared_folder(df.sparkSession)
    sc = df.sparkSession.sparkContext
    conf = sc._jsc.sc().conf()
    if not conf.contains(CLEAN):
        conf.set(CLEAN, "true")
    out = df.checkpoint(eager=True)
    sc._jvm.System.gc()
    return out


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset a temporary folder, in local mode only, as other machines do not see it."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
            folder = tempfile.mkdtemp(prefix="tideline-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


_tables: list[dict] = []


def give_back() -> None:
    """Return what this process has freed to the machine; Arrow's pool and malloc would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def gives_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run` for mapInArrow, whose worker gives back at the end of a task what the task has freed: Spark keeps the worker
    for later stages, beside the executor's heap."""

    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


def keep_only(table: dict | None) -> None:
    """Empty the tables of words that other operators have left in this worker process, which Spark uses again for their
    successors, and give their memory back: it then holds one operator's words and not those of all that ran before."""
    left = [other for other in _tables if other is not table and other]
    for other in left:
        other.clear()
    if left:
        gc.collect()
        give_back()
    if table is not None and not any(other is table for other in _tables):
        _tables.append(table)


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that `column` holds about most_bytes in each; a longer value stays whole."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        at, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > most_bytes:
                yield batch.slice(at, i - at)
                at, held = i, 0
            held += int(n)
        yield batch.slice(at)
