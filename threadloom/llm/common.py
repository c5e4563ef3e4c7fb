"""Shared plumbing of the training-data operators: workspace, tables, batches."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: Text handled at once inside a Python worker; bounds its memory.
SLICE_BYTES = 1 << 20
#: Deletes a query's shuffle files when it ends, instead of when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workspace(spark: SparkSession) -> str:
    """Folder that driver and executors share. Only a driver that is its own executor may go without a setting."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="threadloom-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def materialise(df: DataFrame, label: str, compression: str = "snappy", group_bytes: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of it.

    Cuts the lineage; the files outlive any executor. The shuffles that led to them go at once.
    With small row groups (``group_bytes``) a filter on what they are sorted by reads little else.
    """
    spark = df.sparkSession
    path, was = f"{workspace(spark)}/{label}-{uuid.uuid4().hex}", spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        (df.write.option("parquet.block.size", group_bytes) if group_bytes else df.write).parquet(path, compression=compression)
    finally:
        spark.conf.set(CLEANUP, was)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Deletes the files of a table that ``materialise`` wrote and nothing reads any more."""
    context = df.sparkSession.sparkContext
    for path in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def _free_memory() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


_settled = False


def _settle() -> None:
    """Takes what is loaded by now out of later collections, once in a process: walking all modules costs a task about 90 ms."""
    global _settled
    if not _settled:
        gc.freeze()
        _settled = True


def give_back(spark: SparkSession) -> None:
    """Has the driver and the executors collect their heaps and return what past jobs took: a heap else grows to its bound before it is collected."""
    tasks = spark.sparkContext.defaultParallelism  # at once, so that each executor has some
    spark.range(0, tasks, 1, tasks).select(F.expr("reflect('java.lang.System', 'gc')").alias("gc")).write.format("noop").mode("overwrite").save()
    spark.sparkContext._jvm.System.gc()
    _free_memory()


def released(run: Callable) -> Callable:
    """``run`` for mapInArrow. Workers live on after a task: this gives what it held back to the system."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            _free_memory()
            _settle()

    return whole


def fresh(columns: list[str], wanted: str) -> str:
    """A column name that clashes with none of ``columns``."""
    taken, name = {c.lower() for c in columns}, wanted
    while name.lower() in taken:
        name = "_" + name
    return name


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` bytes of ``column`` (one row at least)."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes.astype(np.int64)), 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def partitions_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def training_fold(doc_id: str) -> Column:
    """Rows whose labels may be learned: crc32 of the id as text, modulo 3, is not 1."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 != 1
