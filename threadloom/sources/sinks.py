"""Sinks: monthly NDJSON, merged and recompressed text, manifests, CSV with a fixed order."""

from __future__ import annotations

import fnmatch
import hashlib
import json
import uuid
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import frames
from .stored import scratch, stored

#: Bytes of a file that are held at once.
CHUNK = 8 << 20


def monthly(rows: DataFrame, path: str, value: str = "value") -> None:
    """Accepted raw lines as compressed text by month; months without rows make no files."""
    rows.select(F.col(value).alias("value"), "ym").write.mode("overwrite").partitionBy("ym").option("compression", "gzip").text(path)


def merge_months(spark: SparkSession, path: str, out: str, compression: str = "zstd", files: int = 8) -> None:
    """Monthly files as one recompressed set, lines in the order of (month, file, line); a large month is several tasks."""
    rows = spark.read.text(path).select("value", "ym", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"))
    ordered = rows.repartitionByRange(files, "ym", "file", "block", "pos").sortWithinPartitions("ym", "file", "block", "pos")
    ordered.select("value").write.mode("overwrite").option("compression", compression).text(out)


def file_summary(rows: DataFrame, out: str | None = None, totals: bool = False) -> DataFrame:
    """Totals of each input file of rows with status and ym; with ``totals`` a row of null file for all, from the same scan.

    ``out_path`` is where ``monthly`` puts a file's last month, null without ``out`` or if nothing of the file was accepted.
    """
    groups = rows.rollup("file") if totals else rows.groupBy("file")
    matched = F.count_if(F.col("status") == "accepted")
    last = F.max(F.when(F.col("status") == "accepted", F.col("ym")))
    summed = groups.agg(F.count(F.lit(1)).alias("total"), matched.alias("matched"), F.count_if(F.col("status") == "bad").alias("bad"), F.max("ym").alias("last_month"), last.alias("_last"))
    return summed.withColumn("out_path", F.concat(F.lit(out), F.lit("/ym="), F.col("_last"))).drop("_last")


def listed(spark: SparkSession, path: str, pattern: str = "*") -> list[tuple[str, int]]:
    """(path, length) of all files under a folder, empty ones too, by path; names that begin with a dot or an underscore stay out."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    found, out = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, True), []
    while found.hasNext():
        status = found.next()
        name = status.getPath().getName()
        if name[:1] not in "._" and fnmatch.fnmatchcase(name, pattern):
            out.append((status.getPath().toString(), status.getLen()))
    return sorted(out)


def _dealt(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """The files of a folder over as many tasks as there are files, so that a lost task costs one."""
    files = listed(spark, path, pattern)
    return spark.createDataFrame(files, "path string, length bigint").repartition(max(1, len(files)))


@contextmanager
def _new_file(path: str):
    """A file that appears under its name only once it is whole; of tasks that write it twice one replaces the other."""
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(frames.uri(path))
    folder, _, own = name.rpartition("/")
    part = f"{folder}/.{own}.{uuid.uuid4().hex}.part"
    system.create_dir(folder, recursive=True)
    try:
        with system.open_output_stream(part) as out:
            yield out
        if system.get_file_info(name).type != fs.FileType.NotFound:
            system.delete_file(name)
        system.move(part, name)
    except BaseException:
        if system.get_file_info(part).type != fs.FileType.NotFound:
            system.delete_file(part)
        raise


def manifest(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length, sha256) of every file, of any size: a task reads its files in pieces."""

    def run(batches):
        for batch in batches:
            for name, length in zip(*(c.to_pylist() for c in batch.columns)):
                digest = hashlib.sha256()
                with frames.open_file(name) as source:
                    while piece := source.read(CHUNK):
                        digest.update(piece)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([length], pa.int64()), pa.array([digest.hexdigest()])], ["path", "length", "sha256"])

    return _dealt(spark, path, pattern).mapInArrow(run, "path string, length bigint, sha256 string")


def recompress(spark: SparkSession, path: str, out: str, level: int = 19, pattern: str = "*.zst") -> DataFrame:
    """Each zstd file under a folder written anew at ``level`` to the same place under ``out``, as a stream.

    (path, length, out_path, out_length, sha256), the digest being that of what the file holds. A file that ends
    inside a frame raises an error and leaves nothing under its name. A file is one task.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toString().rstrip("/") + "/"
    target = out.rstrip("/") + "/"

    def run(batches):
        import zstandard

        for batch in batches:
            for name, length in zip(*(c.to_pylist() for c in batch.columns)):
                with frames.open_file(name) as source:
                    for _ in frames.walk(source, source.size(), name):
                        pass
                place, digest, size = target + name.removeprefix(root), hashlib.sha256(), 0
                with _new_file(place) as sink, zstandard.ZstdCompressor(level=level, write_checksum=True).stream_writer(sink, closefd=False) as writer:
                    for piece in frames.chunks(name, 0, None):
                        digest.update(piece)
                        writer.write(piece)
                with frames.open_file(place) as written:
                    size = written.size()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v]) for v in (name, length, place, size, digest.hexdigest())], ["path", "length", "out_path", "out_length", "sha256"]
                )

    done = _dealt(spark, path, pattern).mapInArrow(run, "path string, length bigint, out_path string, out_length bigint, sha256 string")
    return stored(done, "recompressed")


def ndjson(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def thread_documents(segs: DataFrame, meta: DataFrame) -> DataFrame:
    """{thread_id, metadata, segments[]} of each thread, segments in order; a thread's own segments bound a row."""
    fields = [c for c in segs.columns if c != "thread_id"]
    listed = segs.groupBy("thread_id").agg(F.array_sort(F.collect_list(F.struct("seg_no", *[c for c in fields if c != "seg_no"]))).alias("segments"))
    return meta.select("thread_id", F.struct(*[c for c in meta.columns if c != "thread_id"]).alias("metadata")).join(listed, "thread_id")


def corpus_text(documents: DataFrame, path: str, separator: str = "=" * 80) -> None:
    """Rendered documents, each with a separator line after it."""
    documents.select(F.concat_ws("\n", "document", F.lit(separator))).write.mode("overwrite").text(path)


@F.pandas_udf(StringType())
def _indented(rows: pd.Series) -> pd.Series:
    return rows.map(lambda r: json.dumps(json.loads(r), ensure_ascii=False, indent=2))


def json_array(rows: DataFrame, path: str, *order, pretty: bool = False) -> None:
    """One JSON array in one file, for the export of tasks.

    Tasks write ordered parts, one task joins the parts end to end as bytes; no row passes through the driver.
    Rows without an order come as their partitions do. No rows make an empty array.
    """
    spark = rows.sparkSession
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order) if order else rows
    line = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    parts = scratch(spark, "array")
    ordered.select((_indented(line) if pretty else line).alias("value")).write.option("lineSep", ",\n").text(parts)

    def run(batches):
        names = [n for batch in batches for of in batch.column(0).to_pylist() for n in of]
        written = 0
        with _new_file(path) as out:
            out.write(b"[\n")
            held = b""  # the last row's separator goes
            for name in names:
                with frames.open_file(name) as source:
                    while piece := source.read(CHUNK):
                        held += piece
                        out.write(held[:-2])
                        written += len(held[:-2])
                        held = held[-2:]
            out.write(b"\n]\n" if written else b"]\n")
        yield pa.RecordBatch.from_arrays([pa.array([written], pa.int64())], ["bytes"])

    names = [n for n, _ in listed(spark, parts)]  # as many as there were tasks
    spark.createDataFrame([(names,)], "names array<string>").coalesce(1).mapInArrow(run, "bytes bigint").collect()  # one number
    place = spark._jvm.org.apache.hadoop.fs.Path(parts)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def ordered_csv(rows: DataFrame, path: str, *order, quote_all: bool = False) -> None:
    rows.orderBy(*order).write.mode("overwrite").option("header", True).option("quoteAll", quote_all).option("escape", '"').csv(path)


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)
