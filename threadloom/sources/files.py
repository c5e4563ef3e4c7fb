"""Sources: NDJSON dumps with any zstd window, tab-separated catalog dumps, CSV, JSON arrays."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.labels import last_wins
from . import frames
from .counters import write_counted
from .stored import stored

#: The widest zstd window that Spark's own reader takes.
PLAIN_WINDOW = 1 << 27


def months(path: Column) -> Column:
    """The month in a dump file's name."""
    return F.regexp_extract(path, r"[RC][CS]_(\d{4}-\d{2})\.zst", 1)


def dump_files(spark: SparkSession, path: str, first: str | None = None, last: str | None = None, pattern: str = "*.zst") -> list[str]:
    """Files of a folder by (month, path), from ``first`` to ``last``; those without a month in their name only if neither is given."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, pattern))
    paths = [f.getPath().toString() for f in found or [] if f.isFile()]
    dated = sorted((m[1] if (m := re.search(r"[RC][CS]_(\d{4}-\d{2})\.zst", p)) else "", p) for p in paths)
    return [p for ym, p in dated if (first is None or ym >= first) and (last is None or ("" < ym <= last))]


def lines(
    spark: SparkSession, path: str, first: str | None = None, last: str | None = None, pattern: str = "*.zst", probes: tuple[str, ...] = (), by_frames: bool | None = None
) -> DataFrame:
    """(value, ym, file) of compressed NDJSON; only the wanted months' files are listed. With ``probes`` only lines that hold one of them, in any case.

    Files of several frames, and those whose frames need a window beyond Spark's reader, are read by frames, the others
    by Spark; ``by_frames`` says so for all. All frames are looked up first: a file that ends inside one raises an error.
    """
    files = dump_files(spark, path, first, last, pattern)
    rows = spark.createDataFrame([], "value string, file string")
    found = stored(frames.frames(spark, files), "frames") if files and by_frames is not False else None
    framed = set()
    if found is not None:
        wide = found.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.max("window").alias("window"))
        framed = {r["file"] for r in (wide if by_frames else wide.filter((F.col("n") > 1) | (F.col("window") > PLAIN_WINDOW))).collect()}  # a row for each listed file
    if plain := [p for p in files if p not in framed and by_frames is not True]:
        text = spark.read.text(plain).select("value", F.col("_metadata.file_path").alias("file"))
        low = F.lower("value")
        rows = rows.unionByName(text.filter(reduce(lambda a, p: a | F.contains(low, F.lit(p.lower())), probes, F.lit(False))) if probes else text)
    if framed:
        kept = found.join(F.broadcast(spark.createDataFrame([(p,) for p in sorted(framed)], "file string")), "file", "left_semi").select("file", "start", "end", "window")
        rows = rows.unionByName(frames.frame_lines(spark, kept, tuple(probes)).select("value", "file"))
    return rows.withColumn("ym", months(F.col("file"))).select("value", "ym", "file")


def entities(rows: DataFrame, schema: StructType | str, value: str = "value", key: str = "id") -> DataFrame:
    """Parsed NDJSON records with a key (``id``, or ``thread_id`` of threads); blank, malformed and keyless lines go."""
    parsed = rows.filter(F.trim(value) != "").withColumn("r", F.from_json(value, schema))
    keep = [c for c in rows.columns if c != value]
    return parsed.filter(F.col(f"r.{key}").isNotNull()).select(*keep, "r.*")


def checkpoint(rows: DataFrame, schema: StructType | str, pos: str, key: str = "thread_id") -> DataFrame:
    """Records of a checkpoint file: malformed ones go, the last of each key stays."""
    return last_wins(entities(rows, schema, key=key), [key], pos)


def editions(rows: DataFrame, value: str = "value") -> DataFrame:
    """Edition lines of a dump: lines without an edition key go before anything is parsed."""
    return dump(rows.filter(F.contains(F.col(value), F.lit("\t/books/"))), "/type/edition", value)


def _dump_parts(rows: DataFrame, value: str) -> DataFrame:
    part = F.split(value, "\t", 5)
    return rows.withColumn("_parts", F.size(part)).select(*[c for c in rows.columns if c != value], "_parts", *(F.get(part, F.lit(i)).alias(n) for i, n in enumerate(("type", "key", "revision", "last_modified", "payload"))))


def dump(rows: DataFrame, wanted: str | None = None, value: str = "value") -> DataFrame:
    """(type, key, revision, last_modified, payload) of 5-column dump lines; short lines go."""
    named = _dump_parts(rows, value).filter("_parts = 5").drop("_parts")
    named = named if wanted is None else named.filter(F.col("type") == wanted)
    return named.filter(F.try_parse_json("payload").isNotNull())


def import_dump(rows: DataFrame, path: str, wanted: str | None = None, value: str = "value") -> dict[str, int]:
    """Writes what ``dump`` gives and returns how many lines there were, and were kept, short, of another type or not JSON (``bad``), from one scan.

    A null line is short. Every line counts once, for the first of these that it is.
    """
    status = F.when(F.coalesce(F.col("_parts"), F.lit(0)) != 5, "short")
    status = status if wanted is None else status.when(F.col("type") != wanted, "other")
    judged = _dump_parts(rows, value).withColumn("_status", status.when(F.try_parse_json("payload").isNull(), "bad").otherwise("kept"))
    counts = {"lines": F.count(F.lit(1))} | {s: F.count_if(F.col("_status") == s) for s in ("kept", "short", "other", "bad")}
    return write_counted(judged, path, F.col("_status") == "kept", counts, ("_status", "_parts"))


def csv(spark: SparkSession, path: str, schema: str, required: tuple[str, ...] = ()) -> DataFrame:
    """A CSV with a header; raises if a required column is missing."""
    found = spark.read.option("header", True).csv(path).columns
    if missing := [c for c in required if c not in found]:
        raise ValueError(f"{path} lacks the columns {missing}")
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).schema(schema).csv(path)


def json_array(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def peek(rows: DataFrame, condition: Column) -> DataFrame:
    """The first row that meets a condition."""
    return rows.filter(condition).limit(1)
