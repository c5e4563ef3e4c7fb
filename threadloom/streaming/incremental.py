"""Incremental mode: new files in, each file once, resumed from a checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.labels import first_wins
from ..operators.threads import fast_accept


def new_lines(spark: SparkSession, path: str, files_per_batch: int = 8) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)


def once(rows: DataFrame, key: str, time: str | None = None, late: str = "7 days", first: str | None = None) -> DataFrame:
    """Each key once: within the watermark if rows have a time, else over the whole stream.

    A batch has no order of arrival: there ``first`` names the column whose least value says which row of a key stays.
    """
    if first is not None:
        return first_wins(rows, [key], first)
    return rows.dropDuplicates([key]) if time is None else rows.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def ingest(spark: SparkSession, path: str, out: str, checkpoint: str, communities: list[str], files_per_batch: int = 8) -> StreamingQuery:
    """Filter the files that have come since the last run and append accepted lines by month; each file is read once.

    Months come in any order, so no watermark drops what is late; ``once`` or ``last_wins`` make records unique.
    """
    rows = fast_accept(new_lines(spark, path, files_per_batch), communities).filter("status = 'accepted'").select("value", "ym")
    return rows.writeStream.partitionBy("ym").format("json").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)


def unprocessed(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key has not been processed."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def windowed_counts(events: DataFrame, width: str, late: str, key: str) -> DataFrame:
    """Counts per event-time window and key with a watermark (for streams; batches work as well)."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), key).agg(F.count(F.lit(1)).alias("n"))
