"""Tables that a plan writes on its way, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only a driver that is its own executor, as in tests, may go without."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="threadloom-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new name in the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` written once and read back: its lineage ends here, and what it holds stays the same however often it is read."""
    path = scratch(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(df.columns)


def discard(df: DataFrame) -> None:
    """Deletes what ``stored`` wrote for ``df``, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
