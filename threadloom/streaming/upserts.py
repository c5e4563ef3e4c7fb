"""Upserts over a stream: of each key the row that came last, kept over batches and restarts.

A batch is one folder with its own last row of each key, so that a batch costs what comes in, never
what is stored; a batch that runs again after a failure replaces its folder. Reading takes the last
row of each key over the folders by partial aggregation. ``compact`` writes the folders as one; it
is complete once Spark has marked it so, and only then do the folders go.

Rows without a key go. Within a batch the greatest ``pos`` is last (null before all, equal ones by a hash of the row), over
batches the later batch. A table
without batches has no rows. Columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.labels import last_wins


class Upserts:
    """The table under ``path``; ``schema`` is that of the stream's rows."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str, pos: str):
        self.spark, self.path, self.schema, self.key, self.pos = spark, path.rstrip("/"), schema, key, pos
        self.batch = "_batch"
        while self.batch in schema.names:
            self.batch += "_"

    def _fs(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _complete(self, kind: str) -> list[int]:
        """Numbers of the complete folders of a kind."""
        system, place = self._fs(f"{self.path}/{kind}-*/_SUCCESS")
        return sorted(int(f.getPath().getParent().getName().rsplit("-", 1)[1]) for f in system.globStatus(place) or [])

    def _folders(self) -> list[tuple[int, str]]:
        bases, batches = self._complete("base"), self._complete("batch")
        low = bases[-1] if bases else -1
        return ([(low, f"{self.path}/base-{low}")] if bases else []) + [(n, f"{self.path}/batch-{n}") for n in batches if n > low]

    def merge(self, rows: DataFrame, number: int) -> None:
        """What a batch does; the same number again replaces it."""
        keyed = rows.select(self.schema.names).filter(F.col(self.key).isNotNull()).withColumn(self.batch, F.struct(F.col(self.pos), F.xxhash64(F.to_json(F.struct(*self.schema.names)))))
        last_wins(keyed, [self.key], self.batch).select(self.schema.names).write.mode("overwrite").parquet(f"{self.path}/batch-{number}")

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Takes in all that has come since the last run."""
        return stream.writeStream.foreachBatch(self.merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def current(self) -> DataFrame:
        rows = self.spark.createDataFrame([], self.schema).withColumn(self.batch, F.lit(0))
        for number, folder in self._folders():
            rows = rows.unionByName(self.spark.read.schema(self.schema).parquet(folder).withColumn(self.batch, F.lit(number)))
        return last_wins(rows, [self.key], self.batch).select(self.schema.names)

    def compact(self) -> None:
        """All complete folders as one; not to run beside another ``compact``."""
        if len(held := self._folders()) < 2:
            return
        upto = held[-1][0]
        self.current().write.mode("overwrite").parquet(f"{self.path}/base-{upto}")
        gone = [f"base-{n}" for n in self._complete("base") if n < upto] + [f"batch-{n}" for n in self._complete("batch") if n <= upto]
        for folder in gone:
            system, place = self._fs(f"{self.path}/{folder}")
            system.delete(place, True)
