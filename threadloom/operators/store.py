"""The catalog as stored tables: bucketed, merged bucket by bucket, joined without moving them.

Works are kept twice, bucketed by key and by normalised title, and the pairs of work and author
by work. An import replaces works of the same key and keeps every pair it has seen (pairs of
superseded revisions too, D21). What is stored is never shuffled: an import's rows are dealt to the
buckets and merged there, each table is written anew beside the old one, which goes once the
new one is complete.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.stored import shared_folder
from .catalog import work_authors, works_table

#: Lets a join on several columns use the buckets of one of them.
_BY_SOME_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


@contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    was = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, was)


class Catalog:
    """Stored works and pairs. ``buckets`` stays what it is for as long as the catalog lives."""

    TABLES = {"works": "ol_key", "titles": "norm_title", "pairs": "work_key"}

    def __init__(self, spark: SparkSession, buckets: int | None = None):
        self.spark, self.buckets = spark, buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder, self.names = f"{shared_folder(spark)}/catalog-{uuid.uuid4().hex}", {}

    def table(self, kind: str) -> DataFrame:
        """``works`` by ol_key, ``titles`` (works by norm_title) or ``pairs`` by work_key."""
        return self.spark.table(self.names[kind])

    def _dealt(self, rows: DataFrame, kind: str) -> DataFrame:
        by = self.TABLES[kind]
        return rows.repartition(self.buckets, by).sortWithinPartitions(by)

    def _write(self, rows: DataFrame, kind: str) -> None:
        by, name = self.TABLES[kind], f"catalog_{kind}_{uuid.uuid4().hex}"
        rows.write.bucketBy(self.buckets, by).sortBy(by).option("path", f"{self.folder}/{name}").saveAsTable(name)
        old, self.names[kind] = self.names.get(kind), name
        if old:
            self.spark.sql(f"DROP TABLE {old}")
            place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{old}")
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)

    def _merge(self, new: DataFrame, kind: str, keys: list[str], replaced: DataFrame) -> None:
        """Stored rows but for those whose keys are in ``replaced``, then the new ones: each bucket on its own."""
        kept = self.table(kind).hint("merge").join(self._dealt(replaced, kind), keys, "left_anti")
        self._write(kept.unionByName(self._dealt(new, kind)), kind)

    def add(self, dump: DataFrame) -> None:
        """An import of dump lines (key, payload, _pos): the last revision of each key within it counts."""
        works, pairs = self._dealt(works_table(dump), "works"), work_authors(dump)
        if not self.names:
            self._write(works, "works")
            self._write(self._dealt(self.table("works"), "titles"), "titles")
            self._write(self._dealt(pairs, "pairs"), "pairs")
            return
        with _setting(self.spark, _BY_SOME_KEYS, "false"):
            incoming = Catalog(self.spark, self.buckets)  # written once: what comes in is read several times
            incoming._write(works, "works")
            new = incoming.table("works")
            gone = self.table("works").join(new.select("ol_key"), "ol_key", "left_semi").select("norm_title", "ol_key")
            self._merge(new, "titles", ["norm_title", "ol_key"], gone)
            self._merge(new, "works", ["ol_key"], new.select("ol_key"))
            unseen = self._dealt(pairs, "pairs").join(self.table("pairs").hint("merge"), ["work_key", "author_key"], "left_anti")
            self._merge(unseen, "pairs", ["work_key", "author_key"], unseen.limit(0))
            incoming.drop()

    def drop(self) -> None:
        for name in self.names.values():
            self.spark.sql(f"DROP TABLE {name}")
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
        self.names = {}

    def by_normalised_title(self, surfaces: DataFrame) -> DataFrame:
        """Surfaces with ``norm`` and the works of that normalised title."""
        works = self.table("titles")
        return surfaces.join(works, surfaces.norm == works.norm_title)

    def by_title(self, surfaces: DataFrame) -> DataFrame:
        """Surfaces with ``norm`` and the works of that very title; both have one normalised form, so the buckets serve."""
        return self.by_normalised_title(surfaces).filter(F.col("surface") == F.col("title"))

    def by_key(self, rows: DataFrame, key: str = "ol_key") -> DataFrame:
        works = self.table("works").withColumnRenamed("ol_key", key)
        return rows.join(works, key)

    def author_keys_of(self, rows: DataFrame, key: str = "work_key") -> DataFrame:
        return rows.join(self.table("pairs").withColumnRenamed("work_key", key), key)
