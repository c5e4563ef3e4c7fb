"""Counters taken in passing: a write's own scan counts what it sees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation


def write_counted(rows: DataFrame, path: str, keep: Column, counts: dict[str, Column], drop: tuple[str, ...] = (), partition_by: tuple[str, ...] = ()) -> dict[str, int]:
    """Writes the rows to ``keep`` as Parquet, and returns the counts over all rows, kept or not, by name.

    ``counts`` are aggregates. They are taken in the stage that writes, after any shuffle of ``rows``: Spark adds up
    a partition of that stage once, even if its task runs again after an executor is lost.
    """
    seen = Observation()
    watched = rows.observe(seen, *(c.alias(n) for n, c in counts.items()))
    watched.filter(keep).drop(*drop).write.partitionBy(*partition_by).parquet(path)
    return {n: seen.get.get(n, 0) for n in counts}
