"""Global orders without a task that holds them: ranges, counts of each range, places inside.

Rows are dealt into ranges of the order and sorted there; what a range holds is written with
each row's number in it; the ranges' counts, summed up, are the offsets. One shuffle, no window.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.stored import stored

#: Equal rows that one task multiplies; larger groups of equal rows are dealt out.
COPIES = 1 << 16
#: ``monotonically_increasing_id`` counts the rows of a partition in these bits.
ROW_BITS = 33


def _copies(rows: DataFrame) -> DataFrame:
    """``rows`` with a number for each of several equal ones, so that no two rows are equal any more."""
    counted = rows.groupBy(*(F.col(f"`{c}`") for c in rows.columns)).agg(F.count(F.lit(1)).alias("_n"))
    few = counted.filter(F.col("_n") <= COPIES).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    starts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / COPIES).cast("long"))
    many = counted.filter(F.col("_n") > COPIES).withColumn("_part", F.explode(starts))
    many = many.repartition(*(F.col(f"`{c}`") for c in rows.columns), "_part")
    inside = F.sequence(F.col("_part") * COPIES + 1, F.least((F.col("_part") + 1) * COPIES, F.col("_n")))
    return few.unionByName(many.withColumn("_copy", F.explode(inside)).drop("_part")).drop("_n")


def placed(rows: DataFrame, *order: Column | str, distinct: bool = False, place: str = "place") -> DataFrame:
    """``rows`` with their ``place`` from 1 in a total order: by ``order``, then by all their columns.

    Equal rows get places next to each other, whichever comes first. With ``distinct`` the caller
    says that no two rows are equal, which saves a shuffle; right results don't depend on it. Columns that cannot be compared (maps,
    variants) don't take part in breaking ties, so they need ``distinct``. An empty table stays empty.
    """
    spark = rows.sparkSession
    single = rows if distinct else _copies(rows)
    keys = [F.col(o) if isinstance(o, str) else o for o in order]
    comparable = [f.name for f in single.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    keys += [F.col(f"`{c}`") for c in comparable]
    ranged = single.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys)
    numbered = stored(ranged.withColumn("_id", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_id", ROW_BITS)
    counts = sorted(tuple(r) for r in numbered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())  # a row for each range
    offsets = [(p, before) for (p, _), before in zip(counts, accumulate((n for _, n in counts), initial=0))]
    before = spark.createDataFrame(offsets, "_range bigint, _before bigint")
    value = F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + 1
    joined = numbered.join(F.broadcast(before), part == F.col("_range"))
    return joined.withColumn(place, value).select(*(F.col(f"`{c}`") for c in rows.columns if c != place), place)
