"""Exact dedup by two-pass Bloom filtering.

Pass 1 folds every text's 64-bit hash into a pair of bit sets, "seen" and "seen
again". Pass 2 asks the second one: a row all of whose positions were seen again may
be a repeat and goes to the exact grouping by SHA-256; every other row is certainly
alone and passes straight through, without a shuffle. The filter only ever errs towards
"may be a repeat", so its size changes cost, never results.

Defined cases: a null text counts as empty; equal means byte for byte; of equal texts the
row with the largest doc_id stays; repeated rows of one doc_id and text share the verdict
(``deduplicated`` keeps one of them); an empty table gives an empty table.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitfilter import bits_for, build, known
from .common import fresh, materialise, partitions_for

BITS_PER_ROW = 8
MIN_BITS, MAX_BITS = 1 << 20, 1 << 29
#: A group is dealt out by salts if it has more rows than this and than one in HOT_SHARE of an even partition.
SALTS, LARGE_GROUP, HOT_SHARE = 64, 256, 4


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with keep_id, group_size, kept and text_sha256 (input columns of these names give way).

    ``max_bits`` bounds the filter that is sent to every executor (64 MB for each of its
    bit sets by default); past it more rows take the exact path.
    """
    docs = docs.drop("keep_id", "group_size", "kept", "text_sha256")
    spark = docs.sparkSession
    names = {n: fresh(docs.columns, n) for n in ("h", "maybe", "salt", "hot")}
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.count()
    bits = bits_for(rows, BITS_PER_ROW, MIN_BITS, max_bits)
    again = spark.sparkContext.broadcast(build(docs.select(F.xxhash64(text).alias("h")), bits)[1])

    @F.pandas_udf("boolean")
    def may_repeat(h: pd.Series) -> pd.Series:
        return pd.Series(known(again.value, h.to_numpy(), bits))

    marked = docs.withColumn(names["h"], F.xxhash64(text)).withColumn(names["maybe"], may_repeat(names["h"])).drop(names["h"])
    sha = F.sha2(text.cast("binary"), 256)
    maybe = marked.filter(names["maybe"]).drop(names["maybe"]).withColumn("text_sha256", sha)
    alone = (
        marked.filter(~F.col(names["maybe"])).drop(names["maybe"]).withColumn("keep_id", F.col(id_col))
        .withColumn("group_size", F.lit(1).cast("long")).withColumn("kept", F.lit(True)).withColumn("text_sha256", sha)
    )
    groups = maybe.groupBy("text_sha256").agg(F.max(id_col).alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = materialise(groups, "exact-groups")
    # no more than HOT_SHARE groups a partition can be this large, so their hashes may be broadcast
    hot = groups.filter(F.col("group_size") > max(LARGE_GROUP, rows // (HOT_SHARE * partitions_for(spark)))).select("text_sha256")
    is_hot = F.col(names["hot"])
    salt = F.when(is_hot, F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(SALTS))).otherwise(0).cast("int")
    marks = hot.withColumn(names["hot"], F.lit(True))
    salted = maybe.join(F.broadcast(marks), "text_sha256", "left").withColumn(names["salt"], salt).drop(names["hot"])
    copies = groups.join(F.broadcast(marks), "text_sha256", "left")
    copies = copies.withColumn(names["salt"], F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).drop(names["hot"])
    grouped = salted.join(copies, ["text_sha256", names["salt"]]).withColumn("kept", F.col(id_col).eqNullSafe(F.col("keep_id")))
    return grouped.select(alone.columns).unionByName(alone)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, one for each text, with the columns of ``docs``."""
    kept = exact_groups(docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "text").filter("kept")
    many = kept.filter("group_size > 1").dropDuplicates(["text_sha256"])
    return kept.filter("group_size = 1").unionByName(many).select("row.*")
