import __spark_entry__ as entry
from pyspark.sql import functions as F

from threadloom.operators import labels
from threadloom.plans import adapters

SF = "/root/testdata/sf0.001"


def test_candidates_of_tasks_are_counted_in_bounded_partitions(spark):
    items = spark.read.parquet(f"{SF}/lineitem.parquet")
    assert adapters.parts(items, 1000) == -(-items.count() // 1000) and adapters.parts(items) == 4
    rows = items.groupBy(F.col("l_partkey").alias("candidate")).agg(F.collect_set("l_orderkey").alias("task_ids"))
    got = labels.candidate_tasks(rows, 7)
    assert got.rdd.getNumPartitions() == 7
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, entry.queries()["candidate_tasks"](spark, SF).collect()))
