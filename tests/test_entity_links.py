from pyspark.sql import functions as F

from threadloom.operators import resolve


def test_mentions_of_common_texts_are_not_gathered(spark):
    mentions = spark.range(600).select(F.when(F.col("id") < 500, "often").when(F.col("id") < 599, F.concat(F.lit("t"), "id")).alias("text"), F.col("id").alias("thread_id"))
    found = spark.createDataFrame([("often", "k1"), ("t500", "k2"), ("other", "k3")], "surface string, ol_key string")
    got = resolve.entity_links(mentions, found, 10)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Union") == 1
    counts = {(r.text if r.text in ("often", "t500") else "", r.ol_key): r.n for r in got.withColumn("text", F.when(F.col("text").isin("often", "t500"), F.col("text")).otherwise("")).groupBy("text", "ol_key").agg(F.count("*").alias("n")).fillna({"text": ""}).collect()}
    assert counts == {("often", "k1"): 500, ("t500", "k2"): 1, ("", None): 99}
