from pyspark.sql import functions as F

from threadloom.operators import catalog


def test_exact_names_give_all_their_authors(spark):
    authors = spark.range(250).select(F.concat(F.lit("/authors/"), "id").alias("author_key"), F.lit("Same Name").alias("name"), F.lit("same name").alias("norm_name"))
    assert catalog.by_name(authors.select("name"), authors, normalised=False, limit=None).count() == 250
    assert catalog.by_name(authors.select("name"), authors, normalised=False).count() == 200


def test_query_of_exact_names_has_no_limit(spark, tmp_path):
    import __spark_entry__ as entry

    for name in ("supplier", "nation"):
        rows = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        if name == "supplier":
            rows = rows.limit(1).drop("s_suppkey").crossJoin(spark.range(4, 1004, 4).withColumnRenamed("id", "s_suppkey")).withColumn("s_suppkey", F.col("s_suppkey") * 7)
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    got = entry.queries()["authors_by_exact_name"](spark, str(tmp_path))
    assert got.count() == got.select("author_key").distinct().count() == 250
