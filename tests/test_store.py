import json

import pytest
from pyspark.sql import functions as F

from threadloom.functions import text as tx
from threadloom.operators import store


def dump(spark, rows):
    lines = [(k, json.dumps({"title": t, "authors": [{"author": {"key": a}} for a in authors]}), i) for i, (k, t, authors) in enumerate(rows)]
    return spark.createDataFrame(lines, "key string, payload string, _pos int")


@pytest.fixture
def held(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield store.Catalog(spark, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def works(held):
    return sorted((r.ol_key, r.title, r.norm_title) for r in held.table("works").collect())


def test_second_import_replaces_and_keeps(spark, held):
    held.add(dump(spark, [("w1", "Old", ["a1"]), ("w1", "Older Dune", ["a2"]), ("w2", "Dune", ["a1"]), ("w4", "Stays!", [])]))
    assert works(held) == [("w1", "Older Dune", "older dune"), ("w2", "Dune", "dune"), ("w4", "Stays!", "stays")]
    held.add(dump(spark, [("w1", "Dune", ["a3"]), ("w3", "Émile", ["a1"]), ("w2", "Dune", ["a1"])]))
    held.add(dump(spark, [("w3", "Émile", ["a9"])]))
    assert works(held) == [("w1", "Dune", "dune"), ("w2", "Dune", "dune"), ("w3", "Émile", "emile"), ("w4", "Stays!", "stays")]
    assert works(held) == sorted((r.ol_key, r.title, r.norm_title) for r in held.table("titles").collect())
    pairs = sorted(tuple(r) for r in held.table("pairs").select("work_key", "author_key").collect())
    assert pairs == [("w1", "a1"), ("w1", "a2"), ("w1", "a3"), ("w2", "a1"), ("w3", "a1"), ("w3", "a9")]
    surfaces = spark.createDataFrame([("DUNE",), ("Dune",), ("emile",)], "surface string").withColumn("norm", tx.norm_title("surface"))
    assert sorted((r.surface, r.ol_key) for r in held.by_normalised_title(surfaces).collect()) == [("DUNE", "w1"), ("DUNE", "w2"), ("Dune", "w1"), ("Dune", "w2"), ("emile", "w3")]
    assert sorted((r.surface, r.ol_key) for r in held.by_title(surfaces).collect()) == [("Dune", "w1"), ("Dune", "w2")]
    assert held.by_key(spark.createDataFrame([("w3",)], "ol_key string")).first().title == "Émile"
    assert len(held.names) == 3
    held.drop()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("catalog_works_")]


def test_what_is_stored_is_not_shuffled(spark, held):
    held.add(dump(spark, [(f"w{i}", f"Title {i % 50}", ["a"]) for i in range(300)]))
    surfaces = spark.range(20).select(F.concat(F.lit("title "), "id").alias("surface"), F.concat(F.lit("title "), "id").alias("norm"))
    for joined in (held.by_normalised_title(surfaces), held.by_key(spark.range(5).select(F.concat(F.lit("w"), "id").alias("ol_key"))), held.author_keys_of(spark.range(5).select(F.concat(F.lit("w"), "id").alias("work_key")))):
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan
    held.add(dump(spark, [("w0", "Other", ["b"])]))
    assert held.table("works").count() == 300
