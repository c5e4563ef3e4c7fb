import random

import pytest
from pyspark.sql import functions as F

from threadloom.operators import labels, ranking


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_places_of_a_total_order(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "B", "b", "cc"]), rng.choice([None, 0.5, 1.0]), i % 7, None) for i in range(500)]
    frame = spark.createDataFrame(rows, "surface string, score double, place int, note string").repartition(5)
    got = ranking.placed(frame, F.desc_nulls_last("score"), F.length("surface"), place="rank").collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 501))
    got.sort(key=lambda r: r["rank"])
    keys = [(r.score is None, -(r.score or 0), (0, 0) if r.surface is None else (1, len(r.surface)), r.surface or "", r.place) for r in got]
    assert keys == sorted(keys)
    assert sorted(map(str, (tuple(r)[:4] for r in got))) == sorted(map(str, rows))


@pytest.mark.parametrize("distinct", [True, False])
def test_no_task_numbers_the_whole_table(spark, distinct):
    rows = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
    got = ranking.placed(rows, F.desc("k"), distinct=distinct)
    assert "Window" not in plan(got) and "SinglePartition" not in plan(got)
    assert {r.id: r.place for r in got.collect()} == {i: (9 - i % 10) * 100 + i // 10 + 1 for i in range(1000)}


def test_equal_rows_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(ranking, "COPIES", 100)
    rows = spark.range(5000).select(F.when(F.col("id") < 4000, "same").otherwise(F.concat(F.lit("z"), F.col("id") % 3)).alias("t"))
    got = ranking.placed(rows, "t")
    assert got.filter("t = 'same'").agg(F.min("place"), F.max("place"), F.countDistinct("place")).first()[:] == (1, 4000, 4000)
    ranges = got.filter("t = 'same'").groupBy(F.input_file_name()).count().count()
    assert got.count() == 5000 and ranges > 1


def test_empty_table_and_merge_order(spark):
    assert ranking.placed(spark.createDataFrame([], "a int, b string"), "a").count() == 0
    rows = [("b", "k", None, 0.5), ("A", "k", None, 0.5), ("c", None, "", 0.9), ("d", "", "t", None), ("a", None, None, None)]
    got = ranking.placed(spark.createDataFrame(rows, "surface string, ol_key string, canonical_title string, score double"), *labels.merge_order(), distinct=True)
    assert [r.surface for r in sorted(got.collect(), key=lambda r: r.place)] == ["A", "b", "d", "a", "c"]
