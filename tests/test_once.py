import __spark_entry__ as entry
from threadloom.streaming.incremental import once

SF = "/root/testdata/sf0.001"


def test_first_row_of_each_key_stays_whole(spark):
    rows = spark.createDataFrame([("a", 3, "z"), ("a", 1, "y"), ("b", 2, "x"), ("a", 2, None)], "k string, at int, v string").repartition(3)
    assert sorted(map(tuple, once(rows, "k", first="at").select("k", "at", "v").collect())) == [("a", 1, "y"), ("b", 2, "x")]


def test_query_gives_each_users_first_event(spark):
    events, got = spark.read.parquet(f"{SF}/events.parquet"), entry.queries()["once_per_key"](spark, SF)
    assert sorted(got.columns) == ["event_id", "user_id"]
    least = {}
    for r in events.select("user_id", "event_id").collect():
        least[r.user_id] = min(r.event_id, least.get(r.user_id, r.event_id))
    assert {r.user_id: r.event_id for r in got.collect()} == least
