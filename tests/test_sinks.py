import hashlib
import json
import os

import pytest
import zstandard
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from threadloom.operators import labels, threads
from threadloom.sources import files, sinks
from threadloom.sources.counters import write_counted
from threadloom.streaming.upserts import Upserts


def test_manifest_reads_files_of_any_size(spark, tmp_path):
    """A sparse file of 3 GB, beyond what one row can hold, an empty file and one in a folder below."""
    (tmp_path / "a" / "b").mkdir(parents=True)
    with open(tmp_path / "a" / "big.bin", "wb") as f:
        f.truncate(3 << 30)
    (tmp_path / "a" / "empty").write_bytes(b"")
    (tmp_path / "a" / "b" / "small").write_bytes(b"text")
    rows = {os.path.basename(r.path): r for r in sinks.manifest(spark, str(tmp_path / "a")).collect()}
    zeros, piece = hashlib.sha256(), bytes(1 << 24)
    for _ in range(3 << 6):
        zeros.update(piece)
    assert {n: r.sha256 for n, r in rows.items()} == {"big.bin": zeros.hexdigest(), "empty": hashlib.sha256().hexdigest(), "small": hashlib.sha256(b"text").hexdigest()}
    assert rows["big.bin"].length == 3 << 30


def test_recompress_mirrors_folders(spark, tmp_path):
    texts = {"x/RC_2020-01.zst": b"a\n" * 50_000, "x/y/RS_2020-02.zst": b"", "RC_2020-03.zst": b"no end"}
    for name, text in texts.items():
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(zstandard.ZstdCompressor(level=1).compress(text[:70]) + zstandard.ZstdCompressor(level=1).compress(text[70:]))
    for _ in range(2):  # a second time over what is there
        rows = sinks.recompress(spark, str(tmp_path / "in"), str(tmp_path / "out"), level=12).collect()
    for name, text in texts.items():
        got = (tmp_path / "out" / name).read_bytes()
        assert zstandard.ZstdDecompressor().stream_reader(got, read_across_frames=True).read() == text
        (row,) = [r for r in rows if r.path.endswith("/in/" + name)]
        assert (row.out_length, row.sha256) == (len(got), hashlib.sha256(text).hexdigest())
    assert not [n for _, _, names in os.walk(tmp_path / "out") for n in names if n.endswith(".part")]
    whole = (tmp_path / "in" / "x/RC_2020-01.zst").read_bytes()
    (tmp_path / "in" / "x/RC_2020-01.zst").write_bytes(whole[:-3])
    with pytest.raises(PythonException, match="ends inside a frame"):
        sinks.recompress(spark, str(tmp_path / "in"), str(tmp_path / "new"))
    assert not (tmp_path / "new" / "x" / "RC_2020-01.zst").exists()


@pytest.mark.parametrize("pretty", [False, True])
def test_json_array_is_joined_from_parts(spark, tmp_path, pretty):
    rows = spark.range(1000).select(F.col("id"), F.expr("CASE WHEN id % 3 = 0 THEN NULL ELSE concat('é, \n\"', id) END").alias("t"))
    sinks.json_array(rows.repartition(7), str(tmp_path / "a.json"), F.desc("id"), pretty=pretty)
    text = (tmp_path / "a.json").read_text(encoding="utf-8")
    assert json.loads(text) == [{"id": i, "t": None if i % 3 == 0 else f'é, \n"{i}'} for i in range(999, -1, -1)]
    assert "é" in text and ("\n  " in text) == pretty
    sinks.json_array(rows.limit(0), str(tmp_path / "none.json"), "id", pretty=pretty)
    assert json.loads((tmp_path / "none.json").read_text()) == []
    assert files.json_array(spark, str(tmp_path / "a.json")).count() == 1000


def test_file_summary_has_grand_totals(spark):
    rows = spark.createDataFrame([("f", "accepted", "2020-01"), ("f", "bad", None), ("f", "accepted", "2020-03"), ("g", "rejected", "2021-01")], "file string, status string, ym string")
    got = {r.file: (r.total, r.matched, r.bad, r.last_month, r.out_path) for r in sinks.file_summary(rows, "/o", totals=True).collect()}
    assert got == {"f": (3, 2, 1, "2020-03", "/o/ym=2020-03"), "g": (1, 0, 0, "2021-01", None), None: (4, 2, 1, "2021-01", "/o/ym=2020-03")}


def test_writes_count_in_passing(spark, tmp_path):
    rows = spark.range(100).withColumn("g", F.col("id") % 3)
    counts = {"all": F.count(F.lit(1)), "low": F.count_if(F.col("id") < 10)}
    assert write_counted(rows, str(tmp_path / "a"), F.col("id") > 50, counts, partition_by=("g",)) == {"all": 100, "low": 10}
    assert spark.read.parquet(str(tmp_path / "a")).count() == 49
    assert write_counted(rows.filter("id < 0"), str(tmp_path / "b"), F.lit(True), counts) == {"all": 0, "low": 0}
    assert write_counted(spark.createDataFrame([], "id long"), str(tmp_path / "c"), F.lit(True), counts) == {"all": 0, "low": 0}


def test_dump_import_counts_each_line_once(spark, tmp_path):
    values = ["/type/work\tk\t1\tx\t{\"title\": \"a\\tb\"}", "/type/work\tk\t1", "", None, "/type/edition\te\t1\tx\t{", "/type/work\tbad\t1\tx\t{", "/type/work\tk\t1\tx\t{\"a\":\t1}"]
    rows = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, _pos int")
    assert files.import_dump(rows, str(tmp_path / "w"), "/type/work") == {"lines": 7, "kept": 2, "short": 3, "other": 1, "bad": 1}
    kept = spark.read.parquet(str(tmp_path / "w"))
    assert sorted(kept.columns) == sorted(files.dump(rows).columns)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, files.dump(rows, "/type/work").collect()))
    assert files.import_dump(rows, str(tmp_path / "all"))["bad"] == 2


def test_prune_and_source_totals(spark):
    rows = spark.createDataFrame([("a", True), ("a", False), ("a", None), ("b", False)], "k string, _removed boolean")
    assert sorted((r.k, r.total, r.kept, r.removed, float(r.removed_pct), r.bad) for r in threads.prune_totals(rows, "k").collect()) == [("a", 3, 1, 1, 33.33, 1), ("b", 1, 1, 0, 0.0, 0)]
    assert threads.prune_totals(rows.limit(0)).first().total == 0
    span = "array<struct<was_cancelled:boolean,result:array<string>>>"
    tasks = spark.createDataFrame([([(None, ["x"])], []), ([(False, None)], [(None, ["p"])]), ([(True, ["x"])], None), (None, [])], f"annotations {span}, predictions {span}")
    assert labels.source_counts(tasks).first().asDict() == {"tasks": 4, "annotation": 1, "prediction": 1, "none": 2, "reviewed": 2}


def test_upserts_survive_restarts(spark, tmp_path):
    schema = spark.createDataFrame([], "id string, p long, v string, _batch int").schema
    drops = [[("a", 1, "x", 5), ("a", 2, "y", 5), ("b", 1, "z", None), (None, 1, "no key", 1)], [("a", 0, "later drop", 6), ("c", None, "n", 1)], [("c", 1, "m", 2), ("c", 1, "m", 2)]]
    table = Upserts(spark, str(tmp_path / "t"), schema, "id", "p")
    assert table.current().count() == 0
    states = []
    for i, rows in enumerate(drops):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        table = Upserts(spark, str(tmp_path / "t"), schema, "id", "p")
        table.start(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "cp")).awaitTermination()
        if i == 1:
            before = sorted(map(str, table.current().collect()))
            table.compact()
            assert sorted(map(str, table.current().collect())) == before
        states.append({r.id: (r.p, r.v, r._batch) for r in table.current().collect()})
    assert states == [{"a": (2, "y", 5), "b": (1, "z", None)}, {"a": (0, "later drop", 6), "b": (1, "z", None), "c": (None, "n", 1)}, {"a": (0, "later drop", 6), "b": (1, "z", None), "c": (1, "m", 2)}]
    table.merge(spark.createDataFrame(drops[2], schema), 2)  # a batch that runs again
    assert {r.id: (r.p, r.v, r._batch) for r in table.current().collect()} == states[-1]
    assert table.current().columns == schema.names
