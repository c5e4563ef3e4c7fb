import random
import re

import pytest
from pyspark.sql import functions as F

from threadloom.operators import labels, resolve, selection, spans, threads, trees
from threadloom.sources import files, sinks

COMMENTS = "thread_id string, id string, parent_id string, created_utc long, _pos long"


def tree(spark):
    rows = [
        ("t", "a", "t3_t", 5, 0), ("t", "b", "t3_t", 5, 1), ("t", "c", "t1_a", 9, 2), ("t", "d", "t1_a", 3, 3), ("t", "e", "t1_gone", 1, 4), ("t", "f", "t1_e", 2, 5),
        ("t", "x", "t1_y", 1, 6), ("t", "y", "t1_x", 1, 7), ("t", "z", "t1_z", 1, 8), ("u", "only", "t3_u", 1, 9),
    ]
    return spark.createDataFrame(rows, COMMENTS)


def test_comment_order(spark):
    expected = [("t", "a", 1, 0), ("t", "d", 2, 1), ("t", "c", 2, 2), ("t", "b", 1, 3), ("t", "e", 1, 4), ("t", "f", 2, 5), ("u", "only", 1, 0)]
    for order in (threads.comment_order, threads.comment_order_sql, trees.ranked_order):
        assert sorted(tuple(r) for r in order(tree(spark)).select("thread_id", "id", "depth", "place").collect()) == sorted(expected)


def test_deep_thread(spark):
    rows = [("t", f"c{i}", "t3_t" if not i else f"t1_c{i - 1}", i, i) for i in range(1500)]
    assert threads.comment_order(spark.createDataFrame(rows, COMMENTS)).agg(F.max("depth")).first()[0] == 1500


def test_ranked_order_of_any_tree(spark):
    """Ties, nulls, orphans with replies, cycles and wide parents: what the walk gives."""
    rng, rows = random.Random(6), []
    for t in range(4):
        ids = [f"c{i}" for i in range(60)]
        for i, own in enumerate(ids):
            above = rng.choice([f"t3_t{t}", "t1_c0", f"t1_{rng.choice(ids)}", "t1_gone", None, f"t1_{ids[max(0, i - 1)]}"])
            rows.append((f"t{t}", own, above, rng.choice([None, 1, 2, 3]), len(rows)))
    frame = spark.createDataFrame(rows, COMMENTS).repartition(3)
    ranked = trees.ranked_order(frame)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "Pandas" not in plan and "Window" not in plan
    columns = ["thread_id", "id", "depth", "place"]
    assert sorted(map(tuple, ranked.select(columns).collect())) == sorted(map(tuple, threads.comment_order(frame).select(columns).collect()))
    assert trees.ranked_order(frame.limit(0)).count() == 0


def test_large_threads_are_ranked(spark, monkeypatch):
    monkeypatch.setattr(threads, "GROUP_COMMENTS", 5)
    assert sorted(map(tuple, threads.comment_order(tree(spark)).collect())) == sorted([("t", "a", 1, 0), ("t", "d", 2, 1), ("t", "c", 2, 2), ("t", "b", 1, 3), ("t", "e", 1, 4), ("t", "f", 2, 5), ("u", "only", 1, 0)])


def test_a_chain_of_a_hundred_thousand(spark):
    chain = spark.range(100_000).select(
        F.lit("t").alias("thread_id"), F.concat(F.lit("c"), "id").alias("id"), F.when(F.col("id") == 0, "t3_t").otherwise(F.concat(F.lit("t1_c"), F.col("id") - 1)).alias("parent_id"), F.col("id").alias("created_utc"), F.col("id").alias("_pos")
    )
    got = trees.ranked_order(chain)
    assert got.agg(F.count(F.lit(1)), F.max("depth"), F.count_if(F.col("depth") == F.col("place") + 1), F.count_if(F.concat(F.lit("c"), "place") == F.col("id"))).first()[:] == (100_000,) * 4


def test_fast_accept(spark):
    values = [
        '{"subreddit":"Books","created_utc":"1700000000"}', '{"subreddit":"books","created_utc":1700000000}', '{"subreddit":"other","body":"books","created_utc":1}',
        '{"subreddit":"books"}', '{"subreddit":null,"body":"books","created_utc":1}', "books {", "nothing",
    ]
    got = threads.fast_accept(spark.createDataFrame([(v,) for v in values], "value string"), ["Books"]).collect()
    assert [r["status"] for r in got] == ["accepted", "accepted", "rejected", "bad", "bad", "bad", "rejected"]
    assert got[0]["ym"] == "2023-11"


@pytest.mark.parametrize(
    ("entity", "text", "expected"),
    [
        ("Dune", "Dune and Dune", [(0, 4, "verbatim"), (9, 13, "verbatim")]), ("dune", "read DUNE", [(5, 9, "case")]), ("Café  noir", "a café noir b", [(2, 12, "folded")]),
        ("Mason & Dixon", "mason and dixon", [(0, 15, "flexible")]), ("Swann's Way", "swann’s way", [(0, 11, "flexible")]), ("The Magic Mountain Book", "magic mountain", [(0, 14, "words")]), ("absent", "text", []), ("", "text", []), ("x", None, []),
    ],
)
def test_find_spans(entity, text, expected):
    assert [(s["start"], s["end"], s["pass"]) for s in spans.find_spans(entity, text)] == expected


def test_span_selection(spark):
    row = spark.sql("SELECT from_json('[{\"start\":0,\"end\":4},{\"start\":3,\"end\":9},{\"start\":9,\"end\":12},{\"start\":0,\"end\":3}]', 'array<struct<start:int,end:int>>') AS s")
    longest, left = row.select(selection.longest_first(F.col("s")), selection.leftmost_longest(F.col("s"))).first()
    assert [(s.start, s.end) for s in longest] == [(3, 9), (0, 3), (9, 12)]
    assert [(s.start, s.end) for s in left] == [(0, 4), (9, 12)]


def test_noise_keeps_span_text(spark):
    text = "[u/a] . I read [u/b]Dune twice"
    at = text.index("Dune")
    df = spark.createDataFrame([(text, [(at, at + 4), (0, 3)])], "t string, s array<struct<start:int,end:int>>")
    r = df.select(spans.remove_noise("t", "s").alias("r")).first()["r"]
    assert [r.text[s.start : s.end] for s in r.spans] == ["Dune"]


def test_priority_merge_is_idempotent(spark):
    columns = "surface string, canonical_title string, ol_key string, author_name string, method string, score double, ambiguous boolean, notes string, source string, _pos long"
    a = spark.createDataFrame([("s", "T", "k1", None, "m", 0.5, False, "", "a", 1), ("r", None, None, None, "m", 0.9, False, "", "a", 2)], columns)
    b = spark.createDataFrame([("s", "T", "k2", None, "m", 0.9, False, "", "b", 1), ("r", "R", "k3", None, "m", 0.1, False, "", "b", 2)], columns)
    once = resolve.priority_merge(a, b)
    assert {r.surface: r.ol_key for r in once.collect()} == {"s": "k2", "r": "k3"}
    again = resolve.priority_merge(once.withColumn("_pos", F.lit(0)))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, once.collect()))


def test_upserts(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, p long, v string")
    assert sorted((r.k, r.v) for r in labels.last_wins(rows, ["k"], "p").collect()) == [("a", "y"), ("b", "z")]
    assert sorted((r.k, r.v) for r in labels.first_wins(rows, ["k"], "p").collect()) == [("a", "x"), ("b", "z")]


def test_zstd_sources_and_sinks(spark, tmp_path):
    import zstandard

    body = b'{"id":"1","subreddit":"books","created_utc":1700000000}\n\nbroken\n{"id":"2","subreddit":"books","created_utc":1700000001}'
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "RC_2023-11.zst").write_bytes(zstandard.ZstdCompressor(compression_params=zstandard.ZstdCompressionParameters(window_log=27, enable_ldm=True)).compress(body))
    long = files.lines(spark, str(tmp_path / "in"), by_frames=True)
    short = files.lines(spark, str(tmp_path / "in"), "2023-01", "2023-12")
    assert sorted(r.value for r in long.collect()) == sorted(r.value for r in short.collect()) and short.count() == 4
    assert [r.id for r in files.entities(short, "id string").orderBy("id").collect()] == ["1", "2"]
    accepted = threads.fast_accept(short, ["books"])
    summary = sinks.file_summary(accepted).first()
    assert (summary.total, summary.matched, summary.bad) == (4, 2, 0)
    sinks.monthly(accepted.filter("status = 'accepted'"), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 2
    assert sinks.manifest(spark, str(tmp_path / "in")).count() == 1


def test_dump_lines(spark):
    values = ["/type/work\tk\t1\tx\t{\"title\": \"a\\tb\"}", "/type/work\tk\t1", "/type/edition\te\t1\tx\t{}", "/type/work\tbad\t1\tx\t{"]
    rows = spark.createDataFrame([(v,) for v in values], "value string")
    assert [r.key for r in files.dump(rows, "/type/work").collect()] == ["k"]


def test_incremental_ingest(spark, tmp_path):
    from threadloom.streaming.incremental import ingest

    (tmp_path / "in").mkdir()
    for i in range(2):
        (tmp_path / "in" / f"{i}.json").write_text('{"subreddit":"books","created_utc":1700000000}\n{"subreddit":"x","created_utc":1}\n')
        ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), ["books"]).awaitTermination()
    assert spark.read.json(str(tmp_path / "out")).count() == 2


def test_result_choice_and_mentions(spark):
    span = "array<struct<text:string,start:int,end:int,labels:array<string>>>"
    rows = spark.createDataFrame(
        [
            (1, "t", [(True, [("x", 0, 1, ["BOOK"])]), (None, [("a", 0, 1, ["BOOK", "WRITER"]), ("b", 2, 3, ["NOTE"])])], [([("p", 0, 1, ["BOOK"])],)], []),
            (2, "t", [], [([("p", 0, 1, ["BOOK"])],)], [([("d", 0, 1, ["WRITER"])],)]), (3, "t", [], [], []),
        ],
        f"task_id long, thread_id string, annotations array<struct<was_cancelled:boolean,result:{span}>>, predictions array<struct<result:{span}>>, drafts array<struct<result:{span}>>",
    )
    source, _ = labels.chosen_result(F.col("annotations"), F.col("predictions"))
    assert [r[0] for r in rows.orderBy("task_id").select(source).collect()] == ["annotation", "prediction", "none"]
    assert sorted((r.task_id, r.label, r.text) for r in labels.mentions(rows).collect()) == [(1, "BOOK", "a"), (2, "WRITER", "d")]
    assert rows.filter(labels.is_reviewed(F.col("annotations"))).count() == 1


def test_csv_needs_its_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text('surface,notes\n"x ""y""\nz",n\n')
    assert files.csv(spark, str(tmp_path / "a.csv"), "surface string, notes string", ("surface",)).first().surface == 'x "y"\nz'
    with pytest.raises(ValueError):
        files.csv(spark, str(tmp_path / "a.csv"), "surface string", ("ol_key",))


def test_thread_documents_are_whole(spark):
    """Inputs with the least columns, an unreachable thread's comment, a post without comments, and names that clash with a document's."""
    posts = spark.createDataFrame(
        [("p", " A  b ", " x\ny ", True, "me", 3, 1700000000, True, 7), ("q", None, None, None, None, None, None, False, 8)],
        "id string, title string, selftext string, is_self boolean, author string, score long, created_utc long, _removed boolean, date long",
    )
    replies = spark.createDataFrame(
        [("p", "c1", "t3_p", 0, 1, "one", "u", 1, False, None, False), ("p", "c2", "t1_c1", 5, 2, None, None, None, None, "moderator", True), ("gone", "c3", "t3_gone", 5, 1, "x", "u", 1, False, None, False)],
        "thread_id string, id string, parent_id string, created_utc long, _pos long, body string, author string, score long, is_submitter boolean, distinguished string, _removed boolean",
    )
    segs = threads.document_segments(posts, replies)
    docs = {r.thread_id: r for r in sinks.thread_documents(segs, threads.document_metadata(posts, segs)).collect()}
    assert set(docs) == {"p", "q"}
    kinds = [(s.id, s.type, s.depth, s.is_removed, s.is_submitter, s.edited, s.stickied, s.parent_id, s.text) for s in docs["p"].segments]
    assert kinds == [
        ("p_title", "title", 0, True, True, "false", False, None, "A b"), ("p_body", "body", 0, True, True, "false", False, None, "x y"),
        ("c1", "comment", 1, False, False, "false", False, "t3_p", "one"), ("c2", "comment", 2, True, False, "false", False, "t1_c1", ""),
    ]
    meta = docs["p"].metadata.asDict()
    assert len(meta) == 20 and meta["title"] == " A  b " and (meta["num_comments_found"], meta["depth_max"], meta["date_last_comment"], meta["date"]) == (2, 2, "1970-01-01", "2023-11-14")
    assert [s.id for s in docs["q"].segments] == ["q_title"] and docs["q"].metadata.title == "" and docs["q"].metadata.num_comments_found == 0 and docs["q"].metadata.is_self is False
    assert threads.document_segments(posts.limit(0), replies).count() == 0
