from threadloom.operators import resolve


def test_pairs_of_surface_and_writer_are_distinct_before_they_are_collected(spark):
    rows = [(i, label, text) for i in range(3) for label, text in (("BOOK", "b"), ("WRITER", "Ann X!"), ("WRITER", "ann x"), ("WRITER", None))]
    got = resolve.context_writers(spark.createDataFrame(rows, "task_id int, label string, text string"), None)
    assert [(r.surface, r.writers) for r in got.collect()] == [("b", ["ann x"])]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") > plan.index("Aggregate [surface") and "Aggregate [surface" in plan.split("collect_list")[1]


def test_candidates_are_combined_by_score(spark):
    """Two best candidates of equal score make the runner-up as good as the best; the least key wins."""
    kind = "surface string, norm string, ol_key string, title string, norm_title string, author_name string, in_context boolean, has_subjects boolean"
    rows = [("s", "s", k, t, "s", None, False, h) for k, t, h in (("k3", "S", True), ("k2", "s!", True), ("k1", "S", False))] + [("one", "one", "k9", "One", "one", "x", True, False)]
    rows += [("gap", "gap", "k5", "Gap", "gap", None, True, True), ("gap", "gap", "k4", "Gap", "gap", None, False, False)]
    got = resolve.build_resolutions(spark.createDataFrame(rows, kind).repartition(3), "exact")
    assert {r.surface: (r.ol_key, r.canonical_title, r.confidence, r.ambiguous, r.notes) for r in got.collect()} == {
        "s": ("k2", "s!", 0.5, True, "3_candidates;top_score=0.50"), "one": ("k9", "One", 1.0, False, "ctx_confirmed"), "gap": ("k5", "Gap", 1.0, False, "2_candidates;top_score=1.00")
    }
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [surface" in plan.split("Window")[-1]


def test_tasks_are_dealt_once_and_meet_in_their_partitions(spark):
    rows = [(i, label, text) for i in range(9) for label, text in (("BOOK", f"b{i % 2}"), ("WRITER", f"w{i % 3}"))]
    mentions = spark.createDataFrame(rows, "task_id int, label string, text string")
    plain, dealt = resolve.context_writers(mentions, None), resolve.context_writers(mentions, None, 5)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, dealt.collect())) == [("b0", ["w0", "w1", "w2"]), ("b1", ["w0", "w1", "w2"])]
