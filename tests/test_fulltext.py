import collections
import math
import random

import pytest
from pyspark.sql import functions as F

from threadloom.operators import catalog, fulltext, resolve


def by_force(docs, queries, limit):
    held = {k: t.split() for k, t in docs if t and t.split()}
    mean = sum(map(len, held.values())) / max(1, len(held))
    df = collections.Counter(w for t in held.values() for w in set(t))
    out = []
    for q, terms in queries:
        found = []
        for k, t in held.items():
            if terms and all(w in t for w in terms):
                score = 0.0
                for w in terms:
                    tf = t.count(w)
                    score += math.log((len(held) - df[w] + 0.5) / (df[w] + 0.5) + 1) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(t) / mean))
                found.append((-round(score, 6), k))
        out += [(q, k, place) for place, (_, k) in enumerate(sorted(found)[:limit], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(2)
    words = ["the"] * 30 + ["a"] * 15 + [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(int(rng.lognormvariate(2.5, 1)) + 1))) for i in range(1500)] + [(5000, None), (5001, ""), (5002, "the")]
    return docs, spark.createDataFrame(docs, "doc_id long, text string").repartition(3)


@pytest.fixture(scope="module")
def index(spark, corpus):
    was, fulltext.RANGE_DOCS = fulltext.RANGE_DOCS, 40
    yield fulltext.build(corpus[1], "doc_id", F.filter(F.split("text", " "), lambda w: w != ""))
    fulltext.RANGE_DOCS = was


def test_searches_on_one_stored_index(spark, corpus, index):
    for queries in ([("one", ["the", "a"]), ("two", ["w3"])], [("three", ["the"]), ("none", ["the", "unheard"]), ("empty", [])], [(f"q{i}", ["the", f"w{i}", "a"]) for i in range(12)]):
        asked = spark.createDataFrame(queries, "query string, terms array<string>")
        for limit in (1, 20, 5000):
            got = sorted((r.query, r.doc_id, r.place) for r in fulltext.search(index, asked, limit).collect())
            assert got == by_force(corpus[0], queries, limit)


def test_blocks_that_cannot_matter_are_not_read(spark, index):
    asked = spark.createDataFrame([("q", ["the", "a"])], "query string, terms array<string>")
    everything = fulltext.ranges_of(index, asked).count()
    first, _, rest = fulltext.pruned(index, asked, 5)
    assert first.count() == fulltext.FIRST_RANGES and first.count() + rest.count() < 0.8 * everything
    assert index.blocks.count() == index.blocks.select("token", "range").distinct().count()
    assert index.blocks.agg(F.max("n")).first()[0] < 120


def test_empty_index(spark):
    nothing = fulltext.build(spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string"), "doc_id", F.filter(F.split("text", " "), lambda w: w != ""))
    assert fulltext.search(nothing, spark.createDataFrame([("q", ["a"])], "query string, terms array<string>"), 3).count() == 0


def test_fuzzy_candidates_from_the_index(spark):
    works = spark.createDataFrame([(f"/works/{i}", t) for i, t in enumerate(["dune", "dune messiah", "children of dune", "the trial"])], "ol_key string, title string").withColumn("norm_title", F.col("title"))
    surfaces = spark.createDataFrame([("Dune!", "dune"), ("Trial", "trial"), ("Emma", "emma"), ("?", "")], "surface string, norm string")
    found = resolve.fulltext_candidates(surfaces, catalog.title_index(works), works, 2)
    assert sorted((r.surface, r.ol_key) for r in found.collect()) == [("Dune!", "/works/0"), ("Dune!", "/works/1"), ("Trial", "/works/3")]


def test_blocks_are_made_from_whole_documents(spark, index, monkeypatch):
    plan = index.blocks.agg(F.sum("n")).first()[0], index.tokens.agg(F.sum("df")).first()[0]
    assert plan[0] == plan[1]
    seen, made = [], fulltext._blocks
    monkeypatch.setattr(fulltext, "_blocks", lambda ranged, mean: seen.append(ranged.columns) or made(ranged, mean))
    docs = spark.createDataFrame([(i, " ".join(f"w{i * 7 + j}" for j in range(50))) for i in range(60)], "doc_id long, text string")
    was, fulltext.RANGE_TOKENS = fulltext.RANGE_TOKENS, 500
    try:
        long = fulltext.build(docs, "doc_id", F.split("text", " "))
    finally:
        fulltext.RANGE_TOKENS = was
    assert seen == [["range", "key", "doc_len", "terms", "tfs"]]  # a row for each document is shuffled, none for each of its tokens
    assert long.blocks.select("range").distinct().count() > 1 and long.blocks.agg(F.sum("n")).first()[0] == 60 * 50
