from pyspark.sql import functions as F

from threadloom.functions import text as tx
from threadloom.operators import catalog, resolve

def tables(spark, titles, surfaces):
    works = spark.createDataFrame([(f"/works/{i}", t) for i, t in enumerate(titles)], "ol_key string, title string").withColumn("norm_title", tx.norm_title("title"))
    return works, spark.createDataFrame([(x,) for x in surfaces], "surface string").withColumn("norm", tx.norm_title("surface"))


def test_canonical_stage_searches_what_is_left(spark):
    works, surfaces = tables(spark, ["It", "War and Peace", "Of the Cat"], ["War And Peace", "the cat", "qqqq"])
    pairs = catalog.token_candidates(surfaces, catalog.token_index(works)).join(surfaces, "surface").join(works, "ol_key")
    index = catalog.title_index(works)
    got = {r.surface: (r.method, r.work_key) for r in resolve.canonical_stage(surfaces, pairs, index, works).collect()}
    assert got == {"War And Peace": ("exact", "/works/1"), "the cat": ("fts", "/works/2"), "qqqq": ("unresolved", "")}


def test_fuzzy_stage_keeps_every_surface(spark):
    works, surfaces = tables(spark, ["One Hundred Years of Solitude", "War and Peace"], ["100 yrs of solitude", "John 3:16", "zz", "w n p", "peace"])
    aliases = spark.createDataFrame([("w n p", "War and Peace")], "norm string, canonical string")
    got = {r.surface: (r.method, r.ol_key, r.notes) for r in resolve.fuzzy_stage(surfaces, resolve.fuzzy_candidates(surfaces, works), aliases, works).collect()}
    assert got.pop("100 yrs of solitude")[:2] == ("fuzzy", "/works/0")
    assert got == {"John 3:16": ("failed", None, "SCRIPTURE"), "zz": ("failed", None, "no_candidates"), "w n p": ("alias", "/works/1", "alias->'War and Peace'"), "peace": ("failed", None, "below_threshold(85.0)")}
