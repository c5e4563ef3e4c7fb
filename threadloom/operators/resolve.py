"""Resolution of surfaces to works: context, scoring, cascade, fuzzy and canonical stages, merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ALIASES
from ..config import SETTINGS as S
from ..functions.similarity import canonical_score, dice
from ..functions.text import is_scripture, norm_title, spell_numbers
from ..sources.stored import stored
from .bestmatch import CanonicalScorer, FuzzyScorer, best_two
from .catalog import token_candidates, token_index
from .fulltext import FullTextIndex, search

RESOLUTION = ["surface", "method", "ol_key", "canonical_title", "author_name", "confidence", "ambiguous", "notes"]


def context_writers(mentions: DataFrame, norm: str | None = "norm", parts: int | None = None) -> DataFrame:
    """(surface, writers): normalised writers mentioned in any task of the surface; without ``norm`` their texts are normalised here, once for each pair.

    Writers are made distinct per task first, so tasks meet surfaces once per pair; pairs of surface and writer are
    made distinct before sets are collected, which combines all but one of each before the shuffle. With ``parts`` tasks
    are dealt to so many partitions first, and all that meets of them meets there.
    """
    books = mentions.filter("label = 'BOOK'").select("task_id", F.col("text").alias("surface"))
    writers = mentions.filter("label = 'WRITER'").select("task_id", F.col(norm or "text").alias("writer"))
    if parts is not None:
        books, writers = books.repartition(parts, "task_id"), writers.repartition(parts, "task_id")
    pairs = books.distinct().join(writers.distinct(), "task_id").select("surface", "writer").distinct()
    pairs = pairs if norm else pairs.withColumn("writer", norm_title("writer"))
    # collect_set would let the optimizer drop the distinct
    return pairs.groupBy("surface").agg(F.sort_array(F.array_distinct(F.collect_list("writer"))).alias("writers"))


def author_in_context(author_norm: Column, writers: Column) -> Column:
    """The author's normalised name, or its last word, is among the writers."""
    keys = F.array(author_norm, F.element_at(F.split(author_norm, " "), -1))
    return F.coalesce(F.arrays_overlap(keys, writers), F.lit(False))


def candidate_score(in_context: Column, similarity: Column, has_subjects: Column) -> Column:
    return S.context_weight * in_context.cast("double") + S.title_weight * similarity + S.subject_weight * has_subjects.cast("double")


def build_resolutions(candidates: DataFrame, method: str) -> DataFrame:
    """One resolution per surface from its candidates.

    ``candidates`` has surface, norm, ol_key, title, norm_title, author_name, in_context, has_subjects.
    """
    similarity = F.when(F.col("norm") == F.col("norm_title"), 1.0).otherwise(dice(F.col("norm"), F.col("norm_title")))
    scored = candidates.withColumn("score", candidate_score(F.col("in_context"), similarity, F.col("has_subjects")))
    # a surface's candidates are combined by score before any of them meet, so the window sees a row for each score
    first = F.min_by(F.struct("ol_key", "title", "author_name", "in_context"), "ol_key").alias("first")
    by_score = scored.groupBy("surface", "score").agg(F.count(F.lit(1)).alias("n"), first)
    best, own = Window.partitionBy("surface").orderBy(F.desc("score")), Window.partitionBy("surface")
    top = by_score.withColumn("second", F.when(F.col("n") > 1, F.col("score")).otherwise(F.lead("score", 1, 0.0).over(best))).withColumn("place", F.row_number().over(best))
    top = top.withColumn("n", F.sum("n").over(own)).filter("place = 1").select("surface", "score", "n", "second", "first.*")
    one = F.col("n") == 1
    return top.select(
        "surface", F.lit(method).alias("method"), "ol_key", F.col("title").alias("canonical_title"), "author_name",
        F.when(one, F.when(F.col("in_context"), 1.0).otherwise(S.single_match_confidence)).otherwise(F.bround("score", 3)).alias("confidence"),
        (~one & (F.col("score") - F.col("second") < S.ambiguous_gap) & (F.col("score") < S.ambiguous_below)).alias("ambiguous"),
        F.when(one, F.when(F.col("in_context"), "ctx_confirmed").otherwise("single_match")).otherwise(F.format_string("%d_candidates;top_score=%.2f", F.col("n"), F.col("score"))).alias("notes"),
    )


def table_stage(surfaces: DataFrame, table: DataFrame, method: Column) -> DataFrame:
    """A stage that looks surfaces up in a resolved table."""
    return surfaces.select("surface").join(table, "surface").select("surface", method.alias("method"), *RESOLUTION[2:])


def acronym_stage(surfaces: DataFrame, acronyms: DataFrame, works: DataFrame) -> DataFrame:
    """Surfaces that are a known acronym, letter for letter: its title and author, and the first work of that title.

    ``acronyms`` has key, title and author; ``works`` ol_key and norm_title.
    """
    keys = works.groupBy("norm_title").agg(F.min("ol_key").alias("ol_key"))
    hit = surfaces.select("surface").distinct().join(acronyms.select(F.col("key").alias("surface"), "title", "author"), "surface")
    hit = hit.withColumn("norm_title", norm_title("title")).join(keys, "norm_title", "left")
    return hit.select("surface", F.lit("acronym").alias("method"), "ol_key", F.col("title").alias("canonical_title"), F.col("author").alias("author_name"), F.lit(1.0).alias("confidence"), F.lit(False).alias("ambiguous"), F.lit("acronym_map").alias("notes"))


def fuzzy_table_stage(surfaces: DataFrame, table: DataFrame, works: DataFrame) -> DataFrame:
    """Rows of a fuzzy run that resolved a surface; an alias without a key takes the first work of its title."""
    keys = works.groupBy("norm_title").agg(F.min("ol_key").alias("found"))
    rows = table.filter("method <> 'failed'").withColumn("norm_title", norm_title("canonical_title")).join(keys, "norm_title", "left")
    rows = rows.withColumns({"ol_key": F.coalesce("ol_key", "found"), "confidence": F.bround(F.col("fuzzy_score") / 100, 3), "author_name": F.lit(None).cast("string")})
    return table_stage(surfaces, rows, F.col("method"))


def canonical_table_stage(surfaces: DataFrame, table: DataFrame, works: DataFrame) -> DataFrame:
    """Rows of a canonical run with a key or a method; the author is that of the work with this key and title."""
    rows = table.filter("NOT (method = 'unresolved' AND coalesce(work_key, '') = '')")
    names = works.select(F.col("ol_key").alias("work_key"), F.col("title").alias("canonical_title"), "author_name")
    rows = rows.join(names, ["work_key", "canonical_title"], "left").withColumnRenamed("work_key", "ol_key")
    rows = rows.withColumns({"confidence": F.bround(F.col("score") / 100, 3), "ambiguous": F.lit(False), "notes": F.lit("")})
    return table_stage(surfaces, rows, F.concat(F.lit("canonical_"), F.col("method")))


def cascade(surfaces: DataFrame, stages: list[DataFrame]) -> DataFrame:
    """The first stage that resolves a surface wins; what none resolves has failed."""
    tagged = None
    for i, stage in enumerate(stages):
        rows = stage.select(*RESOLUTION).withColumn("_stage", F.lit(i))
        tagged = rows if tagged is None else tagged.unionByName(rows)
    first = tagged.groupBy("surface").agg(F.min_by(F.struct(*RESOLUTION[1:]), F.col("_stage")).alias("r"))
    joined = surfaces.select("surface").distinct().join(first, "surface", "left")
    failed = F.struct(
        F.lit("failed").alias("method"), F.lit(None).cast("string").alias("ol_key"), F.lit(None).cast("string").alias("canonical_title"), F.lit(None).cast("string").alias("author_name"),
        F.lit(0.0).alias("confidence"), F.lit(False).alias("ambiguous"), F.lit("no_match").alias("notes"),
    )
    return joined.withColumn("r", F.coalesce("r", failed)).select("surface", "r.*")


def entity_links(mentions: DataFrame, resolutions: DataFrame, often: int = 512) -> DataFrame:
    """Every mention with its resolution (one for each surface); blanks where there is none.

    Mentions of a text that makes up more than one in ``often`` of all (fewer than ``often`` texts) stay where they are
    and get their resolutions by broadcast, so that no task gathers the mentions of a common text; the others are joined.
    """
    found = stored(resolutions.withColumnRenamed("surface", "text"), "resolutions")
    counts = stored(mentions.groupBy("text").agg(F.count(F.lit(1)).alias("n")), "texts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    common = counts.filter((F.col("n") * often > total) & F.col("text").isNotNull()).select("text", F.lit(True).alias("_common"))
    marked = mentions.join(F.broadcast(common), "text", "left")
    here = marked.filter("_common").drop("_common").join(F.broadcast(found.join(F.broadcast(common.drop("_common")), "text", "left_semi")), "text", "left")
    return here.unionByName(marked.filter("_common IS NULL").drop("_common").join(found, "text", "left"))


def fuzzy_decision(best: DataFrame, threshold: float = S.fuzzy_threshold) -> DataFrame:
    """What the fuzzy stage makes of each surface's best candidate (ol_key, title, score), its runner-up's score (second) and the number of candidates (n)."""
    ok = F.col("score") >= threshold
    return best.select(
        "surface", F.when(ok, "fuzzy").otherwise("failed").alias("method"), F.when(ok, F.col("ol_key")).alias("ol_key"), F.when(ok, F.col("title")).alias("canonical_title"),
        F.bround("score", 1).alias("fuzzy_score"), (ok & (F.col("score") - F.col("second") < S.fuzzy_gap) & (F.col("score") < S.fuzzy_ambiguous_below)).alias("ambiguous"),
        F.when(ok, F.format_string("score=%.1f;n_cands=%d", F.bround("score", 1), F.col("n"))).otherwise(f"below_threshold({threshold})").alias("notes"),
    )


def fuzzy_resolutions(candidates: DataFrame, threshold: float = S.fuzzy_threshold) -> DataFrame:
    """Best candidate by the fuzzy score; ``candidates`` has surface, norm, ol_key, title, norm_title."""
    return fuzzy_decision(best_two(candidates.dropDuplicates(["surface", "ol_key"]), FuzzyScorer()), threshold)


def fuzzy_candidates(surfaces: DataFrame, works: DataFrame) -> DataFrame:
    """Candidates of each surface as written and with its numbers spelled; the latter is what gets scored."""
    spelled = surfaces.select("surface", "norm", norm_title(spell_numbers(F.col("surface"))).alias("spelled"))
    index = token_index(works)
    pairs = token_candidates(spelled, index).unionByName(token_candidates(spelled.filter("norm <> spelled"), index, "spelled")).distinct()
    return pairs.join(spelled, "surface").join(works, "ol_key").select("surface", F.col("spelled").alias("norm"), "ol_key", "title", "norm_title")


def fulltext_candidates(surfaces: DataFrame, index: FullTextIndex, works: DataFrame, limit: int = S.fulltext_candidates) -> DataFrame:
    """The retriever with less memory: the ``limit`` best titles that hold all words of a surface."""
    own = surfaces.select("surface", "norm").dropDuplicates(["surface"])
    terms = F.array_distinct(F.filter(F.split("norm", " "), lambda w: w != ""))
    hits = search(index, own.select(F.col("surface").alias("query"), terms.alias("terms")), limit).select(F.col("query").alias("surface"), "ol_key")
    return hits.join(own, "surface").join(works, "ol_key").select("surface", "norm", "ol_key", "title", "norm_title")


def alias_table(spark) -> DataFrame:
    rows = spark.createDataFrame(list(ALIASES.items()), "surface string, canonical string")
    return rows.groupBy(norm_title("surface").alias("norm")).agg(F.min("canonical").alias("canonical"))


def fuzzy_stage(surfaces: DataFrame, candidates: DataFrame, aliases: DataFrame, works: DataFrame, threshold: float = S.fuzzy_threshold) -> DataFrame:
    """Every surface once: scripture fails, then an alias wins, then the best fuzzy score; others fail with the reason.

    ``surfaces`` has surface and norm, ``aliases`` norm and canonical, ``works`` ol_key and norm_title.
    """
    text = F.lit(None).cast("string")
    own = surfaces.select("surface", "norm").dropDuplicates(["surface"]).withColumn("scripture", is_scripture(F.col("surface"))).join(aliases, "norm", "left")
    keys = works.groupBy(F.col("norm_title").alias("alias_norm")).agg(F.min("ol_key").alias("alias_key"))
    known = own.filter("not scripture AND canonical IS NOT NULL").withColumn("alias_norm", norm_title("canonical")).join(keys, "alias_norm", "left")
    known = known.select("surface", F.lit("alias").alias("method"), F.col("alias_key").alias("ol_key"), F.col("canonical").alias("canonical_title"), F.lit(100.0).alias("fuzzy_score"), F.lit(False).alias("ambiguous"), F.format_string("alias->'%s'", F.col("canonical")).alias("notes"))
    failed = own.filter("scripture").select("surface", F.lit("failed").alias("method"), text.alias("ol_key"), text.alias("canonical_title"), F.lit(None).cast("double").alias("fuzzy_score"), F.lit(False).alias("ambiguous"), F.lit("SCRIPTURE").alias("notes"))
    rest = own.filter("not scripture AND canonical IS NULL").select("surface").join(fuzzy_resolutions(candidates, threshold), "surface", "left")
    rest = rest.withColumns({"method": F.coalesce("method", F.lit("failed")), "ambiguous": F.coalesce("ambiguous", F.lit(False)), "notes": F.coalesce("notes", F.lit("no_candidates"))})
    return rest.unionByName(known).unionByName(failed)


def canonical_decision(best: DataFrame, threshold: float = S.canonical_fuzzy) -> DataFrame:
    """What the canonical stage makes of each surface's best candidate; equal normalised titles count 100."""
    same = F.col("norm") == F.col("norm_title")
    score = F.when(same, 100.0).otherwise(F.col("score"))
    method = F.when(same, "exact").when(score >= threshold, "fuzzy").otherwise("unresolved")
    return best.select("surface", F.col("title").alias("canonical_title"), F.col("ol_key").alias("work_key"), method.alias("method"), F.bround(score, 1).alias("score"))


def canonical_resolutions(candidates: DataFrame, threshold: float = S.canonical_fuzzy) -> DataFrame:
    """Exact title first, then the best canonical score; otherwise unresolved with the best hint."""
    return canonical_decision(best_two(candidates.dropDuplicates(["surface", "ol_key"]), CanonicalScorer()), threshold)


def canonical_stage(surfaces: DataFrame, candidates: DataFrame, index: FullTextIndex, works: DataFrame, limit: int = 20) -> DataFrame:
    """Every surface once: exact, fuzzy, then the best of the full-text search's hits; otherwise unresolved with the hint.

    ``surfaces`` has surface and norm, ``index`` the stored index of the works' titles.
    """
    first = stored(surfaces.select("surface", "norm").dropDuplicates(["surface"]).join(canonical_resolutions(candidates), "surface", "left"), "canonical")
    terms = F.array_distinct(F.filter(F.split("norm", " "), lambda w: w != ""))
    open_ = first.filter("coalesce(method, 'unresolved') = 'unresolved'").select(F.col("surface").alias("query"), "norm", terms.alias("terms"))
    hits = search(index, open_, limit).join(open_.select("query", "norm"), "query").join(works.select("ol_key", "title", "norm_title"), "ol_key")
    hits = hits.withColumn("found", canonical_score(F.col("norm"), F.col("norm_title"))).filter(F.col("found") >= S.canonical_search)
    hits = hits.groupBy(F.col("query").alias("surface")).agg(F.min_by(F.struct("title", "ol_key", "found"), F.struct(-F.col("found"), F.col("place"))).alias("fts"))
    fts, hit = F.col("fts").isNotNull(), F.col("fts")
    return first.join(hits, "surface", "left").select(
        "surface", F.when(fts, hit["title"]).otherwise(F.coalesce("canonical_title", F.lit(""))).alias("canonical_title"), F.when(fts, hit["ol_key"]).otherwise(F.coalesce("work_key", F.lit(""))).alias("work_key"),
        F.when(fts, "fts").otherwise(F.coalesce("method", F.lit("unresolved"))).alias("method"), F.when(fts, F.bround(hit["found"], 1)).otherwise(F.coalesce("score", F.lit(0.0))).alias("score"),
    )


def priority_merge(*sources: DataFrame) -> DataFrame:
    """One entry per surface: resolved, then score, then source order, then first seen.

    Each source has surface, canonical_title, ol_key, author_name, method, score, ambiguous, notes, source and _pos.
    """
    rows = None
    for i, source in enumerate(sources):
        tagged = source.withColumn("_priority", F.lit(i))
        rows = tagged if rows is None else rows.unionByName(tagged)
    unresolved = (F.coalesce("ol_key", F.lit("")) == "") & (F.coalesce("canonical_title", F.lit("")) == "")
    rest = [c for c in rows.columns if c not in ("surface", "_priority", "_pos")]
    order = F.struct(unresolved.cast("int"), -F.coalesce("score", F.lit(0.0)), F.col("_priority"), F.col("_pos"))
    return rows.groupBy("surface").agg(F.min_by(F.struct(*rest), order).alias("r")).select("surface", "r.*")


def enrich(rows: DataFrame, titles: DataFrame) -> DataFrame:
    """Surfaces with their distinct keys in first-seen order, piped, and a JSON map of titles.

    ``rows`` has surface, edition_key, work_key and _pos; ``titles`` has work_key and title.
    """
    joined = rows.join(titles, "work_key", "left").withColumn("title", F.coalesce("title", F.lit("[NOT FOUND]")))
    seen = joined.groupBy("surface").agg(F.array_sort(F.collect_list(F.struct("_pos", "edition_key", "work_key", "title"))).alias("s"))
    works = F.array_distinct(F.transform("s", lambda x: F.struct(x["work_key"].alias("key"), x["title"].alias("value"))))
    return seen.select(
        "surface", F.array_join(F.array_distinct(F.transform("s", lambda x: x["edition_key"])), "|").alias("edition_keys"), F.array_join(F.array_distinct(F.transform("s", lambda x: x["work_key"])), "|").alias("work_keys"),
        F.to_json(F.map_from_entries(works)).alias("work_titles"),
    )
