"""Annotated tasks: which result counts, mention statistics, review queue, tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def valid_annotations(annotations: Column) -> Column:
    return F.filter(annotations, lambda a: ~F.coalesce(a["was_cancelled"], F.lit(False)))


def is_reviewed(annotations: Column) -> Column:
    return F.coalesce(F.size(valid_annotations(annotations)) > 0, F.lit(False))


def chosen_result(annotations: Column, fallback: Column, name: str = "prediction") -> tuple[Column, Column]:
    """(source, result): the first valid annotation, else the first of ``fallback``, else none."""
    first, second = F.get(valid_annotations(annotations), F.lit(0))["result"], F.get(fallback, F.lit(0))["result"]
    return F.when(first.isNotNull(), "annotation").when(second.isNotNull(), name).otherwise("none"), F.coalesce(first, second)


def source_counts(tasks: DataFrame) -> DataFrame:
    """How many tasks take their result from an annotation, a prediction or nowhere, and how many were reviewed: one row."""
    source, _ = chosen_result(F.col("annotations"), F.col("predictions"))
    kinds = [F.count_if(source == s).alias(s) for s in ("annotation", "prediction", "none")]
    return tasks.agg(F.count(F.lit(1)).alias("tasks"), *kinds, F.count_if(is_reviewed(F.col("annotations"))).alias("reviewed"))


def mentions(tasks: DataFrame, label_set: tuple[str, ...] = ("BOOK", "WRITER")) -> DataFrame:
    """Spans by their first label, from a valid annotation or else a draft."""
    _, result = chosen_result(F.col("annotations"), F.col("drafts"), "draft")
    span = tasks.withColumn("r", F.explode(result))
    return span.select("task_id", "thread_id", F.get("r.labels", F.lit(0)).alias("label"), "r.text", "r.start", "r.end").filter(F.col("label").isin(*label_set))


def without_terms(result: Column, terms: tuple[str, ...]) -> Column:
    return F.filter(result, lambda r: ~r["text"].isin(*terms))


def mention_counts(rows: DataFrame, once_per_task: bool = False) -> DataFrame:
    """Counts by text, by (label, text) and by (label, text, thread), in one pass over grouping sets."""
    rows = rows.select("task_id", "thread_id", "label", "text")
    rows = rows.dropDuplicates(["task_id", "label", "text"]) if once_per_task else rows
    return rows.groupingSets([["text"], ["label", "text"], ["label", "text", "thread_id"]], "label", "text", "thread_id").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level"))


def top_then_frequent(counts: DataFrame, n: int, least: int, *ties: str) -> DataFrame:
    """The ``n`` most frequent, and of those only the frequent enough: in this order."""
    return counts.orderBy(F.desc("n"), *ties).limit(n).filter(F.col("n") >= least)


def best_by(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row for each key: the first in a total order."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_place", place).filter("_place = 1").drop("_place")


def last_wins(rows: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """Upsert: the row with the greatest position of each key, by partial aggregation."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(pos)).alias("_row")).select(*keys, "_row.*")


def first_wins(rows: DataFrame, keys: list[str], pos: str) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(pos)).alias("_row")).select(*keys, "_row.*")


def repeats(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with how many other rows have the same text in any case."""
    folded = F.lower(F.trim(text))
    return rows.join(rows.groupBy(folded.alias("_folded")).agg((F.count(F.lit(1)) - 1).alias("n_others")), folded == F.col("_folded")).drop("_folded")


def review_queue(candidates: DataFrame, reviewed: DataFrame, rejected_texts: DataFrame, least_length: int) -> DataFrame:
    """Longest candidate of each key that is long enough, not reviewed, and not a rejected text."""
    best = best_by(candidates, ["ol_key"], F.desc("length"), F.col("_pos"))
    folded = F.lower(F.trim("text"))
    known = rejected_texts.select(F.lower(F.trim("text")).alias("_text")).distinct()
    return best.filter(F.col("length") >= least_length).join(reviewed.select("ol_key").distinct(), "ol_key", "left_anti").join(known, folded == F.col("_text"), "left_anti")


def flag_tasks(rows: DataFrame, terms: DataFrame, any_case: bool) -> DataFrame:
    """Sorted flagged terms of each task; ``terms`` has one column ``term``."""
    text, term = (F.lower("text"), F.lower("term")) if any_case else (F.col("text"), F.col("term"))
    hit = rows.join(terms, text == term)
    return hit.groupBy("task_id").agg(F.sort_array(F.collect_set("term")).alias("flags"))


def add_flags(existing: Column, flags: Column) -> Column:
    return F.array_sort(F.array_union(F.coalesce(existing, F.array().cast("array<string>")), F.coalesce(flags, F.array().cast("array<string>"))))


def doc_lengths(tasks: DataFrame, key: str = "thread_id") -> DataFrame:
    """Characters of each thread's text; its last task counts."""
    return tasks.groupBy(key).agg(F.max_by(F.length("text"), "_pos").alias("length"))


def surface_tasks(rows: DataFrame) -> DataFrame:
    """(surface, task_ids): the tasks that mention each surface, sorted; a row for each is in ``rows``."""
    return rows.groupBy("surface").agg(F.sort_array(F.collect_set("task_id")).alias("task_ids"))


def candidate_tasks(candidates: DataFrame, parts: int | None = None) -> DataFrame:
    """How many of the candidates (with task_ids) each task has; ``parts`` partitions bound what a task holds of them."""
    each = candidates.select("candidate", F.explode("task_ids").alias("task_id"))
    each = (each if parts is None else each.repartition(parts, "task_id")).distinct()
    return each.groupBy("task_id").agg(F.count(F.lit(1)).alias("n_candidates"))


def lookup_counts(rows: DataFrame, found: str) -> DataFrame:
    """Hits and misses of a lookup."""
    return rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col(found).isNotNull()).alias("hits"), F.count_if(F.col(found).isNull()).alias("misses"))


def accepted_by_task(accepted: DataFrame) -> DataFrame:
    """(task_id, spans): the accepted spans of each task in text order."""
    return accepted.groupBy("task_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", "text"))).alias("spans"))


def review_totals(candidates: DataFrame) -> DataFrame:
    """Totals of a review: reviewed, accepted, rejected by a rejected text (cascade), and still in the queue."""
    decision = F.coalesce("decision", F.lit(""))
    return candidates.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(decision != "").alias("reviewed"), F.count_if(decision == "accept").alias("accepted"),
        F.count_if((decision == "") & F.coalesce("cascade", F.lit(False))).alias("cascade"), F.count_if((decision == "") & ~F.coalesce("cascade", F.lit(False))).alias("queue"),
    )


def cascade_reject(candidates: DataFrame, any_case: bool = True) -> DataFrame:
    """``candidates`` (text, decision) and whether a rejected one has the same text and no decision is made yet."""
    text = F.lower("text") if any_case else F.col("text")
    rejected = candidates.filter("decision = 'reject'").select(text.alias("_t")).distinct()
    return candidates.withColumn("_t", text).join(rejected.withColumn("cascade", F.lit(True)), "_t", "left").withColumn("cascade", F.coalesce("cascade", F.lit(False)) & F.col("decision").isNull()).drop("_t")


def without_notes(rows: DataFrame, notes: tuple[str, ...] = ("SCRIPTURE",)) -> DataFrame:
    """Rows whose note is none of these; rows without a note stay."""
    return rows.filter(~F.coalesce("notes", F.lit("")).isin(*notes))


def without_meta(tasks: DataFrame, key: str, clear: bool = False) -> DataFrame:
    """Tasks whose ``meta`` map has no value for a key yet; with ``clear`` all of them."""
    return tasks if clear else tasks.filter(F.col("meta")[key].isNull())


def merge_meta(existing: Column, new: Column) -> Column:
    """Both maps, the new one's values where both have a key."""
    old = F.coalesce(existing, F.create_map().cast("map<string,string>"))
    return F.map_concat(F.map_filter(old, lambda k, v: ~F.map_contains_key(new, k)), new)


def right_wins(left: DataFrame, right: DataFrame, key: str = "key") -> DataFrame:
    """Two tables of one key merged: the right one's row where both have it."""
    return left.join(right.select(key), key, "left_anti").unionByName(right)


def merge_order() -> list[Column]:
    """Resolved ones by score, then name; unresolved ones after them by name."""
    unresolved = (F.coalesce("ol_key", F.lit("")) == "") & (F.coalesce("canonical_title", F.lit("")) == "")
    return [unresolved.asc(), F.when(unresolved, 0.0).otherwise(-F.coalesce("score", F.lit(0.0))).asc(), F.lower("surface").asc(), F.col("surface").asc()]


def longest_and_shortest(rows: DataFrame, text: str, n: int = 20) -> DataFrame:
    """The ``n`` longest and the ``n`` shortest texts, each with its place."""
    size = F.length(text)
    ends = [("longest", [size.desc(), F.col(text)]), ("shortest", [size.asc(), F.col(text)])]
    # n rows each: one task numbers them
    parts = [rows.select(text).orderBy(*o).limit(n).withColumn("place", F.row_number().over(Window.orderBy(*o))).withColumn("which", F.lit(w)) for w, o in ends]
    return parts[0].unionByName(parts[1]).select("which", "place", text)
