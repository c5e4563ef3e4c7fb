"""Rankings and ratios over resolved mentions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def round_even(x: Column, places: int) -> Column:
    """As SQL's ``round_even`` of doubles: scaled, rounded to even as a double, scaled back.

    ``bround`` rounds the shortest decimal that a double prints as, which lies elsewhere near a half.
    """
    return F.rint(x * float(10**places)) / float(10**places)


def resolved_only(links: DataFrame) -> DataFrame:
    """Links with a key or a title, and not failed."""
    named = (F.coalesce("ol_key", F.lit("")) != "") | (F.coalesce("canonical_title", F.lit("")) != "")
    return links.filter(named & (F.coalesce("method", F.lit("")) != "failed"))


def replace_values(rows: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Replace values by a (old, new) table; others stay."""
    m = mapping.select(F.col("old").alias("_old"), F.col("new").alias("_new"))
    return rows.join(m, F.col(column) == F.col("_old"), "left").withColumn(column, F.coalesce("_new", column)).drop("_old", "_new")


def by_title(links: DataFrame, *ties: str) -> DataFrame:
    """Per (title, author), null authors kept: mentions, threads, confidence, first key, share of ambiguous ones.

    Of keys at the same position the first by ``ties`` counts, then the least.

    Confidences are added up as decimals (12 places): sums of doubles depend on the order of rows, and where the average lies
    halfway between two results, so would its last digit.
    """
    confidence = F.avg(F.col("confidence").cast("decimal(28,12)"))
    first = F.min(F.when(F.coalesce("ol_key", F.lit("")) != "", F.struct("_pos", *ties, "ol_key")))
    return links.groupBy("canonical_title", "author_name").agg(
        F.count("text").alias("mentions"), F.countDistinct("thread_id").alias("threads"), F.bround(confidence, 9).cast("double").alias("avg_confidence"),
        first["ol_key"].alias("ol_key"), round_even(100 * F.avg(F.col("ambiguous").cast("double")), 1).alias("ambiguous_pct"),
    )


def by_key(links: DataFrame) -> DataFrame:
    """Per (key, title, author), rows with a null among them dropped."""
    keys = ["ol_key", "canonical_title", "author_name"]
    return links.dropna(subset=keys).groupBy(*keys).agg(F.count("text").alias("mentions"), F.countDistinct("thread_id").alias("threads"))


def ranked(rows: DataFrame, measure: str, top: int, *ties: str) -> DataFrame:
    """The ``top`` rows by a measure with their rank; only they are ranked."""
    best = rows.orderBy(F.desc(measure), *ties).limit(top)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(measure), *ties)))


def rank_shift(counts: DataFrame, top: int = 100) -> DataFrame:
    """Ranks by mentions and by threads, and the difference where both exist."""
    keys = ["ol_key", "canonical_title", "author_name"]
    raw = ranked(counts, "mentions", top, *keys).select(*keys, F.col("rank").alias("rank_raw"))
    threads = ranked(counts, "threads", top, *keys).select(*keys, F.col("rank").alias("rank_threads"))
    both = raw.select(keys).unionByName(threads.select(keys)).dropDuplicates()
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(f">{top}"))
    return both.join(raw, keys, "left").join(threads, keys, "left").select(
        *keys, (F.col("rank_raw") - F.col("rank_threads")).cast("long").alias("shift"), shown("rank_raw").alias("rank_raw"), shown("rank_threads").alias("rank_threads")
    )


def hubness(counts: DataFrame, least_threads: int = 5) -> DataFrame:
    """Mentions per thread of titles in enough threads."""
    return counts.filter(F.col("threads") >= least_threads).withColumn("ratio", round_even(F.col("mentions") / F.col("threads"), 2))


def exact_titles(counts: DataFrame, norm: str = "norm") -> DataFrame:
    """Per normalised title: the title in most threads, summed counts, the author with most mentions."""
    titles = counts.groupBy(norm, "canonical_title").agg(F.sum("threads").alias("threads"), F.sum("mentions").alias("mentions"))
    best = titles.groupBy(norm).agg(F.min_by("canonical_title", F.struct(-F.col("threads"), "canonical_title")).alias("title"), F.sum("threads").alias("threads"), F.sum("mentions").alias("mentions"))
    authors = counts.dropna(subset=["author_name"]).groupBy(norm, "author_name").agg(F.sum("mentions").alias("n"))
    return best.join(authors.groupBy(norm).agg(F.min_by("author_name", F.struct(-F.col("n"), "author_name")).alias("author")), norm, "left")


def density(rows: DataFrame, count: str, length: str) -> DataFrame:
    return rows.withColumn("density", F.expr(f"try_divide({count}, {length})"))


def shares(rows: DataFrame, by: str) -> DataFrame:
    """Counts and percentages of the values of a column."""
    counts = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", round_even(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 1))  # a row for each value


def distinct_counts(links: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct threads, keys and titles; approximate ones for tables past counting exactly."""
    count = F.approx_count_distinct if approximate else F.countDistinct
    return links.agg(count("thread_id").alias("threads"), count("ol_key").alias("keys"), count("canonical_title").alias("titles"))
