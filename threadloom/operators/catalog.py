"""The bibliographic catalog: import, lookups, full-text search, acronyms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SETTINGS
from ..functions.text import author_keys, description_text, index_tokens, initials, norm_title, title_acronym
from . import fulltext
from .fulltext import FullTextIndex
from .labels import last_wins


def works_table(dump: DataFrame) -> DataFrame:
    """Works of dump lines (key, payload, _pos): the last revision of each key."""
    rows = dump.select(
        F.col("key").alias("ol_key"), F.get_json_object("payload", "$.title").alias("title"), author_keys(F.col("payload")).alias("author_keys"),
        F.coalesce(F.from_json(F.get_json_object("payload", "$.subjects"), "array<string>"), F.array().cast("array<string>")).alias("subjects"),
        description_text(F.col("payload")).alias("description"), "_pos",
    )
    return last_wins(rows.filter("title is not null"), ["ol_key"], "_pos").drop("_pos").withColumn("norm_title", norm_title("title"))


def work_authors(dump: DataFrame) -> DataFrame:
    """Work and author keys of all revisions, superseded ones too."""
    return dump.select(F.col("key").alias("work_key"), F.explode(author_keys(F.col("payload"))).alias("author_key")).distinct()


def title_dictionary(works: DataFrame, least: int = 6) -> DataFrame:
    """Titles of at least ``least`` characters and two words, the first key of each in any case."""
    rows = works.filter((F.length("title") >= least) & (F.size(F.split(F.trim("title"), r"\s+")) >= 2)).withColumn("title_lower", F.lower("title"))
    return rows.groupBy("title_lower").agg(F.min_by(F.struct("ol_key", "title"), "_pos").alias("r")).select("r.*", "title_lower")


def edition_works(dump: DataFrame, wanted: DataFrame) -> DataFrame:
    """(edition_key, work_keys, work_key_primary) of the wanted editions, misses included."""
    found = dump.filter(F.col("type") == "/type/edition").join(wanted.select(F.col("edition_key").alias("key")).distinct(), "key", "left_semi")
    keys = F.transform(F.from_json(F.get_json_object("payload", "$.works"), "array<struct<key:string>>"), lambda w: w["key"])
    found = found.groupBy(F.col("key").alias("edition_key")).agg(F.max_by(F.coalesce(keys, F.array().cast("array<string>")), "_pos").alias("work_keys"))
    return wanted.join(found, "edition_key", "left").withColumn("work_keys", F.coalesce("work_keys", F.array().cast("array<string>"))).withColumn("work_key_primary", F.get("work_keys", F.lit(0)))


def works_of_author(works: DataFrame, junction: DataFrame, names: DataFrame, limit: int = 50) -> DataFrame:
    """Works of each author, the first ``limit`` by key."""
    rows = names.join(junction, names.ol_key == junction.author_key).drop("ol_key").join(works, F.col("work_key") == works.ol_key)
    return rows.withColumn("n", F.row_number().over(Window.partitionBy("author_key").orderBy("work_key"))).filter(F.col("n") <= limit).drop("n")


def exact_lookup(surfaces: DataFrame, works: DataFrame) -> DataFrame:
    return surfaces.join(works, surfaces.surface == works.title)


def normalised_lookup(surfaces: DataFrame, works: DataFrame) -> DataFrame:
    """Surfaces with ``norm`` and works with ``norm_title``: a plain equi-join, no cap."""
    return surfaces.join(works, surfaces.norm == works.norm_title)


def title_index(works: DataFrame, key: str = "ol_key", norm: str = "norm_title") -> FullTextIndex:
    """The stored full-text index of normalised titles, or of authors' names."""
    return fulltext.build(works, key, F.filter(F.split(norm, " "), lambda w: w != ""))


def acronym_matches(acronyms: DataFrame, works: DataFrame, limit: int = 10) -> DataFrame:
    """Works whose title has each acronym, the first ``limit`` by key."""
    titles = works.select("ol_key", "title", title_acronym(F.col("title")).alias("acronym"))
    hit = acronyms.join(titles, "acronym")
    return hit.withColumn("place", F.row_number().over(Window.partitionBy("acronym").orderBy("ol_key"))).filter(F.col("place") <= limit)


def token_index(works: DataFrame, norm: str = "norm_title", most: int = SETTINGS.postings_per_token) -> DataFrame:
    """(token, ol_key): the first ``most`` works by key of each index token, as the candidate index defines."""
    rows = works.select(F.explode(index_tokens(F.col(norm))).alias("token"), "ol_key")
    return rows.withColumn("n", F.row_number().over(Window.partitionBy("token").orderBy("ol_key"))).filter(F.col("n") <= most).drop("n")


def token_candidates(surfaces: DataFrame, index: DataFrame, norm: str = "norm") -> DataFrame:
    """(surface, ol_key) of works that share an index token."""
    return surfaces.select("surface", F.explode(index_tokens(F.col(norm))).alias("token")).join(index, "token").select("surface", "ol_key").distinct()


def authors_table(dump: DataFrame) -> DataFrame:
    """Authors of dump lines (key, payload, _pos): the last revision of each key, with its normalised name."""
    rows = dump.select(F.col("key").alias("author_key"), F.get_json_object("payload", "$.name").alias("name"), "_pos").filter("name is not null")
    return last_wins(rows, ["author_key"], "_pos").drop("_pos").withColumn("norm_name", norm_title("name"))


def by_name(names: DataFrame, authors: DataFrame, normalised: bool = True, limit: int | None = 200) -> DataFrame:
    """(name, author_key, author_name): authors of a name as written, or as normalised; the first ``limit`` by key, or all."""
    left = names.select(F.col("name").alias("asked"), (F.col("norm") if normalised else F.col("name")).alias("k")).distinct()
    hit = left.join(authors.select("author_key", F.col("name").alias("author_name"), F.col("norm_name" if normalised else "name").alias("k")), "k")
    if limit is not None:
        hit = hit.withColumn("n", F.row_number().over(Window.partitionBy("asked").orderBy("author_key"))).filter(F.col("n") <= limit)
    return hit.select(F.col("asked").alias("name"), "author_key", "author_name")


def authors_of_work(works: DataFrame, junction: DataFrame, authors: DataFrame) -> DataFrame:
    """Each work with the names of its authors, by key; without any, an empty list."""
    names = junction.join(authors, "author_key").groupBy("work_key").agg(F.array_sort(F.collect_set(F.struct("author_key", "name"))).alias("a"))
    joined = works.join(names, works.ol_key == names.work_key, "left").drop("work_key")
    return joined.withColumn("authors", F.coalesce(F.transform("a", lambda x: x["name"]), F.array().cast("array<string>"))).drop("a")


def first_author(works: DataFrame, authors: DataFrame) -> DataFrame:
    """``works`` (with author_keys) and the name of the first author; null if there is none."""
    keyed = works.withColumn("_first", F.get("author_keys", F.lit(0)))
    names = authors.select(F.col("author_key").alias("_first"), F.col("name").alias("author_name"))
    return keyed.join(names, "_first", "left").drop("_first")


def get_by_key(rows: DataFrame, keys: list[str], key: str) -> DataFrame:
    """Point lookups: the rows of some keys."""
    return rows.filter(F.col(key).isin(keys))


def acronym_authors(acronyms: DataFrame, authors: DataFrame, limit: int = 10) -> DataFrame:
    """Authors whose initials are each acronym, the first ``limit`` by key."""
    hit = acronyms.join(authors.select("author_key", "name", initials(F.col("name")).alias("acronym")), "acronym")
    return hit.withColumn("place", F.row_number().over(Window.partitionBy("acronym").orderBy("author_key"))).filter(F.col("place") <= limit)
