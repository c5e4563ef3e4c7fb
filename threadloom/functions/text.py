"""Text functions as Column expressions, with Arrow UDFs where Spark has no equivalent.

Spark has no Unicode normalisation, so the three normalisers are Arrow UDFs; everything
else stays inside the JVM.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ABBREVIATIONS, ACRONYM_STOP_WORDS, DELETED_MARKERS, INDEX_STOP_WORDS, NUMBER_WORDS, SCRIPTURE_BOOKS, SETTINGS

_SPACES = r"(?U)[\s\x1c-\x1f]+"


def fold_title(text: str | None) -> str | None:
    """Without diacritics, lower case, punctuation as spaces, single spaces."""
    if text is None:
        return None
    plain = "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")
    return " ".join(re.sub(r"[^\w\s]", " ", plain.lower()).split())


@F.pandas_udf(T.StringType())
def norm_title(x: pd.Series) -> pd.Series:
    """The normaliser of deterministic title matching."""
    return x.map(fold_title, na_action="ignore")


def norm_title_sql(x: Column) -> Column:
    """The same for text whose letters are ASCII or precomposed Latin, without leaving the JVM."""
    pairs = [(chr(c), d) for c in range(0xC0, 0x250) if len(d := "".join(y for y in unicodedata.normalize("NFD", chr(c)) if unicodedata.category(y) != "Mn")) == 1 and d != chr(c)]
    plain = F.translate(x, "".join(a for a, _ in pairs), "".join(b for _, b in pairs))
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(plain), r"[^\p{L}\p{N}_\s]", " "), _SPACES, " "))


@F.pandas_udf(T.StringType())
def norm_search(x: pd.Series) -> pd.Series:
    """Compatibility form, lower case, single spaces; punctuation stays."""
    return x.map(lambda s: " ".join(unicodedata.normalize("NFKD", s).lower().split()), na_action="ignore")


@F.pandas_udf(T.StringType())
def norm_stats(x: pd.Series) -> pd.Series:
    """ASCII letters only, lower case, no leading article, punctuation as spaces."""

    def one(s: str) -> str:
        s = unicodedata.normalize("NFD", s).encode("ascii", "ignore").decode().lower()
        return " ".join(re.sub(r"[^\w\s]", " ", re.sub(r"^(the|a|an)\s+", "", s)).split())

    return x.map(one, na_action="ignore")


def is_removed(x: Column) -> Column:
    return F.coalesce(x.isin(*DELETED_MARKERS), F.lit(False))


def clean_text(x: Column) -> Column:
    """Single spaces; nothing for deleted or absent text."""
    return F.when(x.isNull() | is_removed(x), "").otherwise(F.trim(F.regexp_replace(x, _SPACES, " ")))


def epoch_date(x: Column) -> Column:
    """UTC date of epoch seconds; null if they are not a number."""
    return F.date_format(F.timestamp_seconds(x.try_cast("bigint")), "yyyy-MM-dd")


def bare_id(x: Column) -> Column:
    """What follows the first underscore."""
    return F.regexp_replace(x, r"^[^_]*_", "")


def words(x: Column) -> Column:
    return F.filter(F.split(F.trim(F.regexp_replace(x, _SPACES, " ")), " "), lambda w: w != "")


def initials(x: Column) -> Column:
    return F.array_join(F.transform(words(x), lambda w: F.upper(F.substring(w, 1, 1))), "")


def title_acronym(x: Column) -> Column:
    """Initials of the words that are not articles or prepositions."""
    return F.array_join(F.transform(F.filter(words(x), lambda w: ~F.lower(w).isin(*ACRONYM_STOP_WORDS)), lambda w: F.upper(F.substring(w, 1, 1))), "")


def last_word(x: Column) -> Column:
    return F.element_at(words(x), -1)


def is_scripture(x: Column) -> Column:
    """A chapter and verse, or a scripture book as first word."""
    first = F.lower(F.regexp_replace(F.get(words(x), F.lit(0)), r"[,.]+$", ""))
    return F.coalesce(x.rlike(r"^(\d\s+)?[A-Z][a-z]+\s+\d+:\d+"), F.lit(False)) | F.coalesce(first.isin(*SCRIPTURE_BOOKS), F.lit(False))


def spell_numbers(x: Column) -> Column:
    """Lower case, digits as words, abbreviations spelled out."""
    table = F.create_map(*(F.lit(y) for pair in NUMBER_WORDS.items() for y in pair))
    joined = F.array_join(F.transform(words(F.regexp_replace(F.lower(x), r"(\d),(\d{3})", "$1$2")), lambda w: F.coalesce(table[w], w)), " ")
    for short, long in ABBREVIATIONS:
        joined = F.regexp_replace(joined, rf"(?U)\b{short}\b", long)
    return F.trim(joined)


def index_tokens(normalised: Column) -> Column:
    """Distinct tokens of a normalised title that are long enough and not stop words."""
    return F.array_distinct(F.filter(F.split(normalised, " "), lambda w: (F.length(w) >= SETTINGS.min_token_length) & ~w.isin(*INDEX_STOP_WORDS)))


def search_terms(x: Column) -> Column:
    """A query without the characters that a full-text engine would interpret."""
    return F.trim(F.regexp_replace(F.regexp_replace(x, r"[^\p{L}\p{N}_\s]", " "), _SPACES, " "))


def pipe_split(x: Column) -> Column:
    return F.filter(F.transform(F.split(x, r"\|"), lambda w: F.trim(w)), lambda w: w != "")


def catalog_keys(x: Column) -> Column:
    """Catalog keys in a page, first seen first."""
    return F.array_distinct(F.regexp_extract_all(x, F.lit(r"/(OL\d+[MWA])"), F.lit(1)))


def with_prefix(x: Column, prefix: str) -> Column:
    return F.when(x.startswith("/"), x).otherwise(F.concat(F.lit(prefix), x))


def as_flag(x: Column) -> Column:
    return F.lower(F.trim(x)).isin("true", "1", "yes")


def as_number(x: Column) -> Column:
    return F.trim(x).try_cast("double")


def description_text(payload: Column) -> Column:
    """A description that is a string, or an object with a value."""
    return F.coalesce(F.get_json_object(payload, "$.description.value"), F.get_json_object(payload, "$.description"))


def json_list(x: Column) -> Column:
    return F.coalesce(F.from_json(x, "array<string>"), F.array().cast("array<string>"))


def author_keys(payload: Column) -> Column:
    """Keys of the authors given as objects; entries of any other shape are ignored."""
    found = F.regexp_extract_all(F.get_json_object(payload, "$.authors"), F.lit(r'"author"\s*:\s*\{[^{}]*"key"\s*:\s*"([^"]+)"'), F.lit(1))
    return F.coalesce(found, F.array().cast("array<string>"))


def reply_entities(reply: Column) -> Column:
    """Entities of a model's reply: code fences off, labels checked, blanks dropped."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(reply), r"^```[a-zA-Z]*\s*", ""), r"\s*```$", "")
    parsed = F.from_json(bare, "array<struct<text:string,label:string>>")
    clean = F.transform(parsed, lambda e: F.struct(F.trim(e["text"]).alias("text"), F.upper(F.trim(e["label"])).alias("label")))
    return F.coalesce(F.filter(clean, lambda e: (e["text"] != "") & e["label"].isin("BOOK", "WRITER")), F.array().cast("array<struct<text:string,label:string>>"))


def acronym_line(x: Column) -> Column:
    """(key, title, author) of a line ``key: title - author``."""
    rest = F.get(F.split(x, ":", 2), F.lit(1))
    return F.struct(
        F.trim(F.get(F.split(x, ":", 2), F.lit(0))).alias("key"), F.trim(F.get(F.split(rest, " - ", 2), F.lit(0))).alias("title"), F.trim(F.get(F.split(rest, " - ", 2), F.lit(1))).alias("author")
    )


def acronym_map(lines: DataFrame, value: str = "value") -> DataFrame:
    """(key, title, author) of the lines that have a key and a title; a later line wins."""
    rows = lines.select(acronym_line(F.col(value)).alias("a"), "_pos").select("a.*", "_pos").filter("key <> '' AND title <> ''")
    return rows.groupBy("key").agg(F.max_by(F.struct("title", "author"), "_pos").alias("r")).select("key", "r.*")


def query_text(x: Column) -> Column:
    """A search query without outer white space and quotes, percent-encoded."""
    bare = F.regexp_replace(F.regexp_replace(x, r"^[\s\"']+", ""), r"[\s\"']+$", "")
    return F.replace(F.url_encode(bare), F.lit("+"), F.lit("%20"))


def four_places(x: Column) -> Column:
    return F.format_string("%.4f", x)


def bar(count: Column, most: Column, width: int = 30) -> Column:
    return F.repeat(F.lit("█"), F.floor(count / most * width).cast("int"))


def any_of(column: Column, values: Iterable[str]) -> Column:
    return F.coalesce(column.isin(*values), F.lit(False))
