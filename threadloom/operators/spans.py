"""Span operators: finding entities and titles in text, and the algebra of their spans.

Offsets count characters from 0, ends are exclusive. Span arrays are columns of
``array<struct<start:int,end:int,text:string,labels:array<string>>>`` unless said otherwise.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SETTINGS
from .selection import row_slices

SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("pass", T.StringType())]))
PLAIN_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
APOSTROPHES = "'‘’`ʼʻ"


def _folded(text: str) -> tuple[str, list[int]]:
    """Compatibility form with single spaces, and each character's place in ``text``."""
    out: list[str] = []
    places: list[int] = []
    for i, c in enumerate(text):
        for d in unicodedata.normalize("NFKD", c).lower():
            if d.isspace():
                if not out or out[-1] == " ":
                    continue
                d = " "
            out.append(d)
            places.append(i)
    while out and out[-1] == " ":
        out.pop()
        places.pop()
    return "".join(out), places


def _literal(needle: str, text: str, flags: int = 0) -> list[tuple[int, int]]:
    return [m.span() for m in re.finditer(re.escape(needle), text, flags)] if needle else []


_ELEMENTS = re.compile(rf"(?P<also>\s*&\s*|\s+and\s+)|(?P<mark>[{APOSTROPHES}])|(?P<plain>.)", re.IGNORECASE | re.DOTALL)


def _flexible(entity: str) -> re.Pattern:
    """One element for each token of the entity: any way to write "and", any apostrophe, or the character itself."""
    element = {"also": lambda _: r"\s*(?:&|&amp;|and)\s*", "mark": lambda _: f"[{APOSTROPHES}]", "plain": re.escape}
    return re.compile("".join(element[m.lastgroup](m.group()) for m in _ELEMENTS.finditer(entity)), re.IGNORECASE)


def _runs(words: list[str]):
    """Every shorter run of the words, the longest first, then the leftmost."""
    return (" ".join(words[at : at + n]) for n in range(len(words) - 1, 0, -1) for at in range(len(words) - n + 1))


def find_spans(entity: str | None, text: str | None) -> list[dict]:
    """All places of an entity by the first pass that finds any: verbatim, any case, folded,
    flexible, and last its runs of words, each flexible and then folded."""
    if not entity or not entity.strip() or not text:
        return []
    folded, places = _folded(text)

    def in_folded(needle: str) -> list[tuple[int, int]]:
        return [(places[a], places[b - 1] + 1) for a, b in _literal(_folded(needle)[0], folded)]

    def flexible(needle: str) -> list[tuple[int, int]]:
        return [m.span() for m in _flexible(needle).finditer(text)]

    passes = [("verbatim", lambda: _literal(entity, text)), ("case", lambda: _literal(entity, text, re.IGNORECASE)), ("folded", lambda: in_folded(entity)), ("flexible", lambda: flexible(entity))]
    passes += [("words", lambda run=run: flexible(run) or in_folded(run)) for run in _runs(entity.split())]
    for used, search in passes:
        if hits := search():
            return [{"start": a, "end": b, "pass": used} for a, b in hits]
    return []


@F.pandas_udf(SPAN)
def entity_spans(entity: pd.Series, text: pd.Series) -> pd.Series:
    return pd.Series([find_spans(e, t) for e, t in zip(entity, text)])


def verbatim_spans(entity: Column, text: Column) -> Column:
    """The verbatim pass as an expression: starts of non-overlapping places, left to right."""
    pieces = F.split(text, F.concat(F.lit(r"\Q"), entity, F.lit(r"\E")), -1)
    step = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.length(p))
    starts = F.aggregate(step, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("found")), lambda acc, n: F.struct((acc["at"] + n + F.length(entity)).alias("at"), F.concat(acc["found"], F.array(acc["at"] + n)).alias("found")))
    return F.when(F.coalesce(F.length(entity), F.lit(0)) > 0, starts["found"])


def span_results(entities: DataFrame, texts: DataFrame, key: str = "thread_id") -> DataFrame:
    """One row per place of each entity, and one with a null start for those not found."""
    return (
        entities.join(texts, key).withColumn("s", F.explode_outer(entity_spans("entity", "text")))
        .select(key, "entity", "label", F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.col("s.pass").alias("pass"))
    )


def overlap(a: Column, b: Column) -> Column:
    return F.greatest(F.lit(0), F.least(a["end"], b["end"]) - F.greatest(a["start"], b["start"]))


def novel(hit: Column, existing: Column, share: float = SETTINGS.novelty_overlap) -> Column:
    """No existing span covers ``share`` of the hit or more."""
    return ~F.exists(existing, lambda e: overlap(hit, e) / (hit["end"] - hit["start"]) >= share)


def merge_accepted(existing: Column, accepted: Column, label: str = "BOOK") -> Column:
    """Existing spans without those of the label that overlap an accepted one, then the accepted ones."""
    kept = F.filter(existing, lambda e: ~(F.array_contains(e["labels"], label) & F.exists(accepted, lambda n: overlap(e, n) > 0)))
    return F.concat(kept, accepted)


def span_id(*parts: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 8)


def snippet(text: Column, start: Column, end: Column, context: int = 40) -> Column:
    """The span with its surroundings, dots where text was cut off."""
    low, high = F.greatest(start - context, F.lit(0)), F.least(end + context, F.length(text))
    return F.concat(F.when(low > 0, "…").otherwise(""), F.substr(text, low + 1, high - low), F.when(high < F.length(text), "…").otherwise(""))


#: Fixed value: what stands before a comment of a rendered document.
NOISE = r"\[u/[^\]]+\]\s*\.?\s*"


#: Characters (bytes of UTF-8) of text that a worker cleans at once; a text stays whole.
NOISE_BYTES_AT_ONCE = 1 << 22


def _without_noise(text: pa.Array, spans: pa.Array) -> pa.Array:
    texts, flat = text.to_pylist(), spans.flatten()
    sizes = pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, end = (pc.fill_null(pc.struct_field(flat, i), -1).to_numpy(zero_copy_only=False).copy() for i in (0, 1))
    stays, ends = (start >= 0) & (end >= 0), np.append(0, np.cumsum(sizes))
    for row, t in enumerate(texts):
        cuts = np.array([m.span() for m in re.finditer(NOISE, t)] if t else [], dtype=np.int64).reshape(-1, 2)
        if not len(cuts):
            continue
        texts[row] = re.sub(NOISE, "", t)
        a, b = start[ends[row] : ends[row + 1]], end[ends[row] : ends[row + 1]]
        after = np.searchsorted(cuts[:, 1], a, side="right")  # the first cut that ends behind the start
        stays[ends[row] : ends[row + 1]] &= np.append(cuts[:, 0], np.iinfo(np.int64).max)[after] >= b
        shift = np.append(0, np.cumsum(cuts[:, 1] - cuts[:, 0]))[after].astype(a.dtype)
        a -= shift
        b -= shift
    kept = np.append(0, np.cumsum(stays))[ends].astype(np.int32)
    moved = pa.StructArray.from_arrays([pa.array(x[stays], pa.int32()) for x in (start, end)], ["start", "end"])
    return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.ListArray.from_arrays(pa.array(kept), moved)], ["text", "spans"])


@F.arrow_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("spans", PLAIN_SPAN)]))
def _noise_removed(text: pa.Array, spans: pa.Array) -> pa.Array:
    sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    parts = [_without_noise(text.slice(at, n), spans.slice(at, n)) for at, n in row_slices(sizes, NOISE_BYTES_AT_ONCE)]
    return pa.concat_arrays(parts) if parts else _without_noise(text, spans)


def remove_noise(text: Column | str, spans: Column) -> Column:
    """(text, spans): the text without noise, spans moved along; spans that touch removed characters go, as do those without both ends."""
    return _noise_removed(text, F.transform(spans, lambda s: F.struct(s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end"))))


def length_buckets(n: Column) -> Column:
    bounds = (6, 10), (11, 20), (21, 30), (31, 50), (51, 100)
    out = F.when(n < 6, "0-5")
    for a, b in bounds:
        out = out.when(n.between(a, b), f"{a}-{b}")
    return out.otherwise("101+")
