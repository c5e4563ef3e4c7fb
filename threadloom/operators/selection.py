"""Which of the overlapping spans of a text stay: one sweep over sorted ends, in n log n.

A text's spans are an array, as everywhere. Rows of an Arrow batch are sorted together, as many as hold about
``SPANS_AT_ONCE`` spans, and walked once.
Longest first needs no search among the kept spans: a kept span is never shorter than one that
comes after it, so if the two overlap it covers the first or the last stretch between neighbouring ends
of the later one. Those two stretches are looked up, and a stretch is taken at most once.

A null array stays null. Spans without a start or an end, or that end before they start, go. Spans
without any character overlap what they lie inside of, nothing else. Equal spans stay once, unless empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ENDS = [T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
PLAIN, LABELLED = T.ArrayType(T.StructType(_ENDS)), T.ArrayType(T.StructType([*_ENDS, T.StructField("label", T.StringType())]))
#: Spans that a worker sorts and walks at once (a row's spans stay together); bounds its memory whatever the rows of a batch hold.
SPANS_AT_ONCE = 1 << 17


def _by_length(order: np.ndarray, start: np.ndarray, end: np.ndarray, group: np.ndarray) -> list[int]:
    """Places kept, taken in the given order, in which spans of a group come from long to short."""
    n = len(order)
    points, owners = np.concatenate([start, end]), np.concatenate([group, group])
    by_place = np.lexsort((points, owners))
    new = np.ones(2 * n, dtype=bool)
    new[1:] = (np.diff(points[by_place]) != 0) | (np.diff(owners[by_place]) != 0)
    cell = np.empty(2 * n, dtype=np.int64)
    cell[by_place] = np.cumsum(new) - 1
    first, last = cell[:n].tolist(), cell[n:].tolist()
    taken, kept = [-1] * (2 * n + 1), []
    for i in order.tolist():
        a, b = first[i], last[i]
        if a == b:
            free = a == 0 or taken[a] < 0 or taken[a] != taken[a - 1]
        else:
            free = taken[a] < 0 and taken[b - 1] < 0
            if free:
                taken[a:b] = [i] * (b - a)
        if free:
            kept.append(i)
    return kept


def _by_start(order: np.ndarray, start: np.ndarray, end: np.ndarray, group: np.ndarray) -> list[int]:
    """Places kept, taken in the given order, in which spans of a group come from left to right, long ones first."""
    kept, here, low, high = [], None, 0, 0
    for i, g, a, b in zip(order.tolist(), group[order].tolist(), start[order].tolist(), end[order].tolist()):
        if g != here:
            here, low, high = g, a, a
        if a < high and low < b:
            continue
        kept.append(i)
        if a < b:
            low, high = a, b
    return kept


def choose(spans: pa.Array, longest: bool, first_seen: bool = False) -> pa.Array:
    """Spans (start, end) or (start, end, label) that stay in each row, for each label by itself, in the order in which they are taken.

    With ``longest`` long spans come first, of equally long ones the leftmost or the ``first_seen``; else the leftmost
    come first and of those that start together the longest. Labels of a row come in the order of their names, null last.
    """
    flat = spans.flatten()
    row = np.repeat(np.arange(len(spans)), pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False))
    good = pc.fill_null(pc.less_equal(pc.struct_field(flat, 0), pc.struct_field(flat, 1)), False)
    flat, row = flat.filter(good), row[good.to_numpy(zero_copy_only=False)]
    start, end = (pc.struct_field(flat, i).cast(pa.int64()).to_numpy(zero_copy_only=False) for i in (0, 1))
    group = row
    if flat.type.num_fields == 3:
        label = pc.struct_field(flat, 2).cast(pa.string())
        names = pc.unique(label)
        rank = np.empty(len(names), dtype=np.int64)
        rank[pc.sort_indices(names, null_placement="at_end").to_numpy(zero_copy_only=False)] = np.arange(len(names))
        group = row * len(names) + rank[pc.index_in(label, value_set=names).to_numpy(zero_copy_only=False)]
    ties = () if first_seen else (start,)
    order = np.lexsort((*ties, start - end, group) if longest else (start - end, start, group))
    kept = np.array((_by_length if longest else _by_start)(order, start, end, group), dtype=np.int64)
    counts = np.bincount(row[kept], minlength=len(spans))
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat.take(pa.array(kept)), mask=pc.is_null(spans) if spans.null_count else None)


def row_slices(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """(first row, rows) of stretches of rows whose sizes add up to ``most``, or of one larger row."""
    ends, out, at = np.cumsum(sizes), [], 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        out.append((at, stop - at))
        at = stop
    return out


def choose_by_slices(spans: pa.Array, longest: bool, first_seen: bool = False, most: int | None = None) -> pa.Array:
    """``choose``, for some rows at a time."""
    sizes = pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    parts = [choose(spans.slice(at, n), longest, first_seen) for at, n in row_slices(sizes, most or SPANS_AT_ONCE)]
    return pa.concat_arrays(parts) if parts else choose(spans, longest, first_seen)


@F.arrow_udf(PLAIN)
def _longest(spans: pa.Array) -> pa.Array:
    return choose_by_slices(spans, True)


@F.arrow_udf(LABELLED)
def _longest_first_seen(spans: pa.Array) -> pa.Array:
    return choose_by_slices(spans, True, True)


@F.arrow_udf(PLAIN)
def _leftmost(spans: pa.Array) -> pa.Array:
    return choose_by_slices(spans, False)


def _ends(s: Column) -> tuple[Column, Column]:
    return s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end")


def longest_first(spans: Column) -> Column:
    """Longest spans first, earlier ones on ties; touching spans both stay."""
    return _longest(F.transform(spans, lambda s: F.struct(*_ends(s))))


def leftmost_longest(spans: Column) -> Column:
    """Leftmost spans first, the longest of those that start together."""
    return _leftmost(F.transform(spans, lambda s: F.struct(*_ends(s))))


def longest_first_by_label(spans: Column) -> Column:
    """Spans (start, end, label), those of each label chosen by themselves: longest first, the first of the array on ties."""
    return _longest_first_seen(F.transform(spans, lambda s: F.struct(*_ends(s), s["label"].cast("string").alias("label"))))
