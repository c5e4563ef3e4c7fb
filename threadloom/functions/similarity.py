"""String similarities: Dice on bigrams as an expression, the indel family as Arrow UDFs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SETTINGS


def bigrams(x: Column) -> Column:
    return F.when(F.length(x) < 2, F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(x) - 1, F.lit(1))), lambda i: F.substr(x, i, F.lit(2))))
    )


def dice(a: Column, b: Column) -> Column:
    """Dice coefficient of the bigram sets of two normalised strings; equality if either has none."""
    x, y = bigrams(a), bigrams(b)
    return F.when((F.size(x) == 0) | (F.size(y) == 0), (a == b).cast("double")).otherwise(2.0 * F.size(F.array_intersect(x, y)) / (F.size(x) + F.size(y)))


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence, bit-parallel: zeros of the state are matched places of ``a``."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    state = full
    for c in b:
        hit = state & places.get(c, 0)
        state = ((state + hit) | (state - hit)) & full
    return len(a) - state.bit_count()


def ratio(a: str, b: str) -> float:
    """100 times the normalised indel similarity."""
    return 100.0 if not a and not b else 200.0 * lcs_length(a, b) / (len(a) + len(b))


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter string with a window of the longer one, clipped at both ends."""
    if not a or not b:
        return 100.0 if a == b else 0.0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    best = max(ratio(short, long[max(0, i) : i + len(short)]) for i in range(1 - len(short), len(long)))
    if len(a) == len(b):
        best = max(best, *(ratio(b, a[max(0, i) : i + len(b)]) for i in range(1 - len(b), len(a))))
    return best


def token_set_ratio(a: str, b: str) -> float:
    """Best ratio among the common tokens and each side's common tokens with its own."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and (not left or not right):
        return 100.0
    one, two = f"{both} {left}".strip(), f"{both} {right}".strip()
    return max(ratio(one, two), *((ratio(both, one), ratio(both, two)) if both else (0.0,)))


def _udf(f):
    @F.pandas_udf(T.DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else f(x, y) for x, y in zip(a, b)], dtype="float64")

    return run


indel_ratio, sort_ratio, part_ratio, set_ratio = (_udf(f) for f in (ratio, token_sort_ratio, partial_ratio, token_set_ratio))


def fuzzy_score(a: Column, b: Column) -> Column:
    """The score of the fuzzy stage, on normalised strings."""
    return SETTINGS.fuzzy_sort_weight * sort_ratio(a, b) + SETTINGS.fuzzy_partial_weight * part_ratio(a, b)


def canonical_score(a: Column, b: Column) -> Column:
    return F.greatest(sort_ratio(a, b), set_ratio(a, b), indel_ratio(a, b))
