"""Which quality filter removes what, in every order: incidence matrix products.

Each document is reduced to a mask of the filters that it fails. Per part, the counts of
the 32 masks (of all documents, of the good and of the toxic ones) are stacked as rows and
multiplied by integer 32-by-600 matrices, one for each outcome and a column for each step of
each of the 120 orders. Texts are read once; what is shuffled is one narrow row a document.

Filters: A under 50 words; B distinct words under 65 % of the words; C capitals over 5 % of
the code points; D holds any of ``#$%&*|``; E the text stands in a row of a smaller id.

Defined cases: a null text counts as empty (it fails A, and E if it is not the first empty
one); a null id is smaller than none, has none smaller and no labels; rows that share an id are
documents each, and copies under the smallest id all pass E; a document is good or toxic if any label row of its
id says so; a null part is the empty string; an empty table has no parts and no rows.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, released

FILTERS = "ABCDE"
MASKS = 1 << len(FILTERS)
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(FILTERS)
#: Parts multiplied at once: 600 result rows each.
PARTS_AT_ONCE = 64
WHITE = "[\\x20\\x09-\\x0D]+"
RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def outcome_matrices() -> dict[str, np.ndarray]:
    """0/1 matrices (mask, order x step): kept, removed, redundant, unique_fails; ``shapley`` counts the orders that remove a mask by the step's filter."""
    names = ("kept", "removed", "redundant", "unique_fails", "shapley")
    out = {n: np.zeros((MASKS, len(ORDERS), STEPS), np.int64) for n in names}
    fails = (np.arange(MASKS)[:, None] >> np.arange(STEPS)) & 1 == 1
    removals = np.zeros((MASKS, STEPS), np.int64)
    places = [[FILTERS.index(f) for f in order] for order in ORDERS]
    for o, order in enumerate(places):
        gone = np.zeros(MASKS, bool)
        for s, f in enumerate(order):
            out["removed"][:, o, s] = fails[:, f] & ~gone
            out["redundant"][:, o, s] = fails[:, f] & gone
            out["unique_fails"][:, o, s] = np.arange(MASKS) == 1 << f
            removals[:, f] += fails[:, f] & ~gone
            gone = gone | fails[:, f]
            out["kept"][:, o, s] = ~gone
    for o, order in enumerate(places):
        out["shapley"][:, o, :] = removals[:, order]
    return {n: m.reshape(MASKS, -1) for n, m in out.items()}


def text_mask(text: Column) -> Column:
    """Bits of the filters that a text fails by itself (all but E)."""
    inner = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    words = F.split(inner, WHITE)
    n = F.when(inner == "", 0).otherwise(F.size(words)).cast("long")
    distinct = F.when(inner == "", 0).otherwise(F.size(F.array_distinct(words))).cast("long")
    capitals = F.regexp_count(text, F.lit("[A-Z]")).cast("long")
    tests = (n < 50, 100 * distinct < 65 * n, 100 * capitals > 5 * F.length(text), text.rlike("[#$%&*|]"))
    mask = F.lit(0)
    for bit, test in enumerate(tests):
        mask = mask + F.when(test, 1 << bit).otherwise(0)
    return mask


def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part that fail just the filters of ``mask``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        text_mask(text).alias("mask"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("sha"),
    )
    rows = materialise(rows, "filter-masks")
    named = rows.filter("id IS NOT NULL")
    # joined by text and least id, not by text: copies of a text, however many, never meet in a task
    first = named.groupBy("sha").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    says = [F.max((F.col(c) == 1).cast("int")).alias(k) for c, k in (("quality", "good"), ("toxic", "toxic"))]
    said = labels.select(F.col("doc_id").alias("id"), "quality", "toxic").filter("id IS NOT NULL").groupBy("id").agg(*says)
    duplicate = F.when(F.col("first").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    known = named.join(first, ["id", "sha"], "left").join(said, "id", "left").select(
        "part", (F.col("mask") + duplicate).alias("mask"), F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")
    )
    every = known.unionByName(rows.filter("id IS NULL").select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic")))
    return every.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Per part, order of the filters and step: documents kept, removed, redundant, failing that filter alone, and good and toxic ones lost."""
    matrices = outcome_matrices()
    orders, steps = np.repeat(ORDERS, STEPS), np.tile(np.arange(1, STEPS + 1, dtype=np.int32), len(ORDERS))

    def multiply(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, PARTS_AT_ONCE):
                rows = batch.slice(start, PARTS_AT_ONCE)
                p, counts = rows.num_rows, rows.column(1)
                part = np.repeat(np.arange(p), np.diff(counts.offsets.to_numpy()))
                mask, n, good, toxic = (x.to_numpy(zero_copy_only=False) for x in counts.flatten().flatten())
                stacked = np.zeros((3, p, MASKS), np.int64)
                for k, values in enumerate((n, good, toxic)):
                    stacked[k, part, mask] = values
                lost = stacked.reshape(3 * p, MASKS) @ matrices["removed"]
                whole = [stacked[0] @ matrices[m] for m in ("kept", "redundant", "unique_fails", "shapley")]
                columns = [whole[0], lost[:p], whole[1], whole[2], lost[p : 2 * p], lost[2 * p :], whole[3]]
                names = rows.column(0).take(pa.array(np.repeat(np.arange(p), len(steps))))
                yield pa.RecordBatch.from_arrays(
                    [names, pa.array(np.tile(orders, p)), pa.array(np.tile(steps, p))] + [pa.array(c.ravel()) for c in columns],
                    ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"],
                )

    counts = mask_counts(docs, labels, id_col, text_col, part_col)
    stacked = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))  # at most 32 each
    return stacked.mapInArrow(released(multiply), RESULT)
