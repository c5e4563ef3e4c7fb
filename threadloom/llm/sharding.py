"""Uniform sharding by a hypergeometric communication matrix.

Rows fall into logical partitions by a hash of their id, whatever files or splits they
came in, so a rerun after a lost executor sees the same partitions. A matrix drawn from
the multivariate hypergeometric law says exactly how many rows each partition sends to
each block of each shard. Rows are permuted inside their partition, dealt out by the
matrix, exchanged, and permuted again inside their block. Block sizes are fixed before
the draw, so slots follow by arithmetic and no shard is ever sorted as one group.

Defined cases: shard sizes differ by one row at most; an empty table gives an empty table;
rows with equal ids or texts are separate rows; a null id is an id like any other.
"""

from __future__ import annotations

from math import lgamma

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import fresh

ROWS_PER_BLOCK = 4096
MAX_SIDE = 1024  # partitions, and blocks: the matrix has a million entries at most


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Draw the good ones among ``n`` of ``good + bad``; numpy's sampler ends at 1e9."""
    if good == 0 or n == 0:
        return 0
    if bad == 0:
        return n
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, n))
    low, high = max(0, n - bad), min(n, good)
    mode = min(max((n + 1) * (good + 1) // (good + bad + 2), low), high)
    log_choose = lambda a, b: lgamma(a + 1) - lgamma(b + 1) - lgamma(a - b + 1)
    p = np.exp(log_choose(good, mode) + log_choose(bad, n - mode) - log_choose(good + bad, n))
    u, up, down, p_up, p_down = rng.random() - p, mode, mode, p, p
    while u > 0 and (up < high or down > low):  # outwards from the mode
        if up < high:
            p_up *= (good - up) * (n - up) / ((up + 1.0) * (bad - n + up + 1.0))
            up, u = up + 1, u - p_up
            if u <= 0:
                return up
        if down > low:
            p_down *= down * (bad - n + down) / ((good - down + 1.0) * (n - down + 1.0))
            down, u = down - 1, u - p_down
            if u <= 0:
                return down
    return mode


def communication_matrix(rows: list[int], blocks: list[int], seed: int) -> np.ndarray:
    """How many rows each partition sends to each block: row sums ``rows``, column sums ``blocks``."""
    rng, left = np.random.default_rng(seed), np.array(blocks, np.int64)
    out = np.zeros((len(rows), len(blocks)), np.int64)
    for p, n in enumerate(rows):
        rest = int(left.sum())
        for b in range(len(blocks)):
            rest -= int(left[b])
            take = hypergeometric(rng, int(left[b]), rest, n)
            out[p, b] = take
            n -= take
        left -= out[p]
    return out


def even(total: int, parts: int) -> list[int]:
    return [total // parts + (i < total % parts) for i in range(parts)]


def uniform_shards(docs: DataFrame, n_shards: int, seed: int = 20240501, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with shard (0 to ``n_shards`` - 1) and slot (gapless from 0 in its shard); input columns of these names give way."""
    docs = docs.drop("shard", "slot")
    spark = docs.sparkSession
    c = {n: fresh(docs.columns, n) for n in ("part", "first", "second", "rank", "block", "tie")}
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit("\0"))
    tie = F.xxhash64(*(F.col(f"`{x}`") for x, kind in docs.dtypes if not kind.startswith("map")))  # rows with equal ids keep their places in a rerun
    keyed = docs.withColumn(c["first"], F.xxhash64(ident, F.lit(seed))).withColumn(c["tie"], tie)
    total = docs.count()
    n_parts = int(np.clip(-(-total // ROWS_PER_BLOCK), 16, MAX_SIDE))
    per_shard = int(np.clip(-(-total // (ROWS_PER_BLOCK * n_shards)), 1, max(1, MAX_SIDE // n_shards)))
    part = F.pmod(F.xxhash64(ident, F.lit(seed + 1)), F.lit(n_parts)).cast("int")
    counts = dict(docs.groupBy(part.alias("p")).count().collect())  # n_parts rows
    sizes = [size for shard in even(total, n_shards) for size in even(shard, per_shard)]
    matrix = communication_matrix([counts.get(p, 0) for p in range(n_parts)], sizes, seed)
    ends = spark.sparkContext.broadcast(np.cumsum(matrix, axis=1))
    bases = np.array([sum(sizes[b - b % per_shard : b]) for b in range(len(sizes))], np.int64)

    @F.pandas_udf("int")
    def block_of(p: pd.Series, rank: pd.Series) -> pd.Series:
        rows, out = ends.value, np.empty(len(p), np.int32)
        p, rank = p.to_numpy(), rank.to_numpy()
        for one in np.unique(p):
            at = p == one
            out[at] = np.searchsorted(rows[one], rank[at] - 1, side="right")
        return pd.Series(out)

    within = Window.partitionBy(c["part"]).orderBy(c["first"], id_col, c["tie"])
    dealt = keyed.withColumn(c["part"], part).withColumn(c["rank"], F.row_number().over(within))
    dealt = dealt.withColumn(c["block"], block_of(c["part"], c["rank"])).withColumn(c["second"], F.xxhash64(ident, F.lit(seed + 2)))
    within = Window.partitionBy(c["block"]).orderBy(c["second"], id_col, c["tie"])
    base = F.element_at(F.array(*(F.lit(int(b)) for b in bases)), F.col(c["block"]) + 1)
    return (
        dealt.withColumn("slot", (base + F.row_number().over(within) - 1).cast("long"))
        .withColumn("shard", F.floor(F.col(c["block"]) / per_shard).cast("int"))
        .drop(*c.values())
    )
