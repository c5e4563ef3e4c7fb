"""A stored full-text index: postings in blocks with their greatest score, top-k by block-max pruning.

Documents are dealt into ranges of about ``RANGE_DOCS`` of similar length, chosen by length class and
hash, so building needs no global order; whole documents are shuffled by range, and a worker turns a
range's lists of tokens into its blocks. A block holds a token's postings in one range, with
the greatest BM25 part that any of them has; blocks are written once, in folders by a hash of
their token, sorted by token. A search reads the tokens, ranges and greatest parts alone: ranges that have
all its terms, by the sum of the greatest parts. The blocks of the most promising ranges give
each query a kth score; of the other ranges only those whose sum reaches it are read. Results are
those of scoring every posting.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.stored import stored

#: BM25 constants of the full-text search.
K1, B = 1.2, 0.75
RANGE_DOCS = 1024
#: Tokens of a range's documents together, about: long documents get ranges of fewer, since a worker holds one.
RANGE_TOKENS = 1 << 20
#: Folders of the blocks.
BUCKETS = 16
#: Documents that a worker counts at once.
DOCS_AT_ONCE = 512
#: Blocks that a worker passes on at once.
BLOCKS_AT_ONCE = 1 << 15
#: Ranges that a query reads before it knows a score to beat.
FIRST_RANGES = 2
#: Scores are rounded to so many places; a range may not be left out for less.
PLACES, SLACK = 6, 1e-6


@dataclass(frozen=True)
class FullTextIndex:
    """``blocks`` (bucket, token, range, n, top, postings) and ``tokens`` (token, df), both stored, of documents with ``key``."""

    key: str
    blocks: DataFrame
    tokens: DataFrame
    n_docs: int
    mean_length: float


def term_part(tf: Column, length: Column, mean: float) -> Column:
    """What a term adds to a document's BM25 score, without the term's own weight."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / F.lit(float(mean or 1))))


def weight(df: Column, n_docs: int) -> Column:
    n = F.lit(float(n_docs))
    return F.log((n - df + 0.5) / (df + 0.5) + 1)


def _bucket(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(BUCKETS)).cast("int")


def _forward(rows: DataFrame, key: str, tokens: Column) -> DataFrame:
    """(key, doc_len, terms, tfs): each document's distinct tokens and how often it has them, so that only pairs are shuffled."""

    def count(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(start, DOCS_AT_ONCE)
                sizes = pc.fill_null(pc.list_value_length(part.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                coded = part.column(1).flatten().dictionary_encode()
                doc, words = np.repeat(np.arange(len(sizes)), sizes), max(1, len(coded.dictionary))
                pairs, tf = np.unique(doc * words + coded.indices.to_numpy(), return_counts=True)
                ends = pa.array(np.append(0, np.cumsum(np.bincount(pairs // words, minlength=len(sizes)))).astype(np.int32))
                terms = pa.ListArray.from_arrays(ends, coded.dictionary.take(pa.array(pairs % words)))
                tfs = pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes.astype(np.int32)), terms, tfs], ["key", "doc_len", "terms", "tfs"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(F.col(key).alias("key"), tokens.alias("tokens")).mapInArrow(count, f"key {kind}, doc_len int, terms array<string>, tfs array<int>").filter("doc_len > 0")


def _blocks(ranged: DataFrame, mean: float) -> DataFrame:
    """(token, range, n, top, postings) from rows of (range, key, doc_len, terms, tfs) in which those of a range follow each other."""
    kind = ranged.schema["key"].dataType.simpleString()

    def made(parts):
        part = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        coded = part.column("terms").flatten().dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        doc = np.repeat(np.arange(part.num_rows), pc.list_value_length(part.column("terms")).to_numpy(zero_copy_only=False).astype(np.int64))
        order = np.argsort(codes, kind="stable")
        codes, doc, tf = codes[order], doc[order], part.column("tfs").flatten().to_numpy()[order]
        begin = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
        ends, length = np.append(begin[1:], len(codes)), part.column("doc_len").to_numpy()[doc]
        top = np.maximum.reduceat(tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / (mean or 1.0))), begin)
        postings = pa.StructArray.from_arrays([part.column("key").take(pa.array(doc)), pa.array(length), pa.array(tf)], ["key", "doc_len", "tf"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), postings)
        columns = [coded.dictionary.take(pa.array(codes[begin])), pa.array(np.full(len(begin), part.column("range")[0].as_py(), np.int64)), pa.array(ends - begin), pa.array(top), lists]
        yield from pa.Table.from_arrays(columns, ["token", "range", "n", "top", "postings"]).to_batches(max_chunksize=BLOCKS_AT_ONCE)

    def run(batches):
        held, current = [], None
        for batch in batches:
            of = batch.column("range").to_numpy()
            cuts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))) if len(of) else []
            for a, b in zip(cuts, np.append(cuts[1:], len(of))):
                if held and of[a] != current:
                    yield from made(held)
                    held = []
                current = of[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield from made(held)

    return ranged.mapInArrow(run, f"token string, range long, n long, top double, postings array<struct<key:{kind},doc_len:int,tf:int>>")


def build(rows: DataFrame, key: str, tokens: Column) -> FullTextIndex:
    """The index of ``rows``; documents without tokens are not in it, neither as hits nor in the statistics. Keys are unique."""
    spark = rows.sparkSession
    held = stored(_forward(rows, key, tokens), "terms").withColumn("class", F.floor(2 * F.log2("doc_len")).cast("int"))
    sizes = held.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_len").alias("length")).collect()  # two for each doubling of the length
    n_docs, total = sum(r["n"] for r in sizes), sum(r["length"] for r in sizes)
    mean = total / n_docs if n_docs else 0.0
    parts = F.create_map(*(F.lit(x) for r in sizes for x in (r["class"], max(-(-r["n"] // RANGE_DOCS), -(-r["length"] // RANGE_TOKENS)))))[F.col("class")] if sizes else F.lit(1)
    ranged = held.select((F.col("class").cast("long") * F.lit(1 << 40) + F.pmod(F.xxhash64("key"), parts)).alias("range"), "key", "doc_len", "terms", "tfs")
    dealt = ranged.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "range").sortWithinPartitions("range")
    blocks = _blocks(dealt, mean)
    blocks = blocks.select(_bucket(F.col("token")).alias("bucket"), "*").sortWithinPartitions("bucket", "token", "range")
    kept = stored(blocks, "postings", ("bucket",))
    return FullTextIndex(key, kept, stored(kept.groupBy("token").agg(F.sum("n").alias("df")), "tokens"), n_docs, mean)


def _wanted(index: FullTextIndex, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(query, n_terms, token, idf) of queries all of whose terms occur, and the blocks of their buckets."""
    terms = queries.select("query", F.size("terms").alias("n_terms"), F.explode("terms").alias("token"))
    wanted = terms.join(index.tokens, "token").select("query", "n_terms", "token", weight(F.col("df"), index.n_docs).alias("idf"))
    buckets = [r[0] for r in terms.select(_bucket(F.col("token"))).distinct().collect()]  # BUCKETS at most
    return wanted, index.blocks.filter(F.col("bucket").isin(buckets))


def ranges_of(index: FullTextIndex, queries: DataFrame) -> DataFrame:
    """(query, range, n_terms, bound): ranges that have all terms of a query, and what a document there can score at most."""
    wanted, blocks = _wanted(index, queries)
    met = blocks.select("token", "range", "top").join(wanted, "token").groupBy("query", "n_terms", "range")
    return met.agg(F.count(F.lit(1)).alias("found"), F.sum(F.col("idf") * F.col("top")).alias("bound")).filter("found = n_terms").drop("found")


def _scored(index: FullTextIndex, queries: DataFrame, ranges: DataFrame) -> DataFrame:
    """(query, key, score) of the documents of some ranges that hold all terms."""
    wanted, blocks = _wanted(index, queries)
    read = ranges.select("query", "range").join(wanted, "query").join(blocks.select("token", "range", "postings"), ["token", "range"])
    hits = read.select("query", "n_terms", "idf", F.explode("postings").alias("p")).select("query", "n_terms", "idf", "p.*")
    part = F.col("idf") * term_part(F.col("tf"), F.col("doc_len"), index.mean_length)
    scored = hits.groupBy("query", "key", "n_terms").agg(F.sum(part).alias("score"), F.count(F.lit(1)).alias("found")).filter("found = n_terms")
    return scored.select("query", "key", F.bround("score", PLACES).alias("score"))


def pruned(index: FullTextIndex, queries: DataFrame, limit: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(first ranges, their best documents, other ranges that can still matter) of each query."""
    ranges = stored(ranges_of(index, queries), "ranges")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("bound"), "range"))
    first = ranges.withColumn("place", place).filter(F.col("place") <= FIRST_RANGES)
    best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "key"))
    scores = stored(_scored(index, queries, first).withColumn("place", best).filter(F.col("place") <= limit), "scores")
    bars = scores.filter(F.col("place") == limit).select("query", F.col("score").alias("bar"))
    rest = ranges.join(first.select("query", "range"), ["query", "range"], "left_anti").join(bars, "query", "left")
    return first, scores.drop("place"), rest.filter(F.col("bar").isNull() | (F.col("bound") >= F.col("bar") - SLACK)).drop("bar")


def search(index: FullTextIndex, queries: DataFrame, limit: int) -> DataFrame:
    """(query, key, score, place): documents that hold all terms, best BM25 first, equal ones by key.

    ``queries`` has query and terms (distinct tokens); queries without terms, or with one that no document has, find nothing.
    """
    _, scores, rest = pruned(index, queries, limit)
    best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "key"))
    found = scores.unionByName(_scored(index, queries, rest)).withColumn("place", best).filter(F.col("place") <= limit)
    return found.select("query", F.col("key").alias(index.key), "score", "place")
