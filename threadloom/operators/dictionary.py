"""Dictionary scan: every place of very many titles in very many texts.

Titles are sharded by their rarest token, and a shard's Aho-Corasick automaton is built by the
task that streams the texts past it. A text goes only to shards one of whose tokens it holds. A
title at word boundaries has all its tokens whole in the text, so nothing is missed. Titles never pass through the
driver; what it hands out is a hash and a shard number for each sharding token, a bounded number at a time.
How rare a token is, is counted on a bounded sample of the texts (``SAMPLE_CHARS``, chosen by hash): that decides
how many texts travel, never what is found.

Tokens are runs of ``\\w`` in the lower-cased text; a title without any is sharded by its rarest
character, which is a token of a text as well. Offsets count characters of the text as it
is, although lower-casing may lengthen it (D13).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.stored import stored

#: Characters of the titles of a shard; a token with more titles has several.
SHARD_CHARS = 4 << 20
#: Characters of the texts that a task streams past one automaton.
TEXT_CHARS = 64 << 20
#: Characters of the texts on which rarity is counted.
SAMPLE_CHARS = 4 << 20
#: Sharding tokens whose hashes are sent to every executor at once (16 bytes each).
ROUND_KEYS = 1 << 21
#: Texts that a worker turns into rows at once.
TEXTS_AT_ONCE = 256
_WORD = re.compile(r"\w+")


def lowered(text: str) -> tuple[str, list[int] | None]:
    """A text in lower case and, if that changed its length, each character's place in ``text``."""
    low = text.lower()
    if len(low) == len(text):
        return low, None
    sizes = [len(c.lower()) for c in text]
    return low, [i for i, n in enumerate(sizes) for _ in range(n)]


def spans_of(places: list[int] | None, start: int, end: int) -> tuple[int, int]:
    """A span of the lower-cased text in the text as it is."""
    return (start, end) if places is None else (places[start], places[end - 1] + 1)


def at_boundaries(low: str, start: int, end: int) -> bool:
    """No word character right before or after the span."""
    return not (_WORD.match(low[start - 1 : start]) if start else None) and not _WORD.match(low[end : end + 1])


def text_tokens(low: str) -> set[str]:
    return set(_WORD.findall(low)) | set(re.sub(r"\w+", "", low))


def title_tokens(low: str, boundary: bool) -> set[str]:
    """The tokens under one of which a title may be sharded: any text that has the title has them all."""
    runs = [m for m in _WORD.finditer(low) if boundary or (m.start() > 0 and m.end() < len(low))]
    if runs:
        return {m.group() for m in runs}
    signs = set(re.sub(r"\w+", "", low))  # no whole token for sure; characters between words are tokens of a text as well
    return signs or {""}


def token_hash(token: str) -> int:
    return xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass")) - (1 << 63)


def _known_titles(titles: DataFrame, boundary: bool) -> DataFrame:
    """(title, ol_key, h): the distinct lower-cased titles that are not empty, with the hashes of the tokens that may shard them."""

    def fold(batches):
        for batch in batches:
            low = [None if t is None else t.lower() for t in batch.column(1).to_pylist()]
            hashes = [[token_hash(x) for x in title_tokens(t, boundary)] if t else None for t in low]
            kept = pa.array([bool(t) for t in low])
            columns = [batch.column(0).filter(kept), pa.array(low, pa.string()).filter(kept), pa.array(hashes, pa.list_(pa.int64())).filter(kept)]
            yield pa.RecordBatch.from_arrays(columns, ["ol_key", "title", "hs"])

    rows = titles.select("ol_key", F.col("title").cast("string")).mapInArrow(fold, "ol_key string, title string, hs array<bigint>")
    return rows.groupBy("title").agg(F.min("ol_key").alias("ol_key"), F.first("hs").alias("hs"))


def _token_counts(texts: DataFrame) -> DataFrame:
    """(h, n): in how many texts each token is."""

    def count(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, TEXTS_AT_ONCE):
                found: dict[str, int] = {}
                for text in batch.column(0).slice(s, TEXTS_AT_ONCE).to_pylist():
                    for token in text_tokens((text or "").lower()):
                        found[token] = found.get(token, 0) + 1
                yield pa.RecordBatch.from_arrays([pa.array([token_hash(t) for t in found], pa.int64()), pa.array(list(found.values()), pa.int64())], ["h", "n"])

    return texts.select("text").mapInArrow(count, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))


def _sharded(known: DataFrame, counts: DataFrame, n_sampled: int, shard_chars: int) -> DataFrame:
    """(title, ol_key, h, n, parts, part): each title under the rarest of its tokens, which ``n`` sampled texts hold; its token's titles are cut into ``parts``."""
    each = known.select("title", "ol_key", F.explode("hs").alias("h")).join(counts, "h", "left")
    # a title without a token that texts have for sure meets all texts
    each = each.withColumn("n", F.when(F.col("h") == token_hash(""), F.lit(n_sampled)).otherwise(F.coalesce("n", F.lit(0))))
    best = each.groupBy("title", "ol_key").agg(F.min(F.struct("n", "h")).alias("best")).select("title", "ol_key", "best.*")
    # a token with many titles is cut into parts, tokens with few share a shard
    sizes = best.groupBy("h").agg(F.sum(F.length("title") + 1).alias("chars"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("chars") / shard_chars)).cast("int")
    return best.join(sizes.select("h", parts.alias("parts")), "h").withColumn("part", F.pmod(F.xxhash64("title"), F.col("parts")).cast("int"))


def _stream(boundary: bool):
    """Rows of a shard come with its titles first: they become an automaton, past which its texts go."""
    schema = [("key", None), ("ol_key", pa.string()), ("title", pa.string()), ("start", pa.int32()), ("end", pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton, current, ready, found = None, None, False, []

        def flush(own: pa.DataType) -> pa.RecordBatch:
            arrays = [pa.array([f[i] for f in found], t or own) for i, (_, t) in enumerate(schema)]
            found.clear()
            return pa.RecordBatch.from_arrays(arrays, [n for n, _ in schema])

        for batch in batches:
            for s in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(s, TEXTS_AT_ONCE)
                for shard, split, title, ol_key, key, text in zip(*(part.column(c).to_pylist() for c in ("shard", "split", "title", "ol_key", "key", "text"))):
                    if (shard, split) != current:
                        automaton, current, ready = ahocorasick.Automaton(), (shard, split), False
                    if title is not None:
                        automaton.add_word(title, (ol_key, title))
                        continue
                    if not ready:
                        ready = True
                        automaton.make_automaton()
                    if not len(automaton):
                        continue
                    low, places = lowered(text)
                    for last, (own, name) in automaton.iter(low):
                        a, b = last + 1 - len(name), last + 1
                        if not boundary or at_boundaries(low, a, b):
                            found.append((key, own, name, *spans_of(places, a, b)))
                if found:
                    yield flush(batch.schema.field("key").type)

    return run


def matches(texts: DataFrame, titles: DataFrame, key: str = "task_id", boundary: bool = True, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """(key, ol_key, title, start, end): every place of every title in every text, overlapping ones too, in any case.

    ``texts`` has the key and text, ``titles`` ol_key and title; of titles that are equal in lower case the least key
    stays. With ``boundary`` a word character may neither come before nor after. Null and empty texts
    and titles match nothing; rows of ``texts`` that share a key are texts each.
    """
    spark, kind = texts.sparkSession, texts.schema[key].dataType.simpleString()
    texts = texts.select(F.col(key).alias("key"), F.col("text").cast("string").alias("text")).filter("length(text) > 0")
    size, n_texts = texts.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)), F.count(F.lit(1))).first()
    every = max(1, size // SAMPLE_CHARS)
    sample = texts.filter(F.pmod(F.xxhash64("text"), F.lit(every)) == 0)
    sharded = stored(_sharded(_known_titles(titles, boundary), _token_counts(sample), -(-n_texts // every), shard_chars), "titles")
    keys = sharded.groupBy("h").agg(F.max("parts").alias("parts"), F.max("n").alias("n"), F.sum(F.length("title") + 1).alias("chars"))
    n_keys, chars = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum("chars"), F.lit(0))).first()
    if not n_keys or not n_texts:
        return spark.createDataFrame([], f"`{key}` {kind}, ol_key string, title string, start int, end int")
    shards, rounds = max(1, -(-chars // shard_chars)), -(-n_keys // ROUND_KEYS)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shard = F.pmod(F.xxhash64("h", "part"), F.lit(shards)).cast("int").alias("shard")
    owner = keys.select("h", "n", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).select("h", "n", shard)
    # the texts that a shard may see decide among how many tasks they are dealt
    seen = owner.groupBy("shard").agg(F.least(F.sum("n") * every, F.lit(n_texts)).alias("n"))
    wanted = F.ceil((F.col("n") if shards > 1 else F.lit(n_texts)) * max(1, size // n_texts) / TEXT_CHARS)
    splits = stored(seen.select("shard", F.greatest(F.lit(-(-partitions // shards)), wanted).cast("int").alias("splits")), "shards")
    widest = splits.agg(F.max("splits")).first()[0]

    def routed(p: int) -> DataFrame:
        # all tokens of a shard are in one round, so a text meets it once
        rows = owner.join(splits, "shard").filter(F.pmod("shard", F.lit(rounds)) == p).select("h", "shard", "splits").toPandas().sort_values("h", kind="stable")
        held = spark.sparkContext.broadcast(tuple(rows[c].to_numpy() for c in ("h", "shard", "splits")))  # about ROUND_KEYS

        def route(batches):
            hs, to, parts = held.value
            anything = token_hash("")
            for batch in batches:
                for s in range(0, batch.num_rows, TEXTS_AT_ONCE):
                    piece = batch.slice(s, TEXTS_AT_ONCE)
                    known: dict[str, int] = {}
                    at, where, split = [], [], []
                    for i, (own, text) in enumerate(zip(piece.column("key").to_pylist(), piece.column("text").to_pylist())):
                        hashes = [known[t] if t in known else known.setdefault(t, token_hash(t)) for t in text_tokens(text.lower())]
                        hashes = np.array([*hashes, anything], np.int64)
                        lo, hi = np.searchsorted(hs, hashes, "left"), np.searchsorted(hs, hashes, "right")
                        met = {int(to[k]): int(parts[k]) for a, b in zip(lo[hi > lo], hi[hi > lo]) for k in range(a, b)}
                        dealt = xxhash.xxh64_intdigest(f"{own}|{text[:64]}".encode("utf-8", "surrogatepass"))
                        at += [i] * len(met)
                        where += met
                        split += [dealt % n for n in met.values()]
                    taken = piece.take(pa.array(at, pa.int64()))
                    yield pa.RecordBatch.from_arrays([taken.column("key"), taken.column("text"), pa.array(where, pa.int32()), pa.array(split, pa.int32())], ["key", "text", "shard", "split"])

        return texts.mapInArrow(route, f"key {kind}, text string, shard int, split int")

    if shards > 1:
        sent = reduce(DataFrame.unionByName, (routed(p) for p in range(rounds)))
    else:  # one automaton holds all titles: every text goes past it
        sent = texts.select("*", F.lit(0).alias("shard"), F.pmod(F.xxhash64("key", "text"), F.lit(widest)).cast("int").alias("split"))
    nothing = F.lit(None).cast("string")
    sent = sent.select("shard", "split", nothing.alias("title"), nothing.alias("ol_key"), "key", "text")
    held = sharded.select("*", shard).join(splits, "shard")
    held = held.select("shard", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("split"), "title", "ol_key", F.lit(None).cast(kind).alias("key"), nothing.alias("text"))
    slot = F.pmod(F.col("shard").cast("long") * widest + F.col("split"), F.lit(partitions)).cast("int")
    dealt = held.unionByName(sent).repartitionById(partitions, slot).sortWithinPartitions("shard", "split", F.col("title").isNull())
    return dealt.mapInArrow(_stream(boundary), f"key {kind}, ol_key string, title string, start int, end int").withColumnRenamed("key", key)
