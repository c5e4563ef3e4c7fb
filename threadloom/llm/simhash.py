"""SimHash near-duplicates with pigeonring filtering.

Fingerprints are 16 segments of 4 bits on a ring. If two differ in at most 3 bits, some
segment starts a chain whose first l segments differ in at most 3 l / 16 bits, for every l.
So the first 5 segments of the chain agree: they are the key under which fingerprints meet,
once for each of the 16 starts. Before the full Hamming check a pair must keep within 1 bit
over 10 segments and 2 bits over 15. A key that too many fingerprints share is split without
loss: the remaining bits fall into 4 blocks, one of which must agree, and it joins the key.
Equal fingerprints are one node from the start, and each key's links come out as stars, so
nothing is ever expanded into all pairs.

Defined cases: null and empty texts have fingerprint zero and link like any other; texts of
one or two words have one shingle; repeated rows are copies; rows that share a doc_id are documents
of their own; a null doc_id is less than any other, and is the component_id where it is in one; an
empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bitfilter import bits_for, fetched, known, ranges
from .common import forget, fresh, materialise, partitions_for, released, text_slices
from .components import connected_components
from .line_dedup import BITS_PER_KEY, MAX_BITS, _bounds, _groups, _mix

RADIUS = 3
SHINGLE = 3
SEED = 42
SEGMENTS, SEGMENT_BITS = 16, 4
KEY_BITS = 20
#: Stands for a null doc_id.
NULL_ID = -(1 << 63)
#: Chain lengths in bits at which the proportional budget grows, and the budget up to there.
BUDGETS = ((40, 1), (60, 2), (64, 3))
#: A key shared by more fingerprints than this is split, twice at most.
LARGE_KEY = 2048
SPLITS = ((44, 11), (33, 9))  # bits left, bits of the widest of 4 blocks


def word_sequence(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit SimHash of the whole text."""
    words = word_sequence(text)
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts[: 1 - SHINGLE].tolist(), ends[SHINGLE - 1 :].tolist())]
    octets = np.array(hashes, np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(octets), 1 << 15):
        ones += np.unpackbits(octets[i : i + (1 << 15)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _id(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID).cast("long"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``, fp as a signed long, a null id as ``NULL_ID``."""

    def run(batches):
        for batch in batches:
            values = np.array([fingerprint(x.as_py()) for x in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["doc_id", "fp"])

    narrow = docs.select(_id(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(released(run), "doc_id long, fp long")


def _near(x: np.ndarray) -> np.ndarray:
    """Pigeonring chain budgets, then the full check, on differences turned to the chain's start."""
    ok = np.ones(len(x), bool)
    for bits, budget in BUDGETS:
        ok &= np.bitwise_count(x >> np.uint64(64 - bits)) <= budget
    return ok


def _stars(turned: np.ndarray, rep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links inside one key's group, as stars around the least node of each part that hangs together."""
    left, out_a, out_b = np.arange(len(rep)), [], []
    while len(left) > 1:
        part, frontier, left = [left[0]], [left[0]], left[1:]
        while frontier and len(left):
            one = frontier.pop()
            near = _near(turned[left] ^ turned[one])
            if near.any():
                hit = left[near]
                part.extend(hit.tolist())
                frontier.extend(hit.tolist())
                left = left[~near]
        if len(part) > 1:
            ids = rep[part]
            least = ids.min()
            ids = ids[ids != least]
            out_a.append(np.full(len(ids), least))
            out_b.append(ids)
    empty = np.zeros(0, np.int64)
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (empty, empty)


def _split(key: np.ndarray, turned: np.ndarray, rep: np.ndarray, level: int) -> list[np.ndarray]:
    """Four finer keys for each row: one of the 4 blocks of its remaining bits joins the old key."""
    left, width = SPLITS[level]
    keys, turns, reps = [], [], []
    for j in range(4):
        block = (turned >> np.uint64(max(0, left - width * (j + 1)))) & np.uint64((1 << width) - 1)
        mixed = (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ ((block << np.uint64(2)) | np.uint64(j)) * np.uint64(0xC2B2AE3D27D4EB4F)
        keys.append(mixed.view(np.int64))
        turns.append(turned)
        reps.append(rep)
    return [np.concatenate(x) for x in (keys, turns, reps)]


def _links_of(level: int, large: int):
    """Streams rows sorted by key; yields links, or finer keys for the rows of a large key."""

    def batch_of(key, a, b):
        return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["key", "a", "b"])

    def finish(key, turned, rep, begun=None):
        edges = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        sizes = np.diff(np.append(edges, len(key)))
        size_of = np.repeat(sizes, sizes)
        small = (size_of <= 8) & (key != begun if begun is not None else True)
        for lag in range(1, min(8, int(sizes.max(initial=1)))):
            pair = np.flatnonzero((key[lag:] == key[:-lag]) & small[lag:])
            pair = pair[_near(turned[pair + lag] ^ turned[pair])]
            if len(pair):
                yield batch_of(np.full(len(pair), None), np.minimum(rep[pair], rep[pair + lag]), np.maximum(rep[pair], rep[pair + lag]))
        for at, n in zip(edges.tolist(), sizes.tolist()) if begun is not None else zip(edges[sizes > 8].tolist(), sizes[sizes > 8].tolist()):
            if n <= 8 and key[at] != begun:
                continue
            part = slice(at, at + n)
            if (n > large or key[at] == begun) and level < len(SPLITS):
                k, t, r = _split(key[part], turned[part], rep[part], level)
                yield batch_of(k, t.view(np.int64), r)
            else:
                a, b = _stars(turned[part], rep[part])
                if len(a):
                    yield batch_of(np.full(len(a), None), a, b)

    def run(batches):
        held, begun = [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)], None
        for batch in batches:
            new = [batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64), batch.column(2).to_numpy()]
            rows = [np.concatenate(x) for x in zip(held, new)]
            last = int(np.searchsorted(rows[0], rows[0][-1])) if len(rows[0]) else 0
            held = [x[last:] for x in rows]
            if last:
                yield from finish(*(x[:last] for x in rows), begun)
            if len(held[0]) > 64 * large and level < len(SPLITS):  # split in parts, with whatever of this key still comes
                begun = held[0][0]
                k, t, r = _split(*held, level)
                yield batch_of(k, t.view(np.int64), r)
                held = [x[:0] for x in held]
        if len(held[0]):
            yield from finish(*held, begun)

    return run


def hamming_links(reps: DataFrame, large_key: int = LARGE_KEY, label: str = "simhash-links") -> DataFrame:
    """Links (a, b) between the nodes ``rep`` of distinct fingerprints ``fp`` within the radius, as stars."""
    n = partitions_for(reps.sparkSession)
    fp = F.col("fp")
    turns = [fp if not i else F.shiftleft(fp, 4 * i).bitwiseOR(F.shiftrightunsigned(fp, 64 - 4 * i)) for i in range(SEGMENTS)]
    chains = F.array(*(F.struct((F.lit(i << KEY_BITS).cast("long") + F.shiftrightunsigned(t, 64 - KEY_BITS)).alias("key"), t.alias("turned")) for i, t in enumerate(turns)))
    rows = reps.select(F.explode(chains).alias("c"), "rep").select("c.key", "c.turned", "rep")
    found = None
    for level in range(len(SPLITS) + 1):
        grouped = rows.repartition(n, "key").sortWithinPartitions("key", "turned")
        out = materialise(grouped.mapInArrow(released(_links_of(level, large_key)), "key long, a long, b long"), label)
        links = out.filter("key is null").select("a", "b")
        found = links if found is None else found.unionByName(links)
        rows = out.filter("key is not null").select("key", F.col("a").alias("turned"), F.col("b").alias("rep"))
    return found.distinct()


def _classes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, fp, component_id), null ids as ``NULL_ID``."""
    prints = materialise(fingerprints(docs, id_col, text_col), "simhash-fp")
    reps = prints.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"))
    # a fingerprint is a node of its own: rows that share a doc_id may have different ones
    reps = materialise(reps.withColumn("node", F.xxhash64("fp")), "simhash-rep")
    roots = connected_components(hamming_links(reps.select(F.col("node").alias("rep"), "fp")), "simhash-cc").withColumnRenamed("root", "cls")
    known = reps.join(roots, "node", "left").withColumn("cls", F.coalesce("cls", "node"))
    least = known.groupBy("cls").agg(F.min("rep").alias("component_id"))
    classes = materialise(known.join(least, "cls").select("fp", "component_id", "n"), "simhash-classes")
    # the fingerprints of many rows: so few that they may be broadcast
    most = max(LARGE_KEY, prints.count() // (4 * partitions_for(docs.sparkSession)))
    many, few = classes.filter(F.col("n") > most), classes.filter(F.col("n") <= most)
    hot = prints.join(F.broadcast(many.select("fp", F.col("component_id").alias("hot"))), "fp", "left")
    out = hot.filter("hot is not null").select("doc_id", "fp", F.col("hot").alias("component_id"))
    return out.unionByName(hot.filter("hot is null").join(few, "fp").select("doc_id", "fp", "component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): component_id is the least id reachable over links of at most 3 bits."""
    null = F.lit(NULL_ID).cast("long")
    return _classes(docs, id_col, text_col).select(F.nullif("doc_id", null).alias("doc_id"), "fp", F.nullif("component_id", null).alias("component_id"))


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Distinct hashes of the text's word shingles, sorted; a shorter text is one shingle."""
    words = word_sequence(text)
    if not words:
        return np.zeros(0, np.int64)
    one = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n, width = max(1, len(one) - shingle + 1), min(shingle, len(one))
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out = out * np.uint64(0xD6E8FEB86659FD93) + one[j : j + n]
    return np.unique(_mix(out).view(np.int64))


def _least(x: np.ndarray, similarity: float) -> np.ndarray:
    """The least hashes of a set, one more than a set of this similarity may lack."""
    return x[: len(x) - int(np.ceil(similarity * len(x) - 1e-9)) + 1] if len(x) else x


def sketches(docs: DataFrame, id_col: str, text_col: str, shingle: int, similarity: float | None) -> DataFrame:
    """(node, id, fp, same, size, least) per row: the text's hash and fingerprint, its shingle set's hash and size, and its least hashes."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                texts = part.column("text").to_pylist()
                prints = np.array([fingerprint(x) for x in texts], np.uint64)
                found = [shingle_set(x, shingle) for x in texts] if similarity is not None else [np.zeros(0, np.int64)] * len(texts)
                same = np.array([xxhash.xxh64_intdigest(x.tobytes()) for x in found], np.uint64).view(np.int64)
                least = [_least(x, similarity) for x in found]
                ends = np.cumsum([0, *map(len, least)]).astype(np.int32)
                least = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *least])))
                columns = [part.column("node"), part.column("id"), pa.array(prints.view(np.int64)), pa.array(same), pa.array([len(x) for x in found], pa.int32()), least]
                yield pa.RecordBatch.from_arrays(columns, ["node", "id", "fp", "same", "size", "least"])

    narrow = docs.select(F.xxhash64(text_col).alias("node"), _id(id_col).alias("id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(released(run), "node long, id long, fp long, same long, size int, least array<long>")


def _meetings(batches):
    """(grp, same) from sorted rows of (key, same): the sets that meet under a key, under a hash of them all."""
    for key, same in _groups(batches, 2):
        once = np.concatenate(([True], (key[1:] != key[:-1]) | (same[1:] != same[:-1])))
        key, same = key[once], same[once]
        edges = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        sizes = np.diff(np.append(edges, len(key)))
        grp = np.repeat(np.add.reduceat(_mix(same.view(np.uint64)), edges), sizes).view(np.int64)
        many = np.repeat(sizes > 1, sizes)
        if many.any():
            yield pa.RecordBatch.from_arrays([pa.array(grp[many]), pa.array(same[many])], ["grp", "same"])


def _hopeful(batches, similarity: float):
    """(first, same) from rows of (grp, same, size, least): sets that may have a partner in their group, by what the least hashes leave to them."""
    most = (1 - similarity) / (1 + similarity)  # of both sizes together, what similar sets may not share
    for grp, same, size, least in _groups(batches, 4):
        first, kept = [], []
        for a, b in _bounds(grp):
            good = np.zeros(b - a, bool)
            for i in range(b - a - 1):
                rest = np.arange(i + 1, b - a)
                rest = rest[~good[rest]] if good[i] else rest
                n, m = size[a + i].astype(np.int64), size[a + rest].astype(np.int64)
                rest = rest[np.minimum(n, m) >= similarity * np.maximum(n, m) - 1e-6]
                for j in rest.tolist():
                    x, y = least[a + i], least[a + j]
                    upto = min(x[-1], y[-1])
                    x, y = x[: np.searchsorted(x, upto, side="right")], y[: np.searchsorted(y, upto, side="right")]
                    apart = len(x) + len(y) - 2 * len(np.intersect1d(x, y, assume_unique=True))
                    if apart <= most * (int(n) + int(size[a + j])) + 1e-6:
                        good[i] = good[j] = True
            if good.any():
                some = same[a:b][good]
                first.append(np.full(len(some), some[0]))
                kept.append(some)
        if kept:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(first)), pa.array(np.concatenate(kept))], ["first", "same"])


def _alike(batches, shingle: int, similarity: float):
    """Links of each group of (grp, node, text), as stars of parts that hang together."""
    for grp, ident, text in _groups(batches, 3):
        out = []
        for a, b in _bounds(grp):
            sets = [shingle_set(x, shingle) for x in text[a:b]]
            size, left = np.array([len(x) for x in sets]), np.arange(b - a)
            while len(left) > 1:
                root, frontier, left = left[0], [left[0]], left[1:]
                while frontier and len(left):
                    one = frontier.pop()
                    fits = np.minimum(size[left], size[one]) >= similarity * np.maximum(size[left], size[one])
                    common = np.array([len(np.intersect1d(sets[one], sets[i], assume_unique=True)) for i in left[fits]], np.int64)
                    fits[fits] = common >= similarity * (size[left[fits]] + size[one] - common)
                    out += [(ident[a + root], ident[a + i]) for i in left[fits]]
                    frontier += left[fits].tolist()
                    left = left[~fits]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["a", "b"])


def _may_be(spark, hashes: DataFrame):
    """A filter on hashes that lets all of ``hashes`` through, and few others."""
    bits = bits_for(hashes.count(), 2 * BITS_PER_KEY, most=MAX_BITS)
    stored = materialise(ranges(hashes, bits), "bits", "zstd")
    some = spark.sparkContext.broadcast(fetched(stored, bits, "seen"))
    forget(stored)

    @F.pandas_udf("boolean")
    def may_be(h):
        import pandas as pd

        return pd.Series(known(some.value, h.to_numpy(), bits))

    return may_be


def jaccard_links(docs: DataFrame, made: DataFrame, text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """Links (a, b) between the nodes of ``sketches`` that join all texts whose shingle sets have this Jaccard similarity.

    Of two such sets, the least hashes of each, one more than it may lack, have one in common:
    no pair is missed. Equal sets are one; hashes under which the same sets meet are one group.
    Sets that the least hashes rule out go; the texts of the others are compared, those of a
    group's first set with all others that it meets anywhere.
    """
    spark, n = docs.sparkSession, partitions_for(docs.sparkSession)
    sets = made.filter("size > 0")
    reps = sets.groupBy("same").agg(F.min("node").alias("rep"))
    equal = sets.select("node", "same").distinct().join(reps, "same").filter("node <> rep").select(F.col("rep").alias("a"), F.col("node").alias("b"))
    keys = sets.select(F.explode("least").alias("key"), "same").repartition(n, "key").sortWithinPartitions("key", "same")
    members = materialise(keys.mapInArrow(released(_meetings), "grp long, same long").distinct(), "jaccard-groups")
    met = sets.filter(_may_be(spark, members.select("same").distinct())("same")).select("same", "size", "least").dropDuplicates(["same"])
    rows = members.join(met, "same").select("grp", "same", "size", "least").repartition(n, "grp").sortWithinPartitions("grp", "same")
    hopeful = materialise(rows.mapInArrow(released(lambda batches: _hopeful(batches, similarity)), "first long, same long").distinct(), "jaccard-likely")
    forget(members)
    pairs = materialise(hopeful.join(reps, "same").select("first", F.col("rep").alias("node")), "jaccard-pairs")
    forget(hopeful)
    narrow = docs.select(F.xxhash64(text_col).alias("node"), F.col(text_col).alias("text"))
    texts = narrow.filter(_may_be(spark, pairs.select("node").distinct())("node")).groupBy("node").agg(F.min("text").alias("text"))
    rows = pairs.join(texts, "node").select("first", "node", "text").repartition(n, "first").sortWithinPartitions("first", "node")
    found = materialise(rows.mapInArrow(released(lambda batches: _alike(batches, shingle, similarity)), "a long, b long"), "jaccard-links")
    forget(pairs)
    return equal.unionByName(found).distinct()


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay if fingerprints within the radius link; one of each component, as in ``one_of_near``."""
    return one_of_near(docs, id_col, text_col, similarity=None)


def one_of_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float | None = 0.8) -> DataFrame:
    """The rows that stay if fingerprints within the radius and shingle sets of this similarity, if any, both link.

    Of what hangs together, the row with the least (doc_id, text hash) stays; of rows equal in both, one.
    """
    spark = docs.sparkSession
    made = materialise(sketches(docs, id_col, text_col, shingle, similarity), "near-sketches")
    prints = made.select("node", "fp").distinct()
    same = prints.groupBy("fp").agg(F.min("node").alias("rep"))
    equal = prints.join(same, "fp").filter("node <> rep").select(F.col("rep").alias("a"), F.col("node").alias("b"))
    links = equal.unionByName(hamming_links(same))
    if similarity is not None:
        links = links.unionByName(jaccard_links(docs, made, text_col, shingle, similarity))
    links = materialise(links, "near-links")
    roots = connected_components(links, "near-cc")
    rows = made.groupBy("node", "id").agg(F.count(F.lit(1)).alias("n"))
    known_ = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    known_ = known_.join(known_.groupBy("root").agg(F.min(F.struct("id", "node")).alias("first")), "root")
    stays = (F.col("first.node") == F.col("node")) & (F.col("first.id") == F.col("id"))
    # few rows go, or stay as one of several: only those that may be among them shuffle
    doubtful = materialise(known_.withColumn("stays", stays).filter("not stays or n > 1").select("node", "id", "stays"), "near-doubtful")
    forget(made)
    forget(links)
    forget(roots)
    name, node = fresh(docs.columns, "id"), fresh(docs.columns, "node")
    stay = doubtful.filter("stays").select(F.col("node").alias(node), F.col("id").alias(name))
    row = F.xxhash64(F.xxhash64(text_col), _id(id_col))
    may_go = _may_be(spark, doubtful.select(F.xxhash64("node", "id").alias("h")))(row)
    h = fresh([*docs.columns, name, node], "h")
    certain, rest = docs.filter(~may_go), docs.filter(may_go).withColumn(h, F.xxhash64(text_col))
    here = doubtful.select(F.col("node").alias(node), F.col("id").alias(name))
    match = (F.col(h) == F.col(node)) & (_id(id_col) == F.col(name))
    kept = rest.join(stay, match, "left_semi").dropDuplicates([h, id_col]).unionByName(rest.join(here, match, "left_anti"))
    return certain.unionByName(kept.drop(h))
