"""Each operator against a brute-force version, an exact round trip or held-out accuracy."""

import collections
import hashlib
import os
import random
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from threadloom.llm import bitfilter, common, components, decontam, exact_dedup, huffman, langid, line_dedup, packing, queries, sharding, simhash, substring_dedup, toxicity
from threadloom.llm.common import training_fold, workspace
from threadloom.llm.tokenise import WordEncoder, default_tokenizer

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, n_lines string, shard string, key string"


def frame(spark, texts, ids=None):
    """Documents with extra columns whose names clash with what operators add."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", 1, "k", "l", "h", "y") for i, t in zip(ids, texts)], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(5)
    base = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) for _ in range(70)) for _ in range(4)]
    near = base[0].split()
    near[69] = "omega"
    long = " ".join(f"w{i}" for i in range(30_000))
    return [None, "", " \n\t ", "a", "a b", base[0], base[0], " ".join(near), base[1] + "\n" + base[2], base[2], base[3], long, long + " end", "!!! ???", "漢字 かな", base[0].upper(), base[1] + "\n\n" + base[1]]


@pytest.fixture(scope="module")
def documents():
    return pd.read_parquet(f"{SF}/documents.parquet")


# 10


def test_exact_dedup(spark, odd):
    got = {r.doc_id: r for r in exact_dedup.exact_groups(frame(spark, odd)).collect()}
    groups = collections.defaultdict(list)
    for i, t in enumerate(odd):
        groups[t or ""].append(i)
    for i, t in enumerate(odd):
        own = groups[t or ""]
        assert (got[i].keep_id, got[i].group_size, got[i].kept) == (max(own), len(own), i == max(own))
        assert got[i].text_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    kept = exact_dedup.deduplicated(frame(spark, odd + ["a"], [*range(len(odd)), 3]))
    assert kept.count() == len(groups) and kept.columns == frame(spark, odd).columns
    assert exact_dedup.exact_groups(frame(spark, [])).count() == 0


def test_small_filter_is_still_right(spark):
    texts = [str(i % 700) for i in range(1000)]
    got = exact_dedup.exact_groups(frame(spark, texts), max_bits=1 << 8)
    assert got.filter("kept").count() == 700 and got.agg(F.sum("group_size")).first()[0] == 300 * 4 + 400


# 6


def test_sharding(spark, odd):
    texts = (odd * 30)[:500]
    rows = sharding.uniform_shards(frame(spark, texts), 7).collect()
    assert sorted(r.doc_id for r in rows) == list(range(500)) and all(r.text == texts[r.doc_id] for r in rows)
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sharding.uniform_shards(frame(spark, []), 7).count() == 0
    again = sharding.uniform_shards(frame(spark, texts).repartition(5), 7).select("doc_id", "shard", "slot").collect()
    assert {(r.doc_id, r.shard, r.slot) for r in rows} == {tuple(r) for r in again}


def test_communication_matrix():
    m = sharding.communication_matrix([50, 70, 0, 80], [66, 67, 67], 3)
    assert m.sum(axis=1).tolist() == [50, 70, 0, 80] and m.sum(axis=0).tolist() == [66, 67, 67]
    rng = np.random.default_rng(1)
    big = [sharding.hypergeometric(rng, 10**9, 10**9, 1000) for _ in range(400)]
    assert abs(np.mean(big) - 500) < 4 and 13 < np.std(big) < 19


# 8


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if b < a and (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash(spark, odd):
    got = {r.doc_id: r for r in simhash.near_duplicates(frame(spark, odd)).collect()}
    prints = {i: brute_print(t) for i, t in enumerate(odd)}
    assert {i: r.fp & (1 << 64) - 1 for i, r in got.items()} == prints
    assert {i: r.component_id for i, r in got.items()} == brute_components(prints)
    kept = simhash.one_of_each(frame(spark, odd))
    assert {r.doc_id for r in kept.collect()} == set(brute_components(prints).values()) and kept.columns == frame(spark, odd).columns
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


@pytest.mark.parametrize("large", [2, 16, 2048])
def test_hamming_links_lose_none(spark, large):
    rng = random.Random(large)
    base = [rng.getrandbits(64) for _ in range(25)]
    prints = {p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for p in base for _ in range(14)}
    prints |= {base[0] ^ 1 << i ^ 1 << j for i in range(6) for j in range(30, 60)}
    nodes = {i: p for i, p in enumerate(sorted(prints))}
    reps = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p, i) for i, p in nodes.items()], "fp long, rep long")
    roots = {r.node: r.root for r in components.connected_components(simhash.hamming_links(reps, large)).collect()}
    assert {i: roots.get(i, i) for i in nodes} == brute_components(nodes)


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 101), (7, 7)]
    roots = {r.node: r.root for r in components.connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert {roots[i] for i in range(61)} == {0} and roots[102] == 100
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# 3 and 4


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_tokenizer())


def test_encoder_is_exact(tokenizer):
    rng = random.Random(3)
    bits = [" ", "  ", "\n", "\t", "a", "Bc", "ü", "漢字", "🙂", "don't", "12", "'s", "!!", "...", "\x1c", "<|endoftext|>", "é", "ǅ", "​", "²"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(1500)] + [None, "", " "]
    words = WordEncoder(default_tokenizer(), store_entries=200)
    for start in range(0, len(texts), 300):
        part = texts[start : start + 300]
        ids, counts = words.encode(pa.array(part), 9)
        assert np.split(ids, np.cumsum(counts)[:-1])[0].tolist() == tokenizer.encode(part[0] or "", add_special_tokens=False).ids + [9]
        assert ids.tolist() == [i for t in part for i in tokenizer.encode(t or "", add_special_tokens=False).ids + [9]]


def ids_of(tokenizer, text, end):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def test_packing(spark, odd, tokenizer):
    rows = [r.asDict() for r in packing.pack(frame(spark, odd), open_windows=2).collect()]
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for i, t in enumerate(odd):
        ids, at = ids_of(tokenizer, t, 0), 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : at].tobytes())
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    assert packing.pack(frame(spark, [])).count() == 0


def test_open_windows_are_bounded():
    rng, windows, closed = random.Random(2), packing.OpenWindows(100, 4, 0), []
    for i in range(500):
        closed += windows.place((i, 0, rng.randint(1, 99), 0, 0))
        assert len(windows.room) <= 4 and len(windows.held) <= 4
    assert len(closed) + sum(map(len, windows.held.values())) == 500


def test_huffman_round_trip(spark, odd, tokenizer):
    ids = [2**40 if i == 4 else i for i in range(len(odd))]
    rows = huffman.read_ids(*huffman.write_ids(frame(spark, odd, ids))).orderBy("start").collect()
    at = 0
    for r, (doc_id, text) in zip(rows, sorted(zip(ids, odd)), strict=True):
        want = ids_of(tokenizer, text, 2)
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, at, len(want), zlib.crc32(want.tobytes())) and bytes(r.ids) == want.tobytes()
        at += len(want)
    assert huffman.read_ids(*huffman.write_ids(frame(spark, []))).count() == 0


def test_code_lengths():
    rng = np.random.default_rng(4)
    for counts, limit in ((np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55]), 5), (rng.integers(0, 1000, 300), 9), (2 ** np.arange(20), 16), (np.array([0, 7]), 16)):
        lengths = huffman.code_lengths(counts, limit)
        assert lengths.max() <= limit and ((lengths > 0) == (counts > 0)).all()
        assert (counts > 0).sum() < 2 or abs((0.5 ** lengths[lengths > 0]).sum() - 1) < 1e-12
    free = huffman.code_lengths(np.array([1, 1, 2, 4, 8]), 16)
    assert free.tolist() == [4, 4, 3, 2, 1]


# 2


def brute_repeats(texts):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in texts.items()}
    first, out = {}, {}
    for i in sorted(words):
        for s in range(len(words[i]) - 49):
            first.setdefault(tuple(words[i][s : s + 50]), i)
    for i, w in words.items():
        gone = {p for s in range(len(w) - 49) if first[tuple(w[s : s + 50])] < i for p in range(s, s + 50)}
        out[i] = (len(gone), " ".join(x for p, x in enumerate(w) if p not in gone))
    return out


def test_substring_dedup(spark, odd):
    rng = random.Random(9)
    passages = [" ".join(f"p{k}x{rng.randint(0, 9)}" for _ in range(rng.randint(45, 130))) for k in range(6)]
    texts = list(odd)
    for i in range(40):
        parts = [f"u{i}v{j}" for j in range(rng.randint(0, 40))] + rng.choice(passages).split()[rng.randint(0, 20) :] + rng.choice(passages).split(" ")
        texts.append(rng.choice(["  ", " ", "\n"]).join(parts))
    docs = frame(spark, texts)
    got = {r.doc_id: (r.n_removed, r.kept) for r in substring_dedup.kept_texts(docs, substring_dedup.repeated_spans(docs)).collect()}
    for i, want in brute_repeats(dict(enumerate(texts))).items():
        assert got.get(i, (0, want[1])) == want
    assert substring_dedup.repeated_spans(frame(spark, [])).count() == 0


# 5


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def mutate(rng, line, n, letters):
    out = list(line)
    for _ in range(n):
        at = rng.randint(0, len(out))
        if rng.random() < 0.4:
            out.insert(at, rng.choice(letters))
        elif at < len(out):
            out[at : at + 1] = [] if rng.random() < 0.5 else [rng.choice(letters)]
    return "".join(out)


def near(a, b):
    return distance(a, b) <= min(line_dedup.edits_allowed(len(a)), line_dedup.edits_allowed(len(b)))


def test_edit_kernel_and_keys():
    rng = random.Random(1)
    pairs = []
    for _ in range(1500):
        a = "".join(rng.choice("abcé") for _ in range(rng.randint(0, 45)))
        pairs.append((a, mutate(rng, a, rng.randint(0, 4), "abc")))
    want = [near(a, b) for a, b in pairs]
    assert line_dedup.within_edits([a for a, _ in pairs], [b for _, b in pairs]).tolist() == want
    for (a, b), yes in zip(pairs, want):
        if yes and a != b:
            short, long = sorted((a, b), key=len)
            (ks, own), (kl, _) = line_dedup.line_keys(short), line_dedup.line_keys(long)
            assert set(ks[:own]) & set(kl) or (len(a) == len(b) and set(ks) & set(kl))


def brute_lines(texts):
    places = {}
    for i, t in texts.items():
        for k, line in enumerate((t or "").split("\n")):
            if line.strip():
                places.setdefault(line, []).append((i, k))
    lines = list(places)
    root = list(range(len(lines)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(lines):
        for j in range(i):
            if near(a, lines[j]):
                root[find(i)] = find(j)
    classes = collections.defaultdict(list)
    for i, line in enumerate(lines):
        classes[find(i)] += places[line]
    gone = {p for c in classes.values() for p in c if p != min(c)}
    return {i: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in texts.items()}


def test_line_dedup(spark):
    rng = random.Random(6)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(5, 60))) for _ in range(30)]
    texts = [None, "", "\n\n", "x" * 5000, "y" + "x" * 5000]
    for _ in range(90):
        lines = [mutate(rng, rng.choice(base), rng.choice([0, 0, 1, 1, 2, 3]), "xyz") for _ in range(rng.randint(0, 5))]
        texts.append("\n".join(lines + [""] * rng.randint(0, 1)))
    got = {r.doc_id: r.text for r in line_dedup.deduplicate_lines(frame(spark, texts)).collect()}
    assert got == brute_lines(dict(enumerate(texts)))
    assert line_dedup.deduplicate_lines(frame(spark, [])).count() == 0


def test_line_dedup_edits_grow_with_the_line(spark):
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (12, 25, 39, 59, 166, 166, 400)]
    word = base[4][:50] + "zzzzz" + base[4][55:]
    spread = list(base[5])
    for at in range(9, 166, 10):  # 16 edits, no ten characters in a row without one
        spread[at] = "z"
    past = list(base[6])
    for at in range(0, 400, 9):  # 45 edits where 40 are allowed
        past[at] = "z"
    lines = base + [word, "".join(spread), "".join(past)] + [mutate(rng, rng.choice(base), rng.randint(0, 45), "xyz") for _ in range(25)]
    root = list(range(len(lines)))
    for i, a in enumerate(lines):
        for j in range(i):
            if root[i] != root[j] and near(a, lines[j]):
                root = [root[j] if r == root[i] else r for r in root]
    want = {i: line if i == root.index(root[i]) else "" for i, line in enumerate(lines)}
    got = {r.doc_id: r.text for r in line_dedup.deduplicate_lines(frame(spark, lines)).collect()}
    assert got == want and want[7] == want[8] == "" and want[9]


def test_large_key_groups():
    rng = random.Random(8)
    lines = sorted({mutate(rng, "the quick brown fox jumps over it", rng.randint(0, 3), "xyz") for _ in range(80)})
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in ([1] * len(lines), range(len(lines)), lines)], ["grp", "id", "line"])
    links = {(min(a, b), max(a, b)) for out in line_dedup._verify(iter([batch])) for a, b in zip(*(c.to_pylist() for c in out.columns))}
    part = {i: i for i in range(len(lines))}

    def find(i):
        while part[i] != i:
            i = part[i]
        return i

    for a, b in links:
        part[find(a)] = find(b)
    for i, a in enumerate(lines):
        for j in range(i):
            assert not near(a, lines[j]) or find(i) == find(j)


def test_windows_keep_all_but_one_segment_and_shuffles_go(spark):
    rng = random.Random(14)
    for n in (10, 19, 24, 45, 70, 100, 150, 700):
        line = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
        keys, own = line_dedup.line_keys(line)
        segments = line_dedup.segments_of(n)
        assert len(segments) == 4 and own == 4 * line_dedup.windows_of(n) and set(keys[:own]) <= set(keys[own:])
    keys = spark.range(20_000).repartition(5).select(F.concat(F.lit("k"), F.col("id") % 9000).alias("key")).select(F.xxhash64("key").alias("key"))
    seen, again = line_dedup.build(keys, 1 << 16, stored=True)
    plain = line_dedup.build(keys, 1 << 16)
    assert (seen == plain[0]).all() and (again == plain[1]).all() and (bitfilter.unpacked(bitfilter.packed(seen)) == seen).all()
    hot = spark.range(line_dedup.BLOCK + 1).select(F.lit(7).cast("long").alias("key")).unionByName(keys)
    assert [(r.key, r.n >= line_dedup.BLOCK + 1) for r in line_dedup._large_keys(hot).collect()] == [(7, True)]


def test_late_lines_of_a_large_group_meet():
    rng = random.Random(12)
    lines = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(30)) for _ in range(line_dedup.BLOCK + 40)]
    lines.append(lines[-1][:-1] + "#")  # both come after the first block's worth of lines
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in ([1] * len(lines), range(len(lines)), lines)], ["grp", "id", "line"])
    links = [sorted(x) for out in line_dedup._verify(iter([batch])) for x in zip(*(c.to_pylist() for c in out.columns))]
    assert links == [[len(lines) - 2, len(lines) - 1]]


def test_line_stage_loses_no_pair_of_a_large_group(spark):
    import corpus_pipeline

    rng = random.Random(13)
    lines = []
    for _ in range(1250):  # same letters everywhere; of a pair only the beginning, which all lines share, has an unchanged window
        tail = rng.sample("abcdefghijklmnopqrstuvwxyz01", 28)
        other = list(tail)
        for at in (3, 8, 16, 21):
            other[at] = "#"
        lines += ["the same start" + "".join(tail), "the same start" + "".join(other)]
    kept = corpus_pipeline.line_stage(spark, frame(spark, lines).withColumn("n_chars", F.length("text").cast("long")), SF)
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == list(range(0, len(lines), 2))


def full_collections(spark):
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    return sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())


def test_line_rounds_give_the_drivers_heap_back(spark):
    rng, before = random.Random(15), full_collections(spark)
    lines = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(60)) for _ in range(20)]
    rows = line_dedup._rows(frame(spark, lines + [x[:-1] + "#" for x in lines]), "doc_id", "text")
    seen = line_dedup.occurrences(rows)
    assert line_dedup.near_lines(rows, seen).count() == 40
    assert full_collections(spark) > before


def test_give_back_reaches_the_executors(spark):
    context = spark.sparkContext
    context.setJobGroup("give back", "")
    common.give_back(spark)
    context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("give back") for s in tracker.getJobInfo(job).stageIds]
    assert sum(tracker.getStageInfo(s).numTasks for s in stages) >= context.defaultParallelism


def test_groups_of_the_same_lines_go_on_once():
    key, counts = np.repeat(np.arange(6), [2, 3, 2, 2, 3, 2]), np.zeros(14, np.int64)
    ident = np.array([5, 9, -3, 5, 9, 5, 9, -3, 5, -3, 5, 9, 5, 9])
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in (key, ident, counts, np.full(14, 20, np.int32), np.arange(14) % 2 == 0)], ["key", "id", "counts", "length", "probe"])
    rows = pa.Table.from_batches(line_dedup._prune(iter([batch])))
    assert rows.num_rows < 6
    twice = pa.concat_tables([rows, rows]).sort_by([("x", "ascending"), ("y", "ascending"), ("n", "ascending")])
    got = collections.defaultdict(list)
    for out in line_dedup._once(iter(twice.to_batches(max_chunksize=2))):
        for grp, least, n, i in zip(*(c.to_pylist() for c in out.columns)):
            got[grp, least, n].append(i)
    assert sorted(x[1:] + (i,) for x, i in ((x, tuple(i)) for x, i in got.items())) == [(-3, 2, (-3, 5)), (-3, 3, (-3, 5, 9)), (5, 2, (5, 9))]


def test_long_lines_are_compared_in_bounded_slices(monkeypatch):
    seen, whole = [], line_dedup.within_edits
    monkeypatch.setattr(line_dedup, "within_edits", lambda a, b: seen.append(sum(map(len, [*a, *b]))) or whole(a, b))
    links = line_dedup.Links()
    for i in range(20):
        links.add(2 * i, 2 * i + 1, "a" * 200_000, "a" * 199_999 + "b" if i % 3 else "b" * 200_000)
    assert links.compare() == [(2 * i, 2 * i + 1) for i in range(20) if i % 3]
    assert len(seen) > 1 and max(seen) <= 1 << 21


def test_hubs_first_then_what_hangs_apart(spark):
    rng = random.Random(16)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(40)) for _ in range(4)]
    lines = sorted({mutate(rng, rng.choice(base), rng.randint(0, 5), "xyz") for _ in range(90)})
    groups = [sorted(rng.sample(range(len(lines)), rng.randint(2, 30))) for _ in range(25)]

    def batches(rows, names, size):
        columns = [pa.array(c) for c in zip(*rows)]
        whole = pa.RecordBatch.from_arrays(columns, names)
        return iter([whole.slice(k, size) for k in range(0, len(rows), size)])

    def joined(links, root=()):
        part = dict(root) or {i: i for i in range(len(lines))}
        for a, b in links:
            low, high = sorted((part[a], part[b]))
            part = {i: low if r == high else r for i, r in part.items()}
        return part

    def links(out):
        return [x for batch in out for x in zip(*(c.to_pylist() for c in batch.columns))]

    hubs = sorted({(g[0], i) for g in groups for i in g})
    roots = joined(links(line_dedup._stars(batches([(h, i, lines[i]) for h, i in hubs], ["least", "id", "line"], 7))))
    rest = [(k, i, lines[i], roots[i]) for k, g in enumerate(groups) for i in g]
    got = joined(links(line_dedup._verify(batches(rest, ["grp", "id", "line", "root"], 11), settled=True)), roots)
    want = joined([(a, b) for g in groups for a in g for b in g if a < b and near(lines[a], lines[b])])
    assert got == want and len(set(want.values())) < len(set(roots.values()))


# 8, as the pipeline uses it


def test_near_copy_stage_finds_scattered_edits(spark):
    import corpus_pipeline

    rng, texts = random.Random(3), []
    for _ in range(12):
        words = [f"w{rng.randint(0, 500)}" for _ in range(200)]
        texts.append(" ".join(words))
        for edits in (1, 2, 4, 6):
            copy = list(words)
            for _ in range(edits):
                copy[rng.randrange(200)] = f"z{rng.randint(0, 500)}"
            texts.append(" ".join(copy))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    fingers, root = [simhash.fingerprint(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if root[i] != root[j] and (len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) or (fingers[i] ^ fingers[j]).bit_count() <= 3):
                root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
    got = corpus_pipeline.near_copy_stage(spark, frame(spark, texts), SF)
    assert {r.doc_id for r in got.collect()} == set(root) and len(set(root)) < 25


def stored_bytes(spark):
    folder = workspace(spark).removeprefix("file://")
    return sum(os.path.getsize(f"{d}/{x}") for d, _, names in os.walk(folder) for x in names)


@pytest.mark.parametrize("stage", ["line_stage", "near_copy_stage"])
def test_stages_leave_little_in_the_shared_folder(spark, stage):
    import corpus_pipeline

    rng = random.Random(31)
    texts = ["\n".join(" ".join(f"{rng.getrandbits(40):x}" for _ in range(40)) for _ in range(10)) for _ in range(120)]
    texts += [texts[0] + " end", texts[1]]
    docs = frame(spark, texts).withColumn("n_chars", F.length("text").cast("long"))
    before = stored_bytes(spark)
    kept = getattr(corpus_pipeline, stage)(spark, docs, SF)
    assert stored_bytes(spark) - before < 0.1 * sum(map(len, texts))
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == list(range(120))


def test_filters_come_one_at_a_time(spark):
    keys = spark.range(9000).select(F.xxhash64(F.col("id") % 6000).alias("key"))
    seen, again = bitfilter.build(keys, 1 << 18)
    stored = exact_dedup_cache(bitfilter.ranges(keys, 1 << 18))
    assert (bitfilter.fetched(stored, 1 << 18, "seen") == seen).all() and (bitfilter.fetched(stored, 1 << 18, "again") == again).all()
    folded = np.bitwise_or.reduce(again.reshape(bitfilter.HASHES, 4, -1), axis=1).ravel()
    assert (bitfilter.fetched(stored, 1 << 18, "again", 1 << 16) == folded).all()


def test_near_copies_in_small_groups_of_a_stage(spark):
    rng = random.Random(32)
    words = [f"w{i}" for i in range(3000)]
    base, texts = [[rng.choice(words) for _ in range(60)] for _ in range(15)], []
    for x in base:
        for _ in range(5):
            y = list(x)
            for _ in range(rng.randint(0, 2)):
                y[rng.randrange(60)] = rng.choice(words)
            texts.append(" ".join(y))
    texts += [texts[0].replace(" ", "\n"), texts[0].upper(), texts[5], "same words at the start of each text " + texts[9], None, ""]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in ((t or "").lower().split() for t in texts)]
    fingers, root = [simhash.fingerprint(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            near_ = sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
            if root[i] != root[j] and (near_ or (fingers[i] ^ fingers[j]).bit_count() <= 3):
                root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
    kept = simhash.one_of_near(frame(spark, texts + texts[3:5], [*range(len(texts)), 3, 4]))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root)) and kept.columns == frame(spark, []).columns


# 9


def test_decontamination(spark, documents):
    items = pd.read_parquet(f"{SF}/benchmark.parquet")
    rng, texts = random.Random(2), documents.text.tolist()[:120]
    for k in range(100):
        item = rng.choice(items.text.tolist()).split()
        for _ in range(rng.randint(0, 2)):
            item[rng.randrange(len(item))] = "zzz"
        words = texts[k].split(" ")
        at = rng.randint(0, len(words))
        texts[k] = " ".join(words[:at] + item + words[at:])
    texts += [None, "", "one two", items.text[0], items.text[1].upper()]

    def shingles(t):
        w = re.findall(r"[^\W_]+", (t or "").lower())
        return [tuple(w[i : i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else [])

    bench = {i: shingles(t) for i, t in zip(items.item_id, items.text)}
    want = {}
    for d, t in enumerate(texts):
        own = shingles(t)
        for i, item in bench.items():
            if len(set(own) & set(item)) < 0.8 * len(set(item)) * 0.8:
                continue
            best = max((collections.Counter(item) & collections.Counter(own[s : s + len(item)])).total() / (collections.Counter(item) | collections.Counter(own[s : s + len(item)])).total() for s in range(len(own)))
            if best >= 0.8:
                want[d, i] = round(best, 9)
    bench_df = spark.createDataFrame(items)
    got = {(r.doc_id, m.item_id): round(m.similarity, 9) for r in decontam.leaks(frame(spark, texts), bench_df).collect() for m in r.matches}
    assert got == want and len(want) > 40
    kept = decontam.decontaminated(frame(spark, texts), bench_df)
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {d for d, _ in want}
    assert decontam.leaks(frame(spark, texts[:2]), bench_df.limit(0)).filter("size(matches) > 0").count() == 0


def leaks_at_the_end(shingles, trials=150):
    """Texts that end with an item whose first words are changed down to a similarity of 0.8, and how many are found."""
    rng, found = random.Random(shingles), 0
    words = shingles + 4
    spared = int(np.floor(shingles * (1 - 0.8) / (1 + 0.8)))
    for _ in range(trials):
        item = [f"i{rng.randint(0, 9999)}" for _ in range(words)]
        text = [f"t{rng.randint(0, 9999)}" for _ in range(101)] + ["zz"] * spared + item[spared:]
        index = decontam.LeakIndex([(1, " ".join(item))])
        found += bool(index.find(pa.array([" ".join(text)]))[0])
    return found, trials


@pytest.mark.parametrize("shingles", [33, 50])
def test_leaks_at_the_end_of_a_text(shingles):
    found, trials = leaks_at_the_end(shingles)
    assert found >= 0.97 * trials  # fingerprints' noise is left


def similarity_of(a, b):
    a, b = (collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) for w in (a, b))
    return (a & b).total() / (a | b).total()


def test_benchmark_stage_drops_leaks_beyond_the_radius(spark):
    import corpus_pipeline

    rng, items, texts = random.Random(42), [], []
    for n in (33, 90):
        for _ in range(150):
            item = [f"i{rng.randint(0, 10**6)}" for _ in range(n)]
            leak, past = list(item), list(item)
            for _ in range(60):
                other = list(leak)
                other[rng.randrange(n)] = f"z{rng.randint(0, 10**6)}"
                if similarity_of(other, item) >= 0.8:
                    leak = other
            past[:: n // 6] = ["zz"] * len(past[:: n // 6])
            around = [[f"t{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 200))] for _ in range(4)]
            items.append((len(items), " ".join(item)))
            texts += [" ".join(around[0] + leak + around[1]), " ".join(around[2] + past + around[3])]
    spark.createDataFrame(items, "item_id long, text string").write.mode("overwrite").parquet("/tmp/threadloom-test/benchmark.parquet")
    kept = corpus_pipeline.benchmark_stage(spark, frame(spark, texts), "/tmp/threadloom-test")
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == list(range(1, len(texts), 2))


@pytest.mark.parametrize("found", [1 << 20, 3])
def test_exact_leak_search(found, monkeypatch):
    monkeypatch.setattr(decontam, "FOUND", found)
    rng = random.Random(24)
    items = [[rng.choice("abc") for _ in range(rng.randint(1, 60))] for _ in range(25)]
    texts = []
    for _ in range(60):
        words = [rng.choice("abcdef") for _ in range(rng.randint(0, 80))]
        at, item = rng.randint(0, len(words)), list(rng.choice(items))
        for _ in range(rng.randint(0, 3)):
            item[rng.randrange(len(item))] = "z"
        texts.append(words[:at] + item + words[at:])
    index = decontam.LeakIndex([(i, " ".join(x)) for i, x in enumerate(items)], radius=0)
    for text, got in zip(texts, index.find(pa.array(" ".join(x) for x in texts), exact=True)):
        want = {}
        for i, item in enumerate(items):
            n = max(5, len(item))
            best = max((round(similarity_of(text[s : s + n], item), 9) for s in range(max(1, len(text) - 4))), default=0)
            if best >= 0.8:
                want[i] = best
        assert {m["item_id"]: round(m["similarity"], 9) for m in got} == want


def test_hamming_blocks_guarantee_the_radius():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 20).astype(np.uint64)
    c = decontam.SizeClass(20, 1, list(range(20)), base, 16)
    prints = base.copy()
    for i in range(20):
        for b in rng.choice(64, 16, replace=False):
            prints[i] ^= np.uint64(1) << np.uint64(b)
    at, item = c.within(prints)
    assert {(i, i) for i in range(20)} <= set(zip(at.tolist(), item.tolist()))


# 7 and 1


def test_chain_marginals():
    rng = np.random.default_rng(0)
    emit, trans, first = rng.normal(size=(150, 3)), rng.normal(size=(3, 3)), np.zeros(150, bool)
    first[[0, 5, 6, 70]] = True
    got, move = langid.marginals(emit, trans, first, 16), np.exp(trans)
    for a, b in zip([0, 5, 6, 70], [5, 6, 70, 150]):
        x = np.exp(emit[a:b])
        alpha, beta = [x[0]], [np.ones(3)]
        for t in range(1, b - a):
            alpha.append((alpha[-1] @ move) * x[t])
            beta.insert(0, move @ (x[b - a - t] * beta[0]))
        want = np.array(alpha) * np.array(beta)
        assert np.allclose(got[a:b], want / want.sum(axis=1, keepdims=True))


def test_language_accuracy(spark, documents, odd):
    docs = spark.createDataFrame(documents)
    model = langid.fit(langid.training_spans(docs.filter(training_fold("doc_id")), "text", "lang", "doc_id"))
    got = langid.identify(docs, model).toPandas().merge(documents, on="doc_id")
    held = got[[zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]]
    assert (held.lang_pred == held.lang).mean() > 0.95 and got.score.between(0, 1).all()
    other = {r.doc_id: r for r in langid.identify(frame(spark, odd), model, with_runs=True).collect()}
    assert [i for i in range(len(odd)) if other[i].lang_pred == "und"] == [0, 1, 2, 13]
    assert sum(run.words for run in other[11].runs) == other[11].n_words == 30_000
    assert langid.identify(frame(spark, odd), None).filter("lang_pred <> 'und'").count() == 0
    kept = langid.identified(frame(spark, odd), model, 0.0)
    assert kept.count() == len(odd) - 4 and kept.columns == frame(spark, odd).columns
    mixed = documents[documents.lang == "en"].text.iloc[0][:600] + " " + documents[documents.lang == "de"].text.iloc[0][:600]
    runs = langid.identify(frame(spark, [mixed]), model, with_runs=True).first().runs
    assert runs[0].lang == "en" and runs[-1].lang == "de"


def test_toxicity_held_out(spark, odd):
    sf = "/root/testdata/sf0.01"
    got = queries.op1_toxicity(spark, sf).toPandas()
    labels = pd.read_parquet(f"{sf}/labels.parquet").merge(got, on="doc_id")
    held = labels[labels.held_out]
    assert held[held.toxic == 1].predicted.mean() > 0.6 and held[held.toxic == 0].predicted.mean() < 0.05
    assert got.score.between(0, 1).all() and ((got.score >= 0.7) == (got.predicted == 1)).all()
    assert toxicity.score(frame(spark, odd), None).filter("score > 0").count() == 0
    assert toxicity.fit([], [], 0.1) is None


def test_pipeline(spark):
    import corpus_pipeline

    rows = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = rows.columns, [rows.count()]
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, SF)
        if name != "packing":
            assert rows.columns == columns
        rows = exact_dedup_cache(rows)
        counts.append(rows.count())
    assert counts[1] > 0.95 * counts[0] and counts[-2] <= counts[-3] <= counts[-4] <= counts[1]
    assert rows.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0


def exact_dedup_cache(rows):
    from threadloom.llm.common import materialise

    return materialise(rows, "test")


# rows that share an id, and rows without one


def test_line_dedup_rows_that_share_an_id(spark):
    rows = [(1, "the quick brown fox jumps"), (2, "the quick brown fox jumps"), (2, "completely different unique line here"), (None, "a line that only the row without an id has"), (None, None), (2, "completely different unique line here")]
    got = line_dedup.deduplicate_lines(frame(spark, [t for _, t in rows], [i for i, _ in rows]))
    want = [(1, "the quick brown fox jumps"), (2, ""), (2, rows[2][1]), (2, rows[2][1]), (None, rows[3][1]), (None, None)]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(want, key=str)


def test_substring_dedup_rows_that_share_an_id(spark):
    shared, own = " ".join(f"s{i}" for i in range(60)), " ".join(f"o{i}" for i in range(60))
    docs = frame(spark, [shared, shared, own, own, None], [1, 2, 2, 2, None])
    docs.select("doc_id", "text").write.mode("overwrite").parquet("/tmp/threadloom-test/documents.parquet")
    got = queries.op2_substring_dedup(spark, "/tmp/threadloom-test").collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in got) == [(0, 0, 0), (1, 60, 0), (2, 60, 0), (2, 60, 0), (2, 60, 60)]


def test_periodic_texts_take_linear_time(spark):
    texts = [" ".join(["a", "b", "c"] * 8000), " ".join(["a", "b", "c"] * 9000)]
    spans = {r.doc_id: [(s.a, s.b) for s in r.spans] for r in substring_dedup.repeated_spans(frame(spark, texts)).collect()}
    assert {i: substring_dedup.merged(s) for i, s in spans.items()} == {1: [(0, 27000)]}


def test_simhash_rows_without_or_with_shared_ids(spark):
    texts, ids = ["one text of some words here", "one text of some words here", "quite another text with words", "a third of them stands alone"], [None, 7, 7, 7]
    got = simhash.near_duplicates(frame(spark, texts, ids)).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == sorted([(None, None), (7, None), (7, 7), (7, 7)], key=str)
    kept = simhash.one_of_each(frame(spark, texts, ids))
    assert sorted(r.text for r in kept.collect()) == sorted({*texts})


def test_every_language_is_learned(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(f"{x}{y}", " ".join(f"{x}{y}{x}{k}{y}" for k in letters)) for x in letters[:10] for y in letters[10:17]]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    assert len({lang for lang, _ in langid.training_spans(docs, "text", "lang", "doc_id")}) == 70


def test_risk_and_gradient_of_pu_learning():
    """One step of one classifier goes against the gradient of the risk as written down."""
    rng = np.random.default_rng(2)
    toxic = [np.unique(rng.integers(0, 6, 4)) for _ in range(40)]
    unlabelled = [np.unique(rng.integers(4, 30, 4)) for _ in range(120)]
    model = toxicity.fit(toxic, unlabelled, 0.2, members=1, steps=1, rate=0.01, decay=0.0)
    assert len(model.features)
    rng = np.random.default_rng(5)
    rows = [np.isin(model.features, x).astype(float) for x in toxic], [np.isin(model.features, x).astype(float) for x in unlabelled]
    p, u = (np.array(x)[rng.integers(len(x), size=len(x))] for x in rows)

    def risk(w):
        logit = lambda x: x @ w[:-1] + w[-1]
        loss = lambda z: np.log1p(np.exp(-z)).mean()
        corrected = loss(-logit(u)) - 0.2 * loss(-logit(p))
        return 0.2 * loss(logit(p)) + corrected if corrected >= 0 else -corrected

    start = np.append(np.zeros(len(model.features)), np.log(0.2 / 0.8))
    slope = np.array([(risk(start + e) - risk(start - e)) / 2e-5 for e in 1e-5 * np.eye(len(start))])
    step = np.append(model.weights, model.bias) - start
    sure = np.abs(slope) > 1e-4
    assert sure.any() and (np.sign(step[sure]) == -np.sign(slope[sure])).all()


def test_shuffle_is_uniform(spark):
    """Over many seeds, every row comes to every shard about equally often."""
    docs = frame(spark, [str(i) for i in range(40)]).coalesce(1).cache()
    counts = np.zeros((40, 4))
    for seed in range(60):
        for r in sharding.uniform_shards(docs, 4, seed).select("doc_id", "shard").collect():
            counts[r.doc_id, r.shard] += 1
    chi = ((counts - 15) ** 2 / 15).sum()
    assert 60 < chi < 190  # 120 degrees of freedom


def test_best_fit_and_fullest_out():
    rng = random.Random(4)
    windows, slow, closed = packing.OpenWindows(100, 3, 0), {}, {}
    for i in range(500):
        size, out = rng.randint(1, 99), None
        fits = [w for w, used in slow.items() if used + size <= 100]
        if fits:
            at = max(fits, key=lambda w: (slow[w], -w))
        else:
            if len(slow) == 3:
                out = max(slow, key=lambda w: (slow[w], -w))
                closed[out] = slow.pop(out)
            at = len(slow) + len(closed)
            slow[at] = 0
        slow[at] += size
        got = windows.place((i, 0, size, 0, size))
        if slow[at] == 100:
            closed[at] = slow.pop(at)
        assert {w for _, w in windows.room} == set(slow) and all(100 - room == slow[w] for room, w in windows.room)
        assert out is None or out in {x[5] for x in got}


def test_line_stage_keeps_columns_named_like_its_counts(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "a line of its own\nshared line of some length", 99, "x", 5), (2, None, 98, "y", 0)], "doc_id long, text string, _n_lines int, _n_removed string, n_chars long")
    kept = {r.doc_id: r for r in corpus_pipeline.line_stage(spark, docs, SF).collect()}
    assert [(kept[i]["_n_lines"], kept[i]["_n_removed"]) for i in (1, 2)] == [(99, "x"), (98, "y")] and kept[2].n_chars is None


def test_language_stage_starts_and_scores_from_collected_heaps(spark, monkeypatch):
    import corpus_pipeline

    told, fit = [], langid.fit
    monkeypatch.setattr(corpus_pipeline, "give_back", lambda spark: told.append("heaps"))
    monkeypatch.setattr(langid, "fit", lambda spans: told.append("fit") or fit(spans))
    docs = spark.createDataFrame([(i, "the cat sat on the mat", "en") for i in range(6)], "doc_id long, text string, lang string")
    assert corpus_pipeline.language_stage(spark, docs, SF).count() == 6
    assert told == ["heaps", "fit", "heaps"]


def signed_rows(lines):
    made, ident = line_dedup.LineKeys(lines), np.arange(len(lines))
    key, owner, after, tests = made.own_rows()
    own = line_dedup._signed_rows(ident, lines, key, owner, after, tests, False)
    key, owner, after = (np.concatenate(x) for x in zip(*made.probe_rows()))
    probes = line_dedup._signed_rows(ident, lines, key, owner, after, np.ones(len(key), bool), True)
    return pa.Table.from_batches([own, probes]).sort_by([("key", "ascending"), ("id", "ascending")])


def candidates(rows):
    return sum(x.num_rows for x in line_dedup._prune(iter(rows.combine_chunks().to_batches())))


def test_letters_after_a_window_lose_no_pair():
    rng, pairs = random.Random(19), 0
    for _ in range(300):
        n = rng.choice([30, 60, 100, 140, 200, 400])
        short = "".join(rng.choice("abcdefghijklmnop    ") for _ in range(n))
        long = list(short)
        for at in sorted(rng.sample(range(n), n // 10) if rng.random() < 0.5 else [k * 10 + rng.randrange(3) for k in range(n // 10)], reverse=True):
            long[at : at + 1] = rng.choice([["#"], [], [long[at], "#"]])
        lines = [short, "".join(long)]
        if line_dedup.within_edits(lines[:1], lines[1:])[0]:
            pairs += 1
            assert candidates(signed_rows(lines if rng.random() < 0.5 else lines[::-1]))
    assert pairs > 150


def test_lines_that_share_a_window_by_chance_are_told_apart():
    rng = random.Random(20)
    shared, found, before = "".join(rng.choice("abcdefghij") for _ in range(25)), 0, 0
    for _ in range(20):  # the same letters in another order, so that whole lines tell nothing
        rest = [rng.choice("abcdefghijklmnopqrst") for _ in range(275)]
        lines = [shared + "".join(sorted(rest)), shared + "".join(sorted(rest, reverse=True))]
        rows = signed_rows(lines)
        found, before = found + candidates(rows), before + candidates(rows.select(["key", "id", "counts", "length", "probe"]))
    assert before >= 20 and found <= before // 4


# a round of line dedup reads and runs no more than it needs


def test_lines_are_stored_by_length(spark, monkeypatch):
    import pyarrow.parquet as pq

    monkeypatch.setattr(line_dedup, "GROUP_BYTES", 1 << 14)
    rng = random.Random(21)
    texts = ["\n".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(12, 400))) for _ in range(20)) for _ in range(60)]
    texts += texts[:20]
    rows = line_dedup._rows(frame(spark, texts), "doc_id", "text")
    lines = line_dedup.comparable_lines(rows, line_dedup.occurrences(rows))
    assert sorted((r.line, r.n) for r in lines.collect()) == sorted((x, len(x)) for x in {x for t in texts for x in t.split("\n")})
    files = [pq.ParquetFile(x.removeprefix("file://").removeprefix("file:")).metadata for x in lines.inputFiles()]
    groups = [m.row_group(g).column(m.schema.names.index("n")).statistics for m in files for g in range(m.num_row_groups)]
    assert len(groups) > 2 * len(files)
    assert sum(g.min < 40 for g in groups) < len(groups) / 2


def test_filters_take_hashes_that_a_task_makes(spark):
    rows = spark.range(3000).select((F.col("id") % 2000).alias("x"))

    def made(batch):
        yield batch.column(0).to_numpy() * 7
        yield batch.column(0).to_numpy()[:0]

    def bits(table):
        return sorted((r.seg, bytes(r.seen), bytes(r.again)) for r in table.collect())

    assert bits(bitfilter.ranges(rows, 1 << 16, made)) == bits(bitfilter.ranges(rows.select(F.col("x") * 7), 1 << 16))


def test_tasks_collect_without_walking_what_is_loaded(spark):
    def run(batches):
        import gc

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([gc.get_freeze_count()] * batch.num_rows, pa.int64())], ["n"])

    counts = [spark.range(0, 8, 1, 8).coalesce(1).mapInArrow(common.released(run), "n long").collect()[0].n for _ in range(6)]
    assert max(counts) > 1000
