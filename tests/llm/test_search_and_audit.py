"""Operators 11 to 13 against brute-force versions on odd rows."""

import collections
import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from threadloom.llm import filter_audit, inner_product, lexical

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts_of(seed, n):
    rng = random.Random(seed)
    vocabulary = ["alpha", "Beta", "GAMMA", "d1", "été", "漢字", "x#y", "İzmir", "a|b", "ß", "naïve", " ", "\u0085q"]
    return ["".join(rng.choice(vocabulary) + rng.choice([" ", "\n", "  ", "\t", ".", "\x1c"]) for _ in range(rng.choice([0, 1, 3, 40, 60, 120]))) for _ in range(n)]


# 11


def audit_by_force(rows, labels):
    texts = [(i, t or "", s or "") for i, t, s in rows]
    fails = []
    for i, t, s in texts:
        w = WORDS.findall(t)
        f = "A" * (len(w) < 50) + "B" * (100 * len(set(w)) < 65 * len(w)) + "C" * (100 * len(re.findall("[A-Z]", t)) > 5 * len(t)) + "D" * bool(re.search("[#$%&*|]", t))
        f += "E" * (i is not None and any(j is not None and j < i and u == t for j, u, _ in texts))
        good, toxic = (any(d == i and i is not None and lab[k] == 1 for d, *lab in labels) for k in (0, 1))
        fails.append((s, f, good, toxic))
    out, shapley = {}, collections.Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        for part in {f[0] for f in fails}:
            left = [f for f in fails if f[0] == part]
            for step, letter in enumerate(order, 1):
                gone = [f for f in left if letter in f[1]]
                redundant = sum(f[0] == part and letter in f[1] for f in fails) - len(gone)
                left = [f for f in left if letter not in f[1]]
                alone = sum(f[0] == part and f[1] == letter for f in fails)
                out[part, order, step] = [len(left), len(gone), redundant, alone, sum(f[2] for f in gone), sum(f[3] for f in gone)]
                shapley[part, letter] += len(gone)
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


DOCS = "doc_id long, text string, source string, part string, mask int, sha string, first int, good int"


def documents(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, "s", 2, 3) for r in rows], DOCS).repartition(3)


def test_audit(spark):
    texts = [None, "", " \n", "a", "A# b", *texts_of(3, 20)] * 2
    rows = [(i, t, [None, "", "s1", "s2"][i % 4]) for i, t in enumerate(texts)]
    rows += [(None, texts[7], "s1"), (None, None, None), (3, texts[3], "s1"), (7, texts[7], "s3"), (60, "word " * 5000, "s3")]
    labels = [(0, 1, 0), (1, 0, 1), (1, None, None), (7, 1, 1), (7, 0, 0), (9, None, 1), (None, 1, 1), (500, 1, 1)]
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(documents(spark, rows), said)
    result = got.collect()
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in result} == audit_by_force(rows, labels)
    assert len(result) == 600 * len({r[2] or "" for r in rows})
    assert filter_audit.audit(documents(spark, []), said).count() == 0
    alone = filter_audit.audit(documents(spark, rows[:3]), said.limit(0)).collect()
    assert alone and not any(r.good_lost or r.toxic_lost for r in alone)


def test_audit_of_many_copies(spark):
    rows = [(i, "same text", "s") for i in range(3000)] + [(5000 + i, f"{i} other", "t") for i in range(200)]
    got = filter_audit.audit(documents(spark, rows), spark.createDataFrame([], "doc_id long, quality int, toxic int")).filter("filter_order = 'EABCD'").collect()
    assert {(r.part, r.step): (r.kept, r.removed) for r in got if r.step < 3} == {("s", 1): (1, 2999), ("s", 2): (0, 1), ("t", 1): (200, 0), ("t", 2): (0, 200)}


def test_outcome_matrices_add_up():
    m = filter_audit.outcome_matrices()
    assert m["kept"].shape == (32, 600)
    assert (m["removed"].reshape(32, 120, 5).sum(axis=2) == (np.arange(32) > 0)[:, None]).all()
    assert (m["removed"] + m["redundant"] <= 1).all()
    per_filter = {f: m["shapley"].reshape(32, 120, 5)[:, 0, k] for k, f in enumerate("ABCDE")}
    assert (sum(per_filter.values()) == np.where(np.arange(32) > 0, 120, 0)).all()


# 12


def ranked_by_force(docs, items, k):
    held = [(i, collections.Counter(TERMS.findall((t or "").translate(LOWER)))) for i, t in docs]
    n, total = sum(bool(c) for _, c in held), sum(c.total() for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    asked = collections.defaultdict(set)
    for i, t in items:
        asked[i] |= set(TERMS.findall((t or "").translate(LOWER)))
    out = []
    for item, terms in asked.items():
        found = []
        for i, c in held:
            m = 50 + (50 * c.total() * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [1 << 20, 7])
def test_lexical_search(spark, monkeypatch, block):
    monkeypatch.setattr(lexical, "BLOCK_TERMS", block)
    texts = [None, "", "...", *texts_of(5, 60), "alpha " * 30_000 + "rare", "alpha rare"]
    docs = [(i, t) for i, t in enumerate(texts)] + [(i + 100, "alpha beta tied") for i in range(90)] + [(None, "tied"), (3, "tied again"), (3, "tied again")]
    items = [(1, "alpha BETA"), (2, None), (3, "..."), (4, "nothing of it: zzz"), (5, "tied"), (None, "rare 漢字"), (6, "d1"), (6, "été naïve"), *((10 + i, t) for i, t in enumerate(texts_of(8, 5)))]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item string, score int").repartition(5)
    index = lexical.build_index(frame)
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, rank int")
    for k in (1, 5, 50):
        got = [tuple(r) for r in lexical.search(index, asked, k).collect()]
        assert sorted(got, key=str) == ranked_by_force(docs, items, k)
    assert lexical.search(index, asked.limit(0)).count() == 0
    assert lexical.search(lexical.build_index(frame.limit(0)), asked).count() == 0


def test_bounds_in_pieces(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(texts_of(9, 80))), "doc_id long, text string").coalesce(1)
    row = lexical.build_index(docs).segments.first().asDict()
    row["terms"] = pa.array(row["terms"])
    asked = lexical._Asked([1, 2, 3], [["alpha", "d1", "zzz"], ["beta"], ["gamma", "été", "alpha"]])
    asked.weights[:] = np.arange(1, len(asked.terms) + 1)
    seg = lexical._Segment(row, asked)
    whole = [x for x in seg.bounds(np.array([0, 2]))]
    monkeypatch.setattr(lexical, "CELLS", 90)  # an item at a time, its postings in pieces
    parts = [x for x in seg.bounds(np.array([0, 2]))]
    assert len(whole) == 1 and len(parts) == 2
    for k in (2, 3):
        assert (np.concatenate([p[k] for p in parts]) == whole[0][k]).all() and whole[0][k].any()
    assert (whole[0][2].max(axis=1) <= seg.best(3)[[0, 2]]).all()


def test_impacts_are_bounded_by_their_bytes():
    tf, m = np.repeat([1, 2, 7, 1000, 10**9], 4), np.tile([50, 51, 10_000, 10**9], 5)
    exact = lexical.impact(tf, m)
    byte = -(-exact // lexical.STEP)
    assert byte.max() <= 255 and (byte * lexical.STEP >= exact).all() and (np.maximum(byte - 1, 0) * lexical.STEP <= exact).all()


# 13


def products_by_force(rows, queries, k, scale=256):
    def clean(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return tuple(math.floor(scale * float(np.float32(x))) for x in v)

    held = [(i, clean(v)) for i, v in rows]
    out = []
    for q, x in {(i, clean(v)) for i, v in queries}:
        if x is None or q is None:
            continue
        found = sorted((-sum(a * b for a, b in zip(x, y)), i is None, i or 0) for i, y in held if y is not None and len(y) == len(x) and i != q)
        out += [(q, r, None if none else i, -s) for r, (s, none, i) in enumerate(found[:k], 1)]
    return sorted(out, key=str)


VECTORS = "vec_id long, embedding array<float>, score int, query_id string"


def vector_rows(seed, n, dim, spread):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in v]) for i, v in enumerate((rng.normal(size=(n, dim)) * rng.lognormal(0, spread, (n, 1))).astype(np.float32))]


@pytest.mark.parametrize("spread", [0.0, 1.5])
def test_inner_products(spark, monkeypatch, spread):
    monkeypatch.setattr(inner_product, "QUERY_VALUES", 60)  # several blocks of queries
    rows = vector_rows(1, 400, 12, spread)
    rows += [(1000 + i, rows[50][1]) for i in range(60)]  # copies of a query
    rows += [(2000, None), (2001, []), (2050, []), (2002, [None] * 12), (2003, [float("nan")] * 12), (2004, [float("inf")] + [0.0] * 11), (None, rows[3][1]), (None, rows[50][1])]
    rows += [(2100, [0.0] * 12), (2101, [1.0, 2.0]), (2150, [-1.0, 0.5]), (7, rows[7][1]), (50, rows[50][1]), (100, rows[9][1])]
    frame = spark.createDataFrame([(i, v, 1, "q") for i, v in rows], VECTORS).repartition(4)
    queries = [r for r in rows if r[0] is not None and r[0] % 50 == 0] + [rows[0], (None, rows[3][1])]
    asked = spark.createDataFrame(queries, "vec_id long, embedding array<float>")
    index = inner_product.build_index(frame)
    for k in (1, 5):
        got = [tuple(r) for r in inner_product.search(index, asked, k).collect()]
        assert sorted(got, key=str) == products_by_force(rows, queries, k)
    assert inner_product.search(index, asked.limit(0)).count() == 0
    assert inner_product.search(inner_product.build_index(frame.limit(0)), asked).count() == 0


def test_products_beyond_doubles(spark):
    rows = [(i, [float(2**20 + i), float(2**19 - i)]) for i in range(60)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in inner_product.search(inner_product.build_index(frame), frame.filter("vec_id % 50 = 0")).collect()]
    assert sorted(got, key=str) == products_by_force(rows, [rows[0], rows[50]], 5)


def test_pruning_meets_few_vectors(spark, monkeypatch):
    """Blocks come by descending length; beyond the first, which sets the scores to beat, hardly a vector is multiplied whole."""
    frame = spark.createDataFrame(vector_rows(2, 8000, 16, 1.0), "vec_id long, embedding array<float>")
    index = inner_product.build_index(frame)
    blocks = sorted((b.asDict() for b in index.blocks.collect()), key=lambda b: -b["top"])
    assert sum(len(b["ids"]) for b in blocks) == 8000
    assert all(list(np.frombuffer(b["norms"])) == sorted(np.frombuffer(b["norms"]), reverse=True) for b in blocks)
    asked = [tuple(r) for r in inner_product.integer_vectors(frame, "vec_id", "embedding", 256.0).filter("id % 50 = 0").select("id", "dim", "vector").collect()]
    queries, met, exact = inner_product._Queries(asked, index.bases, 5), [], inner_product._exact_products
    monkeypatch.setattr(inner_product, "_exact_products", lambda a, b, pairs: met.append(len(a) * (1 if pairs else len(b))) or exact(a, b, pairs))
    best = inner_product._Best(queries)
    for b in blocks:
        inner_product._meet(best, queries, b | {"ids": pa.array(b["ids"])})
    assert len(blocks) > 2 and sum(met) < 1.05 * len(asked) * len(blocks[0]["ids"])
