import random

from pyspark.sql import functions as F

from threadloom.functions import similarity as sim
from threadloom.operators import bestmatch, resolve

FIELDS = "surface string, norm string, ol_key string, title string, norm_title string"


def pairs(seed, n, names):
    rng = random.Random(seed)
    words = ["dune", "the", "trial", "of", "hundred", "years", "solitude", "emma", "é", "messiah", "a"]
    out = []
    for s in range(n):
        norm = " ".join(rng.choice(words) for _ in range(rng.randint(0, 5)))
        for k in range(rng.randint(1, names)):
            name = norm if rng.random() < 0.05 else " ".join(rng.choice(words) for _ in range(rng.randint(0, 5)))
            name = name[: rng.randint(0, len(name))] + rng.choice(["", "x"]) if rng.random() < 0.3 else name
            out.append((f"s{s}", norm, f"k{k}", name.upper(), name))
    return out


def by_force(rows, score):
    by = {}
    for s, a, k, t, b in rows:
        by.setdefault(s, []).append((-score(a, b), k, t))
    out = {}
    for s, found in by.items():
        found.sort()
        out[s] = (found[0][1], found[0][2], round(-found[0][0], 9), round(-found[1][0], 9) if len(found) > 1 else 0.0, len(found))
    return out


def fuzzy(a, b):
    return bestmatch.FuzzyScorer.sort * sim.token_sort_ratio(a, b) + bestmatch.FuzzyScorer.part * sim.partial_ratio(a, b)


def test_winners_and_gaps_are_those_of_scoring_everything(spark):
    rows = pairs(1, 60, 40) + [("null", None, "k", "T", "t"), ("null", "t", "k", None, None)]
    frame = spark.createDataFrame(rows, FIELDS).repartition(3)
    got = {r.surface: (r.ol_key, r.title, round(r.score, 9), round(r.second, 9), r.n) for r in bestmatch.best_two(frame, bestmatch.FuzzyScorer()).collect()}
    assert got == by_force(rows[:-2], fuzzy)
    canonical = lambda a, b: float("inf") if a == b else max(sim.token_sort_ratio(a, b), sim.token_set_ratio(a, b), sim.ratio(a, b))
    got = {r.surface: (r.ol_key, r.title, round(r.score, 9), r.n) for r in bestmatch.best_two(frame, bestmatch.CanonicalScorer()).collect()}
    assert got == {s: (k, t, score, n) for s, (k, t, score, _, n) in by_force(rows[:-2], canonical).items()}
    assert bestmatch.best_two(frame.limit(0), bestmatch.FuzzyScorer()).count() == 0


def test_candidates_in_several_stretches(monkeypatch):
    rows = [r for r in pairs(2, 1, 40) if r[0] == "s0"] + [("s0", "dune of the trial", f"z{i}", f"t{i}", f"dune of trial {i}") for i in range(40)]
    a, scorer = "dune of the trial", bestmatch.FuzzyScorer()
    whole = bestmatch._best_two(a, [r[4] for r in rows], [r[2] for r in rows], [], scorer)
    parts = []
    for i in range(0, len(rows), 7):
        parts = bestmatch._best_two(a, [r[4] for r in rows[i : i + 7]], [r[2] for r in rows[i : i + 7]], parts, scorer)
    assert [x[:2] for x in whole] == [x[:2] for x in parts]


def test_bounds_hold_and_save_scores(monkeypatch):
    rng, scorer = random.Random(3), bestmatch.FuzzyScorer()
    for s, a, k, t, b in pairs(4, 40, 30):
        held, sizes = bestmatch._bags([a, b])
        bound = scorer.bounds(len(a), sizes[1:], held.min(axis=0).sum(keepdims=True))[0]
        exact = fuzzy(a, b)
        assert bound >= exact - 1e-9
        least = rng.uniform(0, 100)
        got = scorer.score(a, b, " ".join(sorted(a.split())), least)
        assert abs(got - exact) < 1e-9 if got is not None else exact < least
    names, calls = [f"{w} {i}" for i in range(300) for w in ("one hundred years of solitude", "zzz qqq")], []
    monkeypatch.setattr(scorer, "score", lambda *x: calls.append(1) or bestmatch.FuzzyScorer.score(scorer, *x))
    bestmatch._best_two("one hundred years of solitude 7", names, [str(i) for i in range(len(names))], [], scorer)
    assert len(calls) < len(names) / 2


def test_decision_over_given_scores(spark):
    rows = [("a", "k", "T", 86.04, 82.0, 3), ("b", "k", "T", 86.0, 80.9, 2), ("c", "k", "T", 95.0, 95.0, 2), ("d", "k", "T", 84.9, 0.0, 1)]
    got = resolve.fuzzy_decision(spark.createDataFrame(rows, "surface string, ol_key string, title string, score double, second double, n bigint"))
    assert sorted(tuple(r) for r in got.collect()) == [
        ("a", "fuzzy", "k", "T", 86.0, True, "score=86.0;n_cands=3"), ("b", "fuzzy", "k", "T", 86.0, False, "score=86.0;n_cands=2"),
        ("c", "fuzzy", "k", "T", 95.0, False, "score=95.0;n_cands=2"), ("d", "failed", None, None, 84.9, False, "below_threshold(85.0)"),
    ]
    assert got.filter(F.col("ambiguous")).count() == 1
