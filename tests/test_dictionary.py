import random
import re

import pytest

from threadloom.operators import dictionary


def by_force(texts, titles, boundary=True):
    least = {}
    for k, t in titles:
        if t:
            low = t.lower()
            least[low] = min(least.get(low, k), k)
    out = []
    for key, text in texts:
        low = (text or "").lower()
        origin = [i for i, c in enumerate(text or "") for _ in c.lower()]
        assert len(origin) == len(low)
        for name, k in least.items():
            for m in re.finditer(f"(?={re.escape(name)})", low):
                a, b = m.start(), m.start() + len(name)
                if not boundary or not (re.match(r"\w", low[a - 1 : a] if a else "") or re.match(r"\w", low[b : b + 1])):
                    out.append((key, k, name, origin[a], origin[b - 1] + 1))
    return sorted(out, key=str)


def frames(spark, texts, titles):
    rows = spark.createDataFrame([(k, t, "x") for k, t in texts], "task_id long, text string, title string").repartition(3)
    return rows, spark.createDataFrame([(k, t, 1) for k, t in titles], "ol_key string, title string, text int")


TEXTS = [
    (1, "The Trial, the trial of Dune!"), (2, "untrial dune"), (3, "x the castle"), (4, "DUNE"), (5, ""), (6, None), (7, "İİ abc def ghi"), (8, "abİ İab abc def"),
    (9, "He read 'Salem's Lot twice?!"), (10, "a b a b a"), (10, "a b a b a"), (None, "dune"), (11, "?! ?!"), (12, "naïve NAÏVE ﬁn"), (13, " the\ncastle the castle_ the castle"), (14, "dune " * 3000),
]
TITLES = [
    ("k1", "The Trial"), ("k2", "Dune"), ("k0", "dunE"), ("k3", "the castle"), ("k4", "trial"), ("k5", "abc def"), ("k6", "'Salem's Lot"), ("k7", "a b a"), ("k8", "?!"), ("k9", None), ("k10", ""),
    ("k11", "İ"), ("k12", "naïve"), ("k13", "not in any text"), ("k14", "dune absentia"), ("k15", "(dune)"), ("k16", " "),
]


@pytest.mark.parametrize("boundary", [True, False])
@pytest.mark.parametrize("shard_chars", [1 << 22, 12])
def test_every_place_of_every_title(spark, boundary, shard_chars):
    rows, names = frames(spark, TEXTS, TITLES)
    got = [tuple(r) for r in dictionary.matches(rows, names, boundary=boundary, shard_chars=shard_chars).collect()]
    assert sorted(got, key=str) == by_force(TEXTS, TITLES, boundary)


def test_rounds_and_splits_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(dictionary, "ROUND_KEYS", 3)
    monkeypatch.setattr(dictionary, "TEXT_CHARS", 500)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(30)] + ["the"] * 20
    texts = [(i, " ".join(rng.choice(words) for _ in range(40)).replace("w7", "İ")) for i in range(120)]
    titles = [(f"k{i}", " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 3])))) for i in range(200)]
    rows, names = frames(spark, texts, titles)
    got = [tuple(r) for r in dictionary.matches(rows, names, shard_chars=100).collect()]
    assert sorted(got, key=str) == by_force(texts, titles)


def test_no_titles_or_no_texts(spark):
    rows, names = frames(spark, TEXTS, TITLES)
    assert dictionary.matches(rows.limit(0), names).count() == 0
    assert dictionary.matches(rows, names.limit(0)).count() == 0
    assert dictionary.matches(rows, names.filter("ol_key = 'k13'")).columns == ["task_id", "ol_key", "title", "start", "end"]


def test_a_title_goes_where_its_rarest_token_is(spark):
    rows, names = frames(spark, [(i, "common words" + (" seldom" if i == 7 else "")) for i in range(50)], [("k", "Common Seldom"), ("m", "common unknown")])
    sharded = dictionary._sharded(dictionary._known_titles(names, True), dictionary._token_counts(rows), 50, 1 << 20)
    assert sorted((r.title, r.h, r.n) for r in sharded.collect()) == [("common seldom", dictionary.token_hash("seldom"), 1), ("common unknown", dictionary.token_hash("unknown"), 0)]
