"""Span selection against the definition: take spans in order unless they overlap one taken before."""

import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from threadloom.operators import selection

KIND = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.string())]))


def fold(spans, longest, first_seen):
    kept = []
    good = [s for s in spans if s and s["start"] is not None and s["end"] is not None and s["start"] <= s["end"]]
    for label in sorted({s["label"] for s in good}, key=lambda x: (x is None, x or "")):
        own, mine = [s for s in good if s["label"] == label], []
        if longest:
            own.sort(key=lambda s: (s["start"] - s["end"], 0 if first_seen else s["start"]))
        else:
            own.sort(key=lambda s: (s["start"], s["start"] - s["end"]))
        for s in own:
            if not any(s["start"] < k["end"] and k["start"] < s["end"] for k in mine):
                mine.append(s)
        kept += mine
    return kept


@pytest.mark.parametrize("longest,first_seen", [(True, False), (True, True), (False, False)])
def test_as_defined(longest, first_seen):
    rng = random.Random(5)

    def span():
        a = rng.randrange(40)
        return {"start": a, "end": a + rng.randrange(-1, 12), "label": rng.choice(["a", "b", None])}

    texts = [[span() for _ in range(rng.randrange(25))] for _ in range(400)] + [None, [], [None, {"start": None, "end": 3, "label": "a"}]]
    for some in (texts, texts[7:90], [None, None], []):
        want = [None if t is None else fold(t, longest, first_seen) for t in some]
        assert selection.choose(pa.array(some, KIND), longest, first_seen).to_pylist() == want
    assert selection.choose(pa.array(texts, KIND)[5:60], longest, first_seen).to_pylist() == [fold(t, longest, first_seen) for t in texts[5:60]]


@pytest.mark.parametrize("longest", [True, False])
def test_very_many_spans_of_one_text(longest):
    """10^5 spans, most of which stay; the second text nests them all."""
    texts = [[{"start": 10 * i, "end": 10 * i + 11 - i % 3, "label": "x"} for i in range(100_000)], [{"start": i, "end": 200_000 - i, "label": "x"} for i in range(100_000)]]
    began = time.time()
    kept = selection.choose(pa.array(texts, KIND), longest).to_pylist()
    assert time.time() - began < 10
    assert len(kept[0]) > 50_000 and len(kept[1]) == 1


def test_columns(spark):
    rows = spark.sql("SELECT array(named_struct('start', 0L, 'end', 4L, 'label', 'a', 'text', 'x'), named_struct('start', 3L, 'end', 9L, 'label', 'a', 'text', 'y'), named_struct('start', 2L, 'end', 3L, 'label', 'b', 'text', 'z')) AS s")
    by_label, longest, left, none = rows.select(selection.longest_first_by_label(F.col("s")), selection.longest_first(F.col("s")), selection.leftmost_longest(F.col("s")), selection.longest_first(F.lit(None).cast("array<struct<start:int,end:int>>"))).first()
    assert [tuple(s) for s in by_label] == [(3, 9, "a"), (2, 3, "b")]
    assert [tuple(s) for s in longest] == [(3, 9), (2, 3)]
    assert [tuple(s) for s in left] == [(0, 4)]
    assert none is None


def test_spans_are_chosen_by_bounded_slices_of_rows(monkeypatch):
    rng, held, whole = random.Random(3), [], selection.choose
    texts = [None if i % 9 == 4 else [(a := rng.randrange(50), a + rng.randrange(9), rng.choice("xyz")) for _ in range(rng.randrange(40))] for i in range(200)]
    spans = pa.array([t and [dict(zip(("start", "end", "label"), s)) for s in t] for t in texts], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.string())])))
    monkeypatch.setattr(selection, "choose", lambda part, *how: held.append(len(part.flatten())) or whole(part, *how))
    for longest, first_seen in ((True, False), (True, True), (False, False)):
        held.clear()
        assert selection.choose_by_slices(spans, longest, first_seen, 100).to_pylist() == whole(spans, longest, first_seen).to_pylist()
        assert max(held) <= 100 and sum(held) == len(spans.flatten())
    assert selection.row_slices(pa.array([1, 500, 2, 3]).to_numpy(), 5) == [(0, 1), (1, 1), (2, 2)]
