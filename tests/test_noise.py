from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_noise_remap_takes_whole_texts(spark):
    got = entry.queries()["noise_remap"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.col("text").alias("whole")), "doc_id")
    assert got.filter("not startswith(text, whole)").count() == 0 and got.filter("start <> length(text) - 2").count() == 0


def test_spans_move_with_their_text_in_slices(monkeypatch):
    import random
    import re

    import pyarrow as pa

    from threadloom.operators import spans

    rng = random.Random(5)
    texts = ["".join(rng.choice(["[u/ab] . ", "word ", "é→", "[u/]", " "]) for _ in range(rng.randrange(30))) for _ in range(80)] + [None, ""]
    own = [None if i % 11 == 3 else [(a := rng.randrange(60), a + rng.randrange(12)) for _ in range(rng.randrange(20))] for i in range(82)]

    def plain(t, all_spans):
        cuts = [m.span() for m in re.finditer(spans.NOISE, t or "")]
        kept = [s for s in all_spans or [] if not any(a < s[1] and s[0] < b for a, b in cuts)]
        moved = [(s[0] - (lost := sum(b - a for a, b in cuts if b <= s[0])), s[1] - lost) for s in kept]
        return {"text": t and re.sub(spans.NOISE, "", t), "spans": [{"start": a, "end": b} for a, b in moved]}

    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    rows = pa.array([o and [{"start": a, "end": b} for a, b in o] if o is not None else None for o in own], kind)
    whole, sizes = spans._without_noise, []
    monkeypatch.setattr(spans, "_without_noise", lambda t, s: sizes.append(len(t)) or whole(t, s))
    monkeypatch.setattr(spans, "NOISE_BYTES_AT_ONCE", 300)
    assert spans._noise_removed.func(pa.array(texts), rows).to_pylist() == [plain(t, o) for t, o in zip(texts, own)]
    assert len(sizes) > 5


def test_null_text_stays_null(spark):
    from threadloom.operators import spans

    row = spark.createDataFrame([(None, [(1, 2)])], "t string, s array<struct<start:int,end:int>>").select(spans.remove_noise("t", F.col("s")).alias("r")).first()
    assert row.r.text is None and [tuple(s) for s in row.r.spans] == [(1, 2)]
