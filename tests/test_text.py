import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from threadloom.functions import similarity as sim
from threadloom.functions import text as tx


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first()["y"]


def test_docstring_examples(spark):
    assert one(spark, tx.initials, "David Foster Wallace") == "DFW"
    assert one(spark, tx.title_acronym, "Infinite Jest") == "IJ"
    assert one(spark, tx.title_acronym, "The Brothers Karamazov") == "BK"
    assert one(spark, tx.spell_numbers, "100 yrs of Solitude") == "one hundred years of solitude"
    assert one(spark, tx.spell_numbers, "1,000 plateaus") == "one thousand plateaus"
    assert one(spark, tx.spell_numbers, "1,000,000") == "1000,000"


def test_normalisers(spark):
    rows = ["À rebours!", "  The  Crying\tof Lot-49 ", "Œuvre_x", "", None, "漢字、テスト"]
    df = spark.createDataFrame([(r,) for r in rows], "x string")
    got = [tuple(r) for r in df.select(tx.norm_title("x"), tx.norm_title_sql(F.col("x")), tx.norm_stats("x")).collect()]
    assert [g[0] for g in got] == ["a rebours", "the crying of lot 49", "œuvre_x", "", None, "漢字 テスト"]
    assert all(a == b for a, b, _ in got)
    assert got[1][2] == "the crying of lot 49" and got[0][2] == "rebours"
    assert one(spark, lambda x: tx.norm_stats(x), "The Trial") == "trial"


def test_clean_text_and_markers(spark):
    values = [" a \x1c b c ", "[deleted]", " [deleted] ", None]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    assert [r[0] for r in df.select(tx.clean_text(F.col("x"))).collect()] == ["a b c", "", "[deleted]", ""]
    assert [r[0] for r in df.select(tx.is_removed(F.col("x"))).collect()] == [False, True, False, False]


def test_scripture(spark):
    values = ["1 Kings 3:16", "Genesis, chapter", "John Adams", "The Trial", "", None]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    assert [r[0] for r in df.select(tx.is_scripture(F.col("x"))).collect()] == [True, True, True, False, False, False]


def test_parsers(spark):
    assert one(spark, tx.catalog_keys, "a/OL1W b/OL2M c/OL1W d/OL9X") == ["OL1W", "OL2M"]
    assert one(spark, tx.pipe_split, "a| b ||c") == ["a", "b", "c"]
    assert one(spark, tx.json_list, '["a"]') == ["a"] and one(spark, tx.json_list, "{}") in ([], ["{}"])
    reply = '```json\n[{"text": " Dune ", "label": "book"}, {"text": "x", "label": "FILM"}]\n```'
    assert [r.asDict() for r in one(spark, tx.reply_entities, reply)] == [{"text": "Dune", "label": "BOOK"}]
    assert one(spark, tx.acronym_line, "IJ: Infinite Jest - David Foster Wallace").asDict() == {"key": "IJ", "title": "Infinite Jest", "author": "David Foster Wallace"}
    assert one(spark, tx.bare_id, "t3_a_b") == "a_b" and one(spark, tx.epoch_date, "1700000000") == "2023-11-14" and one(spark, tx.epoch_date, "x") is None


def naive_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def naive_partial(a, b):
    """The best ratio of the shorter one with a stretch of its length in the longer one, cut at the ends."""
    if len(a) == len(b):
        return max(naive_partial_of(a, b), naive_partial_of(b, a))
    return naive_partial_of(*sorted((a, b), key=len))


def naive_partial_of(short, long):
    n = len(short)
    stretches = [long[max(0, i) : i + n] for i in range(1 - n, len(long))]
    return max((200 * naive_lcs(short, s) / (n + len(s)) for s in stretches if s), default=0)


@settings(max_examples=150, deadline=None)
@given(st.text("abcé ", max_size=15), st.text("abcé ", max_size=15))
def test_lcs_and_ratios(a, b):
    assert sim.lcs_length(a, b) == naive_lcs(a, b)
    assert sim.ratio(a, b) == sim.ratio(b, a)
    assert abs(sim.partial_ratio(a, b) - naive_partial(a, b)) < 1e-9 or not a or not b
    assert 0 <= sim.token_set_ratio(a, b) <= 100


def test_known_ratios():
    assert sim.ratio("this is a test", "this is a test!") > 96.5
    assert sim.token_sort_ratio("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear") == 100
    assert sim.token_set_ratio("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100
    assert sim.partial_ratio("test", "this is a test!") == 100


def test_dice(spark):
    rng = random.Random(1)
    pairs = [("".join(rng.choices("abc ", k=rng.randint(0, 8))), "".join(rng.choices("abc ", k=rng.randint(0, 8)))) for _ in range(60)]
    got = [r[0] for r in spark.createDataFrame(pairs, "a string, b string").select(sim.dice(F.col("a"), F.col("b"))).collect()]

    def dice(a, b):
        x, y = ({s[i : i + 2] for i in range(len(s) - 1)} for s in (a, b))
        return float(a == b) if not x or not y else 2 * len(x & y) / (len(x) + len(y))

    assert all(abs(g - dice(a, b)) < 1e-12 for g, (a, b) in zip(got, pairs))
