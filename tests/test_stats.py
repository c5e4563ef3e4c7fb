import pytest

from threadloom.operators import stats


@pytest.mark.parametrize("tenths", [6, 7, 8, 9])
def test_average_confidence_does_not_depend_on_the_order_of_sums(spark, tenths):
    """741.9 over 1536 rows is 0.4830078125, halfway between two results of nine places; the even one is right."""
    whole, rest = divmod(7419, tenths)
    values = [tenths / 10] * whole + [rest / 10] + [0.0] * (1536 - whole - 1)
    for order in (values, values[::-1]):
        rows = [("t", "a", "k", i, c, False, i) for i, c in enumerate(order)]
        links = spark.createDataFrame(rows, "canonical_title string, author_name string, ol_key string, thread_id int, confidence double, ambiguous boolean, _pos int")
        got = stats.by_title(links.withColumn("text", links.canonical_title).coalesce(1)).first()
        assert (got.mentions, got.avg_confidence) == (1536, 0.483007812)


SHARES = [(17, 2000), (33, 2000), (143, 2000), (283, 2000), (291, 2000), (1375, 4400)]  # exact halves of a tenth of a percent


def test_shares_are_rounded_as_sql_rounds_them(spark):
    import duckdb

    wanted = [duckdb.connect().execute(f"SELECT round_even(100 * ({k}::DOUBLE / {n}), 1)").fetchall()[0][0] for k, n in SHARES]
    assert wanted == [0.8, 1.6, 7.2, 14.2, 14.6, 31.2]
    for (k, n), share in zip(SHARES, wanted):
        links = spark.range(n).selectExpr("'t' AS canonical_title", "'a' AS author_name", "'t' AS text", "'k' AS ol_key", "id AS thread_id", "0.5D AS confidence", f"id < {k} AS ambiguous", "id AS _pos")
        assert stats.by_title(links).first().ambiguous_pct == share


@pytest.mark.parametrize("last", [1, 2, 3])
def test_of_keys_at_one_position_the_first_row_counts(spark, last):
    rows = [("t", "a", "t", key, 1, 0.5, False, 7, row) for key, row in (("b", 0), ("a", 2), ("c", 1), ("", -1))]
    links = spark.createDataFrame(rows[last:] + rows[:last], "canonical_title string, author_name string, text string, ol_key string, thread_id int, confidence double, ambiguous boolean, _pos int, _row int")
    for parts in (1, 4):
        assert stats.by_title(links.repartition(parts), "_row").first().ol_key == "b"
        assert stats.by_title(links.repartition(parts)).first().ol_key == "a"


def test_group_titles_takes_the_first_of_its_file(spark, tmp_path):
    from threadloom.plans.queries import QUERIES

    parts = [(p, "cold anvil", "Brand#1") for p in (1, 2, 3)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    lines = [(5, 2, 1, 0.05)] + [(4, p, 1, 0.05) for p in (3, 1, 2)]  # three lines of one number in an order
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_discount double").coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    assert QUERIES["group_titles"](spark, str(tmp_path)).first().ol_key == "/works/3"
