import duckdb
import pytest

import __spark_entry__ as entry
from threadloom.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        return round(float(v), 6) if isinstance(v, float) or type(v).__name__ == "Decimal" else v

    return sorted((tuple(str(plain(r[i])) for i in order) for r in values))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF)
    result = got.collect()
    if name in ORACLES:
        want = duck.sql(ORACLES[name])
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got.columns, result) == rows(want.columns, want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
