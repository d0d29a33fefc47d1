"""Every registered query runs on the smallest tables; those with SQL must agree with it."""

import math
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{DATA}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return None if value is None else str(value)


WITHOUT_SQL = set(entry.queries()) - set(entry.oracle_sql())


def test_names_match():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if not n.startswith("op")))
def test_against_sql(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted([tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in columns]).collect()], key=repr)
    answer = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    at = sorted(range(len(names)), key=names.__getitem__)
    assert got == sorted([tuple(plain(r[i]) for i in at) for r in answer.fetchall()], key=repr)


@pytest.mark.parametrize("name", sorted(n for n in WITHOUT_SQL if not n.startswith("op") and n != "pipeline"))
def test_without_sql(spark, name):
    """Those that SQL cannot express run and give rows; what they must hold is tested in the other files."""
    assert entry.queries()[name](spark, DATA).count() > 0


def test_flagship(spark):
    assert entry.entry(spark).count() == 16
