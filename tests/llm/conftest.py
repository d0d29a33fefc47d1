import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def by_value():
    import eventloom
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(eventloom)


@pytest.fixture(scope="session")
def documents():
    import duckdb

    return duckdb.sql(f"SELECT doc_id, text FROM '{DATA}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and very long texts, ties and repeated rows, and columns whose names clash with helpers."""
    rows = [
        (1, "one two three four five six seven eight", "a"),
        (2, "one two three four five six seven eight", "b"),
        (2, "one two three four five six seven eight", "b"),
        (3, None, None),
        (4, "", "x"),
        (5, " \n\t ", "x"),
        (None, "no key here, but some words", "y"),
        (6, "long " * 60_000, "z"),
        (7, "x" * 100_000, "z"),
        (8, "Ünïcode wörds 日本語 and 😀 too", None),
    ]
    names = "_row", "_key", "_stats", "_text", "ident", "n_words", "label", "component", "row", "kept"
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for name in names:
        from pyspark.sql import functions as F

        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.where("1 = 0")
