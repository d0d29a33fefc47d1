"""Loads in several files: merged counts and series against counting everything again, and tables that change together."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.analysis import corr_matrix
from ..plans.increments import add_daily_counts, add_token_counts, merged_daily_counts, merged_token_counts
from ..session import scratch_path
from ..sources.snapshots import TableSet
from .analysis import _MATRIX, DAILY, DAILY_SQL, SERIES
from .features import COUNTS_SQL, SEP
from .ingestion import ROW, ROW_SQL, _rows
from .registry import activity, query, table

FILES = 3


def _tables(spark, name: str) -> TableSet:
    return TableSet(spark, scratch_path(spark, name))


@query("token_counts_by_file", COUNTS_SQL)
def counts_by_file(spark, sf):
    """Documents as three files: the third comes first with other rows, then each file adds its own counts."""
    docs = table(spark, sf, "documents").select("text", F.concat(F.lit("file"), F.col("doc_id") % FILES).alias("source_file"))
    tables = _tables(spark, "counts")
    wrong = docs.where("source_file = 'file0'").withColumn("source_file", F.lit("file2"))
    add_token_counts(tables, wrong, cols=["text"], separator=SEP)
    for n in range(FILES):
        add_token_counts(tables, docs.where(F.col("source_file") == f"file{n}"), cols=["text"], separator=SEP)
    return merged_token_counts(tables)


def _series(spark, sf):
    rows = activity(spark, sf).withColumn("source_file", F.concat(F.lit("file"), F.col("GLOBALEVENTID") % FILES))
    tables = _tables(spark, "series")
    options = dict(categories=DAILY, where=F.lit(True))
    add_daily_counts(tables, rows.where("source_file = 'file1'").withColumn("source_file", F.lit("file0")), **options)
    for n in range(FILES):
        add_daily_counts(tables, rows.where(F.col("source_file") == f"file{n}"), **options)
    return merged_daily_counts(tables, categories=DAILY)


@query("daily_counts_by_file", f"SELECT * REPLACE (round(avg_tone, 6) AS avg_tone) FROM ({DAILY_SQL})")
def series_by_file(spark, sf):
    """The daily series from three files with events of all days, one of which replaces what stood under its name."""
    return _series(spark, sf).withColumn("avg_tone", F.round("avg_tone", 6))


@query("corr_matrix_by_file", f"WITH d AS ({DAILY_SQL}) {_MATRIX}")
def matrix_by_file(spark, sf):
    return corr_matrix(_series(spark, sf), SERIES).withColumn("correlation", F.round("correlation", 6))


@query(
    "snapshot_tables",
    f"""SELECT *, 'old' AS seen FROM ({ROW_SQL}) WHERE event_id % 2 = 0 UNION ALL SELECT *, 'new' FROM ({ROW_SQL}) WHERE event_id % 2 = 0
        UNION ALL SELECT *, 'replaced' FROM ({ROW_SQL}) WHERE event_id % 2 = 1""",
)
def snapshots(spark, sf):
    """Two tables that change in one step: what a reader of the version before sees, and what one after it sees."""
    rows, tables = _rows(spark, sf), _tables(spark, "tables")
    even, odd = rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1")
    first = tables.replace({"one": even, "two": even})
    tables.publish([*tables.stage("one", odd), *tables.stage_parts("days", even, "day", "day")])
    seen = lambda df, name: df.withColumn("seen", F.lit(name))
    return (
        seen(tables.read("one", ROW, first), "old")
        .unionByName(seen(tables.read("days", ROW), "new"))
        .unionByName(seen(tables.read("one", ROW), "replaced"))
    )


@query("read_days", f"SELECT * FROM ({ROW_SQL}) WHERE day BETWEEN '20240105' AND '20240109'")
def days_of_a_table(spark, sf):
    """A range of days out of a table kept by day files: the log's ranges choose the files, the filter the rows."""
    tables = _tables(spark, "days")
    tables.put("events", _rows(spark, sf).withColumn("source_file", F.concat("day", F.lit(".export.CSV"))), day="day")
    found = tables.read("events", ROW, between=("20240105", "20240109"))
    return found.where(F.col("day").between("20240105", "20240109"))
