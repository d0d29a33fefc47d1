"""Sources, sinks and file arrival, fed with files that Spark derives from the given tables."""

from __future__ import annotations

import datetime as dt
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import day_before, folder_of
from ..schemas import EVENTS, GKG
from ..session import scratch_path, settle, settle_alone
from ..sources import readers, sinks
from ..sources.zips import member_lines, parse_lines, read_zipped_members
from ..sources.archives import archive_lines
from ..streaming.arrivals import append_new_archives, daily_append, daily_stream, ingest, on_new_content, on_new_file
from .registry import ACTIVITY_SQL, activity, query, table

ROW = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("day", T.StringType()),
        T.StructField("ts", T.StringType()),
        T.StructField("props", T.StringType()),
    ]
)
ROW_SQL = """SELECT event_id, user_id, event_type, value, strftime(ts, '%Y%m%d') AS day,
  strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, props FROM events"""
NOW = dt.datetime(2024, 1, 16, 3, 0)


def _rows(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.date_format("ts", "yyyyMMdd").alias("day"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        "props",
    )


def _lines(rows: DataFrame) -> DataFrame:
    return rows.select("day", F.concat_ws("\t", *[F.col(c).cast("string") for c in rows.columns]).alias("line"))


def zipped_days(rows: DataFrame) -> DataFrame:
    """Each Arrow batch of lines as zips, one a day: ``(path, content)`` like a scan of a folder."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            for day, lines in batch.groupby("day"):
                name = f"{day}.{part}-{number}.export"
                target = io.BytesIO()
                with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr(f"{name}.txt", "not a table")
                    archive.writestr(f"{name}.CSV", "\n".join(lines["line"]) + "\n")
                yield pd.DataFrame({"path": [f"landing/{name}.CSV.zip"], "content": [target.getvalue()]})

    return _lines(rows).mapInPandas(pack, "path string, content binary")


def stored_zips(spark, rows: DataFrame) -> str:
    """The same archives as files of a folder in the shared one; a task that runs again writes the same files."""
    folder = scratch_path(spark, "zips")

    def store(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = pa.fs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with files.open_output_stream(f"{base}/{path.rsplit('/', 1)[1]}", compression=None) as out:
                    out.write(content)
            yield batch[["path"]]

    settle(zipped_days(rows).mapInPandas(store, "path string"))
    return folder


@query(
    "select_source_files",
    """SELECT 'http://feeds.example.org/daily/' || url AS url FROM pages
       WHERE contains(url, 'example') AND contains(url, '/en/') AND NOT contains(url, '#top')""",
)
def source_files(spark, sf):
    line = F.concat(F.lit('<LI><A HREF="'), "url", F.lit('">'), F.col("page_id").cast("string"), F.lit("</A>"))
    index = table(spark, sf, "pages").select(line.alias("value"))
    base = folder_of("http://feeds.example.org/daily/index.html")
    return readers.select_source_files(index, base, ["example", "/en/", "HREF"], ["#top"])


@query(
    "previous_day_filter",
    "SELECT event_id, strftime(ts - INTERVAL 5 HOUR - INTERVAL 1 DAY, '%Y%m%d') AS previous_day FROM events",
)
def previous_days(spark, sf):
    return table(spark, sf, "events").select("event_id", day_before("ts").alias("previous_day"))


@query("read_zipped_members", ROW_SQL)
def zipped(spark, sf):
    good, _ = readers.split_quarantine(read_zipped_members(spark, stored_zips(spark, _rows(spark, sf)), ROW))
    return good.drop("source_file")


def _as_events_file(rows: DataFrame) -> DataFrame:
    """58 columns in file order; the stand-in fills seven of them."""
    return rows.select(*[
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in EVENTS.fields
    ])


@query(
    "read_events_tsv",
    """SELECT event_id::VARCHAR AS GLOBALEVENTID, strftime(ts, '%Y%m%d') AS SQLDATE, '0' || event_type AS EventCode,
       user_id AS NumMentions, value AS AvgTone FROM events""",
)
def events_file(spark, sf):
    rows = activity(spark, sf).withColumn("EventCode", F.concat(F.lit("0"), "EventCode"))
    path = scratch_path(spark, "events-tsv")
    _as_events_file(rows.withColumnRenamed("user_id", "NumMentions")).write.csv(path, sep="\t", header=False)
    good, _ = readers.split_quarantine(readers.read_events_tsv(spark, path))
    return good.select("GLOBALEVENTID", "SQLDATE", "EventCode", "NumMentions", "AvgTone")


def gkg_rows(spark, sf) -> DataFrame:
    """Documents as knowledge-graph rows; two pages, found by the document's number modulo the pages, are the URLs."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    n = pages.count()
    docs = table(spark, sf, "documents")
    same = pages.select(F.col("page_id").alias("p1"), F.col("url").alias("u1"))
    after = pages.select(F.col("page_id").alias("p2"), F.col("url").alias("u2"))
    # the remainders spread evenly over the pages, so neither join has a hot key
    docs = docs.withColumn("p1", F.col("doc_id") % n).withColumn("p2", (F.col("doc_id") + 1) % n)
    # both pages are found for the pairs of remainders, so a text is joined, and shuffled, once
    links = docs.select("p1", "p2").where("p1 IS NOT NULL").distinct().join(same, "p1", "left").join(after, "p2", "left")
    rows = docs.join(links, ["p1", "p2"], "left")
    # the words of the whole text stand in for theme codes
    words = F.array_join(F.regexp_extract_all("text", F.lit(r"(\p{L}+)"), F.lit(1)), ";")
    urls = F.concat_ws("<UDIV>", "u1", "u2")
    values = {
        "DATE": F.lit("20240822"),
        "NUMARTS": F.floor(F.col("n_chars") / 100).cast("bigint"),
        "THEMES": words,
        "PERSONS": F.col("lang"),
        "ORGANIZATIONS": F.col("source"),
        "SOURCES": F.col("doc_id").cast("string"),
        "SOURCEURLS": F.when(urls != "", urls),
    }
    return rows.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in GKG.fields])


GKG_SQL = """
  SELECT (d.n_chars // 100)::BIGINT AS NUMARTS, d.lang AS PERSONS, d.source AS ORGANIZATIONS, d.doc_id::VARCHAR AS SOURCES,
         nullif(concat_ws('<UDIV>', a.url, b.url), '') AS SOURCEURLS,
         nullif(array_to_string(regexp_extract_all(d.text, '\\p{L}+'), ';'), '') AS THEMES
  FROM documents d LEFT JOIN pages a ON a.page_id = d.doc_id % (SELECT count(*) FROM pages)
    LEFT JOIN pages b ON b.page_id = (d.doc_id + 1) % (SELECT count(*) FROM pages)
"""


def _gkg_view(rows: DataFrame) -> DataFrame:
    return rows.select("NUMARTS", "PERSONS", "ORGANIZATIONS", "SOURCES", "SOURCEURLS", "THEMES")


def _write_gkg(spark, sf, path: str) -> None:
    gkg_rows(spark, sf).write.csv(
        path, sep="\t", header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


@query("read_gkg_tsv", GKG_SQL)
def gkg_file(spark, sf):
    path = scratch_path(spark, "gkg-tsv")
    _write_gkg(spark, sf, path)
    good, _ = readers.split_quarantine(readers.read_gkg_tsv(spark, path))
    return _gkg_view(good)


@query("on_new_file", GKG_SQL)
def arrivals(spark, sf):
    """Files of a folder through the stream, each taken once; the table is laid out by file."""
    path, out = scratch_path(spark, "arrivals"), scratch_path(spark, "arrived")
    _write_gkg(spark, sf, path)
    stream = on_new_file(
        spark, path, scratch_path(spark, "stream"), lambda rows: sinks.append_table(rows, out), files_per_batch=64
    )
    stream.awaitTermination()
    return _gkg_view(spark.read.schema(GKG).parquet(out))


@query(
    "quarantine",
    """SELECT event_id, user_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS value,
       event_type = 'error' AS rejected FROM events""",
)
def quarantined(spark, sf):
    """Lines of errors carry a value that is not a number; they and only they are set aside."""
    rows = _rows(spark, sf)
    value = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    files = rows.withColumn("value", value)
    good, bad = readers.split_quarantine(parse_lines(member_lines(zipped_days(files)), ROW))
    columns = ["event_id", "user_id", "event_type", "value"]
    return good.select(*columns, F.lit(False).alias("rejected")).unionByName(
        bad.select(*columns, F.lit(True).alias("rejected"))
    )


@query(
    "read_calendar",
    """SELECT strftime(o_orderdate, '%Y%m%d') AS "Date", 'orders: ' || count(*)::VARCHAR AS "Event" FROM orders GROUP BY 1""",
)
def calendar_file(spark, sf):
    days = table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyyMMdd").alias("Date"))
    events = days.agg(F.concat(F.lit("orders: "), F.count(F.lit(1)).cast("string")).alias("Event"))
    path = scratch_path(spark, "calendar")
    events.write.csv(path, header=True)
    return readers.read_calendar(spark, path)


@query("land_raw", ROW_SQL)
def landed(spark, sf):
    """Every landed line, cut into its fields again."""
    path = scratch_path(spark, "landing")
    sinks.land_raw(member_lines(zipped_days(_rows(spark, sf))), path)
    fields = F.split("value", "\t", -1)
    lines = spark.read.format("text").load(path)
    return lines.select(*[fields[i].cast(f.dataType).alias(f.name) for i, f in enumerate(ROW.fields)])


@query(
    "quarantine_stream",
    """SELECT doc_id::VARCHAR AS SOURCES, doc_id % 7 = 3 AS rejected FROM documents""",
)
def quarantined_stream(spark, sf):
    """Files with bad lines (an article count that is no number) through the stream: what is set aside, what is not."""
    path, out, aside = (scratch_path(spark, name) for name in ("arrivals", "arrived", "rejected"))
    bad = F.col("SOURCES").cast("bigint") % 7 == 3
    rows = gkg_rows(spark, sf).withColumn("NUMARTS", F.when(bad, F.lit("many")).otherwise(F.col("NUMARTS").cast("string")))
    rows.write.csv(path, sep="\t", header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    stream = on_new_file(
        spark, path, scratch_path(spark, "stream"), lambda good: sinks.append_table(good, out), files_per_batch=64, rejected=aside
    )
    stream.awaitTermination()
    good = spark.read.schema(GKG).parquet(out).select("SOURCES", F.lit(False).alias("rejected"))
    lines = spark.read.parquet(aside).select(F.split(readers.CORRUPT, "\t", -1)[9].alias("SOURCES"), F.lit(True).alias("rejected"))
    return good.unionByName(lines)


INDEX_DAY = "20240115"


@query(
    "ingest",
    f"""SELECT event_id, user_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS value,
        strftime(ts, '%Y%m%d') AS day, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, props, event_type = 'error' AS rejected
        FROM events WHERE strftime(ts, '%Y%m%d') <> '{INDEX_DAY}'""",
)
def ingested(spark, sf):
    """The whole load from files: an index page that leaves one day out, landed archives, text, table, bad lines."""
    rows = _rows(spark, sf)
    value = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    folder = stored_zips(spark, rows.withColumn("value", value))
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder)
    link = F.concat(F.lit('<A HREF="'), F.element_at(F.split("path", "/"), -1), F.lit('">'))
    landing, stored, aside = (scratch_path(spark, name) for name in ("landing", "table", "rejected"))
    for _ in range(2):  # a second run replaces the files' rows
        ingest(archives.select(link.alias("value")), archives, landing, stored, aside, ROW, ["export"], [INDEX_DAY])
    columns = [f.name for f in ROW.fields]
    good = spark.read.schema(ROW).parquet(stored).select(*columns, F.lit(False).alias("rejected"))
    fields = F.split(readers.CORRUPT, "\t", -1)
    bad = spark.read.parquet(aside).select(
        *[(F.lit(None) if f.name == "value" else fields[i]).cast(f.dataType).alias(f.name) for i, f in enumerate(ROW.fields)],
        F.lit(True).alias("rejected"),
    )
    return good.unionByName(bad)


def _stored(spark, sf) -> DataFrame:
    return _rows(spark, sf).withColumn("source_file", F.concat("day", F.lit(".export.CSV")))


@query("append_table", ROW_SQL)
def appended(spark, sf):
    """The same files loaded twice: the second load replaces the first."""
    path = scratch_path(spark, "table")
    for _ in range(2):
        sinks.append_table(_stored(spark, sf), path, sort_col="event_id")
    return spark.read.schema(ROW).parquet(path).drop("source_file")


@query(
    "append_table_strict",
    "SELECT event_id, count(*)::BIGINT AS copies FROM (SELECT * FROM events UNION ALL SELECT * FROM events) GROUP BY 1",
)
def appended_twice(spark, sf):
    path = scratch_path(spark, "table")
    for _ in range(2):
        sinks.append_table(_stored(spark, sf), path, strict_append=True)
    return spark.read.schema(ROW).parquet(path).groupBy("event_id").agg(F.count(F.lit(1)).alias("copies"))


@query("ctas", ROW_SQL)
def created(spark, sf):
    path = scratch_path(spark, "ctas")
    sinks.ctas(_rows(spark, sf), path)
    return spark.read.schema(ROW).parquet(path)


@query("replace_table", ROW_SQL)
def replaced(spark, sf):
    path = scratch_path(spark, "replaced")
    sinks.replace_table(_rows(spark, sf).unionByName(_rows(spark, sf)), path)
    sinks.replace_table(_rows(spark, sf), path)
    return spark.read.schema(ROW).parquet(path)


@query("append_in_chunks", ROW_SQL)
def chunked(spark, sf):
    path = scratch_path(spark, "chunks")
    sinks.append_in_chunks(_rows(spark, sf), path, rows=5_000)
    return spark.read.schema(ROW).parquet(path)


@query("daily_append", f"SELECT * FROM ({ROW_SQL}) WHERE day = '{(NOW - dt.timedelta(hours=29)).strftime('%Y%m%d')}'")
def increment(spark, sf):
    """Yesterday's zips out of all of them, loaded twice; the table holds that day once."""
    path, folder = scratch_path(spark, "daily"), stored_zips(spark, _rows(spark, sf))
    for _ in range(2):
        daily_append(spark, folder, path, ROW, NOW)
    return spark.read.schema(ROW).parquet(path).drop("source_file")


@query("read_archives", ROW_SQL)
def archives(spark, sf):
    """The data source over stored archives: a partition an archive, read through an open file."""
    lines = archive_lines(spark, stored_zips(spark, _rows(spark, sf)))
    good, _ = readers.split_quarantine(parse_lines(lines, ROW))
    return good.drop("source_file")


@query("daily_stream", f"SELECT * FROM ({ROW_SQL}) WHERE day = '{(NOW - dt.timedelta(hours=29)).strftime('%Y%m%d')}'")
def increment_by_stream(spark, sf):
    """Yesterday's archives by the stream, run twice on one checkpoint: the second run finds nothing new."""
    path, check, folder = scratch_path(spark, "daily"), scratch_path(spark, "check"), stored_zips(spark, _rows(spark, sf))
    for _ in range(2):
        daily_stream(spark, folder, path, ROW, NOW, check).awaitTermination()
    return spark.read.schema(ROW).parquet(path).drop("source_file")


@query("append_new_archives", ROW_SQL)
def archives_as_they_come(spark, sf):
    """All archives in two runs of the stream over one checkpoint: first those of ten days, then the rest."""
    path, check, rows = scratch_path(spark, "stream"), scratch_path(spark, "check"), _rows(spark, sf)
    folder = stored_zips(spark, rows)
    for contains in ("202401", ""):
        append_new_archives(spark, folder, path, ROW, check, contains).awaitTermination()
    return spark.read.schema(ROW).parquet(path).drop("source_file")


@query("on_new_content", "SELECT doc_id::VARCHAR AS SOURCES, 1::BIGINT AS times FROM documents")
def content_once(spark, sf):
    """Every file stored twice under different names: each row arrives once."""
    path, out, check = (scratch_path(spark, name) for name in ("arrivals", "arrived", "check"))
    rows = settle_alone(gkg_rows(spark, sf).repartition(4, "SOURCES"))
    for _ in range(2):
        rows.write.mode("append").csv(path, sep="\t", header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        on_new_content(spark, path, check, lambda good: sinks.append_table(good, out)).awaitTermination()
    return spark.read.schema(GKG).parquet(out).groupBy("SOURCES").agg(F.count(F.lit(1)).alias("times"))
