"""New files start work: the news tables per file, and the daily increment of a table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.spread import lookup_join
from ..plans.relevant_news import news_pipeline
from ..schemas import GKG
from ..session import settle
from ..sources.archives import archive_lines
from ..sources.contents import content_digests
from ..sources.readers import CORRUPT, previous_day, select_source_files, split_quarantine, with_corrupt, with_source_file
from ..sources.sinks import append_table, land_raw
from ..sources.zips import member_lines, parse_lines

# Columns of Spark's binary files.
BINARY = "path string, modificationTime timestamp, length bigint, content binary"


def stream_gkg_files(spark: SparkSession, folder: str, files_per_batch: int = 1) -> DataFrame:
    """Knowledge-graph files of one folder as they arrive; other names and folders are not seen. Bad lines keep
    their text in ``_corrupt_record``."""
    stream = (
        spark.readStream.schema(with_corrupt(GKG))
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder, sep="\t", header=True, enforceSchema=True, mode="PERMISSIVE")
    )
    return with_source_file(stream)


def on_new_file(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    process: Callable[[DataFrame], None],
    files_per_batch: int = 1,
    available_now: bool = True,
    rejected: str | None = None,
) -> StreamingQuery:
    """Call ``process`` with the good rows of each new file, once; bad lines are stored by file under
    ``rejected`` (beside the checkpoint if not given).

    A failure stops the stream, and the file is taken again after a restart; what ``process``
    writes therefore replaces (a table, or the partition of the file) rather than adds.
    """

    aside = rejected or f"{checkpoint.rstrip('/')}-rejected"

    def batch(rows: DataFrame, _: int) -> None:
        good, bad = split_quarantine(settle(rows))
        append_table(bad.select("source_file", CORRUPT), aside)
        process(good)

    writer = stream_gkg_files(spark, folder, files_per_batch).writeStream.foreachBatch(batch)
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def news_on_new_file(
    spark: SparkSession, folder: str, checkpoint: str, texts: DataFrame, out: str, **options
) -> StreamingQuery:
    """Replace the two news tables with those of each new file."""
    return on_new_file(
        spark, folder, checkpoint, lambda rows: news_pipeline(rows.drop("source_file"), texts, out, **options)
    )


def files_of_previous_day(files: DataFrame, now: dt.datetime) -> DataFrame:
    """Files whose name holds yesterday's date (on the feed's clock)."""
    name = F.element_at(F.split("path", "/"), -1)
    return files.where(name.contains(previous_day(now)))


def load_files(
    files: DataFrame,
    table: str,
    schema: T.StructType,
    skip_header: int = 0,
    sort_col: str | None = None,
    strict_append: bool = False,
) -> DataFrame:
    """Unzip and parse once, append; gives back the rejected rows and files."""
    rows = settle(parse_lines(member_lines(files), schema, skip_header=skip_header))
    good, rejected = split_quarantine(rows)
    append_table(good, table, sort_col=sort_col, strict_append=strict_append)
    return rejected


def daily_append(
    spark: SparkSession,
    folder: str,
    table: str,
    schema: T.StructType,
    now: dt.datetime,
    skip_header: int = 0,
    sort_col: str | None = None,
) -> DataFrame:
    """Append yesterday's zips of ``folder``; running it twice leaves the same table."""
    day = previous_day(now)
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{day}*.zip").load(folder)
    return load_files(files, table, schema, skip_header, sort_col)


def append_new_archives(
    spark: SparkSession,
    folder: str,
    table: str,
    schema: T.StructType,
    checkpoint: str,
    contains: str = "",
    skip_header: int = 0,
    sort_col: str | None = None,
    rejected: str | None = None,
) -> StreamingQuery:
    """Append the archives of ``folder`` that have come since the last run, as a stream that ends when it has them all; the
    checkpoint knows the last name. What cannot be read is stored by file under ``rejected`` (beside the checkpoint)."""
    aside = rejected or f"{checkpoint.rstrip('/')}-rejected"

    def batch(rows: DataFrame, _: int) -> None:
        good, bad = split_quarantine(settle(rows))
        append_table(good, table, sort_col=sort_col)
        append_table(bad.select(F.coalesce("source_file", F.lit("unreadable")).alias("source_file"), CORRUPT), aside)

    rows = parse_lines(archive_lines(spark, folder, contains, stream=True), schema, skip_header=skip_header)
    writer = rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def daily_stream(
    spark: SparkSession,
    folder: str,
    table: str,
    schema: T.StructType,
    now: dt.datetime,
    checkpoint: str,
    skip_header: int = 0,
    sort_col: str | None = None,
) -> StreamingQuery:
    """Yesterday's archives of ``folder`` that are not in the table yet; a second run of the day adds nothing."""
    return append_new_archives(spark, folder, table, schema, checkpoint, previous_day(now), skip_header, sort_col)


def on_new_content(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    process: Callable[[DataFrame], None],
    files_per_batch: int = 64,
) -> StreamingQuery:
    """Call ``process`` with the good rows of the files whose content was not seen before, under whatever name.

    The digests of all contents are the keyed state of the stream and live in its checkpoint, so a restart knows them. A
    file is taken by its digest first and parsed only if that is new; of equal files that come together one is taken. A
    file of any size is hashed some megabytes at a time. A batch that fails is processed again, so ``process`` replaces by file.
    """
    files = (
        spark.readStream.format("binaryFile").schema(BINARY).option("pathGlobFilter", "*.csv").option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )
    files = content_digests(files, folder)

    def batch(fresh: DataFrame, _: int) -> None:
        paths = [r["path"] for r in fresh.select("path").orderBy("path").collect()]  # at most files_per_batch
        if paths:
            read = spark.read.schema(with_corrupt(GKG)).csv(paths, sep="\t", header=True, enforceSchema=True, mode="PERMISSIVE")
            process(split_quarantine(settle(with_source_file(read)))[0])

    writer = files.dropDuplicates(["digest"]).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def ingest(
    index: DataFrame,
    files: DataFrame,
    landing: str,
    table: str,
    rejected: str,
    schema: T.StructType,
    include: Sequence[str],
    exclude: Sequence[str] = (),
    now: dt.datetime | None = None,
    skip_header: int = 0,
    sort_col: str | None = None,
) -> DataFrame:
    """The whole load: the index names the archives, those that have landed are unzipped once, their members are
    stored as text, parsed, and appended by file; bad lines and files are stored under ``rejected``.

    ``index`` has the lines of the index page, ``files`` the landed archives (path, content). With ``now`` only
    yesterday's archives are taken. Gives back the names that were asked for and whether they were there.
    """
    terms = [*include, previous_day(now)] if now else list(include)
    chosen = select_source_files(index, "", terms, exclude)
    names = settle(chosen.select(F.element_at(F.split("url", "/"), -1).alias("name")).distinct())
    name = F.element_at(F.split("path", "/"), -1)
    found = files.withColumn("name", name)
    landed = lookup_join(found, names, "name", "left_semi").drop("name")
    lines = settle(member_lines(landed))
    land_raw(lines, landing)
    good, bad = split_quarantine(settle(parse_lines(lines, schema, skip_header=skip_header)))
    append_table(good, table, sort_col=sort_col)
    append_table(bad.select("source_file", CORRUPT), rejected)
    there = found.select("name", F.lit(True).alias("landed")).distinct()
    return lookup_join(names, settle(there), "name", "left").select("name", F.coalesce("landed", F.lit(False)).alias("landed"))
