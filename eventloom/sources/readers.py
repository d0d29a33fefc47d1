"""Typed readers for the feed's files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import ZONE, has_terms, quoted
from ..operators.spread import number_rows
from ..schemas import CALENDAR, EVENTS, GKG, cluster_profile_schema

CORRUPT = "_corrupt_record"


def previous_day(now: dt.datetime, zone: str = ZONE) -> str:
    """``yyyyMMdd`` of yesterday on the clock of ``zone``; ``now`` without a zone is UTC."""
    if now.tzinfo is None:
        now = now.replace(tzinfo=dt.timezone.utc)
    return (now.astimezone(ZoneInfo(zone)) - dt.timedelta(days=1)).strftime("%Y%m%d")


def previous_day_filter(
    include: Iterable[str], now: dt.datetime, zone: str = ZONE
) -> list[str]:
    """The include terms plus yesterday's date; the given list is left as it is."""
    return [*include, previous_day(now, zone)]


def select_source_files(
    index: DataFrame,
    base_url: str,
    include: Sequence[str],
    exclude: Sequence[str] = (),
    line: str = "value",
) -> DataFrame:
    """``(url)`` of the index lines that hold all of ``include`` and none of ``exclude``.

    The terms are looked for in the whole line; the link is the text between its first two quotes.
    """
    link = quoted(line)
    return index.where(has_terms(line, include, exclude) & link.isNotNull()).select(
        F.concat(F.lit(base_url.rstrip("/") + "/"), link).alias("url")
    )


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])


def _read_tsv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, header: bool, mode: str, quote: str
) -> DataFrame:
    reader = spark.read.schema(with_corrupt(schema) if mode == "PERMISSIVE" else schema)
    return reader.csv(
        path, sep="\t", header=header, mode=mode, quote=quote, enforceSchema=True, encoding="UTF-8"
    )


def read_events_tsv(
    spark: SparkSession, path: str | list[str], mode: str = "PERMISSIVE", quote: str = '"'
) -> DataFrame:
    """Tab-separated events without a header. In the default mode bad lines keep their text in
    ``_corrupt_record`` (see ``split_quarantine``)."""
    return _read_tsv(spark, path, EVENTS, False, mode, quote)


def read_gkg_tsv(
    spark: SparkSession, path: str | list[str], mode: str = "PERMISSIVE", quote: str = '"'
) -> DataFrame:
    """Tab-separated knowledge-graph rows below one header line."""
    return _read_tsv(spark, path, GKG, True, mode, quote)


def with_source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    return df.withColumn(name, F.col("_metadata.file_name"))


def split_quarantine(df: DataFrame, marker: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the rejected ones with what was wrong. Rejected rows of a plain file are read
    with all their columns or settled first; Spark refuses to scan a file for the marker alone."""
    return df.where(F.col(marker).isNull()).drop(marker), df.where(F.col(marker).isNotNull())


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CALENDAR).csv(path, header=True)


def long_profile(wide: DataFrame, k: int = 10) -> DataFrame:
    """Wide profile rows with a ``rank`` column to ``(cluster, rank, feature, appearance)``."""
    cells = ", ".join(f"{i}, feature_Centroid{i}, appereance_Centroid{i}" for i in range(1, k + 1))
    long = wide.selectExpr("rank", f"stack({k}, {cells}) AS (cluster, feature, appearance)")
    return long.where(F.col("feature").isNotNull()).select("cluster", "rank", "feature", "appearance")


def read_cluster_profile(spark: SparkSession, path: str, k: int = 10) -> DataFrame:
    """The wide profile as a long table; the rank is the row's place, counted over all its files in name order."""
    wide = spark.read.schema(cluster_profile_schema(k)).csv(path, header=True)
    placed = wide.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),  # grows along a split
    )
    ranked = number_rows(placed, ["_file", "_block", "_row"], "rank").drop("_file", "_block", "_row")
    return long_profile(ranked, k)


def scan_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A stored table; Spark prunes the columns and pushes the filters of whatever follows."""
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table
