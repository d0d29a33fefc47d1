"""Counts and series that a new file adds to: what a file contributes is kept by file and merged when it is read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import day_of
from ..operators.analysis import DAILY_CATEGORIES, in_country, in_period
from ..operators.features import token_counts
from ..schemas import TOKEN_COLUMNS, TOKEN_SEPARATOR
from ..sources.snapshots import TableSet

COUNTS = T.StructType().add("token", T.StringType()).add("count", T.LongType()).add("source_file", T.StringType())


def add_token_counts(
    tables: TableSet,
    df: DataFrame,
    name: str = "token_counts",
    file_col: str = "source_file",
    cols: Sequence[str] = TOKEN_COLUMNS,
    separator: str = TOKEN_SEPARATOR,
    alpha_only: bool = True,
) -> int:
    """Count the tokens of the files in ``df`` and put their counts in place of those files' earlier ones."""
    counts = token_counts(df, cols, separator, alpha_only, by=[file_col]).withColumnRenamed(file_col, "source_file")
    # a file that has no token any more still takes the place of its earlier counts
    files = df.select(F.col(file_col).alias("source_file")).distinct()
    files = files.select(F.lit(None).cast("string").alias("token"), F.lit(0).cast("bigint").alias("count"), "source_file")
    return tables.put(name, counts.select(*COUNTS.names).unionByName(files), "source_file")


def merged_token_counts(tables: TableSet, name: str = "token_counts", version: int | None = None) -> DataFrame:
    """``(token, count)`` over all files; a file costs its own tokens once, not a recount of the others."""
    counts = tables.read(name, COUNTS, version).where("token is not null")
    return counts.groupBy("token").agg(F.sum("count").alias("count"))


def _series_schema(categories: Mapping[str, Sequence[str]]) -> T.StructType:
    kinds = T.StructType().add("date", T.DateType()).add("source_file", T.StringType())
    for name in categories:
        kinds = kinds.add(name, T.LongType())
    return kinds.add("tone_sum", T.DoubleType()).add("tone_rows", T.LongType())


def add_daily_counts(
    tables: TableSet,
    df: DataFrame,
    name: str = "daily_counts",
    file_col: str = "source_file",
    date: Column | None = None,
    code: str = "EventCode",
    categories: Mapping[str, Sequence[str]] = DAILY_CATEGORIES,
    tone: str = "AvgTone",
    where: Column | None = None,
) -> int:
    """Add up the files in ``df`` by day: what each brings to every category and to the tone. A file may bring any days."""
    if where is None:
        where = in_country("Actor1Geo_CountryCode") & in_period("SQLDATE")
    date = day_of("SQLDATE") if date is None else date
    counts = [F.sum(F.when(F.col(code).isin(*codes), 1).otherwise(0)).alias(n) for n, codes in categories.items()]
    sums = [F.sum(F.col(tone).cast("double")).alias("tone_sum"), F.count(tone).alias("tone_rows")]
    kept = df.withColumn("_counts", F.coalesce(where, F.lit(False)))
    # a file without rows that count still has to take the place of its earlier rows, so its days stay with zeros
    zero = {n: F.when(F.col("_counts"), F.col(n)) for n in dict.fromkeys([code, tone])}
    parts = kept.select(date.alias("date"), F.col(file_col).alias("source_file"), "_counts", *[c.alias(n) for n, c in zero.items()])
    by_day = parts.groupBy("date", "source_file").agg(*counts, *sums, F.count_if("_counts").alias("n"))
    schema = _series_schema(categories).add("n", T.LongType())
    return tables.put(name, by_day.select(*schema.names), "source_file", "date")


def merged_daily_counts(
    tables: TableSet,
    name: str = "daily_counts",
    categories: Mapping[str, Sequence[str]] = DAILY_CATEGORIES,
    version: int | None = None,
    between: tuple[str, str] | None = None,
) -> DataFrame:
    """The series of ``daily_category_counts`` over all files; its correlations follow by ``corr_matrix``, whose input is a
    row a day. ``between`` opens only files that have such days."""
    parts = tables.read(name, _series_schema(categories).add("n", T.LongType()), version, between)
    if between is not None:
        parts = parts.where(F.col("date").cast("string").between(*between))
    total = parts.groupBy("date").agg(
        *[F.sum(n).alias(n) for n in categories], F.sum("tone_sum").alias("t"), F.sum("tone_rows").alias("r"), F.sum("n").alias("n")
    )
    return total.where("n > 0").select("date", *categories, F.try_divide("t", "r").alias("avg_tone"))
