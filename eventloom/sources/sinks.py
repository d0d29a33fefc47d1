"""Writers: landing, typed tables, replacements, exports and models."""

from __future__ import annotations

from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_FILE = 1_000_000


def land_raw(lines: DataFrame, path: str) -> None:
    """Extracted members as text, one folder a member; landing a member again replaces it."""
    good = lines.where(F.col("error").isNull())
    good.select(F.col("source_file").alias("member"), F.col("line").alias("value")).write.mode(
        "overwrite"
    ).option("partitionOverwriteMode", "dynamic").partitionBy("member").text(path)


def append_table(
    df: DataFrame,
    path: str,
    file_col: str = "source_file",
    sort_col: str | None = None,
    strict_append: bool = False,
) -> None:
    """Add files to a typed table.

    The table is laid out by the file that brought the rows, so that loading a file again replaces
    its own rows and no others; the event day is never the unit, since a file also brings older
    days. ``sort_col`` orders each file's rows for row-group skipping. ``strict_append`` adds the
    rows whatever is there, so a file loaded twice counts twice.
    """
    if strict_append:
        df.write.mode("append").partitionBy(file_col).parquet(path)
        return
    if sort_col:
        df = df.sortWithinPartitions(file_col, sort_col)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        file_col
    ).parquet(path)


def ctas(df: DataFrame, path: str) -> None:
    """Create a table from a query; an existing one is an error."""
    df.write.mode("errorifexists").parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append_in_chunks(df: DataFrame, path: str, rows: int = ROWS_PER_FILE) -> None:
    """Append with at most ``rows`` rows a file."""
    df.write.mode("append").option("maxRecordsPerFile", rows).parquet(path)


def write_edges(df: DataFrame, path: str) -> None:
    """Graph as CSV with a header of column positions."""
    df.toDF(*[str(i) for i in range(len(df.columns))]).write.mode("overwrite").csv(path, header=True)


def save_model(model: MLWritable, path: str) -> None:
    model.write().overwrite().save(path)
