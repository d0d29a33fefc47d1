"""Joins and numbering that hold when one key has a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settle

# A side is broadcast only when its measured size is below this.
BROADCAST_BYTES = 64 * 1024 * 1024
# A key is hot when it has more than this share of the rows, so there are at most 1/HOT_SHARE of them.
HOT_SHARE = 1e-3
# Narrow rows that one task may sort, where their number is known.
ONE_TASK_ROWS = 200_000
HOT_ROWS = 1_000_000
SPREAD = 64


def _bytes_of(value: Column, kind: T.DataType) -> Column:
    """Bytes of a value of any type: what varies is measured, level by level."""
    zero = F.lit(0).cast("bigint")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value).cast("bigint"), zero) + 24
    if isinstance(kind, VectorUDT):
        # its text has the cells that a sparse vector stores, and no others
        return F.coalesce(F.octet_length(value.cast("string")).cast("bigint"), zero) * 4 + 24
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)):
            return F.coalesce(F.size(value).cast("bigint"), zero) * 16 + 24
        sizes = F.transform(value, lambda v: _bytes_of(v, kind.elementType))
        return F.coalesce(F.aggregate(sizes, zero, lambda x, y: x + y), zero) + 24
    if isinstance(kind, T.MapType):
        keys = _bytes_of(F.map_keys(value), T.ArrayType(kind.keyType))
        return keys + _bytes_of(F.map_values(value), T.ArrayType(kind.valueType)) + 24
    if isinstance(kind, T.StructType):
        parts = [_bytes_of(value.getField(f.name), f.dataType) for f in kind.fields]
        return sum(parts, F.lit(24).cast("bigint"))
    return F.lit(16).cast("bigint")


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the in-memory size, from an aggregate over the rows themselves."""
    parts = [_bytes_of(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    row = sum(parts, F.lit(16).cast("bigint"))
    return df.agg(F.sum(row)).first()[0] or 0


def small_enough(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= limit


def hot_keys(
    df: DataFrame, key: str, share: float = HOT_SHARE, at_least: int = HOT_ROWS
) -> DataFrame:
    """Keys with more than ``share`` of the rows: at most ``1/share`` of them, whatever the data."""
    sizes = settle(df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")))  # the rows are read once
    limit = max((sizes.agg(F.sum("_rows")).first()[0] or 0) * share, at_least)
    return sizes.where((F.col("_rows") > limit) & F.col(key).isNotNull()).select(key)


def spread_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    by: Sequence[str] = (),
    spread: int = SPREAD,
    share: float = HOT_SHARE,
    at_least: int = HOT_ROWS,
) -> DataFrame:
    """Equi-join for a large left side whose keys may be very unequal; ``right`` has one row a key.

    Rows of hot keys are dealt over ``spread`` partitions by the hash of ``by``; only the matching
    right rows are copied that often. Left rows without a key are dealt out as well.
    ``how`` is inner, left or left_semi.
    """
    hot = F.broadcast(settle(hot_keys(left, key, share, at_least)).withColumn("_hot", F.lit(True)))
    deal = F.pmod(F.xxhash64(*(by or left.columns)), F.lit(spread)).cast("int")
    dealt = F.col("_hot") | F.col(key).isNull()
    left = left.join(hot, key, "left").withColumn("_deal", F.when(dealt, deal).otherwise(0))
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(spread - 1))).otherwise(
        F.array(F.lit(0))
    )
    right = right.join(hot, key, "left").withColumn("_deal", F.explode(copies)).drop("_hot")
    return left.drop("_hot").join(right, [key, "_deal"], how).drop("_deal")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    by: Sequence[str] = (),
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join to a keyed look-up table: broadcast when its measured size allows, else ``spread_join``."""
    if small_enough(right, limit):
        return left.join(F.broadcast(right), key, how)
    return spread_join(left, right, key, how, by)


def number_rows(
    df: DataFrame, order: Sequence[Column | str], name: str = "rn", rows: int | None = None
) -> DataFrame:
    """Exact 1-based row numbers in a total order, without bringing the rows into one task.

    The rows are range-partitioned and sorted once and written down; the number is the place inside
    the partition plus the size of the partitions before it (one row per partition). A caller that
    has already counted few ``rows`` gets a plain window.
    """
    if rows is not None and rows <= ONE_TASK_ROWS:
        place = F.row_number().over(Window.orderBy(*order)).cast("bigint")
        return df.withColumn(name, place)
    placed = settle(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + place + 1)
        .drop("_at", "_part", "_start")
    )


def rank_in_group(
    df: DataFrame, group: str, order: Sequence[Column | str], name: str = "rank"
) -> DataFrame:
    """``row_number`` per group for groups too large for a task: numbered over all rows, then
    shifted by the first number of the group."""
    numbered = number_rows(df, [group, *order], "_rn")
    firsts = numbered.groupBy(group).agg(F.min("_rn").alias("_first"))
    return (
        lookup_join(numbered, firsts, group)
        .withColumn(name, F.col("_rn") - F.col("_first") + 1)
        .drop("_rn", "_first")
    )
