"""Arithmetic on numeric arrays as higher-order functions (no Python in the hot path)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dense(df: DataFrame, name: str) -> Column:
    """Column ``name`` as ``array<double>``, whether it is an ML vector or an array."""
    if isinstance(df.schema[name].dataType, VectorUDT):
        return vector_to_array(F.col(name))
    return F.col(name).cast("array<double>")


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def squared_distance(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(squared_distance(a, b))


def set_positions(values: Column) -> Column:
    """Positions of the values that are not zero."""
    at = F.transform(values, lambda x, i: F.when(x != 0, i))
    return F.filter(at, lambda i: i.isNotNull())


def sparse_distance(at: Column, x: Column, squares: Column, centre: Column, length: Column) -> Column:
    """Distance of a vector given by its non-zero cells and sum of squares to a dense centre with
    squared length ``length``; the work follows the cells, not the width."""
    product = total(F.zip_with(at, x, lambda i, v: v * F.get(centre, i)))
    return F.sqrt(F.greatest(squares - 2 * product + length, F.lit(0.0)))


def squared_length(a: Column) -> Column:
    return total(F.transform(a, lambda x: x * x))


def stored_cells(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the vectors of column ``name`` replaced by their non-zero positions ``at`` and values ``x``.

    The vectors are read in their storage form, so a sparse vector is never made dense and nothing is written.
    """
    rows = df.withColumn("_v", F.unwrap_udt(name)).drop(name)
    every = F.when(F.size("_v.values") > 0, F.sequence(F.lit(0), F.size("_v.values") - 1)).otherwise(F.array().cast("array<int>"))
    cells = F.arrays_zip(F.coalesce("_v.indices", every).alias("at"), F.col("_v.values").alias("x"))
    rows = rows.withColumn("_v", F.filter(cells, lambda c: c["x"] != 0))
    return rows.select(*[c for c in rows.columns if c != "_v"], F.col("_v.at").alias("at"), F.col("_v.x").alias("x"))


def long_cells(df: DataFrame, ident: str, name: str) -> DataFrame:
    """Non-zero cells ``(ident, position, x)`` of the vectors of column ``name``."""
    rows = stored_cells(df.select(ident, name), name)
    return rows.select(ident, F.explode(F.arrays_zip("at", "x")).alias("_c")).select(
        ident, F.col("_c.at").cast("bigint").alias("position"), "_c.x"
    )
