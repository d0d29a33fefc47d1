"""Vocabularies, multi-hot encoders and assembled feature vectors."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Normalizer, VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import (
    day_of,
    is_alpha,
    prefixed,
    row_token_set,
    row_tokens,
    season_position,
    strip,
)
from ..schemas import COVERAGE, TOKEN_COLUMNS, TOKEN_SEPARATOR
from ..session import scratch_path, settle
from .spread import lookup_join, number_rows


def time_feature(df: DataFrame, date: Column | None = None, name: str = "time") -> DataFrame:
    return df.withColumn(name, season_position(day_of("SQLDATE") if date is None else date))


def concat_columns(df: DataFrame, cols: Sequence[str], name: str = "value") -> DataFrame:
    """The values of several columns below each other (one scan, nulls included)."""
    return df.select(F.explode(F.array(*cols)).alias(name))


def actor_frequencies(
    df: DataFrame, cols: Sequence[str] = ("Actor1Name", "Actor2Name")
) -> DataFrame:
    """``(value, count)`` over all the columns, nulls left out."""
    return (
        concat_columns(df, cols)
        .where(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def sort_tokens(counts: DataFrame, token: str = "token", count: str = "count") -> DataFrame:
    """Most frequent first; equal counts in value order."""
    return counts.orderBy(F.col(count).desc(), F.col(token))


def distinct_sorted_codes(df: DataFrame, column: str = "EventRootCode") -> DataFrame:
    return df.select(F.col(column).alias("code")).distinct().orderBy("code")


def token_counts(
    df: DataFrame,
    cols: Sequence[str] = TOKEN_COLUMNS,
    separator: str = TOKEN_SEPARATOR,
    alpha_only: bool = True,
    by: Sequence[str] = (),
) -> DataFrame:
    """``(token, count)`` over every occurrence in the columns, or ``(*by, token, count)``; tokens are stripped, and only
    those of letters count unless ``alpha_only`` is off."""
    pieces = df.select(*by, F.explode(row_tokens(cols, separator)).alias("piece")).groupBy(*by, "piece")
    # repeated pieces are counted before they are cleaned, so a piece is cleaned once, not per row
    tokens = pieces.agg(F.count(F.lit(1)).alias("n")).select(*by, strip("piece").alias("token"), "n")
    if alpha_only:
        # the test also looks at n, so the optimizer cannot move it below the count
        tokens = tokens.where(F.when(F.col("n") > 0, is_alpha("token")))
    return tokens.groupBy(*by, "token").agg(F.sum("n").alias("count"))


def vocab_by_coverage(counts: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Smallest set of the most frequent tokens that covers the share, with its alphabetical index.

    Order is (count descending, token); the token that reaches the share is included. The running
    sum goes over the histogram of counts, which has at most sqrt(2 * occurrences) rows, instead of
    over the tokens; only the tokens with the boundary count are put in order, and that by a
    distributed sort.
    """
    counts = settle(counts)
    before = Window.orderBy(F.col("count").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    occurrences = F.col("count") * F.col("tokens")
    edge = (
        counts.groupBy("count")
        .agg(F.count(F.lit(1)).alias("tokens"))
        .select(
            "count",
            "tokens",
            F.coalesce(F.sum(occurrences).over(before), F.lit(0)).alias("before"),
            F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("more"),
            F.sum(occurrences).over(every).alias("total"),
        )
        .where(F.col("before") < F.col("total") * F.lit(float(coverage)))
        .orderBy("count")
        .first()
    )
    if edge is None:
        return counts.select("token", F.lit(0).cast("bigint").alias("idx")).limit(0)
    target = coverage * edge["total"]
    wanted = max(math.ceil((target - edge["before"]) / edge["count"]) - 1, 0)
    while wanted < edge["tokens"] and edge["before"] + wanted * edge["count"] < target:
        wanted += 1
    kept = counts.where(F.col("count") > edge["count"]).select("token")
    tied = counts.where(F.col("count") == edge["count"]).select("token")
    if wanted < edge["tokens"]:
        tied = number_rows(tied, ["token"], "rn", edge["tokens"]).where(F.col("rn") <= wanted).select("token")
    return settle(vocabulary(kept.unionByName(tied), "token", rows=edge["more"] + wanted))


def vocabulary(
    df: DataFrame, value: str, order: Sequence[Column | str] | None = None, rows: int | None = None
) -> DataFrame:
    """Give each row of a one-row-a-value frame its 0-based place in ``order`` (default: by value)."""
    numbered = number_rows(df, list(order or [value]), "_n", rows)
    return numbered.withColumn("idx", F.col("_n") - 1).drop("_n")


def vocab_lookup_join(df: DataFrame, vocab: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Attach ``idx`` of the vocabulary; values outside it drop out."""
    return lookup_join(df, vocab, key, "inner", by)


def multi_hot_long(
    df: DataFrame,
    ident: str,
    vocab: DataFrame,
    cols: Sequence[str] = TOKEN_COLUMNS,
    separator: str = TOKEN_SEPARATOR,
    strip_on_match: bool = False,
) -> DataFrame:
    """Set positions as rows ``(ident, token, idx)``: exact for a vocabulary of any width."""
    tokens = df.select(ident, F.explode(row_token_set(cols, separator, strip_on_match)).alias("token"))
    return vocab_lookup_join(tokens, vocab, "token", [ident]).select(ident, "token", "idx")


def sparse_vectors(rows: DataFrame, cells: DataFrame, ident: str, width: int, name: str) -> DataFrame:
    """``rows`` with the sparse vector of each row's ``cells`` (ident, position, value); none give zeros.

    The cells of a row are gathered by its unique id and written in the storage form of a vector, so a vocabulary
    of any size needs no list on the driver and no Python.
    """
    cell = F.struct(F.col("position").cast("int").alias("position"), F.col("value").cast("double").alias("value"))
    kind = "array<struct<position:int,value:double>>"
    lists = cells.groupBy(ident).agg(F.array_sort(F.collect_list(cell)).cast(kind).alias("_c"))
    full = rows.join(lists, ident, "left").withColumn("_c", F.coalesce("_c", F.array().cast(kind)))
    stored = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(width).cast("int").alias("size"),
        F.transform("_c", lambda c: c["position"]).alias("indices"),
        F.transform("_c", lambda c: c["value"]).alias("values"),
    )
    path = scratch_path(rows.sparkSession, "vectors")
    full.withColumn(name, stored).drop("_c").write.parquet(path)
    schema = T.StructType([*(f for f in rows.schema.fields if f.name != name), T.StructField(name, VectorUDT())])
    return rows.sparkSession.read.schema(schema).parquet(path)


def vocabulary_width(vocab: DataFrame) -> int:
    return (vocab.agg(F.max("idx")).first()[0] or 0) + 1 if not vocab.isEmpty() else 0


def multi_hot(
    df: DataFrame,
    ident: str,
    values: Column,
    vocab: DataFrame,
    name: str,
    key: str = "token",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Sparse binary vector over the vocabulary ``(key, idx)`` of an array of texts; unknown texts set nothing. The result
    has the columns ``keep`` beside the id (all if not given), and only these are gathered and written."""
    present = df.select(ident, F.explode(F.array_distinct(F.array_compact(values))).alias(key))
    cells = vocab_lookup_join(present, vocab.select(key, "idx"), key, [ident])
    cells = cells.select(ident, F.col("idx").alias("position"), F.lit(1.0).alias("value"))
    rows = df if keep is None else df.select(ident, *keep)
    return sparse_vectors(rows, cells, ident, vocabulary_width(vocab), name)


def multi_hot_tokens(
    df: DataFrame,
    ident: str,
    vocab: DataFrame,
    cols: Sequence[str] = TOKEN_COLUMNS,
    separator: str = TOKEN_SEPARATOR,
    name: str = "multi_hot",
    strip_on_match: bool = False,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    return multi_hot(df, ident, row_token_set(cols, separator, strip_on_match), vocab, name, keep=keep)


def code_array(cols: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("string") for c in cols])


def encode_actor_pair(
    df: DataFrame,
    ident: str,
    vocab: DataFrame,
    cols: Sequence[str] = ("Actor1Name", "Actor2Name"),
    name: str = "actor_vector",
) -> DataFrame:
    """Binary vector with the positions of both actors set."""
    return multi_hot(df, ident, code_array(cols), vocab.withColumn("value", F.col("value").cast("string")), name, "value")


def encode_codes(
    df: DataFrame,
    ident: str,
    vocab: DataFrame,
    cols: Sequence[str] = ("EventRootCode", "EventBaseCode", "EventCode"),
    name: str = "event_vector",
) -> DataFrame:
    """Binary vector over the root codes; base and full codes count only if they are root codes."""
    return multi_hot(df, ident, code_array(cols), vocab.withColumn("code", F.col("code").cast("string")), name, "code")


def encode_long(
    df: DataFrame, ident: str, cols: Sequence[str], vocab: DataFrame, value: str = "code"
) -> DataFrame:
    """Long form of both encoders: ``(ident, value, idx)``, each position once per row."""
    values = df.select(ident, F.explode(F.array_distinct(F.array_compact(code_array(cols)))).alias(value))
    return vocab_lookup_join(values, vocab, value, [ident]).select(ident, value, "idx")


def assemble(df: DataFrame, cols: Sequence[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=name).transform(df)


def combine_and_normalise(
    df: DataFrame, cols: Sequence[str], name: str = "features", p: float = 2.0
) -> DataFrame:
    """Concatenate vectors and divide by the length; an all-zero row stays zero."""
    joined = assemble(df, cols, "_joined")
    return Normalizer(inputCol="_joined", outputCol=name, p=p).transform(joined).drop("_joined")


def feature_names(actors: DataFrame, codes: DataFrame, n_actors: int) -> DataFrame:
    """``(feature, position)`` of the assembled vector: time, then actors, then event codes."""
    spark = actors.sparkSession
    time = spark.range(1).select(F.lit("time").alias("feature"), F.col("id").alias("position"))
    first = actors.select(prefixed("actor_", "value").alias("feature"), (F.col("idx") + 1).alias("position"))
    last = codes.select(
        prefixed("event_", "code").alias("feature"), (F.col("idx") + 1 + n_actors).alias("position")
    )
    return time.unionByName(first).unionByName(last)
