"""From an actor-event extract to clusters, their profile and the actor-event graph."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import prefixed
from ..operators.cluster import ACTOR_CLUSTERS, cluster_profile, cluster_sizes, kmeans_cosine
from ..operators.features import (
    actor_frequencies,
    distinct_sorted_codes,
    encode_long,
    feature_names,
    sparse_vectors,
    time_feature,
    vocabulary,
    vocabulary_width,
)
from ..operators.graph import actor_event_graph
from ..operators.lloyd import Models
from ..operators.spread import lookup_join
from ..session import settle

ACTORS = ("Actor1Name", "Actor2Name")
CODES = ("EventRootCode", "EventBaseCode", "EventCode")


@dataclass
class TrainingSet:
    """Rows ``base (ident, *carried)``, their non-zero ``cells (ident, position, value)`` and ``names (feature, position)``."""

    base: DataFrame
    cells: DataFrame
    names: DataFrame
    ident: str
    width: int

    @cached_property
    def rows(self) -> DataFrame:
        """``base`` with the sparse vector ``features``; gathered when it is first asked for."""
        return sparse_vectors(self.base, self.cells, self.ident, self.width, "features")

    def long(self, ident: str) -> DataFrame:
        """Non-zero cells as ``(ident, feature, value)``."""
        return lookup_join(self.cells, self.names, "position", by=[ident]).select(ident, "feature", "value")

    def wide(self, ident: str) -> DataFrame:
        """One column per feature; for exports, as wide as the vocabulary."""
        names = [r["feature"] for r in self.names.orderBy("position").collect()]
        cells = vector_to_array("features")
        kinds = ["double"] + ["int"] * (len(names) - 1)
        return self.rows.select(
            ident, *[cells[i].cast(k).alias(n) for i, (n, k) in enumerate(zip(names, kinds))]
        )


def training_set(
    df: DataFrame,
    ident: str = "GLOBALEVENTID",
    date: Column | None = None,
    actors: Sequence[str] = ACTORS,
    codes: Sequence[str] = CODES,
    carry: Sequence[str] = (),
) -> TrainingSet:
    """Time, actor pair and event code of each row as one sparse vector.

    Actors are ordered by frequency, codes by value. Rows and vocabularies stay on the executors; ``ident`` is
    unique.
    """
    counts = actor_frequencies(df, actors)
    people = settle(vocabulary(counts, "value", [F.col("count").desc(), "value"]).drop("count"))
    roots = settle(vocabulary(distinct_sorted_codes(df, codes[0]).where("code is not null"), "code"))
    n_actors, n_codes = vocabulary_width(people), vocabulary_width(roots)
    people_text = people.select(F.col("value").cast("string").alias("value"), "idx")
    roots_text = roots.select(F.col("code").cast("string").alias("code"), "idx")
    one = F.lit(1.0).alias("value")
    time = time_feature(df, date).select(ident, F.lit(0).cast("bigint").alias("position"), F.col("time").alias("value"))
    first = encode_long(df, ident, actors, people_text, "value").select(ident, (F.col("idx") + 1).alias("position"), one)
    last = encode_long(df, ident, codes, roots_text).select(ident, (F.col("idx") + 1 + n_actors).alias("position"), one)
    cells = settle(time.where("value <> 0").unionByName(first).unionByName(last))
    names = settle(feature_names(people, roots, n_actors))
    return TrainingSet(df.select(ident, *carry), cells, names, ident, 1 + n_actors + n_codes)


def row_features(df: DataFrame, ident: str, cluster: str, actors: Sequence[str], code: str) -> DataFrame:
    """Long rows ``(ident, cluster, feature)`` of labelled events, each feature once a row."""
    features = [prefixed("actor_", a) for a in actors] + [prefixed("event_", code)]
    return df.select(
        ident, cluster, F.explode(F.array_distinct(F.array_compact(F.array(*features)))).alias("feature")
    )


def actor_clusters(
    df: DataFrame,
    ident: str = "GLOBALEVENTID",
    date: Column | None = None,
    actors: Sequence[str] = ACTORS,
    codes: Sequence[str] = CODES,
    k: int = ACTOR_CLUSTERS,
    seed: int = 1,
    with_mean: bool = True,
) -> tuple[Models, DataFrame]:
    """Model and labelled rows; labels run from 0 and are null where the vector is zero."""
    carry = list(dict.fromkeys([*actors, *codes]))
    training = training_set(df, ident, date, actors, codes, carry)
    cells = training.cells.withColumnRenamed("value", "x")
    return kmeans_cosine(training.base, k=k, seed=seed, with_mean=with_mean, ident=ident, cells=cells)


def actor_graph(
    labelled: DataFrame,
    ident: str = "GLOBALEVENTID",
    actors: Sequence[str] = ACTORS,
    code: str = "EventRootCode",
    top: int | None = 100,
) -> DataFrame:
    """Edges of every cluster among its ``top`` features (None: all, and their pairs are the square of the
    vocabulary); centroids are numbered from 1."""
    rows = labelled.where("cluster is not null").withColumn("cluster", F.col("cluster") + 1)
    long = row_features(rows, ident, "cluster", actors, code)
    sizes = cluster_sizes(rows, "cluster")
    profile = cluster_profile(long, ident, "cluster", "feature", top, sizes)
    return actor_event_graph(settle(profile))
