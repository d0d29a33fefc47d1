"""Actor-event graph of a cluster profile."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import prefixed
from ..session import settle
from .spread import lookup_join

EXCLUDED = "UNITED_STATES"
# Pairs that one cell makes at most, roughly.
CELL_PAIRS = 1_000_000


def actor_features(profile: DataFrame, exclude: str = EXCLUDED) -> DataFrame:
    feature = F.col("feature")
    return profile.where(feature.contains("actor") & ~feature.contains(exclude))


def event_features(profile: DataFrame) -> DataFrame:
    return profile.where(F.col("feature").contains("event"))


def top_event_per_centroid(profile: DataFrame) -> DataFrame:
    """``(cluster, event)``: event feature of greatest appearance, the earlier rank on ties."""
    best = F.max_by("feature", F.struct("appearance", -F.col("rank")))
    return event_features(profile).groupBy("cluster").agg(best.alias("event"))


def ordered_pairs_self_join(actors: DataFrame, cell_pairs: int = CELL_PAIRS) -> DataFrame:
    """All ordered pairs of a cluster's actors by position, n(n-1) of them: ``(cluster, src, dst)``.

    The pairs are the result itself. They are made in square cells, each holding a share of either side; their
    number follows from the size of the cluster, so that a cell makes about ``cell_pairs`` however large it is.
    """
    sizes = actors.groupBy("cluster").agg(F.count(F.lit(1)).alias("_size"))
    sizes = settle(sizes.select("cluster", F.ceil(F.col("_size") / math.sqrt(cell_pairs)).cast("int").alias("_blocks")))
    actors = lookup_join(actors, sizes, "cluster", by=["rank"])
    own = F.pmod(F.hash("rank"), F.col("_blocks"))
    every = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    left = actors.select(
        "cluster", F.col("rank").alias("src_rank"), F.col("feature").alias("src"),
        own.alias("row"), every.alias("col"),
    )
    right = actors.select(
        "cluster", F.col("rank").alias("dst_rank"), F.col("feature").alias("dst"),
        own.alias("col"), every.alias("row"),
    )
    # a given number of partitions is kept as it is, so the cells stay apart however small the input
    tasks = int(actors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = left.repartition(tasks, "cluster", "row", "col")
    joined = left.join(right, ["cluster", "row", "col"]).where("src_rank != dst_rank")
    return joined.select("cluster", "src", "dst")


def attach_event_to_pairs(pairs: DataFrame, events: DataFrame) -> DataFrame:
    """Edges ``(src, dst, event, centroid)``; a cluster without an event has no edges."""
    return lookup_join(pairs, events, "cluster", by=["src", "dst"]).select(
        "src", "dst", "event", prefixed("centroid_", "cluster").alias("centroid")
    )


def actor_event_graph(profile: DataFrame, exclude: str = EXCLUDED) -> DataFrame:
    events = top_event_per_centroid(profile)
    actors = actor_features(profile, exclude)
    return attach_event_to_pairs(ordered_pairs_self_join(actors), events)
