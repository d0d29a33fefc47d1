"""Representatives of clusters: most articles, closest, n closest, diverse.

No operator gathers a cluster: each reduces inside the partitions first (a minimum of structs, or
the partial row limit of the window), so a cluster with a third of all rows costs no more than the
others. ``ident`` is a unique, stable row id and settles every tie.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle
from .cluster import centre_distances, nearest_centroid_join

# Representatives per cluster, noise draws and their standard deviation.
CLOSEST = 10
DRAWS = 10
NOISE_STD = 0.2


def _least(df: DataFrame, group: str, order: Sequence[Column], ident: str, keep: Sequence[str]) -> DataFrame:
    """The row of each group with the least ``(order, ident)``, as a partially aggregated minimum."""
    keys = [c.alias(f"_o{i}") for i, c in enumerate(order)]
    rest = [c for c in dict.fromkeys(keep) if c not in (group, ident)]
    best = df.groupBy(group).agg(F.min(F.struct(*keys, F.col(ident), *rest)).alias("_b"))
    return best.select(group, *[F.col(f"_b.{c}").alias(c) for c in [ident, *rest]])


def max_articles_per_cluster(
    df: DataFrame,
    cluster: str = "cluster_label",
    metric: str = "NUMARTS",
    ident: str = "row_id",
    keep: Sequence[str] = ("NUMARTS", "SOURCEURLS"),
) -> DataFrame:
    """Row with the most articles of each cluster, the first one on ties."""
    rows = df.where(F.col(metric).isNotNull())
    return _least(rows, cluster, [-F.col(metric)], ident, [metric, *keep])


def closest_per_cluster(
    df: DataFrame,
    vec: str,
    centres: DataFrame,
    cluster: str = "cluster_label",
    ident: str = "row_id",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Row nearest to the centre of its cluster, the first one on ties."""
    near = nearest_centroid_join(df.select(ident, cluster, vec, *keep), vec, cluster, centres)
    return _least(near.drop(vec), cluster, [F.col("dist")], ident, ["dist", *keep])


def closest_n_per_cluster(
    df: DataFrame,
    vec: str,
    centres: DataFrame,
    n: int = CLOSEST,
    cluster: str = "cluster_label",
    ident: str = "row_id",
    keep: Sequence[str] = (),
) -> DataFrame:
    """The n nearest rows of each cluster with their ``rank``; each partition sends at most n."""
    near = nearest_centroid_join(df.select(ident, cluster, vec, *keep), vec, cluster, centres).drop(vec)
    place = F.row_number().over(Window.partitionBy(cluster).orderBy("dist", ident))
    return near.withColumn("rank", place).where(F.col("rank") <= n)


def normal_noise(*parts: Column | str) -> Column:
    """Standard normal number that follows from the parts alone (their md5, Box-Muller), so that it is the same in
    every run, for every order of the rows and in any engine."""
    digest = F.md5(F.concat_ws(":", *[F.col(p) if isinstance(p, str) else p for p in parts]).cast("binary"))
    # 12 hexadecimal digits each, as a share of 16**12; the first is kept above 0
    one, two = (F.conv(F.substring(digest, at, 12), 16, 10).cast("double") / float(16**12) for at in (1, 13))
    return F.sqrt(-2 * F.log(1 - one)) * F.cos(2 * math.pi * two)


def noisy_centres(
    centres: DataFrame, cluster: str, draws: int = DRAWS, std: float = NOISE_STD, seed: int = 0
) -> DataFrame:
    """Each centre shifted ``draws`` times by normal noise: ``(cluster, points)``, made where the centres are."""
    text = lambda c: c.cast("string")
    shifted = lambda draw: F.transform(
        "centre", lambda x, i: x + std * normal_noise(F.lit(str(seed)), text(F.col(cluster)), text(draw), text(i))
    )
    points = F.transform(F.sequence(F.lit(0), F.lit(draws - 1)), shifted)
    return centres.select(cluster, points.alias("points"))


def draws_join(df: DataFrame, vec: str, cluster: str, noisy: DataFrame, name: str = "dists") -> DataFrame:
    """Distances of each row to all noisy centres of its cluster, as one array (rows do not multiply)."""
    return centre_distances(df, vec, noisy, cluster, name)


def diverse_closest_per_cluster(
    df: DataFrame,
    vec: str,
    centres: DataFrame,
    draws: int = DRAWS,
    std: float = NOISE_STD,
    seed: int = 0,
    cluster: str = "cluster_label",
    ident: str = "row_id",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Nearest row to each noisy centre, without repeats: at most ``draws`` rows a cluster, with the
    first ``draw`` that chose them."""
    noisy = settle(noisy_centres(centres, cluster, draws, std, seed))
    far = draws_join(df.select(ident, cluster, vec, *keep), vec, cluster, noisy).drop(vec)
    best = far.groupBy(cluster).agg(
        *[F.min(F.struct(F.col("dists")[i], ident, *keep)).alias(f"_d{i}") for i in range(draws)]
    )
    picks = [
        F.struct(F.lit(i).alias("draw"), *[F.col(f"_d{i}.{c}").alias(c) for c in [ident, *keep]])
        for i in range(draws)
    ]
    chosen = best.select(cluster, F.explode(F.array(*picks)).alias("p")).select(cluster, "p.*")
    return chosen.groupBy(cluster, ident).agg(
        F.min("draw").alias("draw"), *[F.first(c).alias(c) for c in keep]
    )


def dedupe(df: DataFrame, by: Sequence[str], ident: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row for each distinct ``by``: the smallest id with its ``keep``; a partial minimum, never a gathered group."""
    best = df.groupBy(*by).agg(F.min(F.struct(ident, *keep)).alias("_b"))
    return best.select(*by, *[F.col(f"_b.{c}").alias(c) for c in (ident, *keep)])


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Number the rows in scan order and write them down, so that the ids never change again."""
    return settle(df.withColumn(name, F.monotonically_increasing_id()))
