"""Clustering: cosine k-means, choice of k, mixtures, profiles and a 2-D view."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.vectors import (
    dense,
    distance,
    long_cells,
    sparse_distance,
    squared_distance,
    squared_length,
    stored_cells,
)
from ..session import settle
from . import lloyd
from .spread import lookup_join, rank_in_group

# Clusters of the actor-event model, tried k of the sweep, and the seeds.
ACTOR_CLUSTERS = 10
SWEEP = range(2, 11)
SWEEP_SEED = 42
FINAL_SEED = 0
MAX_ITER = 300


def fit_kmeans(
    df: DataFrame, features: str, k: int, seed: int, measure: str = "euclidean", label: str = "cluster"
) -> KMeansModel:
    return KMeans(
        k=k,
        seed=seed,
        maxIter=MAX_ITER,
        distanceMeasure=measure,
        featuresCol=features,
        predictionCol=label,
    ).fit(df)


def kmeans_cosine(
    df: DataFrame,
    features: str = "features",
    k: int = ACTOR_CLUSTERS,
    seed: int = 1,
    with_mean: bool = True,
    label: str = "cluster",
    ident: str | None = None,
    cells: DataFrame | None = None,
) -> tuple[lloyd.Models, DataFrame]:
    """Standardise, then k-means by cosine distance; the model and ``df`` with the label.

    The angle of a zero vector is not defined: such rows take no part in the fit and keep a null label. Works on the
    non-zero cells: ``cells (ident, position, x)`` or, where they are not given, those of the vectors in ``features``;
    the mean that standardising takes off every cell is a number a position and a number a centre, so rows stay sparse.
    ``with_mean=False`` leaves the mean in.
    """
    df, row, cells = with_cells(df, features, ident, cells)
    prepared = lloyd.standard_cells(df.select(row), cells, row, with_mean)
    try:
        models = lloyd.kmeans(prepared, [k], seed, cosine=True)
    finally:
        prepared.close()
    labels = models.labels.select(row, F.col("labels")[0].alias(label))
    labelled = df.join(labels, row, "left")
    return models, labelled if ident else labelled.drop(row)


def with_cells(
    df: DataFrame, features: str, ident: str | None, cells: DataFrame | None = None
) -> tuple[DataFrame, str, DataFrame]:
    """``df``, its unique id column (numbered and written down where it has none) and its cells."""
    if ident is None:
        ident, df = "_row", settle(df.withColumn("_row", F.monotonically_increasing_id()))
    return df, ident, long_cells(df, ident, features) if cells is None else cells


def vector_cells(df: DataFrame, features: str, ident: str) -> lloyd.Cells:
    """The vectors of ``features``, prepared for fits; several fits may share them."""
    return lloyd.array_cells(stored_cells(df.select(ident, features), features), ident)


def sweep_models(
    df: DataFrame,
    features: str = "features",
    ks: Iterable[int] = SWEEP,
    seed: int = SWEEP_SEED,
    ident: str | None = None,
    tolerance: float = 1e-4,
    prepared: lloyd.Cells | None = None,
) -> lloyd.Models:
    """The models of all k, fitted together. ``prepared`` has the vectors where the caller shares them (see ``vector_cells``)."""
    if prepared is not None:
        return lloyd.kmeans(prepared, list(ks), seed, tolerance=tolerance, most=MAX_ITER)
    df, row, _ = with_cells(df, features, ident)
    own = vector_cells(df, features, row)
    try:
        return lloyd.kmeans(own, list(ks), seed, tolerance=tolerance, most=MAX_ITER)
    finally:
        own.close()


def kmeans_sweep(
    df: DataFrame,
    features: str = "features",
    ks: Iterable[int] = SWEEP,
    seed: int = SWEEP_SEED,
    ident: str | None = None,
    prepared: lloyd.Cells | None = None,
) -> DataFrame:
    """``(k, wcss)`` for each k. All models are fitted in the same rounds over the cells."""
    return sweep_costs(df.sparkSession, sweep_models(df, features, ks, seed, ident, prepared=prepared))


def sweep_costs(spark: SparkSession, models: lloyd.Models) -> DataFrame:
    return spark.createDataFrame(pa.table({"k": pa.array(models.ks, pa.int32()), "wcss": pa.array(models.costs, pa.float64())}))


def second_differences(sweep: DataFrame) -> DataFrame:
    """``(j, k, wcss, bend)``: bend is the second difference of the costs that starts at row j."""
    by_k = Window.orderBy("k")
    step = F.lead("wcss").over(by_k) - F.col("wcss")
    return (
        sweep.withColumn("step", step)
        .withColumn("bend", F.lead("step").over(by_k) - F.col("step"))
        .withColumn("j", F.row_number().over(by_k) - 1)
        .select("j", "k", "wcss", "bend")
    )


def elbow_row(sweep: DataFrame, offset: int = 2, rule: str = "argmin") -> DataFrame:
    """``optimal_k`` as one row: place of the least second difference plus ``offset``, first on ties.

    The reference rule (argmin, offset 2) leans to the flat end of a convex curve; offset 3 names the
    middle of the three costs, and ``argmax`` picks the sharpest bend.
    """
    bends = second_differences(sweep).where(F.col("bend").isNotNull())
    value = F.col("bend") if rule == "argmin" else -F.col("bend")
    best = bends.agg(F.min(F.struct(value.alias("v"), "j")).alias("b"))
    return best.select((F.col("b.j") + offset).cast("int").alias("optimal_k"))


def elbow_k(sweep: DataFrame, offset: int = 2, rule: str = "argmin") -> int:
    return elbow_row(sweep, offset, rule).first()["optimal_k"]


def kmeans_final(
    df: DataFrame, features: str, k: int, seed: int = FINAL_SEED, label: str = "cluster_label"
) -> tuple[KMeansModel, DataFrame]:
    model = fit_kmeans(df, features, k, seed, label=label)
    return model, model.transform(df)


def gmm_fit(
    df: DataFrame,
    features: str,
    k: int,
    seed: int = FINAL_SEED,
    ident: str | None = None,
    rounds: int = 100,
    tolerance: float = 1e-3,
) -> tuple[lloyd.Mixture, DataFrame, str]:
    """Mixture of ``k`` Gaussians with a variance for each position, started from k-means; the mixture, ``df`` with an id,
    and the id's name."""
    df, row, _ = with_cells(df, features, ident)
    prepared = vector_cells(df, features, row)
    try:
        start = lloyd.kmeans(prepared, [k], seed).labels.select(row, F.col("labels")[0].alias("label"))
        return lloyd.mixture(prepared, start, k, rounds, tolerance), df, row
    finally:
        prepared.close()


def gmm_labels(
    df: DataFrame, features: str, k: int, seed: int = FINAL_SEED, label: str = "gmm_label", ident: str | None = None, **options
) -> DataFrame:
    """``df`` with the most likely component of each row (see ``gmm_fit``)."""
    found, df, row = gmm_fit(df, features, k, seed, ident, **options)
    labelled = df.join(found.labels.select(row, F.col("label").alias(label)), row, "left")
    return labelled if ident else labelled.drop(row)


def label_disagreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """Number of rows whose two labels differ, by id as they are (not aligned)."""
    return df.agg(F.count_if(F.col(a) != F.col(b)).alias("different"))


def project_2d(df: DataFrame, features: str, label: str = "cluster_label") -> DataFrame:
    """``(d1, d2, cluster)``: the first two principal components, one row per input row.

    Each axis points to where its largest loading is positive.
    """
    first = df.select(features).first()
    kind = df.schema[label].dataType.simpleString()
    if first is None:
        return df.sparkSession.createDataFrame([], f"d1 double, d2 double, cluster {kind}")
    cells = sparse_cells(df, features, [label])
    axes = df.sparkSession.sparkContext.broadcast(principal_axes(cells, first[0].size))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, rows, at, x = flat_cells(batch)
            d = row_products(sizes, rows, at, x, axes.value)
            yield pa.RecordBatch.from_arrays([pa.array(d[:, 0]), pa.array(d[:, 1]), batch.column(label)], ["d1", "d2", "cluster"])

    return cells.mapInArrow(score, f"d1 double, d2 double, cluster {kind}")


def sparse_cells(df: DataFrame, features: str, keep: Sequence[str] = ()) -> DataFrame:
    """Non-zero positions and values of each vector as two arrays."""
    return stored_cells(df.select(*keep, features), features)


def flat_cells(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cells of each row of a batch, and the row, position and value of every cell."""
    sizes = batch.column("at").value_lengths().fill_null(0).to_numpy()
    at, x = (batch.column(name).flatten().to_numpy() for name in ("at", "x"))
    return sizes, np.repeat(np.arange(len(sizes)), sizes), at, x


def row_products(sizes: np.ndarray, rows: np.ndarray, at: np.ndarray, x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Product of each sparse row with the columns of ``axes``."""
    return np.stack([np.bincount(rows, x * axes[at, j], len(sizes)) for j in range(axes.shape[1])], axis=1)


def principal_axes(
    cells: DataFrame, width: int, k: int = 2, tolerance: float = 1e-8, seed: int = 0, most: int = 400
) -> np.ndarray:
    """First ``k`` principal axes of sparse rows of any width, by block Krylov steps with restarts.

    A step is one pass over the rows: each partition adds up x (x . block) and sends one row per touched
    position; the driver holds a few dozen vectors of the width and never a covariance. Steps go on until the
    residual of each axis is below ``tolerance`` of the first variance; if ``most`` steps do not get there, that is
    an error.
    """
    spark = cells.sparkSession
    cells = cells.select("at", "x").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = cells.count()
        totals = cells.select(F.explode(F.arrays_zip("at", "x")).alias("c"))
        totals = totals.groupBy("c.at").agg(F.sum("c.x").alias("s")).toPandas()
        mean = np.zeros(width)
        mean[totals["at"].to_numpy(int)] = totals["s"] / n

        def scatter(block: np.ndarray) -> np.ndarray:
            """Covariance (times n) times ``block``."""
            shared = spark.sparkContext.broadcast(block)
            names = [f"a{j}" for j in range(block.shape[1])]

            def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                current = shared.value
                sums = np.zeros_like(current)
                for batch in batches:
                    sizes, rows, at, x = flat_cells(batch)
                    products = row_products(sizes, rows, at, x, current)
                    for j in range(current.shape[1]):
                        sums[:, j] += np.bincount(at, x * products[rows, j], len(current))
                touched = np.flatnonzero(sums.any(axis=1))
                yield pa.RecordBatch.from_arrays([*map(pa.array, sums[touched].T.copy()), pa.array(touched)], [*names, "at"])

            parts = cells.mapInArrow(add_up, ", ".join(f"{c} double" for c in names) + ", at bigint")
            sums = parts.groupBy("at").agg(*[F.sum(c).alias(c) for c in names]).toPandas()
            moved = np.zeros_like(block)
            moved[sums["at"].to_numpy(int)] = sums[names].to_numpy()
            shared.unpersist()
            return moved - n * np.outer(mean, mean @ block)

        size = min(width, k + 4)
        block = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, size)))[0]
        basis, images = np.zeros((width, 0)), np.zeros((width, 0))
        for _ in range(most):
            basis, images = np.hstack([basis, block]), np.hstack([images, scatter(block)])
            small = basis.T @ images
            values, turns = np.linalg.eigh((small + small.T) / 2)
            values, turns = values[::-1], turns[:, ::-1]
            axes, residual = basis @ turns[:, :k], images @ turns[:, :k] - (basis @ turns[:, :k]) * values[:k]
            scale = max(values[0], np.finfo(float).tiny)
            if np.linalg.norm(residual, axis=0).max() <= tolerance * scale or basis.shape[1] >= width:
                axes = np.hstack([axes, np.zeros((width, k - axes.shape[1]))]) if axes.shape[1] < k else axes
                high = axes[np.abs(axes).argmax(axis=0), np.arange(k)]
                return axes * np.where(high < 0, -1.0, 1.0)
            # the next block: where the images of the leading directions leave the basis
            lead = turns[:, :size]
            fresh = images @ lead - (basis @ lead) * values[:size]
            if basis.shape[1] + size > 10 * size:
                keep = turns[:, : 4 * size]
                basis, images = basis @ keep, images @ keep
            fresh = fresh[:, : width - basis.shape[1]]
            for _ in range(2):
                fresh -= basis @ (basis.T @ fresh)
                fresh = np.linalg.qr(fresh)[0]
            block = fresh
        raise RuntimeError(f"the principal axes did not settle in {most} steps")
    finally:
        cells.unpersist()


def centres_of(model: KMeansModel, spark: SparkSession, cluster: str = "cluster_label") -> DataFrame:
    """The model's centres as rows ``(cluster, centre)``: k of them, already on the driver."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, f"{cluster} int, centre array<double>")


def model_centres(models: lloyd.Models, width: int, cluster: str = "cluster_label") -> DataFrame:
    """Centres of the first of ``models`` as rows ``(cluster, centre)``: k arrays of the width. A cluster that lost its rows
    has none."""
    k = models.ks[0]
    rows = models.centres.where("position >= 0").select("position", F.slice("v", 1, k).alias("v")).toArrow()
    centres = np.zeros((width, k))
    if rows.num_rows:
        centres[rows.column("position").to_numpy()] = np.stack(rows.column("v").to_pylist())
    alive = models.labels.select(F.col("labels")[0].alias("c")).distinct().toArrow().column("c").to_pylist()
    spark = models.labels.sparkSession
    return spark.createDataFrame([(c, centres[:, c].tolist()) for c in sorted(alive)], f"{cluster} int, centre array<double>")


def mean_centres(df: DataFrame, vec: str, cluster: str) -> DataFrame:
    """Centres of given clusters as their means (partially aggregated per partition)."""
    vector = array_to_vector(dense(df, vec))
    means = df.groupBy(cluster).agg(Summarizer.mean(vector).alias("mean"))
    return means.select(cluster, vector_to_array("mean").alias("centre"))


def centre_distances(df: DataFrame, vec: str, centres: DataFrame, cluster: str, name: str) -> DataFrame:
    """Add an array of distances to the ``points`` (array of arrays) of the row's cluster.

    Arrays are compared cell by cell. ML vectors, usually sparse, are compared by their non-zero cells; the vectors
    themselves are left out of the result.
    """
    if not isinstance(df.schema[vec].dataType, VectorUDT):
        joined = lookup_join(df, centres.select(cluster, "points"), cluster)
        x = dense(df, vec)
        return joined.withColumn(name, F.transform("points", lambda c: distance(x, c))).drop("points")
    rows = stored_cells(df, vec).withColumnsRenamed({"at": "_at", "x": "_x"})
    lengths = F.transform("points", lambda c: F.struct(c.alias("c"), squared_length(c).alias("l")))
    joined = lookup_join(rows, centres.select(cluster, lengths.alias("points")), cluster)
    squares = squared_length(F.col("_x"))
    joined = joined.withColumn("_sq", squares)
    far = F.transform("points", lambda p: sparse_distance(F.col("_at"), F.col("_x"), F.col("_sq"), p["c"], p["l"]))
    return joined.withColumn(name, far).drop("points", "_at", "_x", "_sq")


def nearest_centroid_join(
    df: DataFrame, vec: str, cluster: str, centres: DataFrame, name: str = "dist"
) -> DataFrame:
    """Distance of each row to the centre of its own cluster."""
    single = centres.select(cluster, F.array("centre").alias("points"))
    return centre_distances(df, vec, single, cluster, name).withColumn(name, F.col(name)[0])


def wcss(df: DataFrame, vec: str, cluster: str, centres: DataFrame) -> DataFrame:
    """Within-cluster sum of squares as one row."""
    joined = lookup_join(df.select(cluster, vec), centres.select(cluster, "centre"), cluster)
    return joined.agg(F.sum(squared_distance(dense(df, vec), F.col("centre"))).alias("wcss"))


def cluster_sizes(df: DataFrame, cluster: str) -> DataFrame:
    """``(cluster, size)`` of a frame with one row an item."""
    return df.groupBy(F.col(cluster).alias("cluster")).agg(F.count(F.lit(1)).alias("size"))


def cluster_profile(
    long: DataFrame,
    row: str,
    cluster: str,
    feature: str,
    top: int | None = None,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """``(cluster, rank, feature, appearance)`` from long rows ``(row, cluster, feature)``.

    Appearance is the share of the cluster's rows that have the feature; rank 1 is the largest, equal
    shares in feature order. ``top`` limits the report to the first ranks. ``sizes`` (see
    ``cluster_sizes``) spares the distinct over the long rows.
    """
    counts = long.groupBy(F.col(cluster).alias("cluster"), F.col(feature).alias("feature")).agg(
        F.count(F.lit(1)).alias("n")
    )
    if sizes is None:
        sizes = cluster_sizes(long.select(cluster, row).distinct(), cluster)
    shares = lookup_join(counts, settle(sizes), "cluster").select(
        "cluster", "feature", (F.col("n") / F.col("size")).alias("appearance")
    )
    order = [F.col("appearance").desc(), F.col("feature")]
    if top is None:
        ranked = rank_in_group(shares, "cluster", order)
    else:
        place = F.row_number().over(Window.partitionBy("cluster").orderBy(*order))
        ranked = shares.withColumn("rank", place).where(F.col("rank") <= top)
    return ranked.select("cluster", F.col("rank").cast("int").alias("rank"), "feature", "appearance")
