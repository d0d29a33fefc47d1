import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from eventloom.functions.vectors import dense
from eventloom.operators import cluster as C
from eventloom.operators import graph as G
from eventloom.operators import represent as R
from eventloom.operators import spread as S


@pytest.fixture(scope="module")
def points(spark):
    """90 points around three directions; the first group holds most of them."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(90):
        group = 0 if i < 60 else 1 + i % 2
        rows.append((i, group, (np.eye(6)[group] * 5 + rng.normal(0, 0.3, 6)).tolist()))
    return spark.createDataFrame(rows, "row_id long, cluster_label int, v array<double>").repartition(5).cache()


def as_arrays(points):
    rows = points.orderBy("row_id").collect()
    return np.array([r.v for r in rows]), np.array([r.cluster_label for r in rows])


def test_elbow_rules(spark):
    costs = [100, 60, 45, 40, 38, 37, 36.5, 36.2, 36]
    sweep = spark.createDataFrame([(k + 2, float(c)) for k, c in enumerate(costs)], "k int, wcss double")
    bends = np.diff(np.diff(costs))
    assert C.elbow_k(sweep) == int(np.argmin(bends)) + 2 == 8
    assert C.elbow_k(sweep, offset=3) == 9
    assert C.elbow_k(sweep, offset=3, rule="argmax") == 3
    tied = spark.createDataFrame([(k, float(c)) for k, c in zip(range(2, 8), [9, 8, 6, 5, 3, 2])], "k int, wcss double")
    assert C.elbow_k(tied) == 2


def test_sweep_costs_are_sums_of_squares(spark, points):
    df = points.select(array_to_vector("v").alias("features"))
    sweep = {r.k: r.wcss for r in C.kmeans_sweep(df, "features", range(2, 5)).collect()}
    assert sorted(sweep) == [2, 3, 4] and sweep[2] > sweep[3]
    model, labelled = C.kmeans_final(points.withColumn("features", array_to_vector("v")).drop("cluster_label"), "features", 3)
    centres = C.centres_of(model, spark)
    cost = C.wcss(labelled, "v", "cluster_label", centres).first().wcss
    assert cost == pytest.approx(model.summary.trainingCost)
    assert {r.cluster_label for r in labelled.collect()} == {0, 1, 2}


def test_cosine_keeps_rows_that_do_not_turn(spark):
    rows = [(i, Vectors.dense([1.0, float(i % 3)])) for i in range(9)]
    _, labelled = C.kmeans_cosine(spark.createDataFrame(rows, ["id", "features"]), k=2)
    got = {r.id: r.cluster for r in labelled.collect()}
    assert len(got) == 9
    assert {got[i] for i in (1, 4, 7)} == {None}  # the mean of both columns: zero after standardising
    assert got[0] == got[3] == got[6] != got[2]


def test_label_disagreement(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (None, 1)], "a int, b int")
    assert C.label_disagreement(df, "a", "b").first().different == 2


@pytest.mark.parametrize("width", [1, 2, 6, 64, 1500])
def test_axes_are_the_principal_axes(spark, width):
    """Whatever the width, and with hardly a gap between the variances, the axes are the exact ones."""
    rng = np.random.default_rng(width)
    x = rng.normal(size=(120, width)) * (rng.random((120, width)) < 0.3) * np.linspace(1.2, 1, width)
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "row_id int, v array<double>")
    cells = C.sparse_cells(df.withColumn("features", array_to_vector("v")), "features")
    axes = C.principal_axes(cells, width)
    centred = x - x.mean(axis=0)
    exact = np.linalg.svd(centred, full_matrices=False)[2][:2].T
    for j in range(min(2, width)):
        assert abs(axes[:, j] @ exact[:, j]) > 1 - 1e-6
        assert axes[np.abs(axes[:, j]).argmax(), j] > 0
    flat = C.project_2d(df.select(array_to_vector("v").alias("features"), F.col("row_id").alias("cluster_label")), "features")
    got = np.array([(r.d1, r.d2) for r in flat.orderBy("cluster").collect()])
    assert np.allclose(got, x @ axes, atol=1e-9)


def test_axes_that_do_not_settle_are_an_error(spark, points):
    cells = C.sparse_cells(points.withColumn("features", array_to_vector("v")), "features")
    with pytest.raises(RuntimeError, match="settle"):
        C.principal_axes(cells, 50, most=1, tolerance=0.0)


def test_fits_leave_nothing_persisted(spark, points):
    df = points.select("row_id", array_to_vector("v").alias("features"))
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    C.kmeans_cosine(df, k=2)[1].count()
    C.kmeans_sweep(df, ks=range(2, 4)).count()
    C.project_2d(df.withColumnRenamed("row_id", "cluster_label"), "features").count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


@pytest.mark.parametrize("kind", ["array", "vector"])
def test_representatives_against_brute_force(spark, points, kind):
    x, labels = as_arrays(points)
    df = points.withColumn("f", F.col("v") if kind == "array" else array_to_vector("v"))
    centres = C.mean_centres(points, "v", "cluster_label")
    means = {c: x[labels == c].mean(axis=0) for c in range(3)}
    order = {c: sorted(np.flatnonzero(labels == c), key=lambda i: np.linalg.norm(x[i] - means[c])) for c in means}
    one = {r.cluster_label: r for r in R.closest_per_cluster(df, "f", centres).collect()}
    ten = R.closest_n_per_cluster(df, "f", centres).orderBy("cluster_label", "rank").collect()
    for c in means:
        assert one[c].row_id == order[c][0]
        assert one[c].dist == pytest.approx(np.linalg.norm(x[order[c][0]] - means[c]))
        assert [r.row_id for r in ten if r.cluster_label == c] == order[c][:10]
    noisy = {r.cluster_label: np.array(r.points) for r in R.noisy_centres(centres, "cluster_label", seed=4).collect()}
    spread = np.concatenate([(noisy[c] - means[c]).ravel() for c in means])
    assert abs(spread.mean()) < 0.06 and abs(spread.std() - R.NOISE_STD) < 0.05 and len(set(spread)) == len(spread)
    got = R.diverse_closest_per_cluster(df, "f", centres, seed=4).orderBy("cluster_label", "draw").collect()
    for c in means:
        mine = np.flatnonzero(labels == c)
        chosen = []
        for centre in noisy[c]:
            best = int(mine[np.argmin(np.linalg.norm(x[mine] - centre, axis=1))])
            if best not in chosen:
                chosen.append(best)
        assert [r.row_id for r in got if r.cluster_label == c] == chosen


def test_ties_go_to_the_smallest_id_and_partitions_send_few_rows(spark):
    df = spark.createDataFrame([(7, 0, [1.0]), (3, 0, [3.0]), (5, 0, [1.0])], "row_id long, cluster_label int, v array<double>")
    centres = spark.createDataFrame([(0, [2.0])], "cluster_label int, centre array<double>")
    assert R.closest_per_cluster(df, "v", centres).first().row_id == 3
    ten = R.closest_n_per_cluster(df, "v", centres, 2)
    assert [r.row_id for r in ten.orderBy("rank").collect()] == [3, 5]
    plan = ten._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_most_articles_first_on_ties_and_nulls_lose(spark):
    df = spark.createDataFrame(
        [(4, 0, 9, "d"), (2, 0, 9, "b"), (1, 0, None, "a"), (3, 1, 1, "c")],
        "row_id int, cluster_label int, NUMARTS int, SOURCEURLS string",
    )
    got = R.max_articles_per_cluster(df).orderBy("cluster_label").collect()
    assert [(r.row_id, r.NUMARTS, r.SOURCEURLS) for r in got] == [(2, 9, "b"), (3, 1, "c")]


def test_profile_shares_and_ranks(spark, monkeypatch):
    long = spark.createDataFrame(
        [(1, 1, "actor_A"), (1, 1, "event_1"), (2, 1, "actor_A"), (2, 1, "event_2"), (3, 2, "event_1")],
        "row int, cluster int, feature string",
    )
    expected = [(1, 1, "actor_A", 1.0), (1, 2, "event_1", 0.5), (1, 3, "event_2", 0.5), (2, 1, "event_1", 1.0)]
    got = C.cluster_profile(long, "row", "cluster", "feature").orderBy("cluster", "rank").collect()
    assert [tuple(r) for r in got] == expected
    top = C.cluster_profile(long, "row", "cluster", "feature", top=1).orderBy("cluster").collect()
    assert [tuple(r) for r in top] == [expected[0], expected[3]]


PROFILE = "cluster int, rank int, feature string, appearance double"


def test_graph_pairs_by_position(spark):
    profile = spark.createDataFrame(
        [(1, 1, "actor_A", 0.9), (1, 2, "actor_B", 0.8), (1, 3, "actor_A", 0.7), (1, 4, "actor_UNITED_STATES", 0.7),
         (1, 5, "event_1", 0.5), (1, 6, "event_2", 0.5), (2, 1, "actor_A", 0.9), (2, 2, "actor_B", 0.9),
         (3, 1, "actor_A", 0.9), (3, 2, "event_1", 0.1), (4, 1, "actor_ACTOR", 0.9), (4, 2, "Actor_X", 0.9), (4, 3, "event_9", 1.0)],
        PROFILE,
    )
    edges = [tuple(r) for r in G.actor_event_graph(profile).collect()]
    pairs = [("A", "B"), ("A", "A"), ("B", "A"), ("B", "A"), ("A", "A"), ("A", "B")]
    assert sorted(edges) == sorted((f"actor_{a}", f"actor_{b}", "event_1", "centroid_1") for a, b in pairs)


@pytest.mark.parametrize("cell_pairs", [10**6, 50])
def test_graph_has_all_pairs_of_a_large_cluster(spark, cell_pairs):
    n = 60
    rows = [(1, i, f"actor_{i}", 1.0 / i) for i in range(1, n + 1)] + [(2, 1, "actor_1", 1.0), (2, 2, "actor_2", 1.0)]
    pairs = G.ordered_pairs_self_join(spark.createDataFrame(rows, PROFILE), cell_pairs).collect()
    assert len(pairs) == len(set(pairs)) == n * (n - 1) + 2
