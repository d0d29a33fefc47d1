"""Fits over cells: both ways of a round, plain numpy, wide rows, likelihoods."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from eventloom.functions.vectors import long_cells, stored_cells
from eventloom.operators import cluster as C
from eventloom.operators import lloyd


@pytest.fixture(scope="module", autouse=True)
def by_value():
    import eventloom
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(eventloom)


def sparse(n, width, seed, share=0.3):
    rng = np.random.default_rng(seed)
    return rng.normal(rng.integers(0, 3, (n, 1)), 1, (n, width)) * (rng.random((n, width)) < share)


def frame(spark, x):
    rows = [(i, Vectors.sparse(x.shape[1], {int(j): float(r[j]) for j in np.flatnonzero(r)})) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, ["id", "features"])


def labels_of(models):
    return np.array([r.labels for r in models.labels.orderBy("id").collect()])


@pytest.mark.parametrize("cosine", [False, True])
def test_both_ways_and_numpy_agree(spark, monkeypatch, cosine):
    """The costs are those of the labels, labels are nearest centres, and tables of any size give the same fit."""
    x = sparse(300, 12, 1)
    x[7] = 0
    df = frame(spark, x)
    prepare = lloyd.standard_cells if cosine else lloyd.plain_cells
    cells = prepare(df.select("id"), long_cells(df, "id", "features"), "id")
    models = lloyd.kmeans(cells, [2, 3, 5], 4, cosine, tolerance=0.0)
    z = x
    if cosine:
        z = (x - x.mean(0)) / x.std(0, ddof=1)
        z /= np.linalg.norm(z, axis=1, keepdims=True)
    labels = labels_of(models)
    for i, k in enumerate(models.ks):
        centres = np.array([z[labels[:, i] == c].mean(0) for c in range(k)])
        if cosine:
            centres /= np.linalg.norm(centres, axis=1, keepdims=True)
        far = ((z[:, None] - centres) ** 2).sum(2)
        assert (far.argmin(1) == labels[:, i]).all()
        assert models.costs[i] == pytest.approx(far.min(1).sum() / (2 if cosine else 1))
    cells.close()
    monkeypatch.setattr(lloyd, "BROADCAST_BYTES", 0)
    again = prepare(df.select("id"), long_cells(df, "id", "features"), "id")
    assert not again.small
    wide = lloyd.kmeans(again, [2, 3, 5], 4, cosine, tolerance=0.0)
    assert (labels_of(wide) == labels).all() and wide.costs == pytest.approx(models.costs)
    again.close()


def test_a_model_does_not_depend_on_the_others(spark):
    df = frame(spark, sparse(200, 9, 3))
    together = C.sweep_models(df, "features", [2, 4, 6], 5, "id", tolerance=0.0)
    alone = C.sweep_models(df, "features", [4], 5, "id", tolerance=0.0)
    assert (labels_of(together)[:, 1] == labels_of(alone)[:, 0]).all()
    assert together.costs[1] == pytest.approx(alone.costs[0])


def test_one_scan_a_round_whatever_the_number_of_models(spark):
    df = frame(spark, sparse(120, 6, 2))
    tracker = spark.sparkContext.statusTracker()

    def jobs(ks):
        spark.sparkContext.setJobGroup(f"sweep {ks}", "")
        rounds = C.sweep_models(df, "features", ks, 5, "id", tolerance=0.0).rounds
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(f"sweep {ks}")), rounds

    (few, one), (many, all_) = jobs([3]), jobs(list(range(2, 11)))
    assert many - few <= 3 * abs(all_ - one) + 3


def test_a_million_positions(spark):
    """Rows of a few cells in a space of a million positions: no dense row, and the plan has no vector_to_array."""
    width = 1_000_000
    rows = [(i, Vectors.sparse(width, sorted({i % 3: 1.0, 1000 + i % 3: 2.0, (i * 7919) % width: 0.01}.items()))) for i in range(300)]
    df = spark.createDataFrame(rows, ["id", "features"])
    for cosine in (False, True):
        if cosine:
            _, labelled = C.kmeans_cosine(df, k=3, ident="id", with_mean=False)
            got = {r.id: r.cluster for r in labelled.collect()}
        else:
            got = dict(enumerate(labels_of(C.sweep_models(df, "features", [3], 1, "id"))[:, 0]))
            assert {len({got[i] for i in range(300) if i % 3 == g}) for g in range(3)} == {1}
        assert len(got) == 300
    assert "vector_to_array" not in stored_cells(df, "features")._jdf.queryExecution().toString()


def test_cells_of_dense_and_sparse_vectors(spark):
    df = spark.createDataFrame(
        [(1, Vectors.dense([0.0, 2.0, 3.0])), (2, Vectors.sparse(3, {1: 5.0})), (3, Vectors.dense([0.0, 0.0, 0.0])), (4, Vectors.sparse(3, {}))],
        ["id", "v"],
    )
    got = {r.id: (list(r.at), list(r.x)) for r in stored_cells(df, "v").collect()}
    assert got == {1: ([1, 2], [2.0, 3.0]), 2: ([1], [5.0]), 3: ([], []), 4: ([], [])}
    assert sorted(tuple(r) for r in long_cells(df, "id", "v").collect()) == [(1, 1, 2.0), (1, 2, 3.0), (2, 1, 5.0)]


def test_fewer_rows_than_clusters_and_no_rows(spark):
    x = np.array([[1.0, 0], [1, 0], [0, 1]])
    models = C.sweep_models(frame(spark, x), "features", [2, 3], 1, "id")
    labels = labels_of(models)
    assert models.costs == pytest.approx([0, 0]) and (labels[0] == labels[1]).all() and (labels[0] != labels[2]).all()
    empty = C.sweep_models(frame(spark, x).where("id < 0"), "features", [2], 1, "id")
    assert empty.costs == [0.0] and empty.labels.count() == 0


def test_likelihood_never_falls_and_matches_numpy(spark):
    x = sparse(250, 7, 8, share=0.7)
    df = frame(spark, x)
    found, _, _ = C.gmm_fit(df, "features", 3, ident="id", rounds=12, tolerance=0.0)
    gains = np.diff(found.likelihoods)
    assert (gains > -1e-8).all() and gains[0] > 0
    known = {r.position: r for r in found.parameters.collect()}
    means, variances = (np.array([getattr(known[j], n) for j in range(7)]).T for n in ("means", "variances"))
    density = np.log(found.weights) - 0.5 * (np.log(2 * np.pi * variances).sum(1) + ((x[:, None] - means) ** 2 / variances).sum(2))
    rows = found.labels.orderBy("id").collect()
    assert [r.label for r in rows] == density.argmax(1).tolist()
    top = density.max(1)
    ll = top + np.log(np.exp(density - top[:, None]).sum(1))
    assert [r.log_likelihood for r in rows] == pytest.approx(ll.tolist())
    assert found.likelihoods[-1] == pytest.approx(ll.sum())
    labelled = C.gmm_labels(df.select("features"), "features", 2, rounds=3)
    assert labelled.columns == ["features", "gmm_label"] and labelled.where(F.col("gmm_label").between(0, 1)).count() == 250


def test_rows_kept_as_arrays_fit_like_single_cells(spark):
    """Dense positions, rare ones, a row without cells, a value that is no number, an id that comes twice."""
    x = sparse(240, 40, 8, 0.05)
    x[:, :6] = np.random.default_rng(9).normal(0, 2, (240, 6))
    x[3], x[5, 1] = 0, np.nan
    df = frame(spark, x)
    df = df.unionByName(df.where("id = 7"))
    single = lloyd.plain_cells(df.select("id"), long_cells(df, "id", "features"), "id")
    arrays = C.vector_cells(df, "features", "id")
    assert (arrays.size, arrays.width) == (single.size, single.width)
    one, two = (lloyd.kmeans(cells, [2, 4], 3, most=4) for cells in (single, arrays))
    assert (labels_of(one) == labels_of(two)).all() and one.costs == pytest.approx(two.costs, nan_ok=True)
    single.close(), arrays.close()


def test_common_positions_are_a_bounded_block():
    rng = np.random.default_rng(2)
    x = np.where(rng.random((50, 300)) < np.where(np.arange(300) < 4, 0.9, 0.02), 1.5, 0)
    row, at = np.nonzero(x)
    common, block, (r, p, v) = lloyd._parted(row, at, x[row, at], 50, 300)
    assert set(range(4)) <= set(common) and block.size <= 4 * len(row)
    back = np.zeros_like(x)
    back[:, common] = block
    np.add.at(back, (r, p), v)
    assert (back == x).all()


def test_vectors_are_read_in_place_and_dealt_once_for_both_fits(spark, monkeypatch):
    """Reading cells writes nothing, and a frame that two fits share is prepared once."""
    from eventloom.plans import relevant_news as plan

    df = frame(spark, sparse(60, 8, 4)).withColumnRenamed("id", "row_id")
    assert "parquet" not in stored_cells(df, "features")._jdf.queryExecution().toString()
    made = []
    monkeypatch.setattr(plan, "news_vectors", lambda *a, **k: df.selectExpr("row_id", "features"))
    monkeypatch.setattr(plan, "vector_cells", lambda *a: made.append(C.vector_cells(*a)) or made[-1])
    clusters = plan.news_clusters(df, df, ks=[2, 3, 4])
    assert len(made) == 1 and clusters.rows.count() == 60


def test_standardised_rows_are_gathered_once(spark):
    """A row an id, whose cells are dealt as arrays; an id that comes twice is one row, rows without an id take no part."""
    x = sparse(80, 7, 6)
    df = frame(spark, x)
    rows = df.unionByName(df.where("id = 5")).unionByName(df.where("id = 6").withColumn("id", F.lit(None).cast("bigint")))
    cells = lloyd.standard_cells(rows.select("id"), long_cells(rows, "id", "features"), "id")
    assert cells.single
    got = {r.id: r for r in cells.lists.collect()}
    assert sorted(got) == list(range(80)) == sorted(r.id for r in cells.lists.collect())
    one = {r.id: sorted(zip(r.at, r.a)) for r in got.values()}
    assert len(one[5]) == 2 * (x[5] != 0).sum() and all(len(one[i]) == (x[i] != 0).sum() for i in range(80) if i != 5)
    counted = {r["id"]: r["n"] for r in cells.stored.groupBy("id").agg(F.count_if(F.col("position") == lloyd.CONSTANT).alias("n")).collect()}
    assert counted == {i: 1 + (i == 5) for i in range(80)}
    cells.close()
