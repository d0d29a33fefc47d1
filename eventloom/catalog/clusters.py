"""Clusters, representatives, profile and graph."""

from __future__ import annotations

from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from ..functions.columns import prefixed
from ..functions.vectors import squared_distance, total
from ..operators import cluster as C
from ..operators import graph as G
from ..operators import represent as R
from ..plans.actor_clusters import actor_graph
from ..session import scratch_path, settle
from ..sources.readers import read_cluster_profile
from ..sources.sinks import save_model, write_edges
from .features import PRIORITIES, STATUSES, orders_training
from .fits import kmeans_sql, mixture_sql, stop_sql
from .registry import query, table

POINTS_SQL = "SELECT vec_id, label, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings"
CENTRES_SQL = f"SELECT label, pos, avg(x) AS c FROM ({POINTS_SQL}) GROUP BY 1, 2"
DIST_SQL = f"""
  SELECT p.vec_id, p.label, sqrt(sum((p.x - m.c) * (p.x - m.c))) AS dist
  FROM ({POINTS_SQL}) p JOIN ({CENTRES_SQL}) m ON p.label = m.label AND p.pos = m.pos GROUP BY 1, 2
"""
LONG_SQL = """
  SELECT p_partkey, p_size % 10 + 1 AS cluster, 'actor_' || p_brand AS feature FROM part
  UNION ALL SELECT p_partkey, p_size % 10 + 1, 'event_' || p_type FROM part
"""
PROFILE_SQL = f"""
  SELECT cluster::INTEGER AS cluster, row_number() OVER (PARTITION BY cluster ORDER BY share DESC, feature)::INTEGER AS rank,
         feature, share AS appearance
  FROM (SELECT l.cluster, feature, count(*)::DOUBLE / any_value(n) AS share FROM ({LONG_SQL}) l
        JOIN (SELECT cluster, count(DISTINCT p_partkey) AS n FROM ({LONG_SQL}) GROUP BY 1) s ON l.cluster = s.cluster
        GROUP BY 1, 2)
"""
EXCLUDE = "Brand#2"
ACTORS_SQL = f"SELECT * FROM ({PROFILE_SQL}) WHERE contains(feature, 'actor') AND NOT contains(feature, '{EXCLUDE}')"
TOP_SQL = f"""
  SELECT cluster, feature AS event FROM (SELECT *, row_number() OVER (PARTITION BY cluster
    ORDER BY appearance DESC, rank) AS r FROM ({PROFILE_SQL}) WHERE contains(feature, 'event')) WHERE r = 1
"""
PAIRS_SQL = f"SELECT a.cluster, a.feature AS src, b.feature AS dst FROM ({ACTORS_SQL}) a JOIN ({ACTORS_SQL}) b ON a.cluster = b.cluster AND a.rank <> b.rank"
EDGES_SQL = f"SELECT src, dst, event, 'centroid_' || p.cluster AS centroid FROM ({PAIRS_SQL}) p JOIN ({TOP_SQL}) t ON p.cluster = t.cluster"


def points(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "embedding", "label")


def vectors(spark, sf):
    """Embeddings as unit ML vectors."""
    rows = points(spark, sf).withColumn("raw", array_to_vector(F.col("embedding").cast("array<double>")))
    from pyspark.ml.feature import Normalizer

    return Normalizer(inputCol="raw", outputCol="features").transform(rows).drop("raw")


def given_centres(rows):
    return settle(C.mean_centres(rows, "embedding", "label"))


def part_profile(spark, sf):
    part = table(spark, sf, "part")
    features = F.array(prefixed("actor_", "p_brand"), prefixed("event_", "p_type"))
    part = part.withColumn("cluster", F.col("p_size") % 10 + 1)
    long = part.select("p_partkey", "cluster", F.explode(features).alias("feature"))
    sizes = C.cluster_sizes(part, "cluster")
    return C.cluster_profile(long, "p_partkey", "cluster", "feature", sizes=sizes)


@query("cluster_profile", f"SELECT cluster, rank, feature, round(appearance, 6) AS appearance FROM ({PROFILE_SQL})")
def profile(spark, sf):
    return part_profile(spark, sf).withColumn("appearance", F.round("appearance", 6))


@query("filter_feature_kind", ACTORS_SQL.replace("SELECT *", "SELECT cluster, rank, feature"))
def feature_kind(spark, sf):
    return G.actor_features(part_profile(spark, sf), EXCLUDE).select("cluster", "rank", "feature")


@query("top_event_per_centroid", TOP_SQL)
def top_event(spark, sf):
    return G.top_event_per_centroid(part_profile(spark, sf))


@query("ordered_pairs_self_join", PAIRS_SQL)
def pairs(spark, sf):
    return G.ordered_pairs_self_join(G.actor_features(part_profile(spark, sf), EXCLUDE))


@query("attach_event_to_pairs", EDGES_SQL)
def attach_event(spark, sf):
    rows = part_profile(spark, sf)
    actors = G.actor_features(rows, EXCLUDE)
    return G.attach_event_to_pairs(G.ordered_pairs_self_join(actors), G.top_event_per_centroid(rows))


@query("actor_event_graph", EDGES_SQL)
def graph(spark, sf):
    return G.actor_event_graph(part_profile(spark, sf), EXCLUDE)


@query("write_edges", f'SELECT src AS "0", dst AS "1", event AS "2", centroid AS "3" FROM ({EDGES_SQL})')
def edges_file(spark, sf):
    path = scratch_path(spark, "edges")
    write_edges(G.actor_event_graph(part_profile(spark, sf), EXCLUDE), path)
    return spark.read.schema("`0` string, `1` string, `2` string, `3` string").csv(path, header=True)


@query("read_cluster_profile", f"SELECT cluster, rank::BIGINT AS rank, feature, round(appearance, 6) AS appearance FROM ({PROFILE_SQL})")
def profile_file(spark, sf):
    """The profile written as wide files (one row a rank) and read back."""
    rows = part_profile(spark, sf)
    wide = rows.groupBy("rank").pivot("cluster", list(range(1, 11))).agg(
        F.first("feature").alias("feature"), F.first("appearance").alias("appereance")
    )
    cells = [
        F.col(f"{i}_{kind}").alias(f"{kind}_Centroid{i}") for i in range(1, 11) for kind in ("feature", "appereance")
    ]
    path = scratch_path(spark, "profile")
    # several files: their names follow the ranges of the rank
    wide.repartitionByRange(4, "rank").sortWithinPartitions("rank").select(*cells).write.csv(path, header=True)
    return read_cluster_profile(spark, path).withColumn("appearance", F.round("appearance", 6))


@query("actor_clusters_graph")
def clusters_graph(spark, sf):
    """The whole actor plan: features, cosine k-means, profile, graph."""
    carry = ["o_orderpriority", "o_orderstatus"]
    _, labelled = orders_clusters(orders_training(spark, sf, carry))
    return actor_graph(labelled, "o_orderkey", ["o_orderpriority"], "o_orderstatus", top=100)


def orders_clusters(training):
    cells = training.cells.select("o_orderkey", "position", F.col("value").alias("x"))
    return C.kmeans_cosine(training.base, k=C.ACTOR_CLUSTERS, ident="o_orderkey", cells=cells)


# The same features with all positions, standardised and divided by their length.
ORDER_FLAGS_SQL = ", ".join(
    [f"(p = '{v}')::INTEGER::DOUBLE" for v in PRIORITIES] + [f"(s = '{v}')::INTEGER::DOUBLE" for v in STATUSES * 2]
)
ORDER_CELLS_SQL = f"""
  SELECT id, pos, x / sqrt(sum(x * x) OVER (PARTITION BY id)) AS x FROM (
    SELECT id, pos, (x - avg(x) OVER (PARTITION BY pos)) / stddev_samp(x) OVER (PARTITION BY pos) AS x FROM (
      SELECT o_orderkey AS id, unnest(['t', '1', '2', '3', '4', '5', 'F', 'O', 'P', 'eF', 'eO', 'eP']) AS pos,
             unnest([(30 * month(o_orderdate) + day(o_orderdate)) / 365.0::DOUBLE, {ORDER_FLAGS_SQL}]) AS x
      FROM (SELECT *, o_orderpriority AS p, o_orderstatus AS s FROM orders)))
"""


@query(
    "kmeans_cosine",
    f"""WITH {kmeans_sql(ORDER_CELLS_SQL, [C.ACTOR_CLUSTERS], 1, cosine=True)}
        SELECT id AS o_orderkey, label::INTEGER AS cluster FROM f_rounds WHERE t = {stop_sql()}""",
)
def cosine(spark, sf):
    """The label of every order; SQL repeats the fit."""
    return orders_clusters(orders_training(spark, sf))[1].select("o_orderkey", "cluster")


UNIT_SQL = f"SELECT vec_id AS id, pos, x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)) AS x FROM ({POINTS_SQL})"
SWEEP_SQL = f"WITH {kmeans_sql(UNIT_SQL, list(C.SWEEP), C.SWEEP_SEED)}"


@query("kmeans_sweep", f"{SWEEP_SQL} SELECT k::INTEGER AS k, round(cost, 6) AS wcss FROM f_costs WHERE t = {stop_sql()}")
def sweep(spark, sf):
    """The cost of each of the nine k, fitted together; SQL repeats the fits."""
    costs = C.kmeans_sweep(settle(vectors(spark, sf)), ident="vec_id")
    return costs.select("k", F.round("wcss", 6).alias("wcss"))


@query(
    "kmeans_sweep_labels",
    f"{SWEEP_SQL} SELECT id AS vec_id, k::INTEGER AS k, label::INTEGER AS label FROM f_rounds WHERE t = {stop_sql()}",
)
def sweep_labels(spark, sf):
    """The label of every vector under each k."""
    models = C.sweep_models(settle(vectors(spark, sf)), ident="vec_id")
    ks = F.lit(models.ks)
    rows = models.labels.select("vec_id", F.explode(F.arrays_zip(ks.alias("k"), F.col("labels").alias("label"))).alias("c"))
    return rows.select("vec_id", "c.k", "c.label")


def chosen_k(rows) -> int:
    return C.elbow_k(C.kmeans_sweep(rows, ident="vec_id"))


@query("kmeans_final", "SELECT vec_id, true AS nearest FROM embeddings")
def final(spark, sf):
    """Every vector under the k of the elbow, and whether its label is its nearest centre."""
    rows = settle(vectors(spark, sf))
    model, labelled = C.kmeans_final(rows, "features", chosen_k(rows))
    centres = F.lit([[float(x) for x in c] for c in model.clusterCenters()])
    far = F.transform(centres, lambda c: squared_distance(vector_to_array("features"), c))
    measured = labelled.select("vec_id", "cluster_label", far.alias("far"))
    return measured.select("vec_id", (F.get("far", "cluster_label") <= F.array_min("far") + 1e-9).alias("nearest"))


GMM_ROUNDS = 10
CHOSEN_SQL = f"""
  chosen AS MATERIALIZED (SELECT j + 2 AS k FROM (SELECT row_number() OVER (ORDER BY k) - 1 AS j, lead(cost, 2) OVER (ORDER BY k)
    - 2 * lead(cost) OVER (ORDER BY k) + cost AS bend FROM f_costs WHERE t = {stop_sql()}) WHERE bend IS NOT NULL ORDER BY bend, j LIMIT 1)
"""
START_SQL = f"SELECT id, label FROM h_rounds WHERE k = (SELECT k FROM chosen) AND t = {stop_sql('h', 'k = (SELECT k FROM chosen)')}"


@query(
    "gmm_labels",
    f"""{SWEEP_SQL}, {CHOSEN_SQL}, {kmeans_sql(UNIT_SQL, list(C.SWEEP), C.FINAL_SEED, name="h")},
        {mixture_sql(UNIT_SQL, START_SQL, GMM_ROUNDS)} SELECT id AS vec_id, label::INTEGER AS label FROM g_e""",
)
def mixture(spark, sf):
    """The component of every vector after ten rounds, as many components as the elbow's k; SQL repeats the fits."""
    rows = settle(vectors(spark, sf))
    found, _, _ = C.gmm_fit(rows, "features", chosen_k(rows), ident="vec_id", rounds=GMM_ROUNDS, tolerance=0.0)
    return found.labels.select("vec_id", "label")


@query(
    "project_2d",
    "SELECT label::BIGINT AS cluster, count(*)::BIGINT AS points, true AS ordered, true AS uncorrelated, true AS within_total "
    "FROM embeddings GROUP BY 1",
)
def projection(spark, sf):
    """Points by given cluster; the first axis has the larger variance, both are uncorrelated, and together they
    have no more than the vectors."""
    rows = settle(vectors(spark, sf))
    flat = settle(C.project_2d(rows, "features", "label"))
    v = flat.agg(F.var_samp("d1"), F.var_samp("d2"), F.covar_samp("d1", "d2")).first()
    spread = rows.select(Summarizer.variance(F.col("features")).alias("v")).select(total(vector_to_array("v")).alias("t"))
    whole = spread.first()["t"]
    facts = v[0] >= v[1], abs(v[2]) <= 1e-6 * v[0], v[0] + v[1] <= whole * (1 + 1e-9)
    names = "ordered", "uncorrelated", "within_total"
    counts = flat.groupBy(F.col("cluster").cast("bigint").alias("cluster")).agg(F.count(F.lit(1)).alias("points"))
    return counts.select("*", *[F.lit(bool(f)).alias(n) for f, n in zip(facts, names)])


@query("save_model", "SELECT count(*)::BIGINT AS points, 0::BIGINT AS different FROM embeddings")
def model_round_trip(spark, sf):
    """Labels of a stored and re-read model against those of the model itself."""
    rows = settle(vectors(spark, sf))
    model = C.fit_kmeans(rows, "features", C.ACTOR_CLUSTERS, C.FINAL_SEED, label="before")
    path = scratch_path(spark, "model")
    save_model(model, path)
    again = KMeansModel.load(path).setPredictionCol("after")
    both = again.transform(model.transform(rows))
    return both.agg(
        F.count(F.lit(1)).alias("points"), F.count_if(F.col("before") != F.col("after")).alias("different")
    )


@query("label_disagreement", "SELECT count(*) FILTER (WHERE quality <> toxic)::BIGINT AS different FROM labels")
def disagreement(spark, sf):
    return C.label_disagreement(table(spark, sf, "labels"), "quality", "toxic")


@query("wcss", f"SELECT round(sum(dist * dist), 5) AS wcss FROM ({DIST_SQL})")
def within(spark, sf):
    rows = points(spark, sf)
    cost = C.wcss(rows, "embedding", "label", given_centres(rows))
    return cost.select(F.round("wcss", 5).alias("wcss"))


@query("nearest_centroid_join", f"SELECT vec_id, label, round(dist, 6) AS dist FROM ({DIST_SQL})")
def own_centre(spark, sf):
    rows = points(spark, sf)
    near = C.nearest_centroid_join(rows, "embedding", "label", given_centres(rows))
    return near.select("vec_id", "label", F.round("dist", 6).alias("dist"))


@query(
    "closest_per_cluster",
    f"""SELECT vec_id, label, round(dist, 6) AS dist FROM (SELECT *, row_number() OVER (PARTITION BY label
        ORDER BY dist, vec_id) AS r FROM ({DIST_SQL})) WHERE r = 1""",
)
def closest(spark, sf):
    rows = points(spark, sf)
    best = R.closest_per_cluster(rows, "embedding", given_centres(rows), "label", "vec_id")
    return best.select("vec_id", "label", F.round("dist", 6).alias("dist"))


@query(
    "closest_n_per_cluster",
    f"""SELECT vec_id, label, round(dist, 6) AS dist, r::INTEGER AS rank FROM (SELECT *, row_number() OVER
        (PARTITION BY label ORDER BY dist, vec_id) AS r FROM ({DIST_SQL})) WHERE r <= 10""",
)
def closest_ten(spark, sf):
    rows = points(spark, sf)
    best = R.closest_n_per_cluster(rows, "embedding", given_centres(rows), R.CLOSEST, "label", "vec_id")
    return best.select("vec_id", "label", F.round("dist", 6).alias("dist"), "rank")


# Noise of seed 0: md5 of "seed:cluster:draw:position", two times twelve digits, Box-Muller.
DRAWS_SQL = f"""
  WITH p AS ({POINTS_SQL}), m AS ({CENTRES_SQL}),
  h AS (SELECT label, draw, pos, c, md5('0:' || label || ':' || draw || ':' || (pos - 1)) AS h FROM m, (SELECT unnest(range(10)) AS draw)),
  noisy AS (SELECT label, draw, pos, c + 0.2 * sqrt(-2 * ln(1 - ('0x' || substr(h, 1, 12))::BIGINT / 281474976710656.0::DOUBLE))
    * cos(2 * pi() * (('0x' || substr(h, 13, 12))::BIGINT / 281474976710656.0::DOUBLE)) AS c FROM h),
  far AS (SELECT vec_id, p.label, draw, sqrt(sum((x - c) * (x - c))) AS dist FROM p JOIN noisy n ON p.label = n.label AND p.pos = n.pos
    GROUP BY 1, 2, 3)
"""


@query(
    "diverse_closest_per_cluster",
    DRAWS_SQL
    + """SELECT label, vec_id, min(draw)::INTEGER AS draw FROM (SELECT *, row_number() OVER (PARTITION BY label, draw
         ORDER BY dist, vec_id) AS r FROM far) WHERE r = 1 GROUP BY 1, 2""",
)
def diverse(spark, sf):
    rows = points(spark, sf)
    centres = given_centres(rows)
    return R.diverse_closest_per_cluster(rows, "embedding", centres, cluster="label", ident="vec_id")


@query("draws_join", DRAWS_SQL + "SELECT vec_id, draw::INTEGER AS draw, round(dist, 6) AS dist FROM far")
def draws(spark, sf):
    rows = points(spark, sf)
    noisy = settle(R.noisy_centres(given_centres(rows), "label"))
    far = R.draws_join(rows, "embedding", "label", noisy)
    return far.select("vec_id", F.posexplode("dists").alias("draw", "dist")).withColumn("dist", F.round("dist", 6))


@query(
    "dedupe",
    """SELECT source, min(doc_id) AS doc_id, text FROM (SELECT source, doc_id, md5(text) AS text FROM documents) GROUP BY source, text""",
)
def distinct_samples(spark, sf):
    """One row per distinct text of a source, the first id: what drops repeated representatives."""
    rows = table(spark, sf, "documents").select("source", "doc_id", F.md5("text").alias("text"))
    return R.dedupe(rows, ["source", "text"], "doc_id")


@query(
    "concat_samples",
    f"""SELECT vec_id, label, 'first' AS sample FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY dist, vec_id) AS r
        FROM ({DIST_SQL})) WHERE r = 1 UNION ALL
        SELECT vec_id, label, 'ten' FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY dist, vec_id) AS r
        FROM ({DIST_SQL})) WHERE r <= 10""",
)
def samples(spark, sf):
    rows = points(spark, sf)
    centres = given_centres(rows)
    one = R.closest_per_cluster(rows, "embedding", centres, "label", "vec_id")
    ten = R.closest_n_per_cluster(rows, "embedding", centres, R.CLOSEST, "label", "vec_id")
    pick = lambda df, name: df.select("vec_id", "label", F.lit(name).alias("sample"))
    return pick(one, "first").unionByName(pick(ten, "ten"))


@query(
    "max_articles_per_cluster",
    """SELECT source, doc_id, n_chars FROM (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source
       ORDER BY n_chars DESC, doc_id) AS r FROM documents) WHERE r = 1""",
)
def most_articles(spark, sf):
    return R.max_articles_per_cluster(table(spark, sf, "documents"), "source", "n_chars", "doc_id", ["n_chars"])


ELBOW_SQL = f"""
  WITH p AS ({POINTS_SQL}),
  s AS (SELECT label, pos, sum(x) AS sx, count(*) AS n FROM p GROUP BY 1, 2),
  t AS (SELECT sum(x * x) AS total FROM p),
  g AS (SELECT k, least(label, k - 1) AS grp, pos, sum(sx) AS sx, sum(n) AS n
        FROM s, (SELECT unnest(range(2, 11)) AS k) GROUP BY 1, 2, 3),
  w AS (SELECT k, any_value(total) - sum(sx * sx / n) AS wcss FROM g, t GROUP BY k),
  d AS (SELECT k, wcss, lead(wcss) OVER (ORDER BY k) - wcss AS step FROM w),
  b AS (SELECT k, wcss, lead(step) OVER (ORDER BY k) - step AS bend, row_number() OVER (ORDER BY k) - 1 AS j FROM d)
"""


@query(
    "elbow_k",
    ELBOW_SQL
    + """SELECT j::INTEGER AS j, k::INTEGER AS k, round(wcss, 5) AS wcss, round(bend, 5) AS bend,
         ((SELECT j FROM b WHERE bend IS NOT NULL ORDER BY bend, j LIMIT 1) + 2)::INTEGER AS optimal_k FROM b""",
)
def elbow(spark, sf):
    """Costs of nine groupings of the embeddings (labels from k-1 on are one group) and their elbow."""
    cells = points(spark, sf).select("label", F.posexplode("embedding").alias("pos", "x"))
    cells = cells.withColumn("x", F.col("x").cast("double"))
    sums = cells.groupBy("label", "pos").agg(
        F.sum("x").alias("sx"), F.count(F.lit(1)).alias("n"), F.sum(F.col("x") * F.col("x")).alias("sq")
    )
    tried = sums.withColumn("k", F.explode(F.sequence(F.lit(2), F.lit(10))))
    groups = tried.groupBy("k", F.least("label", F.col("k") - 1).alias("grp"), "pos").agg(
        F.sum("sx").alias("sx"), F.sum("n").alias("n"), F.sum("sq").alias("sq")
    )
    cost = groups.groupBy("k").agg((F.sum("sq") - F.sum(F.col("sx") * F.col("sx") / F.col("n"))).alias("wcss"))
    cost = settle(cost)
    bends = C.second_differences(cost).withColumn("optimal_k", F.lit(C.elbow_k(cost)))
    return bends.withColumn("wcss", F.round("wcss", 5)).withColumn("bend", F.round("bend", 5))


@query(
    "euclidean_distance",
    """SELECT a.vec_id, round(sqrt(sum((a.x - b.c) * (a.x - b.c))), 6) AS dist FROM
       (SELECT vec_id, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings) a JOIN
       (SELECT pos, avg(x) AS c FROM (SELECT generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS x
        FROM embeddings) GROUP BY 1) b ON a.pos = b.pos GROUP BY 1""",
)
def distance_to_mean(spark, sf):
    """Distance of every vector to the overall mean (a single row on the driver)."""
    rows = points(spark, sf).withColumn("v", F.col("embedding").cast("array<double>"))
    mean = rows.agg(vector_to_array(Summarizer.mean(array_to_vector("v"))).alias("m")).first()["m"]
    centre = F.array(*[F.lit(float(x)) for x in mean])
    return rows.select("vec_id", F.round(F.sqrt(squared_distance(F.col("v"), centre)), 6).alias("dist"))
