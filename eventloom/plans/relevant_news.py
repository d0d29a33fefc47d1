"""Relevant news of one knowledge-graph file: two result tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cluster import FINAL_SEED, SWEEP, elbow_k, kmeans_sweep, model_centres, project_2d, sweep_models, vector_cells
from ..operators.features import (
    combine_and_normalise,
    multi_hot_tokens,
    token_counts,
    vocab_by_coverage,
)
from ..operators.represent import (
    closest_per_cluster,
    diverse_closest_per_cluster,
    max_articles_per_cluster,
    with_row_id,
)
from ..operators.spread import lookup_join
from ..operators.text import (
    attach_topics,
    cluster_topics,
    first_usable_url,
    one_text_per_url,
    representative_text,
    summarise,
    text_embedding,
    texts_of,
)
from ..schemas import MIN_ARTICLES, TOKEN_COLUMNS, TOKEN_SEPARATOR
from ..session import settle
from ..sources.snapshots import TableSet

NEWS_COLUMNS = ("cluster_label", "SOURCEURLS", "extracted_text", "summary", "lda_topics")


@dataclass
class NewsTables:
    relevant_news: DataFrame
    dimension_reduction: DataFrame
    k: int


def news_vectors(
    gkg: DataFrame,
    texts: DataFrame,
    embeddings: DataFrame | None = None,
    min_articles: int = MIN_ARTICLES,
    columns: Sequence[str] = TOKEN_COLUMNS,
    separator: str = TOKEN_SEPARATOR,
    ident: str | None = None,
) -> DataFrame:
    """``(row_id, NUMARTS, SOURCEURLS, features)`` of the rows with a text: unit vectors of the
    multi-hot tokens and the text's embedding. ``texts`` is (url, text), one row a URL;
    ``embeddings`` is (url, embedding), worked out from the texts if not given. ``ident`` names a unique integer column
    that becomes the row id; without it rows are numbered as they are scanned. Columns that no vector shows are not written."""
    used = dict.fromkeys([*([ident] if ident else []), "NUMARTS", "SOURCEURLS", *columns])
    rows = gkg.where(F.col("NUMARTS") >= min_articles).select(*used)
    rows = settle(rows.withColumn("row_id", F.col(ident).cast("bigint"))) if ident else with_row_id(rows)
    vocab = vocab_by_coverage(token_counts(rows, columns, separator))
    chosen = settle(first_usable_url(rows, "row_id", "SOURCEURLS", texts))
    if chosen.isEmpty():
        schema = T.StructType([rows.schema[c] for c in ("row_id", "NUMARTS", "SOURCEURLS")])
        return gkg.sparkSession.createDataFrame([], schema.add("features", VectorUDT()))
    if embeddings is None:
        read = texts_of(settle(chosen.select("url").distinct()), texts)
        embeddings = text_embedding(read).select("url", "embedding")
    elif not isinstance(embeddings.schema["embedding"].dataType, VectorUDT):
        embeddings = embeddings.select("url", array_to_vector("embedding").alias("embedding"))
    vectors = lookup_join(chosen.select("row_id", "url"), settle(embeddings), "url", "inner", ["row_id"])
    kept = rows.join(chosen.select("row_id"), "row_id", "left_semi")  # one row an id on both sides
    # the texts' tokens are read where they are; what is gathered by row and written down is what the result has
    encoded = multi_hot_tokens(kept, "row_id", vocab, columns, separator, keep=["NUMARTS", "SOURCEURLS"])
    joined = encoded.join(vectors, "row_id")
    combined = combine_and_normalise(joined, ["multi_hot", "embedding"])
    return settle(combined.select("row_id", "NUMARTS", "SOURCEURLS", "features"))


@dataclass
class NewsClusters:
    """Labelled rows ``(row_id, NUMARTS, SOURCEURLS, features, cluster_label)`` and the centres."""

    rows: DataFrame
    centres: DataFrame
    k: int


def news_clusters(
    gkg: DataFrame,
    texts: DataFrame,
    embeddings: DataFrame | None = None,
    ks: Sequence[int] = SWEEP,
    offset: int = 2,
    rule: str = "argmin",
    columns: Sequence[str] = TOKEN_COLUMNS,
    ident: str | None = None,
) -> NewsClusters:
    """Vectors, the choice of k by the elbow, and the final labels. No row with a text: no cluster."""
    vectors = news_vectors(gkg, texts, embeddings, columns=columns, ident=ident)
    if vectors.isEmpty():
        spark = gkg.sparkSession
        centres = spark.createDataFrame([], "cluster_label int, centre array<double>")
        return NewsClusters(vectors.withColumn("cluster_label", F.lit(None).cast("int")), centres, 0)
    prepared = vector_cells(vectors, "features", "row_id")  # dealt once for both fits
    try:
        k = elbow_k(kmeans_sweep(vectors, "features", ks, ident="row_id", prepared=prepared), offset, rule)
        models = sweep_models(vectors, "features", [k], FINAL_SEED, "row_id", prepared=prepared)
    finally:
        prepared.close()
    labelled = vectors.join(models.labels.select("row_id", F.col("labels")[0].alias("cluster_label")), "row_id")
    return NewsClusters(settle(labelled), model_centres(models, vectors.first()["features"].size), k)


def relevant_news(
    clusters: NewsClusters, texts: DataFrame, seed: int = 0, stop_words: Sequence[str] | None = None
) -> DataFrame:
    """One row a cluster: its closest news with text, summary and the topics of a diverse sample."""
    rows, centres = clusters.rows, clusters.centres
    closest = settle(closest_per_cluster(rows, "features", centres, keep=["SOURCEURLS"]))  # a row a cluster, read twice
    closest = settle(representative_text(closest, "SOURCEURLS", texts, ["row_id"]))
    sample = settle(diverse_closest_per_cluster(rows, "features", centres, seed=seed, keep=["SOURCEURLS"]))
    sample = settle(representative_text(sample, "SOURCEURLS", texts, ["row_id"]))
    topics = cluster_topics(sample, "cluster_label", "extracted_text", stop_words=stop_words)
    news = attach_topics(summarise(closest, "row_id", "extracted_text"), topics)
    return settle(news.select(*NEWS_COLUMNS))


def relevant_news_tables(
    gkg: DataFrame, texts: DataFrame, embeddings: DataFrame | None = None, seed: int = 0, **options
) -> NewsTables:
    """The news of each cluster and the 2-D view of all rows."""
    texts = settle(one_text_per_url(texts.select("url", "text"), order="text"))
    clusters = news_clusters(gkg, texts, embeddings, **options)
    if not clusters.k:
        spark = gkg.sparkSession
        news = spark.createDataFrame([], ", ".join(f"{c} {'int' if c == 'cluster_label' else 'string'}" for c in NEWS_COLUMNS))
        return NewsTables(news, spark.createDataFrame([], "d1 double, d2 double, cluster int"), 0)
    news = relevant_news(clusters, texts, seed)
    return NewsTables(news, project_2d(clusters.rows, "features"), clusters.k)


def most_covered_news(clusters: NewsClusters, texts: DataFrame) -> DataFrame:
    """One row a cluster: its news with the most articles, with the text of its first URL and a summary."""
    best = settle(max_articles_per_cluster(clusters.rows, keep=["NUMARTS", "SOURCEURLS"]))
    best = settle(representative_text(best, "SOURCEURLS", texts, ["row_id"]))
    news = summarise(best, "row_id", "extracted_text")
    return news.select("cluster_label", "NUMARTS", "SOURCEURLS", "extracted_text", "summary")


def news_pipeline(gkg: DataFrame, texts: DataFrame, out: str, **options) -> NewsTables:
    """Work out both tables and replace the stored ones below ``out`` together: readers of ``TableSet(spark, out)`` see
    both old ones or both new ones, and a run that fails leaves the old ones."""
    tables = relevant_news_tables(gkg, texts, **options)
    TableSet(gkg.sparkSession, out).replace(
        {"dimension_reduction": tables.dimension_reduction, "relevant_news": tables.relevant_news}
    )
    return tables
