"""The whole news analysis over documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.vectors import long_cells
from ..operators.cluster import FINAL_SEED, SWEEP, SWEEP_SEED, project_2d
from ..operators.text import one_text_per_url
from ..plans.relevant_news import most_covered_news, news_clusters, news_vectors, relevant_news
from ..session import settle
from .clusters import CHOSEN_SQL
from .features import _STRIP
from .fits import ROUNDS, kmeans_sql, stop_sql
from .ingestion import GKG_SQL, gkg_rows
from .registry import query, table
from .texts import STOP, SUMMARY_SQL, TEXT_SQL, page_texts, topics_sql


# The labels of the two columns stand for tokens in the clusters; the row of the vectors has the whole texts' tokens.
LABEL_COLUMNS = ("PERSONS", "ORGANIZATIONS")


def _inputs(spark, sf):
    """Knowledge-graph rows of the documents, the texts of the pages, and the given embeddings as those of the pages."""
    texts = settle(one_text_per_url(page_texts(spark, sf)))
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("at"), "embedding")
    pages = table(spark, sf, "pages").groupBy("url").agg(F.min("page_id").alias("at"))
    embeddings = pages.withColumn("at", F.col("at") % vectors.count()).join(vectors, "at")
    return gkg_rows(spark, sf), texts, settle(embeddings.select("url", F.col("embedding").cast("array<double>").alias("embedding")))


def vectors_sql(columns) -> str:
    """Common table expressions; ends with ``cells (id, pos, x)``, the non-zero cells of unit length, and ``rows_ (row_id,
    urls, numarts)``."""
    pieces = " UNION ALL ".join(f"SELECT row_id, unnest(regexp_split_to_array({c}, '[#;]')) AS piece FROM g WHERE {c} IS NOT NULL" for c in columns)
    return f"""
  g AS MATERIALIZED (SELECT *, SOURCES::BIGINT AS row_id FROM ({GKG_SQL}) WHERE NUMARTS >= 3),
  t AS MATERIALIZED (SELECT url, text FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY text = '', page_id) AS r FROM ({TEXT_SQL})) WHERE r = 1),
  l AS (SELECT row_id, generate_subscripts(string_split(SOURCEURLS, '<UDIV>'), 1) AS p, trim(unnest(string_split(SOURCEURLS, '<UDIV>'))) AS url FROM g),
  first_ AS MATERIALIZED (SELECT row_id, arg_min(url, p) AS url FROM l JOIN t USING (url) WHERE text <> '' GROUP BY 1),
  e AS (SELECT url, vec_id FROM (SELECT url, min(page_id) AS p FROM pages GROUP BY 1), (SELECT count(*) AS n FROM embeddings) JOIN embeddings ON vec_id = p % n),
  pieces AS MATERIALIZED ({pieces}),
  counted AS (SELECT token, count(*) AS count FROM (SELECT trim(piece, {_STRIP}) AS token FROM pieces) WHERE regexp_full_match(token, '\\p{{L}}+') GROUP BY 1),
  vocab AS MATERIALIZED (SELECT token, row_number() OVER (ORDER BY token) - 1 AS pos FROM (SELECT token, coalesce(sum(count) OVER (ORDER BY count DESC, token
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(count) OVER () AS total FROM counted) WHERE before < 0.8 * total),
  raw AS (SELECT DISTINCT row_id AS id, pos, 1.0::DOUBLE AS x FROM pieces JOIN vocab ON piece = token WHERE row_id IN (SELECT row_id FROM first_)
    UNION ALL SELECT row_id, (SELECT count(*) FROM vocab) + place - 1, x FROM first_ JOIN e USING (url) JOIN (SELECT vec_id,
    generate_subscripts(embedding, 1) AS place, unnest(embedding)::DOUBLE AS x FROM embeddings) USING (vec_id)),
  cells AS MATERIALIZED (SELECT id, pos, x / sqrt(sum(x * x) OVER (PARTITION BY id)) AS x FROM raw),
  rows_ AS MATERIALIZED (SELECT row_id, SOURCEURLS AS urls, NUMARTS AS numarts FROM g JOIN first_ USING (row_id))"""


@query(
    "news_vectors",
    f"WITH {vectors_sql(('THEMES', *LABEL_COLUMNS))} SELECT id AS row_id, pos::BIGINT AS position, round(x, 6) AS value FROM cells",
)
def vectors(spark, sf):
    """The non-zero cells of the combined vectors over the tokens of whole texts."""
    gkg, texts, embeddings = _inputs(spark, sf)
    rows = news_vectors(gkg, texts, embeddings, ident="SOURCES")
    return long_cells(rows, "row_id", "features").select("row_id", "position", F.round("x", 6).alias("value"))


DENSE_SQL = """SELECT r.row_id AS id, p.pos, coalesce(c.x, 0) AS x FROM rows_ r CROSS JOIN (SELECT DISTINCT pos FROM cells) p
  LEFT JOIN cells c ON c.id = r.row_id AND c.pos = p.pos"""
_CHOSEN = "(SELECT k FROM chosen)"
# All fits, then labels, centres and texts.
CLUSTERS_SQL = f"""WITH {vectors_sql(LABEL_COLUMNS)}, {kmeans_sql(DENSE_SQL, list(SWEEP), SWEEP_SEED)}, {CHOSEN_SQL},
  {kmeans_sql(DENSE_SQL, list(SWEEP), FINAL_SEED, name="h")},
  labels_ AS MATERIALIZED (SELECT id, label FROM h_rounds WHERE k = {_CHOSEN} AND t = {stop_sql("h", f"k = {_CHOSEN}")}),
  centres_ AS MATERIALIZED (SELECT c.* FROM ({" UNION ALL ".join(f"SELECT {t} AS t, * FROM h_c{t - 1}" for t in range(1, ROUNDS + 1))}) c
    WHERE k = {_CHOSEN} AND t = {stop_sql("h", f"k = {_CHOSEN}")}),
  told AS MATERIALIZED (SELECT r.*, label, trim(string_split(urls, '<UDIV>')[1]) AS url FROM rows_ r JOIN labels_ ON row_id = id)"""
_NEAR = """SELECT id, label, sum((u.x - m.x) * (u.x - m.x)) AS d FROM f_u u JOIN labels_ USING (id) JOIN centres_ m ON m.c = label AND m.pos = u.pos GROUP BY ALL"""


def _summary_sql(texts: str) -> str:
    """Summaries of ``texts (doc_id, text)``, null where there is no text."""
    return SUMMARY_SQL.replace("FROM documents d", f"FROM ({texts}) d").replace("FROM documents", f"FROM ({texts})").replace(
        "SELECT d.doc_id, coalesce(", "SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce("
    ).replace("'#nosummary#') AS summary", "'#nosummary#') END AS summary")


CLOSEST_SQL = f"SELECT label, arg_min(id, (round(d, 12), id)) AS row_id FROM ({_NEAR}) GROUP BY 1"
_BEST = f"SELECT b.label, b.row_id AS doc_id, told.urls, told.numarts, t.text FROM ({{}}) b JOIN told ON b.row_id = told.row_id LEFT JOIN t ON t.url = told.url"
_DRAWN = f"""SELECT label AS cluster, text FROM (SELECT DISTINCT label, row_id FROM (SELECT label, draw, arg_min(id, (d, id)) AS row_id FROM (
    SELECT id, label, draw, sqrt(sum((u.x - m.x) * (u.x - m.x))) AS d FROM f_u u JOIN labels_ USING (id) JOIN noisy m ON m.c = label AND m.pos = u.pos GROUP BY ALL)
    GROUP BY ALL)) JOIN told USING (label, row_id) JOIN t ON t.url = told.url"""
NOISY_SQL = """noisy AS MATERIALIZED (SELECT c, draw, pos, x + 0.2 * sqrt(-2 * ln(1 - ('0x' || substr(h, 1, 12))::BIGINT / 281474976710656.0::DOUBLE))
    * cos(2 * pi() * (('0x' || substr(h, 13, 12))::BIGINT / 281474976710656.0::DOUBLE)) AS x
    FROM (SELECT c, draw, pos, x, md5('0:' || c || ':' || draw || ':' || pos) AS h FROM centres_, (SELECT unnest(range(10)) AS draw)))"""


def _clusters(spark, sf):
    gkg, texts, embeddings = _inputs(spark, sf)
    return news_clusters(gkg, texts, embeddings, columns=LABEL_COLUMNS, ident="SOURCES"), texts


@query(
    "relevant_news",
    f"""{CLUSTERS_SQL}, {NOISY_SQL}, best AS MATERIALIZED ({_BEST.format(CLOSEST_SQL)}), {topics_sql(_DRAWN)},
        topics_ AS (SELECT cluster, string_agg(line, '; ' ORDER BY topic) AS lda_topics FROM (SELECT cluster, topic,
        string_agg(term, ', ' ORDER BY place) AS line FROM ranked GROUP BY ALL) GROUP BY 1),
        said AS ({_summary_sql("SELECT doc_id, text FROM best")})
        SELECT label::INTEGER AS cluster_label, urls AS SOURCEURLS, best.text AS extracted_text, summary, lda_topics
        FROM best JOIN said USING (doc_id) LEFT JOIN topics_ ON cluster = label""",
)
def relevant(spark, sf):
    """The final table: the news closest to each centre, its text and summary, the topics of the diverse sample."""
    clusters, texts = _clusters(spark, sf)
    return relevant_news(clusters, texts, stop_words=STOP)


@query(
    "most_covered_news",
    f"""{CLUSTERS_SQL}, best AS MATERIALIZED ({_BEST.format("SELECT label, arg_min(row_id, (-numarts, row_id)) AS row_id FROM told GROUP BY 1")}),
        said AS ({_summary_sql("SELECT doc_id, text FROM best")})
        SELECT label::INTEGER AS cluster_label, numarts AS NUMARTS, urls AS SOURCEURLS, best.text AS extracted_text, summary
        FROM best JOIN said USING (doc_id)""",
)
def most_covered(spark, sf):
    clusters, texts = _clusters(spark, sf)
    return most_covered_news(clusters, texts)


@query("dimension_reduction", f"{CLUSTERS_SQL} SELECT label::INTEGER AS cluster, count(*)::BIGINT AS points, true AS spread FROM labels_ GROUP BY 1")
def reduced(spark, sf):
    """Points of the 2-D view by cluster, and whether no point lies on the axes' origin."""
    clusters, _ = _clusters(spark, sf)
    view = project_2d(clusters.rows, "features").groupBy("cluster")
    return view.agg(F.count(F.lit(1)).alias("points"), F.bool_and((F.col("d1") != 0) & (F.col("d2") != 0)).alias("spread"))
