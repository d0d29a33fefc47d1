"""Paragraphs, texts of URLs, embeddings, topics and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import first_url, quoted
from ..functions.vectors import dense
from ..operators import text as X
from ..operators.cluster import mean_centres
from ..operators.represent import diverse_closest_per_cluster
from ..operators.spread import lookup_join
from ..session import settle
from .clusters import DRAWS_SQL
from .registry import query, table

TEXT_SQL = r"""
  SELECT page_id, url, coalesce(array_to_string([regexp_replace(p, '<[^>]+>', '', 'g') FOR p IN regexp_extract_all(
    regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)\s*>', '', 'g'),
    '(?is)<p(?:\s[^>]*)?>(.*?)</p\s*>', 1)], ' '), '') AS text FROM pages
"""
# three pages a row, the list of every second row starts with a blank URL
LISTS_SQL = """
  SELECT page_id // 3 AS row_id, CASE WHEN min(page_id) % 2 = 0 THEN ' <UDIV>' ELSE '' END
    || string_agg(' ' || url, '<UDIV>' ORDER BY page_id) AS urls FROM pages GROUP BY 1
"""


def page_texts(spark, sf, closed_only=True):
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    return X.extract_paragraph_text(pages, closed_only=closed_only).select("page_id", "url", "text")


def url_lists(spark, sf):
    pages = table(spark, sf, "pages").select(F.floor(F.col("page_id") / 3).alias("row_id"), "page_id", "url")
    rows = pages.groupBy("row_id").agg(
        F.min("page_id").alias("first"), F.array_sort(F.collect_list(F.struct("page_id", "url"))).alias("l")
    )
    blank = F.when(F.col("first") % 2 == 0, F.lit(" <UDIV>")).otherwise("")
    urls = F.array_join(F.transform("l", lambda s: F.concat(F.lit(" "), s["url"])), "<UDIV>")
    return rows.select("row_id", F.concat(blank, urls).alias("urls"))


@query("extract_paragraph_text")
def paragraphs(spark, sf):
    return page_texts(spark, sf, closed_only=False)


@query("extract_closed_paragraphs", TEXT_SQL)
def closed_paragraphs(spark, sf):
    return page_texts(spark, sf)


@query(
    "url_text_join",
    f"""SELECT d.doc_id, t.url, CASE WHEN t.text = '' THEN 'again: ' ELSE t.text END AS text
        FROM documents d LEFT JOIN ({TEXT_SQL}) t ON t.page_id = d.doc_id""",
)
def texts_of_urls(spark, sf):
    """Every page was fetched twice: the first text of a URL counts, the second only where that is empty."""
    once = settle(page_texts(spark, sf))
    again = once.select((F.col("page_id") + 10**9).alias("page_id"), "url", F.concat(F.lit("again: "), "text").alias("text"))
    texts = settle(X.one_text_per_url(once.unionByName(again)))
    links = table(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), "url")
    docs = table(spark, sf, "documents").select("doc_id").join(links, "doc_id", "left")
    return X.url_text_join(docs, texts.select("url", "text"), by=["doc_id"]).select("doc_id", "url", "text")


FIRST_SQL = f"""
  WITH l AS ({LISTS_SQL}), t AS ({TEXT_SQL}),
  e AS (SELECT row_id, generate_subscripts(string_split(urls, '<UDIV>'), 1) - 1 AS pos,
               trim(unnest(string_split(urls, '<UDIV>'))) AS url FROM l),
  m AS (SELECT e.row_id, e.pos, e.url, t.text, row_number() OVER (PARTITION BY e.row_id ORDER BY e.pos) AS r
        FROM e JOIN t ON e.url = t.url WHERE t.text <> '')
"""


@query(
    "first_text_per_row",
    FIRST_SQL + "SELECT row_id, pos::INTEGER AS pos, url, text FROM m WHERE r = 1",
)
def first_texts(spark, sf):
    texts = settle(page_texts(spark, sf))
    return X.first_text_per_row(url_lists(spark, sf), "row_id", "urls", texts)


@query(
    "drop_rows_without_text",
    FIRST_SQL + "SELECT row_id, urls FROM l WHERE row_id IN (SELECT row_id FROM m)",
)
def rows_with_text(spark, sf):
    texts = settle(page_texts(spark, sf))
    rows = url_lists(spark, sf)
    return X.drop_rows_without_text(rows, X.first_usable_url(rows, "row_id", "urls", texts), "row_id")


@query(
    "representative_text",
    FIRST_SQL
    + """SELECT l.row_id, t.text AS extracted_text FROM l LEFT JOIN t
         ON t.url = trim(string_split(l.urls, '<UDIV>')[1])""",
)
def first_url_texts(spark, sf):
    texts = settle(page_texts(spark, sf))
    rows = X.representative_text(url_lists(spark, sf), "urls", texts, ["row_id"])
    return rows.select("row_id", "extracted_text")


@query(
    "url_pieces",
    f"""SELECT row_id, trim(string_split(urls, '<UDIV>')[1]) AS first_url,
        len(string_split(urls, '<UDIV>'))::INTEGER AS urls FROM ({LISTS_SQL})""",
)
def url_pieces(spark, sf):
    rows = url_lists(spark, sf)
    return rows.select(
        "row_id", first_url("urls").alias("first_url"), F.size(F.split("urls", "<UDIV>", -1)).alias("urls")
    )


@query(
    "quoted_links",
    """SELECT page_id, string_split(html, '"')[2] AS link FROM pages""",
)
def quoted_links(spark, sf):
    return table(spark, sf, "pages").select("page_id", quoted("html").alias("link"))


@query("text_embedding")
def embedded(spark, sf):
    rows = X.text_embedding(table(spark, sf, "documents").select("doc_id", "text"))
    cells = F.filter(F.arrays_zip(F.sequence(F.lit(0), F.lit(X.EMBEDDING_WIDTH - 1)).alias("pos"),
                                  dense(rows, "embedding").alias("value")), lambda c: c["value"] != 0)
    return rows.select("doc_id", F.inline(cells).alias("pos", "value"))


def diverse_sample(spark, sf):
    """The sample that topics are made of: the closest and the diverse rows of the given clusters of ``embeddings``,
    with the texts of the documents of the same numbers."""
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    centres = settle(mean_centres(rows, "embedding", "label"))
    sample = diverse_closest_per_cluster(rows, "embedding", centres, cluster="label", ident="vec_id")
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    return settle(lookup_join(docs, settle(sample.select("vec_id", "label")), "vec_id"))


# Words that the queries leave out: an argument of the operator.
STOP = ("the", "of", "and", "to", "in", "is", "that", "it", "was", "for", "on", "are", "with", "as", "be", "at", "this", "have", "from", "or")


def topics_sql(sample: str, n_topics: int = X.TOPICS, rounds: int = X.TOPIC_ITERATIONS, seed: int = X.TOPIC_SEED) -> str:
    """Common table expressions that repeat the rounds over ``sample (cluster, text)``; ends with ``ranked``."""
    ks = range(n_topics)
    prior = f"(1.0::DOUBLE / {n_topics})"
    lots = ", ".join(
        f"1 + ('0x' || substr(md5('{seed}:' || doc || ':' || term || ':{k}'), 1, 12))::BIGINT / 281474976710656.0::DOUBLE AS q{k}" for k in ks
    )
    shares = ", ".join(f"q{k} / ({' + '.join(f'q{j}' for j in ks)}) AS r{k}" for k in ks)
    sums = lambda p: ", ".join(f"sum(n * r{k}) AS {p}{k}" for k in ks)
    stop = ", ".join(f"'{w}'" for w in STOP)
    parts = [
        f"""n AS MATERIALIZED (SELECT cluster, doc, term, count(*) AS n FROM (SELECT cluster, md5(text) AS doc,
            unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM ({sample})) WHERE term NOT IN ({stop}) GROUP BY ALL)""",
        f"r0 AS MATERIALIZED (SELECT cluster, doc, term, n, {shares} FROM (SELECT *, {lots} FROM n))",
    ]
    for t in range(1, rounds + 1):
        fresh = ", ".join(f"(t{k} + {prior}) / (w{k} + v * {prior}) * (d{k} + {prior}) AS q{k}" for k in ks)
        parts += [
            f"t{t} AS MATERIALIZED (SELECT cluster, term, {sums('t')} FROM r{t - 1} GROUP BY ALL)",
            f"d{t} AS MATERIALIZED (SELECT cluster, doc, {sums('d')} FROM r{t - 1} GROUP BY ALL)",
            f"w{t} AS MATERIALIZED (SELECT cluster, count(*) AS v, {', '.join(f'sum(t{k}) AS w{k}' for k in ks)} FROM t{t} GROUP BY ALL)",
            f"""r{t} AS MATERIALIZED (SELECT cluster, doc, term, n, {shares} FROM (SELECT r.cluster, r.doc, r.term, n, {fresh} FROM r{t - 1} r
                JOIN t{t} t ON r.cluster = t.cluster AND r.term = t.term JOIN d{t} d ON r.cluster = d.cluster AND r.doc = d.doc
                JOIN w{t} w ON r.cluster = w.cluster))""",
        ]
    heavy = " UNION ALL ".join(f"SELECT cluster, term, {k} AS topic, sum(n * r{k}) AS weight FROM r{rounds} GROUP BY ALL" for k in ks)
    parts.append(
        f"""ranked AS (SELECT * FROM (SELECT cluster, topic, term, row_number() OVER (PARTITION BY cluster, topic
            ORDER BY round(weight, 9) DESC, term) AS place FROM ({heavy})) WHERE place <= {n_topics})"""
    )
    return ",\n".join(parts)


SAMPLE_SQL = """SELECT label AS cluster, text FROM documents JOIN (SELECT DISTINCT label, vec_id FROM (SELECT *, row_number() OVER (
  PARTITION BY label, draw ORDER BY dist, vec_id) AS place FROM far) WHERE place = 1) ON doc_id = vec_id"""


@query(
    "cluster_topics",
    DRAWS_SQL
    + f""", {topics_sql(SAMPLE_SQL)} SELECT label, string_agg(line, '; ' ORDER BY topic) AS lda_topics FROM (SELECT cluster AS label,
        topic, string_agg(term, ', ' ORDER BY place) AS line FROM ranked GROUP BY ALL) GROUP BY label""",
)
def topics(spark, sf):
    """Topics of every cluster's diverse sample, term by term; SQL repeats the rounds."""
    return X.cluster_topics(diverse_sample(spark, sf), "label", "text", stop_words=STOP)


@query(
    "top_terms",
    f"WITH {topics_sql('SELECT source AS cluster, text FROM documents')} SELECT cluster AS source, topic::INTEGER AS topic, place::INTEGER AS place, term FROM ranked",
)
def terms(spark, sf):
    """The three heaviest terms of three topics of each source, over all its whole documents."""
    return X.topic_terms(table(spark, sf, "documents"), "source", "text", stop_words=STOP)


@query(
    "attach_topics",
    """SELECT d.doc_id, d.lang, 'topics of ' || t.lang || ': ' || t.n::VARCHAR AS lda_topics FROM documents d
       LEFT JOIN (SELECT lang, count(*) AS n FROM documents WHERE lang <> 'en' GROUP BY 1) t ON d.lang = t.lang""",
)
def with_topics(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    label = F.concat(F.lit("topics of "), "lang", F.lit(": "), F.count(F.lit(1)).cast("string"))
    topics = docs.where("lang <> 'en'").groupBy("lang").agg(label.alias("lda_topics"))
    return X.attach_topics(docs, topics, "lang")


SUMMARY_SQL = r"""
  WITH s AS (SELECT doc_id, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS sentence FROM (
         SELECT doc_id, string_split(regexp_replace(trim(text, ' '), '([.!?])[ \t\n\f\r\x0B]+', '\1' || chr(1), 'g'), chr(1)) AS l
         FROM documents)),
  w AS (SELECT doc_id, pos, unnest(regexp_extract_all(lower(sentence), '[\p{L}\p{N}_]{2,}')) AS word FROM s),
  c AS (SELECT doc_id, word, count(*) AS total FROM w GROUP BY 1, 2),
  r AS (SELECT w.doc_id, w.pos, sum(total)::DOUBLE / count(*) AS score FROM w JOIN c ON w.doc_id = c.doc_id AND w.word = c.word
        GROUP BY 1, 2 HAVING count(*) >= 4),
  b AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS place FROM r)
  SELECT d.doc_id, coalesce((SELECT string_agg(s.sentence, ' ' ORDER BY s.pos) FROM b JOIN s ON b.doc_id = s.doc_id
    AND b.pos = s.pos WHERE b.place <= 3 AND b.doc_id = d.doc_id), '#nosummary#') AS summary FROM documents d
"""


@query("summarise_representatives", SUMMARY_SQL)
def summaries(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return X.summarise(docs, "doc_id", "text").select("doc_id", "summary")
