"""Registered queries of the training-data operators, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import cap_filters, decontamination, html_text, near_dups, pieces, pitman_yor, quality, repeats, token_files, turn_repair, turn_tries, url_rules, warc_audit
from .batches import lean_batches

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    lean_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP8_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all({FOLD.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w
  FROM documents
), i AS (
  SELECT item_id, coalesce(regexp_extract_all({FOLD.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w
  FROM benchmark
), s AS (
  SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0
), win AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(w, p, p + n - 1), ' ') AS k FROM s
), sizes AS (SELECT DISTINCT n FROM win),
dp AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n
), hits AS (
  SELECT doc_id, p, n, item_id
  FROM (SELECT doc_id, p, n, array_to_string(list_slice(w, p, p + n - 1), ' ') AS k FROM dp) JOIN win USING (n, k)
), hit_words AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, p, n FROM hits)) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op8_decontamination", OP8_SQL)
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = decontamination.hit_words()
    return leaks.select(
        F.col("_key").alias("doc_id"),
        "n_words",
        hit.alias("n_hit"),
        F.size(F.array_distinct("item_ids")).cast("bigint").alias("n_items"),
        decontamination.ids_digest().alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


@query("op9_quality_rules")
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "posterior",
        *[c for c in judged.columns if c.startswith("vote_")],
    )


@query("op10_sentencepiece")
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op1_html_extraction")
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# The block list of the query: hosts, without their first label if it only names a service, that advertise.
SERVICES, JUNK = r"^(www|m|blog)\.", "spam|pills|casino"

OP4_SQL = f"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, {FOLD.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), listed AS (SELECT DISTINCT regexp_replace(host, '{SERVICES}', '') AS entry FROM p WHERE regexp_matches(host, '{JUNK}')),
bad AS (
  SELECT DISTINCT host FROM (SELECT DISTINCT host FROM p) JOIN listed ON host = entry OR ends_with(host, '.' || entry)
), r AS (
  SELECT p.*, bad.host IS NOT NULL AS on_list, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM p LEFT JOIN bad USING (host)
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN on_list THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""


@query("op4_url_filter", OP4_SQL)
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    hosts = pages.select(url_rules.host_and_path("url")[0].alias("host")).distinct()
    listed = hosts.where(F.col("host").rlike(JUNK)).select(F.regexp_replace("host", SERVICES, "").alias("entry"))
    return url_rules.judge(pages, listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query("op6_token_files")
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_files(
        table(spark, sf_dir, "documents"), scratch_path(spark, "tokens"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return token_files.read_documents(manifest).withColumnRenamed("key", "doc_id")


OP5_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all({FOLD.format("text")}, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN w ELSE [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] END) AS g
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
both_have AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM both_have JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach (doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.other = e.a
)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id, d.doc_id = min(other) AS kept
FROM documents d JOIN reach USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id
"""


@query("op5_near_duplicates", OP5_SQL)
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dups.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)
    return found.select(
        F.col("_key").alias("doc_id"),
        "n_shingles",
        F.col("component").alias("component_id"),
        (F.col("_key") == F.col("component")).alias("kept"),
    )


OP7_SQL = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
win AS (
  SELECT doc_id, p, md5(b[p:p + 199]) AS k FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - 198)) AS p FROM d)
), hits AS (SELECT doc_id, p FROM win WHERE k IN (SELECT k FROM win GROUP BY k HAVING count(*) > 1)),
marked AS (
  SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 200 THEN 0 ELSE 1 END AS fresh FROM hits
), numbered AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked),
spans AS (SELECT doc_id, run, min(p) AS low, max(p) + 199 AS high FROM numbered GROUP BY 1, 2),
pieces AS (
  SELECT doc_id, low, high, hex(b[coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) + 1:low - 1]) AS piece
  FROM spans JOIN d USING (doc_id)
), cut AS (
  SELECT doc_id, sum(high - low + 1) AS n_removed, count(*) AS n_spans, string_agg(piece, '' ORDER BY low) AS front, max(high) AS last
  FROM pieces GROUP BY 1
)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(CASE WHEN n_spans IS NULL THEN b ELSE unhex(front || hex(b[last + 1:octet_length(b)])) END) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""


@query("op7_repeats", OP7_SQL)
def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(table(spark, sf_dir, "documents"))


@query("op3_pitman_yor")
def op3_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(table(spark, sf_dir, "documents"))


OP2_SQL = """
SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS n_bytes, sha256(coalesce(html, '')) AS payload_sha256,
       page_id % 53 = 7 AS corrupt
FROM pages
"""


@query("op2_warc_audit", OP2_SQL)
def op2_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages in WARC files, a replica in which some records are damaged, and which records the audit finds."""
    first, second = scratch_path(spark, "warc"), scratch_path(spark, "replica")
    index = warc_audit.write_warc(table(spark, sf_dir, "pages"), first)
    warc_audit.copy_replica(index, first, second, F.col("key") % 53 == 7)
    corrupt = warc_audit.audit(index, first, second).withColumn("corrupt", F.lit(True))
    read = warc_audit.payloads(index, first).join(corrupt, ["file", "offset"], "left")
    return read.select(
        F.col("key").alias("page_id"), "n_bytes", "payload_sha256", F.coalesce("corrupt", F.lit(False)).alias("corrupt")
    )


OP11_SQL = """
WITH RECURSIVE g AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reach (vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a
), least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY 1)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings e JOIN least USING (vec_id)
"""


@query("op11_similar_vectors", OP11_SQL)
def op11_similar_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cap_filters.similar_vectors(table(spark, sf_dir, "embeddings"), cosine=0.95)
    return found.select(
        F.col("_key").alias("vec_id"),
        "n_links",
        F.col("component").alias("component_id"),
        F.col("_key").eqNullSafe(F.col("component")).alias("kept"),
    )


@query("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    fixed = turn_repair.repair(turn_repair.damage(rows), "conv", "turn", "role", "text")
    found = fixed.report.join(turn_repair.digests(fixed.turns), "_c", "left")
    whole = rows.select("conv_id").distinct().withColumn("_c", turn_repair.conversation_name("conv_id"))
    counts = "gaps", "blank", "duplicate", "truncated", "illegal", "cost"
    return whole.join(found, "_c", "left").select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )



def _heads_sql() -> str:
    """crc32 of the decimal id modulo 4, bit by bit over a table of 256 remainders."""
    return """
  bits (i, c, n) AS (SELECT i, i::UBIGINT, 0 FROM range(256) r(i) UNION ALL
    SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, n + 1 FROM bits WHERE n < 8),
  steps AS MATERIALIZED (SELECT i, c FROM bits WHERE n = 8),
  crc (conv, rest, c) AS (SELECT conv_id, conv_id::VARCHAR, 4294967295::UBIGINT FROM (SELECT DISTINCT conv_id FROM conversations
    WHERE conv_id IS NOT NULL) UNION ALL SELECT conv, rest[2:], xor(s.c, crc.c >> 8) FROM crc JOIN steps s
    ON s.i = xor(crc.c & 255, ascii(rest[1])::UBIGINT) WHERE rest <> ''),
  heads AS MATERIALIZED (SELECT conv, xor(c, 4294967295::UBIGINT) % 4 AS h FROM crc WHERE rest = '')"""


# A node is named by the digests of its turns; its ancestors lie on the path of its smallest member.
OP13_SQL = f"""
WITH RECURSIVE {_heads_sql()},
t AS MATERIALIZED (
  SELECT conv_id AS c, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
         len(coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []))::BIGINT AS w,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), paths AS MATERIALIZED (
  SELECT c, id, w, row_number() OVER (PARTITION BY c ORDER BY own, k) AS d FROM (
    SELECT h.conv AS c, id, w, k, 0 AS own FROM heads h JOIN t ON t.c = h.conv - h.conv % 20 WHERE k <= h.h
    UNION ALL SELECT t.c, id, w, k, 1 FROM t JOIN heads h ON t.c = h.conv WHERE k > h.h)
), named AS MATERIALIZED (
  SELECT c, d, w, md5(string_agg(id, '') OVER (PARTITION BY c ORDER BY d)) AS name FROM paths
  UNION ALL SELECT conv, 0, 0, '' FROM heads
), own AS MATERIALIZED (
  SELECT name, d, min(c) AS conv_id, count(*) AS n_convs, any_value(w) AS w FROM named GROUP BY 1, 2
), last AS (SELECT c, max(d) AS d FROM named GROUP BY 1),
ends AS (
  SELECT name, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends FROM named JOIN last USING (c, d) GROUP BY 1
), up AS MATERIALIZED (
  SELECT o.name, p.name AS parent FROM own o JOIN named p ON p.c = o.conv_id AND p.d = o.d - 1
), kids AS (SELECT parent AS name, count(*) AS n_children FROM up GROUP BY 1),
sums AS (
  SELECT a.name, sum((o.n_convs - 1) * o.w) AS saved, count(*) FILTER (WHERE n_children IS NULL) AS leaves
  FROM own o JOIN named a ON a.c = o.conv_id AND a.d <= o.d LEFT JOIN kids ON kids.name = o.name GROUP BY 1
)
SELECT o.conv_id, o.d::BIGINT AS depth, p.conv_id AS parent_conv_id, o.n_convs::BIGINT AS n_convs,
       coalesce(n_children, 0)::BIGINT AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens,
       coalesce(ends, sha256('')) AS ends_sha256
FROM own o JOIN sums USING (name) LEFT JOIN kids USING (name) LEFT JOIN ends USING (name) LEFT JOIN up USING (name)
LEFT JOIN own p ON p.name = up.parent
"""


@query("op13_prefix_trie", OP13_SQL)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_tries.prefix_trie(table(spark, sf_dir, "conversations")).drop("name", "parent")
