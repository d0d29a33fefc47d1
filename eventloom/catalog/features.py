"""Vocabularies, encoders and token sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import prefixed, row_token_set
from ..functions.vectors import dense, set_positions
from ..operators.features import (
    combine_and_normalise,
    distinct_sorted_codes,
    encode_long,
    multi_hot,
    multi_hot_long,
    time_feature,
    token_counts,
    vocab_by_coverage,
    vocab_lookup_join,
    vocabulary,
)
from ..functions.columns import WHITESPACE
from ..plans.actor_clusters import training_set
from ..session import settle
from .registry import query, table

SEP = "[ \\n]"
# Values that the two columns of the orders table have.
STATUSES = ("F", "O", "P")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
_STRIP = "chr(32)" + "".join(f" || chr({ord(c)})" for c in WHITESPACE if c != " ")

PIECES_SQL = "SELECT doc_id, unnest(regexp_split_to_array(text, '[ \\n]')) AS piece FROM documents"
COUNTS_SQL = f"""
  SELECT token, count(*)::BIGINT AS count
  FROM (SELECT trim(piece, {_STRIP}) AS token FROM ({PIECES_SQL}))
  WHERE regexp_full_match(token, '\\p{{L}}+') GROUP BY 1
"""
VOCAB_SQL = f"""
  SELECT token, (row_number() OVER (ORDER BY token) - 1)::BIGINT AS idx FROM (
    SELECT token, coalesce(sum(count) OVER (ORDER BY count DESC, token
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
           sum(count) OVER () AS total
    FROM ({COUNTS_SQL})) WHERE before < 0.8 * total
"""
FEATURES_SQL = """
  SELECT o_orderkey, 'time' AS feature, (30 * month(o_orderdate) + day(o_orderdate)) / 365.0 AS value FROM orders
  UNION ALL SELECT DISTINCT o_orderkey, 'actor_' || a, 1.0 FROM (
    SELECT o_orderkey, o_orderpriority AS a FROM orders UNION ALL SELECT o_orderkey, o_orderstatus FROM orders)
  UNION ALL SELECT o_orderkey, 'event_' || o_orderstatus, 1.0 FROM orders
"""


def _documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus")


def orders_training(spark, sf, carry=()):
    return training_set(
        _orders(spark, sf),
        "o_orderkey",
        F.col("o_orderdate").cast("date"),
        ["o_orderpriority", "o_orderstatus"],
        ["o_orderstatus", "o_orderpriority"],
        carry,
    )


@query(
    "time_feature",
    "SELECT o_orderkey, round((30 * month(o_orderdate) + day(o_orderdate)) / 365.0, 6)::DOUBLE AS time FROM orders",
)
def time_of_year(spark, sf):
    rows = time_feature(table(spark, sf, "orders"), F.col("o_orderdate").cast("date"))
    return rows.select("o_orderkey", F.round("time", 6).alias("time"))


@query("distinct_sorted_codes", "SELECT DISTINCT p_brand AS code FROM part ORDER BY 1")
def codes(spark, sf):
    return distinct_sorted_codes(table(spark, sf, "part"), "p_brand")


@query("token_counts", COUNTS_SQL)
def counts(spark, sf):
    return token_counts(_documents(spark, sf), ["text"], SEP)


@query("vocab_by_coverage", VOCAB_SQL)
def coverage(spark, sf):
    return vocab_by_coverage(token_counts(_documents(spark, sf), ["text"], SEP))


@query(
    "multi_hot_tokens",
    f"""WITH v AS ({VOCAB_SQL}) SELECT DISTINCT p.doc_id, v.token, v.idx
        FROM ({PIECES_SQL}) p JOIN v ON p.piece = v.token""",
)
def multi_hot_rows(spark, sf):
    rows = _documents(spark, sf)
    vocab = vocab_by_coverage(token_counts(rows, ["text"], SEP))
    return multi_hot_long(rows, "doc_id", vocab, ["text"], SEP)


@query(
    "multi_hot_vectors",
    """WITH p AS (SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ')) AS piece FROM part),
       v AS (SELECT piece, row_number() OVER (ORDER BY piece) - 1 AS idx FROM (SELECT DISTINCT piece FROM p))
       SELECT p_partkey, string_agg(idx::VARCHAR, ',' ORDER BY idx) AS ones FROM p JOIN v USING (piece) GROUP BY 1""",
)
def multi_hot_vectors(spark, sf):
    """The vector form over the whole vocabulary: the positions that are set."""
    rows = table(spark, sf, "part").select("p_partkey", "p_name")
    words = token_counts(rows, ["p_name"], " ", alpha_only=False)
    vocab = settle(vocabulary(words.select("token"), "token"))
    hot = multi_hot(rows, "p_partkey", row_token_set(["p_name"], " "), vocab, "v")
    return hot.select("p_partkey", F.array_join(set_positions(dense(hot, "v")), ",").alias("ones"))


@query(
    "vocab_lookup_join",
    """WITH v AS (SELECT p_brand AS value, row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS idx
       FROM part GROUP BY p_brand) SELECT p_partkey, idx::BIGINT AS idx FROM part JOIN v ON p_brand = value""",
)
def lookup(spark, sf):
    part = table(spark, sf, "part")
    sizes = part.groupBy(F.col("p_brand").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    vocab = vocabulary(sizes, "value", [F.col("n").desc(), "value"]).select("value", "idx")
    rows = part.select("p_partkey", F.col("p_brand").alias("value"))
    return vocab_lookup_join(rows, settle(vocab), "value", ["p_partkey"]).select("p_partkey", "idx")


@query(
    "encode_actor_pair",
    """WITH v AS (SELECT value, row_number() OVER (ORDER BY count(*) DESC, value) - 1 AS idx FROM (
         SELECT p_brand AS value FROM part UNION ALL SELECT p_type FROM part) GROUP BY value)
       SELECT p_partkey, value, idx::BIGINT AS idx FROM part JOIN v ON p_brand = value
       UNION SELECT p_partkey, value, idx::BIGINT FROM part JOIN v ON p_type = value""",
)
def encode_actors(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    from ..operators.features import actor_frequencies

    counts = actor_frequencies(part, ["p_brand", "p_type"])
    vocab = vocabulary(counts, "value", [F.col("count").desc(), "value"]).select("value", "idx")
    return encode_long(part, "p_partkey", ["p_brand", "p_type"], settle(vocab), "value")


@query(
    "encode_codes",
    """WITH v AS (SELECT code, row_number() OVER (ORDER BY code) - 1 AS idx FROM (SELECT DISTINCT p_type AS code FROM part))
       SELECT p_partkey, code, idx::BIGINT AS idx FROM part JOIN v ON p_type = code
       UNION SELECT p_partkey, code, idx::BIGINT FROM part JOIN v ON p_brand = code
       UNION SELECT p_partkey, code, idx::BIGINT FROM part JOIN v ON p_name = code""",
)
def encode_event_codes(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_type", "p_brand", "p_name")
    vocab = vocabulary(distinct_sorted_codes(part, "p_type"), "code")
    return encode_long(part, "p_partkey", ["p_type", "p_brand", "p_name"], settle(vocab))


@query("assemble_training_set", f"SELECT o_orderkey, feature, round(value, 6)::DOUBLE AS value FROM ({FEATURES_SQL})")
def assembled(spark, sf):
    long = orders_training(spark, sf).long("o_orderkey")
    return long.withColumn("value", F.round("value", 6))


@query(
    "training_set_wide",
    "SELECT o_orderkey, round((30 * month(o_orderdate) + day(o_orderdate)) / 365.0, 6)::DOUBLE AS time, "
    + ", ".join(f"(o_orderstatus = '{x}')::INTEGER AS \"{kind}_{x}\"" for x in STATUSES for kind in ("event", "actor"))
    + ", "
    + ", ".join(f"(o_orderpriority = '{x}')::INTEGER AS \"actor_{x}\"" for x in PRIORITIES)
    + " FROM orders",
)
def training_wide(spark, sf):
    wide = orders_training(spark, sf).wide("o_orderkey")
    return wide.withColumn("time", F.round("time", 6))


@query(
    "combine_and_normalise",
    """WITH j AS (SELECT vec_id, list_concat(embedding::DOUBLE[], [CASE WHEN label = t THEN 1.0::DOUBLE ELSE 0.0 END
         FOR t IN range(10)]) AS v FROM embeddings),
       u AS (SELECT vec_id, generate_subscripts(v, 1) - 1 AS pos, unnest(v) AS x FROM j),
       n AS (SELECT vec_id, sqrt(sum(x * x)) AS len FROM u GROUP BY 1)
       SELECT u.vec_id, pos::INTEGER AS pos, round(x / len, 6) AS value FROM u JOIN n ON u.vec_id = n.vec_id""",
)
def combined(spark, sf):
    rows = table(spark, sf, "embeddings")
    rows = rows.withColumn("code", F.col("label").cast("string"))
    vocab = settle(vocabulary(distinct_sorted_codes(rows, "code"), "code"))
    hot = multi_hot(rows, "vec_id", F.array("code"), vocab, "hot", "code")
    from pyspark.ml.functions import array_to_vector

    hot = hot.withColumn("vec", array_to_vector(F.col("embedding").cast("array<double>")))
    unit = combine_and_normalise(hot, ["vec", "hot"])
    cells = unit.select("vec_id", F.posexplode(dense(unit, "features")).alias("pos", "value"))
    return cells.withColumn("value", F.round("value", 6))


@query(
    "set_union",
    """SELECT p_partkey, string_agg(piece, ';' ORDER BY piece) AS tokens FROM (
         SELECT DISTINCT p_partkey, unnest(string_split(p_name || ' ' || p_type || ' ' || p_brand, ' ')) AS piece FROM part)
       GROUP BY 1""",
)
def union_of_tokens(spark, sf):
    tokens = F.array_sort(row_token_set(["p_name", "p_type", "p_brand"], " "))
    return table(spark, sf, "part").select("p_partkey", F.array_join(tokens, ";").alias("tokens"))


@query(
    "set_intersection",
    """SELECT p_partkey, coalesce((SELECT string_agg(DISTINCT x, ';' ORDER BY x)
         FROM unnest(string_split(p_name, ' ')) AS u(x) WHERE x IN ('red', 'blue', 'ring', 'bolt')), '') AS tokens FROM part""",
)
def intersection_of_tokens(spark, sf):
    chosen = F.array(*[F.lit(t) for t in ("red", "blue", "ring", "bolt")])
    tokens = F.array_sort(F.array_intersect(row_token_set(["p_name"], " "), chosen))
    return table(spark, sf, "part").select("p_partkey", F.array_join(tokens, ";").alias("tokens"))


@query(
    "prefixed_names",
    "SELECT p_partkey, 'actor_' || p_brand AS actor, 'event_' || p_type AS event, 'centroid_' || p_size AS centroid FROM part",
)
def prefixed_names(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        prefixed("actor_", "p_brand").alias("actor"),
        prefixed("event_", "p_type").alias("event"),
        prefixed("centroid_", "p_size").alias("centroid"),
    )
