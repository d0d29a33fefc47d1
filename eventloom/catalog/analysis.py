"""Filters, semi-joins, daily counts and correlations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import category_of, date_of_parts, day_of, has_terms, path_matches
from ..operators.analysis import (
    categorise_events,
    corr_matrix,
    daily_category_counts,
    in_country,
    in_period,
    popular_actor_extract,
    popular_values,
    with_calendar,
)
from ..operators.features import actor_frequencies, concat_columns, sort_tokens
from ..sources.readers import scan_table
from .registry import ACTIVITY_SQL, SHIPMENTS_SQL, activity, query, shipments, table

PERIOD = ("19960101", "19981231")
KEEP = ["GLOBALEVENTID", "SQLDATE", "Actor1Name", "Actor2Name", "EventRootCode", "EventCode", "NumMentions"]
SERIES = {"Disturbances": "disturbances", "Economic Events": "economic_events", "Medical": "medical", "AvgTone": "avg_tone"}
DAILY = {"disturbances": ["error"], "economic_events": ["click", "purchase"], "medical": ["signup"]}
CATEGORIES = {"Medical": ["signup"], "Disturbances": ["error"], "Economic Events": ["click", "purchase"]}
DAYS = ("20240103", "20240126")

DAILY_SQL = f"""
  SELECT strptime(SQLDATE, '%Y%m%d')::DATE AS date,
         sum(CASE WHEN EventCode IN ('error') THEN 1 ELSE 0 END)::BIGINT AS disturbances,
         sum(CASE WHEN EventCode IN ('click', 'purchase') THEN 1 ELSE 0 END)::BIGINT AS economic_events,
         sum(CASE WHEN EventCode IN ('signup') THEN 1 ELSE 0 END)::BIGINT AS medical,
         avg(AvgTone) AS avg_tone
  FROM ({ACTIVITY_SQL}) GROUP BY 1
"""


def _daily(spark, sf):
    return daily_category_counts(activity(spark, sf), categories=DAILY, where=F.lit(True))


# Times are compared as text: the two engines print them alike.
TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


@query("scan_events", "SELECT * REPLACE (strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts) FROM events")
def scan_events(spark, sf):
    return scan_table(spark, f"{sf}/events.parquet").withColumn("ts", F.date_format("ts", TIME))


@query("scan_actor_event", "SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate) FROM lineitem")
def scan_actor_event(spark, sf):
    return scan_table(spark, f"{sf}/lineitem.parquet").withColumn("l_shipdate", F.date_format("l_shipdate", TIME))


@query(
    "filter_country",
    "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_returnflag = 'R'",
)
def filter_country(spark, sf):
    rows = table(spark, sf, "lineitem").where(in_country("l_returnflag", "R"))
    return rows.select("l_orderkey", "l_partkey", "l_quantity")


@query(
    "filter_date_range",
    f"SELECT GLOBALEVENTID, SQLDATE, Actor1Name FROM ({SHIPMENTS_SQL}) WHERE SQLDATE BETWEEN '{PERIOD[0]}' AND '{PERIOD[1]}'",
)
def filter_date_range(spark, sf):
    return shipments(spark, sf).where(in_period("SQLDATE", PERIOD)).select("GLOBALEVENTID", "SQLDATE", "Actor1Name")


@query(
    "filter_code_set",
    "SELECT event_id, event_type FROM events WHERE event_type IN ('error', 'signup', 'purchase')",
)
def filter_code_set(spark, sf):
    rows = table(spark, sf, "events")
    return rows.where(F.col("event_type").isin("error", "signup", "purchase")).select("event_id", "event_type")


@query(
    "filter_not_null",
    """SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
       WHERE l.quality IS NOT NULL""",
)
def filter_not_null(spark, sf):
    # one row a document on both sides, so the join has no hot key
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return rows.where(F.col("quality").isNotNull()).select("doc_id", "quality")


@query(
    "filter_min_articles",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 3",
)
def filter_min_articles(spark, sf):
    rows = table(spark, sf, "lineitem").where(F.col("l_quantity") >= 3)
    return rows.select("l_orderkey", "l_linenumber", "l_quantity")


@query("project_actor_event", f"SELECT {', '.join(KEEP)} FROM ({SHIPMENTS_SQL})")
def project_actor_event(spark, sf):
    return shipments(spark, sf).select(*KEEP)


@query(
    "filter_text_terms",
    """SELECT doc_id FROM documents WHERE contains(text, 'the') AND contains(text, 'and')
       AND NOT contains(text, 'http') AND NOT contains(text, '@')""",
)
def filter_text_terms(spark, sf):
    return table(spark, sf, "documents").where(has_terms("text", ["the", "and"], ["http", "@"])).select("doc_id")


@query(
    "filter_path",
    "SELECT page_id, url FROM pages WHERE starts_with(url, 'https://m.') AND ends_with(url, '#top')",
)
def filter_path(spark, sf):
    return table(spark, sf, "pages").where(path_matches("url", "https://m.", "#top")).select("page_id", "url")


@query(
    "rename_project",
    "SELECT c_custkey AS id, c_acctbal AS latitude, c_nationkey AS longitude, c_name AS actor FROM customer",
)
def rename_project(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_acctbal").alias("latitude"),
        F.col("c_nationkey").alias("longitude"),
        F.col("c_name").alias("actor"),
    )


@query(
    "event_dates",
    f"""SELECT GLOBALEVENTID, strptime(SQLDATE, '%Y%m%d')::DATE AS parsed,
        make_date(substr(SQLDATE, 1, 4)::BIGINT, substr(SQLDATE, 5, 2)::BIGINT, substr(SQLDATE, 7, 2)::BIGINT) AS built
        FROM ({ACTIVITY_SQL})""",
)
def event_dates(spark, sf):
    return activity(spark, sf).select(
        "GLOBALEVENTID", day_of("SQLDATE").alias("parsed"), date_of_parts("SQLDATE").alias("built")
    )


@query(
    "event_categories",
    f"""SELECT GLOBALEVENTID, CASE WHEN EventCode = 'signup' THEN 'Medical' WHEN EventCode = 'error' THEN 'Disturbances'
        WHEN EventCode IN ('click', 'purchase') THEN 'Economic Events' ELSE NULL END AS category FROM ({ACTIVITY_SQL})""",
)
def event_categories(spark, sf):
    return activity(spark, sf).select("GLOBALEVENTID", category_of("EventCode", CATEGORIES).alias("category"))


@query(
    "categorise_events",
    f"""SELECT strptime(SQLDATE, '%Y%m%d')::DATE AS date, AvgTone AS avgtone,
        CASE WHEN EventCode = 'signup' THEN 'Medical' WHEN EventCode = 'error' THEN 'Disturbances'
             ELSE 'Economic Events' END AS event_type,
        user_id AS latitude, GLOBALEVENTID AS longitude
        FROM ({ACTIVITY_SQL}) WHERE EventCode IN ('signup', 'error', 'click', 'purchase')
        AND SQLDATE BETWEEN '{DAYS[0]}' AND '{DAYS[1]}'""",
)
def categorised(spark, sf):
    return categorise_events(
        activity(spark, sf),
        categories=CATEGORIES,
        where=in_period("SQLDATE", DAYS),
        latitude="user_id",
        longitude="GLOBALEVENTID",
    )


@query(
    "popular_actor_extract",
    f"""WITH e AS ({SHIPMENTS_SQL}),
        c AS (SELECT * FROM e WHERE ActionGeo_CountryCode = 'R' AND SQLDATE BETWEEN '{PERIOD[0]}' AND '{PERIOD[1]}')
        SELECT {', '.join(KEEP)} FROM e WHERE ActionGeo_CountryCode = 'R'
        AND Actor1Name IN (SELECT Actor1Name FROM c GROUP BY 1 HAVING count(*) > 94)
        AND Actor2Name IN (SELECT Actor2Name FROM c GROUP BY 1 HAVING count(*) > 6)""",
)
def popular_actors(spark, sf):
    return popular_actor_extract(
        shipments(spark, sf),
        min_counts=(94, 6),
        country=in_country("ActionGeo_CountryCode", "R"),
        period=in_period("SQLDATE", PERIOD),
        keep=KEEP,
    )


@query(
    "count_by_having",
    """SELECT l_partkey AS value, count(*)::BIGINT AS qty FROM lineitem WHERE l_returnflag = 'R'
       AND l_partkey IS NOT NULL GROUP BY 1 HAVING count(*) > 6""",
)
def count_by_having(spark, sf):
    return popular_values(table(spark, sf, "lineitem"), "l_partkey", 6, in_country("l_returnflag", "R"))


@query("daily_category_counts", f"SELECT * REPLACE (round(avg_tone, 6) AS avg_tone) FROM ({DAILY_SQL})")
def daily_counts(spark, sf):
    return _daily(spark, sf).withColumn("avg_tone", F.round("avg_tone", 6))


_COLUMNS = list(SERIES.items())
_MATRIX = " UNION ALL ".join(
    f"SELECT '{a}' AS type1, '{b}' AS type2, "
    + ("1.0::DOUBLE" if a == b else f"(SELECT round(corr({x}, {y}), 6) FROM d)")
    + " AS correlation"
    for a, x in _COLUMNS
    for b, y in _COLUMNS
)


def _matrix(spark, sf):
    return corr_matrix(_daily(spark, sf), SERIES).withColumn("correlation", F.round("correlation", 6))


@query("corr_matrix", f"WITH d AS ({DAILY_SQL}) {_MATRIX}")
def matrix(spark, sf):
    return _matrix(spark, sf)


@query("order_matrix", f"WITH d AS ({DAILY_SQL}), m AS ({_MATRIX}) SELECT * FROM m ORDER BY type1, type2")
def order_matrix(spark, sf):
    return _matrix(spark, sf).orderBy("type1", "type2")


@query(
    "union_all_matrix",
    f"WITH d AS ({DAILY_SQL}), m AS ({_MATRIX}) SELECT type1, count(*)::BIGINT AS cells, round(sum(correlation), 4) AS total FROM m GROUP BY type1",
)
def union_all_matrix(spark, sf):
    rows = _matrix(spark, sf).groupBy("type1")
    return rows.agg(F.count(F.lit(1)).alias("cells"), F.round(F.sum("correlation"), 4).alias("total"))


@query(
    "daily_calendar",
    f"""WITH d AS ({DAILY_SQL}), c AS (SELECT DISTINCT strftime(o_orderdate + INTERVAL 25 YEAR, '%Y%m%d') AS day FROM orders)
        SELECT d.date, d.disturbances, CASE WHEN c.day IS NULL THEN NULL ELSE 'orders of ' || c.day END AS event
        FROM d LEFT JOIN c ON strptime(c.day, '%Y%m%d')::DATE = d.date""",
)
def daily_calendar(spark, sf):
    day = F.date_format(F.add_months(F.col("o_orderdate").cast("date"), 300), "yyyyMMdd")
    calendar = table(spark, sf, "orders").select(day.alias("Date")).distinct()
    calendar = calendar.withColumn("Event", F.concat(F.lit("orders of "), "Date"))
    return with_calendar(_daily(spark, sf), calendar).select("date", "disturbances", "event")


@query(
    "concat_columns",
    """SELECT value, count(*)::BIGINT AS n FROM (SELECT l_suppkey AS value FROM lineitem UNION ALL
       SELECT l_partkey FROM lineitem) GROUP BY 1""",
)
def concat(spark, sf):
    both = concat_columns(table(spark, sf, "lineitem"), ["l_suppkey", "l_partkey"])
    return both.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query(
    "actor_frequencies",
    """SELECT value, count(*)::BIGINT AS count FROM (SELECT o_orderpriority AS value FROM orders UNION ALL
       SELECT o_orderstatus FROM orders) WHERE value IS NOT NULL GROUP BY 1""",
)
def frequencies(spark, sf):
    return actor_frequencies(table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"])


@query(
    "sort_tokens",
    """SELECT value, count(*)::BIGINT AS count FROM (SELECT l_suppkey AS value FROM lineitem UNION ALL
       SELECT l_partkey FROM lineitem) GROUP BY 1 ORDER BY count DESC, value""",
)
def sort_counts(spark, sf):
    counts = actor_frequencies(table(spark, sf, "lineitem"), ["l_suppkey", "l_partkey"])
    return sort_tokens(counts, "value")
