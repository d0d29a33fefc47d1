"""Registry of queries and the stand-in views they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

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
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` in the shape of actor events: suppliers and parts act, the flag is the country."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("GLOBALEVENTID"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("SQLDATE"),
        F.col("l_suppkey").alias("Actor1Name"),
        F.col("l_partkey").alias("Actor2Name"),
        F.col("l_linestatus").alias("EventRootCode"),
        F.col("l_linenumber").alias("EventCode"),
        F.col("l_quantity").alias("NumMentions"),
        F.col("l_extendedprice").alias("AvgTone"),
        F.col("l_returnflag").alias("ActionGeo_CountryCode"),
    )


SHIPMENTS_SQL = """
  SELECT l_orderkey AS GLOBALEVENTID, strftime(l_shipdate, '%Y%m%d') AS SQLDATE,
         l_suppkey AS Actor1Name, l_partkey AS Actor2Name, l_linestatus AS EventRootCode,
         l_linenumber AS EventCode, l_quantity AS NumMentions, l_extendedprice AS AvgTone,
         l_returnflag AS ActionGeo_CountryCode
  FROM lineitem
"""


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` in the shape of coded events with a tone."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("GLOBALEVENTID"),
        F.date_format("ts", "yyyyMMdd").alias("SQLDATE"),
        F.col("event_type").alias("EventCode"),
        F.col("value").alias("AvgTone"),
        F.col("user_id").alias("user_id"),
    )


ACTIVITY_SQL = """
  SELECT event_id AS GLOBALEVENTID, strftime(ts, '%Y%m%d') AS SQLDATE, event_type AS EventCode,
         value AS AvgTone, user_id
  FROM events
"""
