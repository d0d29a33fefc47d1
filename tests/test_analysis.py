import math

import pytest
from pyspark.sql import functions as F

from eventloom.operators import analysis as A


EVENT = "GLOBALEVENTID string, SQLDATE string, Actor1Name string, Actor2Name string, ActionGeo_CountryCode string"
KEEP = ["GLOBALEVENTID", "Actor1Name", "Actor2Name"]


@pytest.mark.parametrize("limit", [64 << 20, -1])
def test_popular_actors_keep_rows_of_every_date(spark, monkeypatch, limit):
    """Both join ways: broadcast of the measured names, and the shuffle join."""
    from eventloom.operators import spread

    monkeypatch.setattr(spread.lookup_join, "__defaults__", ("inner", (), limit))
    rows = [(f"in{i}", "20200101", "A", "X", "US") for i in range(3)]
    rows += [("edge1", "20211231", "B", "X", "US"), ("edge2", "20211231", "B", "X", "US")]
    rows += [("old", "19990101", "A", "X", "US"), ("abroad", "20200601", "A", "X", "FR")]
    rows += [("null", "20200601", None, "X", "US"), ("rare", "20200601", "A", "Y", "US")]
    df = spark.createDataFrame(rows, EVENT)
    got = A.popular_actor_extract(df, min_counts=(2, 2), keep=KEEP).collect()
    assert sorted(r[0] for r in got) == ["in0", "in1", "in2", "old"]


def test_threshold_is_exclusive(spark):
    df = spark.createDataFrame([("A",), ("A",), ("B",), (None,), (None,)], "n string")
    assert [tuple(r) for r in A.popular_values(df, "n", 1).collect()] == [("A", 2)]
    assert A.popular_values(df, "n", 2).count() == 0


def test_daily_counts_and_geo_columns_differ(spark):
    df = spark.createDataFrame(
        [("20200101", "061", 1.0, "US", "FR"), ("20200101", "141", 3.0, "US", "US"), ("20200103", "182", 5.0, "US", None),
         ("20200103", None, 7.0, "US", "US"), ("20220101", "141", 9.0, "US", "US"), ("20200101", "141", 9.0, "FR", "US")],
        "SQLDATE string, EventCode string, AvgTone double, Actor1Geo_CountryCode string, ActionGeo_CountryCode string",
    )
    rows = A.daily_category_counts(df).orderBy("date").collect()
    got = [(str(r.date), r.disturbances, r.economic_events, r.medical, r.avg_tone) for r in rows]
    assert got == [("2020-01-01", 1, 1, 0, 2.0), ("2020-01-03", 0, 0, 1, 6.0)]
    mapped = A.categorise_events(
        df.withColumn("ActionGeo_Lat", F.lit(1.0)).withColumn("ActionGeo_Long", F.lit(2.0))
    ).collect()
    assert sorted((r.avgtone, r.event_type) for r in mapped) == [(3.0, "Disturbances"), (9.0, "Disturbances")]


def test_corr_matrix_edges(spark):
    schema = "date int, disturbances long, economic_events long, medical long, avg_tone double"
    varied = spark.createDataFrame([(i, i, 10 - i, 5, [1.0, 4.0, 2.0, 8.0][i]) for i in range(4)], schema)
    cells = {(r.type1, r.type2): r.correlation for r in A.corr_matrix(varied).collect()}
    assert len(cells) == 16
    assert all(cells[a, a] == 1.0 for a in A.SERIES)
    assert all(cells[a, b] == cells[b, a] or math.isnan(cells[a, b]) for a, b in cells)
    assert cells["Disturbances", "Economic Events"] == pytest.approx(-1.0)
    assert math.isnan(cells["Disturbances", "Medical"])
    single = A.corr_matrix(varied.limit(1)).collect()
    assert all(r.correlation is None for r in single if r.type1 != r.type2)
    order = [(r.type1, r.type2) for r in A.corr_matrix(varied).collect()]
    assert order == sorted(order)


def test_calendar_marks_days(spark):
    days = spark.createDataFrame([("2020-03-11",), ("2020-03-12",)], "d string").select(F.to_date("d").alias("date"))
    calendar = spark.createDataFrame([("20200311", "Something declared")], "Date string, Event string")
    got = A.with_calendar(days, calendar).orderBy("date").collect()
    assert [r.event for r in got] == ["Something declared", None]


def test_filters_reach_the_scan_and_one_pass_serves_the_matrix(spark, folder):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    rows = [("20200101", "061", 1.0, "US", "x" * 10)]
    spark.createDataFrame(
        rows, "SQLDATE string, EventCode string, AvgTone double, Actor1Geo_CountryCode string, Other string"
    ).write.parquet(f"{folder}/e")
    plan = A.corr_matrix(A.daily_category_counts(spark.read.parquet(f"{folder}/e")))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert physical.count("FileScan") == 1
    assert "EqualTo(Actor1Geo_CountryCode,US)" in physical and "GreaterThanOrEqual(SQLDATE,20200101)" in physical
    assert "Other" not in physical and "Cartesian" not in physical
