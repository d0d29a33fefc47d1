"""Explicit types of every file the library reads; nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"s": T.StringType(), "i": T.LongType(), "f": T.DoubleType()}


def _struct(spec: str) -> T.StructType:
    fields = (item.split(":") for item in spec.split())
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in fields])


# Names, order and types of the landing tables' columns (s string, i bigint, f double).
EVENTS = _struct(
    """
    GLOBALEVENTID:s SQLDATE:s MonthYear:s Year:s FractionDate:f
    Actor1Code:s Actor1Name:s Actor1CountryCode:s Actor1KnownGroupCode:s Actor1EthnicCode:s
    Actor1Religion1Code:s Actor1Religion2Code:s Actor1Type1Code:s Actor1Type2Code:s Actor1Type3Code:s
    Actor2Code:s Actor2Name:s Actor2CountryCode:s Actor2KnownGroupCode:s Actor2EthnicCode:s
    Actor2Religion1Code:s Actor2Religion2Code:s Actor2Type1Code:s Actor2Type2Code:s Actor2Type3Code:s
    IsRootEvent:s EventCode:s EventBaseCode:s EventRootCode:s QuadClass:i GoldsteinScale:f
    NumMentions:i NumSources:i NumArticles:i AvgTone:f
    Actor1Geo_Type:i Actor1Geo_FullName:s Actor1Geo_CountryCode:s Actor1Geo_ADM1Code:s
    Actor1Geo_Lat:f Actor1Geo_Long:f Actor1Geo_FeatureID:s
    Actor2Geo_Type:i Actor2Geo_FullName:s Actor2Geo_CountryCode:s Actor2Geo_ADM1Code:s
    Actor2Geo_Lat:f Actor2Geo_Long:f Actor2Geo_FeatureID:s
    ActionGeo_Type:i ActionGeo_FullName:s ActionGeo_CountryCode:s ActionGeo_ADM1Code:s
    ActionGeo_Lat:f ActionGeo_Long:f ActionGeo_FeatureID:s
    DATEADDED:s SOURCEURL:s
    """
)

GKG = _struct(
    """
    DATE:s NUMARTS:i COUNTS:s THEMES:s LOCATIONS:s PERSONS:s ORGANIZATIONS:s
    TONE:s CAMEOEVENTIDS:s SOURCES:s SOURCEURLS:s
    """
)

CALENDAR = _struct("Date:s Event:s")


def cluster_profile_schema(k: int = 10) -> T.StructType:
    """Wide profile file: a feature and an appearance column per centroid, 1-based.

    The column spelling ``appereance`` is the file's own.
    """
    pairs = (f"feature_Centroid{i}:s appereance_Centroid{i}:f" for i in range(1, k + 1))
    return _struct(" ".join(pairs))


# Event codes behind each category of the daily series and the categorised map.
CATEGORY_CODES = {
    "Medical": ["0233", "073", "182"],
    "Governmental Regulations": ["0334", "0254", "0342"],
    "Disturbances": ["141", "145", "172"],
    "Economic Events": ["061", "0331", "0256", "091"],
}

# Country and inclusive yyyyMMdd period of the analyses.
COUNTRY = "US"
PERIOD = ("20200101", "20211231")

# Fixed value: an actor is popular when it has more rows than this in the period.
POPULAR_ACTOR_ROWS = 45_000

# Multi-valued columns tokenised per row, their separators and the URL separator.
TOKEN_COLUMNS = ("COUNTS", "THEMES", "LOCATIONS", "PERSONS", "ORGANIZATIONS")
TOKEN_SEPARATOR = "[#;]"
URL_SEPARATOR = "<UDIV>"
MIN_ARTICLES = 3
COVERAGE = 0.8

# Fixed value: text the summary step writes when a text is not worth summarising.
NO_SUMMARY = "#nosummary#"
