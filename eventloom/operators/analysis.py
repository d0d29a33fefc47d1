"""Event analyses: popular actors, daily category counts, correlations, categorised events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import category_of, day_of
from ..schemas import CATEGORY_CODES, COUNTRY, PERIOD, POPULAR_ACTOR_ROWS
from ..session import settle
from .spread import lookup_join

ACTOR_EVENT_COLUMNS = (
    "GLOBALEVENTID",
    "SQLDATE",
    "Actor1Name",
    "Actor2Name",
    "EventRootCode",
    "EventBaseCode",
    "EventCode",
    "NumMentions",
    "SOURCEURL",
)

# Label of each series in the matrix -> column of the daily counts.
SERIES = {
    "Disturbances": "disturbances",
    "Economic Events": "economic_events",
    "Medical": "medical",
    "AvgTone": "avg_tone",
}

DAILY_CATEGORIES = {
    column: CATEGORY_CODES[label] for label, column in SERIES.items() if label in CATEGORY_CODES
}


def in_country(column: str, country: str = COUNTRY) -> Column:
    return F.col(column) == F.lit(country)


def in_period(column: str, period: Sequence[str] = PERIOD) -> Column:
    """Inclusive comparison on the stored text, which is what lets it reach the Parquet scan."""
    return F.col(column).between(F.lit(period[0]), F.lit(period[1]))


def popular_values(
    df: DataFrame, column: str, min_count: int, where: Column | None = None
) -> DataFrame:
    """Values with more than ``min_count`` rows: ``(value, qty)``. Nulls are not a value."""
    if where is not None:
        df = df.where(where)
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("qty"))
        .where(F.col("qty") > min_count)
    )


def popular_actor_extract(
    df: DataFrame,
    actors: Sequence[str] = ("Actor1Name", "Actor2Name"),
    min_counts: Sequence[int] = (POPULAR_ACTOR_ROWS, POPULAR_ACTOR_ROWS),
    country: Column | None = None,
    period: Column | None = None,
    keep: Sequence[str] = ACTOR_EVENT_COLUMNS,
) -> DataFrame:
    """Rows whose actors are all popular in their own column.

    The period limits only the counting: a popular actor keeps its rows of every date. All columns
    are counted in one pass over the (country, date, actors) columns; the names are written down,
    measured and then used as semi-join sides, so the wide rows are read once and not shuffled.
    """
    country = in_country("ActionGeo_CountryCode") if country is None else country
    period = in_period("SQLDATE") if period is None else period
    scope = df.where(country)
    sides = [F.struct(F.lit(i).alias("side"), F.col(a).alias("name")) for i, a in enumerate(actors)]
    threshold = F.element_at(F.array(*[F.lit(int(n)) for n in min_counts]), F.col("side") + 1)
    popular = settle(
        scope.where(period)
        .select(F.explode(F.array(*sides)).alias("a"))
        .select("a.side", "a.name")
        .where(F.col("name").isNotNull())
        .groupBy("side", "name")
        .agg(F.count(F.lit(1)).alias("qty"))
        .where(F.col("qty") > threshold)
    )
    kept = list(dict.fromkeys([*keep, *actors]))
    rows = scope.select(*kept)
    for i, actor in enumerate(actors):
        names = popular.where(F.col("side") == i).select(F.col("name").alias(actor))
        rows = lookup_join(rows, names, actor, "left_semi")
    return rows.select(*keep)


def daily_category_counts(
    df: DataFrame,
    date: Column | None = None,
    code: str = "EventCode",
    categories: Mapping[str, Sequence[str]] = DAILY_CATEGORIES,
    tone: str = "AvgTone",
    where: Column | None = None,
) -> DataFrame:
    """Per day: rows of each category and the mean tone. Days without rows are absent."""
    if where is None:
        where = in_country("Actor1Geo_CountryCode") & in_period("SQLDATE")
    date = day_of("SQLDATE") if date is None else date
    counts = [
        F.sum(F.when(F.col(code).isin(*codes), 1).otherwise(0)).alias(name)
        for name, codes in categories.items()
    ]
    return df.where(where).groupBy(date.alias("date")).agg(*counts, F.avg(tone).alias("avg_tone"))


def pearson(x: str, y: str) -> Column:
    """Pearson correlation over rows where both are present: null below two rows, NaN when a side
    does not vary. (``corr`` itself raises on a constant column under ANSI.)"""
    scale = F.sqrt(F.regr_sxx(y, x) * F.regr_syy(y, x))
    return (
        F.when(F.regr_count(y, x) < 2, F.lit(None).cast("double"))
        .when(scale == 0, F.lit(float("nan")))
        .otherwise(F.try_divide(F.regr_sxy(y, x), scale))
    )


def corr_matrix(df: DataFrame, series: Mapping[str, str] = SERIES) -> DataFrame:
    """``(type1, type2, correlation)`` for every ordered pair of series, ordered by both labels.

    One aggregate over one scan computes each unordered pair once; ``stack`` emits it both ways.
    """
    labels = list(series)
    pairs = list(combinations(range(len(labels)), 2))
    row = df.agg(*[pearson(series[labels[i]], series[labels[j]]).alias(f"c{i}_{j}") for i, j in pairs])
    cells = [(a, a, "double(1)") for a in labels]
    for i, j in pairs:
        cells += [(labels[i], labels[j], f"c{i}_{j}"), (labels[j], labels[i], f"c{i}_{j}")]
    body = ", ".join(f"'{a}', '{b}', {c}" for a, b, c in cells)
    return row.selectExpr(f"stack({len(cells)}, {body}) AS (type1, type2, correlation)").orderBy(
        "type1", "type2"
    )


def categorise_events(
    df: DataFrame,
    date: Column | None = None,
    code: str = "EventCode",
    categories: Mapping[str, Sequence[str]] = CATEGORY_CODES,
    where: Column | None = None,
    tone: str = "AvgTone",
    latitude: str = "ActionGeo_Lat",
    longitude: str = "ActionGeo_Long",
) -> DataFrame:
    """Date, tone, category and place of the events that have a category: one filtered scan."""
    if where is None:
        where = in_country("ActionGeo_CountryCode") & in_period("SQLDATE")
    date = day_of("SQLDATE") if date is None else date
    codes = [c for group in categories.values() for c in group]
    return df.where(where & F.col(code).isin(*codes)).select(
        date.alias("date"),
        F.col(tone).alias("avgtone"),
        category_of(code, categories).alias("event_type"),
        F.col(latitude).alias("latitude"),
        F.col(longitude).alias("longitude"),
    )


def with_calendar(df: DataFrame, calendar: DataFrame, date: str = "date") -> DataFrame:
    """Mark each day with the event of the calendar file (days without one keep a null)."""
    days = calendar.select(day_of("Date").alias(date), F.col("Event").alias("event"))
    return lookup_join(df, days, date, "left")
