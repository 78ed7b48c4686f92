"""Hourly rows to daily figures.

Every aggregate here is combined within a task before its shuffle, so what
crosses the network is one row per task and day, not the hours themselves.
``series`` adds grouping columns (market, zone) in front of the date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide import schemas
from gridtide.functions import casting

GRID_DATE = "grid_date"


def _mean(df: DataFrame, column: str, exact: T.DataType) -> Column:
    """The mean to two places, from an exact sum and rounded once: an average
    of decimals would be rounded to a few places first. Whole numbers add up as
    bigint, which costs next to nothing; fractions have to be decimals."""
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.IntegralType):
        total = F.sum(value.cast("bigint")).cast("decimal(20,0)")
    else:
        total = F.sum(value if isinstance(kind, T.DecimalType) else value.cast(exact))
    n = F.nullif(F.count(value).cast("decimal(20,0)"), F.lit(0))
    return F.round(total / n, 2).cast("decimal(18,2)")


def daily_aggregate(
    hourly: DataFrame,
    ts: str = schemas.LOCAL_HOUR,
    price: str = "pool_price",
    load: str = "alberta_internal_load",
    series: Sequence[str] = (),
    computed_at=None,
    exact: T.DataType = schemas.PRICE_TYPE,
) -> DataFrame:
    """Price statistics, mean load and the number of hours present per day.

    A day of one price (or none) has deviation 0; a day without any price still
    counts its hours. ``exact`` is the decimal type binary prices are averaged
    in; a narrow one such as ``schemas.MONEY_TYPE`` is several times faster.
    Extremes are found in the column's own type and made exact once per day.
    """
    p = F.col(price)
    daily = (
        hourly.filter(F.col(ts).isNotNull())
        .groupBy(*series, F.to_date(ts).alias(GRID_DATE))
        .agg(
            _mean(hourly, price, exact).alias("avg_price"),
            F.min(p).cast(schemas.PRICE_TYPE).alias("min_price"),
            F.max(p).cast(schemas.PRICE_TYPE).alias("max_price"),
            F.round(F.coalesce(F.stddev_samp(p), F.lit(0.0)), 2).cast("decimal(18,2)").alias("stddev_price"),
            _mean(hourly, load, T.DecimalType(18, 4)).alias("avg_load"),
            F.count("*").cast("int").alias("hours_reported"),
        )
    )
    return daily.withColumn("computed_at", casting.run_at(computed_at))


def price_range(prices: DataFrame, ts: str = schemas.LOCAL_HOUR, price: str = "pool_price", series: Sequence[str] = ()) -> DataFrame:
    """Lowest and highest price per day."""
    return prices.groupBy(*series, F.to_date(ts).alias("trade_date_mpt")).agg(
        F.min(price).alias("min_charge_price"), F.max(price).alias("max_discharge_price")
    )


def hours_in_day(date: Column | str, zone: str = schemas.MARKET_ZONE) -> Column:
    """How many hours a local calendar day has: 24, or 23 and 25 on the days
    the clocks change."""
    date = casting.as_column(date)
    midnight, next_midnight = date.cast("timestamp_ntz"), F.date_add(date, 1).cast("timestamp_ntz")
    to_utc = [F.convert_timezone(F.lit(zone), F.lit("UTC"), m) for m in (midnight, next_midnight)]
    length = to_utc[1] - to_utc[0]
    return (F.extract(F.lit("DAY"), length) * 24 + F.extract(F.lit("HOUR"), length)).cast("int")


def completeness(daily: DataFrame, zone: str = schemas.MARKET_ZONE, series: Sequence[str] = ()) -> DataFrame:
    """Hours reported against the hours the day has."""
    expected = hours_in_day(GRID_DATE, zone)
    return daily.select(
        *series,
        GRID_DATE,
        "hours_reported",
        expected.alias("expected_hours"),
        (expected - F.col("hours_reported")).alias("missing_hours"),
        (F.col("hours_reported") >= expected).alias("is_complete"),
    )
