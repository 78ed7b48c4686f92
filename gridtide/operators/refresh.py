"""Refreshing the daily aggregate for just the dates a batch touched."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide import schemas
from gridtide.operators import daily as day
from gridtide.operators.upsert import upsert


def batch_dates(batch: DataFrame, ts: str = schemas.LOCAL_HOUR, series: Sequence[str] = ()) -> DataFrame:
    """The distinct (series and) dates a batch has rows for."""
    return (
        batch.filter(F.col(ts).isNotNull()).select(*series, F.to_date(ts).alias(day.GRID_DATE)).distinct()
    )


def daily_rows(hourly: DataFrame, computed_at=None, series: Sequence[str] = ()) -> DataFrame:
    """Rows of the daily table for every date in ``hourly``."""
    return day.daily_aggregate(hourly, series=series, computed_at=computed_at)


def affected_days(
    hourly: DataFrame, batch: DataFrame, computed_at=None, series: Sequence[str] = (), ts: str = schemas.LOCAL_HOUR
) -> DataFrame:
    """Daily rows for the dates in the batch, from all stored hours of those
    dates (a batch may hold only part of a day).

    Hours of other dates are dropped before they are aggregated, by a semi join
    on the date whose list is bounded by the calendar. Over a date-partitioned
    table read only the partitions concerned (``gridtide.sources.tables`` does).
    """
    dated = hourly.withColumn("_date", F.to_date(ts))
    dates = batch_dates(batch, ts, series).withColumnRenamed(day.GRID_DATE, "_date")
    kept = dated.join(dates, [*series, "_date"], "left_semi").select(*hourly.columns)
    return day.daily_aggregate(kept, ts=ts, series=series, computed_at=computed_at)


def refresh(current: DataFrame, hourly: DataFrame, batch: DataFrame, computed_at=None, series: Sequence[str] = ()) -> DataFrame:
    """The daily table after a batch: affected days recomputed, others as they
    were, their ``computed_at`` included."""
    changed = affected_days(hourly, batch, computed_at, series)
    names = [c for c in schemas.DAILY_GRID.names if c != day.GRID_DATE]
    return upsert(current, changed, [*series, day.GRID_DATE], names)
