"""Running, rolling and latest-N figures over a daily series.

Input is at daily grain: at most one row per date and series, so one window
partition holds as many rows as the calendar has days, whatever the size of the
hourly data below it. Many series run in parallel through ``series``. Never
apply these to hourly rows.

Rolling frames count rows, not calendar days: over a gap in the dates they
reach further back, and the first rows see a shorter frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtide import schemas


def _ordered(order: str, series: Sequence[str]):
    return Window.partitionBy(*series).orderBy(order) if series else Window.orderBy(order)


def running_total(value: str, order: str, series: Sequence[str] = ()) -> Column:
    """Sum of everything up to and including the row's date."""
    return F.sum(value).over(_ordered(order, series))


def rolling_frame(order: str, rows: int = schemas.ROLLING_ROWS, series: Sequence[str] = ()):
    return _ordered(order, series).rowsBetween(-(rows - 1), Window.currentRow)


def latest(df: DataFrame, order: str, n: int, series: Sequence[str] = (), ties: Sequence[str] = ()) -> DataFrame:
    """The newest n rows, or the newest n of each series.

    Nulls come first, as a descending sort in the relational store has them.
    Without series Spark keeps only n rows per task before the final merge;
    with series the rank filter is pushed below the shuffle in the same way.
    """
    newest = [F.col(c).desc_nulls_first() for c in (order, *ties)]
    if not series:
        return df.orderBy(*newest).limit(n)
    rank = F.row_number().over(Window.partitionBy(*series).orderBy(*newest))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def running_profit(arb: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Daily profit with its running total, oldest first."""
    total = running_total("net_daily_profit", "grid_date", series)
    return arb.select(*series, "grid_date", "net_daily_profit", total.alias("total_profit_acc")).orderBy(
        *series, "grid_date"
    )


def last_days_profit(arb: DataFrame, days: int = schemas.ROLLING_ROWS, series: Sequence[str] = ()) -> DataFrame:
    """The newest days with their total and rolling sum, newest first. Both
    figures are taken over the kept days only."""
    kept = latest(arb.select(*series, "grid_date", "net_daily_profit"), "grid_date", days, series)
    everything = Window.partitionBy(*series).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return kept.select(
        *series,
        "grid_date",
        "net_daily_profit",
        F.sum("net_daily_profit").over(everything).alias("total_10_day_profit"),
        F.sum("net_daily_profit").over(rolling_frame("grid_date", days, series)).alias("rolling_10d_sum"),
    ).orderBy(*series, F.col("grid_date").desc())


def rolling_profit(arb: DataFrame, rows: int = schemas.ROLLING_ROWS, series: Sequence[str] = ()) -> DataFrame:
    """Rolling sum and mean of the (already rounded) daily profit over the
    whole history. Both share one sort and one window pass."""
    frame = rolling_frame("trade_date_mpt", rows, series)
    profit = "daily_net_profit_cad"
    return arb.select(
        *series,
        "trade_date_mpt",
        "min_charge_price",
        "max_discharge_price",
        "daily_charge_cost_cad",
        "daily_discharge_revenue_cad",
        profit,
        F.round(F.sum(profit).over(frame), 2).alias("rolling_10d_cumulative_profit_cad"),
        F.round(F.avg(profit).over(frame), 2).alias("rolling_10d_avg_daily_profit_cad"),
    )


def latest_days_report(rolled: DataFrame, days: int = schemas.LATEST_DAYS, series: Sequence[str] = ()) -> DataFrame:
    """The newest days of the rolling view under report names. The frame of the
    oldest day shown reaches behind it, so the cut comes after the window."""
    report = rolled.withColumnsRenamed(
        {"min_charge_price": "charge_price_per_mwh", "max_discharge_price": "discharge_price_per_mwh"}
    )
    return latest(report, "trade_date_mpt", days, series)


def latest_hours_report(errors: DataFrame, hours: int = schemas.LATEST_HOURS, series: Sequence[str] = ()) -> DataFrame:
    """The newest hours of the forecast errors. Local hours repeat when clocks
    go back, so the UTC hour settles ties."""
    return latest(errors, schemas.LOCAL_HOUR, hours, series, ties=[schemas.UTC_HOUR]).drop(schemas.UTC_HOUR)
