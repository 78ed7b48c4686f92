"""The stacked analytic views, as functions and as temporary SQL views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from gridtide import schemas
from gridtide.operators import arbitrage, daily, grid, rolling
from gridtide.sources import tables


def daily_battery_arbitrage(daily_agg: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Over the daily aggregate, loss on discharge."""
    return arbitrage.discharge_loss_view(daily_agg, series=series)


def daily_battery_arbitrage_silver(silver_price: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Over the silver prices, loss on charge."""
    return arbitrage.charge_loss_view(daily.price_range(silver_price, series=series), series=series)


def battery_arbitrage_rolling(silver_price: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    return rolling.rolling_profit(daily_battery_arbitrage_silver(silver_price, series), series=series)


def running_profit(daily_agg: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    return rolling.running_profit(daily_battery_arbitrage(daily_agg, series), series)


def last_days_profit(daily_agg: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    return rolling.last_days_profit(daily_battery_arbitrage(daily_agg, series), series=series)


def latest_days(silver_price: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    return rolling.latest_days_report(battery_arbitrage_rolling(silver_price, series), series=series)


def latest_hours(silver_price: DataFrame, silver_load: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    errors = grid.forecast_errors(silver_price, silver_load, [*series, schemas.UTC_HOUR])
    return rolling.latest_hours_report(errors, series=series)


def register(
    hourly: DataFrame | None = None,
    daily_agg: DataFrame | None = None,
    silver_price: DataFrame | None = None,
    silver_load: DataFrame | None = None,
    series: Sequence[str] = (),
) -> list[str]:
    """Put tables and derived views under their SQL names for ``spark.sql``.
    With ``series`` every figure is per market or zone."""
    # Table and view names analysts' SQL refers to.
    views: dict[str, DataFrame] = {}
    if hourly is not None:
        views["raw_hourly_grid"] = hourly
    if daily_agg is not None:
        views["daily_grid_agg"] = daily_agg
        views["v_daily_battery_arbitrage"] = daily_battery_arbitrage(daily_agg, series)
    if silver_price is not None:
        views["silver_pool_price"] = silver_price
        views["view_daily_battery_arbitrage"] = daily_battery_arbitrage_silver(silver_price, series)
        views["view_battery_arbitrage_10d_rolling"] = battery_arbitrage_rolling(silver_price, series)
    if silver_load is not None:
        views["silver_actual_forecast_load"] = silver_load
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def register_store(store: tables.MarketStore) -> list[str]:
    """The views over a store's tables as they are now: call it again after a
    load. Tables carry their partition date as ``part``, and SQL that filters
    on it opens only that date's files."""
    frames = [store.read(t, with_part=True) for t in (tables.HOURLY, tables.DAILY, tables.SILVER_PRICE, tables.SILVER_LOAD)]
    return register(*frames, series=store.series)


class LiveViews:
    """The same names, current under every query: the commit log is looked at
    first, and the views are put in place again if anything was published,
    by whatever session. SQL that filters on ``part`` opens only that date's
    files, as with ``register_store``."""

    def __init__(self, store: tables.MarketStore):
        self.store, self.shown = store, None

    def refresh(self) -> bool:
        """Whether there was anything new."""
        live = self.store.live()
        if live == self.shown:
            return False
        register_store(self.store)
        self.shown = live
        return True

    def sql(self, query: str) -> DataFrame:
        self.refresh()
        return self.store.spark.sql(query)
