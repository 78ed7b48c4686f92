import datetime as dt
from decimal import Decimal

import pytest
from helpers import hourly, rows_of
from pyspark.sql import functions as F

from gridtide import schemas
from gridtide.operators import daily, grid, rolling
from gridtide.plans import views

D = Decimal


@pytest.fixture(scope="module")
def market(spark):
    rows = [
        (f"2026-{m:02d}-{d:02d} {h:02d}:00", 20.0 + (d * h * 7 + m) % 83, 9000 + (h * 31 + d) % 400)
        for m in (6, 7)
        for d in range(1, 29)
        for h in range(24)
    ]
    hours = hourly(spark, rows).withColumns(
        {"forecast_pool_price": F.col("pool_price") - 1.5, "forecast_alberta_internal_load": F.col("alberta_internal_load") + 5}
    )
    money = {c: F.col(c).cast("decimal(10,2)") for c in ("pool_price", "forecast_pool_price")}
    price = hours.select(
        (F.col(schemas.LOCAL_HOUR) + F.expr("INTERVAL '6' HOUR")).alias(schemas.UTC_HOUR),
        schemas.LOCAL_HOUR,
        "pool_price",
        "forecast_pool_price",
    ).withColumns(money)
    load = hours.select((F.col(schemas.LOCAL_HOUR) + F.expr("INTERVAL '6' HOUR")).alias(schemas.UTC_HOUR), schemas.LOCAL_HOUR, *schemas.LOAD_METRICS)
    days = daily.daily_aggregate(hours, computed_at=dt.datetime(2026, 8, 1))
    names = views.register(hours, days, price, load)
    assert names == [
        "raw_hourly_grid",
        "daily_grid_agg",
        "v_daily_battery_arbitrage",
        "silver_pool_price",
        "view_daily_battery_arbitrage",
        "view_battery_arbitrage_10d_rolling",
        "silver_actual_forecast_load",
    ]
    return hours, days, price, load


def same(spark, df, sql):
    want = spark.sql(sql)
    assert df.columns == want.columns
    assert [tuple(r) for r in df.collect()] == [tuple(r) for r in want.collect()]


def test_running_profit_in_sql(spark, market):
    _, days, _, _ = market
    same(
        spark,
        views.running_profit(days),
        """SELECT a.grid_date, a.net_daily_profit,
                  (SELECT sum(b.net_daily_profit) FROM v_daily_battery_arbitrage b WHERE b.grid_date <= a.grid_date) AS total_profit_acc
           FROM v_daily_battery_arbitrage a ORDER BY a.grid_date""",
    )


def test_last_days_in_sql(spark, market):
    _, days, _, _ = market
    same(
        spark,
        views.last_days_profit(days),
        """SELECT grid_date, net_daily_profit,
                  sum(net_daily_profit) OVER () AS total_10_day_profit,
                  sum(net_daily_profit) OVER (ORDER BY grid_date) AS rolling_10d_sum
           FROM v_daily_battery_arbitrage
           WHERE grid_date > (SELECT date_sub(max(grid_date), 10) FROM v_daily_battery_arbitrage)
           ORDER BY grid_date DESC""",
    )


def test_latest_days_in_sql(spark, market):
    _, _, price, _ = market
    same(
        spark,
        views.latest_days(price),
        """SELECT trade_date_mpt, min_charge_price AS charge_price_per_mwh, max_discharge_price AS discharge_price_per_mwh,
                  daily_charge_cost_cad, daily_discharge_revenue_cad, daily_net_profit_cad,
                  rolling_10d_cumulative_profit_cad, rolling_10d_avg_daily_profit_cad
           FROM view_battery_arbitrage_10d_rolling ORDER BY trade_date_mpt DESC LIMIT 30""",
    )


def test_latest_hours_in_sql(spark, market):
    _, _, price, load = market
    df = views.latest_hours(price, load)
    same(
        spark,
        df,
        """SELECT p.begin_datetime_mpt, pool_price, forecast_pool_price, alberta_internal_load, forecast_alberta_internal_load,
                  pool_price - forecast_pool_price AS price_forecast_error,
                  alberta_internal_load - forecast_alberta_internal_load AS load_forecast_error
           FROM silver_pool_price p JOIN silver_actual_forecast_load l USING (begin_datetime_utc)
           ORDER BY p.begin_datetime_mpt DESC LIMIT 48""",
    )
    assert df.count() == 48 and {r.price_forecast_error for r in df.collect()} == {D("1.50")}


def test_correlation_in_sql(spark, market):
    hours, *_ = market
    want = spark.sql("SELECT corr(pool_price, alberta_internal_load) FROM raw_hourly_grid").first()[0]
    assert grid.demand_price_correlation(hours).first()[0] == pytest.approx(want, abs=1e-12)


def test_arbitrage_view_in_sql(spark, market):
    got = rows_of(spark.table("v_daily_battery_arbitrage"), "grid_date")
    for _, high, low, cost, revenue, profit in got:
        assert (cost, revenue, profit) == (low * 10, high * 9, high * 9 - low * 10)


def test_rolling_view_agrees_with_its_function(spark, market):
    _, _, price, _ = market
    daily_view = spark.table("view_daily_battery_arbitrage")
    got = rows_of(spark.table("view_battery_arbitrage_10d_rolling"), "trade_date_mpt")
    assert got == rows_of(rolling.rolling_profit(daily_view), "trade_date_mpt") and len(got) == 56
