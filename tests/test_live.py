"""Views that follow a store: one SQL name, current after every load."""

import datetime as dt

from helpers import plan_of, rows_of
from test_store import LATER, MONTH
from test_upsert import T0, T1, grid, same

from gridtide.plans import views
from gridtide.sources import tables


def test_a_view_shows_each_load_of_any_session(spark, tmp_path):
    store = tables.MarketStore(spark, str(tmp_path), deltas=True)
    shown = views.LiveViews(store)
    assert shown.sql("SELECT * FROM raw_hourly_grid").isEmpty() and not shown.refresh()
    other = tables.MarketStore(spark.newSession(), str(tmp_path))
    for load, rows, run, when in ((store, MONTH, "r1", T0), (other, LATER, "r2", T1)):
        load.load_hourly(grid(load.spark, rows), run, when)
        assert same(shown.sql("SELECT * FROM raw_hourly_grid").drop("part"), store.read(tables.HOURLY))
        want = views.daily_battery_arbitrage(store.read(tables.DAILY))
        assert same(shown.sql("SELECT * FROM v_daily_battery_arbitrage"), want)
    one = shown.sql("SELECT * FROM raw_hourly_grid WHERE part = DATE '2026-07-28'")
    assert "part" in plan_of(one).split("PartitionFilters: [")[1].split("]")[0] and one.count() == 24
    store.compact(tables.HOURLY)
    assert shown.refresh()
    days = shown.sql("SELECT DISTINCT grid_date FROM daily_grid_agg WHERE grid_date > DATE '2026-07-31'")
    assert rows_of(days) == [(dt.date(2026, 8, 1),)]
