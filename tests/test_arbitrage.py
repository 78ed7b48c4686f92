import datetime as dt
from decimal import Decimal

import pytest
from helpers import hourly, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridtide import schemas
from gridtide.operators import arbitrage, daily

D = Decimal
DAY = dt.date(2026, 8, 1)


def ranges(spark, pairs):
    rows = [(DAY + dt.timedelta(days=i), lo, hi) for i, (lo, hi) in enumerate(pairs)]
    return spark.createDataFrame(rows, "trade_date_mpt date, min_charge_price decimal(10,2), max_discharge_price decimal(10,2)")


def daily_rows(spark, pairs):
    return ranges(spark, pairs).toDF("grid_date", "min_price", "max_price")


@pytest.mark.parametrize(
    "low, high, on_discharge, on_charge",
    [
        ("100", "100", "-100.00", "-111.11"),
        ("20", "100", "700.00", "777.78"),
        ("0", "0", "0.00", "0.00"),
        ("-20", "100", "1100.00", "1222.22"),
        (None, None, None, None),
    ],
)
def test_profit(spark, low, high, on_discharge, on_charge):
    pair = [(low and D(low), high and D(high))]
    h = arbitrage.discharge_loss_view(daily_rows(spark, pair)).first()
    s = arbitrage.charge_loss_view(ranges(spark, pair)).first()
    assert h.net_daily_profit == (on_discharge and D(on_discharge))
    assert s.daily_net_profit_cad == (on_charge and D(on_charge))


def test_columns(spark):
    pair = [(D("20"), D("100"))]
    h = arbitrage.discharge_loss_view(daily_rows(spark, pair))
    assert h.columns == ["grid_date", "max_price", "min_price", "charge_cost", "discharge_revenue", "net_daily_profit"]
    assert h.first()[3:5] == (D("200.00"), D("900.00"))
    s = arbitrage.charge_loss_view(ranges(spark, pair))
    assert s.columns == [
        "trade_date_mpt",
        "min_charge_price",
        "max_discharge_price",
        "battery_capacity_mwh",
        "round_trip_efficiency",
        "daily_charge_cost_cad",
        "daily_discharge_revenue_cad",
        "daily_net_profit_cad",
    ]
    assert s.first()[3:7] == (D("10.00"), D("0.9000"), D("222.22"), D("1000.00"))


def exact(low, high, cap, eff):
    """Charge-side profit in cents by exact integer arithmetic."""
    num, den = cap * (high * eff - low), eff
    cents = num * 100 / den
    return cents.quantize(D(1), rounding="ROUND_HALF_UP") / 100


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.decimals(-500000, 500000, places=2), st.decimals(0, 500000, places=2)), min_size=1, max_size=40
    )
)
def test_charge_side_to_the_cent_and_both_sides_agree(spark, drawn):
    pairs = [(lo, lo + spread) for lo, spread in drawn]
    s = [r.daily_net_profit_cad for r in arbitrage.charge_loss_view(ranges(spark, pairs)).orderBy("trade_date_mpt").collect()]
    h = [r.net_daily_profit for r in arbitrage.discharge_loss_view(daily_rows(spark, pairs)).orderBy("grid_date").collect()]
    assert s == [exact(lo, hi, D(10), D("0.9")) for lo, hi in pairs]
    assert all(abs(a * D("0.9") - b) <= D("0.01") for a, b in zip(s, h))


def test_large_prices_do_not_lose_cents(spark):
    (row,) = arbitrage.charge_loss_view(ranges(spark, [(D("499978.59"), D("500000.00"))])).collect()
    assert row.daily_charge_cost_cad == D("5555317.67")


def test_sweep(spark):
    days = ranges(spark, [(D("20"), D("100")), (D("0"), D("5"))])
    df = arbitrage.sweep(days, [("10", "0.90"), (5, 0.5), ("100", "1")])
    assert df.count() == 6
    one = df.filter("battery_capacity_mwh = 10").drop("spec")
    assert rows_of(one, "trade_date_mpt") == rows_of(arbitrage.charge_loss_view(days), "trade_date_mpt")
    got = {(r[3], r[4]): r[7] for r in df.collect() if r[0] == DAY}
    assert got == {(D("10"), D("0.9")): D("777.78"), (D("5"), D("0.5")): D("300.00"), (D("100"), D("1")): D("8000.00")}


def test_unknown_side(spark):
    one = F.lit(1)
    with pytest.raises(ValueError, match="loss_on"):
        arbitrage.cash_flows(one, one, one, one, "both")


def test_minimum_may_come_after_maximum(spark):
    hours = hourly(spark, [("2026-08-01 05:00", 100.0, 1), ("2026-08-01 20:00", 20.0, 1)])
    prices = hours.withColumn("pool_price", F.col("pool_price").cast("decimal(10,2)"))
    assert arbitrage.charge_loss_view(daily.price_range(prices)).first().daily_net_profit_cad == D("777.78")


def test_battery_parameters_keep_their_digits(spark):
    ranges = spark.createDataFrame([(D("20.00"), D("100.00"))], "min_charge_price decimal(10,2), max_discharge_price decimal(10,2)")
    ranges = ranges.withColumn("trade_date_mpt", F.lit("2026-08-01").cast("date"))
    for df in (arbitrage.charge_loss_view(ranges, "10.125", 0.92555), arbitrage.sweep(ranges, [("1e1", "1"), ("10.125", "0.92555")])):
        row = df.collect()[-1]
        assert (row.battery_capacity_mwh, row.round_trip_efficiency) == (D("10.125"), D("0.92555"))
        assert row.daily_charge_cost_cad == D("218.79") and row.daily_discharge_revenue_cad == D("1012.50")
