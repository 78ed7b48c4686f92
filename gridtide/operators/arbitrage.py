"""Daily profit of a battery that charges at a day's lowest price and
discharges at its highest.

The two published variants differ in where the round-trip loss falls: on
discharge (buy the full capacity, sell what is left) or on charge (buy more,
sell the full capacity). Minimum and maximum are not ordered in time, and a
loss-making day stays negative.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide import schemas

# The least places capacities and efficiencies are kept with.
CAPACITY_PLACES, EFFICIENCY_PLACES = 2, 4

Number = str | float | Decimal


def _exact_type(values: Sequence[Number], places: int) -> str:
    """A decimal type that holds each of the values with all its digits."""
    parts = [Decimal(str(v)).as_tuple() for v in values]
    scale = max(places, *[-p.exponent for p in parts])
    whole = max(len(p.digits) + p.exponent for p in parts)
    return f"decimal({max(whole, 1) + scale},{scale})"


def _number(value: Number, kind: str) -> Column:
    return F.lit(format(Decimal(str(value)), "f")).cast(kind)


def cash_flows(low: Column, high: Column, capacity: Column, efficiency: Column, loss_on: str) -> tuple[Column, Column, Column]:
    """Cost, revenue and profit, each rounded to cents from unrounded parts.

    Division comes last, on a wide decimal: dividing capacity by efficiency
    first would keep six places only and move cents on large prices.
    """
    low, high = (c.cast(schemas.PRICE_TYPE) for c in (low, high))
    if loss_on == "discharge":
        cost, revenue = low * capacity, high * capacity * efficiency
    elif loss_on == "charge":
        cost, revenue = low * capacity / efficiency, high * capacity
    else:
        raise ValueError(f"loss_on must be 'discharge' or 'charge', not {loss_on!r}")
    return tuple(F.round(c, 2).cast("decimal(20,2)") for c in (cost, revenue, revenue - cost))


def discharge_loss_view(
    daily: DataFrame,
    capacity_mwh: str | float = schemas.BATTERY_CAPACITY_MWH,
    efficiency: str | float = schemas.ROUND_TRIP_EFFICIENCY,
    series: Sequence[str] = (),
) -> DataFrame:
    """Profit per day of the daily aggregate, loss on discharge."""
    cost, revenue, profit = cash_flows(
        F.col("min_price"),
        F.col("max_price"),
        _number(capacity_mwh, _exact_type([capacity_mwh], CAPACITY_PLACES)),
        _number(efficiency, _exact_type([efficiency], EFFICIENCY_PLACES)),
        "discharge",
    )
    return daily.select(
        *series,
        "grid_date",
        "max_price",
        "min_price",
        cost.alias("charge_cost"),
        revenue.alias("discharge_revenue"),
        profit.alias("net_daily_profit"),
    )


def _charge_loss(ranges: DataFrame, capacity: Column, efficiency: Column, series: Sequence[str]) -> DataFrame:
    cost, revenue, profit = cash_flows(
        F.col("min_charge_price"), F.col("max_discharge_price"), capacity, efficiency, "charge"
    )
    return ranges.select(
        *series,
        "trade_date_mpt",
        "min_charge_price",
        "max_discharge_price",
        capacity.alias("battery_capacity_mwh"),
        efficiency.alias("round_trip_efficiency"),
        cost.alias("daily_charge_cost_cad"),
        revenue.alias("daily_discharge_revenue_cad"),
        profit.alias("daily_net_profit_cad"),
    )


def charge_loss_view(
    ranges: DataFrame,
    capacity_mwh: str | float = schemas.BATTERY_CAPACITY_MWH,
    efficiency: str | float = schemas.ROUND_TRIP_EFFICIENCY,
    series: Sequence[str] = (),
) -> DataFrame:
    """Profit per day of the daily price range, loss on charge."""
    return _charge_loss(
        ranges, _number(capacity_mwh, _exact_type([capacity_mwh], CAPACITY_PLACES)), _number(efficiency, _exact_type([efficiency], EFFICIENCY_PLACES)), series
    )


def sweep(ranges: DataFrame, specs: Sequence[tuple[str | float, str | float]], series: Sequence[str] = ()) -> DataFrame:
    """The same for several (capacity, efficiency) pairs: one row per day and
    pair. The pairs ride along as an array literal, so there is no join and the
    daily input is read once."""
    capacity_type = _exact_type([c for c, _ in specs], CAPACITY_PLACES)
    efficiency_type = _exact_type([e for _, e in specs], EFFICIENCY_PLACES)
    pairs = F.array(
        *[
            F.struct(_number(c, capacity_type).alias("capacity"), _number(e, efficiency_type).alias("efficiency"))
            for c, e in specs
        ]
    )
    each = ranges.withColumn("spec", F.explode(pairs))
    return _charge_loss(each, F.col("spec.capacity"), F.col("spec.efficiency"), series)
