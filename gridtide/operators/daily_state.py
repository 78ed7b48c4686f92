"""Daily figures that follow corrections without reading whole days again.

Per day (and series) a state holds what can be added to and taken from: counts,
exact sums and sums of squares. A batch of corrections takes the old versions of
its keys off and adds the new ones. Only the extremes cannot always follow: if
a value that goes was the day's lowest or highest, and no new value reaches it,
the day is read again. Everything is exact, so a state that has followed any
number of batches equals one worked out from scratch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide import schemas
from gridtide.functions import casting
from gridtide.operators.daily import GRID_DATE

LOAD_TYPE = T.DecimalType(18, 4)
SUMS = {
    "n_rows": "bigint", "n_prices": "bigint", "price_sum": "decimal(38,6)", "price_squares": "decimal(38,12)",
    "n_loads": "bigint", "load_sum": "decimal(38,4)",
}
EXTREMES = {"min_price": F.least, "max_price": F.greatest}


def daily_state(
    hourly: DataFrame, series: Sequence[str] = (), ts: str = schemas.LOCAL_HOUR, price: str = "pool_price", load: str = "alberta_internal_load"
) -> DataFrame:
    """The state of every day in ``hourly``. Rows without an hour are in none."""
    p, amount = F.col(price).cast(schemas.PRICE_TYPE), F.col(load).cast(LOAD_TYPE)
    figures = {
        "n_rows": F.count("*"), "n_prices": F.count(p), "price_sum": F.coalesce(F.sum(p), F.lit(0)),
        "price_squares": F.coalesce(F.sum(p * p), F.lit(0)), "n_loads": F.count(amount), "load_sum": F.coalesce(F.sum(amount), F.lit(0)),
    }
    grouped = hourly.filter(F.col(ts).isNotNull()).groupBy(*series, F.to_date(ts).alias(GRID_DATE))
    sums = [figures[c].cast(kind).alias(c) for c, kind in SUMS.items()]
    return grouped.agg(*sums, F.min(p).alias("min_price"), F.max(p).alias("max_price"))


def merge_state(state: DataFrame, removed: DataFrame, added: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """A state after rows were taken off and others added, both given as states
    of their own, and ``stale``: whether an extreme of the day is unknown. Days
    left without rows go. One aggregate over the three; null series match."""
    columns = [*series, GRID_DATE, *SUMS, *EXTREMES]
    tagged = [d.select(*columns, F.lit(side).alias("_side")) for side, d in zip("sra", (state, removed, added), strict=True)]
    sign = F.when(F.col("_side") == "r", -1).otherwise(1)
    of_side = lambda side, c: F.max(F.when(F.col("_side") == side, F.col(c))).alias(f"{side}_{c}")
    merged = (
        tagged[0].unionByName(tagged[1]).unionByName(tagged[2])
        .groupBy(*series, GRID_DATE)
        .agg(*[F.sum(F.col(c) * sign).cast(kind).alias(c) for c, kind in SUMS.items()], *[of_side(s, c) for s in "sra" for c in EXTREMES])
        .filter("n_rows <> 0")
    )
    unknown = F.lit(False)
    for c, pick in EXTREMES.items():
        # The extreme that goes was the day's own, and nothing new reaches it.
        goes = F.coalesce(F.col(f"r_{c}") == F.col(f"s_{c}"), F.lit(False))
        reached = F.coalesce(pick(f"a_{c}", f"s_{c}") == F.col(f"a_{c}"), F.lit(False))
        unknown = unknown | (goes & ~reached)
    priced = F.col("n_prices") > 0
    extremes = [F.when(priced, pick(f"s_{c}", f"a_{c}")).alias(c) for c, pick in EXTREMES.items()]
    return merged.select(*series, GRID_DATE, *SUMS, *extremes, (priced & unknown).alias("stale"))


def follow(
    state: DataFrame, old_rows: DataFrame, new_rows: DataFrame, hourly: DataFrame, series: Sequence[str] = (), ts: str = schemas.LOCAL_HOUR
) -> DataFrame:
    """The state of every day after a batch. ``old_rows`` are the stored
    versions of the batch's keys, ``new_rows`` what they become, and ``hourly``
    the table afterwards, read for the stale days only. Days that no row of the
    batch touches pass as they are."""
    merged = merge_state(state, daily_state(old_rows, series, ts), daily_state(new_rows, series, ts), series)
    keys = [*series, GRID_DATE]
    stale = merged.filter("stale").select(*[F.col(k).alias(f"_stale_{k}") for k in keys])
    dated = hourly.withColumn("_date", F.to_date(ts))
    on = dated["_date"] == F.col(f"_stale_{GRID_DATE}")
    for s in series:
        on = on & dated[s].eqNullSafe(F.col(f"_stale_{s}"))
    again = daily_state(dated.join(stale, on, "left_semi").drop("_date"), series, ts)
    return merged.filter("not stale").drop("stale").unionByName(again)


def figures(state: DataFrame, series: Sequence[str] = (), computed_at=None) -> DataFrame:
    """Rows of the daily table from their states."""
    prices, loads = (F.nullif(F.col(c).cast("decimal(20,0)"), F.lit(0)) for c in ("n_prices", "n_loads"))
    total = F.col("price_sum")
    spread = (F.col("price_squares") - (total * total / prices)).cast("double")
    variance = F.when(F.col("n_prices") > 1, F.greatest(spread, F.lit(0.0)) / (F.col("n_prices") - 1)).otherwise(F.lit(0.0))
    return state.select(
        *series,
        GRID_DATE,
        F.round(total / prices, 2).cast("decimal(18,2)").alias("avg_price"),
        F.col("min_price").cast(schemas.PRICE_TYPE).alias("min_price"),
        F.col("max_price").cast(schemas.PRICE_TYPE).alias("max_price"),
        F.round(F.sqrt(variance), 2).cast("decimal(18,2)").alias("stddev_price"),
        F.round(F.col("load_sum") / loads, 2).cast("decimal(18,2)").alias("avg_load"),
        F.col("n_rows").cast("int").alias("hours_reported"),
        casting.run_at(computed_at).alias("computed_at"),
    )
