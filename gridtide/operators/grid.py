"""Joining the price and load feeds, and the questions asked of the pair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide import schemas

JOIN_KINDS = ("full_outer", "inner", "left", "right")


def join_feeds(price: DataFrame, load: DataFrame, keys: Sequence[str] = (schemas.LOCAL_HOUR,), how: str = "full_outer") -> DataFrame:
    """Equi-join of two feeds already known to have unique keys (stored tables,
    or the output of an aggregate on the key). Unique keys cannot be hot, and
    inputs already partitioned on the key are not shuffled again."""
    return price.join(load, list(keys), how)


def merge_feeds(price: DataFrame, load: DataFrame, keys: Sequence[str] = (schemas.LOCAL_HOUR,), how: str = "full_outer") -> DataFrame:
    """The same join for raw feeds, failing on any key that is not unique.

    Under that rule a key has at most one row per side, so the join is a single
    aggregate over both feeds stacked: one read of each feed, one shuffle, no
    sort, and rows of a repeated (or null) key are combined before the shuffle,
    however many there are. The check sits in a filter of the same plan, so it
    cannot be optimised away and costs no second job over the raw documents.

    A null key matches nothing, but two rows with a null key are duplicates.
    """
    if how not in JOIN_KINDS:
        raise ValueError(f"how must be one of {JOIN_KINDS}, not {how!r}")
    keys = list(keys)
    price_cols = [c for c in price.columns if c not in keys]
    load_cols = [c for c in load.columns if c not in keys]
    shared = set(price_cols) & set(load_cols)
    if shared:
        raise ValueError(f"both feeds carry {sorted(shared)}; drop or rename one side's")

    stacked = price.withColumn("_price", F.lit(True)).unionByName(
        load.withColumn("_load", F.lit(True)), allowMissingColumns=True
    )
    if how == "inner":
        stacked = stacked.dropna(subset=keys)
    merged = stacked.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in price_cols + load_cols],
        F.count("_price").alias("_price"),
        F.count("_load").alias("_load"),
    )
    has_price, has_load = F.col("_price") > 0, F.col("_load") > 0
    wanted = {
        "full_outer": F.lit(True),
        "inner": has_price & has_load,
        "left": has_price,
        "right": has_load,
    }[how]
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    repeated = (F.col("_price") > 1) | (F.col("_load") > 1) | (null_key & (F.col("_price") + F.col("_load") > 1))
    message = F.concat_ws(" ", F.lit("duplicate timestamps found at"), *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    passes = F.when(~wanted, False).when(repeated, F.raise_error(message)).otherwise(True)
    return merged.filter(passes).drop("_price", "_load")


def forecast_errors(price: DataFrame, load: DataFrame, keys: Sequence[str] = (schemas.UTC_HOUR,)) -> DataFrame:
    """Actual against forecast, for hours both feeds report."""
    right = load.select(*keys, *schemas.LOAD_METRICS)
    left = price.select(*keys, schemas.LOCAL_HOUR, "pool_price", "forecast_pool_price")
    both = join_feeds(left, right, keys, "inner")
    return both.select(
        *keys,
        schemas.LOCAL_HOUR,
        "pool_price",
        "forecast_pool_price",
        *schemas.LOAD_METRICS,
        (F.col("pool_price") - F.col("forecast_pool_price")).alias("price_forecast_error"),
        (F.col("alberta_internal_load") - F.col("forecast_alberta_internal_load")).alias("load_forecast_error"),
    )


def correlation(x: str, y: str) -> Column:
    """Pearson correlation as an aggregate; pairs with a null do not count and
    a constant side gives NULL instead of an error."""
    complete = F.col(x).isNotNull() & F.col(y).isNotNull()
    a = F.when(complete, F.col(x).cast("double"))
    b = F.when(complete, F.col(y).cast("double"))
    spread = F.sqrt(F.var_pop(a) * F.var_pop(b))
    return F.try_divide(F.covar_pop(a, b), spread)


def demand_price_correlation(
    hourly: DataFrame, price: str = "pool_price", load: str = "alberta_internal_load", series: Sequence[str] = ()
) -> DataFrame:
    return hourly.groupBy(*series).agg(correlation(price, load).alias("demand_price_correlation"))
