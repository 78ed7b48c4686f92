"""Market roles for the general-purpose test tables.

``events`` plays both feeds: purchases are prices (highest, lowest and spread
of ``value`` in the hour), views are load (their number, and the number of
users behind them). ``orders`` and ``lineitem`` are longer daily price series.
Each role is an aggregate of a whole table and reads only the columns it needs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide import schemas
from gridtide.sources.reports import in_window

# The day the look-back ends on, and where the incremental queries split
# the events; the base has no first day and the batch no last one.
AS_OF = dt.date(2024, 1, 30)
BASE_LAST_DAY = dt.date(2024, 1, 20)
BATCH_FIRST_DAY = dt.date(2024, 1, 15)
BASE_RUN, BATCH_RUN = "run-base", "run-correction"
BASE_TIME, BATCH_TIME = dt.datetime(2024, 2, 1, 2), dt.datetime(2024, 2, 2, 2)
# Fixed value: the market's distance from UTC in the days above.
LOCAL_OFFSET = "INTERVAL '7' HOUR"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hour_of(ts: str = "ts") -> Column:
    """The hour a zone-less timestamp falls in, whatever the session's zone."""
    midnight = F.to_date(ts).cast("timestamp_ntz")
    return midnight + F.make_dt_interval(hours=F.hour(ts))


def _money(c: Column) -> Column:
    return c.cast(schemas.MONEY_TYPE)


def _events(spark: SparkSession, sf_dir: str, first: dt.date | None, last: dt.date | None) -> DataFrame:
    events = table(spark, sf_dir, "events")
    if first is None and last is None:
        return events
    return events.filter(in_window(F.col("ts"), first, last))


def price_feed(
    spark: SparkSession,
    sf_dir: str,
    first: dt.date | None = None,
    last: dt.date | None = None,
    key: str = schemas.LOCAL_HOUR,
) -> DataFrame:
    # Highest and lowest are found as doubles and made exact once per hour.
    value = F.col("value")
    return (
        _events(spark, sf_dir, first, last)
        .filter("event_type = 'purchase'")
        .groupBy(hour_of().alias(key))
        .agg(
            _money(F.max(value)).alias("pool_price"),
            _money(F.min(value)).alias("forecast_pool_price"),
            (_money(F.max(value)) - _money(F.min(value))).cast(schemas.MONEY_TYPE).alias("rolling_30day_avg"),
        )
    )


def load_feed(
    spark: SparkSession,
    sf_dir: str,
    first: dt.date | None = None,
    last: dt.date | None = None,
    key: str = schemas.LOCAL_HOUR,
) -> DataFrame:
    return (
        _events(spark, sf_dir, first, last)
        .filter("event_type = 'view'")
        .groupBy(hour_of().alias(key))
        .agg(
            F.count("*").cast("int").alias("alberta_internal_load"),
            F.count_distinct("user_id").cast("int").alias("forecast_alberta_internal_load"),
        )
    )


def grid_feed(spark: SparkSession, sf_dir: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Both feeds joined, hour by hour, from one scan of the events: what a
    full outer join of the two feeds gives. Events without a time are in no
    hour; saying so here lets plans that use the grid twice share its shuffle."""
    is_price, is_load = F.col("event_type") == "purchase", F.col("event_type") == "view"
    price = F.when(is_price, F.col("value"))
    views = F.count_if(is_load)
    return (
        _events(spark, sf_dir, first, last)
        .filter((is_price | is_load) & hour_of().isNotNull())
        .groupBy(hour_of().alias(schemas.LOCAL_HOUR))
        .agg(
            _money(F.max(price)).alias("pool_price"),
            _money(F.min(price)).alias("forecast_pool_price"),
            (_money(F.max(price)) - _money(F.min(price))).cast(schemas.MONEY_TYPE).alias("rolling_30day_avg"),
            F.nullif(views, F.lit(0)).cast("int").alias("alberta_internal_load"),
            F.nullif(F.count_distinct(F.when(is_load, F.col("user_id"))), F.lit(0))
            .cast("int")
            .alias("forecast_alberta_internal_load"),
        )
    )


def with_local_hour(feed: DataFrame) -> DataFrame:
    """Add the local hour to a feed keyed on UTC."""
    return feed.withColumn(schemas.LOCAL_HOUR, F.col(schemas.UTC_HOUR) - F.expr(LOCAL_OFFSET))


def silver_price(spark: SparkSession, sf_dir: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    return with_local_hour(price_feed(spark, sf_dir, first, last, schemas.UTC_HOUR))


def silver_load(spark: SparkSession, sf_dir: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    return with_local_hour(load_feed(spark, sf_dir, first, last, schemas.UTC_HOUR))


def corrected(feed: DataFrame, hour: str, price: str) -> DataFrame:
    """A later delivery of a feed: every value one higher, and NULL at each
    fifth hour of the day."""
    return feed.withColumn(price, F.when(F.hour(hour) % 5 != 0, F.col(price) + 1))


def order_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as price observations; the customer key stands in for load."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias(schemas.LOCAL_HOUR),
        F.col("o_totalprice").alias("pool_price"),
        F.col("o_custkey").alias("alberta_internal_load"),
        F.col("o_orderpriority").alias("market"),
    )


def shipment_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as price observations of several markets; quantity stands in
    for load."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias(schemas.LOCAL_HOUR),
        F.col("l_extendedprice").alias("pool_price"),
        F.col("l_quantity").cast("bigint").alias("alberta_internal_load"),
        F.col("l_returnflag").alias("market"),
    )


def stated(df: DataFrame) -> DataFrame:
    """Result types any SQL engine has: decimals as double, integers as bigint."""
    kinds = {"decimal": "double", "integer": "bigint"}
    return df.select(
        *[
            F.col(f.name).cast(kinds[f.dataType.typeName()]) if f.dataType.typeName() in kinds else F.col(f.name)
            for f in df.schema.fields
        ]
    )
