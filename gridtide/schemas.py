"""Names, record layouts and table layouts shared by every module.

Everything is declared: raw feeds are read with an explicit all-string schema
(no inference pass over the data), and each table has a fixed column order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Report, field and file names as the market feeds publish them.
PRICE_REPORT = "Pool Price Report"
LOAD_REPORT = "Actual Forecast Report"
ENVELOPE = "return"
UTC_HOUR = "begin_datetime_utc"
LOCAL_HOUR = "begin_datetime_mpt"
PRICE_METRICS = ["pool_price", "forecast_pool_price", "rolling_30day_avg"]
LOAD_METRICS = ["alberta_internal_load", "forecast_alberta_internal_load"]
PRICE_PREFIX = "raw_pool_prices"
LOAD_PREFIX = "raw_ail"
CAPACITY_PREFIX = "raw_gen_cap"
PRICE_WINDOW_FILE = "pool_price_raw.json"
LOAD_WINDOW_FILE = "actual_forecast_load_raw.json"
GRID_DATASET = "hourly_grid_performance.parquet"
PRICE_DATASET = "pool_price_clean"
LOAD_DATASET = "load_clean"
MARKET_ZONE = "America/Edmonton"

# The battery every report assumes unless told otherwise.
BATTERY_CAPACITY_MWH = "10.0"
ROUND_TRIP_EFFICIENCY = "0.90"

# Report sizes and look-back.
ROLLING_ROWS = 10
LATEST_DAYS = 30
LATEST_HOURS = 48
LOOKBACK_DAYS = 15

# Prices of the hourly grid have no declared scale; six places keep every digit
# the feeds publish while staying inside an 18-digit (long-backed) decimal.
PRICE_TYPE = T.DecimalType(18, 6)
MONEY_TYPE = T.DecimalType(10, 2)

RUN_COLUMNS = ["source_run_id", "created_run_id", "updated_run_id"]


def string_fields(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


PRICE_RECORD = string_fields([UTC_HOUR, LOCAL_HOUR, *PRICE_METRICS])
LOAD_RECORD = string_fields([UTC_HOUR, LOCAL_HOUR, *LOAD_METRICS])


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


_TS = T.TimestampNTZType()
_TEXT = T.StringType()

# Variant H: one joined row per local hour.
HOURLY_GRID = _table(
    begin_datetime_mpt=_TS,
    pool_price=PRICE_TYPE,
    forecast_pool_price=PRICE_TYPE,
    rolling_30day_avg=PRICE_TYPE,
    alberta_internal_load=T.IntegerType(),
    forecast_alberta_internal_load=T.IntegerType(),
    ingested_at=_TS,
    source_run_id=_TEXT,
    created_run_id=_TEXT,
    updated_run_id=_TEXT,
)

DAILY_GRID = _table(
    grid_date=T.DateType(),
    avg_price=T.DecimalType(18, 2),
    min_price=PRICE_TYPE,
    max_price=PRICE_TYPE,
    stddev_price=T.DecimalType(18, 2),
    avg_load=T.DecimalType(18, 2),
    hours_reported=T.IntegerType(),
    computed_at=_TS,
)

# Variant S: each feed in a table of its own, keyed on the UTC hour.
SILVER_PRICE = _table(
    begin_datetime_utc=_TS,
    begin_datetime_mpt=_TS,
    pool_price=MONEY_TYPE,
    forecast_pool_price=MONEY_TYPE,
    rolling_30day_avg=MONEY_TYPE,
    created_at=_TS,
    updated_at=_TS,
)

SILVER_LOAD = _table(
    begin_datetime_utc=_TS,
    begin_datetime_mpt=_TS,
    alberta_internal_load=MONEY_TYPE,
    forecast_alberta_internal_load=MONEY_TYPE,
    created_at=_TS,
    updated_at=_TS,
)
