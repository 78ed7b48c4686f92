"""Rows, documents and comparisons the tests share."""

import json

from pyspark.sql import functions as F

from gridtide import schemas


def price_record(local, price, forecast=None, average=None, utc=None):
    return {
        "begin_datetime_utc": local if utc is None else utc,
        "begin_datetime_mpt": local,
        "pool_price": price,
        "forecast_pool_price": forecast,
        "rolling_30day_avg": average,
    }


def load_record(local, load, forecast=None, utc=None):
    return {
        "begin_datetime_utc": local if utc is None else utc,
        "begin_datetime_mpt": local,
        "alberta_internal_load": load,
        "forecast_alberta_internal_load": forecast,
    }


# Two hours as both feeds report them.
PRICES = [
    price_record("2026-08-01 00:00", "21.63", "23.35", "31.99", "2026-08-01 06:00"),
    price_record("2026-08-01 01:00", "18.87", "22.10", "32.00", "2026-08-01 07:00"),
]
LOADS = [
    load_record("2026-08-01 00:00", "10089", "10100", "2026-08-01 06:00"),
    load_record("2026-08-01 01:00", "9950", "9980", "2026-08-01 07:00"),
]


def envelope(report, records):
    return {"return": {report: records}}


def write_json(path, document):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(document if isinstance(document, str) else json.dumps(document, indent=2))
    return str(path)


def raw_frame(spark, records, record_type):
    rows = [tuple(r.get(n) for n in record_type.names) for r in records]
    return spark.createDataFrame(rows, record_type)


def raw_prices(spark, records):
    return raw_frame(spark, records, schemas.PRICE_RECORD)


def raw_loads(spark, records):
    return raw_frame(spark, records, schemas.LOAD_RECORD)


def hourly(spark, rows):
    """Rows of (local hour text, price, load)."""
    df = spark.createDataFrame(rows, "h string, pool_price double, alberta_internal_load int")
    return df.select(F.col("h").cast("timestamp_ntz").alias(schemas.LOCAL_HOUR), "pool_price", "alberta_internal_load")


def rows_of(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
