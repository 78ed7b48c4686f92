import datetime as dt
from decimal import Decimal

import pytest
from helpers import hourly, rows_of
from pyspark.sql import functions as F

from gridtide import schemas
from gridtide.operators import daily

D = Decimal
NOW = dt.datetime(2026, 8, 5, 2)


def figures(spark, rows):
    got = daily.daily_aggregate(hourly(spark, rows), computed_at=NOW).orderBy("grid_date").collect()
    return [tuple(None if v is None else v for v in r) for r in got]


def test_layout(spark):
    from gridtide import schemas

    df = daily.daily_aggregate(hourly(spark, [("2026-08-01 00:00", 1.0, 1)]), computed_at=NOW)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schemas.DAILY_GRID]


def test_one_hour_day(spark):
    assert figures(spark, [("2026-08-01 00:00", 50.0, 7)]) == [
        (dt.date(2026, 8, 1), D("50.00"), D("50"), D("50"), D("0.00"), D("7.00"), 1, NOW)
    ]


def test_day_without_prices(spark):
    rows = [(f"2026-08-01 0{h}:00", None, 100 + h) for h in range(3)]
    assert figures(spark, rows) == [(dt.date(2026, 8, 1), None, None, None, D("0.00"), D("101.00"), 3, NOW)]


def test_sample_deviation_and_rounding(spark):
    rows = [("2026-08-01 00:00", 10.0, 1), ("2026-08-01 01:00", 20.0, 2), ("2026-08-01 02:00", 20.01, None)]
    ((_, avg, low, high, dev, load, hours, _),) = figures(spark, rows)
    assert (avg, low, high, dev, load, hours) == (D("16.67"), D("10"), D("20.01"), D("5.78"), D("1.50"), 3)


def test_mean_ties_round_up(spark):
    rows = [("2026-08-01 00:00", 1.00, 1), ("2026-08-01 01:00", 1.01, 2)]
    assert figures(spark, rows)[0][1] == D("1.01")
    rows = [("2026-08-01 00:00", -1.00, 1), ("2026-08-01 01:00", -1.01, 2)]
    assert figures(spark, rows)[0][1] == D("-1.01")


def test_rows_without_an_hour_belong_to_no_day(spark):
    assert len(figures(spark, [("2026-08-01 00:00", 1.0, 1), (None, 5.0, 5)])) == 1


def test_days_split_at_local_midnight(spark):
    got = figures(spark, [("2026-08-01 23:00", 1.0, 1), ("2026-08-02 00:00", 5.0, 5)])
    assert [(r[0].day, r[2]) for r in got] == [(1, D("1")), (2, D("5"))]


def test_series(spark):
    df = hourly(spark, [("2026-08-01 00:00", 1.0, 1), ("2026-08-01 01:00", 3.0, 1)]).withColumn("market", F.lit("a"))
    df = df.unionByName(df.withColumn("market", F.lit("b")).withColumn("pool_price", F.col("pool_price") * 10))
    got = daily.daily_aggregate(df, series=["market"], computed_at=NOW)
    assert rows_of(got.select("market", "max_price"), "market") == [("a", D("3")), ("b", D("30"))]


@pytest.mark.parametrize("day, hours", [("2026-03-08", 23), ("2026-11-01", 25), ("2026-08-01", 24)])
@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_hours_in_a_day(spark, day, hours, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(day,)], "d string").select(daily.hours_in_day(F.col("d").cast("date")))
        assert df.first()[0] == hours
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_completeness(spark):
    rows = [(f"2026-03-08 {h:02d}:00", 1.0, 1) for h in range(24) if h != 2]
    rows += [(f"2026-08-01 {h:02d}:00", None, 1) for h in range(22)]
    got = rows_of(daily.completeness(daily.daily_aggregate(hourly(spark, rows))), "grid_date")
    assert got == [(dt.date(2026, 3, 8), 23, 23, 0, True), (dt.date(2026, 8, 1), 22, 24, 2, False)]


@pytest.mark.parametrize("kind", ["decimal(10,2)", "double", "decimal(18,6)"])
@pytest.mark.parametrize("exact", [schemas.MONEY_TYPE, schemas.PRICE_TYPE])
def test_mean_of_a_big_day_is_rounded_once(spark, kind, exact):
    # 10,000 prices of 12.35 and 10,001 of 12.34: just under 12.345.
    hours = spark.range(20_001).select(
        F.lit("2026-08-01 00:00:00").cast("timestamp_ntz").alias(schemas.LOCAL_HOUR),
        F.when(F.col("id") < 10_000, 12.35).otherwise(12.34).cast(kind).alias("pool_price"),
        F.lit(1).alias("alberta_internal_load"),
    )
    assert daily.daily_aggregate(hours, exact=exact).first()["avg_price"] == D("12.34")
