import datetime as dt
from decimal import Decimal

from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from gridtide.operators import rolling

D = Decimal


def profits(spark, values, skip=(), market=None):
    """Daily profits from 2026-08-01 on, with some dates left out."""
    rows = [(dt.date(2026, 8, 1) + dt.timedelta(days=i), v) for i, v in enumerate(values) if i not in skip]
    df = spark.createDataFrame(rows, "grid_date date, net_daily_profit decimal(20,2)")
    return df if market is None else df.withColumn("market", F.lit(market))


def silver(spark, values, skip=()):
    return (
        profits(spark, values, skip)
        .withColumnsRenamed({"grid_date": "trade_date_mpt", "net_daily_profit": "daily_net_profit_cad"})
        .withColumns(
            {
                c: F.lit(1).cast("decimal(10,2)")
                for c in (
                    "min_charge_price",
                    "max_discharge_price",
                    "daily_charge_cost_cad",
                    "daily_discharge_revenue_cad",
                )
            }
        )
    )


def test_running_total(spark):
    rows = rows_of(rolling.running_profit(profits(spark, [D(5), D(-2), None, D(4)])))
    assert [r[2] for r in rows] == [D(5), D(3), D(3), D(7)]
    assert [r[0].day for r in rows] == [1, 2, 3, 4]


def test_running_total_ends_at_the_sum(spark):
    values = [D(i * 37 % 101 - 50) for i in range(60)]
    rows = rows_of(rolling.running_profit(profits(spark, values)))
    assert rows[-1][2] == sum(values)


def test_last_days(spark):
    values = [D(i) for i in range(1, 16)]
    rows = rows_of(rolling.last_days_profit(profits(spark, values)))
    assert [r[0].day for r in rows] == list(range(15, 5, -1))
    kept = values[5:]
    assert {r[2] for r in rows} == {sum(kept)}
    # Over the kept days only, the rolling sum is a running one.
    assert [r[3] for r in reversed(rows)] == [sum(kept[: i + 1]) for i in range(10)]


def test_fewer_days_than_asked_for(spark):
    rows = rows_of(rolling.last_days_profit(profits(spark, [D(1), D(2)])))
    assert [(r[1], r[2], r[3]) for r in rows] == [(D(2), D(3), D(3)), (D(1), D(3), D(1))]


def test_last_days_per_series(spark):
    df = profits(spark, [D(i) for i in range(20)], market="a").unionByName(profits(spark, [D(7)] * 12, market="b"))
    rows = rows_of(rolling.last_days_profit(df, series=["market"]))
    assert len(rows) == 20
    assert {r[3] for r in rows if r[0] == "a"} == {D(sum(range(10, 20)))}
    assert {r[3] for r in rows if r[0] == "b"} == {D(70)}


def test_rolling_counts_rows_not_days(spark):
    values = [D(i) for i in range(1, 13)]
    rows = rows_of(rolling.rolling_profit(silver(spark, values, skip=(5,))), "trade_date_mpt")
    kept = [v for i, v in enumerate(values) if i != 5]
    assert len(rows) == 11
    for i, row in enumerate(rows):
        frame = kept[max(0, i - 9) : i + 1]
        assert row[6] == sum(frame)
        assert row[7] == (sum(frame) / len(frame)).quantize(D("0.01"), rounding="ROUND_HALF_UP")


def test_rolling_mean_ignores_null_profits(spark):
    rows = rows_of(rolling.rolling_profit(silver(spark, [None, D(4), None, D(6)])), "trade_date_mpt")
    assert [(r[6], r[7]) for r in rows] == [(None, None), (D(4), D(4)), (D(4), D(4)), (D(10), D(5))]


def test_latest_days_report_keeps_the_full_frame(spark):
    values = [D(i) for i in range(50)]
    rows = rows_of(rolling.latest_days_report(rolling.rolling_profit(silver(spark, values))))
    assert len(rows) == 30 and rows[0][5] == D(49)
    assert rows[-1][6] == sum(values[11:21])


def test_latest_hours_settles_ties_by_utc(spark):
    rows = [(dt.datetime(2026, 11, 1, 7), 1), (dt.datetime(2026, 11, 1, 8), 2), (dt.datetime(2026, 11, 1, 6), 0)]
    df = spark.createDataFrame(rows, "begin_datetime_utc timestamp_ntz, v int").withColumn(
        "begin_datetime_mpt", F.lit("2026-11-01 01:00").cast("timestamp_ntz")
    )
    got = rolling.latest_hours_report(df, 2)
    assert "begin_datetime_utc" not in got.columns
    assert [r.v for r in got.collect()] == [2, 1]


def test_latest_puts_nulls_first(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    assert [r.v for r in rolling.latest(df, "v", 2).collect()] == [None, 3]


def test_latest_keeps_n_rows_per_task_before_merging(spark):
    df = spark.range(1000, numPartitions=4).selectExpr("id % 3 AS g", "id AS v")
    assert "TakeOrderedAndProject" in plan_of(rolling.latest(df, "v", 10))
    assert "WindowGroupLimit" in plan_of(rolling.latest(df, "v", 10, ["g"]))


def test_rolling_sum_and_mean_share_one_window(spark):
    plan = plan_of(rolling.rolling_profit(silver(spark, [D(1), D(2)])))
    assert plan.count("+- Window") == 1 and plan.count("Sort [") == 1
