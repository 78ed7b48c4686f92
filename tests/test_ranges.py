"""Running and rolling figures in ranges against plain windows."""

import random

import pytest
from helpers import plan_of
from pyspark.sql import Window
from pyspark.sql import functions as F
from test_upsert import same

from gridtide.operators import ranges


def series_frame(spark, n=600, seed=1):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", None]) if i % 7 else "a", rng.choice([None, rng.randint(0, 40), 5]), i, rng.choice([None, rng.randint(-500, 500) / 4])) for i in range(n)]
    df = spark.createDataFrame(rows, "market string, day int, id int, value double")
    when = F.date_add(F.lit("2026-01-01").cast("date"), F.col("day"))
    return df.withColumn("day", when).withColumn("value", F.col("value").cast("decimal(12,2)")).repartition(6)


@pytest.mark.parametrize("series, n_ranges", [((), 1), ((), 20), (("market",), 9)])
def test_running_total(spark, series, n_ranges):
    df, order = series_frame(spark), ["day", "id"]
    got = ranges.running_total(df, "value", order, "total", series, n_ranges)
    window = Window.partitionBy(*series).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.withColumn("total", F.sum("value").over(window))
    assert got.schema == want.schema and same(got, want)


@pytest.mark.parametrize("series, n_ranges", [((), 1), ((), 50), (("market",), 30)])
def test_rolling(spark, series, n_ranges):
    df, order = series_frame(spark, 200), ["day", "id"]
    figures = {"total": F.sum("value"), "mean": F.avg("value"), "n": F.count("*")}
    got = ranges.rolling(df, figures, order, 10, series, n_ranges)
    window = Window.partitionBy(*series).orderBy(*order).rowsBetween(-9, 0)
    want = df.select("*", *[f.over(window).alias(name) for name, f in figures.items()])
    assert got.columns == want.columns and same(got, want)


def test_one_busy_day_is_split(spark):
    df = spark.range(20_000).select(F.lit("2026-08-01").cast("date").alias("day"), F.col("id"), F.lit(1).alias("value"))
    sizes = [r["count"] for r in ranges.with_range(df, ["day", "id"], 16).groupBy(ranges.RANGE).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 20_000 / 16


def test_ranges_never_fall_along_the_order(spark):
    df = series_frame(spark).withColumn("hour", F.col("day").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id") % 24))
    rows = ranges.with_range(df, ["hour", "id"], 20).orderBy(F.asc_nulls_first("hour"), "id").collect()
    numbers = [r[ranges.RANGE] for r in rows]
    assert numbers == sorted(numbers) and len(set(numbers)) > 10


def test_nothing_to_run_over(spark):
    df = series_frame(spark).limit(0)
    assert ranges.running_total(df, "value", ["day", "id"], "total").isEmpty()
    assert ranges.rolling(df, {"n": F.count("*")}, ["day"], 10).isEmpty()
    with pytest.raises(TypeError):
        ranges.with_range(series_frame(spark), ["market"])


def test_no_task_sees_the_whole_series(spark):
    df = series_frame(spark)
    for done in (
        ranges.running_total(df, "value", ["day", "id"], "total"),
        ranges.rolling(df, {"total": F.sum("value")}, ["day", "id"], 10),
    ):
        assert "SinglePartition" not in plan_of(done)
