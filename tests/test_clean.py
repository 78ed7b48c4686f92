import datetime as dt

import pytest
from helpers import plan_of, price_record, raw_loads, raw_prices, load_record, rows_of
from pyspark.sql import functions as F

from gridtide import schemas
from gridtide.operators import clean

H0, H1 = dt.datetime(2026, 8, 1), dt.datetime(2026, 8, 1, 1)


def test_local_hour_variant_keeps_bad_rows_and_drops_utc(spark):
    raw = raw_prices(spark, [price_record("2026-08-01 00:00", "21.63", "", "x"), price_record("bad", "1")])
    df = clean.price_by_local_hour(raw)
    assert df.columns == [schemas.LOCAL_HOUR, *schemas.PRICE_METRICS]
    assert rows_of(df, schemas.LOCAL_HOUR) == [(None, 1.0, None, None), (H0, 21.63, None, None)]


def test_local_hour_load_is_whole_numbers(spark):
    raw = raw_loads(spark, [load_record("2026-08-01 00:00", "10089.5", "1e3")])
    assert rows_of(clean.load_by_local_hour(raw)) == [(H0, 10089, None)]


def test_utc_variant_filters_and_dedups(spark):
    raw = raw_prices(
        spark,
        [
            price_record("2026-08-01 00:00", "1", utc="2026-08-01 00:00"),
            price_record("2026-08-01 00:00", "3", "  ", utc="2026-08-01 00:00"),
            price_record("2026-08-01 00:00", "2", utc="2026-08-01 00:00"),
            price_record("2026-08-01 01:00", "9", utc="bad"),
            price_record("2026-08-01 01:00", "8", utc=""),
        ],
    )
    df = clean.price_by_utc_hour(raw)
    assert df.columns == [schemas.UTC_HOUR, schemas.LOCAL_HOUR, *schemas.PRICE_METRICS]
    # Rows of no stated preference: always the same one, in whatever order they come.
    (row,) = rows_of(df)
    assert row[:2] == (H0, H0) and row[2] in (1.0, 2.0, 3.0) and row[3:] == (None, None)
    assert rows_of(clean.price_by_utc_hour(raw.orderBy("pool_price"))) == [row] == rows_of(clean.price_by_utc_hour(raw.repartition(3)))
    ranked = raw.withColumn("seq", F.col("pool_price").cast("int"))
    valid = ranked.filter("begin_datetime_utc LIKE '2026%'")
    assert rows_of(clean.price_by_utc_hour(valid, prefer=["seq"])) == [(H0, H0, 3.0, None, None)]


def test_repeated_local_hours_have_distinct_utc_hours(spark):
    raw = raw_prices(
        spark,
        [
            price_record("2026-11-01 01:30", "1", utc="2026-11-01 07:30"),
            price_record("2026-11-01 01:30", "2", utc="2026-11-01 08:30"),
        ],
    )
    assert clean.price_by_utc_hour(raw).count() == 2
    with pytest.raises(ValueError, match="duplicate keys found: .*2026-11-01 01:30"):
        clean.require_unique(clean.price_by_local_hour(raw), [schemas.LOCAL_HOUR])


def test_utc_load_is_double(spark):
    raw = raw_loads(spark, [load_record("2026-08-01 00:00", "10089.5", "abc")])
    assert rows_of(clean.load_by_utc_hour(raw)) == [(H0, H0, 10089.5, None)]


def test_keep_one_follows_preference_and_keeps_rows_whole(spark):
    df = spark.createDataFrame(
        [("a", 1, None, "x"), ("a", 3, None, "y"), ("a", 2, 7.0, "z"), ("b", 1, 1.0, None)],
        "k string, seq int, v double, t string",
    )
    got = clean.keep_one(df, ["k"], ["seq"])
    assert got.columns == df.columns
    assert rows_of(got, "k") == [("a", 3, None, "y"), ("b", 1, 1.0, None)]


def test_keep_one_treats_null_keys_as_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 5)], "k string, v int")
    assert rows_of(clean.keep_one(df, ["k"]), "k") == [(None, 2), ("a", 5)]
    assert rows_of(clean.keep_one(df.select("k"), ["k"]), "k") == [(None,), ("a",)]


def test_keep_one_matches_a_ranked_window_on_a_hot_key(spark):
    df = spark.range(30000).selectExpr("if(id % 3 = 0, 0, id div 7) AS k", "id AS seq", "id * 2 AS v")
    df.createOrReplaceTempView("hot")
    want = spark.sql(
        "SELECT k, seq, v FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY seq DESC) rn FROM hot) WHERE rn = 1"
    )
    got = clean.keep_one(df, ["k"], ["seq"])
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    plan = plan_of(got)
    assert "SortAggregate" not in plan and "Window" not in plan and plan.count("HashAggregate") == 2


def test_keep_one_with_dates_and_without_any(spark):
    rows = [("a", dt.date(2026, 1, 2), 1), ("a", dt.date(2026, 1, 3), 2), ("a", None, 3), ("b", None, 4), ("c", dt.date(1950, 1, 1), 5), ("c", None, 6)]
    df = spark.createDataFrame(rows, "k string, landed date, v int")
    assert rows_of(clean.keep_one(df, ["k"], ["landed"]).select("k", "v"), "k") == [("a", 2), ("b", 4), ("c", 5)]
    with pytest.raises(ValueError):
        clean.keep_one(df, ["v"], ["k"])


def test_the_jobs_dedup_does_not_sort(spark):
    raw = spark.createDataFrame([], schemas.PRICE_RECORD).withColumn("landing_date", F.lit(None).cast("date"))
    for prefer in ([], ["landing_date"]):
        assert "SortAggregate" not in plan_of(clean.price_by_utc_hour(raw, prefer=prefer))


def test_unique_keys_pass(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    clean.require_unique(df, ["k"])
    assert clean.duplicate_keys(df, ["k"]).isEmpty()


def test_two_null_keys_are_duplicates(spark):
    df = spark.createDataFrame([(None,), (None,)], "k int")
    assert rows_of(clean.duplicate_keys(df, ["k"])) == [(None, 2)]
