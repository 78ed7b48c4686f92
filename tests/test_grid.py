import datetime as dt

import pytest
from helpers import LOADS, PRICES, load_record, plan_of, price_record, raw_loads, raw_prices, rows_of

from gridtide import schemas
from gridtide.operators import clean, grid

H0, H1 = dt.datetime(2026, 8, 1), dt.datetime(2026, 8, 1, 1)


def feeds(spark, prices, loads):
    return clean.price_by_local_hour(raw_prices(spark, prices)), clean.load_by_local_hour(raw_loads(spark, loads))


def test_matching_hours(spark):
    df = grid.merge_feeds(*feeds(spark, PRICES, LOADS))
    assert "begin_datetime_utc" not in df.columns
    assert dict(df.dtypes)["pool_price"] == "double" and dict(df.dtypes)["alberta_internal_load"] == "int"
    assert rows_of(df, schemas.LOCAL_HOUR) == [
        (H0, 21.63, 23.35, 31.99, 10089, 10100),
        (H1, 18.87, 22.10, 32.00, 9950, 9980),
    ]


@pytest.mark.parametrize("how, hours", [("full_outer", [H0, H1]), ("inner", [H0]), ("left", [H0, H1]), ("right", [H0])])
def test_an_hour_one_feed_lacks(spark, how, hours):
    price, load = feeds(spark, PRICES, LOADS[:1])
    merged = grid.merge_feeds(price, load, how=how)
    assert [r[0] for r in rows_of(merged, schemas.LOCAL_HOUR)] == hours
    joined = grid.join_feeds(price, load, how=how)
    assert rows_of(merged, schemas.LOCAL_HOUR) == rows_of(joined, schemas.LOCAL_HOUR)


def test_unmatched_hour_has_null_load(spark):
    df = grid.merge_feeds(*feeds(spark, PRICES, LOADS[:1]))
    assert rows_of(df, schemas.LOCAL_HOUR)[1] == (H1, 18.87, 22.10, 32.00, None, None)


def test_size_of_the_full_outer_join(spark):
    prices = [price_record(f"2026-08-{d:02d} {h:02d}:00", "1") for d in range(1, 9) for h in range(24)]
    loads = [load_record(f"2026-08-{d:02d} {h:02d}:00", "1") for d in range(5, 14) for h in range(24)]
    price, load = feeds(spark, prices, loads)
    both = grid.merge_feeds(price, load, how="inner").count()
    assert grid.merge_feeds(price, load).count() == len(prices) + len(loads) - both


@pytest.mark.parametrize("side", [0, 1])
def test_duplicate_hour_fails_even_if_no_column_of_it_is_used(spark, side):
    prices, loads = (PRICES + PRICES[:1], LOADS) if side == 0 else (PRICES, LOADS + LOADS[:1])
    with pytest.raises(Exception, match="duplicate timestamps found at 2026-08-01 00:00:00"):
        grid.merge_feeds(*feeds(spark, prices, loads)).count()


def test_null_keys(spark):
    lone = [price_record("bad", "5")]
    df = grid.merge_feeds(*feeds(spark, PRICES + lone, LOADS))
    assert rows_of(df, schemas.LOCAL_HOUR)[0] == (None, 5.0, None, None, None, None)
    with pytest.raises(Exception, match="duplicate timestamps found at null"):
        grid.merge_feeds(*feeds(spark, PRICES + lone, LOADS + [load_record("bad", "5")])).count()
    inner = grid.merge_feeds(*feeds(spark, PRICES + lone, LOADS + [load_record("bad", "5")]), how="inner")
    assert inner.count() == 2


def test_merge_is_one_aggregate_without_a_join(spark):
    plan = plan_of(grid.merge_feeds(*feeds(spark, PRICES, LOADS)))
    assert "Join" not in plan and "SortAggregate" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_shared_columns_and_unknown_kinds_are_refused(spark):
    price, _ = feeds(spark, PRICES, LOADS)
    with pytest.raises(ValueError, match="both feeds carry"):
        grid.merge_feeds(price, price)
    with pytest.raises(ValueError, match="how must be"):
        grid.merge_feeds(price, price, how="cross")


def test_forecast_errors(spark):
    price = clean.price_by_utc_hour(raw_prices(spark, PRICES))
    load = clean.load_by_utc_hour(raw_loads(spark, LOADS[:1]))
    (row,) = grid.forecast_errors(price, load).collect()
    assert round(row.price_forecast_error, 2) == -1.72 and row.load_forecast_error == -11.0
    assert row.begin_datetime_mpt == H0 and row.begin_datetime_utc == dt.datetime(2026, 8, 1, 6)


def correlation(spark, pairs):
    df = spark.createDataFrame(pairs, "pool_price double, alberta_internal_load double")
    return grid.demand_price_correlation(df).first()[0]


def test_correlation(spark):
    assert correlation(spark, [(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)]) == pytest.approx(1.0)
    assert correlation(spark, [(1.0, 6.0), (2.0, 4.0), (3.0, 2.0), (None, 99.0), (99.0, None)]) == pytest.approx(-1.0)


@pytest.mark.parametrize("pairs", [[(1.0, 2.0), (1.0, 3.0)], [(1.0, 2.0)], [(None, 1.0)], [(1.0, 2.0), (None, 3.0), (1.0, 5.0)]])
def test_correlation_without_variance_is_null(spark, pairs):
    assert correlation(spark, pairs) is None


def test_correlation_agrees_with_the_built_in(spark):
    df = spark.range(5000).selectExpr("sin(id) * 100 AS pool_price", "cos(id * 0.3) + id % 7 AS alberta_internal_load")
    want = df.selectExpr("corr(pool_price, alberta_internal_load)").first()[0]
    assert grid.demand_price_correlation(df).first()[0] == pytest.approx(want, abs=1e-12)
