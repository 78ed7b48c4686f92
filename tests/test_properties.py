"""Drawn inputs against the same rules spelled out over plain dictionaries."""

import datetime as dt
from decimal import Decimal

from helpers import hourly
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridtide import schemas
from gridtide.operators import clean, daily, grid, refresh, upsert

START = dt.datetime(2026, 3, 7)
T0, T1 = dt.datetime(2026, 5, 1), dt.datetime(2026, 5, 2)
CHECKED = settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

hours = st.integers(0, 96)
price = st.none() | st.integers(-99999, 150000).map(lambda cents: cents / 100)
load = st.none() | st.integers(0, 12000)
table = st.dictionaries(hours, st.tuples(price, load), min_size=1, max_size=60)


def at(hour):
    return START + dt.timedelta(hours=hour)


def frame(spark, rows):
    return hourly(spark, [(at(h).isoformat(" "), p, n) for h, (p, n) in rows.items()])


def batch(spark, rows, run, as_of):
    full = frame(spark, rows).withColumns({c: F.lit(None).cast("double") for c in schemas.PRICE_METRICS[1:]})
    full = full.withColumn(schemas.LOAD_METRICS[1], F.lit(None).cast("int"))
    return upsert.hourly_batch(full, run, as_of)


def cents(value):
    return None if value is None else Decimal(str(value))


@CHECKED
@given(table, table)
def test_full_outer_merge(spark, left, right):
    prices = frame(spark, left).select(schemas.LOCAL_HOUR, "pool_price")
    loads = frame(spark, right).select(schemas.LOCAL_HOUR, "alberta_internal_load")
    want = {(at(h), left.get(h, (None, None))[0], right.get(h, (None, None))[1]) for h in left.keys() | right.keys()}
    assert {tuple(r) for r in grid.merge_feeds(prices, loads).collect()} == want
    assert {tuple(r) for r in grid.join_feeds(prices, loads).collect()} == want
    inner = grid.merge_feeds(prices, loads, how="inner")
    assert {r[0] for r in inner.collect()} == {at(h) for h in left.keys() & right.keys()}


@CHECKED
@given(table, table)
def test_upsert_and_refresh(spark, stored, later):
    old, new = batch(spark, stored, "r1", T0), batch(spark, later, "r2", T1)
    merged = upsert.upsert_hourly(old, new)
    got = {r.begin_datetime_mpt: r for r in merged.collect()}
    assert got.keys() == {at(h) for h in stored.keys() | later.keys()}
    for h in stored.keys() | later.keys():
        row, (p, n) = got[at(h)], later.get(h) or stored[h]
        assert (row.pool_price, row.alberta_internal_load) == (cents(p), n)
        assert row.created_run_id == row.source_run_id == ("r1" if h in stored else "r2")
        assert row.updated_run_id == ("r2" if h in later else "r1")
        assert row.ingested_at == (T0 if h in stored else T1)
    again = upsert.upsert_hourly(merged, new)
    assert again.exceptAll(merged).isEmpty() and merged.exceptAll(again).isEmpty()
    days = refresh.refresh(refresh.daily_rows(old, T0), merged, new, T1)
    full = daily.daily_aggregate(merged, computed_at=T1)
    assert days.drop("computed_at").exceptAll(full.drop("computed_at")).isEmpty() and days.count() == full.count()
    touched = {at(h).date() for h in later}
    assert {r.grid_date for r in days.filter(F.col("computed_at") == F.lit(str(T1)).cast("timestamp_ntz")).collect()} == touched


@CHECKED
@given(table)
def test_daily_figures(spark, rows):
    got = {r.grid_date: r for r in daily.daily_aggregate(frame(spark, rows)).collect()}
    days = {}
    for h, (p, n) in rows.items():
        days.setdefault(at(h).date(), []).append((cents(p), n))
    assert got.keys() == days.keys()

    def mean(values):
        if not values:
            return None
        return (sum(map(Decimal, values)) / len(values)).quantize(Decimal("0.01"), rounding="ROUND_HALF_UP")

    for day, hours_of in days.items():
        prices = [p for p, _ in hours_of if p is not None]
        row = got[day]
        assert row.hours_reported == len(hours_of)
        assert (row.min_price, row.max_price) == (min(prices, default=None), max(prices, default=None))
        assert row.avg_price == mean(prices)
        assert row.avg_load == mean([n for _, n in hours_of if n is not None])


@CHECKED
@given(st.lists(st.tuples(st.integers(0, 5) | st.none(), st.integers(-9, 9) | st.none()), min_size=1, max_size=40))
def test_dedup_and_duplicates(spark, rows):
    df = spark.createDataFrame(rows, "k int, v int")
    by_key = {}
    for k, v in rows:
        by_key.setdefault(k, []).append(v)
    greatest = {k: max((v for v in vs if v is not None), default=None) for k, vs in by_key.items()}
    assert {r.k: r.v for r in clean.keep_one(df, ["k"]).collect()} == greatest
    assert {r.k: r.n_rows for r in clean.duplicate_keys(df, ["k"]).collect()} == {
        k: len(vs) for k, vs in by_key.items() if len(vs) > 1
    }
