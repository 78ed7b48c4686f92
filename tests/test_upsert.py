import datetime as dt
from decimal import Decimal

import pytest
from helpers import hourly, rows_of
from pyspark.sql import functions as F

from gridtide import schemas
from gridtide.operators import refresh, upsert

D = Decimal
T0, T1, T2 = (dt.datetime(2026, 8, d, 2) for d in (5, 6, 7))
H = [dt.datetime(2026, 8, 1, h) for h in range(24)]


def grid(spark, rows):
    """Rows of (hour text, price, load) as a joined grid."""
    return hourly(spark, rows).withColumns(
        {
            "forecast_pool_price": F.col("pool_price") + 1,
            "rolling_30day_avg": F.lit(30.0),
            "forecast_alberta_internal_load": F.col("alberta_internal_load") + 1,
        }
    )


def batch(spark, rows, run, as_of):
    return upsert.hourly_batch(grid(spark, rows), run, as_of)


A = [("2026-08-01 00:00", 10.0, 100), ("2026-08-01 01:00", 20.0, 200)]
B = [("2026-08-01 01:00", None, 250), ("2026-08-01 02:00", 30.0, 300)]


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_layout(spark):
    df = batch(spark, A, "r1", T0)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schemas.HOURLY_GRID]


def test_hourly_column_rules(spark):
    merged = upsert.upsert_hourly(batch(spark, A, "r1", T0), batch(spark, B, "r2", T1))
    assert merged.columns == schemas.HOURLY_GRID.names
    got = {r[0]: tuple(r) for r in merged.collect()}
    assert got[H[0]] == (H[0], D(10), D(11), D(30), 100, 101, T0, "r1", "r1", "r1")
    # The later NULL replaces the stored price; origin and arrival stay.
    assert got[H[1]] == (H[1], None, None, D(30), 250, 251, T0, "r1", "r1", "r2")
    assert got[H[2]] == (H[2], D(30), D(31), D(30), 300, 301, T1, "r2", "r2", "r2")


def test_upsert_into_nothing(spark):
    empty = spark.createDataFrame([], schemas.HOURLY_GRID)
    first = batch(spark, A, "r1", T0)
    assert same(upsert.upsert_hourly(empty, first), first)
    assert same(upsert.upsert_hourly(first, empty), first)


def test_upsert_is_idempotent(spark):
    t, b = batch(spark, A, "r1", T0), batch(spark, B, "r2", T1)
    once = upsert.upsert_hourly(t, b)
    assert same(upsert.upsert_hourly(once, b), once)
    again = upsert.upsert_hourly(once, batch(spark, B, "r3", T2))
    assert same(again.drop("updated_run_id"), once.drop("updated_run_id"))


def test_silver_column_rules(spark):
    layout = schemas.SILVER_PRICE

    def rows(price, local, as_of):
        df = spark.createDataFrame(
            [("2026-08-01 06:00", local, price, 1.005, None)],
            "u string, l string, pool_price double, forecast_pool_price double, rolling_30day_avg double",
        )
        clean = df.select(
            F.col("u").cast("timestamp_ntz").alias(schemas.UTC_HOUR),
            F.col("l").cast("timestamp_ntz").alias(schemas.LOCAL_HOUR),
            *schemas.PRICE_METRICS,
        )
        return upsert.silver_batch(clean, layout, as_of)

    old, new = rows(21.635, "2026-08-01 00:00", T0), rows(None, "2026-08-01 01:00", T1)
    assert old.first()[2:] == (D("21.64"), D("1.01"), None, T0, T0)
    (row,) = upsert.upsert_silver(old, new, layout).collect()
    assert tuple(row) == (dt.datetime(2026, 8, 1, 6), H[1], None, D("1.01"), None, T0, T1)


def test_constraints(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", None), (None, 3), (None, None), ("c", 4)], "k string, v int"
    )
    assert tuple(upsert.constraint_report(df, ["k"], ["v"]).first()) == (6, 3, 2, 1, 2)
    assert tuple(upsert.constraint_report(df.limit(0), ["k"], ["v"]).first()) == (0, 0, 0, 0, 0)


@pytest.mark.parametrize("rows, fault", [(A + A[:1], "repeated_keys"), (A + [(None, 1.0, 1)], "null_key_rows")])
def test_bad_batches_are_refused(spark, rows, fault):
    with pytest.raises(ValueError, match=fault):
        upsert.check_constraints(batch(spark, rows, "r", T0), [schemas.LOCAL_HOUR], [], F.to_date(schemas.LOCAL_HOUR))


def test_load_verification(spark):
    t, b = batch(spark, A, "r1", T0), batch(spark, B, "r2", T1)
    merged = upsert.upsert_hourly(t, b)
    assert tuple(upsert.load_verification(merged, b, "r2").first()) == (2, 2, True)
    assert tuple(upsert.load_verification(t, b, "r2").first()) == (0, 2, False)


def test_refresh_touches_only_the_batch_days(spark):
    base = batch(spark, [(f"2026-08-0{d} {h:02d}:00", d * 10.0 + h, d) for d in (1, 2, 3) for h in range(4)], "r1", T0)
    later = batch(spark, [("2026-08-02 01:00", 99.0, 5), ("2026-08-04 00:00", 1.0, 1)], "r2", T1)
    merged = upsert.upsert_hourly(base, later)
    got = refresh.refresh(refresh.daily_rows(base, T0), merged, later, T1)
    assert got.columns == schemas.DAILY_GRID.names
    assert {r.grid_date.day: r.computed_at for r in got.collect()} == {1: T0, 2: T1, 3: T0, 4: T1}
    full = refresh.daily_rows(merged, T1)
    assert same(got.drop("computed_at"), full.drop("computed_at"))
    # The second day counts hours the batch did not bring as well.
    assert got.filter("day(grid_date) = 2").first().hours_reported == 4


def test_batch_dates(spark):
    df = hourly(spark, [("2026-08-01 00:00", 1.0, 1), ("2026-08-01 05:00", 1.0, 1), (None, 1.0, 1)])
    assert rows_of(refresh.batch_dates(df)) == [(dt.date(2026, 8, 1),)]


def test_series_are_part_of_the_key(spark):
    def both(rows, run, as_of):
        g = grid(spark, rows)
        two = g.withColumn("market", F.lit("a")).unionByName(g.withColumn("market", F.lit("b")))
        return upsert.hourly_batch(two, run, as_of, ["market"])

    merged = upsert.upsert_hourly(both(A, "r1", T0), both(B, "r2", T1).filter("market = 'b'"), ["market"])
    assert merged.columns == ["market", *schemas.HOURLY_GRID.names]
    assert {r.market: r["n"] for r in merged.groupBy("market").agg(F.count("*").alias("n")).collect()} == {"a": 2, "b": 3}
