"""Loads that write their batch only give what loads that rewrite give."""

import datetime as dt
import glob
import random

import pytest
from helpers import plan_of, price_record, raw_prices, rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_store import LATER, MONTH
from test_upsert import A, B, T0, T1, T2, grid, same

from gridtide import schemas
from gridtide.operators import clean, upsert
from gridtide.plans import jobs, views
from gridtide.sources import tables

ONE_HOUR = [("2026-07-31 05:00", 77.0, None)]


def two(spark, tmp_path, series=()):
    return [tables.MarketStore(spark, str(tmp_path / name), series, deltas=name == "deltas") for name in ("deltas", "rewritten")]


def agree(stores):
    a, b = stores
    return all(same(a.read(t), b.read(t)) for t in tables.TABLES)


def test_reads_agree_before_and_after_compaction(spark, tmp_path):
    stores = two(spark, tmp_path)
    for rows, run, when in ((MONTH, "r1", T0), (LATER, "r2", T1), (ONE_HOUR, "r3", T2)):
        assert len({s.load_hourly(grid(spark, rows), run, when) for s in stores}) == 1
        assert agree(stores)
    before = rows_of(stores[0].read(tables.HOURLY), schemas.LOCAL_HOUR)
    assert stores[0].compact(tables.HOURLY) == 8 and stores[0].compact(tables.HOURLY) == 0
    assert rows_of(stores[0].read(tables.HOURLY), schemas.LOCAL_HOUR) == before and agree(stores)
    assert all(len(c) == 1 for (name, _), c in stores[0].live().items() if name == tables.HOURLY.name)
    # Old versions go, and the table still reads the same.
    assert stores[0].clean_up() > 0 and agree(stores)
    for s in stores:
        s.load_hourly(grid(spark, B), "r4", T2)
    assert agree(stores)


def test_a_batch_of_one_hour_writes_one_small_file(spark, tmp_path):
    store = tables.MarketStore(spark, str(tmp_path), deltas=True)
    store.load_hourly(grid(spark, MONTH), "r1", T0)
    store.compact(tables.HOURLY)
    assert store.load_hourly(grid(spark, ONE_HOUR), "r2", T1) == 1
    commit = max(c[-1] for c in store.live().values())
    files = glob.glob(f"{tmp_path}/raw_hourly_grid/commit={commit}/part=*/*.parquet")
    assert [f.split("/")[-2] for f in files] == ["part=2026-07-31"]
    assert spark.read.parquet(files[0]).count() == 1
    # Other days are read from the files they were in.
    other = store.read(tables.HOURLY, dt.date(2026, 7, 26), dt.date(2026, 7, 26))
    assert "Aggregate" not in plan_of(other) and "Exchange" not in plan_of(other)


def test_random_loads_and_compactions(spark, tmp_path):
    rng = random.Random(4)
    field = [T.StructField("market", T.StringType())]
    stores = two(spark, tmp_path, field)
    hours = [f"2026-0{m}-{d} {h:02d}:00" for m, d in ((7, 30), (7, 31), (8, 10)) for h in (0, 1, 23)]
    for run in range(5):
        rows = [(h, rng.choice([None, rng.randint(0, 9) / 2]), rng.choice([None, 5])) for h in rng.sample(hours, 5)]
        batch = grid(spark, rows).withColumn("market", F.explode(F.array(*[F.lit(m) for m in rng.sample(["a", "b"], rng.randint(1, 2))])))
        for s in stores:
            s.load_hourly(batch, f"r{run}", T0 + dt.timedelta(hours=run))
        if run in (1, 3):
            stores[0].compact(rng.choice([tables.HOURLY, tables.DAILY]), min_deltas=rng.randint(1, 2))
        assert agree(stores)


def test_a_store_loaded_either_way_in_turn(spark, tmp_path):
    mixed = [tables.MarketStore(spark, str(tmp_path / "m"), deltas=d) for d in (True, False)]
    plain = tables.MarketStore(spark, str(tmp_path / "p"))
    for i, rows in enumerate((A, B, ONE_HOUR, A)):
        mixed[i % 2].load_hourly(grid(spark, rows), f"r{i}", T0 + dt.timedelta(hours=i))
        plain.load_hourly(grid(spark, rows), f"r{i}", T0 + dt.timedelta(hours=i))
        assert agree([mixed[0], plain])


def test_silver_deltas(spark, tmp_path):
    stores = two(spark, tmp_path)
    for price, when in (("1", T0), ("", T1), ("3", T2)):
        raw = raw_prices(spark, [price_record("2026-08-01 00:00", price), price_record(f"2026-08-0{when.day - 3} 05:00", "9")])
        for s in stores:
            s.load_silver(tables.SILVER_PRICE, clean.price_by_utc_hour(raw), when)
        assert agree(stores)
    first = stores[0].read(tables.SILVER_PRICE).filter(F.col(schemas.UTC_HOUR) == F.lit("2026-08-01 00:00").cast("timestamp_ntz")).first()
    assert (first.created_at, first.updated_at) == (T0, T2)


@pytest.mark.parametrize("bad", [A + A[:1], A + [(None, 1.0, 1)]])
def test_a_bad_delta_publishes_nothing(spark, tmp_path, bad):
    store = tables.MarketStore(spark, str(tmp_path), deltas=True)
    store.load_hourly(grid(spark, A), "r1", T0)
    before = store.live()
    with pytest.raises(ValueError, match="violates the key"):
        store.load_hourly(grid(spark, bad), "r2", T1)
    assert store.live() == before and store.read(tables.HOURLY).count() == 2
    assert store.load_hourly(grid(spark, B).limit(0), "r3", T1) == 0 and store.live() == before
    assert store.load_hourly(grid(spark, B), "r3", T1) == 2


def test_a_compaction_that_loses_rows_publishes_nothing(spark, tmp_path, monkeypatch):
    store = tables.MarketStore(spark, str(tmp_path), deltas=True)
    store.load_hourly(grid(spark, A), "r1", T0)
    before = store.live()
    monkeypatch.setattr(upsert, "check_constraints", lambda *_args, **_kwargs: {})
    with pytest.raises(RuntimeError, match="nothing published"):
        store.compact(tables.HOURLY)
    assert store.live() == before


def test_views_over_deltas_open_one_day(spark, tmp_path):
    store = tables.MarketStore(spark, str(tmp_path), deltas=True)
    store.load_hourly(grid(spark, MONTH), "r1", T0)
    store.load_hourly(grid(spark, LATER), "r2", T1)
    views.register_store(store)
    one = spark.sql("SELECT * FROM raw_hourly_grid WHERE part = DATE '2026-07-30'")
    assert one.count() == 24
    assert "part" in plan_of(one).split("PartitionFilters: [")[1].split("]")[0]


def test_jobs_with_deltas(spark, tmp_path):
    from test_store import land

    data, root = str(tmp_path), str(tmp_path / "store")
    land(tmp_path, "2026-08-01", [price_record("2026-08-01 00:00", "5")], [])
    jobs.main(["build-grid", "--data", data, "--all"])
    for run in ("r1", "r2"):
        jobs.main(["load-grid", "--data", data, "--store", root, "--run-id", run, "--deltas"])
    store = tables.MarketStore(spark, root)
    assert store.live()[tables.HOURLY.name, dt.date(2026, 8, 1)] == (0, 1, 2)
    jobs.main(["compact", "--store", root, "--min-deltas", "2"])
    assert store.live()[tables.HOURLY.name, dt.date(2026, 8, 1)] == (3,)
    (row,) = store.read(tables.HOURLY).collect()
    assert (row.created_run_id, row.updated_run_id) == ("r1", "r2")
    for wrong in (["compact"], ["build-grid"]):
        with pytest.raises(SystemExit):
            jobs.main(wrong)


def test_the_target_date_is_yesterday():
    assert jobs.target_date(dt.datetime(2026, 8, 1, 0, 30)) == dt.date(2026, 7, 31)
