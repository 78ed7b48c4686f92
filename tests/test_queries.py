"""Every registered query against its SQL, and the plans they run as."""

import os

import duckdb
import pytest
from helpers import plan_of

import __spark_entry__ as entry_point
from gridtide.plans.oracles import ORACLES
from gridtide.plans.queries import registered

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
WRITES = {"stored_hourly_grid", "stored_daily_agg", "delta_hourly_grid", "delta_daily_agg", "compacted_hourly_grid", "live_hourly_grid"}
QUERIES = registered()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(value):
        return repr(value + 0.0) if isinstance(value, float) else str(value)

    return sorted(tuple(text(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_oracle(spark, oracle, name):
    df = QUERIES[name](spark, SF)
    want = oracle.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    assert got == canonical(want.fetchall(), want.columns)
    assert got


def test_entry_registers_all_of_them():
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql()) and set(entry_point.oracle_sql()) <= set(entry_point.queries())


MOVED_DATES = [
    "upsert_hourly", "upsert_silver", "upsert_silver_load", "batch_dates", "incremental_daily_refresh",
    "load_verification", "stored_hourly_grid", "stored_daily_agg", "lookback_window", "landing_date_scope",
]


@pytest.fixture(scope="module")
def other_dates(spark, tmp_path_factory):
    """The tables with events of other dates too: 40 days before and after."""
    folder = tmp_path_factory.mktemp("dates")
    for table in set(TABLES) - {"events"}:
        (folder / f"{table}.parquet").symlink_to(f"{SF}/{table}.parquet")
    connection = duckdb.connect()
    connection.sql(
        f"""COPY (SELECT * REPLACE (ts + to_days(CAST(d AS INTEGER)) AS ts, event_id * 3 + i AS event_id)
        FROM '{SF}/events.parquet', (VALUES (-40, 0), (0, 1), (40, 2)) AS moved(d, i)) TO '{folder}/events.parquet'"""
    )
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return str(folder), connection


@pytest.mark.parametrize("name", MOVED_DATES)
def test_events_of_any_date_count(spark, other_dates, name):
    folder, connection = other_dates
    df, want = QUERIES[name](spark, folder), connection.sql(ORACLES[name])
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(want.fetchall(), want.columns)


def test_refresh_drops_other_dates_before_it_aggregates(spark):
    from gridtide.operators import refresh
    from gridtide.plans import driver_tables as dtab

    hours = dtab.table(spark, SF, "events").select(
        dtab.hour_of().alias("begin_datetime_mpt"), dtab._money(dtab.F.col("value")).alias("pool_price"),
        dtab.F.lit(1).alias("alberta_internal_load"),
    )
    plan = plan_of(refresh.affected_days(hours, hours.limit(5))).splitlines()
    depth = {word: next(i for i, line in enumerate(plan) if word in line) for word in ("LeftSemi", "HashAggregate")}
    assert depth["HashAggregate"] < depth["LeftSemi"]


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["grid_date", "net_daily_profit", "total_profit_acc"] and not df.isEmpty()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in WRITES])
def test_plan_stays_distributed_and_in_the_jvm(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "SortAggregate", "InMemoryTable"):
        assert operator not in plan


def scans(spark, name):
    return [line for line in plan_of(QUERIES[name](spark, SF)).splitlines() if "FileScan" in line]


def columns_read(line):
    return {c.split(":")[0] for c in line.split("ReadSchema: struct<")[1].rstrip(">").split(",")}


def test_scans_read_only_the_columns_in_use(spark):
    (line,) = scans(spark, "running_profit")
    assert columns_read(line) == {"ts", "event_type", "value"}
    (line,) = scans(spark, "arb_loss_on_charge_orders")
    assert columns_read(line) == {"o_orderdate", "o_totalprice"}


def test_filters_reach_the_scan(spark):
    (line,) = scans(spark, "lookback_window")
    assert "EqualTo(event_type,purchase)" in line
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00" in line and "LessThan(ts,2024-01-31T00:00" in line


def test_join_of_aggregates_adds_no_shuffle(spark):
    plan = plan_of(QUERIES["hourly_grid_full_outer"](spark, SF))
    # Two for the feeds and one for counting distinct users; none for the join.
    assert plan.count("Exchange hashpartitioning") == 3


def test_refresh_computes_the_stored_grid_once(spark):
    df = QUERIES["incremental_daily_refresh"](spark, SF)
    df.collect()
    assert "ReusedExchange" in plan_of(df)
