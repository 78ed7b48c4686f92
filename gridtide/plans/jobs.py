"""The batch jobs: raw reports to clean datasets, clean datasets to tables.

    python -m gridtide.plans.jobs build-grid   --data DIR [--as-of DATE | --first DATE --last DATE | --all]
    python -m gridtide.plans.jobs load-grid    --data DIR --store DIR [--deltas]
    python -m gridtide.plans.jobs build-silver --data DIR
    python -m gridtide.plans.jobs load-silver  --data DIR --store DIR [--deltas]
    python -m gridtide.plans.jobs compact      --store DIR [--first DATE --last DATE] [--min-deltas N]

``--data`` holds ``raw/`` and ``clean/``. The target date is yesterday unless
``--as-of`` names another, and the look-back ends on it. With ``--deltas`` a load
writes its batch only, and ``compact`` merges what has gathered. Each job is one step of a schedule
that lives elsewhere, and each can be repeated without changing its outcome.
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging
import uuid

from pyspark.sql import SparkSession

from gridtide import schemas
from gridtide.operators import grid
from gridtide.plans.feeds import LOAD, PRICE
from gridtide.session import build_session
from gridtide.sources import reports, tables
from gridtide.sources.datasets import read_dataset, remove, replace, write_dataset

log = logging.getLogger(__name__)


def build_grid(spark: SparkSession, data: str, first: dt.date | None = None, last: dt.date | None = None) -> int:
    """Landed price and load files to one joined hourly dataset: all of them,
    or those of the dates first..last. Fails on any local hour that a feed
    reports twice."""
    price, load = (
        feed.by_local_hour(
            reports.read_landing(spark, f"{data}/raw", feed.landing_prefix, feed.report, feed.record, first, last)
        )
        for feed in (PRICE, LOAD)
    )
    path = f"{data}/clean/{schemas.GRID_DATASET}"
    rows = write_dataset(grid.merge_feeds(price, load), f"{path}.new")
    replace(spark, f"{path}.new", path)
    log.info("joined grid: %d hours", rows)
    return rows


def load_grid(spark: SparkSession, data: str, store: str, run_id: str | None = None, as_of=None, deltas: bool = False) -> int:
    """The joined dataset into the hourly and daily tables, all or nothing."""
    run_id = run_id or str(uuid.uuid4())
    joined = read_dataset(spark, f"{data}/clean/{schemas.GRID_DATASET}")
    if joined is None:
        raise FileNotFoundError(f"no joined grid below {data}/clean; run build-grid first")
    rows = tables.MarketStore(spark, store, deltas=deltas).load_hourly(joined, run_id, as_of)
    log.info("run %s loaded %d hours", run_id, rows)
    return rows


def build_silver(spark: SparkSession, data: str) -> dict[str, int]:
    """Each window report to its clean dataset; a report that is missing or
    empty is skipped and leaves its dataset as it was."""
    done = {}
    for feed in (PRICE, LOAD):
        raw = reports.read_any_shape(spark, f"{data}/raw/{feed.window_file}", feed.report, feed.record)
        # Written beside the dataset first: an empty report must not replace it,
        # and asking beforehand would read every document twice.
        path = f"{data}/clean/{feed.dataset}"
        rows = write_dataset(feed.by_utc_hour(raw), f"{path}.new")
        if rows:
            replace(spark, f"{path}.new", path)
            done[feed.dataset] = rows
            log.info("%s: %d rows", feed.dataset, rows)
        else:
            remove(spark, f"{path}.new")
            log.warning("no records for %s", feed.report)
    return done


def load_silver(spark: SparkSession, data: str, store: str, as_of=None, deltas: bool = False) -> dict[str, int]:
    """Whatever clean datasets exist into their tables, each on its own."""
    market = tables.MarketStore(spark, store, deltas=deltas)
    done = {}
    for feed in (PRICE, LOAD):
        cleaned = read_dataset(spark, f"{data}/clean/{feed.dataset}")
        if cleaned is not None:
            done[feed.table.name] = market.load_silver(feed.table, cleaned, as_of)
            log.info("%s: %d rows", feed.table.name, done[feed.table.name])
    return done


def compact(
    spark: SparkSession, store: str, first: dt.date | None = None, last: dt.date | None = None, min_deltas: int = 1
) -> dict[str, int]:
    """Partitions of each table with at least that many deltas into plain ones."""
    market = tables.MarketStore(spark, store)
    done = {table.name: market.compact(table, first, last, min_deltas) for table in tables.TABLES}
    log.info("compacted partitions: %s", done)
    return done


def target_date(now: dt.datetime | None = None) -> dt.date:
    """Yesterday: the last day whose reports are complete."""
    return (now or dt.datetime.now(dt.timezone.utc)).date() - dt.timedelta(days=1)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="gridtide.plans.jobs")
    parser.add_argument("job", choices=["build-grid", "load-grid", "build-silver", "load-silver", "compact"])
    parser.add_argument("--data", help="folder with raw/ and clean/")
    parser.add_argument("--store")
    parser.add_argument("--run-id")
    parser.add_argument("--first", type=dt.date.fromisoformat, help="first landing date to build from, or day to compact")
    parser.add_argument("--last", type=dt.date.fromisoformat, help="last landing date to build from, or day to compact")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, help="target date: the look-back ends on it (yesterday)")
    parser.add_argument("--days-back", type=int, default=schemas.LOOKBACK_DAYS, help="length of the look-back")
    parser.add_argument("--all", action="store_true", help="build from everything that has landed")
    parser.add_argument("--deltas", action="store_true", help="write the batch only, and leave merging to reads")
    parser.add_argument("--min-deltas", type=int, default=1, help="how many deltas a partition has to have to be compacted")
    parser.add_argument("--shuffle-gb", type=int, help="size of the feeds, to size the shuffles by")
    args = parser.parse_args(argv)
    if not args.store and (args.job.startswith("load") or args.job == "compact"):
        parser.error("--store is needed to load and to compact")
    if not args.data and args.job != "compact":
        parser.error("--data is needed")
    logging.basicConfig(level=logging.INFO, format="%(asctime)s [%(levelname)s] %(message)s")
    spark = build_session(f"gridtide-{args.job}", shuffle_bytes=args.shuffle_gb and args.shuffle_gb << 30)
    if args.job == "build-grid":
        first, last = args.first, args.last
        if first is None and last is None and not args.all:
            first, last = reports.window_bounds(args.as_of or target_date(), args.days_back)
        build_grid(spark, args.data, first, last)
    elif args.job == "load-grid":
        load_grid(spark, args.data, args.store, args.run_id, deltas=args.deltas)
    elif args.job == "build-silver":
        build_silver(spark, args.data)
    elif args.job == "load-silver":
        load_silver(spark, args.data, args.store, deltas=args.deltas)
    else:
        compact(spark, args.store, args.first, args.last, args.min_deltas)


if __name__ == "__main__":
    main()
