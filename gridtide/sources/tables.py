"""Keyed tables on shared storage that several jobs load into.

Each table is a set of date partitions in Parquet. A load writes into folders
of its own; what is live is decided by a small log of commits. Adding one file
to that log publishes everything a load wrote, over several tables, at once. A
load that fails before it leaves the tables as they were.

    <root>/<table>/commit=<n>/part=<date>/*.parquet
    <root>/commits/*.parquet             (commit, table, part, delta)

There are two ways to load, with the same results. A load *with rewriting*
reads the partitions its batch touches and writes them anew. A load *by deltas*
(``MarketStore(..., deltas=True)``) writes the rows of the batch only, and reads
merge them: for each key the newest version of every column that follows the
batch, the oldest of those that stay with whoever brought the key first. All
versions of a key meet in one aggregate, without a join and with one shuffle;
partitions without deltas are read as they are. ``compact`` turns partitions
with many deltas into plain ones.

What reaches the driver from the log is a row per table and partition, bounded
by the calendar, and the commits of deltas not compacted yet. One load at a
time may run on a root: each claims the next commit number
(``gridtide.sources.claims``), and a second one that wants it fails.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide import schemas
from gridtide.operators import refresh, upsert
from gridtide.sources import reports
from gridtide.sources.claims import SETTLE_SECONDS, Claims, HadoopFiles
from gridtide.sources.datasets import matching, path_exists, remove, write_dataset


@dataclass(frozen=True)
class Table:
    """``part`` derives a row's partition from its key, so a key can only ever
    be in one partition. ``monthly`` partitions start at the month's first.
    ``keep`` columns stay with the first version of a key, others follow the
    newest."""

    name: str
    layout: T.StructType
    key: str
    monthly: bool = False
    keep: tuple[str, ...] = ()

    def part(self) -> Column:
        return F.trunc(self.key, "month") if self.monthly else F.to_date(self.key)

    def part_of(self, day: dt.date) -> dt.date:
        return day.replace(day=1) if self.monthly else day


HOURLY = Table("raw_hourly_grid", schemas.HOURLY_GRID, schemas.LOCAL_HOUR, keep=("ingested_at", "source_run_id", "created_run_id"))
DAILY = Table("daily_grid_agg", schemas.DAILY_GRID, "grid_date", monthly=True)
SILVER_PRICE = Table("silver_pool_price", schemas.SILVER_PRICE, schemas.UTC_HOUR, keep=("created_at",))
SILVER_LOAD = Table("silver_actual_forecast_load", schemas.SILVER_LOAD, schemas.UTC_HOUR, keep=("created_at",))



def landed(table: Table) -> Table:
    """Which landing date each key of a table was last written from."""
    fields = [table.layout[table.key], T.StructField(reports.LANDED_ON, T.DateType())]
    return Table(f"{table.name}_landed", T.StructType(fields), table.key)


TABLES = (HOURLY, DAILY, SILVER_PRICE, SILVER_LOAD, landed(SILVER_PRICE), landed(SILVER_LOAD))

PART = T.StructField("part", T.DateType())
VERSION = T.StructField("commit", T.LongType())
DELTA = T.StructField("delta", T.BooleanType())
COMMIT = T.StructType([VERSION, T.StructField("table", T.StringType()), PART, DELTA])

# The commits that hold each live partition, by table and partition: the one
# with all its rows (0 if there is none), then those of later deltas.
Live = dict[tuple[str, dt.date], tuple[int, ...]]


class MarketStore:
    """The hourly grid, its daily aggregate and the two silver tables.

    ``series`` are leading key columns (with their types) for stores that hold
    several markets or zones. ``deltas`` says how to load; a store can be loaded
    either way in turn. ``settle`` seconds pass before a claim counts on file
    systems that do not create files atomically.
    """

    def __init__(
        self, spark: SparkSession, root: str, series: Sequence[T.StructField] = (), deltas: bool = False, settle: float = SETTLE_SECONDS
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.series_fields = list(series)
        self.series = [f.name for f in series]
        self.deltas = deltas
        self.claims = Claims(HadoopFiles(spark, self.root), f"{self.root}/commits", settle)

    def layout(self, table: Table) -> T.StructType:
        return T.StructType([*self.series_fields, *table.layout.fields])

    def keys(self, table: Table) -> list[str]:
        return [*self.series, table.key]

    # -- reading ---------------------------------------------------------

    def live(self) -> Live:
        path = f"{self.root}/commits"
        if not path_exists(self.spark, path):
            return {}
        log = self.spark.read.schema(COMMIT).parquet(path)
        # Logs from before there were deltas have no such column.
        is_delta = F.coalesce("delta", F.lit(False))
        newest = log.groupBy("table", "part").agg(
            F.coalesce(F.max(F.when(~is_delta, F.col("commit"))), F.lit(0)).alias("base"),
            F.collect_set(F.when(is_delta, F.col("commit"))).alias("deltas"),
        )
        later = F.sort_array(F.filter("deltas", lambda c: c > F.col("base")))
        rows = newest.select("table", "part", "base", later.alias("deltas")).collect()
        return {(r["table"], r["part"]): (r["base"], *r["deltas"]) for r in rows}

    def read(
        self, table: Table, first: dt.date | None = None, last: dt.date | None = None, with_part: bool = False
    ) -> DataFrame:
        """The live rows, or those of the days first..last. Only the folders of
        the partitions concerned are listed and read. ``with_part`` adds the
        partition date as ``part``: a filter on it opens only its files."""
        low = dt.date.min if first is None else table.part_of(first)
        high = dt.date.max if last is None else last
        live = self.live()
        df = self._read(table, live, [part for name, part in live if name == table.name and low <= part <= high], with_part)
        if table.monthly and first is not None:
            df = df.filter(F.col(table.key) >= F.lit(first))
        if table.monthly and last is not None:
            df = df.filter(F.col(table.key) <= F.lit(last))
        return df

    def _folder(self, table: Table, commit: int) -> str:
        return f"{self.root}/{table.name}/commit={commit}"

    def _folders(self, table: Table, commits: dict[dt.date, Iterable[int]]) -> DataFrame:
        """The rows of some commits of some partitions, with partition and commit."""
        layout = T.StructType([*self.layout(table).fields, VERSION, PART])
        folders = [f"{self._folder(table, c)}/part={part}" for part in sorted(commits) for c in commits[part] if c]
        reader = self.spark.read.schema(layout).option("basePath", f"{self.root}/{table.name}")
        return reader.parquet(*folders).select(*layout.names)

    def _merged(self, table: Table, versions: DataFrame) -> DataFrame:
        """The row each key has after all its versions."""
        keys = [PART.name, *self.keys(table)]
        rest = [c for c in self.layout(table).names if c not in keys]
        follow = [c for c in rest if c not in table.keep]
        newest = F.max_by(F.struct(*follow), VERSION.name).alias("_newest")
        oldest = [F.min_by(F.struct(*table.keep), VERSION.name).alias("_oldest")] if table.keep else []
        merged = versions.groupBy(*keys).agg(newest, *oldest)
        values = [F.col(f"{'_oldest' if c in table.keep else '_newest'}.{c}").alias(c) for c in rest]
        return merged.select(*keys, *values).select(*self.layout(table).names, PART.name)

    def _read(self, table: Table, live: Live, parts: Iterable[dt.date], with_part: bool = False) -> DataFrame:
        layout = self.layout(table)
        if with_part:
            layout = T.StructType([*layout.fields, PART])
        held = {p: live[table.name, p] for p in parts if (table.name, p) in live}
        plain = {p: commits for p, commits in held.items() if len(commits) == 1}
        frames = []
        if plain and with_part:
            frames.append(self._folders(table, plain))
        elif plain:
            # Without the partition in it a plan does not depend on the folders' names.
            frames.append(self.spark.read.schema(layout).parquet(*[f"{self._folder(table, c[0])}/part={p}" for p, c in sorted(plain.items())]))
        if len(plain) < len(held):
            frames.append(self._merged(table, self._folders(table, {p: c for p, c in held.items() if p not in plain})))
        if not frames:
            return self.spark.createDataFrame([], layout)
        rows = frames[0].select(*layout.names)
        return rows.unionByName(frames[1].select(*layout.names)) if len(frames) > 1 else rows

    # -- writing ---------------------------------------------------------

    def _claim(self, live: Live) -> tuple[int, str]:
        """The number of this load's commit, and the token it is claimed with.
        A load that runs beside another one, or after one that was killed,
        fails here."""
        after = max((c[-1] for c in live.values()), default=0)
        claim = self.claims.take(after)
        if claim is None:
            raise RuntimeError(f"commit {after + 1} of {self.root} is claimed by another load; see MarketStore.clean_up")
        return claim

    def _write(self, table: Table, commit: int, rows: DataFrame) -> tuple[DataFrame, int]:
        """Write the partitions of a commit; return them as they can be read
        back, and how many rows went in."""
        folder = self._folder(table, commit)
        n = write_dataset(rows.withColumn(PART.name, table.part()), folder, partition_by=PART.name, sort_by=self.keys(table))
        return self.spark.read.schema(T.StructType([*self.layout(table).fields, PART])).parquet(folder), n

    def _touched(self, table: Table, batch: DataFrame) -> set[dt.date]:
        """The partitions a batch has rows for: dates only, bounded by the
        calendar. Rows without a key have none and fail the check later."""
        return {r[0] for r in batch.select(table.part()).distinct().collect()}

    def _publish(self, commit: int, token: str, parts: dict[str, set[dt.date]], delta: bool) -> None:
        if not self.claims.holds(commit, token):
            raise RuntimeError(f"commit {commit} of {self.root} went to another load; nothing published")
        rows = [(commit, name, part, delta) for name, touched in parts.items() for part in sorted(touched)]
        log = self.spark.createDataFrame(rows, COMMIT).coalesce(1)
        log.write.mode("append").parquet(f"{self.root}/commits")

    def _load(self, table: Table, batch: DataFrame, merge, required: Sequence[str], then, run_id: str | None = None) -> int:
        """Write a batch, check what was written, publish it with whatever
        ``then`` writes besides. With rewriting the batch is worked out twice:
        for its dates, and where it is merged, which also counts it. By deltas
        it is worked out once: what was written has its dates. With ``run_id``
        as many rows must have been written by that run as the batch had."""
        touched = None if self.deltas else self._touched(table, batch)
        if touched is not None and not touched:
            return 0
        live = self.live()
        commit, token = self._claim(live)
        try:
            if self.deltas:
                written, expected = self._write(table, commit, batch)
            else:
                seen = Observation()
                counted = batch.observe(seen, F.count("*").alias("n_rows"))
                written, _ = self._write(table, commit, merge(self._read(table, live, touched - {None}), counted))
                expected = seen.get["n_rows"]
            own = None if run_id is None else F.col("updated_run_id") == run_id
            by_part = upsert.check_constraints(written, self.keys(table), required, table.part(), own) if expected else {}
            if not by_part:
                self.claims.give_up(commit, token)
                return 0
            loaded = expected if own is None else sum(counts["counted"] for counts in by_part.values())
            if loaded != expected:
                raise RuntimeError(f"expected {expected} rows from run {run_id}, found {loaded}; nothing published")
            touched = set(by_part)
            parts = {table.name: touched, **then(commit, live, written, touched)}
            self._publish(commit, token, parts, self.deltas)
        except BaseException:
            self.claims.give_up(commit, token)
            raise
        return expected

    def load_hourly(self, grid: DataFrame, run_id: str | None = None, as_of=None) -> int:
        """Upsert a joined grid, refresh the days it touches, verify, publish
        both tables together. Returns the number of hours loaded. All rows of a
        load carry one time: ``as_of``, or now, in UTC."""
        run_id = run_id or str(uuid.uuid4())
        as_of = as_of or dt.datetime.now(dt.timezone.utc)

        def daily(commit: int, live: Live, hourly: DataFrame, touched: set[dt.date]) -> dict:
            # Rewritten partitions are whole days, so they are all a refresh
            # needs. Deltas are not: their days are read with them merged in.
            if self.deltas:
                ahead = {(HOURLY.name, d): (*live.get((HOURLY.name, d), (0,)), commit) for d in touched}
                hourly = self._read(HOURLY, ahead, touched)
            months = {DAILY.part_of(day) for day in touched}
            rest = [c for c in DAILY.layout.names if c != DAILY.key]
            days = refresh.daily_rows(hourly, as_of, self.series)
            if not self.deltas:
                days = upsert.upsert(self._read(DAILY, live, months), days, self.keys(DAILY), rest)
            self._write(DAILY, commit, days)
            return {DAILY.name: months}

        batch = upsert.hourly_batch(grid, run_id, as_of, self.series)
        return self._load(HOURLY, batch, lambda old, new: upsert.upsert_hourly(old, new, self.series), (), daily, run_id)

    def load_silver(self, table: Table, clean: DataFrame, as_of=None) -> int:
        """Upsert one cleaned feed into its silver table and publish it.
        Returns the number of rows in the batch."""
        batch = upsert.silver_batch(clean, table.layout, as_of or dt.datetime.now(dt.timezone.utc), self.series)
        merge = lambda old, new: upsert.upsert_silver(old, new, table.layout, self.series)
        return self._load(table, batch, merge, [schemas.LOCAL_HOUR], lambda *_: {})

    def load_landed(self, table: Table, clean: DataFrame, as_of=None) -> int:
        """``load_silver`` for rows that say which landing date they are from.
        Rows of a key that was written from a later date are left out; the
        dates are published in the same commit, and only those of the batch's
        own days are read. Returns the number of rows loaded."""
        dates, before = landed(table), self.live()
        touched = self._touched(dates, clean)
        last = self._read(dates, before, touched - {None})
        fresh = upsert.not_older(clean, last, self.keys(table), reports.LANDED_ON)
        marks = fresh.select(*self.keys(table), reports.LANDED_ON)

        def with_dates(commit: int, live: Live, _written: DataFrame, days: set[dt.date]) -> dict:
            if live != before:
                raise RuntimeError(f"another load published to {self.root} meanwhile; nothing published")
            rows = marks if self.deltas else upsert.upsert(self._read(dates, live, days), marks, self.keys(table), [reports.LANDED_ON])
            self._write(dates, commit, rows)
            return {dates.name: days}

        batch = upsert.silver_batch(fresh.drop(reports.LANDED_ON), table.layout, as_of or dt.datetime.now(dt.timezone.utc), self.series)
        merge = lambda old, new: upsert.upsert_silver(old, new, table.layout, self.series)
        return self._load(table, batch, merge, [schemas.LOCAL_HOUR], with_dates)

    def compact(self, table: Table, first: dt.date | None = None, last: dt.date | None = None, min_deltas: int = 1) -> int:
        """Write partitions that have at least ``min_deltas`` deltas as plain
        ones, of the days first..last if given. Returns their number. What the
        table reads as does not change. It is a load like any other: nothing is
        published unless every row came through, and it claims a commit."""
        live = self.live()
        low = dt.date.min if first is None else table.part_of(first)
        high = dt.date.max if last is None else last
        due = {p for (name, p), c in live.items() if name == table.name and low <= p <= high and len(c) > min_deltas}
        if not due:
            return 0
        commit, token = self._claim(live)
        try:
            written, expected = self._write(table, commit, self._read(table, live, due))
            by_part = upsert.check_constraints(written, self.keys(table), (), by=table.part())
            if sum(counts["n_rows"] for counts in by_part.values()) != expected or set(by_part) != due:
                raise RuntimeError(f"expected {expected} rows of {len(due)} partitions, found {by_part}; nothing published")
            self._publish(commit, token, {table.name: due}, False)
        except BaseException:
            self.claims.give_up(commit, token)
            raise
        return len(due)

    def clean_up(self) -> int:
        """Remove the partition folders no commit refers to any more, and the
        claims of loads that were killed. Returns the number of folders. Run it
        when no load runs and nobody reads an older state."""
        live = self.live()
        removed = 0
        for table in TABLES:
            used = {(c, str(part)) for (name, part), commits in live.items() if name == table.name for c in commits}
            for path in matching(self.spark, f"{self.root}/{table.name}/commit=*/part=*"):
                commit, part = path.rstrip("/").split("/")[-2:]
                if (int(commit.removeprefix("commit=")), part.removeprefix("part=")) not in used:
                    remove(self.spark, path)
                    removed += 1
        for path in matching(self.spark, f"{self.root}/commits/_claim-*"):
            remove(self.spark, path)
        return removed
