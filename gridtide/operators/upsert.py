"""Keyed upsert, and the checks that guard it.

``upsert`` is a pure function of two frames. Which part of a stored table it
has to see is the caller's business: see ``gridtide.sources.tables``, which
hands it only the partitions a batch touches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide import schemas
from gridtide.functions import casting


def upsert(
    current: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    replace: Sequence[str],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows of ``current`` with those of ``batch`` merged in by key.

    ``replace`` columns take the batch's value wherever the key is in the
    batch, NULL included. ``keep`` columns take it only for new keys. Keys must
    be unique on both sides (see ``check_constraints``), so the join is one to
    one and no key can be hot.
    """
    keys, columns = list(keys), [*keys, *replace, *keep]
    old = current.select(*columns).withColumn("_old", F.lit(True)).alias("old")
    new = batch.select(*columns).withColumn("_new", F.lit(True)).alias("new")
    joined = old.join(new, keys, "full_outer")
    in_old, in_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()

    def pick(c: str, use_new: Column) -> Column:
        return F.when(use_new, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)

    merged = {c: pick(c, in_new) for c in replace} | {c: pick(c, ~in_old) for c in keep}
    return joined.select(*[merged.get(c, F.col(c)) for c in columns])


def stamp_run(batch: DataFrame, run_id: str, as_of=None) -> DataFrame:
    """Run ids and arrival time for rows about to enter the hourly grid."""
    return batch.withColumns(
        {**{c: F.lit(run_id) for c in schemas.RUN_COLUMNS}, "ingested_at": casting.run_at(as_of)}
    )


def stamp_audit(batch: DataFrame, as_of=None) -> DataFrame:
    """Creation and change time for rows about to enter a silver table."""
    return batch.withColumns({c: casting.run_at(as_of) for c in ("created_at", "updated_at")})


def coerce(df: DataFrame, layout) -> DataFrame:
    """Table column order and types. Numbers that do not fit fail the job."""
    exact = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType | T.IntegralType)}

    def fit(field) -> Column:
        kind = field.dataType
        if kind.typeName() == "decimal":
            return casting.to_money(field.name, kind.precision, kind.scale, field.name in exact).alias(field.name)
        return F.col(field.name).cast(kind).alias(field.name)

    return df.select(*[fit(f) for f in layout.fields])


def _with_series(layout, df: DataFrame, series: Sequence[str]):
    named = {f.name: f for f in df.schema.fields}
    return type(layout)([*[named[s] for s in series], *layout.fields])


def hourly_batch(grid: DataFrame, run_id: str, as_of=None, series: Sequence[str] = ()) -> DataFrame:
    """A joined grid as rows of the hourly table, stamped with its run."""
    stamped = stamp_run(grid, run_id, as_of)
    return coerce(stamped, _with_series(schemas.HOURLY_GRID, grid, series))


def upsert_hourly(current: DataFrame, batch: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Metrics and the updating run follow the batch; arrival time, source run
    and creating run stay with whoever brought the hour first."""
    merged = upsert(
        current,
        batch,
        keys=[*series, schemas.LOCAL_HOUR],
        replace=[*schemas.PRICE_METRICS, *schemas.LOAD_METRICS, "updated_run_id"],
        keep=["ingested_at", "source_run_id", "created_run_id"],
    )
    return merged.select(*series, *schemas.HOURLY_GRID.names)


def silver_batch(clean: DataFrame, layout, as_of=None, series: Sequence[str] = ()) -> DataFrame:
    """A cleaned feed as rows of its silver table."""
    return coerce(stamp_audit(clean, as_of), _with_series(layout, clean, series))


def upsert_silver(current: DataFrame, batch: DataFrame, layout, series: Sequence[str] = ()) -> DataFrame:
    """Everything but the key and the creation time follows the batch."""
    keys = [*series, schemas.UTC_HOUR]
    replace = [c for c in layout.names if c not in (schemas.UTC_HOUR, "created_at")]
    return upsert(current, batch, keys, replace, ["created_at"]).select(*series, *layout.names)


def constraint_report(
    df: DataFrame, keys: Sequence[str], required: Sequence[str] = (), by: Column | None = None, counted: Column | None = None
) -> DataFrame:
    """How many rows, distinct keys, rows with a null key, keys that repeat,
    and rows lacking a required column: one row in all, or one per value of
    ``by`` (an expression over the keys). With ``counted`` also how many rows
    that holds for.

    Counting per key first keeps a hot key to one partial row per task, and
    every figure comes out of the same pass.
    """
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    lacking = F.lit(False)
    for r in required:
        lacking = lacking | F.col(r).isNull()
    also = [] if counted is None else [F.count_if(counted).alias("counted")]
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(lacking).alias("lacking"), *also)
    grouped = per_key.groupBy() if by is None else per_key.groupBy(by.alias("part"))
    zero = F.lit(0)
    return grouped.agg(
        F.coalesce(F.sum("n"), zero).alias("n_rows"),
        F.count_if(~null_key).alias("n_keys"),
        F.coalesce(F.sum(F.when(null_key, F.col("n"))), zero).alias("null_key_rows"),
        F.count_if(~null_key & (F.col("n") > 1)).alias("repeated_keys"),
        F.coalesce(F.sum("lacking"), zero).alias("null_required_rows"),
        *([] if counted is None else [F.coalesce(F.sum("counted"), zero).alias("counted")]),
    )


def check_constraints(
    df: DataFrame, keys: Sequence[str], required: Sequence[str], by: Column, counted: Column | None = None
) -> dict[object, dict[str, int]]:
    """Fail the batch if a key is null or repeated or a required column is
    null; otherwise return the counts per value of ``by``, a date derived from
    the key: only as many rows as there are dates come to the driver."""
    by_part = {r["part"]: r.asDict() for r in constraint_report(df, keys, required, by, counted).collect()}
    faults = ("null_key_rows", "repeated_keys", "null_required_rows")
    broken = {f: n for f in faults if (n := sum(counts[f] for counts in by_part.values()))}
    if broken:
        raise ValueError(f"batch violates the key on {list(keys)}: {broken}")
    return by_part


def not_older(batch: DataFrame, written: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """Rows of a batch whose key was not written from a later date before. A
    row without a date counts as older than any with one."""
    last = written.select(*keys, F.col(date).alias("_last"))
    joined = batch.join(last, list(keys), "left")
    return joined.filter(F.col("_last").isNull() | (F.col(date) >= F.col("_last"))).drop("_last")


def load_verification(table: DataFrame, batch: DataFrame, run_id: str, keys: Sequence[str] = (schemas.LOCAL_HOUR,)) -> DataFrame:
    """One row: rows the run left in the table, keys the batch brought, and
    whether the two agree."""
    loaded = table.filter(F.col("updated_run_id") == run_id).agg(
        F.count("*").alias("loaded"), F.lit(0).cast("bigint").alias("expected")
    )
    # A null key counts as one more, hence rows of a distinct, not countDistinct.
    expected = batch.select(*keys).distinct().agg(
        F.lit(0).cast("bigint").alias("loaded"), F.count("*").alias("expected")
    )
    both = loaded.unionByName(expected).agg(
        F.sum("loaded").alias("loaded_count"), F.sum("expected").alias("expected_count")
    )
    return both.withColumn("verified", F.col("loaded_count") == F.col("expected_count"))
