"""Typed hourly frames from raw report rows, and key uniqueness.

The local-hour variant keeps every row and drops the UTC hour. The UTC variant
drops rows without a key and keeps one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide import schemas
from gridtide.functions import casting


def _typed(raw: DataFrame, hours: dict, metrics: list[str], number, keep: Sequence[str]) -> DataFrame:
    return raw.select(
        *keep,
        *[parse(name).alias(name) for name, parse in hours.items()],
        *[number(m).alias(m) for m in metrics],
    )


def price_by_local_hour(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    hours = {schemas.LOCAL_HOUR: casting.parse_minute}
    return _typed(raw, hours, schemas.PRICE_METRICS, casting.to_double, keep)


def load_by_local_hour(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    hours = {schemas.LOCAL_HOUR: casting.parse_minute}
    return _typed(raw, hours, schemas.LOAD_METRICS, casting.to_int, keep)


def _by_utc_hour(
    raw: DataFrame, metrics: list[str], keep: Sequence[str], prefer: Sequence[str], with_preferred: bool
) -> DataFrame:
    hours = {schemas.UTC_HOUR: casting.parse_any, schemas.LOCAL_HOUR: casting.parse_any}
    extra = [c for c in prefer if c not in keep]
    typed = _typed(raw, hours, metrics, casting.to_double, [*keep, *extra])
    present = typed.filter(F.col(schemas.UTC_HOUR).isNotNull())
    one = keep_one(present, [*keep, schemas.UTC_HOUR], prefer)
    return one if with_preferred else one.drop(*extra)


def price_by_utc_hour(
    raw: DataFrame, keep: Sequence[str] = (), prefer: Sequence[str] = (), with_preferred: bool = False
) -> DataFrame:
    return _by_utc_hour(raw, schemas.PRICE_METRICS, keep, prefer, with_preferred)


def load_by_utc_hour(
    raw: DataFrame, keep: Sequence[str] = (), prefer: Sequence[str] = (), with_preferred: bool = False
) -> DataFrame:
    return _by_utc_hour(raw, schemas.LOAD_METRICS, keep, prefer, with_preferred)


def _rank(df: DataFrame, prefer: Sequence[str], rest: Sequence[str]) -> Column:
    """One number that orders the rows of a key: the preferred column first,
    rows without it last, and a hash of the whole row after it. It has a fixed
    width, so that the aggregate on it can hash."""
    row = F.xxhash64(*rest)
    if not prefer:
        return row
    (first,) = prefer
    kind, value = df.schema[first].dataType, F.col(first)
    if isinstance(kind, T.DateType):
        value = F.unix_date(value)
    elif not isinstance(kind, T.IntegralType):
        raise ValueError(f"the preferred column must hold dates or whole numbers, not {kind.simpleString()}")
    wide = "decimal(38,0)"
    lowest = F.lit(-(1 << 63)).cast("bigint")
    first_part = F.coalesce(value.cast("bigint"), lowest).cast("decimal(19,0)") * F.lit(Decimal(10**18))
    return (first_part.cast(wide) + F.pmod(row, F.lit(10**18)).cast(wide)).cast(wide)


def keep_one(df: DataFrame, keys: Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """One row per key, always the same one: that with the greatest ``prefer``
    column (at most one, of dates or whole numbers), and of several the one
    whose hash is greatest. With nothing preferred and a single column beside
    the keys it is the greatest value of that column.

    This is a hash aggregate, combined before the shuffle: a key repeated in a
    third of all rows sends one row per task, and no row is sorted. Only text
    columns outside the keys would make Spark sort.
    """
    keys, prefer = list(keys), list(prefer)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    if not prefer and len(rest) == 1:  # the greatest value is the row
        return df.groupBy(*keys).agg(F.max(rest[0]).alias(rest[0])).select(*df.columns)
    ranked = df.withColumn("_rank", _rank(df, prefer, rest))
    one = ranked.groupBy(*keys).agg(*[F.max_by(c, "_rank").alias(c) for c in rest])
    return one.select(*df.columns)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts; a null key
    counts as a value."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def require_unique(df: DataFrame, keys: Sequence[str], sample: int = 5) -> None:
    """Fail with a few offending keys unless every key is unique."""
    bad = duplicate_keys(df, keys).take(sample)
    if bad:
        shown = "; ".join(", ".join(f"{k}={row[k]}" for k in [*keys, "n_rows"]) for row in bad)
        raise ValueError(f"duplicate keys found: {shown}")
