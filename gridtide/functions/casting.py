"""Lenient typing of string fields.

All of these are plain Column expressions that stay inside whole-stage codegen
and never depend on the session's ANSI switch or time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The feeds' timestamp layout and the numerals an integer may use.
MINUTE_LAYOUT = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}$"
PLAIN_NUMERAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"
NAMES_A_ZONE = r"\d:\d{2}.*[A-Za-z+-]"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_minute(c: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm`` and nothing else; any other text is NULL.

    Reads straight into a zone-less timestamp, so hours inside a daylight-saving
    gap keep the wall time they were published with.
    """
    c = as_column(c)
    return F.when(c.rlike(MINUTE_LAYOUT), c).try_cast("timestamp_ntz")


def parse_any(c: Column | str) -> Column:
    """Any ISO-like date or timestamp text; unreadable text is NULL.

    Text that names an offset is moved to UTC; text without one is kept as is.
    """
    c = as_column(c)
    # Seconds since the epoch do not depend on the session's zone.
    since_epoch = F.make_dt_interval(secs=F.unix_micros(c.try_cast("timestamp")) / F.lit(1_000_000).cast("decimal(8,0)"))
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    # The feeds' own layout is too short to name a zone, so it skips the pattern.
    names_zone = (F.length(c) > len("yyyy-MM-dd HH:mm")) & c.rlike(NAMES_A_ZONE)
    return F.when(names_zone, epoch + since_epoch).otherwise(c.try_cast("timestamp_ntz"))


def to_double(c: Column | str) -> Column:
    """Text to double; null, blank and malformed text are NULL."""
    return as_column(c).try_cast("double")


def to_int(c: Column | str) -> Column:
    """Text to int: a fraction is cut off, overflow and exponents are NULL."""
    c = as_column(c)
    return F.when(c.rlike(PLAIN_NUMERAL), c).try_cast("double").try_cast("int")


def to_money(c: Column | str, precision: int = 10, scale: int = 2, exact: bool = False) -> Column:
    """Coerce to a fixed-scale number: ties round away from zero and a value
    that does not fit fails the job, as storing it in such a column would. A
    number that is none (the text NaN parses as one) is NULL; values said to be
    ``exact`` (decimals and whole numbers) cannot be one and are not tested."""
    kind = f"decimal({precision},{scale})"
    c = as_column(c)
    if not exact:
        c = F.when(~F.isnan(c.try_cast("double")), c)
    coerced = c.try_cast(kind)
    message = F.concat(F.lit(f"value out of range for {kind}: "), c.cast("string"))
    return F.when(c.isNotNull() & coerced.isNull(), F.raise_error(message)).otherwise(coerced)


def wall_time(moment: dt.datetime) -> Column:
    """A zone-less timestamp literal; a moment with a zone is moved to UTC.

    Spelled as text, because a datetime literal is an instant and would shift
    with the session's zone.
    """
    if moment.tzinfo is not None:
        moment = moment.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def run_at(moment: dt.datetime | None = None) -> Column:
    """The audit timestamp: the moment given, else now; in UTC either way."""
    return wall_time(moment or dt.datetime.now(dt.timezone.utc))
