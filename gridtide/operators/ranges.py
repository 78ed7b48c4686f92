"""Running and rolling figures over series too long for one task.

The figures of ``gridtide.operators.rolling`` run over daily rows, in one task
per series. These run over hourly rows, or any number of them. Rows are dealt
to ranges of about equal size along their order; every range is worked on by
itself, and what crosses between ranges is small: a total for each range in a
running sum, and the last rows of a range in a rolling frame (its halo).

Ranges come from approximate quantiles of the order, so a long series is split
as evenly as its rows allow, and rows of equal order stay together. A quantile
is found through a broadcast grid of ``CELLS`` cells, each with the few bounds
that fall into it; the grid's size does not depend on the data.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CELLS = 4096
RANGE, PLACE = "_range", "_place"


def _number(df: DataFrame, name: str) -> Column:
    """A double that never falls where the column rises; null comes first, as
    in an ascending sort."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        day = F.unix_date(F.to_date(c)).cast("double") * 86400
        return day + F.hour(c) * 3600 + F.minute(c) * 60 + F.floor(F.extract(F.lit("SECOND"), c))
    if isinstance(kind, T.TimestampType):
        return F.unix_seconds(c).cast("double")
    if isinstance(kind, T.NumericType):
        return F.floor(c).cast("double")
    raise TypeError(f"rows cannot be dealt to ranges of {name}, a {kind.simpleString()}")


def _ends(df: DataFrame, column: str) -> tuple[float, float] | None:
    row = df.agg(F.min(column).alias("least"), F.max(column).alias("most")).first()
    return None if row["least"] is None else (row["least"], row["most"])


def _ranges(df: DataFrame, ranges: int | None) -> int:
    """As many ranges as a shuffle has partitions, unless told."""
    return ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_range(df: DataFrame, order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """The rows with the number of their range, from 0 on, which never falls
    along ``order``. The first column of the order decides, and the second one
    among rows of equal firsts, so that one busy day is split too."""
    ranges = _ranges(df, ranges)
    placed = df.withColumn(PLACE, _number(df, order[0]))
    if len(order) > 1:
        second = _ends(df.select(_number(df, order[1]).alias("x")), "x")
        if second:
            part = (_number(df, order[1]) - second[0]) / (second[1] - second[0] + 1)
            placed = placed.withColumn(PLACE, F.col(PLACE) + F.coalesce(part, F.lit(0.0)))
    ends = _ends(placed, PLACE)
    if ends is None:
        return placed.withColumn(RANGE, F.lit(0)).drop(PLACE)
    shares = [i / ranges for i in range(1, ranges)]
    bounds = sorted(set(placed.stat.approxQuantile(PLACE, shares, 0.1 / ranges))) if shares else []
    least, width = ends[0], (ends[1] - ends[0]) / CELLS or 1.0
    cell_of = lambda x: min(CELLS - 1, max(0, int((x - least) / width)))
    inside: dict[int, list[float]] = {}
    for b in bounds:
        inside.setdefault(cell_of(b), []).append(b)
    cells = [cell_of(b) for b in bounds]
    grid = [(cell, bisect_right(cells, cell - 1), inside.get(cell, [])) for cell in range(CELLS)]
    grid = df.sparkSession.createDataFrame(grid, "_cell int, _first int, _bounds array<double>")
    cell = F.least(F.lit(CELLS - 1), F.greatest(F.lit(0), F.floor((F.col(PLACE) - least) / width))).cast("int")
    joined = placed.withColumn("_cell", F.coalesce(cell, F.lit(0))).join(F.broadcast(grid), "_cell")
    beyond = F.size(F.filter("_bounds", lambda b: b <= F.col(PLACE)))
    number = F.when(F.col(PLACE).isNull(), 0).otherwise(F.col("_first") + beyond)
    return joined.withColumn(RANGE, number).select(*df.columns, RANGE)


def _before(per_range: DataFrame, figure: str, ranges: int, series: Sequence[str]) -> DataFrame:
    """For each range (of a series) the sum of a figure over earlier ones. With
    series there is a small window for each; without, every range adds itself
    to all later ones, so that nothing meets in a single task."""
    if series:
        earlier = Window.partitionBy(*series).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
        return per_range.select(*series, RANGE, F.sum(figure).over(earlier).alias("_before"))
    later = per_range.filter(F.col(RANGE) < ranges).withColumn(RANGE, F.explode(F.sequence(F.col(RANGE) + 1, F.lit(ranges))))
    return later.groupBy(RANGE).agg(F.sum(figure).alias("_before"))


def running_total(
    df: DataFrame, value: str, order: Sequence[str], name: str, series: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """The rows with the sum of ``value`` up to and including each: what a
    window over the whole series gives, as long as ``order`` tells its rows
    apart. Nulls add nothing, and the sum is null before the first value."""
    ranges = _ranges(df, ranges)
    dealt = with_range(df, order, ranges)
    totals = dealt.groupBy(*series, RANGE).agg(F.sum(value).alias("_total"))
    before = _before(totals, "_total", ranges, series)
    own = F.sum(value).over(Window.partitionBy(*series, RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # Null series match each other.
    rows = dealt.withColumn("_own", own).alias("rows")
    keys = [*series, RANGE]
    offsets = before.select(*[F.col(k).alias(f"_at{i}") for i, k in enumerate(keys)], "_before")
    matched = F.lit(True)
    for i, k in enumerate(keys):
        matched = matched & F.col(f"rows.{k}").eqNullSafe(F.col(f"_at{i}"))
    joined = rows.join(offsets, matched, "left")
    total = F.coalesce(F.col("_own") + F.col("_before"), F.col("_own"), F.col("_before"))
    kind = totals.schema["_total"].dataType
    return joined.select(*[F.col(f"rows.{c}").alias(c) for c in df.columns], total.cast(kind).alias(name))


def rolling(
    df: DataFrame, figures: dict[str, Column], order: Sequence[str], rows: int, series: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """The rows with ``figures`` (aggregates, by name) over each row and the
    ``rows - 1`` before it in its series, as long as ``order`` tells the rows
    of a series apart.

    The last rows of a range go to the ranges after it that still need them: to
    the next one, and further on over ranges of fewer than ``rows - 1`` rows.
    """
    ranges = _ranges(df, ranges)
    dealt = with_range(df, order, ranges)
    backwards = Window.partitionBy(*series, RANGE).orderBy(*[F.desc(c) for c in order])
    tails = dealt.withColumn("_after", F.row_number().over(backwards) - 1).filter(F.col("_after") < rows - 1)
    sizes = dealt.groupBy(*series, RANGE).agg(F.count("*").alias("_size"))
    ends = _named(_before(sizes, "_size", ranges, series), series, "e").withColumnRenamed("_before", "_e_rows")
    sizes = _named(sizes, series, "s")
    counted = sizes.join(ends, _matched(sizes, ends, series, "s", "e"), "left")
    counted = counted.withColumn("_first", F.coalesce("_e_rows", F.lit(0)).cast("bigint"))
    # Each existing range of a series has a number, so a tail knows which come next.
    ordinal = _named(_before(counted.select(*_renamed(series, "s"), F.lit(1).alias("_one")), "_one", ranges, series), series, "o")
    counted = counted.join(ordinal, _matched(counted, ordinal, series, "s", "o"), "left")
    counted = counted.withColumn("_ordinal", F.coalesce("_before", F.lit(0)).cast("bigint"))
    counted = counted.select(*_renamed(series, "s"), "_size", "_first", "_ordinal")

    own = _named(counted, series, "c")
    tails = tails.join(own, _matched(tails, own, series, None, "c"))
    # Rows between the tail row and the first row of a later range.
    tails = tails.withColumn("_end", F.col("_first") + F.col("_size") - F.col("_after"))
    tails = tails.withColumn("_next", F.explode(F.sequence(F.col("_ordinal") + 1, F.col("_ordinal") + rows - 1)))
    tails = tails.select(*df.columns, "_end", "_next")
    goal = counted.select(*[F.col(s).alias(f"_g_{s}") for s in series], F.col(RANGE).alias("_g_range"), F.col("_first").alias("_g_first"), F.col("_ordinal").alias("_g_ordinal"))
    to_goal = F.col("_next") == F.col("_g_ordinal")
    for s in series:
        to_goal = to_goal & tails[s].eqNullSafe(goal[f"_g_{s}"])
    halo = tails.join(goal, to_goal).filter(F.col("_g_first") - F.col("_end") < rows - 1)
    halo = halo.select(*df.columns, F.col("_g_range").alias(RANGE), F.lit(True).alias("_halo"))

    frame = Window.partitionBy(*series, RANGE).orderBy(*order).rowsBetween(-(rows - 1), Window.currentRow)
    both = dealt.withColumn("_halo", F.lit(False)).unionByName(halo)
    done = both.select("*", *[figure.over(frame).alias(name) for name, figure in figures.items()])
    return done.filter(~F.col("_halo")).select(*df.columns, *figures)


def _named(df: DataFrame, series: Sequence[str], side: str) -> DataFrame:
    """Keys under names of their own, so that both sides of a join differ."""
    return df.withColumnsRenamed({k: f"_{side}_{k}" for k in (*series, RANGE)})


def _renamed(series: Sequence[str], side: str) -> list[Column]:
    return [F.col(f"_{side}_{k}").alias(k) for k in (*series, RANGE)]


def _matched(left: DataFrame, right: DataFrame, series: Sequence[str], a: str | None, b: str) -> Column:
    on = F.lit(True)
    for k in (*series, RANGE):
        on = on & left[k if a is None else f"_{a}_{k}"].eqNullSafe(right[f"_{b}_{k}"])
    return on
