"""A state that follows corrections against one worked out from scratch."""

import datetime as dt
import random

from helpers import hourly
from pyspark.sql import functions as F
from test_upsert import same

from gridtide import schemas
from gridtide.operators import daily, daily_state

AT = dt.datetime(2026, 8, 9)


def frame(spark, hours):
    return hourly(spark, [(h, p, n) for (h, _), (p, n) in hours.items()]) if hours else hourly(spark, [(None, None, None)]).limit(0)


def marked(spark, hours):
    """Hours keyed by (hour, market)."""
    rows = [(h, m, p, n) for (h, m), (p, n) in hours.items()]
    df = spark.createDataFrame(rows, "h string, market string, pool_price double, alberta_internal_load int")
    return df.withColumn(schemas.LOCAL_HOUR, F.col("h").cast("timestamp_ntz")).drop("h")


def test_random_corrections(spark):
    rng = random.Random(8)
    value = lambda: (rng.choice([None, float(rng.randint(0, 6)), rng.randint(-900, 900) / 100]), rng.choice([None, rng.randint(0, 50)]))
    hours = {(f"2026-08-{d:02d} {h:02d}:00", m): value() for d in (1, 2, 3, 4) for h in range(4) for m in ("a", None)}
    state = daily_state.daily_state(marked(spark, hours), ["market"])
    stale = 0
    for _ in range(4):
        batch = {k: value() for k in rng.sample(sorted(hours, key=str), 5)} | {(f"2026-08-{rng.randint(3, 6):02d} 09:00", "b"): value()}
        old = marked(spark, {k: hours[k] for k in batch if k in hours})
        hours |= batch
        new, table = marked(spark, batch), marked(spark, hours)
        merged = daily_state.merge_state(state, daily_state.daily_state(old, ["market"]), daily_state.daily_state(new, ["market"]), ["market"])
        stale += merged.filter("stale").count()
        state = daily_state.follow(state, old, new, table, ["market"])
        assert same(state, daily_state.daily_state(table, ["market"]))
        assert same(
            daily_state.figures(state, ["market"], AT), daily.daily_aggregate(table, series=["market"], computed_at=AT)
        )
        state = spark.createDataFrame(state.collect(), state.schema)
    assert stale


def test_a_day_is_read_again_only_where_an_extreme_went(spark):
    day = {(f"2026-08-01 {h:02d}:00", ""): (float(h), h) for h in range(5)}
    state = daily_state.daily_state(frame(spark, day))

    def stale(changed):
        old, new = (daily_state.daily_state(frame(spark, {k: side[k] for k in changed})) for side in (day, changed))
        return daily_state.merge_state(state, old, new).first()["stale"]

    hour = lambda h: (f"2026-08-01 {h:02d}:00", "")
    assert not stale({hour(2): (3.5, 1)})
    assert not stale({hour(4): (9.0, 1)})  # the highest goes, a higher one comes
    assert stale({hour(4): (2.0, 1)})
    assert stale({hour(0): (None, 1)})


def test_days_that_lose_all_rows_go(spark):
    one = frame(spark, {("2026-08-01 00:00", ""): (1.0, 1)})
    state = daily_state.daily_state(one)
    nothing = frame(spark, {})
    assert daily_state.follow(state, one, nothing, nothing).isEmpty()
    assert same(daily_state.follow(daily_state.daily_state(nothing), nothing, one, one), state)
