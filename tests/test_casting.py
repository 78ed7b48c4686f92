import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridtide.functions import casting


def evaluate(spark, values, kind, expression):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, c {kind}").select("i", expression.alias("r"))
    return [r.r for r in df.orderBy("i").collect()]


def test_to_double(spark):
    got = evaluate(spark, ["", "  ", None, "abc", " 1.5 ", "21.63", "1e3", "-0.5"], "string", casting.to_double("c"))
    assert got == [None, None, None, None, 1.5, 21.63, 1000.0, -0.5]


def test_to_int_cuts_fractions_and_rejects_exponents(spark):
    values = ["10089", "10089.5", "-7.9", " 12 ", "1e3", "", "x", None, "2147483647", "2147483648", "5.", ".5"]
    got = evaluate(spark, values, "string", casting.to_int("c"))
    assert got == [10089, 10089, -7, 12, None, None, None, None, 2147483647, None, 5, 0]


def test_parse_minute_takes_one_layout_only(spark):
    values = ["2026-08-01 00:00", "2026-08-01 00:00:00", "2026-8-1 0:00", "2026-13-01 00:00", "bad", "", None]
    got = evaluate(spark, values, "string", casting.parse_minute("c"))
    assert got == [dt.datetime(2026, 8, 1)] + [None] * 6


def test_parse_any(spark):
    values = ["2026-08-01 05:30", "2026-08-01T05:30:15", "2026-08-01", "bad", "", None]
    got = evaluate(spark, values, "string", casting.parse_any("c"))
    assert got == [dt.datetime(2026, 8, 1, 5, 30), dt.datetime(2026, 8, 1, 5, 30, 15), dt.datetime(2026, 8, 1), None, None, None]


@pytest.mark.parametrize("zone", ["UTC", "America/Edmonton", "Asia/Kolkata"])
def test_timestamps_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        gap = ["2026-03-08 02:30"]
        assert evaluate(spark, gap, "string", casting.parse_minute("c")) == [dt.datetime(2026, 3, 8, 2, 30)]
        assert evaluate(spark, gap, "string", casting.parse_any("c")) == [dt.datetime(2026, 3, 8, 2, 30)]
        zoned = ["2026-03-08T02:30:00-07:00", "2026-11-01T08:30:00Z", "2026-11-01T07:30:00.250Z"]
        assert evaluate(spark, zoned, "string", casting.parse_any("c")) == [
            dt.datetime(2026, 3, 8, 9, 30),
            dt.datetime(2026, 11, 1, 8, 30),
            dt.datetime(2026, 11, 1, 7, 30, 0, 250000),
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_to_money_rounds_ties_away_from_zero(spark):
    got = evaluate(spark, [21.635, -21.635, 1.005, 1.0, None], "double", casting.to_money("c"))
    assert got == [Decimal("21.64"), Decimal("-21.64"), Decimal("1.01"), Decimal("1.00"), None]


def test_to_money_overflow_fails(spark):
    with pytest.raises(Exception, match="out of range for decimal"):
        evaluate(spark, [1e9], "double", casting.to_money("c"))


def test_leniency_does_not_need_ansi_off(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.decimals(-1000, 1500, places=2, allow_nan=False), min_size=1, max_size=30))
def test_money_text_round_trip(spark, amounts):
    texts = [str(a) for a in amounts]
    got = evaluate(spark, texts, "string", casting.to_money(F.lit(0) + casting.to_double("c")))
    assert got == amounts


@pytest.mark.parametrize("zone", ["UTC", "America/Edmonton"])
def test_literals_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        moment = dt.datetime(2026, 3, 8, 2, 30, 0, 5)
        aware = dt.datetime(2026, 3, 8, 2, 30, tzinfo=dt.timezone(dt.timedelta(hours=-7)))
        row = spark.range(1).select(casting.run_at(moment), casting.run_at(aware), casting.run_at()).first()
        assert tuple(row)[:2] == (moment, dt.datetime(2026, 3, 8, 9, 30)) and row[2] is not None
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
