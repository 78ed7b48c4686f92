"""A document read by byte ranges gives the rows it gives as a whole."""

import json

import pytest
from helpers import PRICES, envelope, price_record, write_json
from test_upsert import same

from gridtide import schemas
from gridtide.sources import large_reports, reports

REPORT, RECORD = schemas.PRICE_REPORT, schemas.PRICE_RECORD


def many(n):
    return [price_record(f"2026-08-{1 + i % 28:02d} {i % 24:02d}:00", None if i % 7 == 0 else f"{i}.5") for i in range(n)]


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("shape", ["wrapped", "named", "bare"])
def test_rows_are_those_of_the_whole_document(spark, tmp_path, indent, shape):
    records = many(3000)
    document = {"wrapped": envelope(REPORT, records), "named": {REPORT: records}, "bare": records}[shape]
    path = write_json(tmp_path / "raw_pool_prices_2026-08-01.json", json.dumps(document, indent=indent))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        got = large_reports.read_large_reports(spark, path, REPORT, RECORD)
        assert got.rdd.getNumPartitions() > 4
        want = reports.read_any_shape(spark, path, REPORT, RECORD)
        assert same(got.drop(reports.LANDED_ON), want) and got.count() == 3000
        assert str(got.first()[reports.LANDED_ON]) == "2026-08-01"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")


def test_several_files_and_empty_ones(spark, tmp_path):
    for day, records in (("01", PRICES), ("02", []), ("03", many(5))):
        write_json(tmp_path / f"raw_pool_prices_2026-08-{day}.json", envelope(REPORT, records))
    got = large_reports.read_large_reports(spark, f"{tmp_path}/raw_pool_prices_*.json", REPORT, RECORD)
    assert same(got, reports.read_landing(spark, str(tmp_path), "raw_pool_prices", REPORT, RECORD))
    assert large_reports.read_large_reports(spark, f"{tmp_path}/none_*.json", REPORT, RECORD).isEmpty()


GOOD = json.dumps(envelope(REPORT, PRICES))


@pytest.mark.parametrize(
    "text",
    [
        GOOD[: len(GOOD) // 2],
        GOOD[:-4],
        GOOD.replace('", "pool_price', '" "pool_price'),
        GOOD.replace("}, {", "} {"),
        GOOD.replace("21.63", "2}3"),
        json.dumps(envelope("Other Report", PRICES)),
        json.dumps({**envelope(REPORT, PRICES), "more": 1}),
        GOOD + GOOD,
        "no JSON",
        "",
    ],
)
def test_anything_else_fails_and_is_named(spark, tmp_path, text):
    path = write_json(tmp_path / "raw_pool_prices_2026-08-01.json", text)
    with pytest.raises(Exception, match="unreadable Pool Price Report in .*raw_pool_prices_2026-08-01.json"):
        large_reports.read_large_reports(spark, path, REPORT, RECORD).collect()
