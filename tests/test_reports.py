import datetime as dt
import json

import pytest
from helpers import LOADS, PRICES, envelope, plan_of, price_record, rows_of, write_json

from gridtide import schemas
from gridtide.sources import reports

REPORT = schemas.PRICE_REPORT
ONE = [price_record("2026-08-01 00:00", "21.63")]


def parsed_count(spark, document, strict=False):
    text = document if isinstance(document, str) else json.dumps(document)
    docs = spark.createDataFrame([(text,)], "doc string")
    return rows_of(reports.parse_documents(docs, "doc", REPORT, schemas.PRICE_RECORD, strict=strict))


@pytest.mark.parametrize(
    "document, n",
    [
        (envelope(REPORT, ONE), 1),
        ({REPORT: ONE}, 1),
        (ONE, 1),
        (ONE * 3, 3),
        (envelope(REPORT, []), 0),
        ([], 0),
        ({"return": {}, REPORT: ONE}, 0),
        ({REPORT: ONE, "return": {}}, 0),
        ({"return": 5, REPORT: ONE}, 1),
        ({REPORT: ONE, "return": "text"}, 1),
        ({"return": None, REPORT: ONE}, 1),
        ({"return": [1], REPORT: ONE}, 1),
        ({"return": {REPORT: None}}, 0),
        ({"x": 1}, 0),
        ({}, 0),
        ("null", 0),
        ("5", 0),
    ],
)
def test_document_shapes(spark, document, n):
    for strict in (False, True):
        assert len(parsed_count(spark, document, strict)) == n


def test_shapes_carry_the_same_values(spark):
    want = [("2026-08-01 00:00", "2026-08-01 00:00", "21.63", None, None)]
    for document in (envelope(REPORT, ONE), {REPORT: ONE}, ONE):
        assert parsed_count(spark, document) == want


def test_numbers_in_documents_read_as_text(spark):
    (row,) = parsed_count(spark, [{"begin_datetime_utc": "2026-08-01 00:00", "pool_price": 21.63}])
    assert row == ("2026-08-01 00:00", None, "21.63", None, None)


@pytest.mark.parametrize("broken", ['{"return": {"Pool', "[1", "", "{not json}"])
def test_broken_documents(spark, broken):
    assert parsed_count(spark, broken) == []
    with pytest.raises(Exception, match="unreadable JSON document"):
        parsed_count(spark, broken, strict=True)


@pytest.mark.parametrize(
    "document",
    [envelope(REPORT, [5, *ONE]), envelope(REPORT, {"a": 1}), envelope(REPORT, "text"), envelope(REPORT, 7), {REPORT: "text"}, [5, *ONE], [[1]]],
)
def test_reports_that_are_no_records_are_not_lost(spark, document):
    with pytest.raises(Exception, match="unreadable JSON document"):
        parsed_count(spark, document, strict=True)


@pytest.mark.parametrize("text", ['{"return": {"Pool', json.dumps(envelope(REPORT, [5, *ONE])), json.dumps(envelope(REPORT, {"a": 1}))])
@pytest.mark.parametrize("window", [(None, None), (dt.date(2026, 8, 1), dt.date(2026, 8, 3))])
def test_a_broken_landing_file_fails_and_is_named(spark, tmp_path, text, window):
    write_json(tmp_path / "p_2026-08-01.json", envelope(REPORT, ONE))
    (tmp_path / "p_2026-08-02.json").write_text(text)
    with pytest.raises(Exception, match="p_2026-08-02.json"):
        reports.read_landing(spark, str(tmp_path), "p", REPORT, schemas.PRICE_RECORD, *window).collect()
    only_first = reports.read_landing(spark, str(tmp_path), "p", REPORT, schemas.PRICE_RECORD, window[0], dt.date(2026, 8, 1))
    assert only_first.count() == 1


def test_a_closed_range_names_its_files(spark, tmp_path):
    for day in range(1, 10):
        write_json(tmp_path / f"p_2026-08-0{day}.json", envelope(REPORT, ONE))
    df = reports.read_landing(spark, str(tmp_path), "p", REPORT, schemas.PRICE_RECORD, dt.date(2026, 8, 8), dt.date(2026, 8, 20))
    assert len(df.inputFiles()) == 2 and df.count() == 2


def test_read_enveloped_reads_every_matching_file(spark, tmp_path):
    for day in (1, 2, 3):
        records = [price_record(f"2026-08-0{day} {h:02d}:00", str(day)) for h in range(24)]
        write_json(tmp_path / f"raw_pool_prices_2026-08-0{day}.json", envelope(REPORT, records))
    write_json(tmp_path / "raw_ail_2026-08-01.json", envelope(schemas.LOAD_REPORT, LOADS))
    df = reports.read_enveloped(spark, f"{tmp_path}/raw_pool_prices_*.json", REPORT, schemas.PRICE_RECORD)
    assert df.columns == schemas.PRICE_RECORD.names
    assert df.count() == 72
    assert {t for _, t in df.dtypes} == {"string"}


def test_empty_arrays_have_no_rows(spark, tmp_path):
    write_json(tmp_path / "raw_pool_prices_2026-08-01.json", envelope(REPORT, []))
    df = reports.read_enveloped(spark, f"{tmp_path}/raw_pool_prices_*.json", REPORT, schemas.PRICE_RECORD)
    assert df.count() == 0 and df.columns == schemas.PRICE_RECORD.names


@pytest.mark.parametrize("reader", [reports.read_enveloped, reports.read_any_shape])
def test_missing_input_is_an_empty_report(spark, tmp_path, reader):
    df = reader(spark, f"{tmp_path}/nothing_*.json", REPORT, schemas.PRICE_RECORD)
    assert df.schema == schemas.PRICE_RECORD and df.isEmpty()


def test_read_any_shape(spark, tmp_path):
    paths = [
        write_json(tmp_path / "a.json", envelope(REPORT, PRICES)),
        write_json(tmp_path / "b.json", {REPORT: ONE}),
        write_json(tmp_path / "c.json", ONE),
        str(tmp_path / "absent.json"),
    ]
    assert reports.read_any_shape(spark, paths, REPORT, schemas.PRICE_RECORD).count() == 4


def test_landing_dates(spark):
    names = ["raw_pool_prices_2026-08-15.json", "raw_ail_2026-8-15.json", "raw_ail_2026-13-15.json", "x.json", None]
    df = spark.createDataFrame([(n,) for n in names], "f string").select(reports.landing_date("f"))
    assert [r[0] for r in df.collect()] == [dt.date(2026, 8, 15), None, None, None, None]


def test_read_landing_opens_only_files_in_range(spark, tmp_path):
    for day in range(1, 10):
        write_json(
            tmp_path / f"raw_gen_cap_2026-08-0{day}.json",
            envelope("Capacity", [{"asset": f"a{day}", "mw": "5"}]) if day != 1 else "{broken",
        )
    record = schemas.string_fields(["asset", "mw"])
    df = reports.read_landing(
        spark, str(tmp_path), schemas.CAPACITY_PREFIX, "Capacity", record, dt.date(2026, 8, 3), dt.date(2026, 8, 5)
    )
    assert rows_of(df, "asset") == [(f"a{d}", "5", dt.date(2026, 8, d)) for d in (3, 4, 5)]
    scan = next(line for line in plan_of(df).splitlines() if "FileScan" in line or "Scan json" in line)
    assert "file_name" in scan
    opened = reports_files_read(df)
    assert opened == 3


def reports_files_read(df):
    """Files the scan of an executed plan selected."""
    df.collect()
    execution = df._jdf.queryExecution().executedPlan()
    leaves = execution.collectLeaves()
    scan = leaves.apply(0)
    return scan.metrics().apply("numFiles").value()


def test_read_landing_of_nothing(spark, tmp_path):
    df = reports.read_landing(spark, str(tmp_path), "raw_ail", schemas.LOAD_REPORT, schemas.LOAD_RECORD)
    assert df.columns == [*schemas.LOAD_RECORD.names, reports.LANDED_ON] and df.isEmpty()


def test_window_bounds_are_inclusive():
    assert reports.window_bounds(dt.date(2026, 8, 20)) == (dt.date(2026, 8, 5), dt.date(2026, 8, 20))
