"""Reading market reports: nested JSON documents to flat all-string rows.

A report file holds one document, so one file is one task's unit of work; the
parallelism comes from the number of files. Nothing is listed, opened or parsed
in driver Python, and no schema is inferred.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide import schemas
from gridtide.functions.casting import wall_time
from gridtide.sources.datasets import path_exists

LANDED_ON = "landing_date"
# Landing files are named <prefix>_<yyyy-MM-dd>.json.
FILE_DATE = r"_(\d{4}-\d{2}-\d{2})\.json$"
STARTS_LIST = r"^\s*\["


def envelope_type(report: str, record: T.StructType) -> T.StructType:
    records = T.ArrayType(record)
    inner = T.StructType([T.StructField(report, records)])
    return T.StructType([T.StructField(schemas.ENVELOPE, inner), T.StructField(report, records)])


def _loose_type(report: str) -> T.StructType:
    """The same envelope with the report as whatever text stands there."""
    inner = T.StructType([T.StructField(report, T.StringType())])
    return T.StructType([T.StructField(schemas.ENVELOPE, inner), T.StructField(report, T.StringType())])


def empty_report(spark: SparkSession, record: T.StructType) -> DataFrame:
    return spark.createDataFrame([], record)


def flatten(docs: DataFrame, records: Column, record: T.StructType, keep: list[str] | None = None) -> DataFrame:
    """One row per array element; a null or empty array yields none."""
    keep = keep or []
    return docs.select(*keep, F.explode(records).alias("record")).select(
        *keep, *[F.col("record").getField(f).alias(f) for f in record.names]
    )


def parse_documents(
    docs: DataFrame,
    doc: str,
    report: str,
    record: T.StructType,
    keep: list[str] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Flat report rows from a column of JSON documents of any known shape.

    * an object under ``return``: the report inside it, or nothing at all if
      that object lacks the report;
    * otherwise the report at the top level;
    * otherwise, for a bare list, the list itself;
    * otherwise nothing.

    One declared schema covers all of them, so each document is parsed once: a
    bare list is read as if it stood under the report's name, and a ``return``
    that is not an object reads as NULL, which is just the case in which the
    top level counts. With ``strict`` a document that is no JSON at all, or
    has something other than records where the report should be, fails the job
    instead of yielding nothing.
    """
    keep = keep or []
    text = F.col(doc)
    named = F.concat(F.lit("{" + json.dumps(report) + ":"), text, F.lit("}"))
    as_object = F.when(text.rlike(STARTS_LIST), named).otherwise(text)
    parsed = docs.select(*keep, text.alias("_doc"), F.from_json(as_object, envelope_type(report, record)).alias("_parsed"))
    wrapped = F.col("_parsed").getField(schemas.ENVELOPE)
    direct = F.col("_parsed").getField(report)
    found = F.when(wrapped.isNotNull(), wrapped.getField(report)).otherwise(direct)
    if strict:
        # Only documents that gave nothing are looked at again, as plain text:
        # was there anything in the report's place, and was it JSON at all?
        listed = F.concat(F.lit("{" + json.dumps(report) + ":"), F.col("_doc"), F.lit("}"))
        loose = F.from_json(F.when(F.col("_doc").rlike(STARTS_LIST), listed).otherwise(F.col("_doc")), _loose_type(report))
        place = F.when(wrapped.isNotNull(), loose[schemas.ENVELOPE].getField(report)).otherwise(loose[report])
        no_json = F.get_json_object("_doc", "$").isNull() & (F.trim("_doc") != "null")
        failed = F.raise_error(F.lit(f"unreadable JSON document for {report}"))
        found = F.when(found.isNull(), F.when(no_json | place.isNotNull(), failed)).otherwise(found)
    return flatten(parsed, found, record, keep)


def _landed(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The given paths or globs that stand for anything at all."""
    paths = [path] if isinstance(path, str) else path
    return [p for p in paths if path_exists(spark, p)]


def read_enveloped(spark: SparkSession, path: str | list[str], report: str, record: T.StructType) -> DataFrame:
    """Wrapped reports (``return`` around the report), any number of files.

    ``path`` may hold globs; Spark expands them. The JSON reader streams each
    file, so no document is ever held as one string. Paths that match nothing
    give an empty report.
    """
    paths = _landed(spark, path)
    if not paths:
        return empty_report(spark, record)
    docs = spark.read.schema(envelope_type(report, record)).option("multiLine", True).json(paths)
    return flatten(docs, F.col(schemas.ENVELOPE).getField(report), record)


def read_any_shape(
    spark: SparkSession, path: str | list[str], report: str, record: T.StructType, strict: bool = True
) -> DataFrame:
    """Reports in any of the accepted shapes, one document per file; paths
    that match nothing give an empty report."""
    paths = _landed(spark, path)
    if not paths:
        return empty_report(spark, record)
    docs = spark.read.text(paths, wholetext=True)
    return parse_documents(docs, "value", report, record, strict=strict)


def landing_date(file_name: Column | str) -> Column:
    """The date in a landing file's name, NULL if it has none."""
    name = F.col(file_name) if isinstance(file_name, str) else file_name
    return F.nullif(F.regexp_extract(name, FILE_DATE, 1), F.lit("")).try_cast("date")


def window_bounds(as_of: dt.date, days_back: int = schemas.LOOKBACK_DAYS) -> tuple[dt.date, dt.date]:
    """First and last day of a look-back window, both included."""
    return as_of - dt.timedelta(days=days_back), as_of


def in_window(ts: Column, first: dt.date | None = None, last: dt.date | None = None) -> Column:
    """Timestamps on the days first..last, either end open, as a range on the
    stored column so that the scan can skip row groups (a date() around it
    would hide it)."""
    inside = ts.isNotNull()
    if first is not None:
        inside = inside & (ts >= wall_time(dt.datetime.combine(first, dt.time())))
    if last is not None:
        inside = inside & (ts < wall_time(dt.datetime.combine(last + dt.timedelta(days=1), dt.time())))
    return inside


CORRUPT = "_corrupt"


def _named_by_date(folder: str, prefix: str, first: dt.date, last: dt.date) -> str:
    """One glob for the files of the days first..last, by their names."""
    days = [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]
    return f"{folder}/{prefix}_{{{','.join(map(str, days))}}}.json"


def readable_records(docs: DataFrame, report: str, file: Column) -> Column:
    """The report's records of documents read with a corrupt-record column. A
    document that is cut off, or holds anything but records where the report
    should be, fails the job and is named."""
    named = F.concat(F.lit(f"unreadable {report} in "), file)
    records = docs[schemas.ENVELOPE].getField(report)
    return F.when(docs[CORRUPT].isNotNull(), F.raise_error(named)).otherwise(records)


def strict_envelope(report: str, record: T.StructType) -> T.StructType:
    return T.StructType([*envelope_type(report, record).fields, T.StructField(CORRUPT, T.StringType())])


def read_landing(
    spark: SparkSession,
    folder: str,
    prefix: str,
    report: str,
    record: T.StructType,
    first: dt.date | None = None,
    last: dt.date | None = None,
) -> DataFrame:
    """Wrapped reports from a dated landing zone, with their landing date.

    With both ends of a range only the files of its days are looked up, by
    name. Otherwise the folder is listed once, by Spark, and the date filter is
    on the file name, a per-file constant, so files outside the range are never
    opened. A file that cannot be read whole fails the job.
    """
    reader = (
        spark.read.schema(strict_envelope(report, record)).option("multiLine", True).option("columnNameOfCorruptRecord", CORRUPT)
    )
    if first is not None and last is not None:
        folder = _named_by_date(folder, prefix, first, last)
    else:
        reader = reader.option("pathGlobFilter", f"{prefix}_*.json")
    if not path_exists(spark, folder):
        return empty_report(spark, T.StructType([*record.fields, T.StructField(LANDED_ON, T.DateType())]))
    docs = reader.json(folder)
    landed = landing_date(F.col("_metadata.file_name"))
    if first is not None:
        docs = docs.filter(landed >= F.lit(first))
    if last is not None:
        docs = docs.filter(landed <= F.lit(last))
    docs = docs.withColumn(LANDED_ON, landed)
    flat = flatten(docs, readable_records(docs, report, F.col("_metadata.file_path")), record, keep=[LANDED_ON])
    return flat.select(*record.names, LANDED_ON)
