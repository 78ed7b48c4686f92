"""One large report document over several tasks.

A report is an array of flat records, so every record ends at a closing brace.
Read as text with that brace as the separator, a document splits like any
text file: each task takes a byte range and the records that start in it. What
stands around a record tells whether the document is what it should be: one
opening (the envelope, the report's name, or a bare list), commas between
records, one end of the list. Anything else fails the job and names the file.

Documents of usual size are better read whole, see ``gridtide.sources.reports``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide import schemas
from gridtide.sources.datasets import empty_files, path_exists
from gridtide.sources.reports import CORRUPT, LANDED_ON, empty_report, landing_date

FILE, KIND = "_file", "_kind"
# What a piece of a document is.
FIRST, NEXT, END, NOTHING, BLANK = "first", "next", "end", "nothing", "blank"


def _kind(piece: Column, report: str) -> Column:
    name = re.escape(report).replace("\\ ", " ")
    opening = rf'^\s*(?:(?:\{{\s*"{schemas.ENVELOPE}"\s*:\s*)?\{{\s*"{name}"\s*:\s*)?\['
    record = r"\s*\{[^{}]*$"
    return (
        F.when(piece.rlike(r"^\s*," + record), NEXT)
        .when(piece.rlike(r"^\s*$"), BLANK)
        .when(piece.rlike(r"^\s*\]\s*$"), END)
        .when(piece.rlike(opening + record), FIRST)
        .when(piece.rlike(opening + r"\s*\]\s*$"), NOTHING)
    )


def _check(pieces: DataFrame, paths: list[str], report: str) -> None:
    """Fail unless each file has one opening, one end, and nothing unknown. A
    row per faulty file is asked for, and a few come to the driver."""
    # A file without a byte has no piece that could tell.
    empty = [file for path in paths for file in empty_files(pieces.sparkSession, path)]
    count = lambda *kinds: F.count_if(F.col(KIND).isin(*kinds))
    per_file = pieces.groupBy(FILE).agg(
        count(FIRST, NOTHING).alias("openings"), count(END, NOTHING).alias("ends"), F.count_if(F.col(KIND).isNull()).alias("unknown")
    )
    faulty = empty or [r[FILE] for r in per_file.filter("openings <> 1 OR ends <> 1 OR unknown > 0").take(5)]
    if faulty:
        raise ValueError(f"unreadable {report} in {', '.join(sorted(faulty[:5]))}")


def read_large_reports(spark: SparkSession, path: str | list[str], report: str, record: T.StructType) -> DataFrame:
    """Rows of documents that hold one report and nothing else, under the
    envelope, under the report's name, or as a bare list, with their landing
    date (by the file's name). Paths that match nothing give an empty report.

    A document is read twice, once to check it and once for its records. Texts
    with braces in them cannot be told from records and fail the job.
    """
    paths = [p for p in ([path] if isinstance(path, str) else path) if path_exists(spark, p)]
    if not paths:
        return empty_report(spark, T.StructType([*record.fields, T.StructField(LANDED_ON, T.DateType())]))
    texts = spark.read.option("lineSep", "}").text(paths)
    landed = landing_date(F.col("_metadata.file_name"))
    pieces = texts.select("value", F.col("_metadata.file_path").alias(FILE), landed.alias(LANDED_ON), _kind(F.col("value"), report).alias(KIND))
    _check(pieces, paths, report)
    with_corrupt = T.StructType([*record.fields, T.StructField(CORRUPT, T.StringType())])
    text = F.concat(F.regexp_extract("value", r"\{[^{}]*$", 0), F.lit("}"))
    parsed = F.from_json(text, with_corrupt, {"columnNameOfCorruptRecord": CORRUPT})
    rows = pieces.filter(F.col(KIND).isin(FIRST, NEXT)).select(LANDED_ON, FILE, parsed.alias("_record"))
    failed = F.raise_error(F.concat(F.lit(f"unreadable {report} in "), F.col(FILE)))
    whole = F.when(F.col("_record").getField(CORRUPT).isNotNull(), failed).otherwise(F.col("_record"))
    rows = rows.select(LANDED_ON, whole.alias("_record"))
    return rows.select(*[F.col("_record").getField(f).alias(f) for f in record.names], LANDED_ON)
