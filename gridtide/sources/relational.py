"""Thin JDBC source and sink for the relational store.

Needs the database's driver on the session's class path. Reading is split on
the table's date or hour column so that no single task pulls the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    split_on: str,
    lower: str,
    upper: str,
    parts: int = 32,
    **options: str,
) -> DataFrame:
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", split_on)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", parts)
        .option("preferTimestampNTZ", "true")
        .options(**options)
        .load()
    )


def write_table(df: DataFrame, url: str, table: str, writers: int = 8, batch_rows: int = 10_000, **options: str) -> None:
    """Replace the table's rows. The table keeps its declared column types; at
    most ``writers`` connections are open at once."""
    (
        df.write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("numPartitions", writers)
        .option("batchsize", batch_rows)
        .option("truncate", "true")
        .options(**options)
        .mode("overwrite")
        .save()
    )
