"""What the text operators share: letters, row identity, hand-over tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.session import shared_folder

# The letters that are lower-cased and the white space that parts words.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = " \t\n\x0b\x0c\r"

ID, ROW = "_id", "_row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and every other character as it is. Texts of one byte
    per character take the short way, as nothing else in them has a case."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Only id, row identity and text, under names no input column can clash
    with. Rows with the same id and the same text are one row to an operator,
    and an id that stands on different texts stands for different rows."""
    return docs.select(F.col(key).alias(ID), F.xxhash64(whole(text)).alias(ROW), whole(text).alias("_text"))


def same_row(left: DataFrame, right: DataFrame) -> Column:
    """Join condition on the row identity; null ids match each other."""
    return left[ID].eqNullSafe(right[ID]) & (left[ROW] == right[ROW])


def keep_table(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the folder all executors share and read it back: cuts
    lineage, and what it holds survives the loss of any executor."""
    path = shared_folder(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    """How many partitions the session deals a shuffle to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
