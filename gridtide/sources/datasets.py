"""Parquet datasets: the hand-over between cleaning and loading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def on_file_system(spark: SparkSession, path: str):
    """The path, and the file system it is on, as Hadoop objects."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """What a glob stands for. The driver lists it: keep it to folders whose
    number the calendar bounds."""
    path, files = on_file_system(spark, pattern)
    return [str(status.getPath().toString()) for status in (files.globStatus(path) or [])]


def empty_files(spark: SparkSession, pattern: str) -> list[str]:
    """The files a glob stands for that hold nothing; Spark's readers skip
    them without a word."""
    path, files = on_file_system(spark, pattern)
    return [str(s.getPath().toString()) for s in (files.globStatus(path) or []) if s.isFile() and s.getLen() == 0]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or anything a glob stands for, exists on its file system."""
    if not any(c in path for c in "*?{["):
        hadoop_path, files = on_file_system(spark, path)
        return files.exists(hadoop_path)
    return bool(matching(spark, path))


def remove(spark: SparkSession, path: str) -> None:
    hadoop_path, files = on_file_system(spark, path)
    files.delete(hadoop_path, True)


def _move(spark: SparkSession, path: str, target: str) -> None:
    source, files = on_file_system(spark, path)
    if not files.rename(source, on_file_system(spark, target)[0]):
        raise OSError(f"could not move {path} to {target}")


def replace(spark: SparkSession, path: str, target: str) -> None:
    """Put a written dataset in the place of another one, which is moved aside
    and removed last. Whenever this stops half way, ``read_dataset`` finds the
    old dataset or the new one, and repeating the job brings the new one."""
    old = f"{target}.old"
    if path_exists(spark, target):
        # Left over if an earlier replacement stopped before its last step.
        remove(spark, old)
        _move(spark, target, old)
    _move(spark, path, target)
    remove(spark, old)


def write_dataset(df: DataFrame, path: str, partition_by: str | None = None, sort_by: Sequence[str] = ()) -> int:
    """Replace a dataset and return how many rows went in, counted while they
    were written. Never point this at a path the frame itself reads.

    With ``partition_by`` rows are first rebalanced on it: small partitions end
    up in one file each, and a large one is split over several tasks. Rows are
    sorted on ``sort_by`` within a file, so that a later scan can skip.
    """
    if partition_by:
        df = df.hint("rebalance", partition_by).sortWithinPartitions(partition_by, *sort_by)
    # Counted last: below the sort an empty input would drop out of the plan,
    # and the count with it.
    seen = Observation()
    writer = df.observe(seen, F.count("*").alias("n_rows")).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return seen.get["n_rows"]


def read_dataset(spark: SparkSession, path: str) -> DataFrame | None:
    """A dataset, or None if there is none at the path. One that a replacement
    had moved aside when it stopped still counts."""
    for place in (path, f"{path}.old"):
        if path_exists(spark, place):
            return spark.read.parquet(place)
    return None
