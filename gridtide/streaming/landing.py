"""Picking up newly landed report files.

The scheduled load as a stream: each run takes the files that arrived since
the last one, cleans them and upserts them. Which report of an hour counts does
not depend on how files fall into micro-batches: the one with the newest
landing date does. What date an hour was last written from is a table of the
store, published in one commit with the hour itself, and rows of older files
that arrive later are left out. A batch reads the dates of its own days only.
Wherever a run stops, hours and dates agree; a micro-batch replayed after a
failure writes the same values again, with a new time of change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridtide.plans.feeds import Feed
from gridtide.sources import reports, tables


def landed_reports(spark: SparkSession, folder: str, feed: Feed, files_per_batch: int = 1000) -> DataFrame:
    """Raw rows of newly landed files, with the date in the file's name. A file
    that cannot be read whole fails the stream and is named."""
    docs = (
        spark.readStream.schema(reports.strict_envelope(feed.report, feed.record))
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", reports.CORRUPT)
        .option("pathGlobFilter", f"{feed.landing_prefix}_*.json")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(folder)
        .withColumn(reports.LANDED_ON, reports.landing_date(F.col("_metadata.file_name")))
    )
    records = reports.readable_records(docs, feed.report, F.col("_metadata.file_path"))
    return reports.flatten(docs, records, feed.record, keep=[reports.LANDED_ON])


def follow(
    spark: SparkSession, folder: str, feed: Feed, store: str, checkpoint: str, deltas: bool = False, **kwargs
) -> StreamingQuery:
    """Load everything that has landed and not been loaded yet, then stop.

    Of all files that report an hour the one with the newest landing date wins,
    in whatever order and batches they come. ``checkpoint`` has to be on
    storage that outlives the cluster. With ``deltas`` a batch writes its own
    rows only, see ``gridtide.sources.tables``.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        # Read for its dates, merged, and written as marks, so keep it rather than parse again.
        cleaned = feed.by_utc_hour(batch, keep=[], prefer=[reports.LANDED_ON], with_preferred=True).persist()
        try:
            tables.MarketStore(batch.sparkSession, store, deltas=deltas).load_landed(feed.table, cleaned)
        finally:
            cleaned.unpersist()

    return (
        landed_reports(spark, folder, feed, **kwargs)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
