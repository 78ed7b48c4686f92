"""Exact duplicates by a tree merge of digest runs.

Every text is reduced to its SHA-256 digest. Rows are dealt into runs by their
id, and runs are merged in rounds: each round, ``fan_in`` neighbouring runs
exchange entries by (merged run, digest), and equal digests become one entry
with the verified best id and the number of rows behind it. After the last
round one run, spread over all tasks by digest, holds one entry per text. The
answer then goes down the same tree: to the entries of the first runs, and from
there to the rows, so that no key of any join holds more than a run's share of
a group of copies.

Every entry carries a second, independent hash of its text. Two texts that
agree in the digest and not in that hash fail the job at the round they meet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import ascii_lower, keep_table, shuffle_width, whole


def _merged(runs: DataFrame, keys: list[str], keep: str) -> DataFrame:
    best = F.max("best") if keep == "largest" else F.min("best")
    merged = runs.groupBy(*keys).agg(
        best.alias("best"), F.sum("rows").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    differs = F.raise_error(F.lit("two texts share a digest"))
    return merged.withColumn("low", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(differs.cast("bigint")))


def exact_dedup(
    docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "smallest", fan_in: int = 8
) -> DataFrame:
    """Per row: ``key``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are identical after lower-casing A-Z; null counts
    as empty, and so do empty texts, which form one group. Of equal texts the
    smallest (or largest) id stays. Rows without an id count as members, are
    kept only if their whole group has no id, and an id that occurs more than
    once is kept or dropped as one. Other columns are ignored.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be 'smallest' or 'largest', not {keep!r}")
    spark = docs.sparkSession
    rounds = 1
    while fan_in**rounds < shuffle_width(spark):
        rounds += 1
    normal = docs.select(F.col(key).alias("id"), ascii_lower(whole(text)).alias("norm"))
    rows = keep_table(
        normal.select(
            "id",
            F.pmod(F.xxhash64("id", F.hash("norm")), F.lit(fan_in**rounds)).cast("int").alias("run"),
            F.unhex(F.sha2("norm", 256)).alias("digest"),
            F.xxhash64("norm", F.char_length("norm")).alias("check"),
        ),
        "digests",
    )
    entries = rows.select("run", "digest", F.col("id").alias("best"), F.lit(1).cast("bigint").alias("rows"),
                          F.col("check").alias("low"), F.col("check").alias("high"))
    first = runs = _merged(entries, ["run", "digest"], keep)
    for _ in range(rounds):
        exchanged = runs.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
        runs = _merged(exchanged, ["run", "digest"], keep)
    top = runs.select("digest", F.col("best").alias("keep_id"), F.col("rows").alias("group_size"))
    down = first.select("run", "digest").join(top, "digest")
    return rows.join(down, ["run", "digest"]).select(
        F.col("id").alias(key),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows that stay, with all their columns."""
    kept = exact_dedup(docs, key, text, keep).filter("kept").select(F.col(key).alias("_kept_id")).distinct()
    return docs.join(kept, docs[key].eqNullSafe(kept["_kept_id"]), "left_semi")
