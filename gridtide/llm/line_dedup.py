"""Lines that many documents share.

Lines are exploded with their positions and known by a 128-bit hash of their
key (stripped, A-Z in lower case). Documents per key are counted with partial
aggregates on (key, document), so a line that stands in a third of all
documents is combined before it meets in one task. Only the keys that are over
the threshold go back to the lines, each to ``SALTS`` tasks that share its
lines by document, and only positions come out of that join: texts move once,
to meet their document's dropped positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import ID, ROW, SPACE, ascii_lower, identified

SALTS = 32


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def repeated_lines(rows: DataFrame, min_docs: int, min_chars: int) -> DataFrame:
    """Row identity and positions of the lines to drop."""
    lines = (
        rows.select(ID, ROW, F.posexplode(_lines(ascii_lower(F.col("_text")))).alias("pos", "line"))
        .withColumn("line", F.btrim("line", F.lit(SPACE)))
        .filter(F.char_length("line") >= min_chars)
        .select(ID, ROW, "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))
    )
    shared = (
        lines.groupBy("h1", "h2")
        .agg(F.count_distinct(ID).alias("docs"), F.max(ID).alias("keeper"))
        .filter(F.col("docs") >= min_docs)
        .select("h1", "h2", "keeper", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    return (
        lines.withColumn("salt", F.pmod(F.hash(ID, ROW), F.lit(SALTS)))
        .join(shared, ["h1", "h2", "salt"])
        .filter(~F.col(ID).eqNullSafe(F.col("keeper")))
        .groupBy(ID, ROW)
        .agg(F.collect_set("pos").alias("dropped"))
    )


def line_dedup(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = 3, min_chars: int = 20
) -> DataFrame:
    """The documents, all columns as they were but for ``text``, and the new
    columns ``n_lines`` and ``n_dropped`` (which replace columns of that name).

    Keys of at least ``min_chars`` characters found in at least ``min_docs``
    documents lose all their lines, except in the largest id that holds them,
    which keeps each of its own. A null text is one empty line and comes back
    empty. Rows without an id count as no document and lose every shared line.
    Repeated rows count once. Row order is not kept; line order is.
    """
    dropped = repeated_lines(identified(docs, key, text), min_docs, min_chars)
    # One struct holds the input, so no column of it can clash with ours.
    own = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_in"))
    source = F.coalesce(F.col("_in")[text].cast("string"), F.lit(""))
    own = own.select("_in", F.col("_in")[key].alias("_in_id"), F.xxhash64(source).alias("_in_row"))
    joined = own.join(
        dropped, own["_in_id"].eqNullSafe(dropped[ID]) & (own["_in_row"] == dropped[ROW]), "left"
    ).withColumn("_lines", F.when(F.col("dropped").isNotNull(), _lines(source)))
    size = F.size(F.coalesce(F.col("_lines"), _lines(source)))
    # array_except hashes: linear in the number of lines however many go.
    places = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("dropped"))
    left = F.array_join(F.transform(places, lambda i: F.get(F.col("_lines"), i)), "\n")
    kept = F.when(F.col("dropped").isNull(), source).otherwise(left)
    return joined.select(
        *[(kept if c == text else F.col("_in")[c]).alias(c) for c in docs.columns if c not in ("n_lines", "n_dropped")],
        size.cast("bigint").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )
