"""From raw documents to token ids, in five stages.

Each stage takes (spark, documents, folder of tables) and returns documents
with the same columns; each is written and read again before the next one
starts. All work on whole tables and on everything the stage before has kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.llm import bpe, decontaminate, line_dedup, ngram_join, quality
from gridtide.llm.common import keep_table, table, whole
from gridtide.llm.queries import held_out


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def without(docs: DataFrame, decided: DataFrame, row: Column) -> DataFrame:
    """Documents but for those of ``decided`` (doc_id, decided_row). A row is
    known by its id and a hash of its text, and null ids match each other."""
    gone = decided.select(F.col("doc_id").alias("decided_id"), "decided_row").distinct()
    rows = docs.withColumn("own_row", row)
    return rows.join(gone, rows["doc_id"].eqNullSafe(gone["decided_id"]) & (rows["own_row"] == gone["decided_row"]), "left_anti").select(*COLUMNS)


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality score rejects go; none do where the labels
    are too few to learn from."""
    labels = table(spark, sf_dir, "labels").filter(~held_out())
    scored = quality.score_quality(docs, labels, row="decided_row")
    return without(docs, scored.filter("learnt AND predicted = 0"), F.xxhash64("doc_id", whole("text")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share go, and lengths are brought up to date."""
    cleaned = line_dedup.line_dedup(docs)
    return cleaned.select("doc_id", "text", "lang", "source", F.char_length("text").cast("bigint").alias("n_chars"))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id stays of each group of near duplicates,
    one without an id only if none has one, and one row of those alike in id
    and text. Each text under an id is a document of its own."""
    rows = docs.withColumn("row", F.xxhash64("doc_id", whole("text")))
    grouped = ngram_join.ngram_join(rows, key="row").select("row", "component_id")
    named = rows.select("row", "doc_id").distinct().join(grouped, "row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row"))
    stay = named.groupBy("component_id").agg(first.alias("first")).select(F.col("first.row").alias("row"))
    return rows.join(stay, "row", "left_semi").dropDuplicates(["row"]).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"), row="decided_row")
    return without(docs, found.filter("contaminated"), F.xxhash64(whole("text")))


def to_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids with their digest, and the digest of what they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    # Written in between, so that a task needs one Python worker at a time.
    encoded = keep_table(bpe.encode(docs, path, public_tokenizers.PATTERN), "token-ids")
    decoded = bpe.decode(encoded, path)
    return decoded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "ids",
    )


STAGES = [
    ("quality classifier", keep_good_quality),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE encoding and decoding", to_token_ids),
]

#: The quality score, the join's components and the merges are beyond SQL; the
#: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
