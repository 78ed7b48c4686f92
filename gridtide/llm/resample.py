"""Drawing documents that look like a target, by importance weights.

Every run of one to three words is a feature, hashed into a fixed number of
buckets. A bucket's gain is the log ratio of its smoothed shares in the target
and in the corpus; a document's weight is the sum over its features, scored in
arrays of one slice of documents at a time. A bit of Gumbel noise, fixed by the
id, turns the greatest scores into a draw without replacement.

Ranks come from a distributed radix sort, least digit first. Rows stand at
places, dealt to blocks of equal length. A pass counts each block's rows per
digit, adds the counts up over the blocks of a digit and over the digits, and
sends every row to the place after those that come before it: a stable counting
sort, in which the greatest group is a block. Only rows that can still be drawn
are sorted: a histogram of scores tells from which score on.

Each pass is a written table, so a lost executor repeats one pass at most.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtide.llm.common import keep_table, shuffle_width, whole

# The bytes of a word, A-Z in lower case; all others part words.
WORD = bytes(b | 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
# How many rows a block of the sort has at most, and what a digit holds.
BLOCK_ROWS, DIGIT_BITS = 1 << 18, 12
SLICE_WORDS, HISTOGRAM = 1 << 18, 4096


def _append_tables(sizes: int) -> np.ndarray:
    """What appending n zero bytes does to a crc32, for n below ``sizes``: four
    tables of a byte each."""
    bits = np.array([zlib.crc32(b"\0", 1 << i) ^ zlib.crc32(b"\0", 0) for i in range(32)], dtype=np.uint32)

    def apply(values: np.ndarray) -> np.ndarray:
        out = np.zeros_like(values)
        for i in range(32):
            out ^= np.where((values >> np.uint32(i)) & np.uint32(1), bits[i], np.uint32(0))
        return out

    byte = np.arange(256, dtype=np.uint32)
    tables = [np.stack([byte << np.uint32(8 * k) for k in range(4)])]
    while len(tables) < sizes:
        tables.append(apply(tables[-1]))
    return np.stack(tables)


APPEND = _append_tables(129)
SPACE = np.uint32(zlib.crc32(b" "))


def _moved(crc: np.ndarray, table: np.ndarray, size: np.ndarray) -> np.ndarray:
    return (
        table[size, 0, crc & 255] ^ table[size, 1, (crc >> np.uint32(8)) & 255]
        ^ table[size, 2, (crc >> np.uint32(16)) & 255] ^ table[size, 3, crc >> np.uint32(24)]
    )


def joined_crc(first: np.ndarray, second: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The crc32 of first + " " + second, from theirs and the second's length."""
    longest = len(APPEND) - 1
    crc = _moved(_moved(first, APPEND, np.ones_like(size)) ^ SPACE, APPEND, np.minimum(size, longest))
    rest = np.flatnonzero(size > longest)
    left = size[rest] - longest
    while len(rest):  # words of over 128 bytes
        step = np.minimum(left, longest)
        crc[rest] = _moved(crc[rest], APPEND, step)
        rest, left = rest[left > step], (left - step)[left > step]
    return crc ^ second


def feature_buckets(words: list[bytes], buckets: int) -> list[np.ndarray]:
    """Buckets of all runs of one, two and three words, by the run's start."""
    one = np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words))
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    two = joined_crc(one[:-1], one[1:], size[1:])
    three = joined_crc(two[:-1], one[2:], size[2:])
    return [(c % np.uint32(buckets)).astype(np.int64) for c in (one, two, three)]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[int], list[bytes]]]:
    """Ids, numbers of words and all words of a bounded number of words; a
    longer document is a slice of its own."""
    ids, counts, words = [], [], []
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            own = text.as_py().translate(WORD).split()
            if ids and len(words) + len(own) > SLICE_WORDS:
                yield ids, counts, words
                ids, counts, words = [], [], []
            ids.append(key)
            counts.append(len(own))
            words += own
    if ids:
        yield ids, counts, words


def _inside(counts: list[int], length: int, n_words: int) -> np.ndarray:
    """Which runs of that many words end in the document they start in."""
    ends = np.repeat(np.cumsum(counts), counts)
    starts = np.arange(max(0, n_words - length + 1))
    return starts + length <= ends[: len(starts)]


def _counting(buckets: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for _, counts, words in _slices(batches):
            for length, found in enumerate(feature_buckets(words, buckets), 1):
                total += np.bincount(found[_inside(counts, length, len(words))], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return rows


def _weighing(buckets: int, gains: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, counts, words in _slices(batches):
            bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
            weight, n = np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids), dtype=np.int64)
            for length, found in enumerate(feature_buckets(words, buckets), 1):
                inside = _inside(counts, length, len(words))
                for total, values in ((weight, np.where(inside, gains[found], 0)), (n, inside)):
                    up_to = np.concatenate([[0], np.cumsum(values, dtype=np.int64), np.zeros(len(words) - len(values), dtype=np.int64)])
                    up_to[len(values) + 1 :] = up_to[len(values)]
                    total += np.diff(up_to[bounds])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(n), pa.array(weight)],
                names=["_id", "n_words", "n_features", "weight"],
            )

    return rows


def bucket_counts(rows: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket, over all rows: a number for each bucket reaches the
    driver, however many rows there are."""
    counts = np.zeros(buckets, dtype=np.int64)
    for row in rows.mapInArrow(_counting(buckets), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    s, t, n = int(corpus.sum()), int(target.sum()), len(corpus)
    ratios = [(float((int(y) + 1) * (s + n)) / float((int(x) + 1) * (t + n))) for x, y in zip(corpus, target, strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], dtype=np.int64)


def _noise(key: Column, seed: int) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(uniform))).cast("bigint")


def _pass(rows: DataFrame, digit: Column, per_block: int) -> DataFrame:
    """One stable counting sort by a digit. Rows have a ``place`` each, and
    take ``copies`` places from there on."""
    rows = rows.withColumn("block", F.floor(F.col("place") / per_block)).withColumn("digit", digit)
    counts = rows.groupBy("digit", "block").agg(F.sum("copies").alias("n"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    blocks = before.partitionBy("digit").orderBy("block")
    counts = counts.select("digit", "block", F.coalesce(F.sum("n").over(blocks), F.lit(0)).alias("earlier_blocks"), "n")
    # One row for each value of a digit, so this window is as small as the radix.
    digits = counts.groupBy("digit").agg(F.sum("n").alias("n"))
    digits = digits.select("digit", F.coalesce(F.sum("n").over(before.orderBy("digit")), F.lit(0)).alias("lesser_digits"))
    offsets = counts.drop("n").join(F.broadcast(digits), "digit")
    inside = F.coalesce(F.sum("copies").over(before.partitionBy("digit", "block").orderBy("place")), F.lit(0))
    dealt = rows.withColumn("inside", inside).join(offsets, ["digit", "block"])
    place = F.col("lesser_digits") + F.col("earlier_blocks") + F.col("inside")
    return dealt.withColumn("place", place.cast("bigint")).drop("digit", "block", "inside", "lesser_digits", "earlier_blocks")


def radix_ranks(
    rows: DataFrame, keys: list[str], ties: list[str], copies: str = "copies", block_rows: int = BLOCK_ROWS, bits: int = DIGIT_BITS
) -> DataFrame:
    """The rows with ``place``, from 0 on, in ascending order of whole-number
    ``keys``, the first of them the most important; a row takes as many places
    as ``copies`` says. A digit is ``bits`` bits of a key's distance from its
    least value; only digits that some row has are sorted by. Rows alike in all
    keys, which have to be few, stand in the order of ``ties``."""
    ends = rows.agg(F.sum(copies).alias("all"), *[f(k).alias(f"{f.__name__}_{k}") for k in keys for f in (F.min, F.max)]).first()
    if not ends["all"]:
        return rows.withColumn("place", F.lit(None).cast("bigint"))
    blocks = max(shuffle_width(rows.sparkSession), -(-ends["all"] // block_rows))
    per_block = -(-ends["all"] // blocks)
    # Any order that keeps ties will do to begin with: blocks by a hash of the
    # keys, one after another (a row per block goes into their running total).
    start = rows.withColumn("block", F.pmod(F.xxhash64(*keys), F.lit(blocks)))
    sizes = start.groupBy("block").agg(F.sum(copies).alias("n"))
    offsets = sizes.select("block", (F.sum("n").over(Window.orderBy("block")) - F.col("n")).alias("offset"))
    inside = Window.partitionBy("block").orderBy(*keys, *ties).rowsBetween(Window.unboundedPreceding, -1)
    start = start.withColumn("inside", F.coalesce(F.sum(copies).over(inside), F.lit(0))).join(offsets, "block")
    placed = start.withColumn("place", (F.col("inside") + F.col("offset")).cast("bigint")).drop("inside", "block", "offset")
    placed = keep_table(placed, "radix")
    for key in reversed(keys):
        least, most = ends[f"min_{key}"], ends[f"max_{key}"]
        distance = F.col(key).cast("decimal(20,0)") - F.lit(least).cast("decimal(20,0)")
        for shift in range(0, (most - least).bit_length(), bits):
            digit = F.pmod(F.call_function("div", distance, F.lit(1 << shift).cast("decimal(20,0)")), F.lit(1 << bits)).cast("int")
            placed = keep_table(_pass(placed, digit, per_block), "radix")
    return placed


def _from_score(eligible: DataFrame, drawn: int) -> int | None:
    """A score that at least ``drawn`` rows reach and few more: the start of a
    bar of a histogram of a fixed number of bars."""
    ends = eligible.agg(F.min("score").alias("least"), F.max("score").alias("most")).first()
    if ends["least"] is None or not drawn:
        return None
    width = (ends["most"] - ends["least"]) // HISTOGRAM + 1
    bar = F.floor((F.col("score") - F.lit(ends["least"])) / width).cast("bigint").alias("bar")
    reached = 0
    for row in sorted(eligible.groupBy(bar).agg(F.sum("copies").alias("n")).collect(), key=lambda r: -r["bar"]):
        reached += row["n"]
        if reached >= drawn:
            return ends["least"] + row["bar"] * width
    return ends["least"]


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 5,
    min_words: int = 20, buckets: int = 10_000, seed: int = 42,
) -> DataFrame:
    """Per row: ``key``, ``n_features``, ``weight``, ``score`` and ``rank``.

    Words are runs of a-z (A-Z in lower case), 0-9 and characters beyond ASCII,
    features all runs of one to three of them, with repeats. ``weight`` is the
    sum of the gains of a row's features, each rounded down to thousandths,
    ``score`` that and the noise of the id under ``seed``. Of the N rows with
    at least ``min_words`` words the floor(percent N / 100) greatest scores are
    drawn, equal ones by the smaller id (rows without one last), and ranked
    from 1; the others have a null rank. ``target`` has a column of the same
    name as ``text``.

    A null text has no words, a row without features weighs 0. Ids are whole
    numbers, and the noise of a row without one is that of the empty text.
    Repeated rows are drawn one by one, as rows of equal score. Without a
    target, or without rows, gains follow from counts of 0. Other columns are
    ignored. The driver sees one number for each bucket and bar, never rows.
    """
    texts = whole(text).cast("binary").alias("_text")
    rows = docs.select(F.col(key).cast("bigint").alias("_id"), texts)
    named = target.select(F.lit(0).cast("bigint").alias("_id"), texts)
    gains = bucket_gains(bucket_counts(rows, buckets), bucket_counts(named, buckets))
    weighed = rows.mapInArrow(_weighing(buckets, gains), "_id bigint, n_words bigint, n_features bigint, weight bigint")
    # Rows of one input partition that are alike in all of these are one row of
    # several copies until the end.
    alike = ["_id", "n_features", "weight", "score", "eligible", "part"]
    scored = weighed.select(
        "*", (F.col("weight") + _noise(F.col("_id"), seed)).alias("score"), (F.col("n_words") >= min_words).alias("eligible"), F.spark_partition_id().alias("part")
    )
    scored = keep_table(scored.groupBy(*alike).agg(F.count("*").alias("copies")), "scored")
    eligible = scored.filter("eligible")
    drawn = (eligible.agg(F.sum("copies")).first()[0] or 0) * percent // 100
    lowest = _from_score(eligible, drawn)
    chosen = eligible.filter(F.lit(False) if lowest is None else F.col("score") >= lowest)
    chosen = chosen.select(
        "_id", "n_features", "weight", "part", "copies", (-F.col("score")).alias("down"),
        F.col("_id").isNull().cast("int").alias("nameless"), F.coalesce("_id", F.lit(0)).alias("up"),
    )
    placed = radix_ranks(chosen, ["down", "nameless", "up"], ["n_features", "part"]).filter(F.col("place") < drawn)
    names = ["_id", "n_features", "weight", "part"]
    placed = placed.select(*[F.col(c).alias(f"at_{c}") for c in names], "place")
    same = scored["eligible"]
    for c in names:
        same = same & scored[c].eqNullSafe(placed[f"at_{c}"])
    each = scored.join(placed, same, "left").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    rank = F.col("place") + F.col("copy")
    return each.select(F.col("_id").alias(key), "n_features", "weight", "score", F.when(rank <= drawn, rank).alias("rank"))
