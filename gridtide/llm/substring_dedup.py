"""Repeated passages, found from difference-cover anchors.

A passage counts from ``window`` words on. Word numbers are taken modulo 13,
and short runs of words are hashed only where the remainder is in a cover of
four numbers whose differences are all remainders. Whatever two places a
repeated window stands at, there is an offset below 13 at which both are in the
cover, so both hold the same anchor there. Anchors that occur once are
therefore in no repeated window, and only windows around the others are
extended to their whole length and compared by a 96-bit hash.

Texts move once, by document, and are read twice from that shuffle; anchors
and windows move as compressed blocks (``gridtide.llm.exchange``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import whole
from gridtide.llm.exchange import Records, hash_bytes, repeated_places, unpack_places
from gridtide.llm.words import Slice, in_parts, in_slices

# A period and a cover that has every difference modulo it.
PERIOD, COVER = 13, (0, 1, 3, 9)


def _anchors(window: int):
    length = window - PERIOD + 1
    covered = np.zeros(PERIOD, dtype=bool)
    covered[list(COVER)] = True

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[Records]:
        for ids, rows, texts in in_slices(batches):
            part = Slice(ids, rows, texts)
            # A document shorter than a window has none and needs no anchor.
            docs, at = part.run_starts(length)
            places = at - part.first[docs]
            chosen = covered[places % PERIOD] & (part.counts()[docs] >= window)
            docs, at, places = docs[chosen], at[chosen], places[chosen]
            yield Records(part.ids, part.rows, docs, places, hash_bytes(part.run_hashes(at, length), None, 6))

    return records


def _windows(window: int):
    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[Records]:
        for ids, rows, texts, anchors in in_slices(batches, "places"):
            part = Slice(ids, rows, texts)
            near = np.zeros(len(part.starts) + 1, dtype=np.int64)
            for start, found in zip(part.first, anchors, strict=False):
                at = unpack_places(found)
                np.add.at(near, start + np.maximum(at - (PERIOD - 1), 0), 1)
                np.add.at(near, start + at + 1, -1)
            docs, at = part.run_starts(window)
            chosen = np.cumsum(near)[at] > 0
            docs, at = docs[chosen], at[chosen]
            hashes = hash_bytes(part.run_hashes(at, window), part.run_hashes(at, window, 1), 12)
            yield Records(part.ids, part.rows, docs, at - part.first[docs], hashes)

    return records


def _remove(window: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            n_words, n_removed, kept = [], [], []
            for text, found in zip(batch.column("_text").to_pylist(), batch.column("places").to_pylist(), strict=True):
                words = text.split()
                n_words.append(len(words))
                if found:
                    at = unpack_places(found)
                    depth = np.zeros(len(words) + 1, dtype=np.int64)
                    depth[at] += 1
                    np.add.at(depth, at + window, -1)
                    stays = np.cumsum(depth)[:-1] == 0
                    words = list(compress(words, stays))
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            out = {
                "_id": batch.column("_id"),
                "_row": batch.column("_row"),
                "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "text": pa.array(kept, pa.binary()).cast(pa.string()),
                "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
            }
            yield pa.RecordBatch.from_pydict(out)

    return rows


def substring_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 20) -> DataFrame:
    """Per row: ``key``, ``n_words``, ``n_removed``, ``text`` (the words that
    stay, joined by one space) and ``kept_sha256`` of that text.

    Words stand between ASCII white space. A word goes if a window of
    ``window`` words that covers it also starts earlier: in a smaller id, or in
    the same document before. Null counts as empty and has no words. Ids are
    whole numbers; rows without an id come last in order. Rows alike in id and
    text are one document, are no repeats of each other and are treated alike;
    different texts under one id are ordered among themselves by a hash. A
    document's own words are in one task. Other columns are ignored.
    """
    if window <= PERIOD:
        raise ValueError(f"window must be over {PERIOD} words, not {window}")
    last = (1 << 63) - 1
    rows = docs.select(
        F.coalesce(F.col(key).cast("bigint"), F.lit(last)).alias("_id"),
        F.xxhash64(F.col(key), whole(text)).alias("_row"),
        whole(text).cast("binary").alias("_text"),
    )
    text_bytes = rows.agg(F.sum(F.octet_length("_text").cast("bigint"))).first()[0] or 0
    anchors = repeated_places(rows, _anchors(window), False, text_bytes)
    # Both joins read the same shuffle of the texts.
    matched = (rows["_id"] == F.col("_at_id")) & (rows["_row"] == F.col("_at_row"))
    suspects = rows.hint("shuffle_merge").join(anchors, matched).select("_id", "_row", "_text", "places")
    later = repeated_places(suspects, _windows(window), True, text_bytes)
    marked = rows.hint("shuffle_merge").join(later, matched, "left").select("_id", "_row", "_text", "places")
    schema = "_id bigint, _row bigint, n_words bigint, n_removed bigint, text string, kept_sha256 string"
    done = marked.mapInArrow(_remove(window), schema)
    return done.select(F.nullif("_id", F.lit(last)).alias(key), "n_words", "n_removed", "text", "kept_sha256")
