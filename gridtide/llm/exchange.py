"""Which runs of words occur more than once, over all documents.

A record says that a hash occurs at a place (document and word number). Each
slice of documents packs its records into one compressed block per bucket of
the hash space. A hash that a slice holds several times is settled there: one
record of it travels, and the other places are reported at once. So a passage
that a third of all documents share sends one record per slice, not one per
document. The number of buckets follows from the bytes of the texts, not from
the session, and a bucket answers with one row per document it knows of.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("block", T.BinaryType())])
PLACES = T.StructType(
    [
        T.StructField("_at_id", T.LongType()),
        T.StructField("_at_row", T.LongType()),
        T.StructField("places", T.BinaryType()),
    ]
)
PLACES_ARROW = pa.schema([("_at_id", pa.int64()), ("_at_row", pa.int64()), ("places", pa.binary())])
# What a bucket of hashes stands for, some hundred thousand records, and how many there are at least.
BUCKET_BYTES, BUCKETS = 16 << 20, 64


class Records:
    """Documents with their places and, unless they are settled, the hashes
    there as rows of bytes. Places of a document stand together."""

    def __init__(self, ids, rows, docs, places, hashes=None):
        self.ids, self.rows, self.docs, self.places, self.hashes = ids, rows, docs, places, hashes

    def pick(self, which: np.ndarray) -> Records:
        docs, places = self.docs[which], self.places[which]
        used, docs = np.unique(docs, return_inverse=True)
        hashes = None if self.hashes is None else self.hashes[which]
        return Records(self.ids[used], self.rows[used], docs, places, hashes)

    def pack(self) -> bytes:
        width = 0 if self.hashes is None else self.hashes.shape[1]
        head = np.array([len(self.ids), len(self.docs), width], dtype=np.int64)
        parts = [head, self.ids, self.rows, np.diff(self.docs, prepend=0).astype(np.int32),
                 np.diff(self.places, prepend=0).astype(np.int32)]
        raw = b"".join(p.tobytes() for p in parts) + (b"" if width == 0 else np.ascontiguousarray(self.hashes).tobytes())
        return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)

    @staticmethod
    def unpack(block: bytes) -> Records:
        raw = pa.Codec("zstd").decompress(block[8:], int.from_bytes(block[:8], "little"), asbytes=True)
        n_docs, n, width = np.frombuffer(raw, dtype=np.int64, count=3)
        at = 24

        def take(dtype, count):
            nonlocal at
            found = np.frombuffer(raw, dtype=dtype, count=count, offset=at)
            at += found.nbytes
            return found

        ids, rows = take(np.int64, n_docs), take(np.int64, n_docs)
        docs, places = np.cumsum(take(np.int32, n), dtype=np.int64), np.cumsum(take(np.int32, n), dtype=np.int64)
        return Records(ids, rows, docs, places, take(np.uint8, n * width).reshape(n, width) if width else None)

    @staticmethod
    def joined(parts: list[Records]) -> Records:
        shift = np.cumsum([0, *[len(p.ids) for p in parts[:-1]]])
        return Records(
            np.concatenate([p.ids for p in parts]),
            np.concatenate([p.rows for p in parts]),
            np.concatenate([p.docs + s for p, s in zip(parts, shift, strict=True)]),
            np.concatenate([p.places for p in parts]),
            None if parts[0].hashes is None else np.concatenate([p.hashes for p in parts]),
        )


def hash_bytes(h1: np.ndarray, h2: np.ndarray | None, width: int) -> np.ndarray:
    """The first bytes of one or two 64-bit hashes, a row for each."""
    both = np.ascontiguousarray(h1)[:, None] if h2 is None else np.stack([h1, h2], axis=1)
    return np.ascontiguousarray(both).view(np.uint8).reshape(len(h1), 8 * both.shape[1])[:, :width]


def _keys(hashes: np.ndarray) -> np.ndarray:
    """Rows of bytes as one sortable value each."""
    padded = np.zeros((len(hashes), 8 if hashes.shape[1] <= 8 else 16), dtype=np.uint8)
    padded[:, : hashes.shape[1]] = hashes
    if padded.shape[1] == 8:
        return padded.view(np.uint64)[:, 0]
    return padded.view([("a", "<u8"), ("b", "<u8")])[:, 0]


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order by key, and where in it each group starts."""
    if keys.dtype.names:
        order = np.lexsort((keys["b"], keys["a"]))
        a, b = keys["a"][order], keys["b"][order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    else:
        order = np.argsort(keys, kind="stable")
        sorted_keys = keys[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    return order, new


def settle(records: Records, repeats_only_later: bool) -> tuple[np.ndarray, np.ndarray]:
    """(representatives, repeats), as record numbers. Records stand in document
    order, so a group's first record is its earliest; it is a repeat only if
    all members of a repeated group are asked for."""
    order, new = _grouped(_keys(records.hashes))
    repeat = ~new
    if not repeats_only_later:
        repeat[:-1] |= ~new[1:]
    return order[new], order[repeat]


def blocks(records: Records, buckets: int, repeats_only_later: bool) -> Iterator[tuple[int, bytes]]:
    """What a slice sends to each bucket, and its own repeats."""
    if not len(records.docs):
        return
    kept, repeats = settle(records, repeats_only_later)
    kept = np.sort(kept)
    low = np.zeros((len(kept), 4), dtype=np.uint8)
    low[:, :] = records.hashes[kept][:, :4]
    bucket = low.view(np.uint32)[:, 0] % buckets
    by_bucket = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[by_bucket].astype(np.int64), prepend=-1))
    for start, end in zip(cuts, [*cuts[1:], len(kept)], strict=True):
        yield int(bucket[by_bucket[start]]), records.pick(kept[by_bucket[start:end]]).pack()
    if len(repeats):
        # Repeats are settled; any bucket passes them on.
        found = records.pick(np.sort(repeats))
        found.hashes = None
        yield int((found.places[0] + found.rows[0]) % buckets), found.pack()


def _answers(parts: list[Records]) -> pa.Table:
    """One row per document, with its places."""
    if not parts:
        return PLACES_ARROW.empty_table()
    found = Records.joined(parts)
    ids, rows = found.ids[found.docs], found.rows[found.docs]
    order = np.lexsort((found.places, ids, rows))
    ids, rows, places = ids[order], rows[order], found.places[order].astype(np.int32)
    new = np.ones(len(order), dtype=bool)
    new[1:] = (ids[1:] != ids[:-1]) | (rows[1:] != rows[:-1])
    cuts = np.flatnonzero(new)
    packed = [places[s:e].tobytes() for s, e in zip(cuts, [*cuts[1:], len(order)], strict=True)]
    return pa.table({"_at_id": pa.array(ids[cuts]), "_at_row": pa.array(rows[cuts]), "places": pa.array(packed, pa.binary())})


def _meet(repeats_only_later: bool, table: pa.Table) -> pa.Table:
    """Records of one bucket of hashes: the places of those that repeat."""
    arrived = [Records.unpack(b) for b in table.column("block").to_pylist()]
    out, parts = [r for r in arrived if r.hashes is None], [r for r in arrived if r.hashes is not None]
    if parts:
        joined = Records.joined(parts)
        in_order = np.lexsort((joined.places, joined.rows[joined.docs], joined.ids[joined.docs]))
        records = Records(joined.ids, joined.rows, joined.docs[in_order], joined.places[in_order], joined.hashes[in_order])
        order, new = _grouped(_keys(records.hashes))
        group = np.cumsum(new) - 1
        leader = order[new][group]
        ids, rows = records.ids[records.docs], records.rows[records.docs]
        # Rows alike in id and text are one document and no repeat of each other.
        same = (ids[order] == ids[leader]) & (rows[order] == rows[leader]) & (records.places[order] == records.places[leader])
        if repeats_only_later:
            repeat = ~same
        else:
            repeat = np.bincount(group, weights=~same, minlength=int(group[-1]) + 1)[group] > 0
        if repeat.any():
            found = records.pick(np.sort(order[repeat]))
            found.hashes = None
            out.append(found)
    return _answers(out)


def repeated_places(
    rows: DataFrame, records_of: Callable[[Iterator[pa.RecordBatch]], Iterator[Records]], repeats_only_later: bool, text_bytes: int
) -> DataFrame:
    """One row per document: ``_at_id``, ``_at_row`` and ``places``, lists of
    the word numbers (32-bit integers) at which a repeated hash stands: all of
    its places, or all but its earliest one. The texts have ``text_bytes``."""
    buckets = max(BUCKETS, -(-text_bytes // BUCKET_BYTES))

    def send(batches):
        for records in records_of(batches):
            found = list(blocks(records, buckets, repeats_only_later))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _ in found], pa.int32()), pa.array([x for _, x in found], pa.binary())],
                    names=["bucket", "block"],
                )

    met = rows.mapInArrow(send, BLOCK).groupBy("bucket").applyInArrow(lambda t: _meet(repeats_only_later, t), PLACES)
    return met.groupBy("_at_id", "_at_row").agg(F.collect_list("places").alias("places"))


def unpack_places(packed: list[bytes]) -> np.ndarray:
    return np.unique(np.frombuffer(b"".join(packed), dtype=np.int32)).astype(np.int64)
