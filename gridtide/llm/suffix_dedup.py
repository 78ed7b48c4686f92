"""Repeated byte strings, found by sorting suffixes over range partitions.

A string of ``length`` bytes repeats if two suffixes share that prefix. Sorting
a suffix for every byte of a corpus would move each byte hundreds of times, so
suffixes are sorted in two rounds, each with the same sort.

*Sparse round.* The suffix at a start i is known by its anchor: the place of
the least 8-byte hash among the next GAP starts, which depends on nothing
outside the string. Starts with the same anchor form a zone, and a zone sends
one suffix of three tokens: the 8 bytes at the anchor, a hash of the bytes that
every string of the zone has from its anchor on, and a hash of the zone's whole
content. Neighbours in sorted order that agree in all three hold only repeated
strings. Neighbours that agree in two may share some, and are asked for all.
The others share none: equal strings have equal anchors, so equal first tokens.

*Dense round.* One zone of each content that was asked sends a suffix for each
of its starts: its first 8 bytes, and two hashes that cover the whole string.

*The sort.* Splitters come from a bounded sample and deal suffixes by their
leading tokens to buckets of a bounded expected size. A bucket sorts by
multikey quicksort: by the first token, then ties by the second, and so on. A
run of neighbours at the edge of a bucket is held against the splitter there;
if they agree it may go on in the next bucket, and is asked.

*Common content.* A slice of documents settles what it holds several times and
sends it once. A content that the sample holds several times is settled where
it is read: only one of its zones, which the sample names, is sent.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import keep_table, whole
from gridtide.llm.words import in_slices, mixed, range_hashes

SLICE_BYTES = 1 << 20
# The most starts an anchor is looked for in, and suffixes in a bucket, in the sample, and of a common content in it.
GAP, BUCKET, SAMPLE, COMMON = 128, 1 << 16, 1 << 16, 4
SUFFIX = "bucket int, t1 bigint, t2 bigint, t3 bigint, _id bigint, _row bigint, place int, span int, packed binary"
ANSWER = "_at_id bigint, _at_row bigint, asked boolean, packed binary, starts bigint"


@dataclass
class Suffixes:
    """Three tokens (a row each) and the first of ``span`` starts, a place in
    the document of that id and row hash."""

    tokens: np.ndarray
    ids: np.ndarray
    rows: np.ndarray
    places: np.ndarray
    spans: np.ndarray

    def pick(self, which: np.ndarray) -> Suffixes:
        return Suffixes(self.tokens[:, which], self.ids[which], self.rows[which], self.places[which], self.spans[which])

    def order(self) -> np.ndarray:
        """By the first token, then what ties by the next one, and so on."""
        order = np.argsort(self.tokens[0], kind="stable")
        for depth in (1, 2):
            tied = np.flatnonzero(self._runs(order, depth)[1])
            run = self._runs(order, depth)[0][tied]
            order[tied] = order[tied][np.lexsort((self.tokens[depth][order[tied]], run))]
        return order

    def _runs(self, order: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """For suffixes in order: which run of equal first tokens each is in,
        and whether it is not alone there."""
        new = np.ones(len(order), dtype=bool)
        new[1:] = (self.tokens[:depth, order[1:]] != self.tokens[:depth, order[:-1]]).any(axis=0)
        run = np.cumsum(new) - 1
        return run, np.bincount(run, minlength=1)[run] > 1 if len(run) else new

    def keys(self) -> np.ndarray:
        """The tokens as bytes that compare like them."""
        return np.ascontiguousarray(self.tokens.T.astype(">u8")).view("S24")[:, 0] if self.tokens.shape[1] else np.zeros(0, "S24")


class Texts:
    """Documents end to end, with the leading 8 bytes at each place."""

    def __init__(self, ids: list[int], rows: list[int], texts: list[bytes], length: int):
        self.ids, self.rows, self.length = np.array(ids, dtype=np.int64), np.array(rows, dtype=np.int64), length
        raw = b"".join(texts)
        self.data = np.frombuffer(raw, dtype=np.uint8)
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        starts = np.maximum(sizes - length + 1, 0)
        self.docs = np.repeat(np.arange(len(texts)), starts)
        # All starts of strings that end in their document.
        self.at = np.arange(len(self.docs)) + np.repeat(self.first[:-1] - np.cumsum(starts) + starts, starts)

    def lead(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), dtype=np.uint64)
        for k in range(8):
            out = (out << np.uint64(8)) | self.data[at + k].astype(np.uint64)
        return out

    def hashes(self, starts: np.ndarray, ends: np.ndarray, family: int) -> np.ndarray:
        return range_hashes(self.data.astype(np.uint16) + np.uint16(1), starts, ends, family)

    def anchors(self, gap: int) -> np.ndarray:
        """For each start the place of the least hash of 8 bytes among ``gap``
        (a power of two) starts, the first of equal ones."""
        n = len(self.data)
        least = (mixed(self.lead(np.arange(n - 7))) & np.uint64(0xFFFFFFFF00000000)) | np.arange(n - 7, dtype=np.uint64)
        width = 1
        while width < gap:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        return (least[self.at] & np.uint64(0xFFFFFFFF)).astype(np.int64)

    def suffixes(self, at: np.ndarray, docs: np.ndarray, spans: np.ndarray, tokens: list[np.ndarray]) -> Suffixes:
        return Suffixes(np.stack(tokens), self.ids[docs], self.rows[docs], at - self.first[docs], spans)


def _gap(length: int) -> int:
    return min(GAP, 1 << ((length - 7).bit_length() - 1))


def _zones(length: int):
    gap = _gap(length)

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[Suffixes]:
        for ids, rows, texts in in_slices(batches, limit=SLICE_BYTES, unique=False):
            part = Texts(ids, rows, texts, length)
            if not len(part.at):
                continue
            anchor = part.anchors(gap)
            new = np.ones(len(anchor), dtype=bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (part.docs[1:] != part.docs[:-1])
            cuts = np.flatnonzero(new)
            spans, at, anchor = np.diff(np.append(cuts, len(new))), part.at[cuts], anchor[cuts]
            tokens = [
                part.lead(anchor),
                part.hashes(anchor, anchor + length - gap + 1, 0),
                part.hashes(at, at + spans - 1 + length, 1),
            ]
            yield part.suffixes(at, part.docs[cuts], spans, tokens)

    return suffixes


def _starts(length: int):
    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[Suffixes]:
        for ids, rows, texts, asked in in_slices(batches, "asked", limit=SLICE_BYTES, unique=False):
            part = Texts(ids, rows, texts, length)
            wanted = np.zeros(len(part.data) + 1, dtype=np.int64)
            for first, blocks in zip(part.first, asked, strict=False):
                for place, span in map(unpacked, blocks):
                    np.add.at(wanted, first + place, 1)
                    np.add.at(wanted, first + place + span, -1)
            chosen = np.cumsum(wanted)[part.at] > 0
            at, docs = part.at[chosen], part.docs[chosen]
            if len(at):
                tokens = [part.lead(at), part.hashes(at, at + length, 0), part.hashes(at, at + length, 1)]
                yield part.suffixes(at, docs, np.ones(len(at), dtype=np.int64), tokens)

    return suffixes


def unpacked(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places, and how many starts there are from each on."""
    both = np.frombuffer(block, dtype=np.int32).astype(np.int64).reshape(2, -1)
    return both[0], both[1]


def _packed(found: Suffixes) -> Iterator[tuple[int, int, bytes, int]]:
    """Id, row, starts and their number for each document, neighbours joined."""
    order = np.lexsort((found.places, found.rows, found.ids))
    if not len(order):
        return
    found = found.pick(order)
    new = np.ones(len(order), dtype=bool)
    new[1:] = (found.ids[1:] != found.ids[:-1]) | (found.rows[1:] != found.rows[:-1])
    apart = new.copy()
    apart[1:] |= found.places[1:] != found.places[:-1] + found.spans[:-1]
    places = found.places[apart]
    spans = np.add.reduceat(found.spans, np.flatnonzero(apart))
    cuts = np.flatnonzero(new[apart])
    firsts = np.flatnonzero(new)
    for row, start, end in zip(firsts, cuts, [*cuts[1:], len(places)], strict=True):
        block = np.stack([places[start:end], spans[start:end]]).astype(np.int32).tobytes()
        yield int(found.ids[row]), int(found.rows[row]), block, int(spans[start:end].sum())


def _sampled(suffixes_of: Callable, fraction: float):
    """Suffixes for the sample; of many, an even share."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dice = np.random.default_rng(0)
        for found in suffixes_of(batches):
            yield _as_rows(found.pick(np.flatnonzero(dice.random(len(found.ids)) < fraction)), np.int32(0))

    return rows


def _as_rows(found: Suffixes, buckets, packed: list | None = None) -> pa.RecordBatch:
    n = len(found.ids)
    columns = [pa.array(np.broadcast_to(buckets, n).astype(np.int32)), *[pa.array(t.view(np.int64)) for t in found.tokens]]
    columns += [pa.array(found.ids), pa.array(found.rows), pa.array(found.places.astype(np.int32)), pa.array(found.spans.astype(np.int32))]
    columns.append(pa.array(packed or [None] * n, pa.binary()))
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "t1", "t2", "t3", "_id", "_row", "place", "span", "packed"])


def _from_table(table: pa.Table) -> Suffixes:
    column = {c: table.column(c).to_numpy() for c in table.column_names if c != "packed"}
    tokens = np.stack([column[c].astype(np.int64).view(np.uint64) for c in ("t1", "t2", "t3")])
    return Suffixes(tokens, column["_id"], column["_row"], column["place"].astype(np.int64), column["span"].astype(np.int64))


def _splitters(sample_of: Callable[[float], DataFrame], suffixes_of: Callable, expected: int) -> tuple[np.ndarray, Suffixes]:
    """Keys that part buckets, and one suffix of each common content."""
    if expected <= BUCKET:
        return np.zeros(0, "S24"), _NONE
    # About SAMPLE suffixes, from an even share of the rows and of each row's.
    share = min(1.0, SAMPLE / expected)
    chosen = sample_of(min(1.0, 16 * share))
    sample = chosen.mapInArrow(_sampled(suffixes_of, max(share, 1 / 16)), SUFFIX).limit(4 * SAMPLE).toArrow()
    found = _from_table(sample)
    found = found.pick(found.order())
    run, _ = found._runs(np.arange(len(found.ids)), 3)
    common = np.bincount(run, minlength=1)[run] >= COMMON if len(run) else np.zeros(0, dtype=bool)
    named = found.pick(np.flatnonzero(common))
    named = named.pick(np.lexsort((named.places, named.rows, named.ids, *named.tokens[::-1])))
    run, _ = named._runs(np.arange(len(named.ids)), 3)
    buckets = -(-expected // BUCKET)
    at = np.arange(1, buckets) * len(found.ids) // buckets
    keys = np.unique(found.keys()[at]) if len(found.ids) else np.zeros(0, "S24")
    return keys, named.pick(np.unique(run, return_index=True)[1])


_NONE = Suffixes(np.zeros((3, 0), np.uint64), *[np.zeros(0, np.int64) for _ in range(4)])


def _sending(suffixes_of: Callable, splitters: np.ndarray, common: Suffixes):
    """Suffixes with their buckets, and what is known to repeat already."""
    common_keys = common.keys()

    def settled(found: Suffixes) -> tuple[np.ndarray, np.ndarray]:
        """Which to send, and which repeat: all of a content held twice, or of
        a common one. The first of a content is sent, of a common one only the
        suffix the sample names."""
        order = found.order()
        run, several = found._runs(order, 3)
        first = np.ones(len(order), dtype=bool)
        first[1:] = run[1:] != run[:-1]
        repeats, send = np.zeros(len(order), dtype=bool), np.zeros(len(order), dtype=bool)
        repeats[order], send[order] = several, first
        if len(common_keys):
            keys = found.keys()
            at = np.minimum(np.searchsorted(common_keys, keys), len(common_keys) - 1)
            known = common_keys[at] == keys
            named = known & (common.ids[at] == found.ids) & (common.rows[at] == found.rows) & (common.places[at] == found.places)
            repeats, send = repeats | known, np.where(known, named, send)
        return np.flatnonzero(send), np.flatnonzero(repeats)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in suffixes_of(batches):
            send, repeats = settled(found)
            sent = found.pick(send)
            yield _as_rows(sent, np.searchsorted(splitters, sent.keys(), side="right"))
            packed = list(_packed(found.pick(repeats)))
            if packed:
                ids, docs, blocks, starts = zip(*packed, strict=True)
                zeros = np.zeros(len(ids), dtype=np.int64)
                passed = Suffixes(np.zeros((3, len(ids)), np.uint64), np.array(ids), np.array(docs), zeros, np.array(starts))
                yield _as_rows(passed, np.array(docs) % (len(splitters) + 1), list(blocks))

    return rows


def _meeting(splitters: np.ndarray, ask: bool):
    """What a bucket of suffixes repeats, and what it asks for."""

    def at_edge(found: Suffixes, bucket: int) -> np.ndarray:
        """Which agree with the splitter on either side in two tokens."""
        edges = [splitters[b] for b in (bucket - 1, bucket) if 0 <= b < len(splitters)]
        agrees = np.zeros(len(found.ids), dtype=bool)
        for edge in edges:
            t1, t2 = np.frombuffer(edge.ljust(24, b"\0"), dtype=">u8")[:2]
            agrees |= (found.tokens[0] == t1) & (found.tokens[1] == t2)
        return agrees

    def rows(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        passed = table.filter(table.column("packed").is_valid())
        found = _from_table(table.filter(table.column("packed").is_null()))
        found = found.pick(found.order())
        run, several = found._runs(np.arange(len(found.ids)), 3)
        out = [(i, r, False, b, n) for i, r, b, n in _packed(found.pick(np.flatnonzero(several)))]
        if ask and len(run):
            first = np.ones(len(run), dtype=bool)
            first[1:] = run[1:] != run[:-1]
            shared, _ = found._runs(np.arange(len(run)), 2)
            contents = np.bincount(shared, weights=first)[shared]
            asked = first & ((contents > 1) | at_edge(found, bucket))
            out += [(i, r, True, b, n) for i, r, b, n in _packed(found.pick(np.flatnonzero(asked)))]
        columns = list(zip(*out, strict=True)) or [[]] * 5
        kinds = dict(zip(["_at_id", "_at_row", "asked", "packed", "starts"], [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64()], strict=True))
        own = pa.table({name: pa.array(list(c), kind) for (name, kind), c in zip(kinds.items(), columns, strict=True)})
        known = pa.table(
            {"_at_id": passed.column("_id"), "_at_row": passed.column("_row"), "asked": pa.array([False] * len(passed), pa.bool_()),
             "packed": passed.column("packed"), "starts": passed.column("span").cast(pa.int64())}
        )
        return pa.concat_tables([own, known])

    return rows


def sorted_suffixes(
    rows: DataFrame, sample_of: Callable[[float], DataFrame], suffixes_of: Callable, expected: int, ask: bool
) -> DataFrame:
    """Starts of repeated strings per document and bucket, and with ``ask``
    those of zones that may hold some. ``sample_of`` gives a share of ``rows``,
    of which ``expected`` suffixes come."""
    splitters, common = _splitters(sample_of, suffixes_of, expected)
    sent = rows.mapInArrow(_sending(suffixes_of, splitters, common), SUFFIX)
    return sent.groupBy("bucket").applyInArrow(_meeting(splitters, ask), ANSWER)


def _remove(length: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, blocks in zip(batch.column("_text"), batch.column("settled"), strict=True):
                text, gone = text.as_py(), np.zeros(0, dtype=bool)
                n_bytes, n_removed, n_spans = len(text), 0, 0
                if blocks.is_valid:
                    depth = np.zeros(n_bytes + 1, dtype=np.int64)
                    for place, span in map(unpacked, blocks.as_py()):
                        np.add.at(depth, place, 1)
                        np.add.at(depth, place + span - 1 + length, -1)
                    gone = np.cumsum(depth[:-1]) > 0
                    n_removed = int(gone.sum())
                    n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    text = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
                out.append((n_bytes, n_removed, n_spans, text, hashlib.sha256(text).hexdigest()))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
            arrays = [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), *arrays], names=["_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return rows


def suffix_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 400) -> DataFrame:
    """Per row: ``key``, ``n_bytes``, ``n_removed``, ``n_spans`` (removed runs
    of bytes), ``kept`` (the bytes that stay) and ``kept_sha256``.

    A byte goes if a string of ``length`` bytes that covers it also starts
    anywhere else: in another row, or in the same one. All copies go; strings
    are judged on the input. A null text is empty. Every row counts, so of rows
    alike in id and text each loses all its strings. Rows without an id are
    treated like others. Ids are whole numbers. A row's own bytes are in one
    task, and it has less than 2 GB. Other columns are ignored.
    """
    if length < 16:
        raise ValueError(f"length must be at least 16 bytes, not {length}")
    last = (1 << 63) - 1
    rows = docs.select(
        F.coalesce(F.col(key).cast("bigint"), F.lit(last)).alias("_id"),
        F.xxhash64(F.col(key), whole(text)).alias("_row"),
        whole(text).cast("binary").alias("_text"),
    )
    per_doc = F.greatest(F.octet_length("_text").cast("bigint") - F.lit(length - 1), F.lit(0))
    expected = (rows.agg(F.sum(per_doc)).first()[0] or 0) * 2 // (_gap(length) + 1)
    sparse = keep_table(sorted_suffixes(rows, lambda share: rows.sample(share, seed=7), _zones(length), expected, True), "sparse-suffixes")
    n_asked = sparse.filter("asked").agg(F.sum("starts")).first()[0] or 0
    asked = sparse.filter("asked").groupBy("_at_id", "_at_row").agg(F.collect_list("packed").alias("asked"))
    matched = (rows["_id"] == F.col("_at_id")) & (rows["_row"] == F.col("_at_row"))
    # Both joins read the same shuffle of the texts.
    suspects = rows.hint("shuffle_merge").join(asked, matched).select("_id", "_row", "_text", "asked")

    def some_suspects(share: float) -> DataFrame:
        # As many starts as the sample has: a bounded number of documents.
        some = F.broadcast(asked.sample(share, seed=7))
        return rows.join(some, matched).select("_id", "_row", "_text", "asked")

    dense = sorted_suffixes(suspects, some_suspects, _starts(length), n_asked, False)
    repeated = sparse.filter("not asked").unionByName(dense).groupBy("_at_id", "_at_row").agg(F.collect_list("packed").alias("settled"))
    marked = rows.hint("shuffle_merge").join(repeated, matched, "left").select("_id", "_text", "settled")
    done = marked.mapInArrow(_remove(length), "_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, kept_sha256 string")
    return done.select(F.nullif("_id", F.lit(last)).alias(key), "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256")
