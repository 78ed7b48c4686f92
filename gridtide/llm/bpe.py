"""Byte-level pair encoding and decoding with a given vocabulary.

Texts are cut into words, each slice of documents numbers its distinct ones,
and keeps its text as a sequence of these numbers: the positions. The distinct
words of all slices are dealt to buckets by a hash, so each is cut into
pre-tokens and encoded once in its bucket whatever the number of slices that
have it, and the ids are joined back to the slices, where sequences turn into
ids by position.
Sequences and word lists travel as compressed blocks; a common word costs one
entry per slice.

Decoding joins every id with the token-byte table. The table is as large as the
vocabulary, which is fixed, so it goes to every task.

A slice is cut again when its sequence is read; it is known by a digest of its
documents, and a sequence that finds no words of its slice fails the job.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.llm.common import shuffle_width, whole
from gridtide.llm.words import in_parts

SLICE_CHARS = 4 << 20
PIECE_CHARS = 4 << 20
BATCH_TOKENS = 1 << 16
# A space between two characters of which none is white space, by anyone's
# definition; and what texts have in which not every space is such a one.
CUT = regex.compile(r"(?<=[^\s\x1c-\x1f\x85]) (?=[^\s\x1c-\x1f\x85])")
AWKWARD = ["  ", " \n", "\n ", *map(chr, [9, 11, 12, 13, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)])]
AWKWARD += map(chr, [0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
BLOCK = "slice bigint, part int, block binary"


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 token and rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def encode_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of least rank merges first, and
    the leftmost of equals, until no pair is in the vocabulary. A heap keeps
    long pieces at n log n."""
    if piece in ranks:
        return [ranks[piece]]
    end = list(range(1, len(piece) + 1))  # where the part that starts here ends; 0 once it is merged away
    before = list(range(-1, len(piece) - 1))
    heap = [(ranks[piece[i : i + 2]], i, i + 2) for i in range(len(piece) - 1) if piece[i : i + 2] in ranks]
    heapq.heapify(heap)

    def offer(start: int) -> None:
        if end[start] < len(piece):
            stop = end[end[start]]
            rank = ranks.get(piece[start:stop])
            if rank is not None:
                heapq.heappush(heap, (rank, start, stop))

    while heap:
        _, start, stop = heapq.heappop(heap)
        middle = end[start]
        if not middle or middle >= len(piece) or end[middle] != stop:
            continue
        end[start], end[middle] = stop, 0
        if stop < len(piece):
            before[stop] = start
        offer(start)
        if before[start] >= 0:
            offer(before[start])
    ids, start = [], 0
    while start < len(piece):
        ids.append(ranks[piece[start : end[start]]])
        start = end[start]
    return ids


@lru_cache(maxsize=4)
def _cutter(pattern: str):
    return regex.compile(pattern)


def _pack(*arrays: bytes) -> bytes:
    raw = b"".join(len(a).to_bytes(8, "little") + a for a in arrays)
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 3).compress(raw, asbytes=True)


def _unpack(block: bytes) -> list[bytes]:
    raw = pa.Codec("zstd").decompress(block[8:], int.from_bytes(block[:8], "little"), asbytes=True)
    parts, at = [], 0
    while at < len(raw):
        size = int.from_bytes(raw[at : at + 8], "little")
        parts.append(raw[at + 8 : at + 8 + size])
        at += 8 + size
    return parts


def _planes(values: np.ndarray) -> bytes:
    """The values' first bytes, then their second ones, and so on: like bytes
    stand together and compress."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplanes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4")[:, 0]


def _is_awkward(text: str) -> bool:
    return text[:1] == " " or text[-1:] == " " or any(a in text for a in AWKWARD)


def _chunks(text: str) -> Iterator[str]:
    """A text cut before spaces, in parts of a bounded size; the space at a cut
    is left out, and stands in front of every part but the first."""
    start = 0
    while len(text) - start > PIECE_CHARS:
        cut = CUT.search(text, start + PIECE_CHARS)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:]


class CutSlice:
    """Documents of a slice as numbers of their distinct words.

    A word goes from one lone space to the next and has the space in front of
    it. No pre-token reaches over such a space, so the pre-tokens of a text are
    those of its words.
    """

    def __init__(self, ids: list, rows: list, texts: list[str], buckets: int):
        number = count().__next__
        opening, spaced = defaultdict(number), defaultdict(number)
        sequences, self.sizes = [], []
        for text in texts:
            size = len(sequences)
            for n, chunk in enumerate(_chunks(text) if text else ()):
                words = CUT.split(chunk) if _is_awkward(chunk) else chunk.split(" ")
                if n == 0:
                    sequences.append(np.array([opening[words.pop(0)]], np.int32))
                sequences.append(np.fromiter(map(spaced.__getitem__, words), np.int32, len(words)))
            self.sizes.append(sum(map(len, sequences[size:])))
        self.ids, self.rows = ids, rows
        words = [b""] * (len(opening) + len(spaced))
        for space, numbers in ((b"", opening), (b" ", spaced)):
            for word, n in numbers.items():
                words[n] = space + word.encode()
        bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
        # Numbers run through bucket 0's words, then bucket 1's, as they first occur.
        order = np.argsort(bucket, kind="stable")
        renumbered = np.empty(len(words), dtype=np.int32)
        renumbered[order] = np.arange(len(words), dtype=np.int32)
        self.words, self.bucket = [words[i] for i in order], bucket[order] if len(words) else bucket
        self.sequence = renumbered[np.concatenate(sequences)] if sequences else np.empty(0, np.int32)
        known = hashlib.blake2b(repr((rows, self.sizes)).encode(), digest_size=8).digest()
        self.key = int.from_bytes(known, "little", signed=True)

    def word_blocks(self) -> Iterator[tuple[int, int, bytes]]:
        cuts = np.flatnonzero(np.diff(self.bucket, prepend=-1)) if len(self.words) else []
        for start, end in zip(cuts, [*cuts[1:], len(self.words)], strict=True) if len(self.words) else ():
            words = self.words[start:end]
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            yield self.key, int(self.bucket[start]), _pack(_planes(sizes), b"".join(words))

    def sequence_block(self) -> tuple[int, int, bytes]:
        ids = np.array([0 if i is None else i for i in self.ids], np.int64).tobytes()
        named = np.array([i is not None for i in self.ids], np.uint8).tobytes()
        return self.key, -1, _pack(ids, named, np.array(self.sizes, np.int64).tobytes(), _planes(self.sequence))


def _cut_slices(batches: Iterable[pa.RecordBatch], buckets: int) -> Iterator[CutSlice]:
    ids, rows, texts, size = [], [], [], 0
    for batch in in_parts(batches):
        for i, row, text in zip(*[batch.column(c).to_pylist() for c in ("id", "row", "text")], strict=True):
            if texts and size + len(text) > SLICE_CHARS:
                yield CutSlice(ids, rows, texts, buckets)
                ids, rows, texts, size = [], [], [], 0
            ids.append(i), rows.append(row), texts.append(text)
            size += len(text)
    if texts:
        yield CutSlice(ids, rows, texts, buckets)


def _blocks(found: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) or [[], [], []]
    kinds = [pa.int64(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["slice", "part", "block"])


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, .. for each pair, laid end to end."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def encode(docs: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key`` and ``ids``, the ids of the whole text as little-endian
    unsigned 32-bit integers, as the public tokenizer with that vocabulary and
    pattern gives them; there are no special tokens, and their strings are
    ordinary text.

    ``vocabulary`` is the path of a rank file the driver can read. Null counts
    as empty and gives no ids. Repeated rows come out as often as they go in.
    Ids are whole numbers, or null. Other columns are ignored.
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(vocabulary))
    buckets = 4 * shuffle_width(spark)
    rows = docs.select(
        F.col(key).cast("bigint").alias("id"), F.xxhash64(F.col(key), whole(text)).alias("row"), whole(text).alias("text")
    )

    def words(batches):
        for part in _cut_slices(batches, buckets):
            yield _blocks(list(part.word_blocks()))

    def sequences(batches):
        for part in _cut_slices(batches, buckets):
            yield _blocks([part.sequence_block()])

    def encode_words(table: pa.Table) -> pa.Table:
        cut, known, pieces, out = _cutter(pattern), {}, {}, []
        for key_, part, block in zip(*[table.column(c).to_pylist() for c in ("slice", "part", "block")], strict=True):
            sizes, joined = _unpack(block) if block else (b"", b"")
            at, counts, ids = 0, [], []
            for size in _unplanes(sizes).tolist():
                word = joined[at : at + size]
                at += size
                found = known.get(word)
                if found is None:
                    found = []
                    for piece in cut.findall(word.decode()):
                        if piece not in pieces:
                            pieces[piece] = encode_piece(piece.encode(), ranks.value)
                        found += pieces[piece]
                    known[word] = found
                counts.append(len(found))
                ids += found
            out.append((key_, part, _pack(_planes(np.array(counts, np.int64)), _planes(np.array(ids, np.int64)))))
        return pa.Table.from_batches([_blocks(out)])

    def assemble(table: pa.Table) -> pa.Table:
        parts = sorted(zip(table.column("part").to_pylist(), table.column("block").to_pylist(), strict=True), key=lambda p: p[0])
        # Two slices of the same documents have one key, and the same words.
        answers = [_unpack(block) for part, block in sorted({part: block for part, block in parts if part >= 0}.items())]
        counts = np.concatenate([np.empty(0, np.int64), *[_unplanes(a[0]) for a in answers]])
        ids = np.concatenate([np.empty(0, "<u4"), *[_unplanes(a[1]) for a in answers if len(a) > 1]])
        starts = np.cumsum(counts) - counts
        out_ids, out = [], []
        for _, block in [p for p in parts if p[0] < 0]:
            known, named, sizes, *sequence = _unpack(block)
            sizes = np.frombuffer(sizes, np.int64)
            numbers = _unplanes(sequence[0]) if sequence else np.empty(0, np.int64)
            if len(numbers) and (not len(counts) or int(numbers.max()) != len(counts) - 1):
                raise RuntimeError("a slice of documents was cut differently the second time")
            out_ids += [i if has else None for i, has in zip(np.frombuffer(known, np.int64).tolist(), named, strict=True)]
            ends = np.cumsum(sizes)
            for start, end in zip(ends - sizes, ends, strict=True):
                mine = []
                for first in range(int(start), int(end), BATCH_TOKENS):
                    n = numbers[first : min(first + BATCH_TOKENS, int(end))]
                    mine.append(ids[_ragged(starts[n], counts[n])].tobytes())
                out.append(b"".join(mine))
        return pa.table({"id": pa.array(out_ids, pa.int64()), "ids": pa.array(out, pa.binary())})

    encoded = rows.mapInArrow(words, BLOCK).groupBy("part").applyInArrow(encode_words, BLOCK)
    whole_slices = rows.mapInArrow(sequences, BLOCK).unionByName(encoded).groupBy("slice").applyInArrow(assemble, "id bigint, ids binary")
    return whole_slices.withColumnRenamed("id", key)


def decode(encoded: DataFrame, vocabulary: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The frame with ``out``, the bytes its ids stand for (null ids: no
    bytes). An id outside the vocabulary fails the job. ``out`` replaces a
    column of that name."""
    by_id = {rank: token for token, rank in read_ranks(vocabulary).items()}
    tokens = [by_id.get(i, None) for i in range(max(by_id, default=-1) + 1)]
    if any(t is None for t in tokens):
        raise ValueError("ranks must be consecutive")
    table = encoded.sparkSession.sparkContext.broadcast(
        (np.frombuffer(b"".join(tokens), np.uint8), np.fromiter(map(len, tokens), np.int64, len(tokens)))
    )

    kept = [f for f in encoded.schema.fields if f.name != out]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, sizes = table.value
        starts = np.cumsum(sizes) - sizes
        for batch in in_parts(batches):
            decoded = []
            for raw in batch.column(ids).to_pylist():
                found, numbers = [], np.frombuffer(raw or b"", "<u4")
                for first in range(0, len(numbers), BATCH_TOKENS):
                    n = numbers[first : first + BATCH_TOKENS]
                    found.append(data[_ragged(starts[n], sizes[n])].tobytes())
                decoded.append(b"".join(found))
            columns = [batch.column(f.name) for f in kept] + [pa.array(decoded, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*[f.name for f in kept], out])

    return encoded.mapInArrow(rows, T.StructType([*kept, T.StructField(out, T.BinaryType())]))
