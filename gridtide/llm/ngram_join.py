"""Near duplicates: documents whose word shingles overlap by a given share.

Equal sets are one class from the start. Of the other pairs, two sets that
overlap by a share t share one of the first n - ceil(t * n) + 1 of their n
shingles, whatever order all sets are sorted in. The order is rare before
frequent, after a count sketch of fixed size over the whole corpus, so a
passage that very many documents hold stands last and brings nobody together.

Each such prefix shingle is a tile. At the first tile that two sets share, what
stands before it in either has no part in their overlap, so the places of the
tile in both orders bound it. A member stays in a tile only if that bound allows
it a partner there. Sets of a tile are sorted by size and cut into bands within which sizes allow a link, and the smallest set of a band is
compared with the others of it, and each with its neighbour in an order of the
tile's own. That joins most groups of copies with a number of pairs in
proportion to the documents. Then components are worked out, and only tiles
that still hold several components are looked at again: for pairs between them,
as all others can add nothing.

A pair's hashed bitmaps bound its overlap from above: a bit that one set has
and the other lacks is an element less. In the second round the bound is taken
inside the tile, and a pair comes only from the first tile it shares, which the
shingles before it in both orders tell. Only pairs that the bound lets pass fetch
their sorted shingle arrays and are intersected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import keep_table, shuffle_width, whole
from gridtide.llm.components import components, shuffled_if_large
from gridtide.llm.exchange import Records, hash_bytes
from gridtide.llm.words import Slice, in_slices, mixed, range_hashes

SKETCH_LOG, SKETCH_PARTS = 20, 64
# Bitmaps up to this size have more bits for each shingle; a filter of ids has no more than that.
FINE_LOG, FILTER_LOG = 13, 26


def document_sets(part: Slice, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(document number, shingle) pairs, each once, sorted: the runs of
    ``length`` words, or the whole sequence of a shorter document."""
    docs, at = part.run_starts(length)
    shingles = part.run_hashes(at, length)
    counts = part.counts()
    short = np.flatnonzero((counts > 0) & (counts < length))
    if len(short):

        tails = range_hashes(part.word_hashes(), part.first[short], part.first[short + 1], 0)
        docs, shingles = np.concatenate([docs, short]), np.concatenate([shingles, tails])
    order = np.lexsort((shingles, docs))
    docs, shingles = docs[order], shingles[order]
    new = np.ones(len(docs), dtype=bool)
    new[1:] = (docs[1:] != docs[:-1]) | (shingles[1:] != shingles[:-1])
    return docs[new], shingles[new]


def _digests(docs: np.ndarray, shingles: np.ndarray, n_docs: int) -> np.ndarray:
    """64 bits of each sorted set, 0 for the empty one."""

    ends = np.searchsorted(docs, np.arange(n_docs + 1))
    found = range_hashes(shingles, ends[:-1], ends[1:], 1) | np.uint64(1)
    return np.where(ends[1:] > ends[:-1], found, np.uint64(0)).view(np.int64)


def _sketch(length: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_LOG, dtype=np.int64)
        for ids, rows, texts in in_slices(batches):
            _, shingles = document_sets(Slice(ids, rows, texts, lower=True), length)
            counts += np.bincount((shingles >> np.uint64(64 - SKETCH_LOG)).astype(np.int64), minlength=len(counts))
        parts = np.split(counts, SKETCH_PARTS)
        blocks = [pa.Codec("zstd", 1).compress(p.tobytes(), asbytes=True) for p in parts]
        yield pa.RecordBatch.from_pydict({"part": pa.array(range(SKETCH_PARTS), pa.int32()), "block": pa.array(blocks, pa.binary())})

    return send


def _summed(table: pa.Table) -> pa.Table:
    size = (1 << SKETCH_LOG) // SKETCH_PARTS
    total = np.zeros(size, dtype=np.int64)
    for block in table.column("block").to_pylist():
        total += np.frombuffer(pa.Codec("zstd").decompress(block, size * 8, asbytes=True), np.int64)
    return pa.table({"part": table.column("part")[:1], "block": pa.array([total.tobytes()], pa.binary())})


def shingle_counts(rows: DataFrame, length: int) -> np.ndarray:
    """How often the shingles of each of 2**20 hash classes occur, as powers of
    two. The sketch has a fixed size, 8 MB, whatever the corpus."""
    parts = rows.mapInArrow(_sketch(length), "part int, block binary").groupBy("part").applyInArrow(_summed, "part int, block binary")
    blocks = sorted((r["part"], bytes(r["block"])) for r in parts.collect())
    if not blocks:
        return np.zeros(1 << SKETCH_LOG, dtype=np.uint8)
    counts = np.frombuffer(b"".join(b for _, b in blocks), np.int64)
    return np.ceil(np.log2(counts + 1)).astype(np.uint8)


def _document_rows(length: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, rows_, texts in in_slices(batches):
            part = Slice(ids, rows_, texts, lower=True)
            docs, shingles = document_sets(part, length)
            yield pa.RecordBatch.from_pydict(
                {
                    "id": pa.array(part.ids),
                    "row": pa.array(part.rows),
                    "digest": pa.array(_digests(docs, shingles, len(ids))),
                    "size": pa.array(np.bincount(docs, minlength=len(ids)), pa.int64()),
                }
            )

    return rows


def _in_order(docs: np.ndarray, shingles: np.ndarray, n: np.ndarray, classes: np.ndarray, percent: int):
    """The prefixes (document numbers, shingles, sizes) of sets of ``n`` shingles
    rare before frequent, and the rank of each shingle in its set."""
    rarity = classes[(shingles >> np.uint64(64 - SKETCH_LOG)).astype(np.int64)]
    order = np.lexsort((shingles, rarity, docs))
    docs, shingles = docs[order], shingles[order]
    rank = np.arange(len(docs)) - np.searchsorted(docs, docs)
    n = n[docs]
    first = rank < n - -(-percent * n // 100) + 1
    return docs[first], shingles[first], n[first], rank[first]


def _prefixes(length: int, percent: int, frequency, buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = frequency.value
        for ids, rows, texts in in_slices(batches):
            part = Slice(ids, rows, texts, lower=True)
            docs, shingles = document_sets(part, length)
            if not len(docs):
                continue
            digests, sizes = _digests(docs, shingles, len(ids)), np.bincount(docs, minlength=len(ids))
            # Of equal sets in the slice the smallest id stands for all.
            _, stands = np.unique(digests, return_index=True)
            keep = np.zeros(len(ids), dtype=bool)
            keep[stands] = True
            keep[digests == 0] = False
            chosen = keep[docs]
            docs, shingles = docs[chosen], shingles[chosen]
            docs, shingles, n, rank = _in_order(docs, shingles, sizes, classes, percent)
            places = np.ascontiguousarray(rank.astype(np.int32)).view(np.uint8).reshape(-1, 4)
            records = Records(part.ids, digests, docs, n, np.concatenate([hash_bytes(shingles, None, 8), places], axis=1))
            bucket = (shingles % np.uint64(buckets)).astype(np.int64)
            by_bucket = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[by_bucket], prepend=-1))
            blocks = [
                (int(bucket[by_bucket[s]]), records.pick(np.sort(by_bucket[s:e])).pack())
                for s, e in zip(cuts, [*cuts[1:], len(docs)], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in blocks], pa.int32()), pa.array([x for _, x in blocks], pa.binary())], names=["bucket", "block"]
            )

    return send


MEMBERS = (
    "tile bigint, id bigint, digest bigint, size bigint, rank int, leader bigint, leader_digest bigint, next bigint, next_digest bigint"
)


def partner_sizes(sizes: np.ndarray, ranks: np.ndarray, percent: int) -> np.ndarray:
    """The size up to which sets can link with one of ``sizes`` shingles if the
    first shingle they share stands at that rank in it."""
    return np.maximum(((100 + percent) * (sizes - ranks) - percent * sizes) // percent, 0)


def have_partners(tile: np.ndarray, sizes: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Which members of tiles, sorted by (tile, size), have another one there of
    a size up to their ``most`` whose ``most`` allows their own size."""
    if not len(tile):
        return np.zeros(0, dtype=bool)
    base = np.cumsum(np.diff(tile, prepend=tile[0]) != 0).astype(np.int64) << 32
    most = most + base
    # The greatest and second greatest so far in the tile; those of tiles before are less than any size in it.
    greatest = np.maximum.accumulate(most)
    second = np.maximum.accumulate(np.minimum(most, np.concatenate([[-1], greatest[:-1]])))
    allowed = np.searchsorted(base + sizes, most, side="right")
    at = np.maximum(allowed - 1, 0)
    others = np.where((np.arange(len(tile)) < allowed) & (most == greatest[at]), second[at], greatest[at])
    return (allowed > 0) & (others >= base + sizes)


def _tiles(percent: int):
    def meet(table: pa.Table) -> pa.Table:
        parts = [Records.unpack(b) for b in table.column("block").to_pylist()]
        tile = np.concatenate([p.hashes[:, :8].copy().view(np.uint64)[:, 0] for p in parts])
        ranks = np.concatenate([p.hashes[:, 8:].copy().view(np.int32)[:, 0] for p in parts]).astype(np.int64)
        ids = np.concatenate([p.ids[p.docs] for p in parts])
        digests = np.concatenate([p.rows[p.docs] for p in parts])
        sizes = np.concatenate([p.places for p in parts])
        order = np.lexsort((ids, digests, sizes, tile))
        tile, ids, digests, sizes, ranks = tile[order], ids[order], digests[order], sizes[order], ranks[order]
        # Equal sets of several slices: the smallest id.
        first = np.ones(len(tile), dtype=bool)
        first[1:] = (tile[1:] != tile[:-1]) | (digests[1:] != digests[:-1])
        tile, ids, digests, sizes, ranks = tile[first], ids[first], digests[first], sizes[first], ranks[first]
        most = partner_sizes(sizes, ranks, percent)
        met = have_partners(tile, sizes, most)
        tile, ids, digests, sizes, ranks, most = tile[met], ids[met], digests[met], sizes[met], ranks[met], most[met]
        lead = np.zeros(len(tile), dtype=np.int64)
        at = 0
        starts = np.flatnonzero(np.diff(tile, prepend=tile[:1] ^ np.uint64(1))) if len(tile) else []
        for start, end in zip(starts, [*starts[1:], len(tile)] if len(tile) else [], strict=True):
            at = int(start)
            while at < end:  # a band: sizes within the share of its smallest
                stop = int(np.searchsorted(sizes[at:end], sizes[at] * 100 // percent, side="right")) + at
                lead[at:stop] = at
                at = stop
        # Neighbours in an order of each tile's own, within the band.
        turn = np.lexsort((mixed(digests.view(np.uint64) ^ tile), lead))
        later = np.roll(turn, -1)
        neighbour = np.empty(len(tile), dtype=np.int64)
        neighbour[turn] = np.where(lead[later] == lead[turn], later, turn) if len(turn) else turn
        own = np.arange(len(tile))
        lead, neighbour = (np.where((sizes[x] <= most) & (sizes <= most[x]), x, own) for x in (lead, neighbour))
        return pa.table(
            {
                "tile": pa.array(tile.view(np.int64)), "id": pa.array(ids), "digest": pa.array(digests),
                "size": pa.array(sizes, pa.int64()), "rank": pa.array(ranks, pa.int32()), "leader": pa.array(ids[lead]), "leader_digest": pa.array(digests[lead]),
                "next": pa.array(ids[neighbour]), "next_digest": pa.array(digests[neighbour]),
            }
        )

    return meet


def _filter_words(log_bits: int):
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = mixed(batch.column("id").to_numpy().view(np.uint64)) >> np.uint64(64 - log_bits)
            bits = np.uint64(1) << (at & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).view(np.int64)), pa.array(bits.view(np.int64))], names=["word", "bits"])

    return words


def id_filter(ids: DataFrame) -> np.ndarray:
    """Words of 64 bits, of which hashes of the ids set one bit each: 16 bits an
    id as long as that is a bounded size, so that no text has to be shuffled to
    be left out. Ids that pass by chance cost time only."""
    log_bits = min(FILTER_LOG, max(6, int(16 * ids.count()).bit_length()))
    words = ids.mapInArrow(_filter_words(log_bits), "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    found, out = words.toArrow(), np.zeros(1 << (log_bits - 6), dtype=np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def _passing(batches: Iterator[pa.RecordBatch], words: np.ndarray, key: str = "_id") -> Iterator[pa.RecordBatch]:
    log_bits = len(words).bit_length() + 5
    for batch in batches:
        at = mixed(batch.column(key).to_numpy().view(np.uint64)) >> np.uint64(64 - log_bits)
        passes = (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)
        yield batch.filter(pa.array(passes.astype(bool)))


def _set_rows(length: int, percent: int, frequency, wanted):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = frequency.value
        for ids, rows_, texts in in_slices(_passing(batches, wanted.value)):
            part = Slice(ids, rows_, texts, lower=True)
            docs, shingles = document_sets(part, length)
            ends = np.searchsorted(docs, np.arange(len(ids) + 1))
            sets = [shingles[s:e] for s, e in zip(ends[:-1], ends[1:], strict=True)]
            of, rarest, _, _ = _in_order(docs, shingles, np.diff(ends), classes, percent)
            cuts = np.searchsorted(of, np.arange(len(ids) + 1))
            yield pa.RecordBatch.from_pydict(
                {
                    "id": pa.array(part.ids),
                    "digest": pa.array(_digests(docs, shingles, len(ids))),
                    "n": pa.array(np.diff(ends), pa.int64()),
                    "bits": pa.array([bitmap(s) for s in sets], pa.binary()),
                    "shingles": pa.array([packed_set(s) for s in sets], pa.binary()),
                    "prefix": pa.array([packed_set(rarest[s:e]) for s, e in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
                }
            )

    return rows


def bitmap(shingles: np.ndarray) -> bytes:
    """A bit for each shingle, by its leading hash bits; eight times as many bits
    as shingles up to FINE_LOG, else twice as many, rounded up to a power of two."""
    log_bits = max(6, int(2 * len(shingles)).bit_length(), min(FINE_LOG, int(8 * len(shingles)).bit_length()))
    bits = np.zeros(1 << log_bits, dtype=np.uint8)
    bits[(shingles >> np.uint64(64 - log_bits)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def packed_set(shingles: np.ndarray) -> bytes:
    """The leading six bytes of each of the hashes."""
    return (shingles >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked_set(packed: bytes) -> np.ndarray:
    padded = np.zeros((len(packed) // 6, 8), dtype=np.uint8)
    padded[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return padded.view(np.uint64)[:, 0]


def overlap_bound(a: bytes, n_a: int, b: bytes, n_b: int) -> int:
    """No two sets with these bitmaps and sizes overlap by more."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) != len(y):  # a shorter bitmap is the longer one's neighbours joined
        x, y = (np.packbits(np.unpackbits(v).reshape(min(len(x), len(y)) * 8, -1).any(axis=1)) for v in (x, y))
    lacking = [int(np.bitwise_count(p & ~q).sum()) for p, q in ((x, y), (y, x))]
    return min(n_a - lacking[0], n_b - lacking[1])


def _linked(percent: int):
    @F.pandas_udf("boolean")
    def possible(a, n_a, b, n_b):
        import pandas as pd

        return pd.Series([linked(overlap_bound(p, i, q, j), i, j, percent) for p, i, q, j in zip(a, n_a, b, n_b, strict=True)], dtype=bool)

    @F.pandas_udf("boolean")
    def certain(a, b):
        import pandas as pd

        found = []
        for p, q in zip(a, b, strict=True):
            x, y = unpacked_set(p), unpacked_set(q)
            at = np.searchsorted(y, x)
            found.append(linked(int((y[np.minimum(at, len(y) - 1)] == x).sum()), len(x), len(y), percent))
        return pd.Series(found, dtype=bool)

    return possible, certain


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int, bounded: bool = False) -> DataFrame:
    """The pairs (a, a_digest, b, b_digest) that link: bitmaps first, unless
    they are ``bounded`` by them already, then the sorted arrays of the pairs
    that are left."""
    possible, certain = _linked(percent)

    def with_sides(df: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
        for side in "ab":
            own = sets.select(F.col("id").alias(side), F.col("digest").alias(f"{side}_digest"), *[F.col(c).alias(f"{side}_{c}") for c in columns])
            df = df.join(own, [side, f"{side}_digest"])
        return df

    if not bounded:
        pairs = with_sides(pairs, sets, "n", "bits").filter(possible("a_bits", "a_n", "b_bits", "b_n"))
    pairs = keep_table(pairs.select("a", "a_digest", "b", "b_digest"), "bounded")
    pairs = shuffled_if_large(pairs, pairs.count())
    # Only the arrays of these pairs are shuffled.
    ids = sets.sparkSession.sparkContext.broadcast(id_filter(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))))
    arrays = sets.select("id", "digest", "shingles")
    arrays = arrays.mapInArrow(lambda batches: _passing(batches, ids.value, "id"), arrays.schema)
    return with_sides(pairs, arrays, "shingles").filter(certain("a_shingles", "b_shingles")).select("a", "b")


def _ordered_pair():
    """The columns of a pair, the smaller (id, digest) first."""
    a, b = (F.struct(F.col(s).alias("id"), F.col(f"{s}_digest").alias("digest")) for s in "ab")
    sides = {"a": F.least(a, b), "b": F.greatest(a, b)}
    return [c for s, side in sides.items() for c in (side["id"].alias(s), side["digest"].alias(f"{s}_digest"))]


def linked(overlap: int, n_a: int, n_b: int, percent: int) -> bool:
    return 100 * overlap >= percent * (n_a + n_b - overlap)


def _contested(percent: int):
    def pairs(table: pa.Table) -> pa.Table:
        """Pairs of different components that share no earlier tile and that
        sizes, places in the order and bitmaps allow."""
        cols = {c: table.column(c).to_numpy() for c in ("tile", "id", "digest", "size", "rank", "component")}
        order = np.lexsort((cols["id"], cols["size"], cols["tile"]))
        tile, ids, digests, sizes, ranks, comp = (cols[c][order] for c in ("tile", "id", "digest", "size", "rank", "component"))
        bits = table.column("bits").take(pa.array(order)).to_pylist()
        before = table.column("before").take(pa.array(order)).to_pylist()
        earlier: dict[int, frozenset] = {}

        def met_before(i: int, j: int) -> bool:
            for k in (i, j):
                if k not in earlier:
                    earlier[k] = frozenset(unpacked_set(before[k]).tolist())
            return not earlier[i].isdisjoint(earlier[j])

        def words(i: int, size: int) -> np.ndarray:
            """The bitmap folded to ``size`` bytes."""
            whole_map = np.frombuffer(bits[i], np.uint8)
            if len(whole_map) == size:
                return whole_map
            return np.packbits(np.unpackbits(whole_map).reshape(size * 8, -1).any(axis=1))

        def closer(first: int, i: int, others: np.ndarray, n: np.ndarray) -> np.ndarray:
            """Those that the bitmaps of i and each other allow at the width of i's
            own, which is the smaller one or the same."""
            if not len(others):
                return others
            own = np.frombuffer(bits[first + i], np.uint8)
            theirs = np.stack([words(first + int(j), len(own)) for j in others])
            lacks = np.bitwise_count(own & ~theirs).sum(axis=1, dtype=np.int64)
            extra = np.bitwise_count(~own & theirs).sum(axis=1, dtype=np.int64)
            bound = np.minimum(n[i] - lacks, n[others] - extra)
            return others[100 * bound >= percent * (n[i] + n[others] - bound)]

        new = np.ones(len(tile), dtype=bool)
        new[1:] = tile[1:] != tile[:-1]
        starts = np.flatnonzero(new)
        found: set[tuple] = set()
        for start, end in zip(starts, [*starts[1:], len(tile)], strict=True):
            # One width for the tile first; folding only loosens the bound.
            width = min(len(bits[i]) for i in range(start, end))
            rows = np.stack([words(i, width) for i in range(start, end)])
            n = sizes[start:end]
            most = partner_sizes(n, ranks[start:end].astype(np.int64), percent)
            for i in range(end - start):
                stop = int(np.searchsorted(n, most[i], side="right"))
                others = np.flatnonzero((comp[start + i + 1 : start + stop] != comp[start + i]) & (most[i + 1 : stop] >= n[i])) + i + 1
                if not len(others):
                    continue
                for block in np.array_split(others, -(-len(others) // 4096)):
                    lacks = np.bitwise_count(rows[i] & ~rows[block]).sum(axis=1, dtype=np.int64)
                    extra = np.bitwise_count(~rows[i] & rows[block]).sum(axis=1, dtype=np.int64)
                    bound = np.minimum(n[i] - lacks, n[block] - extra)
                    passed = block[100 * bound >= percent * (n[i] + n[block] - bound)]
                    for j in closer(int(start), i, passed, n):
                        if met_before(int(start) + i, int(start) + int(j)):
                            continue
                        p, q = sorted(((int(ids[start + i]), int(digests[start + i])), (int(ids[start + j]), int(digests[start + j]))))
                        found.add((*p, *q))
        columns = list(zip(*found, strict=True)) or [[], [], [], []]
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("a", "a_digest", "b", "b_digest"), columns, strict=True)})

    return pairs


def ngram_join(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 5, percent: int = 75) -> DataFrame:
    """Per row: ``key``, ``n_shingles`` and ``component_id``, the smallest id
    that links reach from it, its own included.

    Words stand between ASCII white space, A-Z in lower case. A document's set
    is its distinct shingles of ``length`` words, or its whole sequence if it
    is shorter. Two documents link if their sets overlap by ``percent`` of
    their union at least. Without words (null, empty) a document links with
    nothing. Ids are whole numbers; rows without an id are in no component
    (null). Rows under one id are versions of one document: a link of either is
    a link of both, and rows alike in id and text are one row of the result.
    Other columns are ignored. Shingles are known by 48 bits of a hash.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(key).cast("bigint").alias("_id"), F.xxhash64(F.col(key), whole(text)).alias("_row"), whole(text).cast("binary").alias("_text")
    )
    identified = rows.filter(F.col("_id").isNotNull())
    every = keep_table(identified.mapInArrow(_document_rows(length), "id bigint, row bigint, digest bigint, size bigint"), "sets")
    frequency = spark.sparkContext.broadcast(shingle_counts(identified, length))
    buckets = 4 * shuffle_width(spark)
    blocks = identified.mapInArrow(_prefixes(length, percent, frequency, buckets), "bucket int, block binary")
    members = keep_table(blocks.groupBy("bucket").applyInArrow(_tiles(percent), MEMBERS), "tiles")

    wanted = spark.sparkContext.broadcast(id_filter(members.select("id").distinct()))
    sets = keep_table(
        identified.mapInArrow(
            _set_rows(length, percent, frequency, wanted), "id bigint, digest bigint, n bigint, bits binary, shingles binary, prefix binary"
        ),
        "shingles",
    )
    tried = [
        members.filter(F.col("digest") != F.col(f"{other}_digest")).select(
            F.col(other).alias("a"), F.col(f"{other}_digest").alias("a_digest"), F.col("id").alias("b"), F.col("digest").alias("b_digest")
        )
        for other in ("leader", "next")
    ]
    led = tried[0].unionByName(tried[1]).select(*_ordered_pair())
    links = keep_table(confirmed(led.distinct(), sets, percent), "links")

    # The tiles that still hold several components.
    joined = components(links)
    placed = members.join(joined, members["id"] == joined["node"], "left").select(
        "tile", "id", "digest", "size", "rank", F.coalesce("component", "id").alias("component")
    )
    placed = keep_table(placed, "placed")
    member = F.xxhash64("id", "digest")
    contested = placed.groupBy("tile").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members"),
        F.bit_xor(member).alias("xor"), F.bit_xor(F.xxhash64(F.lit(1), "digest", "id")).alias("other_xor"),
        F.sum("rank").alias("ranks"),
    ).filter("low < high")
    # Tiles of the same members hold the same pairs: the first in the order, which is first in every member, will do.
    contested = contested.groupBy("members", "xor", "other_xor").agg(F.min(F.struct("ranks", "tile"))["tile"].alias("tile"))
    bits = sets.select(F.col("id").alias("of_id"), F.col("digest").alias("of_digest"), "bits", "prefix").dropDuplicates(["of_id", "of_digest"])
    open_members = placed.join(contested.select("tile"), "tile", "left_semi")
    open_members = open_members.join(bits, (F.col("id") == F.col("of_id")) & (F.col("digest") == F.col("of_digest")))
    open_members = open_members.withColumn("before", F.expr("substring(prefix, 1, 6 * rank)")).drop("of_id", "of_digest", "prefix")
    pairs = (
        open_members.withColumn("bucket", F.pmod(F.xxhash64("tile"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInArrow(_contested(percent), "a bigint, a_digest bigint, b bigint, b_digest bigint")
    )
    more = confirmed(pairs.distinct(), sets, percent, bounded=True)
    classes = keep_table(every.filter("digest <> 0").groupBy("digest", "size").agg(F.min("id").alias("stands")), "classes")
    versions = every.filter("digest <> 0").join(classes, ["digest", "size"]).select(F.col("id").alias("a"), F.col("stands").alias("b"))
    all_links = links.unionByName(more).unionByName(versions)
    grouped = components(all_links)
    out = every.join(grouped, every["id"] == grouped["node"], "left").select(
        F.col("id").alias(key), F.col("size").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")
    )
    nameless = rows.filter(F.col("_id").isNull()).mapInArrow(_nameless(length), f"`{key}` bigint, n_shingles bigint, component_id bigint")
    return out.unionByName(nameless)


def _nameless(length: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column("_row").to_pylist(), batch.column("_text").to_pylist(), strict=True):
                docs, _ = document_sets(Slice([0], [row], [text], lower=True), length)
                none = pa.array([None], pa.int64())
                yield pa.RecordBatch.from_arrays([none, pa.array([len(docs)], pa.int64()), none], names=["id", "n", "c"])

    return rows
