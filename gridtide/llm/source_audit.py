"""How far the sources of a language differ in the words they use.

Every kept term of a language is a row of an indicator matrix, and every pair
of (source, count level) a column: a term has a one in the column of its count
in each source, and in the column of level 0 where the source lacks it. The
product of the matrix with its transpose holds, for each two sources, how many
terms have count c in one and count d in the other. These joint tables are all
that is needed to add up a price that depends on (source, count) alone.

The product is worked out in blocks: rows of one hash block of terms, and two
blocks of at most ``SOURCES`` sources each. A block's table is priced where it
is made, and only one sum per pair of sources leaves it. Terms with no count in
either block of sources are added at the end: they all stand in one cell.

Terms are counted inside the tasks that read the texts, a bounded number of
entries at a time, so a word that a third of all rows hold sends one row per
flush.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtide.llm.common import keep_table, whole
from gridtide.llm.words import in_parts

# What one flush, one block of terms and one block of sources hold.
ENTRIES, TERMS, SOURCES = 250_000, 64, 32
# The bytes of a term, A-Z in lower case; all others part terms.
LETTERS = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SMOOTH, SCALE = 5, 1_000_000_000

COUNTS = "lang string, source string, term string, n bigint, docs bigint"
PRICED = "lang string, source string, item string, value bigint, seen bigint, gap bigint, terms bigint"


def _flush(found: dict, held: dict) -> pa.RecordBatch:
    def repeated(part: int) -> pa.Array:
        return pa.concat_arrays([pa.repeat(pa.scalar(key[part], pa.string()), len(counts)) for key, counts in found.items()])

    def numbers(values: Iterator[int]) -> pa.Array:
        return pa.array(np.fromiter(values, np.int64))

    terms = pa.array([term for counts in found.values() for term in counts], pa.binary()).cast(pa.string())
    n = numbers(v for counts in found.values() for v in counts.values())
    docs = numbers(held[key][term] for key, counts in found.items() for term in counts)
    return pa.RecordBatch.from_arrays([repeated(0), repeated(1), terms, n, docs], names=["lang", "source", "term", "n", "docs"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per language, source and term."""
    found, held, entries = defaultdict(Counter), defaultdict(Counter), 0
    for batch in in_parts(batches):
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            terms = text.as_py().translate(LETTERS).split()
            counts = found[lang, source]
            entries -= len(counts)
            counts.update(terms)
            entries += len(counts)
            held[lang, source].update(set(terms))
            if entries >= ENTRIES:
                yield _flush(found, held)
                found, held, entries = defaultdict(Counter), defaultdict(Counter), 0
    if entries:
        yield _flush(found, held)


def _share(count: Column, total: Column, terms: Column) -> Column:
    """The smoothed share of a count in whole billionths, by exact division."""
    over = (count + SMOOTH).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    under = total.cast("decimal(20,0)") + (terms * SMOOTH).cast("decimal(20,0)")
    return F.call_function("div", over, under).cast("bigint") + 1


def _priced_block(key: tuple, entries: pa.Table, block: pa.Table) -> pa.Table:
    """One block of the product, with every joint table in it priced."""
    left, right = block.column("left")[0].as_py(), block.column("right")[0].as_py()
    same = key[2].as_py() == key[3].as_py()
    sources = left if same else left + right
    column_of = {s["idx"]: i for i, s in enumerate(sources)}
    terms, rows = np.unique(entries.column("term").to_numpy(), return_inverse=True)
    at = np.array([column_of[i] for i in entries.column("idx").to_pylist()], dtype=np.int64)
    levels = np.zeros((len(terms), len(sources)), dtype=np.int64)
    prices = np.tile(np.array([s["p0"] for s in sources], dtype=np.int64), (len(terms), 1))
    levels[rows, at] = entries.column("n").to_numpy()
    prices[rows, at] = entries.column("p").to_numpy()
    # One column for each (source, level) that occurs here.
    owner, price, ones = [], [], []
    for s in range(len(sources) if len(terms) else 0):
        level, first, which = np.unique(levels[:, s], return_index=True, return_inverse=True)
        owner.append(np.full(len(level), s))
        price.append(prices[first, s])
        ones.append(which[:, None] == np.arange(len(level)))
    value = np.zeros((len(sources), len(sources)), dtype=np.int64)
    if len(terms):
        owner, price = np.concatenate(owner), np.concatenate(price)
        indicator = np.concatenate(ones, axis=1).astype(np.float32)  # a cell counts terms of a block: exact
        cut = 0 if same else int(np.searchsorted(owner, len(left)))
        joint = (indicator[:, : cut or None].T @ indicator[:, cut:]).astype(np.int64)
        i, j = np.nonzero(joint)
        np.add.at(value, (owner[i], owner[j + cut]), joint[i, j] * np.abs(price[i] - price[j + cut]))
    pairs = [(a, b) for a in range(len(left)) for b in range(0 if same else len(left), len(sources)) if a != b]
    if not same:
        value = np.maximum(value, value.T)
        pairs += [(b, a) for a, b in pairs]
    return pa.table(
        {
            "lang": pa.array([key[0].as_py()] * len(pairs), pa.string()),
            "source": pa.array([sources[a]["source"] for a, _ in pairs], pa.string()),
            "item": pa.array([sources[b]["source"] for _, b in pairs], pa.string()),
            "value": pa.array([int(value[a, b]) for a, b in pairs], pa.int64()),
            "seen": pa.array([len(terms)] * len(pairs), pa.int64()),
            "gap": pa.array([abs(sources[a]["p0"] - sources[b]["p0"]) for a, b in pairs], pa.int64()),
            "terms": pa.array([block.column("terms")[0].as_py()] * len(pairs), pa.int64()),
        }
    )


def kept_counts(docs: DataFrame, text: str, lang: str, source: str, min_docs: int) -> DataFrame:
    """lang, source, term, n and the language's own count of the term, for the
    terms that at least ``min_docs`` documents of the language hold."""
    texts = docs.select(whole(lang).alias("lang"), whole(source).alias("source"), whole(text).cast("binary").alias("text"))
    counts = texts.mapInArrow(_count, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = keep_table(counts, "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs)
    return keep_table(counts.drop("docs").join(kept.drop("docs"), ["lang", "term"]), "kept-terms")


def audit_sources(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 30, top_terms: int = 50
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``.

    A term is a run of letters (A-Z in lower case) and characters beyond ASCII;
    a language keeps those that at least ``min_docs`` of its rows hold. The
    smoothed share of a term is 1 + floor(10^9 (n + 5) / (N + 5 V)), n its
    count, N that of all V kept terms. Part ``pair`` has every other source of
    the language with the sum of all differences of shares; part ``term`` the
    ``top_terms`` terms the source has and whose share is above the language's.
    Ranks start at 1 with the greatest value; equal values go by the item.

    Null text, lang and source count as empty text. Every row counts, repeated
    ones too. A group without kept terms has pairs, of sum 0 if its language
    keeps none, and no terms. No rows give no rows. Other columns are ignored.
    The pairs of a language are as many as its sources squared.
    """
    held = kept_counts(docs, text, lang, source, min_docs)
    langs = held.groupBy("lang", "term").agg(F.first("n_lang").alias("n_lang"))
    langs = langs.groupBy("lang").agg(F.sum("n_lang").alias("lang_total"), F.count("*").alias("terms"))
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select(whole(lang).alias("lang"), whole(source).alias("source")).distinct()
    groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "lang_total", "terms"])
    p0 = F.when(F.col("terms") > 0, _share(F.lit(0), F.col("total"), F.col("terms"))).otherwise(F.lit(0)).alias("p0")
    idx = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("idx")
    groups = keep_table(groups.select("*", idx, p0).withColumn("part", F.floor(F.col("idx") / SOURCES).cast("int")), "groups")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("terms") / TERMS)).cast("int")

    facts = groups.select("lang", "source", "idx", "part", "total", "lang_total", "terms")
    priced = held.join(facts, ["lang", "source"])
    p, q = _share(F.col("n"), F.col("total"), F.col("terms")), _share(F.col("n_lang"), F.col("lang_total"), F.col("terms"))
    above = priced.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (p - q).alias("value")).filter("value > 0")

    parts = groups.groupBy("lang", "part", "terms").agg(F.sort_array(F.collect_list(F.struct("idx", "source", "p0"))).alias("of"))
    a, b = parts.select("lang", "terms", F.col("part").alias("a"), F.col("of").alias("left")), parts.select("lang", F.col("part").alias("b"), F.col("of").alias("right"))
    tiles = a.join(b, "lang").filter("a <= b").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    n_parts = groups.groupBy("lang").agg((F.max("part") + 1).alias("n_parts"))
    other = F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1)).alias("other")
    entries = (
        priced.join(n_parts, "lang")
        .select("lang", "term", "idx", "part", "n", p.alias("p"), F.pmod(F.xxhash64("term"), blocks).cast("int").alias("block"), other)
        .select("lang", "block", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "term", "idx", "n", "p")
    )
    key = ["lang", "block", "a", "b"]
    sums = entries.groupBy(*key).cogroup(tiles.groupBy(*key)).applyInArrow(_priced_block, PRICED)
    unseen = (F.max("terms") - F.sum("seen")) * F.max("gap")
    pairs = sums.groupBy("lang", "source", "item").agg((F.sum("value") + unseen).alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    return pairs.select("*", rank).unionByName(above.select("*", rank).filter(F.col("rank") <= top_terms))
