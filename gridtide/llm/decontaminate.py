"""Benchmark text in training documents, by winnowing.

A passage counts from ``window`` words on. Of each run of ``window`` words only
the least hash of its ``gram``-word grams is kept, so two texts that share such
a run share a fingerprint for certain, while a document gives two fingerprints
for every ``window - gram + 2`` words. Documents that share no fingerprint with
any item are done. In the others each hit is extended to the windows around it:
runs of ``window`` words are joined with the items' on their hash and compared
word by word. Items shorter than a window are one window each; there are at
most ``window - 1`` such lengths, and each is looked up whole.

Everything up to the fingerprints happens inside a document's row. The items'
side is broadcast only when a count of it shows it small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtide.llm.common import ID, ROW, ascii_lower, identified, keep_table, whole

# Fixed value: what stands between words, whatever the case of their letters.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BROADCAST_ROWS = 500_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BETWEEN, -1), "")


def same_case(words: Column) -> Column:
    return F.transform(words, lambda w: ascii_lower(w))


def _let(value: Column, use) -> Column:
    """use(value), with the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _reach(values: Column, length: int, combine) -> Column:
    """Each element replaced by what ``combine`` makes of it and the
    ``length - 1`` elements after it, in log(length) passes. Runs may overlap
    in the last pass, which neither a minimum nor a hash of runs minds; past
    the end there is null, which both ignore."""
    covered = 1
    while covered < length:
        step = min(covered, length - covered)
        values = _let(values, _with_later(step, combine))
        covered += step
    return values


def _with_later(step: int, combine):
    return lambda v: F.transform(v, lambda a, i: combine(a, F.get(v, i + step)))


def _first(values: Column, words: Column, length: int) -> Column:
    """Without the runs that end past the last word."""
    return F.slice(values, 1, F.greatest(F.size(words) - (length - 1), F.lit(0)))


def _hashes(words: Column, length: int) -> Column:
    # Full lower-casing joins more words than A-Z alone, so nothing is missed.
    return _reach(F.transform(words, lambda w: F.xxhash64(F.lower(w))), length, lambda a, b: F.xxhash64(a, b))


def grams(words: Column, length: int) -> Column:
    """A hash for each run of ``length`` words, at its first word."""
    return _first(_hashes(words, length), words, length)


def fingerprints(words: Column, window: int, gram: int) -> Column:
    """The distinct least gram hashes of all windows."""
    least = _reach(_hashes(words, gram), window - gram + 1, lambda a, b: F.least(a, b))
    return F.array_distinct(_first(least, words, window))


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a frame if it has few rows; leave it to a shuffle if not."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _of_length(n: int):
    return lambda f: F.xxhash64(F.lit(n), f)


def suspects(rows: DataFrame, items: DataFrame, lengths: list[int], window: int, gram: int) -> DataFrame:
    """Row identity, ``n_words`` and ``hit``: whether the row shares a
    fingerprint with any item. Each text is read and split once."""
    words, mine, known = F.col("words"), F.array().cast("array<bigint>"), None
    if not lengths:
        return rows.select(ID, ROW, F.size("words").cast("bigint").alias("n_words"), F.lit(False).alias("hit")).distinct()
    for n in lengths:
        prints = fingerprints(words, n, gram) if n == window else grams(words, n)
        # Lengths are kept apart: a hash says what length it is of.
        tagged = prints if n == window else F.transform(prints, _of_length(n))
        mine = tagged if len(lengths) == 1 else F.concat(mine, tagged)
        of_n = items.filter(F.col("length") == n).select(F.explode(tagged).alias("known"))
        known = of_n if known is None else known.unionByName(of_n)
    own = rows.select(ID, ROW, F.size("words").cast("bigint").alias("n_words"), mine.alias("prints"))
    each = own.select(ID, ROW, "n_words", F.explode_outer("prints").alias("f"))
    met = each.join(_small(known.distinct()), F.col("f") == F.col("known"), "left")
    return met.groupBy(ID, ROW, "n_words").agg(F.max(F.col("known").isNotNull()).alias("hit"))


def _placed(rows: DataFrame, keep: list[str], n: int) -> DataFrame:
    """A row per run of n words: its place and hash. The hashes are worked out
    before, and the words left behind, so that exploding copies neither."""
    hashed = rows.select(*keep, grams(F.col("words"), n).alias("gs"))
    return hashed.select(*keep, F.posexplode("gs").alias("pos", "g"))


def extended(near: DataFrame, items: DataFrame, lengths: list[int]) -> DataFrame:
    """Row identity, start and length of each window hit, and its items: every
    window of the suspects against the items', by hash and then by word. Hits
    meet their document's words once, all of a document together."""
    hits = None
    for n in lengths:
        of_n = items.filter(F.col("length") == n).select("item", "words", grams(F.col("words"), n).alias("gs"))
        of_items = (
            of_n.select("item", "words", F.posexplode("gs").alias("pos", "g"))
            .select("g", same_case(F.slice("words", F.col("pos") + 1, F.lit(n))).alias("w"), "item")
            .groupBy("g", "w")
            .agg(F.collect_set("item").alias("items"))
        )
        found = _placed(near, [ID, ROW], n).join(_small(of_items), "g")
        found = found.select(ID, ROW, F.struct(F.col("pos").alias("start"), F.lit(n).alias("length"), "w", "items").alias("hit"))
        hits = found if hits is None else hits.unionByName(found)
    per_row = hits.groupBy(F.col(ID).alias("_hit_id"), F.col(ROW).alias("_hit_row")).agg(F.collect_list("hit").alias("hits"))
    met = near.join(per_row, near[ID].eqNullSafe(per_row["_hit_id"]) & (near[ROW] == per_row["_hit_row"]))
    same = F.filter("hits", lambda h: same_case(F.slice("words", h["start"] + 1, h["length"])) == h["w"])
    hit = met.select(ID, ROW, same.alias("hits")).select(ID, ROW, F.explode("hits").alias("hit"))
    return hit.select(ID, ROW, "hit.start", "hit.length", "hit.items")


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    gram: int = 7,
    row: str | None = None,
) -> DataFrame:
    """Per row of ``docs``: ``key``, ``n_words``, ``n_hit``, ``n_items``,
    ``items`` (ids as sorted strings) and ``contaminated``.

    Words are lower-cased in A-Z. A null or empty text has no words and cannot
    be hit. Items without words are ignored; items without an id hit words but
    are not listed; a repeated item id is listed once. Rows alike in id and
    text are one row of the result. Other columns are ignored. ``row`` names a
    column to add, the xxhash64 of the text (null as empty).
    """
    rows = identified(docs, key, text).select(ID, ROW, words_of(F.col("_text")).alias("words"))
    items = benchmark.select(F.col(item).cast("string").alias("item"), words_of(whole(item_text)).alias("words"))
    items = items.withColumn("length", F.least(F.size("words"), F.lit(window))).filter("length > 0")
    # At most ``window`` numbers.
    lengths = sorted(r["length"] for r in items.select("length").distinct().collect())
    checked = keep_table(suspects(rows, items, lengths, window, gram), "suspects")
    # Texts move only if the suspects are too many to broadcast, and words never.
    texts = identified(docs, key, text)
    suspected = _small(checked.filter("hit").select(F.col(ID).alias("_hit_id"), F.col(ROW).alias("_hit_row")))
    near = texts.join(suspected, texts[ID].eqNullSafe(suspected["_hit_id"]) & (texts[ROW] == suspected["_hit_row"]), "left_semi")
    near = keep_table(near, "near").select(ID, ROW, words_of(F.col("_text")).alias("words"))
    none = F.array().cast("array<string>")
    if lengths:
        spans = extended(near, items, lengths).groupBy(ID, ROW, "start", "length").agg(F.first("items").alias("items"))
        before = Window.partitionBy(ID, ROW).orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
        end = F.col("start") + F.col("length")
        reached = F.greatest(F.coalesce(F.max(end).over(before), F.lit(0)), F.col("start"))
        per_row = (
            spans.withColumn("fresh", F.greatest(end - reached, F.lit(0)))
            .groupBy(F.col(ID).alias("_hit_id"), F.col(ROW).alias("_hit_row"))
            .agg(F.sum("fresh").alias("n_hit"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
        )
        checked = checked.join(
            per_row, checked[ID].eqNullSafe(per_row["_hit_id"]) & (checked[ROW] == per_row["_hit_row"]), "left"
        )
    else:
        checked = checked.select("*", F.lit(0).alias("n_hit"), none.alias("items"))
    return checked.select(
        F.col(ID).alias(key),
        *([F.col(ROW).alias(row)] if row else []),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("bigint").alias("n_items"),
        F.array_sort(F.coalesce("items", none)).alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )
