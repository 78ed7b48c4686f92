"""Secrets in text: known shapes, and strings that pass for random.

Three shapes are matched as they are written: assignments to a secret's name,
access keys, hexadecimal runs. Besides them every long run of token characters
goes through a battery of tests for randomness in its inferred encoding
(hexadecimal, base 32, 36, 62 or 64), and if it fits none, its parts do:

* chi-squared: do the encoding's symbols occur equally often?
* runs: are values above and below the middle as mixed as chance has them?
* serial correlation: does a value tell anything about the next?

A token that one of them rejects is no secret. For those that pass, the chance
that a written word or name would change between digits, capitals and small
letters as often as the token does is bounded by a large-deviation bound, which
shrinks with length: short tokens need more evidence. Over the whole corpus the
false discoveries among the accepted tokens are then held at ``fdr`` by the
step-up rule on these bounds. Its only global state is a histogram of a fixed
number of bins.

Positions come from the gaps between matches: their lengths are summed in a
window per document and shape, so texts never move, only matches do.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtide.llm.common import ID, ROW, identified, keep_table

# The shapes, in the order in which spans at one place are listed.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ["assign", "access", "hex", "random"]
TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
# The alphabets tokens are held against, smallest first.
ENCODINGS = {
    "hex": (r"^(?:[0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    "base32": (r"^(?:[A-Z2-7]+|[a-z2-7]+)$", "abcdefghijklmnopqrstuvwxyz234567"),
    "base36": (r"^(?:[A-Z0-9]+|[a-z0-9]+)$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    "base62": (r"^[A-Za-z0-9]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    "base64": (r"^[A-Za-z0-9+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    "base64url": (r"^[A-Za-z0-9_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
}
# Encodings in capitals or small letters alone, which mean the same.
FOLDED = ("hex", "base32", "base36")
# What a token that fits no encoding is cut into.
PARTS = [r"[A-Za-z0-9_-]{20,}={0,2}", r"[A-Za-z0-9+/]{20,}={0,2}", r"[A-Za-z0-9]{20,}={0,2}"]
# How often neighbouring characters of words and names change their class.
CHANGES = 0.15
BINS = 400


def _found(pattern: str, text: Column, measured: int = 0) -> Column:
    """Matches with the gap in front of each and the length that decides."""
    gaps = F.split(text, pattern, -1)
    whole, part = (F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (0, measured))
    zipped = F.arrays_zip(F.slice(gaps, 1, F.greatest(F.size(gaps) - 1, F.lit(0))).alias("gap"), whole.alias("match"), part.alias("part"))
    nothing = F.array().cast("array<struct<gap:string,match:string,part:string>>")
    return F.when(F.regexp_like(text, F.lit(pattern)), zipped).otherwise(nothing)


def matches(rows: DataFrame) -> DataFrame:
    """Row identity, kind (as a number), start, end, matched text."""
    text = F.col("_text")
    shapes = [(ASSIGN, 2, 12), (ACCESS, 0, 18), (HEX + r"(?<=[0-9a-f]{16})", 0, 16), (TOKEN, 0, 20)]
    per_kind = F.array(
        *[
            F.struct(F.lit(k).alias("kind"), F.lit(least).alias("least"), _found(pattern, text, group).alias("found"))
            for k, (pattern, group, least) in enumerate(shapes)
        ]
    )
    each = (
        rows.select(ID, ROW, F.explode(per_kind).alias("k"))
        .select(ID, ROW, "k.kind", "k.least", F.posexplode("k.found").alias("n", "m"))
        .select(
            ID, ROW, "kind", "n",
            F.char_length("m.gap").alias("gap"),
            F.char_length("m.match").alias("length"),
            F.when(F.char_length("m.part") >= F.col("least"), F.col("m.match")).alias("match"),
        )
        .dropDuplicates([ID, ROW, "kind", "n"])
    )
    so_far = Window.partitionBy(ID, ROW, "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap").cast("bigint") + F.col("length")).over(so_far)
    return (
        each.withColumn("end", end)
        .filter(F.col("match").isNotNull())
        .select(ID, ROW, "kind", (F.col("end") - F.col("length")).alias("start"), "end", "match")
    )


def _normal_tail(z: Column) -> Column:
    """Two-sided tail of the normal distribution, from above: the bound
    exp(-z*z/2), which is all the battery's rejection needs."""
    return F.least(F.lit(1.0), F.exp(-z * z / 2))


def with_encoding(tokens: DataFrame, token: str = "match") -> DataFrame:
    """The frame with ``encoding`` (null if none fits), its letters and the
    token in them."""
    core = F.rtrim(F.col(token), F.lit("="))
    encoding, alphabet, symbols = F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, (pattern, letters) in reversed(ENCODINGS.items()):
        fits = core.rlike(pattern)
        encoding = F.when(fits, name).otherwise(encoding)
        alphabet = F.when(fits, letters).otherwise(alphabet)
        folded = F.lower(core) if name in FOLDED else core
        symbols = F.when(fits, folded).otherwise(symbols)
    return tokens.select("*", encoding.alias("encoding"), alphabet.alias("_alphabet"), symbols.alias("_core"))


def battery(tokens: DataFrame, token: str = "match") -> DataFrame:
    """The frame with ``encoding`` (null if none fits), ``p_uniform``,
    ``p_runs``, ``p_serial`` (small: not random) and ``p_written`` (small: no
    word or name). A token of any length is judged by all its characters, in
    time that grows with their number, if ``with_encoding`` has been written to
    a table: otherwise the letters are worked out again for each character."""
    with_letters = tokens if "_core" in tokens.columns else with_encoding(tokens, token)
    core = F.rtrim(F.col(token), F.lit("="))
    chars = F.filter(F.split("_core", ""), lambda c: c != "")
    values = F.transform(chars, lambda c: F.instr(F.col("_alphabet"), c).cast("double"))
    measured = with_letters.withColumns({"_values": values, "_size": F.char_length("_alphabet").cast("double")})
    measured = measured.withColumn("_n", F.size("_values").cast("double"))
    # Symbol counts without a shuffle: what is missing after a symbol is removed.
    count = lambda c: (F.char_length("_core") - F.char_length(F.replace(F.col("_core"), c))).cast("double")
    squares = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda s, c: s + count(c) * count(c))
    chi = squares * F.col("_size") / F.col("_n") - F.col("_n")
    freedom = F.col("_size") - 1
    # Cube-root transform of chi-squared to a normal variable.
    z_uniform = (F.cbrt(F.greatest(chi, F.lit(0.0)) / freedom) - (1 - 2 / (9 * freedom))) / F.sqrt(2 / (9 * freedom))
    shifted = F.slice("_values", 2, F.greatest(F.size("_values") - 1, F.lit(0)))
    pairs = F.arrays_zip(F.slice("_values", 1, F.greatest(F.size("_values") - 1, F.lit(0))).alias("a"), shifted.alias("b"))
    middle = (F.col("_size") + 1) / 2
    crossings = F.size(F.filter(pairs, lambda p: (p["a"] > middle) != (p["b"] > middle))).cast("double")
    steps = F.greatest(F.col("_n") - 1, F.lit(1.0))
    z_runs = (crossings - steps / 2) / (F.sqrt(steps) / 2)
    spread = (F.col("_size") * F.col("_size") - 1) / 12
    product = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + (p["a"] - middle) * (p["b"] - middle))
    z_serial = product / spread / F.sqrt(steps)
    kind = lambda c: F.when(c.rlike("[0-9]"), 0).when(c.rlike("[A-Z]"), 1).when(c.rlike("[a-z]"), 2).otherwise(3)
    kinds = F.transform(F.filter(F.split(core, ""), lambda c: c != ""), kind)
    changed = F.size(
        F.filter(
            F.arrays_zip(F.slice(kinds, 1, F.greatest(F.size(kinds) - 1, F.lit(0))).alias("a"), F.slice(kinds, 2, F.greatest(F.size(kinds) - 1, F.lit(0))).alias("b")),
            lambda p: p["a"] != p["b"],
        )
    ).cast("double")
    rate = F.least(F.greatest(changed / steps, F.lit(CHANGES)), F.lit(1 - 1e-9))
    # Chernoff: n steps change at this rate or more with at most exp(-n * divergence).
    divergence = rate * F.log(rate / CHANGES) + (1 - rate) * F.log((1 - rate) / (1 - CHANGES))
    return measured.withColumns(
        {
            "p_uniform": F.when(z_uniform > 0, _normal_tail(z_uniform)).otherwise(1.0),
            "p_runs": _normal_tail(z_runs),
            "p_serial": _normal_tail(z_serial),
            "p_written": F.exp(-steps * divergence),
        }
    ).drop("_alphabet", "_core", "_values", "_size", "_n")


def discovery_bin(judged: DataFrame, fdr: float) -> int:
    """The step-up rule over the whole corpus, from a histogram of -log10 p:
    the least bin from which on tokens are accepted. At most ``BINS`` + 1
    counts reach the driver, whatever the corpus."""
    bins = {r["bin"]: r["n"] for r in judged.groupBy("bin").agg(F.count("*").alias("n")).collect()}
    total, above, least = sum(bins.values()), 0, BINS + 1
    for b in sorted(bins, reverse=True):
        above += bins[b]
        if 10.0 ** -b <= fdr * above / total:
            least = b
    return least


def parted(tokens: DataFrame) -> DataFrame:
    """Tokens with ``token`` (where the match starts) and ``cut``. Those that
    hold '/' or '+' besides '-' or '_' fit no encoding: their parts of 20
    characters and more stand for them, once for each way to cut."""
    mixed = F.col("match").rlike("[+/]") & F.col("match").rlike("[_-]")
    columns = [ID, ROW, "kind", "start", "end", "match", "token", "cut"]
    per_cut = F.array(*[F.struct(F.lit(c).alias("cut"), _found(pattern, F.col("match")).alias("found")) for c, pattern in enumerate(PARTS)])
    so_far = Window.partitionBy(ID, ROW, "token", "cut").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = (
        tokens.filter(mixed)
        .select(ID, ROW, "kind", F.col("start").alias("token"), F.explode(per_cut).alias("k"))
        .select(ID, ROW, "kind", "token", "k.cut", F.posexplode("k.found").alias("n", "m"))
        .select(ID, ROW, "kind", "token", "cut", "n", F.char_length("m.gap").alias("gap"), F.col("m.match").alias("match"))
        .withColumn("end", F.col("token") + F.sum(F.col("gap").cast("bigint") + F.char_length("match")).over(so_far))
        .withColumn("start", F.col("end") - F.char_length("match"))
    )
    entire = tokens.filter(~mixed).select("*", F.col("start").alias("token"), F.lit(0).alias("cut"))
    return entire.select(*columns).unionByName(parts.select(*columns).dropDuplicates([ID, ROW, "start", "end"]))


def apart(accepted: DataFrame) -> DataFrame:
    """Of accepted parts of a token that overlap, the one least like a word;
    words beside a key add little, so a part without separators comes first
    unless another has a quarter more evidence."""
    evidence = F.log(F.greatest(F.col("p_written"), F.lit(math.ulp(0.0)))) * F.when(F.col("match").rlike("[/+_-]"), 1.0).otherwise(1.25)
    part = F.struct(evidence.alias("order"), (F.col("start") - F.col("end")).alias("size"), "start", "end")
    none = F.array().cast("array<struct<order:double,size:bigint,start:bigint,end:bigint>>")
    taken = F.aggregate(
        F.array_sort(F.collect_list(part)),
        none,
        lambda held, p: F.when(F.exists(held, lambda h: (h["start"] < p["end"]) & (p["start"] < h["end"])), held).otherwise(F.concat(held, F.array(p))),
    )
    return accepted.groupBy(ID, ROW, "kind", "token").agg(taken.alias("taken")).select(ID, ROW, "kind", F.inline("taken")).drop("order", "size")


def random_tokens(tokens: DataFrame, alpha: float = 1e-3, fdr: float = 0.01) -> DataFrame:
    fitting = keep_table(with_encoding(parted(tokens)).filter(F.col("encoding").isNotNull()), "tokens")
    judged = battery(fitting)
    passed = (F.col("p_uniform") >= alpha) & (F.col("p_runs") >= alpha) & (F.col("p_serial") >= alpha)
    judged = judged.withColumn(
        "bin", F.least(F.lit(BINS), F.floor(-F.log10(F.greatest(F.col("p_written"), F.lit(math.ulp(0.0))))).cast("int"))
    )
    # Written before it is filtered: a filter would work out each figure again.
    judged = keep_table(judged, "judged")
    return apart(judged.filter(passed & (F.col("bin") >= discovery_bin(judged, fdr))))


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", alpha: float = 1e-3, fdr: float = 0.01) -> DataFrame:
    """Per row of the input: ``key``, ``n_assign``, ``n_access``, ``n_hex``,
    ``n_random`` and ``spans``, an array of (start, kind, end) sorted by start
    and then kind (an index into ``KINDS``); starts and ends count code points,
    end exclusive.

    Null and empty texts have no spans. Rows alike in id and text give the same
    result each. Spans of different kinds may overlap; those of one kind do
    not. Other columns are ignored.
    """
    rows = identified(docs, key, text)
    # One pass over the texts, whatever becomes of the matches.
    found = keep_table(matches(rows), "matches")
    columns = [ID, ROW, "kind", "start", "end"]
    random = random_tokens(found.filter("kind = 3"), alpha, fdr)
    spans = (
        found.filter("kind < 3").select(*columns).unionByName(random.select(*columns))
        .groupBy(ID, ROW)
        .agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    )
    every = rows.select(F.col(ID).alias("_in_id"), F.col(ROW).alias("_in_row"))
    joined = every.join(spans, every["_in_id"].eqNullSafe(spans[ID]) & (every["_in_row"] == spans[ROW]), "left")
    listed = F.coalesce("spans", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    of_kind = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint")
    return joined.select(F.col("_in_id").alias(key), listed.alias("spans")).select(
        key, *[of_kind(k).alias(f"n_{name}") for k, name in enumerate(KINDS)], "spans"
    )


def listed_spans(spans: str, base_only: bool = False) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    picked = F.filter(spans, lambda s: s["kind"] < 3) if base_only else F.col(spans)
    return F.array_join(F.transform(picked, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")
