"""Resampling, suffix dedup and the source audit against brute force."""

import random
import zlib

import brute
import numpy as np
import pytest
from corpus import framed
from hypothesis import given, settings
from hypothesis import strategies as st

from gridtide.llm import resample, source_audit, suffix_dedup
from gridtide.llm.words import FAMILIES, mixed, range_hashes

ITEMS = [(1, "the target has its own words and repeats its own words"), (2, None), (3, ""), (4, "word " * 50), (5, "été Été 12 a1")]


def items_frame(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id long, text string")


def drawn(docs, target, **options):
    return sorted(map(tuple, resample.resample(docs, target, **options).collect()), key=str)


@pytest.mark.parametrize("percent", [5, 60, 100])
def test_draw(spark, docs_frame, small_docs, percent):
    got = drawn(docs_frame, items_frame(spark), percent=percent)
    assert got == brute.resample(small_docs, [t for _, t in ITEMS], percent)
    assert len(got) == len(small_docs)


def test_draw_of_repeated_rows_ties_and_missing_ids(spark):
    text = " ".join(f"w{i}" for i in range(25))
    docs = [(7, text)] * 5 + [(None, text)] * 3 + [(None, text + " " + text), (3, None), (4, ""), (8, "short"), (9, text), (7, text + " w0")]
    got = drawn(framed(spark, docs).repartition(3), items_frame(spark), percent=70)
    assert got == brute.resample(docs, [t for _, t in ITEMS], 70)
    ranks = sorted(r[4] for r in got if r[4])
    assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) == 7


def test_draw_from_nothing(spark, empty_docs):
    assert drawn(empty_docs, items_frame(spark)) == []
    docs = [(i, "some words that stand here " * 5) for i in range(20)]
    assert drawn(framed(spark, docs), items_frame(spark, [])) == brute.resample(docs, [])
    assert drawn(framed(spark, [(1, "few"), (2, None)]), items_frame(spark)) == brute.resample([(1, "few"), (2, None)], [t for _, t in ITEMS])


def test_radix_ranks_over_many_blocks_and_digits(spark):
    rng = random.Random(3)
    rows = [(rng.choice([0, 5, -3, 2**40, rng.randint(-(2**62), 2**62)]), rng.randint(0, 9), i, rng.choice([1, 1, 1, 4])) for i in range(3000)]
    df = spark.createDataFrame(rows, "a long, b long, tie long, copies long").repartition(7)
    got = resample.radix_ranks(df, ["a", "b"], ["tie"], block_rows=100, bits=5).collect()
    place = 0
    for want, row in zip(sorted(rows), sorted(got, key=lambda r: r["place"]), strict=True):
        assert (row["a"], row["b"], row["tie"], row["place"]) == (*want[:3], place)
        place += want[3]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.one_of(st.binary(min_size=1, max_size=20), st.integers(100, 400).map(lambda n: b"z" * n)), max_size=8))
def test_crc_of_joined_words(words):
    for n, found in enumerate(resample.feature_buckets(words, 1 << 20), 1):
        want = [zlib.crc32(b" ".join(words[a : a + n])) % (1 << 20) for a in range(max(0, len(words) - n + 1))]
        assert list(found) == want


def cut(docs, **options):
    rows = suffix_dedup.suffix_dedup(docs, **options)
    return sorted(map(tuple, rows.drop("kept").collect()), key=str)


@pytest.mark.parametrize("length", [16, 60, 400])
def test_repeated_strings(spark, docs_frame, small_docs, length, monkeypatch):
    # Small buckets and samples, so that runs cross buckets and contents are common.
    monkeypatch.setattr(suffix_dedup, "BUCKET", 500)
    monkeypatch.setattr(suffix_dedup, "SAMPLE", 2000)
    assert cut(docs_frame, length=length) == brute.suffix_dedup(small_docs, length)


def test_repeated_strings_of_periodic_and_repeated_rows(spark):
    rng = random.Random(5)
    noise = "".join(rng.choice("abcdefghij") for _ in range(900))
    docs = [
        (1, "x" * 1000), (2, "ab" * 150), (3, noise), (4, noise[100:501]), (5, noise[:99] + "é" + noise[600:]), (6, noise[200:599]),
        (None, noise[:450]), (7, "q" + noise[450:850]), (8, None), (9, ""), (10, "lonely " * 3), (11, "twin" + noise[::-1]), (11, "twin" + noise[::-1]),
    ]
    got = cut(framed(spark, docs))
    assert got == brute.suffix_dedup(docs, 400)
    assert {r[0]: r[2] for r in got}[6] == 0


def test_kept_bytes(spark):
    docs = framed(spark, [(1, "head " + "abcdefghijklmnopqrst" * 2 + " tail"), (2, "none")])
    rows = {r["doc_id"]: bytes(r["kept"]) for r in suffix_dedup.suffix_dedup(docs, length=20).collect()}
    assert rows == {1: b"head  tail", 2: b"none"}
    with pytest.raises(ValueError):
        suffix_dedup.suffix_dedup(docs, length=15)


def test_no_strings_in_no_rows(empty_docs):
    assert cut(empty_docs) == []


def test_suffixes_sort_by_their_tokens():
    rng = np.random.default_rng(2)
    tokens = rng.integers(0, 4, (3, 500)).astype(np.uint64) << np.uint64(61)
    found = suffix_dedup.Suffixes(tokens, *[np.arange(500)] * 4)
    order = found.order()
    assert [tuple(tokens[:, i]) for i in order] == sorted(map(tuple, tokens.T))
    assert (np.sort(found.keys()) == found.keys()[order]).all()


def test_range_hashes_do_not_depend_on_the_place():
    rng = np.random.default_rng(1)
    run = rng.integers(1, 256, 300).astype(np.uint16)
    values = np.concatenate([run, rng.integers(1, 256, 131_072 - 150).astype(np.uint16), run])
    starts, ends = np.array([0, len(values) - 300, 5]), np.array([300, len(values), 305])
    for family, base in enumerate(FAMILIES):
        found = range_hashes(values, starts, ends, family)
        plain = sum(int(v) * pow(base, i, 1 << 64) for i, v in enumerate(run)) + 300
        assert found[0] == found[1] != found[2] and found[0] == mixed(np.array([plain % (1 << 64)], dtype=np.uint64))[0]


def audited(docs, **options):
    return sorted(map(tuple, source_audit.audit_sources(docs, **options).collect()))


def audit_rows(n=400, sources=7):
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcéß") for _ in range(rng.randint(1, 4))) for _ in range(150)]
    rows = [(" ".join(rng.choices(vocabulary, k=rng.randint(0, 40))), rng.choice(["en", "de", None]), f"s{int(rng.expovariate(0.5)) % sources}") for _ in range(n)]
    rows += [(None, "en", "mute"), ("", "fr", "x"), ("Once, ONCE 2x", "fr", "y"), ("lone", "it", None), *[("Same WORDS of one row", "en", "s0")] * 40]
    return rows


def audit_frame(spark, rows):
    return spark.createDataFrame([(*r, "a", 1) for r in rows], "text string, lang string, source string, term string, n int")


@pytest.mark.parametrize("min_docs", [1, 30])
def test_audit(spark, min_docs):
    rows = audit_rows()
    assert audited(audit_frame(spark, rows).repartition(4), min_docs=min_docs) == brute.audit_sources(rows, min_docs)


def test_audit_over_blocks_of_sources_and_terms(spark, monkeypatch):
    monkeypatch.setattr(source_audit, "SOURCES", 3)
    monkeypatch.setattr(source_audit, "TERMS", 10)
    rows = audit_rows(sources=11)
    assert audited(audit_frame(spark, rows), min_docs=5, top_terms=3) == brute.audit_sources(rows, 5, 3)


def test_audit_of_nothing(empty_docs):
    assert audited(empty_docs) == []


def test_audit_of_a_very_long_text(spark):
    rows = [("ab cd " * 200_000 + "é" * 100_000, "en", "long"), ("ab xy", "en", "short"), ("ab", "en", "short")]
    assert audited(audit_frame(spark, rows), min_docs=1) == brute.audit_sources(rows, 1)
