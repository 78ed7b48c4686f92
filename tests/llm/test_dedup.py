import brute
import pytest
from corpus import framed
from gridtide.llm import exact_dedup, line_dedup, ngram_join, substring_dedup
from gridtide.llm.components import components
from gridtide.llm.ngram_join import bitmap, overlap_bound
from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np
import pyarrow as pa


def by_id(rows, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in rows}


def test_exact_groups(docs_frame, small_docs):
    got = exact_dedup.exact_dedup(docs_frame, keep="largest", fan_in=3).collect()
    assert by_id(got, "keep_id", "group_size", "kept", "text_sha256") == brute.exact_groups(small_docs)
    assert len(got) == len(small_docs)


def test_exact_smallest_and_rows_that_stay(spark):
    docs = framed(spark, [(3, "A"), (1, "a"), (2, None), (4, ""), (None, "a"), (None, "lone"), (5, "É"), (6, "é"), (1, "a")])
    got = sorted(map(tuple, exact_dedup.exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept").collect()), key=str)
    assert got == sorted(
        [(3, 1, 4, False), (1, 1, 4, True), (1, 1, 4, True), (2, 2, 2, True), (4, 2, 2, False), (None, 1, 4, False),
         (None, None, 1, True), (5, 5, 1, True), (6, 6, 1, True)], key=str
    )
    kept = exact_dedup.drop_duplicates(docs.filter("doc_id <> 1"))
    assert {r["doc_id"] for r in kept.collect()} == {3, 2, 5, 6} and kept.columns == docs.columns
    with pytest.raises(ValueError):
        exact_dedup.exact_dedup(docs, keep="newest")


def test_lines(docs_frame, small_docs):
    got = line_dedup.line_dedup(docs_frame).collect()
    assert by_id(got, "n_lines", "n_dropped", "text") == brute.line_dedup(small_docs)
    assert got[0]["dropped"] == "c" and got[0]["source"] == "src"


def test_lines_of_repeated_rows_and_missing_ids(spark):
    line = "a line of twenty characters at least"
    docs = framed(spark, [(1, line), (2, line), (2, line), (3, f"x\n{line}\n{line}"), (None, line), (2, "other")])
    got = sorted(map(tuple, line_dedup.line_dedup(docs).select("doc_id", "n_lines", "n_dropped", "text").collect()), key=str)
    assert got == sorted(
        [(1, 1, 1, ""), (2, 1, 1, ""), (2, 1, 1, ""), (2, 1, 0, "other"), (3, 3, 0, f"x\n{line}\n{line}"), (None, 1, 1, "")], key=str
    )


def test_passages(docs_frame, small_docs):
    got = substring_dedup.substring_dedup(docs_frame).collect()
    assert by_id(got, "n_words", "n_removed", "kept_sha256") == brute.substring_dedup(small_docs)
    assert len(got) == len(small_docs)


def test_passages_of_repeated_rows_and_missing_ids(spark):
    words = " ".join(f"w{i}" for i in range(30))
    docs = framed(spark, [(2, words), (2, words), (None, words), (1, "short"), (3, words + " tail"), (None, None)])
    got = substring_dedup.substring_dedup(docs).select("doc_id", "n_words", "n_removed", "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(2, 30, 0, words), (2, 30, 0, words), (None, 30, 30, ""), (1, 1, 0, "short"), (3, 31, 30, "tail"), (None, 0, 0, "")], key=str
    )
    with pytest.raises(ValueError):
        substring_dedup.substring_dedup(docs, window=13)


def test_near_duplicates(docs_frame, small_docs):
    got = ngram_join.ngram_join(docs_frame).collect()
    assert by_id(got, "n_shingles", "component_id") == brute.near_duplicates(small_docs)
    assert len(got) == len(small_docs)


def test_chains_of_near_duplicates(spark):
    # Each links with the next one only, so the component grows by steps.
    words = [f"w{i}" for i in range(200)]
    docs = [(i, " ".join(words[2 * i : 2 * i + 60])) for i in range(40)]
    got = ngram_join.ngram_join(framed(spark, docs)).collect()
    assert by_id(got, "n_shingles", "component_id") == brute.near_duplicates(docs)


def test_near_duplicates_without_ids_and_versions(spark):
    docs = framed(spark, [(None, "a b c d e f"), (1, "a b c d e f"), (2, "x"), (2, "a b c d e f"), (3, "X"), (4, None), (4, None)])
    got = ngram_join.ngram_join(docs).select("doc_id", "n_shingles", "component_id").distinct().collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(None, 2, None), (1, 2, 1), (2, 1, 1), (2, 2, 1), (3, 1, 1), (4, 0, 4)], key=str
    )


@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=200), st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=60))
@settings(max_examples=60, deadline=None)
def test_bitmaps_bound_the_overlap(a, extra):
    b = set(list(a)[: len(a) // 2]) | extra
    x, y = (np.array(sorted(s), dtype=np.uint64) for s in (a, b))
    assert overlap_bound(bitmap(x), len(x), bitmap(y), len(y)) >= len(a & b)


def test_few_pairs_of_near_misses_are_looked_at(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base, docs = [f"w{i}" for i in range(200)], []
    for i in range(40):
        words = list(base)
        for at in rng.choice(40, 4, replace=False) * 5:
            words[at] = f"x{i}y{at}"
        docs.append((i, " ".join(words)))
    counts, confirmed = [], ngram_join.confirmed

    def counted(pairs, *args, **kwargs):
        counts.append(pairs.count())
        return confirmed(pairs, *args, **kwargs)

    monkeypatch.setattr(ngram_join, "confirmed", counted)
    got = ngram_join.ngram_join(framed(spark, docs)).collect()
    want = brute.near_duplicates(docs)
    assert by_id(got, "n_shingles", "component_id") == want and len({c for _, c in want.values()}) > 1
    assert counts[1] < 100  # of 780


@given(st.lists(st.tuples(st.integers(0, 2), st.integers(1, 40), st.integers(0, 9)), max_size=25), st.sampled_from([50, 75, 100]))
@settings(max_examples=200, deadline=None)
def test_members_without_a_partner_leave_a_tile(members, percent):
    members = sorted((t, n, min(r, n - 1)) for t, n, r in members)
    tile, n, rank = (np.array([m[k] for m in members], dtype=np.int64) for k in range(3))
    got = ngram_join.have_partners(tile, n, ngram_join.partner_sizes(n, rank, percent))

    def may_link(a, b):
        return a[0] == b[0] and ngram_join.linked(min(a[1] - a[2], b[1] - b[2]), a[1], b[1], percent)

    assert got.tolist() == [any(i != j and may_link(a, b) for j, b in enumerate(members)) for i, a in enumerate(members)]


def test_id_filter_passes_its_ids(spark):
    ids = [-5, 0, 7, 1 << 62, *range(1000, 3000)]
    words = ngram_join.id_filter(spark.createDataFrame([(i,) for i in ids], "id bigint"))

    def passed(values):
        batch = pa.RecordBatch.from_pydict({"_id": pa.array(values, pa.int64())})
        return next(ngram_join._passing(iter([batch]), words)).column("_id").to_pylist()

    assert passed(ids) == ids and len(passed(list(range(10_000, 20_000)))) < 2000
    none = ngram_join.id_filter(spark.createDataFrame([], "id bigint"))
    assert next(ngram_join._passing(iter([pa.RecordBatch.from_pydict({"_id": pa.array([1], pa.int64())})]), none)).num_rows == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(50)] + [(60, 70), (70, 60), (70, 70), (None, 3)] + [(100, 200 + i) for i in range(80)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = {i: 0 for i in range(51)} | {60: 60, 70: 60, 100: 100} | {200 + i: 100 for i in range(80)}
    assert got == want


@pytest.mark.parametrize("rows", [0, 20_000])
def test_large_sides_are_not_sent_through_the_driver(spark, monkeypatch, rows):
    from gridtide.llm import components as module

    monkeypatch.setattr(module, "BROADCAST_ROWS", rows, raising=False)
    plans, kept = [], module.keep_table

    def keep(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, name)

    monkeypatch.setattr(module, "keep_table", keep)
    links = [(i, i + 1) for i in range(50)] + [(100, 200 + i) for i in range(80)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert {r["node"]: r["component"] for r in found.collect()} == {i: 0 for i in range(51)} | {100: 100} | {200 + i: 100 for i in range(80)}
    joined = spark.createDataFrame([(i,) for i in range(300)], "node bigint").join(found, "node", "left")
    plans.append(joined._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 3
    # Exploded rows never, and none at all if there are more than a few.
    assert not any("Broadcast" in p and "Generate" in p for p in plans)
    assert rows or not any("Broadcast" in p for p in plans)


def test_empty_tables(empty_docs):
    for frame in (
        exact_dedup.exact_dedup(empty_docs), line_dedup.line_dedup(empty_docs),
        substring_dedup.substring_dedup(empty_docs), ngram_join.ngram_join(empty_docs),
    ):
        assert frame.collect() == []
