import brute
import public_tokenizers
import pytest
import tiktoken
from gridtide.llm import bpe, quality

import corpus_pipeline

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def tables(spark, tmp_path, small_docs):
    rng_words = [f"word{i}" for i in range(80)]
    good = [(2000 + i, " ".join(rng_words[(i * 7 + j * j) % 80] for j in range(60)) + f" tail{i}.") for i in range(120)]
    bad = [(3000 + i, " ".join(["AGAIN!!"] * 40 + [f"N{i}!!"])) for i in range(60)]
    docs = [*small_docs, *good, *bad]
    item = " ".join(good[3][1].split()[5:25])
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad]
    spark.createDataFrame(labels, "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), docs, [(1, item)]


def test_every_stage_against_brute_force(spark, tables):
    folder, docs, items = tables
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    held = dict(docs)
    (_, keep_good), (_, lines), (_, near), (_, clean), (_, tokens) = corpus_pipeline.STAGES

    labels = spark.read.parquet(f"{folder}/labels.parquet").filter(~corpus_pipeline.held_out())
    rejected = {r["doc_id"] for r in quality.score_quality(frame, labels).filter("predicted = 0").collect()}
    assert rejected & {3000 + i for i in range(60)}
    held = {i: t for i, t in held.items() if i not in rejected}
    frame = keep_good(spark, frame, folder)
    assert {r["doc_id"]: r["text"] for r in frame.collect()} == held

    frame = lines(spark, frame, folder)
    held = {i: text for i, (_, _, text) in brute.line_dedup(held.items()).items()}
    assert {r["doc_id"]: r["text"] for r in frame.collect()} == held
    assert all(r["n_chars"] == len(r["text"]) for r in frame.collect())

    frame = near(spark, frame, folder)
    held = {i: held[i] for i, (_, top) in brute.near_duplicates(held.items()).items() if i == top}
    assert {r["doc_id"]: r["text"] for r in frame.collect()} == held

    frame = clean(spark, frame, folder)
    held = {i: held[i] for i, (*_, hit) in brute.contamination(held.items(), items).items() if not hit}
    assert {r["doc_id"]: r["text"] for r in frame.collect()} == held
    assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"]

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    got = {r["doc_id"]: (r["n_tokens"], r["decoded_sha256"]) for r in tokens(spark, frame, folder).collect()}
    assert got == {i: (len(library.encode_ordinary(t)), brute.sha(t)) for i, t in held.items()}

    whole = {r["doc_id"]: (r["n_tokens"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, folder).collect()}
    assert whole == got


def test_decisions_hold_for_rows_and_not_for_ids(spark, tables):
    folder, docs, items = tables
    held = dict(docs)

    def frame(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCUMENTS)

    def stage(n, rows):
        got = corpus_pipeline.STAGES[n][1](spark, frame(rows), folder).collect()
        return sorted(((r["doc_id"], r["text"]) for r in got), key=str)

    good, other, bad = held[2010], held[2020], held[3002]
    base = [(i, held[i]) for i in [*range(2000, 2120), *range(3000, 3060)]]
    kept = stage(0, [*base, (None, bad), (None, good), (9000, bad), (9000, good)])
    assert (None, bad) not in kept and (9000, bad) not in kept and (None, good) in kept and (9000, good) in kept

    rows = [(7, good), (7, good), (None, good), (8, good), (8, "quite another text of some more words"), (None, other), (None, other)]
    assert stage(2, rows) == sorted([(7, good), (8, "quite another text of some more words"), (None, other)], key=str)

    hit = "so it is " + items[0][1]
    assert stage(3, [(None, hit), (None, "clean"), (7, hit), (7, "clean"), (7, "clean")]) == sorted([(None, "clean"), (7, "clean"), (7, "clean")], key=str)


@pytest.mark.parametrize("empty", [("documents",), ("labels",), ("benchmark",), ("documents", "labels", "benchmark")])
def test_pipeline_over_empty_tables(spark, tables, tmp_path, empty):
    folder, docs, _ = tables
    for name in ("documents", "labels", "benchmark"):
        df = spark.read.parquet(f"{folder}/{name}.parquet")
        (df.limit(0) if name in empty else df).write.parquet(f"{tmp_path}/some/{name}.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_path}/some").select("doc_id").collect()
    if "documents" in empty:
        assert got == []
    elif "labels" in empty:
        # Nothing to learn from: no document goes for its quality.
        assert {2000 + i for i in range(80) if i != 3} - {r["doc_id"] for r in got} == set()
    else:
        assert {r["doc_id"] for r in got} >= {2003}
