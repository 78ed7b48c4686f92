"""A quality score by regularised quadratic discriminant analysis.

Every whole text becomes a few statistics (shares of kinds of characters and
words, repetition, length), transformed to be closer to normal. Each class has
a mean and a covariance of them; covariances are shrunk towards their own
diagonal and towards the one both classes share. A document's evidence is the
difference of the two log densities, each a Mahalanobis distance from a cached
Cholesky factor, and a logistic curve fitted to the same sample turns it into a
score from 0 to 1.

Statistics are worked out once per document and kept in a table; learning reads
a bounded sample of it, and scoring reads all of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import keep_table, whole
from gridtide.llm.words import Slice, in_slices

FEATURES = [
    "length", "capitals", "symbols", "digits", "marks", "lines", "bare_words", "ragged_words",
    "echoes", "variety", "word_size", "short_words",
]
SAMPLE_ROWS = 20_000
# Fixed value: characters that do not end a word of prose.
RAGGED = b"!$%&*#@^~+=<>|"


def statistics(part: Slice) -> np.ndarray:
    """A row of transformed statistics per document."""
    n_docs, counts, data = len(part.ids), part.counts().astype(float), part.data
    bounds = np.concatenate([[0], np.cumsum(part.sizes)])

    def bytes_where(mask: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(mask)])[bounds]).astype(float)

    def words_where(mask: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(mask)])[part.first]).astype(float)

    capital, digit = (data >= 65) & (data <= 90), (data >= 48) & (data <= 57)
    letter = capital | ((data >= 97) & (data <= 122)) | (data >= 128)
    symbol = (data > 32) & ~letter & ~digit & (data < 127)
    mark = np.isin(data, np.frombuffer(b".,;:'\"()-?", np.uint8))
    size = np.maximum(bytes_where((data > 32) & (data != 127)), 1)
    words = np.maximum(counts, 1)
    letters_up_to = np.concatenate([[0], np.cumsum(letter | digit)])
    bare = letters_up_to[part.ends] == letters_up_to[part.starts]
    ragged = np.isin(data[part.ends - 1], np.frombuffer(RAGGED, np.uint8))
    hashes, doc = part.word_hashes(), np.repeat(np.arange(n_docs), part.counts())
    echo = np.zeros(len(hashes), dtype=bool)
    echo[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    order = np.lexsort((hashes, doc))
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    distinct = np.bincount(doc[order][fresh], minlength=n_docs)
    lengths = part.ends - part.starts

    def share(part_: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.log(part_ / of + 0.01)

    return np.column_stack(
        [
            np.log1p(counts),
            share(bytes_where(capital), size),
            share(bytes_where(symbol & ~mark), size),
            share(bytes_where(digit), size),
            share(bytes_where(mark), size),
            share(np.maximum(bytes_where(data == 10) - 1, 0), words),
            share(words_where(bare), words),
            share(words_where(ragged), words),
            share(words_where(echo), words),
            np.log((distinct + 1) / (words**0.9 + 1)),
            np.log1p(words_where(lengths) / words),
            share(words_where(lengths <= 3), words),
        ]
    )


def _statistics_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, rows, texts in in_slices(batches, unique=False):
        part = Slice([0] * len(ids), rows, texts)
        values = statistics(part)
        columns = {"_id": pa.array(ids, pa.int64()), "_row": pa.array(rows, pa.int64())}
        columns |= {name: pa.array(values[:, i]) for i, name in enumerate(FEATURES)}
        yield pa.RecordBatch.from_pydict(columns)


@dataclass
class Discriminant:
    """Means, Cholesky factors and log determinants per class, and the curve."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    log_dets: list[float]
    slope: float = 1.0
    shift: float = 0.0

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, own: float = 0.1, pooled: float = 0.1) -> Discriminant:
        if set(np.unique(y)) != {0, 1}:
            raise ValueError("labelled rows of both classes are needed")
        groups = [x[y == c] for c in (0, 1)]
        means = [g.mean(axis=0) for g in groups]
        centred = [g - m for g, m in zip(groups, means, strict=True)]
        shared = sum(c.T @ c for c in centred) / max(len(x) - 2, 1)
        floor = 1e-3 * (np.diag(shared).mean() + 1e-6) * np.eye(x.shape[1])
        factors = []
        for c in centred:
            cov = c.T @ c / max(len(c) - 1, 1)
            cov = (1 - own) * cov + own * np.diag(np.diag(cov))
            factors.append(np.linalg.cholesky((1 - pooled) * cov + pooled * shared + floor))
        model = Discriminant(means, factors, [2 * np.log(np.diag(f)).sum() for f in factors])
        return model._calibrated(model.evidence(x), y.astype(float))

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """log p(x | 1) - log p(x | 0), squashed at its far ends."""
        log_p = []
        for mean, factor, log_det in zip(self.means, self.factors, self.log_dets, strict=True):
            z = np.linalg.solve(factor, (x - mean).T)
            log_p.append(-0.5 * ((z * z).sum(axis=0) + log_det))
        return np.arcsinh((log_p[1] - log_p[0]) / 2)

    def _calibrated(self, e: np.ndarray, y: np.ndarray) -> Discriminant:
        w, design = np.zeros(2), np.column_stack([e, np.ones(len(e))])
        for _ in range(50):
            p = 1 / (1 + np.exp(-design @ w))
            hessian = (design.T * (p * (1 - p))) @ design + 1e-3 * np.eye(2)
            w = w + np.linalg.solve(hessian, design.T @ (y - p) - 1e-3 * w)
        self.slope, self.shift = float(w[0]), float(w[1])
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.evidence(x) + self.shift, -500, 500)))


def document_statistics(docs: DataFrame, key: str, text: str) -> DataFrame:
    rows = docs.select(
        F.col(key).cast("bigint").alias("_id"), F.xxhash64(F.col(key), whole(text)).alias("_row"), whole(text).cast("binary").alias("_text")
    )
    schema = "_id bigint, _row bigint, " + ", ".join(f"`{f}` double" for f in FEATURES)
    return rows.mapInArrow(_statistics_rows, schema)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    threshold: float = 0.7,
    sample_rows: int = SAMPLE_ROWS,
    row: str | None = None,
) -> DataFrame:
    """Per row: ``key``, ``score``, ``predicted`` (1 if the score reaches the
    threshold) and ``learnt`` (whether the score tells documents apart).

    ``labels`` has the rows to learn from: ``key`` and a label of 0 or 1; rows
    with another label, or none, are left out, and of several labels for one id
    the least counts. At most ``sample_rows`` labelled documents are learnt
    from, chosen by a hash of their id. Unless both labels occur among them
    nothing tells documents apart, and all get the share of label 1, counted
    with one more row of each label: 0.5 without labels. No documents give no
    rows. A null text is scored as an empty one, and an empty text by its statistics, which are
    those of no words. Repeated rows come out as often as they go in. Ids are
    whole numbers. Other columns are ignored. ``row`` names a column to add, the
    xxhash64 of id and text (null as empty).
    """
    measured = keep_table(document_statistics(docs, key, text), "statistics")
    known = (
        labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(key).cast("bigint").alias("_known")).agg(F.min(label).cast("int").alias("_label"))
    )
    sample = (
        measured.join(known, measured["_id"] == known["_known"])
        .orderBy(F.xxhash64("_id", "_row"), "_row")
        .limit(sample_rows)
        .select("_label", *FEATURES)
        .toPandas()
    )
    identity = [F.col("_row").alias(row)] if row else []
    found = measured.select(F.col("_id").alias(key), *identity, *FEATURES)
    labelled = sample["_label"].to_numpy()
    if set(labelled) != {0, 1}:
        prior = F.lit((labelled.sum() + 1) / (len(labelled) + 2)).cast("double")
        return _predicted(found.withColumn("score", prior), threshold, False)
    model = docs.sparkSession.sparkContext.broadcast(Discriminant.fit(sample[FEATURES].to_numpy(), labelled))

    @F.pandas_udf("double")
    def score(*columns):
        import pandas as pd

        return pd.Series(model.value.score(np.column_stack([c.to_numpy() for c in columns])))

    return _predicted(found.withColumn("score", score(*FEATURES)), threshold, True)


def _predicted(scored: DataFrame, threshold: float, learnt: bool) -> DataFrame:
    predicted = (F.col("score") >= threshold).cast("int")
    return scored.drop(*FEATURES).withColumns({"predicted": predicted, "learnt": F.lit(learnt)})
