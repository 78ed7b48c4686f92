"""A small corpus with every awkward case."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names the operators use themselves or give to their results.
        *[T.StructField(c, T.StringType()) for c in ("_id", "_row", "dropped", "n_words", "keep_id", "spans", "score", "ids")],
    ]
)


def corpus(n: int = 160, seed: int = 7) -> list[tuple[int, str | None]]:
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéñßüxyzABC") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    line = "This Line stands in very many documents."
    docs: list[tuple[int, str | None]] = []
    for i in range(n):
        kind = rng.random()
        words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 3, 4, 5, 12, 40, 90, 300]))]
        if kind < 0.15 and docs:
            text = rng.choice(docs)[1]
        elif kind < 0.35 and docs:
            copy = (rng.choice(docs)[1] or "").split(" ")
            if len(copy) > 30:
                copy[rng.randrange(len(copy))] = "changed"
            text = " ".join(copy)
        else:
            text = " ".join(words)
        if rng.random() < 0.3:
            text = (text or "") + "\n" + passage + "\n"
        if rng.random() < 0.4:
            text = "  " + line.upper() + "\n" + (text or "") + "\r\n" + line
        docs.append((i, text))
    docs += [(1000, None), (1001, ""), (1002, " \t\n "), (1003, "\n"), (1004, "same " * 2000), (1005, "same " * 70), (1006, "\x00|\x7f\x1f ")]
    docs += [(1007, docs[5][1]), (1008, (docs[5][1] or "").upper()), (1009, "word " * 30000 + passage), (1010, "👍🏽 é it's 12'345    end  ")]
    return docs


def framed(spark, docs):
    """The documents with columns whose names clash with the operators' own."""
    rows = [(i, t, None, "src", None if t is None else len(t), "a", "b", "c", "d", "e", "f", "g", "h") for i, t in docs]
    return spark.createDataFrame(rows, DOCS)
