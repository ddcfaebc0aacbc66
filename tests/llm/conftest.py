from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def frame(spark):
    """Documents from texts, or from (doc_id, text) pairs; with columns that clash with results."""

    def make(texts, lang="en", source="s"):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        data = [(i, t, lang, source, None if t is None else len(t)) for i, t in rows]
        docs = spark.createDataFrame(data, SCHEMA).repartition(3)
        return docs.selectExpr(
            "*", "'x' AS n_words", "'x' AS kept", "'x' AS shard", "'x' AS score", "'x' AS _id", "'x' AS component"
        )

    return make


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, shared passages, odd spaces, empty and NULL texts."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdeäß", k=rng.randint(1, 6))) for _ in range(60)]

    def prose(n: int) -> list[str]:
        return rng.choices(vocabulary, k=n)

    shared, texts = prose(40), []
    for i in range(30):
        own = prose(rng.randint(1, 90))
        if i % 3 == 0:
            own[len(own) // 2 : len(own) // 2] = shared[: rng.randint(5, 40)]
        texts.append(rng.choice([" ", "\n", "\t "]).join(own))
    texts += texts[:4] * 2
    base = prose(80)
    for i in range(8):
        near = list(base)
        near[i * 9] = f"x{i}"
        texts.append(" ".join(near))
    texts += ["", None, " \n ", "a", "b b b b b b b b b b b b b b b b b b b b", "é" * 300, " ".join(prose(4000))]
    return texts
