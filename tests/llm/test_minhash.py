"""Operator 6 against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from by_hand import near_groups

from quayside.llm.components import connected
from quayside.llm.minhash import NearDup, circulant_minima, distinct_documents, near_duplicates
from quayside.scratch import Workspace


def result(frame, rows, p=None):
    got = near_duplicates(frame(rows), p or NearDup()).collect()
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}


def test_against_brute_force(frame, corpus):
    rows = list(enumerate(corpus, start=10))
    assert result(frame, rows) == near_groups(rows)


@pytest.mark.parametrize("seed", range(2))
def test_chains_and_stars_of_near_copies(frame, seed):
    rng = random.Random(seed)
    rows, n = [], 0
    for _ in range(3):
        text = [f"w{rng.randint(0, 500)}" for _ in range(120)]
        star = list(text)
        for step in range(25):
            rows.append((n := n + 1, " ".join(text)))
            text = list(text)
            text[rng.randrange(120)] = f"n{seed}-{step}"  # drifts away from the first
        for step in range(25):
            near = list(star)
            for k in range(rng.randint(0, 6)):
                near[rng.randrange(120)] = f"s{step}-{k}"
            rows.append((n := n + 1, " ".join(near)))
    rng.shuffle(rows)
    assert result(frame, rows) == near_groups(rows)


def test_similarity_of_exactly_the_threshold_links(frame):
    # 4 words are one shingle each with words=1: 3 of 4 shared is 75 %
    p = NearDup(words=1, bands=64, rows=1)
    rows = [(1, "a b c d"), (2, "A b c"), (3, "a b x"), (4, "q")]
    assert result(frame, rows, p) == near_groups(rows, 1)
    assert near_groups(rows, 1)[2] == (3, 1)


def test_odd_rows(frame):
    rows = [(4, "one two"), (3, "ONE  two"), (5, ""), (6, None), (7, " \n"), (8, "one two three")]
    assert result(frame, rows) == near_groups(rows)
    text = " ".join(f"w{i}" for i in range(50))
    got = near_duplicates(frame([(9, text), (9, text), (None, text), (None, text), (2, text + " x")])).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in got) == [
        (0, 0, True), (0, 0, True), (2, 2, True), (9, 2, False), (9, 2, False),
    ]
    assert near_duplicates(frame(["x"]).limit(0)).count() == 0


def test_distinct_documents_keeps_one_row_and_all_columns(frame):
    text = " ".join(f"w{i}" for i in range(50))
    docs = frame([(9, text), (2, text), (2, text), (3, "else"), (None, text), (5, None), (5, "five")])
    kept = distinct_documents(docs)
    assert kept.columns == docs.columns
    # of rows that are alike the smallest id stays; unlike rows of one id all stay
    assert sorted((r["doc_id"], r["text"] or "") for r in kept.collect()) == [(2, text), (3, "else"), (5, ""), (5, "five")]
    unnamed = distinct_documents(frame([(None, text), (None, text), (None, "else")]))
    assert sorted(r["text"] for r in unnamed.collect()) == ["else", text]


def test_signature_estimates_similarity():
    rng = np.random.default_rng(2)
    shared = rng.integers(0, 2**63, 600, dtype=np.uint64)
    own = [rng.integers(0, 2**63, 100, dtype=np.uint64) for _ in range(2)]
    sets = [np.concatenate([shared, x]) for x in own]
    low = circulant_minima(np.concatenate(sets), np.array([0, 700]), 2000)
    assert abs((low[:, 0] == low[:, 1]).mean() - 600 / 800) < 0.05


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(200, 300)] + [(7, i) for i in range(400, 450)] + [(449, 5)]
    random.Random(1).shuffle(links)
    found = connected(spark.createDataFrame(links, "a long, b long"), Workspace(spark, "test"), "links").collect()
    want = {i: 200 for i in range(200, 301)} | {i: 5 for i in [5, 7, *range(400, 450)]}
    assert {r["node"]: r["component"] for r in found} == want


def test_bounds_hold_for_every_pair(spark):
    """Elements in common are never more than the outlines say, and the bound is near for sets of usual size."""
    from pyspark.sql import functions as F

    from quayside.llm.minhash import most_in_common, outlines

    rng = np.random.default_rng(3)
    rows = []
    for n in (1, 5, 200, 900, 6000):
        shared = rng.integers(0, 2**63, n // 2, dtype=np.uint64)
        sets = [np.unique(np.concatenate([shared, rng.integers(0, 2**63, n - n // 2, dtype=np.uint64)])) for _ in range(2)]
        sizes = np.array([len(x) for x in sets])
        outline, spare = outlines(np.concatenate(sets), sizes)
        common = len(np.intersect1d(*sets))
        rows.append((n, common, *outline.view(np.int64).tolist(), *spare.tolist()))
    frame = spark.createDataFrame(rows, "n long, common long, a array<long>, b array<long>, c long, d long")
    bound = most_in_common(F.col("a"), F.col("b"), F.col("c"), F.col("d"))
    for n, common, most in frame.select("n", "common", bound).collect():
        assert most >= common
        assert n > 900 or most <= common + 0.25 * n


def thue_morse(letters: str, rounds: int) -> str:
    text = letters[0]
    for _ in range(rounds):
        text += text.translate(str.maketrans(letters, letters[::-1]))
    return text


def test_words_made_to_a_pattern_are_not_alike(frame):
    one, other = thue_morse("ab", 10), thue_morse("ba", 10)
    rows = [(1, one), (2, other), (3, one), (4, f"{one} {other}"), (5, f"{other} {one}")]
    assert result(frame, rows) == near_groups(rows)


def test_a_bucket_of_near_misses_is_settled_by_bounds(frame, spark, monkeypatch):
    """Texts that share bands and are not alike: few of their pairs need their full sets."""
    from quayside.llm import minhash

    rng, base = random.Random(4), [f"w{i}" for i in range(200)]
    rows = []
    for n in range(300):
        text = list(base)
        for k in range(9):
            text[rng.randrange(200)] = f"n{n}-{k}"
        rows.append((n, " ".join(text)))
    judged, compared = minhash._judged, []

    def counting(pairs, sets, p):
        compared.append(pairs.count())
        return judged(pairs, sets, p)

    monkeypatch.setattr(minhash, "_judged", counting)
    assert result(frame, rows) == near_groups(rows)
    assert sum(compared) < 300 * 299 // 2 // 4


def test_the_test_of_a_pair_is_compiled(spark, capsys):
    """The JVM leaves methods of 8000 bytes and more to its interpreter, which took 20 µs a pair."""
    import re

    from quayside.llm.minhash import _promising

    kinds = {"component": "long", "n_shingles": "long", "spare": "long", "node": "long"}
    kinds |= {"bands": "array<long>", "outline": "array<long>"}
    schema = "bucket long, " + ", ".join(f"{c} {kind}, {c}_b {kind}" for c, kind in kinds.items())
    frame = spark.createDataFrame(spark.sparkContext.emptyRDD(), schema)
    frame.where(_promising(NearDup())).select("node", "node_b").explain("codegen")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000
