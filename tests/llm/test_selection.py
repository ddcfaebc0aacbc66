"""Operators 1, 7, 8 and 9."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from by_hand import words_of
from pyspark.sql import functions as F

from quayside.llm import decontaminate
from quayside.llm.common import remainder
from quayside.llm.decontaminate import clean_documents, contaminated_words
from quayside.llm.language_id import distances, gram_counts, learn_profiles, predict
from quayside.llm.outliers import Outliers, judge_documents, statistics
from quayside.llm.queries import QUERIES
from quayside.llm.rule_ensemble import (
    NAMES,
    RuleParameters,
    fit,
    labelled,
    score_column,
    simplified,
    with_statistics,
)
from quayside.llm.rule_ensemble import statistics as text_statistics

SF_DIR = "/root/testdata/sf0.01"


def test_remainder(spark):
    rows = spark.createDataFrame([(1,), (123456789,), (-5,), (None,)], "doc_id long")
    got = [r[0] for r in rows.select(remainder(F.col("doc_id"), 3)).collect()]
    assert got == [zlib.crc32(t.encode()) % 3 for t in ("1", "123456789", "-5", "")]


# --- benchmark passages ---------------------------------------------------------------


def normal_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    out, word = [], ""
    for c in lowered + " ":
        if c.isascii() and not c.isalnum():
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out


def hits_by_hand(text, items, size=10):
    words, hit, names = normal_words(text), set(), set()
    for item_id, item in items:
        own = normal_words(item)
        n = min(size, len(own))
        passages = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in passages:
                hit |= set(range(i, i + n))
                names.add(str(item_id))
    return len(words), sorted(hit), sorted(names)


@pytest.mark.parametrize("most", [0, 10**6])
def test_passages_against_brute_force(spark, frame, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", most)
    rng = random.Random(4)
    vocabulary = ["Ab", "ä", "x9", "Éa", "foo", "b"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([3, 9, 10, 14])))) for i in range(12)]
    items += [(20, "solo"), (21, ""), (22, None), (23, items[3][1]), (24, "!!")]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 300)))) for i in range(25)]
    rows += [(30, items[0][1].upper().replace(" ", ", ")), (31, "SOLO"), (32, None), (33, ""), (34, "solos")]
    rows += [(31, "SOLO"), (30, "clean"), (None, "a solo")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS hash", "2 AS words")
    got = contaminated_words(frame(rows), benchmark).collect()
    want = Counter((i, *map(str, hits_by_hand(t, items))) for i, t in rows)
    assert Counter((r["doc_id"], str(r["n_words"]), str(r["hit_words"]), str(r["items"])) for r in got) == want
    assert all(r["contaminated"] == (r["n_hit"] > 0) and r["n_hit"] == len(r["hit_words"]) for r in got)
    kept = clean_documents(frame(rows), benchmark)
    assert Counter(r["text"] for r in kept.collect()) == Counter(
        t for i, t in rows if not hits_by_hand(t, items)[1]
    )


def test_passages_of_empty_tables(spark, frame):
    none = spark.createDataFrame([], "item_id string, text string")
    assert [tuple(r)[2:5] for r in contaminated_words(frame(["a b"]), none).collect()] == [(2, 0, [])]
    some = spark.createDataFrame([("x", "a b")], "item_id string, text string")
    assert contaminated_words(frame(["a b"]).limit(0), some).count() == 0


# --- languages ------------------------------------------------------------------------


def grams_by_hand(text):
    out = Counter()
    for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        out.update(word)
        framed = f"_{word}_"
        out.update(framed[i : i + 2] for i in range(len(framed) - 1))
        out.update(framed[i : i + 3] for i in range(len(framed) - 2))
    return out


def unpacked(gram):
    parts = [(gram >> 42) & (2**21 - 1), (gram >> 21) & (2**21 - 1), gram & (2**21 - 1)]
    return "".join("_" if p == 1 else chr(p) for p in parts if p)


def test_grams_against_brute_force():
    texts = ["Hello, héllo! a", "", "123 -", "ab", "𝒳y 中文字", "x" * 1000]
    owner, gram, count = gram_counts(texts)
    for i, text in enumerate(texts):
        own = {unpacked(int(g)): int(n) for o, g, n in zip(owner, gram, count, strict=True) if o == i}
        assert own == dict(grams_by_hand(text))


def test_distance_and_profiles_against_brute_force(spark):
    docs = [("the cat and the hat", "en"), ("der hut und die katze", "de"), ("der hund", "de"), ("?", "xx"), (None, "de")]
    profiles = learn_profiles(spark.createDataFrame([*docs, ("unlabelled", None)], "text string, lang string"), 20)
    assert profiles.languages == ("de", "en")

    def ranked(counter, n):
        key = lambda g: tuple([0] * (3 - len(g)) + [1 if c == "_" else ord(c) for c in g])
        return sorted(counter, key=lambda g: (-counter[g], key(g)))[:n]

    want = ranked(grams_by_hand(docs[1][0]) + grams_by_hand(docs[2][0]), 20)
    assert [unpacked(g) for g in profiles.grams[0]] == want
    text = "der hat die katze"
    own = ranked(grams_by_hand(text), 20)
    away = sum(min(abs(want.index(g) - i), 20) if g in want else 20 for i, g in enumerate(own))
    assert distances(profiles, ["", text])[0][0].tolist() == [0, away]


def test_languages_held_out(spark):
    out = QUERIES["op7_rank_order_language"](spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    right, n = out.where("held_out").join(docs, "doc_id").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")
    ).first()
    assert n > 200 and right > 0.98
    assert out.where("score < 0 OR score > 1").count() == 0 and out.count() == docs.count()


def test_odd_texts_are_undetermined(frame):
    docs = frame([(1, None), (2, ""), (3, "12 !"), (4, "ab ab"), (4, "ab ab")])
    profiles = learn_profiles(docs)
    got = sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in predict(docs, profiles).collect())
    assert got == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (4, "en", 1.0), (4, "en", 1.0)]
    nothing = learn_profiles(docs.limit(0))
    assert {r["lang_pred"] for r in predict(docs, nothing).collect()} == {"und"}
    assert predict(docs.limit(0), profiles).count() == 0


# --- outliers -------------------------------------------------------------------------


def statistics_by_hand(text):
    words, lines = words_of(text), [x for x in (text or "").split("\n") if words_of(x)]
    triples = Counter(zip(words, words[1:], words[2:], strict=False))
    inside = set()
    for i, t in enumerate(zip(words, words[1:], words[2:], strict=False)):
        if triples[t] > 1:
            inside |= {i, i + 1, i + 2}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside)


def test_statistics_against_brute_force(frame, corpus):
    texts = [*corpus, "a b c a b c\n\n a\n a\n", "#*$%&|<> x y\x1fz", "q\nq\nq \n"]
    got = statistics(frame(texts)).collect()
    want = [(i, *statistics_by_hand(t)) for i, t in enumerate(texts)]
    assert sorted(tuple(r)[:1] + tuple(r)[3:] for r in got) == want


def test_far_documents_are_rejected_and_near_ones_stay(frame):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(400)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(60, 300))) for _ in range(200)]
    far = ["# $ ".join(rng.choices(vocabulary, k=100)) for _ in range(20)]
    odd = [None, "", "too short", "x y z " * 60]
    got = {r["doc_id"]: r for r in judge_documents(frame(texts + far + odd, lang=None)).collect()}
    assert all(got[i]["kept"] for i in range(200))
    assert not any(got[i]["kept"] or got[i]["base_failed"] for i in range(200, 220))
    assert all(got[i]["base_failed"] and not got[i]["kept"] for i in range(220, 224))
    assert judge_documents(frame(["x"]).limit(0)).count() == 0
    few = judge_documents(frame(far)).collect()  # too few for an estimate
    assert all(r["kept"] and r["distance"] is None for r in few)


def test_documents_of_symbols_or_of_repeated_lines_are_rejected(frame):
    """Below the base rule, in a clean group: each statistic can reject alone."""
    rng = random.Random(9)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(400)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(60, 300))) for _ in range(200)]
    own = rng.sample(vocabulary, 180)
    symbols = " ".join(w if i % 20 else f"#{w}" for i, w in enumerate(own[:100]))
    line = " ".join(own[:3])
    lines = "\n".join([" ".join(own[3 : 3 + 70]), *[line] * 17])  # 17 lines of 3 words in 121
    two = [" ".join(own[i : i + 2]) for i in range(0, 80, 2)]
    pairs = "\n".join([*two, *rng.sample(two, 40)])
    got = {r["doc_id"]: r for r in judge_documents(frame([*texts, symbols, lines, pairs])).collect()}
    assert [got[i]["n_symbols"] * 100 / got[i]["n_words"] for i in (200,)] == [5]
    assert got[201]["n_dup_lines"] == 16 and got[202]["n_dup_lines"] == 40
    assert not any(got[i]["kept"] or got[i]["base_failed"] for i in (200, 201, 202))
    assert sum(got[i]["kept"] for i in range(200)) >= 198


def test_estimate_is_that_of_a_concentrated_half(spark):
    """Mean and spread are roughly those of the clean rows, whatever the others are."""
    from quayside.llm.outliers import GROUP, MEAN, X, estimates
    from quayside.scratch import Workspace

    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5)) @ np.diag([1, 2, 0.5, 1, 3]) + 4
    x[:60] += 40
    rows = spark.createDataFrame([("=a", "=b", *map(float, v)) for v in x], [*GROUP, *X])
    p = Outliers()
    final = estimates(rows, Workspace(spark, "test"), p).first()
    clean = x[60:]
    assert np.allclose([final[c] for c in MEAN], clean.mean(axis=0), atol=0.25)
    spread = 1 / (np.array([final[f"inverse{i}{i}"] for i in range(5)]))
    assert np.all(spread > 0.5 * clean.var(axis=0)) and np.all(spread < 1.5 * clean.var(axis=0) + 0.3)


def estimate_by_hand(x, p):
    """Mean and covariance of a group's rows by the steps of the method, with whole groups sorted."""

    def at(bins, share):
        return np.sort(bins)[math.ceil(share * len(bins)) - 1]

    def distance(mean, cov):
        return np.einsum("ni,ij,nj->n", x - mean, np.linalg.inv(cov), x - mean)

    def fitted(rows, factor=1.0):
        cov = factor * np.cov(rows.T, bias=True)
        i = np.arange(5)
        cov[i, i] += np.maximum(np.square(p.floors) - cov[i, i], p.least_variance)
        return rows.mean(axis=0), cov

    low, middle, high = ([at(np.floor(c * 200), q) for c in x.T] for q in (0.25, 0.5, 0.75))
    spread = np.maximum((np.array(high) - low) / 200 / 1.349, p.floors)
    mean, cov, before = (np.array(middle) + 0.5) / 200, np.diag(spread**2), 0.0
    for step in range(p.steps):
        bins = np.floor(np.log(distance(mean, cov) + 1e-6) * 100)
        mean, cov = fitted(x[bins <= at(bins, p.half)])
        now = np.linalg.slogdet(cov)[1]
        if step and abs(now - before) < 1e-6:
            break
        before = now
    mean, cov = fitted(x[distance(mean, cov) / p.nearest <= p.weight_cut], p.reweighted)
    return distance(mean, cov)


def test_verdicts_are_those_of_sorted_groups(frame):
    """``kept`` and ``distance`` against the same estimate with whole groups in memory."""
    rng = random.Random(12)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(300)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(60, 400))) for _ in range(150)]
    for i in range(0, 150, 9):  # some repeat lines, some have symbols, some are short words
        texts[i] += "\n" + "\n".join([" ".join(rng.choices(vocabulary, k=4))] * (i % 5))
        texts[i + 1] = texts[i + 1].replace(" ", " #", i % 12)
        texts[i + 2] = " ".join(w[:2] for w in texts[i + 2].split())
    p = Outliers()
    got = {r["doc_id"]: r for r in judge_documents(frame(texts)).collect()}
    rows = {}
    for i, text in enumerate(texts):
        n, chars, symbols, lines, repeats = statistics_by_hand(text)
        failed = n < p.min_words or 100 * repeats > p.max_repeat_percent * n
        assert got[i]["base_failed"] == failed
        if not failed:
            rates = [math.log1p(100 * c / n) for c in (symbols, lines, repeats)]
            rows[i] = [math.log(n), chars / n, *rates]
    want = estimate_by_hand(np.array(list(rows.values())), p)
    assert np.allclose([got[i]["distance"] for i in rows], want, rtol=1e-6)
    kept = want <= p.cut
    assert [got[i]["kept"] for i in rows] == kept.tolist() and 0.5 < kept.mean() < 1


# --- rules ----------------------------------------------------------------------------


def test_rules_are_simplified_and_compiled(spark):
    path = ((1, True, 5.0), (0, False, 1.0), (1, True, 3.0), (0, False, 2.0))
    assert simplified(path) == ((0, False, 2.0), (1, True, 3.0))
    assert tuple(text_statistics(F.lit(""))) == NAMES


def test_rules_separate_held_out_documents(spark):
    out = QUERIES["op1_rule_ensemble"](spark, SF_DIR).cache()
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    right, n = out.where("held_out").join(labels, "doc_id").agg(
        F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")
    ).first()
    assert n > 50 and right > 0.95
    assert out.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert out.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()


def test_score_is_the_sum_of_the_rules(spark, frame, corpus):
    stats = with_statistics(frame(corpus))
    rows = stats.withColumn("label", (F.col("word_length") > 4.5).cast("double"))
    ensemble = fit(rows, RuleParameters(trees=3, depth=2))
    assert ensemble.rules
    for r in stats.withColumn("score", score_column(ensemble)).collect():
        total = ensemble.intercept
        for rule, weight in ensemble.rules:
            if all((r[NAMES[i]] <= t) == below for i, below, t in rule):
                total += weight
        assert math.isclose(r["score"], 1 / (1 + math.exp(-total)), rel_tol=1e-9)


def test_odd_labels(spark, frame):
    stats = with_statistics(frame([(1, "a"), (2, None), (2, None), (None, ""), (4, "b")]))
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (4, 0)], "doc_id long, quality int")
    rows = labelled(stats, labels, F.lit(True), RuleParameters())
    assert sorted((r["doc_id"], r["label"]) for r in rows.collect()) == [(1, 1.0), (4, 0.0)]
    none = fit(rows.limit(0))
    assert [round(r[0], 3) for r in stats.limit(1).select(score_column(none)).collect()] == [0.5]
    assert labelled(stats, labels.limit(0), F.lit(True), RuleParameters()).count() == 0


def test_only_the_sample_reaches_one_task(frame, corpus):
    """Labels by partition: all would be 1 if the rows were made in the task of the fit."""
    from pyspark import TaskContext

    first = F.udf(lambda _: float(TaskContext.get().partitionId() == 0), "double").asNondeterministic()
    rows = with_statistics(frame(corpus)).withColumn("label", first("doc_id"))
    assert fit(rows.withColumn("word_length", F.col("label")), RuleParameters(trees=3, depth=2)).rules


def test_rows_that_repeat_a_labelled_id_are_bounded(spark, frame):
    stats = with_statistics(frame([(1, f"{'a ' * i}b") for i in range(400)] + [(1, "c")] * 200 + [(2, "d")] * 10))
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    p = RuleParameters(most_rows=100)
    assert 60 <= labelled(stats, labels, F.lit(True), p).count() <= 140
    assert labelled(stats.where("doc_id = 2"), labels, F.lit(True), p).count() == 10
