"""Operators 4 and 5, and the pipeline."""

from __future__ import annotations

import math
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from by_hand import words_of
from pyspark.sql import functions as F

import corpus_pipeline
from quayside.llm import ranges
from quayside.llm.mixing import Mix, draws, mix_sources, mixed_documents, permuted, taken, targets
from quayside.llm.sharding import SEED, rendezvous, shard_manifest


def test_manifest(frame):
    rows = [(i, "é" * (i % 7)) for i in range(300)] + [(5, None)] * 3 + [(None, ""), (None, "")]
    got = shard_manifest(frame(rows), [1.0] * 8).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    slots: dict = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 8)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(8))
    assert len({r["shard"] for r in got if r["doc_id"] is None}) == 1
    assert shard_manifest(frame(["x"]).limit(0), [1.0]).count() == 0


def shard_by_hand(key, weights):
    """The shard with the smallest -ln(u) / weight, u from the standard 64-bit xxHash of seed, shard and key."""
    scores = []
    for shard, weight in enumerate(weights):
        if weight:
            h = 42
            for kind, value in (("<i", SEED), ("<i", shard), ("<q", key)):
                if value is not None:
                    h = xxhash.xxh64_intdigest(struct.pack(kind, value), seed=h)
            scores.append((-math.log(((h >> 11) + 0.5) / 2**53) / weight, shard))
    return min(scores)[1]


@pytest.mark.parametrize("weights", [[1.0] * 8, [1.0, 0.0, 3.0], [2.5]])
def test_shards_against_hand_written_rendezvous(spark, weights):
    keys = [*range(500), -7, 2**62, None]
    frame = spark.createDataFrame([(k,) for k in keys], "key long").withColumn("shard", rendezvous(F.col("key"), weights))
    assert {r["key"]: r["shard"] for r in frame.collect()} == {k: shard_by_hand(k, weights) for k in keys}


def test_shares_follow_weights_and_few_keys_move(spark):
    keys = spark.range(20_000)
    weights = [1.0, 2.0, 0.0, 5.0]
    rows = keys.select(
        rendezvous(F.col("id"), weights).alias("a"),
        rendezvous(F.col("id"), [*weights, 2.0]).alias("b"),
        rendezvous(F.col("id"), weights[:3]).alias("c"),
    ).collect()
    share = Counter(r["a"] for r in rows)
    assert share[2] == 0 and all(abs(share[i] / 20_000 - w / 8) < 0.02 for i, w in enumerate(weights))
    assert all(r["b"] in (r["a"], 4) for r in rows) and abs(Counter(r["b"] for r in rows)[4] / 20_000 - 0.2) < 0.02
    assert all(r["c"] == r["a"] for r in rows if r["a"] != 3)
    with pytest.raises(ValueError):
        rendezvous(F.col("id"), [0.0])


def test_rows_end_to_end(spark):
    rows = [("a", i % 40, 3) for i in range(400)] + [("b", 1, 0)] * 5 + [("b", 2, 7)]
    got = ranges.end_to_end(
        spark.createDataFrame(rows, "g string, id long, w long"), "g", F.col("w"), ["id", "w"]
    ).collect()
    for group, total in (("a", 1200), ("b", 7)):
        own = sorted((r["start"], r["w"]) for r in got if r["g"] == group and r["w"])
        assert [s for s, _ in own] == np.cumsum([0, *[w for _, w in own]])[:-1].tolist()
        assert own[-1][0] + own[-1][1] == total
    assert len(got) == len(rows)


@pytest.mark.parametrize("size", [1, 2, 3, 17, 1000])
def test_permutations(size):
    for key in (0, 5, 2**70):
        assert sorted(permuted(np.arange(size), size, key).tolist()) == list(range(size))
    if size == 1000:
        assert permuted(np.arange(size), size, 1).tolist() != permuted(np.arange(size), size, 2).tolist()


def test_targets_and_draws():
    mix = Mix(block_words=10)
    wanted = targets([1000, 1000, 1000], mix)
    assert wanted == pytest.approx([1875, 750, 375])
    wanted = targets([100, 1000, 5000, 0], mix)
    assert wanted[0] == 300 and wanted[3] == 0 and sum(wanted) == pytest.approx(6100)
    assert wanted[1] == pytest.approx(min(3000, 5800 * 2 / 3)) and wanted[2] == pytest.approx(5800 - wanted[1])
    counts = draws(wanted, [100, 1000, 5000, 0], mix).sum(axis=0)
    assert counts[0] == 30 and abs(counts[2] - wanted[2] / 10) < 5 and counts[3] == 0
    assert targets([], mix) == [] and targets([0, 0], mix) == [0, 0]
    with np.errstate(all="raise"):
        assert draws([], [], mix).shape == (8, 0)


def mixture(frame, spark):
    docs = frame(["w " * (37 * i % 230) for i in range(120)], source="a")
    docs = docs.unionByName(frame([(i, f"v{i} " * (11 * i % 90)) for i in range(200, 330)], source="b"))
    return docs.unionByName(frame([(500, None), (501, ""), (502, "x " * 900), (502, "x " * 900)], source=None))


def test_mixture(frame, spark):
    docs = mixture(frame, spark)
    mix = Mix(block_words=16)
    got = taken(mix_sources(docs, mix)).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter(
        (r["doc_id"], len(words_of(r["text"]))) for r in docs.collect()
    )
    total = sum(r["size"] for r in got)
    for size in {r["source_size"] for r in got}:
        own = [r for r in got if r["source_size"] == size]
        assert sum(r["size"] for r in own) == size
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) < 0.03 * total
        assert all(r["taken"] <= 3 * r["size"] for r in own)
    again = taken(mix_sources(docs.repartition(7, "text"), mix)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert taken(mix_sources(docs.limit(0), mix)).count() == 0


def test_mixed_documents_hold_the_words_taken(frame, spark):
    docs, mix = mixture(frame, spark), Mix(block_words=16)
    mixed = mixed_documents(docs, mix)
    assert mixed.columns == docs.columns
    words: Counter = Counter()
    for r in mixed.collect():
        words[r["doc_id"]] += len(words_of(r["text"]))
        assert r["n_chars"] == len(r["text"])
    want: Counter = Counter()
    for r in taken(mix_sources(docs, mix, identity=F.xxhash64(*[c for c in docs.columns if c != "text"]))).collect():
        want[r["doc_id"]] += r["taken"]
    assert +words == +want


def test_pipeline_stages_keep_clashing_columns_and_rows_of_one_id(spark):
    """Columns named like results pass, texts that share an id are judged apart, rows without an id too."""
    english, german = ("the cat sat on the mat and looked at the dog " * 3, "der hund und die katze liegen auf dem haus " * 3)
    rows = [(1, english, "en"), (1, german, "de"), (2, german, None), (None, english, "en"), (3, "12 -", "en"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr(
        "doc_id", "text", "lang", "'s' AS source", "1L AS n_chars", "'mine' AS SCORE", "'mine' AS lang_pred", "'mine' AS shard"
    )
    told = corpus_pipeline.language(spark, docs, "")
    assert told.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"], r["lang"]) for r in told.collect()) == sorted(
        [(1, english, "en"), (1, german, "de"), (2, german, "de"), (0, english, "en")]
    )
    assert {tuple(r) for r in told.select("SCORE", "lang_pred", "shard").collect()} == {("mine",) * 3}
    kept = corpus_pipeline.dedup(spark, told, "")
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == sorted([(1, english), (1, german)])
    sharded = corpus_pipeline.shard(spark, kept, "")
    assert {(r["doc_id"], r["shard"]) for r in sharded.collect()} == {(1, shard_by_hand(1, [1.0] * 8))}


def test_pipeline(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "dedup", "decontaminate", "mix", "shard"]
    out, ids = docs, set()
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"] for r in out.select("doc_id").collect()}
        out = spark.createDataFrame(stage(spark, out, sf_dir).toPandas(), stage(spark, out, sf_dir).schema)
        ids = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert ids <= before and ids
        if name != "shard":
            assert out.columns == docs.columns
    final = corpus_pipeline.run(spark, sf_dir)
    assert Counter(map(tuple, final.collect())) == Counter(map(tuple, out.collect()))
    assert {r["shard"] for r in final.collect()} <= set(range(8))
