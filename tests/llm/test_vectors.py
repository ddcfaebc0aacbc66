"""Operators 11 to 13 against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import near_vectors as nv
from quayside.llm import negatives, small_worlds
from quayside.llm.near_vectors import NearVectors, near_vectors
from quayside.llm.negatives import Mining, SortedLists, hard_negatives
from quayside.llm.whitening import Whitening, count_above, leading, whiten

SCHEMA = "vec_id long, label int, embedding array<float>"
NAN, INF = float("nan"), float("inf")


@pytest.fixture
def vectors(spark):
    """Rows of (vec_id, label, vector), with columns whose names clash with the operators' own."""

    def make(rows):
        frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
        return frame.selectExpr("*", "'x' AS row", "'x' AS node", "'x' AS x", "'x' AS score", "'x' AS component")

    return make


UNSOUND = [None, [None, 1.0, 0.0], [NAN, 0.0, 1.0], [INF, 0.0, 0.0]]


def sound(vector) -> bool:
    return vector is not None and all(c is not None and math.isfinite(c) for c in vector)


# --- hard negatives -------------------------------------------------------------------


def negatives_by_hand(rows, p=Mining(), every=3):
    width = max((len(v) for _, _, v in rows if v), default=0)
    kept = [
        (i, label, [math.floor(p.scale * c) for c in np.float32(v).astype(float)] + [0] * (width - len(v)))
        for i, label, v in rows
        if label is not None and sound(v)
    ]

    def ranked(n, others, allowed):
        scored = [(-sum(a * b for a, b in zip(kept[n][2], kept[m][2], strict=True)), m) for m in others if allowed(m)]
        return sorted((s, kept[m][0] is None, kept[m][0] or 0) for s, m in scored)

    out = []
    for n, (i, label, _) in enumerate(kept):
        if i is None or i % every:
            continue
        others = [m for m in range(len(kept)) if m != n]
        positives = ranked(n, others, lambda m: kept[m][1] == label)[: p.positives]
        negatives = ranked(n, others, lambda m: kept[m][1] != label)
        for ps, p_null, pid in positives:
            fit = [x for x in negatives if p.least * -ps <= 100 * -x[0] <= p.most * -ps][: p.negatives]
            for rank, (ns, n_null, nid) in enumerate(fit, start=1):
                out.append((i, None if p_null else pid, rank, None if n_null else nid, -ps, -ns))
    return sorted(out, key=repr)


@pytest.mark.parametrize("kind", ["prose", "ties", "tiny"])
def test_negatives(vectors, kind):
    rng = np.random.default_rng(5)
    n, width, spread = {"prose": (300, 8, 1.0), "ties": (200, 3, 0.01), "tiny": (7, 2, 1.0)}[kind]
    rows = [(i, int(rng.integers(0, 3)), (spread * rng.standard_normal(width)).tolist()) for i in range(n)]
    rows += [(n, None, [1.0] * width), (n + 3, 1, [])] + [(n + 6 + k, 1, v) for k, v in enumerate(UNSOUND)]
    rows += [rows[0], rows[0], (None, 1, [0.5] * width), (None, 2, [0.5] * width)]
    p = Mining(block_rows=64, group_rows=16)
    got = hard_negatives(vectors(rows), F.col("vec_id") % 3 == 0, p)
    assert sorted(map(tuple, got.collect()), key=repr) == negatives_by_hand(rows, p)


def test_tasks_of_negatives_do_not_grow_with_the_pairs(spark, vectors):
    """Forty blocks and as many groups are no 1,600 tasks; the groups come one after the other."""
    rng = np.random.default_rng(3)
    rows = [(i, i % 2, rng.standard_normal(3).tolist()) for i in range(40)]
    p = Mining(block_rows=1, group_rows=1)
    spark.sparkContext.setJobGroup("negatives", "")
    try:
        got = hard_negatives(vectors(rows), F.lit(True), p).collect()
        tracker = spark.sparkContext.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup("negatives") for s in tracker.getJobInfo(j).stageIds]
        most = max(info.numTasks for info in map(tracker.getStageInfo, stages) if info)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert most <= 40
    assert sorted(map(tuple, got), key=repr) == negatives_by_hand(rows, p, every=1)


def test_a_task_of_negatives_goes_through_several_blocks_and_stripes(vectors, monkeypatch):
    """Whatever a task holds and however many there are, also where no row was dealt to a block."""
    rng = np.random.default_rng(4)
    rows = [(i, i % 2, rng.standard_normal(3).tolist()) for i in range(30)]
    p = Mining(block_rows=2, group_rows=3)
    for given in ((1, 1, 4), (4, 3, 2)):
        monkeypatch.setattr(negatives, "grid", lambda *_, given=given: given)
        got = hard_negatives(vectors(rows), F.lit(True), p)
        assert sorted(map(tuple, got.collect()), key=repr) == negatives_by_hand(rows, p, every=1)
    monkeypatch.undo()
    for blocks, n_anchors in ((1, 0), (7, 1_000), (75, 12_000), (2_000, 300_000), (90_000, 10**7)):
        held, stripes, tasks = negatives.grid(blocks, -(-n_anchors // 128) or 1, n_anchors, 20 * 64 * 8192, 500)
        assert 1 <= tasks <= 500 and stripes >= 1 and held * 20 * 64 * 8192 <= negatives.HELD_BYTES


def test_no_rows_give_no_negatives(vectors):
    assert hard_negatives(vectors([(0, None, [1.0])]), F.lit(True)).count() == 0
    assert hard_negatives(vectors([(0, 1, [1.0])]).limit(0), F.lit(True)).count() == 0
    with pytest.raises(OverflowError):
        hard_negatives(vectors([(0, 1, [8e6] * 4), (1, 1, [8e6] * 4)]), F.lit(True))


def test_lists_are_read_no_further_than_the_bound_asks():
    """The search stops with rows unmet, and what it leaves out is below what it found."""
    rng = np.random.default_rng(1)
    x = rng.integers(-5, 5, (4000, 4))
    x[:6] = rng.integers(200, 255, (6, 4))
    lists, anchor = SortedLists(x.astype(np.float64)), np.array([3.0, 2, 4, 1])
    met = sum(len(rows) for rows, _, _ in lists.rounds(anchor))
    assert met == len(x)
    rows, scores = lists.best(anchor, np.ones(len(x), bool), np.array([-(2**62)]), np.array([2**62]), 5)
    assert len(rows) < len(x) / 2
    assert sorted(scores)[-5:] == sorted(x @ anchor)[-5:]


# --- whitening ------------------------------------------------------------------------


def test_whitening(vectors):
    rng = np.random.default_rng(2)
    mixing = rng.standard_normal((12, 12))
    rows = [(i, 0, (rng.standard_normal(12) @ mixing).tolist()) for i in range(400)]
    rows += [(1000 + i, 0, v) for i, v in enumerate(UNSOUND)] + [rows[3], (None, None, [0.25] * 5)]
    got = whiten(vectors(rows)).toPandas()
    used = [(i, v + [0.0] * (12 - len(v))) for i, _, v in rows if sound(v)]
    x = np.floor(1024 * np.float32([v for _, v in used]).astype(float)).astype(np.int64) + 100_000
    n = len(x)
    values, base = np.linalg.eigh(np.cov(x.T, bias=True))
    values, base = values[::-1], base[:, ::-1]
    white = (x - x.sum(axis=0) / n) @ base[:, :8] / np.sqrt(values[:8])
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, x.sum(axis=0), strict=True)) for row in x]
    assert len(got) == 8 * n and set(got.n) == {n} and got.identity_error.max() < 1e-9
    assert got.vec_id.isna().sum() == 8 and (got.vec_id == 3).sum() == 16
    assert np.allclose(got.groupby("component").explained.first(), values[:8] / values.sum(), rtol=1e-10)
    for k, (i, _) in enumerate(used[:50]):
        own = got[got.vec_id == i].sort_values("component").head(8) if i != 3 else None
        if own is not None:
            assert list(own.component) == list(range(1, 9)) and set(own.deviation) == {deviation[k]}
            assert np.allclose(np.abs(own.whitened), np.abs(white[k]), atol=1e-9)
    signs = got[got.vec_id < 3].pivot(index="vec_id", columns="component", values="whitened").values
    assert len({tuple(row) for row in np.sign(signs * white[:3]).astype(int)}) == 1


def test_whitening_of_few_or_equal_rows(vectors):
    assert whiten(vectors([(1, 1, [1.0, 2.0])]).limit(0)).count() == 0
    assert whiten(vectors([(1, 1, [1.0, 2.0])] * 3)).count() == 0
    line = whiten(vectors([(i, 1, [float(i), 2.0 * i, 0.0]) for i in range(5)])).toPandas()
    assert len(line) == 5 and set(line.component) == {1} and line.explained[0] == pytest.approx(1)
    huge = whiten(vectors([(i, 1, [1e9 * i]) for i in range(3)])).toPandas()
    assert huge.deviation.isna().any() and huge.identity_error.max() < 1e-9
    assert whiten(vectors([(i, 1, [float(i), float(i % 2)]) for i in range(9)]), Whitening(components=1)).count() == 9


def test_eigenvalues_close_together():
    rng = np.random.default_rng(0)
    base = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    values = np.r_[5, 4, 4, 4, 3.9999999, 3.9999998, np.full(24, 1.0)]
    a = (base * values) @ base.T
    a = (a + a.T) / 2
    found = leading(a, 8)
    p = np.stack([v for _, v in found], axis=1)
    assert np.allclose([e for e, _ in found], values[:8], rtol=1e-12)
    assert np.abs(p.T @ a @ p - np.diag(values[:8])).max() < 1e-8
    assert np.abs(p.T @ p - np.eye(8)).max() < 1e-8
    for shift in (5.1, 4.5, 3.9999999 + 5e-8, 3.0, 0.5):
        assert count_above(a, shift) == (values > shift).sum()
    assert leading(np.zeros((3, 3)), 8) == []


# --- near copies ----------------------------------------------------------------------


def copies_by_hand(rows, cosine=0.9):
    width = max((len(v) for _, _, v in rows if v), default=0)
    unit = []
    for _, _, v in rows:
        ok = sound(v) and any(v)
        x = np.array(v + [0.0] * (width - len(v)), dtype=np.float32).astype(float) if ok else np.zeros(width)
        unit.append(x / (np.linalg.norm(x) or 1))
    near = np.array(unit) @ np.array(unit).T >= cosine - 1e-15
    np.fill_diagonal(near, False)
    group = list(range(len(rows)))
    for _ in rows:
        for a, b in zip(*np.nonzero(near), strict=True):
            group[a] = group[b] = min(group[a], group[b])
    out = []
    for n, (i, _, _) in enumerate(rows):
        ids = [rows[m][0] for m in range(len(rows)) if group[m] == group[n] and rows[m][0] is not None]
        smallest = min(ids, default=None)
        out.append((i, int(near[n].sum()), smallest, i == smallest))
    return sorted(out, key=repr)


@pytest.fixture
def clusters():
    rng = np.random.default_rng(8)
    rows = []
    for size in (1, 2, 3, 40, 90):
        centre = rng.standard_normal(16)
        rows += [(centre + 0.2 * rng.standard_normal(16)).tolist() for _ in range(size)]
    rows += rng.standard_normal((150, 16)).tolist()
    order = rng.permutation(len(rows))
    return [(int(i), 0, rows[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize("shard_rows", [10_000, 60])
def test_near_copies(vectors, clusters, shard_rows):
    rows = clusters + [(500 + i, 0, v) for i, v in enumerate(UNSOUND)]
    rows += [(600, 0, [0.0] * 16), (601, 0, [-0.0] * 16), (602, 0, []), (603, None, clusters[0][2]), clusters[1]]
    rows += [(None, 0, clusters[0][2]), (None, 0, [9e30, *[0.0] * 15]), (604, 0, [1e-30]), (605, 0, [3.0])]
    got = near_vectors(vectors(rows), NearVectors(shard_rows=shard_rows, query_rows=40, beam=4, widest=8))
    assert sorted(map(tuple, got.collect()), key=repr) == copies_by_hand(rows)


def test_no_rows_give_no_copies(vectors):
    assert near_vectors(vectors([(0, 1, [1.0])]).limit(0)).count() == 0
    assert [tuple(r) for r in near_vectors(vectors([(4, 1, None)])).collect()] == [(4, 0, 4, True)]


def test_a_graph_finds_the_nearest():
    rng = np.random.default_rng(4)
    x = nv.units(rng.standard_normal((3000, 24))).astype(np.float32)
    graph = small_worlds.build(x)
    q = nv.units(rng.standard_normal((200, 24))).astype(np.float32)
    ids, cosines = graph.search(q, 64)
    best = (q @ x.T).argmax(axis=1)
    assert (ids[:, 0] == best).mean() > 0.95
    assert (np.diff(cosines, axis=1) <= 0).all() and all(len(set(row)) == len(row) for row in ids)
    assert all((level >= -1).all() and (level < len(level)).all() for level in graph.links)


def test_beams_widen_until_the_audit_passes():
    rng = np.random.default_rng(6)
    x = nv.units(rng.standard_normal((2000, 64))).astype(np.float32)
    graph = small_worlds.build(x)
    easy, hard = (nv.audited_beam(graph, NearVectors(beam=1, recall=r)) for r in (0.1, 0.999))
    assert easy < hard
