"""Near copies among vectors: a small-world graph per shard, verified cosines, components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.components import connected
from quayside.llm.small_worlds import BATCH, Graph, build, level_sizes
from quayside.llm.vectors import packed, padded, piece_of, pieces, sound, values
from quayside.scratch import Workspace


@dataclass(frozen=True)
class NearVectors:
    """Parameters.

    Vectors with a cosine of at least ``cosine`` are linked. A shard's graph has about ``shard_rows``
    vectors, a task asks about ``query_rows`` of one shard. Beams start at ``beam`` and double
    until ``recall`` of the links an audit knows are found, or up to ``widest``; what a beam
    that wide misses is found by a scan of the shard. ``audited`` vectors take part in an audit.
    """

    cosine: float = 0.9
    shard_rows: int = 16_384
    query_rows: int = 4096
    beam: int = 16
    widest: int = 256
    recall: float = 0.99
    audited: int = 256


def near_vectors(rows: DataFrame, p: NearVectors | None = None) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    ``rows`` has ``vec_id`` and ``embedding``. A vector that is NULL, zero, or has NULL or
    non-finite components links with nothing; a shorter vector counts as if it ended in zeros. Rows
    with equal vectors are linked with each other and counted one by one, though only one of them
    is searched for. A NULL id is never the smallest; a component of such rows alone has the id NULL. Other
    columns are left out; an empty table gives no rows.

    Vectors are dealt to shards by a hash, and each shard gets a graph whose beam passes an
    audit: vectors of the shard turned until their cosine is just ``cosine`` have to find where they came
    from. Every vector asks its own shard and those after it, so each pair of shards meets once. A
    second audit scans the shard for a few of the vectors that ask. A vector whose
    whole beam is linked has more links than it can hold, and scans the shard as well. Found pairs are
    confirmed in double precision. A task sends on counts and a spanning forest of its
    links, at most a row per vector, whatever the number of pairs.
    """
    p = p or NearVectors()
    work = Workspace(rows.sparkSession, "near-vectors")
    # Adding zero makes -0.0 and 0.0 one value, in comparisons and hashes.
    usable = sound(F.col("embedding")) & F.exists("embedding", lambda c: c != 0)
    told = work.table(
        rows.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.when(usable, F.transform("embedding", lambda c: c.cast("double") + F.lit(0.0))).alias("x"),
        ).withColumn("hash", F.xxhash64("x")),
        "rows",
    )
    distinct = told.where("x IS NOT NULL").groupBy("hash", "x").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("smallest")
    )
    nodes = work.table(distinct.withColumn("node", F.monotonically_increasing_id()), "nodes")
    n, width = nodes.agg(F.count("*"), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    shards = pieces(n, p.shard_rows)
    dealt = nodes.select(
        piece_of(F.col("node"), shards).alias("shard"), "node", "copies", padded(F.col("x"), width, F.lit(0.0)).alias("x")
    )
    graphs = work.table(
        packed(dealt, "shard", "", flat=("x",)).repartition(shards, "shard").mapInArrow(builder(width, p), GRAPH), "graphs"
    )
    chunks = pieces(p.shard_rows, p.query_rows)
    asking = dealt.withColumn("chunk", F.pmod(F.xxhash64("node", F.lit("chunk")), F.lit(chunks)).cast("int"))
    asking = asking.withColumn("part", F.struct("shard", "chunk")).drop("shard", "chunk")
    pairs = (
        packed(asking, "part", "q_", flat=("x",))
        .withColumn("from_shard", F.col("part.shard"))
        .withColumn("shard", F.explode(F.sequence(F.col("part.shard"), F.lit(shards - 1))))
        .join(graphs, "shard")
        .repartition(min(shards * (shards + 1) // 2 * chunks, 100_000), "shard", "part")
        .drop("part")
    )
    found = work.table(pairs.mapInArrow(asker(width, p), FOUND), "found")

    component = connected(found.where("root IS NOT NULL").select(F.col("node").alias("a"), F.col("root").alias("b")), work, "links")
    component = component.distinct()
    counts = found.where("links > 0").groupBy("node").agg(F.sum("links").alias("links"))
    joined = nodes.select("hash", "x", "node", "copies", "smallest").join(component, "node", "left").join(counts, "node", "left")
    joined = work.table(joined.withColumn("component", F.coalesce("component", "node")), "joined")
    smallest = joined.groupBy("component").agg(F.min("smallest").alias("component_id"))
    by_vector = joined.join(smallest, "component").select(
        "hash", "x", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    linked = told.where("x IS NOT NULL").join(by_vector, ["hash", "x"]).select("vec_id", "n_links", "component_id")
    alone = told.where("x IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


GRAPH = "shard int, node array<long>, copies array<long>, x array<double>, links array<int>, loose array<int>, beam int"
FOUND = "node long, links long, root long"


def units(x: np.ndarray) -> np.ndarray:
    """Vectors of length one, whatever the size of their components."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def lists(values_: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array([pa.array(values_, kind)], pa.list_(kind))


def builder(width: int, p: NearVectors):
    """Packed shards to shards in the order of their levels, with a graph."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                node = values(batch, "node", i)
                # which vectors are on the upper levels must not depend on how rows arrive
                order = np.argsort(node, kind="stable")
                order = order[np.random.default_rng(len(node)).permutation(len(node))]
                x = values(batch, "x", i).reshape(len(node), width)[order]
                graph = build(units(x).astype(np.float32))
                beam = audited_beam(graph, p)
                links = np.concatenate([level.ravel() for level in graph.links])
                yield pa.record_batch(
                    [
                        batch.column("shard").slice(i, 1),
                        lists(node[order], pa.int64()),
                        lists(values(batch, "copies", i)[order], pa.int64()),
                        lists(x.ravel(), pa.float64()),
                        lists(links, pa.int32()),
                        lists(graph.loose, pa.int32()),
                        pa.array([beam], pa.int32()),
                    ],
                    names=["shard", "node", "copies", "x", "links", "loose", "beam"],
                )

    return run


def audited_beam(graph: Graph, p: NearVectors) -> int:
    """The first beam with which vectors turned away to the least cosine find where they came from."""
    rng = np.random.default_rng(len(graph.x))
    at = rng.choice(len(graph.x), min(p.audited, len(graph.x)), replace=False)
    origin = graph.x[at].astype(float)
    aside = rng.standard_normal(origin.shape)
    aside -= (aside * origin).sum(axis=1, keepdims=True) * origin
    aside /= np.maximum(np.linalg.norm(aside, axis=1, keepdims=True), 1e-300)
    turned = (p.cosine * origin + np.sqrt(1 - p.cosine**2) * aside).astype(np.float32)
    beam = p.beam
    while beam < p.widest:
        ids, cosines = graph.search(turned, beam)
        # copies of the origin may hold all of a beam; those that did so are scanned later
        found = (ids == at[:, None]).any(axis=1) | (cosines[:, -1] >= p.cosine) | np.isin(at, graph.loose)
        if found.mean() >= p.recall:
            break
        beam *= 2
    return beam


def asker(width: int, p: NearVectors):
    """Pairs of asking vectors and a shard to counts of links and a spanning forest."""
    # how far a cosine of two vectors in single precision may be off
    margin = 1e-6 + 4 * width * float(np.finfo(np.float32).eps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own, node = values(batch, "q_node", i), values(batch, "node", i)
                exact_q, exact = (units(values(batch, c, i).reshape(-1, width)) for c in ("q_x", "x"))
                graph = unpacked(exact, values(batch, "links", i), values(batch, "loose", i))
                q = exact_q.astype(np.float32)
                inner = batch.column("from_shard")[i].as_py() == batch.column("shard")[i].as_py()
                beam = batch.column("beam")[i].as_py()
                # the place of each asking vector in its own shard
                at = placed(own, node) if inner else np.full(len(own), -1)
                audit = np.linspace(0, len(own) - 1, min(len(own), p.audited // 4)).astype(int)
                known = scan(graph.x, q[audit], p.cosine, margin)
                while True:
                    asked, met = search(graph, q, beam, p, margin)
                    if beam >= len(node) or recall(asked, met, audit, known, len(node)) >= p.recall:
                        break
                    beam *= 2
                keep = met > at[asked] if inner else slice(None)
                asked, met = asked[keep], met[keep]
                sure = confirmed(exact_q, exact, asked, met, p.cosine)
                yield counted(own, node, asked[sure], met[sure], values(batch, "q_copies", i), values(batch, "copies", i))

    return run


def unpacked(exact: np.ndarray, links: np.ndarray, loose: np.ndarray) -> Graph:
    from quayside.llm.small_worlds import NEIGHBOURS

    levels, done = [], 0
    for level, n in enumerate(level_sizes(len(exact))):
        most = NEIGHBOURS if level else 2 * NEIGHBOURS
        levels.append(links[done : done + n * most].reshape(n, most))
        done += n * most
    return Graph(exact.astype(np.float32), levels, loose)


def placed(own: np.ndarray, node: np.ndarray) -> np.ndarray:
    order = np.argsort(node)
    return order[np.searchsorted(node, own, sorter=order)]


def search(graph: Graph, q: np.ndarray, beam: int, p: NearVectors, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose cosine may reach the least one: asking vector, vector of the shard."""
    pairs = []
    for low in range(0, len(q), BATCH):
        part = q[low : low + BATCH]
        ids, cosines = graph.search(part, beam)
        hit = (cosines >= p.cosine - margin) & (ids >= 0)
        full = hit.all(axis=1)
        row, column = np.nonzero(hit & ~full[:, None])
        pairs.append((row + low, ids[row, column]))
        crowded = np.flatnonzero(full)
        row, met = scan(graph.x, part[crowded], p.cosine, margin)
        pairs.append((crowded[row] + low, met))
        if len(graph.loose):
            sparse = np.flatnonzero(~full)
            row, met = scan(graph.x[graph.loose], part[sparse], p.cosine, margin)
            pairs.append((sparse[row] + low, graph.loose[met]))
    row, met = (np.concatenate([pair[c] for pair in pairs]).astype(np.int64) for c in (0, 1))
    both = np.unique(row * len(graph.x) + met)
    return both // len(graph.x), both % len(graph.x)


def scan(x: np.ndarray, q: np.ndarray, cosine: float, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs whose cosine may reach the least one, by products of blocks."""
    rows, met = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for low in range(0, len(q), 256):
        row, column = np.nonzero(q[low : low + 256] @ x.T >= cosine - margin)
        rows.append(row + low)
        met.append(column)
    return np.concatenate(rows), np.concatenate(met)


def recall(asked, met, audit, known, n: int) -> float:
    """The share of the links that a scan knows for some vectors which the search has found."""
    want = np.unique(audit[known[0]].astype(np.int64) * n + known[1])
    return 1.0 if not len(want) else float(np.isin(want, asked * n + met).mean())


def confirmed(exact_q, exact, asked, met, cosine: float) -> np.ndarray:
    """Which pairs reach the cosine in double precision."""
    sure = np.zeros(len(asked), dtype=bool)
    for low in range(0, len(asked), 1 << 16):
        part = slice(low, low + (1 << 16))
        sure[part] = np.einsum("nd,nd->n", exact_q[asked[part]], exact[met[part]]) >= cosine
    return sure


def counted(own, node, asked, met, own_copies, copies) -> pa.RecordBatch:
    """``node, links, root``: linked rows, and the node of a tree that holds all nodes it is linked with."""
    names, place = np.unique(np.concatenate([own, node]), return_inverse=True)
    a, b = place[: len(own)][asked], place[len(own) :][met]
    links = np.bincount(a, weights=copies[met], minlength=len(names)) + np.bincount(b, weights=own_copies[asked], minlength=len(names))
    root = np.arange(len(names))
    while True:
        before = root.copy()
        least = np.minimum(root[a], root[b])
        # roots of linked nodes are joined, so that a long chain takes few rounds
        for side in (a, b):
            np.minimum.at(root, before[side], least)
            np.minimum.at(root, side, least)
        root = root[root]
        if (root == before).all():
            break
    some = np.flatnonzero(links > 0)
    away = root[some] != some
    roots = pa.array(names[root[some]], pa.int64(), mask=~away)
    return pa.record_batch(
        [pa.array(names[some]), pa.array(links[some].astype(np.int64)), roots], names=["node", "links", "root"]
    )
