"""Hierarchical navigable small-world graphs over a block of unit vectors, in numpy.

Vectors are ordered so that those of each level are the first ones. Vectors are put in by
batches, and all queries of a batch take a step of their search at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Queries that take a step together, and entries of a beam that are opened in a step.
BATCH, OPENED = 512, 6
#: Beam while the graph is built and on its upper levels; new links to one vector a batch.
BUILD_BEAM, UPPER_BEAM, NEW_LINKS = 48, 8, 8
NEIGHBOURS = 16


@dataclass
class Graph:
    """``links[level]`` has a row of neighbours per vector of the level, -1 where there is none.

    ``loose`` are vectors that no path of links reaches; they are compared with every query.
    """

    x: np.ndarray
    links: list[np.ndarray]
    loose: np.ndarray

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest vectors met by each query and their cosines, the best first; -1 for none."""
        ids = np.zeros((len(queries), 1), dtype=np.int32)
        for upper in reversed(self.links[1:]):
            ids, _ = nearest(self.x, upper, queries, ids, UPPER_BEAM)
        return nearest(self.x, self.links[0], queries, ids, beam)


def level_sizes(n: int) -> list[int]:
    """Vectors on each level: every level has a sixteenth of the one below."""
    sizes = [n]
    while sizes[-1] > NEIGHBOURS:
        sizes.append(sizes[-1] // NEIGHBOURS)
    return sizes


def nearest(x, links, queries, start, beam) -> tuple[np.ndarray, np.ndarray]:
    """Beam search on one level, for all queries at once."""
    count, n = len(queries), len(links)
    width = max(beam, start.shape[1])
    ids = np.full((count, width), -1, dtype=np.int32)
    cosines = np.full((count, width), -np.inf, dtype=np.float32)
    ids[:, : start.shape[1]] = start
    first = np.einsum("qd,qkd->qk", queries, x[np.maximum(start, 0)])
    cosines[:, : start.shape[1]] = np.where(start >= 0, first, -np.inf)
    ids, cosines = top(ids, cosines, beam)
    seen = np.zeros((count, n), dtype=bool)
    at = np.nonzero(ids >= 0)
    seen[at[0], ids[at]] = True
    unopened = ids >= 0
    live = np.arange(count)
    step = min(OPENED, beam)
    while len(live):
        waiting = np.where(unopened[live], cosines[live], -np.inf)
        live = live[(waiting > -np.inf).any(axis=1)]
        if not len(live):
            break
        waiting = np.where(unopened[live], cosines[live], -np.inf)
        pick = np.argpartition(-waiting, step - 1, axis=1)[:, :step]
        opened = np.take_along_axis(waiting, pick, axis=1) > -np.inf
        unopened[live[:, None], pick] &= False
        found = np.where(opened[:, :, None], links[np.maximum(ids[live[:, None], pick], 0)], -1).reshape(len(live), -1)
        row, column = np.nonzero(found >= 0)
        node = found[row, column]
        fresh = ~seen[live[row], node]
        both = np.unique(row[fresh].astype(np.int64) * n + node[fresh])
        row, node = both // n, both % n
        seen[live[row], node] = True
        cosine = np.einsum("nd,nd->n", x[node], queries[live[row]])
        better = cosine > cosines[live[row], -1]
        row, node, cosine = row[better], node[better], cosine[better]
        if not len(row):
            continue
        each = np.bincount(row, minlength=len(live))
        place = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
        more_ids = np.full((len(live), each.max()), -1, dtype=np.int32)
        more = np.full(more_ids.shape, -np.inf, dtype=np.float32)
        more_ids[row, place], more[row, place] = node, cosine
        all_cosines = np.concatenate([cosines[live], more], axis=1)
        order = np.argsort(-all_cosines, axis=1, kind="stable")[:, :beam]
        cosines[live] = np.take_along_axis(all_cosines, order, axis=1)
        ids[live] = np.take_along_axis(np.concatenate([ids[live], more_ids], axis=1), order, axis=1)
        still = np.concatenate([unopened[live], more_ids >= 0], axis=1)
        unopened[live] = np.take_along_axis(still, order, axis=1)
    return ids, cosines


def top(ids, cosines, beam) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(-cosines, axis=1, kind="stable")[:, :beam]
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(cosines, order, axis=1)


def chosen(x, ids, cosines, most: int) -> np.ndarray:
    """Which candidates, sorted by falling cosine, become neighbours.

    A candidate that is nearer to a neighbour taken before it than to the vector itself waits:
    links should lead in all directions. What is then free goes to the nearest that waited.
    """
    between = x[np.maximum(ids, 0)]
    between = between @ between.transpose(0, 2, 1)
    valid = ids >= 0
    taken = np.zeros(ids.shape, dtype=bool)
    for c in range(ids.shape[1]):
        hidden = (taken[:, :c] & (between[:, c, :c] > cosines[:, c, None])).any(axis=1)
        taken[:, c] = valid[:, c] & ~hidden & (taken.sum(axis=1) < most)
    waiting = valid & ~taken
    free = most - taken.sum(axis=1)
    return taken | (waiting & (np.cumsum(waiting, axis=1) <= free[:, None]))


def build(x: np.ndarray) -> Graph:
    """The graph of unit vectors that are in the order of their levels."""
    sizes = level_sizes(len(x))
    most = [2 * NEIGHBOURS, *[NEIGHBOURS] * (len(sizes) - 1)]
    links = [np.full((n, m), -1, dtype=np.int32) for n, m in zip(sizes, most, strict=True)]
    done = 1
    while done < len(x):
        batch = np.arange(done, min(len(x), done + min(max(done // 2, 1), BATCH)))
        start = np.zeros((len(batch), 1), dtype=np.int32)
        for level in range(len(sizes) - 1, -1, -1):
            own = int(np.searchsorted(batch, sizes[level]))
            found, cosines = nearest(x, links[level], x[batch], start, BUILD_BEAM if own else UPPER_BEAM)
            start = found[:, :UPPER_BEAM]
            if own:
                put_in(x, links[level], batch[:own], found[:own], cosines[:own])
        done += len(batch)
    return Graph(x, links, unreached(links))


def put_in(x, links, batch, found, cosines) -> None:
    """Link a batch with what it found on a level and with each other."""
    mates = x[batch] @ x[batch].T
    np.fill_diagonal(mates, -np.inf)
    near = np.argsort(-mates, axis=1)[:, : min(NEIGHBOURS, len(batch) - 1)]
    ids = np.concatenate([found, batch[near].astype(np.int32)], axis=1)
    ids, cosines = top(ids, np.concatenate([cosines, np.take_along_axis(mates, near, axis=1)], axis=1), ids.shape[1])
    ids = np.where(cosines > -np.inf, ids, -1)
    take = chosen(x, ids, cosines, NEIGHBOURS)
    row, column = np.nonzero(take)
    each = take.sum(axis=1)
    place = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
    links[batch[row], place] = ids[row, column]
    back(x, links, ids[row, column], batch[row], cosines[row, column])


def back(x, links, to, source, cosine) -> None:
    """The links of a batch in the other direction; a full list keeps the best spread ones."""
    order = np.lexsort((-cosine, to))
    to, source, cosine = to[order], source[order], cosine[order]
    nodes, first, each = np.unique(to, return_index=True, return_counts=True)
    place = np.arange(len(to)) - np.repeat(first, each)
    keep = place < NEW_LINKS
    to, source, cosine, place = to[keep], source[keep], cosine[keep], place[keep]
    which = np.searchsorted(nodes, to)
    most = links.shape[1]
    for low in range(0, len(nodes), 4 * BATCH):
        part = nodes[low : low + 4 * BATCH]
        inside = (which >= low) & (which < low + len(part))
        new = np.full((len(part), NEW_LINKS), -1, dtype=np.int32)
        new[which[inside] - low, place[inside]] = source[inside]
        old = links[part]
        new[(new[:, :, None] == old[:, None, :]).any(axis=2)] = -1
        ids = np.concatenate([old, new], axis=1)
        cosines = np.einsum("pd,pkd->pk", x[part], x[np.maximum(ids, 0)])
        ids, cosines = top(ids, np.where(ids >= 0, cosines, -np.inf), ids.shape[1])
        ids = np.where(cosines > -np.inf, ids, -1)
        take = chosen(x, ids, cosines, most)
        packed = np.argsort(~take, axis=1, kind="stable")[:, :most]
        links[part] = np.where(np.take_along_axis(take, packed, axis=1), np.take_along_axis(ids, packed, axis=1), -1)


def unreached(links: list[np.ndarray]) -> np.ndarray:
    """Vectors of the lowest level that no path from the first vector reaches."""
    n = len(links[0])
    reached = np.zeros(n, dtype=bool)
    edge = np.zeros(min(n, 1), dtype=np.int64)
    reached[edge] = True
    while len(edge):
        edge = np.unique(links[0][edge])
        edge = edge[edge >= 0]
        edge = edge[~reached[edge]]
        reached[edge] = True
    return np.flatnonzero(~reached)
