"""A hierarchical navigable small-world graph over the vectors of one shard, in flat arrays.

Each node has a top level, drawn from its number so that each level holds about a sixteenth
of the one below. The nodes of a level are linked by array operations, all at once: the
nearest CANDIDATES of each node are found block by block; going from near to far, one is
chosen if it is nearer to the node than to all chosen before, so links spread in all
directions; free places go to the nearest others; links also count in reverse, up to twice
LINKS. Neighbours are rows of one array of numbers, padded by -1.

A search descends greedily to the lowest level and keeps the WIDTH best nodes seen there,
going on from the best one not yet used, until all are used. It runs for many queries side
by side. Nearness is the inner product. For building, vectors get one more component that
makes their lengths equal, which turns the largest product into the smallest distance.
Equal vectors are one node.
"""

from __future__ import annotations

import numpy as np

from jobgrain.llm import wordhash

LINKS = 24
CANDIDATES = 48
WIDTH = 128
_LEVEL = 16  # nodes of a level for one of the next
_BLOCK = 512


def _nearest(points: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and products of the k nearest others of each point, nearest first."""
    n = len(points)
    index = np.empty((n, k), dtype=np.int32)
    value = np.empty((n, k), dtype=np.float32)
    for low in range(0, n, _BLOCK):
        product = points[low : low + _BLOCK] @ points.T
        product[np.arange(len(product)), low + np.arange(len(product))] = -np.inf
        near = np.argpartition(-product, k - 1, axis=1)[:, :k] if k < n else np.argsort(-product)
        own = np.take_along_axis(product, near, axis=1)
        order = np.argsort(-own, axis=1, kind="stable")
        index[low : low + _BLOCK] = np.take_along_axis(near, order, axis=1)
        value[low : low + _BLOCK] = np.take_along_axis(own, order, axis=1)
    return index, value


def _chosen(points: np.ndarray, index: np.ndarray, value: np.ndarray, links: int) -> np.ndarray:
    """Which candidates become links: spread ones first, then the nearest."""
    out = np.zeros(index.shape, dtype=bool)
    for low in range(0, len(index), _BLOCK):
        near = points[index[low : low + _BLOCK]]
        among = near @ near.transpose(0, 2, 1)
        own = value[low : low + _BLOCK]
        keep = np.zeros(own.shape, dtype=bool)
        for j in range(own.shape[1]):
            hidden = (keep & (among[:, j, :] >= own[:, j, None])).any(axis=1)
            keep[:, j] = ~hidden & (keep.sum(axis=1) < links)
        free = links - keep.sum(axis=1)
        rest = np.cumsum(~keep, axis=1)
        out[low : low + _BLOCK] = keep | (~keep & (rest <= free[:, None]))
    return out


def _link(points: np.ndarray, links: int, candidates: int) -> np.ndarray:
    """Neighbours of each point, both ways, padded by -1."""
    n = len(points)
    k = min(candidates, n - 1)
    if k < 1:
        return np.full((n, 1), -1, dtype=np.int32)
    index, value = _nearest(points, k)
    chosen = _chosen(points, index, value, links)
    a, column = np.nonzero(chosen)
    b, product = index[a, column].astype(np.int64), value[a, column]
    first = np.concatenate((np.zeros(len(a), np.int8), np.ones(len(a), np.int8)))
    a, b, product = np.concatenate((a, b)), np.concatenate((b, a)), np.concatenate((product, product))
    order = np.lexsort((first, b, a))  # own links before reverse ones
    a, b, product, first = a[order], b[order], product[order], first[order]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    a, b, product, first = a[new], b[new], product[new], first[new]
    order = np.lexsort((-product, first, a))
    a, b = a[order], b[order]
    start = np.searchsorted(a, np.arange(n))
    place = np.arange(len(a)) - start[a]
    fits = place < 2 * links
    out = np.full((n, 2 * links), -1, dtype=np.int32)
    out[a[fits], place[fits]] = b[fits]
    return out


class Graph:
    """`ids[first[k]:first[k + 1]]` are the ids of node k, `vectors[k]` its vector,
    `members[l]` the nodes of level l, `links[l]` their neighbours (numbers of nodes)."""

    def __init__(self, ids, first, vectors, members, links):
        self.ids, self.first, self.vectors = ids, first, vectors
        self.members, self.links = members, links
        self.points = vectors.astype(np.float32)

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, links=LINKS, candidates=CANDIDATES):
        order = np.lexsort((ids, *vectors.T[::-1]))
        ids, vectors = ids[order], vectors[order]
        new = np.concatenate(([True], (vectors[1:] != vectors[:-1]).any(axis=1)))
        first = np.concatenate((np.flatnonzero(new), [len(ids)])).astype(np.int64)
        vectors = vectors[new]
        square = (vectors**2).sum(axis=1)
        even = np.sqrt(np.maximum(square.max() - square, 0))
        points = np.concatenate((vectors, even[:, None]), axis=1).astype(np.float32)
        with np.errstate(over="ignore"):
            draw = wordhash.mix(np.arange(1, len(vectors) + 1, dtype=np.uint64))
        chance = (draw >> np.uint64(11)).astype(np.float64) / 2.0**53
        level = np.floor(-np.log(np.maximum(chance, 1e-300)) / np.log(_LEVEL)).astype(int)
        members, levels = [], []
        for k in range(level.max() + 1):
            nodes = np.flatnonzero(level >= k)
            near = _link(points[nodes], links if k == 0 else links // 2, candidates)
            members.append(nodes.astype(np.int32))
            levels.append(np.where(near >= 0, nodes[near], -1).astype(np.int32))
        return cls(ids, first, vectors, members, levels)

    def flat(self) -> dict:
        """The arrays as bytes, for storing."""
        return {
            "ids": self.ids.tobytes(),
            "first": self.first.tobytes(),
            "vectors": self.vectors.tobytes(),
            "members": [m.tobytes() for m in self.members],
            "links": [x.tobytes() for x in self.links],
        }

    @classmethod
    def of_flat(cls, flat: dict):
        members = [np.frombuffer(m, dtype=np.int32) for m in flat["members"]]
        links = [
            np.frombuffer(x, dtype=np.int32).reshape(len(m), -1)
            for m, x in zip(members, flat["links"])
        ]
        first = np.frombuffer(flat["first"], dtype=np.int64)
        vectors = np.frombuffer(flat["vectors"], dtype=np.float64).reshape(len(first) - 1, -1)
        return cls(np.frombuffer(flat["ids"], dtype=np.int64), first, vectors, members, links)

    def _products(self, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Inner products of each query with its row of nodes (-1: none)."""
        out = np.matmul(self.points[nodes], queries[:, :, None])[:, :, 0]
        out[nodes < 0] = -np.inf
        return out

    def search(self, queries: np.ndarray, width: int = WIDTH) -> np.ndarray:
        """The best nodes found for each query (-1: none), best first."""
        queries = queries.astype(np.float32)
        n = len(queries)
        at = np.full(n, self.members[-1][0], dtype=np.int64)
        own = (self.points[at] * queries).sum(axis=1)
        for members, links in zip(self.members[:0:-1], self.links[:0:-1]):
            moving = np.arange(n)
            while len(moving):
                near = links[np.searchsorted(members, at[moving])]
                product = self._products(queries[moving], near)
                best = product.argmax(axis=1)
                value = product[np.arange(len(moving)), best]
                better = value > own[moving]
                moving, best = moving[better], near[better, best[better]]
                at[moving], own[moving] = best, value[better]
        links = self.links[0]
        found = np.full((n, width), -1, dtype=np.int64)
        value = np.full((n, width), -np.inf, dtype=np.float32)
        used = np.zeros((n, width), dtype=bool)
        seen = np.zeros((n, len(self.points) + 1), dtype=bool)  # the last column: none
        seen[:, -1] = True
        seen[np.arange(n), at] = True
        found[:, 0], value[:, 0] = at, own
        live = np.arange(n)
        while len(live):
            open_value = np.where(used[live], -np.inf, value[live])
            best = open_value.argmax(axis=1)
            on = open_value[np.arange(len(live)), best] > -np.inf
            live, best = live[on], best[on]
            if not len(live):
                break
            used[live, best] = True
            near = links[found[live, best]].astype(np.int64)
            near[seen[live[:, None], near]] = -1
            seen[live[:, None], near] = True
            product = self._products(queries[live], near)
            all_value = np.concatenate((value[live], product), axis=1)
            keep = np.argpartition(-all_value, width - 1, axis=1)[:, :width]
            value[live] = np.take_along_axis(all_value, keep, axis=1)
            found[live] = np.take_along_axis(np.concatenate((found[live], near), axis=1), keep, axis=1)
            fresh = np.zeros(near.shape, dtype=bool)
            used[live] = np.take_along_axis(np.concatenate((used[live], fresh), axis=1), keep, axis=1)
        order = np.argsort(-value, axis=1, kind="stable")
        found, value = np.take_along_axis(found, order, axis=1), np.take_along_axis(value, order, axis=1)
        return np.where(value > -np.inf, found, -1)

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, k: int, width: int = WIDTH):
        """(query number, id, product in double precision) of the k nearest found, without
        the query's own id; ties go to the smaller id."""
        found = self.search(queries, max(width, 2 * k))[:, : 2 * k + 1]
        row, column = np.nonzero(found >= 0)
        node = found[row, column]
        product = np.empty(len(row))
        for low in range(0, len(row), 1 << 16):
            part = slice(low, low + (1 << 16))
            product[part] = (self.vectors[node[part]] * queries[row[part]]).sum(axis=1)
        size = np.minimum(self.first[node + 1] - self.first[node], k + 1)  # smallest ids first
        place = np.repeat(self.first[node] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        row, product, ids = np.repeat(row, size), np.repeat(product, size), self.ids[place]
        other = ids != query_ids[row]
        row, product, ids = row[other], product[other], ids[other]
        order = np.lexsort((ids, -product, row))
        row, product, ids = row[order], product[order], ids[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        top = rank < k
        return row[top], ids[top], product[top]
