"""Cover trees over vectors of integers, and the search that walks two of them at once.

A node stands for points of which one is its centre; level by level the points of a node are covered by centres that lie over half of its
reach apart, the first being its own.  Nodes keep the true reach of their points, so bounds hold however the tree was built.
Equal points share a leaf.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

#: Components below this are kept as numbers of the machine; vectors with larger ones as Python's, which know no limit.
SMALL = 1 << 26
#: Pairs of points and centroids that are compared at a time.
PAIRS = 50_000


def integers(values: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) of each finite double, exactly."""
    low = np.floor(values * scale)
    if not low.size or np.abs(low).max() < SMALL:
        return low.astype(np.int64)
    return np.array([[int(x) for x in row] for row in low.tolist()], dtype=object).reshape(low.shape)


@dataclass
class Tree:
    points: np.ndarray  # in the order of the leaves
    row: np.ndarray  # which of the given points each of them was
    centre: np.ndarray  # of each node: its centre, the reach of its points, the range of its points, the range of its children
    reach: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray
    last: np.ndarray


def _distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    d = points - centre
    return np.sqrt(np.einsum("ij,ij->i", d, d))


def build(points: np.ndarray, leaf: int) -> Tree:
    """A tree over at least one point; nodes of up to leaf points, or of equal ones, are not divided."""
    real = points.astype(np.float64)
    row = np.arange(len(points))
    nodes: list[tuple[int, float, int, int]] = []  # centre (a given point), reach, range of row
    children: list[tuple[int, int]] = []

    def add(begin: int, end: int, distances: np.ndarray) -> None:
        """The node's points stand in row[begin:end], its centre first."""
        nodes.append((int(row[begin]), float(distances.max()), begin, end))
        children.append((0, 0))

    add(0, len(row), _distances(real, real[0]))
    at = 0
    while at < len(nodes):
        _, reach, begin, end = nodes[at]
        if end - begin > leaf and reach > 0:
            scale = 2.0 ** (math.ceil(math.log2(reach)) - 1)
            own = row[begin:end].copy()
            x = real[own]
            nearest, group = _distances(x, x[0]), np.zeros(len(own), np.int64)
            centres = [0]
            while nearest.max() > scale:  # the point that is covered worst is the next centre
                c = int(nearest.argmax())
                d = _distances(x, x[c])
                closer = d < nearest
                nearest[closer], group[closer] = d[closer], len(centres)
                group[c] = len(centres)
                centres.append(c)
            order = np.lexsort((np.arange(len(own)) != np.array(centres)[group], group))  # a group's centre comes first
            row[begin:end], nearest = own[order], nearest[order]
            sizes = np.bincount(group, minlength=len(centres))
            children[at] = (len(nodes), len(nodes) + len(centres))
            start = 0
            for size in sizes.tolist():
                add(begin + start, begin + start + size, nearest[start : start + size])
                start += size
        at += 1
    place = np.empty(len(row), np.int64)
    place[row] = np.arange(len(row))
    centre, reach, begin, end = (np.array(c) for c in zip(*nodes))
    first, last = (np.array(c) for c in zip(*children))
    return Tree(points[row], row, place[centre], reach, begin, end, first, last)


def _grown(at: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each range first[i]:last[i] its members, and at which i each stands."""
    n = last - first
    i = np.repeat(np.arange(len(at)), n)
    return i, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)


def nearest(tree: Tree, centroids: Tree) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) of each given point; of equally near centroids the smallest number.

    A pair of nodes is dropped where all its centroids are farther from all its points than some centroid is that was met before.
    What is left between leaves is compared exactly.
    """
    n, exact = len(tree.points), tree.points.dtype != object and centroids.points.dtype != object
    kind = np.int64 if exact else object
    far = np.iinfo(np.int64).max if exact else float("inf")
    best, number = np.full(n, far, dtype=kind), np.full(n, len(centroids.points), np.int64)
    real, middle = tree.points.astype(np.float64), centroids.points.astype(np.float64)
    slack = 1e-6 + 1e-9 * max(np.sqrt((real * real).sum(1)).max(), np.sqrt((middle * middle).sum(1)).max())
    bound = np.full(len(tree.centre), np.inf)
    v, c = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(v):
        d = np.empty(len(v))
        for at in range(0, len(v), PAIRS):
            s = slice(at, at + PAIRS)
            d[s] = _distances(real[tree.centre[v[s]]], middle[centroids.centre[c[s]]])
        reach = tree.reach[v] + centroids.reach[c]
        # the centre of a node of centroids is one of them
        np.minimum.at(bound, v, d + tree.reach[v])
        keep = d - reach <= bound[v] + slack
        v, c = v[keep], c[keep]
        whole, single = tree.last[v] == tree.first[v], centroids.last[c] == centroids.first[c]
        _compare(tree, centroids, v[whole & single], c[whole & single], best, number)
        # the wider side is divided
        by_centroid = ~single & (whole | (centroids.reach[c] >= tree.reach[v]))
        by_vector = ~whole & ~by_centroid
        i, below = _grown(v[by_vector], tree.first[v[by_vector]], tree.last[v[by_vector]])
        above = v[by_vector][i]
        np.minimum.at(bound, below, bound[above])
        j, within = _grown(c[by_centroid], centroids.first[c[by_centroid]], centroids.last[c[by_centroid]])
        v, c = np.concatenate([below, v[by_centroid][j]]), np.concatenate([c[by_vector][i], within])
    out, squared = np.empty(n, np.int64), np.empty(n, dtype=kind)
    out[tree.row], squared[tree.row] = number, best
    return out, squared


def _compare(tree: Tree, centroids: Tree, v: np.ndarray, c: np.ndarray, best: np.ndarray, number: np.ndarray) -> None:
    """Exact distances between the points of pairs of leaves."""
    if not len(v):
        return
    i, point = _grown(v, tree.begin[v], tree.end[v])
    c = c[i]
    j, centroid = _grown(c, centroids.begin[c], centroids.end[c])
    point = point[j]
    for at in range(0, len(point), PAIRS):
        p, q = point[at : at + PAIRS], centroid[at : at + PAIRS]
        diff = tree.points[p] - centroids.points[q]
        d, name = (diff * diff).sum(axis=1), centroids.row[q]
        order = np.lexsort((name, d, p)) if d.dtype != object else np.array(sorted(range(len(p)), key=lambda k: (p[k], d[k], name[k])))
        p, d, name = p[order], d[order], name[order]
        head = np.r_[True, p[1:] != p[:-1]]
        p, d, name = p[head], d[head], name[head]
        better = (d < best[p]) | ((d == best[p]) & (name < number[p]))
        best[p[better]], number[p[better]] = d[better], name[better]
