"""Lloyd's clustering of whole vectors with two trees.

Vectors become integers, so every step is exact and no order of sums changes the result.  Blocks of vectors get a cover tree each, built once and saved;
in each round a tree over the centroids is sent to the tasks, both are walked together, and pairs of nodes are dropped by bounds on their distances
(`cover_tree`).  A task returns sums for each centroid, so what is shuffled depends on tasks and centroids alone.

Vectors of another length, with nulls or without a finite value are left out; other columns are not read.  Repeated rows and ids are vectors of their own; equally near
centroids are decided by their number.  An empty table gives no rows; fewer vectors than centroids give as many centroids.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import cover_tree
from .common import Workspace

DIMENSIONS, SCALE, CENTROIDS, ROUNDS = 64, 64.0, 16, 3
#: Vectors of one tree, and of one of its leaves.
BLOCK, LEAF = 2048, 16
#: Sums are kept in parts of so many bits, so that they are exact at any size.
LIMB = 40
LARGEST = (1 << 63) - 1


def whole_vectors(table: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """(vec_id, x: array<double>) of the rows whose vector has all its components, each finite."""
    x = F.col("embedding").cast("array<double>")
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    return table.select("vec_id", x.alias("x")).filter((F.size("x") == dimensions) & F.forall("x", finite))


def seeds(vectors: DataFrame, k: int = CENTROIDS) -> list[list[float]]:
    """The k vectors with the smallest sha256 of `1:<vec_id>`, of equal ids the smallest vector."""
    hashed = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [r.x for r in vectors.select(hashed.alias("h"), "x").orderBy("h", "x").limit(k).collect()]


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dimensions)


def forest(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: float = SCALE) -> DataFrame:
    """(ids: array, tree: binary): a cover tree for each block of up to BLOCK vectors."""
    kind = vectors.schema["vec_id"].dataType
    ids_type = pa.list_(to_arrow_type(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            x = cover_tree.integers(_matrix(rows.column(1).combine_chunks(), dimensions), scale)
            tree = cover_tree.build(x, LEAF)
            if tree.points.dtype != object:
                tree.points = tree.points.astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array([rows.column(0).to_pylist()], ids_type), pa.array([pickle.dumps(tree)], pa.binary())], ["ids", "tree"])

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= BLOCK:
                rows = pa.Table.from_batches(held)
                yield block(rows.slice(0, BLOCK))
                held = rows.slice(BLOCK).to_batches()
        if sum(b.num_rows for b in held):
            yield block(pa.Table.from_batches(held))

    return vectors.select("vec_id", "x").mapInArrow(run, f"ids array<{kind.simpleString()}>, tree binary")


def _trees(column: pa.Array) -> Iterator[cover_tree.Tree]:
    for raw in column:
        tree = pickle.loads(raw.as_py())
        if tree.points.dtype != object:
            tree.points = tree.points.astype(np.int64)
        yield tree


def _centroid_tree(centroids: list[list[int]]) -> cover_tree.Tree | None:
    if not centroids:  # then there is no vector either
        return None
    small = all(abs(x) < cover_tree.SMALL for c in centroids for x in c)
    return cover_tree.build(np.array(centroids, dtype=np.int64 if small else object), 1)


def _sums(trees: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(cluster, dimension, limb, part, n): sums of the vectors by their nearest centroid, in parts."""
    sent = trees.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle = _centroid_tree(sent.value)
        totals: dict[int, np.ndarray] = {}
        counts: dict[int, int] = {}
        for batch in batches:
            for tree in _trees(batch.column(1)):
                number, _ = cover_tree.nearest(tree, middle)
                of = number[tree.row]
                order = np.argsort(of, kind="stable")
                used, start = np.unique(of[order], return_index=True)
                sums = np.add.reduceat(tree.points[order], start, axis=0)
                for c, row, n in zip(used.tolist(), sums.astype(object), np.diff(np.r_[start, len(of)]).tolist()):
                    totals[c] = totals[c] + row if c in totals else row
                    counts[c] = counts.get(c, 0) + n
        rows = []
        for c, total in totals.items():
            for dimension, x in enumerate(total.tolist()):
                sign, size, limb = (-1 if x < 0 else 1), abs(x), 0
                while size or not limb:
                    rows.append((c, dimension, limb, sign * (size & ((1 << LIMB) - 1)), counts[c] if not limb else 0))
                    size, limb = size >> LIMB, limb + 1
        columns = list(zip(*rows)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, [pa.int32()] * 3 + [pa.int64()] * 2)], ["cluster", "dimension", "limb", "part", "n"])

    return trees.mapInArrow(run, "cluster int, dimension int, limb int, part long, n long")


def _moved(trees: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The next round's centroids: floor of the exact mean, or as before where there is no vector.  One row for each centroid, dimension and limb is collected."""
    total = _sums(trees, centroids).groupBy("cluster", "dimension", "limb").agg(F.sum("part").alias("part"), F.sum("n").alias("n"))
    sums: dict[tuple[int, int], int] = {}
    counts: dict[int, int] = {}
    for r in total.collect():
        sums[r.cluster, r.dimension] = sums.get((r.cluster, r.dimension), 0) + (r.part << LIMB * r.limb)
        if r.dimension == 0:
            counts[r.cluster] = counts.get(r.cluster, 0) + r.n
    return [[sums[i, d] // counts[i] for d in range(len(c))] if i in counts else c for i, c in enumerate(centroids)]


def _assigned(trees: DataFrame, centroids: list[list[int]]) -> DataFrame:
    kind = trees.schema["ids"].dataType.elementType
    sent = trees.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle = _centroid_tree(sent.value)
        for batch in batches:
            for ids, tree in zip(batch.column(0), _trees(batch.column(1))):
                number, squared = cover_tree.nearest(tree, middle)
                capped = pa.array([min(x, LARGEST) for x in squared.tolist()], pa.int64())
                yield pa.RecordBatch.from_arrays([ids.values, pa.array(number, pa.int32()), capped], ["vec_id", "cluster", "distance"])

    return trees.mapInArrow(run, f"vec_id {kind.simpleString()}, cluster int, distance long")


def cluster(table: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: float = SCALE) -> tuple[DataFrame, list[list[int]]]:
    """((vec_id, cluster, distance), the final centroids).  Squared distances over 2**63 - 1 are given as that."""
    work = Workspace(table.sparkSession, "clustering")
    vectors = whole_vectors(table, dimensions)
    start = seeds(vectors, k)
    centroids = cover_tree.integers(np.array(start, dtype=np.float64).reshape(-1, dimensions), scale).tolist()
    trees = work.save(forest(vectors, dimensions, scale), "trees")
    for _ in range(rounds if centroids else 0):
        centroids = _moved(trees, centroids)
    assigned = work.save(_assigned(trees, centroids), "assigned")
    work.only("assigned")
    return assigned, centroids


def clusters(table: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: float = SCALE) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each whole vector.  One row for each centroid is collected."""
    assigned, centroids = cluster(table, k, rounds, dimensions, scale)
    sums = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    total = min(sum(sums.values()), LARGEST)
    rows = [(c, min(s, LARGEST), total, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, s in sums.items()]
    told = assigned.sparkSession.createDataFrame(rows, "of int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(told), F.col("cluster") == F.col("of")).drop("of")
