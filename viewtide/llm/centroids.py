"""Centroid clustering: k-means whose assignment searches a vantage-point tree of the centroids.

Vectors are integers, floor(64 * x). Each round the driver builds a vantage-point tree over the centroids
(their number is a parameter) and broadcasts it. A vector searches it best-first: of its open nodes
the one with the smallest lower bound is opened next, the distance to the node's vantage point gives the
children's bounds, and a node whose bound exceeds the best distance so far is pruned; the pruning radius is
inclusive, since an equally near centroid may have a smaller number. The vectors of a batch walk together, each with its
own open nodes, so numpy opens one node of every vector at a time. Bounds are floats with a margin; distances are exact
integers, and ties go to the smaller number. Componentwise sums are exact: each task sends one row per centroid and
limb, and Spark adds them as decimals.

Defined cases: vectors that are null, of another number of components, or with a null or non-finite component are left
out; a null vec_id is hashed as the empty text; among repeated ids the smaller vector starts first; with fewer than k vectors all
are centroids, and without any there is no row; repeated rows count each time; vectors with components beyond 2^27 are computed in
Python integers, and distances or sums that no long holds are null; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship, written

DIM = 64
CLUSTERS = 16
ROUNDS = 3
SCALE = 64.0
LEAF = 3  # centroids in a leaf, at most
WIDE = 1 << 27  # components up to here keep squared distances in 64 bits
LIMB = 60  # bits of a limb of a sum
CELLS = 1 << 20  # open nodes kept at a time: vectors of a chunk times nodes
ASSIGNED = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("cluster", T.IntegerType()),
                         T.StructField("distance", T.LongType())])
SUMS = "cluster int, limb int, n long, " + ", ".join(f"s{j} long" for j in range(DIM))


def scaled(values: np.ndarray) -> np.ndarray:
    """floor(64 * x) as 64-bit integers, or as Python integers if one is large."""
    big = np.abs(values) >= WIDE / SCALE
    if not big.any():
        return np.floor(values * SCALE).astype(np.int64)
    exact = [int(x) * int(SCALE) if abs(x) >= 2.0 ** 53 else math.floor(x * SCALE) for x in values.ravel().tolist()]
    return np.array(exact, object).reshape(values.shape)


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = x - c
    return (d * d).sum(axis=-1)


def _root(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


@dataclass
class Tree:
    """Nodes of a vantage-point tree; node 0 is the root. An inner node has a vantage point and two children with the
    least and greatest distance of their members from it, a leaf has members only."""
    centroids: np.ndarray
    vantage: list[int]
    members: list[list[int]]
    children: list[tuple[int, int]]
    near: list[tuple[float, float]]
    far: list[tuple[float, float]]


def build_tree(centroids: list[list[int]]) -> Tree:
    wide = any(abs(v) > WIDE for row in centroids for v in row)
    c = np.array(centroids, object if wide else np.int64).reshape(len(centroids), DIM)
    tree = Tree(c, [], [], [], [], [])

    def node(ids: list[int]) -> int:
        me = len(tree.vantage)
        for column, empty in zip((tree.vantage, tree.members, tree.children, tree.near, tree.far), (-1, ids, (-1, -1), (0.0, 0.0), (0.0, 0.0))):
            column.append(empty)
        if len(ids) <= LEAF:
            return me
        # the member farthest from the first one: an end of the set spreads the others' distances
        top = ids[int(np.argmax(_root(_squared(c[ids], c[ids[0]]))))]
        rest = [i for i in ids if i != top]
        d = _root(_squared(c[rest], c[top]))
        order = np.argsort(d, kind="stable")
        half = len(rest) // 2
        sides = [[rest[i] for i in order[:half]], [rest[i] for i in order[half:]]]
        reach = [(float(d[order[:half]].min()), float(d[order[:half]].max())), (float(d[order[half:]].min()), float(d[order[half:]].max()))]
        tree.vantage[me], tree.members[me] = top, []
        tree.near[me], tree.far[me] = reach
        tree.children[me] = (node(sides[0]), node(sides[1]))
        return me

    if centroids:
        node(list(range(len(centroids))))
    return tree


def search(tree: Tree, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest centroid of each row of ``x``."""
    step = max(1, CELLS // len(tree.vantage))
    parts = [_search(tree, x[i:i + step]) for i in range(0, len(x), step)]
    return tuple(np.concatenate(p) for p in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _search(tree: Tree, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(x)
    kind = object if object in (x.dtype, tree.centroids.dtype) else np.int64
    best, who = np.full(n, None if kind is object else np.iinfo(np.int64).max, kind), np.full(n, -1)
    reach = np.full(n, np.inf)  # the pruning radius
    bound = np.full((n, len(tree.vantage)), np.inf)  # of the open nodes
    bound[:, 0] = 0.0

    def meet(rows: np.ndarray, centroid: int) -> np.ndarray:
        d = _squared(x[rows], tree.centroids[centroid])
        if kind is object:
            better = np.array([who[r] < 0 or (v, centroid) < (best[r], who[r]) for r, v in zip(rows, d)], bool)
        else:
            better = (d < best[rows]) | ((d == best[rows]) & (centroid < who[rows]))
        best[rows[better]], who[rows[better]] = d[better], centroid
        root = _root(d)
        reach[rows[better]] = root[better] * (1 + 1e-9) + 1e-6
        return root

    live = np.arange(n)
    while len(live):
        first = bound[live].argmin(axis=1)
        least = bound[live, first]
        open_ = least <= reach[live]  # inclusive; an infinite bound means that no node is open
        open_ &= np.isfinite(least)
        live, first = live[open_], first[open_]
        for node in np.unique(first):
            rows = live[first == node]
            above = bound[rows, node]
            bound[rows, node] = np.inf
            if tree.vantage[node] < 0:
                for c in tree.members[node]:
                    meet(rows, c)
                continue
            d = meet(rows, tree.vantage[node])
            for child, (low, high) in zip(tree.children[node], (tree.near[node], tree.far[node])):
                gap = np.maximum(d - high, low - d) - 1e-9 * (d + high) - 1e-6
                bound[rows, child] = np.maximum(above, np.maximum(gap, 0.0))
    return who, best


def finite_vectors(vectors: DataFrame, dim: int = DIM) -> DataFrame:
    """vec_id and embedding (doubles) of the rows with exactly ``dim`` finite components."""
    e = F.col("embedding").cast("array<double>")
    ok = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding"))
    return rows.where(F.col("embedding").isNotNull() & (F.size("embedding") == dim)).where(F.coalesce(ok, F.lit(False)))


def _matrix(batch) -> np.ndarray:
    return scaled(batch.column("embedding").flatten().to_numpy().reshape(batch.num_rows, DIM))


def start_centroids(kept: DataFrame, k: int) -> list[list[int]]:
    """The ``k`` vectors with the smallest hashes (rows, so a bounded report)."""
    key = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = kept.select(key.alias("key"), "embedding").orderBy("key", "embedding").limit(k).collect()
    return [[int(v) for v in scaled(np.array([r.embedding], np.float64))[0]] for r in first]


def _limbs(value: int) -> list[int]:
    """Signed digits of LIMB bits, lowest first."""
    sign, value, out = (-1 if value < 0 else 1), abs(value), []
    while value:
        out.append(sign * (value & ((1 << LIMB) - 1)))
        value >>= LIMB
    return out


def _sum_rows(tree):
    def add(batches):
        sums, count = {}, {}
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b)
            who = search(tree.value, x)[0]
            for c in np.unique(who).tolist():
                own = x[who == c]
                count[c] = count.get(c, 0) + len(own)
                total = [int(v) for v in own.sum(axis=0)]
                sums[c] = [a + v for a, v in zip(sums[c], total)] if c in sums else total
        out = []
        for c, total in sums.items():
            digits = [_limbs(v) for v in total]
            for limb in range(max(1, max(map(len, digits)))):
                out.append((c, limb, 0 if limb else count[c], *(d[limb] if limb < len(d) else 0 for d in digits)))
        columns = list(zip(*out)) if out else [[] for _ in range(DIM + 3)]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), *(pa.array(v, pa.int64()) for v in columns[2:])],
                                         names=["cluster", "limb", "n", *(f"s{j}" for j in range(DIM))])
    return add


def next_centroids(spark: SparkSession, kept: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Centroids after one round; the driver gets one row per centroid and limb."""
    tree = spark.sparkContext.broadcast(build_tree(centroids))
    rows = kept.select("embedding").mapInArrow(_sum_rows(tree), SUMS)
    sums = rows.groupBy("cluster", "limb").agg(
        F.sum("n").alias("n"), *[F.sum(F.col(f"s{j}").cast("decimal(20, 0)")).alias(f"s{j}") for j in range(DIM)]).collect()
    out = [list(c) for c in centroids]
    for c in range(len(centroids)):
        own = [r for r in sums if r.cluster == c]
        n = sum(r.n for r in own)
        if n:
            out[c] = [sum(int(r[f"s{j}"]) << (LIMB * r.limb) for r in own) // n for j in range(DIM)]
    tree.unpersist()
    return out


def _assign(tree):
    def assign(batches):
        for b in batches:
            who, d = search(tree.value, _matrix(b)) if b.num_rows else (np.zeros(0, np.int64),) * 2
            fits = [int(v) if v < 1 << 63 else None for v in d] if d.dtype == object else d
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(who, pa.int32()), pa.array(fits, pa.int64())], names=ASSIGNED.names)
    return assign


def cluster(spark: SparkSession, vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS) -> DataFrame:
    """Per vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    ship(spark)
    kept = finite_vectors(vectors)
    centroids = start_centroids(kept, k)
    for _ in range(rounds):
        centroids = next_centroids(spark, kept, centroids)
    tree = spark.sparkContext.broadcast(build_tree(centroids))
    assigned = written(spark, kept.mapInArrow(_assign(tree), ASSIGNED), "clusters")
    # one row per centroid
    total = F.sum(F.col("distance").cast("decimal(20, 0)"))
    unfit = F.max(F.col("distance").isNull().cast("int"))
    per = assigned.groupBy("cluster").agg(total.alias("t"), unfit.alias("u")).collect()
    fits = lambda v, u: int(v) if not u and v < 1 << 63 else None
    inertia = fits(sum(int(r.t or 0) for r in per), any(r.u for r in per))
    table = [(r.cluster, fits(r.t, r.u), inertia, hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()) for r in per]
    facts = spark.createDataFrame(table, "c int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), assigned.cluster == facts.c).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
