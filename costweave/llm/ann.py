"""Approximate nearest neighbours by inner product: hierarchical k-means tree.

The tree is learnt on a bounded sample (``SAMPLE`` vectors), ``BRANCH``
children a node, deep enough for leaves of about ``LEAF`` vectors; every
vector goes down to the leaf of its nearest centres.  A query meets
branches best bin first: a priority queue ordered by the inner product with
the centres gives the order in which it visits leaves.

How many leaves to visit is calibrated: a bounded set of sample queries is
compared with *all* vectors, block by block, and the visits are widened until the
leaves visited hold ``RECALL`` of their true neighbours.  A query whose leaves
hold too few vectors for its neighbours goes on to the next ones.  Spark joins queries and
vectors on the leaves; blocks of both keep a group bounded, whatever a leaf
or the number of queries grows to.  Scores are exact products in double precision.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null id, take no part; vectors of different
dimension do not compare with the most common dimension's and take no part
either; rows that repeat an id with the same vector are one vector; ties go
to the smaller id; a query with fewer candidates gets all of them.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage
from .vectors import blocks, from_bytes, kmeans, matrix, nearest, sample, usable

NEIGHBOURS = 20
SAMPLE = 16384
BRANCH = 8
LEAF = 1024
DEEPEST = 4                                  # at most BRANCH**4 leaves, so the tree is small
RECALL = 0.96
CALIBRATION = 256                            # sample queries


class Tree:
    """Centres level by level; node ``i`` of a level has children ``i*BRANCH..``."""

    def __init__(self, vectors: np.ndarray, depth: int):
        self.centres, self.there = [], []
        groups = [vectors]
        for _ in range(depth):
            level = np.zeros((len(groups) * BRANCH, vectors.shape[1]))
            there = np.zeros(len(level), bool)
            below = []
            for g, x in enumerate(groups):
                centres = kmeans(x, BRANCH) if len(x) else x[:0]
                level[g * BRANCH:g * BRANCH + len(centres)] = centres
                there[g * BRANCH:g * BRANCH + len(centres)] = True
                near = nearest(x, centres) if len(x) else np.zeros(0, int)
                below += [x[near == k] for k in range(BRANCH)]
            # a child that no sample vector reached isn't there
            there &= np.array([len(x) > 0 for x in below])
            self.centres.append(level)
            self.there.append(there)
            groups = below

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        for centres, there in zip(self.centres, self.there):
            child = centres.reshape(-1, BRANCH, centres.shape[1])[node]
            d2 = ((x[:, None, :] - child) ** 2).sum(2)
            d2[~there.reshape(-1, BRANCH)[node]] = np.inf
            node = node * BRANCH + d2.argmin(1)
        return node

    def visits(self, q: np.ndarray, most: int, held: dict[int, int] | None = None, least: int = 0) -> list[int]:
        """The first ``most`` leaves of a query, best bin first, and further ones until
        the leaves hold ``least`` vectors (``held``: vectors by leaf)."""
        score = [c @ q for c in self.centres]
        depth, out, have = len(self.centres), [], 0
        queue = [(-score[0][k], 0, k) for k in range(BRANCH) if self.there[0][k]]
        heapq.heapify(queue)
        while queue and (len(out) < most or have < least):
            _, level, node = heapq.heappop(queue)
            if level == depth - 1:
                out.append(node)
                have += held.get(node, 0) if held else least
                continue
            for k in range(node * BRANCH, (node + 1) * BRANCH):
                if self.there[level + 1][k]:
                    heapq.heappush(queue, (-score[level + 1][k], level + 1, k))
        return out


def _best(x, xi, y, yi, k: int):
    """For each query its ``k`` best of the block (not itself): rows, columns."""
    order = np.argsort(yi, kind="stable")               # equal scores: smaller id first
    y, yi = y[order], yi[order]
    rows, cols = [], []
    for at in range(0, len(x), 256):
        s = np.round(x[at:at + 256] @ y.T, 12)
        s[xi[at:at + 256, None] == yi[None, :]] = -np.inf
        top = np.argsort(-s, axis=1, kind="stable")[:, :k]
        real = np.take_along_axis(s, top, 1) > -np.inf
        r, c = np.nonzero(real)
        rows.append(r + at)
        cols.append(order[top[r, c]])
    return np.concatenate(rows), np.concatenate(cols)


def _calibrate(tree: Tree, placed: DataFrame, k: int) -> int:
    """Leaves to visit so that sample queries find RECALL of their true neighbours."""
    rows = placed.select(F.xxhash64("vec_id").alias("h"), "vec_id", "x").orderBy("h").limit(CALIBRATION).collect()
    qi, q = np.array([r[1] for r in rows], np.int64), from_bytes([bytes(r[2]) for r in rows])

    def partial(batches):
        for b in batches:
            y, yi, leaf = from_bytes(b.column(1).to_pylist()), b.column(0).to_numpy(), b.column(2).to_numpy()
            if len(yi):
                r, c = _best(q, qi, y, yi, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qi[r]), pa.array(yi[c]), pa.array(leaf[c]), pa.array(np.einsum("ij,ij->i", q[r], y[c]))],
                    names=["q", "y", "leaf", "score"])

    near = placed.select("vec_id", "x", "leaf").mapInArrow(partial, "q long, y long, leaf long, score double")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "y"))
    true = near.withColumn("r", rank).filter(F.col("r") <= k).select("q", "leaf").collect()     # CALIBRATION * k rows
    leaves = sum(tree.there[-1])
    place = {int(i): {leaf: n for n, leaf in enumerate(tree.visits(v, leaves), 1)} for i, v in zip(qi, q)}
    needed = np.sort([place[r[0]][r[1]] for r in true])
    return int(needed[min(len(needed), math.ceil(RECALL * len(needed))) - 1]) if len(needed) else leaves


def search(vectors: DataFrame, is_query, k: int = NEIGHBOURS, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows that ``is_query`` (a condition on
    the column ``vec_id``) selects, against all rows but their own."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                          F.col(f"`{vector_col}`").cast("array<float>").alias("v"))
    valid = rows.filter(F.col("vec_id").isNotNull() & usable("v")).distinct()
    dims = valid.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if dims is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, n = dims
    valid = valid.filter(F.size("v") == dim)
    depth = min(DEEPEST, max(1, math.ceil(math.log(max(2, n / LEAF), BRANCH))))
    tree = Tree(sample(valid, "vec_id", "v", SAMPLE, dim), depth)

    def place(batches):
        for b in batches:
            x = matrix(b.column(1), dim)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([r.tobytes() for r in x.astype(np.float32)], pa.binary()),
                 pa.array(tree.leaf_of(x), pa.int64())], names=["vec_id", "x", "leaf"])

    placed = cut_lineage(valid.repartition("vec_id").mapInArrow(place, "vec_id long, x binary, leaf long"))
    most = _calibrate(tree, placed, k)
    held = {r[0]: r[1] for r in placed.groupBy("leaf").count().collect()}         # at most BRANCH**DEEPEST rows

    def route(batches):
        for b in batches:
            x = from_bytes(b.column(1).to_pylist()) if b.num_rows else np.zeros((0, dim))
            leaves = [tree.visits(q, most, held, k + 1) for q in x]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(leaves, pa.list_(pa.int64()))],
                                             names=["q", "x", "leaves"])

    queries = placed.filter(is_query).select("vec_id", "x").mapInArrow(route, "q long, x binary, leaves array<long>")
    queries = cut_lineage(queries).select("q", "x", F.explode("leaves").alias("leaf"))
    q, y = blocks(queries, placed.withColumnRenamed("vec_id", "y"), ["leaf"], "q", "y")

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "float64"})
        xi, yi = left["q"].to_numpy(np.int64), right["y"].to_numpy(np.int64)
        x, v = from_bytes(left["x"].tolist()), from_bytes(right["x"].tolist())
        r, c = _best(x, xi, v, yi, k)
        return pd.DataFrame({"query_id": xi[r], "vec_id": yi[c], "score": np.einsum("ij,ij->i", x[r], v[c])})

    near = q.cogroup(y).applyInPandas(compare, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
