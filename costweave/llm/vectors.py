"""What the two vector operators share: valid vectors, k-means on a bounded
sample, and joins of query blocks with vector blocks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix

BLOCK = 2048                                 # vectors of a list that meet in one group
QUERIES = 4096                               # queries that meet them


def usable(column: str):
    """Neither null nor empty nor zero, all components there and finite."""
    c = F.col(column)
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(c.isNotNull() & (F.size(c) > 0) & finite & F.exists(c, lambda x: x != 0), F.lit(False))


def matrix(column, width: int) -> np.ndarray:
    """A list column as rows of doubles, short ones filled with zeros."""
    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lens = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(lens), width))
    if len(lens):
        out[np.repeat(np.arange(len(lens)), lens), np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)] = flat
    return out


def from_bytes(blobs) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.float32).reshape(len(blobs), -1).astype(np.float64)


def sample(frame: DataFrame, key: str, column: str, most: int, width: int) -> np.ndarray:
    """Up to ``most`` vectors, chosen by a hash of their id."""
    rows = frame.select(F.xxhash64(key).alias("h"), F.col(column).alias("v")).orderBy("h").limit(most).collect()
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, :len(r[1])] = r[1]
    return out


def kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """At most ``k`` centres; begins with rows spread over the data by a fixed order."""
    k = min(k, len(x))
    order = np.argsort(mix(np.arange(1, len(x) + 1, dtype=np.uint64)), kind="stable")
    centres = x[order[:k]].copy()
    for _ in range(rounds):
        near = nearest(x, centres)
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        count = np.bincount(near, minlength=k)
        centres[count > 0] = total[count > 0] / count[count > 0, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres ** 2).sum(1)[None, :] - 2 * x @ centres.T).argmin(1)


def blocks(queries: DataFrame, vectors: DataFrame, keys: list[str], query_id: str, vector_id: str):
    """Both sides with block numbers, so that a group (keys, y_block, q_block)
    holds about BLOCK vectors and QUERIES queries however large a key is: each
    query goes to all vector blocks of its key, each vector to all query blocks."""
    size = (vectors.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("y_n"))
            .join(queries.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("q_n")), keys))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    part = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    q = queries.join(size, keys).withColumn("q_block", part(query_id, "q_n")).withColumn("y_block", each("y_n"))
    y = vectors.join(size, keys).withColumn("y_block", part(vector_id, "y_n")).withColumn("q_block", each("q_n"))
    group = [*keys, "y_block", "q_block"]
    return q.drop("q_n", "y_n").groupBy(*group), y.drop("q_n", "y_n").groupBy(*group)
