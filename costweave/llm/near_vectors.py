"""Embedding near-dedup with product quantisation.

Codebooks are learnt on a bounded sample (``SAMPLE`` vectors): coarse
centroids, and for each of ``PARTS`` subspaces ``CODES`` codewords of the residuals.
Every vector lies in the inverted list of its centroid, with its residual
codes and the exact length of what the codes miss.

Probes are sufficient: a unit vector within ``delta`` of ``x`` (the distance
that the cosine threshold allows) can lie in another list only if ``x`` is
no further than ``delta`` from the plane between the two centroids; all such
lists are probed.  Distances to a list come from lookup tables (the query's
residual against every codeword); by the triangle inequality a pair whose table distance
exceeds ``delta`` plus the missed length cannot link.  The rest is
reranked by the exact cosine in double precision, so no link is lost and
none is below the threshold.

Equal vectors of a label are one class that is compared once.  A group
holds a bounded block of a list and a bounded block of queries; it emits
link *counts* and a spanning forest of its links, never the pairs.

Defined cases: only vectors with equal, non-null labels and equal dimension
compare; vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null id, link with nothing; rows that repeat an
id with the same label and vector count as one vector.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage
from .graph import components
from .vectors import blocks, from_bytes, kmeans, matrix, nearest, sample, usable

COSINE = 0.93
SAMPLE = 8192
LISTS_MOST = 1024
PARTS = 8
CODES = 256
_SLACK = 1e-4                                # for rounding in the lossless bounds
_PAIRS = 1 << 15


def learn(vectors: np.ndarray, lists: int):
    """Coarse centroids and the residual codewords of each subspace."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    coarse = kmeans(unit, lists)
    residual = unit - coarse[nearest(unit, coarse)]
    step = residual.shape[1] // PARTS
    return coarse, [kmeans(residual[:, m * step:(m + 1) * step], CODES, 6) for m in range(PARTS)]


def _encode(unit: np.ndarray, coarse, books):
    own = nearest(unit, coarse)
    residual = unit - coarse[own]
    step = residual.shape[1] // PARTS
    codes = np.stack([nearest(residual[:, m * step:(m + 1) * step], b) for m, b in enumerate(books)], 1)
    rebuilt = np.concatenate([b[codes[:, m]] for m, b in enumerate(books)], 1)
    return own, codes.astype(np.uint8), np.linalg.norm(residual - rebuilt, axis=1)


def _probes(unit: np.ndarray, own: np.ndarray, coarse: np.ndarray, delta: float) -> np.ndarray:
    """Mask (vector, list) of the lists that may hold something within delta."""
    d2 = ((unit[:, None, :] - coarse[None]) ** 2).sum(2) if len(coarse) * unit.size < 1 << 22 else \
        (unit ** 2).sum(1)[:, None] - 2 * unit @ coarse.T + (coarse ** 2).sum(1)[None]
    gap = np.sqrt(((coarse[:, None] - coarse[None]) ** 2).sum(2))[own]
    margin = d2 - d2[np.arange(len(unit)), own][:, None]
    return (margin <= 2 * gap * delta + _SLACK) | (gap == 0)


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Component of each of ``n`` vertices under links i-j."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _links_of(x, y, x_id, y_id, table_codes, missed, coarse_of, books, delta):
    """Index pairs (query, vector) with cosine >= COSINE."""
    xn, yn = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    residual = x / xn[:, None] - coarse_of
    step = residual.shape[1] // PARTS
    found_i, found_j = [], []
    for at in range(0, len(x), 512):
        d2 = np.zeros((len(x[at:at + 512]), len(y)), np.float32)
        for m, book in enumerate(books):
            r = residual[at:at + 512, m * step:(m + 1) * step]
            table = ((r ** 2).sum(1)[:, None] - 2 * r @ book.T + (book ** 2).sum(1)[None]).astype(np.float32)
            d2 += table[:, table_codes[:, m]]
        i, j = np.nonzero(np.sqrt(np.maximum(d2, 0)) <= (delta + missed + _SLACK)[None, :])
        i += at
        other = x_id[i] != y_id[j]
        i, j = i[other], j[other]
        for k in range(0, len(i), _PAIRS):
            a, b = i[k:k + _PAIRS], j[k:k + _PAIRS]
            near = np.einsum("ij,ij->i", x[a], y[b]) / (xn[a] * yn[b]) >= COSINE
            found_i.append(a[near])
            found_j.append(b[near])
    none = [np.zeros(0, np.int64)]
    return np.concatenate(found_i or none), np.concatenate(found_j or none)


def near_links(frame: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
               label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows = frame.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                        F.col(f"`{vector_col}`").cast("array<float>").alias("v"), F.col(f"`{label_col}`").alias("label"))
    valid = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("v")).distinct()
    # equal vectors of a label are one class
    same = cut_lineage(valid.groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("size")))
    n, dim = same.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    width = -(-dim // PARTS) * PARTS
    delta = math.sqrt(2 - 2 * COSINE)
    members = valid.join(same, ["label", "v"])
    if n:
        lists = max(1, min(LISTS_MOST, math.ceil(math.sqrt(n) / 8)))
        coarse, books = learn(sample(same, "rep", "v", SAMPLE, width), lists)

        def encode(batches):
            for b in batches:
                x = matrix(b.column(3), width)
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                own, codes, missed = _encode(unit, coarse, books)
                probe = _probes(unit, own, coarse, delta)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), b.column(2), b.column(4), pa.array(own, pa.int32()),
                     pa.array([r.tobytes() for r in x.astype(np.float32)], pa.binary()),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(missed, pa.float64()),
                     pa.array([np.flatnonzero(p).astype(np.int32) for p in probe], pa.list_(pa.int32()))],
                    names=["rep", "size", "dim", "label", "own", "x", "codes", "missed", "probes"])

        label_type = same.schema["label"].dataType.simpleString()
        encoded = cut_lineage(
            same.select("rep", "size", F.size("v").alias("dim"), "v", "label").repartition("rep").mapInArrow(
                encode, f"rep long, size long, dim int, label {label_type}, own int, x binary, codes binary, "
                        "missed double, probes array<int>"))
        # new names for all columns: both sides of the comparison come from one table
        vectors = encoded.select(*[F.col(a).alias(b) for a, b in (
            ("label", "label"), ("dim", "dim"), ("own", "list"), ("rep", "y"), ("size", "size"), ("x", "x"),
            ("codes", "codes"), ("missed", "missed"))])
        queries = encoded.select("label", "dim", F.explode("probes").alias("list"), F.col("rep").alias("q"), "x")
        q, y = blocks(queries, vectors, ["label", "dim", "list"], "q", "y")

        def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            out = {"a": [], "b": [], "n": []}
            if len(left) and len(right):
                xi, yi = left["q"].to_numpy(np.int64), right["y"].to_numpy(np.int64)
                codes = np.frombuffer(b"".join(right["codes"]), np.uint8).reshape(len(right), PARTS)
                i, j = _links_of(from_bytes(left["x"].tolist()), from_bytes(right["x"].tolist()), xi, yi, codes,
                                 right["missed"].to_numpy(np.float64), coarse[int(right["list"].iloc[0])], books, delta)
                if len(i):
                    count = np.bincount(i, weights=right["size"].to_numpy(np.float64)[j], minlength=len(xi))
                    some = np.flatnonzero(count)
                    root = _roots(len(xi) + len(yi), i, j + len(xi))
                    ids = np.concatenate((xi, yi))
                    moved = np.flatnonzero(root != np.arange(len(root)))
                    out["a"] = np.concatenate((xi[some], ids[moved]))
                    out["b"] = np.concatenate((np.full(len(some), -1), ids[root[moved]]))
                    out["n"] = np.concatenate((count[some].astype(np.int64), np.zeros(len(moved), np.int64)))
            return pd.DataFrame(out).astype("int64")

        # n > 0: links of a; n = 0: a and b are connected
        compared = cut_lineage(q.cogroup(y).applyInPandas(compare, "a long, b long, n long"))
        found = components(compared.filter("n = 0"))
        links = compared.filter("n > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("links"))
        members = members.join(links, "rep", "left").join(
            found.select(F.col("v").alias("rep"), F.col("c").alias("component")), "rep", "left")
    else:
        members = members.withColumn("links", F.lit(0)).withColumn("component", F.col("rep"))
    members = members.groupBy("vec_id").agg(
        F.max(F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
        F.min(F.coalesce("component", "rep")).alias("component_id"))
    return rows.select("vec_id").join(members, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
