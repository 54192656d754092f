"""MinT reconciliation with a shrunk residual covariance (mint_shrink).

Wickramasuriya et al. (2019) with the Schafer & Strimmer (2005) shrinkage
towards the diagonal.  The expensive part - the N x N residual Gram over
every day - is a distributed aggregation: residual days are chunked by
calendar quarter, each chunk's partial sums (sum e_i e_j, sum (e_i e_j)^2, pair
counts) come out of a grouped map as long (i, j) rows, and a ``groupBy``
adds the chunks up.  Only the N x N result (N = number of nodes, a few
hundred; guarded by ``MAX_NODES``) meets in one task for the solve, which
returns the bottom-level projection P (M x N) as long rows.  Applying P is
a join + aggregate per day; all levels follow from the bridge table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_NODES = 5000
GRAM_SCHEMA = "node_i string, node_j string, sxy double, sxy2 double, n long"
P_SCHEMA = "bottom_id string, node_id string, weight double"


def _partial_gram(pdf: pd.DataFrame) -> pd.DataFrame:
    wide = pdf.pivot_table(index="ds", columns="unique_id", values="residual", aggfunc="first")
    nodes = list(wide.columns)
    X = wide.to_numpy(dtype=float)
    M = ~np.isnan(X)
    E = np.where(M, X, 0.0)
    sxy = E.T @ E
    sxy2 = (E * E).T @ (E * E)
    cnt = M.T.astype(float) @ M.astype(float)
    ii, jj = np.meshgrid(np.arange(len(nodes)), np.arange(len(nodes)), indexing="ij")
    names = np.array(nodes)
    # symmetric: emit each unordered pair once (ordered by name)
    keep = (cnt.ravel() > 0) & (names[ii.ravel()] <= names[jj.ravel()])
    return pd.DataFrame({"node_i": np.array(nodes)[ii.ravel()][keep], "node_j": np.array(nodes)[jj.ravel()][keep],
                         "sxy": sxy.ravel()[keep], "sxy2": sxy2.ravel()[keep],
                         "n": cnt.ravel()[keep].astype("int64")})


def residual_gram(residuals: DataFrame, chunk: str = "quarter", keys: list[str] | None = None) -> DataFrame:
    """(unique_id, ds, residual[, keys]) -> summed pair statistics over all
    days (each unordered pair once), per value of ``keys`` (e.g. a backtest
    cutoff).  A chunk holds a calendar period of days for all nodes, so its
    size is bounded by nodes x days-per-chunk."""
    keys = list(keys or [])
    r = residuals.filter(F.col("residual").isNotNull()).withColumn("_chunk", F.date_trunc(chunk, "ds"))

    def part_fn(pdf: pd.DataFrame) -> pd.DataFrame:
        out = _partial_gram(pdf)
        for k in keys:
            out[k] = pdf[k].iloc[0]
        return out

    schema = GRAM_SCHEMA + "".join(f", {k} {r.schema[k].dataType.simpleString()}" for k in keys)
    part = r.groupBy(*keys, "_chunk").applyInPandas(part_fn, schema)
    return part.groupBy(*keys, "node_i", "node_j").agg(F.sum("sxy").alias("sxy"), F.sum("sxy2").alias("sxy2"),
                                                        F.sum("n").alias("n"))


def shrunk_covariance(nodes: list[str], g: pd.DataFrame) -> np.ndarray:
    idx = {u: k for k, u in enumerate(nodes)}
    N = len(nodes)
    sxy, sxy2, cnt = np.zeros((N, N)), np.zeros((N, N)), np.zeros((N, N))
    i = g["node_i"].map(idx).to_numpy()
    j = g["node_j"].map(idx).to_numpy()
    for a, b in ((i, j), (j, i)):
        sxy[a, b], sxy2[a, b], cnt[a, b] = g["sxy"], g["sxy2"], g["n"]
    with np.errstate(invalid="ignore", divide="ignore"):
        W = np.where(cnt > 0, sxy / cnt, 0.0)                     # uncentred pairwise covariance
        sd = np.sqrt(np.clip(np.diag(W), 1e-12, None))
        r = W / np.outer(sd, sd)                                   # correlations of standardised residuals
        wbar = r
        w2 = np.where(cnt > 0, sxy2 / cnt, 0.0) / np.outer(sd, sd) ** 2
        var_r = np.where(cnt > 1, cnt / (cnt - 1) ** 3 * (cnt * w2 - cnt * wbar ** 2), 0.0)
    off = ~np.eye(N, dtype=bool)
    denom = (r[off] ** 2).sum()
    lam = float(np.clip(var_r[off].sum() / denom, 0.0, 1.0)) if denom > 0 else 1.0
    Ws = W * (1.0 - lam)
    np.fill_diagonal(Ws, np.diag(W))
    return Ws


def projection(nodes: list[str], bottoms: list[str], bridge: pd.DataFrame, W: np.ndarray) -> np.ndarray:
    """P = (S' W^-1 S)^-1 S' W^-1, bottoms x nodes."""
    ni = {u: k for k, u in enumerate(nodes)}
    bi = {u: k for k, u in enumerate(bottoms)}
    S = np.zeros((len(nodes), len(bottoms)))
    for a, b in zip(bridge["unique_id"], bridge["bottom_id"]):
        if a in ni and b in bi:
            S[ni[a], bi[b]] = 1.0
    Wi = np.linalg.pinv(W)
    return np.linalg.solve(S.T @ Wi @ S, S.T @ Wi)


def _solve(gram: pd.DataFrame, bridge: pd.DataFrame) -> pd.DataFrame:
    nodes = sorted(set(gram["node_i"]) | set(gram["node_j"]))
    if len(nodes) > MAX_NODES:
        raise ValueError(f"{len(nodes)} nodes exceed the MinT size guard ({MAX_NODES}); use wls_tree")
    bottoms = sorted(set(bridge["bottom_id"]) & set(nodes))
    P = projection(nodes, bottoms, bridge, shrunk_covariance(nodes, gram))
    bi, ni = np.meshgrid(np.arange(len(bottoms)), np.arange(len(nodes)), indexing="ij")
    return pd.DataFrame({"bottom_id": np.array(bottoms)[bi.ravel()], "node_id": np.array(nodes)[ni.ravel()],
                         "weight": P.ravel()})


def mint_weights(gram: DataFrame, bridge: DataFrame, key: str | None = None, key_values=None) -> DataFrame:
    """One solve per hierarchy - or one per value of ``key`` (e.g. each
    backtest cutoff on its own residuals), with ``key_values`` the array
    column of those values.  Both inputs are small (node pairs, node-leaf
    links) and meet in a cogroup."""
    keys = [key] if key else []
    if not keys:
        g = gram.withColumn("_k", F.lit(0))
        b = bridge.select("unique_id", "bottom_id").withColumn("_k", F.lit(0))
        return g.groupBy("_k").cogroup(b.groupBy("_k")).applyInPandas(lambda x, y: _solve(x, y), P_SCHEMA)
    # the bridge is the same for every key value: explode the (few) values
    # onto it instead of joining
    b = bridge.select("unique_id", "bottom_id", F.explode(key_values).alias(key))

    def solve_keyed(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        out = _solve(x, y)
        for k in keys:
            out[k] = x[k].iloc[0]
        return out

    schema = P_SCHEMA + "".join(f", {k} {gram.schema[k].dataType.simpleString()}" for k in keys)
    return gram.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInPandas(solve_keyed, schema)


def apply_mint(fc: DataFrame, weights: DataFrame, bridge: DataFrame, suffix: str = "/MinT_shrink",
               keys: list[str] | None = None) -> DataFrame:
    """Reconciled bottoms = P yhat per day (join + sum), then every node as
    the sum of its bottoms."""
    keys = list(keys or [])
    w = weights.withColumnRenamed("node_id", "unique_id")
    j = fc.join(w, ["unique_id", *keys])
    bottoms = j.groupBy("bottom_id", *keys, "ds", "model_id").agg(F.sum(F.col("weight") * F.col("yhat")).alias("yhat"))
    up = bottoms.join(bridge.select(F.col("unique_id").alias("anc"), "bottom_id"), "bottom_id")
    out = up.groupBy(F.col("anc").alias("unique_id"), *keys, "ds", "model_id").agg(F.sum("yhat").alias("yhat"))
    return out.withColumn("model_id", F.concat("model_id", F.lit(suffix)))
