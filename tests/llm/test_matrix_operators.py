"""Whitening against a dense eigensolver, vector codes against plain Lloyd rounds."""
import hashlib
import math

import numpy as np
import pytest

from costweave.llm import queries, vector_codes, whitening
from tests.conftest import SF001
from tests.harness import compare, duck
from tests.llm.test_vector_operators import INF, NAN, VECTORS, clustered

# ---- whitening ------------------------------------------------------------------------------


def random_spectrum(d, n, seed):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(n, d)) * np.exp(rng.normal(size=d))
    a -= a.mean(0)
    return a.T @ a / n


@pytest.mark.parametrize("d,n", [(1, 9), (3, 30), (12, 400), (40, 25), (64, 900)])
def test_leading_pairs(d, n):
    v = random_spectrum(d, n, d)
    values, vectors = whitening.leading_pairs(v, 8)
    dense = np.linalg.eigvalsh(v)[::-1][:8]
    assert len(values) == min(8, d)
    assert np.allclose(values, dense, rtol=1e-10, atol=0)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs(v @ vectors - vectors * values).max() < 1e-11 * dense[0]


@pytest.mark.parametrize("spectrum,found", [([5] * 3 + [4] * 3 + [3] * 4 + [1] * 10, 8), ([1] * 20, 8), ([7, 7] + [0] * 18, 2),
                                            ([1e6] + [1] * 19, 8), ([0] * 20, 0), ([2 - 1e-13 * i for i in range(20)], 8),
                                            ([2 - 1e-9 * i for i in range(20)], 8)])
def test_ties_and_missing_ranks(spectrum, found):
    q, _ = np.linalg.qr(np.random.default_rng(3).normal(size=(20, 20)))
    v = q @ np.diag(np.array(spectrum, float)) @ q.T
    values, vectors = whitening.leading_pairs((v + v.T) / 2, 8)
    assert len(values) == found and np.allclose(values, sorted(spectrum)[::-1][:found], rtol=1e-9)
    assert np.abs(vectors.T @ vectors - np.eye(found)).max(initial=0) < 1e-12


def test_inertia_counts():
    rng = np.random.default_rng(1)
    for d in (1, 2, 5, 30):
        for _ in range(20):
            m = rng.normal(size=(d, d))
            m = m + m.T
            m[rng.random((d, d)) < 0.3] = 0
            m = np.triu(m) + np.triu(m, 1).T
            assert whitening.positive_count(m + 0.0) == (np.linalg.eigvalsh(m) > 1e-12).sum()


def test_products_are_exact():
    rng = np.random.default_rng(2)
    for top in (5, 1 << 20, 1 << 27, 1 << 33):
        y = rng.integers(-top, top, (300, 4))
        want = [[sum(int(r[i]) * int(r[j]) for r in y) for j in range(4)] for i in range(4)]
        assert whitening.products(y).tolist() == want


def check_whitening(rows, out, components=8):
    """rows: complete vectors of one length."""
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in rows])
    n, sums = len(x), x.sum(0)
    v = np.cov(x.T, bias=True).reshape(x.shape[1], -1)
    dense = np.linalg.eigvalsh(v)[::-1][:components]
    k = int((dense > 1e-9 * max(dense[0], 1e-300)).sum())
    assert len(out) == n * k
    by_row = {}
    for r in out:
        assert r["n"] == n and r["identity_error"] <= 1e-4
        assert abs(r["explained"] - dense[r["component"] - 1] / np.trace(v)) <= 1e-6 * r["explained"]
        by_row.setdefault(r["vec_id"], []).append(r)
    ids = [i for i, _ in rows]
    w = np.zeros((n, k))
    for at, (i, row) in enumerate(zip(ids, x)):
        own = sorted(by_row[i], key=lambda r: r["component"])[:: len(by_row[i]) // k]
        assert all(r["deviation"] == sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for r in own)
        w[at] = [r["whitened"] for r in own]
    assert np.abs(w.mean(0)).max() < 1e-9 and np.abs(np.cov(w.T, bias=True).reshape(k, k) - np.eye(k)).max() < 1e-8
    # the whitened values times the root of their eigenvalue rebuild the projection on the leading space
    u = np.linalg.eigh(v)[1][:, ::-1][:, :k]
    y = x - sums / n
    assert np.abs((y @ u) @ (y @ u).T - (w * dense[:k]) @ w.T).max() < 1e-6 * dense[0] * n


def test_whitening_of_the_table(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    out = queries.QUERIES["op12_embedding_whitening"](spark, SF001)
    assert dict(out.dtypes) | {"component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double"} == dict(out.dtypes)
    check_whitening(rows, out.collect())


def test_whitening_odd_rows(spark):
    rows = [(i, v) for i, v, _ in clustered(4, 200, 6)[:200]]
    odd = [(9001, None), (9003, [NAN] + [1.0] * 5), (9004, [INF] * 6), (9005, [None] + [1.0] * 5), (9006, []), (9007, [1.0] * 5)]
    zero = [(None, [0.0] * 6)]
    frame = spark.createDataFrame(rows + odd + zero, "vec_id long, embedding array<float>").selectExpr(
        "*", "'clash' AS vector", "1 AS component", "2 AS n")
    check_whitening(rows + zero, whitening.whiten(frame).collect())
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<float>")
    assert whitening.whiten(same).count() == 0 and whitening.whiten(same.limit(0)).count() == 0
    two = whitening.whiten(spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 0.5]), (3, [0.0, 0.0])], "vec_id long, embedding array<double>")).collect()
    assert len(two) == 3 and all(math.isfinite(r["whitened"]) for r in two)      # the second eigenvalue is zero to rounding


# ---- vector codes ---------------------------------------------------------------------------


def plain_codes(rows, parts=4, entries=256, rounds=4):
    use = [(i, v, lab) for i, v, lab in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = -(-max([1, *(len(v) for _, v, _ in use)]) // parts) * parts
    x = {at: np.array([max(-vector_codes.CLAMP, min(vector_codes.CLAMP, math.floor(1024 * c))) for c in v] + [0] * (width - len(v)))
         for at, (_, v, _) in enumerate(use)}
    first = sorted(x, key=lambda at: (use[at][0] is None, use[at][0] or 0, use[at][1]))[:entries]
    books = [[x[at][p * width // parts:(p + 1) * width // parts].tolist() for at in first] for p in range(parts)]

    def nearest(p, at):
        own = x[at][p * width // parts:(p + 1) * width // parts]
        return min((int(((own - np.array(e)) ** 2).sum()), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            got = {}
            for at in x:
                got.setdefault(nearest(p, at)[1], []).append(x[at][p * width // parts:(p + 1) * width // parts])
            new.append([[int(s) // len(got[k]) for s in sum(got[k])] if k in got else e for k, e in enumerate(books[p])])
        books = new
    final = [[nearest(p, at) for p in range(parts)] for at in x]
    total = {}
    for (_, _, lab), f in zip(use, final):
        total[lab] = total.get(lab, 0) + sum(d for d, _ in f)
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), total[lab], digest)
                   for (i, _, lab), f in zip(use, final)), key=str)


def rows_of(frame):
    return sorted((tuple(r[c] for c in ("vec_id", "code", "error", "label_error", "codebooks_sha256")) for r in frame.collect()), key=str)


def test_codes_equal_plain_rounds(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK", 150)
    rows = clustered(5, 260, 10) + [(7000 + i, [float(i % 3)] * 10, None) for i in range(40)]
    rows += [(None, [0.5] * 10, 2), (9001, None, 1), (9003, [NAN] * 10, 1), (9004, [INF] * 10, 1), (9005, [None] * 10, 1), (9006, [], 1),
             (9007, [0.0] * 10, 7), (9008, [1.0] * 7, 1), (9009, [1e30] + [0.0] * 9, 1)]
    frame = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'clash' AS vector", "1 AS code", "2 AS salt", "3 AS error")
    assert rows_of(vector_codes.compress(frame, entries=40)) == plain_codes(rows, entries=40)
    few = rows[:5]
    assert rows_of(vector_codes.compress(spark.createDataFrame(few, VECTORS))) == plain_codes(few)
    assert vector_codes.compress(frame.limit(0)).count() == 0
    only_empty = [(1, [], 1), (2, [], None)]
    assert rows_of(vector_codes.compress(spark.createDataFrame(only_empty, VECTORS))) == plain_codes(only_empty)


@pytest.mark.parametrize("kind", ["spread", "clusters", "copies", "large"])
def test_trees_own_what_all_pairs_say(kind):
    rng = np.random.default_rng(0)
    x = {"spread": lambda: rng.integers(-300, 300, (1500, 16)), "large": lambda: rng.integers(-vector_codes.CLAMP, vector_codes.CLAMP, (700, 16)),
         "clusters": lambda: rng.integers(-900, 900, (20, 8))[rng.integers(0, 20, 1500)] + rng.integers(-5, 5, (1500, 8)),
         "copies": lambda: np.repeat(rng.integers(-3, 3, (30, 4)), 50, 0)}[kind]()
    packed = vector_codes.pack_tree(vector_codes.tree(x, np.arange(len(x))))
    book = x[::9][:15 if kind == "clusters" else 120].copy()
    owned = 0
    for _ in range(3):
        got = np.full(len(x), -1)
        for entry, rows, rest in vector_codes.owners(x, packed, book):
            assert (got[rows] == -1).all()
            got[rows] = entry if entry >= 0 else rest
            owned += len(rows) if entry >= 0 else 0
            assert entry < 0 or (x[rows].sum(0) == rest).all()
        dist = np.stack([((x - e) ** 2).sum(1) for e in book], 1)
        assert (dist.argmin(1) == got).all()
        for e in set(got.tolist()):
            book[e] = x[got == e].sum(0) // (got == e).sum()
    assert kind in ("spread", "large") or owned > len(x)


def test_codes_equal_sql(spark):
    name = "op13_vector_codes"
    info = compare(spark, duck(SF001), name, queries.QUERIES[name], queries.ORACLE[name], SF001)
    assert "error" not in info, info
