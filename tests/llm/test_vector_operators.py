"""Near-duplicate links and nearest neighbours against brute force."""
import numpy as np
from pyspark.sql import functions as F

from costweave.llm import ann, near_vectors, queries
from tests.conftest import SF001

VECTORS = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def clustered(seed=0, n=400, dim=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(25, dim))
    rows = []
    for i in range(n):
        v = (centres[rng.integers(25)] + rng.normal(size=dim) * rng.choice([0.02, 0.3, 2.0])) * rng.choice([0.5, 1, 3])
        rows.append((int(i * 3), [float(x) for x in v.astype(np.float32)], int(rng.integers(3))))
    rows += [(5000 + k, rows[0][1], rows[0][2]) for k in range(30)]
    return rows


def odd(dim=12):
    one = [1.0] + [0.0] * (dim - 1)
    return [(9001, None, 1), (9002, [0.0] * dim, 1), (9003, [NAN] + one[1:], 1), (9004, [INF] + one[1:], 1),
            (9005, [None] + one[1:], 1), (9006, [], 1), (None, one, 1), (9007, one, None), (9008, one[:-1], 1),
            (9009, one, 1), (9009, one, 1)]


def valid(rows):
    return [(i, np.array(v, float), lab) for i, v, lab in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]


def brute_links(rows):
    use = [(i, v, lab) for i, v, lab in dict((r[0], r) for r in valid(rows)).values() if lab is not None]
    near = {r[0]: set() for r in rows}
    for i, v, lab in use:
        for j, w, other in use:
            if i != j and lab == other and len(v) == len(w) and \
                    v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= 0.93:
                near[i].add(j)
    low = {i: i for i in near}
    changed = True
    while changed:
        changed = False
        for i, js in near.items():
            best = min([low[i], *(low[j] for j in js)]) if i is not None else None
            if best != low[i]:
                low[i], changed = best, True
    return {i: (len(js), low[i], True if i is None else low[i] == i) for i, js in near.items()}


def test_links_equal_brute_force(spark, monkeypatch):
    from costweave.llm import vectors
    monkeypatch.setattr(vectors, "BLOCK", 50)           # several blocks a list
    monkeypatch.setattr(vectors, "QUERIES", 70)
    rows = clustered() + odd()
    frame = spark.createDataFrame(rows, VECTORS).withColumn("size", F.lit("clash"))
    out = near_vectors.near_links(frame).collect()
    want = brute_links(rows)
    assert len(out) == len(rows)
    assert all((r["n_links"], r["component_id"], r["kept"]) == want[r["vec_id"]] for r in out)
    assert any(r["n_links"] >= 30 for r in out)


def test_no_links_without_vectors(spark):
    frame = spark.createDataFrame(odd()[:6], VECTORS)
    assert all(tuple(r) == (r["vec_id"], 0, r["vec_id"], True) for r in near_vectors.near_links(frame).collect())
    assert near_vectors.near_links(frame.limit(0)).count() == 0


def brute_search(rows, is_query, k):
    use = list(dict((r[0], r) for r in valid(rows)).values())
    dim = max({len(v) for _, v, _ in use}, key=[len(v) for _, v, _ in use].count)
    use = [r for r in use if len(r[1]) == dim]
    return {i: sorted((-float(v @ w), j) for j, w, _ in use if j != i)[:k] for i, v, _ in use if is_query(i)}


def recall_of(out, want, k=20):
    got = {}
    for r in out:
        got.setdefault(r["query_id"], []).append(r)
    assert set(got) == set(want)
    hit = total = 0
    for q, rows in got.items():
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1)) and len(rows) == len(want[q])
        assert [(-r["score"], r["vec_id"]) for r in rows] == sorted((-r["score"], r["vec_id"]) for r in rows)
        hit += len({r["vec_id"] for r in rows} & {j for _, j in want[q]})
        total += len(want[q])
    return hit / total


def test_search_finds_the_neighbours(spark, monkeypatch):
    monkeypatch.setattr(ann, "LEAF", 40)
    rows = clustered(1, 900) + odd()
    out = ann.search(spark.createDataFrame(rows, VECTORS).withColumn("leaf", F.lit(0)), F.col("vec_id") % 20 == 0).collect()
    assert recall_of(out, brute_search(rows, lambda i: i % 20 == 0, 20)) >= 0.9


def test_search_query(spark):
    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    out = queries.QUERIES["op7_tree_ann"](spark, SF001).collect()
    want = brute_search(rows, lambda i: i % 20 == 0, 20)
    assert recall_of(out, want) >= 0.9
    exact = {r[0]: np.array(r[1], float) for r in rows}
    assert all(abs(r["score"] - exact[r["query_id"]] @ exact[r["vec_id"]]) < 1e-12 for r in out)


def test_few_candidates_and_ties(spark):
    rows = [(20, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.0, 1.0], 1)]
    out = ann.search(spark.createDataFrame(rows, VECTORS), F.col("vec_id") == 20).collect()
    assert [(r["rank"], r["vec_id"]) for r in sorted(out, key=lambda r: r["rank"])] == [(1, 1), (2, 3), (3, 2)]
    assert ann.search(spark.createDataFrame([], VECTORS), F.col("vec_id") == 20).count() == 0


def test_full_answer_from_small_leaves(spark, monkeypatch):
    """A few outliers in leaves of their own beside a hot group that sets the calibrated visits."""
    monkeypatch.setattr(ann, "LEAF", 40)
    rng = np.random.default_rng(5)
    rows = [(i, [1.0, 0.0, 0.0, 0.0], 1) for i in range(600)]
    rows += [(600 + i, [float(x) for x in 40 * np.eye(4)[1 + i % 3] + rng.normal(size=4)], 1) for i in range(12)]
    out = ann.search(spark.createDataFrame(rows, VECTORS), F.col("vec_id") >= 600).collect()
    assert {i: sum(r["query_id"] == i for r in out) for i in range(600, 612)} == dict.fromkeys(range(600, 612), 20)
