import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from costweave.forecast import baseline as B
from costweave.forecast.changepoint import break_series, classify_changes, median_square_gap, pelt_rbf, segments, segments_at
from costweave.forecast.reconcile import structural_weights, wls_tree


def test_pelt_finds_single_step():
    rng = np.random.default_rng(0)
    x = np.r_[np.zeros(365), np.ones(365) * 3] + rng.normal(0, 0.1, 730)
    b = pelt_rbf((x - x.mean()) / x.std())
    assert len(b) == 2 and abs(b[0] - 365) <= 7 and b[-1] == 730


def test_segment_skips():
    days = pd.date_range("2024-01-01", periods=89)
    short = pd.DataFrame({"unique_id": "a", "ds": days, "y": 1.0})
    assert break_series(short)["skip_reason"].iloc[0] == "too_short"
    flat = pd.DataFrame({"unique_id": "a", "ds": pd.date_range("2024-01-01", periods=120), "y": 5.0})
    assert break_series(flat)["skip_reason"].iloc[0] == "flat"


def test_changepoints_distributed(spark):
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(400)]
    rows = [("s", d, 100.0 if i < 200 else 300.0) for i, d in enumerate(days)]
    rows += [("t", d, 0.0 if i < 301 else 50.0) for i, d in enumerate(days[:350])]   # step on the 7-day grid
    df = spark.createDataFrame(rows, "unique_id string, ds date, y double")
    ch = {r.unique_id: r for r in classify_changes(segments(df)).collect()}
    assert abs((ch["s"].changepoint_date - days[200]).days) <= 7 and ch["s"].change_type == "increase"
    assert ch["t"].pct_change is None and ch["t"].change_type == "launch"


def test_seasonal_naive_repeats_last_week(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(14)]
    df = spark.createDataFrame([("a", d, float(i)) for i, d in enumerate(days)], "unique_id string, ds date, y double")
    fc = {r.ds: r.yhat for r in B.seasonal_naive(df, h=10).collect()}
    assert fc[dt.date(2024, 1, 15)] == 7.0 and fc[dt.date(2024, 1, 21)] == 13.0 and fc[dt.date(2024, 1, 22)] == 7.0
    assert len(fc) == 10


def test_wls_tree_coherent_and_matches_dense_gls(spark):
    ids = ["total", "total/a", "total/b", "total/a/x/y/l1", "total/a/x/y/l2", "total/b/x/y/l3"]
    # a 5-level tree needs every level: add the intermediate nodes
    ids += ["total/a/x", "total/a/x/y", "total/b/x", "total/b/x/y"]
    yhat = {"total": 10.0, "total/a": 7.0, "total/b": 2.0, "total/a/x": 6.5, "total/a/x/y": 6.0, "total/b/x": 2.5,
            "total/b/x/y": 2.2, "total/a/x/y/l1": 4.0, "total/a/x/y/l2": 1.5, "total/b/x/y/l3": 3.0}
    fc = spark.createDataFrame([(u, dt.date(2024, 1, 1), "m", yhat[u]) for u in ids],
                               "unique_id string, ds date, model_id string, yhat double")
    leaves = ["total/a/x/y/l1", "total/a/x/y/l2", "total/b/x/y/l3"]
    bridge = spark.createDataFrame([(u, l) for l in leaves for u in ids if l == u or l.startswith(u + "/")],
                                   "unique_id string, bottom_id string")
    out = {r.unique_id: r.yhat for r in wls_tree(fc, structural_weights(bridge)).collect()}
    assert abs(out["total"] - sum(out[l] for l in leaves)) < 1e-9
    assert abs(out["total/a"] - out["total/a/x/y/l1"] - out["total/a/x/y/l2"]) < 1e-9
    # dense GLS with W = diag(leaf counts)
    S = np.array([[1.0 if (l == u or l.startswith(u + "/")) else 0.0 for l in leaves] for u in ids])
    Winv = np.diag(1.0 / S.sum(1))
    y = np.array([yhat[u] for u in ids])
    b = np.linalg.solve(S.T @ Winv @ S, S.T @ Winv @ y)
    dense = dict(zip(ids, S @ b))
    assert max(abs(out[u] - dense[u]) for u in ids) < 1e-9


def test_stl_recovers_line_and_weekly_pattern():
    from costweave.forecast.stl import mstl
    t = np.arange(730)
    pat = np.array([3.0, 1.0, -2.0, 0.5, 0.0, -4.0, 1.5])
    pat -= pat.mean()
    y = 10 + 0.05 * t + pat[t % 7]
    d = mstl(y, [7, 365])
    assert np.abs(d["seasonal_7"] - pat[t % 7]).max() < 1e-6
    assert np.abs(d["trend"] + d["seasonal_7"] + d["seasonal_365"] + d["remainder"] - y).max() < 1e-9
    short = mstl(y[:500], [7, 365])
    assert "seasonal_365" not in short                         # fewer than two cycles: period skipped


def test_arima_order_search_recovers_ar1():
    from costweave.forecast import arima
    rng = np.random.default_rng(3)
    e, ys = 0.0, []
    for _ in range(730):
        e = 0.7 * e + rng.normal()
        ys.append(e)
    y = np.array(ys)
    assert arima.choose_d(y) == 0 and arima.choose_d(np.cumsum(rng.normal(size=730))) == 1
    fits = {(p, q): arima.fit_forecast(y, p, q, 0, 5) for p, q in arima.orders()}
    best = min(fits, key=lambda k: (fits[k][0], k))
    true_err = abs(fits[(1, 0)][1][0] - 0.7 * y[-1])
    assert abs(fits[best][1][0] - 0.7 * y[-1]) < 0.5 + true_err   # one-step forecast as good as the true model
    assert fits[(0, 0)][0] > fits[(1, 0)][0]                       # AR(1) beats white noise on AICc


def test_mstl_arima_pipeline(spark):
    from costweave.forecast.mstl_forecast import mstl_arima
    rng = np.random.default_rng(0)
    pat = [3.0, 1.0, -2.0, 0.5, 0.0, -4.0, 1.5]
    rows = []
    for s in range(3):
        for i in range(200):
            rows.append((f"s{s}", dt.date(2020, 1, 1) + dt.timedelta(days=i), 50 + pat[i % 7] + rng.normal(0, 0.1)))
    df = spark.createDataFrame(rows, "unique_id string, ds date, y double")
    fc, fit = mstl_arima(df, 14)
    got = fc.collect()
    assert len(got) == 3 * 14
    first = {r.unique_id: r for r in got if r.ds == dt.date(2020, 7, 19)}
    # 2020-07-19 is day 200 -> phase 200 % 7 = 4 of the weekly pattern
    assert all(abs(r.yhat - (50 + pat[200 % 7])) < 1.0 for r in first.values())
    assert fit.filter("fitted IS NULL").count() == 0


def test_mint_shrink_matches_dense_and_is_coherent(spark):
    from costweave.forecast.mint import apply_mint, mint_weights, projection, residual_gram, shrunk_covariance
    ids = ["total", "total/a", "total/b", "total/a/l1", "total/a/l2", "total/b/l3"]
    leaves = ["total/a/l1", "total/a/l2", "total/b/l3"]
    links = [(u, l) for l in leaves for u in ids if l == u or l.startswith(u + "/")]
    rng = np.random.default_rng(5)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(90)]
    E = rng.normal(size=(90, 6)) * np.array([3, 2, 2, 1, 1, 1.5])
    resid = spark.createDataFrame([(u, d, float(E[t, k])) for t, d in enumerate(days) for k, u in enumerate(ids)],
                                  "unique_id string, ds date, residual double")
    bridge = spark.createDataFrame(links, "unique_id string, bottom_id string")
    gram = residual_gram(resid)
    W = mint_weights(gram, bridge).toPandas()
    # dense reference from the full residual matrix
    import pandas as pd
    g = pd.DataFrame([(ids[i], ids[j], float(E[:, i] @ E[:, j]), float((E[:, i] * E[:, j]) @ (E[:, i] * E[:, j])), 90)
                      for i in range(6) for j in range(6)], columns=["node_i", "node_j", "sxy", "sxy2", "n"])
    nodes = sorted(ids)
    P = projection(nodes, sorted(leaves), pd.DataFrame(links, columns=["unique_id", "bottom_id"]),
                   shrunk_covariance(nodes, g))
    got = {(r.bottom_id, r.node_id): r.weight for r in W.itertuples()}
    for bi, b in enumerate(sorted(leaves)):
        for ni, n in enumerate(nodes):
            assert abs(got[(b, n)] - P[bi, ni]) < 1e-9
    yhat = {"total": 10.0, "total/a": 6.0, "total/b": 3.0, "total/a/l1": 2.0, "total/a/l2": 3.5, "total/b/l3": 3.2}
    fc = spark.createDataFrame([(u, dt.date(2024, 4, 1), "m", v) for u, v in yhat.items()],
                               "unique_id string, ds date, model_id string, yhat double")
    out = {r.unique_id: r.yhat for r in apply_mint(fc, mint_weights(gram, bridge), bridge).collect()}
    assert abs(out["total"] - sum(out[l] for l in leaves)) < 1e-9
    assert abs(out["total/a"] - out["total/a/l1"] - out["total/a/l2"]) < 1e-9


def test_short_series_get_the_naive_forecast(spark):
    from costweave.forecast.mstl_forecast import mstl_arima
    start = dt.date(2020, 1, 1)
    size = {"one": 1, "three": 3, "eight": 8, "long": 120}
    rows = [(u, start + dt.timedelta(days=i), 10.0 + i % 7 + i / 10) for u, n in size.items() for i in range(n)]
    fc, fit = mstl_arima(spark.createDataFrame(rows, "unique_id string, ds date, y double"), 14)
    got = {}
    for r in sorted(fc.collect(), key=lambda r: (r.unique_id, r.ds)):
        got.setdefault(r.unique_id, []).append(r)
    assert {u: len(x) for u, x in got.items()} == dict.fromkeys(size, 14)
    assert all((r.skip_reason is None) == (u == "long") for u, x in got.items() for r in x)
    y = {u: [r[2] for r in rows if r[0] == u] for u in size}
    assert np.allclose([r.yhat for r in got["three"]], y["three"][-1]) and np.allclose([r.yhat for r in got["one"]], 10.0)
    assert np.allclose([r.yhat for r in got["eight"]], (y["eight"][-7:] * 2))
    assert got["eight"][0].ds == start + dt.timedelta(days=8) and fit.filter("fitted IS NULL").count() == 0


def dense_pelt(x, pen=10.0, min_size=14, jump=7):
    """The same search with the whole kernel matrix."""
    n = len(x)
    d2 = np.subtract.outer(x, x) ** 2
    med = np.median(d2[np.triu_indices(n, 1)])
    cum = np.zeros((n + 1, n + 1))
    cum[1:, 1:] = np.exp(-d2 * (1.0 / med if med > 0 else 1.0)).cumsum(0).cumsum(1)
    cost = lambda a, b: (b - a) - (cum[b, b] - cum[a, b] - cum[b, a] + cum[a, a]) / (b - a)
    grid = [*range(0, n, jump), n]
    best, prev = {0: -pen}, {}
    for b in grid[1:]:
        ok = [(best[a] + cost(a, b) + pen, a) for a in grid if a < b and a in best and b - a >= min_size]
        if ok:
            best[b], prev[b] = min(ok)
    out, t = [], n
    while t:
        out.append(t)
        t = prev[t]
    return sorted(out)


def test_linear_memory_pelt_equals_dense_search():
    rng = np.random.default_rng(4)
    for n in (90, 133, 400, 707):
        steps = np.repeat(rng.normal(size=n // 45 + 1), 45)[:n] * 3
        x = steps + rng.normal(0, 0.3, n)
        x = (x - x.mean()) / x.std()
        assert pelt_rbf(x) == dense_pelt(x)
    for x in (rng.normal(size=101), rng.integers(0, 3, 90).astype(float), np.r_[np.zeros(80), 1.0], rng.normal(size=2)):
        gaps = np.subtract.outer(x, x)[np.triu_indices(len(x), 1)]
        assert median_square_gap(x) == np.median(gaps ** 2)


def test_segments_at_given_breaks(spark):
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i)
    series = spark.createDataFrame([("a", day(i), float(i)) for i in range(10)], "unique_id string, ds date, y double")
    breaks = spark.createDataFrame([("a", day(2)), ("a", day(7)), ("b", day(0)), ("c", None)], "unique_id string, segment_start date")
    got = sorted(tuple(r) for r in segments_at(series, breaks).collect())
    assert got == [("a", day(2), day(6), 5, 4.0), ("a", day(7), day(9), 3, 8.0)]


def _tree(seed, days=3, leaves=(("a", "x", "y", "l1"), ("a", "x", "y", "l2"), ("b", "x", "y", "l3"), ("b", "z", "y", "l4"))):
    rng = np.random.default_rng(seed)
    bottoms = ["total/" + "/".join(p) for p in leaves]
    ids = sorted({"/".join(b.split("/")[:i]) for b in bottoms for i in range(1, 6)})
    S = np.array([[1.0 if b == u or b.startswith(u + "/") else 0.0 for b in bottoms] for u in ids])
    return ids, bottoms, S, rng


def test_wls_var_by_cutoff_matches_dense_solve(spark):
    ids, bottoms, S, rng = _tree(7)
    rows, weights, want = [], [], {}
    for cut in (dt.date(2024, 1, 1), dt.date(2024, 2, 1)):
        for model in ("m1", "m2"):
            w = rng.uniform(0.1, 5.0, len(ids))
            weights += [(u, model, cut, float(v)) for u, v in zip(ids, w)]
            P = np.linalg.solve(S.T @ np.diag(1 / w) @ S, S.T @ np.diag(1 / w))
            for k in range(3):
                y = rng.normal(size=len(ids)) * 3
                ds = cut + dt.timedelta(days=k + 1)
                rows += [(u, ds, model, cut, float(v)) for u, v in zip(ids, y)]
                want |= {(u, ds, model + "/WLS", cut): v for u, v in zip(ids, S @ (P @ y))}
                want |= {(u, ds, model + "/WLS", cut, "clipped"): v for u, v in zip(ids, S @ np.clip(P @ y, 0, None))}
    fc = spark.createDataFrame(rows, "unique_id string, ds date, model_id string, cutoff date, yhat double")
    wt = spark.createDataFrame(weights, "unique_id string, model_id string, cutoff date, w double")
    for nonnegative in (False, True):
        out = wls_tree(fc, wt, extra_keys=["cutoff"], nonnegative=nonnegative).collect()
        assert len(out) == len(rows)
        for r in out:
            key = (r.unique_id, r.ds, r.model_id, r.cutoff) + (("clipped",) if nonnegative else ())
            assert abs(r.yhat - want[key]) < 1e-9
    assert any(len(k) == 5 and v == 0 for k, v in want.items())
    plan = wls_tree(fc, wt, extra_keys=["cutoff"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1 and "SortMergeJoin" not in plan.split("REPARTITION_BY_NUM")[0]


def test_residual_variances_use_training_days_only(spark):
    start = dt.date(2024, 1, 1)
    y = [float((i * i) % 11 + (50 if i > 40 else 0)) for i in range(60)]
    h = spark.createDataFrame([("a", start + dt.timedelta(days=i), v) for i, v in enumerate(y)] + [("b", start, 3.0)],
                              "unique_id string, ds date, y double")
    cuts = F.array(F.lit(start + dt.timedelta(days=30)), F.lit(start + dt.timedelta(days=59)))
    got = {(r.unique_id, r.model_id, r.cutoff): r.w for r in B.residual_variances(B.in_sample(h), cuts, 2).collect()}
    for last in (30, 59):
        naive = np.mean([(y[i] - y[i - 7]) ** 2 for i in range(7, last + 1)])
        lower = lambda i: sorted(y[i - 7 * k] for k in range(1, 10) if i >= 7 * k)
        median = np.mean([(y[i] - lower(i)[(len(lower(i)) + 1) // 2 - 1]) ** 2 for i in range(7, last + 1)])
        cut = start + dt.timedelta(days=last)
        assert abs(got["a", B.NAIVE, cut] - naive) < 1e-9 and abs(got["a", B.MEDIAN, cut] - median) < 1e-9
        assert got["b", B.NAIVE, cut] == 9.0                       # never fitted: its own mean square


def test_anomalies_after_flat_and_noisy_past(spark):
    from costweave.operators.aggregate import anomalies
    start = dt.date(2024, 1, 1)
    noisy = [10.0 + (i % 3) for i in range(28)] + [11.0, 60.0]
    rare = [5.0] * 25 + [6.0] * 3 + [5.0, 20.0]
    flat = [7.0] * 29 + [8.0]
    rows = [(k, "x", start + dt.timedelta(days=i), v) for k, s in (("noisy", noisy), ("rare", rare), ("flat", flat), ("young", flat[-20:]))
            for i, v in enumerate(s)]
    out = {r.unique_id: r for r in anomalies(spark.createDataFrame(rows, "unique_id string, level string, ds date, y double"),
                                             ["unique_id"], ["level"]).collect()}
    assert {k: r.basis for k, r in out.items()} == {"noisy": "mad", "rare": "mean", "flat": "flat"}
    assert all(r.ds == start + dt.timedelta(days=29) and r.severity == "high" for r in out.values())
    assert out["flat"].anomaly_score is None and out["flat"].impact == 1.0
    assert abs(out["noisy"].anomaly_score - 49 / 1.4826) < 1e-9


def test_accuracy_rerun_replaces_its_run_date(spark, monkeypatch, tmp_path):
    from costweave.operators.aggregate import accuracy
    from costweave.sources.store import TableStore
    cv = spark.createDataFrame([("total", "m", "01-28d", 10.0, 12.0), ("total", "m", None, 0.0, 1.0), ("total", "m", "29-91d", None, 3.0)],
                               "level string, model_id string, horizon_bucket string, y double, yhat double")
    rows = {r.horizon_bucket: r for r in accuracy(cv, ["level", "model_id"], "horizon_bucket").collect()}
    assert set(rows) == {None, "01-28d", "29-91d"}
    assert abs(rows[None].wape - 0.3) < 1e-12 and abs(rows[None].mape - 0.2) < 1e-12 and abs(rows[None].rmse - 2.5 ** 0.5) < 1e-12
    assert rows["29-91d"].wape is None and rows["29-91d"].rmse is None
    store = TableStore(spark, str(tmp_path))
    for value in (1.0, 2.0):
        store.replace_run_date(spark.createDataFrame([("m", value, "2024-01-01")], "model_id string, value double, run_date string"), "acc")
    assert [r.value for r in store.read("acc").collect()] == [2.0]
