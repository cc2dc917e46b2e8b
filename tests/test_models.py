"""Model parity with closed forms (numpy) and the what-if grid."""

import numpy as np
from pyspark.sql import functions as F

from seatcast.operators import models as M
from seatcast.operators import whatif

TARGET = "target_host_sold_today"


def _data(spark, n=300, seed=0):
    rng = np.random.default_rng(seed)
    x1, x2 = rng.normal(size=n), rng.normal(size=n) * 3 + 1
    y = rng.poisson(np.exp(0.3 + 0.4 * x1 - 0.1 * x2))
    rows = [(float(a), float(b), int(c)) for a, b, c in zip(x1, x2, y)]
    return spark.createDataFrame(rows, f"x1 double, x2 double, {TARGET} long"), x1, x2, y.astype(float)


def _standardize(x):
    return (x - x.mean()) / x.std()


def test_ridge_matches_closed_form(spark):
    df, x1, x2, y = _data(spark)
    alpha = 5.0
    m = M.fit_ridge(df, M.FeatureSet(["x1", "x2"]), alpha)
    X = np.column_stack([_standardize(x1), _standardize(x2)])
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(2), Xc.T @ yc)
    assert np.allclose(m.stages[-1].coefficients.toArray(), w, atol=1e-6)


def test_poisson_matches_newton(spark):
    df, x1, x2, y = _data(spark, seed=1)
    alpha = 1.0
    m = M.fit_poisson(df, M.FeatureSet(["x1", "x2"]), alpha)
    X = np.column_stack([np.ones_like(x1), _standardize(x1), _standardize(x2)])
    w = np.zeros(3)
    n = len(y)
    P = np.diag([0.0, alpha, alpha])
    for _ in range(50):      # Newton on (1/2n) sum deviance + (alpha/2) |w|^2
        mu = np.exp(X @ w)
        g = X.T @ (mu - y) / n + P @ w
        H = X.T @ (X * mu[:, None]) / n + P
        w = w - np.linalg.solve(H, g)
    got = np.concatenate([[m.stages[-1].intercept], m.stages[-1].coefficients.toArray()])
    assert np.allclose(got, w, atol=1e-4)


def test_coef_table_and_persistence(spark, tmp_path):
    df, *_ = _data(spark, seed=2)
    df = df.withColumn("team", F.when(F.col("x1") > 0, "a").otherwise("b"))
    m = M.fit_poisson(df, M.FeatureSet(["x1", "x2"], ["team"]))
    coef = M.coef_table(m, m.transform(df.limit(1))).collect()
    assert {r["feature"] for r in coef} >= {"x1", "x2"}
    assert [r["magnitude"] for r in coef] == sorted((abs(r["coefficients"]) for r in coef), reverse=True)
    path = M.save_model(m, str(tmp_path / "model"))
    a = m.transform(df).select("prediction").collect()
    b = M.load_model(path).transform(df).select("prediction").collect()
    assert a == b


def test_whatif_grid_one_pass(spark):
    rows = spark.createDataFrame([("o1", "A", 2.0, 76.0), ("o1", "W", 3.0, None), ("o2", "B", 1.0, 68.0)],
                                 "opponent string, price_code string, times_above_floor double, price_floor double")
    scorer = whatif.linear_scorer({"times_above_floor": 1.0})
    curve = whatif.demand_curve_ratio(rows, scorer, (1.0, 8.0), 30, ["opponent", "price_code"])
    assert curve.count() == 90
    pts = sorted(r["times_above_floor"] for r in curve.where("price_code = 'A'").collect())
    assert pts == list(np.linspace(1, 8, 30))
    imp = {(r["opponent"], r["grid_idx"]): r["total_prediction"]
           for r in whatif.price_change_impact(rows, scorer, n=3).collect()}
    # o1: A scales with the multiplier, unknown code W keeps its ratio
    assert imp[("o1", 0)] == 2.0 * 0.5 + 3.0 and imp[("o1", 2)] == 2.0 * 2.0 + 3.0
