"""Fits from sufficient statistics against closed forms and the row-wise fits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from seatcast import constants as C
from seatcast.operators import linear as L
from seatcast.operators import models as M
from seatcast.operators import splits
from seatcast.operators.gram import Design, Moments, moments, prepared, total

Y = C.TARGET


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(700):
        a, b = float(rng.normal() * 3 + 1e4), float(rng.normal() - 2)
        team, month = str(rng.choice(list("PQR"))), int(rng.integers(1, 4))
        y = int(rng.poisson(np.exp(0.5 + 0.1 * (a - 1e4) - 0.2 * b + (team == "Q"))))
        rows.append((i, None if i % 11 == 0 else a, None if i % 7 == 0 else b, None if i % 50 == 0 else team, month,
                     float(i % 2), i % 3, None if i == 5 else y))
    return spark.createDataFrame(rows, f"id long, a double, b double, team string, month int, flag double, bowl int, {Y} long").repartition(5)


FS = M.FeatureSet(["a", "b"], ["team", "month"], ["flag"])


def test_moments_merge_exactly():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(100, 4)) * [1, 1e3, 1e-3, 1] + [1e6, 0, 5, -1e8]
    merged = total([Moments.unpack(Moments.of(p).pack()) for p in np.array_split(x, 7)])
    whole = Moments.of(x)
    assert merged.n == 100 and np.allclose(merged.mean, whole.mean, rtol=1e-14)
    assert np.allclose(merged.m2, whole.m2, rtol=1e-6, atol=1e-6)      # the means themselves are known to 1e-8
    a = rng.normal(size=(2, 4))
    assert np.allclose(whole.mapped(a).m2, Moments.of(x @ a.T).m2, rtol=1e-6)


@pytest.mark.parametrize("fill,degree", [("mean", 1), ("zero", 1), ("zero", 2)])
def test_ridge_equals_the_pipeline_fit(data, fill, degree):
    fit = L.fit_ridge(data, Design.of(data, FS, fill, degree), 3.0)
    model = M.fit_ridge(data, FS, 3.0, degree=degree, impute_numeric=fill)
    old = {r["id"]: r["prediction"] for r in M.scored(model, data).select("id", "prediction").collect()}
    new = {r["id"]: r["prediction"] for r in fit.predict(data).collect()}
    assert old.keys() == new.keys()
    assert max(abs(old[i] - new[i]) for i in old) < 1e-5
    if degree == 1:
        names = [M.plain_name(n) for n in M.feature_names(model, model.transform(data.limit(1)))]
        assert np.allclose(model.stages[-1].coefficients.toArray(), [dict(zip(fit.design.names, fit.scaled_coef))[n] for n in names], atol=1e-6)


def test_errors_from_moments_are_those_of_the_rows(data):
    design = Design.of(data, FS, "mean")
    fit = L.fit_ridge(data, design, 1.0)
    raw = moments(prepared(data, design, Y), design)[0]
    sse = fit.predict(data).agg(F.sum(F.pow(F.col(Y) - F.col("prediction"), 2))).first()[0]
    assert abs(fit.sse(raw) - sse) < 1e-6 * sse


def test_kfold_and_search_equal_one_fit_a_fold(data):
    folded = splits.kfold_assign(data, ["id"], 4, 42)
    got = L.kfold(folded, Design.of(data, FS, "mean"), 2.0, F.col("fold"), 4).collect()
    want = splits.kfold_scores(folded.where(F.col(Y).isNotNull()), lambda t: M.fit_ridge(t, FS, 2.0), 4).collect()
    for g, w in zip(got, want):
        assert (g["fold"], g["n"]) == (w["fold"], w["n"])
        assert abs(g["rmse"] - w["rmse"]) < 1e-6 and abs(g["train_rmse"] - w["train_rmse"]) < 1e-6
    table, best = L.search(folded, Design.of(data, FS, "zero"), [0.5, 50.0, 5000.0], F.col("fold"))
    old, setting, _ = splits.random_search(folded.where(F.col(Y).isNotNull()), lambda t, p: M.fit_ridge(t, FS, p["alpha"], impute_numeric="zero"),
                                           [{"alpha": a} for a in (0.5, 50.0, 5000.0)], 4)
    assert np.allclose([r["mean_mse"] for r in table.collect()], [r["mean_mse"] for r in old.orderBy("candidate").collect()], rtol=1e-7)
    assert best.alpha == setting["alpha"]


def poisson_rows(spark, data):
    """With folds, some rows in none, and a team and a constant that only one fold has."""
    rows = data.withColumn("fold", F.when(F.col("id") % 17 != 0, (F.col("id") % 3).cast("int")))
    return (rows.withColumn("team", F.when((F.col("fold") == 1) & (F.col("id") % 5 == 0), "only here").otherwise(F.col("team")))
                .withColumn("c", F.when(F.col("fold") == 2, F.col("id") / 100.0).otherwise(4.0)))


def test_poisson_search_equals_one_fit_a_setting_and_fold(spark, data):
    rows = poisson_rows(spark, data)
    fs = M.FeatureSet(["a", "b", "c"], ["team", "month"], ["flag"])
    settings = [{"alpha": a, "degree": g} for a, g in ((0.3, 2), (800.0, 2), (0.002, 1), (800.0, 1), (1.0, 2))]
    new, best, model = splits.random_search(rows, L.PoissonFits(fs), settings, 3)
    old, setting, pipeline = splits.random_search(rows, lambda t, p: M.fit_poisson(t, fs, p["alpha"], degree=p["degree"]), settings, 3)
    new, old = new.orderBy("candidate").collect(), old.orderBy("candidate").collect()
    assert new[0].asDict().keys() == old[0].asDict().keys() and [r[:3] for r in new] == [r[:3] for r in old]
    assert [r["best"] for r in new] == [r["best"] for r in old] and best == setting and sum(r["best"] for r in new) == 1
    for c in ("mean_mse", "std_mse"):       # with a column that is constant in a fold Spark ML solves by L-BFGS, to some 1e-6
        assert np.allclose([r[c] for r in new], [r[c] for r in old], rtol=1e-5)
    want = {r["id"]: r["prediction"] for r in M.scored(pipeline, rows).collect()}
    got = {r["id"]: r["prediction"] for r in model.predict(rows).collect()}         # the rows without a fold take part
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-5 * want[i] for i in want)


def test_poisson_search_reaches_the_optimum_of_weak_penalties(spark, data):
    """Far from the mean label the steps need the information anew."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 2)) * [3.0, 50.0]
    y = rng.poisson(np.exp(np.clip(0.9 * x[:, 0] + 0.02 * x[:, 1], -9, 7)))
    rows = spark.createDataFrame([(float(a), float(b), int(v), i % 2) for i, ((a, b), v) in enumerate(zip(x, y))], f"a double, b double, {Y} long, fold int")
    fit = splits.random_search(rows, L.PoissonFits(M.FeatureSet(["a", "b"])), [{"alpha": 1e-6, "degree": 2}], 2)[2]
    z = np.column_stack([x, x[:, 0] ** 2, x[:, 0] * x[:, 1], x[:, 1] ** 2])
    z = (z - z.mean(axis=0)) / z.std(axis=0)
    mu = np.array([r["prediction"] for r in fit.predict(rows).collect()])
    assert np.abs(z.T @ (y - mu) - 1e-6 * 400 * fit.scaled_coef).max() < 1e-6 * np.abs(z.T @ y).max() and abs((y - mu).sum()) < 1e-6 * y.sum()


def test_poisson_search_tells_what_it_cannot_fit(spark, data):
    rows, search = poisson_rows(spark, data), L.PoissonFits(FS)
    for bad in ({"alpha": 1.0, "degree": 3}, {"alpha": 0.0, "degree": 1}):
        with pytest.raises(ValueError, match="degree"):
            splits.random_search(rows, search, [bad], 3)
    with pytest.raises(ValueError, match="fold 3"):
        splits.random_search(rows, search, [{"alpha": 1.0, "degree": 1}], 4)
    with pytest.raises(ValueError, match="outside fold 0"):
        splits.random_search(rows.withColumn("fold", F.lit(0)), search, [{"alpha": 1.0, "degree": 1}], 1)
    with pytest.raises(Exception, match="labels of 0 or more"):
        splits.random_search(rows.withColumn(Y, F.col(Y) - 1), search, [{"alpha": 1.0, "degree": 1}], 3)


def test_poisson_search_query_shares_its_passes(spark, monkeypatch):
    """Ten settings on three folds and the refit: some jobs, not some for each fit."""
    from seatcast.plans import catalog_models as Q
    rng = np.random.default_rng(3)
    cols = [*C.POISSON_NUMERIC, *C.POISSON_PASSTHROUGH]
    keys = [c for c in Q.KEYS if c not in C.POISSON_CATEGORICAL]
    rows = [(*[f"{i}" for _ in keys], *map(float, rng.normal(size=len(cols))), i % 4, "RS"[i % 2], int(rng.poisson(2))) for i in range(300)]
    df = spark.createDataFrame(rows, ", ".join([*(f"{c} string" for c in keys), *(f"{c} double" for c in cols), "month int", "opponent string", f"{Y} long"]))
    monkeypatch.setattr(Q, "train", lambda spark, d: df)
    jobs = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs
    before = jobs()
    got = Q.q_random_search_poisson(spark, None)
    assert jobs() - before < 60
    assert got.count() == C.SEARCH_SETTINGS and got.where("best").count() == 1 and got.where("mean_mse is null").isEmpty()


def test_backtest_equals_one_fit_a_fold(spark):
    rng = np.random.default_rng(1)
    rows = [(f"2020-01-{d:02d}", float(rng.normal()), int(rng.poisson(3))) for d in range(1, 25) for _ in range(9)]
    df = spark.createDataFrame(rows, f"day string, a double, {Y} long").select(F.to_date("day").alias("calculate_date"), "a", Y)
    fs = M.FeatureSet(["a"])
    got = L.backtest(df, Design.of(df, fs, "mean"), 1.0, train_dates=10, valid_dates=4).collect()
    want = splits.backtest(df, lambda t, v: M.fit_ridge(t, fs, 1.0).transform(v), train_dates=10, valid_dates=4).collect()
    assert [r[:5] + (r["n"],) for r in got] == [r[:5] + (r["n"],) for r in want] and len(got) == 4
    assert np.allclose([r["rmse"] for r in got], [r["rmse"] for r in want], atol=1e-6)


def design_matrix(pdf, design):
    x = np.column_stack([pdf[c].fillna(0.0) for c in design.numeric])
    x = (x - x.mean(axis=0)) / x.std(axis=0)
    dummies = [np.array([str(u) == v for u in pdf[c]], float) for c, vs in design.categorical.items() for v in vs]
    return np.column_stack([np.ones(len(pdf)), x, *dummies, *[pdf[c] for c in design.passthrough]])


@pytest.mark.parametrize("drop_first", [True, False])
def test_poisson_summary_on_a_singular_design(data, drop_first):
    df = data.where("team is not null")
    design = Design.of(df, FS, drop_first=drop_first)       # with all dummies and a constant: dependent columns
    fit = L.fit_poisson(df, design)[0]
    pdf = df.where(F.col(Y).isNotNull()).toPandas()
    x, y = design_matrix(pdf, design), pdf[Y].to_numpy(float)
    b = np.concatenate([[fit.summary["constant"]], fit.scaled_coef])
    mu = np.exp(x @ b)
    assert np.abs(x.T @ (y - mu)).max() < 1e-5                                  # the maximum
    info = x.T @ (x * mu[:, None])
    inverse = np.linalg.pinv(info, rcond=1e-10, hermitian=True)
    assert np.allclose(fit.summary["std_error"], np.sqrt(np.diag(inverse)), rtol=1e-6)
    assert fit.summary["rank"] == np.linalg.matrix_rank(x) == 8
    null = np.eye(len(b)) - inverse @ info
    assert np.abs(null @ b).max() < 1e-6                                        # of least norm
    rows = L.summary_rows(fit)
    assert [r[0] for r in rows] == ["const", *design.names] and all(0 <= r[4] <= 1 for r in rows)


def test_segments_are_fitted_together_and_keep_every_row(data):
    design = Design.of(data, FS)
    fits = L.fit_poisson(data, design, 0.5, segment=F.col("bowl"))
    for k in (0, 1, 2):
        alone = L.fit_poisson(data.where(F.col("bowl") == k), design, 0.5)[0]
        assert np.allclose(fits[k].scaled_coef, alone.scaled_coef, atol=1e-7)
    more = data.withColumn("bowl", F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 10 == 1, 99).otherwise(F.col("bowl")))
    got = L.score_segments(more, fits, F.col("bowl"))
    assert got.count() == data.count() and got.where("prediction is null").isEmpty()
    want = {r["id"]: r["prediction"] for r in fits[2].predict(more.where("id % 10 < 2")).collect()}
    assert all(abs(r["prediction"] - want[r["id"]]) < 1e-9 for r in got.where("id % 10 < 2").collect())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan


def test_poisson_equals_the_pipeline_fit(data):
    df = data.where(F.col(Y).isNotNull())
    fit = L.fit_poisson(df, Design.of(df, FS), 1.0)[0]
    old = {r["id"]: r["prediction"] for r in M.scored(M.fit_poisson(df, FS, 1.0), df).collect()}
    assert all(abs(r["prediction"] - old[r["id"]]) < 1e-3 * old[r["id"]] for r in fit.predict(df).collect())


def test_scored_rows_keep_their_inputs(data):
    df = data.where(F.col(Y).isNotNull())
    m = M.fit_poisson(df, FS, 1.0)
    s = M.scored(m, df)
    assert s.columns == [*df.columns, "prediction"]
    assert s.drop("prediction").exceptAll(df).isEmpty()
    parts = M.fit_segmented(df, "bowl", lambda t: M.fit_poisson(t, FS, 1.0))
    both = {r["id"]: r for r in M.predict_batch(df, m, "bowl", parts).collect()}
    for r in s.collect():
        assert both[r["id"]]["predicted_poisson"] == r["prediction"] and both[r["id"]]["a"] == r["a"]
