"""Aggregates and metrics against numpy / closed forms."""

import math
import random

import numpy as np

from seatcast.operators import aggregates as A
from seatcast.operators import splits


def test_exact_quantiles_match_numpy(spark):
    rnd = random.Random(3)
    data = [(g, float(rnd.randint(0, 40))) for g in "abc" for _ in range(rnd.randint(5, 60))]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r["g"]: (r["q1"], r["med"], r["q9"]) for r in
           A.exact_quantiles(df, ["g"], "v", [0.1, 0.5, 0.9], ["q1", "med", "q9"]).collect()}
    for g in "abc":
        vals = np.array([v for k, v in data if k == g])
        exp = tuple(np.percentile(vals, [10, 50, 90]))
        assert np.allclose(got[g], exp), g


def test_box_stats_whiskers(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([("x", v) for v in vals], "price_code string, last_price double")
    r = A.box_stats(df).first()
    q1, q3 = np.percentile(vals, [25, 75])
    assert (r["q1"], r["q3"]) == (q1, q3)
    assert r["lower_whisker"] == 1.0 and r["upper_whisker"] == 4.0


def test_corr_matrix_pairwise_complete(spark):
    data = [(1.0, 2.0, None), (2.0, 4.1, 1.0), (3.0, 6.2, 0.0), (4.0, 7.9, 1.0), (5.0, 10.0, 3.0)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    got = {(r["feature_1"], r["feature_2"]): r["correlation"] for r in A.corr_matrix(df, ["a", "b", "c"]).collect()}
    a, b = np.array([d[0] for d in data]), np.array([d[1] for d in data])
    assert math.isclose(got[("a", "b")], np.corrcoef(a, b)[0, 1])
    assert got[("b", "a")] == got[("a", "b")] and got[("c", "c")] == 1.0
    sub = A.high_corr_pairs(A.corr_matrix(df, ["a", "b", "c"]), 0.8)
    assert {r["feature_1"] for r in sub.collect()} == {"a", "b"}


def test_nb_log_loss_against_lgamma(spark):
    data = [(0.0, 0.5), (3.0, 2.0), (7.0, 6.5)]
    df = spark.createDataFrame(data, "y double, mu double")
    for alpha in (1, 2):
        got = A.nb_log_loss(df, "y", "mu", alpha).first()[0]
        ll = [math.lgamma(y + alpha) - math.lgamma(alpha) - math.lgamma(y + 1)
              + alpha * math.log(alpha / (alpha + mu)) + y * math.log(mu / (alpha + mu)) for y, mu in data]
        assert math.isclose(got, -sum(ll) / len(ll), rel_tol=1e-12)


def test_nb_log_loss_query_counts_its_rows_in_the_same_pass(spark, monkeypatch):
    """The count takes no job of its own, and counts the rows without a label too."""
    from seatcast import constants as C
    from seatcast.plans import catalog_reports as R
    data = [(0, 0.0), (3, 2.0), (7, 6.5), (None, 1.0), (3, 2.0)]
    df = spark.createDataFrame(data, f"{C.TARGET} long, prediction double")
    monkeypatch.setattr(R, "scored", lambda spark, d: df)
    spark.sparkContext.setJobGroup("nb_log_loss_built", "")
    try:
        out = R.q_nb_log_loss(spark, "")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("nb_log_loss_built")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    a, ll = 1.5, []
    for y, p in data:
        if y is not None:
            mu = p + (0.5 if y > 0 else 0.0)
            ll.append(math.lgamma(y + a) - math.lgamma(a) - math.lgamma(y + 1) + a * math.log(a / (a + mu))
                      + (y * math.log(mu / (a + mu)) if y else 0.0))
    got = out.first()
    assert out.columns == ["nb_loss", "n"] and got["n"] == len(data)
    assert math.isclose(got["nb_loss"], -sum(ll) / len(ll), rel_tol=1e-9)
    assert R.q_nb_log_loss(spark, "").schema["n"].dataType.typeName() == "long"


def test_metrics_batch_rmse_and_summary(spark):
    data = [(1, 1.0, 2.0), (1, 2.0, 2.0), (2, 5.0, 1.0)]
    df = spark.createDataFrame(data, "b int, y double, p double")
    m = A.regression_metrics(df, "y", "p").first()
    y, p = np.array([1.0, 2.0, 5.0]), np.array([2.0, 2.0, 1.0])
    assert math.isclose(m["rmse"], float(np.sqrt(np.mean((y - p) ** 2))))
    assert math.isclose(m["r2"], 1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))
    br = A.batch_rmse(df, "y", "p", "b").first()["batch_rmse"]
    assert math.isclose(br, (math.sqrt(0.5) + 4.0) / 2)
    s = A.score_summary(spark.createDataFrame([(1.0,), (3.0,)], "rmse double")).first()
    assert (s["mean_score"], s["std_score"]) == (2.0, 1.0)   # population std


def test_expanding_folds_edges(spark):
    import datetime as dt
    dates = [(dt.date(2024, 1, 1) + dt.timedelta(days=2 * i),) for i in range(10)]
    df = spark.createDataFrame(dates, "calculate_date date")
    f = splits.expanding_folds(df, 4, 4).orderBy("fold").collect()
    assert [(r["fold"], r["train_to"], r["valid_from"], r["valid_to"]) for r in f] == [
        (0, dates[3][0], dates[4][0], dates[7][0]), (1, dates[7][0], dates[8][0], dates[9][0])]
    assert all(r["train_from"] == dates[0][0] for r in f)
    assert splits.expanding_folds(df, 20, 4).count() == 0


def test_correlations_where_a_column_is_constant_in_a_pairs_rows(spark):
    """``flag`` is constant wherever ``rare`` is known, in every batch and task."""
    rows = [(float(i % 2), float(i) if i % 2 == 0 else None, float(i * i)) for i in range(400)]
    df = spark.createDataFrame(rows, "flag double, rare double, x double").repartition(7)
    got = {(r[0], r[1]): r[2] for r in A.corr_matrix(df, ["flag", "rare", "x"]).collect()}
    assert got["flag", "rare"] is None and got["rare", "flag"] is None and got["flag", "flag"] == 1
    import numpy as np
    x = np.arange(0, 400, 2.0)
    assert abs(got["rare", "x"] - np.corrcoef(x, x * x)[0, 1]) < 1e-12
