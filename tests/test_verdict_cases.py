"""Rows and values that must not get lost: CSV by name, segments without a
model, codes without a price range, zero predictions, constant labels."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from seatcast import constants as C
from seatcast import schemas
from seatcast.operators import aggregates as A
from seatcast.operators import clean, features, joins, splits, whatif
from seatcast.operators import models as M
from seatcast.sources import files

TARGET = C.TARGET


def test_csv_columns_line_up_by_name(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,a\n20,10\n")
    (tmp_path / "3.csv").write_text("a,other\n100,x\n")
    (tmp_path / "4.csv").write_text("")
    got = files.scan_csv_glob(spark, str(tmp_path / "*.csv"), spark.createDataFrame([], "a int, b int").schema)
    assert sorted((r["a"], r["b"]) for r in got.collect()) == [(1, 2), (10, 20), (100, None)]


def test_csv_bad_fields_stop_the_read(spark, tmp_path):
    (tmp_path / "1.csv").write_text("d,n\n03/05/2024,x\n")
    schema = spark.createDataFrame([], "d date, n int").schema
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|parse"):
        files.scan_csv_glob(spark, str(tmp_path), schema).collect()


def test_raw_ingest_renames_parses_and_rejects(spark):
    raw = spark.createDataFrame([("e1", "03/05/2024", "7", "0.5"), (None, "03/06/2024", "1", "0.1")],
                                "event_id string, calculate_date string, `host_sold-yesterday` string, `s/t-rate` string")
    good, rejected = files.ingest_raw(raw)
    assert good.collect() == [("e1", dt.date(2024, 3, 5), 7, 0.5)]
    assert dict(good.dtypes) == {"event_id": "string", "calculate_date": "date", "host_sold_yesterday": "bigint", "st_rate": "double"}
    assert rejected.first()[0] == 1


def test_segments_without_a_model_are_scored(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 10.0), (1, 20.0)], f"bowl int, {TARGET} double").withColumn("k", F.lit("a"))
    models_ = M.fit_segmented(df, "bowl", lambda t: M.fit_ols(t.withColumn("x", F.rand(1)), M.FeatureSet(["x"])))
    rows = spark.createDataFrame([(0, 0.0), (1, 0.0), (2, 0.0), (None, 0.0)], "bowl int, x double")
    got = M.score_segmented(rows, "bowl", models_).collect()
    assert len(got) == 4
    by = {r["bowl"]: r["prediction"] for r in got}
    assert by[2] == by[None] == by[1] != by[0]


def test_codes_without_a_range_keep_their_curve(spark):
    rows = spark.createDataFrame([("A", 5.0), ("Z", 7.0), (None, 9.0)], "price_code string, last_price double")
    reference = spark.createDataFrame([("A", 1.0), ("A", 4.0)], "price_code string, last_price double")
    got = whatif.demand_curve_price(rows, whatif.linear_scorer({"last_price": 1.0}), reference, 3, ["price_code"])
    by = {}
    for r in got.collect():
        by.setdefault(r["price_code"], set()).add(r["last_price"])
    assert got.count() == 9 and by == {"A": {1.0, 2.5, 4.0}, "Z": {7.0}, None: {9.0}}


def test_nb_loss_counts_every_row(spark):
    rows = [(0, 0.0), (2, 1.5), (5, 4.0)]
    df = spark.createDataFrame(rows, "y int, mu double")
    for a in (1.0, 2.5):
        want = -np.mean([math.lgamma(y + a) - math.lgamma(a) - math.lgamma(y + 1) + a * math.log(a / (a + m))
                         + (y * math.log(m / (a + m)) if y else 0) for y, m in rows])
        assert A.nb_log_loss(df, "y", "mu", a).first()[0] == pytest.approx(want, abs=1e-9)
    assert A.nb_log_loss(spark.createDataFrame([(1, 0.0)], "y int, mu double"), "y", "mu").first()[0] == math.inf


def test_r2_does_not_cancel(spark):
    big = spark.createDataFrame([(1e9 + i, 1e9 + i + 0.5) for i in range(4)], "y double, p double")
    assert A.regression_metrics(big, "y", "p").first()["r2"] == pytest.approx(1 - 0.25 * 4 / 5)
    flat = spark.createDataFrame([(3.0, 2.0), (3.0, 4.0)], "y double, p double")
    r = A.regression_metrics(flat, "y", "p").first()
    assert r["r2"] is None and r["rmse"] == 1.0


def test_one_hot_unknown_and_null_are_zeros(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "t string")
    enc = M.Pipeline(stages=M.encode_stages(M.FeatureSet([], ["t"]))).fit(train)
    got = enc.transform(spark.createDataFrame([("b",), ("zz",), (None,)], "t string")).collect()
    assert [list(r["features"].toArray()) for r in got] == [[0, 1, 0], [0, 0, 0], [0, 0, 0]]


def test_polynomial_terms_have_population_scale(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (4.0, 7.0)], "x double, y double")
    out = M.Pipeline(stages=M.encode_stages(M.FeatureSet(["x", "y"]), 2, True, rows=3)).fit(df).transform(df)
    v = np.array([r["features"].toArray() for r in out.collect()])
    assert np.allclose(v.mean(0), 0) and np.allclose(v.std(0), 1)


def test_missing_features_are_an_error(spark):
    df = spark.createDataFrame([(1.0, 2.0)], f"x double, {TARGET} double")
    with pytest.raises(ValueError, match="gone"):
        M.fit_ols(df, M.FeatureSet(["x", "gone"]))


def test_group_means_and_unpenalised_totals(spark):
    rng = np.random.default_rng(0)
    rows = [(t, float(x), int(rng.poisson(np.exp(0.2 * x) + 3 * (t == "b")))) for t in "abc" for x in rng.normal(size=60)]
    df = spark.createDataFrame(rows, f"team string, x double, {TARGET} int")
    mean = {r["team"]: r["m"] for r in df.groupBy("team").agg(F.avg(TARGET).alias("m")).collect()}
    for r in M.fit_group_means(df, ["team"]).transform(df).select("team", "prediction").distinct().collect():
        assert r["prediction"] == pytest.approx(mean[r["team"]], abs=1e-5)
    s = M.fit_poisson_unpenalized(df, M.FeatureSet(["x"], ["team"])).transform(df)
    for r in s.groupBy("team").agg(F.sum("prediction").alias("p"), F.sum(TARGET).alias("y")).collect():
        assert r["p"] == pytest.approx(r["y"], abs=1e-3)


@pytest.mark.parametrize("n", [1, 7, 500])
def test_quantiles_with_hot_values(spark, n):
    rng = np.random.default_rng(n)
    values = np.where(rng.random(n) < 0.4, 3.0, rng.normal(size=n).round(2))
    df = spark.createDataFrame([(float(v), "g" if i % 3 else None) for i, v in enumerate(values)], "v double, k string")
    got = A.exact_quantiles(df, [], "v", [0.05, 0.5, 0.95], ["a", "b", "c"]).first()
    assert list(got) == pytest.approx(list(np.quantile(values, [0.05, 0.5, 0.95])))
    for r in A.exact_quantiles(df, ["k"], "v", [0.25, 0.5], ["a", "b"]).collect():
        own = [v for i, v in enumerate(values) if (i % 3 != 0) == (r["k"] is not None)]
        assert [r["a"], r["b"]] == pytest.approx(list(np.quantile(own, [0.25, 0.5])))


def test_correlations_with_gaps_and_constants(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(80, 3)) + 1e6
    rows = [(float(a), float(a + b), None if i % 5 == 0 else float(c), 2.0) for i, (a, b, c) in enumerate(x)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = {(r["feature_1"], r["feature_2"]): r["correlation"] for r in A.corr_matrix(df, ["a", "b", "c", "d"]).collect()}
    full = np.array([[math.nan if v is None else v for v in r] for r in rows])
    for i, p in enumerate("abc"):
        for j, q in enumerate("abc"):
            ok = ~np.isnan(full[:, i]) & ~np.isnan(full[:, j])
            assert got[p, q] == pytest.approx(np.corrcoef(full[ok, i], full[ok, j])[0, 1], abs=1e-6)
    assert got["a", "d"] is None and got["d", "d"] == 1.0


def test_residual_outliers_of_one_event(spark):
    df = spark.createDataFrame([("e", float(i % 10), 0.0) for i in range(100)] + [("e", 999.0, 0.0), ("f", -999.0, 0.0)],
                               "event_id string, y double, p double")
    marked = lambda **k: {(r["event_id"], r["residuals"]) for r in A.residual_outliers(df, "y", "p", **k).where("is_outlier").collect()}
    assert marked() == {("e", 999.0), ("f", -999.0)} and marked(event_id="e") == {("e", 999.0)}


def test_rank_fill_modes(spark):
    d = lambda n: dt.date(2024, 1, n)
    fact = spark.createDataFrame([(d(n),) for n in (1, 2, 3, 4)], "calculate_date date")
    ranks = spark.createDataFrame([(d(2), 5), (d(4), 7)], "rank_date date, van_rank int")
    got = lambda m: [r["van_rank"] for r in joins.join_ranking_asof(fact, ranks, mode=m).orderBy("calculate_date").collect()]
    assert got("fill") == [5, 5, 5, 7] and got("ffill") == [None, 5, 5, 7]


def test_cast_drop_takes_the_housekeeping_columns(spark):
    cols = ", ".join(f"{c} string" for c in schemas.HOUSEKEEPING_COLUMNS)
    df = spark.createDataFrame([("e", 3.0, *["x"] * len(schemas.HOUSEKEEPING_COLUMNS))], f"event_id string, ticket_sold_total double, {cols}")
    got = clean.cast_drop(df)
    assert got.dtypes == [("event_id", "string"), ("ticket_sold_total", "bigint")]


def test_random_search_returns_the_best_model(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(float(x), float(3 * x + rng.normal() / 10), i) for i, x in enumerate(rng.normal(size=120))],
                               f"x double, {TARGET} double, i int")
    df = splits.kfold_assign(df, ["i"], 3)
    fit = lambda t, p: M.fit_ridge(t, M.FeatureSet(["x"]), p["alpha"])
    table, best, model = splits.random_search(df, fit, [{"alpha": 1e4}, {"alpha": 0.1}, {"alpha": 50.0}], 3)
    assert best == {"alpha": 0.1} and [r["candidate"] for r in table.where("best").collect()] == [1]
    assert table.count() == 3 and model.transform(df).count() == 120


def test_latest_day_plan_equals_the_full_one(spark):
    """Only the events of the last day are windowed, with the same result."""
    from seatcast.plans import pipelines as P
    rows = []
    for e, last in (("e1", 9), ("e2", 12), ("e3", 12)):
        for n in range(1, last + 1):
            for code in "AB":
                rows.append((e, "Home vs. X", f"EVT_{dt.date(2024, 1, 31):%a_%b_%-d_%Y}_1", f"Level {code}", dt.date(2024, 1, n),
                             10, 5, 1.0, 2.0, n * len(e) + ord(code), 7.0))
    df = spark.createDataFrame(rows, "event_id string, event_name string, identifier string, price_level_name string, "
                                     "calculate_date date, cap long, pminventory long, initial_price double, last_price double, "
                                     "host_sold_yesterday long, ticket_sold_total double")
    pop = spark.createDataFrame([("X", 2)], "data_name string, opponent_rank int")
    ranks = spark.createDataFrame([(dt.date(2024, 1, 8), 4)], "rank_date date, van_rank int")
    web = spark.createDataFrame([], schemas.WEB_ANALYTICS)
    p = P.PreprocessParams(start_date="2020-01-01", excluded_events=(), preseason_ranges=(), home_prefix="Home", training=False)
    full = clean.latest_snapshot(P.feature_engineer(P.preprocess(df, p), pop, ranks, web))
    got = P.latest_features(df, pop, ranks, web, p)
    key = lambda d: sorted(map(str, d.select(sorted(d.columns)).collect()))
    assert key(got) == key(full) and got.count() == 4 and features is not None
