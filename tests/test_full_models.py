"""Queries over the full-feature models."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import SMOKE_DIR, queries
from seatcast import constants as C
from seatcast.plans import catalog_models as Q


@pytest.fixture(scope="module")
def run(spark):
    return lambda name: queries()[name](spark, SMOKE_DIR)


@pytest.mark.parametrize("name", ["demand_curve_model", "demand_curve_sequence"])
def test_curves_depend_on_the_price(run, name):
    got = run(name).groupBy(*Q.KEYS).agg(F.count("prediction").alias("n"), F.countDistinct("prediction").alias("different")).collect()
    assert got and all(r["n"] == r["different"] == C.PRICE_GRID_POINTS for r in got)


def test_coefficients_of_every_feature(run):
    got = {r["feature"] for r in run("coef_table").collect()}
    for f in (*C.POISSON_NUMERIC, *C.POISSON_PASSTHROUGH):
        assert f in got
    for c in C.POISSON_CATEGORICAL:
        assert any(f.startswith(f"{c}_") for f in got)


def test_predictions_differ_within_an_opponent(spark):
    """On sf0.01: the last day of sf0.001 has a single row."""
    got = queries()["predict_batch"](spark, SMOKE_DIR.replace("sf0.001", "sf0.01"))
    assert got.select("opponent", "predicted_poisson").distinct().count() > got.select("opponent").distinct().count()
    assert got.where("predicted_segmented is null or predicted_poisson is null").isEmpty()


def test_results_and_persistence(run, spark):
    results, loaded = run("results_join"), run("model_persistence")
    n = Q.train_test(spark, SMOKE_DIR)[1].count()
    assert n and results.count() == loaded.count() == n
    assert loaded.where("not same or same is null").isEmpty()
    assert results.select("y_pred").distinct().count() > n // 2


def test_batch_predictions_are_the_bare_models(run, spark):
    want = Q.full_poisson(spark, SMOKE_DIR).predict(Q.latest(spark, SMOKE_DIR)).collect()
    key = lambda r: (r["event_name"], r["price_code"], r["host_sold_yesterday"])
    want = {key(r): (r["prediction"], r["last_price"]) for r in want}
    got = {key(r): (r["predicted_poisson"], r["last_price"]) for r in run("predict_batch").collect()}
    assert got.keys() == want.keys()
    for k, (p, price) in got.items():
        assert abs(p - want[k][0]) < 1e-9 * abs(p) and price == want[k][1]


def test_glm_summaries_have_errors_for_every_coefficient(run):
    for name in ("poisson_glm_unpenalized", "glm_summary"):
        rows = run(name).collect()
        assert rows[0]["feature"] == "const" and len(rows) > len(C.POISSON_NUMERIC)
        assert all(r["std_error"] is not None for r in rows) and any(r["p_value"] is not None for r in rows)
