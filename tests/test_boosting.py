"""Histogram boosting against trees grown in plain numpy."""

import numpy as np
import pytest

from seatcast.operators import boosting as B
from seatcast.operators import models as M
from seatcast.operators.gram import Design

NAMES = [f"a{i}" for i in range(6)]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(900, 6)), 1)
    y = np.round(np.exp(x[:, 0] / 2) * 4 + (x[:, 1] > 0) * 3 + rng.normal(size=900))
    rows = [(*(None if (i + j) % 40 == 0 else float(v) for j, v in enumerate(r)), "pqr"[i % 3], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in NAMES) + ", team string, y double").repartition(3)


def grown(bins, y, base, rounds, depth, rate, share, seed, l2, least):
    """Predictions, tree by tree, splitting each node by trying every column and cut."""
    p = np.full(len(y), base)
    for t in range(rounds):
        columns = B.drawn_columns(bins.shape[1], share, seed, t)
        g = p - y
        step = np.zeros(len(y))

        def grow(rows, level):
            if level == depth:
                step[rows] = -rate * g[rows].sum() / (len(rows) + l2)
                return
            score = lambda r: g[r].sum() ** 2 / (len(r) + l2)
            best, at = 1e-12, None
            for c in columns:
                for cut in range(B.BINS - 1):
                    left, right = rows[bins[rows, c] <= cut], rows[bins[rows, c] > cut]
                    if len(left) >= least and len(right) >= least:
                        gain = score(left) + score(right) - score(rows)
                        if gain > best + 1e-9:
                            best, at = gain, (left, right)
            if at is None:
                step[rows] = -rate * g[rows].sum() / (len(rows) + l2)
            else:
                grow(at[0], level + 1)
                grow(at[1], level + 1)

        grow(np.arange(len(y)), 0)
        p = p + step
    return p


def test_trees_equal_those_grown_in_numpy(data):
    design = Design.of(data, M.FeatureSet(NAMES, ["team"]), "mean")
    how = dict(depth=3, rate=0.3, share=0.5, seed=7, l2=1.0, least=2.0)
    model = B.fit(data, design, "y", 4, **how)
    pdf = model.predict(data).toPandas()
    other = B.fit(data, design, "y", 4, **how, tasks=1).predict(data).toPandas()         # however rows are spread
    assert np.allclose(sorted(pdf["prediction"]), sorted(other["prediction"]), atol=1e-9)
    x = np.column_stack([*(pdf[n].fillna(v) for n, v in zip(NAMES, model.fills)), *((pdf["team"] == t) * 1.0 for t in "pqr")])
    want = grown(model.bins(x), pdf["y"].to_numpy(), pdf["y"].mean(), 4, 3, 0.3, 0.5, 7, 1.0, 2.0)
    assert np.allclose(pdf["prediction"], want, atol=1e-9)


def test_more_trees_fit_better_and_one_tree_has_one_draw(data):
    design = Design.of(data, M.FeatureSet(NAMES, ["team"]))
    model = B.fit(data, design, "y", 60, rate=0.2, share=0.3, seed=1, tasks=2)
    pdf = model.predict(data).toPandas()
    assert ((pdf["prediction"] - pdf["y"]) ** 2).mean() < 0.35 * pdf["y"].var()
    for t, tree in enumerate(model.trees):
        used = set(tree.column[tree.cut < 255])
        assert used <= set(B.drawn_columns(len(model.edges), 0.3, 1, t)) and len(B.drawn_columns(len(model.edges), 0.3, 1, t)) == 2


def test_one_constant_label_and_an_empty_column(spark):
    df = spark.createDataFrame([(1.0, None, 5.0), (2.0, None, 5.0)], "a double, b double, y double")
    m = B.fit(df, Design(("a", "b")), "y", 2, tasks=2)
    assert [r["prediction"] for r in m.predict(df).collect()] == [5.0, 5.0]


def test_a_worker_catches_up_from_shared_and_latest_trees():
    from types import SimpleNamespace
    rng = np.random.default_rng(5)
    bins = rng.integers(0, B.BINS, (50, 4)).astype(np.uint8)
    trees = [B.Tree(rng.integers(0, 4, 3), rng.integers(0, B.BINS, 3), rng.normal(size=4)) for _ in range(2 * B.SHARED_AT_ONCE + 5)]
    shared = [SimpleNamespace(value=trees[i:i + B.SHARED_AT_ONCE]) for i in (0, B.SHARED_AT_ONCE)]
    want = lambda n: 1.5 + sum(t.predict(bins) for t in trees[:n])
    n = B.SHARED_AT_ONCE - 2
    assert np.allclose(B._predictions("a", 0, bins, 1.5, (), trees[:n]), want(n))
    for run in ("a", "b"):              # one that has kept some of them, and one that has none
        got = B._predictions(run, 0, bins, 1.5, tuple(shared), trees[2 * B.SHARED_AT_ONCE:])
        assert np.allclose(got, want(len(trees)))
