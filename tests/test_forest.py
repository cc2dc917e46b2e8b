"""Random forest against trees grown again in plain Python."""

import hashlib
import math

import numpy as np
import pytest

from seatcast.operators import forest as R
from seatcast.operators import models as M
from seatcast.operators.gram import Design

NAMES = [f"a{i}" for i in range(4)]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(500, 4)), 1)
    y = np.round(np.exp(x[:, 0] / 2) * 4 + (x[:, 1] > 0) * 3 + rng.normal(size=500))
    rows = [(i, *(None if (i + j) % 40 == 0 else float(v) for j, v in enumerate(r)), "pqr"[i % 3], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{n} double" for n in NAMES) + ", team string, y double").repartition(3)


def weight(key, tree, seed):
    """Poisson(1) quantile of 16 bits of the md5, by the definition of its chances."""
    u = int(hashlib.md5(f"{key}|{seed}|{tree // 8}".encode()).hexdigest()[tree % 8 * 4:][:4], 16)
    total, k = 0.0, 0
    while k < 9:
        total += math.exp(-1) / math.factorial(k)
        if u < round(65536 * total):
            break
        k += 1
    return k


def regrown(bins, y, w, depth, least):
    """{node: (n, mean)} trying every column and cut of every node."""
    out = {}

    def grow(rows, node, level):
        n, total = w[rows].sum(), (w[rows] * y[rows]).sum()
        out[node] = (n, total / n)
        score = lambda r: (w[r] * y[r]).sum() ** 2 / w[r].sum()
        best, at = 1e-9, None
        for c in range(bins.shape[1]) if level < depth else ():
            for cut in np.unique(bins[rows, c]):
                left, right = rows[bins[rows, c] <= cut], rows[bins[rows, c] > cut]
                if w[left].sum() >= least and w[right].sum() >= least:
                    gain = score(left) + score(right) - score(rows)
                    if gain > best + 1e-7:
                        best, at = gain, (left, right)
        if at:
            grow(at[0], 2 * node + 1, level + 1)
            grow(at[1], 2 * node + 2, level + 1)

    grow(np.flatnonzero(w > 0), 0, 0)
    return out


def test_every_tree_can_be_grown_again(data):
    design = Design.of(data, M.FeatureSet(NAMES, ["team"]), "mean")
    model = R.fit(data, design, "y", ["id"], trees=10, depth=5, least=4.0, seed=42)
    pdf = model.predict(data).toPandas()
    x = np.column_stack([*(pdf[n].fillna(v) for n, v in zip(NAMES, model.fills)), *((pdf["team"] == t) * 1.0 for t in "pqr")])
    bins, y = model.bins(x), pdf["y"].to_numpy()
    for t in range(10):
        w = np.array([weight(k, t, 42) for k in pdf["id"]], float)
        want = regrown(bins, y, w, 5, 4.0)
        got = {i: (v.n, v.mean) for i, v in model.grown[t].items()}
        assert got.keys() == want.keys()
        assert all(np.allclose(got[i], want[i]) for i in got)
        leaves = [v for v in model.grown[t].values() if v.column < 0]
        assert sum(v.n for v in leaves) == w.sum() and min(v.n for v in leaves) >= 4
    assert ((pdf["prediction"] - y) ** 2).mean() < 0.4 * y.var()


def test_the_spread_of_rows_and_groups_of_trees_change_nothing(data, monkeypatch):
    design = Design.of(data, M.FeatureSet(NAMES, ["team"]), "mean")
    one = R.fit(data, design, "y", ["id"], trees=3, depth=4).nodes()
    monkeypatch.setattr(R, "TREES_AT_ONCE", 2)
    assert R.fit(data, design, "y", ["id"], trees=3, depth=4, tasks=1).nodes() == one
    assert R.fit(data, design, "y", ["id"], trees=3, depth=4, seed=1).nodes() != one


def test_weights_are_poisson():
    w = R.weights([str(i) for i in range(4000)], 20, 42)
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.03 and abs((w == 0).mean() - math.exp(-1)) < 0.01


def test_constant_label_empty_column_and_empty_table(spark):
    df = spark.createDataFrame([(i, float(i), None, 5.0) for i in range(30)], "id long, a double, b double, y double")
    m = R.fit(df, Design(("a", "b")), "y", ["id"], trees=2, depth=3)
    assert {r["prediction"] for r in m.predict(df).collect()} == {5.0} and all(len(t) == 1 for t in m.grown)
    none = R.fit(df.where("id < 0"), Design(("a", "b")), "y", ["id"], trees=2, depth=3)
    assert {r["prediction"] for r in none.predict(df).collect()} == {0.0}
