"""Histogram gradient boosting for squared error (survey 2.9).

Features are cut into at most ``BINS`` bins once, at quantiles of all rows, and
the binned rows are stored.  Every tree draws one sample of the columns (as
``colsample_bytree`` does; Spark's own trees draw anew at every node).  A tree
grows level by level; each level is one aggregate over the stored rows: tasks
add up gradients and rows by node, drawn column and bin, and each node takes the
best split of the sums.  Leaves are Newton steps ``-G / (H + l2)`` times the
learning rate.

A task needs the predictions of the trees so far.  Between jobs it keeps them in
its worker with the number of trees they hold, and adds the trees it lacks, so a
lost executor or a retried task only works out its own rows again.  A job carries
the latest trees only; older ones are broadcast, ``SHARED_AT_ONCE`` at a time, and
are fetched only by a worker that lacks them.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatcast.operators.gram import Design, prepared

BINS = 64
KEPT_PARTS = 8                    # partitions whose predictions a worker keeps
SHARED_AT_ONCE = 32
_KEPT: OrderedDict = OrderedDict()


@dataclass
class Tree:
    """A tree of fixed depth: node i has children 2i + 1 and 2i + 2; a node without a split sends all rows left."""
    column: np.ndarray
    cut: np.ndarray               # to the right if the bin is greater
    leaf: np.ndarray

    @property
    def depth(self) -> int:
        return int(np.log2(len(self.leaf)))

    def place(self, bins: np.ndarray, depth: int) -> np.ndarray:
        rows, at = np.arange(len(bins)), np.zeros(len(bins), np.int64)
        for _ in range(depth):
            at = 2 * at + 1 + (bins[rows, self.column[at]] > self.cut[at])
        return at

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return self.leaf[self.place(bins, self.depth) - (len(self.leaf) - 1)]


@dataclass
class Boosted:
    design: Design
    edges: list[np.ndarray]
    base: float
    fills: np.ndarray             # what NULL counts as in each numeric column
    trees: list[Tree] = field(default_factory=list)

    def numbers(self, batch: pa.RecordBatch, at: int = 0) -> np.ndarray:
        x, d, k = self.design.matrix(batch, at), len(self.design.names), len(self.fills)
        if self.design.fill == "mean":           # its last columns mark the NULLs
            x[:, :k] += x[:, d:] * self.fills
        return x[:, :d]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "left") for k, e in enumerate(self.edges)], axis=1).astype(np.uint8)

    def values(self, x: np.ndarray) -> np.ndarray:
        b, out = self.bins(x), np.full(len(x), self.base)
        for t in self.trees:
            out += t.predict(b)
        return out

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self)

        @F.arrow_udf("double")
        def of(*columns: pa.Array) -> pa.Array:
            m = shared.value
            batch = pa.RecordBatch.from_arrays(list(columns), names=[str(i) for i in range(len(columns))])
            return pa.array(m.values(m.numbers(batch)))

        return df.withColumn(out, of(*self.design.columns()))


def bin_edges(rows: DataFrame, design: Design, bins: int, fills: np.ndarray) -> list[np.ndarray]:
    """Up to ``bins`` - 1 cuts of every design column: quantiles of a numeric
    column (NULL counts as its fill value), 0.5 for a dummy."""
    n = len(design.numeric)
    marks = [i / bins for i in range(1, bins)]
    wanted = [*(f"x{i}" for i in range(n)), *(f"p{i}" for i in range(len(design.passthrough)))]
    filled = {c: F.coalesce(c, F.lit(float(fills[i]) if i < n else 0.0)) for i, c in enumerate(wanted)}
    got = rows.agg(*[F.percentile_approx(e, marks, 10 * bins).alias(c) for c, e in filled.items()],
                   *[F.max(e).alias(f"max_{c}") for c, e in filled.items()]).first()      # one row

    def cuts(c):
        edges = np.unique(np.array(got[c] or [], float))
        return edges[edges < got[f"max_{c}"]] if len(edges) else edges

    dummies = [np.array([0.5])] * sum(len(v) for v in design.categorical.values())
    return [*(cuts(f"x{i}") for i in range(n)), *dummies, *(cuts(f"p{i}") for i in range(len(design.passthrough)))]


def best_split(g: np.ndarray, h: np.ndarray, l2: float, least: float) -> tuple[float, int, int]:
    """(gain, column, cut) of a node from its (columns, bins) sums; the first of equals."""
    gl, hl = g.cumsum(axis=1), h.cumsum(axis=1)
    ga, ha = gl[:, -1:], hl[:, -1:]
    gain = gl ** 2 / (hl + l2) + (ga - gl) ** 2 / (ha - hl + l2) - ga ** 2 / (ha + l2)
    gain[(hl < least) | (ha - hl < least)] = -np.inf
    at = int(gain.argmax())
    return float(gain.ravel()[at]), *divmod(at, g.shape[1])


def drawn_columns(n: int, share: float, seed: int, tree: int) -> np.ndarray:
    """The columns of one tree: the same wherever it is grown."""
    return np.sort(np.random.default_rng([seed, tree]).choice(n, max(1, int(share * n)), replace=False))


def _blocks(batches, model: Boosted):
    xs, ys = [], []
    for b in batches:
        xs.append(model.bins(model.numbers(b, 2)))
        ys.append(b.column(1).to_numpy())
    if xs:
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(xs).tobytes()], pa.binary()),
                                          pa.array([np.concatenate(ys).tobytes()], pa.binary())], names=["bins", "y"])


def _sums(bins: np.ndarray, g: np.ndarray, at: np.ndarray, nodes: int, columns: np.ndarray, width: int) -> np.ndarray:
    """(2, nodes, columns, bins) sums of gradients and of rows."""
    out = np.empty((2, nodes, len(columns), width))
    for i, c in enumerate(columns):
        cell = at * width + bins[:, c]
        out[0, :, i] = np.bincount(cell, g, nodes * width).reshape(nodes, width)
        out[1, :, i] = np.bincount(cell, minlength=nodes * width).reshape(nodes, width)
    return out


@dataclass(frozen=True)
class Grower:
    """How one tree grows from the sums of its levels, wherever they are taken."""
    n_columns: int
    depth: int
    rate: float
    share: float
    seed: int
    l2: float
    least: float
    width: int

    def begin(self, t: int) -> tuple[Tree, np.ndarray]:
        n = 2 ** self.depth
        return Tree(np.zeros(n - 1, np.int64), np.full(n - 1, 255), np.zeros(n)), drawn_columns(self.n_columns, self.share, self.seed, t)

    def level(self, tree: Tree, columns: np.ndarray, level: int, total: np.ndarray) -> None:
        """Best splits of a level's nodes; below the last level, the leaves: a
        child's sums are those left or right of the split."""
        nodes = 2 ** level
        for k in range(nodes):
            g, h = total[0, k], total[1, k]
            gain, c, cut = best_split(g, h, self.l2, self.least)
            split = gain > 1e-12
            if split:
                tree.column[nodes - 1 + k], tree.cut[nodes - 1 + k] = columns[c], cut
            if level == self.depth - 1:
                left = slice(0, cut + 1) if split else slice(None)
                c = c if split else 0
                gl, hl, ga, ha = g[c, left].sum(), h[c, left].sum(), g[c].sum(), h[c].sum()
                tree.leaf[2 * k] = -self.rate * gl / (hl + self.l2)
                tree.leaf[2 * k + 1] = -self.rate * (ga - gl) / (ha - hl + self.l2)


def fit(df: DataFrame, design: Design, label: str, rounds: int, depth: int = 3, rate: float = 0.025, share: float = 1.0,
        seed: int = 0, l2: float = 1.0, least: float = 1.0, bins: int = BINS, tasks: int | None = None) -> Boosted:
    """Boosted trees on binned rows spread over ``tasks`` partitions (the frame's own unless given)."""
    if design.degree != 1:
        raise ValueError("trees take features as they are")
    rows = prepared(df, design, label)
    k = len(design.numeric)
    means = rows.agg(F.avg("y"), *[F.avg(f"x{i}") for i in range(k)]).first()
    fills = np.array([(means[i + 1] or 0.0) if design.fill == "mean" else 0.0 for i in range(k)])
    edges = bin_edges(rows, design, bins, fills)
    model = Boosted(design, edges, means[0] or 0.0, fills)
    empty = Boosted(design, edges, 0.0, fills)
    grower = Grower(len(edges), depth, rate, share, seed, l2, least, bins)
    rows = rows.repartition(tasks) if tasks else rows
    d, run, first, sc = len(edges), uuid.uuid4().hex, model.base, df.sparkSession.sparkContext
    blocks = (rows.mapInArrow(lambda batches: _blocks(batches, empty), "bins binary, y binary").rdd
              .mapPartitionsWithIndex(lambda i, it: [(i, *_unpacked(list(it), d))]).persist(StorageLevel.MEMORY_AND_DISK))
    shared = []                                   # broadcast lists of SHARED_AT_ONCE trees
    try:
        for t in range(rounds):
            if t and t % SHARED_AT_ONCE == 0:
                shared.append(sc.broadcast(model.trees[-SHARED_AT_ONCE:]))
            tree, columns = grower.begin(t)
            latest = model.trees[len(shared) * SHARED_AT_ONCE:]
            for level in range(depth):
                def add(part, tree=tree, level=level, older=tuple(shared), latest=latest, columns=columns):
                    index, b, y = part
                    g = _predictions(run, index, b, first, older, latest) - y
                    return _sums(b, g, tree.place(b, level) - (2 ** level - 1), 2 ** level, columns, grower.width)

                grower.level(tree, columns, level, blocks.map(add).treeReduce(np.add))
            model.trees.append(tree)
    finally:
        blocks.unpersist()
        for old in shared:
            old.unpersist()
    return model


def _unpacked(rows, d: int):
    b = [np.frombuffer(r["bins"], np.uint8).reshape(-1, d) for r in rows]
    y = [np.frombuffer(r["y"]) for r in rows]
    return (np.concatenate(b), np.concatenate(y)) if b else (np.empty((0, d), np.uint8), np.empty(0))


def _predictions(run: str, part: int, bins: np.ndarray, base: float, older: tuple, latest: list[Tree]) -> np.ndarray:
    """A partition's predictions by the broadcast trees and the latest ones, from what this worker has kept of them."""
    done, p = _KEPT.pop((run, part), (0, np.full(len(bins), base)))
    while done < len(older) * SHARED_AT_ONCE:
        p, done = p + older[done // SHARED_AT_ONCE].value[done % SHARED_AT_ONCE].predict(bins), done + 1
    for t in latest[done - len(older) * SHARED_AT_ONCE:]:
        p = p + t.predict(bins)
    _KEPT[run, part] = len(older) * SHARED_AT_ONCE + len(latest), p
    while len(_KEPT) > KEPT_PARTS:
        _KEPT.popitem(last=False)
    return p
