"""Random forest of regression trees that can be grown again outside (survey 2.9).

How often a row counts in a tree (its bootstrap weight) is a Poisson(1) number
drawn from the md5 of the row's keys, so neither the spread of the rows nor a
retried task changes a tree, and any other program can grow the same one.  Every
tree sees all columns and splits by variance.  Features are cut into at most
``BINS`` bins once, at quantiles of all rows; binned rows and their weights (one
byte a tree) are stored as a block an Arrow batch.

Trees grow together, level by level, in groups of ``TREES_AT_ONCE``.  A level is
one job: tasks add up weights and labels by (tree, node, column, bin) and send
the cells that hold any; the sums of a node meet in one of many reduce tasks,
which takes its best split, and one small row a node comes back.  A node stops
when no split leaves a weight of at least ``least`` in both children; its
prediction is its weighted mean.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatcast.operators.boosting import BINS, Boosted, bin_edges
from seatcast.operators.gram import Design

TREES_AT_ONCE = 25
PER_HASH = 8                      # an md5 gives 16 bits to each of so many trees
# of 65,536 draws, how many give a Poisson(1) number of at most 0, 1, 2, ...
POISSON_STEPS = [int(round(65536 * float(v))) for v in np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 9)]))]
SUMS = "tree int, node int, cells binary, sums binary"
FOUND = "tree int, node int, column int, cut int, n double, mean double, left_n double, left_mean double, right_n double, right_mean double"


@dataclass
class Node:
    """A node: rows whose bin of ``column`` exceeds ``cut`` go right; a leaf has column -1."""
    n: float
    mean: float
    column: int = -1
    cut: int = -1


@dataclass
class Forest(Boosted):
    """Trees as tables of nodes: node i has children 2i + 1 and 2i + 2."""
    grown: list[dict[int, Node]] = field(default_factory=list)
    depth: int = 0

    def tables(self, tree: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Columns (-1 at a leaf), cuts and means by node number."""
        size = 2 ** (self.depth + 1) - 1
        column, cut, mean = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)
        for i, node in self.grown[tree].items():
            column[i], cut[i], mean[i] = node.column, node.cut, node.mean
        return column, cut, mean

    def values(self, x: np.ndarray) -> np.ndarray:
        b, out = self.bins(x), np.zeros(len(x))
        for t in range(len(self.grown)):
            column, cut, mean = self.tables(t)
            out += mean[place(b, column, cut, self.depth)]
        return out / max(1, len(self.grown))

    def nodes(self) -> list[tuple]:
        """(tree, node, depth, feature, threshold, n, mean): bounded by trees and depth."""
        names = self.design.names
        return [(t, i, int(np.log2(i + 1)), names[v.column] if v.column >= 0 else None,
                 float(self.edges[v.column][v.cut]) if v.column >= 0 else None, v.n, v.mean)
                for t, tree in enumerate(self.grown) for i, v in sorted(tree.items())]


def place(bins: np.ndarray, column: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    """The node of every row after at most ``depth`` splits."""
    rows, at = np.arange(len(bins)), np.zeros(len(bins), np.int64)
    for _ in range(depth):
        c = column[at]
        at = np.where(c >= 0, 2 * at + 1 + (bins[rows, c] > cut[at]), at)
    return at


def row_key(keys: Sequence[str]) -> Column:
    """The keys of a row as text, joined by '|' (a NULL counts as empty)."""
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])


def weights(keys: Sequence[str], trees: int, seed: int) -> np.ndarray:
    """(rows, trees) bootstrap weights: md5 of ``<key>|<seed>|<n>`` serves the n-th
    ``PER_HASH`` trees, and 16 of its bits are looked up among ``POISSON_STEPS``."""
    hashes = -(-trees // PER_HASH)
    drawn = b"".join(hashlib.md5(f"{k}|{seed}|{n}".encode()).digest() for k in keys for n in range(hashes))
    drawn = np.frombuffer(drawn, ">u2").reshape(len(keys), hashes * PER_HASH)[:, :trees]
    return np.searchsorted(POISSON_STEPS, drawn, "right").astype(np.uint8)


def best_split(w: np.ndarray, s: np.ndarray, least: float) -> tuple[int, int]:
    """(column, cut) that lowers the squared error most, from (columns, bins) sums of
    weights and weighted labels; (-1, -1) if none helps; the first of equals."""
    wl, sl = w.cumsum(axis=1), s.cumsum(axis=1)
    wa, sa = wl[:, -1:], sl[:, -1:]
    wr, sr = wa - wl, sa - sl
    fits = (wl >= least) & (wr >= least)
    gain = np.where(fits, sl ** 2 / np.where(fits, wl, 1.0) + sr ** 2 / np.where(fits, wr, 1.0) - sa ** 2 / np.maximum(wa, 1.0), -np.inf)
    gain = np.where(gain >= gain.max() - 1e-9 * max(1.0, abs(float(gain.max()))), gain, -np.inf) if fits.any() else gain
    at = int(gain.argmax())
    return divmod(at, w.shape[1]) if np.isfinite(gain.ravel()[at]) and gain.ravel()[at] > 1e-9 else (-1, -1)


def _stored(rows: DataFrame, empty: Forest, trees: int, seed: int) -> DataFrame:
    """One row of packed arrays (bins, labels, weights) for every Arrow batch."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                packed = (empty.bins(empty.numbers(b, 2)), b.column(1).to_numpy().astype(float), weights(b.column(0).to_pylist(), trees, seed))
                yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in packed], names=["bins", "y", "w"])

    return rows.mapInArrow(run, "bins binary, y binary, w binary")


def _node_sums(bins: np.ndarray, y: np.ndarray, w: np.ndarray, at: np.ndarray, width: int):
    """(node, cells, sums) of every node in ``at`` (-1: none): the (column, bin) cells
    that hold rows, and their sums of weights and of weighted labels."""
    columns = bins.shape[1]
    used = np.flatnonzero((at >= 0) & (w > 0))
    used = used[np.argsort(at[used], kind="stable")]
    for rows in np.split(used, np.flatnonzero(np.diff(at[used])) + 1) if len(used) else []:
        cell = (np.arange(columns) * width + bins[rows]).ravel()
        wr = np.repeat(w[rows], columns)
        n = np.bincount(cell, wr, columns * width)
        held = np.flatnonzero(n)
        yield int(at[rows[0]]), held, np.stack([n[held], np.bincount(cell, wr * np.repeat(y[rows], columns), columns * width)[held]])


def _level(blocks: DataFrame, tables: dict, trees: int, level: int, width: int, columns: int, least: float) -> list:
    """The open nodes of a level with their best splits; a row a node."""
    shared = blocks.sparkSession.sparkContext.broadcast(tables)

    def add(batches):
        for batch in batches:
            for r in batch.to_pylist():
                bins = np.frombuffer(r["bins"], np.uint8).reshape(-1, columns)
                y, w = np.frombuffer(r["y"]), np.frombuffer(r["w"], np.uint8).reshape(-1, trees)
                for t, (column, cut, open_) in shared.value.items():
                    at = place(bins, column, cut, level)
                    found = list(_node_sums(bins, y, w[:, t].astype(float), np.where(open_[at], at, -1), width))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([t] * len(found), pa.int32()), pa.array([f[0] for f in found], pa.int32()),
                         pa.array([f[1].astype(np.int32).tobytes() for f in found], pa.binary()),
                         pa.array([f[2].tobytes() for f in found], pa.binary())], names=["tree", "node", "cells", "sums"])

    def split(of, total):
        w, s = total.reshape(2, columns, width)
        c, cut = best_split(w, s, least)
        sides = [(0.0, 0.0)] * 2
        if c >= 0:
            sides = [(float(w[c, q].sum()), float(s[c, q].sum() / w[c, q].sum())) for q in (slice(0, cut + 1), slice(cut + 1, None))]
        return (*of, c, cut, float(w[0].sum()), float(s[0].sum() / w[0].sum()), *sides[0], *sides[1])

    names = [f.split()[0] for f in FOUND.split(", ")]
    kinds = [pa.int32() if f.endswith(" int") else pa.float64() for f in FOUND.split(", ")]

    def merge(batches):
        of, total, done = None, np.zeros((2, columns * width)), []
        for batch in batches:                    # sorted: the rows of a node follow each other
            for r in batch.to_pylist():
                if (r["tree"], r["node"]) != of:
                    done += [split(of, total)] if of else []
                    of, total = (r["tree"], r["node"]), np.zeros((2, columns * width))
                total[:, np.frombuffer(r["cells"], np.int32)] += np.frombuffer(r["sums"]).reshape(2, -1)
        done += [split(of, total)] if of else []
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*done), kinds)], names=names)

    sums = blocks.mapInArrow(add, SUMS).repartition("tree", "node").sortWithinPartitions("tree", "node")
    return sums.mapInArrow(merge, FOUND).collect()


def fit(df: DataFrame, design: Design, label: str, keys: Sequence[str], trees: int = 100, depth: int = 10, least: float = 4.0,
        seed: int = 42, bins: int = BINS, tasks: int | None = None) -> Forest:
    """A forest over the rows of ``df`` that have a label; ``keys`` name a row."""
    if design.degree != 1:
        raise ValueError("trees take features as they are")
    if not design.names:
        raise ValueError("a forest needs a feature")
    rows = (df.where(F.col(label).isNotNull())
            .select(row_key(keys).alias("key"), F.col(label).cast("double").alias("y"), *design.columns()))
    k = len(design.numeric)
    means = rows.agg(F.avg("y"), *[F.avg(f"x{i}") for i in range(k)]).first()
    fills = np.array([(means[i + 1] or 0.0) if design.fill == "mean" else 0.0 for i in range(k)])
    forest = Forest(design, bin_edges(rows, design, bins, fills), means[0] or 0.0, fills, depth=depth)
    empty = Forest(design, forest.edges, 0.0, fills)
    columns, size = len(forest.edges), 2 ** (depth + 1) - 1
    blocks = _stored(rows.repartition(tasks) if tasks else rows, empty, trees, seed).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for begin in range(0, trees, TREES_AT_ONCE):
            group = range(begin, min(trees, begin + TREES_AT_ONCE))
            grown = {t: {} for t in group}
            tables = {t: (np.full(size, -1), np.zeros(size, np.int64), np.arange(size) == 0) for t in group}
            for level in range(depth):
                live = {t: v for t, v in tables.items() if v[2].any()}
                if not live:
                    break
                got = _level(blocks, live, trees, level, bins, columns, least)
                for _, _, open_ in live.values():
                    open_[:] = False
                for r in got:
                    t, i = r["tree"], r["node"]
                    grown[t][i] = Node(r["n"], r["mean"], r["column"], r["cut"])
                    if r["column"] >= 0:
                        column, cut, open_ = tables[t]
                        column[i], cut[i] = r["column"], r["cut"]
                        for child, side in ((2 * i + 1, "left"), (2 * i + 2, "right")):
                            grown[t][child] = Node(r[f"{side}_n"], r[f"{side}_mean"])
                            open_[child] = r[f"{side}_n"] >= 2 * least
            forest.grown += [grown[t] or {0: Node(0.0, forest.base)} for t in group]
    finally:
        blocks.unpersist()
    return forest
