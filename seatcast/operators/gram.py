"""Sufficient statistics of linear models, in one pass over the rows.

:class:`Design` says how rows become numbers; :func:`moments` gives, for every
key (a fold, a date range, a segment), the row count, the means and the centred
co-moments of all design columns and the label.  Batches are centred on their
own means and merged pairwise, so nothing cancels however large the means are,
and the statistics of a union are those of its parts: the training part of a
fold is merged from the other folds, an expanding one from the ranges before.
Whatever a linear fit needs follows without the rows: imputation by the mean and
scaling are linear maps of the statistics, and so are the errors of any fit.

Each task gives one row a key.  Merging goes up a tree of at most ``FAN`` rows a
node; what reaches the driver is one matrix a key (times tasks / FAN**2).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatcast.operators.models import FeatureSet, categories

FAN = 64
PARTS = "key bigint, task bigint, state binary"


@dataclass
class Moments:
    """Count, means and centred co-moments (sums of products of deviations)."""
    n: float
    mean: np.ndarray
    m2: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> "Moments":
        mean = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
        x = x - mean
        return cls(float(len(x)), mean, x.T @ x)

    def __add__(self, other: "Moments") -> "Moments":
        n = self.n + other.n
        if not n:
            return self
        d = other.mean - self.mean
        return Moments(n, self.mean + d * (other.n / n), self.m2 + other.m2 + np.outer(d, d) * (self.n * other.n / n))

    def mapped(self, a: np.ndarray) -> "Moments":
        """The moments of ``a @ row``."""
        return Moments(self.n, a @ self.mean, a @ self.m2 @ a.T)

    def pack(self) -> bytes:
        return np.concatenate([[self.n], self.mean, self.m2.ravel()]).tobytes()

    @classmethod
    def unpack(cls, b: bytes) -> "Moments":
        v = np.frombuffer(b)
        d = int(round((np.sqrt(4 * len(v) - 3) - 1) / 2))
        return cls(float(v[0]), v[1:1 + d], v[1 + d:].reshape(d, d))


def total(parts: Sequence[Moments]) -> Moments:
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out


def tree_merge(parts: DataFrame, merge: Callable[[list[bytes]], bytes]) -> DataFrame:
    """``parts`` (key, task, state), merged to one row a key and FAN**2 tasks."""
    def up(table: pa.Table) -> pa.Table:
        return pa.table({"key": table.column("key")[:1], "task": table.column("task")[:1],
                         "state": pa.array([merge(table.column("state").to_pylist())], pa.binary())})

    for _ in range(2):
        parts = parts.withColumn("task", F.floor(F.col("task") / FAN)).groupBy("key", "task").applyInArrow(up, PARTS)
    return parts


def task_states(rows: DataFrame, begin: Callable[[pa.RecordBatch], dict], merge: Callable) -> DataFrame:
    """One (key, task, state) row for each key a task meets; ``begin`` gives a
    batch's states by key."""
    def run(batches):
        states: dict[int, bytes] = {}
        for batch in batches:
            for key, s in begin(batch).items():
                states[key] = merge([states[key], s]) if key in states else s
        if states:
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array(list(states), pa.int64()), pa.array([task] * len(states), pa.int64()),
                                              pa.array(list(states.values()), pa.binary())], names=["key", "task", "state"])

    return rows.mapInArrow(run, PARTS)


def by_key(rows: DataFrame, begin: Callable, merge: Callable) -> dict[int, bytes]:
    """The merged state of every key, on the driver: a matrix a key."""
    out: dict[int, bytes] = {}
    for r in tree_merge(task_states(rows, begin, merge), merge).collect():
        out[r["key"]] = merge([out[r["key"]], bytes(r["state"])]) if r["key"] in out else bytes(r["state"])
    return out


def merge_moments(states: list[bytes]) -> bytes:
    return total([Moments.unpack(s) for s in states]).pack()


@dataclass(frozen=True)
class Design:
    """How rows become numbers: numeric features imputed by 0 or their mean (and
    scaled when fitted), optionally with all products of two; dummies of the
    listed categories; passed-through columns (0 for NULL)."""
    numeric: tuple[str, ...]
    categorical: dict[str, list[str]] = field(default_factory=dict)
    passthrough: tuple[str, ...] = ()
    fill: str = "zero"
    degree: int = 1

    @classmethod
    def of(cls, df: DataFrame, fs: FeatureSet, fill: str = "zero", degree: int = 1, drop_first: bool = False) -> "Design":
        """The design of ``fs``, with the categories that ``df`` has."""
        if degree > 1 and fill != "zero":
            raise ValueError("products are made of zero-filled features")
        fs = fs.checked(df)
        found = categories(df, fs.categorical)
        return cls(fs.numeric, {c: v[drop_first:] for c, v in found.items()}, fs.passthrough, fill, degree)

    @property
    def pairs(self) -> list[tuple[int, int]]:
        d = len(self.numeric)
        return [(i, j) for i in range(d) for j in range(i, d)] if self.degree == 2 else []

    @property
    def scaled(self) -> int:
        """Number of leading columns that are scaled."""
        return len(self.numeric) + len(self.pairs)

    @property
    def names(self) -> list[str]:
        n = self.numeric
        return [*n, *(f"{n[i]} {n[j]}" for i, j in self.pairs), *(f"{c}_{v}" for c, vs in self.categorical.items() for v in vs),
                *self.passthrough]

    def columns(self) -> list[Column]:
        """What tasks are sent: nullable numbers, one category number a column, numbers."""
        number = [F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(self.numeric)]
        index = [F.coalesce(F.array_position(F.array(*map(F.lit, vs)).cast("array<string>"), F.col(f"`{c}`").cast("string")), F.lit(0))
                 .cast("int").alias(f"c{i}") for i, (c, vs) in enumerate(self.categorical.items())]
        return [*number, *index, *[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(f"p{i}")
                                   for i, c in enumerate(self.passthrough)]]

    def matrix(self, batch: pa.RecordBatch, at: int = 0) -> np.ndarray:
        """Rows of numbers; with fill "mean" each numeric column is 0 for NULL,
        and further columns at the end mark its NULLs."""
        rows, col = batch.num_rows, lambda i: batch.column(at + i).to_numpy(zero_copy_only=False)
        n, k = len(self.numeric), len(self.categorical)
        x = np.empty((rows, n))
        for i in range(n):
            x[:, i] = col(i)                      # Arrow gives NaN for NULL
        null = np.isnan(x)
        x[null] = 0.0
        parts = [x]
        if self.degree == 2:
            i, j = np.array(self.pairs).T
            parts.append(x[:, i] * x[:, j])
        for i, vs in enumerate(self.categorical.values()):
            parts.append((col(n + i)[:, None] == np.arange(1, len(vs) + 1)).astype(float))
        parts += [col(n + k + i)[:, None] for i in range(len(self.passthrough))]
        if self.fill == "mean":
            parts.append(null.astype(float))
        return np.hstack(parts) if parts else np.empty((rows, 0))

    def imputing(self, m: Moments) -> tuple[np.ndarray, np.ndarray]:
        """(map from raw columns to the imputed ones, fill values) for the means of ``m``
        (whose last column is the label, which is kept)."""
        d, k = len(self.names), len(self.numeric) if self.fill == "mean" else 0
        a = np.zeros((d + 1, d + k + 1))
        a[:d, :d] = np.eye(d)
        a[d, d + k] = 1.0
        fills = np.zeros(len(self.numeric))
        if k:
            seen = 1.0 - m.mean[d:d + k]
            fills = np.divide(m.mean[:k], seen, out=np.zeros(k), where=seen > 0)
            a[:k, d:d + k] = np.diag(fills)
        return a, fills

    def terms(self, fills: Sequence[float]) -> list[Column]:
        """The imputed columns as expressions, in the order of :attr:`names`."""
        x = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float(v))) for c, v in zip(self.numeric, fills)]
        made = x + [x[i] * x[j] for i, j in self.pairs]
        for c, vs in self.categorical.items():
            made += [F.col(f"`{c}`").cast("string").eqNullSafe(v).cast("double") for v in vs]
        return made + [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in self.passthrough]


def prepared(df: DataFrame, design: Design, label: str, key: Column | None = None) -> DataFrame:
    """The columns a fit reads: key, y and the design's, of rows that have a label and a key."""
    key = (F.lit(0) if key is None else key).cast("bigint").alias("key")
    return df.where(F.col(label).isNotNull()).select(key, F.col(label).cast("double").alias("y"), *design.columns()).where("key is not null")


def moments(rows: DataFrame, design: Design) -> dict[int, Moments]:
    """Moments of every key of :func:`prepared` rows, the label as last column."""
    def begin(batch):
        keys = batch.column(0).to_numpy()
        xy = np.column_stack([design.matrix(batch, 2), batch.column(1).to_numpy()])
        return {int(k): Moments.of(xy[keys == k]).pack() for k in np.unique(keys)}

    return {k: Moments.unpack(s) for k, s in by_key(rows, begin, merge_moments).items()}


def cells(found: dict[int, Moments], names: Sequence[str]) -> list[tuple]:
    """(key, feature_1, feature_2, n, mean_1, mean_2, comoment) rows."""
    return [(k, a, b, int(m.n), float(m.mean[i]), float(m.mean[j]), float(m.m2[i, j]))
            for k, m in sorted(found.items()) for i, a in enumerate(names) for j, b in enumerate(names)]
