"""Exact top-k by inner product with Fagin's no-random-access aggregation.

Candidates and queries are cut into blocks of a bounded number of values, each
block one row.  A unit of work is one query block and a band of candidate
blocks: queries are copied once a band, candidates once a query block, and there
are about as many units as shuffle partitions (more only where there are more
query blocks).  A task reads its units as a sorted stream, one candidate block
at a time.  In a block every component has a list of the candidates, sorted
once, which is only ever read in order: from the top for a positive query
component and from the bottom for a negative one.  After each round of reading,
a candidate's lower bound takes the worst value of a list for what is unread,
and its upper bound the value just read.  A query stops when no candidate unread
in all lists can reach its k-th best lower bound; the final scores of those that
still can are then worked out.  The k best of a unit so far are carried along as
lower bounds: a query that has them needs no others, and tests a round of reading
by the values just read alone.  The bounds of all queries are matrix products.
The k best of every unit meet in a ranking by query.

Scores are exact: products run in float32 or float64 only where every sum is
below 2**24 or 2**53, else in Python integers.

Cases: vectors that are null or hold a null or non-finite component, and rows
without an id, take no part; a shorter vector counts as filled up with zeros;
rows with equal ids count once, by the least vector; with fewer than k
candidates all are returned; ties go to the smaller id; an empty table, or one
without queries, gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatcast.llm.common import shuffle_partitions, stage

K, SCALE = 20, 64
QUERY_BLOCK, BLOCK = 32_768, 4096          # rows of a block at most
QUERY_VALUES, VALUES = 1 << 21, 1 << 18    # values of a block, about, at most
SLICE = 512                                # queries whose bounds are worked out at once
DEPTHS = (1 / 8, 1 / 2, 3 / 4, 1)          # share of each list read after each round
NOTHING = -(1 << 63) + 1
RESULT = "query_id bigint, vec_id bigint, score bigint"


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, x: the usable vectors as arrays of floor(scale * component)."""
    e = F.col("embedding")
    usable = e.isNotNull() & F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    x = F.transform(e, lambda v: F.floor(v.cast("double") * scale))
    return (vectors.where(F.col("vec_id").isNotNull() & usable).select(F.col("vec_id").cast("bigint"), x.alias("x"))
            .groupBy("vec_id").agg(F.min("x").alias("x")))


def blocks(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    """One row a block: its number, its ids and its vectors (int64, row by row)."""
    n = max(1, -(-rows.count() // size))

    def pack(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        x = table.column("x").combine_chunks()
        return pa.table({"block": table.column("block").slice(0, 1), "ids": pa.array([ids.astype("<i8").tobytes()]),
                         "sizes": pa.array([np.diff(x.offsets.to_numpy()).astype("<i4").tobytes()]),
                         "x": pa.array([_narrow(x.flatten().to_numpy())])})

    packed = (rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")).groupBy("block")
              .applyInArrow(pack, "block int, ids binary, sizes binary, x binary"))
    return stage(packed, name), n


def _narrow(x: np.ndarray) -> bytes:
    """The values in the smallest integer type that holds them, after its width."""
    top = max(int(np.abs(x).max(initial=0)), 1)
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w - 1) or w == 8)
    return bytes([width]) + x.astype(f"<i{width}").tobytes()


def _matrix(sizes: bytes, x: bytes, dim: int) -> np.ndarray:
    sizes, flat = np.frombuffer(sizes, "<i4"), np.frombuffer(x, f"<i{x[0]}", offset=1)
    if (sizes == dim).all():
        return flat.reshape(-1, dim).astype(np.int64)
    out = np.zeros((len(sizes), dim), np.int64)
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


def no_random_access(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int,
                     known: np.ndarray | None = None, order: np.ndarray | None = None):
    """Yield (place of the query, candidate ids, scores) of each query's k best in
    the block; with ``known``, a score that k others are known to reach (NOTHING
    if there are none), those below it may be left out.  ``order`` sorts the lists."""
    n, dim = x.shape
    limit = int(np.abs(x).max(initial=0)) * int(np.abs(q).max(initial=0)) * max(dim, 1)
    dtype = np.float32 if limit < 1 << 24 else np.float64 if limit < 1 << 53 else object
    order = np.argsort(x, axis=0, kind="stable") if order is None else order
    x, q = x.astype(dtype), q.astype(dtype)
    lists = np.take_along_axis(x, order, 0)
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    top_read, bottom_read = np.zeros((n, dim), bool), np.zeros((n, dim), bool)
    open_, read, floor_ = np.arange(len(q)), 0, -limit - 1
    known = np.full(len(q), NOTHING) if known is None else known
    known = np.array([min(max(int(v), floor_), limit + 1) for v in known], dtype)
    places = np.argsort(ids, kind="stable")
    at = places[np.minimum(np.searchsorted(ids, query_ids, sorter=places), n - 1)]
    own = np.where(ids[at] == query_ids, at, -1)

    def bounds(rows, unread_top, unread_bottom):
        out = (plus[rows] @ np.where(top_read, x, unread_top).T + minus[rows] @ np.where(bottom_read, x, unread_bottom).T)
        has_own = np.flatnonzero(own[rows] >= 0)
        out[has_own, own[rows][has_own]] = floor_
        return out

    def kth(values):
        return np.partition(values, n - k, axis=1)[:, n - k] if n > k else np.full(len(values), floor_, dtype)

    for share in DEPTHS:
        depth = max(1, int(np.ceil(n * share)))
        if depth == read:
            continue
        np.put_along_axis(top_read, order[n - depth:n - read], True, 0)
        np.put_along_axis(bottom_read, order[read:depth], True, 0)
        read = depth
        at_top, at_bottom = lists[n - depth], lists[depth - 1]
        bar = known[open_]
        blind = np.flatnonzero(bar == floor_)
        if depth < n:
            if len(blind):
                bar[blind] = kth(bounds(open_[blind], lists[0], lists[-1]))
            stop = np.flatnonzero(plus[open_] @ at_top + minus[open_] @ at_bottom < bar)
            if not len(stop):
                continue
            upper = bounds(open_[stop], at_top, at_bottom)
        else:
            stop = np.arange(len(open_))
            upper = bounds(open_, at_top, at_bottom)          # all is read: the scores
            bar[blind] = kth(upper[blind])
        for row, s in enumerate(stop):
            query = open_[s]
            can = np.flatnonzero(upper[row] >= bar[s])
            can = can[can != own[query]]
            scores = (upper[row][can] if depth == n else x[can] @ q[query]).astype(np.int64)
            best = np.lexsort((ids[can], -scores))[:k]
            if len(best):
                yield int(query), ids[can][best], scores[best]
        open_ = np.delete(open_, stop)
        if not len(open_):
            return


class Best:
    """The k best so far of every query of one block."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int):
        self.ids, self.q, self.k = ids, q, k
        self.score = np.full((len(ids), k), NOTHING)
        self.vec = np.zeros((len(ids), k), np.int64)

    def meet(self, ids: np.ndarray, x: np.ndarray) -> None:
        order = np.argsort(x, axis=0, kind="stable")
        for a in range(0, len(self.ids), SLICE):
            part = slice(a, a + SLICE)
            for at, found, scores in no_random_access(ids, x, self.ids[part], self.q[part], self.k,
                                                      self.score[part, -1], order):
                vec, score = np.append(self.vec[a + at], found), np.append(self.score[a + at], scores)
                best = np.lexsort((vec, -score))[:self.k]
                self.vec[a + at], self.score[a + at] = vec[best], score[best]

    def rows(self) -> pa.RecordBatch:
        at, rank = np.nonzero(self.score > NOTHING)
        return pa.RecordBatch.from_arrays([pa.array(self.ids[at]), pa.array(self.vec[at, rank]), pa.array(self.score[at, rank])],
                                          names=["query_id", "vec_id", "score"])


def bands(n_q: int, n_c: int, units: int) -> int:
    """Bands of candidate blocks: with ``n_q`` query blocks about ``units`` units, a block a band at least."""
    return max(1, min(n_c, -(-units // n_q)))


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of every query row."""
    rows = stage(integers(vectors, scale), "vectors")
    dim = rows.agg(F.max(F.size("x"))).first()[0] or 0
    asked = rows.where(is_query)
    queries, n_q = blocks(asked, min(QUERY_BLOCK, max(1, QUERY_VALUES // max(dim, 1))), "queries")
    candidates, n_c = blocks(rows, min(BLOCK, max(1, VALUES // max(dim, 1))), "candidates")
    partitions = shuffle_partitions(rows.sparkSession)
    n_bands = bands(n_q, n_c, partitions)

    def copied(side: DataFrame, role: int, unit: Column) -> DataFrame:
        return side.select(unit.alias("unit"), F.lit(role).alias("role"), "ids", "sizes", "x")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))

    unit = F.col("q") * n_bands + F.col("c")
    units = (copied(queries.select("*", F.col("block").alias("q"), every(n_bands).alias("c")), 0, unit)
             .unionByName(copied(candidates.select("*", every(n_q).alias("q"), (F.col("block") % n_bands).alias("c")), 1, unit))
             .repartition(partitions, "unit").sortWithinPartitions("unit", "role"))

    def search(batches):
        unit, best = None, None
        for batch in batches:
            for at in range(batch.num_rows):
                u = batch.slice(at, 1).to_pylist()[0]
                if u["unit"] != unit and best is not None:
                    yield best.rows()
                    best = None
                unit = u["unit"]
                ids, x = np.frombuffer(u["ids"], "<i8"), _matrix(u["sizes"], u["x"], dim)
                if u["role"] == 0:
                    best = Best(ids, x, k)
                elif best is not None:              # no block of queries: nothing is asked here
                    best.meet(ids, x)
        if best is not None:
            yield best.rows()

    best = units.mapInArrow(search, RESULT)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
