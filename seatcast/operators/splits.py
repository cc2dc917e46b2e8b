"""Dataset splitting and backtesting (survey 2.8).

Folds are defined over *distinct dates*, not calendar days: the k-th date is
the k-th distinct ``calculate_date``.  The date -> fold map is built once on
the distinct dates (one row per calendar day) and each fold is then a date
range predicate on the cached fact, so no fold re-scans with ``isin`` lists.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seatcast import constants as C
from seatcast.operators._util import persisted


def split_cutoff(df: DataFrame, cutoff: str, date_col: str = "calculate_date") -> tuple[DataFrame, DataFrame]:
    """train: ``date < cutoff``; test: ``date >= cutoff``.  The target stays in
    the row (no separate X / y frames to re-align)."""
    c = F.lit(cutoff).cast("date")
    return df.where(F.col(date_col) < c), df.where(F.col(date_col) >= c)


def date_index(df: DataFrame, date_col: str = "calculate_date") -> DataFrame:
    """(date, date_idx) with date_idx = 0-based rank of the distinct date.

    Runs on the distinct dates only: bounded by the calendar."""
    d = df.select(F.col(date_col).alias("date")).distinct()
    return d.withColumn("date_idx", (F.dense_rank().over(Window.orderBy("date")) - 1).cast("int"))


def expanding_folds(df: DataFrame, train_dates: int = C.BACKTEST_TRAIN_DATES,
                    valid_dates: int = C.BACKTEST_VALID_DATES,
                    date_col: str = "calculate_date") -> DataFrame:
    """Fold table: for i = train, train+valid, ... < n_dates, train on dates
    [0, i) (expanding) and validate on [i, i+valid) (last fold may be short).

    Columns: fold, train_from, train_to, valid_from, valid_to."""
    idx = date_index(df, date_col).where(F.col("date_idx") >= train_dates)
    idx = idx.withColumn("fold", ((F.col("date_idx") - train_dates) / valid_dates).cast("int"))
    folds = idx.groupBy("fold").agg(F.min("date").alias("valid_from"), F.max("date").alias("valid_to"),
                                    F.min("date_idx").alias("_first"))
    first = df.select(F.min(date_col)).scalar()
    prev = date_index(df, date_col).select(F.col("date_idx").alias("_first_m1"), F.col("date").alias("train_to"))
    return (folds.join(prev, F.col("_first") - 1 == F.col("_first_m1"))
                 .select("fold", first.alias("train_from"), "train_to", "valid_from", "valid_to"))


def fold_frames(df: DataFrame, fold: dict, date_col: str = "calculate_date") -> tuple[DataFrame, DataFrame]:
    d = F.col(date_col)
    train = df.where((d >= F.lit(fold["train_from"])) & (d <= F.lit(fold["train_to"])))
    valid = df.where((d >= F.lit(fold["valid_from"])) & (d <= F.lit(fold["valid_to"])))
    return train, valid


def backtest(df: DataFrame, fit_predict: Callable[[DataFrame, DataFrame], DataFrame],
             label: str = C.TARGET, pred: str = "prediction",
             train_dates: int = C.BACKTEST_TRAIN_DATES, valid_dates: int = C.BACKTEST_VALID_DATES,
             date_col: str = "calculate_date") -> DataFrame:
    """Fit on each fold's train range, score its validation range, RMSE per fold.

    The fold loop runs on the driver over the (few) fold boundaries; every fit
    and score is a distributed Spark job over a date-range slice of ``df``.
    Returns fold, date ranges, rmse, n -- one row per fold.
    """
    spark = df.sparkSession
    rows = []
    with persisted(df) as data:
        folds = expanding_folds(data, train_dates, valid_dates, date_col).orderBy("fold").collect()
        for f in folds:
            fd = f.asDict()
            train, valid = fold_frames(data, fd, date_col)
            scored = fit_predict(train, valid)
            m = scored.agg(F.sqrt(F.avg(F.pow(F.col(label) - F.col(pred), 2))).alias("rmse"),
                           F.count(F.lit(1)).alias("n")).first()
            rows.append((fd["fold"], fd["train_from"], fd["train_to"], fd["valid_from"], fd["valid_to"],
                         float(m["rmse"]) if m["rmse"] is not None else None, int(m["n"])))
    schema = ("fold int, train_from date, train_to date, valid_from date, valid_to date, "
              "rmse double, n bigint")
    return spark.createDataFrame(rows, schema)


def hash_share(keys: Sequence[str], seed: int = 42):
    """A number in [0, 2**32) from the md5 of the row keys: the same in every
    engine and for every partitioning."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def hash_fold(keys: Sequence[str], k: int, seed: int = 42):
    """Deterministic fold id in [0, k) from a hash of the row keys."""
    return (hash_share(keys, seed) % k).cast("int")


def kfold_assign(df: DataFrame, keys: Sequence[str], k: int = 5, seed: int = 42,
                 out: str = "fold") -> DataFrame:
    return df.withColumn(out, hash_fold(keys, k, seed))


def holdout_split(df: DataFrame, keys: Sequence[str], test_fraction: float = 0.2,
                  seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Reproducible hash split (same rows whatever the partitioning)."""
    cut = int(test_fraction * 2**32)
    u = hash_share(keys, seed)
    return df.where(u >= cut), df.where(u < cut)


def kfold_scores(df: DataFrame, fit: Callable[[DataFrame], object], k: int = 5, label: str = C.TARGET,
                 pred: str = "prediction", fold: str = "fold", threads: int = 4) -> DataFrame:
    """Train and test RMSE of every fold: fold, n, rmse, train_rmse.

    Fits of different folds are independent Spark jobs; a few run side by side
    from driver threads."""
    from multiprocessing.pool import ThreadPool

    def one(i: int):
        model = fit(data.where(F.col(fold) != i))
        scored = model.transform(data)
        own = F.when(F.col(fold) == i, F.pow(F.col(label) - F.col(pred), 2))
        rest = F.when(F.col(fold) != i, F.pow(F.col(label) - F.col(pred), 2))
        r = scored.agg(F.count(own), F.sqrt(F.avg(own)), F.sqrt(F.avg(rest))).first()
        return (i, int(r[0]), *(None if x is None else float(x) for x in r[1:]))

    with persisted(df) as data, ThreadPool(threads) as pool:
        rows = pool.map(one, range(k))
    return df.sparkSession.createDataFrame(rows, "fold int, n bigint, rmse double, train_rmse double")


def random_search(df: DataFrame, fit: Callable[[DataFrame, dict], object], candidates: Sequence[dict], k: int,
                  label: str = C.TARGET, pred: str = "prediction", fold: str = "fold", threads: int = 4):
    """Mean squared error of every candidate over ``k`` folds, and the best one
    refitted on all rows: (table of candidate, mean_mse, std_mse; best setting;
    its model).

    A ``fit`` with a method ``search`` (:class:`~seatcast.operators.linear.PoissonFits`)
    makes the fits of all candidates, on the folds and on all rows, together; any
    other one is called for each."""
    from multiprocessing.pool import ThreadPool
    from statistics import fmean, pstdev

    def one(job):
        c, i = job
        model = fit(data.where(F.col(fold) != i), candidates[c])
        r = model.transform(data.where(F.col(fold) == i)).agg(F.avg(F.pow(F.col(label) - F.col(pred), 2))).first()
        return c, float(r[0])

    with persisted(df) as data, ThreadPool(threads) as pool:
        if together := getattr(fit, "search", None):
            scores, models = together(data, candidates, k, label, fold)
        else:
            done = pool.map(one, [(c, i) for c in range(len(candidates)) for i in range(k)], chunksize=1)
            scores = [[s for c, s in done if c == n] for n in range(len(candidates))]
        best = min(range(len(candidates)), key=lambda n: fmean(scores[n]))
        model = models[best] if together else fit(data, candidates[best])
    rows = [(n, *[float(v) for v in candidates[n].values()], fmean(s), pstdev(s), n == best) for n, s in enumerate(scores)]
    names = ", ".join(f"{c} double" for c in candidates[0])
    table = df.sparkSession.createDataFrame(rows, f"candidate int, {names}, mean_mse double, std_mse double, best boolean")
    return table, candidates[best], model


def sample_param_maps(space: dict, n: int = 10, seed: int = 42) -> list[dict]:
    """Random-search candidates: each value is a list (choice) or a (lo, hi)
    tuple (uniform).  Small driver-side list of parameter settings."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        m = {}
        for k, v in space.items():
            m[k] = rng.uniform(*v) if isinstance(v, tuple) else rng.choice(list(v))
        out.append(m)
    return out
