"""Report aggregates and metrics (survey 2.5).

All aggregates are partial (map-side) aggregations.  Exact quantiles split
each group into value ranges, so no task orders a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatcast.operators._util import persisted
from seatcast.operators.gram import task_states, tree_merge


def _cols(x: Sequence[str] | str) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def avg_initial_price(df: DataFrame, keys: Sequence[str] = ("price_code", "event_date"),
                      value: str = "initial_price") -> DataFrame:
    return df.groupBy(*_cols(keys)).agg(F.avg(value).alias(value))


def sum_by(df: DataFrame, key: Sequence[str] | str, value: str, out: str | None = None) -> DataFrame:
    return df.groupBy(*_cols(key)).agg(F.sum(value).alias(out or f"sum_{value}"))


def top_by_sum(df: DataFrame, key: str, value: str, out: str = "total") -> DataFrame:
    """The key with the largest sum of ``value`` (ties: smallest key), and the sum."""
    return (df.groupBy(key).agg(F.sum(value).alias(out))
              .orderBy(F.desc(out), F.asc(key)).limit(1))


def argmax_row(df: DataFrame, value: str, tie_keys: Sequence[str]) -> DataFrame:
    """The whole row with the largest ``value`` (ties broken by ``tie_keys``)."""
    return df.orderBy(F.desc(value), *[F.asc(k) for k in tie_keys]).limit(1)


def price_range_by_code(df: DataFrame, key: str = "price_code", value: str = "last_price") -> DataFrame:
    return df.groupBy(key).agg(F.min(value).alias("min_price"), F.max(value).alias("max_price"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), col)


def histogram(long_df: DataFrame, name_col: str, value_col: str, width: float) -> DataFrame:
    """Counts per series and bin ``floor(value / width)``; bin edges returned."""
    b = F.floor(F.col(value_col) / F.lit(float(width)))
    return (long_df.where(F.col(value_col).isNotNull())
            .groupBy(F.col(name_col), b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("count"))
            .withColumn("bin_start", F.col("bin") * F.lit(float(width)))
            .withColumn("bin_end", (F.col("bin") + 1) * F.lit(float(width))))


def linear_quantile(values: Column, p: float) -> Column:
    """Quantile of a sorted array column, numpy's "linear" method with the same
    floating-point steps (bin edges depend on them): the virtual index is
    (n*p + (1-p)) - 1, and the lerp is taken from the upper neighbour when the
    fraction is >= 0.5."""
    n, q = F.size(values), F.lit(float(p))
    pos = (n.cast("double") * q + (F.lit(1.0) - q)) - F.lit(1.0)
    lo = F.floor(pos).cast("int")
    a = F.get(values, lo).cast("double")
    b = F.get(values, F.least(lo + 1, n - 1)).cast("double")
    t = pos - lo
    return F.when(t >= 0.5, b - (b - a) * (F.lit(1.0) - t)).otherwise(a + (b - a) * t)


QUANTILE_BUCKETS = 64     # value ranges per group that share the ordered pass


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str,
                    probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy/pandas default) per group.

    No group is ordered by one task.  Approximate percentiles cut each group
    into value ranges; rows collapse to (group, range, value, count), a map-side
    combined aggregate; the running count inside a range runs over its distinct
    values, and the ranges' own totals (a small table) give where each begins.
    The approximate marks only spread the work: the counts are exact.
    """
    keys = list(keys)
    seen = df.where(F.col(value).isNotNull())
    marks = F.percentile_approx(value, F.array(*[F.lit(i / QUANTILE_BUCKETS) for i in range(1, QUANTILE_BUCKETS)]),
                                F.lit(20 * QUANTILE_BUCKETS)).alias("_marks")
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    marked = seen.groupBy(*named).agg(marks) if keys else seen.agg(marks)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    if keys:
        ranged = seen.join(marked, same)
    else:
        ranged = seen.withColumn("_marks", marked.select("_marks").scalar())
    h = (ranged.select(*keys, value, F.size(F.filter("_marks", lambda m: m < F.col(value))).alias("_r"))
         .groupBy(*keys, "_r", value).agg(F.count(F.lit(1)).alias("_c")))
    totals = h.groupBy(*keys, "_r").agg(F.sum("_c").alias("_t"))
    by_group = Window.partitionBy(*keys) if keys else Window.partitionBy()
    before = by_group.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_r").alias("_tr"),
                           F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_before"), F.sum("_t").over(by_group).alias("_n"))
    inside = Window.partitionBy(*keys, "_r").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    h = (h.withColumn("_end", F.sum("_c").over(inside))
         .join(totals, same & (F.col("_r") == F.col("_tr")))
         .withColumn("_start", F.col("_before") + F.col("_end") - F.col("_c")))
    aggs = []
    for p, nm in zip(probs, names):
        # numpy's "linear" method, same floating-point steps: the virtual
        # index is (n*q + (1-q)) - 1, and the lerp is taken from the upper
        # neighbour when the fraction is >= 0.5 (bin edges depend on it).
        q = F.lit(float(p))
        pos = (F.col("_n").cast("double") * q + (F.lit(1.0) - q)) - F.lit(1.0)
        lo = F.floor(pos)
        hi = F.least(lo + 1, F.col("_n") - 1)
        aggs += [F.max(F.when(F.col("_start") <= lo, F.col(value))).alias(f"_{nm}_lo"),
                 F.max(F.when(F.col("_start") <= hi, F.col(value))).alias(f"_{nm}_hi"),
                 F.max(pos - lo).alias(f"_{nm}_frac")]
    g = h.groupBy(*keys).agg(*aggs) if keys else h.agg(*aggs)
    out = [F.col(k) for k in keys]
    for nm in names:
        a, b = F.col(f"_{nm}_lo").cast("double"), F.col(f"_{nm}_hi").cast("double")
        t = F.col(f"_{nm}_frac")
        lerp = F.when(t >= 0.5, b - (b - a) * (F.lit(1.0) - t)).otherwise(a + (b - a) * t)
        out.append(lerp.alias(nm))
    return g.select(*out)


def median_by_code(df: DataFrame, key: str = "price_code", value: str = "last_price",
                   out: str = "median") -> DataFrame:
    """Group median broadcast back to each row (one row per group joins back)."""
    med = exact_quantiles(df, [key], value, [0.5], [out])
    return df.join(med, key, "left")


def box_stats(df: DataFrame, key: str = "price_code", value: str = "last_price") -> DataFrame:
    """Box-plot numbers per group: quartiles and whiskers (the most extreme
    values inside 1.5 IQR of the box)."""
    q = exact_quantiles(df, [key], value, [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    q = q.withColumns({"_lf": F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")),
                       "_uf": F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))})
    j = df.select(key, value).join(q, key)
    return (j.groupBy(key, "q1", "median", "q3")
             .agg(F.min(F.when(F.col(value) >= F.col("_lf"), F.col(value))).alias("lower_whisker"),
                  F.max(F.when(F.col(value) <= F.col("_uf"), F.col(value))).alias("upper_whisker"),
                  F.count(F.col(value)).alias("n")))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair (pairwise complete rows), as a
    long table (feature_1, feature_2, correlation) with both directions.

    One pass, and no job before the result is asked for: each Arrow batch gives,
    per pair, the count, mean and centred co-moments of the rows that have both
    (matrix products of the masked values); batches and tasks are merged
    pairwise, so nothing cancels.  A constant column has no correlation (NULL);
    the diagonal is 1."""
    import numpy as np
    import pyarrow as pa

    cols = list(cols)
    d = len(cols)

    def begin(batch):
        x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(d)]).astype(float)
        has = ~np.isnan(x)
        m = has.astype(float)
        shift = np.where(has, x, 0.0).sum(axis=0) / np.maximum(m.sum(axis=0), 1.0)
        x = np.where(has, x - shift, 0.0)
        n, sums = m.T @ m, x.T @ m               # [i, j]: over the rows that have both
        mean = sums / np.maximum(n, 1.0)
        size = (x * x).T @ m                     # of the numbers that the sums were taken of
        return {0: np.stack([n, mean + shift[:, None], size - sums * mean, x.T @ x - sums * mean.T, size]).tobytes()}

    def merge(states):
        n, mean, xx, xy, size = np.frombuffer(states[0]).reshape(5, d, d)
        for s in states[1:]:
            n2, mean2, xx2, xy2, size2 = np.frombuffer(s).reshape(5, d, d)
            both, diff = np.maximum(n + n2, 1.0), mean2 - mean
            weight = n * n2 / both
            xx, xy = xx + xx2 + diff * diff * weight, xy + xy2 + diff * diff.T * weight
            mean, n, size = mean + diff * n2 / both, n + n2, size + size2
        return np.stack([n, mean, xx, xy, size]).tobytes()

    def table(parts: pa.Table) -> pa.Table:
        n, mean, xx, xy, size = np.frombuffer(merge(parts.column("state").to_pylist())).reshape(5, d, d)
        # what rounding leaves of a constant column's variance counts as none
        varies = (xx > 1e-12 * size + 1e-24 * n * mean * mean) & (n > 0)
        spread = np.sqrt(np.where(varies & varies.T, xx * xx.T, 1.0))
        r = np.clip(xy / spread, -1.0, 1.0)
        known = varies & varies.T
        np.fill_diagonal(r, 1.0)
        np.fill_diagonal(known, True)
        i, j = np.divmod(np.arange(d * d), d)
        return pa.table({"feature_1": pa.array([cols[k] for k in i]), "feature_2": pa.array([cols[k] for k in j]),
                         "correlation": pa.array(r.ravel(), mask=~known.ravel())})

    rows = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    parts = tree_merge(task_states(rows, begin, merge), merge)
    return parts.groupBy("key").applyInArrow(table, "feature_1 string, feature_2 string, correlation double")


def high_corr_pairs(corr_long: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Sub-matrix of the features that take part in some |r| >= threshold pair
    (the table holds both directions, so a feature's row tells)."""
    strong = F.max(F.when(F.col("feature_1") != F.col("feature_2"), F.abs("correlation")))
    return (corr_long.withColumn("_a", strong.over(Window.partitionBy("feature_1")))
            .withColumn("_b", strong.over(Window.partitionBy("feature_2")))
            .where((F.col("_a") >= threshold) & (F.col("_b") >= threshold)).drop("_a", "_b"))


def quantile_bounds(df: DataFrame, col: str = "residuals",
                    probs: tuple[float, float] = (0.05, 0.95), k: float = 1.5,
                    approx_accuracy: int | None = None) -> DataFrame:
    """P_lo, P_hi and the bounds P_lo - k*(P_hi-P_lo), P_hi + k*(P_hi-P_lo), one row.

    Exact (linear interpolation, see :func:`exact_quantiles`) by default; pass
    ``approx_accuracy`` to use ``percentile_approx``.
    """
    if approx_accuracy:
        b = df.agg(F.percentile_approx(col, list(probs), approx_accuracy).alias("_q")).select(
            F.col("_q")[0].alias("q_low"), F.col("_q")[1].alias("q_high"))
    else:
        b = exact_quantiles(df, [], col, probs, ["q_low", "q_high"])
    spread = F.col("q_high") - F.col("q_low")
    return b.withColumns({"lower_bound": F.col("q_low") - k * spread,
                          "upper_bound": F.col("q_high") + k * spread})


def residual_outliers(df: DataFrame, label: str, pred: str, event_id: str | None = None,
                      out: str = "is_outlier", k: float = 1.5) -> DataFrame:
    """``residuals = label - pred`` and whether they lie outside the bounds of
    :func:`quantile_bounds` over all rows; with ``event_id`` only that event's
    rows are marked.  The residuals alone are kept for the passes of the exact
    quantiles; their two bounds, one row, then stand in the plan as numbers."""
    r = df.withColumn("residuals", F.col(label).cast("double") - F.col(pred))
    with persisted(r.select("residuals")) as slim:
        b = quantile_bounds(slim, "residuals", k=k).first()
    mark = (F.col("residuals") < F.lit(b["lower_bound"])) | (F.col("residuals") > F.lit(b["upper_bound"]))
    if event_id is not None:
        mark = mark & F.col("event_id").eqNullSafe(event_id)
    return r.withColumn(out, mark)


def rmse_expr(label: str, pred: str) -> Column:
    return F.sqrt(F.avg(F.pow(F.col(label) - F.col(pred), 2)))


def regression_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """RMSE and R^2 in one pass.  The total sum of squares is the count times
    the population variance, which does not cancel; a constant label has no R^2
    (NULL)."""
    y, p = F.col(label).cast("double"), F.col(pred).cast("double")
    n = F.count(F.lit(1))
    sse = F.sum(F.pow(y - p, 2))
    return df.where(F.col(label).isNotNull() & F.col(pred).isNotNull()).agg(
        F.sqrt(F.try_divide(sse, n)).alias("rmse"), (1 - F.try_divide(sse, F.var_pop(y) * n)).alias("r2"), n.alias("n"))


# --- fixed values: Lanczos approximation of the gamma function, g = 7, n = 9 ---
LANCZOS = [0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
           12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7]


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x > 0 (Lanczos; about 1e-13)."""
    z = x - 1
    s = F.lit(LANCZOS[0])
    for i, c in enumerate(LANCZOS[1:], 1):
        s = s + F.lit(c) / (z + i)
    t = z + 7.5
    return F.lit(0.9189385332046727) + (z + 0.5) * F.log(t) - t + F.log(s)    # log(sqrt(2 pi)) first


def nb_log_loss_expr(label: str, pred: str, alpha: float = 1.0) -> Column:
    """Row-wise negative-binomial log likelihood with fixed dispersion ``alpha`` > 0.

    Zero predictions: a zero count is certain then (0); any other count is
    impossible (minus infinity).  No row is left out."""
    if alpha <= 0:
        raise ValueError("alpha must be positive")
    y, mu = F.col(label).cast("double"), F.col(pred).cast("double")
    a = F.lit(float(alpha))
    t1 = log_gamma(y + a) - log_gamma(a) - log_gamma(y + 1) if alpha != 1 else F.lit(0.0)
    t3 = F.when(y == 0, 0.0).when(mu == 0, F.lit(float("-inf"))).otherwise(y * F.log(mu / (a + mu)))
    return t1 + a * F.log(a / (a + mu)) + t3


def nb_log_loss(df: DataFrame, label: str, pred: str, alpha: float = 1.0, count: str | None = None) -> DataFrame:
    """Mean loss over the rows; ``count`` names a column for their number, taken in the same pass."""
    n = [F.count(F.lit(1)).alias(count)] if count else []
    return df.agg((-F.avg(nb_log_loss_expr(label, pred, alpha))).alias("nb_loss"), *n)


def batch_rmse(df: DataFrame, label: str, pred: str, batch_col: str) -> DataFrame:
    """Mean over batches of the per-batch RMSE (not the overall RMSE)."""
    per = df.groupBy(batch_col).agg(rmse_expr(label, pred).alias("_r"))
    return per.agg(F.avg("_r").alias("batch_rmse"), F.count(F.lit(1)).alias("n_batches"))


def score_summary(scores: DataFrame, col: str = "rmse") -> DataFrame:
    """Mean and population standard deviation of fold scores."""
    return scores.agg(F.avg(col).alias("mean_score"), F.stddev_pop(col).alias("std_score"),
                      F.count(F.lit(1)).alias("n_folds"))


def table_means(df: DataFrame, cols: Sequence[str], label_col: str, label: str = "mean") -> DataFrame:
    """Append one row holding the mean of each column."""
    means = df.agg(*[F.avg(c).alias(c) for c in cols]).withColumn(label_col, F.lit(label))
    return df.select(label_col, *[F.col(c).cast("double") for c in cols]).unionByName(means)
