"""Pricing what-if operators (survey 2.10).

Every operator takes the rows to vary and a *scorer*: a function
``DataFrame -> DataFrame`` that adds a ``prediction`` column (a fitted
``PipelineModel.transform`` or a fixed column expression).  A price grid is an
``explode`` of a literal sequence, so N scenarios are one generate node and
one scoring pass -- never N copies of the frame, never a cartesian exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatcast import constants as C
from seatcast.functions import columns as X
from seatcast.operators.aggregates import price_range_by_code
from seatcast.operators.models import scored

Scorer = Callable[[DataFrame], DataFrame]


def linear_scorer(weights: Mapping[str, float], intercept: float = 0.0,
                  floor_at: float | None = 0.0, out: str = "prediction") -> Scorer:
    """Fixed-coefficient scorer ``intercept + sum(w * coalesce(x, 0))`` (floored)."""
    def score(df: DataFrame) -> DataFrame:
        e = F.lit(float(intercept))
        for c, w in weights.items():
            e = e + F.lit(float(w)) * F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        if floor_at is not None:
            e = F.greatest(e, F.lit(float(floor_at)))
        return df.withColumn(out, e)
    return score


def model_scorer(model, out: str = "prediction") -> Scorer:
    """Scorer of a fitted model; the grid column keeps its values."""
    return lambda df: scored(model, df, out)


def with_grid(rows: DataFrame, lo, hi, n: int, value_col: str = "grid_value",
              idx_col: str = "grid_idx") -> DataFrame:
    """Each row x ``n`` evenly spaced values in [lo, hi] (lo/hi: numbers or columns)."""
    return rows.select("*", F.posexplode(X.linspace(lo, hi, n)).alias(idx_col, value_col))


def demand_curve_price(rows: DataFrame, scorer: Scorer, reference: DataFrame | None = None,
                       n: int = C.PRICE_GRID_POINTS, keys: Sequence[str] = ()) -> DataFrame:
    """Each selected row x ``n`` prices between its code's min and max
    ``last_price`` (range taken on ``reference``); only ``last_price`` changes.
    A code that the reference lacks, NULL included, takes its range from the
    rows themselves, so every row keeps its curve."""
    known = price_range_by_code(reference if reference is not None else rows).withColumnsRenamed(
        {"price_code": "_code", "min_price": "_min", "max_price": "_max"})
    own = price_range_by_code(rows).withColumnsRenamed({"price_code": "_own"})
    g = (rows.join(known, F.col("price_code").eqNullSafe(F.col("_code")), "left")
         .join(own, F.col("price_code").eqNullSafe(F.col("_own")), "left"))
    lo, hi = F.coalesce("_min", "min_price"), F.coalesce("_max", "max_price")
    g = with_grid(g.withColumn("_lo", lo).withColumn("_hi", hi), F.col("_lo"), F.col("_hi"), n)
    g = g.withColumn("last_price", F.col("grid_value")).drop(
        "_code", "_own", "_min", "_max", "min_price", "max_price", "_lo", "_hi", "grid_value")
    curve = scorer(g)
    return curve.select(*keys, "grid_idx", "last_price", "prediction") if keys else curve


def demand_curve_ratio(rows: DataFrame, scorer: Scorer, grid: tuple[float, float] = C.RATIO_GRID,
                       n: int = C.PRICE_GRID_POINTS, keys: Sequence[str] = ()) -> DataFrame:
    """``times_above_floor`` over the grid for each row; price = ratio x floor.
    One curve per row key (sorted by price at the sink)."""
    g = with_grid(rows, grid[0], grid[1], n).withColumn("times_above_floor", F.col("grid_value"))
    g = g.withColumn("curve_price", F.col("grid_value") * F.col("price_floor")).drop("grid_value")
    curve = scorer(g)
    return curve.select(*keys, "grid_idx", "times_above_floor", "curve_price", "prediction") if keys else curve


def aggregate_sales_curve(rows: DataFrame, scorer: Scorer, group: str = "opponent",
                          grid: tuple[float, float] = C.RATIO_GRID,
                          n: int = C.PRICE_GRID_POINTS) -> DataFrame:
    """Set the ratio for all rows of a group to each grid value and sum the
    predictions per (group, grid point): all groups in one job."""
    g = with_grid(rows, grid[0], grid[1], n).withColumn("times_above_floor", F.col("grid_value"))
    return (scorer(g).groupBy(group, "grid_idx")
            .agg(F.first("grid_value").alias("times_above_floor"),
                 F.sum("prediction").alias("total_prediction")))


def price_change_impact(rows: DataFrame, scorer: Scorer, group: str = "opponent",
                        grid: tuple[float, float] = C.MULTIPLIER_GRID,
                        n: int = C.PRICE_GRID_POINTS, floors: Mapping[str, float] | None = None) -> DataFrame:
    """Multiply the ratio by each grid multiplier for rows with a known price
    code (others keep their ratio); sum predictions per (group, multiplier)."""
    known = F.col("price_code").isin(sorted((floors or C.PRICE_FLOOR).keys()))
    g = with_grid(rows, grid[0], grid[1], n).withColumn(
        "times_above_floor",
        F.when(known, F.col("times_above_floor") * F.col("grid_value")).otherwise(F.col("times_above_floor")))
    return (scorer(g).groupBy(group, "grid_idx")
            .agg(F.first("grid_value").alias("multiplier"),
                 F.sum("prediction").alias("total_prediction")))
