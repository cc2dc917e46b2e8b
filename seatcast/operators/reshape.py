"""Sort, top-k and reshape operators (survey 2.7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sort_rows(df: DataFrame, keys: Sequence[str], descending: Sequence[bool] | None = None) -> DataFrame:
    """Multi-key sort: only for sinks; windows carry their own order."""
    descending = descending or [False] * len(keys)
    return df.orderBy(*[F.desc(k) if d else F.asc(k) for k, d in zip(keys, descending)])


def top_n(df: DataFrame, value: str, n: int, tie_keys: Sequence[str] = (),
          columns: Sequence[str] | None = None) -> DataFrame:
    """The ``n`` largest rows by ``value`` (TakeOrderedAndProject: each task
    keeps its own top n, so nothing is shuffled in full)."""
    out = df.orderBy(F.desc(value), *[F.asc(k) for k in tie_keys]).limit(n)
    return out.select(*columns) if columns else out


def top_coefficients(coef: DataFrame, n: int = 20) -> DataFrame:
    return top_n(coef, "magnitude", n, ["feature"])


def melt(df: DataFrame, id_vars: Sequence[str], value_vars: Sequence[str],
         var_name: str = "variable", value_name: str = "value") -> DataFrame:
    """Wide -> long (``unpivot``); value columns are cast to a common double."""
    wide = df.select(*id_vars, *[F.col(c).cast("double").alias(c) for c in value_vars])
    return wide.unpivot(list(id_vars), list(value_vars), var_name, value_name)


def scenario_union(df: DataFrame, column: str, values: Sequence[float],
                   scenario_col: str = "scenario") -> DataFrame:
    """Copies of ``df`` with ``column`` set to each value, as one frame.

    Expressed as one ``explode`` over a literal array (a generate node, no
    union of N plans and no cartesian exchange)."""
    arr = F.array(*[F.lit(float(v)) for v in values])
    return (df.select("*", F.posexplode(arr).alias(scenario_col, "_val"))
              .withColumn(column, F.col("_val")).drop("_val"))
