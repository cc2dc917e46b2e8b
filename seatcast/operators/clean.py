"""Projections, filters and predicates over the snapshot fact (survey 2.2).

NULL handling follows the reference's pandas semantics, which differ from
SQL three-valued logic: ``!=`` and ``~isin`` keep NULL rows, range exclusion
keeps NULL dates, and numeric comparisons drop NULLs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatcast import constants as C
from seatcast import schemas
from seatcast.functions import columns as X


def extract_event_date(df: DataFrame, identifier: str = "identifier",
                       out: str = "event_date", pattern: str = C.EVENT_DATE_PATTERN) -> DataFrame:
    return df.withColumn(out, X.event_date_from_identifier(identifier, pattern))


def extract_opponent(df: DataFrame, home_prefix: str = C.DEFAULT_HOME_PREFIX,
                     name: str = "event_name", out: str = "opponent") -> DataFrame:
    return df.withColumn(out, X.opponent_from_name(name, home_prefix))


def extract_price_code(df: DataFrame, level: str = "price_level_name",
                       out: str = "price_code") -> DataFrame:
    return df.withColumn(out, X.price_code_from_level(level))


def filter_start_date(df: DataFrame, start_date: str = C.DEFAULT_START_DATE,
                      date_col: str = "event_date") -> DataFrame:
    """Keep ``date_col > start_date`` (strict); NULL dates drop."""
    return df.where(F.col(date_col) > F.lit(start_date).cast("date"))


def filter_excluded_events(df: DataFrame, excluded: Sequence[str] = tuple(C.DEFAULT_EXCLUDED_EVENTS),
                           name: str = "event_name") -> DataFrame:
    """Drop listed event names; NULL names stay (pandas ``~isin``)."""
    if not excluded:
        return df
    return df.where(~F.coalesce(F.col(name).isin(list(excluded)), F.lit(False)))


def filter_valid_sold(df: DataFrame, threshold: int = 0, col: str = "host_sold_yesterday") -> DataFrame:
    """Keep ``col >= threshold``; NULL drops."""
    return df.where(F.col(col) >= threshold)


def filter_price_code(df: DataFrame, code: str = C.DROPPED_PRICE_CODE,
                      col: str = "price_code") -> DataFrame:
    """Drop one price code; NULL codes stay."""
    return df.where(~F.col(col).eqNullSafe(code))


def filter_preseason(df: DataFrame,
                     ranges: Sequence[tuple[str, str]] = tuple(C.DEFAULT_PRESEASON_RANGES),
                     date_col: str = "event_date") -> DataFrame:
    """Drop rows whose date falls in any inclusive range; NULL dates stay.

    The ranges are a handful of literals, so an OR of ``between`` predicates is
    used (stays in codegen, no join).
    """
    if not ranges:
        return df
    d = F.col(date_col)
    hit = None
    for lo, hi in ranges:
        c = d.between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
        hit = c if hit is None else (hit | c)
    return df.where(~F.coalesce(hit, F.lit(False)))


def filter_lead_days(df: DataFrame, days: int = C.DEFAULT_DAYS_BEFORE_EVENT,
                     event_col: str = "event_date", calc_col: str = "calculate_date") -> DataFrame:
    """Keep ``event_date - calculate_date <= days`` (no lower bound; NULL drops)."""
    return df.where(F.datediff(F.col(event_col), F.col(calc_col)) <= days)


def fill_initial_price(df: DataFrame) -> DataFrame:
    """``last_price == 0`` -> ``initial_price``; NULL stays NULL."""
    return df.withColumn("last_price", F.when(F.col("last_price") == 0, F.col("initial_price"))
                         .otherwise(F.col("last_price")))


def cast_drop(df: DataFrame, drop: Sequence[str] = tuple(schemas.HOUSEKEEPING_COLUMNS)) -> DataFrame:
    """Cast the ticket total to BIGINT and drop housekeeping columns that exist."""
    out = df
    if "ticket_sold_total" in df.columns:
        out = out.withColumn("ticket_sold_total", F.col("ticket_sold_total").cast("bigint"))
    present = [c for c in drop if c in df.columns]
    return out.drop(*present) if present else out


def select_numeric(df: DataFrame, drop: Sequence[str] = ()) -> DataFrame:
    """Keep numeric columns only (schema-driven), minus ``drop``."""
    keep = [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in set(drop)]
    return df.select(*keep)


def filter_report_slice(df: DataFrame, event_ids: Sequence[str] | None = None,
                        codes: Sequence[str] | None = None, max_price: float | None = None,
                        price_col: str = "initial_price", min_date: str | None = None,
                        date_col: str = "event_date") -> DataFrame:
    """Report slices: event ids, price-code list, price ceiling, date floor."""
    out = df
    if event_ids is not None:
        out = out.where(F.col("event_id").isin(list(event_ids)))
    if codes is not None:
        out = out.where(F.col("price_code").isin(list(codes)))
    if max_price is not None:
        out = out.where(F.col(price_col) <= max_price)
    if min_date is not None:
        out = out.where(F.col(date_col) >= F.lit(min_date).cast("date"))
    return out


def latest_snapshot(df: DataFrame, date_col: str = "calculate_date") -> DataFrame:
    """Rows of the latest ``date_col``: a scalar subquery, so the max is one
    partial aggregate and the filter is a plain predicate on the scan side."""
    latest = df.select(F.max(date_col)).scalar()
    return df.where(F.col(date_col) == latest)


def distinct_values(df: DataFrame, cols: Sequence[str] | str) -> DataFrame:
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.select(*cols).distinct()
