"""The reference's stage order as one lazy DataFrame plan.

``preprocess``: date -> price code -> drop V -> start date -> excluded events
-> preseason -> opponent -> valid sold -> target -> lags -> 30 days -> fill
price -> cast/drop.  Lead/lag run after the row filters (row-based gaps) and
before the 30-day filter (lags see older days), as in the reference.

``feature_engineer``: calendar, lead time, popularity, standings rank, bowl,
per-day sums, web analytics, ordinal, floor ratio, inventory ratio.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatcast import constants as C
from seatcast.operators import clean, features, joins


@dataclass(frozen=True)
class PreprocessParams:
    start_date: str = C.DEFAULT_START_DATE
    excluded_events: Sequence[str] = tuple(C.DEFAULT_EXCLUDED_EVENTS)
    preseason_ranges: Sequence[tuple[str, str]] = tuple(C.DEFAULT_PRESEASON_RANGES)
    home_prefix: str = C.DEFAULT_HOME_PREFIX
    sold_threshold: int = 0
    lag_days: int = 7
    days_before_event: int = C.DEFAULT_DAYS_BEFORE_EVENT
    training: bool = True           # False: serving variant (keep unlabelled rows, no drop)
    co_locate: bool = True          # one exchange on event_id for all series windows


@dataclass(frozen=True)
class FeatureParams:
    web_prefix: str = C.DEFAULT_HOME_PREFIX
    rank_mode: str = "fill"
    lower_bowl: Sequence[str] = field(default_factory=lambda: tuple(C.LOWER_BOWL_CODES))


def row_filters(df: DataFrame, p: PreprocessParams = PreprocessParams()) -> DataFrame:
    """The steps that look at one row only."""
    out = clean.extract_event_date(df)
    out = clean.extract_price_code(out)
    out = clean.filter_price_code(out)
    out = clean.filter_start_date(out, p.start_date)
    out = clean.filter_excluded_events(out, p.excluded_events)
    out = clean.filter_preseason(out, p.preseason_ranges)
    out = clean.extract_opponent(out, p.home_prefix)
    return clean.filter_valid_sold(out, p.sold_threshold)


def series_steps(out: DataFrame, p: PreprocessParams = PreprocessParams()) -> DataFrame:
    """The steps that look at a whole series, and those after them."""
    if p.co_locate:
        out = features.co_locate_events(out)
    out = features.shift_target(out, drop_unlabelled=p.training)
    out = features.lag_sales(out, p.lag_days)
    out = clean.filter_lead_days(out, p.days_before_event)
    out = clean.fill_initial_price(out)
    return clean.cast_drop(out) if p.training else out


def preprocess(df: DataFrame, p: PreprocessParams = PreprocessParams()) -> DataFrame:
    return series_steps(row_filters(df, p), p)


def feature_engineer(df: DataFrame, popularity: DataFrame, ranks: DataFrame, web: DataFrame,
                     p: FeatureParams = FeatureParams(), fact_dates: DataFrame | None = None) -> DataFrame:
    out = features.add_weekend_month(df)
    out = features.add_days_until_game(out)
    out = joins.join_popularity(out, popularity)
    out = joins.join_ranking_asof(out, ranks, mode=p.rank_mode, fact_dates=fact_dates)
    out = features.add_bowl_location(out, p.lower_bowl)
    out = features.sold_agg_day(out)
    out = joins.join_web_analytics(out, web, p.web_prefix)
    out = features.add_price_code_ordinal(out)
    out = features.add_price_floor_ratio(out)
    out = features.add_inventory_normalized(out)
    return out


def latest_features(df: DataFrame, popularity: DataFrame, ranks: DataFrame, web: DataFrame,
                    p: PreprocessParams, f: FeatureParams = FeatureParams()) -> DataFrame:
    """Serving features of the last day only.

    The day comes from the filtered rows, without any window.  Only the events
    on sale that day are kept for the series windows (whole series, so leads
    and lags are those of the full history), and only the day's rows get
    features.  The rank fill still runs over all fact dates."""
    rows = row_filters(df, p)
    served = clean.filter_lead_days(rows, p.days_before_event)
    day = served.select(F.max("calculate_date")).scalar()
    on_sale = served.where(F.col("calculate_date") == day).select("event_id").distinct()
    out = series_steps(rows.join(on_sale, "event_id", "left_semi"), p).where(F.col("calculate_date") == day)
    return feature_engineer(out, popularity, ranks, web, f, fact_dates=served.select("calculate_date"))
