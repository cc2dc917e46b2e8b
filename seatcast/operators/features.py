"""Feature columns (survey 2.3) and window operators (survey 2.6).

Series windows are keyed by ``event_id`` first.  ``co_locate_events`` hash
partitions the fact once on ``event_id``; every later window keyed by
(event_id, ...) reuses that partitioning, so lead, lags and the per-day sums
cost one exchange.  An event's rows are bounded by price levels x sale days,
whatever the total data size, so no partition can grow with the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seatcast import constants as C
from seatcast.functions import columns as X

SERIES_KEYS = ("event_id", "price_code")
ORDER_COL = "calculate_date"


# --------------------------------------------------------------------- 2.3 --
def add_weekend_month(df: DataFrame, date_col: str = "event_date") -> DataFrame:
    return df.withColumns({"weekend_game": X.is_weekend(date_col), "month": F.month(date_col)})


def add_days_until_game(df: DataFrame) -> DataFrame:
    return df.withColumn("days_until_game", X.days_between("event_date", "calculate_date"))


def add_bowl_location(df: DataFrame, codes: Sequence[str] = tuple(C.LOWER_BOWL_CODES)) -> DataFrame:
    """1 = lower bowl (code in the lower-bowl set), else 0; NULL -> 0."""
    return df.withColumn("bowl_location", X.in_codes("price_code", codes))


def add_price_code_ordinal(df: DataFrame, ordinals: dict | None = None) -> DataFrame:
    """Code -> ordinal via a literal map (31 fixed codes: no join)."""
    return df.withColumn("price_code_ordinal",
                         X.lookup("price_code", ordinals or C.PRICE_CODE_ORDINAL, "int"))


def add_price_floor_ratio(df: DataFrame, floors: dict | None = None) -> DataFrame:
    """``price_floor`` by code and ``times_above_floor = last_price / price_floor``."""
    return (df.withColumn("price_floor", X.lookup("price_code", floors or C.PRICE_FLOOR, "double"))
              .withColumn("times_above_floor", X.safe_ratio("last_price", "price_floor")))


def add_inventory_normalized(df: DataFrame) -> DataFrame:
    """``pminventory / cap``; a zero capacity gives NULL instead of inf/NaN."""
    return df.withColumn("inventory_normalized", X.safe_ratio("pminventory", "cap"))


def add_season_label(df: DataFrame, date_col: str = "event_date", out: str = "season") -> DataFrame:
    return df.withColumn(out, X.season_label(date_col))


def add_date_string(df: DataFrame, date_col: str, out: str | None = None) -> DataFrame:
    return df.withColumn(out or date_col, X.format_ymd(date_col))


# --------------------------------------------------------------------- 2.6 --
def co_locate_events(df: DataFrame, key: str = "event_id", partitions: int | None = None) -> DataFrame:
    """One hash exchange on the event key, shared by all later event windows."""
    return df.repartition(partitions, key) if partitions else df.repartition(key)


def _series_window(keys: Sequence[str] = SERIES_KEYS, order: str = ORDER_COL):
    return Window.partitionBy(*keys).orderBy(order)


def shift_target(df: DataFrame, drop_unlabelled: bool = True, source: str = "host_sold_yesterday",
                 target: str = C.TARGET, keys: Sequence[str] = SERIES_KEYS,
                 order: str = ORDER_COL) -> DataFrame:
    """Target = the next row's ``source`` within the series (today's sales).

    Training (``drop_unlabelled``): keep target >= 0, which also drops each
    series' last row.  Serving: keep every row, last target NULL.
    """
    out = df.withColumn(target, F.lead(source, 1).over(_series_window(keys, order)))
    return out.where(F.col(target) >= 0) if drop_unlabelled else out


def lag_sales(df: DataFrame, days: int = 7, target: str = C.TARGET,
              keys: Sequence[str] = SERIES_KEYS, order: str = ORDER_COL) -> DataFrame:
    """``tickets_sold_{i}_days_before_today`` = lag i of the target, i = 2..days
    (row based: gaps left by filters are not filled).  All lags share one window."""
    w = _series_window(keys, order)
    return df.withColumns({f"tickets_sold_{i}_days_before_today": F.lag(target, i).over(w)
                           for i in range(2, days + 1)})


def sold_agg_day(df: DataFrame, source: str = "host_sold_yesterday") -> DataFrame:
    """Sum of ``source`` per (event, day) and per (event, day, bowl) on each row.
    An all-NULL group sums to 0 (pandas semantics)."""
    w_day = Window.partitionBy("event_id", "calculate_date")
    w_bowl = Window.partitionBy("event_id", "calculate_date", "bowl_location")
    return df.withColumns({
        "host_sold_agg_last_day": F.coalesce(F.sum(source).over(w_day), F.lit(0)),
        "host_sold_agg_last_day_samebowl": F.coalesce(F.sum(source).over(w_bowl), F.lit(0)),
    })


def ffill_bfill(df: DataFrame, col: str, order: Sequence[str] | str,
                partition: Sequence[str] = (), backward: bool = True) -> DataFrame:
    """Forward fill, then (optionally) backward fill ``col`` along ``order``.

    Without ``partition`` this is one ordered pass, so callers use it on small,
    domain-bounded frames (e.g. distinct calendar dates), never on a fact.
    """
    order = [order] if isinstance(order, str) else list(order)
    w = Window.partitionBy(*partition).orderBy(*order) if partition else Window.orderBy(*order)
    fwd = F.last(col, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    if not backward:
        return df.withColumn(col, fwd)
    bwd = F.first(col, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return df.withColumn(col, F.coalesce(fwd, bwd))


def rank_min_desc(df: DataFrame, partition: Sequence[str] | str, order_col: str,
                  out: str = "rank") -> DataFrame:
    """Competition rank (ties share the smallest rank, gap after) by ``order_col`` desc."""
    partition = [partition] if isinstance(partition, str) else list(partition)
    return df.withColumn(out, F.rank().over(Window.partitionBy(*partition)
                                            .orderBy(F.desc(order_col))).cast("int"))


def dense_rank_overall(df: DataFrame, col: str, out: str = "overall_rank") -> DataFrame:
    """Dense rank ascending over the whole frame: for bounded frames (teams)."""
    return df.withColumn(out, F.dense_rank().over(Window.orderBy(col)).cast("int"))


def tercile_bucket(df: DataFrame, col: str, out: str = "opponent_rank",
                   overrides: Sequence[str] = (), override_col: str = "team") -> DataFrame:
    """Label 1/2/3 by the 1/3 and 2/3 quantiles of ``col`` (linear interpolation),
    bins closed on the right; rows whose ``override_col`` is listed get 1.

    For bounded frames (teams): the sorted values are one array in a window, so
    the frame is worked out once."""
    from seatcast.operators.aggregates import linear_quantile
    values = F.sort_array(F.collect_list(col).over(Window.partitionBy()))
    q1, q2 = linear_quantile(values, 1.0 / 3.0), linear_quantile(values, 2.0 / 3.0)
    label = F.when(F.col(col) <= q1, 1).when(F.col(col) <= q2, 2).otherwise(3)
    if overrides:
        label = F.when(F.col(override_col).isin(list(overrides)), 1).otherwise(label)
    return df.withColumn(out, label.cast("int"))


def sequence_window(df: DataFrame, features: Sequence[str], group: str = "opponent",
                    order: Sequence[str] = ("calculate_date", "price_code_ordinal"),
                    tie_break: Sequence[str] = ("event_id", "price_code"),
                    length: int = C.SEQUENCE_LENGTH, out: str = "sequence") -> DataFrame:
    """The last ``length`` rows (current included) of each ``group``, ordered by
    ``order`` + ``tie_break``, as an array of feature arrays.

    Skew-safe: a group (an opponent) may hold a large share of all rows, so it
    is never sent whole to one task.  Same-day context comes from a window per
    (group, day); earlier-day context comes from each day's last ``length-1``
    rows, carried through a window over the (group, day) table, which has one
    row per day.  The largest partition is one group-day.
    """
    need = length - 1
    day_col, within = order[0], list(order[1:]) + list(tie_break)
    feats = F.array(*[F.col(c).cast("double") for c in features])
    rows = df.withColumn("_f", feats)
    if need == 0:
        return rows.withColumn(out, F.array("_f")).drop("_f")

    # NULLs sort last, as in pandas; the same key order is used by the window
    # and by the struct sort of each day's tail.
    keys = []
    for c in within:
        keys += [F.col(c).isNull(), F.col(c)]
    w_day = Window.partitionBy(group, day_col).orderBy(*keys)
    w_day_desc = Window.partitionBy(group, day_col).orderBy(*[k.desc() for k in keys])
    rows = rows.withColumns({
        "_same": F.collect_list("_f").over(w_day.rowsBetween(-need, -1)),
        "_rn_desc": F.row_number().over(w_day_desc),
    })
    key_struct = F.struct(*[k.alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_f").alias("_f"))
    tails = (rows.where(F.col("_rn_desc") <= need)
             .groupBy(group, day_col)
             .agg(F.transform(F.array_sort(F.collect_list(key_struct)), lambda s: s["_f"]).alias("_tail")))
    w_prev = Window.partitionBy(group).orderBy(day_col).rowsBetween(-need, -1)
    days = tails.withColumn("_prev", F.flatten(F.collect_list("_tail").over(w_prev))).drop("_tail")
    joined = rows.join(days, [group, day_col], "left")
    ctx = F.concat(F.coalesce(F.col("_prev"), F.array().cast("array<array<double>>")), F.col("_same"))
    n = F.size(ctx)
    ctx_last = F.when(n > need, F.slice(ctx, n - need + 1, need)).otherwise(ctx)
    return (joined.withColumn(out, F.concat(ctx_last, F.array("_f")))
                  .drop("_f", "_same", "_rn_desc", "_prev"))


def pad_sequence(df: DataFrame, seq: str = "sequence", max_length: int = C.SEQUENCE_MAX_LENGTH,
                 width: int | None = None, out: str | None = None) -> DataFrame:
    """Zero-pad at the end (or keep the last ``max_length``) to a fixed length."""
    if width is None:
        raise ValueError("width (number of features per step) is required")
    return df.withColumn(out or seq, X.pad_or_truncate(seq, max_length, width))


