"""Joins of the fact with its dimensions (survey 2.4).

Dimensions here are keyed by team, by calendar date or by (event date,
as-of date): their size is bounded by the league or the calendar, not by the
fact.  No join carries a hint: Spark broadcasts a side whose size it knows to be
below ``autoBroadcastJoinThreshold``, adaptive execution does so once a side
has been measured, and anything larger stays a shuffle join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seatcast import constants as C
from seatcast.operators.features import ffill_bfill


def join_popularity(df: DataFrame, popularity: DataFrame, opponent: str = "opponent") -> DataFrame:
    """Left join ``opponent = data_name``; missing rank -> -1.  ``data_name`` is kept."""
    dim = popularity.select("data_name", "opponent_rank")
    return (df.join(dim, df[opponent] == dim["data_name"], "left")
              .withColumn("opponent_rank", F.coalesce(F.col("opponent_rank").cast("int"), F.lit(-1))))


def ranks_by_fact_date(fact_dates: DataFrame, ranks: DataFrame, date_col: str = "calculate_date",
                       mode: str = "fill") -> DataFrame:
    """Rank per distinct fact date.

    ``mode="fill"`` (reference semantics): exact match on the date, then
    forward fill and back fill along the fact dates; a rank date that is not a
    fact date never propagates.  ``mode="ffill"``: the same without the back fill
    (dates before the first rank stay NULL).  ``mode="asof"``: latest rank date
    <= fact date.
    """
    dates = fact_dates.select(date_col).distinct()
    if mode in ("fill", "ffill"):
        r = ranks.select("rank_date", "van_rank")
        m = dates.join(r, dates[date_col] == F.col("rank_date"), "left").drop("rank_date")
        return ffill_bfill(m, "van_rank", date_col, backward=mode == "fill")
    if mode == "asof":
        r = ranks.select(F.col("rank_date").alias(date_col), F.col("van_rank"),
                         F.lit(0).alias("_is_fact"))
        d = dates.select(date_col, F.lit(None).cast("int").alias("van_rank"), F.lit(1).alias("_is_fact"))
        w = Window.orderBy(date_col, "_is_fact").rowsBetween(Window.unboundedPreceding, 0)
        u = r.unionByName(d).withColumn("van_rank", F.last("van_rank", ignorenulls=True).over(w))
        return u.where(F.col("_is_fact") == 1).drop("_is_fact")
    raise ValueError(f"unknown mode {mode!r}")


def join_ranking_asof(df: DataFrame, ranks: DataFrame, date_col: str = "calculate_date",
                      mode: str = "fill", fact_dates: DataFrame | None = None) -> DataFrame:
    """Add ``van_rank`` to every fact row (see :func:`ranks_by_fact_date`).

    The fill runs on the distinct fact dates only (one row per calendar day);
    the result goes back to the fact through an equi-join, so the fact is never
    ordered globally.  ``fact_dates`` gives the dates where ``df`` holds only
    some of the fact's rows, or where a cheaper frame has them.
    """
    dim = ranks_by_fact_date(df if fact_dates is None else fact_dates, ranks, date_col, mode)
    return df.join(dim, date_col, "left").withColumn("van_rank", F.col("van_rank").cast("int"))


def web_daily(web: DataFrame, prefix: str = C.DEFAULT_HOME_PREFIX) -> DataFrame:
    """Web analytics per (event date, as-of date): home events only, as-of on
    or before the event, duplicates collapsed by max."""
    return (web.where(F.col("Event_Name").startswith(prefix))
               .where(F.col("as_of_date") <= F.col("Event_Date"))
               .groupBy("Event_Date", "as_of_date")
               .agg(F.max("unique_views").alias("unique_views"),
                    F.max("order_qty").alias("order_qty"),
                    F.max("tkt_qty").alias("tkt_qty")))


def join_web_analytics(df: DataFrame, web: DataFrame, prefix: str = C.DEFAULT_HOME_PREFIX) -> DataFrame:
    """Left join on (event_date, calculate_date) = (Event_Date, as_of_date)."""
    # Spark resolves names case-insensitively: rename the web keys so that
    # dropping them cannot touch the fact's ``event_date``.
    dim = web_daily(web, prefix).withColumnsRenamed(
        {"Event_Date": "_web_event_date", "as_of_date": "_web_as_of_date"})
    cond = (df["event_date"] == dim["_web_event_date"]) & (df["calculate_date"] == dim["_web_as_of_date"])
    return df.join(dim, cond, "left").drop("_web_event_date", "_web_as_of_date")


def join_inner_team(a: DataFrame, b: DataFrame, on: str = "team",
                    suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Inner join of two per-team tables; clashing columns get pandas-style suffixes."""
    clash = [c for c in a.columns if c in b.columns and c != on]
    a2 = a.withColumnsRenamed({c: c + suffixes[0] for c in clash})
    b2 = b.withColumnsRenamed({c: c + suffixes[1] for c in clash})
    return a2.join(b2, on, "inner")


def dates_to_fetch(fact: DataFrame, existing: DataFrame | None = None,
                   date_col: str = "calculate_date") -> DataFrame:
    """Distinct Mondays among fact dates, plus the earliest fact date when it is
    not a Monday, minus dates already stored (``existing.rank_date``)."""
    dates = fact.select(F.col(date_col).alias("rank_date")).distinct()
    mondays = dates.where(F.weekday("rank_date") == 0)
    first = fact.agg(F.min(date_col).alias("rank_date")).where(F.weekday("rank_date") != 0)
    wanted = mondays.unionByName(first)
    if existing is not None:
        wanted = wanted.join(existing.select("rank_date"), "rank_date", "left_anti")
    return wanted


def membership_join(df: DataFrame, dates: DataFrame, date_col: str = "calculate_date") -> DataFrame:
    """Rows whose date is in ``dates`` (left semi join)."""
    return df.join(dates.select(F.col(dates.columns[0]).alias(date_col)).distinct(), date_col, "left_semi")


def team_alias(df: DataFrame, aliases: DataFrame, team: str = "team", out: str = "data_name") -> DataFrame:
    """Map team -> short name through an alias table (left join; unmapped -> NULL)."""
    dim = aliases.select(F.col("team").alias(team), F.col("data_name").alias(out))
    return df.join(dim, team, "left")


def flatten_standings(payload: DataFrame) -> DataFrame:
    """Nested standings -> one row per (rank_date, team); an empty array gives no row."""
    t = payload.select("rank_date", F.explode("standings").alias("t"))
    return t.select("rank_date", F.col("t.teamName.default").alias("team_name"),
                    *[F.col(f"t.{c}").alias(n) for c, n in [
                        ("points", "points"), ("wins", "wins"), ("losses", "losses"),
                        ("otLosses", "ot_losses"), ("goalDifferential", "goal_differential"),
                        ("goalFor", "goal_for"), ("goalAgainst", "goal_against")]])


def team_rank_by_date(standings: DataFrame, home_team: str) -> DataFrame:
    """Competition rank of ``home_team`` by points per date -> (rank_date, van_rank)."""
    w = Window.partitionBy("rank_date").orderBy(F.desc("points"))
    return (standings.withColumn("van_rank", F.rank().over(w).cast("int"))
                     .where(F.col("team_name") == home_team)
                     .select("rank_date", "van_rank"))


def union_append(existing: DataFrame, new: DataFrame, key: str = "rank_date") -> DataFrame:
    """Append new rows to stored ones; a key already stored keeps the stored row."""
    fresh = new.join(existing.select(key), key, "left_anti")
    return existing.unionByName(fresh)


def popularity_table(fans: DataFrame, social: DataFrame, aliases: DataFrame,
                     rivals: Sequence[str] = ()) -> DataFrame:
    """Derive ``team, data_name, opponent_rank`` from two per-team rankings:
    inner join, rank sum, dense rank, terciles (right-closed), rival override."""
    from seatcast.operators.features import dense_rank_overall, tercile_bucket
    m = join_inner_team(social, fans).withColumn("overall", F.col("ranking_x") + F.col("ranking_y"))
    m = dense_rank_overall(m, "overall")
    m = tercile_bucket(m, "overall_rank", "opponent_rank", overrides=rivals)
    return team_alias(m, aliases).select("team", "data_name", "opponent_rank")
