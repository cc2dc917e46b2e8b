"""Registered queries: one per operator of the survey inventory.

Each entry is ``(spark, sf_dir) -> DataFrame`` over the stand-in inputs
(``seatcast.plans.inputs``); ``ORACLE`` holds the DuckDB twin where the
operator is expressible in SQL.  Queries run over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from seatcast import constants as C
from seatcast import schemas
from seatcast.operators import aggregates as A
from seatcast.operators import clean, features, joins
from seatcast.plans import inputs as I
from seatcast.plans.oracle import with_base
from seatcast.sources import files
from seatcast.sources import testdata as td

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

KEYS = ["event_id", "price_code", "calculate_date"]
SKEYS = ["event_id", "price_level_name", "calculate_date"]


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _k(cols=KEYS) -> str:
    return ", ".join(cols)


# ------------------------------------------------------------------ 2.1 ----
@register("scan_combine", with_base(
    "SELECT * EXCLUDE (holds), CASE WHEN calculate_date < DATE '1998-01-01' THEN NULL ELSE holds END AS holds "
    "FROM snapshot"))
def q_scan_combine(spark: SparkSession, d: str) -> DataFrame:
    s = I.snapshot(spark, d)
    root = files.scratch_path(spark, "combine")
    early = F.col("calculate_date") < F.lit("1998-01-01").cast("date")
    files.sink_parquet(s.where(early).drop("holds"), f"{root}/y1/part_a")
    files.sink_parquet(s.where(~early), f"{root}/y2/nested/part_b")
    spark.createDataFrame([("not parquet",)], "line string").write.mode("overwrite").text(f"{root}/notes")
    return files.scan_combine(spark, root)


@register("scan_csv_glob", with_base("SELECT * FROM snapshot"))
def q_scan_csv_glob(spark: SparkSession, d: str) -> DataFrame:
    s = I.snapshot(spark, d)
    root = files.scratch_path(spark, "csv")
    early = F.col("calculate_date") < F.lit("1998-01-01").cast("date")
    files.sink_csv(s.where(early), f"{root}/day_a")
    files.sink_csv(s.where(~early), f"{root}/day_b")
    return files.scan_csv_glob(spark, f"{root}/day_*/*.csv", s.schema)


@register("scan_daily_stream", with_base("SELECT * FROM snapshot"))
def q_scan_daily_stream(spark: SparkSession, d: str) -> DataFrame:
    """Daily drops as CSV files, ingested incrementally with Structured Streaming."""
    from seatcast.streaming import ingest_daily_drops
    s = I.snapshot(spark, d)
    root = files.scratch_path(spark, "drops")
    early = F.col("calculate_date") < F.lit("1998-01-01").cast("date")
    files.sink_csv(s.where(early), f"{root}/in/day_1")
    files.sink_csv(s.where(~early), f"{root}/in/day_2")
    ingest_daily_drops(spark, f"{root}/in/*", f"{root}/table", f"{root}/_checkpoint", s.schema)
    return spark.read.parquet(f"{root}/table")


@register("scan_dim_csv", with_base("SELECT team, data_name, opponent_rank FROM popularity"))
def q_scan_dim_csv(spark: SparkSession, d: str) -> DataFrame:
    path = files.sink_csv(I.popularity(spark, d), files.scratch_path(spark, "popularity"))
    return files.scan_dim_csv(spark, path, schemas.OPPONENT_POPULARITY)


RAW_COLS = [f.name for f in schemas.SNAPSHOT.fields]


@register("ingest_raw", with_base(
    f"SELECT {', '.join(RAW_COLS)} FROM (SELECT * REPLACE (CAST(ticket_sold_total AS BIGINT) AS ticket_sold_total) FROM snapshot)"))
def q_ingest_raw(spark: SparkSession, d: str) -> DataFrame:
    """The snapshot exported with raw names and text dates, one file with its
    columns in another order and a row without a key, and read back."""
    s = I.snapshot(spark, d).select(*RAW_COLS).withColumn("calculate_date", F.date_format("calculate_date", "MM/dd/yyyy"))
    s = schemas.to_raw_names(s.withColumn("ticket_sold_total", F.col("ticket_sold_total").cast("bigint")))
    root = files.scratch_path(spark, "raw")
    early = F.col("calculate_date").endswith("1996")
    files.sink_csv(s.where(early), f"{root}/day_a")
    files.sink_csv(s.where(~early).select(*reversed(s.columns)), f"{root}/day_b")
    files.sink_csv(s.limit(1).withColumn("event_id", F.lit(None).cast("string")), f"{root}/day_c")
    text = StructType([StructField(f.name, StringType()) for f in s.schema.fields])
    good, _ = files.ingest_raw(files.scan_csv_glob(spark, f"{root}/day_*/*.csv", text))
    return good


@register("sink_parquet", with_base("SELECT * FROM pre"))
def q_sink_parquet(spark: SparkSession, d: str) -> DataFrame:
    path = files.sink_parquet(I.preprocessed(spark, d), files.scratch_path(spark, "processed"))
    return spark.read.parquet(path)


@register("sink_csv", with_base("SELECT rank_date, van_rank FROM ranks"))
def q_sink_csv(spark: SparkSession, d: str) -> DataFrame:
    path = files.sink_csv(I.ranks(spark, d), files.scratch_path(spark, "ranks"))
    return files.scan_csv_glob(spark, path, schemas.STANDINGS_RANK)


@register("standings_flatten", with_base("SELECT * FROM standings"))
def q_standings_flatten(spark: SparkSession, d: str) -> DataFrame:
    wanted = joins.dates_to_fetch(I.preprocessed(spark, d))
    payload = td.standings_payload(spark, d, wanted)
    path = files.sink_json(payload, files.scratch_path(spark, "standings"))
    return joins.flatten_standings(files.read_standings_json(spark, path))


@register("earliest_date", with_base("SELECT MIN(calculate_date) AS earliest_date FROM pre"))
def q_earliest_date(spark: SparkSession, d: str) -> DataFrame:
    """The earliest date of the stored table, from its footers."""
    path = files.sink_parquet(I.preprocessed(spark, d).select("event_id", "calculate_date"), files.scratch_path(spark, "preprocessed"))
    return files.earliest_stored_date(spark, path)


# ------------------------------------------------------------------ 2.2 ----
@register("extract_event_date", with_base("SELECT * EXCLUDE (price_code) FROM pre_1"))
def q_extract_event_date(spark, d):
    return clean.extract_event_date(I.snapshot(spark, d))


@register("extract_opponent", with_base(
    f"SELECT *, CASE WHEN starts_with(event_name, '{td.HOME_PREFIX}') AND regexp_matches(event_name, 'vs\\.\\s(.+)') "
    "THEN regexp_extract(event_name, 'vs\\.\\s(.+)', 1) ELSE event_name END AS opponent FROM snapshot"))
def q_extract_opponent(spark, d):
    return clean.extract_opponent(I.snapshot(spark, d), td.HOME_PREFIX)


@register("extract_price_code", with_base("SELECT * EXCLUDE (event_date) FROM pre_1"))
def q_extract_price_code(spark, d):
    return clean.extract_price_code(I.snapshot(spark, d))


@register("filter_start_date", with_base(
    f"SELECT * EXCLUDE (price_code) FROM pre_1 WHERE event_date > DATE '{I.PRE.start_date}'"))
def q_filter_start_date(spark, d):
    return clean.filter_start_date(clean.extract_event_date(I.snapshot(spark, d)), I.PRE.start_date)


@register("filter_excluded_events", with_base(
    "SELECT * FROM snapshot WHERE NOT COALESCE(event_name IN ("
    + ", ".join(f"'{e}'" for e in I.PRE.excluded_events) + "), false)"))
def q_filter_excluded_events(spark, d):
    return clean.filter_excluded_events(I.snapshot(spark, d), I.PRE.excluded_events)


@register("filter_valid_sold", with_base("SELECT * FROM snapshot WHERE host_sold_yesterday >= 0"))
def q_filter_valid_sold(spark, d):
    return clean.filter_valid_sold(I.snapshot(spark, d))


@register("filter_price_code", with_base(
    "SELECT * EXCLUDE (event_date) FROM pre_1 WHERE NOT (price_code IS NOT DISTINCT FROM 'V')"))
def q_filter_price_code(spark, d):
    return clean.filter_price_code(clean.extract_price_code(I.snapshot(spark, d)))


_PRESEASON_SQL = " OR ".join(f"(event_date BETWEEN DATE '{a}' AND DATE '{b}')" for a, b in I.PRE.preseason_ranges)


@register("filter_preseason", with_base(
    f"SELECT * EXCLUDE (price_code) FROM pre_1 WHERE NOT COALESCE({_PRESEASON_SQL}, false)"))
def q_filter_preseason(spark, d):
    return clean.filter_preseason(clean.extract_event_date(I.snapshot(spark, d)), I.PRE.preseason_ranges)


@register("filter_lead_days", with_base(
    "SELECT * EXCLUDE (price_code) FROM pre_1 WHERE date_diff('day', calculate_date, event_date) <= 30"))
def q_filter_lead_days(spark, d):
    return clean.filter_lead_days(clean.extract_event_date(I.snapshot(spark, d)), 30)


@register("fill_initial_price", with_base(
    "SELECT * REPLACE (CASE WHEN last_price = 0 THEN initial_price ELSE last_price END AS last_price) FROM snapshot"))
def q_fill_initial_price(spark, d):
    return clean.fill_initial_price(I.snapshot(spark, d))


@register("cast_drop", with_base("SELECT * FROM pre"))
def q_cast_drop(spark, d):
    return I.preprocessed(spark, d)


FEAT_NUMERIC = [
    "cap", "pminventory", "opens", "holds", "revenue_to_date", "st_rate", "initial_price", "last_price",
    "ticket_sold_total", "host_sold_total", "host_sold_yesterday", "host_sold_at_current_price",
    "resale_sold_total", "number_of_postings", "lowest_post_price", "highest_post_price",
    "target_host_sold_today"] + td.EXTRA_MEASURES + [f"tickets_sold_{i}_days_before_today" for i in range(2, 8)] + [
    "weekend_game", "month", "days_until_game", "opponent_rank", "van_rank", "bowl_location",
    "host_sold_agg_last_day", "host_sold_agg_last_day_samebowl", "unique_views", "order_qty", "tkt_qty",
    "price_code_ordinal", "price_floor", "times_above_floor", "inventory_normalized"]


@register("select_numeric", with_base(f"SELECT {', '.join(FEAT_NUMERIC)} FROM feat"))
def q_select_numeric(spark, d):
    return clean.select_numeric(I.featured(spark, d))


SLICE = dict(event_ids=["AMERICA-1999Q2", "ASIA-2000Q1", "AFRICA-1998Q3"], codes=["9", "K", "N", "4"],
             max_price=1500.0, min_date="1996-07-01")


@register("filter_report_slice", with_base(
    "SELECT * FROM pre WHERE event_id IN ('AMERICA-1999Q2', 'ASIA-2000Q1', 'AFRICA-1998Q3') "
    "AND price_code IN ('9', 'K', 'N', '4') AND initial_price <= 1500.0 AND event_date >= DATE '1996-07-01'"))
def q_filter_report_slice(spark, d):
    return clean.filter_report_slice(I.preprocessed(spark, d), **SLICE)


@register("latest_snapshot", with_base(
    "SELECT * FROM feat_serve WHERE calculate_date = (SELECT MAX(calculate_date) FROM feat_serve)"))
def q_latest_snapshot(spark, d):
    return I.latest(spark, d)


@register("latest_snapshot_stored", with_base(
    "SELECT * FROM pre_serve WHERE calculate_date = (SELECT MAX(calculate_date) FROM pre_serve)"))
def q_latest_snapshot_stored(spark, d):
    """The last day of the serving rows, from a store with one folder a day."""
    rows = I.preprocessed(spark, d, training=False)
    return files.recent_days(spark, files.append_days(rows, files.scratch_path(spark, "days")), rows.schema)


@register("recent_snapshot_stored", with_base(
    "SELECT event_id, price_code, calculate_date FROM pre_serve "
    "WHERE calculate_date > (SELECT MAX(calculate_date) FROM pre_serve) - INTERVAL 7 DAY"))
def q_recent_snapshot_stored(spark, d):
    """Keys of the last seven days' rows, likewise."""
    rows = I.preprocessed(spark, d, training=False).select("event_id", "price_code", "calculate_date")
    return files.recent_days(spark, files.append_days(rows, files.scratch_path(spark, "days")), rows.schema, days=7)


@register("distinct_values", with_base("SELECT DISTINCT opponent, price_code FROM feat"))
def q_distinct_values(spark, d):
    return clean.distinct_values(I.featured(spark, d), ["opponent", "price_code"])


# ------------------------------------------------------------------ 2.3 ----
def _pre_with(spark, d, fn, cols):
    return fn(I.preprocessed(spark, d)).select(*KEYS, *cols)


@register("weekend_month", with_base(
    f"SELECT {_k()}, CAST(CASE WHEN isodow(event_date) IN (5, 6, 7) THEN 1 ELSE 0 END AS INTEGER) AS weekend_game, "
    "CAST(month(event_date) AS INTEGER) AS month FROM pre"))
def q_weekend_month(spark, d):
    return _pre_with(spark, d, features.add_weekend_month, ["weekend_game", "month"])


@register("days_until_game", with_base(
    f"SELECT {_k()}, CAST(date_diff('day', calculate_date, event_date) AS INTEGER) AS days_until_game FROM pre"))
def q_days_until_game(spark, d):
    return _pre_with(spark, d, features.add_days_until_game, ["days_until_game"])


_LOWER = ", ".join(f"'{c}'" for c in C.LOWER_BOWL_CODES)


@register("bowl_location", with_base(
    f"SELECT {_k()}, CAST(COALESCE(price_code IN ({_LOWER}), false) AS INTEGER) AS bowl_location FROM pre"))
def q_bowl_location(spark, d):
    return _pre_with(spark, d, features.add_bowl_location, ["bowl_location"])


@register("price_code_ordinal", with_base(
    f"SELECT {_k()}, pc.ordinal AS price_code_ordinal FROM pre LEFT JOIN price_codes pc ON pre.price_code = pc.code"))
def q_price_code_ordinal(spark, d):
    return _pre_with(spark, d, features.add_price_code_ordinal, ["price_code_ordinal"])


@register("price_floor_ratio", with_base(
    f"SELECT {_k()}, last_price, pc.floor AS price_floor, last_price / pc.floor AS times_above_floor "
    "FROM pre LEFT JOIN price_codes pc ON pre.price_code = pc.code"))
def q_price_floor_ratio(spark, d):
    return _pre_with(spark, d, features.add_price_floor_ratio, ["last_price", "price_floor", "times_above_floor"])


@register("inventory_normalized", with_base(
    f"SELECT {_k()}, CASE WHEN cap = 0 THEN NULL ELSE CAST(pminventory AS DOUBLE) / CAST(cap AS DOUBLE) END "
    "AS inventory_normalized FROM pre"))
def q_inventory_normalized(spark, d):
    return _pre_with(spark, d, features.add_inventory_normalized, ["inventory_normalized"])


SEASON_FIRST, SEASON_LAST = 1996, 2000


@register("season_label", with_base(f"""
SELECT price_code, event_date, initial_price,
  CAST(s AS VARCHAR) || '-' || CAST(s + 1 AS VARCHAR) AS season
FROM (
  SELECT price_code, event_date, initial_price,
    LEAST(GREATEST(year(event_date) - CASE WHEN month(event_date) < 7 THEN 1 ELSE 0 END, {SEASON_FIRST}), {SEASON_LAST}) AS s
  FROM (SELECT price_code, event_date, AVG(initial_price) AS initial_price FROM pre GROUP BY 1, 2)
  WHERE event_date >= DATE '1996-07-01' AND price_code IN ('0', 'L') AND initial_price <= 1500.0
)"""))
def q_season_label(spark, d):
    g = A.avg_initial_price(I.preprocessed(spark, d))
    g = clean.filter_report_slice(g, codes=["0", "L"], max_price=1500.0, min_date="1996-07-01")
    from seatcast.functions.columns import season_label
    return g.withColumn("season", season_label("event_date", SEASON_FIRST, SEASON_LAST))


@register("date_format", with_base(f"SELECT {_k()}, strftime(event_date, '%Y-%m-%d') AS event_day FROM pre"))
def q_date_format(spark, d):
    return features.add_date_string(I.preprocessed(spark, d), "event_date", "event_day").select(*KEYS, "event_day")


@register("team_alias", with_base(
    "SELECT f.team, f.ranking, r.r_name AS data_name FROM fans f LEFT JOIN region r ON f.team = 'Team ' || r.r_name"))
def q_team_alias(spark, d):
    fans, _, aliases = td.team_rankings(spark, d)
    return joins.team_alias(fans, aliases)


def _grid_sql(lo: str, hi: str, n: int, idx: str = "grid_idx") -> str:
    return (f"CASE WHEN {idx} = {n - 1} THEN {hi} ELSE CAST({idx} AS DOUBLE) * (({hi} - {lo}) / "
            f"CAST({n - 1} AS DOUBLE)) + {lo} END")


@register("linspace_grid", with_base(f"""
SELECT price_code, CAST(g.grid_idx AS INTEGER) AS grid_idx, {_grid_sql('min_price', 'max_price', 30)} AS price
FROM (SELECT price_code, MIN(last_price) AS min_price, MAX(last_price) AS max_price FROM pre GROUP BY 1)
CROSS JOIN (SELECT range AS grid_idx FROM range(30)) g"""))
def q_linspace_grid(spark, d):
    from seatcast.operators.whatif import with_grid
    r = A.price_range_by_code(I.preprocessed(spark, d))
    return with_grid(r, F.col("min_price"), F.col("max_price"), 30, "price").select("price_code", "grid_idx", "price")


# ------------------------------------------------------------------ 2.4 ----
@register("join_popularity", with_base(
    f"SELECT {_k()}, opponent, pop.data_name, COALESCE(pop.opponent_rank, -1) AS opponent_rank "
    "FROM pre LEFT JOIN popularity pop ON pre.opponent = pop.data_name"))
def q_join_popularity(spark, d):
    return joins.join_popularity(I.preprocessed(spark, d), I.popularity(spark, d)).select(
        *KEYS, "opponent", "data_name", "opponent_rank")


@register("join_ranking_asof", with_base(
    f"SELECT {_k()}, van_rank FROM feat"))
def q_join_ranking_asof(spark, d):
    return joins.join_ranking_asof(I.preprocessed(spark, d), I.ranks(spark, d)).select(*KEYS, "van_rank")


@register("join_ranking_ffill", with_base(f"""
SELECT {_k()}, CAST(r.van_rank AS INTEGER) AS van_rank FROM pre LEFT JOIN (
  SELECT calculate_date, LAST_VALUE(van_rank IGNORE NULLS) OVER (ORDER BY calculate_date
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS van_rank FROM feat_dates) r USING (calculate_date)"""))
def q_join_ranking_ffill(spark, d):
    return joins.join_ranking_asof(I.preprocessed(spark, d), I.ranks(spark, d), mode="ffill").select(*KEYS, "van_rank")


@register("join_web_analytics", with_base(
    f"SELECT {_k()}, w.unique_views, w.order_qty, w.tkt_qty FROM pre LEFT JOIN web_daily w "
    "ON pre.event_date = w.Event_Date AND pre.calculate_date = w.as_of_date"))
def q_join_web_analytics(spark, d):
    return joins.join_web_analytics(I.preprocessed(spark, d), I.web(spark, d), td.HOME_PREFIX).select(
        *KEYS, "unique_views", "order_qty", "tkt_qty")


@register("join_inner_team", with_base("SELECT team, ranking_x, ranking_y FROM team_merged"))
def q_join_inner_team(spark, d):
    fans, social, _ = td.team_rankings(spark, d)
    return joins.join_inner_team(social, fans)


@register("dates_to_fetch", with_base(
    "SELECT rank_date FROM wanted_dates WHERE rank_date NOT IN "
    "(SELECT rank_date FROM ranks WHERE rank_date < DATE '1998-01-01')"))
def q_dates_to_fetch(spark, d):
    stored = I.ranks(spark, d).where(F.col("rank_date") < F.lit("1998-01-01").cast("date"))
    return joins.dates_to_fetch(I.preprocessed(spark, d), stored)


@register("membership_join", with_base("""
SELECT pre.* FROM pre WHERE calculate_date IN (
  SELECT date FROM (SELECT date, DENSE_RANK() OVER (ORDER BY date) - 1 AS date_idx
                    FROM (SELECT DISTINCT calculate_date AS date FROM pre))
  WHERE date_idx >= 270 AND date_idx < 330)"""))
def q_membership_join(spark, d):
    from seatcast.operators.splits import date_index
    p = I.preprocessed(spark, d)
    dates = date_index(p).where((F.col("date_idx") >= 270) & (F.col("date_idx") < 330)).select("date")
    return joins.membership_join(p, dates)


# ------------------------------------------------------------------ 2.6 ----
@register("shift_target", with_base(
    f"SELECT {_k()}, host_sold_yesterday, target_host_sold_today FROM pre_3 WHERE target_host_sold_today >= 0"))
def q_shift_target(spark, d):
    from dataclasses import replace
    s = I.snapshot(spark, d)
    p = replace(I.PRE, lag_days=1)
    out = clean.extract_event_date(s)
    out = clean.extract_price_code(out)
    out = clean.filter_price_code(out)
    out = clean.filter_start_date(out, p.start_date)
    out = clean.filter_excluded_events(out, p.excluded_events)
    out = clean.filter_preseason(out, p.preseason_ranges)
    out = clean.filter_valid_sold(out)
    out = features.shift_target(features.co_locate_events(out))
    return out.select(*KEYS, "host_sold_yesterday", C.TARGET)


@register("shift_target_keep", with_base(
    f"SELECT {_k()}, host_sold_yesterday, target_host_sold_today FROM pre_serve"))
def q_shift_target_keep(spark, d):
    return I.preprocessed(spark, d, training=False).select(*KEYS, "host_sold_yesterday", C.TARGET)


LAGS = [f"tickets_sold_{i}_days_before_today" for i in range(2, 8)]


@register("lag_sales", with_base(f"SELECT {_k()}, target_host_sold_today, {', '.join(LAGS)} FROM pre"))
def q_lag_sales(spark, d):
    return I.preprocessed(spark, d).select(*KEYS, C.TARGET, *LAGS)


@register("sold_agg_day", with_base(f"SELECT {_k()}, host_sold_agg_last_day FROM feat"))
def q_sold_agg_day(spark, d):
    return I.featured(spark, d).select(*KEYS, "host_sold_agg_last_day")


@register("sold_agg_day_bowl", with_base(f"SELECT {_k()}, bowl_location, host_sold_agg_last_day_samebowl FROM feat"))
def q_sold_agg_day_bowl(spark, d):
    return I.featured(spark, d).select(*KEYS, "bowl_location", "host_sold_agg_last_day_samebowl")


@register("median_by_code", with_base(
    f"SELECT {_k()}, last_price, m.median FROM pre JOIN "
    "(SELECT price_code, quantile_cont(last_price, 0.5) AS median FROM pre GROUP BY 1) m USING (price_code)"))
def q_median_by_code(spark, d):
    return A.median_by_code(I.preprocessed(spark, d)).select(*KEYS, "last_price", "median")


@register("rank_min_desc", with_base(
    "SELECT rank_date, team_name, points, CAST(RANK() OVER (PARTITION BY rank_date ORDER BY points DESC) AS INTEGER) "
    "AS rank FROM standings"))
def q_rank_min_desc(spark, d):
    return features.rank_min_desc(I.standings(spark, d), "rank_date", "points").select(
        "rank_date", "team_name", "points", "rank")


@register("dense_rank_overall", with_base("SELECT team, overall, overall_rank FROM team_dense"))
def q_dense_rank_overall(spark, d):
    fans, social, _ = td.team_rankings(spark, d)
    m = joins.join_inner_team(social, fans).withColumn("overall", F.col("ranking_x") + F.col("ranking_y"))
    return features.dense_rank_overall(m, "overall").select("team", "overall", "overall_rank")


@register("tercile_bucket", with_base(
    "SELECT team, overall_rank, CAST(CASE WHEN overall_rank <= q1 THEN 1 WHEN overall_rank <= q2 THEN 2 ELSE 3 END "
    "AS INTEGER) AS bucket FROM team_dense CROSS JOIN team_q"))
def q_tercile_bucket(spark, d):
    fans, social, _ = td.team_rankings(spark, d)
    m = joins.join_inner_team(social, fans).withColumn("overall", F.col("ranking_x") + F.col("ranking_y"))
    m = features.dense_rank_overall(m, "overall")
    return features.tercile_bucket(m, "overall_rank", "bucket").select("team", "overall_rank", "bucket")


@register("ffill_bfill", with_base("SELECT calculate_date, van_rank FROM feat_rank"))
def q_ffill_bfill(spark, d):
    return joins.ranks_by_fact_date(I.preprocessed(spark, d), I.ranks(spark, d))
