"""Registered queries for report aggregates, sequences, reshaping, splits
and what-if grids (survey 2.3-2.10, SQL-checkable parts)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatcast import constants as C
from seatcast.operators import aggregates as A
from seatcast.operators import features, joins, reshape, splits, whatif
from seatcast.plans import inputs as I
from seatcast.plans.catalog import FEAT_NUMERIC, KEYS, _grid_sql, _k, register
from seatcast.plans.oracle import with_base

# A fixed-coefficient scorer: makes every what-if and metric query checkable
# in SQL.  (Fitted Spark ML scorers are registered in catalog_models.)
SCORE_WEIGHTS = {"host_sold_yesterday": 0.5, "times_above_floor": -2.0, "days_until_game": 0.1,
                 "last_price": -0.001}
SCORE_INTERCEPT = 5.0
SCORER = whatif.linear_scorer(SCORE_WEIGHTS, SCORE_INTERCEPT)


def _score_expr() -> str:
    e = f"CAST({SCORE_INTERCEPT!r} AS DOUBLE)"
    for c, w in SCORE_WEIGHTS.items():
        e = f"({e} + CAST({w!r} AS DOUBLE) * COALESCE(CAST({c} AS DOUBLE), CAST(0.0 AS DOUBLE)))"
    return f"GREATEST({e}, CAST(0.0 AS DOUBLE))"


SCORE = _score_expr()
LATEST_CTE = ("latest AS (SELECT * FROM feat_serve WHERE calculate_date = "
              "(SELECT MAX(calculate_date) FROM feat_serve))")
PRED_CTE = LATEST_CTE + f",\npred AS (SELECT *, {SCORE} AS prediction FROM latest)"
SCORED_CTE = f"scored AS (SELECT *, {SCORE} AS prediction FROM feat)"


def latest(spark, d) -> DataFrame:
    return I.latest(spark, d)


def predictions(spark, d) -> DataFrame:
    return SCORER(latest(spark, d))


def scored(spark, d) -> DataFrame:
    return SCORER(I.featured(spark, d))


# ------------------------------------------------------------ 2.3 / 2.6 ----
# every numeric and passthrough feature of the sequence model
SEQ_FEATS = list(dict.fromkeys([*C.NUMERIC_FEATURES, *C.PASSTHROUGH_FEATURES]))
SEQ_ORDER = "calculate_date, price_code_ordinal, event_id, price_code"


def _seq_steps_sql(max_len: int | None) -> str:
    lags = ",\n    ".join(
        f"LAG({f}, {j}) OVER (PARTITION BY opponent ORDER BY {SEQ_ORDER}) AS {f}_l{j}"
        for f in SEQ_FEATS for j in (1, 2))
    parts = []
    for k in range(3):  # step k of a sequence of length n holds lag (n-1-k)
        for n in range(k + 1, 4):
            lag = n - 1 - k
            vals = ", ".join(f"CAST({f if lag == 0 else f + '_l' + str(lag)} AS DOUBLE) AS f{i}"
                             for i, f in enumerate(SEQ_FEATS))
            parts.append(f"SELECT {_k()}, {k} AS step, {vals} FROM seq_src WHERE n = {n}")
    if max_len:
        zeros = ", ".join(f"CAST(0.0 AS DOUBLE) AS f{i}" for i in range(len(SEQ_FEATS)))
        parts.append(f"SELECT {_k()}, k AS step, {zeros} FROM seq_src JOIN (SELECT range AS k FROM range(1, {max_len})) g ON n <= k")
    body = "\nUNION ALL\n".join(parts)
    names = ", ".join(f"f{i}" for i in range(len(SEQ_FEATS)))
    return with_base(f"SELECT {_k()}, CAST(step AS INTEGER) AS step, {names} FROM (\n{body}\n)", f"""
seq_src AS MATERIALIZED (
  SELECT {_k()}, {', '.join(SEQ_FEATS)},
    LEAST(ROW_NUMBER() OVER (PARTITION BY opponent ORDER BY {SEQ_ORDER}), 3) AS n,
    {lags}
  FROM feat
)""")


def _explode_seq(df: DataFrame, col: str) -> DataFrame:
    e = df.select(*KEYS, F.posexplode(col).alias("step", "_v"))
    return e.select(*KEYS, F.col("step").cast("int").alias("step"),
                    *[F.col("_v")[i].alias(f"f{i}") for i in range(len(SEQ_FEATS))])


@register("sequence_window", _seq_steps_sql(None))
def q_sequence_window(spark, d):
    s = features.sequence_window(I.featured(spark, d), SEQ_FEATS)
    return _explode_seq(s, "sequence")


PAD_LEN = C.SEQUENCE_MAX_LENGTH


@register("pad_sequence", _seq_steps_sql(PAD_LEN))
def q_pad_sequence(spark, d):
    s = features.sequence_window(I.featured(spark, d), SEQ_FEATS)
    s = features.pad_sequence(s, "sequence", PAD_LEN, width=len(SEQ_FEATS))
    return _explode_seq(s, "sequence")


# ------------------------------------------------------------------ 2.4 ----
@register("cross_price_grid", with_base(
    f"SELECT {_k()}, CAST(g.grid_idx AS INTEGER) AS grid_idx, {_grid_sql('1.0', '8.0', 30)} AS times_above_floor "
    "FROM latest CROSS JOIN (SELECT range AS grid_idx FROM range(30)) g", LATEST_CTE))
def q_cross_price_grid(spark, d):
    g = whatif.with_grid(latest(spark, d).drop("times_above_floor"), 1.0, 8.0, 30, "times_above_floor")
    return g.select(*KEYS, "grid_idx", "times_above_floor")


# ------------------------------------------------------------------ 2.5 ----
@register("agg_web_dedup", with_base("SELECT * FROM web_daily"))
def q_agg_web_dedup(spark, d):
    return joins.web_daily(I.web(spark, d), I.FEAT.web_prefix)


@register("avg_initial_price", with_base(
    "SELECT price_code, event_date, AVG(initial_price) AS initial_price FROM pre GROUP BY 1, 2"))
def q_avg_initial_price(spark, d):
    return A.avg_initial_price(I.preprocessed(spark, d))


@register("sum_by_event_top", with_base(
    "SELECT event_name, SUM(prediction) AS total FROM pred GROUP BY 1 ORDER BY total DESC, event_name LIMIT 1",
    PRED_CTE))
def q_sum_by_event_top(spark, d):
    return A.top_by_sum(predictions(spark, d), "event_name", "prediction")


@register("sum_by_opponent", with_base(
    "SELECT opponent, SUM(prediction) AS total_prediction FROM pred GROUP BY 1", PRED_CTE))
def q_sum_by_opponent(spark, d):
    return A.sum_by(predictions(spark, d), "opponent", "prediction", "total_prediction")


@register("argmax_row", with_base(
    "SELECT * FROM pred ORDER BY prediction DESC, event_id, price_code LIMIT 1", PRED_CTE))
def q_argmax_row(spark, d):
    return A.argmax_row(predictions(spark, d), "prediction", ["event_id", "price_code"])


@register("price_range_by_code", with_base(
    "SELECT price_code, MIN(last_price) AS min_price, MAX(last_price) AS max_price FROM pre GROUP BY 1"))
def q_price_range_by_code(spark, d):
    return A.price_range_by_code(I.preprocessed(spark, d))


@register("value_counts", with_base(
    "SELECT target_host_sold_today, COUNT(*) AS count FROM pre GROUP BY 1"))
def q_value_counts(spark, d):
    return A.value_counts(I.preprocessed(spark, d), C.TARGET)


HIST_VARS = ["host_sold_total", "host_sold_yesterday"]
HIST_WIDTH = 5.0


@register("histogram", with_base(f"""
SELECT variable, CAST(FLOOR(value / {HIST_WIDTH!r}) AS BIGINT) AS bin, COUNT(*) AS count,
  CAST(FLOOR(value / {HIST_WIDTH!r}) AS BIGINT) * {HIST_WIDTH!r} AS bin_start,
  (CAST(FLOOR(value / {HIST_WIDTH!r}) AS BIGINT) + 1) * {HIST_WIDTH!r} AS bin_end
FROM (
  SELECT 'host_sold_total' AS variable, CAST(host_sold_total AS DOUBLE) AS value FROM pre WHERE opens > 0 AND last_price > 0
  UNION ALL
  SELECT 'host_sold_yesterday', CAST(host_sold_yesterday AS DOUBLE) FROM pre WHERE opens > 0 AND last_price > 0
) WHERE value IS NOT NULL GROUP BY 1, 2"""))
def q_histogram(spark, d):
    p = I.preprocessed(spark, d).where((F.col("opens") > 0) & (F.col("last_price") > 0))
    long = reshape.melt(p, ["price_code"], HIST_VARS)
    return A.histogram(long, "variable", "value", HIST_WIDTH)


@register("box_stats", with_base("""
SELECT q.price_code, q.q1, q.median, q.q3,
  MIN(CASE WHEN p.last_price >= q.q1 - 1.5 * (q.q3 - q.q1) THEN p.last_price END) AS lower_whisker,
  MAX(CASE WHEN p.last_price <= q.q3 + 1.5 * (q.q3 - q.q1) THEN p.last_price END) AS upper_whisker,
  COUNT(p.last_price) AS n
FROM pre p JOIN (
  SELECT price_code, quantile_cont(last_price, 0.25) AS q1, quantile_cont(last_price, 0.5) AS median,
         quantile_cont(last_price, 0.75) AS q3 FROM pre GROUP BY 1) q USING (price_code)
GROUP BY 1, 2, 3, 4"""))
def q_box_stats(spark, d):
    return A.box_stats(I.preprocessed(spark, d))


CORR_COLS = FEAT_NUMERIC      # every numeric column of the feature table


def _corr_sql() -> str:
    cells = []
    for i, a in enumerate(CORR_COLS):
        for j, b in enumerate(CORR_COLS):
            r = "CAST(1.0 AS DOUBLE)" if i == j else f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"
            cells.append(f"{{'feature_1': '{a}', 'feature_2': '{b}', 'correlation': {r}}}")
    return ("corr_wide AS MATERIALIZED (SELECT [" + ",\n".join(cells) + "] AS cells FROM feat),\n"
            "corr_long AS (SELECT c.feature_1, c.feature_2, CASE WHEN isnan(c.correlation) THEN NULL ELSE c.correlation END "
            "AS correlation FROM (SELECT unnest(cells) AS c FROM corr_wide))")


@register("corr_matrix", with_base("SELECT * FROM corr_long", _corr_sql()))
def q_corr_matrix(spark, d):
    return A.corr_matrix(I.featured(spark, d), CORR_COLS)


@register("high_corr_pairs", with_base("""
SELECT * FROM corr_long WHERE feature_1 IN (SELECT f FROM hot) AND feature_2 IN (SELECT f FROM hot)""",
    _corr_sql() + """,
hot AS (
  SELECT feature_1 AS f FROM corr_long WHERE abs(correlation) >= 0.8 AND feature_1 <> feature_2
  UNION SELECT feature_2 FROM corr_long WHERE abs(correlation) >= 0.8 AND feature_1 <> feature_2
)"""))
def q_high_corr_pairs(spark, d):
    return A.high_corr_pairs(A.corr_matrix(I.featured(spark, d), CORR_COLS), C.HIGH_CORR_THRESHOLD)


@register("quantile_bounds", with_base("""
SELECT q_low, q_high, q_low - 1.5 * (q_high - q_low) AS lower_bound, q_high + 1.5 * (q_high - q_low) AS upper_bound
FROM (SELECT quantile_cont(r, 0.05) AS q_low, quantile_cont(r, 0.95) AS q_high
      FROM (SELECT CAST(target_host_sold_today AS DOUBLE) - prediction AS r FROM scored))""", SCORED_CTE))
def q_quantile_bounds(spark, d):
    s = scored(spark, d).withColumn("residuals", F.col(C.TARGET).cast("double") - F.col("prediction"))
    return A.quantile_bounds(s, "residuals")


_METRICS_SQL = with_base("""
SELECT SQRT(sse / n) AS rmse, 1 - sse / (syy - sy * sy / n) AS r2, n FROM (
  SELECT SUM(POW(y - p, 2)) AS sse, SUM(POW(y, 2)) AS syy, SUM(y) AS sy, COUNT(*) AS n
  FROM (SELECT CAST(target_host_sold_today AS DOUBLE) AS y, prediction AS p FROM scored
        WHERE target_host_sold_today IS NOT NULL AND prediction IS NOT NULL))""", SCORED_CTE)


@register("rmse", f"SELECT rmse, n FROM ({_METRICS_SQL})")
def q_rmse(spark, d):
    return A.regression_metrics(scored(spark, d), C.TARGET, "prediction").select("rmse", "n")


@register("r2", f"SELECT r2 FROM ({_METRICS_SQL})")
def q_r2(spark, d):
    return A.regression_metrics(scored(spark, d), C.TARGET, "prediction").select("r2")


@register("nb_log_loss", with_base("""
SELECT -AVG(lgamma(y + a) - lgamma(a) - lgamma(y + 1) + a * LN(a / (a + mu))
            + CASE WHEN y = 0 THEN 0 ELSE y * LN(mu / (a + mu)) END) AS nb_loss, COUNT(*) AS n
FROM (SELECT CAST(target_host_sold_today AS DOUBLE) AS y, prediction + CASE WHEN target_host_sold_today > 0 THEN 0.5 ELSE 0 END AS mu,
             CAST(1.5 AS DOUBLE) AS a FROM scored)""",
    SCORED_CTE))
def q_nb_log_loss(spark, d):
    """Zero predictions stay in where the count is zero too; positive counts get
    a prediction above zero here, as their loss would be infinite."""
    s = scored(spark, d).withColumn("mu", F.col("prediction") + F.when(F.col(C.TARGET) > 0, 0.5).otherwise(0.0))
    return A.nb_log_loss(s, C.TARGET, "mu", 1.5, count="n")


@register("batch_rmse", with_base("""
SELECT AVG(r) AS batch_rmse, COUNT(*) AS n_batches FROM (
  SELECT calculate_date, SQRT(AVG(POW(CAST(target_host_sold_today AS DOUBLE) - prediction, 2))) AS r
  FROM scored GROUP BY 1)""", SCORED_CTE))
def q_batch_rmse(spark, d):
    return A.batch_rmse(scored(spark, d), C.TARGET, "prediction", "calculate_date")


FOLD_SCORES_CTE = SCORED_CTE + f""",
didx AS (SELECT date, DENSE_RANK() OVER (ORDER BY date) - 1 AS date_idx FROM (SELECT DISTINCT calculate_date AS date FROM feat)),
fold_scores AS (
  SELECT CAST(FLOOR((date_idx - {C.BACKTEST_TRAIN_DATES}) / {C.BACKTEST_VALID_DATES}) AS INTEGER) AS fold,
    SQRT(AVG(POW(CAST(s.target_host_sold_today AS DOUBLE) - s.prediction, 2))) AS rmse, COUNT(*) AS n
  FROM scored s JOIN didx ON s.calculate_date = didx.date WHERE date_idx >= {C.BACKTEST_TRAIN_DATES}
  GROUP BY 1
)"""


def fold_scores(spark, d) -> DataFrame:
    """RMSE of the fixed scorer on each expanding fold's validation range."""
    s = scored(spark, d)
    idx = splits.date_index(s).where(F.col("date_idx") >= C.BACKTEST_TRAIN_DATES).withColumn(
        "fold", ((F.col("date_idx") - C.BACKTEST_TRAIN_DATES) / C.BACKTEST_VALID_DATES).cast("int"))
    j = s.join(idx.select(F.col("date").alias("calculate_date"), "fold"), "calculate_date")
    return j.groupBy("fold").agg(A.rmse_expr(C.TARGET, "prediction").alias("rmse"),
                                 F.count(F.lit(1)).alias("n"))


@register("score_summary", with_base(
    "SELECT AVG(rmse) AS mean_score, STDDEV_POP(rmse) AS std_score, COUNT(*) AS n_folds FROM fold_scores",
    FOLD_SCORES_CTE))
def q_score_summary(spark, d):
    return A.score_summary(fold_scores(spark, d), "rmse")


@register("table_means", with_base("""
SELECT CAST(fold AS VARCHAR) AS fold_label, rmse, CAST(n AS DOUBLE) AS n FROM fold_scores
UNION ALL SELECT 'mean', AVG(rmse), AVG(CAST(n AS DOUBLE)) FROM fold_scores""", FOLD_SCORES_CTE))
def q_table_means(spark, d):
    t = fold_scores(spark, d).withColumn("fold_label", F.col("fold").cast("string"))
    return A.table_means(t, ["rmse", "n"], "fold_label")


# ------------------------------------------------------------------ 2.7 ----
@register("sort_rows", with_base("SELECT * FROM pre ORDER BY event_id, calculate_date, price_code"))
def q_sort_rows(spark, d):
    return reshape.sort_rows(I.preprocessed(spark, d), ["event_id", "calculate_date", "price_code"])


TOP_COLS = ["event_name", "event_date", "opponent", "price_code", "last_price", "host_sold_yesterday",
            "prediction"]


@register("top_predictions", with_base(
    f"SELECT {', '.join(TOP_COLS)} FROM pred ORDER BY prediction DESC, event_id, price_code LIMIT {C.TOP_PREDICTIONS}",
    PRED_CTE))
def q_top_predictions(spark, d):
    return reshape.top_n(predictions(spark, d), "prediction", C.TOP_PREDICTIONS, ["event_id", "price_code"],
                         TOP_COLS)


SLOPE_FEATS = ["host_sold_yesterday", "host_sold_total", "ticket_sold_total", "cap", "pminventory", "opens",
               "holds", "last_price", "initial_price", "days_until_game", "times_above_floor",
               "inventory_normalized", "opponent_rank", "van_rank", "bowl_location", "weekend_game",
               "price_code_ordinal", "host_sold_agg_last_day", "st_rate", "number_of_postings",
               "resale_sold_total", "host_sold_at_current_price"]


def _slope_sql() -> str:
    parts = [f"SELECT '{f}' AS feature, regr_slope(CAST(target_host_sold_today AS DOUBLE), CAST({f} AS DOUBLE)) "
             f"AS coefficients FROM feat" for f in SLOPE_FEATS]
    return "slopes AS (\n" + "\nUNION ALL\n".join(parts) + "\n)"


@register("top_coefficients", with_base(
    f"SELECT feature, coefficients, abs(coefficients) AS magnitude FROM slopes "
    f"ORDER BY magnitude DESC, feature LIMIT {C.TOP_COEFFICIENTS}", _slope_sql()))
def q_top_coefficients(spark, d):
    fe = I.featured(spark, d)
    aggs = [F.regr_slope(F.col(C.TARGET).cast("double"), F.col(f).cast("double")).alias(f) for f in SLOPE_FEATS]
    wide = fe.agg(*aggs)
    long = wide.unpivot([], SLOPE_FEATS, "feature", "coefficients")
    coef = long.withColumn("magnitude", F.abs("coefficients"))
    return reshape.top_coefficients(coef, C.TOP_COEFFICIENTS)


@register("melt", with_base(
    f"SELECT {_k()}, 'host_sold_total' AS variable, CAST(host_sold_total AS DOUBLE) AS value FROM pre "
    f"UNION ALL SELECT {_k()}, 'host_sold_yesterday', CAST(host_sold_yesterday AS DOUBLE) FROM pre"))
def q_melt(spark, d):
    return reshape.melt(I.preprocessed(spark, d), KEYS, HIST_VARS)


@register("union_append", with_base("SELECT rank_date, van_rank FROM ranks"))
def q_union_append(spark, d):
    r = I.ranks(spark, d)
    stored = r.where(F.col("rank_date") < F.lit("1998-01-01").cast("date"))
    return joins.union_append(stored, r)


SCENARIOS = [0.9, 1.0, 1.1]


@register("scenario_union", with_base(
    f"SELECT {_k()}, CAST(s.scenario AS INTEGER) AS scenario, s.v AS last_price FROM latest CROSS JOIN "
    "(VALUES (0, CAST(0.9 AS DOUBLE)), (1, CAST(1.0 AS DOUBLE)), (2, CAST(1.1 AS DOUBLE))) AS s(scenario, v)",
    LATEST_CTE))
def q_scenario_union(spark, d):
    return reshape.scenario_union(latest(spark, d), "last_price", SCENARIOS).select(*KEYS, "scenario", "last_price")


# ------------------------------------------------------------------ 2.8 ----
@register("split_cutoff", with_base(
    f"SELECT {_k()}, target_host_sold_today, CASE WHEN calculate_date < DATE '{I.SPLIT_CUTOFF}' THEN 'train' "
    "ELSE 'test' END AS split FROM feat"))
def q_split_cutoff(spark, d):
    train, test = splits.split_cutoff(I.featured(spark, d), I.SPLIT_CUTOFF)
    cols = [*KEYS, C.TARGET]
    return (train.select(*cols, F.lit("train").alias("split"))
                 .unionByName(test.select(*cols, F.lit("test").alias("split"))))


@register("expanding_folds", with_base(f"""
SELECT CAST(fold AS INTEGER) AS fold, (SELECT MIN(date) FROM didx) AS train_from, t.date AS train_to,
       valid_from, valid_to
FROM (SELECT CAST(FLOOR((date_idx - {C.BACKTEST_TRAIN_DATES}) / {C.BACKTEST_VALID_DATES}) AS INTEGER) AS fold,
             MIN(date) AS valid_from, MAX(date) AS valid_to, MIN(date_idx) AS first_idx
      FROM didx WHERE date_idx >= {C.BACKTEST_TRAIN_DATES} GROUP BY 1) f
JOIN didx t ON t.date_idx = f.first_idx - 1""", FOLD_SCORES_CTE))
def q_expanding_folds(spark, d):
    return splits.expanding_folds(I.featured(spark, d))


# ----------------------------------------------------------------- 2.10 ----
@register("demand_curve_price_absent_code", with_base(f"""
SELECT {_k()}, CAST(grid_idx AS INTEGER) AS grid_idx, price AS last_price,
  {SCORE.replace('COALESCE(CAST(last_price AS DOUBLE)', 'COALESCE(CAST(price AS DOUBLE)')} AS prediction
FROM (
  SELECT l.*, g.grid_idx, {_grid_sql('COALESCE(r.min_price, o.min_price)', 'COALESCE(r.max_price, o.max_price)', 30, 'g.grid_idx')} AS price
  FROM latest l
  LEFT JOIN (SELECT price_code, MIN(last_price) AS min_price, MAX(last_price) AS max_price FROM pre
             WHERE price_code <> 'N' GROUP BY 1) r ON l.price_code IS NOT DISTINCT FROM r.price_code
  LEFT JOIN (SELECT price_code, MIN(last_price) AS min_price, MAX(last_price) AS max_price FROM latest GROUP BY 1) o
    ON l.price_code IS NOT DISTINCT FROM o.price_code
  CROSS JOIN (SELECT range AS grid_idx FROM range(30)) g
)""", LATEST_CTE))
def q_demand_curve_price_absent_code(spark, d):
    """The reference frame lacks one code, whose rows keep their own range."""
    reference = I.preprocessed(spark, d).where(F.col("price_code") != "N")
    return whatif.demand_curve_price(latest(spark, d), SCORER, reference, 30, KEYS)


@register("demand_curve_price", with_base(f"""
SELECT {_k()}, CAST(grid_idx AS INTEGER) AS grid_idx, price AS last_price,
  {SCORE.replace('COALESCE(CAST(last_price AS DOUBLE)', 'COALESCE(CAST(price AS DOUBLE)')} AS prediction
FROM (
  SELECT l.*, g.grid_idx, {_grid_sql('COALESCE(r.min_price, o.min_price)', 'COALESCE(r.max_price, o.max_price)', 30, 'g.grid_idx')} AS price
  FROM latest l
  LEFT JOIN (SELECT price_code, MIN(last_price) AS min_price, MAX(last_price) AS max_price FROM pre GROUP BY 1) r
    ON l.price_code IS NOT DISTINCT FROM r.price_code
  LEFT JOIN (SELECT price_code, MIN(last_price) AS min_price, MAX(last_price) AS max_price FROM latest GROUP BY 1) o
    ON l.price_code IS NOT DISTINCT FROM o.price_code
  CROSS JOIN (SELECT range AS grid_idx FROM range(30)) g
)""", LATEST_CTE))
def q_demand_curve_price(spark, d):
    """Every code's range over the whole history."""
    return whatif.demand_curve_price(latest(spark, d), SCORER, I.preprocessed(spark, d), 30, KEYS)


_RATIO_SQL = _grid_sql("1.0", "8.0", 30, "g.grid_idx")


@register("demand_curve_ratio", with_base(f"""
SELECT {_k()}, CAST(grid_idx AS INTEGER) AS grid_idx, times_above_floor, times_above_floor * price_floor AS curve_price,
  {SCORE} AS prediction
FROM (SELECT l.* REPLACE ({_RATIO_SQL} AS times_above_floor), g.grid_idx
      FROM latest l CROSS JOIN (SELECT range AS grid_idx FROM range(30)) g)""", LATEST_CTE))
def q_demand_curve_ratio(spark, d):
    return whatif.demand_curve_ratio(latest(spark, d), SCORER, C.RATIO_GRID, 30, KEYS)


@register("aggregate_sales_curve", with_base(f"""
SELECT opponent, CAST(grid_idx AS INTEGER) AS grid_idx, FIRST(times_above_floor) AS times_above_floor,
  SUM({SCORE}) AS total_prediction
FROM (SELECT l.* REPLACE ({_RATIO_SQL} AS times_above_floor), g.grid_idx
      FROM latest l CROSS JOIN (SELECT range AS grid_idx FROM range(30)) g) GROUP BY 1, 2""", LATEST_CTE))
def q_aggregate_sales_curve(spark, d):
    return whatif.aggregate_sales_curve(latest(spark, d), SCORER)


_MULT_SQL = _grid_sql("0.5", "2.0", 30, "g.grid_idx")
_KNOWN = ", ".join(f"'{c}'" for c in sorted(C.PRICE_FLOOR))


@register("price_change_impact", with_base(f"""
SELECT opponent, CAST(grid_idx AS INTEGER) AS grid_idx, FIRST(m) AS multiplier, SUM({SCORE}) AS total_prediction
FROM (SELECT l.* REPLACE (CASE WHEN l.price_code IN ({_KNOWN}) THEN l.times_above_floor * {_MULT_SQL}
                               ELSE l.times_above_floor END AS times_above_floor),
             g.grid_idx, {_MULT_SQL} AS m
      FROM latest l CROSS JOIN (SELECT range AS grid_idx FROM range(30)) g) GROUP BY 1, 2""", LATEST_CTE))
def q_price_change_impact(spark, d):
    return whatif.price_change_impact(latest(spark, d), SCORER)


@register("residual_outliers", with_base("""
SELECT event_id, price_code, calculate_date, residuals,
  (residuals < lower_bound OR residuals > upper_bound) AS is_outlier
FROM (SELECT event_id, price_code, calculate_date, CAST(target_host_sold_today AS DOUBLE) - prediction AS residuals
      FROM scored) r
CROSS JOIN (SELECT q_low - 1.5 * (q_high - q_low) AS lower_bound, q_high + 1.5 * (q_high - q_low) AS upper_bound
            FROM (SELECT quantile_cont(CAST(target_host_sold_today AS DOUBLE) - prediction, 0.05) AS q_low,
                         quantile_cont(CAST(target_host_sold_today AS DOUBLE) - prediction, 0.95) AS q_high
                  FROM scored)) b""", SCORED_CTE))
def q_residual_outliers(spark, d):
    return A.residual_outliers(scored(spark, d), C.TARGET, "prediction").select(*KEYS, "residuals", "is_outlier")
