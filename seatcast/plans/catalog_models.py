"""Registered queries for Spark ML feature stages, models, backtests and
scoring (survey 2.8-2.10).  Feature stages have SQL twins.  Full linear fits are
held against their score equations (``..._scores``): at the optimum the weighted
totals of every feature are those of the label, plus the penalty's share, and no
other coefficients give them.  Saturated fits (``..._means``) are held against
group means.  Trees, searches and full backtests are checked in the tests."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatcast import constants as C
from seatcast.operators import aggregates as A
from seatcast.operators import boosting
from seatcast.operators import forest
from seatcast.operators import gram
from seatcast.operators import linear as L
from seatcast.operators import models as M
from seatcast.operators import splits, whatif
from seatcast.plans import inputs as I
from seatcast import schemas
from seatcast.operators._util import persisted
from seatcast.plans.catalog import KEYS, _grid_sql, _k, register
from seatcast.plans.catalog_reports import FOLD_SCORES_CTE, LATEST_CTE, latest
from seatcast.plans.oracle import with_base
from seatcast.sources import files

POISSON_FS = M.FeatureSet(C.POISSON_NUMERIC, C.POISSON_CATEGORICAL, C.POISSON_PASSTHROUGH)
BASELINE_FS = M.FeatureSet(C.BASELINE_NUMERIC, C.BASELINE_CATEGORICAL, C.BASELINE_PASSTHROUGH)
RF_FS = M.FeatureSet(C.RF_NUMERIC, C.RF_CATEGORICAL, C.RF_PASSTHROUGH)
POLY_FS = M.FeatureSet(C.POLY_NUMERIC, C.POLY_CATEGORICAL, C.POLY_PASSTHROUGH)
GLM_FS = M.FeatureSet(C.POISSON_NUMERIC, C.POISSON_CATEGORICAL, C.GLM_PASSTHROUGH)
TRAIN_SQL = f"train AS (SELECT * FROM feat WHERE calculate_date < DATE '{I.SPLIT_CUTOFF}')"
FOREST_NODES = "tree int, node int, depth int, feature string, threshold double, n double, mean double"
TEST_SQL = f"test AS (SELECT * FROM feat WHERE calculate_date >= DATE '{I.SPLIT_CUTOFF}')"
Y = "CAST(target_host_sold_today AS DOUBLE)"


def train_test(spark, d) -> tuple[DataFrame, DataFrame]:
    return splits.split_cutoff(I.featured(spark, d), I.SPLIT_CUTOFF)


def train(spark, d) -> DataFrame:
    return train_test(spark, d)[0]


# At the optimum an unpenalised intercept makes the predictions of the training
# rows add up to their labels, so a full fit can be held against SUM(target).
TOTALS_SQL = with_base(f"SELECT COUNT(*) AS n, ROUND(SUM({Y})) AS total_prediction FROM train", TRAIN_SQL)


def _training_totals(spark, d, fit) -> DataFrame:
    with persisted(train(spark, d)) as t:
        model = fit(t)
        total = model.transform(t).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("prediction")).alias("total_prediction"))
        return spark.createDataFrame(total.collect(), total.schema)     # one row


def _scored_test(spark, d, model) -> DataFrame:
    _, test = train_test(spark, d)
    return model.transform(test).select(*KEYS, C.TARGET, "prediction")


# ------------------------------------------------------- feature stages ----
@register("impute_zero", with_base(
    f"SELECT {_k()}, CAST(COALESCE(unique_views, 0) AS BIGINT) AS unique_views, "
    "CAST(COALESCE(tickets_sold_7_days_before_today, 0) AS BIGINT) AS tickets_sold_7_days_before_today FROM feat"))
def q_impute_zero(spark, d):
    return M.impute_zero(I.featured(spark, d), ["unique_views", "tickets_sold_7_days_before_today"]).select(
        *KEYS, "unique_views", "tickets_sold_7_days_before_today")


@register("impute_mean", with_base(
    f"SELECT {_k()}, COALESCE(CAST(unique_views AS DOUBLE), (SELECT AVG(CAST(unique_views AS DOUBLE)) FROM feat)) "
    "AS unique_views FROM feat"))
def q_impute_mean(spark, d):
    return M.impute(I.featured(spark, d), ["unique_views"], "mean").select(*KEYS, "unique_views")


@register("impute_mode", with_base(
    f"SELECT {_k()}, COALESCE(CAST(tickets_sold_7_days_before_today AS DOUBLE), "
    "(SELECT CAST(v AS DOUBLE) FROM (SELECT tickets_sold_7_days_before_today AS v, COUNT(*) AS c FROM feat "
    "WHERE tickets_sold_7_days_before_today IS NOT NULL GROUP BY 1 ORDER BY c DESC, v LIMIT 1))) "
    "AS tickets_sold_7_days_before_today FROM feat"))
def q_impute_mode(spark, d):
    return M.impute(I.featured(spark, d), ["tickets_sold_7_days_before_today"], "mode").select(
        *KEYS, "tickets_sold_7_days_before_today")


STD_COLS = ["host_sold_yesterday", "last_price", "days_until_game"]


@register("standardize", with_base(
    f"SELECT {_k()}, " + ", ".join(
        f"(CAST({c} AS DOUBLE) - (SELECT AVG(CAST({c} AS DOUBLE)) FROM feat)) / "
        f"(SELECT STDDEV_POP(CAST({c} AS DOUBLE)) FROM feat) AS {c}" for c in STD_COLS) + " FROM feat"))
def q_standardize(spark, d):
    fe = I.featured(spark, d)
    return M.population_scaler(fe, STD_COLS).transform(fe).select(*KEYS, *STD_COLS)


@register("one_hot", with_base(
    "SELECT opponent, CAST(DENSE_RANK() OVER (ORDER BY opponent) - 1 AS DOUBLE) AS opponent_index, "
    "COUNT(*) AS n, CAST(COUNT(*) AS DOUBLE) AS hot_sum FROM feat GROUP BY opponent"))
def q_one_hot(spark, d):
    fe = I.featured(spark, d)
    fs = M.FeatureSet([], ["opponent"], [])
    enc = M.Pipeline(stages=M.encode_stages(fs)).fit(fe).transform(fe)
    arr = vector_to_array("_opponent_ohe")
    return (enc.groupBy("opponent", F.col("_opponent_idx").alias("opponent_index"))
               .agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x)).alias("hot_sum")))


POLY_COLS = ["days_until_game", "price_code_ordinal"]


@register("poly_features", with_base(
    f"SELECT {_k()}, CAST(x AS DOUBLE) AS p0, CAST(x AS DOUBLE) * x AS p1, CAST(y AS DOUBLE) AS p2, "
    "CAST(x AS DOUBLE) * y AS p3, CAST(y AS DOUBLE) * y AS p4 FROM "
    "(SELECT *, CAST(days_until_game AS DOUBLE) AS x, CAST(COALESCE(price_code_ordinal, 0) AS DOUBLE) AS y FROM feat)"))
def q_poly_features(spark, d):
    from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
    fe = I.featured(spark, d).fillna(0, subset=["price_code_ordinal"])
    v = VectorAssembler(inputCols=POLY_COLS, outputCol="_v").transform(fe)
    p = PolynomialExpansion(degree=2, inputCol="_v", outputCol="_p").transform(v)
    a = vector_to_array("_p")
    return p.select(*KEYS, *[a[i].alias(f"p{i}") for i in range(5)])


def _slots_sql() -> str:
    num = [f"SELECT '{c}' AS slot, SUM(COALESCE(CAST({c} AS DOUBLE), 0)) AS total FROM feat"
           for c in (*C.POISSON_NUMERIC, *C.POISSON_PASSTHROUGH)]
    cat = [f"SELECT '{c}_' || CAST({c} AS VARCHAR), CAST(COUNT(*) AS DOUBLE) FROM feat WHERE {c} IS NOT NULL GROUP BY 1"
           for c in C.POISSON_CATEGORICAL]
    return " UNION ALL ".join([*num, *cat])


@register("assemble", with_base(f"SELECT slot, ROUND(total, 3) AS total FROM ({_slots_sql()})"))
def q_assemble(spark, d):
    """Every slot of the assembled vector, added up over all rows."""
    from pyspark.ml.stat import Summarizer
    with persisted(I.featured(spark, d)) as fe:
        fs = POISSON_FS.checked(fe)
        out = M.Pipeline(stages=M.impute_stages(fs) + M.encode_stages(fs, copies=True)).fit(fe).transform(fe)
        names = [M.plain_name(n) for n in M.feature_names(None, out)]
        total = out.agg(vector_to_array(Summarizer.sum(F.col("features"))).alias("t")).first()["t"]
    return spark.createDataFrame([(n, round(v, 3)) for n, v in zip(names, total)], "slot string, total double")


# -------------------------------------------------------------- models ----
@register("ols", with_base(
    "SELECT regr_intercept(CAST(target_host_sold_today AS DOUBLE), last_price) AS intercept, "
    "regr_slope(CAST(target_host_sold_today AS DOUBLE), last_price) AS slope FROM train", TRAIN_SQL))
def q_ols(spark, d):
    m = M.fit_ols(train(spark, d), M.FeatureSet(["last_price"]))
    lr = m.stages[-1]
    return spark.createDataFrame([(float(lr.intercept), float(lr.coefficients[0]))], "intercept double, slope double")


def _ridge(t) -> L.LinearFit:
    return L.fit_ridge(t, gram.Design.of(t, BASELINE_FS, "mean"), C.RIDGE_ALPHA)


def _poly_ridge(t) -> L.LinearFit:
    return L.fit_ridge(t, gram.Design.of(t, POLY_FS, degree=C.POLY_DEGREE), C.POLY_RIDGE_ALPHA)


def _poisson(t, fs=POISSON_FS, alpha=C.POISSON_ALPHA, **design) -> L.LinearFit:
    return L.fit_poisson(t, gram.Design.of(t, fs, **design), alpha)[0]


def _linear_totals(spark, d, fit) -> DataFrame:
    with persisted(train(spark, d)) as t:
        total = fit(t).predict(t).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("prediction")).alias("total_prediction"))
        return spark.createDataFrame(total.collect(), total.schema)     # one row


@register("ridge", TOTALS_SQL)
def q_ridge(spark, d):
    return _linear_totals(spark, d, _ridge)


@register("poly_ridge", TOTALS_SQL)
def q_poly_ridge(spark, d):
    return _linear_totals(spark, d, _poly_ridge)


def _scores_sql(fs: M.FeatureSet, fill: str = "zero", degree: int = 1, by: str | None = None) -> str:
    """Sum of x * y over the norm of x, for every design column x (of every ``by``)."""
    num = list(dict.fromkeys(fs.numeric))
    term = {c: f"COALESCE(CAST({c} AS DOUBLE), {f'a.mean_{c}' if fill == 'mean' else 0})" for c in num}
    terms = [(c, term[c]) for c in num]
    if degree == 2:
        terms += [(f"{a} {b}", f"{term[a]} * {term[b]}") for i, a in enumerate(num) for b in num[i:]]
    terms += [(c, f"COALESCE(CAST({c} AS DOUBLE), 0)") for c in dict.fromkeys(fs.passthrough)]
    each = ", ".join(f"{{'feature': '{n}', 'score': ROUND(SUM(({x}) * y) / SQRT(NULLIF(SUM(POW({x}, 2)) * COUNT(*), 0)), 4)}}" for n, x in terms)
    means = ", ".join(f"AVG(CAST({c} AS DOUBLE)) AS mean_{c}" for c in num) if fill == "mean" else "0 AS none"
    key, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    cats = " ".join(f"UNION ALL SELECT {key}'{c}_' || CAST({c} AS VARCHAR), ROUND(SUM(y) / SQRT(COUNT(*) * MAX(n)), 4) FROM ys "
                    f"WHERE {c} IS NOT NULL GROUP BY {key}{c}" for c in dict.fromkeys(fs.categorical))
    over = f"OVER (PARTITION BY {by})" if by else "OVER ()"
    return with_base(f"""SELECT {key}u.feature AS feature, u.score AS score
FROM (SELECT {key}UNNEST(list) AS u FROM (SELECT {key.replace(by or '', f'ys.{by}') if by else ''}[{each}] AS list FROM ys CROSS JOIN a{f' GROUP BY ys.{by}' if by else ''})) {cats}""",
                     f"{TRAIN_SQL},\nys AS (SELECT *, {Y} AS y, COUNT(*) {over} AS n FROM train), a AS (SELECT {means} FROM train)")


def _scores(t: DataFrame, fit: L.LinearFit) -> list[tuple[str, float | None]]:
    """Sum of x * prediction plus the penalty's share, over the norm of x, for every design column."""
    design, p = fit.design, "_fitted"
    raw = gram.moments(gram.prepared(fit.predict(t, p), design, p), design)[0]
    m = raw.mapped(design.imputing(raw)[0])
    weight = fit.alpha * (m.n if fit.log_link else 1.0)
    out = []
    for i, name in enumerate(design.names):
        xy = m.m2[i, -1] + m.n * m.mean[i] * m.mean[-1] + weight * fit.scaled_coef[i] * fit.scale[i]
        xx = m.m2[i, i] + m.n * m.mean[i] ** 2
        out.append((name, round(float(xy / (xx * m.n) ** 0.5), 4) if xx > 0 else None))
    return out


def _score_table(spark, d, fit) -> DataFrame:
    with persisted(train(spark, d)) as t:
        return spark.createDataFrame(_scores(t, fit(t)), "feature string, score double")      # a row a feature


@register("ridge_scores", _scores_sql(BASELINE_FS, "mean"))
def q_ridge_scores(spark, d):
    """The score equations of the ridge fit on its full feature list."""
    return _score_table(spark, d, _ridge)


@register("poly_ridge_scores", _scores_sql(POLY_FS, degree=2))
def q_poly_ridge_scores(spark, d):
    """The same for all terms of degree 2."""
    return _score_table(spark, d, _poly_ridge)


GRAM_FS = M.FeatureSet(C.BASELINE_NUMERIC)
GRAM_COLS = list(dict.fromkeys(C.BASELINE_NUMERIC))


@register("poisson_glm", TOTALS_SQL)
def q_poisson_glm(spark, d):
    return _training_totals(spark, d, lambda t: M.fit_poisson(t, POISSON_FS))


@register("poisson_glm_test")
def q_poisson_glm_test(spark, d):
    """The Poisson model's predictions of the rows after the cut-off."""
    return _scored_test(spark, d, M.fit_poisson(train(spark, d), POISSON_FS))


@register("poisson_glm_scores", _scores_sql(POISSON_FS))
def q_poisson_glm_scores(spark, d):
    """The score equations of the penalised Poisson fit on its full feature list."""
    return _score_table(spark, d, _poisson)


def _unpenalised(t: DataFrame) -> L.LinearFit:
    """Constant, drop-first dummies, numeric columns scaled by their sample std."""
    return L.fit_poisson(t, gram.Design.of(t, GLM_FS, drop_first=True), 0.0, ddof=1)[0]


SUMMARY = "feature string, coefficient double, std_error double, z_value double, p_value double, deviance double, aic double"


@register("poisson_glm_unpenalized")
def q_poisson_glm_unpenalized(spark, d):
    """Coefficients of the maximum-likelihood fit with their statistics."""
    with persisted(train(spark, d)) as t:
        return spark.createDataFrame(L.summary_rows(_unpenalised(t)), SUMMARY)


@register("glm_scores", _scores_sql(GLM_FS))
def q_glm_scores(spark, d):
    """The score equations of the maximum-likelihood fit with all dummies."""
    return _score_table(spark, d, _glm)


@register("poisson_glm_rows", with_base(
    f"SELECT opponent, month, COUNT(*) AS n FROM train GROUP BY 1, 2", TRAIN_SQL))
def q_poisson_glm_rows(spark, d):
    """Rows the unpenalised fit scores, by opponent and month."""
    with persisted(train(spark, d)) as t:
        m = M.fit_poisson_unpenalized(t, GLM_FS)
        out = m.transform(t).where(F.col("prediction") > 0).groupBy("opponent", "month").agg(F.count(F.lit(1)).alias("n"))
        return spark.createDataFrame(out.collect(), out.schema)      # a row per opponent and month


GLM_TOTALS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS category, ROUND(SUM({Y})) AS total_prediction FROM train GROUP BY 1, 2"
    for c in C.POISSON_CATEGORICAL)


@register("poisson_glm_totals", with_base(GLM_TOTALS, TRAIN_SQL))
def q_poisson_glm_totals(spark, d):
    """An unpenalised GLM matches the label totals of every dummy category."""
    with persisted(train(spark, d)) as t:
        s = M.fit_poisson_unpenalized(t, GLM_FS).transform(t)
        rows = []
        for c in C.POISSON_CATEGORICAL:
            got = s.groupBy(F.col(c).cast("string").alias("category")).agg(F.round(F.sum("prediction")).alias("p")).collect()
            rows += [(c, r["category"], float(r["p"])) for r in got]     # a row per category
    return spark.createDataFrame(rows, "feature string, category string, total_prediction double")


def _glm(t: DataFrame) -> L.LinearFit:
    return _poisson(t, GLM_FS, 0.0)


@register("glm_summary")
def q_glm_summary(spark, d):
    """Coefficients and statistics of the fit with a constant and all dummies:
    a singular design, whose least-norm solution has standard errors too."""
    with persisted(train(spark, d)) as t:
        return spark.createDataFrame(L.summary_rows(_glm(t)), SUMMARY)


@register("poisson_poly", TOTALS_SQL)
def q_poisson_poly(spark, d):
    return _training_totals(spark, d, lambda t: M.fit_poisson(t, POLY_FS, C.POISSON_ALPHA, degree=2))


def _forest(t: DataFrame) -> forest.Forest:
    p = C.RF_PARAMS
    return forest.fit(t, gram.Design.of(t, RF_FS, "mean"), C.TARGET, KEYS, p["numTrees"], p["maxDepth"], p["minInstancesPerNode"], p["seed"])


@register("random_forest")
def q_random_forest(spark, d):
    with persisted(train(spark, d)) as t:
        model = _forest(t)
    return model.predict(train_test(spark, d)[1]).select(*KEYS, C.TARGET, "prediction")


# A tree's leaves share out its bootstrap sample, which SQL draws anew from the keys.
FOREST_TOTALS = f"""
SELECT CAST(tree AS INTEGER) AS tree, CAST(SUM(w) AS DOUBLE) AS n, ROUND(SUM(w * y), 3) AS label_total
FROM (SELECT tree, y, LEN(LIST_FILTER({forest.POISSON_STEPS}, lambda s: s <= u)) AS w
      FROM (SELECT tree, {Y} AS y, CAST('0x' || SUBSTR(MD5(
                     {" || '|' || ".join(f"COALESCE(CAST({k} AS VARCHAR), '')" for k in KEYS)} || '|{C.RF_PARAMS["seed"]}|' || (tree // {forest.PER_HASH})),
                   tree % {forest.PER_HASH} * 4 + 1, 4) AS INTEGER) AS u
            FROM train, range({C.RF_PARAMS["numTrees"]}) AS trees(tree) WHERE {C.TARGET} IS NOT NULL))
GROUP BY tree"""


@register("random_forest_totals", with_base(FOREST_TOTALS, TRAIN_SQL))
def q_random_forest_totals(spark, d):
    """Rows and label total over the leaves of every tree."""
    with persisted(train(spark, d)) as t:
        nodes = spark.createDataFrame(_forest(t).nodes(), FOREST_NODES)
    return nodes.where("feature IS NULL").groupBy("tree").agg(F.sum("n").alias("n"), F.round(F.sum(F.col("n") * F.col("mean")), 3).alias("label_total"))


@register("random_forest_nodes")
def q_random_forest_nodes(spark, d):
    """Every node of every tree: feature and threshold it splits by (NULL: a leaf), rows and mean label."""
    with persisted(train(spark, d)) as t:
        return spark.createDataFrame(_forest(t).nodes(), FOREST_NODES)


@register("gbt")
def q_gbt(spark, d):
    """Histogram boosting, one column sample a tree, 1,500 rounds as published (minutes: three jobs a round)."""
    p = C.GBT_PARAMS
    with persisted(train(spark, d)) as t:
        model = boosting.fit(t, gram.Design.of(t, BASELINE_FS, "mean"), C.TARGET, p["maxIter"], p["maxDepth"], p["stepSize"], p["subset"],
                             p["seed"], tasks=4)
    return model.predict(train_test(spark, d)[1]).select(*KEYS, C.TARGET, "prediction")


@register("gbt_first_trees")
def q_gbt_first_trees(spark, d):
    """The first 50 of these trees: what the model predicts after them (a prefix of the same fit)."""
    p = C.GBT_PARAMS
    with persisted(train(spark, d)) as t:
        model = boosting.fit(t, gram.Design.of(t, BASELINE_FS, "mean"), C.TARGET, 50, p["maxDepth"], p["stepSize"], p["subset"], p["seed"], tasks=4)
    return model.predict(train_test(spark, d)[1]).select(*KEYS, C.TARGET, "prediction")


# Saturated fits: with one categorical key and no penalty the prediction of a row
# is the mean label of its category, which SQL can tell.
def mean3(c: str):
    """A fitted mean to three places; the small addition keeps exact means such
    as 26.3485 from being rounded one way by the fit and the other way by SQL."""
    return F.round(F.col(c) + 0.00001, 3)


def by_opponent(spark, d):
    return M.fit_group_means(train(spark, d), ["opponent"])


def by_bowl_and_opponent(spark, d):
    with persisted(train(spark, d)) as t:
        return M.fit_segmented(t, "bowl_location", lambda part: M.fit_group_means(part, ["opponent"]))


# The same on the full feature list of the Poisson model.
def full_poisson(spark, d) -> L.LinearFit:
    with persisted(train(spark, d)) as t:
        return _poisson(t)


def bowl():
    return F.col("bowl_location")


def full_poisson_by_bowl(spark, d, t=None) -> dict[int, L.LinearFit]:
    """A Poisson model for each bowl, fitted together."""
    with persisted(train(spark, d) if t is None else t) as t:
        return L.fit_poisson(t, gram.Design.of(t, POISSON_FS), C.POISSON_ALPHA, segment=bowl())


def by_bowl(fits):
    return lambda df: L.score_segments(df, fits, bowl())


MEANS_SQL = f"""{TRAIN_SQL},
m1 AS (SELECT opponent, AVG({Y}) AS p FROM train GROUP BY 1),
m2 AS (SELECT bowl_location, opponent, AVG({Y}) AS p FROM train GROUP BY 1, 2)"""


@register("segmented_means", with_base(
    f"SELECT {_k()}, target_host_sold_today, ROUND(m2.p + 0.00001, 3) AS prediction FROM test JOIN m2 USING (bowl_location, opponent)",
    f"{MEANS_SQL},\n{TEST_SQL}"))
def q_segmented_means(spark, d):
    _, test = train_test(spark, d)
    s = M.score_segmented(test, "bowl_location", by_bowl_and_opponent(spark, d))
    return s.select(*KEYS, C.TARGET, mean3("prediction").alias("prediction"))


@register("segmented_models")
def q_segmented_models(spark, d):
    """The Poisson model per bowl on its full feature list, every row scored by its bowl's coefficients."""
    _, test = train_test(spark, d)
    return by_bowl(full_poisson_by_bowl(spark, d))(test).select(*KEYS, C.TARGET, "prediction")


@register("segmented_scores", _scores_sql(POISSON_FS, by="bowl_location"))
def q_segmented_scores(spark, d):
    """The score equations of each bowl's model."""
    with persisted(train(spark, d)) as t:
        rows = [(k, *r) for k, fit in full_poisson_by_bowl(spark, d, t).items() for r in _scores(t.where(bowl() == k), fit)
                if r[1] is not None or r[0] in (*C.POISSON_NUMERIC, *C.POISSON_PASSTHROUGH)]      # a bowl lacks some categories
    return spark.createDataFrame(rows, "bowl_location int, feature string, score double")


@register("coef_table_means", with_base("""
SELECT 'opponent_' || opponent AS feature, ROUND(LN(p / base), 4) AS coefficients, ROUND(ABS(LN(p / base)), 4) AS magnitude
FROM m1 CROSS JOIN (SELECT FIRST(p ORDER BY opponent) AS base, MIN(opponent) AS first FROM m1) b WHERE opponent <> first""",
    MEANS_SQL))
def q_coef_table_means(spark, d):
    t = train(spark, d)
    m = by_opponent(spark, d)
    c = M.coef_table(m, m.transform(t.limit(1)))
    return c.select("feature", F.round("coefficients", 4).alias("coefficients"), F.round("magnitude", 4).alias("magnitude"))


@register("coef_table")
def q_coef_table(spark, d):
    """Coefficients of the Poisson model on its full feature list, exported as CSV and read back."""
    table = spark.createDataFrame(L.coef_rows(full_poisson(spark, d)), "feature string, coefficients double, magnitude double")
    path = files.sink_csv(table, files.scratch_path(spark, "coefficients"))
    return files.scan_csv_glob(spark, path, table.schema)


LATEST_MEANS = f"{LATEST_CTE},\n{MEANS_SQL}"


@register("predict_batch_means", with_base("""
SELECT event_name, event_date, opponent, price_code, last_price, host_sold_yesterday,
  ROUND(m2.p + 0.00001, 3) AS predicted_segmented, ROUND(m1.p + 0.00001, 3) AS predicted_poisson
FROM latest JOIN m1 USING (opponent) JOIN m2 USING (bowl_location, opponent)""", LATEST_MEANS))
def q_predict_batch_means(spark, d):
    """Both saturated predictions of the latest rows, exported as CSV and read back."""
    out = M.predict_batch(latest(spark, d), by_opponent(spark, d), "bowl_location", by_bowl_and_opponent(spark, d))
    return _exported(spark, out.withColumns({c: mean3(c) for c in ("predicted_segmented", "predicted_poisson")}))


def _exported(spark, predictions) -> DataFrame:
    cols = ["event_name", "event_date", "opponent", "price_code", "last_price", "host_sold_yesterday"]
    out = predictions.select(*cols, "predicted_segmented", "predicted_poisson")
    path = files.export_predictions(out, files.scratch_path(spark, "predictions"))
    return files.scan_csv_glob(spark, path, schemas.PREDICTIONS)


@register("predict_batch")
def q_predict_batch(spark, d):
    """Both predictions of the latest rows by the Poisson models on their full feature list, exported as CSV and read back."""
    with persisted(train(spark, d)) as t:
        whole, fits = _poisson(t), full_poisson_by_bowl(spark, d, t)
    segmented = L.score_segments(latest(spark, d), fits, bowl(), out="predicted_segmented")
    return _exported(spark, whole.predict(segmented, "predicted_poisson"))


@register("results_join_means", with_base(
    f"SELECT {_k()}, target_host_sold_today AS y_true, ROUND(m1.p + 0.00001, 3) AS y_pred FROM test JOIN m1 USING (opponent)",
    f"{MEANS_SQL},\n{TEST_SQL}"))
def q_results_join_means(spark, d):
    s = _scored_test(spark, d, by_opponent(spark, d))
    return M.results(s, KEYS).withColumn("y_pred", mean3("y_pred"))


@register("results_join")
def q_results_join(spark, d):
    """True values beside the predictions of the full Poisson model."""
    return M.results(full_poisson(spark, d).predict(train_test(spark, d)[1]), KEYS)


@register("model_persistence_means", with_base(
    f"SELECT month, COUNT(*) AS n, ROUND(AVG({Y}), 4) AS prediction, true AS same FROM train GROUP BY month", TRAIN_SQL))
def q_model_persistence_means(spark, d):
    """A saved and loaded model predicts what the fitted one does."""
    with persisted(train(spark, d)) as t:
        m = M.fit_group_means(t, ["month"])
        again = M.load_model(M.save_model(m, files.scratch_path(spark, "model")))
        s = again.transform(m.transform(t).select("month", F.col("prediction").alias("before")))
        out = s.groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("prediction"), 4).alias("prediction"),
                                     F.bool_and(F.col("prediction") == F.col("before")).alias("same"))
        return spark.createDataFrame(out.collect(), out.schema)      # a row per month


@register("model_persistence")
def q_model_persistence(spark, d):
    """The same for the full Poisson pipeline (imputer, scaler, one-hots), row by row on the test part."""
    m = M.fit_poisson(train(spark, d), POISSON_FS)
    again = M.load_model(M.save_model(m, files.scratch_path(spark, "model")))
    _, test = train_test(spark, d)
    s = M.scored(again, M.scored(m, test, "before"))
    return s.select(*KEYS, C.TARGET, "prediction", (F.col("prediction") == F.col("before")).alias("same"))


# ------------------------------------------------------------ backtests ----
OLS_DESIGN = gram.Design(("last_price",))
HASH = "CAST('0x' || substr(md5('42|' || event_id || '|' || COALESCE(price_code, '') || '|' || CAST(calculate_date AS VARCHAR)), 1, 8) AS BIGINT)"
OLS_ERROR = f"POW({Y} - (a + b * last_price), 2)"


@register("backtest", with_base(f"""
SELECT f.fold, f.valid_from, f.valid_to, SQRT(AVG(POW(v.y - (p.a + p.b * v.last_price), 2))) AS rmse, COUNT(*) AS n
FROM folds f
JOIN (SELECT f.fold, regr_intercept({Y}, s.last_price) AS a, regr_slope({Y}, s.last_price) AS b
      FROM folds f JOIN dated s ON s.date_idx < f.first_idx GROUP BY 1) p ON p.fold = f.fold
JOIN (SELECT *, {Y} AS y FROM dated) v ON v.calculate_date BETWEEN f.valid_from AND f.valid_to
GROUP BY 1, 2, 3""", FOLD_SCORES_CTE + f""",
dated AS (SELECT feat.*, date_idx FROM feat JOIN didx ON feat.calculate_date = didx.date),
folds AS (SELECT CAST(FLOOR((date_idx - {C.BACKTEST_TRAIN_DATES}) / {C.BACKTEST_VALID_DATES}) AS INTEGER) AS fold,
                 MIN(date) AS valid_from, MAX(date) AS valid_to, MIN(date_idx) AS first_idx
          FROM didx WHERE date_idx >= {C.BACKTEST_TRAIN_DATES} GROUP BY 1)"""))
def q_backtest(spark, d):
    """Expanding-window backtest of the one-feature least-squares model."""
    b = L.backtest(I.featured(spark, d), OLS_DESIGN, 0.0, scale=False)
    return b.select("fold", "valid_from", "valid_to", "rmse", "n")


@register("backtest_ridge")
def q_backtest_ridge(spark, d):
    """The same over the ridge baseline with its full feature list."""
    with persisted(I.featured(spark, d)) as fe:
        return L.backtest(fe, gram.Design.of(fe, BASELINE_FS, "mean"), C.RIDGE_ALPHA)


def _kfold_sql(k: int) -> str:
    return with_base(f"""
SELECT CAST(k AS INTEGER) AS fold, COUNT(*) FILTER (fold = k) AS n, SQRT(AVG({OLS_ERROR}) FILTER (fold = k)) AS rmse,
  SQRT(AVG({OLS_ERROR}) FILTER (fold <> k)) AS train_rmse
FROM (SELECT k, regr_intercept({Y}, last_price) AS a, regr_slope({Y}, last_price) AS b
      FROM hashed JOIN (SELECT range AS k FROM range({k})) g ON fold <> k GROUP BY 1) m JOIN hashed ON true GROUP BY 1""",
                     f"{TRAIN_SQL},\nhashed AS (SELECT *, {HASH} % {k} AS fold FROM train)")


def _kfold_ols(spark, d, k) -> DataFrame:
    return L.kfold(train(spark, d), OLS_DESIGN, 0.0, splits.hash_fold(KEYS, k, 42), k, scale=False)


@register("kfold_random", _kfold_sql(5))
def q_kfold_random(spark, d):
    return _kfold_ols(spark, d, 5)


@register("kfold_random_10", _kfold_sql(10))
def q_kfold_random_10(spark, d):
    return _kfold_ols(spark, d, 10)


@register("kfold_ridge")
def q_kfold_ridge(spark, d):
    """Five folds of the ridge baseline with its full feature list, one pass."""
    with persisted(train(spark, d)) as t:
        return L.kfold(t, gram.Design.of(t, BASELINE_FS, "mean"), C.RIDGE_ALPHA, splits.hash_fold(KEYS, 5, 42), 5)


@register("gram_cells", with_base("""
SELECT CAST(fold AS BIGINT) AS fold, feature_1, feature_2, COUNT(*) AS n, ROUND(AVG(v1), 4) AS mean_1, ROUND(AVG(v2), 4) AS mean_2,
  ROUND(COVAR_POP(v1, v2) / (1 + STDDEV_POP(v1) * STDDEV_POP(v2)), 6) AS comoment
FROM (SELECT a.fold, a.id, a.feature AS feature_1, a.v AS v1, b.feature AS feature_2, b.v AS v2 FROM long a JOIN long b ON a.id = b.id)
GROUP BY 1, 2, 3""", f"""{TRAIN_SQL},
wide AS (SELECT row_number() OVER () AS id, {HASH} % 5 AS fold, {Y} AS label, {", ".join(f"COALESCE(CAST({c} AS DOUBLE), 0) AS {c}" for c in GRAM_COLS)}
         FROM train),
long AS MATERIALIZED (SELECT id, fold, feature, v FROM wide UNPIVOT (v FOR feature IN (label, {", ".join(GRAM_COLS)})))"""))
def q_gram_cells(spark, d):
    """The statistics that ridge, its search and its folds are solved from: per
    fold, every pair of numeric features and the label (co-moments as shares of
    one plus the product of both deviations)."""
    with persisted(train(spark, d)) as t:
        design = gram.Design.of(t, GRAM_FS)
        found = gram.moments(gram.prepared(t, design, C.TARGET, splits.hash_fold(KEYS, 5, 42)), design)
    sd = {k: (m.m2.diagonal() / m.n) ** 0.5 for k, m in found.items()}
    names = [*design.names, "label"]
    at = {n: i for i, n in enumerate(names)}
    rows = [(k, a, b, n, round(m1, 4), round(m2, 4), round(c / n / (1 + float(sd[k][at[a]] * sd[k][at[b]])), 6))
            for k, a, b, n, m1, m2, c in gram.cells(found, names)]
    return spark.createDataFrame(rows, "fold bigint, feature_1 string, feature_2 string, n bigint, mean_1 double, mean_2 double, comoment double")


@register("kfold_poisson")
def q_kfold_poisson(spark, d):
    """Five folds of the Poisson model with its full feature list."""
    folded = splits.kfold_assign(train(spark, d), KEYS, 5, 42)
    return splits.kfold_scores(folded, lambda t: M.fit_poisson(t, POISSON_FS), 5)


@register("holdout_random", with_base(f"""
SELECT SQRT(AVG({OLS_ERROR})) AS rmse, 1 - SUM({OLS_ERROR}) / (VAR_POP({Y}) * COUNT(*)) AS r2, COUNT(*) AS n
FROM hashed JOIN (SELECT regr_intercept({Y}, last_price) AS a, regr_slope({Y}, last_price) AS b
                  FROM hashed WHERE share >= {int(0.2 * 2**32)}) m ON share < {int(0.2 * 2**32)}""",
    f"{TRAIN_SQL},\nhashed AS (SELECT *, {HASH} AS share FROM train)"))
def q_holdout_random(spark, d):
    return L.holdout(train(spark, d), OLS_DESIGN, 0.0, splits.hash_share(KEYS, 42) < int(0.2 * 2**32), scale=False)


@register("holdout_poisson")
def q_holdout_poisson(spark, d):
    """The full Poisson model on a random hold-out."""
    with persisted(train(spark, d)) as t:
        fit_part, hold = splits.holdout_split(t, KEYS, 0.2, 42)
        score = A.regression_metrics(_poisson(fit_part).predict(hold), C.TARGET, "prediction")
        return spark.createDataFrame(score.collect(), score.schema)      # one row


@register("random_search")
def q_random_search(spark, d):
    """Ridge on degree-2 terms: ten drawn penalties, five folds, mean squared error, one pass for all."""
    drawn = splits.sample_param_maps(C.RIDGE_SEARCH, C.SEARCH_SETTINGS, 42)
    with persisted(train(spark, d)) as t:
        return L.search(t, gram.Design.of(t, POLY_FS, degree=2), [p["alpha"] for p in drawn],
                        splits.hash_fold(KEYS, C.RIDGE_SEARCH_FOLDS, 42))[0]


def _poisson_search(spark, d, space) -> DataFrame:
    """All settings and folds are fitted in the same passes over the columns of
    the model, stored once: each pass would plan the whole input again."""
    data = splits.kfold_assign(train(spark, d), KEYS, C.POISSON_SEARCH_FOLDS, 42)
    used = dict.fromkeys([*POISSON_FS.numeric, *POISSON_FS.categorical, *POISSON_FS.passthrough])
    data = files.write_stage(data.select("fold", C.TARGET, *used), files.scratch_path(spark, "search"))
    return splits.random_search(data, L.PoissonFits(POISSON_FS),
                                splits.sample_param_maps(space, C.SEARCH_SETTINGS, 42), C.POISSON_SEARCH_FOLDS)[0]


@register("random_search_poisson")
def q_random_search_poisson(spark, d):
    """Poisson, degree 1 or 2, ten drawn settings of the wide penalty range, three folds."""
    return _poisson_search(spark, d, C.POISSON_SEARCH)


@register("random_search_poisson_kfold")
def q_random_search_poisson_kfold(spark, d):
    """The same over the narrow penalty range."""
    return _poisson_search(spark, d, C.POISSON_KFOLD_SEARCH)


# ------------------------------------------------------------- what-if ----
_CURVE_SQL = """SELECT {k}, CAST(g.grid_idx AS INTEGER) AS grid_idx, {grid} AS times_above_floor,
  {grid} * price_floor AS curve_price, ROUND(p + 0.00001, 3) AS prediction
FROM latest JOIN {m} CROSS JOIN (SELECT range AS grid_idx FROM range(30)) g"""
_GRID = _grid_sql("1.0", "8.0", 30, "g.grid_idx")


def _curve(spark, d, scorer) -> DataFrame:
    return _full_curve(spark, d, scorer).withColumn("prediction", mean3("prediction"))


@register("demand_curve_sequence_means", with_base(
    _CURVE_SQL.format(k=_k(), grid=_GRID, m="m2 USING (bowl_location, opponent)"), LATEST_MEANS))
def q_demand_curve_sequence_means(spark, d):
    """Ratio curve scored through the per-bowl (segmented) models."""
    models_ = by_bowl_and_opponent(spark, d)
    return _curve(spark, d, lambda df: M.score_segmented(df, "bowl_location", models_))


@register("demand_curve_model_means", with_base(
    _CURVE_SQL.format(k=_k(), grid=_GRID, m="m1 USING (opponent)"), LATEST_MEANS))
def q_demand_curve_model_means(spark, d):
    """Ratio curve scored through a fitted Poisson pipeline."""
    return _curve(spark, d, whatif.model_scorer(by_opponent(spark, d)))


def _full_curve(spark, d, scorer) -> DataFrame:
    return whatif.demand_curve_ratio(latest(spark, d), scorer, C.RATIO_GRID, C.PRICE_GRID_POINTS, KEYS)


@register("demand_curve_sequence")
def q_demand_curve_sequence(spark, d):
    """Ratio curve scored through the per-bowl Poisson models on their full feature list."""
    return _full_curve(spark, d, by_bowl(full_poisson_by_bowl(spark, d)))


@register("demand_curve_model")
def q_demand_curve_model(spark, d):
    """Ratio curve scored through the Poisson model on its full feature list."""
    return _full_curve(spark, d, full_poisson(spark, d).predict)
