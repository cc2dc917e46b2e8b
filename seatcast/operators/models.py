"""Feature assembly and models on Spark ML (survey 2.9).

Every model is a ``pyspark.ml.Pipeline``: imputation, scaling, one-hot
encoding and assembly are stages, so a fitted ``PipelineModel`` carries its
preprocessing and is saved/loaded as one artefact.  Fitting is distributed
(treeAggregate of gradients / sufficient statistics); nothing is collected.

A fitted model works on its own copies of the features, so a scored frame keeps
every input column as it came (:func:`scored`), and can be scored again.

Parity notes (see survey): sklearn's ``StandardScaler`` uses the population
std, Spark's the sample std, so ``population_scaler`` computes the population
statistics with one SQL aggregate and applies them in a ``SQLTransformer``.
Ridge and Poisson penalties are converted to Spark's parametrisation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import comb

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (ElementwiseProduct, Imputer, OneHotEncoder, PolynomialExpansion, SQLTransformer,
                                StringIndexer, VectorAssembler)
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import (GBTRegressor, GeneralizedLinearRegression, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatcast import constants as C
from seatcast.operators._util import persisted


@dataclass(frozen=True)
class FeatureSet:
    numeric: Sequence[str]
    categorical: Sequence[str] = ()
    passthrough: Sequence[str] = ()

    def checked(self, df: DataFrame) -> "FeatureSet":
        """The set without repeats inside a list; a listed feature that ``df``
        lacks is an error, so that a renamed column cannot train another model."""
        lacking = [c for c in (*self.numeric, *self.categorical, *self.passthrough) if c not in df.columns]
        if lacking:
            raise ValueError(f"features not in the frame: {', '.join(lacking)}")
        return FeatureSet(*(tuple(dict.fromkeys(cols)) for cols in (self.numeric, self.categorical, self.passthrough)))


def _q(c: str) -> str:
    return f"`{c}`"


def impute_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.fillna(0, subset=list(cols))


def impute(df: DataFrame, cols: Sequence[str], strategy: str = "mean") -> DataFrame:
    imp = Imputer(strategy=strategy, inputCols=list(cols), outputCols=list(cols))
    return imp.fit(df.select(*[F.col(c).cast("double") if c in cols else F.col(c) for c in df.columns])) \
              .transform(df.select(*[F.col(c).cast("double") if c in cols else F.col(c) for c in df.columns]))


def population_stats(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std per column (one aggregate; a constant column gets scale 1)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"m_{c}"), F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}")]
    r = df.agg(*aggs).first()
    out = {}
    for c in cols:
        m, s = r[f"m_{c}"], r[f"s_{c}"]
        out[c] = (0.0 if m is None else float(m), 1.0 if not s else float(s))
    return out


def population_scaler(df: DataFrame, cols: Sequence[str], suffix: str = "") -> SQLTransformer:
    """A persistable stage ``(x - mean) / std_pop`` with fitted literals."""
    st = population_stats(df, cols)
    exprs = ", ".join(f"(CAST({_q(c)} AS DOUBLE) - ({m!r})) / ({s!r}) AS {_q(c + suffix)}"
                      for c, (m, s) in st.items())
    keep = "" if suffix else "EXCEPT (" + ", ".join(_q(c) for c in cols) + ")"
    return SQLTransformer(statement=f"SELECT * {keep}, {exprs} FROM __THIS__")


def worked(c: str) -> str:
    """The pipeline's own copy of a numeric feature: it is imputed and scaled,
    the input column stays as it came."""
    return f"_f_{c}"


def impute_stages(fs: FeatureSet, impute_numeric: str | None = "zero") -> list:
    """Double copies of the numeric features (see :func:`worked`), imputed."""
    num = list(fs.numeric)
    if not num:
        return []
    made = [f"CAST({_q(c)} AS DOUBLE)" for c in num]
    if impute_numeric == "zero":
        made = [f"COALESCE({e}, 0.0)" for e in made]
    copies = ", ".join(f"{e} AS {_q(worked(c))}" for c, e in zip(num, made))
    stages = [SQLTransformer(statement=f"SELECT *, {copies} FROM __THIS__")]
    if impute_numeric not in (None, "zero"):
        own = [worked(c) for c in num]
        stages.append(Imputer(strategy=impute_numeric, inputCols=own, outputCols=own))
    return stages


def encode_stages(fs: FeatureSet, degree: int = 1, scale_poly: bool = False,
                  out: str = "features", rows: int | None = None, dummies: dict | None = None,
                  copies: bool = False) -> list:
    """(poly) -> one-hot -> passthrough -> assemble.

    One-hot keeps every seen category; unknown and NULL ones map to all zeros:
    the indexer gives them the last index, and the encoder drops the last slot.
    ``dummies`` (column -> its categories, see :func:`categories`) instead gives
    0/1 columns for all but the first one, as an unpenalised intercept needs.
    Polynomial terms are scaled by the population std:
    Spark divides by the sample std, ``rows`` gives the factor between the two.
    ``copies`` reads the numeric features' copies that :func:`impute_stages` made.
    """
    stages, vec_inputs = [], []
    num = [worked(c) for c in fs.numeric] if copies else list(fs.numeric)
    if num:
        if degree > 1:
            stages.append(VectorAssembler(inputCols=num, outputCol="_num_raw", handleInvalid="keep"))
            stages.append(PolynomialExpansion(degree=degree, inputCol="_num_raw", outputCol="_num_poly"))
            if scale_poly:
                from pyspark.ml.feature import StandardScaler
                stages.append(StandardScaler(inputCol="_num_poly", outputCol="_num_poly_c",
                                             withMean=True, withStd=True))
                n = rows or 0
                terms = comb(len(num) + degree, degree) - 1
                factor = (n / (n - 1)) ** 0.5 if n > 1 else 1.0
                stages.append(ElementwiseProduct(scalingVec=Vectors.dense([factor] * terms),
                                                 inputCol="_num_poly_c", outputCol="_num_poly_s"))
                vec_inputs.append("_num_poly_s")
            else:
                vec_inputs.append("_num_poly")
        else:
            vec_inputs += num
    cats = list(fs.categorical)
    if cats and dummies is not None:
        made = {f"{c}_{v}": f"CAST(CAST({_q(c)} AS STRING) <=> {_sql_text(v)} AS DOUBLE)"
                for c in cats for v in dummies[c][1:]}
        stages.append(SQLTransformer(statement="SELECT *, " + ", ".join(
            f"{e} AS {_q(n)}" for n, e in made.items()) + " FROM __THIS__"))
        vec_inputs += list(made)
    elif cats:
        idx = [f"_{c}_idx" for c in cats]
        ohe = [f"_{c}_ohe" for c in cats]
        cast = ", ".join(f"CAST({_q(c)} AS STRING) AS {_q('_' + c + '_str')}" for c in cats)
        stages.append(SQLTransformer(statement=f"SELECT *, {cast} FROM __THIS__"))
        stages.append(StringIndexer(inputCols=[f"_{c}_str" for c in cats], outputCols=idx,
                                    handleInvalid="keep", stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True))
        vec_inputs += ohe
    pas = list(fs.passthrough)
    if pas:
        cast = ", ".join(f"COALESCE(CAST({_q(c)} AS DOUBLE), 0.0) AS {_q('_' + c + '_pt')}" for c in pas)
        stages.append(SQLTransformer(statement=f"SELECT *, {cast} FROM __THIS__"))
        vec_inputs += [f"_{c}_pt" for c in pas]
    stages.append(VectorAssembler(inputCols=vec_inputs, outputCol=out, handleInvalid="keep"))
    return stages


MAX_CATEGORIES, MAX_SEGMENTS = 1_000, 100


def categories(df: DataFrame, cols: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct values (as text) of each column; more than
    ``MAX_CATEGORIES`` of them is an error, since each one is a model column."""
    out = {}
    for c in cols:
        got = [r[0] for r in df.select(F.col(c).cast("string").alias("v")).where("v is not null").distinct()
               .orderBy("v").limit(MAX_CATEGORIES + 1).collect()]
        if len(got) > MAX_CATEGORIES:
            raise ValueError(f"{c} has more than {MAX_CATEGORIES} categories")
        out[c] = got
    return out


def _sql_text(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _label(df: DataFrame, label: str) -> DataFrame:
    return df.where(F.col(label).isNotNull()).withColumn(label, F.col(label).cast("double"))


def fit_model(df: DataFrame, fs: FeatureSet, estimator, label: str = C.TARGET,
              scale: bool = True, degree: int = 1, impute_numeric: str | None = "zero",
              drop_first: bool = False) -> PipelineModel:
    """Impute -> scale (population std, fitted here) -> encode -> estimator."""
    with persisted(_label(df, label)) as train:
        return _fit_stages(train, fs, estimator, scale, degree, impute_numeric, drop_first)


def _fit_stages(train: DataFrame, fs: FeatureSet, estimator, scale: bool, degree: int,
                impute_numeric: str | None, drop_first: bool = False) -> PipelineModel:
    fs = fs.checked(train)
    if impute_numeric in ("mean", "median", "mode") and fs.numeric:
        # like sklearn's imputers, drop features with no observed value
        cnt = train.agg(*[F.count(F.col(c)).alias(c) for c in fs.numeric]).first()
        fs = FeatureSet(tuple(c for c in fs.numeric if cnt[c]), fs.categorical, fs.passthrough)
    imp = impute_stages(fs, impute_numeric)
    stages = list(imp)
    if scale and degree == 1 and fs.numeric:
        pre = Pipeline(stages=imp).fit(train).transform(train)
        stages.append(population_scaler(pre, [worked(c) for c in fs.numeric]))
    stages += encode_stages(fs, degree, scale_poly=scale and degree > 1, rows=train.count() if degree > 1 else None,
                            dummies=categories(train, fs.categorical) if drop_first else None, copies=True)
    return Pipeline(stages=stages + [estimator]).fit(train)


def ridge(alpha: float, n: int, label_std: float, max_iter: int = 100) -> LinearRegression:
    """sklearn ``Ridge(alpha)`` in Spark's parametrisation (normal equations)."""
    reg = alpha * label_std / n if n else 0.0
    return LinearRegression(featuresCol="features", labelCol=C.TARGET, regParam=reg,
                            elasticNetParam=0.0, standardization=False, solver="normal",
                            maxIter=max_iter)


def label_stats(df: DataFrame, label: str = C.TARGET) -> tuple[int, float, float]:
    r = _label(df, label).agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("m"),
                              F.stddev_pop(label).alias("s")).first()
    return int(r["n"]), float(r["m"] or 0.0), float(r["s"] or 0.0)


def fit_ridge(df: DataFrame, fs: FeatureSet, alpha: float = C.RIDGE_ALPHA, degree: int = 1,
              label: str = C.TARGET, impute_numeric: str = "mean") -> PipelineModel:
    with persisted(_label(df, label)) as train:
        n, _, s = label_stats(train, label)
        return fit_model(train, fs, ridge(alpha, n, s).setLabelCol(label), label, True, degree, impute_numeric)


def fit_ols(df: DataFrame, fs: FeatureSet, label: str = C.TARGET) -> PipelineModel:
    est = LinearRegression(labelCol=label, regParam=0.0, solver="normal", standardization=False)
    return fit_model(df, fs, est, label, scale=False)


def poisson(alpha: float, mean_label: float, label: str = C.TARGET, max_iter: int = 100):
    """sklearn ``PoissonRegressor(alpha)`` in Spark's parametrisation."""
    reg = alpha / mean_label if mean_label > 0 else alpha
    return GeneralizedLinearRegression(family="poisson", link="log", labelCol=label,
                                       regParam=reg, maxIter=max_iter, tol=1e-8)


def fit_poisson(df: DataFrame, fs: FeatureSet, alpha: float = C.POISSON_ALPHA, degree: int = 1,
                label: str = C.TARGET) -> PipelineModel:
    with persisted(_label(df, label)) as train:
        _, m, _ = label_stats(train, label)
        return fit_model(train, fs, poisson(alpha, m, label), label, True, degree)


def fit_poisson_unpenalized(df: DataFrame, fs: FeatureSet, label: str = C.TARGET) -> PipelineModel:
    """Poisson GLM without a penalty: drop-first dummies, constant-0 imputation."""
    est = GeneralizedLinearRegression(family="poisson", link="log", labelCol=label, regParam=0.0,
                                      maxIter=100, tol=1e-10)
    return fit_model(df, fs, est, label, True, drop_first=True)


def fit_group_means(df: DataFrame, keys: Sequence[str], label: str = C.TARGET) -> PipelineModel:
    """Saturated Poisson model of one categorical key: at its optimum the
    prediction of a row is the mean label of its category."""
    est = GeneralizedLinearRegression(family="poisson", link="log", labelCol=label, regParam=0.0, maxIter=100, tol=1e-12)
    return fit_model(df, FeatureSet([], list(keys), []), est, label, scale=False, drop_first=True)


def fit_random_forest(df: DataFrame, fs: FeatureSet, label: str = C.TARGET, **kw) -> PipelineModel:
    p = {**C.RF_PARAMS, **kw}
    est = RandomForestRegressor(labelCol=label, numTrees=p["numTrees"], maxDepth=p["maxDepth"],
                                minInstancesPerNode=p["minInstancesPerNode"], seed=p["seed"],
                                featureSubsetStrategy="all")
    return fit_model(df, fs, est, label, scale=True, impute_numeric="mean")


def fit_gbt(df: DataFrame, fs: FeatureSet, label: str = C.TARGET, **kw) -> PipelineModel:
    p = {**C.GBT_PARAMS, **kw}
    est = GBTRegressor(labelCol=label, maxIter=p["maxIter"], maxDepth=p["maxDepth"],
                       stepSize=p["stepSize"], featureSubsetStrategy=str(p["subset"]), seed=p["seed"],
                       cacheNodeIds=True, checkpointInterval=p.get("checkpointInterval", 50))
    return fit_model(df, fs, est, label, scale=True, impute_numeric="mean")


def feature_names(model: PipelineModel, transformed: DataFrame, col: str = "features") -> list[str]:
    """Names of the assembled vector slots, from the column's ML attributes."""
    meta = transformed.schema[col].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    slots = []
    for kind in attrs.values():
        for a in kind:
            slots.append((a["idx"], a.get("name", f"f{a['idx']}")))
    n = meta.get("num_attrs", len(slots))
    names = dict(slots)
    return [names.get(i, f"f{i}") for i in range(n)]


def plain_name(slot: str) -> str:
    """The feature (or feature_category) that a vector slot stands for."""
    return slot.removeprefix("_f_").removesuffix("_pt").replace("_ohe_", "_").lstrip("_")


def scored(model: PipelineModel, df: DataFrame, out: str = "prediction") -> DataFrame:
    """The rows of ``df``, every column as it came, with the model's prediction."""
    return model.transform(df).select(*df.columns, F.col("prediction").alias(out))


def coef_table(model: PipelineModel, transformed: DataFrame, prefix: str | None = None) -> DataFrame:
    """feature, coefficients, magnitude (= |coef|), sorted by magnitude desc;
    ``transformed`` is any output of the model, which names the slots."""
    spark = transformed.sparkSession
    est = model.stages[-1]
    coefs = [float(x) for x in est.coefficients.toArray()]
    names = feature_names(model, transformed)
    rows = [(plain_name(n), c, abs(c)) for n, c in zip(names, coefs)]
    df = spark.createDataFrame(rows, "feature string, coefficients double, magnitude double")
    if prefix:
        df = df.where(F.col("feature").startswith(prefix))
    return df.orderBy(F.desc("magnitude"), "feature")


def fit_segmented(df: DataFrame, segment_col: str, fit_fn) -> dict:
    """One model per segment value (e.g. bowl 0 / 1); a column with more than
    ``MAX_SEGMENTS`` values is no segment column."""
    values = [r[0] for r in df.select(segment_col).where(F.col(segment_col).isNotNull()).distinct()
              .orderBy(segment_col).limit(MAX_SEGMENTS + 1).collect()]
    if len(values) > MAX_SEGMENTS:
        raise ValueError(f"{segment_col} has more than {MAX_SEGMENTS} values")
    return {v: fit_fn(df.where(F.col(segment_col) == v)) for v in values}


def score_segmented(df: DataFrame, segment_col: str, models: dict, out: str = "prediction", default=None) -> DataFrame:
    """Route each row to its segment's model: filter + union of the scored parts.

    Rows of a segment without a model, NULL included, go to the ``default``
    segment's model (the last one unless given), so no row is lost."""
    if default is None:
        default = list(models)[-1]
    seg, others, parts = F.col(segment_col), [v for v in models if v != default], []
    for v, m in models.items():
        own = ~F.coalesce(seg.isin(others), F.lit(False)) if v == default else seg == v
        parts.append(scored(m, df.where(own), out))
    out_df = parts[0]
    for p in parts[1:]:
        out_df = out_df.unionByName(p)
    return out_df


def predict_batch(rows: DataFrame, poisson_model: PipelineModel, segment_col: str, models: dict) -> DataFrame:
    """Both predictions of every row: by its segment's model and by the Poisson model."""
    seg = score_segmented(rows, segment_col, models, "predicted_segmented")
    return scored(poisson_model, seg, "predicted_poisson")


def results(scored: DataFrame, keys: Sequence[str], label: str = C.TARGET) -> DataFrame:
    """Keys with the true and the predicted value."""
    return scored.select(*keys, F.col(label).alias("y_true"), F.col("prediction").alias("y_pred"))


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
