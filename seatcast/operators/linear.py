"""Linear models fitted from sufficient statistics (survey 2.8, 2.9).

Ridge and least squares need one pass for any number of penalties and folds:
:func:`~seatcast.operators.gram.moments` by fold or date range gives every fit
and every error.  Poisson models take one pass an iteration, for all segments at
once: each task adds up, for every segment, the score and the Fisher information
at the current coefficients, and the small systems are solved on the driver.
The unpenalised solution is taken by a pseudo-inverse from the eigenvalues of
the information, so a design with dependent columns (a constant and all dummies)
has its least-norm coefficients and standard errors.  A search fits all settings
and folds in the same passes, mostly by gradients alone (:class:`PoissonFits`).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from math import erfc, sqrt

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatcast import constants as C
from seatcast.operators import splits
from seatcast.operators._util import persisted
from seatcast.operators.gram import Design, Moments, by_key, moments, prepared, total
from seatcast.operators.models import FeatureSet

RANK_TOLERANCE = 1e-11       # eigenvalues below this share of the largest count as none
MAX_ITERATIONS, DEVIANCE_TOLERANCE = 100, 1e-11
GAP_TOLERANCE = 1e-18        # of many fits: what a step can still gain, as a share of the value
SLOW = 0.05                  # a gap that shrinks less than this calls for the information at the new place
NO_FOLD = -(1 << 62)         # key of rows without a fold: they train only what is fitted on all rows


@dataclass
class LinearFit:
    """Coefficients of the imputed columns as they are (``coef``) and as scaled
    for the fit (``scaled_coef``), and what the imputation puts for NULL."""
    design: Design
    intercept: float
    coef: np.ndarray
    scaled_coef: np.ndarray
    scale: np.ndarray
    fills: np.ndarray
    alpha: float = 0.0
    log_link: bool = False
    summary: dict | None = None

    def linear(self) -> Column:
        x = F.array(*self.design.terms(self.fills))
        w = F.array(*[F.lit(float(c)) for c in self.coef])
        return F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(float(self.intercept)), lambda s, v: s + v)

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, F.exp(self.linear()) if self.log_link else self.linear())

    def sse(self, raw: Moments) -> float:
        """Sum of squared errors over the rows of ``raw`` (raw columns and label)."""
        d, k = len(self.coef), len(self.fills) if self.design.fill == "mean" else 0
        v = np.zeros(d + k + 1)
        v[:d], v[-1] = -self.coef, 1.0
        if k:
            v[d:d + k] = -self.coef[:k] * self.fills
        return float(v @ raw.m2 @ v + raw.n * (v @ raw.mean - self.intercept) ** 2)


def solve_ridge(raw: Moments, design: Design, alpha: float, scale: bool = True) -> LinearFit:
    """Ridge with an unpenalised intercept; leading columns are scaled by their
    population std (a constant one by 1).  ``alpha`` 0 is least squares, of least
    norm where columns are dependent."""
    a, fills = design.imputing(raw)
    m = raw.mapped(a)
    d = len(design.names)
    s = np.ones(d)
    if scale:
        var = np.diag(m.m2)[:design.scaled] / max(m.n, 1.0)
        flat = var <= 1e-24 * (m.mean[:design.scaled] ** 2 + var)
        s[:design.scaled] = np.where(flat, 1.0, np.sqrt(np.where(flat, 1.0, var)))
    xx, xy = m.m2[:d, :d] / np.outer(s, s), m.m2[:d, d] / s
    if alpha > 0:
        w = np.linalg.solve(xx + alpha * np.eye(d), xy)
    else:
        w = pseudo_inverse(xx)[0] @ xy
    coef = w / s
    return LinearFit(design, float(m.mean[d] - coef @ m.mean[:d]), coef, w, s, fills, alpha)


def pseudo_inverse(h: np.ndarray) -> tuple[np.ndarray, int]:
    """Moore-Penrose inverse of a symmetric positive matrix, and its rank."""
    if not len(h):
        return h, 0
    values, vectors = np.linalg.eigh(h)
    keep = values > RANK_TOLERANCE * max(values[-1], 0.0)
    v = vectors[:, keep]
    return (v / values[keep]) @ v.T, int(keep.sum())


def fit_ridge(df: DataFrame, design: Design, alpha: float, label: str = C.TARGET, scale: bool = True) -> LinearFit:
    return solve_ridge(moments(prepared(df, design, label), design)[0], design, alpha, scale)


# ---------------------------------------------------------------- folds ----
def _rmse(fit: LinearFit, parts: Sequence[Moments]) -> float | None:
    n = sum(p.n for p in parts)
    return sqrt(max(0.0, sum(fit.sse(p) for p in parts)) / n) if n else None


def kfold(df: DataFrame, design: Design, alpha: float, fold: Column, k: int, label: str = C.TARGET, scale: bool = True) -> DataFrame:
    """Test and training RMSE of every fold, one pass: fold, n, rmse, train_rmse."""
    got = moments(prepared(df, design, label, fold), design)
    rows = []
    for i in range(k):
        rest = [m for j, m in sorted(got.items()) if j != i]
        own = [got[i]] if i in got else []
        if not rest:
            continue
        fit = solve_ridge(total(rest), design, alpha, scale)
        rows.append((i, int(sum(m.n for m in own)), _rmse(fit, own), _rmse(fit, rest)))
    return df.sparkSession.createDataFrame(rows, "fold int, n bigint, rmse double, train_rmse double")


def search(df: DataFrame, design: Design, alphas: Sequence[float], fold: Column, label: str = C.TARGET):
    """Mean squared error of every penalty over the folds, one pass for all:
    (table of candidate, alpha, degree, mean_mse, std_mse, best; the best fit on all rows)."""
    got = moments(prepared(df, design, label, fold), design)
    keys, scores = sorted(got), []
    for alpha in alphas:
        fits = [solve_ridge(total([got[j] for j in keys if j != i]), design, alpha) for i in keys]
        scores.append([f.sse(got[i]) / got[i].n for f, i in zip(fits, keys)])
    best = min(range(len(alphas)), key=lambda n: np.mean(scores[n]))
    rows = [(n, float(a), float(design.degree), float(np.mean(s)), float(np.std(s)), n == best)
            for n, (a, s) in enumerate(zip(alphas, scores))]
    table = df.sparkSession.createDataFrame(rows, "candidate int, alpha double, degree double, mean_mse double, std_mse double, best boolean")
    return table, solve_ridge(total([got[i] for i in keys]), design, alphas[best])


def backtest(df: DataFrame, design: Design, alpha: float, label: str = C.TARGET, scale: bool = True,
             train_dates: int = C.BACKTEST_TRAIN_DATES, valid_dates: int = C.BACKTEST_VALID_DATES,
             date_col: str = "calculate_date") -> DataFrame:
    """Expanding-window backtest: fold, date ranges, rmse, n.

    Rows are added up by validation range (what comes before the first one is
    range -1); a fold's training statistics are the ranges before it, merged."""
    spark = df.sparkSession
    with persisted(df.select(*dict.fromkeys([date_col, label, *design.numeric, *design.categorical, *design.passthrough]))) as data:
        folds = splits.expanding_folds(data, train_dates, valid_dates, date_col).orderBy("fold").collect()   # a row a fold
        if not folds:
            return spark.createDataFrame([], "fold int, train_from date, train_to date, valid_from date, valid_to date, rmse double, n bigint")
        d, part = F.col(date_col), F.lit(-1)
        for f in folds:
            part = F.when((d >= F.lit(f["valid_from"])) & (d <= F.lit(f["valid_to"])), f["fold"]).otherwise(part)
        got = moments(prepared(data, design, label, F.when(d.isNotNull(), part)), design)
    rows, upto = [], got.get(-1)
    for f in folds:
        own = got.get(f["fold"])
        if upto is not None and own is not None:
            fit = solve_ridge(upto, design, alpha, scale)
            rows.append((f["fold"], f["train_from"], f["train_to"], f["valid_from"], f["valid_to"], _rmse(fit, [own]), int(own.n)))
        if own is not None:
            upto = own if upto is None else upto + own
    return spark.createDataFrame(rows, "fold int, train_from date, train_to date, valid_from date, valid_to date, rmse double, n bigint")


def holdout(df: DataFrame, design: Design, alpha: float, held: Column, label: str = C.TARGET, scale: bool = True) -> DataFrame:
    """RMSE and R^2 of the held-out rows, one pass: rmse, r2, n."""
    got = moments(prepared(df, design, label, held.cast("int")), design)
    fit, own = solve_ridge(got[0], design, alpha, scale), got[1]
    sse, sst = fit.sse(own), float(own.m2[-1, -1])
    return df.sparkSession.createDataFrame([(_rmse(fit, [own]), 1 - sse / sst if sst else None, int(own.n))], "rmse double, r2 double, n bigint")


# -------------------------------------------------------------- Poisson ----
def _pack(n, dev, ll, g, h) -> bytes:
    return np.concatenate([[n, dev, ll], g, h.ravel()]).tobytes()


def _unpack(b: bytes, d: int):
    v = np.frombuffer(b)
    return v[0], v[1], v[2], v[3:3 + d], v[3 + d:].reshape(d, d)


def _add(states: list[bytes]) -> bytes:
    return np.sum([np.frombuffer(s) for s in states], axis=0).tobytes()


def _scales(m: Moments, design: Design, ddof: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Std of the scaled columns, 1 for constant ones and the others; which ones are constant."""
    s, top = np.ones(len(design.names)), design.scaled
    var = np.diag(m.m2)[:top] / max(m.n - ddof, 1.0)
    flat = ~(var > 1e-24 * m.mean[:top] ** 2)
    s[:top] = np.where(flat, 1.0, np.sqrt(np.maximum(var, 0)))
    s[s == 0] = 1.0
    return s, np.concatenate([flat, np.zeros(len(s) - top, bool)])


def fit_poisson(df: DataFrame, design: Design, alpha: float = 0.0, label: str = C.TARGET, segment: Column | None = None,
                ddof: int = 0) -> dict[int, LinearFit]:
    """Poisson regression with log link for every segment (a whole number; 0
    without one), all segments in each pass.  ``alpha`` as in sklearn (mean half
    deviance plus alpha / 2 times the squared coefficients); 0 gives the
    maximum-likelihood fit with standard errors in ``summary``.  Numeric columns
    are scaled by their std with ``ddof``."""
    if design.fill != "zero":
        raise ValueError("the Poisson fit takes zero-filled features")
    with persisted(prepared(df, design, label, segment)) as rows:
        stats = moments(rows, design)
        d = len(design.names)
        start, scale, centre, penalty = {}, {}, {}, {}
        for k, m in stats.items():
            c = np.zeros(d)
            c[:design.scaled] = m.mean[:design.scaled]
            scale[k], centre[k] = _scales(m, design, ddof)[0], c
            start[k] = np.concatenate([[np.log(max(m.mean[d], 1e-12))], np.zeros(d)])
            penalty[k] = np.concatenate([[0.0], np.full(d, alpha * m.n)])
        beta, done, old = dict(start), {}, {}
        for _ in range(MAX_ITERATIONS):
            state = {k: _unpack(s, d + 1) for k, s in _pass(rows, design, {k: b for k, b in beta.items() if k not in done}, centre, scale).items()}
            for k, (n, dev, ll, g, h) in state.items():
                b, p = beta[k], penalty[k]
                value = dev + float(p @ b ** 2)
                if k in old and value > old[k][0] + 1e-9 * (abs(old[k][0]) + 1) and old[k][2] < 30:     # too far: half the step
                    beta[k], old[k] = (b + old[k][1]) / 2, (old[k][0], old[k][1], old[k][2] + 1)
                    continue
                inverse, rank = pseudo_inverse(h + np.diag(p))
                after = inverse @ (h @ b + g)       # solved whole, not as a step: of least norm whatever the start
                step = after - b
                if k in old and abs(old[k][0] - value) <= DEVIANCE_TOLERANCE * (abs(value) + 0.1) or not np.abs(step).max() > 1e-12:
                    done[k] = (b, n, dev, ll, inverse, rank)
                old[k], beta[k] = (value, b, 0), after
            if len(done) == len(beta):
                break
        else:
            raise RuntimeError(f"no convergence after {MAX_ITERATIONS} passes")
    out = {}
    for k, (b, n, dev, ll, inverse, rank) in done.items():
        coef = b[1:] / scale[k]
        error = np.sqrt(np.maximum(np.diag(inverse), 0.0)) if alpha == 0 else None
        out[k] = LinearFit(design, float(b[0] - coef @ centre[k]), coef, b[1:], scale[k], np.zeros(len(design.numeric)), alpha, True,
                           {"n": int(n), "deviance": float(dev), "log_likelihood": float(ll), "rank": rank,
                            "aic": 2.0 * rank - 2.0 * float(ll), "constant": float(b[0]), "std_error": error})
    return out


def _pass(rows: DataFrame, design: Design, beta: dict, centre: dict, scale: dict) -> dict[int, bytes]:
    """Per segment: rows, deviance, log-likelihood, score and Fisher information at ``beta``."""
    def states(batch):
        keys, y, x = batch.column(0).to_numpy(), batch.column(1).to_numpy(), design.matrix(batch, 2)
        out = {}
        for k in np.unique(keys):
            k = int(k)
            if k not in beta:
                continue
            mine = keys == k
            z = np.column_stack([np.ones(int(mine.sum())), (x[mine] - centre[k]) / scale[k]])
            t = y[mine]
            eta = np.clip(z @ beta[k], -700, 700)
            mu = np.exp(eta)
            seen = t > 0
            dev = 2.0 * float(np.sum(t[seen] * np.log(t[seen] / mu[seen])) - np.sum(t - mu))
            ll = float(np.sum(t * eta - mu) - log_factorials(t))
            out[k] = _pack(len(t), dev, ll, z.T @ (t - mu), z.T @ (z * mu[:, None]))
        return out

    return by_key(rows, states, _add)


@dataclass
class _Fit:
    """One of many fits: the fold it leaves out (None: it takes all rows), its
    columns (the constant first), penalty by column, and where it stands."""
    held: int | None
    columns: np.ndarray
    penalty: np.ndarray
    info: np.ndarray
    w: np.ndarray
    last: tuple[float, float, np.ndarray] | None = None      # value and gap there, and the place
    stale: bool = False
    sse: float | None = None                                 # once done: over the fold left out


@dataclass(frozen=True)
class PoissonFits:
    """Poisson models for :func:`~seatcast.operators.splits.random_search`: a
    setting has a penalty ``alpha`` above 0 (as in :func:`fit_poisson`) and a
    ``degree``, 1 or 2.

    All settings and folds share their passes, and so do the fits of all
    settings on all rows.  A fit starts from the mean label, where its
    information follows from the moments of the folds, and keeps that for its
    steps; a pass then takes gradients only.  Where this gains too little the
    next pass takes the information at the current place (a Newton step).
    Columns are centred and scaled alike for all fits; a fold's own scale is in
    the weights of its penalty, and its own centre in the constant.  A model of
    degree 1 is one of degree 2 without the products."""
    features: FeatureSet

    def search(self, df: DataFrame, settings: Sequence[dict], k: int, label: str = C.TARGET,
               fold: str = "fold") -> tuple[list[list[float]], list[LinearFit]]:
        """Mean squared errors of every setting on the folds that it was not fitted on, and its model of all rows."""
        if any(s["degree"] not in (1, 2) or not s["alpha"] > 0 for s in settings):
            raise ValueError("a setting needs degree 1 or 2 and a penalty above 0")
        design = Design.of(df, self.features, degree=int(max(s["degree"] for s in settings)))
        with persisted(prepared(df, design, label, F.coalesce(F.col(fold).cast("bigint"), F.lit(NO_FOLD)))) as rows:
            stats = moments(rows, design)
            for i in range(k):
                if i not in stats:
                    raise ValueError(f"fold {i} has no rows with a label")
            whole = total([m for _, m in sorted(stats.items())])
            centre, scale = whole.mean[:-1], _scales(whole, design)[0]
            fits = [_begin(design, stats, i, s, centre, scale) for s in settings for i in (*range(k), None)]
            _fit_many(rows, design, fits, centre, scale)
        each = [fits[n:n + k + 1] for n in range(0, len(fits), k + 1)]
        return ([[f.sse / stats[f.held].n for f in own[:k]] for own in each],
                [_on_all_rows(design, own[k], s, centre, scale) for own, s in zip(each, settings)])


def _begin(design: Design, stats: dict[int, Moments], held: int | None, setting: dict, centre: np.ndarray, scale: np.ndarray) -> _Fit:
    parts = [m for k, m in sorted(stats.items()) if held is None or k not in (held, NO_FOLD)]
    if not parts:
        raise ValueError(f"no rows with a label outside fold {held}")
    m, d = total(parts), len(design.names)
    own, flat = _scales(m, design)
    weight = np.concatenate([[0.0], setting["alpha"] * m.n * np.where(flat, 1.0, own / scale) ** 2])
    x = np.concatenate([[1.0], (m.mean[:d] - centre) / scale])
    info = m.n * np.outer(x, x)
    info[1:, 1:] += m.m2[:d, :d] / np.outer(scale, scale)
    columns = np.arange(d + 1)
    if setting["degree"] == 1:      # without the products
        columns = np.concatenate([columns[:len(design.numeric) + 1], columns[design.scaled + 1:]])
    start, penalty, w = max(float(m.mean[d]), 1e-12), weight[columns], np.zeros(len(columns))
    w[0] = np.log(start)
    return _Fit(held, columns, penalty, start * info[np.ix_(columns, columns)] + np.diag(penalty), w)


def _on_all_rows(design: Design, fit: _Fit, setting: dict, centre: np.ndarray, scale: np.ndarray) -> LinearFit:
    own = replace(design, degree=int(setting["degree"]))
    s, c = scale[fit.columns[1:] - 1], centre[fit.columns[1:] - 1]
    coef = fit.w[1:] / s
    return LinearFit(own, float(fit.w[0] - coef @ c), coef, fit.w[1:], s, np.zeros(len(own.numeric)), float(setting["alpha"]), True)


def _fit_many(rows: DataFrame, design: Design, fits: Sequence[_Fit], centre: np.ndarray, scale: np.ndarray) -> None:
    """Takes every fit to its optimum."""
    for _ in range(MAX_ITERATIONS):
        left = [f for f in fits if f.sse is None]
        if not left:
            return
        for f, dev, sse, g, h in zip(left, *_gradients(rows, design, left, centre, scale)):
            value = float(dev + f.penalty @ f.w ** 2)
            if f.last and not value <= f.last[0] + 1e-9 * (abs(f.last[0]) + 1):     # too far: half the step
                f.w, f.stale = (f.w + f.last[2]) / 2, True
                continue
            if h is not None:
                f.info = h[np.ix_(f.columns, f.columns)] + np.diag(f.penalty)
            g = g[f.columns] - f.penalty * f.w
            step = np.linalg.solve(f.info, g)
            gap = float(g @ step)
            if gap <= GAP_TOLERANCE * (abs(value) + 0.1):
                f.sse = float(sse)
            else:
                f.stale = f.last is not None and gap > SLOW * f.last[1]
                f.last, f.w = (value, gap, f.w), f.w + step
    raise RuntimeError(f"no convergence after {MAX_ITERATIONS} passes")


def _gradients(rows: DataFrame, design: Design, fits: Sequence[_Fit], centre: np.ndarray, scale: np.ndarray):
    """Of every fit: deviance over its training rows, squared errors over the fold
    it leaves out, score, and the Fisher information if stale (None for others)."""
    n, d, held, wanted = len(fits), len(design.names) + 1, [f.held for f in fits], [i for i, f in enumerate(fits) if f.stale]
    w = np.zeros((n, d))
    for row, f in zip(w, fits):
        row[f.columns] = f.w

    def states(batch):
        keys, y = batch.column(0).to_numpy(), batch.column(1).to_numpy()[:, None]
        if (y < 0).any():
            raise ValueError("a Poisson model needs labels of 0 or more")
        x = design.matrix(batch, 2)
        x -= centre
        x /= scale
        eta = np.clip(x @ w[:, 1:].T + w[:, 0], -700, 700)
        mu = np.exp(eta)
        own = np.column_stack([np.ones(len(keys), bool) if h is None else (keys != h) & (keys != NO_FOLD) for h in held])
        out = np.column_stack([np.zeros(len(keys), bool) if h is None else keys == h for h in held])
        dev = 2.0 * np.where(own, y * (np.log(np.where(y > 0, y, 1.0)) - eta) - (y - mu), 0.0).sum(axis=0)
        r = np.where(own, y - mu, 0.0)
        with np.errstate(over="ignore"):
            sse = np.where(out, (y - mu) ** 2, 0.0).sum(axis=0)
        state = {-1: np.concatenate([dev, sse, np.column_stack([r.sum(axis=0), r.T @ x]).ravel()]).tobytes()}
        for i in wanted:
            v = np.where(own[:, i], mu[:, i], 0.0)
            h = np.empty((d, d))
            h[0, 0] = v.sum()
            h[0, 1:] = h[1:, 0] = v @ x
            h[1:, 1:] = x.T @ (x * v[:, None])
            state[i] = h.tobytes()
        return state

    got = by_key(rows, states, _add)
    v = np.frombuffer(got[-1])
    return v[:n], v[n:2 * n], v[2 * n:].reshape(n, d), [np.frombuffer(got[i]).reshape(d, d) if i in got else None for i in range(n)]


def log_factorials(y: np.ndarray) -> float:
    """Sum of log(y!) over whole numbers (log-gamma of y + 1 for others)."""
    from math import lgamma
    values, times = np.unique(y, return_counts=True)
    return float(sum(lgamma(v + 1.0) * t for v, t in zip(values, times)))


def summary_rows(fit: LinearFit) -> list[tuple]:
    """(feature, coefficient, std_error, z_value, p_value, deviance, aic) of an unpenalised fit, the constant first."""
    s = fit.summary
    names, coefs = ["const", *fit.design.names], [s["constant"], *fit.scaled_coef]
    out = []
    for name, b, e in zip(names, coefs, s["std_error"]):
        z = b / e if e > 0 else None
        out.append((name, float(b), float(e), None if z is None else float(z), None if z is None else float(erfc(abs(z) / sqrt(2))),
                    s["deviance"], s["aic"]))
    return out


def coef_rows(fit: LinearFit) -> list[tuple[str, float, float]]:
    """(feature, coefficient as fitted, magnitude), largest first."""
    rows = [(n, float(w), abs(float(w))) for n, w in zip(fit.design.names, fit.scaled_coef)]
    return sorted(rows, key=lambda r: (-r[2], r[0]))


def score_segments(df: DataFrame, fits: dict[int, LinearFit], segment: Column, default: int | None = None, out: str = "prediction") -> DataFrame:
    """Every row scored with its segment's coefficients, looked up as an array:
    one pass, no filter or union.  NULL and unseen segments take those of the
    ``default`` segment (the last one unless given)."""
    default = max(fits) if default is None else default
    design, log_link = fits[default].design, fits[default].log_link
    found = F.lit(default)
    for k in fits:
        found = F.when(segment == k, k).otherwise(found)
    arrays = F.create_map(*[c for k, f in fits.items() for c in
                            (F.lit(k), F.array(*[F.lit(float(v)) for v in (f.intercept, *f.coef)]))])
    x = F.array(F.lit(1.0), *design.terms(np.zeros(len(design.numeric))))
    eta = F.aggregate(F.zip_with(x, F.element_at(arrays, found), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    return df.withColumn(out, F.exp(eta) if log_link else eta)
