"""LEAR forecast: one AIC-selected lasso per point, hour and fold.

Spark lays out the design rows, cuts the history into overlapping day ranges and shuffles them by
(point, hour, range); a task then holds one bounded range, `window + range` rows whatever the size
of the data, and fits its folds from running moments.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..config import Model
from ..session import task_count
from .baselines import as_forecast
from .folds import DAY_IDX, first_origin, with_folds, with_mature_folds

# The lags, in days, of the classic LEAR design.
LEAR_LAGS = (1, 2, 3, 7)
RANGE_KEYS = [S.POINT, S.HOUR, "_range"]


def numeric_columns(model: Model) -> list[str]:
    return [*map(S.lag_name, LEAR_LAGS), *model.exogenous]


def design_row(model: Model) -> Column:
    """Numeric columns, holiday flag, then weekday and month dummies without their first level."""
    numeric = [F.col(c).cast("double") for c in numeric_columns(model)]
    flag = [F.col(S.HOLIDAY).cast("double")]
    weekdays = [(F.col(S.DOW) == d).cast("double") for d in range(1, 7)]
    months = [(F.col(S.MONTH) == m).cast("double") for m in range(2, 13)]
    return F.array(*numeric, *flag, *weekdays, *months)


def lasso_knots(gram: np.ndarray, corr: np.ndarray) -> list[np.ndarray]:
    """Coefficients at every knot of the lasso path, from the centred Gram matrix and X'y."""
    size = len(corr)
    scale = np.where(np.diag(gram) > 0, np.diag(gram), 1.0)
    usable = np.diag(gram) > 1e-12 * max(float(np.max(np.diag(gram), initial=0.0)), 1e-300)
    beta, active, knots = np.zeros(size), [], [np.zeros(size)]
    level = float(np.max(np.abs(corr[usable]), initial=0.0))
    tiny = 1e-11 * max(level, 1e-300)
    entering = int(np.argmax(np.where(usable, np.abs(corr), -1.0))) if level > 0 else None
    gone = None
    stalled = 0
    while True:
        if entering is not None:
            trial = [*active, entering]
            block = gram[np.ix_(trial, trial)] / np.sqrt(np.outer(scale[trial], scale[trial]))
            if np.linalg.eigvalsh(block)[0] > 1e-9:
                active = trial
            else:  # a column the active ones already span
                usable[entering] = False
        if level <= tiny or (not active and entering is None):
            break
        residual = corr - gram @ beta
        direction = np.zeros(size)
        if active:
            direction[active] = np.linalg.solve(gram[np.ix_(active, active)], np.sign(residual[active]))
        slope = gram @ direction
        idle = usable.copy()
        idle[active] = False
        with np.errstate(divide="ignore", invalid="ignore"):
            reach = np.stack([(level - residual) / (1.0 - slope), (level + residual) / (1.0 + slope)])
            leave = -beta / direction
        reach[:, ~idle] = np.inf
        reach[~(reach > -tiny)] = np.inf
        if gone is not None:  # it stands at the level it left, and may only come back from the other side
            reach[0 if residual[gone] > 0 else 1, gone] = np.inf
        join = np.maximum(reach.min(axis=0), 0.0)
        leave[(direction == 0) | ~(leave > 0)] = np.inf
        step = min(float(join.min()), float(leave.min()), level)
        beta = beta + step * direction
        level -= step
        stalled = 0 if step > 0 else stalled + 1
        if stalled > 4 * size:
            raise RuntimeError("the lasso path makes no progress: columns join and leave at one level")
        entering = gone = None
        if step == leave.min():
            gone = int(np.argmin(leave))
            beta[gone] = 0.0
            active = [j for j in active if j != gone]
        elif step == join.min():
            entering = int(np.argmin(join))
        knots.append(beta.copy())
        if not active and entering is None:
            entering, gone = gone, None
    return knots


def aic_lasso(gram: np.ndarray, corr: np.ndarray, total: float, rows: float) -> np.ndarray:
    """The knot with the smallest AIC; the noise level is that of the full least-squares fit."""
    spare = rows - len(corr) - 1
    if spare <= 0:
        raise ValueError(f"{int(rows)} training rows cannot support {len(corr)} features")
    full = np.linalg.lstsq(gram, corr, rcond=1e-10)[0]
    noise = max((total - full @ corr) / spare, 1e-12 * max(total, 1e-300))
    best, chosen = np.inf, np.zeros(len(corr))
    for beta in lasso_knots(gram, corr):
        rss = total - 2 * beta @ corr + beta @ gram @ beta
        score = rss / noise + 2 * np.count_nonzero(np.abs(beta) > np.finfo(float).eps)
        if score < best - 1e-9:
            best, chosen = score, beta
    return chosen


def _fit_range(model: Model, n_numeric: int, coefficients: bool = False):
    """Build the grouped function: fits every fold of one day range and predicts its test days.

    With `coefficients` it returns the fitted models instead, a row for each fold.
    """
    start, step, window = first_origin(model), model.recalibrate_every_days, model.window_days

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(DAY_IDX, kind="stable")
        day, x, y = rows[DAY_IDX].to_numpy(), np.stack(rows["x"].to_numpy()), rows["y"].to_numpy(float)
        x0, y0 = x.mean(axis=0), y.mean()
        spread = np.ones(x.shape[1])
        spread[:n_numeric] = np.where(x[:, :n_numeric].std(axis=0) > 0, x[:, :n_numeric].std(axis=0), 1.0)
        z = np.column_stack([np.ones(len(y)), (x - x0) / spread, y - y0])
        running = np.concatenate(
            [np.zeros((1, z.shape[1], z.shape[1])), np.cumsum(z[:, :, None] * z[:, None, :], axis=0)]
        )
        out = rows[rows["is_test"]]
        predicted, fitted = np.full(len(out), np.nan), []
        folds = out[S.FOLD].to_numpy()
        for fold in np.unique(folds):
            origin = start + int(fold) * step
            lo, hi = np.searchsorted(day, [max(0, origin - window), origin])
            if lo == hi:
                continue  # the point has no training day, so there is no mean to fall back on
            moments = running[hi] - running[lo]
            count = moments[0, 0]
            mean = moments[0] / count
            centred = moments[1:, 1:] - count * np.outer(mean[1:], mean[1:])
            unit = np.ones(x.shape[1])
            deviation = np.sqrt(np.maximum(np.diag(centred)[:n_numeric] / count, 0.0))
            unit[:n_numeric] = np.where(deviation > 1e-9, deviation, 1.0)
            gram = centred[:-1, :-1] / np.outer(unit, unit)
            beta = aic_lasso(gram, centred[:-1, -1] / unit, centred[-1, -1], count)
            if coefficients:
                fitted.append((rows[S.POINT].iloc[0], rows[S.HOUR].iloc[0], fold, y0 + mean[-1],
                               x0 + mean[1:-1] * spread, spread * unit, beta))
                continue
            mask = folds == fold
            test = (np.stack(out["x"].to_numpy()[mask]) - x0) / spread
            predicted[mask] = y0 + mean[-1] + ((test - mean[1:-1]) / unit) @ beta
        if coefficients:
            return pd.DataFrame(fitted, columns=[S.POINT, S.HOUR, S.FOLD, "level", "centre", "scale", "beta"])
        return out.drop(columns=["x", "is_test"]).assign(predicted=predicted)

    return fit


def _ranges(matrix: DataFrame, model: Model, folds_per_range: int | None = None) -> DataFrame:
    """Design rows per (point, hour, range); a range covers `folds_per_range` folds (default: half a window)."""
    start, step = first_origin(model), model.recalibrate_every_days
    per = folds_per_range or max(1, model.window_days // (2 * step))
    span = per * step
    rows = with_mature_folds(matrix, model)
    idx = F.col(DAY_IDX)
    # A day trains the ranges that start at most a window later and is tested in its own.
    own = F.floor((idx - start) / span).cast("int")
    last = F.floor((idx - start + model.window_days) / span).cast("int")
    final = F.floor((F.col("_days") - 1 - start) / span).cast("int")
    days = rows.agg(F.max(DAY_IDX) + 1).scalar()
    bounded = (
        rows.withColumn("_days", days)
        .withColumn("_lo", F.greatest(own, F.lit(0)))
        .withColumn("_hi", F.least(last, final))
        .where(F.col("_lo") <= F.col("_hi"))
    )
    ranged = bounded.select(
        S.POINT, S.HOUR, S.DAY, S.INTERVAL, S.REGIME, S.FOLD, DAY_IDX,
        design_row(model).alias("x"), F.col(S.PRICE).alias("y"), own.alias("_own"),
        F.explode(F.sequence("_lo", "_hi")).alias("_range"),
    )
    tested = F.col(S.FOLD).isNotNull() & (F.col("_own") == F.col("_range"))
    ranged = ranged.withColumn("is_test", tested).drop("_own")
    return ranged.repartition(task_count(matrix.sparkSession), *RANGE_KEYS)


def lear(matrix: DataFrame, model: Model, folds_per_range: int | None = None) -> DataFrame:
    """Forecasts of every fold."""
    spread = _ranges(matrix, model, folds_per_range)
    kept = [f for f in spread.schema.fields if f.name not in ("x", "is_test")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    fitted = spread.groupBy(*RANGE_KEYS).applyInPandas(
        _fit_range(model, len(numeric_columns(model))), f"{schema}, predicted double"
    )
    predicted = F.when(~F.isnan("predicted"), F.col("predicted"))
    return as_forecast(fitted.withColumnRenamed("y", S.PRICE), S.LEAR, predicted)


def coefficients(matrix: DataFrame, model: Model) -> DataFrame:
    """The fitted model of every point, hour and fold: level + sum of beta * (x - centre) / scale."""
    return _ranges(matrix, model).groupBy(*RANGE_KEYS).applyInPandas(
        _fit_range(model, len(numeric_columns(model)), coefficients=True),
        f"{S.POINT} string, {S.HOUR} int, {S.FOLD} int, level double, centre array<double>, scale array<double>, beta array<double>",
    )


def optimality(matrix: DataFrame, fitted: DataFrame, model: Model) -> DataFrame:
    """Whether every fitted model meets the lasso's conditions on its own training rows.

    At a solution the products g of the scaled columns with the residuals have one level: |g| stands at it,
    with the sign of beta, where beta isn't zero, and not above it elsewhere. The products are sums over the
    training rows, from one aggregate with a column each.
    """
    start, step = first_origin(model), model.recalibrate_every_days
    rows, idx = with_folds(matrix, model), F.col(DAY_IDX)
    first = F.greatest(F.floor((idx - start) / step).cast("int") + 1, F.lit(0))
    last = F.floor((idx - start + model.window_days) / step).cast("int")
    trains = rows.select(S.POINT, S.HOUR, design_row(model).alias("x"), F.col(S.PRICE).alias("y"),
                         F.explode(F.when(first <= last, F.sequence(first, last))).alias(S.FOLD))
    z = F.transform("x", lambda v, j: (v - F.get("centre", j)) / F.get("scale", j))
    fit = F.aggregate(F.zip_with("z", "beta", lambda a, b: a * b), F.lit(0.0), lambda a, v: a + v)
    width = len(numeric_columns(model)) + 1 + 6 + 11
    met = trains.join(fitted, [S.POINT, S.HOUR, S.FOLD]).withColumn("z", z).withColumn("rest", F.col("y") - F.col("level") - fit)
    totals = met.groupBy(S.POINT, S.HOUR, S.FOLD).agg(
        F.count(F.lit(1)).alias("n_train"), F.first("beta").alias("beta"),
        F.sqrt(F.count(F.lit(1)) * F.sum((F.col("y") - F.col("level")) ** 2)).alias("size"),
        F.array(*[F.sum(F.get("z", F.lit(j)) * F.col("rest")) for j in range(width)]).alias("g"))
    level, slack = F.array_max(F.transform("g", F.abs)), F.col("size") * 1e-7 + 1e-9
    active = F.forall(F.zip_with("g", "beta", lambda g, b: F.when(b != 0, F.abs(g - F.signum(b) * F.col("at")) <= F.col("slack")).otherwise(True)), lambda ok: ok)
    still = F.exists("beta", lambda b: b != 0)
    return totals.withColumn("at", level).withColumn("slack", slack).select(
        S.POINT, S.HOUR, S.FOLD, "n_train", active.alias("meets"), still.alias("has_active"))
