from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattspan import schemas as S
from wattspan.config import DEFAULT
from wattspan.operators import backtest, folds, forecast
from wattspan.operators.baselines import naive_week, seasonal_dow
from wattspan.operators.boosted import BINS, BLOCK_ROWS, LEAST, RATE, boosted, first_splits
from wattspan.operators.lear import aic_lasso, lasso_knots, lear

MODEL = DEFAULT.with_model(window_days=35, min_train_days=35, recalibrate_every_days=1).model


def synthetic(days=50, points=("HB_HUBAVG",), seed=7, regime="swcap5000", horizon=24):
    rng = np.random.default_rng(seed)
    rows = []
    first = datetime(2024, 1, 1)
    for p in points:
        base = {}
        for d in range(-7, days):
            for h in range(0, 24, 24 // horizon):
                dow = (first + timedelta(days=d)).weekday()
                base[d, h] = 30 + 10 * np.sin(2 * np.pi * h / 24) + 3 * dow + rng.normal(0, 1.5)
        for d in range(days):
            for h in range(0, 24, 24 // horizon):
                at = first + timedelta(days=d, hours=h)
                rows.append((
                    at.date(), at, p, regime, base[d, h], *[base[d - k, h] for k in (1, 2, 3, 7)],
                    h, at.weekday(), at.month, 0, 40000 + 500 * np.sin(h) + rng.normal(0, 50), 15 + rng.normal(0, 3),
                ))
    return rows


@pytest.fixture(scope="module")
def matrix(spark):
    rows = [tuple(float(v) if isinstance(v, np.floating) else v for v in r) for r in synthetic(horizon=6)]
    return spark.createDataFrame(rows, S.matrix_schema(MODEL)).cache()


def test_fold_ranges(spark):
    days = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-20')) delivery_date")
    model = DEFAULT.with_model(window_days=5, min_train_days=10, recalibrate_every_days=1).model
    rows = folds.walk_forward_folds(days, model).orderBy(S.FOLD).collect()
    assert [r[S.FOLD] for r in rows] == list(range(10))
    assert {r.n_train_days for r in rows} == {5} and {r.n_test_days for r in rows} == {1}
    assert (rows[0].train_first_day, rows[0].train_last_day, rows[0].test_first_day) == (
        date(2024, 1, 6), date(2024, 1, 10), date(2024, 1, 11))
    wide = DEFAULT.with_model(window_days=100, min_train_days=10, recalibrate_every_days=4).model
    rows = folds.walk_forward_folds(days, wide).orderBy(S.FOLD).collect()
    assert [(r.n_train_days, r.n_test_days) for r in rows] == [(10, 4), (14, 4), (18, 2)]


def test_training_precedes_testing(matrix):
    rows = folds.fold_causality(matrix, MODEL).collect()
    assert len(rows) == 15 and all(r.causal for r in rows)


def test_seasonal_equals_direct_means(matrix):
    model = DEFAULT.with_model(window_days=20, min_train_days=30, recalibrate_every_days=4).model
    pdf = matrix.toPandas()
    got = seasonal_dow(matrix, model).toPandas()
    days = sorted(pdf[S.DAY].unique())
    assert got[S.DAY].nunique() == 20
    for _, row in got.sample(40, random_state=1).iterrows():
        origin = 30 + int(row[S.FOLD]) * 4
        train = pdf[pdf[S.DAY].isin(days[max(0, origin - 20):origin])]
        cell = train[(train[S.DOW] == row[S.DAY].weekday()) & (train[S.HOUR] == row[S.HOUR])][S.PRICE]
        assert row[S.PREDICTED] == pytest.approx(cell.mean())


def test_seasonal_falls_back_to_the_window_mean(spark, matrix):
    sundays_gone = matrix.where((F.col(S.DOW) != 6) | (F.col(S.DAY) >= "2024-02-05"))
    model = DEFAULT.with_model(window_days=30, min_train_days=30, recalibrate_every_days=30).model
    got = seasonal_dow(sundays_gone, model).toPandas()
    sunday = got[[d.weekday() == 6 for d in got[S.DAY]]]
    train_days = sorted(r[0] for r in sundays_gone.select(S.DAY).distinct().collect())[:30]
    mean = sundays_gone.where(F.col(S.DAY).isin(train_days)).agg(F.avg(S.PRICE)).first()[0]
    assert len(sunday) and sunday[S.PREDICTED].tolist() == pytest.approx([mean] * len(sunday))


def test_lasso_path_meets_its_optimality_conditions():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 8))
    x[:, 3] = x[:, 0] + 0.1 * rng.normal(size=200)
    y = x[:, 0] * 3 - x[:, 5] + rng.normal(size=200)
    x, y = x - x.mean(0), y - y.mean()
    gram, corr = x.T @ x, x.T @ y
    knots = lasso_knots(gram, corr)
    for beta in knots:
        slope = corr - gram @ beta
        level = np.abs(slope).max()
        active = beta != 0
        assert np.allclose(np.abs(slope[active]), level, atol=1e-6 * np.abs(corr).max())
        assert (np.sign(slope[active]) == np.sign(beta[active])).all() or level < 1e-6
    assert np.allclose(knots[-1], np.linalg.solve(gram, corr), atol=1e-6)


def test_aic_pick_and_row_guard():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 10))
    x[:, 9] = 0.0  # a constant dummy
    y = 5 * x[:, 2] + rng.normal(size=400)
    xc, yc = x - x.mean(0), y - y.mean()
    beta = aic_lasso(xc.T @ xc, xc.T @ yc, yc @ yc, 400)
    assert beta[2] == pytest.approx(5, abs=0.3) and beta[9] == 0
    with pytest.raises(ValueError, match="cannot support"):
        aic_lasso(np.eye(10), np.ones(10), 10.0, 11)


def test_lear_equals_a_direct_fit_and_ignores_the_range_cut(matrix):
    whole = lear(matrix, MODEL).toPandas().set_index(S.INTERVAL)[S.PREDICTED]
    cut = lear(matrix, MODEL, folds_per_range=2).toPandas().set_index(S.INTERVAL)[S.PREDICTED]
    assert len(whole) == 15 * 6 and np.allclose(whole.sort_index(), cut.sort_index(), atol=1e-6)
    pdf = matrix.toPandas()
    days = sorted(pdf[S.DAY].unique())
    numeric = ["price_lag_1d", "price_lag_2d", "price_lag_3d", "price_lag_7d", S.DEMAND, S.TEMP]

    def design(df, mean, sd):
        cols = [(df[c] - mean[c]) / sd[c] for c in numeric] + [df[S.HOLIDAY]]
        cols += [(df[S.DOW] == d) for d in range(1, 7)] + [(df[S.MONTH] == m) for m in range(2, 13)]
        return np.column_stack([np.asarray(c, float) for c in cols])

    for k in (35, 41, 49):
        train = pdf[pdf[S.DAY].isin(days[k - 35:k]) & (pdf[S.HOUR] == 8)]
        test = pdf[(pdf[S.DAY] == days[k]) & (pdf[S.HOUR] == 8)]
        mean, sd = train[numeric].mean(), train[numeric].std(ddof=0)
        x, y = design(train, mean, sd), train[S.PRICE].to_numpy()
        xc, yc = x - x.mean(0), y - y.mean()
        beta = aic_lasso(xc.T @ xc, xc.T @ yc, yc @ yc, len(y))
        want = y.mean() + (design(test, mean, sd) - x.mean(0)) @ beta
        assert whole[pd.Timestamp(test[S.INTERVAL].iloc[0])] == pytest.approx(want[0], abs=1e-5)


def test_metrics_table_and_ranking(spark, matrix):
    names = [S.NAIVE_WEEK, S.SEASONAL_DOW, S.LEAR]
    out = forecast.walk_forward(matrix, MODEL, names).cache()
    assert out.schema.names == S.FORECASTS.names
    metrics = forecast.forecast_metrics(out).toPandas()
    assert (metrics.groupby(S.MODEL).size() == 7).all()  # six slots and the pooled row
    naive = metrics[metrics[S.MODEL] == S.NAIVE_WEEK]
    assert np.allclose(naive[S.REL_MAE], 1.0)
    pooled = metrics[metrics[S.HOUR] == -1].set_index(S.MODEL)
    assert pooled.loc[S.SEASONAL_DOW, S.REL_MAE] < 1 and pooled.loc[S.LEAR, S.REL_MAE] < 1.2
    pdf = out.toPandas()
    own = pdf[pdf[S.MODEL] == S.LEAR]
    assert pooled.loc[S.LEAR, S.MAE] == pytest.approx((own[S.PREDICTED] - own[S.REALISED]).abs().mean())
    assert pooled.loc[S.LEAR, S.N_OBS] == len(own)


def test_smape_bounds_and_zero_baseline(spark):
    rows = [(date(2024, 1, 1), 0, datetime(2024, 1, 1), "p", "r", m, a, b, 0)
            for m, a, b in ((S.NAIVE_WEEK, 5.0, 5.0), ("other", 10.0, 0.0), ("both_zero", 0.0, 0.0))]
    got = {r[S.MODEL]: r for r in forecast.forecast_metrics(spark.createDataFrame(rows, S.FORECASTS)).where("hour_of_day = -1").collect()}
    assert got[S.NAIVE_WEEK][S.SMAPE] == 0 and got["both_zero"][S.SMAPE] == 0
    assert got["other"][S.SMAPE] == pytest.approx(200)
    assert got["other"][S.REL_MAE] is None


def test_boosted_beats_the_mean_and_repeats(matrix):
    model = DEFAULT.with_model(window_days=40, min_train_days=40, recalibrate_every_days=10).model
    first = boosted(matrix, model, rounds=10).toPandas().sort_values(S.INTERVAL)
    assert len(first) == 10 * 6 and set(first[S.MODEL]) == {S.BOOSTED}
    error = (first[S.PREDICTED] - first[S.REALISED]).abs().mean()
    assert error < (first[S.REALISED] - first[S.REALISED].mean()).abs().mean()
    again = boosted(matrix.repartition(5), model, rounds=10).toPandas().sort_values(S.INTERVAL)
    assert np.allclose(first[S.PREDICTED], again[S.PREDICTED])


def boosted_by_hand(rows, model, rounds, depth):
    """Plain loops over folds, rounds and nodes; bins as in the operator, a range being one fold."""
    names = S.feature_names(model)
    days = np.sort(rows[S.DAY].unique())
    idx = np.searchsorted(days, rows[S.DAY].to_numpy())
    x, y, out = rows[names].to_numpy(float), rows[S.PRICE].to_numpy(float), {}
    for fold, origin in enumerate(range(model.min_train_days, len(days), model.recalibrate_every_days)):
        train = np.flatnonzero((idx < origin) & (idx >= origin - model.window_days))
        test = np.flatnonzero((idx >= origin) & (idx < origin + model.recalibrate_every_days))
        cuts = [sorted({np.sort(x[train, j])[int(np.ceil(len(train) * k / BINS)) - 1] for k in range(1, BINS)}) for j in range(len(names))]
        now = np.full(len(y), y[train].mean())
        for _ in range(rounds):
            rest, leaves = y - now, [(train, test)]
            for _ in range(depth):
                grown = []
                for a, b in leaves:
                    best = (1e-9 * (1 + rest[a].sum() ** 2 / max(len(a), 1)), None, None)
                    for j in range(len(names)):
                        for cut in cuts[j]:
                            left = x[a, j] <= cut
                            n = left.sum()
                            if n < LEAST or len(a) - n < LEAST:
                                continue
                            gain = rest[a][left].sum() ** 2 / n + rest[a][~left].sum() ** 2 / (len(a) - n) - rest[a].sum() ** 2 / len(a)
                            if gain > best[0] * (1 + 1e-8):
                                best = (gain, j, cut)
                    if best[1] is None:
                        grown.append((a, b))
                    else:
                        grown += [(a[x[a, best[1]] <= best[2]], b[x[b, best[1]] <= best[2]]),
                                  (a[x[a, best[1]] > best[2]], b[x[b, best[1]] > best[2]])]
                leaves = grown
            for a, b in leaves:
                now[np.r_[a, b]] += RATE * rest[a].mean()
        out.update({(rows[S.INTERVAL].iloc[i], rows[S.POINT].iloc[i]): now[i] for i in test})
    return out


def test_boosted_equals_plain_loops_in_one_task_and_in_blocks(spark):
    model = DEFAULT.with_model(window_days=30, min_train_days=30, recalibrate_every_days=4).model
    rows = [tuple(float(v) if isinstance(v, np.floating) else v for v in r) for r in synthetic(days=44, points=("A", "B"), horizon=6)]
    frame = spark.createDataFrame(rows, S.matrix_schema(model))
    want = boosted_by_hand(frame.toPandas(), model, rounds=3, depth=3)
    for block_rows in (BLOCK_ROWS, 150):
        got = {(r[S.INTERVAL], r[S.POINT]): r[S.PREDICTED] for r in boosted(frame, model, 3, 3, block_rows).collect()}
        assert set(got) == set(want) and len(got) == 14 * 6 * 2
        assert max(abs(got[k] - want[k]) for k in want) < 1e-9


def test_boosted_needs_a_first_fold(matrix):
    assert boosted(matrix, DEFAULT.model).count() == 0
    assert first_splits(matrix, DEFAULT.model).count() == 0


def test_boosted_takes_one_task_stage_whatever_the_folds(spark, matrix):
    """Jobs before the result don't depend on the number of folds."""
    def jobs(step):
        group = f"boosted-{step}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            boosted(matrix, DEFAULT.with_model(window_days=30, min_train_days=30, recalibrate_every_days=step).model, 2, 2).count()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    many, few = jobs(1), jobs(10)  # 20 folds and 2; adaptive plans split their stages a little differently
    assert many < 40 and abs(many - few) <= 8


@pytest.mark.parametrize("seed", range(12))
def test_lasso_conditions_hold_at_every_knot(seed):
    """Few rows and strongly related columns, so that columns leave and come back with the other sign."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((26, 3)) @ rng.standard_normal((3, 20)) + 0.25 * rng.standard_normal((26, 20))
    x = (x - x.mean(axis=0)) / x.std(axis=0)
    y = rng.standard_normal(26)
    gram, corr = x.T @ x, x.T @ (y - y.mean())
    knots = lasso_knots(gram, corr)
    for beta in knots:
        left = corr - gram @ beta
        level = np.abs(left[beta != 0]).max() if beta.any() else np.abs(left).max()
        assert np.abs(left).max() <= level + 1e-7
        assert np.allclose(left[beta != 0], np.sign(beta[beta != 0]) * level, atol=1e-7)


def test_guards(spark, matrix):
    with pytest.raises(folds.RegimeError):
        forecast.walk_forward(matrix.withColumn(S.REGIME, F.when(F.col(S.HOUR) == 0, "a").otherwise("b")), MODEL)
    with pytest.raises(ValueError, match="too few"):
        forecast.walk_forward(matrix, DEFAULT.model)
    with pytest.raises(ValueError, match="lag of 7 days"):
        naive_week(matrix, DEFAULT.with_model(price_lag_days=(1, 2)).model)


LATE = DEFAULT.with_model(window_days=30, min_train_days=30, recalibrate_every_days=4).model


@pytest.fixture(scope="module")
def late_points(spark):
    """44 days: A has all of them, B all but the first three, C the last eight."""
    rows = [tuple(float(v) if isinstance(v, np.floating) else v for v in r)
            for r in synthetic(days=44, points=("A", "B", "C"), horizon=6)]
    since = {"A": date(2024, 1, 1), "B": date(2024, 1, 4), "C": date(2024, 2, 6)}
    return spark.createDataFrame([r for r in rows if r[0] >= since[r[2]]], S.matrix_schema(LATE)).cache()


def test_baselines_forecast_every_point_that_has_a_day(late_points):
    """A point that begins after the first training range is forecast in every fold it has rows in."""
    naive = naive_week(late_points, LATE).toPandas()
    assert naive.groupby(S.POINT).size().to_dict() == {"A": 14 * 6, "B": 14 * 6, "C": 8 * 6}
    lags = late_points.toPandas().set_index([S.POINT, S.INTERVAL])["price_lag_7d"]
    assert all(lags[r[S.POINT], r[S.INTERVAL]] == r[S.PREDICTED] for _, r in naive.iterrows())
    seasonal = seasonal_dow(late_points, LATE).toPandas()
    assert seasonal.groupby(S.POINT).size().to_dict() == {"A": 14 * 6, "B": 14 * 6, "C": 8 * 6}
    blank = seasonal[seasonal[S.PREDICTED].isna()]
    # C's first two days lie in a fold that starts before C has any price.
    assert set(zip(blank[S.POINT], blank[S.DAY])) == {("C", date(2024, 2, 6)), ("C", date(2024, 2, 7))}


def test_rows_without_a_prediction_have_no_error(late_points):
    out = forecast.walk_forward(late_points, LATE, [S.NAIVE_WEEK, S.SEASONAL_DOW])
    rows = out.where((F.col(S.MODEL) == S.SEASONAL_DOW) & (F.col(S.POINT) == "C")).toPandas()
    got = {r[S.MODEL]: r for r in forecast.error_grouping_sets(out).where(f"{S.POINT} = 'C' AND {S.HOUR} = -1").collect()}
    assert {k: v[S.N_OBS] for k, v in got.items()} == {S.NAIVE_WEEK: 48, S.SEASONAL_DOW: 48}
    assert got[S.SEASONAL_DOW][S.MAE] == pytest.approx((rows[S.PREDICTED] - rows[S.REALISED]).abs().mean())
    first = forecast.error_grouping_sets(out.where(f"{S.POINT} = 'C' AND {S.PREDICTED} IS NULL")).collect()
    assert first and all(r[S.MAE] is None and r[S.SMAPE] is None and r[S.N_OBS] > 0 for r in first)


def test_days_without_any_prediction_have_no_schedule(late_points):
    out = seasonal_dow(late_points, LATE)
    daily = backtest.daily_backtest(out, late_points, DEFAULT.battery, S.SEASONAL_DOW)
    days = {r[0]: r[1] for r in daily.groupBy(S.POINT).agg(F.countDistinct(S.DAY)).collect()}
    assert days == {"A": 14, "B": 14, "C": 6}
    assert backtest.dispatch_schedule(out, DEFAULT.battery, S.SEASONAL_DOW).count() == 34 * 6


def test_mature_leaves_every_model_the_same_rows(late_points):
    out = forecast.walk_forward(late_points, LATE, [S.NAIVE_WEEK, S.SEASONAL_DOW], mature=True)
    sizes = {(r[0], r[1]): r[2] for r in out.groupBy(S.MODEL, S.POINT).count().collect()}
    # B's first fold that starts a whole first history after its first day is the second.
    assert sizes == {(m, p): n for m in (S.NAIVE_WEEK, S.SEASONAL_DOW) for p, n in (("A", 14 * 6), ("B", 10 * 6))}
    assert boosted(late_points, LATE, rounds=1).count() == 24 * 6
