"""All forecast models over the walk-forward folds, and their error metrics."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schemas as S
from ..config import Model
from ..functions.numeric import ratio_or_null
from .baselines import naive_week, seasonal_dow
from .boosted import boosted
from .features import check_no_leakage
from .folds import check_history, check_single_regime, of_mature_points
from .lear import lear

Forecaster = Callable[[DataFrame, Model], DataFrame]

MODELS: dict[str, Forecaster] = {
    S.NAIVE_WEEK: naive_week,
    S.SEASONAL_DOW: seasonal_dow,
    S.LEAR: lear,
    S.BOOSTED: boosted,
}

# Fixed value: keeps sMAPE finite where prediction and price are both zero.
SMAPE_FLOOR = 1e-9


def walk_forward(
    matrix: DataFrame, model: Model, names: Sequence[str] | None = None, checked: bool = True, mature: bool = False
) -> DataFrame:
    """Forecast rows of the chosen models (default all) over every fold.

    The baselines forecast every point, the fitted models those that are mature for the fold; `mature`
    leaves the baselines the same rows, for comparisons with fitted models.
    """
    check_no_leakage(matrix, model)
    if checked:
        check_single_regime(matrix)
        check_history(matrix, model)
    parts = [MODELS[name](matrix, model) for name in names or MODELS]
    out = reduce(DataFrame.unionByName, parts)
    return of_mature_points(out, matrix, model) if mature else out


def _absolute_error():
    return F.abs(F.col(S.PREDICTED) - F.col(S.REALISED))


def _smape_term():
    size = F.abs(F.col(S.PREDICTED)) + F.abs(F.col(S.REALISED))
    return 200.0 * _absolute_error() / F.greatest(size, F.lit(SMAPE_FLOOR))


CELL = [S.MODEL, S.POINT, S.REGIME]


def error_by(forecasts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row count, MAE and sMAPE of each cell."""
    return forecasts.groupBy(*keys).agg(
        F.count("*").alias(S.N_OBS),
        F.avg(_absolute_error()).alias(S.MAE),
        F.avg(_smape_term()).alias(S.SMAPE),
    )


def error_grouping_sets(forecasts: DataFrame) -> DataFrame:
    """Errors per hour and, with hour -1, pooled over all rows of the cell.

    The forecast rows are reduced once to sums per hour; the grouping sets run on those few rows. Rows
    without a prediction count as observations, but have no error.
    """
    hourly = forecasts.groupBy(*CELL, S.HOUR).agg(
        F.count("*").alias("n"), F.count(_absolute_error()).alias("known"),
        F.sum(_absolute_error()).alias("ae"), F.sum(_smape_term()).alias("sm"),
    )
    cells = [F.col(c) for c in CELL]
    both = hourly.groupingSets([[*cells, F.col(S.HOUR)], cells], *cells, F.col(S.HOUR)).agg(
        F.grouping(S.HOUR).alias("_pooled"),
        F.sum("n").alias(S.N_OBS),
        F.try_divide(F.sum("ae"), F.sum("known")).alias(S.MAE),
        F.try_divide(F.sum("sm"), F.sum("known")).alias(S.SMAPE),
    )
    hour = F.when(F.col("_pooled") == 1, F.lit(S.POOLED_HOUR)).otherwise(F.col(S.HOUR))
    return both.select(*CELL, hour.cast("long").alias(S.HOUR), S.N_OBS, S.MAE, S.SMAPE)


def forecast_metrics(forecasts: DataFrame) -> DataFrame:
    """The metrics table: errors per hour and pooled, each relative to the naive week's.

    The window spans the models of one cell, a handful of rows.
    """
    cell = W.partitionBy(S.POINT, S.REGIME, S.HOUR)
    naive = F.max(F.when(F.col(S.MODEL) == S.NAIVE_WEEK, F.col(S.MAE))).over(cell)
    scored = error_grouping_sets(forecasts).withColumn(S.REL_MAE, ratio_or_null(F.col(S.MAE), naive))
    return S.enforce(scored, S.METRICS)
