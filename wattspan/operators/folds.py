"""Walk-forward folds as arithmetic on a day index: no row is paired with every fold it trains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schemas as S
from ..config import Model

DAY_IDX = "day_idx"
ORIGIN = "origin_idx"
TRAIN_FROM = "train_from_idx"


class RegimeError(ValueError):
    """The rows span more or fewer than one offer-cap regime."""


def first_origin(model: Model) -> int:
    """Index of the first forecast day; an origin without any history is no fold."""
    return model.min_train_days or model.recalibrate_every_days


def delivery_days(matrix: DataFrame) -> DataFrame:
    """The distinct delivery days with their index and total.

    One row per calendar day whatever the size of the matrix, so ordering them in one task and
    broadcasting them is bounded by the calendar, not by the data.
    """
    order = W.orderBy(S.DAY)
    return matrix.select(S.DAY).distinct().select(
        S.DAY, (F.row_number().over(order) - 1).alias(DAY_IDX)
    )


def with_day_index(matrix: DataFrame) -> DataFrame:
    return matrix.join(F.broadcast(delivery_days(matrix)), S.DAY)


def fold_of(model: Model) -> Column:
    """Fold whose test block holds the day, NULL while history is still too short."""
    start, step = first_origin(model), model.recalibrate_every_days
    idx = F.col(DAY_IDX)
    return F.when(idx >= start, F.floor((idx - start) / step).cast("int"))


def with_folds(matrix: DataFrame, model: Model) -> DataFrame:
    """Matrix rows with day index, the fold they test and that fold's training range."""
    start, step = first_origin(model), model.recalibrate_every_days
    origin = F.lit(start) + F.col(S.FOLD) * step
    return (
        with_day_index(matrix)
        .withColumn(S.FOLD, fold_of(model))
        .withColumn(ORIGIN, origin.cast("int"))
        .withColumn(TRAIN_FROM, F.greatest(F.lit(0), F.col(ORIGIN) - model.window_days))
    )


def with_mature_folds(matrix: DataFrame, model: Model) -> DataFrame:
    """The same for models that are fitted: a row whose point is not mature for the fold only trains later ones."""
    laid = with_folds(matrix, model)
    ready = mature_folds(laid, model).withColumn("_ready", F.lit(True))
    return laid.join(ready, [S.POINT, S.FOLD], "left").withColumns({
        name: F.when(F.col("_ready"), F.col(name)) for name in (S.FOLD, ORIGIN, TRAIN_FROM)
    }).drop("_ready")


def mature_folds(rows: DataFrame, model: Model) -> DataFrame:
    """(point, fold) where the point's own history reaches back far enough.

    A point counts from its first day: it is mature once the fold's origin lies a first history after
    that day, and it has a day of its own in the training window. Fold numbers stay those of the common
    calendar, so that rows of all points may train one model without looking ahead. The windows hold
    one row per point and day.
    """
    own = rows.select(S.POINT, DAY_IDX, S.FOLD, ORIGIN, TRAIN_FROM).distinct()
    days = W.partitionBy(S.POINT).orderBy(DAY_IDX)
    seen = own.withColumn("_first", F.first(DAY_IDX).over(days)).withColumn("_before", F.lag(DAY_IDX).over(days))
    reached = (F.col(ORIGIN) - F.col("_first") >= first_origin(model)) & (F.col("_before") >= F.col(TRAIN_FROM))
    # The fold's first own day: its predecessor is the last day before the origin.
    return (seen.where(F.col(S.FOLD).isNotNull()).groupBy(S.POINT, S.FOLD)
            .agg(F.max(reached & (F.coalesce("_before", F.lit(-1)) < F.col(ORIGIN))).alias("_reached"))
            .where("_reached").select(S.POINT, S.FOLD))


def of_mature_points(forecasts: DataFrame, matrix: DataFrame, model: Model) -> DataFrame:
    """Forecast rows whose point is mature for their fold: the rows that fitted models are tested on, too."""
    return forecasts.join(mature_folds(with_folds(matrix, model), model), [S.POINT, S.FOLD], "left_semi").select(*forecasts.columns)


def walk_forward_folds(matrix: DataFrame, model: Model) -> DataFrame:
    """One row per fold with its training and test day ranges."""
    start, step = first_origin(model), model.recalibrate_every_days
    ordered = W.orderBy(DAY_IDX)
    past = ordered.rowsBetween(-model.window_days, -1)
    ahead = ordered.rowsBetween(0, step - 1)
    day = F.col(S.DAY)
    spans = delivery_days(matrix).select(
        DAY_IDX,
        F.min(day).over(past).alias("train_first_day"),
        F.max(day).over(past).alias("train_last_day"),
        F.count("*").over(past).alias("n_train_days"),
        F.min(day).over(ahead).alias("test_first_day"),
        F.max(day).over(ahead).alias("test_last_day"),
        F.count("*").over(ahead).alias("n_test_days"),
    )
    origins = (F.col(DAY_IDX) >= start) & ((F.col(DAY_IDX) - start) % step == 0)
    return spans.where(origins).select(
        fold_of(model).alias(S.FOLD), *[c for c in spans.columns if c != DAY_IDX]
    )


def fold_causality(matrix: DataFrame, model: Model) -> DataFrame:
    """Per fold: last training instant, first test instant, and whether they are in order."""
    start, step = first_origin(model), model.recalibrate_every_days
    daily = with_day_index(matrix).groupBy(DAY_IDX).agg(
        F.min(S.INTERVAL).alias("_first"), F.max(S.INTERVAL).alias("_last")
    )
    ordered = W.orderBy(DAY_IDX)  # one row per calendar day
    spans = daily.select(
        DAY_IDX,
        F.max("_last").over(ordered.rowsBetween(-model.window_days, -1)).alias("last_train"),
        F.min("_first").over(ordered.rowsBetween(0, step - 1)).alias("first_test"),
    )
    origins = (F.col(DAY_IDX) >= start) & ((F.col(DAY_IDX) - start) % step == 0)
    return spans.where(origins).select(
        fold_of(model).alias(S.FOLD),
        "last_train",
        "first_test",
        (F.col("last_train") < F.col("first_test")).alias("causal"),
    )


def regime_counts(rows: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Distinct non-NULL regimes (per key) and whether there is exactly one."""
    counted = rows.groupBy(*(keys or [])).agg(F.countDistinct(S.REGIME).alias("n_regimes"))
    return counted.withColumn("single", F.col("n_regimes") == 1)


def check_single_regime(rows: DataFrame) -> None:
    """Raise unless the rows carry exactly one regime; reads at most two values."""
    found = [r[0] for r in rows.select(S.REGIME).where(F.col(S.REGIME).isNotNull()).distinct().take(2)]
    if len(found) != 1:
        raise RegimeError(f"need a single regime, found {sorted(found) or 'none'}")


def check_history(matrix: DataFrame, model: Model) -> None:
    """Raise unless at least one fold has both history and a day to forecast."""
    days = matrix.select(S.DAY).distinct().count()
    if days <= first_origin(model):
        raise ValueError(f"{days} delivery days are too few for a first fold at {first_origin(model)}")
