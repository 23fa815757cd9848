"""The two baseline forecasts: last week's price, and the weekday-and-hour mean of the window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schemas as S
from ..config import Model
from .folds import DAY_IDX, ORIGIN, TRAIN_FROM, with_folds


def as_forecast(rows: DataFrame, name: str, predicted: Column) -> DataFrame:
    """Test rows in the forecast contract."""
    shaped = rows.withColumns(
        {S.MODEL: F.lit(name), S.PREDICTED: predicted, S.REALISED: F.col(S.PRICE)}
    )
    return S.enforce(shaped, S.FORECASTS)


def naive_week(matrix: DataFrame, model: Model) -> DataFrame:
    """The price of the matching slot seven days earlier, read from its lag column."""
    if 7 not in model.price_lag_days:
        raise ValueError("configure a price lag of 7 days to use this model")
    tested = with_folds(matrix, model).where(F.col(S.FOLD).isNotNull())
    return as_forecast(tested, S.NAIVE_WEEK, F.col(S.lag_name(7)))


def _trailing_mean(rows: DataFrame, cell: list[str]) -> DataFrame:
    """Add `window_mean`: mean over the rows of the same cell inside the fold's training range.

    Running totals answer every fold from one pass: each test row also drops a marker at the start
    and at the end of its training range, and the mean is the difference of the totals read at
    both. A row is therefore read once, not once per fold that trains on it, and both windows
    share one shuffle on the cell. `rows` carries `_sum` and `_n` per row.
    """
    data, until, since = 0, 1, 2
    # Data sits on odd positions, markers on even ones: a marker sees only earlier days.
    entry = F.struct(
        F.lit(data).alias("kind"), (F.col(DAY_IDX) * 2 + 1).alias("at"),
        F.col("_sum").alias("v"), F.col("_n").alias("n"),
    )

    def marker(kind: int, idx: str) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), (F.col(idx) * 2).alias("at"),
            F.lit(None).cast("double").alias("v"), F.lit(0).cast("long").alias("n"),
        )

    tested = F.col(S.FOLD).isNotNull()
    entries = F.when(tested, F.array(entry, marker(until, ORIGIN), marker(since, TRAIN_FROM)))
    laid = rows.withColumn("_e", F.explode(entries.otherwise(F.array(entry)))).select(
        "*", "_e.kind", "_e.at", "_e.v", "_e.n"
    )
    running = W.partitionBy(*cell).orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    totals = laid.withColumn("_v", F.coalesce(F.sum("v").over(running), F.lit(0.0))).withColumn(
        "_c", F.coalesce(F.sum("n").over(running), F.lit(0))
    )
    fold = W.partitionBy(*cell, S.FOLD)

    def at(kind: int, column: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col(column))).over(fold)

    ranged = totals.withColumn("_ds", at(until, "_v") - at(since, "_v")).withColumn(
        "_dn", at(until, "_c") - at(since, "_c")
    )
    mean = F.when(F.col("_dn") > 0, F.col("_ds") / F.col("_dn"))
    return (
        ranged.where((F.col("kind") == data) & tested)
        .withColumn("window_mean", mean)
        .drop("_e", "kind", "at", "v", "n", "_v", "_c", "_ds", "_dn", "_sum", "_n")
    )


def seasonal_dow(matrix: DataFrame, model: Model) -> DataFrame:
    """Mean price of the same weekday and hour in the training window, else the window's mean.

    NULL where the point has no price of its own in the window.
    """
    rows = with_folds(matrix, model)
    per_row = rows.withColumn("_sum", F.col(S.PRICE)).withColumn(
        "_n", F.col(S.PRICE).isNotNull().cast("long")
    )
    profile = _trailing_mean(per_row, [S.POINT, S.DOW, S.HOUR])

    ranges = [DAY_IDX, S.FOLD, ORIGIN, TRAIN_FROM]
    per_day = rows.groupBy(S.POINT, *ranges).agg(
        F.sum(S.PRICE).alias("_sum"), F.count(S.PRICE).alias("_n")
    )
    default = (
        _trailing_mean(per_day, [S.POINT])
        .groupBy(S.POINT, S.FOLD)
        .agg(F.max("window_mean").alias("default_mean"))
    )
    tested = profile.join(default, [S.POINT, S.FOLD], "left")
    return as_forecast(tested, S.SEASONAL_DOW, F.coalesce("window_mean", "default_mean"))
