"""The day-ahead model matrix, keyed by settlement point, and the guard against leaked columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schemas as S
from ..config import Config, Model
from ..functions.calendar import holiday_flag
from ..functions.time import day_number, local_time


class LeakageError(ValueError):
    """The matrix carries a column that is not known before day-ahead close."""


def hub_frame(da_prices: DataFrame, config: Config) -> DataFrame:
    """Prices of the configured points with the local delivery day and hour."""
    local = local_time(F.col(S.INTERVAL), config.market.timezone)
    return da_prices.where(F.col(S.POINT).isin(*config.market.settlement_points)).select(
        S.INTERVAL,
        local.cast("date").alias(S.DAY),
        F.hour(local).alias(S.HOUR),
        S.POINT,
        S.REGIME,
        F.col(S.PRICE).cast("double").alias(S.PRICE),
    )


def check_points(da_prices: DataFrame, config: Config) -> None:
    """Raise when no configured settlement point has a price; reads one row."""
    points = config.market.settlement_points
    if da_prices.where(F.col(S.POINT).isin(*points)).isEmpty():
        raise ValueError(f"no day-ahead prices for settlement points {list(points)}")


def gap_filled(hub: DataFrame, model: Model) -> DataFrame:
    """Hub rows plus a filler row for every missing slot of a day, with `source_price` for lags.

    `source_price` is the first reading of the slot; a missing one is interpolated linearly between
    its neighbours of the same day, and stays NULL at the edges of the day. A repeated autumn hour
    keeps its row but gives no second source. Filler rows have no interval. Every window is over
    (point, day): at most 25 rows, one shuffle.
    """
    step, last_slot = model.slot_hours, 24 - model.slot_hours
    day = [S.POINT, S.DAY]
    by_slot = W.partitionBy(*day).orderBy(S.HOUR, S.INTERVAL)
    previous = F.lag(S.HOUR).over(by_slot)
    following = F.coalesce(F.lead(S.HOUR).over(by_slot), F.lit(last_slot + step))
    # Each row also opens the empty slots up to the next reading; the first one those before it.
    ranged = hub.select(
        "*",
        F.coalesce(previous == F.col(S.HOUR), F.lit(False)).alias("_repeat"),
        F.when(previous.isNull(), F.lit(0)).otherwise(F.col(S.HOUR)).alias("_from"),
        F.greatest(following - step, F.col(S.HOUR)).alias("_to"),
    )
    spread = ranged.withColumn("_slot", F.explode(F.sequence("_from", "_to", F.lit(step))))
    own = F.col("_slot") == F.col(S.HOUR)
    dense = spread.select(
        F.when(own, F.col(S.INTERVAL)).alias(S.INTERVAL),
        *day,
        F.col("_slot").alias(S.HOUR),
        S.REGIME,
        F.when(own, F.col(S.PRICE)).alias(S.PRICE),
        F.when(own & ~F.col("_repeat"), F.col(S.PRICE)).alias("_known"),
        (own & F.col("_repeat")).alias("_repeat"),
    )

    # The nearest known value and its slot on either side.
    seen_slot = F.when(F.col("_known").isNotNull(), F.col(S.HOUR))
    before = W.partitionBy(*day).orderBy(S.HOUR, S.INTERVAL).rowsBetween(W.unboundedPreceding, 0)
    after = W.partitionBy(*day).orderBy(S.HOUR, S.INTERVAL).rowsBetween(0, W.unboundedFollowing)
    sided = dense.withColumns({
        "_v0": F.last("_known", ignorenulls=True).over(before),
        "_h0": F.last(seen_slot, ignorenulls=True).over(before),
        "_v1": F.first("_known", ignorenulls=True).over(after),
        "_h1": F.first(seen_slot, ignorenulls=True).over(after),
    })
    share = F.try_divide(F.col(S.HOUR) - F.col("_h0"), F.col("_h1") - F.col("_h0"))
    filled = F.coalesce("_known", F.col("_v0") + (F.col("_v1") - F.col("_v0")) * share)
    return sided.select(
        S.INTERVAL, *day, S.HOUR, S.REGIME, S.PRICE,
        F.when(~F.col("_repeat"), filled).alias("source_price"),
        (~F.col("_repeat")).alias("is_source"),
        F.col(S.INTERVAL).isNotNull().alias("is_delivery"),
    )


def complete_day_slots(hub: DataFrame, model: Model) -> DataFrame:
    """The lag source alone: one row per point, day and slot with the interpolated price."""
    return gap_filled(hub, model).where("is_source").select(
        S.POINT, S.DAY, S.HOUR, F.col("source_price").alias(S.PRICE)
    )


def with_price_lags(hub: DataFrame, model: Model) -> DataFrame:
    """Price of the same local hour k days earlier, by calendar distance rather than row distance.

    All lags come from one window over (point, hour) with single-day RANGE frames: one shuffle for
    any number of lags, against one join each. A group holds one row per calendar day.
    """
    rows = gap_filled(hub, model).withColumn("_dayno", day_number(F.col(S.DAY)))
    series = W.partitionBy(S.POINT, S.HOUR).orderBy("_dayno")
    lagged = rows.select(
        "*",
        *[
            F.max("source_price").over(series.rangeBetween(-k, -k)).alias(S.lag_name(k))
            for k in model.price_lag_days
        ],
    )
    return lagged.where("is_delivery").drop("_dayno", "source_price", "is_source", "is_delivery")


def with_calendar(df: DataFrame) -> DataFrame:
    """Local weekday (Monday 0), month and federal-holiday flag of the delivery day."""
    day = F.col(S.DAY)
    return df.withColumns({S.DOW: F.weekday(day), S.MONTH: F.month(day), S.HOLIDAY: holiday_flag(S.DAY)})


def with_exogenous(df: DataFrame, load: DataFrame, weather: DataFrame) -> DataFrame:
    """Left joins on the delivery interval.

    Both sides hold one row per hour. No hint: Spark broadcasts them while they are below its
    size threshold and merges on the interval, which no single point can skew, beyond it.
    """
    return df.join(load.select(S.INTERVAL, S.DEMAND), S.INTERVAL, "left").join(
        weather.select(S.INTERVAL, S.TEMP), S.INTERVAL, "left"
    )


def complete_days(df: DataFrame, model: Model) -> DataFrame:
    """Keep delivery days that have exactly the horizon's number of rows."""
    count = F.count("*").over(W.partitionBy(S.POINT, S.DAY))
    return df.withColumn("_n", count).where(F.col("_n") == model.horizon_hours).drop("_n")


def model_matrix(
    da_prices: DataFrame, load: DataFrame, weather: DataFrame, config: Config
) -> DataFrame:
    """Lags from the gap-filled copy, targets from the readings; full days without NULLs only."""
    model = config.model
    rows = with_calendar(with_price_lags(hub_frame(da_prices, config), model))
    rows = with_exogenous(rows, load, weather)
    rows = rows.na.drop(subset=[*S.feature_names(model), S.PRICE])
    return S.enforce(complete_days(rows, model), S.matrix_schema(model))


def leakage_findings(columns: list[str], model: Model) -> dict[str, list[str]]:
    """Column names that break the allow-list, by kind; empty lists when the matrix is clean."""
    allowed = set(S.feature_names(model))
    present = set(columns) - {S.DAY, S.INTERVAL, S.POINT, S.REGIME, S.PRICE}
    return {
        "forbidden": sorted(present & S.FORBIDDEN_FEATURES),
        "unexpected": sorted(present - allowed - S.FORBIDDEN_FEATURES),
        "missing": sorted(allowed - present),
    }


def check_no_leakage(matrix: DataFrame, model: Model) -> DataFrame:
    """Pass the matrix through, or raise before any job starts."""
    broken = {kind: names for kind, names in leakage_findings(matrix.columns, model).items() if names}
    if broken:
        raise LeakageError(f"matrix columns break the allow-list: {broken}")
    return matrix
