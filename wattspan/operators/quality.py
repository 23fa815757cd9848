"""Data-quality statistics: grid gaps, price and series summaries, the whole report."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schemas as S
from ..config import Config
from ..functions.time import epoch_seconds
from .clean import cap_of

HOURLY = timedelta(hours=1)
QUARTER_HOURLY = timedelta(minutes=15)


def _tally(diff: Column, step: float) -> dict[str, Column]:
    """Wide, narrow and off-grid steps as 0/1, nothing for an unknown step."""
    flags = {
        "gaps": diff > step,
        "too_close": diff < step,
        "off_grid": F.pmod(diff, F.lit(step)) != 0,
    }
    return {name: F.coalesce(flag.cast("long"), F.lit(0)) for name, flag in flags.items()}


def _segments(
    df: DataFrame, expected: timedelta, keys: list[str], split: list[str], extra: list[Column]
) -> DataFrame:
    """One row per key, day and `split` value with step tallies and the `extra` aggregates.

    Two levels, so no key is ever sorted by one task: steps inside a day are measured in windows
    of (key, day), then each day's row, a calendar-bounded number per key, adds the step from the
    row before it. Everything after the first shuffle is linear, the table is read once.
    """
    step = expected.total_seconds()
    group = [*keys, "_day", *split]
    stamped = df.where(F.col(S.INTERVAL).isNotNull()).withColumns(
        {"_at": epoch_seconds(F.col(S.INTERVAL)), "_day": F.to_date(S.INTERVAL)}
    )
    previous = F.lag("_at").over(W.partitionBy(*group).orderBy("_at"))
    inner = stamped.withColumn("_diff", F.col("_at") - previous)
    daily = inner.groupBy(*group).agg(
        F.min("_at").alias("_first"), F.max("_at").alias("_last"), F.count("*").alias("rows"),
        *[F.sum(flag).alias(name) for name, flag in _tally(F.col("_diff"), step).items()],
        *extra,
    )
    before = F.lag("_last").over(W.partitionBy(*keys).orderBy("_first"))
    edged = daily.withColumn("_edge", F.col("_first") - before)
    edge = _tally(F.col("_edge"), step)
    return edged.withColumns({name: F.col(name) + flag for name, flag in edge.items()})


_SUMS = ("rows", "gaps", "too_close", "off_grid")


def _sums() -> list[Column]:
    return [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in _SUMS]


def spacing_stats(df: DataFrame, expected: timedelta, keys: list[str]) -> DataFrame:
    """Per key: rows, steps wider than the grid, steps narrower, and steps off the grid."""
    return _segments(df, expected, keys, [], []).groupBy(*keys).agg(*_sums())


def _checked_gaps() -> Column:
    """The gap count; a step below or off the grid fails the job."""
    return (
        F.when(F.col("too_close") > 0, F.raise_error(F.lit("interval closer than the grid")).cast("long"))
        .when(F.col("off_grid") > 0, F.raise_error(F.lit("interval off the grid")).cast("long"))
        .otherwise(F.col("gaps"))
    )


def spacing_gaps(df: DataFrame, expected: timedelta, keys: list[str]) -> DataFrame:
    """Gap count per key; a step below or off the grid fails the job."""
    return spacing_stats(df, expected, keys).select(*keys, _checked_gaps().alias("gaps"))


def _price_aggregates(config: Config, cap: str) -> list[Column]:
    limit = cap_of(F.col(S.REGIME), config.market.regimes, cap)
    return [
        F.min(S.PRICE).alias("min_price"),
        F.max(S.PRICE).alias("max_price"),
        F.count_if(F.col(S.PRICE) > limit).alias("above_cap"),
        F.count_if(F.col(S.PRICE) < 0).alias("negative"),
    ]


def price_by_regime(prices: DataFrame, config: Config, cap: str) -> DataFrame:
    """Rows, price range, rows above the offer cap and negative prices of each regime."""
    return prices.groupBy(S.REGIME).agg(F.count("*").alias("rows"), *_price_aggregates(config, cap))


def price_stats(prices: DataFrame, expected: timedelta, config: Config, cap: str) -> DataFrame:
    """One row: rows, gaps over all points, share of negative prices, and a map of regime stats.

    The share counts rows without a price in its denominator. Steps and prices are measured in the
    same pass; the totals are rolled up from one row per regime.
    """
    regimes = (
        _segments(prices, expected, [S.POINT], [S.REGIME], _price_aggregates(config, cap))
        .groupBy(S.REGIME)
        .agg(
            *_sums(), F.min("min_price").alias("min_price"), F.max("max_price").alias("max_price"),
            F.sum("above_cap").alias("above_cap"), F.sum("negative").alias("negative"),
        )
    )
    stats = F.struct("rows", "min_price", "max_price", "above_cap")
    entry = F.when(F.col(S.REGIME).isNotNull(), F.struct(F.col(S.REGIME), stats))
    totals = regimes.agg(
        *_sums(),
        F.coalesce(F.try_divide(F.sum("negative"), F.sum("rows")), F.lit(0.0)).alias("negative_share"),
        F.map_from_entries(F.collect_list(entry)).alias("by_regime"),  # one entry per regime
    )
    return totals.select("rows", _checked_gaps().alias("gaps"), "negative_share", "by_regime")


def series_stats(series: DataFrame, column: str) -> DataFrame:
    """One row for an hourly series: rows, gaps, min, max."""
    extra = [F.min(column).alias("min"), F.max(column).alias("max")]
    totals = _segments(series, HOURLY, [], [], extra).agg(
        *_sums(), F.min("min").alias("min"), F.max("max").alias("max")
    )
    return totals.select("rows", _checked_gaps().alias("gaps"), "min", "max")


def quality_report(tables: dict[str, DataFrame], config: Config) -> DataFrame:
    """One row per table; price tables fill the price columns, series the range columns."""
    parts = [
        price_stats(tables["da_prices"], HOURLY, config, "cap_da").withColumn("table", F.lit("da_prices")),
        price_stats(tables["rt_prices"], QUARTER_HOURLY, config, "cap_rt").withColumn("table", F.lit("rt_prices")),
        series_stats(tables["load"], S.DEMAND).withColumn("table", F.lit("load")),
        series_stats(tables["weather"], S.TEMP).withColumn("table", F.lit("weather")),
    ]
    report = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return report.select("table", "rows", "gaps", "negative_share", "by_regime", "min", "max")


def flatten_report(report: DataFrame) -> DataFrame:
    """The report as plain rows, one per table and regime."""
    return report.select(
        "table", F.col("rows").alias("table_rows"), "gaps", "negative_share",
        "min", "max", F.explode_outer("by_regime").alias("regime", "stats"),
    ).select(
        "table", "table_rows", "gaps", "negative_share", "min", "max", "regime",
        F.col("stats.rows").alias("regime_rows"), "stats.min_price", "stats.max_price", "stats.above_cap",
    )
