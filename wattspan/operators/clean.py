"""Raw feeds to clean tables: parse, hub filter, dedup, regime tag, forecast-vintage pick."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..config import Config, Market, Regime
from ..functions.numeric import fahrenheit_to_celsius, lenient_double, row_mean
from ..functions.time import delivery_midnight_utc, instant_to_utc, local_time, parse_to_utc

PUBLISH = "publish_time_utc"

# Weather columns that are not a zone reading.
WEATHER_META = ("interval_start_utc", "interval_end_utc", PUBLISH, "retrieved_at_utc", "arrival", "date")


def to_utc(df: DataFrame, column: str) -> Column:
    """UTC wall clock of a column; NTZ input is UTC already and is passed through."""
    kind = dict(df.dtypes)[column]
    if kind == "timestamp_ntz":
        return F.col(column)
    return instant_to_utc(F.col(column)) if kind == "timestamp" else parse_to_utc(F.col(column))


def dedup(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    keep: str = "first",
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the first or last in the given order, with the `carry` columns of that row.

    Written as an extreme-by aggregate, not a ranking window: each task reduces its own copies
    before the shuffle, so a key with a third of all rows costs one row per task, not one big sort.
    With an `arrival` number, which is unique per landed row, all picks come from the same row. Any
    other order may tie: then one struct of order and values is picked, so that the result is one
    row and does not depend on partitioning.
    """
    columns = [c for c in df.columns if c not in keys] if carry is None else list(carry)
    if list(order) == ["arrival"]:
        pick = F.min_by if keep == "first" else F.max_by
        return df.groupBy(*keys).agg(*[pick(c, F.col("arrival")).alias(c) for c in columns])
    extreme = F.min if keep == "first" else F.max
    row = extreme(F.struct(*order, *[c for c in columns if c not in order])).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in columns])


def regime_of(local_day: Column, regimes: Sequence[Regime]) -> Column:
    """Regime name of a local date; the last configured match wins, an uncovered date is an error."""
    chain = None
    for regime in reversed(regimes):
        inside = F.lit(True)
        if regime.start is not None:
            inside = inside & (local_day >= F.lit(regime.start))
        if regime.end is not None:
            inside = inside & (local_day <= F.lit(regime.end))
        chain = F.when(inside, regime.name) if chain is None else chain.when(inside, regime.name)
    uncovered = F.raise_error(F.concat(F.lit("no regime covers "), local_day.cast("string")))
    return uncovered.cast("string") if chain is None else chain.otherwise(uncovered.cast("string"))


def tag_regime(df: DataFrame, market: Market) -> DataFrame:
    local_day = local_time(F.col(S.INTERVAL), market.timezone).cast("date")
    return df.withColumn(S.REGIME, regime_of(local_day, market.regimes))


def cap_of(regime: Column, regimes: Sequence[Regime], attribute: str) -> Column:
    """Offer cap of a regime name."""
    caps = {r.name: getattr(r, attribute) for r in regimes}
    pairs = [F.lit(x) for item in caps.items() for x in item]
    return F.element_at(F.create_map(*pairs), regime)


def _arrival_order(raw: DataFrame) -> list[str]:
    """The landing order of raw rows: a sequence number if the feed has one, else the stamp."""
    known = [c for c in ("retrieved_at_utc", "arrival") if c in raw.columns]
    if "arrival" in known:
        return ["arrival"]
    if not known:
        raise ValueError("raw rows need an arrival or retrieved_at_utc column to order copies by")
    return known


def clean_prices(raw: DataFrame, config: Config) -> DataFrame:
    """Price table of either market: configured hubs only, first reading of each interval."""
    order = _arrival_order(raw)
    rows = raw.where(F.col("location").isin(*config.market.settlement_points)).select(
        to_utc(raw, S.INTERVAL).alias(S.INTERVAL),
        F.col("location").cast("string").alias(S.POINT),
        lenient_double(F.col("spp")).alias(S.PRICE),
        *order,
    )
    kept = dedup(rows, [S.INTERVAL, S.POINT], order, carry=[S.PRICE])
    return S.enforce(tag_regime(kept, config.market), S.PRICES)


def clean_load(raw: DataFrame) -> DataFrame:
    """System demand forecast, first reading of each interval."""
    order = _arrival_order(raw)
    rows = raw.select(
        to_utc(raw, S.INTERVAL).alias(S.INTERVAL),
        lenient_double(F.col("system_total")).alias(S.DEMAND),
        *order,
    )
    return S.enforce(dedup(rows, [S.INTERVAL], order, carry=[S.DEMAND]), S.LOAD)


def zone_columns(raw: DataFrame) -> list[str]:
    return [c for c in raw.columns if c not in WEATHER_META]


def zone_mean_celsius(raw: DataFrame) -> Column:
    """Equal-weight mean of the zone readings (°F) in °C."""
    return fahrenheit_to_celsius(row_mean([lenient_double(F.col(c)) for c in zone_columns(raw)]))


def day_ahead_vintages(raw: DataFrame, config: Config) -> DataFrame:
    """Forecasts published by the local midnight of their delivery day, or with unknown publish."""
    publish = to_utc(raw, PUBLISH) if PUBLISH in raw.columns else F.lit(None).cast("timestamp_ntz")
    interval = to_utc(raw, S.INTERVAL)
    rows = raw.select(
        interval.alias(S.INTERVAL), publish.alias("publish"),
        zone_mean_celsius(raw).alias(S.TEMP), *_arrival_order(raw),
    )
    cutoff = delivery_midnight_utc(F.col(S.INTERVAL), config.market.timezone)
    return rows.where(F.col("publish").isNull() | (F.col("publish") <= cutoff))


#: Later than any publish time: where an unknown one ranks.
UNDATED = "9999-12-31 23:59:59.999999"


def latest_vintage(vintages: DataFrame) -> DataFrame:
    """Newest vintage of each interval; an unknown publish time ranks newest, then last arrival.

    Landed rows have a unique arrival number. Then the pick takes two steps with one primitive key each,
    the last arrival of every publish time and the newest publish time of those, so that both reduce in
    hash tables before they shuffle.
    """
    if "arrival" not in vintages.columns:
        ranked = vintages.withColumn("undated", F.col("publish").isNull())
        order = ["undated", "publish", *[c for c in vintages.columns if c == "retrieved_at_utc"]]
        return dedup(ranked, [S.INTERVAL], order, keep="last", carry=["publish", S.TEMP])
    rank = F.coalesce("publish", F.lit(UNDATED).cast("timestamp_ntz"))
    carried = ["publish", S.TEMP]
    last = vintages.groupBy(S.INTERVAL, rank.alias("_rank")).agg(*[F.max_by(c, "arrival").alias(c) for c in carried])
    return last.groupBy(S.INTERVAL).agg(*[F.max_by(c, "_rank").alias(c) for c in carried])


def clean_weather(raw: DataFrame, config: Config) -> DataFrame:
    return S.enforce(latest_vintage(day_ahead_vintages(raw, config)), S.WEATHER)
