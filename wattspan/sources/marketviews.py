"""Market-shaped views over the star-schema tables (see FIXTURES.md part B).

`events` becomes January-2024 hourly and quarter-hourly feeds, `lineitem` and `orders` a daily
history of several years with four delivery blocks a day.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..config import DEFAULT, Battery, Config, Regime
from ..functions.time import floor_minutes
from ..operators.clean import tag_regime
from .landing import ARRIVAL, RETRIEVED_AT

EVENT_POINTS = ("click", "error", "purchase", "signup", "view")

# Three periods with open ends; the January bounds serve the event feeds.
EVENT_REGIMES = (
    Regime("early", None, date(2024, 1, 10), 200.0, 150.0),
    Regime("middle", date(2024, 1, 11), date(2024, 1, 20), 150.0, 100.0),
    Regime("late", date(2024, 1, 21), None, 100.0, 75.0),
)
SINGLE_REGIME = (Regime("whole", None, None, 5000.0, 5000.0),)

EVENT_CONFIG: Config = DEFAULT.with_market(settlement_points=EVENT_POINTS, regimes=EVENT_REGIMES)

# Four six-hour blocks a day, already in local time, one regime, retrained every four weeks.
HISTORY_CONFIG: Config = DEFAULT.with_market(
    timezone="UTC", settlement_points=("ALL", "A", "N", "R"), regimes=SINGLE_REGIME
).with_model(horizon_hours=4, window_days=365, recalibrate_every_days=28, min_train_days=365)

# Whole stage runs over the event month: one pooled hub, short history, retrained every two days.
RUN_CONFIG: Config = DEFAULT.with_market(settlement_points=("ALL",), regimes=SINGLE_REGIME).with_model(
    window_days=10, recalibrate_every_days=2, min_train_days=10
)

BATTERY: Battery = DEFAULT.battery


# Declared so that a read starts no job to look into file footers.
_SCHEMAS = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _cents(column: str):
    return F.round(F.col(column) * 100).cast("long")


def _raw_prices(spark: SparkSession, sf_dir: str, minutes: int) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        floor_minutes(F.col("ts"), minutes).alias(S.INTERVAL),
        F.col("event_type").alias("location"),
        (F.col("value") - 20).alias("spp"),
        F.col("ts").alias(RETRIEVED_AT),
        F.col("event_id").alias(ARRIVAL),
    )


def raw_da(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_prices(spark, sf_dir, 60)


def raw_rt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_prices(spark, sf_dir, 15)


def raw_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .groupBy(floor_minutes(F.col("ts"), 60).alias(S.INTERVAL))
        .agg(
            (F.sum(_cents("value")) / 100).alias("system_total"),
            F.min("event_id").alias(ARRIVAL),
        )
    )


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = floor_minutes(F.col("ts"), 60)
    behind = F.make_dt_interval(hours=F.col("event_id") % 48)
    return table(spark, sf_dir, "events").select(
        hour.alias(S.INTERVAL),
        F.when(F.col("event_id") % 97 != 0, hour - behind).alias("publish_time_utc"),
        F.col("value").alias("z1"),
        F.when(F.col("event_id") % 11 != 0, F.col("value") + 5).alias("z2"),
        (F.col("value") + 10).alias("z3"),
        (F.col("value") + 15).alias("z4"),
        F.col("event_id").alias(ARRIVAL),
    )


def _mean_by_point(rows: DataFrame, interval, point: str, value: str) -> DataFrame:
    """Mean cents per interval and point, and pooled as point 'ALL' from the same partial sums."""
    parts = rows.groupBy(interval.alias(S.INTERVAL), F.col(point).alias("_point")).agg(
        F.sum(_cents(value)).alias("cents"), F.count("*").alias("n")
    )
    both = parts.withColumn(S.POINT, F.explode(F.array(F.lit("ALL"), F.col("_point"))))
    return both.groupBy(S.INTERVAL, S.POINT).agg((F.sum("cents") / F.sum("n")).alias("mean"))


def hub_hourly(
    spark: SparkSession, sf_dir: str, config: Config = EVENT_CONFIG
) -> DataFrame:
    """Hourly mean price per event type and pooled as point 'ALL', in the price contract."""
    events = table(spark, sf_dir, "events")
    hour = floor_minutes(F.col("ts"), 60)
    hourly = _mean_by_point(events, hour, "event_type", "value").withColumn(S.PRICE, F.col("mean") / 100 - 20)
    return S.enforce(tag_regime(hourly, config.market), S.PRICES)


def _block(ts: str, key: str):
    return F.col(ts) + F.make_dt_interval(hours=(F.col(key) % 4) * 6)


def pooled_quarter_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarter-hourly mean price over all events as point 'ALL'."""
    quarter = floor_minutes(F.col("ts"), 15).alias(S.INTERVAL)
    rows = table(spark, sf_dir, "events").select(quarter, _cents("value").alias("cents"))
    pooled = rows.groupBy(S.INTERVAL).agg((F.sum("cents") / F.count("*") / 100 - 20).alias(S.PRICE))
    return pooled.withColumn(S.POINT, F.lit("ALL"))


def history_prices(
    spark: SparkSession, sf_dir: str, config: Config = HISTORY_CONFIG, only_status: str | None = None
) -> DataFrame:
    """Block prices per return flag and pooled as 'ALL', in the price contract."""
    items = table(spark, sf_dir, "lineitem")
    if only_status is not None:
        items = items.where(F.col("l_linestatus") == only_status)
    block = _block("l_shipdate", "l_orderkey")
    means = _mean_by_point(items, block, "l_returnflag", "l_extendedprice")
    blocks = means.withColumn(S.PRICE, F.col("mean") / 100000)
    return S.enforce(tag_regime(blocks, config.market), S.PRICES)


def history_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block demand: quantity shipped in the block."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(_block("l_shipdate", "l_orderkey").alias(S.INTERVAL))
        .agg(F.sum("l_quantity").alias(S.DEMAND))
    )


def history_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(_block("l_shipdate", "l_orderkey").alias(S.INTERVAL))
        .agg((F.sum(_cents("l_discount")) / F.count("*")).alias(S.TEMP))
    )


def run_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four raw feeds with one row per event, many copies per interval, for whole stage runs."""
    events = table(spark, sf_dir, "events")
    hour, value, arrival = floor_minutes(F.col("ts"), 60), F.col("value"), F.col("event_id").alias(ARRIVAL)

    def prices(minutes: int) -> DataFrame:
        interval = floor_minutes(F.col("ts"), minutes).alias(S.INTERVAL)
        return events.select(interval, F.lit("ALL").alias("location"), (value - 20).alias("spp"), arrival)

    published = hour - F.make_dt_interval(hours=F.col("event_id") % 48 + 24)
    return {
        "da": prices(60),
        "rt": prices(15),
        "demand": events.select(hour.alias(S.INTERVAL), value.alias("system_total"), arrival),
        "weather": events.select(
            hour.alias(S.INTERVAL), published.alias("publish_time_utc"), value.alias("z1"),
            (value + 10).alias("z2"), arrival,
        ),
    }
