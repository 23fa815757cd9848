"""Serving reads: latest day, latest price, chart histories and lookups over stored tables.

"Latest" is a scalar subquery on the key column. It keeps the read a filter that prunes by
column statistics, where a window over a point would sort the point's whole history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.time import delivery_midnight_utc, floor_minutes, local_time
from ..sources.tables import read_span


def _of_point(df: DataFrame, point: str) -> DataFrame:
    return df.where(F.col(S.POINT) == point)


def latest_prices(prices: DataFrame, point: str, market: str, zone: str) -> DataFrame:
    """All intervals of the point's last local day, priced or not; empty for an unknown point."""
    rows = _of_point(prices, point)
    opening = rows.agg(F.max(S.INTERVAL).alias("ts")).select(delivery_midnight_utc(F.col("ts"), zone))
    day = local_time(F.col(S.INTERVAL), zone).cast("date").alias("local_day")
    return rows.where(F.col(S.INTERVAL) >= opening.scalar()).select(
        S.POINT, F.lit(market).alias("market"), day, S.INTERVAL, S.PRICE, S.REGIME
    ).orderBy(S.INTERVAL)


def stored_last_days(
    spark: SparkSession, root: str, name: str, zone: str, days: int = 0
) -> DataFrame:
    """Rows of a clustered price table from the local midnight `days` before its last day on.

    The manifest names the files, so the read opens those of the last days only, however long the history.
    A point that ended earlier is not among them: `latest_prices` over the whole table finds its last day.
    """
    opening = delivery_midnight_utc(F.col("last"), zone) - F.make_dt_interval(F.lit(days))
    return read_span(spark, root, name, S.INTERVAL, low=opening)


def latest_forecast(forecasts: DataFrame, point: str, model: str) -> DataFrame:
    """Predicted and realised prices of the model's last delivery day, by hour."""
    rows = _of_point(forecasts, point).where(F.col(S.MODEL) == model)
    last = rows.agg(F.max(S.DAY))
    return rows.where(F.col(S.DAY) == last.scalar()).select(
        S.POINT, S.MODEL, S.DAY, S.HOUR, S.INTERVAL, S.PREDICTED, S.REALISED, S.REGIME
    ).orderBy(S.HOUR)


def latest_price(prices: DataFrame, points: list[str] | None = None) -> DataFrame:
    """Last known price per point."""
    rows = prices if points is None else prices.where(F.col(S.POINT).isin(*points))
    return (
        rows.where(F.col(S.PRICE).isNotNull())
        .groupBy(S.POINT)
        .agg(F.max_by(S.PRICE, S.INTERVAL).alias(S.PRICE), F.max(S.INTERVAL).alias(S.INTERVAL))
    )


def price_history(prices: DataFrame, point: str, zone: str) -> DataFrame:
    """Prices on local wall-clock time."""
    return _of_point(prices, point).select(
        local_time(F.col(S.INTERVAL), zone).alias("local_time"), S.PRICE
    )


def hourly_history(history: DataFrame) -> DataFrame:
    """Mean price of each local hour that has one."""
    return (
        history.groupBy(floor_minutes(F.col("local_time"), 60).alias("local_time"))
        .agg(F.avg(S.PRICE).alias(S.PRICE))
        .where(F.col(S.PRICE).isNotNull())
    )


def recent_history(
    prices: DataFrame, point: str, zone: str, days: int = 30, hourly: bool = False
) -> DataFrame:
    """The trailing days of the history, counted back from the last row, both ends included.

    A coarse bound on the stored interval, a day wider than asked, lets the scan skip older files;
    the exact cut is made on local time afterwards.
    """
    rows = _of_point(prices, point)
    counted = rows.where(F.col(S.PRICE).isNotNull()) if hourly else rows
    bound = counted.agg(F.max(S.INTERVAL) - F.make_dt_interval(F.lit(days + 1)))
    history = price_history(rows.where(F.col(S.INTERVAL) >= bound.scalar()), point, zone)
    if hourly:
        history = hourly_history(history)
    cutoff = history.agg(F.max("local_time") - F.make_dt_interval(F.lit(days)))
    return history.where(F.col("local_time") >= cutoff.scalar()).orderBy("local_time")


def available_models(forecasts: DataFrame) -> DataFrame:
    return forecasts.where(F.col(S.MODEL).isNotNull()).select(S.MODEL).distinct().orderBy(S.MODEL)


def available_days(backtest: DataFrame, point: str) -> DataFrame:
    """Scored delivery days of a point, newest first."""
    rows = _of_point(backtest, point).where(F.col(S.DAY).isNotNull())
    return rows.select(S.DAY).distinct().orderBy(F.col(S.DAY).desc())


def representative_day(backtest: DataFrame) -> DataFrame:
    """Per point the day with the (lower) median forecast-driven profit, ties to the earlier day.

    A window holds one row per calendar day of its point.
    """
    rows = backtest.where((F.col(S.SCENARIO) == S.FORECAST_DRIVEN) & F.col(S.PROFIT).isNotNull())
    group = W.partitionBy(S.POINT)
    rank = F.row_number().over(group.orderBy(S.PROFIT, S.DAY)) - 1
    middle = F.floor((F.count("*").over(group) - 1) / 2)
    ranked = rows.select(S.POINT, S.DAY, S.PROFIT, (rank == middle).alias("is_middle"))
    return ranked.where("is_middle").drop("is_middle")


def pooled_error(metrics: DataFrame, point: str | None = None, model: str | None = None) -> DataFrame:
    """All-hours error rows."""
    rows = metrics.where(F.col(S.HOUR) == S.POOLED_HOUR)
    if point is not None:
        rows = _of_point(rows, point)
    if model is not None:
        rows = rows.where(F.col(S.MODEL) == model)
    return rows.select(S.MODEL, S.POINT, S.MAE, S.SMAPE, S.REL_MAE, S.N_OBS)


def dispatch_summary(backtest: DataFrame, point: str, day: Column | None = None) -> DataFrame:
    """Stored profit and capture of the operator, for one day or all of a point."""
    rows = _of_point(backtest, point).where(F.col(S.SCENARIO) == S.FORECAST_DRIVEN)
    if day is not None:
        rows = rows.where(F.col(S.DAY) == day)
    return rows.select(S.POINT, S.DAY, S.PROFIT, S.CAPTURE)


def dispatch_rows(forecasts: DataFrame, point: str, day: Column) -> DataFrame:
    """Forecast rows the deployed operator dispatched on one day; its model is fixed."""
    chosen = (F.col(S.MODEL) == S.BOOSTED) & (F.col(S.DAY) == day)
    return _of_point(forecasts, point).where(chosen).orderBy(S.INTERVAL)


def sensitivity_table(sweep: DataFrame, point: str) -> DataFrame:
    columns = ["duration_h", "cycling_cost_per_mwh", S.SCENARIO, "usd_per_kw_year"]
    return _of_point(sweep, point).select(*columns).orderBy(
        S.SCENARIO, "duration_h", "cycling_cost_per_mwh"
    )


def concentration_curve(concentration: DataFrame, point: str, scenario: str) -> DataFrame:
    rows = _of_point(concentration, point).where(F.col(S.SCENARIO) == scenario)
    return rows.select("day_share", "cumulative_share").orderBy("day_share")


def backtest_headline(annual: DataFrame, annualised: DataFrame) -> DataFrame:
    """Annual totals and the per-kW-year figures as one ordered result."""
    rows = annual.withColumn("kind", F.lit("annual")).unionByName(
        annualised.withColumn("kind", F.lit("annualised")), allowMissingColumns=True
    )
    return rows.select(
        "kind", S.POINT, S.SCENARIO, "period", S.PROFIT, S.CYCLES, S.CAPTURE, "n_days", "usd_per_kw_year"
    ).orderBy("kind", S.POINT, S.SCENARIO, "period")


def iso_instant(ts: Column) -> Column:
    """ISO-8601 text of a UTC instant; the plain cast keeps the session zone out of it."""
    return F.concat(F.replace(ts.cast("string"), F.lit(" "), F.lit("T")), F.lit("+00:00"))


def _payload(rows: DataFrame, day: str, listed: str, item: Column, **head: str) -> DataFrame:
    """One JSON document: the head fields, the day, and the day's rows as a list, at most 100.

    Without rows the day is null and the list empty.
    """
    whole = rows.agg(
        F.max(day).cast("string").alias(day), F.sort_array(F.collect_list(item)).alias(listed)
    )
    fields = [F.lit(value).alias(name) for name, value in head.items()]
    document = F.struct(*fields, day, listed)
    return whole.select(F.to_json(document, {"ignoreNullFields": "false"}).alias("payload"))


def price_payload(prices: DataFrame, point: str, market: str, zone: str) -> DataFrame:
    """The last local day of prices of a point as one JSON document."""
    item = F.struct(iso_instant(F.col(S.INTERVAL)).alias(S.INTERVAL), S.PRICE, S.REGIME)
    rows = latest_prices(prices, point, market, zone)
    return _payload(rows, "local_day", "intervals", item, settlement_point=point, market=market)


def forecast_payload(forecasts: DataFrame, point: str, model: str) -> DataFrame:
    """The last delivery day of a model's forecasts as one JSON document."""
    item = F.struct(
        S.HOUR, iso_instant(F.col(S.INTERVAL)).alias(S.INTERVAL), S.PREDICTED, S.REALISED, S.REGIME
    )
    rows = latest_forecast(forecasts, point, model)
    return _payload(rows, S.DAY, "hours", item, settlement_point=point, model=model)


def json_records(df: DataFrame) -> DataFrame:
    """One JSON text per row: instants as ISO-8601 UTC, dates as ISO text, NaN and NULL as null."""
    shaped = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind == "timestamp_ntz":
            column = iso_instant(column)
        elif kind == "double":
            column = F.when(~F.isnan(column), column)
        elif kind == "date":
            column = column.cast("string")
        shaped.append(column.alias(name))
    return df.select(F.to_json(F.struct(*shaped), {"ignoreNullFields": "false"}).alias("record"))
