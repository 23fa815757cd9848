"""Summaries of the daily backtest table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schemas as S
from ..config import Battery
from ..functions.numeric import ratio_or_null
from .backtest import DAYS_PER_YEAR


def period_summary(backtest: DataFrame, period: str) -> DataFrame:
    """Totals per point, scenario and period ('month' or 'year'); mean capture skips open days."""
    return backtest.groupBy(
        S.POINT, S.SCENARIO, F.trunc(S.DAY, period).alias("period")
    ).agg(
        F.sum(S.PROFIT).alias(S.PROFIT),
        F.sum(S.CYCLES).alias(S.CYCLES),
        F.avg(S.CAPTURE).alias(S.CAPTURE),
        F.count("*").alias("n_days"),
    )


def monthly_summary(backtest: DataFrame) -> DataFrame:
    return period_summary(backtest, "month")


def annual_summary(backtest: DataFrame) -> DataFrame:
    return period_summary(backtest, "year")


def annualised_per_kw_year(backtest: DataFrame, battery: Battery) -> DataFrame:
    """Mean daily profit scaled to a year, per kW of rated power."""
    return backtest.groupBy(S.POINT, S.SCENARIO).agg(
        F.count("*").alias("n_days"),
        (F.avg(S.PROFIT) * DAYS_PER_YEAR / (battery.power_mw * 1000.0)).alias("usd_per_kw_year"),
    )


def profit_concentration(backtest: DataFrame) -> DataFrame:
    """Days ranked from most to least profitable with running and relative totals.

    A window holds the days of one point and scenario, at most one row per calendar day.
    """
    group = W.partitionBy(S.SCENARIO, S.POINT)
    ranked = group.orderBy(F.col(S.PROFIT).desc(), S.DAY)
    running = F.sum(S.PROFIT).over(ranked.rowsBetween(W.unboundedPreceding, 0))
    rank = F.row_number().over(ranked)
    return backtest.select(
        S.SCENARIO,
        S.POINT,
        rank.alias("day_rank"),
        (rank / F.count("*").over(group)).alias("day_share"),
        S.DAY,
        S.PROFIT,
        running.alias("cumulative_profit_usd"),
        ratio_or_null(running, F.sum(S.PROFIT).over(group)).alias("cumulative_share"),
    )


def build_summaries(backtest: DataFrame, battery: Battery) -> dict[str, DataFrame]:
    """All stored summary tables of a backtest."""
    return {
        "backtest_monthly": monthly_summary(backtest),
        "backtest_annual": annual_summary(backtest),
        "backtest_annualised_per_kw_year": annualised_per_kw_year(backtest, battery),
        "backtest_concentration": profit_concentration(backtest),
    }
