"""Table contracts: column order and types of every stored table.

Instants are `timestamp_ntz` holding UTC wall clock, so no result depends on the session zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .config import Model

# Column names, labels and the forbidden columns are the stored data contract.
INTERVAL = "interval_start_utc"
POINT = "settlement_point"
PRICE = "price_usd_per_mwh"
REGIME = "regime"
DEMAND = "da_demand_forecast_mw"
TEMP = "temp_c_ercot"
DAY = "delivery_date"
HOUR = "hour_of_day"
DOW = "day_of_week"
MONTH = "month"
HOLIDAY = "holiday_flag"
MODEL = "model"
PREDICTED = "predicted_usd_per_mwh"
REALISED = "realised_usd_per_mwh"
FOLD = "fold_index"
N_OBS = "n_obs"
MAE = "mae_usd_per_mwh"
SMAPE = "smape_pct"
REL_MAE = "rel_mae_vs_naive"
SCENARIO = "scenario"
PROFIT = "profit_usd"
CYCLES = "equiv_full_cycles"
CAPTURE = "capture_rate"

NAIVE_WEEK = "naive_week"
SEASONAL_DOW = "seasonal_dow"
LEAR = "lear"
BOOSTED = "lightgbm"  # stored label of the boosted-tree operator

CEILING = "ceiling"
FORECAST_DRIVEN = "forecast_driven"

POOLED_HOUR = -1

# Series only known on or after the delivery day; never allowed as features.
FORBIDDEN_FEATURES = frozenset({"load_mw", "price_same_day", "temp_realised_c"})


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_NTZ, _STR, _DBL, _INT, _LONG, _DATE = (
    T.TimestampNTZType(), T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.DateType(),
)

PRICES = _schema(**{INTERVAL: _NTZ, POINT: _STR, PRICE: _DBL, REGIME: _STR})
LOAD = _schema(**{INTERVAL: _NTZ, DEMAND: _DBL})
WEATHER = _schema(**{INTERVAL: _NTZ, TEMP: _DBL})
FORECASTS = _schema(**{
    DAY: _DATE, HOUR: _LONG, INTERVAL: _NTZ, POINT: _STR, REGIME: _STR,
    MODEL: _STR, PREDICTED: _DBL, REALISED: _DBL, FOLD: _LONG,
})
METRICS = _schema(**{
    MODEL: _STR, POINT: _STR, REGIME: _STR, HOUR: _LONG, N_OBS: _LONG,
    MAE: _DBL, SMAPE: _DBL, REL_MAE: _DBL,
})
BACKTEST = _schema(**{
    DAY: _DATE, SCENARIO: _STR, POINT: _STR, PROFIT: _DBL, CYCLES: _DBL, CAPTURE: _DBL,
})

TABLES = {
    "da_prices": PRICES, "rt_prices": PRICES, "load": LOAD, "weather": WEATHER,
    "forecasts": FORECASTS, "forecast_metrics": METRICS, "backtest": BACKTEST,
}


def lag_name(days: int) -> str:
    return f"price_lag_{days}d"


def feature_names(model: Model) -> list[str]:
    """Allowed feature columns in order: lags, calendar, exogenous."""
    return [*map(lag_name, model.price_lag_days), *model.calendar, *model.exogenous]


def matrix_schema(model: Model) -> T.StructType:
    meta = {DAY: _DATE, INTERVAL: _NTZ, POINT: _STR, REGIME: _STR, PRICE: _DBL}
    lags = {lag_name(k): _DBL for k in model.price_lag_days}
    calendar = {name: _INT for name in model.calendar}
    exogenous = {name: _DBL for name in model.exogenous}
    return _schema(**meta, **lags, **calendar, **exogenous)


def enforce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the contract's columns in order, cast to its types; missing columns are an error."""
    missing = [name for name in schema.names if name not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
