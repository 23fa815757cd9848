"""Run configuration as frozen dataclasses; `DEFAULT` carries the published settings."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import date


@dataclass(frozen=True)
class Battery:
    power_mw: float = 1.0
    duration_h: float = 2.0
    round_trip_efficiency: float = 0.85
    initial_soc_frac: float = 0.5
    cycles_per_day_cap: float | None = None
    cycling_cost_per_mwh: float = 0.0
    pack_cost_per_kwh: float = 200.0
    cycle_life_at_80pct_dod: int = 1000

    @property
    def capacity_mwh(self) -> float:
        return self.power_mw * self.duration_h

    @property
    def derived_cycling_cost(self) -> float:
        """USD of pack value used up per MWh sent out: pack $/kWh * 1000 / cycle life."""
        return self.pack_cost_per_kwh * 1000.0 / self.cycle_life_at_80pct_dod


@dataclass(frozen=True)
class Regime:
    """An offer-cap period by local date; a None bound is open."""

    name: str
    start: date | None
    end: date | None
    cap_da: float
    cap_rt: float


# Offer-cap periods of the market and their caps in USD/MWh.
MARKET_REGIMES = (
    Regime("pre2022", None, date(2021, 12, 31), 9000.0, 9000.0),
    Regime("swcap5000", date(2022, 1, 1), date(2025, 12, 4), 5000.0, 5000.0),
    Regime("rtcb", date(2025, 12, 5), None, 5000.0, 2000.0),
)


@dataclass(frozen=True)
class Market:
    timezone: str = "America/Chicago"
    settlement_points: tuple[str, ...] = ("HB_HUBAVG",)
    regimes: tuple[Regime, ...] = MARKET_REGIMES


@dataclass(frozen=True)
class Model:
    price_lag_days: tuple[int, ...] = (1, 2, 3, 7)
    calendar: tuple[str, ...] = ("hour_of_day", "day_of_week", "month", "holiday_flag")
    exogenous: tuple[str, ...] = ("da_demand_forecast_mw", "temp_c_ercot")
    window_days: int = 1095
    recalibrate_every_days: int = 1
    min_train_days: int = 365
    horizon_hours: int = 24
    seed: int = 42

    @property
    def slot_hours(self) -> int:
        """Width of one delivery slot; 1 for hourly markets."""
        return 24 // self.horizon_hours


@dataclass(frozen=True)
class Config:
    battery: Battery = field(default_factory=Battery)
    market: Market = field(default_factory=Market)
    model: Model = field(default_factory=Model)

    def with_market(self, **changes) -> Config:
        return replace(self, market=replace(self.market, **changes))

    def with_model(self, **changes) -> Config:
        return replace(self, model=replace(self.model, **changes))

    def with_battery(self, **changes) -> Config:
        return replace(self, battery=replace(self.battery, **changes))


DEFAULT = Config()
