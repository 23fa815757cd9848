"""Profit-optimal charge and discharge of a storage unit over a price vector.

For a fixed choice of charging or discharging per interval the problem is a linear program whose
vertices have, between two stays at empty, full or the start level, at most one interval at part
power. So every level an optimal schedule needs is one of those anchors plus whole charge steps
minus whole discharge steps (or the reverse), a small finite set. Dynamic programming over that
set is exact, and a move uses one direction only, so charging and discharging never overlap.

Spark groups prices into one array per point and day; a scalar pandas UDF solves a batch of
arrays at once, level axis times day axis.
"""

from __future__ import annotations

from dataclasses import replace
from math import sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Battery

# Profits closer than TIE are equal; FRICTION per MWh moved makes equal profits prefer less wear.
TIE = 1e-10
FRICTION = 1e-7
_ROWS_PER_SOLVE = 256

TOTALS = "profit_usd double, throughput_mwh double, status string"
SCHEDULE = f"charge_mw array<double>, discharge_mw array<double>, soe_mwh array<double>, {TOTALS}"


def energy_levels(steps: int, up: float, down: float, capacity: float, start: float) -> np.ndarray:
    """The sorted levels of an exact schedule over `steps` intervals."""
    i, j = np.meshgrid(np.arange(steps + 1), np.arange(steps + 1))
    shift = (i * up - j * down)[i + j <= steps]
    levels = np.concatenate([a + s * shift for a in (0.0, capacity, start) for s in (1, -1)])
    levels = np.sort(levels[(levels >= -1e-9) & (levels <= capacity + 1e-9)])
    levels = levels[np.concatenate([[True], np.diff(levels) > 1e-9])]
    return np.clip(levels, 0.0, capacity)


class LevelGrid:
    """Levels of one unit with, per level, the range one interval can reach."""

    def __init__(self, steps: int, hours: float, battery: Battery):
        self.leg = sqrt(battery.round_trip_efficiency)
        self.hours, self.wear = hours, battery.cycling_cost_per_mwh
        self.capacity = battery.capacity_mwh
        initial = battery.initial_soc_frac * self.capacity
        up, down = self.leg * battery.power_mw * hours, battery.power_mw * hours / self.leg
        self.levels = energy_levels(steps, up, down, self.capacity, initial)
        self.start = int(np.argmin(np.abs(self.levels - initial)))
        self.highest = np.searchsorted(self.levels, self.levels + up + 1e-9, "right") - 1
        self.lowest = np.searchsorted(self.levels, self.levels - down - 1e-9, "left")

    def _range_max(self, values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Column-wise maximum of values[lo..hi] by doubling windows."""
        tables, width = [values], 1
        while 2 * width <= int(np.max(hi - lo)) + 1:
            last = tables[-1].copy()
            last[: len(last) - width] = np.maximum(last[: len(last) - width], last[width:])
            tables.append(last)
            width *= 2
        power = np.log2(hi - lo + 1).astype(int)
        stacked = np.stack(tables)
        return np.maximum(stacked[power, lo], stacked[power, hi - 2**power + 1])

    def solve(
        self,
        prices: np.ndarray,
        penalty: np.ndarray | float = 0.0,
        may_charge: np.ndarray | None = None,
        may_discharge: np.ndarray | None = None,
    ) -> np.ndarray:
        """Level change per interval, shape (T, days), for prices of that shape.

        NaN prices pad shorter days at the end. `penalty` is a cost per MWh moved per day.
        Equal profits resolve to the least energy moved, then to the earliest action.
        """
        steps, days = prices.shape
        level = self.levels[:, None]
        rank = np.arange(len(self.levels))
        active = ~np.isnan(prices)
        known = np.where(active, prices, 0.0)
        buy = (known + penalty + FRICTION) / self.leg  # cost per unit of level gained
        sell = (known - self.wear - penalty - FRICTION) * self.leg  # gain per unit of level lost
        ahead = np.full((steps + 1, len(self.levels), days), -np.inf)
        ahead[steps, self.start] = 0.0
        for t in range(steps - 1, -1, -1):
            nxt = ahead[t + 1]
            rise = self._range_max(nxt - buy[t] * level, rank, self.highest) + buy[t] * level
            fall = self._range_max(nxt - sell[t] * level, self.lowest, rank) + sell[t] * level
            if may_charge is not None:
                rise = np.where(may_charge[t], rise, -np.inf)
                fall = np.where(may_discharge[t], fall, -np.inf)
            ahead[t] = np.where(active[t], np.maximum(rise, fall), nxt)
        moves = np.zeros((steps, days))
        here = np.full(days, self.start)
        for t in range(steps):
            shift = level - self.levels[here]
            value = ahead[t + 1] - np.where(shift > 0, buy[t], sell[t]) * shift
            open_ = (rank[:, None] <= self.highest[here]) & (rank[:, None] >= self.lowest[here])
            if may_charge is not None:
                open_ &= np.where(shift > 0, may_charge[t], True) & np.where(shift < 0, may_discharge[t], True)
            open_ &= active[t] | (shift == 0)
            value = np.where(open_, value, -np.inf)
            tied = value >= value.max(axis=0) - TIE
            here = np.argmax(np.where(tied, np.abs(shift), -1.0), axis=0)
            moves[t] = np.take_along_axis(shift, here[None, :], axis=0)[0]
        return moves

    def powers(self, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (
            np.maximum(moves, 0.0) / self.leg / self.hours,
            np.maximum(-moves, 0.0) * self.leg / self.hours,
        )

    def profit(self, prices: np.ndarray, moves: np.ndarray) -> np.ndarray:
        charge, discharge = self.powers(moves)
        cash = np.nan_to_num(prices) * (discharge - charge) - self.wear * discharge
        return cash.sum(axis=0) * self.hours

    def throughput(self, moves: np.ndarray) -> np.ndarray:
        charge, discharge = self.powers(moves)
        return (charge + discharge).sum(axis=0) * self.hours

    def solve_capped(self, prices: np.ndarray, limits: np.ndarray) -> np.ndarray:
        """Exact schedules, prices shaped (T, days), that move at most `limits` MWh a day.

        A price on throughput gives an upper bound and two schedules on either side of the limit;
        their mix meets the limit and reaches the bound unless it would charge and discharge at
        once in an interval where burning energy pays. Such an interval is split into its two
        directions and the better half kept, so the search ends at the exact optimum. Open halves
        of all days wait in one queue and are priced together, a column each.
        """
        steps, days = prices.shape
        best = np.zeros(days)
        moves = np.zeros(prices.shape)
        every = np.ones(steps, bool)
        todo = [(day, every, every) for day in range(days)]
        while todo:
            batch, todo = todo[-_ROWS_PER_SOLVE:], todo[:-_ROWS_PER_SOLVE]
            of = np.array([day for day, _, _ in batch])
            masks = np.stack([m for _, m, _ in batch], 1), np.stack([m for _, _, m in batch], 1)
            bound, mixed, clash = self._priced_mix(prices[:, of], limits[of], masks)
            value, moved = self.profit(prices[:, of], mixed), self.throughput(mixed)
            for k, day in enumerate(of):
                if moved[k] <= limits[day] + 1e-9 and value[k] > best[day] + TIE:
                    best[day], moves[:, day] = value[k], mixed[:, k]
            for k, day in enumerate(of):
                if clash[k] >= 0 and bound[k] > best[day] + 1e-8:
                    for side in (0, 1):
                        halves = [masks[0][:, k].copy(), masks[1][:, k].copy()]
                        halves[side][clash[k]] = False
                        todo.append((day, *halves))
        return moves

    def _priced_mix(self, prices, limits, masks):
        """Per column: an upper bound, the mix of the two schedules at the bound, and an interval they
        dispute (-1: none)."""
        def at(price, columns):
            moved = self.solve(prices[:, columns], price, masks[0][:, columns], masks[1][:, columns])
            return moved, self.profit(prices[:, columns], moved), self.throughput(moved)

        columns = np.arange(prices.shape[1])
        high = at(np.zeros(len(columns)), columns)
        low = np.zeros(prices.shape), np.zeros(len(columns)), np.zeros(len(columns))
        free = high[2] <= limits + 1e-9
        open_ = columns[~free]
        while len(open_):  # each round keeps a schedule of new throughput between the two, of which there are finitely many
            price = (high[1][open_] - low[1][open_]) / (high[2][open_] - low[2][open_])
            mid = at(price, open_)
            gain = (mid[1] - price * mid[2]) - (low[1][open_] - price * low[2][open_])
            met = (gain <= 1e-9) | (mid[2] == high[2][open_]) | (mid[2] == low[2][open_])
            if not (met | (low[2][open_] < mid[2]) & (mid[2] < high[2][open_])).all():
                raise RuntimeError("the search for a throughput price left its bracket")
            above = mid[2] > limits[open_]
            for side, chosen in ((high, ~met & above), (low, ~met & ~above)):
                side[0][:, open_[chosen]] = mid[0][:, chosen]
                side[1][open_[chosen]], side[2][open_[chosen]] = mid[1][chosen], mid[2][chosen]
            open_ = open_[~met]
        with np.errstate(divide="ignore", invalid="ignore"):
            share = np.where(free, 1.0, (limits - low[2]) / (high[2] - low[2]))
        bound = low[1] + share * (high[1] - low[1])
        mixed = low[0] + share * (high[0] - low[0])
        disputed = (low[0] * high[0] < -1e-12) & (self.profit(prices, mixed) < bound - 1e-8)
        clash = np.where(disputed.any(axis=0), np.argmax(np.abs(low[0] - high[0]) * disputed, axis=0), -1)
        return bound, mixed, clash


def _schedule_rows(grid: LevelGrid, prices: np.ndarray, moves: np.ndarray, lengths: np.ndarray):
    charge, discharge = grid.powers(moves)
    soe = np.clip(grid.levels[grid.start] + np.cumsum(moves, axis=0), 0.0, grid.capacity)
    profit, moved = grid.profit(prices, moves), grid.throughput(moves)
    return [
        (charge[:n, k], discharge[:n, k], soe[:n, k], profit[k], moved[k], "Optimal")
        for k, n in enumerate(lengths)
    ]


def solve_batch(vectors: list[np.ndarray], battery: Battery, hours: float = 1.0) -> list[tuple]:
    """Schedules of several price vectors of any lengths; an empty or unknown price is an error."""
    if any(v is None or len(v) == 0 for v in vectors):
        raise ValueError("no prices to schedule for this day")
    if any(np.isnan(v).any() for v in vectors):
        raise ValueError("a price of this day is unknown")
    lengths = np.array([len(v) for v in vectors])
    rows: list[tuple] = [()] * len(vectors)
    # Similar lengths share a grid, rounded up: more levels than needed stay exact.
    bucket = -(-lengths // 4) * 4
    for size in np.unique(bucket):
        grid = LevelGrid(int(size), hours, battery)
        members = np.flatnonzero(bucket == size)
        for at in range(0, len(members), _ROWS_PER_SOLVE):
            chunk = members[at : at + _ROWS_PER_SOLVE]
            prices = np.full((int(size), len(chunk)), np.nan)
            for k, m in enumerate(chunk):
                prices[: lengths[m], k] = vectors[m]
            moves = grid.solve(prices)
            if battery.cycles_per_day_cap is not None:
                limits = battery.cycles_per_day_cap * lengths[chunk] * hours / 24.0 * 2.0 * grid.capacity
                over = np.flatnonzero(grid.throughput(moves) > limits + 1e-9)
                if len(over):
                    moves[:, over] = grid.solve_capped(prices[:, over], limits[over])
            for m, row in zip(chunk, _schedule_rows(grid, prices, moves, lengths[chunk])):
                rows[m] = row
    return rows


def optimise_dispatch(
    prices: Column,
    battery: Battery,
    duration_h: Column | None = None,
    wear: Column | None = None,
    hours: float = 1.0,
    schedule: bool = True,
) -> Column:
    """Struct column with the best schedule of an array-of-prices column, or only its totals.

    Duration and wear may differ by row, so one pass serves all variants of a sweep.
    """
    fields = SCHEDULE if schedule else TOTALS
    names = [part.split()[0] for part in fields.split(", ")]

    @F.pandas_udf(fields)
    def solve(vectors: pd.Series, durations: pd.Series, wears: pd.Series) -> pd.DataFrame:
        out: list[tuple] = [()] * len(vectors)
        variants = pd.DataFrame({"d": durations.to_numpy(), "w": wears.to_numpy()})
        for (duration, cost), part in variants.groupby(["d", "w"]):
            unit = replace(battery, duration_h=float(duration), cycling_cost_per_mwh=float(cost))
            members = part.index.to_numpy()
            solved = solve_batch([np.asarray(vectors.iloc[k], dtype=float) for k in members], unit, hours)
            for k, row in zip(members, solved):
                out[k] = row[-len(names):]
        return pd.DataFrame(out, columns=names)

    return solve(
        prices,
        F.lit(battery.duration_h) if duration_h is None else duration_h,
        F.lit(battery.cycling_cost_per_mwh) if wear is None else wear,
    )
