from dataclasses import replace
from math import sqrt

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattspan.config import Battery
from wattspan.operators.dispatch import LevelGrid, optimise_dispatch, solve_batch

UNIT = Battery()


def solve(prices, battery=UNIT, hours=1.0):
    return dict(zip(
        ("charge", "discharge", "soe", "profit", "moved", "status"),
        solve_batch([np.array(prices, dtype=float)], battery, hours)[0],
    ))


def grid_best(prices, battery, limit=None, cells=41, moved_step=0.025):
    """Brute force over a grid of levels and, with a limit, of energy moved so far."""
    eta = sqrt(battery.round_trip_efficiency)
    levels = np.linspace(0, battery.capacity_mwh, cells)
    start = int(np.argmin(abs(levels - battery.initial_soc_frac * battery.capacity_mwh)))
    shift = levels[None, :] - levels[:, None]
    charge, discharge = np.maximum(shift, 0) / eta, np.maximum(-shift, 0) * eta
    allowed = (charge <= battery.power_mw + 1e-9) & (discharge <= battery.power_mw + 1e-9)
    used = np.round((charge + discharge) / moved_step).astype(int)
    room = int(round(limit / moved_step)) if limit is not None else 0
    best = np.full((cells, room + 1), -np.inf)
    best[start, 0] = 0.0
    for p in prices:
        nxt = np.full_like(best, -np.inf)
        for a in range(cells):
            for b in np.flatnonzero(allowed[a]):
                gain = p * (discharge[a, b] - charge[a, b]) - battery.cycling_cost_per_mwh * discharge[a, b]
                k = used[a, b] if limit is not None else 0
                if k <= room:
                    nxt[b, k:] = np.maximum(nxt[b, k:], best[a, : room + 1 - k] + gain)
        best = nxt
    return best[start].max()


def test_known_answers():
    r = solve([10, 50])
    assert r["profit"] == pytest.approx(32.5)
    assert r["charge"] == pytest.approx([1, 0]) and r["discharge"] == pytest.approx([0, 0.85])
    assert solve([-100])["profit"] == pytest.approx(0)
    flat = solve([25] * 6)
    assert flat["moved"] == pytest.approx(0) and flat["profit"] == pytest.approx(0)
    worn = solve([20, 80, 15, 90, 10, 75], replace(UNIT, cycling_cost_per_mwh=1e6))
    assert worn["moved"] == pytest.approx(0) and worn["profit"] == pytest.approx(0)


def test_balance_bounds_and_exclusivity():
    rng = np.random.default_rng(1)
    for _ in range(20):
        r = solve(rng.normal(15, 40, 24))
        level = 1.0
        for c, d, s in zip(r["charge"], r["discharge"], r["soe"]):
            level += sqrt(0.85) * c - d / sqrt(0.85)
            assert s == pytest.approx(level, abs=1e-9)
        assert r["soe"][-1] == pytest.approx(1.0, abs=1e-9)
        assert r["soe"].min() >= 0 and r["soe"].max() <= 2
        assert np.minimum(r["charge"], r["discharge"]).max() == 0
        assert max(r["charge"].max(), r["discharge"].max()) <= 1 + 1e-9


@pytest.mark.parametrize("duration", [1.0, 2.0, 4.0])
@pytest.mark.parametrize("wear", [0.0, 5.0])
def test_never_below_a_fine_grid(duration, wear):
    rng = np.random.default_rng(int(duration * 10 + wear))
    unit = replace(UNIT, duration_h=duration, cycling_cost_per_mwh=wear)
    for _ in range(3):
        prices = rng.normal(20, 40, 8)
        exact, rough = solve(prices, unit)["profit"], grid_best(prices, unit, cells=161)
        assert rough - 1e-9 <= exact <= rough + 8.0


def test_lossless_unit_matches_its_grid_exactly():
    unit = replace(UNIT, round_trip_efficiency=1.0)
    prices = np.random.default_rng(5).normal(20, 40, 10)
    assert solve(prices, unit)["profit"] == pytest.approx(grid_best(prices, unit))


def test_quarter_hours_and_mixed_lengths_in_one_batch():
    rng = np.random.default_rng(2)
    vectors = [rng.normal(30, 20, n) for n in (1, 3, 23, 24, 25, 24, 4)]
    together = solve_batch(vectors, UNIT)
    for vector, row in zip(vectors, together):
        assert len(row[0]) == len(vector)
        assert row[3] == pytest.approx(solve(vector)["profit"], abs=1e-9)
    quarter = solve([10, 10, 10, 10, 50, 50, 50, 50], hours=0.25)
    assert quarter["profit"] == pytest.approx(32.5)


def test_ties_take_the_earliest_action_and_repeat():
    r = solve([10, 10, 50, 50])
    assert r["profit"] == pytest.approx(solve([10, 10, 50, 50])["profit"])
    again = solve([10, 10, 50, 50])
    assert np.array_equal(r["charge"], again["charge"])
    single = solve([20, 5, 5, 60])
    assert single["charge"][1] >= single["charge"][2] - 1e-9


# A lossy unit and negative prices make running both legs at once tempting; in the last two the
# priced mix disputes an interval and the search has to branch.
CAPPED = [
    ([-40.5, 12.0, -80.2, 33.1, -5.0], 0.5),
    ([-12.3, 44.0, -61.9, 80.5, -20.0], 1.5),
    ([5.0, -90.0, 15.5, -33.0, 60.1], 1.0),
    ([-37.9, -54.4, -103.8, -14.7, -13.6], 3.0),
    ([-14.0, -18.6, -116.1, -50.3, -135.9], 3.0),
]


@pytest.mark.parametrize("case", range(len(CAPPED)))
def test_throughput_cap_is_exact_with_burning_prices(case):
    prices, limit = CAPPED[case]
    unit = replace(UNIT, round_trip_efficiency=0.25)
    capped = replace(unit, cycles_per_day_cap=limit * 24 / 5 / (2 * unit.capacity_mwh))
    r = solve(prices, capped)
    rough = grid_best(prices, unit, limit)
    assert r["moved"] <= limit + 1e-9
    assert rough - 1e-7 <= r["profit"] <= rough + 3.0
    assert np.minimum(r["charge"], r["discharge"]).max() == 0
    grid = LevelGrid(5, 1.0, unit)
    free = np.ones((5, 1), bool)
    bound, _, disputed = grid._priced_mix(np.array(prices)[:, None], np.array([limit]), (free, free))
    assert r["profit"] <= bound[0] + 1e-8
    assert (disputed[0] >= 0) == (case >= 3)
    if disputed[0] >= 0:
        assert r["profit"] == pytest.approx(rough) and r["profit"] < bound[0] - 0.1


def test_capped_days_are_priced_together(monkeypatch):
    """A batch gives each day what it gets alone, branching days among them, and prices few columns a day."""
    rng = np.random.default_rng(5)
    days = [np.array(p) for p, _ in CAPPED] + [rng.normal(20, 40, 5 + k % 3) for k in range(300)]
    unit = replace(UNIT, round_trip_efficiency=0.25, cycles_per_day_cap=0.9)
    alone = [solve_batch([d], unit)[0] for d in days]
    columns, plain = [], LevelGrid.solve
    monkeypatch.setattr(LevelGrid, "solve", lambda self, p, *more: columns.append(p.shape[1]) or plain(self, p, *more))
    together = solve_batch(days, unit)
    for one, other in zip(alone, together):
        assert one[3] == pytest.approx(other[3], abs=1e-8) and np.allclose(one[4], other[4])
    assert sum(columns) <= 10 * len(days) and len(columns) < 60


def test_cap_on_positive_prices():
    prices = [20, 80, 15, 90, 10, 75]
    r = solve(prices, replace(UNIT, cycles_per_day_cap=0.5))
    assert r["moved"] == pytest.approx(0.5 * 6 / 24 * 4)
    assert r["profit"] <= solve(prices)["profit"]


def test_bad_vectors_are_errors():
    for bad in ([], [1.0, float("nan")]):
        with pytest.raises(ValueError):
            solve(bad)


def test_column_form_serves_variants_by_row(spark):
    rows = [([10.0, 50.0], 2.0, 0.0), ([10.0, 50.0], 2.0, 1e6), ([10.0, 50.0, 20.0, 70.0], 1.0, 0.0)]
    df = spark.createDataFrame(rows, "p array<double>, d double, w double")
    out = df.select("w", F.size("p").alias("n"), optimise_dispatch(F.col("p"), UNIT, F.col("d"), F.col("w")).alias("s"))
    got = {(r.n, r.w): r.s for r in out.collect()}
    assert got[(2, 0.0)].profit_usd == pytest.approx(32.5)
    assert got[(2, 1e6)].profit_usd == pytest.approx(0.0)
    assert len(got[(4, 0.0)].soe_mwh) == 4
