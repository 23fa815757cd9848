"""Every registered query against its DuckDB twin at sf0.01."""

import pytest

import __spark_entry__ as E
from compare import connect, difference
from wattspan.plans.catalogue import registered
from wattspan.plans.twins import twins

QUERIES, TWINS = registered(), twins()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_twin(spark, con, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), con, TWINS[name]) is None


def test_only_fits_lack_a_twin():
    assert set(TWINS) <= set(QUERIES)
    assert set(QUERIES) - set(TWINS) == {"forecast_lear", "forecast_gbt", "walk_forward_all_models",
                                          "forecast_metrics_all_models", "backtest_boosted"}


def test_capped_profit_stays_below_the_ceiling(spark, sf_dir):
    free = {(r[0], r[1]): r for r in QUERIES["dispatch_ceiling"](spark, sf_dir).collect()}
    for r in QUERIES["dispatch_capped"](spark, sf_dir).collect():
        whole = free[(r[0], r[1])]
        assert r.profit_usd <= whole.profit_usd + 1e-3
        assert r.throughput_mwh <= 0.5 * r.n_hours / 24 * 4 + 1e-3


def test_entry_returns_rows(spark):
    df = E.entry(spark)
    assert df.columns and df.count() > 0
