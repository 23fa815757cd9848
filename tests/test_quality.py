import json
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException

from hours import hours_from
from wattspan import schemas as S
from wattspan.config import DEFAULT
from wattspan.operators import quality
from wattspan.sources.tables import write_json

PRICES = "interval_start_utc timestamp_ntz, settlement_point string, price_usd_per_mwh double, regime string"


def at(*hours):
    return [datetime(2024, 1, 1) + timedelta(hours=h) for h in hours]


def gaps(spark, times, step=quality.HOURLY):
    df = spark.createDataFrame([(t, "p") for t in times], "interval_start_utc timestamp_ntz, settlement_point string")
    return [r.gaps for r in quality.spacing_gaps(df, step, [S.POINT]).collect()]


def test_gap_counts(spark):
    assert gaps(spark, at(0, 1, 3)) == [1]
    assert gaps(spark, at(0)) == [0]
    assert gaps(spark, at(22, 23, 24, 25)) == [0]  # across midnight
    assert gaps(spark, at(0, 1, 23, 24 * 9, 24 * 9 + 1)) == [2]
    assert gaps(spark, hours_from("2024-01-01", 200, 15), quality.QUARTER_HOURLY) == [0]


def test_off_grid_and_too_close_fail(spark):
    for bad in (at(0, 0.5), at(0, 1.5), at(23.75, 24.25), at(23, 24.5)):
        with pytest.raises(PySparkException, match="grid"):
            gaps(spark, bad)


def test_report_and_json(spark, tmp_path):
    rows = [(t, "p", v, "swcap5000") for t, v in zip(at(0, 1, 2, 4), (10.0, -5.0, None, 6000.0))]
    prices = spark.createDataFrame(rows, PRICES)
    quarter = spark.createDataFrame(
        [(t, "p", 1.0, "swcap5000") for t in hours_from("2024-01-01", 8, 15)], PRICES)
    load = spark.createDataFrame([(t, 41000.0) for t in at(0, 1, 2)], "interval_start_utc timestamp_ntz, da_demand_forecast_mw double")
    weather = spark.createDataFrame([(t, -1.5) for t in at(0, 2)], "interval_start_utc timestamp_ntz, temp_c_ercot double")
    tables = {"da_prices": prices, "rt_prices": quarter, "load": load, "weather": weather}
    path = write_json(quality.quality_report(tables, DEFAULT), str(tmp_path), "data_quality")
    lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
    report = {r["table"]: r for r in lines}
    da = report["da_prices"]
    assert (da["rows"], da["gaps"], da["negative_share"]) == (4, 1, 0.25)
    assert da["by_regime"]["swcap5000"] == {"rows": 4, "min_price": -5.0, "max_price": 6000.0, "above_cap": 1}
    assert report["rt_prices"]["gaps"] == 0
    assert (report["load"]["min"], report["load"]["max"]) == (41000.0, 41000.0)
    assert report["weather"]["gaps"] == 1


def test_empty_table_reports_zero(spark):
    empty = spark.createDataFrame([], PRICES)
    row = quality.price_stats(empty, quality.HOURLY, DEFAULT, "cap_da").first()
    assert (row["rows"], row["gaps"], row["negative_share"]) == (0, 0, 0.0)
