"""Shape of the physical plans: what must be pushed down, shuffled once or never happen."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from wattspan import schemas as S
from wattspan.operators import clean, features, forecast, serving
from wattspan.operators.baselines import seasonal_dow
from wattspan.plans import catalogue as C
from wattspan.session import materialise
from wattspan.sources import landing, tables
from wattspan.sources import marketviews as V


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> list[str]:
    return [line for line in plan(df).splitlines() if "Exchange hashpartitioning" in line]


@pytest.fixture(scope="module")
def prices(spark, sf_dir):
    return materialise(C._hub(spark, sf_dir), "prices")


def test_source_window_is_pushed_to_the_scan(spark, sf_dir):
    text = plan(C.raw_scan_filtered(spark, sf_dir))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in text and "In(event_" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in text


def test_raw_window_prunes_partitions(spark, sf_dir, tmp_path):
    rows, feed = V.raw_da(spark, sf_dir), landing.FEEDS["da"]
    out = landing.land_range(
        spark, feed, date(2024, 1, 3), date(2024, 1, 4),
        lambda a, b: landing.pushed_window(rows, feed, a, b), str(tmp_path),
    )
    assert "PartitionFilters: [isnotnull(date" in plan(out)


def test_dedup_combines_before_its_only_shuffle(spark, sf_dir):
    df = clean.clean_prices(V.raw_da(spark, sf_dir), V.EVENT_CONFIG)
    text = plan(df)
    assert len(exchanges(df)) == 1 and "partial_min_by" in text and "Window" not in text
    assert "SortAggregate" not in text


def test_all_lags_share_one_shuffle(prices):
    hub = features.hub_frame(prices, C.HUB_CONFIG)
    df = features.with_price_lags(hub, C.HUB_CONFIG.model)
    keys = exchanges(df)
    assert len(keys) == 2 and "Join" not in plan(df)  # (point, day) to fill gaps, (point, hour) to lag
    assert "settlement_point" in keys[0] and "hour_of_day" in keys[0]


def test_no_query_multiplies_rows_by_rows(spark, sf_dir, prices):
    matrix = materialise(C._history_matrix(spark, sf_dir), "matrix")
    for df in (
        seasonal_dow(matrix, C.HISTORY.model),
        features.model_matrix(prices, C._load(spark, sf_dir), C._weather(spark, sf_dir), C.HUB_CONFIG),
        forecast.forecast_metrics(seasonal_dow(matrix, C.HISTORY.model)),
    ):
        text = plan(df)
        assert "CartesianProduct" not in text and "NestedLoop" not in text
        assert "Python" not in text and "InPandas" not in text


def test_seasonal_profile_shuffles_the_rows_once(spark, sf_dir):
    matrix = materialise(C._history_matrix(spark, sf_dir), "matrix")
    keys = [line for line in exchanges(seasonal_dow(matrix, C.HISTORY.model)) if "day_of_week" in line]
    assert len(keys) == 1


def test_dispatch_shuffles_by_point_and_day(spark, sf_dir, prices):
    df = C.B.dispatch_ceiling(prices, C.BATTERY, F.to_date(S.INTERVAL))
    keys = exchanges(df)
    assert len(keys) == 1 and "settlement_point" in keys[0] and "delivery_date" in keys[0]
    assert "REPARTITION_BY_NUM" in keys[0]


def test_latest_reads_filter_the_stored_column(spark, prices, tmp_path):
    tables.write_table(prices, str(tmp_path), "da_prices")
    stored = tables.read_table(spark, str(tmp_path), "da_prices")
    df = serving.latest_prices(stored, "ALL", "da", "America/Chicago")
    text = plan(df)
    assert "EqualTo(settlement_point,ALL)" in text and "Window" not in text and "Join" not in text
    assert "GreaterThanOrEqual(interval_start_utc,ScalarSubquery" in text  # pushed at run time


def test_session_zone_does_not_change_results(spark, sf_dir):
    def total():
        row = C.dispatch_ceiling(spark, sf_dir).agg(F.count("*"), F.round(F.sum(S.PROFIT), 6)).first()
        return tuple(row)

    before = spark.conf.get("spark.sql.session.timeZone")
    want = total()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert total() == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_backtest_reads_one_model_folder(spark, sf_dir, tmp_path):
    matrix = materialise(C._history_matrix(spark, sf_dir), "matrix")
    both = forecast.walk_forward(matrix, C.HISTORY.model, [S.NAIVE_WEEK, S.SEASONAL_DOW])
    tables.write_table(both, str(tmp_path), "forecasts", partition_by=(S.MODEL,), sort_by=(S.POINT, S.INTERVAL))
    stored = tables.read_table(spark, str(tmp_path), "forecasts")
    assert stored.schema.names == S.FORECASTS.names
    one = C.B.settlement_join(stored.where(F.col(S.MODEL) == S.NAIVE_WEEK), V.history_prices(spark, sf_dir))
    assert "PartitionFilters: [isnotnull(model" in plan(one)


def test_vintage_pick_stays_in_hash_tables(spark, sf_dir):
    text = plan(C._weather(spark, sf_dir))
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text and text.count("partial_max_by") >= 2


@pytest.mark.parametrize("days", [10, 200])
def test_last_day_opens_a_bounded_number_of_files(spark, tmp_path, days):
    """However long the history, the last day lies in one or two of its files."""
    rows = spark.range(days * 24 * 5).selectExpr(
        "timestamp_ntz'2024-01-01 06:00:00' + make_dt_interval(0, cast(id / 5 as int)) AS interval_start_utc",
        "concat('p', id % 5) AS settlement_point", "cast(id AS double) AS price_usd_per_mwh", "'x' AS regime")
    tables.write_clustered(rows, str(tmp_path), "da_prices", (S.INTERVAL, S.POINT), files=20)
    out = serving.stored_last_days(spark, str(tmp_path), "da_prices", "Etc/GMT+6")  # six hours behind all year
    assert len(out.inputFiles()) <= 3 and out.count() == 24 * 5
    manifest = tables.read_manifest(spark, str(tmp_path), "da_prices")
    assert manifest.count() == 20 and manifest.agg(F.sum("n_rows")).first()[0] == rows.count()
    assert tables.read_table(spark, str(tmp_path), "da_prices").count() == rows.count()
    tables.write_table(rows.limit(7), str(tmp_path), "da_prices")  # a plain table has no manifest
    assert tables.read_manifest(spark, str(tmp_path), "da_prices") is None
    assert tables.read_span(spark, str(tmp_path), "da_prices", S.INTERVAL).count() == 7


def test_span_without_rows(spark, tmp_path):
    from datetime import datetime

    rows = spark.sql("SELECT timestamp_ntz'2024-01-01 06:00:00' AS interval_start_utc, 'p' AS settlement_point, 1D AS price_usd_per_mwh, 'x' AS regime")
    tables.write_clustered(rows, str(tmp_path), "da_prices", (S.INTERVAL, S.POINT))
    assert tables.read_span(spark, str(tmp_path), "da_prices", S.INTERVAL, low=datetime(2025, 1, 1)).count() == 0
    assert tables.read_span(spark, str(tmp_path), "da_prices", S.INTERVAL, high=datetime(2025, 1, 1)).count() == 1
