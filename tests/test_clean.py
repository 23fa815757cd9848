from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hours import hours_from
from wattspan import schemas as S
from wattspan.config import DEFAULT, Regime
from wattspan.functions.numeric import fahrenheit_to_celsius
from wattspan.operators import clean

HUB = "HB_HUBAVG"
ZONES = ("harbour", "plateau", "delta", "ridge", "basin")
RAW = "interval_start_utc timestamp_ntz, location string, spp double, arrival long"


def test_prices_keep_hub_first_reading_and_regime(spark):
    hours, spot = hours_from("2024-05-14 09:00", 4), (37.25, -12.5, 0.0, 8125.75)
    rows = [(h, HUB, p, i) for i, (h, p) in enumerate(zip(hours, spot))]
    rows += [(hours[2], HUB, 41.5, 17), (hours[3], "HB_WEST", 63.0, 18)]
    out = clean.clean_prices(spark.createDataFrame(rows, RAW), DEFAULT)
    assert out.schema.names == S.PRICES.names
    got = {r[0]: (r[2], r[3]) for r in out.collect()}
    assert got == {h: (p, "swcap5000") for h, p in zip(hours, spot)}


def test_unreadable_price_is_null(spark):
    raw = spark.createDataFrame(
        [(datetime(2024, 1, 1), HUB, "n/a", 1), (datetime(2024, 1, 1, 1), HUB, "12.5", 2)],
        RAW.replace("spp double", "spp string"),
    )
    got = sorted((r[0], r[2]) for r in clean.clean_prices(raw, DEFAULT).collect())
    assert got == [(datetime(2024, 1, 1), None), (datetime(2024, 1, 1, 1), 12.5)]


def test_regime_follows_the_local_date(spark):
    df = spark.createDataFrame([(datetime(2025, 12, 5, 5),), (datetime(2025, 12, 5, 6),)], "interval_start_utc timestamp_ntz")
    assert [r.regime for r in clean.tag_regime(df, DEFAULT.market).orderBy(S.INTERVAL).collect()] == ["swcap5000", "rtcb"]


def test_last_regime_wins_and_uncovered_fails(spark):
    df = spark.createDataFrame([(date(2024, 1, 5),), (date(2024, 2, 5),)], "d date")
    overlap = (Regime("a", None, None, 1, 1), Regime("b", date(2024, 2, 1), None, 1, 1))
    assert [r[0] for r in df.orderBy("d").select(clean.regime_of(F.col("d"), overlap)).collect()] == ["a", "b"]
    closed = (Regime("a", None, date(2024, 1, 31), 1, 1),)
    with pytest.raises(PySparkException, match="no regime covers 2024-02-05"):
        df.select(clean.regime_of(F.col("d"), closed)).collect()


def test_dedup_first_last_under_a_hot_key(spark):
    rows = spark.range(0, 30000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id", (F.col("id") * 2).alias("v")
    )
    first = clean.dedup(rows, ["k"], ["id"])
    last = clean.dedup(rows, ["k"], ["id"], "last")
    assert first.count() == last.count() == 20001
    assert first.where("k = 0").first()["v"] == 0
    assert last.where("k = 0").first()["v"] == 29997 * 2


def test_zone_mean_and_celsius(spark):
    schema = "interval_start_utc timestamp_ntz, publish_time_utc timestamp_ntz, arrival long, " + ", ".join(f"{z} double" for z in ZONES)
    pub, blank = datetime(2024, 8, 19), [None] * len(ZONES)
    first, second, third = hours_from("2024-08-20 15:00", 3)
    rows = [(first, pub, 1, 59.0, 68.0, 77.0, 86.0, 95.0), (second, pub, 2, 14.0, *blank[1:]), (third, pub, 3, *blank)]
    out = clean.clean_weather(spark.createDataFrame(rows, schema), DEFAULT).orderBy(S.INTERVAL).collect()
    assert [r[1] for r in out] == [25.0, -10.0, None]
    assert spark.range(1).select(fahrenheit_to_celsius(F.lit(-40.0))).first()[0] == -40.0


def test_vintage_rules(spark):
    at = datetime(2024, 7, 19, 16)  # local delivery day 2024-07-19, midnight 05:00Z
    schema = "interval_start_utc timestamp_ntz, publish_time_utc timestamp_ntz, z double, arrival long"

    def temp(*vintages):
        rows = [(at, p, f, i) for i, (p, f) in enumerate(vintages)]
        got = clean.clean_weather(spark.createDataFrame(rows, schema), DEFAULT).collect()
        return [round(r[1] * 9 / 5 + 32, 6) for r in got]

    early, late, after = datetime(2024, 7, 17, 22), datetime(2024, 7, 19, 5), datetime(2024, 7, 19, 5, 1)
    assert temp((late, 88.5), (early, 71.25)) == [88.5]
    assert temp((early, 71.25), (after, 102.0)) == [71.25]
    assert temp((after, 102.0)) == []
    assert temp((None, 95.0), (late, 88.5)) == [95.0]
    assert temp((late, 88.5), (late, 89.0)) == [89.0]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_to_utc_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(
            [("2024-03-10 03:30:00-05:00",), ("2024-03-10T08:30:00Z",), ("2024-03-10 08:30:00",)], "t string"
        )
        got = {r[0] for r in df.select(clean.to_utc(df, "t").cast("string")).collect()}
        assert got == {"2024-03-10 08:30:00"}
        ntz = spark.createDataFrame([(datetime(2024, 3, 10, 2, 30),)], "t timestamp_ntz")
        assert ntz.select(clean.to_utc(ntz, "t")).first()[0] == datetime(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_enforce_orders_casts_and_reports_missing(spark):
    df = spark.createDataFrame([("x", "1.5", datetime(2024, 1, 1), "p")], "regime string, price_usd_per_mwh string, interval_start_utc timestamp_ntz, settlement_point string")
    assert S.enforce(df, S.PRICES).schema.names == S.PRICES.names
    with pytest.raises(ValueError, match="regime"):
        S.enforce(df.drop("regime"), S.PRICES)


@pytest.mark.parametrize("zone", ["UTC", "America/Chicago", "America/New_York"])
def test_to_utc_keeps_instants_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["2023-11-05T06:30:00Z", "2023-11-05T07:30:00Z", "2023-11-05T01:30:00.250001-06:00", "2024-01-01 06:00:00"]
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        got = [r[0] for r in df.select(clean.to_utc(df, "t")).collect()]
        assert got == [datetime(2023, 11, 5, 6, 30), datetime(2023, 11, 5, 7, 30),
                       datetime(2023, 11, 5, 7, 30, 0, 250001), datetime(2024, 1, 1, 6)]
        micros = spark.range(1).select(F.timestamp_micros(F.lit(1_699_169_400_000_007)).alias("t"))
        assert micros.select(clean.to_utc(micros, "t")).first()[0] == datetime(2023, 11, 5, 7, 30, 0, 7)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_dedup_without_arrival_does_not_depend_on_partitions(spark):
    rows = [(1, 7, float(i), str(40 - i)) for i in range(40)]
    df = spark.createDataFrame(rows, "k int, retrieved_at_utc int, v double, w string")
    picks = {tuple(clean.dedup(df.repartition(n), ["k"], ["retrieved_at_utc"], carry=["v", "w"]).first()) for n in (1, 2, 5, 16)}
    assert picks == {(1, 0.0, "40")}
