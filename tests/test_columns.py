"""Column builders on literal values, every mode."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ontime.functions import columns as c
from ontime.functions.packed import MISSING_CODES, decode_packed


def one(spark, column, **values):
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return frame.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("hhmm", "expected"),
    [(5, datetime(2024, 3, 1, 0, 5)), (1250, datetime(2024, 3, 1, 12, 50)), (2400, None), (1275, None), (None, None)],
)
def test_hhmm_timestamp(spark, hhmm, expected):
    column = c.hhmm_timestamp(F.lit("2024-03-01"), F.lit(hhmm).cast("int"))
    assert one(spark, column, a=1) == expected


@pytest.mark.parametrize(
    ("hhmm", "mode", "hour"),
    [(1250, "round", 13), (1249, "round", 12), (2350, "round", 24), (1250, "floor", 12), (2359, "floor", 23)],
)
def test_hhmm_hour(spark, hhmm, mode, hour):
    assert one(spark, c.hhmm_hour("h", mode), h=hhmm) == hour


def test_unknown_modes_are_rejected():
    for call in (
        lambda: c.hhmm_hour(F.lit(1), "up"),
        lambda: c.roll_overnight(F.lit(1), F.lit(1), "week"),
        lambda: c.trip_status(F.lit(1), F.lit(1), F.lit(1), "x"),
        lambda: c.estimated_clock(F.lit(1), F.lit(1), "up"),
    ):
        with pytest.raises(ValueError):
            call()


def test_block_hour_and_bad_text(spark):
    assert one(spark, c.block_hour("b"), b="0700-0759") == 7
    assert one(spark, c.block_hour("b"), b="late") is None


def test_names(spark):
    assert one(spark, c.route("a", "b"), a="SFO", b="JFK") == "SFO-JFK"
    assert one(spark, c.carrier_number("a", "b"), a="UA", b=17) == "UA_17"
    assert one(spark, c.trip_id("a", "b"), a="SFO-JFK", b="2024-03-01") == "SFO-JFK_2024-03-01"
    assert one(spark, c.city_of("a"), a="New York, NY") == "New York"
    assert one(spark, c.city_of("a"), a="Nowhere") == "Nowhere"


@pytest.mark.parametrize(("value", "flag"), [("0.0", 0), ("1", 1), (1.0, 1), (0, 0), ("x", None)])
def test_delay15_keeps_flags_numeric(spark, value, flag):
    assert one(spark, c.delay15("f"), f=value) == flag


DEP, ARR = datetime(2024, 1, 31, 23), datetime(2024, 1, 31, 1)


@pytest.mark.parametrize(
    ("arr", "mode", "expected"),
    [
        (ARR, "keep_hour", datetime(2024, 2, 1, 1)),
        (ARR, "midnight", datetime(2024, 2, 1, 0)),
        (DEP, "keep_hour", datetime(2024, 2, 1, 23)),
        (datetime(2024, 2, 1, 0), "keep_hour", datetime(2024, 2, 1, 0)),
    ],
)
def test_roll_overnight(spark, arr, mode, expected):
    assert one(spark, c.roll_overnight("a", "d", mode), a=arr, d=DEP) == expected


def test_roll_by_exact_times_keeps_a_trip_within_one_hour(spark):
    column = c.roll_overnight("a", "d", exact=("a_ts", "d_ts"))
    times = {"a_ts": datetime(2024, 1, 1, 5, 50), "d_ts": datetime(2024, 1, 1, 5, 10)}
    assert one(spark, column, a=datetime(2024, 1, 1, 5), d=datetime(2024, 1, 1, 5), **times) == datetime(2024, 1, 1, 5)


@pytest.mark.parametrize("call_sign", ["KJFK ", "KJFK", " KJFK"])
def test_station_code(spark, call_sign):
    assert one(spark, c.station_code("s"), s=call_sign) == "JFK"


@pytest.mark.parametrize(
    ("minutes", "level"), [(None, 0), (float("nan"), 0), (5.0, 0), (5.5, 1), (45.0, 1), (45.1, 2), (-3.0, 0)]
)
def test_delay_level(spark, minutes, level):
    assert one(spark, c.delay_level(F.lit(minutes).cast("double")), a=1) == level


NOW = datetime(2024, 1, 1, 12)
EARLY, LATE = datetime(2024, 1, 1, 8), datetime(2024, 1, 1, 20)


@pytest.mark.parametrize(
    ("dep", "arr", "reference", "by_clock"),
    [
        (LATE, LATE, "Landed", "Scheduled"),
        (EARLY, LATE, "Landed", "En Route"),
        (EARLY, EARLY, "En Route", "Landed"),
        (LATE, EARLY, "Scheduled", "Scheduled"),
        (NOW, EARLY, None, "Landed"),
        (EARLY, NOW, "Landed", "Landed"),
    ],
)
def test_trip_status(spark, dep, arr, reference, by_clock):
    assert one(spark, c.trip_status("d", "a", NOW), d=dep, a=arr) == reference
    assert one(spark, c.trip_status("d", "a", NOW, "clock"), d=dep, a=arr) == by_clock


def test_estimated_clock(spark):
    late = datetime(2024, 1, 1, 23, 50)
    assert one(spark, c.estimated_clock("t", "m"), t=late, m=10.9) == "00:00"
    assert one(spark, c.estimated_clock("t", "m"), t=late, m=-0.5) == "23:49"
    assert one(spark, c.estimated_clock("t", "m", "half_even"), t=late, m=0.5) == "23:50"
    assert one(spark, c.estimated_clock("t", "m", "half_even"), t=late, m=1.5) == "23:52"
    assert one(spark, c.estimated_clock("t", F.lit(None).cast("double")), t=late) is None


def test_time_text_and_time_of_day(spark):
    moment = datetime(2024, 5, 6, 7, 8, 9)
    assert one(spark, c.minute_text("t"), t=moment) == "2024-05-06 07:08"
    assert one(spark, c.at_time_of_day(F.lit("2024-01-02"), "t"), t=moment) == datetime(2024, 1, 2, 7, 8, 9)


def test_lookup_and_run_id(spark):
    assert one(spark, c.lookup("k", {"a": "A"}), k="a") == "A"
    assert one(spark, c.lookup("k", {"a": "A"}), k="z") is None
    assert one(spark, c.lookup("k", {"a": "A"}, keep_unknown=True), k="z") == "z"
    first, again = (one(spark, c.run_id("k", "n"), k="a", n=3) for _ in range(2))
    assert first == again and len(first) == 10
    assert one(spark, c.run_id("k", "n"), k="a", n=4) != first


WEATHER = {"tmp": "+0250,1", "wnd": "180,1,N,0046,1", "vis": "016000,1,N,1", "dew": "-0010,1", "slp": "10132,1"}


@pytest.mark.parametrize(("aa1", "rate"), [("02,0040,9,5", 2.0), ("00,0040,9,5", None), ("", None), (None, None)])
def test_decode_packed(spark, aa1, rate):
    frame = spark.createDataFrame([(*WEATHER.values(), aa1)], ", ".join(f"{k} string" for k in (*WEATHER, "aa1")))
    row = decode_packed(frame).first()
    assert row["temp_f"] == pytest.approx(77.0)
    assert row["dew_pt_f"] == pytest.approx(30.2)
    assert (row["wnd_mps"], row["vis_m"], row["slp_hpa"]) == pytest.approx((4.6, 16000.0, 1013.2))
    assert (row["wnd_2"], row["wnd_4"], row["temp_qual"]) == ("N", "1", "1")
    assert row["precip_mm"] == rate


def test_missing_codes_are_kept_unless_named(spark):
    frame = spark.createDataFrame([("+9999,9", *list(WEATHER.values())[1:], "")],
                                  ", ".join(f"{k} string" for k in (*WEATHER, "aa1")))
    assert decode_packed(frame).first()["temp_f"] == pytest.approx(9999 * 9 / 50 + 32)
    assert decode_packed(frame, missing_codes=MISSING_CODES).first()["temp_f"] is None
