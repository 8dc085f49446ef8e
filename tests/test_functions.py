from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from wardbook.functions import clock, codes, predicates, text

AS_OF = date(2024, 1, 20)


def one(spark, column, schema="x int", value=0):
    return spark.createDataFrame([(value,)], schema).select(column.alias("v")).first()["v"]


def each(spark, values, schema, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r["v"] for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def test_hhmm_of_every_length(spark):
    values = [5, 45, 930, 1430, 0, 2359, 2400, 1260, -1, None]
    assert each(spark, values, "x int", clock.hhmm_to_time("x")) == [
        "00:05:00", "00:45:00", "09:30:00", "14:30:00", "00:00:00", "23:59:00", None, None, None, None,
    ]
    assert each(spark, [5, 45, 930, 1430, None], "x int", clock.hhmm_pad("x")) == ["0005", "0045", "0930", "1430", None]


def test_packed_dates(spark):
    days = [date(2024, 1, 9), date(2009, 12, 31), None]
    assert each(spark, days, "x date", clock.yymmdd("x")) == [240109, 91231, None]
    assert each(spark, [240109, 91231, 241399, None], "x int", clock.from_yymmdd("x")) == [
        date(2024, 1, 9), date(2009, 12, 31), None, None,
    ]


def test_windows_on_timestamps(spark):
    stamps = [
        datetime(2024, 1, 18, 23, 59, 59),
        datetime(2024, 1, 19),
        datetime(2024, 1, 19, 23, 59, 30),
        datetime(2024, 1, 20),
        datetime(2024, 1, 20, 0, 0, 1),
    ]
    assert each(spark, stamps, "x timestamp_ntz", clock.on_day("x", AS_OF, 1)) == [False, True, True, False, False]
    assert each(spark, stamps, "x timestamp_ntz", clock.between_days("x", AS_OF, 1)) == [False, True, True, True, False]
    assert each(spark, stamps, "x timestamp_ntz", clock.since("x", AS_OF)) == [False, False, False, True, True]
    late = [datetime(2024, 1, 1, 16), datetime(2024, 1, 1, 16, 0, 1)]
    assert each(spark, late, "x timestamp_ntz", clock.time_after("x", "16:00:00")) == [False, True]


def test_months(spark):
    assert one(spark, clock.month_start(AS_OF)) == date(2024, 1, 1)
    assert one(spark, clock.month_start(AS_OF, 1)) == date(2023, 12, 1)
    assert one(spark, clock.month_start(AS_OF, 15)) == date(2022, 10, 1)
    assert one(spark, clock.month_end(date(2024, 1, 10), 16)) == date(2023, 12, 31)


def test_sentinel_date(spark):
    df = spark.sql("SELECT DATE'0001-01-01' AS out, DATE'2024-01-05' AS day UNION ALL SELECT DATE'2024-01-08', DATE'2024-01-05'")
    got = df.select(
        predicates.not_discharged("out").alias("in"),
        clock.los_days("day", "out").alias("stay"),
        clock.los_days("day", "out", raw=True).alias("raw"),
    ).collect()
    assert [(r["in"], r["stay"]) for r in got] == [(True, None), (False, 3)]
    assert got[0]["raw"] < -738_000


def test_durations(spark):
    start, stop = datetime(2024, 1, 1, 8), datetime(2024, 1, 1, 18, 5, 59)
    later = [datetime(2024, 1, 5, 12), datetime(2024, 1, 5, 13), datetime(2024, 1, 1, 7, 50), start, datetime(2024, 3, 1)]
    df = spark.createDataFrame([(start, stop), (start, None), (None, stop), *[(start, x) for x in later]], "a timestamp_ntz, b timestamp_ntz")
    hours, minutes = clock.duration_parts("a", "b")
    assert [tuple(r) for r in df.select(hours, minutes).collect()] == [
        ("10", "05"), (None, None), (None, None), ("100", "00"), ("101", "00"), (None, None), ("00", "00"), ("1432", "00"),
    ]


def test_packed_dates(spark):
    values = ["240119", "40119", "2401191", "991399", "", "x", None]
    want = [date(2024, 1, 19), date(2004, 1, 19), None, None, None, None, None]
    assert each(spark, values, "x string", clock.from_yymmdd("x")) == want
    assert each(spark, [240119, 2401191], "x int", clock.from_yymmdd("x")) == want[:1] + [None]


def test_rendering(spark):
    at = datetime(2024, 3, 4, 5, 6, 7)
    assert one(spark, clock.iso_z("x"), "x timestamp_ntz", at) == "2024-03-04T05:06:07Z"
    assert one(spark, clock.us_date("x"), "x timestamp_ntz", at) == "03/04/2024"
    assert one(spark, clock.time_of("x"), "x timestamp_ntz", at) == "05:06:07"


@pytest.mark.parametrize(("value", "want"), [(0.5, "0"), (1.5, "2"), (2.5, "2"), (-0.5, "0"), (1234567890123.4, "1234567890123"), (None, None)])
def test_floats_without_decimals_round_half_to_even(spark, value, want):
    assert one(spark, text.whole_number_text("x"), "x double", value) == want


def test_top_code_compares_numbers(spark):
    assert each(spark, [89, 90, 91, 100, None], "x int", text.top_code("x", 90)) == ["89", "90", "90+", "90+", None]


def test_text(spark):
    assert one(spark, text.dash(F.lit("12"), F.lit("A"))) == "12-A"
    assert one(spark, text.dash(F.lit("12"), F.lit(None))) is None
    assert one(spark, text.nth_part("x", "{", 1), "x string", "DOE{signed") == "DOE"
    assert one(spark, text.nth_part("x", "{", 1), "x string", "DOE") == "DOE"
    assert each(spark, [0, 7, None], "x long", text.zero_to_null("x")) == [None, 7, None]
    assert each(spark, ["12", "", "x1", None], "x string", text.to_long("x")) == [12, None, None, None]


def test_predicates(spark):
    assert each(spark, ["CCU", "CCU ", "", "  ", None], "x string", predicates.present("x")) == [True, True, False, False, False]
    values = ["HIP ARTHROPLASTY", "HERNIA", None]
    assert each(spark, values, "x string", predicates.contains_any("x", ["ARTHRO", "COLON"])) == [True, False, None]
    assert one(spark, predicates.contains_any("x", []), "x string", "a") is False


def test_codes(spark):
    assert each(spark, ["CCU", "XX", None], "x string", codes.map_codes("x", {"CCU": "ICU 3"}, "other")) == ["ICU 3", "other", "other"]
    assert each(spark, [9, 3, 7], "x int", codes.map_codes("x", {9: "C", 3: "CC"})) == ["C", "CC", None]
    rules = [("CCU", "CCU"), ("PCU", "PCU")]
    assert each(spark, ["CCU ", "PCU", "X", None], "x string", codes.bucket("x", rules, "SSU")) == ["CCU", "PCU", "SSU", "SSU"]
    values = ["NOT DETECTED   ", "POSITIVE", None]
    assert each(spark, values, "x string", codes.normalise("x", {"NOT DETECTED": "NEGATIVE"})) == ["NEGATIVE", "POSITIVE", None]


def test_and_binds_tighter_than_or(spark):
    df = spark.createDataFrame([(1, 0, 0), (0, 1, 1), (0, 1, 0), (0, 0, 1)], "a int, b int, c int")
    branch = predicates.any_of(F.col("a") == 1, (F.col("b") == 1) & (F.col("c") == 1))
    assert df.where(branch).count() == df.where("a = 1 OR b = 1 AND c = 1").count() == 2
