"""Projection / filter edge cases (FIXTURES F2), pandas NULL semantics."""

import datetime as dt

from pyspark.sql import functions as F

from seatcast.operators import clean

from conftest import rows


def test_extract_event_date(spark):
    df = spark.createDataFrame([("A_Fri_Apr_19_2024_x",), ("A_Mon_Jan_1_2024_x",), ("no date here",),
                                ("A_Fri_Apr_19_2024",), (None,)], "identifier string")
    out = [r["event_date"] for r in clean.extract_event_date(df).collect()]
    assert out == [dt.date(2024, 4, 19), dt.date(2024, 1, 1), None, None, None]


def test_extract_opponent(spark):
    df = spark.createDataFrame([("Canucks vs. Oilers",), ("Canucks Open Practice",), ("Oilers vs. Flames",),
                                (None,)], "event_name string")
    out = [r["opponent"] for r in clean.extract_opponent(df, "Canucks").collect()]
    assert out == ["Oilers", "Canucks Open Practice", "Oilers vs. Flames", None]


def test_extract_price_code(spark):
    df = spark.createDataFrame([("Level 7",), ("PL V",), ("",), (None,)], "price_level_name string")
    assert [r["price_code"] for r in clean.extract_price_code(df).collect()] == ["7", "V", None, None]


def test_filters_null_semantics(spark):
    df = spark.createDataFrame(
        [(1, "Canucks vs. TBD", "V", dt.date(2022, 2, 15), -1),
         (2, None, None, None, None),
         (3, "Canucks vs. Jets", "A", dt.date(2022, 2, 16), 0),
         (4, "Canucks vs. Jets", "B", dt.date(2022, 9, 24), 5),
         (5, "Canucks vs. Jets", "C", dt.date(2022, 10, 8), 5),
         (6, "Canucks vs. Jets", "D", dt.date(2022, 10, 9), 5)],
        "id int, event_name string, price_code string, event_date date, host_sold_yesterday long")
    ids = lambda d: sorted(r["id"] for r in d.collect())
    assert ids(clean.filter_excluded_events(df)) == [2, 3, 4, 5, 6]
    assert ids(clean.filter_price_code(df)) == [2, 3, 4, 5, 6]
    assert ids(clean.filter_start_date(df, "2022-02-15")) == [3, 4, 5, 6]      # strict, NULL drops
    assert ids(clean.filter_preseason(df)) == [1, 2, 3, 6]                     # both ends drop, NULL stays
    assert ids(clean.filter_valid_sold(df)) == [3, 4, 5, 6]                    # -1 and NULL drop, 0 stays


def test_filter_lead_days(spark):
    ev = dt.date(2024, 3, 31)
    df = spark.createDataFrame([(ev, ev - dt.timedelta(days=30)), (ev, ev - dt.timedelta(days=31)),
                                (ev, ev + dt.timedelta(days=1))], "event_date date, calculate_date date")
    out = clean.filter_lead_days(df).select(F.datediff("event_date", "calculate_date").alias("d"))
    assert sorted(r["d"] for r in out.collect()) == [-1, 30]


def test_fill_initial_price(spark):
    df = spark.createDataFrame([(0.0, 50.0), (None, 50.0), (10.0, 50.0)], "last_price double, initial_price double")
    assert [r[0] for r in clean.fill_initial_price(df).collect()] == [50.0, None, 10.0]


def test_select_numeric_and_latest(spark):
    df = spark.createDataFrame([("a", 1, 2.0, dt.date(2024, 1, 1)), ("b", 2, 3.0, dt.date(2024, 1, 2)),
                                ("c", 3, 4.0, dt.date(2024, 1, 2))], "s string, i int, x double, calculate_date date")
    assert clean.select_numeric(df, drop=["x"]).columns == ["i"]
    assert rows(clean.latest_snapshot(df), "s") == [("b",), ("c",)]
