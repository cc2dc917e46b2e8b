"""Feature columns and series windows, checked against brute force."""

import datetime as dt

import pandas as pd

from seatcast import constants as C
from seatcast.operators import features

from conftest import rows

D = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)


def _series(spark):
    # event e1/code A has a gap day (day 2 missing); e1/B is a one-day series
    data = [("e1", "A", D(0), 5), ("e1", "A", D(1), 3), ("e1", "A", D(3), 7), ("e1", "A", D(4), 2),
            ("e1", "B", D(0), 4), ("e2", "A", D(0), 1), ("e2", "A", D(1), -1), ("e2", "A", D(2), 6)]
    return spark.createDataFrame(data, "event_id string, price_code string, calculate_date date, host_sold_yesterday long")


def test_shift_target_training_and_serving(spark):
    df = _series(spark)
    train = rows(features.shift_target(df), "event_id", "price_code", "calculate_date", C.TARGET)
    assert train == sorted([("e1", "A", D(0), 3), ("e1", "A", D(1), 7), ("e1", "A", D(3), 2),
                            ("e2", "A", D(1), 6)], key=repr)
    serve = features.shift_target(df, drop_unlabelled=False)
    assert serve.count() == df.count()
    assert serve.where("event_id = 'e1' AND price_code = 'B'").first()[C.TARGET] is None


def test_lag_sales_row_based(spark):
    df = features.shift_target(_series(spark))
    out = features.lag_sales(df, 3).where("event_id = 'e1'").orderBy("calculate_date").collect()
    assert [r["tickets_sold_2_days_before_today"] for r in out] == [None, None, 3]
    assert [r["tickets_sold_3_days_before_today"] for r in out] == [None, None, None]


def test_sold_agg_day_sums_and_null_group(spark):
    df = spark.createDataFrame([("e", D(0), 1, 2), ("e", D(0), 0, 3), ("e", D(0), 1, None), ("e", D(1), 0, None)],
                               "event_id string, calculate_date date, bowl_location int, host_sold_yesterday long")
    out = rows(features.sold_agg_day(df), "calculate_date", "bowl_location", "host_sold_agg_last_day",
               "host_sold_agg_last_day_samebowl")
    assert out == sorted([(D(0), 1, 5, 2), (D(0), 0, 5, 3), (D(0), 1, 5, 2), (D(1), 0, 0, 0)], key=repr)


def test_code_lookups_and_ratios(spark):
    df = spark.createDataFrame([("6", 200.0, 10, 0), ("T", 100.0, 5, 10), ("W", 10.0, 1, 2), (None, 1.0, 1, 1)],
                               "price_code string, last_price double, pminventory long, cap long")
    out = features.add_inventory_normalized(features.add_price_floor_ratio(
        features.add_price_code_ordinal(features.add_bowl_location(df)))).collect()
    assert [r["price_code_ordinal"] for r in out] == [23, 23, None, None]
    assert [r["bowl_location"] for r in out] == [1, 0, 0, 0]
    assert [r["times_above_floor"] for r in out] == [2.0, 1.0, None, None]
    assert [r["inventory_normalized"] for r in out] == [None, 0.5, 0.5, 1.0]


def test_weekend_month_and_season(spark):
    df = spark.createDataFrame([(dt.date(2024, 4, 19),), (dt.date(2024, 4, 22),), (dt.date(2021, 1, 1),),
                                (dt.date(2022, 7, 1),)], "event_date date")
    out = features.add_season_label(features.add_weekend_month(df)).collect()
    assert [r["weekend_game"] for r in out] == [1, 0, 1, 1]
    assert [r["season"] for r in out] == ["2023-2024", "2023-2024", "2021-2022", "2022-2023"]


def _brute_sequences(pdf, feats, length):
    """The reference's loop: per opponent, sorted, last ``length`` rows."""
    out = {}
    for _, g in pdf.groupby("opponent"):
        g = g.sort_values(["calculate_date", "price_code_ordinal", "event_id", "price_code"], na_position="last")
        vals = g[feats].astype(float).values.tolist()
        keys = list(zip(g["event_id"], g["price_code"], g["calculate_date"]))
        for i, k in enumerate(keys):
            out[k] = vals[max(0, i - length + 1): i + 1]
    return out


def test_sequence_window_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    data = []
    for opp in ["X", "Y"]:
        for day in range(6):
            for ev in ["e1", "e2"]:
                for code, ordn in [("A", 15), ("B", 13), ("W", None)]:
                    if rnd.random() < 0.55:
                        data.append((ev, code, D(day), opp, ordn, rnd.randint(0, 9), rnd.random()))
    schema = "event_id string, price_code string, calculate_date date, opponent string, price_code_ordinal int, a long, b double"
    df = spark.createDataFrame(data, schema)
    got = {(r["event_id"], r["price_code"], r["calculate_date"]): r["sequence"]
           for r in features.sequence_window(df, ["a", "b"], length=3).collect()}
    exp = _brute_sequences(pd.DataFrame(data, columns=[c.split()[0] for c in schema.split(", ")]), ["a", "b"], 3)
    assert got.keys() == exp.keys()
    for k in exp:
        assert [list(map(float, s)) for s in got[k]] == exp[k], k


def test_pad_sequence(spark):
    df = spark.createDataFrame([([[1.0, 2.0]],), ([[1.0, 1.0], [2.0, 2.0], [3.0, 3.0]],)], "sequence array<array<double>>")
    out = [r["sequence"] for r in features.pad_sequence(df, "sequence", 2, width=2).collect()]
    assert out[0] == [[1.0, 2.0], [0.0, 0.0]]
    assert out[1] == [[2.0, 2.0], [3.0, 3.0]]
