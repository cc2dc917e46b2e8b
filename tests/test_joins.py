"""Joins with dimensions: fill semantics, popularity, web analytics, dates."""

import datetime as dt

from pyspark.sql import functions as F

from seatcast.operators import joins

from conftest import rows

D = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_ranking_fill_reference_semantics(spark):
    facts = spark.createDataFrame([(D(i),) for i in [0, 1, 3, 5, 6, 9]], "calculate_date date")
    # rank on day 2 has no fact on that day: it must not propagate
    ranks = spark.createDataFrame([(D(2), 7), (D(3), 4), (D(6), 9)], "rank_date date, van_rank int")
    got = dict(rows(joins.join_ranking_asof(facts, ranks), "calculate_date", "van_rank"))
    assert got == {D(0): 4, D(1): 4, D(3): 4, D(5): 4, D(6): 9, D(9): 9}


def test_ranking_asof_mode(spark):
    facts = spark.createDataFrame([(D(i),) for i in [0, 2, 3, 7]], "calculate_date date")
    ranks = spark.createDataFrame([(D(2), 7), (D(5), 4)], "rank_date date, van_rank int")
    got = dict(rows(joins.join_ranking_asof(facts, ranks, mode="asof"), "calculate_date", "van_rank"))
    assert got == {D(0): None, D(2): 7, D(3): 7, D(7): 4}


def test_join_popularity_missing_is_minus_one(spark):
    df = spark.createDataFrame([("Oilers",), ("Nobody",), (None,)], "opponent string")
    pop = spark.createDataFrame([("Edmonton Oilers", "Oilers", 1)], "team string, data_name string, opponent_rank int")
    got = rows(joins.join_popularity(df, pop), "opponent", "data_name", "opponent_rank")
    assert got == sorted([("Oilers", "Oilers", 1), ("Nobody", None, -1), (None, None, -1)], key=repr)


def test_web_analytics_dedup_prefix_and_asof(spark):
    web = spark.createDataFrame(
        [("Canucks vs. A", D(10), D(5), 3, 1, 2), ("Canucks vs. A", D(10), D(5), 8, 0, 1),
         ("Concert", D(10), D(6), 99, 99, 99), ("Canucks vs. A", D(10), D(11), 5, 5, 5)],
        "Event_Name string, Event_Date date, as_of_date date, unique_views long, order_qty long, tkt_qty long")
    fact = spark.createDataFrame([(D(10), D(5)), (D(10), D(6)), (D(10), D(11))], "event_date date, calculate_date date")
    got = rows(joins.join_web_analytics(fact, web, "Canucks"), "calculate_date", "unique_views", "order_qty", "tkt_qty")
    assert got == sorted([(D(5), 8, 1, 2), (D(6), None, None, None), (D(11), None, None, None)], key=repr)
    assert "event_date" in joins.join_web_analytics(fact, web, "Canucks").columns


def test_dates_to_fetch(spark):
    # 2024-01-01 is a Monday
    fact = spark.createDataFrame([(D(i),) for i in [-2, 0, 1, 7, 14]], "calculate_date date")
    stored = spark.createDataFrame([(D(7),)], "rank_date date")
    got = sorted(r[0] for r in joins.dates_to_fetch(fact, stored).collect())
    assert got == [D(-2), D(0), D(14)]


# --- fixed values: the two published 31-team rankings and their golden tercile output
FANS = ["Chicago Blackhawks", "Boston Bruins", "Pittsburgh Penguins", "Detroit Red Wings",
        "Montreal Canadiens", "New York Rangers", "Toronto Maple Leafs", "Philadelphia Flyers",
        "Los Angeles Kings", "San Jose Sharks", "Washington Capitals", "Colorado Avalanche", "St. Louis Blues",
        "Minnesota Wild", "Tampa Bay Lightning", "Edmonton Oilers", "Buffalo Sabres", "Dallas Stars",
        "New Jersey Devils", "Nashville Predators", "Vegas Golden Knights", "Anaheim Ducks", "Winnipeg Jets",
        "Calgary Flames", "Ottawa Senators", "Columbus Blue Jackets", "New York Islanders",
        "Carolina Hurricanes", "Arizona Coyotes", "Florida Panthers", "Seattle Kraken"]
SOCIAL_TEAMS = ["Anaheim Ducks", "Arizona Coyotes", "Boston Bruins", "Buffalo Sabres", "Calgary Flames",
                "Carolina Hurricanes", "Chicago Blackhawks", "Colorado Avalanche", "Columbus Blue Jackets",
                "Dallas Stars", "Detroit Red Wings", "Edmonton Oilers", "Florida Panthers", "Los Angeles Kings",
                "Minnesota Wild", "Montreal Canadiens", "Nashville Predators", "New Jersey Devils",
                "New York Islanders", "New York Rangers", "Ottawa Senators", "Philadelphia Flyers",
                "Pittsburgh Penguins", "San Jose Sharks", "Seattle Kraken", "St. Louis Blues",
                "Tampa Bay Lightning", "Toronto Maple Leafs", "Vegas Golden Knights", "Washington Capitals",
                "Winnipeg Jets"]
SOCIAL_RANKS = [26, 31, 5, 22, 25, 23, 1, 11, 29, 13, 6, 10, 32, 17, 16, 4, 27, 18, 27, 6, 30, 11, 3, 14, 21, 19,
                15, 2, 20, 9, 24]
GOLDEN_RANK_1 = ["Chicago Blackhawks", "Pittsburgh Penguins", "Boston Bruins", "Montreal Canadiens",
                 "Toronto Maple Leafs", "Detroit Red Wings", "New York Rangers", "Philadelphia Flyers",
                 "Washington Capitals", "Colorado Avalanche", "Calgary Flames", "Edmonton Oilers"]
GOLDEN_RANK_2 = ["Vegas Golden Knights", "Buffalo Sabres", "New Jersey Devils", "St. Louis Blues", "Dallas Stars",
                 "Tampa Bay Lightning", "Minnesota Wild", "Los Angeles Kings", "San Jose Sharks"]
RIVALS = ["Edmonton Oilers", "Calgary Flames"]


def test_popularity_terciles_match_published_table(spark):
    fans = spark.createDataFrame([(t, i + 1) for i, t in enumerate(FANS)], "team string, ranking int")
    social = spark.createDataFrame(list(zip(SOCIAL_TEAMS, SOCIAL_RANKS)), "team string, ranking int")
    aliases = spark.createDataFrame([(t, t.split()[-1]) for t in FANS], "team string, data_name string")
    pop = {r["team"]: r["opponent_rank"] for r in joins.popularity_table(fans, social, aliases, RIVALS).collect()}
    assert len(pop) == 31
    assert sorted(t for t, r in pop.items() if r == 1) == sorted(GOLDEN_RANK_1)
    assert sorted(t for t, r in pop.items() if r == 2) == sorted(GOLDEN_RANK_2)
    assert all(r == 3 for t, r in pop.items() if t not in GOLDEN_RANK_1 + GOLDEN_RANK_2)


def test_union_append_keeps_stored(spark):
    old = spark.createDataFrame([(D(0), 5)], "rank_date date, van_rank int")
    new = spark.createDataFrame([(D(0), 9), (D(7), 3)], "rank_date date, van_rank int")
    assert rows(joins.union_append(old, new)) == [(D(0), 5), (D(7), 3)]
