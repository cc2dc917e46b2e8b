"""The library's inputs built from the driver's tables (see
``seatcast.sources.testdata``), with the parameters used by every registered
query.  Dates and team names are parameters, set here for the stand-in data."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession

from seatcast import constants as C
from seatcast.operators import joins
from seatcast.plans.pipelines import (FeatureParams, PreprocessParams, feature_engineer,
                                      latest_features, preprocess)
from seatcast.sources import testdata as td

PRE = PreprocessParams(
    start_date="1995-03-31",
    excluded_events=tuple(C.DEFAULT_EXCLUDED_EVENTS),
    preseason_ranges=(("1996-06-30", "1996-06-30"), ("1998-09-30", "1998-12-31")),
    home_prefix=td.HOME_PREFIX,
)
SERVE = PreprocessParams(**{**PRE.__dict__, "training": False})
FEAT = FeatureParams(web_prefix=td.HOME_PREFIX)
SPLIT_CUTOFF = "2000-07-01"



# Every input is a lazy plan: building it runs no job, and a query's own
# filters and columns reach the scans.
def snapshot(spark: SparkSession, d: str) -> DataFrame:
    return td.snapshot(spark, d)


def preprocessed(spark: SparkSession, d: str, training: bool = True) -> DataFrame:
    return preprocess(snapshot(spark, d), PRE if training else SERVE)


def popularity(spark: SparkSession, d: str) -> DataFrame:
    """The opponent-popularity dimension."""
    fans, social, aliases = td.team_rankings(spark, d)
    return joins.popularity_table(fans, social, aliases, rivals=td.RIVAL_TEAMS)


def standings(spark: SparkSession, d: str) -> DataFrame:
    """Flattened standings for the dates the rank source needs."""
    wanted = joins.dates_to_fetch(preprocessed(spark, d))
    return joins.flatten_standings(td.standings_payload(spark, d, wanted))


def ranks(spark: SparkSession, d: str) -> DataFrame:
    return joins.team_rank_by_date(standings(spark, d), td.HOME_TEAM)


def web(spark: SparkSession, d: str) -> DataFrame:
    return td.web_analytics(spark, d)


def featured(spark: SparkSession, d: str, training: bool = True) -> DataFrame:
    return feature_engineer(preprocessed(spark, d, training), popularity(spark, d), ranks(spark, d), web(spark, d), FEAT)


def latest(spark: SparkSession, d: str) -> DataFrame:
    """Serving features of the last day (see ``pipelines.latest_features``)."""
    return latest_features(snapshot(spark, d), popularity(spark, d), ranks(spark, d), web(spark, d), SERVE, FEAT)
