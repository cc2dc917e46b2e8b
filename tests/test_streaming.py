"""Daily drops are ingested exactly once across restarts."""

import datetime as dt

import pytest

from seatcast.sources import files
from seatcast.streaming import ingest_daily_drops
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("calculate_date", T.DateType()),
                       T.StructField("host_sold-yesterday", T.LongType())])


def test_ingest_daily_drops_once(spark, tmp_path):
    day1 = spark.createDataFrame([("e", dt.date(2024, 1, 1), 3)], SCHEMA)
    files.sink_csv(day1, str(tmp_path / "in" / "d1"))
    out, ck = str(tmp_path / "table"), str(tmp_path / "ck")
    ingest_daily_drops(spark, str(tmp_path / "in" / "*"), out, ck, SCHEMA)
    day2 = spark.createDataFrame([("e", dt.date(2024, 1, 2), 5)], SCHEMA)
    files.sink_csv(day2, str(tmp_path / "in" / "d2"))
    ingest_daily_drops(spark, str(tmp_path / "in" / "*"), out, ck, SCHEMA)   # restart: only the new file
    got = sorted((r["calculate_date"], r["host_sold_yesterday"]) for r in spark.read.parquet(out).collect())
    assert got == [(dt.date(2024, 1, 1), 3), (dt.date(2024, 1, 2), 5)]


def test_drops_unite_by_column_name(spark, tmp_path):
    drops = tmp_path / "in"
    drops.mkdir()
    (drops / "1.csv").write_text("event_id,calculate_date,host_sold-yesterday\na,2024-01-01,1\n")
    (drops / "2.csv").write_text("host_sold-yesterday,x,event_id\n20,left out,\"b, c\"\n\n30,,d\n")
    (drops / "empty.csv").write_text("")
    (drops / "notes.txt").write_text("not,a,drop\n")
    out = str(tmp_path / "table")
    ingest_daily_drops(spark, str(drops), out, str(tmp_path / "ck"), SCHEMA)
    got = sorted((r["event_id"], r["calculate_date"], r["host_sold_yesterday"]) for r in spark.read.parquet(out).collect())
    assert got == [("a", dt.date(2024, 1, 1), 1), ("b, c", None, 20), ("d", None, 30)]
    batch = files.scan_csv_glob(spark, str(drops / "*.csv"), SCHEMA).collect()
    assert sorted((r[0], r[1], r[2]) for r in batch) == got


def test_a_field_that_does_not_parse_stops_the_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_text("event_id,host_sold-yesterday\na,many\n")
    with pytest.raises(Exception):
        ingest_daily_drops(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "ck"), SCHEMA)
