"""Scan / sink behaviour, modelled on the reference's own two tests."""

import datetime as dt

import pandas as pd

from seatcast.sources import files
from seatcast.operators import joins


def test_combine_parquet_files_union(spark, tmp_path):
    pd.DataFrame({"A": [1, 2, 3], "B": [4, 5, 6]}).to_parquet(tmp_path / "file1.parquet")
    pd.DataFrame({"A": [7, 8, 9], "B": [10, 11, 12]}).to_parquet(tmp_path / "file2.parquet")
    out = files.scan_combine(spark, str(tmp_path)).toPandas().sort_values("A").reset_index(drop=True)
    exp = pd.DataFrame({"A": [1, 2, 3, 7, 8, 9], "B": [4, 5, 6, 10, 11, 12]})
    pd.testing.assert_frame_equal(out, exp)


def test_combine_nested_other_files_and_missing_columns(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    pd.DataFrame({"A": [1], "B": [2]}).to_parquet(tmp_path / "a" / "one.parquet")
    pd.DataFrame({"A": [3], "B": [4], "C": ["x"]}).to_parquet(tmp_path / "a" / "b" / "two.parquet")
    (tmp_path / "notes.txt").write_text("not a table")
    out = files.scan_combine(spark, str(tmp_path)).toPandas().sort_values("A").reset_index(drop=True)
    assert list(out["A"]) == [1, 3]
    assert out.loc[0, "C"] is None and out.loc[1, "C"] == "x"


def test_sink_then_read_equals(spark, tmp_path):
    df = spark.createDataFrame([(1, 4), (2, 5), (3, 6)], "A long, B long")
    path = files.sink_parquet(df, str(tmp_path / "combined"))
    back = spark.read.parquet(path).toPandas().sort_values("A").reset_index(drop=True)
    pd.testing.assert_frame_equal(back, df.toPandas())


def test_csv_roundtrip_with_schema(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), 3, 1.5)], "d date, n int, x double")
    path = files.sink_csv(df, str(tmp_path / "csv"))
    back = files.scan_csv_glob(spark, path + "/*.csv", df.schema)
    assert back.collect() == df.collect()


def test_standings_json_flatten_empty_and_ties(spark, tmp_path):
    from seatcast import schemas
    team = lambda n, p: {"teamName": {"default": n}, "points": p, "wins": 1, "losses": 0,
                         "otLosses": 0, "goalDifferential": 0, "goalFor": 1, "goalAgainst": 1}
    payload = spark.createDataFrame(
        [(dt.date(2024, 1, 1), [team("A", 10), team("B", 12), team("C", 10), team("D", 5)]),
         (dt.date(2024, 1, 8), [])], schemas.STANDINGS_JSON)
    path = files.sink_json(payload, str(tmp_path / "standings"))
    flat = joins.flatten_standings(files.read_standings_json(spark, path))
    assert flat.count() == 4  # the empty day gives no row
    ranks = {r["team_name"]: r["van_rank"] for r in
             __import__("seatcast.operators.features", fromlist=["x"]).rank_min_desc(
                 flat, "rank_date", "points", "van_rank").collect()}
    assert ranks == {"B": 1, "A": 2, "C": 2, "D": 4}
    home = joins.team_rank_by_date(flat, "C").collect()
    assert [(r["rank_date"], r["van_rank"]) for r in home] == [(dt.date(2024, 1, 1), 2)]


def test_earliest_date(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 1),), (dt.date(2023, 1, 5),)], "calculate_date date")
    assert files.earliest_date(df).first()[0] == dt.date(2023, 1, 5)


def test_headers_come_from_the_first_bytes(spark, tmp_path):
    import gzip
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b b.csv").write_text("y,x\n1,2\n")
    (tmp_path / "_hidden.csv").write_text("no\n")
    (tmp_path / "none.csv").write_text("")
    with gzip.open(tmp_path / "c.csv.gz", "wt") as f:
        f.write("x,y\n3,4\n")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    got = files.csv_headers(spark, str(tmp_path), "*.csv*")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before        # no job
    assert {k: len(v) for k, v in got.items()} == {"x,y": 2, "y,x": 1}
    from pyspark.sql import types as T
    rows = files.scan_csv_glob(spark, str(tmp_path / "*.csv*"), T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.IntegerType())]))
    assert sorted(map(tuple, rows.collect())) == [(1, 2), (2, 1), (3, 4)]


def test_earliest_stored_date_reads_footers_only(spark, tmp_path):
    spark.sql("SELECT id, date_add(DATE'2020-01-01', CAST(id AS INT)) AS calculate_date FROM range(5, 50)").write.parquet(str(tmp_path / "t"))
    got = files.earliest_stored_date(spark, str(tmp_path / "t"))
    assert str(got.first()["earliest_date"]) == "2020-01-06"
    assert "PushedAggregation: [MIN(calculate_date)]" in got._jdf.queryExecution().executedPlan().toString()
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_day_store_replaces_days_and_reads_only_recent_ones(spark, tmp_path):
    path, schema = str(tmp_path / "days"), "event string, calculate_date date, sold long"
    day = lambda n: dt.date(2020, 1, 31) + dt.timedelta(days=n)
    first = spark.createDataFrame([("a", day(n), n) for n in range(10)] + [("b", None, 99)], schema)
    files.append_days(first, path)
    files.append_days(spark.createDataFrame([("a", day(9), 70), ("c", day(9), 71), ("a", day(10), 80)], schema), path)
    read = lambda n: sorted((r["event"], r["sold"]) for r in files.recent_days(spark, path, first.schema, n).collect())
    assert read(1) == [("a", 80)]
    assert read(3) == [("a", 8), ("a", 70), ("a", 80), ("c", 71)]
    assert len(read(100)) == 12
    plan = files.recent_days(spark, path, first.schema)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(calculate_date" in plan


def test_checkpoint_folder_is_qualified_and_the_same_at_every_call(spark):
    from seatcast.session import ensure_checkpoint_dir
    first = ensure_checkpoint_dir(spark)
    assert "://" in first or first.startswith("file:/")
    assert ensure_checkpoint_dir(spark) == first


def test_event_text_is_filtered_by_group_and_not_by_line(spark, tmp_path):
    import datetime as dt

    from seatcast.plans import inputs as I
    from seatcast.sources import testdata as td
    lines = [(1, 1, float(q), 10.0 * q, 0.01, 0.02, "N", "O", dt.datetime(1999, 6, 10 + q % 2)) for q in range(1, 9)] + [
        (1, 1, 3.0, 30.0, 0.01, 0.02, "N", "O", None)]
    for name, rows, schema in [
            ("lineitem", lines, "l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, "
                                "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
            ("part", [(1, "Brand#12", 9.0)], "p_partkey long, p_brand string, p_retailprice double"),
            ("supplier", [(1, 1)], "s_suppkey long, s_nationkey int"),
            ("nation", [(1, 2)], "n_nationkey int, n_regionkey int"),
            ("region", [(2, "ASIA")], "r_regionkey int, r_name string")]:
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {r["calculate_date"]: r for r in td.snapshot(spark, str(tmp_path)).collect()}
    assert {d: (r["identifier"], r["pminventory"]) for d, r in got.items() if d} == {
        dt.date(1999, 6, 10): ("EVT_Wed_Jun_30_1999_2", 4), dt.date(1999, 6, 11): ("EVT_Wed_Jun_30_1999_2", 4)}
    assert got[None]["event_id"] is None and got[None]["identifier"] is None and got[None]["pminventory"] == 1
    rows = I.preprocessed(spark, str(tmp_path), training=False)
    assert rows.count() == 2
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Aggregate [", 1)
    assert "EVT_" in above and "EVT_" not in below          # neither in a filter nor in a join condition
