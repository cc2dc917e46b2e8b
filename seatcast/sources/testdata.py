"""Stand-in inputs derived from the driver's TPC-H-like tables.

The library's real inputs are daily ticket snapshots and four small
dimensions.  For tests and the benchmark the same shapes are derived here,
with Spark, from ``lineitem part supplier nation region orders customer
events`` so that every registered query reads the given tables and its work
grows with them.  ``seatcast.plans.oracle`` holds the same derivations as
DuckDB SQL.

Mapping (one row per event x price level x day):

* event = (region, quarter of ship date); ``event_date`` = last day of the
  quarter; ``calculate_date`` = ship date.
* price code from the part brand number k: ``0..9`` for k <= 10, ``K..Y``
  above (covers V, ties, unmapped W/X/Y, both bowls).
* measures are aggregates of the lines of the group, so the grain is unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOME_PREFIX = "Home"
HOME_TEAM = "Team AMERICA"
RIVAL_TEAMS = ["Team ASIA"]
TEST_EVENT = "Test Event - DO NOT PURCHASE"
WEB_DAY_SHIFT = 9000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _region_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation -> region map; 25 rows by the TPC-H spec, so a broadcast is safe."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return F.broadcast(nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
                       .select("n_nationkey", "r_regionkey", "r_name"))


EXTRA_MEASURES = [
    "ticket_sold_last_7days", "ticket_sold_yesterday", "host_sold_last_7days", "resale_sold_2_days_ago",
    "resale_sold_last_7days", "resale_asp_2_days_ago", "resale_asp_last_7days", "resale_asp_total",
    "median_posting_price", "posting_below_cp", "prp_currentprice", "prp_forwardtix", "prp_forwardrev"]


def _sum_if(cond: Column, value: Column | str) -> Column:
    return F.sum(F.when(cond, F.col(value) if isinstance(value, str) else value).otherwise(0)).cast("bigint")


def quarter_end(d: Column) -> Column:
    return F.last_day(F.add_months(F.trunc(d, "quarter"), 2))


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table ``snapshot`` (FIXTURES F2 columns that the data can give)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice")
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # supplier joins the lines directly, so Spark's size check sees the plain
    # supplier scan (broadcast while small, shuffle join beyond); the 25-row
    # nation -> region map is broadcast last.
    lines = (li.join(part, li.l_partkey == part.p_partkey)
               .join(supp, li.l_suppkey == supp.s_suppkey)
               .join(_region_dim(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")))

    k = F.substring_index("p_brand", "#", -1).cast("int")
    calc = F.to_date("l_shipdate")
    qty = F.col("l_quantity").cast("bigint")
    unit_price = F.col("l_extendedprice") / F.col("l_quantity")
    lines = lines.select(
        "r_regionkey", "r_name",
        calc.alias("calculate_date"),
        F.when(k <= 10, F.expr("chr(47 + cast(substring_index(p_brand, '#', -1) as int))"))
         .otherwise(F.expr("chr(64 + cast(substring_index(p_brand, '#', -1) as int))"))
         .alias("code"),
        qty.alias("qty"),
        F.when(F.col("l_returnflag") == "R", -qty).otherwise(qty).alias("signed_qty"),
        "l_returnflag", "l_linestatus", "l_discount", "l_tax", "l_extendedprice", "p_retailprice",
        unit_price.alias("unit_price"))

    # The names and dates of an event are text made from the group's day.  Made
    # from a grouping column, Spark would push every filter on them below the
    # aggregate, and format, match and parse that text once a line and filter;
    # ``day`` is the same date as an aggregate, which keeps that work to the groups.
    resale = F.col("l_returnflag") == "A"
    g = lines.groupBy("r_regionkey", "r_name", "calculate_date", "code").agg(
        F.max("calculate_date").alias("day"),
        F.sum("qty").alias("cap"),
        F.count(F.lit(1)).alias("pminventory"),
        F.sum(F.when(F.col("l_linestatus") == "O", F.col("qty")).otherwise(0)).alias("opens"),
        F.sum(F.when(F.col("l_tax") == 0, 1).otherwise(0)).cast("bigint").alias("holds"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("revenue_to_date"),
        (F.sum(F.col("l_discount").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1)))
        .alias("st_rate"),
        F.max("p_retailprice").alias("initial_price"),
        F.when(F.min("l_discount") == 0, F.lit(0.0)).otherwise(F.max("unit_price")).alias("last_price"),
        F.sum(F.when(F.col("l_returnflag") != "R", F.col("qty")).otherwise(0)).alias("ticket_sold_total"),
        F.sum(F.when(F.col("l_returnflag") == "N", F.col("qty")).otherwise(0)).alias("host_sold_total"),
        F.sum("signed_qty").alias("host_sold_yesterday"),
        F.sum(F.when(F.col("l_discount") <= 0.02, F.col("qty")).otherwise(0))
        .alias("host_sold_at_current_price"),
        F.sum(F.when(F.col("l_returnflag") == "A", F.col("qty")).otherwise(0)).alias("resale_sold_total"),
        F.sum(F.when(F.col("l_linestatus") == "F", 1).otherwise(0)).cast("bigint")
        .alias("number_of_postings"),
        F.min("unit_price").alias("lowest_post_price"),
        F.max("unit_price").alias("highest_post_price"),
        _sum_if(F.col("l_discount") <= 0.05, "qty").alias("ticket_sold_last_7days"),
        _sum_if(F.col("l_discount") <= 0.01, "qty").alias("ticket_sold_yesterday"),
        _sum_if((F.col("l_returnflag") == "N") & (F.col("l_discount") <= 0.05), "qty").alias("host_sold_last_7days"),
        _sum_if(resale & (F.col("l_tax") <= 0.02), "qty").alias("resale_sold_2_days_ago"),
        _sum_if(resale & (F.col("l_tax") <= 0.06), "qty").alias("resale_sold_last_7days"),
        F.max(F.when(resale & (F.col("l_tax") <= 0.02), F.col("unit_price"))).alias("resale_asp_2_days_ago"),
        F.max(F.when(resale & (F.col("l_tax") <= 0.06), F.col("unit_price"))).alias("resale_asp_last_7days"),
        F.max(F.when(resale, F.col("unit_price"))).alias("resale_asp_total"),
        ((F.min("unit_price") + F.max("unit_price")) / 2).alias("median_posting_price"),
        _sum_if(F.col("unit_price") < F.col("p_retailprice"), F.lit(1)).alias("posting_below_cp"),
        F.min("p_retailprice").alias("prp_currentprice"),
        _sum_if(F.col("l_tax") > 0.06, "qty").cast("double").alias("prp_forwardtix"),
        F.sum(F.when(F.col("l_tax") > 0.06, F.col("l_extendedprice").cast("decimal(18,2)")).otherwise(0))
        .cast("double").alias("prp_forwardrev"),
    )

    ev_date = quarter_end(F.col("day"))
    yr, q = F.year(F.trunc("day", "quarter")), F.quarter("day")
    rk = F.col("r_regionkey").cast("string")
    event_id = F.concat(F.regexp_replace("r_name", " ", "_"), F.lit("-"), yr.cast("string"), F.lit("Q"), q.cast("string"))
    return g.select(
        event_id.alias("event_id"),
        F.when((yr == 1996) & (q == 1), F.lit(TEST_EVENT))
         .when(F.col("r_regionkey") == 4, F.concat("r_name", F.lit(" Showcase")))
         .when(F.col("r_regionkey") == 3, F.concat(F.lit(HOME_PREFIX + " "), "r_name"))
         .otherwise(F.concat(F.lit(HOME_PREFIX + " vs. "), "r_name")).alias("event_name"),
        F.when((yr == 1997) & (q == 2), F.concat(F.lit("EVT_TBD_"), rk))
         .otherwise(F.concat(F.lit("EVT_"), F.date_format(ev_date, "E_MMM_d_yyyy"), F.lit("_"), rk))
         .alias("identifier"),
        F.concat(F.lit("Level "), "code").alias("price_level_name"),
        "calculate_date", "cap", "pminventory", "opens", "holds", "revenue_to_date", "st_rate",
        "initial_price", "last_price", F.col("ticket_sold_total").cast("double").alias("ticket_sold_total"),
        "host_sold_total", "host_sold_yesterday",
        "host_sold_at_current_price", "resale_sold_total", "number_of_postings",
        "lowest_post_price", "highest_post_price", *EXTRA_MEASURES,
        # housekeeping columns of the export, which the training pipeline drops
        F.lit("Arena").alias("venue"), F.col("opens").alias("platinum_opens"),
        F.col("median_posting_price").alias("platinum_average_open_price"),
        F.col("lowest_post_price").alias("platinum_lowest_open_price"),
        F.col("highest_post_price").alias("platinum_highest_open_price"), F.col("holds").alias("platinum_holds"),
        F.md5(F.concat(event_id, F.lit("|"), F.col("code")).cast("binary")).alias("dl_rowhash"),
        F.lit(1).alias("dl_iscurrent"), F.lit(0).alias("dl_isdeleted"),
        F.col("calculate_date").alias("dl_recordstartdateutc"),
        F.date_add("calculate_date", 1).alias("dl_recordenddateutc"),
        rk.alias("dl_load_id"), event_id.alias("archtics_event_name"), F.col("code").alias("host_event_code"),
    )


def team_rankings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Two per-team rankings (customer count, customer balance) and the alias table.

    A team is a region; its short name (``data_name``) is the region name, which
    is what the event names carry.  Teams are bounded by the league size.
    """
    cust = read_table(spark, sf_dir, "customer").select("c_nationkey", "c_acctbal")
    per_team = (cust.join(_region_dim(spark, sf_dir), cust.c_nationkey == F.col("n_nationkey"))
                .groupBy("r_name")
                .agg(F.count(F.lit(1)).alias("n_customers"),
                     F.sum(F.col("c_acctbal").cast("decimal(18,2)")).alias("balance")))
    team = F.concat(F.lit("Team "), "r_name").alias("team")
    from pyspark.sql import Window as W
    fans = per_team.select(team, F.row_number().over(
        W.orderBy(F.desc("n_customers"), "r_name")).alias("ranking"))
    social = per_team.select(team, F.row_number().over(
        W.orderBy(F.desc("balance"), "r_name")).alias("ranking"))
    aliases = read_table(spark, sf_dir, "region").select(team, F.col("r_name").alias("data_name"))
    return fans, social, aliases


def weekly_standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per team and week: points = orders placed by the team's customers in the
    week before ``rank_date`` (a Monday).  Grain: team x week."""
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderdate")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    cust_team = cust.join(_region_dim(spark, sf_dir), cust.c_nationkey == F.col("n_nationkey"))
    rank_date = F.date_add(F.to_date(F.date_trunc("week", "o_orderdate")), 7)
    return (orders.join(cust_team, orders.o_custkey == cust_team.c_custkey)
            .groupBy(rank_date.alias("rank_date"), F.col("r_name"))
            .agg(F.count(F.lit(1)).cast("int").alias("points"),
                 F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).cast("int").alias("wins"),
                 F.sum(F.when(F.col("o_orderstatus") == "O", 1).otherwise(0)).cast("int").alias("losses"),
                 F.sum(F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)).cast("int").alias("otLosses")))


def standings_payload(spark: SparkSession, sf_dir: str, rank_dates: DataFrame) -> DataFrame:
    """Nested standings per requested date, shaped like the standings API
    (``rank_date, standings ARRAY<STRUCT<teamName: STRUCT<default>, points ...>>``).
    A date without games gets an empty array.  Array size <= number of teams."""
    wk = weekly_standings(spark, sf_dir)
    team_struct = F.struct(
        F.struct(F.concat(F.lit("Team "), "r_name").alias("default")).alias("teamName"),
        "points", "wins", "losses", "otLosses",
        F.lit(None).cast("int").alias("goalDifferential"),
        F.lit(None).cast("int").alias("goalFor"), F.lit(None).cast("int").alias("goalAgainst"))
    return (rank_dates.select("rank_date").distinct()
            .join(wk, "rank_date", "left")
            .groupBy("rank_date")
            .agg(F.collect_list(F.when(F.col("r_name").isNotNull(), team_struct)).alias("standings")))


def web_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw web-analytics rows (FIXTURES F6) from ``events``: one row per event
    type and day, dates shifted back ``WEB_DAY_SHIFT`` days.  Several rows share
    (Event_Date, as_of_date); ``error`` rows carry another name prefix; ``signup``
    rows are dated after their event."""
    ev = read_table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value")
    as_of = F.date_sub(F.to_date("ts"), WEB_DAY_SHIFT)
    g = ev.groupBy(F.col("event_type"), as_of.alias("as_of_date")).agg(
        F.count_distinct("user_id").alias("unique_views"),
        F.count(F.lit(1)).alias("order_qty"),
        F.sum(F.when(F.col("value") > 25, 1).otherwise(0)).cast("bigint").alias("tkt_qty"))
    return g.select(
        F.when(F.col("event_type") == "error", F.lit("Concert Night"))
         .otherwise(F.concat(F.lit(HOME_PREFIX + " vs. "), F.upper("event_type"))).alias("Event_Name"),
        F.col("event_type").alias("Event_Client_Id"),
        F.lit("Arena").alias("Venue_Name"),
        F.lit("19:00").alias("Event_Time"),
        F.when(F.col("event_type") == "signup", F.date_sub("as_of_date", 1))
         .otherwise(quarter_end(F.col("as_of_date"))).alias("Event_Date"),
        "as_of_date", "unique_views", "order_qty", "tkt_qty")
