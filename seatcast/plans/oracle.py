"""DuckDB SQL twins of the stand-in inputs and pipelines.

These strings are the correctness oracle: the same derivations as
``seatcast.sources.testdata`` and ``seatcast.plans.pipelines``, written as
plain SQL over the driver's tables.  ``with_base(select)`` prefixes the shared
CTEs; DuckDB skips the ones a query does not use.
"""

from __future__ import annotations

from seatcast import constants as C
from seatcast import schemas
from seatcast.plans import inputs
from seatcast.sources import testdata as td


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in_list(values) -> str:
    return ", ".join(_q(v) for v in values)


def _price_code_values() -> str:
    rows = [f"({_q(k)}, {C.PRICE_CODE_ORDINAL[k]}, CAST({C.PRICE_FLOOR[k]!r} AS DOUBLE))"
            for k in sorted(C.PRICE_CODE_ORDINAL)]
    return ",\n      ".join(rows)


_PRE = inputs.PRE
_preseason = " OR ".join(f"(event_date BETWEEN DATE {_q(lo)} AND DATE {_q(hi)})"
                         for lo, hi in _PRE.preseason_ranges)
_lags = ",\n    ".join(
    f"LAG(target_host_sold_today, {i}) OVER (PARTITION BY event_id, price_code ORDER BY calculate_date)"
    f" AS tickets_sold_{i}_days_before_today" for i in range(2, _PRE.lag_days + 1))

SNAPSHOT_CTES = f"""
rg AS (
  SELECT n.n_nationkey, r.r_regionkey, r.r_name
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
),
ln AS (
  SELECT rg.r_regionkey, rg.r_name, CAST(l.l_shipdate AS DATE) AS calculate_date,
    CASE WHEN CAST(split_part(p.p_brand, '#', 2) AS INTEGER) <= 10
         THEN chr(47 + CAST(split_part(p.p_brand, '#', 2) AS INTEGER))
         ELSE chr(64 + CAST(split_part(p.p_brand, '#', 2) AS INTEGER)) END AS code,
    CAST(l.l_quantity AS BIGINT) AS qty,
    CASE WHEN l.l_returnflag = 'R' THEN -CAST(l.l_quantity AS BIGINT) ELSE CAST(l.l_quantity AS BIGINT) END AS signed_qty,
    l.l_returnflag, l.l_linestatus, l.l_discount, l.l_tax, l.l_extendedprice, p.p_retailprice,
    l.l_extendedprice / l.l_quantity AS unit_price
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN rg ON s.s_nationkey = rg.n_nationkey
),
snap_g AS (
  SELECT r_regionkey, r_name, calculate_date, code,
    CAST(SUM(qty) AS BIGINT) AS cap,
    COUNT(*) AS pminventory,
    CAST(SUM(CASE WHEN l_linestatus = 'O' THEN qty ELSE 0 END) AS BIGINT) AS opens,
    CAST(SUM(CASE WHEN l_tax = 0 THEN 1 ELSE 0 END) AS BIGINT) AS holds,
    CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue_to_date,
    CAST(SUM(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS st_rate,
    MAX(p_retailprice) AS initial_price,
    CASE WHEN MIN(l_discount) = 0 THEN CAST(0 AS DOUBLE) ELSE MAX(unit_price) END AS last_price,
    CAST(SUM(CASE WHEN l_returnflag <> 'R' THEN qty ELSE 0 END) AS BIGINT) AS ticket_sold_total,
    CAST(SUM(CASE WHEN l_returnflag = 'N' THEN qty ELSE 0 END) AS BIGINT) AS host_sold_total,
    CAST(SUM(signed_qty) AS BIGINT) AS host_sold_yesterday,
    CAST(SUM(CASE WHEN l_discount <= 0.02 THEN qty ELSE 0 END) AS BIGINT) AS host_sold_at_current_price,
    CAST(SUM(CASE WHEN l_returnflag = 'A' THEN qty ELSE 0 END) AS BIGINT) AS resale_sold_total,
    CAST(SUM(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS number_of_postings,
    MIN(unit_price) AS lowest_post_price,
    MAX(unit_price) AS highest_post_price,
    CAST(SUM(CASE WHEN l_discount <= 0.05 THEN qty ELSE 0 END) AS BIGINT) AS ticket_sold_last_7days,
    CAST(SUM(CASE WHEN l_discount <= 0.01 THEN qty ELSE 0 END) AS BIGINT) AS ticket_sold_yesterday,
    CAST(SUM(CASE WHEN l_returnflag = 'N' AND l_discount <= 0.05 THEN qty ELSE 0 END) AS BIGINT) AS host_sold_last_7days,
    CAST(SUM(CASE WHEN l_returnflag = 'A' AND l_tax <= 0.02 THEN qty ELSE 0 END) AS BIGINT) AS resale_sold_2_days_ago,
    CAST(SUM(CASE WHEN l_returnflag = 'A' AND l_tax <= 0.06 THEN qty ELSE 0 END) AS BIGINT) AS resale_sold_last_7days,
    MAX(CASE WHEN l_returnflag = 'A' AND l_tax <= 0.02 THEN unit_price END) AS resale_asp_2_days_ago,
    MAX(CASE WHEN l_returnflag = 'A' AND l_tax <= 0.06 THEN unit_price END) AS resale_asp_last_7days,
    MAX(CASE WHEN l_returnflag = 'A' THEN unit_price END) AS resale_asp_total,
    (MIN(unit_price) + MAX(unit_price)) / 2 AS median_posting_price,
    CAST(SUM(CASE WHEN unit_price < p_retailprice THEN 1 ELSE 0 END) AS BIGINT) AS posting_below_cp,
    MIN(p_retailprice) AS prp_currentprice,
    CAST(SUM(CASE WHEN l_tax > 0.06 THEN qty ELSE 0 END) AS DOUBLE) AS prp_forwardtix,
    CAST(SUM(CASE WHEN l_tax > 0.06 THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS prp_forwardrev
  FROM ln GROUP BY r_regionkey, r_name, calculate_date, code
),
snap_e AS (
  SELECT *, year(calculate_date) AS yr, quarter(calculate_date) AS q,
    last_day(CAST(date_trunc('quarter', calculate_date) AS DATE) + INTERVAL 2 MONTH) AS ev_date
  FROM snap_g
),
snapshot AS (
  SELECT
    replace(r_name, ' ', '_') || '-' || CAST(yr AS VARCHAR) || 'Q' || CAST(q AS VARCHAR) AS event_id,
    CASE WHEN yr = 1996 AND q = 1 THEN {_q(td.TEST_EVENT)}
         WHEN r_regionkey = 4 THEN r_name || ' Showcase'
         WHEN r_regionkey = 3 THEN {_q(td.HOME_PREFIX + ' ')} || r_name
         ELSE {_q(td.HOME_PREFIX + ' vs. ')} || r_name END AS event_name,
    CASE WHEN yr = 1997 AND q = 2 THEN 'EVT_TBD_' || CAST(r_regionkey AS VARCHAR)
         ELSE 'EVT_' || strftime(ev_date, '%a_%b_%-d_%Y') || '_' || CAST(r_regionkey AS VARCHAR) END AS identifier,
    'Level ' || code AS price_level_name,
    calculate_date, cap, pminventory, opens, holds, revenue_to_date, st_rate, initial_price, last_price,
    CAST(ticket_sold_total AS DOUBLE) AS ticket_sold_total, host_sold_total, host_sold_yesterday,
    host_sold_at_current_price, resale_sold_total, number_of_postings, lowest_post_price, highest_post_price,
    {", ".join(td.EXTRA_MEASURES)},
    'Arena' AS venue, opens AS platinum_opens, median_posting_price AS platinum_average_open_price,
    lowest_post_price AS platinum_lowest_open_price, highest_post_price AS platinum_highest_open_price,
    holds AS platinum_holds,
    md5(replace(r_name, ' ', '_') || '-' || CAST(yr AS VARCHAR) || 'Q' || CAST(q AS VARCHAR) || '|' || code) AS dl_rowhash,
    1 AS dl_iscurrent, 0 AS dl_isdeleted, calculate_date AS dl_recordstartdateutc,
    CAST(calculate_date + 1 AS DATE) AS dl_recordenddateutc, CAST(r_regionkey AS VARCHAR) AS dl_load_id,
    replace(r_name, ' ', '_') || '-' || CAST(yr AS VARCHAR) || 'Q' || CAST(q AS VARCHAR) AS archtics_event_name,
    code AS host_event_code
  FROM snap_e
)"""

PRE_CTES = f"""
pre_1 AS (
  SELECT *,
    CAST(try_strptime(substr(NULLIF(regexp_extract(identifier, {_q(C.EVENT_DATE_PATTERN)}, 1), ''), 5),
                      '%b_%d_%Y') AS DATE) AS event_date,
    NULLIF(right(price_level_name, 1), '') AS price_code
  FROM snapshot
),
pre_2 AS (
  SELECT *,
    CASE WHEN starts_with(event_name, {_q(_PRE.home_prefix)})
              AND regexp_matches(event_name, {_q(C.OPPONENT_PATTERN)})
         THEN regexp_extract(event_name, {_q(C.OPPONENT_PATTERN)}, 1) ELSE event_name END AS opponent
  FROM pre_1
  WHERE NOT (price_code IS NOT DISTINCT FROM {_q(C.DROPPED_PRICE_CODE)})
    AND event_date > DATE {_q(_PRE.start_date)}
    AND NOT COALESCE(event_name IN ({_in_list(_PRE.excluded_events)}), false)
    AND NOT COALESCE({_preseason}, false)
    AND host_sold_yesterday >= {_PRE.sold_threshold}
),
pre_3 AS (
  SELECT *, LEAD(host_sold_yesterday, 1) OVER (PARTITION BY event_id, price_code ORDER BY calculate_date)
            AS target_host_sold_today
  FROM pre_2
),
pre_serve_4 AS (
  SELECT *,
    {_lags}
  FROM pre_3
),
pre_4 AS (
  SELECT *,
    {_lags}
  FROM pre_3 WHERE target_host_sold_today >= 0
),
pre AS (
  SELECT * EXCLUDE ({", ".join(schemas.HOUSEKEEPING_COLUMNS)})
    REPLACE (CASE WHEN last_price = 0 THEN initial_price ELSE last_price END AS last_price,
             CAST(ticket_sold_total AS BIGINT) AS ticket_sold_total)
  FROM pre_4 WHERE date_diff('day', calculate_date, event_date) <= {_PRE.days_before_event}
),
pre_serve AS (
  SELECT * REPLACE (CASE WHEN last_price = 0 THEN initial_price ELSE last_price END AS last_price)
  FROM pre_serve_4 WHERE date_diff('day', calculate_date, event_date) <= {_PRE.days_before_event}
)"""

DIM_CTES = f"""
cust_team AS (
  SELECT rg.r_name, COUNT(*) AS n_customers, SUM(CAST(c.c_acctbal AS DECIMAL(18,2))) AS balance
  FROM customer c JOIN rg ON c.c_nationkey = rg.n_nationkey GROUP BY rg.r_name
),
fans AS (SELECT 'Team ' || r_name AS team, ROW_NUMBER() OVER (ORDER BY n_customers DESC, r_name) AS ranking FROM cust_team),
social AS (SELECT 'Team ' || r_name AS team, ROW_NUMBER() OVER (ORDER BY balance DESC, r_name) AS ranking FROM cust_team),
team_merged AS (
  SELECT s.team, s.ranking AS ranking_x, f.ranking AS ranking_y, s.ranking + f.ranking AS overall
  FROM social s JOIN fans f ON s.team = f.team
),
team_dense AS (SELECT *, CAST(DENSE_RANK() OVER (ORDER BY overall) AS INTEGER) AS overall_rank FROM team_merged),
team_q AS (
  SELECT quantile_cont(CAST(overall_rank AS DOUBLE), 1.0 / 3.0) AS q1,
         quantile_cont(CAST(overall_rank AS DOUBLE), 2.0 / 3.0) AS q2 FROM team_dense
),
popularity AS (
  SELECT d.team, r.r_name AS data_name,
    CAST(CASE WHEN d.team IN ({_in_list(td.RIVAL_TEAMS)}) THEN 1
              WHEN d.overall_rank <= q.q1 THEN 1 WHEN d.overall_rank <= q.q2 THEN 2 ELSE 3 END AS INTEGER)
      AS opponent_rank
  FROM team_dense d CROSS JOIN team_q q LEFT JOIN region r ON d.team = 'Team ' || r.r_name
),
weekly AS (
  SELECT CAST(date_trunc('week', o.o_orderdate) AS DATE) + 7 AS rank_date, rg.r_name,
    CAST(COUNT(*) AS INTEGER) AS points,
    CAST(SUM(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END) AS INTEGER) AS wins,
    CAST(SUM(CASE WHEN o.o_orderstatus = 'O' THEN 1 ELSE 0 END) AS INTEGER) AS losses,
    CAST(SUM(CASE WHEN o.o_orderstatus = 'P' THEN 1 ELSE 0 END) AS INTEGER) AS ot_losses
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN rg ON c.c_nationkey = rg.n_nationkey
  GROUP BY 1, 2
),
wanted_dates AS (
  SELECT DISTINCT calculate_date AS rank_date FROM pre WHERE isodow(calculate_date) = 1
  UNION ALL
  SELECT rank_date FROM (SELECT MIN(calculate_date) AS rank_date FROM pre) WHERE isodow(rank_date) <> 1
),
standings AS (
  SELECT w.rank_date, 'Team ' || w.r_name AS team_name, w.points, w.wins, w.losses, w.ot_losses,
    CAST(NULL AS INTEGER) AS goal_differential, CAST(NULL AS INTEGER) AS goal_for,
    CAST(NULL AS INTEGER) AS goal_against
  FROM (SELECT DISTINCT rank_date FROM wanted_dates) d JOIN weekly w ON d.rank_date = w.rank_date
),
ranks AS (
  SELECT rank_date, van_rank FROM (
    SELECT rank_date, team_name, CAST(RANK() OVER (PARTITION BY rank_date ORDER BY points DESC) AS INTEGER) AS van_rank
    FROM standings) WHERE team_name = {_q(td.HOME_TEAM)}
),
web_g AS (
  SELECT event_type, CAST(ts AS DATE) - {td.WEB_DAY_SHIFT} AS as_of_date,
    COUNT(DISTINCT user_id) AS unique_views, COUNT(*) AS order_qty,
    CAST(SUM(CASE WHEN value > 25 THEN 1 ELSE 0 END) AS BIGINT) AS tkt_qty
  FROM events GROUP BY 1, 2
),
web AS (
  SELECT CASE WHEN event_type = 'error' THEN 'Concert Night' ELSE {_q(td.HOME_PREFIX + ' vs. ')} || upper(event_type) END AS Event_Name,
    event_type AS Event_Client_Id, 'Arena' AS Venue_Name, '19:00' AS Event_Time,
    CASE WHEN event_type = 'signup' THEN as_of_date - 1
         ELSE last_day(CAST(date_trunc('quarter', as_of_date) AS DATE) + INTERVAL 2 MONTH) END AS Event_Date,
    as_of_date, unique_views, order_qty, tkt_qty
  FROM web_g
),
web_daily AS (
  SELECT Event_Date, as_of_date, MAX(unique_views) AS unique_views, MAX(order_qty) AS order_qty,
         MAX(tkt_qty) AS tkt_qty
  FROM web WHERE starts_with(Event_Name, {_q(inputs.FEAT.web_prefix)}) AND as_of_date <= Event_Date
  GROUP BY 1, 2
),
price_codes AS (
  SELECT * FROM (VALUES
      {_price_code_values()}
  ) AS t(code, ordinal, floor)
)"""


def _feature_cte(name: str, src: str) -> str:
    return f"""
{name}_dates AS (
  SELECT m.calculate_date, r.van_rank FROM (SELECT DISTINCT calculate_date FROM {src}) m
  LEFT JOIN ranks r ON m.calculate_date = r.rank_date
),
{name}_rank AS (
  SELECT calculate_date, COALESCE(
    LAST_VALUE(van_rank IGNORE NULLS) OVER (ORDER BY calculate_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    FIRST_VALUE(van_rank IGNORE NULLS) OVER (ORDER BY calculate_date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    AS van_rank
  FROM {name}_dates
),
{name}_1 AS (
  SELECT p.*,
    CAST(CASE WHEN isodow(p.event_date) IN (5, 6, 7) THEN 1 ELSE 0 END AS INTEGER) AS weekend_game,
    CAST(month(p.event_date) AS INTEGER) AS month,
    CAST(date_diff('day', p.calculate_date, p.event_date) AS INTEGER) AS days_until_game,
    pop.data_name, COALESCE(pop.opponent_rank, -1) AS opponent_rank,
    CAST(rk.van_rank AS INTEGER) AS van_rank,
    CAST(COALESCE(p.price_code IN ({_in_list(C.LOWER_BOWL_CODES)}), false) AS INTEGER) AS bowl_location,
    w.unique_views, w.order_qty, w.tkt_qty,
    pc.ordinal AS price_code_ordinal, pc.floor AS price_floor,
    p.last_price / pc.floor AS times_above_floor,
    CASE WHEN p.cap = 0 THEN NULL ELSE CAST(p.pminventory AS DOUBLE) / CAST(p.cap AS DOUBLE) END AS inventory_normalized
  FROM {src} p
  LEFT JOIN popularity pop ON p.opponent = pop.data_name
  LEFT JOIN {name}_rank rk ON p.calculate_date = rk.calculate_date
  LEFT JOIN web_daily w ON p.event_date = w.Event_Date AND p.calculate_date = w.as_of_date
  LEFT JOIN price_codes pc ON p.price_code = pc.code
),
{name} AS (
  SELECT *,
    COALESCE(CAST(SUM(host_sold_yesterday) OVER (PARTITION BY event_id, calculate_date) AS BIGINT), 0)
      AS host_sold_agg_last_day,
    COALESCE(CAST(SUM(host_sold_yesterday) OVER (PARTITION BY event_id, calculate_date, bowl_location) AS BIGINT), 0)
      AS host_sold_agg_last_day_samebowl
  FROM {name}_1
)"""


FEATURE_CTES = _feature_cte("feat", "pre") + "," + _feature_cte("feat_serve", "pre_serve")

BASE = SNAPSHOT_CTES + "," + PRE_CTES + "," + DIM_CTES + "," + FEATURE_CTES


def with_base(select: str, extra_ctes: str = "") -> str:
    extra = ("," + extra_ctes) if extra_ctes.strip() else ""
    return f"WITH {BASE}{extra}\n{select}"
