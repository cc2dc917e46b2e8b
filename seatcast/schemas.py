"""Explicit schemas for every input, and the one rename map at ingest.

Raw snapshot exports use ``-`` and ``/`` in column names
(``host_sold-yesterday``, ``s/t-rate``).  Inside the library every column is
snake_case; ``to_raw_names`` reverses the map at a sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Raw export name -> canonical name.  Names not listed only get lower-cased.
RAW_RENAME = {
    "s/t-rate": "st_rate",
    "ticket_sold-total": "ticket_sold_total",
    "ticket_sold-last_7days": "ticket_sold_last_7days",
    "ticket_sold-yesterday": "ticket_sold_yesterday",
    "host_sold-total": "host_sold_total",
    "host_sold-last_7days": "host_sold_last_7days",
    "host_sold-yesterday": "host_sold_yesterday",
    "resale_sold-2_days_ago": "resale_sold_2_days_ago",
    "resale_sold-last_7days": "resale_sold_last_7days",
    "resale_sold-total": "resale_sold_total",
    "resale_asp-2_days_ago": "resale_asp_2_days_ago",
    "resale_asp-last_7days": "resale_asp_last_7days",
    "resale_asp-total": "resale_asp_total",
    "target_host_sold-today": "target_host_sold_today",
}

HOUSEKEEPING_COLUMNS = [
    "venue", "platinum_opens", "platinum_average_open_price", "platinum_lowest_open_price",
    "platinum_highest_open_price", "platinum_holds", "dl_rowhash", "dl_iscurrent", "dl_isdeleted",
    "dl_recordstartdateutc", "dl_recordenddateutc", "dl_load_id", "archtics_event_name",
    "host_event_code",
]

_S, _D, _L, _F, _I = T.StringType(), T.DateType(), T.LongType(), T.DoubleType(), T.IntegerType()


def _struct(pairs) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in pairs])


SNAPSHOT = _struct([
    ("event_id", _S), ("event_name", _S), ("identifier", _S), ("price_level_name", _S),
    ("calculate_date", _D), ("cap", _L), ("pminventory", _L), ("opens", _L), ("holds", _L),
    ("revenue_to_date", _F), ("st_rate", _F), ("initial_price", _F), ("last_price", _F),
    ("prp_currentprice", _F), ("prp_forwardtix", _F), ("prp_forwardrev", _F),
    ("ticket_sold_total", _L), ("ticket_sold_last_7days", _L), ("ticket_sold_yesterday", _L),
    ("host_sold_total", _L), ("host_sold_last_7days", _L), ("host_sold_yesterday", _L),
    ("host_sold_at_current_price", _L), ("resale_sold_2_days_ago", _L),
    ("resale_sold_last_7days", _L), ("resale_sold_total", _L), ("resale_asp_2_days_ago", _F),
    ("resale_asp_last_7days", _F), ("resale_asp_total", _F), ("number_of_postings", _L),
    ("median_posting_price", _F), ("posting_below_cp", _L), ("lowest_post_price", _F),
    ("highest_post_price", _F),
])

OPPONENT_POPULARITY = _struct([("team", _S), ("data_name", _S), ("opponent_rank", _I)])

STANDINGS_RANK = _struct([("rank_date", _D), ("van_rank", _I)])

_TEAM = T.StructType([
    T.StructField("teamName", T.StructType([T.StructField("default", _S)])),
    T.StructField("points", _I), T.StructField("wins", _I), T.StructField("losses", _I),
    T.StructField("otLosses", _I), T.StructField("goalDifferential", _I),
    T.StructField("goalFor", _I), T.StructField("goalAgainst", _I),
])
STANDINGS_JSON = _struct([("rank_date", _D), ("standings", T.ArrayType(_TEAM))])
STANDINGS_PAYLOAD = T.StructType([T.StructField("standings", T.ArrayType(_TEAM))])

WEB_ANALYTICS = _struct([
    ("Event_Name", _S), ("Event_Client_Id", _S), ("Venue_Name", _S), ("Event_Time", _S),
    ("Event_Date", _D), ("as_of_date", _D), ("unique_views", _L), ("order_qty", _L),
    ("tkt_qty", _L),
])

PREDICTIONS = _struct([
    ("event_name", _S), ("event_date", _D), ("opponent", _S), ("price_code", _S),
    ("last_price", _F), ("host_sold_yesterday", _L), ("predicted_segmented", _F),
    ("predicted_poisson", _F),
])

COEFFICIENTS = _struct([("feature", _S), ("coefficients", _F), ("magnitude", _F)])


def canonical_name(raw: str) -> str:
    return RAW_RENAME.get(raw, raw.lower().replace("-", "_").replace("/", "_"))


def to_canonical_names(df: DataFrame) -> DataFrame:
    """Rename raw export columns to snake_case (one projection, no data movement)."""
    return df.withColumnsRenamed({c: canonical_name(c) for c in df.columns
                                  if canonical_name(c) != c})


def to_raw_names(df: DataFrame) -> DataFrame:
    """Reverse of :func:`to_canonical_names` for sinks that need the export names."""
    back = {v: k for k, v in RAW_RENAME.items()}
    return df.withColumnsRenamed({c: back[c] for c in df.columns if c in back})
