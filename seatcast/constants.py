"""Fixed values that must equal the reference's for right results.

Everything here is data, not logic: price-code ordinals and floors, the
lower-bowl code set, default filter parameters and the model settings the
reference publishes.  Team names, venues and dates stay parameters of the
operators; these are only the defaults.
"""

# --- fixed values: price-code ordinal (1 = cheapest area, 31 = best) --------
PRICE_CODE_ORDINAL = {
    "0": 31, "S": 30, "3": 29, "1": 28, "2": 27, "U": 26, "4": 25, "5": 24, "6": 23, "T": 23,
    "7": 21, "D": 20, "8": 19, "H": 18, "9": 17, "O": 16, "A": 15, "E": 14, "B": 13, "F": 13,
    "I": 11, "J": 10, "C": 9, "P": 8, "G": 7, "K": 6, "M": 5, "L": 4, "Q": 3, "N": 2, "R": 1,
}

# --- fixed values: price floor per price code --------------------------------
PRICE_FLOOR = {
    "0": 185.00, "S": 159.00, "3": 149.00, "1": 147.00, "2": 138.00,
    "U": 132.00, "4": 123.00, "5": 115.00, "6": 100.00, "T": 100.00,
    "7": 93.00, "D": 92.00, "8": 86.00, "H": 83.00, "9": 82.00, "O": 79.00,
    "A": 76.00, "E": 74.00, "B": 68.00, "F": 68.00, "I": 65.00,
    "J": 65.00, "C": 58.00, "P": 55.00, "G": 54.00, "K": 51.00,
    "M": 47.00, "L": 45.00, "Q": 44.00, "N": 38.00, "R": 37.00,
}

# --- fixed values: lower-bowl price codes ------------------------------------
LOWER_BOWL_CODES = ["0", "1", "2", "3", "4", "5", "6", "7", "8", "9", "A", "B", "C"]

# --- fixed values: default filter parameters ---------------------------------
DEFAULT_PRESEASON_RANGES = [("2022-09-24", "2022-10-08"), ("2023-09-23", "2023-10-07")]
DEFAULT_EXCLUDED_EVENTS = ["Canucks vs. TBD", "Test Event - DO NOT PURCHASE"]
DEFAULT_HOME_PREFIX = "Canucks"
DEFAULT_DAYS_BEFORE_EVENT = 30
DEFAULT_START_DATE = "2022-02-15"
DEFAULT_CUTOFF_DATE = "2024-04-18"
DROPPED_PRICE_CODE = "V"
EVENT_DATE_PATTERN = (
    r"((?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)_(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
    r"_[0-9]{1,2}_\d{4})_"
)
OPPONENT_PATTERN = r"vs\.\s(.+)"

# --- fixed values: season cut-offs (1 July) and labels ------------------------
SEASON_FIRST_START_YEAR = 2021
SEASON_LAST_START_YEAR = 2023

# --- fixed values: backtest windows (distinct dates) -------------------------
BACKTEST_TRAIN_DATES = 270
BACKTEST_VALID_DATES = 60

# --- fixed values: model settings ---------------------------------------------
RIDGE_ALPHA = 1.0
POLY_RIDGE_ALPHA = 1559.945
POLY_DEGREE = 2
POISSON_ALPHA = 1.0
RF_PARAMS = {"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 4, "seed": 42}
GBT_PARAMS = {"maxIter": 1500, "maxDepth": 3, "stepSize": 0.025, "subset": 0.15, "seed": 123}
SEQUENCE_LENGTH = 3
SEQUENCE_MAX_LENGTH = 30
PRICE_GRID_POINTS = 30
RATIO_GRID = (1.0, 8.0)
MULTIPLIER_GRID = (0.5, 2.0)
HIGH_CORR_THRESHOLD = 0.8
RESIDUAL_QUANTILES = (0.05, 0.95)
TOP_PREDICTIONS = 20
TOP_COEFFICIENTS = 20

# --- fixed values: feature lists of the sequence model --------------------------
NUMERIC_FEATURES = [
    "revenue_to_date", "st_rate", "opens", "holds", "pminventory",
    "ticket_sold_total", "ticket_sold_last_7days", "ticket_sold_yesterday", "host_sold_total",
    "host_sold_last_7days", "host_sold_yesterday", "resale_sold_2_days_ago", "resale_sold_last_7days",
    "resale_sold_total", "resale_asp_2_days_ago", "resale_asp_last_7days", "resale_asp_total",
    "number_of_postings", "median_posting_price", "posting_below_cp", "lowest_post_price",
    "highest_post_price", "host_sold_at_current_price", "unique_views", "tkt_qty",
]
CATEGORICAL_FEATURES = ["month", "opponent"]
PASSTHROUGH_FEATURES = [
    "weekend_game", "days_until_game", "opponent_rank", "van_rank", "bowl_location",
    "price_code_ordinal", "host_sold_agg_last_day", "times_above_floor", "inventory_normalized",
]

TARGET = "target_host_sold_today"

# --- fixed values: feature lists of the Poisson model (canonical names) -------
POISSON_NUMERIC = [
    "st_rate", "opens", "host_sold_total", "host_sold_last_7days", "host_sold_yesterday",
    "resale_sold_last_7days", "resale_sold_total", "resale_asp_last_7days", "resale_asp_total",
    "number_of_postings", "median_posting_price", "posting_below_cp", "lowest_post_price",
    "highest_post_price", "host_sold_at_current_price", "days_until_game", "opponent_rank", "van_rank",
    "host_sold_agg_last_day", "unique_views", "price_code_ordinal", "tickets_sold_2_days_before_today",
    "tickets_sold_3_days_before_today", "tickets_sold_4_days_before_today",
    "tickets_sold_5_days_before_today", "tickets_sold_6_days_before_today",
    "tickets_sold_7_days_before_today",
]
POISSON_CATEGORICAL = ["month", "opponent"]
POISSON_PASSTHROUGH = ["bowl_location", "weekend_game", "inventory_normalized", "times_above_floor"]

# --- fixed values: feature lists of the ridge baseline and boosted trees ----------
BASELINE_NUMERIC = [
    "revenue_to_date", "st_rate", "opens", "holds", "prp_currentprice", "prp_forwardtix", "prp_forwardrev",
    "ticket_sold_total", "ticket_sold_last_7days", "ticket_sold_yesterday", "host_sold_total",
    "host_sold_last_7days", "host_sold_yesterday", "resale_sold_2_days_ago", "resale_sold_last_7days",
    "resale_sold_total", "resale_asp_2_days_ago", "resale_asp_last_7days", "resale_asp_total", "last_price",
    "number_of_postings", "median_posting_price", "posting_below_cp", "lowest_post_price",
    "highest_post_price", "host_sold_at_current_price", "days_until_game", "opponent_rank", "van_rank",
    "tickets_sold_2_days_before_today", "tickets_sold_3_days_before_today", "tickets_sold_4_days_before_today",
    "tickets_sold_5_days_before_today", "tickets_sold_6_days_before_today", "tickets_sold_7_days_before_today",
    "weekend_game", "host_sold_agg_last_day", "unique_views", "tkt_qty",
]
BASELINE_CATEGORICAL = ["price_code", "month"]
BASELINE_PASSTHROUGH = ["weekend_game", "bowl_location"]

# --- fixed values: feature lists of the random forest (baseline plus pminventory) --
RF_NUMERIC = [
    "revenue_to_date", "st_rate", "opens", "holds", "pminventory", "prp_currentprice", "prp_forwardtix",
    "prp_forwardrev", "ticket_sold_total", "ticket_sold_last_7days", "ticket_sold_yesterday", "host_sold_total",
    "host_sold_last_7days", "host_sold_yesterday", "resale_sold_2_days_ago", "resale_sold_last_7days",
    "resale_sold_total", "resale_asp_2_days_ago", "resale_asp_last_7days", "resale_asp_total", "last_price",
    "number_of_postings", "median_posting_price", "posting_below_cp", "lowest_post_price",
    "highest_post_price", "host_sold_at_current_price", "days_until_game", "opponent_rank", "van_rank",
    "tickets_sold_2_days_before_today", "tickets_sold_3_days_before_today", "tickets_sold_4_days_before_today",
    "tickets_sold_5_days_before_today", "tickets_sold_6_days_before_today", "tickets_sold_7_days_before_today",
    "weekend_game", "host_sold_agg_last_day", "unique_views", "tkt_qty",
]
RF_CATEGORICAL = ["month", "opponent"]
RF_PASSTHROUGH = ["weekend_game", "bowl_location", "price_code_ordinal", "times_above_floor", "inventory_normalized"]

# --- fixed values: feature lists of the polynomial ridge --------------------------
POLY_NUMERIC = [
    "cap", "st_rate", "opens", "prp_forwardtix", "ticket_sold_total", "ticket_sold_last_7days",
    "ticket_sold_yesterday", "host_sold_total", "host_sold_last_7days", "host_sold_yesterday",
    "resale_sold_last_7days", "resale_sold_total", "resale_asp_last_7days", "resale_asp_total",
    "initial_price", "last_price", "number_of_postings", "median_posting_price", "posting_below_cp",
    "lowest_post_price", "highest_post_price", "host_sold_at_current_price", "days_until_game",
    "opponent_rank", "van_rank", "host_sold_agg_last_day", "unique_views",
]
POLY_CATEGORICAL = ["month", "opponent", "price_code"]
POLY_PASSTHROUGH = ["weekend_game"]

# --- fixed values: passthrough list of the unpenalised GLM ------------------------
GLM_PASSTHROUGH = ["weekend_game", "inventory_normalized", "times_above_floor"]

# --- fixed values: random searches (settings drawn, penalty range, folds) ---------
SEARCH_SETTINGS = 10
POISSON_SEARCH = {"alpha": (0.0, 10000.0), "degree": [1, 2]}
POISSON_KFOLD_SEARCH = {"alpha": (0.0, 1000.0), "degree": [1, 2]}
POISSON_SEARCH_FOLDS = 3
RIDGE_SEARCH = {"alpha": (0.0, 10000.0), "degree": [2]}
RIDGE_SEARCH_FOLDS = 5
