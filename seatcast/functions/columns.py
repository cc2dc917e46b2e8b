"""Scalar column expressions.  Each returns a ``Column`` and stays inside
whole-stage codegen: no Python UDFs anywhere in this module."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from seatcast import constants as C

__all__ = [
    "col_of", "event_date_from_identifier", "opponent_from_name", "price_code_from_level",
    "is_weekend", "days_between", "in_codes", "lookup", "season_label", "format_ymd",
    "linspace", "safe_ratio", "pad_or_truncate",
]


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_date_from_identifier(identifier: str | Column,
                               pattern: str = C.EVENT_DATE_PATTERN) -> Column:
    """``..._Fri_Apr_19_2024_...`` -> DATE 2024-04-19; no match -> NULL.

    ``regexp_extract`` gives '' on a miss, hence ``nullif``.  The weekday is
    dropped before parsing (weekday text patterns cannot be parsed in Spark 3+),
    and ``try_to_date`` keeps impossible dates NULL under ANSI mode.
    """
    hit = F.nullif(F.regexp_extract(col_of(identifier), pattern, 1), F.lit(""))
    return F.try_to_date(F.substring(hit, 5, 64), "MMM_d_yyyy")


def opponent_from_name(name: str | Column, home_prefix: str = C.DEFAULT_HOME_PREFIX,
                       pattern: str = C.OPPONENT_PATTERN) -> Column:
    """Home-team event ``"<prefix> vs. X"`` -> ``X``; anything else -> the full name."""
    n = col_of(name)
    return (F.when(n.startswith(home_prefix) & n.rlike(pattern), F.regexp_extract(n, pattern, 1))
             .otherwise(n))


def price_code_from_level(level: str | Column) -> Column:
    """Last character of the price-level name ('' -> NULL)."""
    return F.nullif(F.substring(col_of(level), -1, 1), F.lit(""))


def is_weekend(d: str | Column) -> Column:
    """1 for Friday/Saturday/Sunday (``weekday``: 0 = Monday), else 0."""
    return F.weekday(col_of(d)).isin(4, 5, 6).cast("int")


def days_between(later: str | Column, earlier: str | Column) -> Column:
    return F.datediff(col_of(later), col_of(earlier))


def in_codes(c: str | Column, codes: Sequence[str]) -> Column:
    """Membership as 0/1 with NULL -> 0 (not NULL)."""
    return F.coalesce(col_of(c).isin(list(codes)), F.lit(False)).cast("int")


def lookup(c: str | Column, mapping: Mapping, value_type: str) -> Column:
    """Literal map lookup ``mapping[c]``; unmapped or NULL key -> NULL.

    The map is a literal in the plan (no join, no shuffle); use it only for
    fixed small dimensions such as the 31 price codes.
    """
    kv = []
    for k in sorted(mapping):
        kv += [F.lit(k), F.lit(mapping[k])]
    m = F.create_map(*kv)
    return F.try_element_at(m, col_of(c)).cast(value_type)


def season_label(d: str | Column, first_start_year: int = C.SEASON_FIRST_START_YEAR,
                 last_start_year: int = C.SEASON_LAST_START_YEAR) -> Column:
    """Season ``"YYYY-YYYY+1"`` with 1 July cut-offs, clamped to the first and last season."""
    x = col_of(d)
    start = F.year(x) - (F.month(x) < 7).cast("int")
    start = F.least(F.greatest(start, F.lit(first_start_year)), F.lit(last_start_year))
    return F.concat(start.cast("string"), F.lit("-"), (start + 1).cast("string"))


def format_ymd(d: str | Column) -> Column:
    return F.date_format(col_of(d), "yyyy-MM-dd")


def linspace(lo: float | Column, hi: float | Column, n: int) -> Column:
    """Array of ``n`` evenly spaced points in [lo, hi], last point exactly ``hi``
    (same arithmetic as numpy: ``i * step + lo``)."""
    lo_c = lo if isinstance(lo, Column) else F.lit(float(lo))
    hi_c = hi if isinstance(hi, Column) else F.lit(float(hi))
    if n == 1:
        return F.array(lo_c)
    step = (hi_c - lo_c) / F.lit(float(n - 1))
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                       lambda i: F.when(i == n - 1, hi_c).otherwise(i.cast("double") * step + lo_c))


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` as double; zero divisor -> NULL (plain ``/`` throws under ANSI)."""
    return F.try_divide(col_of(num).cast("double"), col_of(den).cast("double"))


def pad_or_truncate(seq: str | Column, max_length: int, width: int, padding: float = 0.0) -> Column:
    """Keep the last ``max_length`` elements of an array of feature arrays, or
    append rows of ``padding`` at the end up to ``max_length``."""
    s = col_of(seq)
    n = F.size(s)
    pad_row = F.array_repeat(F.lit(float(padding)).cast("double"), width)
    kept = F.when(n > max_length, F.slice(s, n - max_length + 1, max_length)).otherwise(s)
    fill = F.array_repeat(pad_row, F.greatest(F.lit(max_length) - n, F.lit(0)))
    return F.concat(kept, fill)
