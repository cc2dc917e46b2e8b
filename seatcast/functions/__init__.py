"""Column-level building blocks (all built-in Spark SQL expressions)."""

from seatcast.functions.columns import *  # noqa: F401,F403
