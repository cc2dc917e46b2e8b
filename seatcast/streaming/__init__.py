"""Incremental ingest of daily snapshot drops (Structured Streaming).

The reference has no streaming operators; its prediction inputs arrive as
daily CSV files in one folder.  ``daily_drops`` reads that folder as a file
stream, so each new day's files are processed once (exactly-once through the
stream checkpoint) and appended to a Parquet table.
"""

from seatcast.streaming.daily_drops import ingest_daily_drops  # noqa: F401
