"""Small plan helpers shared by operators."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def persisted(df: DataFrame):
    """Keep a frame materialised for the several passes of a fit or a fold
    loop, then release it.  A lost executor's blocks are recomputed from
    lineage, so this never replaces a checkpoint."""
    if df.storageLevel != StorageLevel.NONE:
        yield df
        return
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()
