"""Spark session helpers.

The library never creates a session on its own inside operators; callers pass
one in.  ``get_spark`` is for scripts, tests and the benchmark.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Conf values applied when this module builds the session.  On a cluster the
# session is built by the submitter and these are not touched.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.aggregatePushdown": "true",
    # AQE sizes post-shuffle partitions from the actual bytes; the static
    # partition count only has to be large enough for the biggest stage.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def shuffle_partitions_for(shuffle_bytes: int, target_bytes: int = 128 << 20, minimum: int = 8) -> int:
    """Shuffle partition count so each partition holds about ``target_bytes``
    (e.g. 100 TB of shuffled fact -> ~800k partitions; AQE coalesces down)."""
    return max(minimum, -(-int(shuffle_bytes) // int(target_bytes)))


def local_heap_gb(most: int = 12) -> int:
    """Half of this machine's memory, ``most`` at the most."""
    pages = os.sysconf("SC_PHYS_PAGES") * os.sysconf("SC_PAGE_SIZE")
    return max(1, min(most, pages // 2 >> 30))


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "seatcast") -> SparkSession:
    """Build (or reuse) a session with the library's defaults."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    builder = SparkSession.builder.master(master).appName(app_name)
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    if master.startswith("local"):      # one JVM does all the work; on a cluster the submitter sets this
        builder = builder.config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", f"{local_heap_gb()}g"))
    builder = builder.config("spark.sql.shuffle.partitions",
                             str(shuffle_partitions or int(cpus)))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` is read from the session.  Only when it is unset
    and the master is local (tests) a fresh scratch folder is created, and
    removed when the process ends.  On a cluster an unset folder is an error:
    executors could not see what the others write.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        path = sc.getConf().get("spark.checkpoint.dir", None)
        if not path:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            path = tempfile.mkdtemp(prefix="seatcast-ckpt-")
            atexit.register(shutil.rmtree, path, ignore_errors=True)
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir()        # with its scheme, the same for Spark and other readers, at every call
