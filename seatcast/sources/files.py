"""File sources and sinks (survey 2.1).

Every reader takes an explicit schema where the format has none (CSV, JSON)
so nothing is inferred by scanning the data.
"""

from __future__ import annotations

import csv
import uuid
from fnmatch import fnmatch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatcast import schemas
from seatcast.session import ensure_checkpoint_dir


def scan_combine(spark: SparkSession, directory: str, pattern: str = "*.parquet",
                 schema: T.StructType | None = None) -> DataFrame:
    """All Parquet files under ``directory`` (recursively, other files
    ignored), unioned by column name; a column missing from a file is NULL."""
    r = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern))
    if schema is not None:
        return r.schema(schema).parquet(directory)
    return r.option("mergeSchema", "true").parquet(directory)


def list_files(spark: SparkSession, source: str, name: str = "*") -> list[str]:
    """Files that a path, folder or glob stands for, in the file system Spark uses."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(source)
    fs, out = path.getFileSystem(conf), []
    for found in fs.globStatus(path) or []:
        for f in fs.listStatus(found.getPath()) if found.isDirectory() else [found]:
            base = f.getPath().getName()
            if f.isFile() and not base.startswith(("_", ".")) and fnmatch(base, name):
                out.append(f.getPath().toString())
    return sorted(out)


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file (None if empty); only its first bytes are read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(conf).open(p)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
        plain = stream if codec is None else codec.createInputStream(stream)
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()


def csv_headers(spark: SparkSession, source: str, name: str = "*", threads: int = 8) -> dict[str, list[str]]:
    """Header line -> the CSV files that begin with it (empty files left out):
    a listing and the first bytes of each file, no pass over the data."""
    from multiprocessing.pool import ThreadPool
    paths = list_files(spark, source, name)
    with ThreadPool(threads) as pool:
        lines = pool.map(lambda p: first_line(spark, p), paths)
    out: dict[str, list[str]] = {}
    for path, line in zip(paths, lines):
        if line is not None:
            out.setdefault(line.removeprefix("\ufeff"), []).append(path)
    return out


def header_schema(line: str, schema: T.StructType) -> T.StructType:
    """The columns of a header line, with the types that ``schema`` gives them (text where it has none)."""
    types = {f.name.lower(): f.dataType for f in schema.fields}
    return T.StructType([T.StructField(c, types.get(c.lower(), T.StringType())) for c in next(csv.reader([line]))])


def scan_csv_glob(spark: SparkSession, pattern: str, schema: T.StructType,
                  date_format: str = "yyyy-MM-dd") -> DataFrame:
    """CSV files matching a glob, united by column name.

    Files are grouped by their header line and each group is read with its own
    column order, so files whose columns stand in another order, or lack some,
    still line up by name (a missing column is NULL; a column that the schema
    does not name is left out).  A field that does not parse stops the read
    (FAILFAST) instead of becoming NULL."""
    types = {f.name.lower(): f.dataType for f in schema.fields}
    out = None
    for line, paths in csv_headers(spark, pattern).items():
        own = header_schema(line, schema)
        header = own.names
        df = (spark.read.schema(own).option("header", "true").option("dateFormat", date_format)
              .option("enforceSchema", "false").option("mode", "FAILFAST").csv(paths))
        df = df.select(*[F.col(f"`{c}`") for c in header if c.lower() in types])
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        return spark.createDataFrame([], schema)
    lacking = [f for f in schema.fields if f.name.lower() not in {c.lower() for c in out.columns}]
    out = out.withColumns({f.name: F.lit(None).cast(f.dataType) for f in lacking}) if lacking else out
    return out.select(*[F.col(f"`{f.name}`") for f in schema.fields])


def scan_dim_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return scan_csv_glob(spark, path, schema)


def ingest_raw(df: DataFrame, date_format: str | None = "MM/dd/yyyy", date_cols: tuple[str, ...] = ("calculate_date",),
               keys: tuple[str, ...] = ("event_id",)) -> tuple[DataFrame, DataFrame]:
    """Raw export -> canonical snapshot: column names, text dates (a date that
    does not parse stops the job), declared types, and no row without a series
    key.  Returns the good rows and, lazily, the count of rejected ones."""
    out = schemas.to_canonical_names(df)
    kinds = dict(out.dtypes)
    for c in date_cols:
        if kinds.get(c) == "string" and date_format:
            out = out.withColumn(c, F.to_date(c, date_format))
    types = {f.name: f.dataType for f in schemas.SNAPSHOT.fields}
    out = out.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in out.columns])
    missing = F.lit(False)
    for c in keys:
        missing = missing | F.col(c).isNull()
    return out.where(~missing), out.where(missing).agg(F.count(F.lit(1)).alias("rejected_rows"))


def read_standings_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of ``{rank_date, standings: [...]}`` with the standings schema."""
    return spark.read.schema(schemas.STANDINGS_JSON).option("dateFormat", "yyyy-MM-dd").json(path)


def sink_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                 mode: str = "overwrite") -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def sink_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", "true").option("dateFormat", "yyyy-MM-dd").csv(path)
    return path


def sink_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("dateFormat", "yyyy-MM-dd").json(path)
    return path


def earliest_date(df: DataFrame, col: str = "calculate_date") -> DataFrame:
    """min(date) as one row."""
    return df.agg(F.min(col).alias("earliest_date"))


def read_parquet_v2(spark: SparkSession, path: str) -> DataFrame:
    """Parquet through Spark's v2 source, which can push MIN, MAX and COUNT into
    the footers (the default reader cannot)."""
    v1 = "spark.sql.sources.useV1SourceList"
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    before = spark.conf.get(v1)
    spark.conf.set(v1, ",".join(s for s in before.split(",") if s != "parquet"))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(v1, before)


def earliest_stored_date(spark: SparkSession, path: str, col: str = "calculate_date") -> DataFrame:
    """min(date) of a stored table, from its footers: no column is read."""
    return earliest_date(read_parquet_v2(spark, path), col)


def write_stage(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Store a stage where the caller asks for it and read it back: later plans
    start from the files, with column and partition pruning."""
    sink_parquet(df, path, partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_days(df: DataFrame, path: str, date_col: str = "calculate_date") -> str:
    """Put the days of ``df`` into a store with one folder a day.  A day that is
    there already is replaced, so a repeated load leaves each row once; rows
    without a date stand in a folder of their own."""
    (df.hint("rebalance", date_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(date_col).parquet(path))
    return path


def recent_days(spark: SparkSession, path: str, schema: T.StructType, days: int = 1, date_col: str = "calculate_date") -> DataFrame:
    """The stored rows of the last ``days`` days (the latest date and those less
    than ``days`` before it).  The date is a partition, so only its folders are read."""
    stored = spark.read.schema(schema).parquet(path)
    latest = stored.select(F.max(date_col)).scalar()
    return stored.where(F.col(date_col) > F.date_sub(latest, days))


def export_predictions(df: DataFrame, path: str) -> str:
    """Predictions as CSV with a header (the batch export)."""
    return sink_csv(df, path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint location."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/seatcast-io/{name}-{uuid.uuid4().hex[:12]}"
