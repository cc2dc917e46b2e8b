"""Daily CSV drops -> canonical Parquet table, with Structured Streaming.

``trigger(availableNow=True)`` processes every file present at start in
bounded micro-batches and stops; run it after each drop (or continuously
with a processing-time trigger).  The stream's checkpoint records which files
were consumed, so a restart after a lost executor or driver neither skips nor
repeats a file.  Only stateless steps run here (renaming, types); the series
windows need whole series and run in batch on the ingested table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatcast import schemas
from seatcast.sources import files


def read_drops(spark: SparkSession, source: str, schema: T.StructType,
               pattern: str = "*.csv", max_files_per_trigger: int = 100) -> DataFrame:
    """``source`` is the drop folder, or a glob such as ``drops/*`` when each
    drop is its own sub-folder.

    Files are united by column name, as in the batch reader: each line is parsed
    by its own file's header (read once, when the stream is set up).  A column
    that a file lacks is NULL, one that the schema does not name is left out, and
    a field that does not parse stops the stream.  So does a file that came after
    the headers were read; the next run takes it up."""
    headers = files.csv_headers(spark, source, pattern)
    uri = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p).toUri().toString()  # noqa: E731  as in _metadata.file_path
    known = spark.createDataFrame([(uri(p), i) for i, paths in enumerate(headers.values()) for p in paths], "known_path string, header int")
    same = lambda c: F.regexp_replace(c, "^file:/+", "file:///")
    lines = (spark.readStream.option("pathGlobFilter", pattern).option("maxFilesPerTrigger", max_files_per_trigger).text(source)
             .select("value", F.col("_metadata.file_path").alias("path")))
    lines = lines.join(F.broadcast(known.select(same("known_path").alias("known_path"), "header")),      # a row a file
                       same(F.col("path")) == F.col("known_path"), "left")
    options = {"mode": "FAILFAST", "dateFormat": "yyyy-MM-dd"}
    row = F.when(F.col("header").isNull(), F.raise_error(F.concat(F.lit("no header known for "), "path")).cast(schema))
    title = F.lit(False)
    for i, line in enumerate(headers):
        own = files.header_schema(line, schema)
        at = {c.lower(): c for c in own.names}
        parsed = F.from_csv("value", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.fields), options)
        fields = [(parsed.getField(at[f.name.lower()]) if f.name.lower() in at else F.lit(None)).cast(f.dataType).alias(f.name)
                  for f in schema.fields]
        row = row.when(F.col("header") == i, F.struct(*fields))
        title = title | ((F.col("header") == i) & (F.ltrim(F.col("value"), F.lit("\ufeff")) == F.lit(line)))
    blank = F.col("value") == ""
    return lines.where(~F.coalesce(title, F.lit(False)) & ~blank).select(row.alias("row")).select("row.*")


def ingest_daily_drops(spark: SparkSession, source: str, out_path: str, checkpoint: str,
                       schema: T.StructType = schemas.SNAPSHOT, pattern: str = "*.csv",
                       partition_by: str | None = None) -> int:
    """Append all new drop files of ``source`` to ``out_path``; returns the
    number of micro-batches that the stream has committed so far."""
    stream = schemas.to_canonical_names(read_drops(spark, source, schema, pattern))
    w = (stream.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(partition_by)
    q = w.start()
    q.awaitTermination()
    last = q.lastProgress
    return last["batchId"] + 1 if last else 0
