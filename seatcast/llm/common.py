"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seatcast.session import ensure_checkpoint_dir

CLASSES = 500      # classes that a training sample is spread over
WORD = r"[^\x20\x09-\x0D]+"  # a maximal run of non-blank characters


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage is cut,
    a lost executor's work is re-read, and later plans know its exact size (so
    a join broadcasts it only below ``autoBroadcastJoinThreshold``)."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def id_crc(doc_id: Column) -> Column:
    """crc32 of the id as text; that of the empty text for a null id."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the ids that no model learns from (null ids included)."""
    return id_crc(doc_id) % 5 == 0


def least_hashes(rows: DataFrame, hash_col: str, n: int) -> DataFrame:
    """About ``n`` of ``rows``: those whose hash lies in the lowest part of its
    range that should hold as many.  Tasks send only these rows, so a training
    sample stays bounded however many tasks read the corpus."""
    total = rows.count()
    share = min(1.0, n / total) if total else 1.0
    part = F.pmod(F.col(hash_col), F.lit(1 << 32))
    return rows.where(part < F.lit(int(share * (1 << 32))))


def stratified(rows: DataFrame, hash_col: str, n: int, by: str, least: int) -> DataFrame:
    """About ``n`` of ``rows`` by low hash, and of every value of ``by`` at least
    about ``least`` (all, where there are fewer), so that rare classes are met.
    The ``CLASSES`` commonest values count as classes.  Rows of equal hash are
    for the caller to merge: distinct hashes are what the shares bound."""
    counted = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), by).limit(CLASSES).collect()
    total = rows.count()
    share = min(1.0, n / total) if total else 1.0
    limit = F.lit(int(share * (1 << 32)))
    rare = {r[by]: int(min(1.0, least / r["n"]) * (1 << 32)) for r in counted if least / r["n"] > share}
    if rare:
        limits = F.create_map(*[F.lit(v) for kv in rare.items() for v in kv])
        limit = F.coalesce(F.element_at(limits, F.col(by)), limit)
    return rows.where(F.pmod(F.col(hash_col), F.lit(1 << 32)) < limit)


def bounded(text: Column, most_bytes: int, pieces: int = 16) -> Column:
    """``text``, or of one longer than ``most_bytes`` that much at most: pieces at
    random places spread over the whole text, a blank between them."""
    size, n = most_bytes // 4 // pieces, F.char_length(text)
    room = (n - size) / pieces
    at = lambda i: F.floor((F.lit(i) + F.pmod(F.xxhash64(n, F.lit(i)), F.lit(1000)) / 1000) * room) + 1
    runs = [F.substr(text, at(i).cast("int"), F.lit(size)) for i in range(pieces)]
    return F.when(F.octet_length(text) <= most_bytes, text).when(text.isNotNull(), F.concat_ws(" ", *runs))


def texts_of(column, rows: int = 128):
    """The values of an Arrow string column as bytes (empty for null), a few
    rows at a time, so that a batch is never held twice."""
    for at in range(0, len(column), rows):
        for value in column.slice(at, rows).cast("binary").to_pylist():
            yield value or b""


def filesystem(uri: str):
    """pyarrow file system and inner path of a Spark path (file, hdfs, s3, gs)."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
