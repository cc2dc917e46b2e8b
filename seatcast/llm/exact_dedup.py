"""Exact deduplication with two-pass Bloom filtering.

Each text becomes the SHA-256 of itself with A-Z in lower case; these digests
(never the texts) are stored.  Pass 1 builds a filter of the digests seen more
than once: a task sends, for each range of the filter, the bits that its
digests set and the bits of those it saw repeatedly; where ranges meet, a bit
set by two senders, or sent as repeated, is a bit of the filter.  A digest that
occurs twice has all its bits there, whichever tasks saw it.  Pass 2 probes the
filter with every digest.  Rows without all their bits are unique and pass
straight through; only the others are shuffled, by digest, and counted exactly,
so the filter's errors cost time and never change a result.

The filter has ``BITS_PER_ROW`` bits a row (about 0.3 % of the unique rows are
shuffled in vain) up to ``MAX_BLOCKS`` blocks, 128 MB, which is what a worker
can hold and what bounds the broadcast.  A larger corpus fills it more densely;
then more unique digests join the shuffle, at worst all of them.

Cases: null text counts as empty, all empty texts are one group; a null id is
smaller than any other, a group of null ids alone keeps one row and its keep_id
is null; of rows with the same text and id just one stays; an empty table gives
no rows; other columns are carried along (``dedup``) or not read (``groups``).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatcast.llm.common import fresh, shuffle_partitions, stage, texts_of

BITS_PER_ROW, PROBES = 16, 4
BLOCK = 1 << 16            # bits of a block; a digest's bits lie in one block
MAX_BLOCKS = 1 << 14
CHUNK = 1 << 17            # digests that a task gathers before it sends their bits
SIGHTINGS = "part int, once binary, again binary"


@F.arrow_udf(T.BinaryType())
def digest(text: pa.Array) -> pa.Array:
    """SHA-256 of each text; ``bytes.lower`` changes A-Z only."""
    return pa.array([hashlib.sha256(t.lower()).digest() for t in texts_of(text)], pa.binary())


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest and a number for each row."""
    return docs.select(F.col("doc_id").cast("bigint"), digest("text").alias("digest"),
                       F.monotonically_increasing_id().alias("row"))


def _as_bytes(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


def bits_of(d: np.ndarray, blocks: int) -> np.ndarray:
    """(n, PROBES) bit numbers of n digests."""
    block = np.ascontiguousarray(d[:, :4]).view("<u4").astype(np.int64) & (blocks - 1)
    return block * BLOCK | np.ascontiguousarray(d[:, 8:8 + 2 * PROBES]).view("<u2")


def _power(n: int) -> int:
    return 1 << max(0, (int(n) - 1).bit_length())


class Filter:
    """The bits of digests that occur more than once in ``rows`` (column digest)."""

    def __init__(self, rows: DataFrame, n_rows: int, bits_per_row: int = BITS_PER_ROW, max_blocks: int = MAX_BLOCKS):
        spark = rows.sparkSession
        self.blocks = blocks = min(_power(-(-n_rows * bits_per_row // BLOCK)), max_blocks)
        parts = min(blocks, _power(max(shuffle_partitions(spark), n_rows >> 20)))
        width = blocks // parts * BLOCK

        def sightings(batches):
            held, n = [], 0
            for batch in batches:
                for at in range(0, batch.num_rows, CHUNK):
                    held.append(_as_bytes(batch.column(0).slice(at, CHUNK)))
                    n += len(held[-1])
                    if n >= CHUNK:
                        yield from sent(np.concatenate(held))
                        held, n = [], 0
            if n:
                yield from sent(np.concatenate(held))

        def sent(d):
            key = np.ascontiguousarray(d[:, 16:24]).view("<u8")[:, 0]
            _, first, times = np.unique(key, return_index=True, return_counts=True)
            bits = bits_of(d[first], blocks)
            once, again = np.unique(bits), np.unique(bits[times > 1])
            number, at = np.unique(once // width, return_index=True)
            ends, cuts = np.append(at[1:], len(once)), np.searchsorted(again, np.append(number, parts) * width)
            low = lambda v: (v % width).astype("<u4").tobytes()
            for i in range(0, len(number), 4096):
                few = range(i, min(i + 4096, len(number)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number[i:i + 4096], pa.int32()), pa.array([low(once[at[k]:ends[k]]) for k in few], pa.binary()),
                     pa.array([low(again[cuts[k]:np.searchsorted(again, (number[k] + 1) * width)]) for k in few], pa.binary())],
                    names=["part", "once", "again"])

        def meet(table: pa.Table) -> pa.Table:
            seen, repeated = np.zeros(width, bool), np.zeros(width, bool)
            for batch in table.to_batches():
                for once, again in zip(batch.column(1), batch.column(2)):
                    once = np.frombuffer(once.as_buffer(), "<u4")
                    repeated[once[seen[once]]] = True
                    seen[once] = True
                    repeated[np.frombuffer(again.as_buffer(), "<u4")] = True
            return pa.table({"part": table.column(0)[:1], "bits": pa.array([np.packbits(repeated).tobytes()], pa.binary())})

        found = (rows.select("digest").mapInArrow(sightings, SIGHTINGS)
                 .groupBy("part").applyInArrow(meet, "part int, bits binary"))
        bits = np.zeros(blocks * BLOCK // 8, np.uint8)
        for r in found.collect():        # the filter itself, 128 MB at most
            bits[r["part"] * width // 8:(r["part"] + 1) * width // 8] = np.frombuffer(r["bits"], np.uint8)
        shared = spark.sparkContext.broadcast(bits)

        @F.arrow_udf(T.BooleanType())
        def may_repeat(column: pa.Array) -> pa.Array:
            b = bits_of(_as_bytes(column), blocks)
            return pa.array((shared.value[b >> 3] >> (7 - (b & 7)) & 1).all(axis=1))

        self.may_repeat = may_repeat


def _counted(rows: DataFrame, repeats: Filter) -> DataFrame:
    """n, keep_id and keep_row of every digest that the filter lets through;
    stored, so that a join knows its size and can split a hot digest's rows."""
    got = rows.where(repeats.may_repeat("digest")).groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keep_id"),
        F.coalesce(F.max_by("row", "doc_id"), F.max("row")).alias("keep_row"))
    return stage(got, "counted")


def groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = stage(digests(docs), "digests")
    repeats = Filter(rows, rows.count())
    shown = F.lower(F.hex("digest")).alias("text_sha256")
    alone = rows.where(~repeats.may_repeat("digest")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), shown)
    others = rows.where(repeats.may_repeat("digest")).join(_counted(rows, repeats), "digest")
    return alone.unionByName(others.select("doc_id", "keep_id", F.col("n").alias("group_size"),
                                           (F.col("row") == F.col("keep_row")).alias("kept"), shown))


def dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.  Texts that may
    repeat are shuffled only where their id is the one that stays."""
    rows = stage(digests(docs), "digests")
    repeats = Filter(rows, rows.count())
    own, key, best = (fresh(docs, c) for c in ("digest", "same", "best"))
    tagged = docs.withColumn(own, digest("text"))
    alone = tagged.where(~repeats.may_repeat(own)).select(*docs.columns)
    best_ids = _counted(rows, repeats).select(F.col("digest").alias(key), F.col("keep_id").alias(best))
    others = tagged.where(repeats.may_repeat(own)).join(
        best_ids, (F.col(own) == F.col(key)) & docs["doc_id"].cast("bigint").eqNullSafe(F.col(best)))
    return alone.unionByName(others.dropDuplicates([own]).select(*docs.columns))
