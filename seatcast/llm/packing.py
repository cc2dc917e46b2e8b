"""Shortest-pack-first histogram packing of token sequences.

Documents become token ids plus an end id and are cut into pieces of at most
``length`` ids.  Only the histogram of piece lengths (at most ``length`` rows)
reaches the driver.  There lengths are placed longest first, each into the
pattern with the most room, whose count is split when fewer pieces than packs
remain; a pattern is a list of lengths with the number of packs that have it.
The patterns then go back to the pieces by rank: the r-th piece of a length
takes the r-th place that the patterns have for it.  Ranks come from row
numbers within (length, hash bucket) plus bucket offsets, so a length that most
pieces share is ranked by many tasks.

The table of places depends on the histogram only: every length adds at most
one new pattern and splits at most one, so there are at most ``2 * length``
patterns of at most ``length`` entries whatever the corpus size.

Cases: null or empty text gives the piece of the end id alone; a text longer
than a sequence gives several pieces, the last one shorter; null ids and
repeated rows are packed like any others (equal pieces are interchangeable);
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seatcast.llm.common import shuffle_partitions, stage
from seatcast.llm.tokens import default_path, encoder

LENGTH, END_ID = 2048, 1
RANK_SPLITS = 64     # least number of hash buckets that share the ranking of a length
PIECES = "doc_id bigint, start bigint, length bigint, ids binary, ids_crc32 bigint, doc_tokens bigint, doc_no bigint"


def pieces(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece; ``ids`` are little-endian u32, ``doc_no`` counts the
    rows of a task, so that equal documents stay apart."""
    tokenizer = tokenizer or default_path()

    def cut(batches):
        enc, doc_no = encoder(tokenizer), 0
        for batch in batches:
            cols, held = [[] for _ in range(7)], 0
            for key, ids in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1))):
                ids = np.append(ids, np.array([end_id], enc.dtype)).astype("<u4")
                for at in range(0, len(ids), length):
                    piece = ids[at:at + length].tobytes()
                    row = key, at, len(piece) // 4, piece, zlib.crc32(piece), len(ids), doc_no
                    for c, v in zip(cols, row):
                        c.append(v)
                    held += len(piece)
                doc_no += 1
                if held > 4 << 20:
                    yield batch_of(cols)
                    cols, held = [[] for _ in range(7)], 0
            yield batch_of(cols)

    def batch_of(cols):
        names = [c.split()[0] for c in PIECES.split(", ")]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.binary() if n == "ids" else pa.int64()) for n, c in zip(names, cols)], names=names)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(cut, PIECES)


def patterns(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[list[int], int]]:
    """Shortest-pack-first placement of ``{piece length: pieces}``: patterns
    (lengths in order of placing) with the number of sequences of each."""
    groups: dict[int, tuple[tuple | None, int]] = {}    # id -> (linked lengths, packs)
    heap: list[tuple[int, int]] = []                    # (-room, id): the emptiest pack first
    ids = count()

    def put(chain, packs, room):
        g = next(ids)
        groups[g] = chain, packs
        if room:
            heapq.heappush(heap, (-room, g))

    for n in sorted(histogram, reverse=True):
        left, placed = histogram[n], []
        while left and heap and -heap[0][0] >= n:
            room, g = -heap[0][0], heapq.heappop(heap)[1]
            chain, packs = groups.pop(g)
            used = min(packs, left)
            left -= used
            if used < packs:
                put(chain, packs - used, room)
            put((chain, n), used, room - n)
        per = length // n
        for fill, packs in ((per, left // per), (left % per, 1)):     # what is left fills new packs among itself
            if fill and packs:
                chain = None
                for _ in range(fill):
                    chain = chain, n
                put(chain, packs, length - fill * n)
    out = []
    for chain, packs in groups.values():
        lengths = []
        while chain:
            chain, n = chain
            lengths.append(n)
        out.append((lengths[::-1], packs))
    return out


def places(histogram: dict[int, int], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Sorted runs of ranks: from key ``(length, first rank)`` on, the pieces
    go to sequences ``first_sequence, +1, ...`` at ``offset``."""
    runs, taken, sequence = [], dict.fromkeys(histogram, 0), 0
    for lengths, packs in patterns(histogram, length):
        offset = 0
        for n in lengths:
            runs.append((n, taken[n], sequence, offset))
            taken[n] += packs
            offset += n
        sequence += packs
    runs.sort()
    arr = np.array(runs, np.int64).reshape(-1, 4)
    return arr[:, 0] << 44 | arr[:, 1], arr[:, 2], arr[:, 3]


def place(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """``cut`` (columns doc_id, start, length, ...) with sequence_id and offset."""
    spark = cut.sparkSession
    splits = max(RANK_SPLITS, shuffle_partitions(spark))
    keyed = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "doc_no"), F.lit(splits)).cast("int"))
    counts = keyed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = stage(counts.select("length", "bucket", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")), "counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    shared = spark.sparkContext.broadcast(places(histogram, length))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32", "doc_no")
    ranked = (keyed.withColumn("rank", F.row_number().over(within) - 1)
              .join(counts.drop("n"), ["length", "bucket"])
              .withColumn("rank", F.col("rank") + F.col("first")).drop("bucket", "first"))

    @F.arrow_udf("sequence_id bigint, offset bigint")
    def find(n: pa.Array, rank: pa.Array) -> pa.Array:
        keys, first, offset = shared.value
        key = n.to_numpy(zero_copy_only=False) << 44 | rank.to_numpy(zero_copy_only=False)
        at = np.searchsorted(keys, key, "right") - 1
        return pa.StructArray.from_arrays([pa.array(first[at] + (key - keys[at])), pa.array(offset[at])],
                                          names=["sequence_id", "offset"])

    return (ranked.withColumn("place", find("length", "rank"))
            .select(*[c for c in cut.columns], F.col("place.sequence_id").alias("sequence_id"),
                    F.col("place.offset").alias("offset")))


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end_id: int = END_ID,
         with_ids: bool = True) -> DataFrame:
    """Every piece of every document with its place; the ids are stored once
    and travel only where they are asked for."""
    cut = stage(pieces(docs, tokenizer, length, end_id), "pieces")
    return place(cut if with_ids else cut.drop("ids"), length).drop("doc_no")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed rows: sequence_id, n_tokens, ids (the pieces in place order);
    a group is one sequence, so at most ``length`` ids."""
    got = packed.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"), F.sum("length").alias("n_tokens"))
    return got.select("sequence_id", "n_tokens",
                      F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
