"""Histogram sort into shards of near-equal bytes.

The key of a row is (hash of its text, hash of its id).  Splitters between
shards are found by counting exact bytes below candidate boundaries over all
rows: each round lays 2**12 probes over every key interval that still holds
an undecided splitter and only counts rows inside those intervals.  A splitter
is settled when its interval holds no more than ``tolerance`` of a shard's
share.  An interval that holds a single text is cut by id hash instead, and one
that holds a single text and id by a hash of the row's number, so equal texts
stay together unless their group is too large for that, and a group of a third
of all rows is spread, copies of one row included.  Rows then go to their shard
in one exchange.

The driver sees at most ``(n_shards - 1) * 2**12`` sums a round.  A slot is the
row's rank in its shard: the row number in (shard, key range, row-hash class)
plus the ranges' offsets, so neither a shard nor a group is ranked by one task.

Cases: null text counts as no bytes (size 1, checksum 0); an empty text
likewise; repeated rows (same text and id) are split only where a splitter falls
among them, and are alike, so which of them goes where is no matter; null ids
share one hash; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatcast.llm.common import shuffle_partitions, stage

PROBE_BITS = 12
LOWEST = -(1 << 63)
KEY = ("text_hash", "id_hash", "row_hash")


@dataclass(frozen=True)
class Interval:
    """Keys that begin with the hashes ``fixed`` (of one text, or one text and
    id) and whose next hash has the first ``bits`` bits ``prefix`` (signed)."""
    bits: int = 0
    prefix: int = 0
    fixed: tuple[int, ...] = ()

    @property
    def column(self) -> Column:
        return F.col(KEY[len(self.fixed)])

    @property
    def step(self) -> int:
        return min(PROBE_BITS, 64 - self.bits)

    def has(self) -> Column:
        inside = F.lit(True) if not self.bits else F.shiftright(self.column, 64 - self.bits) == F.lit(self.prefix)
        for c, v in zip(KEY, self.fixed):
            inside = (F.col(c) == F.lit(v)) & inside
        return inside

    def probe(self) -> Column:
        """The row's sub-interval: its prefix with ``step`` more bits."""
        left = 64 - self.bits - self.step
        return F.shiftright(self.column, left) if left else self.column

    def start(self, prefix: int) -> tuple[int, ...]:
        """The key at which the sub-interval ``prefix`` begins."""
        key = (*self.fixed, prefix << (64 - self.bits - self.step))
        return key + (LOWEST,) * (len(KEY) - len(key))


def keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text")
    return docs.select(
        F.col("doc_id").cast("bigint"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).alias("text_crc32"),
        *hashes())


def hashes() -> list[Column]:
    """The parts of a row's key."""
    return [F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), F.xxhash64("doc_id").alias("id_hash"),
            F.xxhash64(F.monotonically_increasing_id()).alias("row_hash")]


def shard_number(bounds: list[tuple[int, ...]]) -> Column:
    """How many splitters are not above the row's key."""
    number = F.lit(0)
    for bound in bounds:
        at = F.lit(True)
        for c, v in reversed(list(zip(KEY, bound))):
            at = (F.col(c) > F.lit(v)) | (F.col(c) == F.lit(v)) & at
        number = number + at.cast("int")
    return number.cast("int")


def splitters(rows: DataFrame, n_shards: int, tolerance: float) -> list[tuple[int, ...]]:
    """The first key of each shard but the first, ascending."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    found: dict[int, tuple[int, ...]] = {}
    # splitter -> (interval that holds it, bytes below that interval)
    open_ = {j: (Interval(), 0) for j in range(1, n_shards)} if total else {}
    while open_:
        intervals = list(dict.fromkeys(i for i, _ in open_.values()))
        number, probe = F.lit(None).cast("int"), F.lit(None).cast("bigint")
        for k, i in enumerate(intervals):
            number, probe = F.when(i.has(), k).otherwise(number), F.when(i.has(), i.probe()).otherwise(probe)
        counted = (rows.select(number.alias("k"), probe.alias("probe"), "size", *KEY)
                   .where("k is not null").groupBy("k", "probe")
                   .agg(F.sum("size").alias("size"), *[f(c).alias(f"{n}_{c}") for c in KEY
                                                       for n, f in (("min", F.min), ("max", F.max))]).collect())
        by: dict[int, list] = {}
        for r in sorted(counted, key=lambda r: (r["k"], r["probe"])):
            by.setdefault(r["k"], []).append(r)
        for j, (interval, below) in list(open_.items()):
            goal = j * total / n_shards
            cells = by[intervals.index(interval)]
            for n, r in enumerate(cells):
                if below + r["size"] >= goal or n == len(cells) - 1:
                    break
                below += r["size"]
            alike = len(interval.fixed)           # leading hashes that all rows of the cell share
            while alike < len(KEY) and r[f"min_{KEY[alike]}"] == r[f"max_{KEY[alike]}"]:
                alike += 1
            if r["size"] * n_shards <= tolerance * total or alike == len(KEY):
                # whichever end of the cell is nearer; the end is where the next key begins
                after = (*[r[f"max_{c}"] for c in KEY[:-1]], r[f"max_{KEY[-1]}"] + 1)
                at = tuple(r[f"min_{c}"] for c in KEY) if alike == len(KEY) else interval.start(r["probe"])
                found[j] = at if goal - below <= below + r["size"] - goal else after
                del open_[j]
            elif alike > len(interval.fixed):
                open_[j] = Interval(fixed=tuple(r[f"min_{c}"] for c in KEY[:alike])), below
            else:
                open_[j] = Interval(interval.bits + interval.step, r["probe"], interval.fixed), below
    return [found[j] for j in sorted(found)]


def shard(docs: DataFrame, n_shards: int = 16, tolerance: float = 0.001) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row."""
    rows = stage(keyed(docs), "keys")
    bounds = splitters(rows, n_shards, tolerance)
    classes = max(64, shuffle_partitions(docs.sparkSession))
    cell = ["shard", "range", "class"]
    placed = rows.select("*", shard_number(bounds).alias("shard"),
                         F.shiftright("text_hash", 64 - PROBE_BITS).cast("int").alias("range"),
                         F.pmod("row_hash", F.lit(classes)).cast("int").alias("class"))
    before = Window.partitionBy("shard").orderBy("range", "class").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"))
               .select(*cell, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    within = Window.partitionBy(*cell).orderBy(*KEY)
    return (placed.withColumn("at", F.row_number().over(within) - 1).join(offsets, cell)
            .select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("at")).cast("bigint").alias("slot")))


def write_shards(docs: DataFrame, path: str, n_shards: int = 16, tolerance: float = 0.001) -> None:
    """Write whole rows to ``path/shard=<n>/`` after one exchange on (shard, hash class)."""
    probe = docs.select("*", *hashes())
    bounds = splitters(stage(keyed(docs), "keys"), n_shards, tolerance)
    parts = shuffle_partitions(docs.sparkSession)
    (probe.withColumn("shard", shard_number(bounds)).withColumn("part", F.pmod("row_hash", F.lit(max(1, parts // n_shards))))
     .repartition("shard", "part").drop(*KEY, "part").write.partitionBy("shard").parquet(path))
