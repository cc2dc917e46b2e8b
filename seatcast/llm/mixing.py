"""Mixing sources to target weights by hash-threshold histograms.

Sizes are summed per source; the targets share the whole size by weight, stop
at ``most`` times a source's size and share what is over among the rest.  A
source whose target is q whole copies and a rest takes every document q times,
and those up to a threshold once more.  The threshold is found without sorting:
sizes are summed by (source, hash bucket), a running sum names the one bucket in
which the rest runs out, and only that bucket is split into finer buckets, until
it holds a single row.  Rows are told apart by the hash of their id, those of
one id by the hash of their text, and copies by their place in the stored table,
so a repeated or null id is cut through like any other.  A larger budget takes a
superset; reruns agree, save for which of several copies of one (id, text) are
taken.

Sums are pre-aggregated per task, a hot source or id is split over its buckets,
and what later rounds read shrinks with every round.

Cases: null text has size 0; a null source is a source of its own (last in
order); a null id hashes as the empty text; an empty table, or one without
words, takes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatcast.llm.common import WORD, fresh, stage

LEVEL_BITS, LEVELS = 12, 5          # 60 bits of hash
KEYS = ("hash", "text_hash", "place")
WEIGHTS = (1, 2, 3)                 # repeating over the sources in code-point order
MOST = 3                            # a target is at most so many times its source's size


def _md5(text) -> Column:
    """60 bits of the md5 of a text."""
    return F.conv(F.substring(F.md5(F.coalesce(text, F.lit("")).cast("binary")), 1, 15), 16, 10).cast("bigint")


def measures(docs: DataFrame) -> dict[str, Column]:
    """size (words), hash (of the id as text) and text_hash of every row."""
    return {"size": F.coalesce(F.regexp_count(docs["text"], F.lit(WORD)), F.lit(0)).cast("bigint"),
            "hash": _md5(docs["doc_id"].cast("string")), "text_hash": _md5(docs["text"])}


def place(stored: DataFrame) -> Column:
    """60 bits that name a row of a stored table: its file and its number there."""
    at = stored.metadataColumn("_metadata")
    return F.shiftrightunsigned(F.xxhash64(at["file_path"], at["row_index"]), 64 - LEVEL_BITS * LEVELS)


def targets(rows: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target: one row per source.  Sources whose cap is
    below their share of the rest are capped; the first uncapped one in the order
    of cap over weight fixes the share of all that follow."""
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())          # a row per source
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1)
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    per = (per.withColumn("capped", F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
           .withColumn("open", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
           .withColumn("total", F.sum("source_size").over(Window.partitionBy())))
    share = (F.col("total") - F.col("capped")) / F.col("open")
    first = F.max(F.when(share * F.col("weight") <= F.col("cap"), share)).over(Window.partitionBy())
    return (per.withColumn("share", F.coalesce(first, F.lit(0.0)))
            .select("source", "source_size",
                    F.round(F.least(F.col("cap").cast("double"), F.col("share") * F.col("weight")), 6).alias("target")))


def thresholds(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """source, source_size, target, copies (whole ones) and a cut for each of
    ``KEYS``: rows whose keys, compared in order, are not above the cuts are taken
    once more (hashes are never negative, so none at a first cut of -1)."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goals = stage(goals.withColumn("copies", whole.cast("bigint"))
                  .withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size")), "targets")
    zero, none, every = (F.lit(v).cast("bigint") for v in (0, -1, (1 << 63) - 1))
    waiting = goals.where("rest > 0").select("source", "rest", zero.alias("below"), *[none.alias(f"cut_{k}") for k in KEYS])
    settled = None
    for i, key in enumerate(KEYS):
        seek, waiting = waiting.withColumn("prefix", zero), None       # cuts of earlier keys are those of one class of rows
        for level in range(1, LEVELS + 1):
            edge = _edge(rows, seek, i, level)
            alone = F.col("n") == 1 if i + 1 < len(KEYS) else F.col("low") == F.col("high")
            nearer = F.when(F.col("to") - F.col("rest") <= F.col("rest") - F.col("below"), F.col("high")).otherwise(F.col(f"cut_{key}"))
            done = edge.where(alone).withColumn(f"cut_{key}", nearer)
            done = done.select(F.col("source").alias("of"), *[f"cut_{k}" for k in KEYS[:i + 1]], *[every.alias(f"cut_{k}") for k in KEYS[i + 1:]])
            settled = done if settled is None else settled.unionByName(done)
            alike = edge.where((F.col("low") == F.col("high")) & ~alone).withColumn(f"cut_{key}", F.col("high"))
            alike = alike.select("source", "rest", "below", *[f"cut_{k}" for k in KEYS])
            waiting = alike if waiting is None else waiting.unionByName(alike)
            seek = edge.where("low < high").drop("to", "low", "high", "n")
            if seek.isEmpty():
                break
        if waiting.isEmpty():
            break
    return (goals.join(settled, goals["source"].eqNullSafe(F.col("of")), "left")
            .select("source", "source_size", "target", "copies", *[F.coalesce(f"cut_{k}", none).alias(f"cut_{k}") for k in KEYS]))


def _edge(rows: DataFrame, seek: DataFrame, i: int, level: int) -> DataFrame:
    """The bucket in which each source's rest runs out, among those of key ``i``
    under the prefix found so far: with the sums below and up to it, its rows, and
    in cut_<key> the greatest key before it."""
    key, shift = KEYS[i], LEVEL_BITS * (LEVELS - level)
    s = seek.withColumnRenamed("source", "of")
    same = rows["source"].eqNullSafe(F.col("of")) & (F.shiftright(rows[key], shift + LEVEL_BITS) == F.col("prefix"))
    for k in KEYS[:i]:
        same = same & (rows[k] == F.col(f"cut_{k}"))
    held = ["source", "rest", "below", *[f"cut_{k}" for k in KEYS]]
    cells = (rows.join(s, same).withColumn("bucket", F.shiftright(key, shift) if shift else F.col(key))
             .groupBy(*held, "bucket")
             .agg(F.sum("size").alias("cell"), F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high")))
    order = Window.partitionBy("source").orderBy("bucket")
    before = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    cells = cells.withColumn("to", F.col("below") + F.sum("cell").over(order)).withColumn(f"cut_{key}", F.coalesce(before, f"cut_{key}"))
    edge = cells.where((F.col("to") >= F.col("rest")) & (F.col("to") - F.col("cell") < F.col("rest")))
    return stage(edge.select("source", "rest", (F.col("to") - F.col("cell")).alias("below"), *[f"cut_{k}" for k in KEYS],
                             F.col("bucket").alias("prefix"), "to", "low", "high", "n"), f"edge_{key}{level}")


def _once(keys, cuts) -> Column:
    return F.when(F.struct(*keys) <= F.struct(*cuts), 1).otherwise(0)


def copies(docs: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, size, source_size, target and copies (how often the mix takes it)."""
    rows = stage(docs.select("doc_id", "source", *[e.alias(n) for n, e in measures(docs).items()]), "sizes")
    rows = rows.select("*", place(rows).alias("place"))
    plan = stage(thresholds(rows, targets(rows, weights, most)), "plan").withColumnRenamed("source", "of")
    once = _once([F.col(k) for k in KEYS], [F.col(f"cut_{k}") for k in KEYS])
    return (rows.join(plan, rows["source"].eqNullSafe(F.col("of")), "left")
            .select("doc_id", "size", "source_size", "target", (F.col("copies") + once).cast("bigint").alias("copies")))


def mix(docs: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken.  The
    rows are stored with their measures first, which gives every one its place."""
    names = {c: fresh(docs, c) for c in ("size", *KEYS, "copies", "of", "n", *[f"cut_{k}" for k in KEYS])}
    stored = stage(docs.withColumns({names[c]: e for c, e in measures(docs).items()}), "measured")
    stored = stored.select("*", place(stored).alias(names["place"]))
    rows = stored.select("source", *[F.col(names[c]).alias(c) for c in ("size", *KEYS)])
    plan = stage(thresholds(rows, targets(rows, weights, most)), "plan")
    plan = plan.select(F.col("source").alias(names["of"]), *[F.col(c).alias(names[c]) for c in ("copies", *[f"cut_{k}" for k in KEYS])])
    joined = stored.join(plan, stored["source"].eqNullSafe(F.col(names["of"])), "left")
    times = F.col(names["copies"]) + _once([F.col(names[k]) for k in KEYS], [F.col(names[f"cut_{k}"]) for k in KEYS])
    again = F.explode(F.array_repeat(F.lit(1), times.cast("int"))).alias(names["n"])
    return joined.select(*[stored[c] for c in docs.columns], again).drop(names["n"])
