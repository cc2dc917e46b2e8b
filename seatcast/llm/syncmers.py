"""Closed-syncmer fingerprints of documents.

Every run of ``K`` code points of a text is a candidate, at whatever place it
begins.  It is an anchor if the least hash of the runs of ``S`` code points
inside it belongs to its first or its last one.  That depends on the run alone,
not on what stands around it, so equal passages give equal anchors wherever they
occur, with or without blanks, and two anchors are never more than
``K - S`` places apart.  A fingerprint is the anchors in text order, eight hex
digits each; two fingerprints are as alike as the share of the larger one's
distinct anchors that both have.

Since anchors are free of context, an edited text needs no second reading: its
anchors are those of the parts it was made of, and of the few runs that cross
their border.

The next document comes from a window over key ranges of (doc_id, hash of the
text): boundaries by approximate percentiles of doc_id, an id of more rows than
a range should have (null too) in ranges of its own, cut by the hash.  The first row
of the next range that has rows is put into each range as a marked extra row, so no
range needs another and no task sees the whole order.  Only rows with equal id
and equal text are never parted; their window streams from disk.

Only DataFrame functions are used.  Cases: null text counts as empty; a text of
fewer than ``K`` code points has one anchor, an empty one none; two empty
fingerprints are alike (1), an empty and another are not (0); null ids come
first; rows with equal ids are ordered by the hash of their text; the next of a
single document is itself; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatcast.llm.common import shuffle_partitions, stage

K, S = 20, 5
ROWS_IN_RANGE = 2_000     # about; bounds what a window buffers
MOST_RANGES = 10_000      # beyond, ranges grow with the rows
LOWEST = -(1 << 63)
RANGE_BITS = 40           # below them stands the part of a hot id's range


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.transform(F.array(value), use)[0]


def hashes(text: Column, s: int = S) -> Column:
    """The hash of the ``s`` code points that begin at every place of the text."""
    runs = F.regexp_extract_all(text, F.lit(rf"(?s)(?![\x{{DC00}}-\x{{DFFF}}])(?=(.{{{s}}}))"), F.lit(1))
    return F.transform(runs, lambda r: F.xxhash64(r))


def least_ahead(h: Column, w: int, use: Callable[[Column], Column], have: int = 1) -> Column:
    """``use`` of the least of every ``w`` values in a row: of 2, 4, 8 ... and,
    overlapping, of ``w``.  Near the end there are fewer values."""
    if have == w:
        return use(h)
    step = min(have, w - have)
    ahead = F.slice(h, F.lit(step + 1), F.size(h))
    return let(F.zip_with(h, ahead, lambda a, b: F.least(a, b)), lambda m: least_ahead(m, w, use, have + step))


def _short(h: Column) -> Column:
    """The upper half of a 64-bit hash, as an unsigned number."""
    return F.shiftrightunsigned(h, 32)


def placed(text: Column, k: int = K, s: int = S) -> Column:
    """The closed syncmers in text order, each as place * 2**32 + 32-bit anchor;
    empty for a text shorter than ``k``."""
    w = k - s + 1
    parts = [*range(0, w - 1, s), w - 1]             # runs of s that cover the run of k

    def of(h, m):
        edge = F.filter(F.sequence(F.lit(0), F.size(h) - w),
                        lambda i: (F.get(m, i) == F.get(h, i)) | (F.get(m, i) == F.get(h, i + (w - 1))))
        return F.transform(edge, lambda i: F.shiftleft(i.cast("bigint"), 32) + _short(F.xxhash64(*[F.get(h, i + j) for j in parts])))

    return let(hashes(text, s), lambda h: F.when(F.size(h) >= w, least_ahead(h, w, lambda m: of(h, m)))
               .otherwise(F.array().cast("array<bigint>")))


def _whole(text: Column) -> Column:
    """What a text too short for an anchor has: one of its whole, none if empty."""
    return F.when(text == "", F.array().cast("array<bigint>")).otherwise(F.array(_short(F.xxhash64(text))))


def anchors(found: Column) -> Column:
    """The 32-bit anchors of ``placed`` ones."""
    return F.transform(found, lambda v: v.bitwiseAND(F.lit(0xFFFFFFFF)))


def fingerprint(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda a: F.lpad(F.hex(a), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    larger = F.greatest(F.size(F.array_distinct(a)), F.size(F.array_distinct(b)))
    return F.when(larger == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / larger)


def positions(docs: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """doc_id, anchor, at (code points before it): joined on ``anchor`` they
    align documents place by place."""
    found = docs.select("doc_id", F.explode(placed(F.coalesce("text", F.lit("")), k, s)).alias("v"))
    return found.select("doc_id", F.col("v").bitwiseAND(F.lit(0xFFFFFFFF)).alias("anchor"), F.shiftright("v", 32).cast("int").alias("at"))


def marks_below(marks: list[int], value: Column) -> Column:
    """How many of the ascending ``marks`` are less than ``value``, in two steps
    of about the square root of their number."""
    if not marks:
        return F.lit(0)
    step = isqrt(len(marks)) + 1
    below = lambda found: F.size(F.filter(found, lambda m: m < value))
    all_ = F.array(*map(F.lit, marks)).cast("array<bigint>")
    coarse = F.array(*map(F.lit, marks[::step])).cast("array<bigint>")
    block = lambda c: (c - 1) * step + below(F.slice(all_, (c - 1) * step + 1, F.lit(step)))
    return let(below(coarse), lambda c: F.when(c == 0, 0).otherwise(block(F.greatest(c, F.lit(1)))))


def ranges(docs: DataFrame) -> DataFrame:
    """doc_id, text, tie and the number of the range of (doc_id, tie), in their order."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    total = rows.count()
    n = max(shuffle_partitions(docs.sparkSession), min(MOST_RANGES, total // ROWS_IN_RANGE))
    most = max(ROWS_IN_RANGE, total // n)
    marks = rows.agg(F.percentile_approx("doc_id", F.array(*[F.lit(i / n) for i in range(1, n)]), 10_000)).first()[0] if n > 1 else []
    hot = {r["doc_id"]: -(-r["count"] // most) for r in rows.groupBy("doc_id").count().where(F.col("count") > most).collect()}  # at most n
    own = [i for i in hot if i is not None]
    marks = sorted({*(marks or []), *own, *(i - 1 for i in own if i > LOWEST)})          # a hot id has a range of its own
    cuts = {marks.index(i): hot[i] for i in own}
    number, parts = marks_below(marks, F.col("doc_id")), F.lit(1)
    if cuts:
        parts = F.get(F.array(*[F.lit(cuts.get(i, 1)) for i in range(len(marks) + 1)]), number)
    number = F.when(F.col("doc_id").isNull(), 0).otherwise(number + 1).cast("bigint")
    parts = F.when(F.col("doc_id").isNull(), F.lit(hot.get(None, 1))).otherwise(parts)
    part = F.least(F.floor((F.col("tie").cast("double") / 2.0 ** 64 + 0.5) * parts), parts - 1)
    return rows.withColumn("range", F.shiftleft(number, RANGE_BITS) + part)


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text in ascending order of doc_id, the first after the last."""
    rows = ranges(docs)
    firsts = rows.groupBy("range").agg(F.min(F.struct("doc_id", "tie")).alias("first"))
    order = Window.orderBy("range")          # a row per range
    firsts = firsts.select(F.coalesce(F.lag("range").over(order), F.max("range").over(Window.partitionBy())).alias("to"),
                           F.col("range").alias("from"), "first.doc_id", "first.tie")
    firsts = stage(firsts, "firsts").select("to", "from", F.col("doc_id").alias("first_id"), F.col("tie").alias("first_tie"))
    heads = (rows.join(firsts, (F.col("range") == F.col("from")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
                       & (F.col("tie") == F.col("first_tie")))
             .dropDuplicates(["from"]))
    both = (rows.select("range", F.lit(0).alias("extra"), "doc_id", "tie", "text")
            .unionByName(heads.select(F.col("to").alias("range"), F.lit(1).alias("extra"), "doc_id", "tie", "text")))
    return both.repartition("range")


def fingerprints(docs: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """Fingerprints of every text and of its edited text (its last half replaced
    by the beginning of the next one), and their likeness."""
    rows = with_next(docs).withColumn("placed", placed(F.col("text"), k, s)).withColumn("n", F.char_length("text"))
    follow = Window.partitionBy("range").orderBy("extra", "doc_id", "tie")
    rows = rows.select("*", *[F.lead(c).over(follow).alias(f"next_{c}") for c in ("text", "placed", "n")]).where("extra = 0")
    cut = F.col("n") - F.floor(F.col("n") / 2).cast("int")                # kept of the text
    rows = rows.withColumn("cut", cut).withColumn("half", F.least(F.col("n") - F.col("cut"), "next_n"))
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("cut")), F.substring("next_text", F.lit(1), F.col("half"))))
    within = lambda found, n: F.filter(found, lambda v: F.shiftright(v, 32) + k <= n)
    at = F.greatest(F.col("cut") - (k - 1), F.lit(0))
    border = F.substring("edited", at + 1, F.col("cut") - at + F.least(F.col("half"), F.lit(k - 1)))
    border = anchors(placed(border, k, s))
    parts = F.concat(anchors(within(F.col("placed"), F.col("cut"))), border, anchors(within(F.col("next_placed"), F.col("half"))))
    found = lambda text, n, got: F.when(n >= k, got).otherwise(_whole(text))
    rows = (rows.withColumn("found", found(F.col("text"), F.col("n"), anchors(F.col("placed"))))
            .withColumn("next_found", found(F.col("next_text"), F.col("next_n"), anchors(F.col("next_placed"))))
            .withColumn("edited_found", found(F.col("edited"), F.col("cut") + F.col("half"), parts)))
    return rows.select("doc_id", F.col("n").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       fingerprint(F.col("found")).alias("fingerprint"),
                       fingerprint(F.col("edited_found")).alias("edited_fingerprint"),
                       likeness(F.col("found"), F.col("edited_found")).alias("near_edited"),
                       likeness(F.col("found"), F.col("next_found")).alias("near_next"))
