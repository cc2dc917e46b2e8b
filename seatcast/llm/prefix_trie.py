"""Prefix trie of conversations that share heads, from composable fingerprints.

A turn is an element of a monoid: with ``t`` the turn's hash and ``B`` a base,
a sequence of k turns is the map ``x -> x * B**k + f`` over the field of
2**127 - 1, and following one sequence by another composes their maps.  Running
products over the stored turns give ``f`` of every prefix.  A rebuilt
conversation is the first h turns of a base conversation followed by its own
turns after the h-th, so the fingerprint of any of its prefixes is combined from
three stored ones, ``(f_base(h) - f_own(h)) * B**k + f_own(h + k)``, and that of
the prefix one turn shorter by taking the last turn off again.  No rebuilt text
exists anywhere; a rebuilt turn is a reference to a stored turn, its SHA-256.

Rebuilt prefixes of one length with one fingerprint are a node.  Each node's
members must have one parent and refer to equal last turns; by induction from
the root the members then are equal sequences.  If a node fails that check, two
fingerprints met by chance, and all is done again with another base.

Sums over subtrees need no walk down the tree: a node belongs to its smallest
member, so a conversation owns the nodes of its path from some depth to its end.
A subtree holds, of each member, the owned nodes below: for the owner those from
this depth on, a running sum from the end, and for any other member all.

Running products and sums go over ranges of sorted rows: each task folds its own
rows, only the totals of the first and last conversation of a task reach the
driver (two rows a task), and what went before is added to the one conversation
that a task continues.  So a conversation may spread over any number of tasks.

Cases: order is by turn, nulls first, then role and the SHA-256 of the text;
null role or text is empty; rows without a conv_id belong to no conversation
and are left out; repeated rows are turns like any others; a conversation
without rebuilt turns is a member of the root alone; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatcast.llm.common import shuffle_partitions, stage

PRIME = (1 << 127) - 1
FIELDS = tuple((PRIME, seed) for seed in range(1, 9))     # what is tried, one after another
MAX_HEAD = 5
ID_BITS = 12                     # ids are gathered in runs of at most 2**12 before they are hashed
ZERO = bytes(16)
ARROW = {"bigint": pa.int64(), "binary": pa.binary(), "int": pa.int32()}


def contract_base(c: Column) -> Column:
    return c - c % 100


def contract_head(c: Column) -> Column:
    return (F.crc32(c.cast("string").cast("binary")) % (MAX_HEAD + 1)).cast("int")


def _int(b: bytes) -> int:
    return int.from_bytes(b, "little")


def _bin(i: int) -> bytes:
    return i.to_bytes(16, "little")


class Field:
    """Arithmetic of one attempt: a prime and a base drawn from a seed."""

    def __init__(self, prime: int, seed: int):
        self.p, self.key = prime, seed.to_bytes(4, "little")
        self.base = 2 + _int(hashlib.blake2b(b"base", key=self.key, digest_size=16).digest()) % (prime - 3)
        self.inverse = pow(self.base, -1, prime)
        self.power = lru_cache(1 << 12)(lambda k: pow(self.base, k, prime))

    def __reduce__(self):
        return Field, (self.p, _int(self.key))

    def turn(self, digest: bytes) -> int:
        return _int(hashlib.blake2b(digest, key=self.key, digest_size=16).digest()) % self.p

    def then(self, before: int, k: int, after: int) -> int:
        """Fingerprint of a sequence followed by k turns with fingerprint ``after``."""
        return (before * self.power(k) + after) % self.p

    def without(self, whole: int, last: int) -> int:
        return (whole - last) * self.inverse % self.p


def fold(rows: DataFrame, order: Sequence[Column], schema: str, made: str, begin: Callable, step: Callable) -> DataFrame:
    """Running fold within each conv_id, task by task.  ``step(state, row)`` gives
    the new state and the row's values; a state is a tuple of ``made``'s types.
    Result, stored: conv_id, part, total (true for the row that holds the state
    at the end of a task's first or last conversation), ``schema``, ``made``."""
    n = shuffle_partitions(rows.sparkSession)
    rows = rows.select("conv_id", *rows.drop("conv_id").columns)
    ordered = rows.repartitionByRange(n, "conv_id", *order).sortWithinPartitions("conv_id", *order)
    whole = f"conv_id bigint, part int, total boolean, {schema}, {made}"
    form = pa.schema([(c.split()[0], ARROW.get(c.split()[1], pa.bool_())) for c in whole.split(", ")])
    width, kept = len(schema.split(", ")), [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        part, key, state, first = TaskContext.get().partitionId(), None, None, True
        totals, out = [], []
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                few = batch.slice(at, 4096)
                cols = [few.column(c).to_pylist() for c in kept]
                for conv_id, row in zip(few.column("conv_id").to_pylist(), zip(*cols)):
                    if conv_id != key:
                        if first and key is not None:
                            totals.append((key, part, True, *[None] * width, *state))
                            first = False
                        key, state = conv_id, begin()
                    state = step(state, row)
                    out.append((conv_id, part, False, *row, *state))
                yield batch_of(out)
                out = []
        if key is not None:
            totals.append((key, part, True, *[None] * width, *state))
        if totals:
            yield batch_of(totals)

    def batch_of(out):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), form)], schema=form)

    return stage(ordered.mapInArrow(run, whole), "fold")


def continued(folded: DataFrame, made: Sequence[str], join: Callable) -> tuple[DataFrame, DataFrame]:
    """Rows of a fold, and (part, conv_id, before_...) for every conversation
    that an earlier task began: at most one row a task."""
    spark = folded.sparkSession
    totals = folded.where("total").select("part", "conv_id", *made).collect()      # two rows a task at most
    before, carried = [], {}
    for t in sorted(totals, key=lambda t: (t["part"], t["conv_id"])):
        state = tuple(t[c] for c in made)
        if t["conv_id"] in carried:
            before.append((t["part"], t["conv_id"], *carried[t["conv_id"]]))
            state = join(carried[t["conv_id"]], state)
        carried = {t["conv_id"]: state}
    types = dict(folded.dtypes)
    small = spark.createDataFrame(before, "part int, conv_id bigint, " + ", ".join(f"before_{c} {types[c]}" for c in made))
    return folded.where("not total").drop("total"), small


def turns(conversations: DataFrame, field: Field) -> DataFrame:
    """Every stored turn: conv_id, pos (from 1), digest (its role and text), chars, fp (of the turns up to it)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    tie = F.unhex(F.sha2(text, 256))
    rows = conversations.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint").alias("turn"), role.alias("role"), tie.alias("tie"),
        F.unhex(F.sha2(F.concat(tie, role.cast("binary")), 256)).alias("digest"),
        F.char_length(text).cast("bigint").alias("chars"), F.monotonically_increasing_id().alias("row")).where("conv_id is not null")
    order = [F.col(c) for c in ("turn", "role", "tie", "row")]

    def step(state, row):
        pos, fp = state
        return pos + 1, _bin(field.then(_int(fp), 1, field.turn(row[0])))

    def join(a, b):
        return a[0] + b[0], _bin(field.then(_int(a[1]), b[0], _int(b[1])))

    made = ["pos", "fp"]
    rows, before = continued(fold(rows, order, "digest binary, chars bigint", "pos bigint, fp binary", lambda: (0, ZERO), step),
                             made, join)

    @F.arrow_udf("binary")
    def after(head: pa.Array, pos: pa.Array, fp: pa.Array) -> pa.Array:
        return pa.array([f if h is None else _bin(field.then(_int(h), k, _int(f)))
                         for h, k, f in zip(head.to_pylist(), pos.to_pylist(), fp.to_pylist())], pa.binary())

    got = rows.join(F.broadcast(before), ["part", "conv_id"], "left")
    return got.select("conv_id", (F.col("pos") + F.coalesce("before_pos", F.lit(0))).alias("pos"), "digest", "chars",
                      after("before_fp", "pos", "fp").alias("fp"))


def members(stored: DataFrame, field: Field, base: Callable, head: Callable, max_head: int) -> DataFrame:
    """Every prefix of every rebuilt conversation: conv_id, depth, fp, parent (the
    fingerprint one turn shorter), turn (reference to the last turn), chars, ends
    (1 if the conversation stops there)."""
    @F.arrow_udf("binary")
    def difference(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([_bin((_int(x or ZERO) - _int(y or ZERO)) % field.p) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.binary())

    @F.arrow_udf("struct<fp: binary, parent: binary>")
    def spliced(change: pa.Array, k: pa.Array, fp: pa.Array, digest: pa.Array) -> pa.Array:
        whole, parent = [], []
        for c, n, f, d in zip(*(x.to_pylist() for x in (change, k, fp, digest))):
            now = field.then(_int(c), n, _int(f))
            whole.append(_bin(now))
            parent.append(_bin(field.without(now, field.turn(d))))
        return pa.StructArray.from_arrays([pa.array(whole, pa.binary()), pa.array(parent, pa.binary())], names=["fp", "parent"])

    c = F.col("conv_id")
    heads = stored.where(F.col("pos") <= max_head).select(c.alias("from"), F.col("pos").alias("depth"), "digest", "chars", "fp")
    lengths = stored.groupBy("conv_id").agg(F.max("pos").alias("own"))
    convs = stage(lengths.select("conv_id", "own", base(c).alias("from"), head(c).alias("h")), "convs")
    used = convs.select("from").distinct()
    heads = stage(heads.join(used, "from", "left_semi"), "heads")
    shared = stage(convs.join(heads, "from").where(F.col("depth") <= F.col("h")), "shared")
    met = shared.groupBy("conv_id").agg(F.max("depth").alias("hb"), F.max_by("fp", "depth").alias("fp_base"))
    cut = stored.where((F.col("pos") <= max_head) & (F.col("pos") == head(c))).select("conv_id", F.col("fp").alias("fp_own"))
    plan = convs.join(met, "conv_id", "left").join(cut, "conv_id", "left").withColumn("hb", F.coalesce("hb", F.lit(0)))
    plan = stage(plan.select(
        "conv_id", "h", "hb", difference("fp_base", "fp_own").alias("change"),
        (F.col("hb") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")), "plan")

    own = stored.where(F.col("pos") > head(c)).join(plan, "conv_id")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("hb")).alias("depth"),
                     spliced("change", F.col("pos") - F.col("h"), "fp", "digest").alias("s"),
                     F.col("digest").alias("turn"), "chars", "length")
    first = shared.join(plan.select("conv_id", "length"), "conv_id").select(
        "conv_id", "depth", spliced(F.lit(ZERO), "depth", "fp", "digest").alias("s"), F.col("digest").alias("turn"), "chars", "length")
    rest = own.unionByName(first).select("conv_id", "depth", "s.fp", "s.parent", "turn", "chars",
                                         (F.col("depth") == F.col("length")).cast("int").alias("ends"))
    root = plan.select("conv_id", F.lit(0).cast("bigint").alias("depth"), F.lit(ZERO).alias("fp"), F.lit(ZERO).alias("parent"),
                       F.lit(ZERO).alias("turn"), F.lit(0).cast("bigint").alias("chars"), (F.col("length") == 0).cast("int").alias("ends"))
    return stage(rest.unionByName(root), "members")


def nodes(found: DataFrame) -> tuple[DataFrame, bool]:
    """The nodes of ``members`` and whether every one is a single sequence."""
    got = stage(found.groupBy("depth", "fp").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum("ends").alias("ends"), F.min("chars").alias("chars"),
        F.min("parent").alias("parent"), ((F.min("parent") == F.max("parent")) & (F.min("turn") == F.max("turn"))).alias("equal")), "nodes")
    return got.drop("equal"), not got.where("not equal").limit(1).collect()


def ends_digest(found: DataFrame) -> DataFrame:
    """depth, fp, ends_sha256 of the nodes where conversations stop.  Ids are
    gathered and sorted in short runs; a node's runs are then hashed in order."""
    runs = found.where("ends = 1").groupBy("depth", "fp", F.shiftright("conv_id", ID_BITS).alias("run")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def hashed(batches):
        key, sha, out = None, None, []
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for depth, fp, ids in zip(*(batch.slice(at, 256).column(c).to_pylist() for c in ("depth", "fp", "ids"))):
                    if (depth, fp) != key:
                        if key:
                            out.append((*key, sha.hexdigest()))
                        key, sha = (depth, fp), hashlib.sha256(ids.encode())
                    else:
                        sha.update(b"," + ids.encode())
                if len(out) > 4096:
                    yield batch_of(out)
                    out = []
        if key:
            out.append((*key, sha.hexdigest()))
        yield batch_of(out)

    def batch_of(out):
        cols = list(zip(*out)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.string())],
                                          names=["depth", "fp", "ends_sha256"])

    return (runs.repartition("depth", "fp").sortWithinPartitions("depth", "fp", "run")
            .mapInArrow(hashed, "depth bigint, fp binary, ends_sha256 string"))


def below(found: DataFrame, tree: DataFrame) -> DataFrame:
    """depth, fp, conv_id, n_leaves and saved_tokens of every node's subtree."""
    own = tree.select("conv_id", "depth", "fp", (F.col("ends") == F.col("n_convs")).cast("bigint").alias("leaf"),
                      ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    made = ["leaves", "tokens"]
    folded = fold(own, [F.col("depth").desc()], "depth bigint, fp binary, leaf bigint, saved bigint", "leaves bigint, tokens bigint",
                  lambda: (0, 0), lambda state, row: (state[0] + row[2], state[1] + row[3]))
    rows, before = continued(folded, made, lambda a, b: (a[0] + b[0], a[1] + b[1]))
    rows = rows.join(F.broadcast(before), ["part", "conv_id"], "left")
    rows = stage(rows.select("conv_id", "depth", "fp", *[(F.col(m) + F.coalesce(f"before_{m}", F.lit(0))).alias(m) for m in made]), "owned")
    whole = rows.groupBy("conv_id").agg(F.min("depth").alias("top"), *[F.max(m).alias(f"all_{m}") for m in made])
    others = found.select("conv_id", "depth", "fp").join(stage(whole, "whole"), "conv_id").where("depth < top")
    others = others.groupBy("depth", "fp").agg(*[F.sum(f"all_{m}").alias(f"other_{m}") for m in made])
    got = rows.join(others, ["depth", "fp"], "left")
    return got.select("depth", "fp", *[(F.col(m) + F.coalesce(f"other_{m}", F.lit(0))).alias(n)
                                       for m, n in zip(made, ("n_leaves", "saved_tokens"))])


def trie(conversations: DataFrame, base: Callable = contract_base, head: Callable = contract_head, max_head: int = MAX_HEAD,
         fields: Sequence[tuple[int, int]] = FIELDS) -> DataFrame:
    """One row per node.  ``base`` and ``head`` give, for a conv_id, the
    conversation whose first turns it takes and how many (``max_head`` at most)."""
    for prime, seed in fields:
        field = Field(prime, seed)
        found = members(stage(turns(conversations, field), "turns"), field, base, head, max_head)
        tree, proven = nodes(found)
        if proven:
            break
    else:
        raise RuntimeError("no field told all sequences apart")
    children = tree.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("fp")).agg(
        F.count(F.lit(1)).alias("n_children"))
    at = ["depth", "fp"]
    got = stage(tree.join(below(found, tree), at).join(children, at, "left").join(ends_digest(found), at, "left"), "joined")
    up = tree.select((F.col("depth") + 1).alias("depth"), F.col("fp").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    got = got.join(up, ["depth", "parent"], "left")
    return got.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
                      "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
