"""SimHash near-duplicates, searched with Golay-code fuzzy hashing.

A 64-bit fingerprint is two segments A and B of 23 bits and a rest C of 18.
Every 23-bit word is within three bits of exactly one codeword of the perfect
binary Golay code.  A segment's keys are the codeword indices of the word and
of its 23 one-bit neighbours (one or six different ones), so any two words at
most two bits apart share one: that of the word halfway between.  With two
differing bits at most, (1) A is equal and B shares a key, or (2) B is equal
and A shares one, or (3) each has one bad bit, so C is equal and A shares a
key.  Joining on these keys finds every link; the bit distance is then checked.

Only distinct fingerprints are keyed.  A key that more than ``HOT`` of them
share would give pairs by the square; its fingerprints go another exact way:
each is filed under itself and its 64 one-bit neighbours, and all that meet at
such a midpoint (65 at most) are within two bits of each other, so linking them
to the least one keeps every component, in time linear in their number.

Components come from alternating large-star and small-star contraction on the
links, stored in the shared folder each round.

Cases: null or blank text has fingerprint zero and is linked like any other;
fewer than three words make one shingle; repeated rows get a row each and the
same component; a null id is never the smallest of a component that has others;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatcast.llm.common import fresh, stage, texts_of

SHINGLE, SEED, MAX_BITS = 3, 42, 2
HOT = 32
BLOCK = 1 << 15            # shingles whose bits are counted at a time
GOLAY = 0b110001110101     # generator x^11+x^10+x^6+x^5+x^4+x^2+1, a fixed value
SEGMENT = 23


def text_fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    from xxhash import xxh64_intdigest
    words = text.lower().split()       # bytes: A-Z and the six ASCII blanks only
    if not words:
        return 0
    runs = zip(*(words[i:] for i in range(shingle))) if len(words) >= shingle else [words]
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(map(xxh64_intdigest, map(b" ".join, runs), repeat(SEED)), "<u8", n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        bits = np.unpackbits(hashes[at:at + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


@F.arrow_udf(T.LongType())
def _fingerprints(text: pa.Array) -> pa.Array:
    return pa.array(np.fromiter(map(text_fingerprint, texts_of(text)), np.uint64, len(text)).view(np.int64))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a signed long)."""
    return docs.select(F.col("doc_id").cast("bigint"), _fingerprints("text").alias("fp"))


def syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words by the generator (0 for codewords)."""
    words = words.astype(np.int64)
    for bit in range(SEGMENT - 1, 10, -1):
        words = words ^ np.where(words >> bit & 1, GOLAY << (bit - 11), 0)
    return words


def _nearby() -> np.ndarray:
    """For each syndrome, the six xor masks (some repeated) that lead from a
    word to the codewords of the word and of its one-bit neighbours."""
    from itertools import combinations
    errors = np.array([sum(1 << b for b in c) for n in range(4) for c in combinations(range(SEGMENT), n)])
    error_of = np.empty(1 << 11, np.int64)
    error_of[syndrome(errors)] = errors
    flips = np.concatenate([[0], 1 << np.arange(SEGMENT)])
    masks = error_of[np.arange(1 << 11)[:, None] ^ syndrome(flips)[None, :]] ^ flips
    return np.array([np.resize(np.unique(m), 6) for m in masks])


NEARBY = _nearby()


def codeword_indices(words: np.ndarray) -> np.ndarray:
    """(n, 6) indices (12 bits) of the codewords near each 23-bit word."""
    return (words[:, None] ^ NEARBY[syndrome(words)]) >> 11


def fuzzy_keys(fp: np.ndarray) -> np.ndarray:
    """(n, 18) keys of which any two fingerprints within two bits share one."""
    u = fp.view(np.uint64)
    part = lambda at, n: (u >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64)
    a, b, c = part(0, SEGMENT), part(SEGMENT, SEGMENT), part(2 * SEGMENT, 18)
    near_a, near_b = codeword_indices(a), codeword_indices(b)
    return np.concatenate([1 << 60 | a[:, None] << 12 | near_b, 2 << 60 | b[:, None] << 12 | near_a,
                           3 << 60 | c[:, None] << 12 | near_a], axis=1)


@F.arrow_udf(T.ArrayType(T.LongType()))
def _keys(fp: pa.Array) -> pa.Array:
    keys = np.sort(fuzzy_keys(fp.to_numpy(zero_copy_only=False)), axis=1)
    new = np.ones(keys.shape, bool)
    new[:, 1:] = keys[:, 1:] != keys[:, :-1]
    offsets = np.concatenate([[0], np.cumsum(new.sum(axis=1))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys[new]))


def links(distinct: DataFrame) -> DataFrame:
    """Links (u, v), u < v, between distinct fingerprints: all of those that
    share a cold key, and enough of the others to keep every component."""
    keys = distinct.select(F.explode(_keys("fp")).alias("key"), "fp")
    keys = stage(keys, "keys")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stage(keys.join(shared, "key"), "shared")
    cold, hot = shared.where(F.col("n") <= HOT), shared.where(F.col("n") > HOT)
    left, right = cold.select("key", F.col("fp").alias("u")), cold.select("key", F.col("fp").alias("v"))
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= MAX_BITS
    found = left.join(right, "key").where((F.col("u") < F.col("v")) & near).select("u", "v")
    bits = F.array(F.lit(0).cast("bigint"), *[F.lit(1 << b if b < 63 else -(1 << 63)).cast("bigint") for b in range(64)])
    middle = (hot.select("fp").distinct().select("fp", F.explode(bits).alias("bit"))
              .select("fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("middle")))
    meet = middle.groupBy("middle").agg(F.collect_list("fp").alias("fps"))          # 65 at most
    meet = meet.where(F.size("fps") > 1).select(F.array_min("fps").alias("u"), F.explode("fps").alias("v")).where("u < v")
    return found.unionByName(meet).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node reachable, for every node with a link."""
    edges, seen = stage(edges.select("u", "v"), "edges"), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        large = large.join(least, "u")
        edges = stage(large.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, fp, root (the component's least fingerprint) and component_id
    (its smallest doc_id) of every row."""
    rows = stage(fingerprints(docs), "fingerprints")
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(distinct))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = stage(named, "roots")
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(stage(named.select("fp", "root").join(ids, "root"), "classes"), "fp")


def near_duplicates(docs: DataFrame) -> DataFrame:
    got = classes(docs)
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, one for each component: its smallest id's (of
    repeated rows with that id any one, of rows without ids any one)."""
    got = classes(docs).select("doc_id", "fp", "root", "component_id")
    keep = got.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.min("doc_id").alias("id"), F.min("fp").alias("print"))
    names = {c: fresh(docs, c) for c in ("id", "print", "own", "key", "shared")}
    keep = stage(keep, "keep").select(*[F.col(c).alias(names[c]) for c in ("id", "print")])
    key = docs["doc_id"].cast("bigint")
    # an id that one row has needs no more than its name; only rows that share one are told apart by fingerprint
    times = got.groupBy("doc_id").agg(F.count(F.lit(1)).alias("times")).where("times > 1 or doc_id is null")
    often = stage(times.select("doc_id"), "often").select(F.col("doc_id").alias(names["shared"]))
    one_row = keep.join(often, F.col(names["id"]).eqNullSafe(F.col(names["shared"])), "left_anti")
    several = keep.join(often, F.col(names["id"]).eqNullSafe(F.col(names["shared"])), "left_semi")
    several = several.withColumnsRenamed({names["id"]: names["key"], names["print"]: names["own"]})
    plain = docs.join(one_row, key == F.col(names["id"]), "left_semi")
    # a row for each id and fingerprint before they meet: an id with many different texts is spread by these
    told = (docs.join(often, key.eqNullSafe(F.col(names["shared"])), "left_semi")
            .withColumns({names["key"]: F.col("doc_id").cast("bigint"), names["own"]: _fingerprints("text")})
            .dropDuplicates([names["key"], names["own"]]))
    told = told.alias("told").join(several.alias("several"), F.col(f"told.{names['key']}").eqNullSafe(F.col(f"several.{names['key']}"))
                                   & (F.col(f"told.{names['own']}") == F.col(f"several.{names['own']}")), "left_semi")
    return plain.unionByName(told.select(*docs.columns))
