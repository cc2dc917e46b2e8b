"""Registered queries of this subpackage: each applies one operator to its
whole table with production parameters.  ORACLES has DuckDB SQL where SQL can
express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatcast.llm import (exact_dedup, html, langid, mixing, packing, prefix_trie, quality, records, sharding, simhash, syncmers, topk,
                          turn_repair)
from seatcast.llm.common import table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best vectors of every vector whose id is divisible by 20."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.main_text(table(spark, sf_dir, "pages"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness."""
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    got = mixing.copies(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, in 16 shards of near-equal bytes."""
    got = sharding.shard(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op9_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of every record of the token files, read back from them."""
    return records.encode_and_read_back(table(spark, sf_dir, "documents"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document and the one that stays."""
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    rows = table(spark, sf_dir, "conversations")
    return turn_repair.audit(turn_repair.damaged(rows), rows)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five stages of corpus_pipeline over all documents."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_packing, op2_quality, op3_topk, op4_html, op5_simhash, op6_syncmers,
                                   op7_mixing, op8_sharding, op9_records, op10_langid, op11_exact_dedup, op12_turn_repair,
                                   op13_prefix_trie, pipeline)}

OP3_SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda v: CAST(floor(64 * CAST(v AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
one AS (SELECT vec_id, min(x) AS x FROM usable GROUP BY vec_id),
parts AS (SELECT vec_id, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM one),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.v * c.v) AS BIGINT) AS score
  FROM parts q JOIN parts c ON q.i = c.i AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0 GROUP BY ALL),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 20
"""

OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS hash,
         CAST('0x' || substr(md5(coalesce(text, '')), 1, 15) AS BIGINT) AS text_hash, row_number() OVER () AS place
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [1, 2, 3][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, 3 * source_size AS cap FROM s),
r AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
         sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest_weight,
         sum(source_size) OVER () AS total FROM w),
f AS (SELECT *, CAST(total - capped AS DOUBLE) / rest_weight AS share FROM r),
t AS (
  SELECT source, source_size,
         round(least(CAST(cap AS DOUBLE), coalesce(max(CASE WHEN share * weight <= cap THEN share END) OVER (), 0) * weight), 6) AS target
  FROM f),
g AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies FROM t),
c AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, g.copies, g.target - g.copies * g.source_size AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY hash, text_hash, place ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (copies + CASE WHEN upto < rest THEN 1 WHEN upto - size < rest AND upto - rest <= rest - (upto - size) THEN 1 ELSE 0 END)
            AS BIGINT) AS taken
FROM c
"""

OP11_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d
"""


def _crc32(text: str) -> str:
    """DuckDB SQL of the unsigned CRC-32 of an ASCII text: each byte, then eight shifts (marked -1)."""
    steps = f"flatten(list_transform(range(1, length({text}) + 1), lambda i: [CAST(ascii(substr({text}, i, 1)) AS BIGINT), {', '.join(['-1'] * 8)}]))"
    return (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {steps}), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) "
            f"ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295)")


def _paid(way: str, cost, letter: str) -> str:
    """A way (ten digits of cost, then the letters) after one more edit."""
    return f"lpad(CAST(CAST(left({way}, 10) AS BIGINT) + {cost} AS VARCHAR), 10, '0') || substr({way}, 11) || '{letter}'"


def _with_inserts(ways: str) -> str:
    """e, s, u, a (empty, after system, user, assistant) of ``ways`` after any inserts."""
    u = f"least(u, {_paid('e', 2, 'I')}, {_paid('s', 2, 'I')}, {_paid('a', 2, 'I')})"
    return f"SELECT * REPLACE (least(a, {_paid('u', 2, 'I')}) AS a) FROM (SELECT * REPLACE ({u} AS u) FROM ({ways}))"


_ANY = ("e", "s", "a")      # before a user turn
_KEEP_U = ", ".join(f"CASE WHEN i = 'u' AND NOT gone THEN {_paid(w, 'cut', 'K')} END" for w in _ANY)
_REROLE_U = ", ".join(f"CASE WHEN NOT gone THEN {_paid(w, '2 + cut', 'R')} END" for w in _ANY)
_ROW = f"""SELECT conv_id, p, {_paid('e', 3, 'D')} AS e,
    least({_paid('s', 3, 'D')}, CASE WHEN i = 's' AND NOT gone THEN {_paid('e', 'cut', 'K')} END) AS s,
    least({_paid('u', 3, 'D')}, {_KEEP_U}, {_REROLE_U}) AS u,
    least({_paid('a', 3, 'D')}, CASE WHEN i = 'a' AND NOT gone THEN {_paid('u', 'cut', 'K')} END,
          CASE WHEN NOT gone THEN {_paid('u', '2 + cut', 'R')} END) AS a
  FROM (SELECT f.*, w.e, w.s, w.u, w.a FROM ways w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.p = w.p + 1)"""

OP12_SQL = rf"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
h AS (SELECT *, {_crc32('key')} % 20 AS how FROM k),
d AS (
  SELECT conv_id, turn, CASE how WHEN 4 THEN 'user' ELSE role END AS role,
    CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE how WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM h),
o AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS i,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS p FROM d),
b AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) AS seen FROM o),
t AS (
  SELECT *, lag(i) OVER (PARTITION BY conv_id ORDER BY p) AS before,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE 'none' END AS fault FROM b),
f AS (SELECT *, fault IN ('blank', 'duplicate') AS gone, CAST(fault = 'truncated' AS BIGINT) AS cut FROM t),
ids AS (SELECT DISTINCT conv_id FROM conversations),
ways AS (
  {_with_inserts("SELECT conv_id, CAST(0 AS BIGINT) AS p, '0000000000' AS e, CAST(NULL AS VARCHAR) AS s, CAST(NULL AS VARCHAR) AS u, CAST(NULL AS VARCHAR) AS a FROM ids")}
  UNION ALL
  {_with_inserts(_ROW)}),
r AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal, max(p) AS p FROM f GROUP BY conv_id),
best AS (
  SELECT w.conv_id, r.* EXCLUDE (conv_id, p), least(w.e, w.a) AS way FROM ways w
  LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.p = w.p WHERE r.p = w.p OR (w.p = 0 AND NOT EXISTS (
    SELECT 1 FROM r q WHERE q.conv_id IS NOT DISTINCT FROM w.conv_id))),
l AS (
  SELECT conv_id, unnest(string_split(substr(way, 11), '')) AS edit, generate_subscripts(string_split(substr(way, 11), ''), 1) AS j
  FROM best WHERE length(way) > 10),
q AS (
  SELECT *, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY j) AS p,
    count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv_id ORDER BY j) AS n FROM l),
m AS (
  SELECT q.*, f.role, f.text, max(CASE WHEN q.edit = 'K' AND q.n = 1 AND f.i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY q.conv_id) AS shift
  FROM q LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM q.conv_id AND f.p = q.p),
s AS (
  SELECT conv_id, sha256(string_agg(CASE edit WHEN 'K' THEN role ELSE CASE WHEN (n - shift) % 2 = 1 THEN 'user' ELSE 'assistant' END END
    || ':' || CASE edit WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY j)) AS sha FROM m WHERE edit <> 'D' GROUP BY conv_id)
SELECT best.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(left(way, 10) AS BIGINT) AS cost,
  substr(way, 11) AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM best LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM best.conv_id
"""

OP13_SQL = f"""
WITH o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS name FROM o),
c AS (SELECT conv_id AS c, conv_id - conv_id % 100 AS b, {_crc32('name')} % 6 AS h FROM ids),
k AS (SELECT c, h, b, (SELECT count(*) FROM o WHERE o.conv_id = c.b AND o.pos <= c.h) AS hb FROM c),
r AS (
  SELECT c, o.pos AS d, sha256(sha256(text) || role) AS turn, length(text) AS chars FROM k JOIN o ON o.conv_id = k.b AND o.pos <= k.h
  UNION ALL
  SELECT c, o.pos - h + hb, sha256(sha256(text) || role), length(text) FROM k JOIN o ON o.conv_id = k.c AND o.pos > k.h),
p AS (
  SELECT c, 0 AS d, CAST([] AS VARCHAR[]) AS path, 0 AS chars FROM k
  UNION ALL SELECT c, d, list(turn) OVER (PARTITION BY c ORDER BY d), chars FROM r),
z AS (SELECT *, d = max(d) OVER (PARTITION BY c) AS ends FROM p),
n AS (
  SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, min(chars) AS chars,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM z GROUP BY path, d),
kids AS (SELECT path[:d - 1] AS path, count(*) AS n FROM n WHERE d > 0 GROUP BY 1),
x AS (SELECT n.*, coalesce(kids.n, 0) AS n_children FROM n LEFT JOIN kids ON kids.path = n.path),
below AS (
  SELECT p.path, CAST(sum((x.n_convs - 1) * x.chars) AS BIGINT) AS saved_tokens, count(*) FILTER (x.n_children = 0) AS n_leaves
  FROM x JOIN p ON p.c = x.conv_id AND p.d <= x.d GROUP BY p.path)
SELECT x.conv_id, CAST(x.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, x.n_convs, x.n_children, below.n_leaves, below.saved_tokens,
  x.ends_sha256
FROM x JOIN below ON below.path = x.path LEFT JOIN n up ON x.d > 0 AND up.path = x.path[:x.d - 1]
"""

ORACLES = {"op3_topk": OP3_SQL, "op7_mixing": OP7_SQL, "op11_exact_dedup": OP11_SQL, "op12_turn_repair": OP12_SQL,
           "op13_prefix_trie": OP13_SQL}
