"""The prefix trie against a plain rebuild of every conversation."""

import hashlib
import random
import zlib

import pytest

from seatcast.llm import prefix_trie as P

COLS = "conv_id long, turn long, role string, text string, depth string, part string"
OUT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute_force(rows):
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            own.setdefault(c, []).append((turn is not None, turn or 0, role, hashlib.sha256(text.encode()).digest(), text))
    own = {c: [(r[2], r[4]) for r in sorted(t)] for c, t in own.items()}
    at = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole = own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])[:h] + t[h:]
        for d in range(len(whole) + 1):
            at.setdefault(tuple(whole[:d]), []).append((c, d == len(whole)))
    kids = {}
    for n in at:
        if n:
            kids.setdefault(n[:-1], []).append(n)

    def sums(n):
        below = [sums(k) for k in kids.get(n, [])]
        saved = (len(at[n]) - 1) * (len(n[-1][1]) if n else 0)
        return (sum(b[0] for b in below) or int(not below), saved + sum(b[1] for b in below))

    out = []
    for n, m in at.items():
        ends = ",".join(str(c) for c in sorted(c for c, last in m if last))
        out.append((min(c for c, _ in m), len(n), min(c for c, _ in at[n[:-1]]) if n else None, len(m), len(kids.get(n, [])),
                    *sums(n), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(seed, n):
    rng, out = random.Random(seed), []
    texts = ["Hello.", "", None, "日本語 é", "What?", "No"]
    ids = rng.sample(range(-250, 500), n) + [0, 100, 10**12, 10**12 + 7]
    for c in dict.fromkeys(ids):
        for t in range(rng.randrange(1, 10)):
            out.append((c, rng.choice([None, t, t, t, t // 2]), rng.choice(["user", "assistant", "", None]), rng.choice(texts)))
    out += [(300 + i, t, "user", "one line that many share" if t == 0 else f"{i % 3}{t}") for i in range(120) for t in range(3)]
    out += [(777, t, "user", f"turn {t % 50}") for t in range(300)]                    # longer than a task's range
    out += [(None, 1, "user", "of no conversation"), (None, None, None, None)] + out[:20]
    return [(*r, "x", "y") for r in out]


def got(df, **kw):
    return sorted((tuple(r[c] for c in OUT) for r in P.trie(df, **kw).collect()), key=repr)


def test_equals_brute_force(spark):
    rows = rows_of(1, 150)
    assert got(spark.createDataFrame(rows, COLS).repartition(3)) == brute_force(rows)


def test_fingerprints_that_meet_by_chance_are_found_and_left(spark):
    rows = rows_of(2, 40)
    df = spark.createDataFrame(rows, COLS)
    field = P.Field(101, 1)
    found = P.members(P.turns(df, field), field, P.contract_base, P.contract_head, P.MAX_HEAD)
    assert not P.nodes(found)[1]
    assert got(df, fields=[(101, 1), (P.PRIME, 2)]) == brute_force(rows)
    with pytest.raises(RuntimeError):
        P.trie(df, fields=[(101, 1)])


def test_products_compose():
    f = P.Field(P.PRIME, 3)
    t = [f.turn(bytes([i])) for i in range(9)]

    def product(turns):
        out = 0
        for x in turns:
            out = f.then(out, 1, x)
        return out

    assert f.then(product(t[:4]), 5, product(t[4:])) == product(t)
    assert f.without(product(t), t[-1]) == product(t[:-1])
    spliced = f.then((product(t[:2]) - product(t[:4])) % f.p, 3, product(t[:7]))
    assert spliced == product(t[:2] + t[4:7])


def test_empty_and_nothing_but_null_ids(spark):
    assert got(spark.createDataFrame([], COLS)) == []
    assert got(spark.createDataFrame([(None, 1, "user", "x", "", "")], COLS)) == []


def test_op13_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    from seatcast.llm import queries
    spark.createDataFrame(rows_of(4, 60), COLS).write.parquet(str(tmp_path / "conversations.parquet"))
    df = queries.op13_prefix_trie(spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.sql(queries.ORACLES["op13_prefix_trie"])
    assert sorted(map(repr, map(tuple, df.select(*want.columns).collect()))) == sorted(map(repr, want.fetchall()))
