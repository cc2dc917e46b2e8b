"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import zlib

import pytest

from seatcast.llm import turn_repair as R

COLS = "conv_id long, turn long, role string, text string, cost string, audit string"


def cheapest(kinds):
    """(cost, letters) by keeping the least pair of every state, one row at a time."""
    def with_inserts(best):
        for _ in range(4):
            for i, j in R.INSERTED.items():
                if i in best:
                    c, s = best[i]
                    best[j] = min(best.get(j, (10**9, "")), (c + 2, s + "I"))
        return best

    best = with_inserts({R.EMPTY: (0, "")})
    for kind in kinds:
        new = {}
        for letter, i, j, w in R.row_edits(kind):
            if i in best:
                c, s = best[i]
                new[j] = min(new.get(j, (10**9, "")), (c + w, s + letter))
        best = with_inserts(new)
    return min(best[s] for s in (R.EMPTY, R.ASSISTANT) if s in best)


@pytest.mark.parametrize("block", [1, 2, 3, 4])
def test_block_tables_find_the_cheapest_and_least_edits(block):
    rng, t = random.Random(block), R.Tables(block)
    for _ in range(1500):
        kinds = [rng.randrange(1, R.KINDS) for _ in range(rng.randrange(0, 15))]
        reader = R.Reader(t)
        for k in kinds:
            reader.add(k)
        cost, letters = reader.edits()
        assert (cost, letters.decode()) == cheapest(kinds), kinds


def test_every_short_conversation():
    from itertools import product
    for n in range(5):
        for kinds in product(range(1, R.KINDS), repeat=n):
            reader = R.Reader(R.tables())
            for k in kinds:
                reader.add(k)
            cost, letters = reader.edits()
            assert (cost, letters.decode()) == cheapest(kinds), kinds


def brute_force(rows):
    """The report of op12's contract, conversation by conversation."""
    blank_of, stop = lambda s: not s.strip(" \t\n\x0b\x0c\r"), ".!?"
    out = {}
    for conv_id in {r[0] for r in rows}:
        own = []
        for _, turn, role, text in [r[:4] for r in rows if r[0] == conv_id]:
            show = lambda v: " " if v is None else str(v)
            role, text, how = show(role), show(text), zlib.crc32(f"{show(conv_id)}:{show(turn)}".encode()) % 20
            text = "" if how == 1 else "".join(c for c in text if c not in stop) if how == 2 else text
            role = "user" if how == 4 else role
            own += [(turn is not None, turn or 0, role, hashlib.sha256(text.encode()).hexdigest(), text)] * {0: 0, 3: 2}.get(how, 1)
        own.sort()
        kinds, seen, counts = [], set(), [0, 0, 0]
        for _, _, role, _, text in own:
            fault = 0 if blank_of(text) else 1 if (role, text) in seen else 2 if text.rstrip(" \t\n\x0b\x0c\r")[-1] not in stop else 3
            seen.add((role, text))
            if fault < 3:
                counts[fault] += 1
            kinds.append(R.MUST_GO if fault < 2 else 2 + 2 * {"s": 0, "u": 1, "a": 2}.get(role[:1], 3) + (fault == 2))
        cost, letters = cheapest(kinds)
        turns = [r[1] for r in own if r[0]]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        made, left = [], list(own)
        for letter in letters:
            row = left.pop(0) if letter != "I" else None
            if letter == "D":
                continue
            users = len(made) - (bool(made) and made[0][:1] == "s")
            role = row[2] if letter == "K" else ("user", "assistant")[users % 2]
            made.append(f"{role}:{row[4] if row else ''}")
        out[conv_id] = (gaps, *counts, illegal, cost, letters, hashlib.sha256("\n".join(made).encode()).hexdigest())
    return out


def rows_of(seed, n):
    rng, out = random.Random(seed), []
    texts = ["Fine.", "Cut off", "", " \t\n", "Ja!", "So? \n", "日本語。", "é. x", None, "."]
    for c in range(n):
        for t in range(rng.randrange(1, 12)):
            turn = rng.choice([None, t, t, t, t + 3, 2 * t, -t])
            out.append((c - 3, turn, rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None]),
                        rng.choice(texts) if rng.random() < 0.6 else f"Word {rng.random()}."))
    out += [(None, 1, "user", "x."), (None, None, None, None), (None, 1, "user", "x.")]
    out += [(70_000, t, ("user", "assistant")[t % 2], "The same." if t % 3 == 0 else f"Turn {t}.") for t in range(900)]   # a long one
    return [(*r, "x", "y") for r in out]


def test_report_equals_brute_force(spark):
    rows = rows_of(5, 300)
    df = spark.createDataFrame(rows, COLS).repartition(3)
    got = {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))
           for r in R.audit(R.damaged(df), df).collect()}
    assert got == brute_force(rows)


def test_repaired_turns_are_legal_and_hash_alike(spark):
    rows = rows_of(6, 60)
    df = R.damaged(spark.createDataFrame(rows, COLS))
    turns = {}
    for r in sorted(R.repair(df).collect(), key=lambda r: r["position"]):
        turns.setdefault(r["conv_id"], []).append(r)
    for r in R.audit(df).collect():
        made = turns.get(r["conv_id"], [])
        assert [t["position"] for t in made] == list(range(len(made)))
        assert hashlib.sha256("\n".join(f"{t['role']}:{t['text']}" for t in made).encode()).hexdigest() == r["repaired_sha256"]
        initials = "".join(t["role"][:1] for t in made)
        assert not made or initials.removeprefix("s").replace("ua", "") == "" and initials.endswith("a")
        assert "".join(t["edit"] for t in made) == r["audit"].replace("D", "")


def test_empty_table(spark):
    none = spark.createDataFrame([], COLS)
    assert R.audit(R.damaged(none), none).count() == 0 and R.repair(none).count() == 0


def test_op12_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    from seatcast.llm import queries
    spark.createDataFrame(rows_of(7, 80)[:500], COLS).write.parquet(str(tmp_path / "conversations.parquet"))
    got = queries.op12_turn_repair(spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.sql(queries.ORACLES["op12_turn_repair"])
    assert sorted(map(repr, map(tuple, got.select(*want.columns).collect()))) == sorted(map(repr, want.fetchall()))
