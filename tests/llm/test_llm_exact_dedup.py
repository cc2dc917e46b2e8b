"""Exact deduplication against a plain dictionary."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from seatcast.llm import exact_dedup as X

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(text):
    return hashlib.sha256((text or "").translate(LOWER).encode()).hexdigest()


def groups_of(doc_rows):
    out = defaultdict(list)
    for r in doc_rows:
        out[key(r[1])].append(r[0])
    return out


def check(got, doc_rows):
    want = groups_of(doc_rows)
    assert len(got) == len(doc_rows)
    kept = defaultdict(list)
    for r in got:
        ids = want[r["text_sha256"]]
        best = max((i for i in ids if i is not None), default=None)
        assert (r["keep_id"], r["group_size"]) == (best, len(ids))
        if r["kept"]:
            kept[r["text_sha256"]].append(r["doc_id"])
            assert r["doc_id"] == best
    assert sorted((r["doc_id"] or -1, r["text_sha256"]) for r in got) == sorted((r[0] or -1, key(r[1])) for r in doc_rows)
    assert {k: len(v) for k, v in kept.items()} == dict.fromkeys(want, 1)       # one row of each group, ties included


@pytest.fixture(scope="module")
def tricky(doc_rows):
    more = [(20_000 + i, t, None, "src0", 0, *"xyzw") for i, t in
            enumerate(["ABC z", "abc Z", "aBc z", "ÀB", "àB", "Àb", "İ", "i", "K", "k", "K", "", None, " "])]
    return doc_rows + more + [(None, None, None, "src0", 0, *"xyzw")] * 3 + [(5, "third", "en", "src0", 0, *"xyzw")] * 200


def test_groups_equal_brute_force(spark, docs, tricky):
    check(X.groups(spark.createDataFrame(tricky, docs.schema).repartition(5)).collect(), tricky)


def test_a_crowded_filter_changes_no_result(spark, docs, tricky, monkeypatch):
    monkeypatch.setattr(X, "BLOCK", 8 * 16)
    monkeypatch.setattr(X.Filter.__init__, "__defaults__", (1, 1))          # some 500 digests in 128 bits
    monkeypatch.setattr(X, "bits_of", lambda d, blocks: d[:, 8:12].astype(np.int64) % 128)
    check(X.groups(spark.createDataFrame(tricky, docs.schema)).collect(), tricky)


def test_filter_lets_few_unique_rows_through(spark):
    rows = spark.range(30_000).selectExpr("id AS doc_id", "CASE WHEN id % 10 = 0 THEN 'same ' || id % 500 ELSE 'own ' || id END AS text")
    d = X.stage(X.digests(rows.repartition(7)), "digests")
    let = d.where(X.Filter(d, 30_000).may_repeat("digest"))
    assert let.where("doc_id % 10 = 0").count() == 3_000
    assert let.count() < 3_000 + 27_000 * 0.02


def test_dedup_keeps_one_whole_row_of_each_group(spark, docs, tricky):
    df = spark.createDataFrame(tricky, docs.schema).repartition(3)
    got = X.dedup(df)
    assert got.columns == df.columns
    rows = got.collect()
    want = groups_of(tricky)
    assert sorted(key(r["text"]) for r in rows) == sorted(want)
    for r in rows:
        assert r["doc_id"] == max((i for i in want[key(r["text"])] if i is not None), default=None)
        assert (r["score"], r["hash"], r["id"]) == ("x", "y", "z")


def test_empty_table(spark, no_docs):
    assert X.groups(no_docs).count() == 0 and X.dedup(no_docs).count() == 0


def test_op11_sql(spark, docs, tricky, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    from seatcast.llm import queries
    rows = [r for r in dict.fromkeys(tricky) if r[0] is not None or r[1] is not None]
    spark.createDataFrame(rows, docs.schema).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op11_exact_dedup(spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(queries.ORACLES["op11_exact_dedup"])
    assert sorted(map(repr, map(tuple, got.select(*want.columns).collect()))) == sorted(map(repr, want.fetchall()))
