"""Near-duplicates, fingerprints, sharding, mixing against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from seatcast.llm import mixing, sharding, simhash, syncmers


def brute_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Least id reachable over links of at most two bits; prints: {key: fingerprint}."""
    least = {k: k for k in prints}

    def find(k):
        while least[k] != k:
            k = least[k]
        return k
    for a, b in combinations(prints, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 2:
            x, y = sorted((find(a), find(b)))
            least[y] = x
    return {k: find(k) for k in prints}


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=2))
def test_two_bits_share_a_key(fp, flips):
    other = fp
    for b in flips:
        other ^= 1 << b
    keys = simhash.fuzzy_keys(np.array([fp, other], np.uint64).view(np.int64))
    assert set(keys[0]) & set(keys[1])


def test_golay_words_have_one_or_six_codewords():
    words = np.random.default_rng(0).integers(0, 1 << 23, 4000)
    sizes = {len(set(r)) for r in simhash.codeword_indices(words)}
    assert sizes == {1, 6}
    near = words[:, None] ^ simhash.NEARBY[simhash.syndrome(words)]
    assert (simhash.syndrome(near.ravel()) == 0).all()


def test_near_duplicates_match_brute_force(docs, doc_rows):
    with_id = {(r[0]): brute_fingerprint(r[1]) for r in doc_rows if r[0] is not None}
    prints = dict(with_id)
    want = brute_components(prints)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(doc_rows)
    for r in got:
        if r["doc_id"] is not None:
            assert (r["fingerprint"], r["component_id"]) == (f"{with_id[r['doc_id']]:016x}", want[r["doc_id"]])
    blank = [r for r in got if r["doc_id"] is None and r["fingerprint"] == "0" * 16]
    assert [r["component_id"] for r in blank] == [want[9001]]


def test_hot_keys_go_by_midpoints(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", 3)
    rng = np.random.default_rng(1)
    centre, prints = 0x123456789ABCDEF0, set()
    for _ in range(120):
        prints.add(centre ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))))
    prints |= {int(x) for x in rng.integers(0, 2**63, 30)}
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    edges = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"))
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    want = brute_components({s: s & (2**64 - 1) for s in sorted(signed)})
    assert {s: roots.get(s, s) for s in signed} == want


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 200)] + [(1000, 1001)], "u long, v long")
    got = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 1001: 1000} | {k: v for k, v in got.items() if k == v}


def test_one_of_each_keeps_one_row_a_component(docs, doc_rows):
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    got = simhash.near_duplicates(docs)
    n = got.select(F.coalesce("component_id", F.lit(-1)), F.when(F.col("component_id").isNull(), F.col("fingerprint"))).distinct().count()
    assert kept.count() == n
    ids = {r["doc_id"] for r in kept.collect()}
    assert 15 in ids and not ids & {3 * i for i in range(240, 280) if i % 4}     # the exact copies


def joined_rows(plan):
    """The most rows that a join of the executed plan made."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return joined_rows(plan.executedPlan())
    if name.endswith("QueryStageExec"):
        return joined_rows(plan.plan())
    below = max((joined_rows(plan.children().apply(k)) for k in range(plan.children().size())), default=0)
    made = plan.metrics().get("numOutputRows") if "Join" in name else None
    return max(below, made.get().value() if made and made.isDefined() else 0)


def test_rows_of_a_hot_id_do_not_meet_all_its_components(spark):
    n, word = 300, lambda *k: hashlib.md5(repr(k).encode()).hexdigest()
    rows = [(key, " ".join(word(key, i, w) for w in range(12))) for key in (None, 7) for i in range(n)]
    rows += rows[:20] + [(100 + i, " ".join(word(i, w) for w in range(12))) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash.one_of_each(docs)
    got = kept.collect()
    components = set(brute_components({i: brute_fingerprint(t) for i, t in enumerate(dict.fromkeys(t for _, t in rows))}).values())
    assert len(got) == len(components) and {tuple(r) for r in got} <= set(rows)
    made = joined_rows(kept._jdf.queryExecution().executedPlan())
    assert 0 < made <= len(rows)


def brute_next(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    return [(r, order[(k + 1) % len(order)]) for k, r in enumerate(order)]


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def brute_anchors(text, k=syncmers.K, s=syncmers.S):
    """Anchors with their places, run by run; of a short text one of the whole."""
    if len(text) < k:
        return [(None, xxh64_intdigest(text.encode(), 42) >> 32)] if text else []
    out, w = [], k - s + 1
    for i in range(len(text) - k + 1):
        inner = [signed(xxh64_intdigest(text[i + j:i + j + s].encode(), 42)) for j in range(w)]
        if min(inner) in (inner[0], inner[-1]):
            h = 42
            for j in [*range(0, w - 1, s), w - 1]:
                h = xxh64_intdigest((inner[j] & (1 << 64) - 1).to_bytes(8, "little"), h)
            out.append((i, h >> 32))
    return out


def brute_print(text):
    return [a for _, a in brute_anchors(text)]


def brute_likeness(a, b):
    larger = max(len(set(a)), len(set(b)))
    return len(set(a) & set(b)) / larger if larger else 1.0


def hexed(found):
    return "".join(f"{a:08X}" for a in found)


def test_syncmer_fingerprints_equal_brute_force(docs, doc_rows):
    unique = [r for r in doc_rows if r[0] is not None and r[0] != 9009 and len(r[1] or "") < 3000]
    odd = ["", "a", "x" * 19, "y" * 20, "\U0001F600" * 30 + "abc", "日本語" * 20, "\n" * 25, "a\u0301" * 15, "z" * 40]
    extra = [(20_000 + i, t) for i, t in enumerate(odd)]
    rows = sorted([(r[0], r[1]) for r in unique] + extra)
    frame = docs.sparkSession.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in syncmers.fingerprints(frame).collect()}
    assert len(got) == len(rows)
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        text, after, g = text or "", after or "", got[i]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        own, changed = brute_print(text), brute_print(edited)
        assert (g["fingerprint"], g["edited_fingerprint"]) == (hexed(own), hexed(changed)), (i, text, after)
        assert g["near_edited"] == pytest.approx(brute_likeness(own, changed))
        assert g["near_next"] == pytest.approx(brute_likeness(own, brute_print(after)))
    at = [(r["doc_id"], r["at"], r["anchor"]) for r in syncmers.positions(frame).collect()]
    assert Counter(at) == Counter((i, p, a) for i, t in rows for p, a in brute_anchors(t or "") if p is not None)


def test_syncmers_need_no_blanks(spark):
    rng = np.random.default_rng(5)
    text = "".join(rng.choice(list("abcdefghij"), 2000))
    got = {r["doc_id"]: r for r in syncmers.fingerprints(spark.createDataFrame([(1, text), (2, "q" + text)], "doc_id long, text string")).collect()}
    assert got[1]["near_next"] > 0.98 and got[2]["near_next"] > 0.98
    places = [p for p, _ in brute_anchors(text)]
    assert max(np.diff(places)) <= syncmers.K - syncmers.S


def test_rows_of_hot_ids_are_cut_into_ranges(spark, monkeypatch):
    monkeypatch.setattr(syncmers, "ROWS_IN_RANGE", 20)
    rows = [(key, f"text {key} {i} of a hot id that goes on") for key in (None, 7, -(1 << 63)) for i in range(150)]
    rows += [(i, f"the only text of {i} with some words") for i in range(300) if i != 7]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    ranged = syncmers.ranges(frame).toPandas()
    assert ranged.groupby("range").size().max() <= 60
    key = lambda i, t: (i is not None, i or 0, signed(xxh64_intdigest(t.encode(), 42)))
    order = sorted(rows, key=lambda r: key(*r))
    want = {t: n for (_, t), (_, n) in zip(order, order[1:] + order[:1])}
    got = syncmers.with_next(frame)
    assert got.where("extra = 0").count() == len(rows)
    expected = Counter()
    for _, text in order:
        edited = text[:len(text) - len(text) // 2] + want[text][:len(text) // 2]
        expected[hexed(brute_print(text)), hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert Counter((r["fingerprint"], r["edited_sha256"]) for r in syncmers.fingerprints(frame).collect()) == expected


def test_marks_below(spark):
    for marks in ([], [5], list(range(0, 200, 2)), [-(1 << 63), 0, 3]):
        got = spark.range(-3, 210).select("id", syncmers.marks_below(marks, F.col("id")).alias("n")).collect()
        assert all(r["n"] == sum(m < r["id"] for m in marks) for r in got)


def test_syncmers(docs, doc_rows):
    unique = [r for r in doc_rows if r[0] is not None and r[0] != 9009]
    frame = docs.where("doc_id is not null and doc_id <> 9009")
    got = {r["doc_id"]: r for r in syncmers.fingerprints(frame).collect()}
    assert len(got) == len(unique)
    prints = defaultdict(set)
    for r, nxt in brute_next(unique):
        text, after = r[1] or "", nxt[1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        g = got[r[0]]
        assert (g["n_chars"], g["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        prints[text].add(g["fingerprint"])
        assert 0 <= g["near_edited"] <= 1 and 0 <= g["near_next"] <= 1
        if text == after:
            assert g["near_next"] == 1
        if edited == text:
            assert g["near_edited"] == 1 and g["fingerprint"] == g["edited_fingerprint"]
    assert all(len(p) == 1 for p in prints.values())
    long = [g for g in got.values() if g["n_chars"] > 300]
    assert np.mean([g["near_edited"] for g in long]) > 0.3


def test_syncmers_take_all_rows_and_the_single_one(docs, doc_rows, no_docs):
    assert syncmers.fingerprints(docs).count() == len(doc_rows)
    assert syncmers.fingerprints(no_docs).count() == 0
    one = syncmers.fingerprints(docs.where("doc_id = 9004")).first()
    assert one["near_next"] == 1 and one["edited_sha256"] == hashlib.sha256(b"wowo").hexdigest()


def test_syncmers_are_context_free(spark):
    passage = " ".join(f"w{i * i % 97}x{i}" for i in range(40))
    frame = spark.createDataFrame([(1, "before it " + passage), (2, passage + " and after"), (3, "a b c")],
                                  "doc_id long, text string")
    at = defaultdict(dict)
    for r in syncmers.positions(frame).collect():
        at[r["doc_id"]][r["anchor"]] = r["at"]
    shared = set(at[1]) & set(at[2])
    assert len(shared) >= 10 and {at[1][a] - at[2][a] for a in shared} == {10} and not at[3]   # its place moved by the words before


def test_shards_are_even_and_gapless(docs, doc_rows, no_docs):
    got = sharding.shard(docs, 4, 0.001).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in doc_rows)
    slots, load = defaultdict(list), Counter()
    for r in got:
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == {0, 1, 2, 3}
    longest = max(r["size"] for r in got)
    assert max(load.values()) - min(load.values()) <= 2 * longest
    assert sharding.shard(no_docs).count() == 0


def test_a_hot_group_is_split_and_small_ones_are_not(spark):
    frame = spark.createDataFrame([(i, "copy " * 20 if i % 3 == 0 else f"text {i // 4}") for i in range(3000)],
                                  "doc_id long, text string")
    got = sharding.shard(frame, 8, 0.01).toPandas()
    load = got.groupby("shard")["size"].sum()
    assert load.max() <= 1.02 * load.sum() / 8
    spread = got.groupby("text_crc32")["shard"].nunique()
    assert spread.max() >= 6 and (spread > 1).sum() <= 8


def test_repeated_keys_do_not_stop_the_search(spark):
    """Copies of one row are spread like any others: the law is near-equal bytes."""
    frame = spark.createDataFrame([(1, "same")] * 50, "doc_id long, text string")
    got = sharding.shard(frame, 4).toPandas()
    assert sorted(got.groupby("shard").size()) == [12, 12, 13, 13]
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))


def test_a_third_of_rows_alike_leaves_no_shard_empty(spark):
    rows = [(7, "x" * 14) if i % 3 == 0 else (i, f"text number {i}") for i in range(3000)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 16).toPandas()
    size = got.groupby("shard")["size"].sum()
    assert len(size) == 16 and size.max() - size.min() < 0.02 * size.mean()
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))


def test_write_shards(spark, docs, doc_rows, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "s"), 4)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == len(doc_rows) and set(docs.columns) < set(back.columns)


def water_fill(sizes, weights):
    total, level, open_ = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    left = total
    while True:
        share = left / sum(weights[i] for i in open_)
        over = {i for i in open_ if share * weights[i] > 3 * sizes[i]}
        if not over:
            break
        for i in over:
            level[i] = 3.0 * sizes[i]
        left -= sum(level[i] for i in over)
        open_ -= over
    for i in open_:
        level[i] = share * weights[i]
    return level


@pytest.mark.parametrize("sizes", [[5, 1000, 3, 40], [10, 10], [0, 7, 0], [1, 1, 1, 9999, 2, 2, 500]])
def test_targets_share_the_excess(spark, sizes):
    frame = spark.createDataFrame([(f"s{i}", s) for i, s in enumerate(sizes)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(frame).collect()}
    want = water_fill(sizes, [i % 3 + 1 for i in range(len(sizes))])
    assert [got[f"s{i}"] for i in range(len(sizes))] == pytest.approx(want, abs=1e-4)


def test_mix(docs, doc_rows, no_docs):
    got = mixing.copies(docs).toPandas()
    assert len(got) == len(doc_rows) and got["copies"].between(0, 3).all()
    words = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in doc_rows}
    assert all(s == words[d if d == d else None] for d, s in zip(got["doc_id"], got["size"]) if d == d and d is not None)
    per = got.assign(taken=got["size"] * got["copies"]).groupby(["source_size", "target"]).agg(taken=("taken", "sum"), largest=("size", "max"))
    for (_, target), r in per.iterrows():
        assert abs(r["taken"] - target) <= r["largest"]
    again = mixing.copies(docs.repartition(7)).toPandas()
    key = ["doc_id", "size", "copies"]
    assert Counter(map(str, got[key].itertuples(index=False))) == Counter(map(str, again[key].itertuples(index=False)))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == got["copies"].sum()
    assert mixing.copies(no_docs).count() == 0 and mixing.mix(no_docs).count() == 0


@pytest.mark.parametrize("hot", ["null ids", "one id", "copies of one row"])
def test_mix_cuts_through_repeated_ids(spark, hot):
    rows = [(i, f"w {i} " + "x " * (i % 5), "ab"[i % 2]) for i in range(200)]
    rows += [(None if hot == "null ids" else 7, "same text" if hot == "copies of one row" else f"more of {i}", "b") for i in range(100)]
    docs = spark.createDataFrame([(*r, i, "c") for i, r in enumerate(rows)], "doc_id long, text string, source string, size long, _metadata string")
    got = mixing.copies(docs).toPandas()
    taken = got.assign(taken=got["size"] * got["copies"]).groupby(["source_size", "target"])["taken"].sum().reset_index()
    assert (abs(taken["taken"] - taken["target"]) <= got["size"].max() / 2 + 1e-6).all()
    assert got["copies"].between(0, 3).all()
    keyed = sorted((md5_60(str(i) if i is not None else ""), md5_60(t), s, len(t.split()), i) for i, t, s in rows)
    want = Counter()
    for source, target, size in got_sources(got, rows):
        whole, upto = int(target // size), 0
        rest = target - whole * size
        for _, _, s, n, i in keyed:
            if s == source:
                upto += n
                once = upto < rest or (upto - n < rest and upto - rest <= rest - (upto - n))
                want[i if i is not None else -1, n, whole + once] += 1
    assert Counter((-1 if d != d else int(d), n, c) for d, n, c in got[["doc_id", "size", "copies"]].itertuples(index=False)) == want
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    again = mixed.toPandas()
    assert again["text"].str.split().str.len().sum() == taken["taken"].sum() and len(again) == got["copies"].sum()


def md5_60(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def got_sources(got, rows):
    """(source, target, size) of every source, found by its size."""
    for source in sorted({r[2] for r in rows}):
        size = sum(len(t.split()) for _, t, s in rows if s == source)
        yield source, got.loc[got["source_size"] == size, "target"].iloc[0], size
