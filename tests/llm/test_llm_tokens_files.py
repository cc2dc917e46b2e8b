"""Packing and token files: exact round trips."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from seatcast.llm import packing, records
from seatcast.llm.common import scratch
from seatcast.llm.tokens import WordEncoder, default_path


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(default_path())


def ids_of(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_words_give_the_ids_of_whole_texts(texts):
    tok, enc = Tokenizer.from_file(default_path()), WordEncoder(default_path())
    assert [x.tolist() for x in enc.encode(pa.array(texts, pa.string()))] == [ids_of(tok, t) for t in texts]


def test_pieces_cover_documents_and_fit(docs, doc_rows, tok):
    got = packing.pack(docs).toPandas()
    want = sorted((r[0] is None, r[0] or 0, len(ids_of(tok, r[1])) + 1) for r in doc_rows)
    ends = got[got["start"] + got["length"] == got["doc_tokens"]]
    assert sorted((d != d or d is None, int(d) if d == d and d is not None else 0, n)
                  for d, n in zip(ends["doc_id"], ends["doc_tokens"])) == want
    assert got["length"].sum() == sum(n for *_, n in want)
    for _, g in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert list(g["offset"]) == [0, *np.cumsum(g["length"])[:-1]] and g["length"].sum() <= 2048
    by = {r[0]: np.array(ids_of(tok, r[1]) + [1], "<u4") for r in doc_rows if r[0] is not None}
    for r in got[got["doc_id"].notna()].itertuples():
        piece = by[int(r.doc_id)][r.start:r.start + r.length].tobytes()
        assert zlib.crc32(piece) == r.ids_crc32 and bytes(r.ids) == piece
    assert got["sequence_id"].nunique() == got["sequence_id"].max() + 1


def test_sequences_hold_their_pieces(docs):
    packed = packing.pack(docs, length=128)
    got = packing.sequences(packed).collect()
    assert all(len(r["ids"]) == 4 * r["n_tokens"] <= 512 for r in got)
    assert sum(r["n_tokens"] for r in got) == packed.agg({"length": "sum"}).first()[0]


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 500), max_size=20))
def test_patterns_place_every_piece_once(histogram):
    made = packing.patterns(histogram, 32)
    placed = Counter()
    for lengths, packs in made:
        assert packs > 0 and sum(lengths) <= 32
        for n in lengths:
            placed[n] += packs
    assert placed == Counter(histogram) and len(made) <= 4 * 32


def test_full_pieces_stand_alone():
    assert packing.patterns({2048: 5}) == [([2048], 5)]


def test_pack_empty(no_docs):
    assert packing.pack(no_docs).count() == 0


def test_records_round_trip(spark, docs, doc_rows, tok):
    folder = scratch(spark, "r")
    manifest = records.write_records(docs, folder)
    files = [r["path"] for r in manifest.orderBy("part").collect()]
    back = [(i, x.tolist()) for f in files for i, x in records.records(folder, f)]
    assert [i for i, _ in back] == sorted((r[0] for r in doc_rows), key=lambda i: (i is not None, i or 0))
    assert Counter((i, tuple(x)) for i, x in back) == Counter((r[0], tuple(ids_of(tok, r[1]) + [2])) for r in doc_rows)
    some = list(records.records(folder, files[0]))
    assert [x.tolist() for _, x in records.records(folder, files[0], [2, 0])] == [some[2][1].tolist(), some[0][1].tolist()]
    got = records.digests(manifest, folder).toPandas().sort_values("start")
    assert list(got["start"]) == [0, *np.cumsum(got["n_tokens"])[:-1]]
    assert list(got["ids_crc32"]) == [zlib.crc32(np.array(x, "<u4").tobytes()) for _, x in back]


def test_damaged_records_are_noticed(tmp_path):
    whole = bytearray(records.frame(b"payload"))
    for at in (0, 14, len(whole) - 1):
        bad = whole.copy()
        bad[at] ^= 1
        (tmp_path / "x").write_bytes(bad)
        with open(tmp_path / "x", "rb") as f, pytest.raises((ValueError, Exception)):
            records.read_record(f)
    (tmp_path / "x").write_bytes(whole)
    with open(tmp_path / "x", "rb") as f:
        assert records.read_record(f) == b"payload"


def test_records_empty(no_docs):
    assert records.encode_and_read_back(no_docs).count() == 0
