"""Trained operators (held-out accuracy), top-k search and page text."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from seatcast.llm import html, langid, quality, topk


def test_language(docs, doc_rows, no_docs):
    got = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    lang = {r[0]: r[2] for r in doc_rows}
    made = [i for i in got if i is not None and i < 9000]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in made)
    held = [i for i in made if got[i]["held_out"]]
    assert np.mean([got[i]["lang_pred"] == lang[i] for i in held]) > 0.95
    for i in (9001, 9002, 9003, 9005):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["accepted"]) == ("und", 0, False)
    assert got[9006]["lang_pred"] in lang.values() and got[None]["held_out"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert langid.identify(no_docs).count() == 0


def test_language_without_choice(docs):
    got = langid.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in got.collect()} == {"und"}
    got = langid.identify(docs.where("lang = 'en'"))
    assert {r["lang_pred"] for r in got.collect()} <= {"en", "und"}


def test_grams_do_not_depend_on_blocks(monkeypatch):
    text = ("some words and äöü " * 300).encode()
    whole = np.sort(np.concatenate(list(langid.grams(text))))
    monkeypatch.setattr(langid, "BLOCK", 64)
    assert (np.sort(np.concatenate(list(langid.grams(text)))) == whole).all()


def test_quality(docs, doc_rows, labels, no_docs):
    got = {r["doc_id"]: r for r in quality.classify(docs, labels).collect()}
    bad = {r[0]: "!!" in (r[1] or "") for r in doc_rows}
    held = [i for i in got if i is not None and i < 9000 and got[i]["held_out"]]
    assert np.mean([got[i]["predicted"] == (not bad[i]) for i in held]) > 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    assert got[9001]["score"] == got[9002]["score"]
    assert quality.classify(no_docs, labels).count() == 0
    none = quality.classify(docs, labels.where("quality > 5")).collect()
    assert {r["score"] for r in none} == {1.0}


def test_chunks_cover_the_text():
    for n in (0, 1, 255, 256, 257, 496, 497, 5000):
        text = bytes(np.random.default_rng(n).integers(1, 256, n, dtype=np.uint8))
        c = quality.chunks(text)
        step = quality.CHUNK - quality.OVERLAP
        back = b"".join(bytes(x[:step]) for x in c[:-1]) + bytes(c[-1])
        assert back.rstrip(b"\0") == text


def test_scores_do_not_depend_on_batches(monkeypatch):
    rows = [(b"good words here and there " * 8, 1), (b"BAD!! " * 30, 0)] * 40
    m = quality.fit(rows)
    texts = [t * k for t, _ in rows[:2] for k in (1, 7, 60)] + [b""]
    whole = m.scores(texts)
    monkeypatch.setattr(quality, "BATCH", 3)
    assert m.scores(texts) == pytest.approx(whole, abs=1e-5)
    assert whole[0] > 0.5 > whole[3]


def brute_top(vectors, k):
    rows = {}
    for i, v in vectors:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        x = [int(np.floor(64 * float(np.float32(c)))) for c in v]
        rows[i] = min(rows.get(i, x), x)
    out = []
    for q in rows:
        if q % 20 == 0:
            score = lambda c: sum(a * b for a, b in zip(rows[q], rows[c]))
            best = sorted((c for c in rows if c != q), key=lambda c: (-score(c), c))[:k]
            out += [(q, r, c, score(c)) for r, c in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("n, block", [(3, 8192), (300, 8192), (300, 37)])
def test_top_k(spark, monkeypatch, n, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(n)
    vectors = [(i, [float(x) for x in rng.choice([-0.5, -0.1, 0.0, 0.02, 0.3, 0.9], 6)]) for i in range(n)]
    vectors += [(1001, None), (1002, [None] * 6), (1003, [float("nan")] * 6), (1004, [float("inf")] + [0.0] * 5),
                (None, [1.0] * 6), (2, vectors[2][1]), (1020, [0.5, 0.5]), (1040, [])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in vectors], "vec_id long, embedding array<float>, score string")
    got = topk.top_k(frame, F.col("vec_id") % 20 == 0).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == brute_top(vectors, 20)


def test_reading_stops_early_where_bounds_allow():
    rng = np.random.default_rng(0)
    x = rng.integers(-3, 3, (2000, 2))
    x[:30] = 100 + rng.integers(0, 50, (30, 2))
    q = np.array([[5, 1], [1, 4]])
    found = {i: (c, s) for i, c, s in topk.no_random_access(np.arange(2000), x, np.array([-1, -2]), q, 5)}
    for i, v in ((0, q[0]), (1, q[1])):
        s = x @ v
        best = np.lexsort((np.arange(2000), -s))[:5]
        assert (found[i][0] == best).all() and (found[i][1] == s[best]).all()


@pytest.mark.parametrize("top", [3, 40, 2**28])
def test_best_of_many_blocks_carry_their_bound(monkeypatch, top):
    monkeypatch.setattr(topk, "SLICE", 7)
    rng = np.random.default_rng(top)
    x = rng.integers(-top, top + 1, (600, 8))
    x[::9] = x[0]                                             # ties
    q = x[::20]
    best = topk.Best(np.arange(600)[::20], q, 20)
    for block in np.array_split(rng.permutation(600), 13):
        best.meet(block, x[block])
    for at, i in enumerate(range(0, 600, 20)):
        s = x.astype(object) @ q[at].astype(object)
        s[i] = -(1 << 70)
        want = sorted((c for c in range(600) if c != i), key=lambda c: (-s[c], c))[:20]
        assert best.vec[at].tolist() == want and best.score[at].tolist() == [s[c] for c in want]


def test_known_bounds_stop_the_reading_and_spare_lower_bounds(monkeypatch):
    rng = np.random.default_rng(2)
    x, q = rng.integers(-50, 50, (500, 16)), rng.integers(-50, 50, (5, 16))
    monkeypatch.setattr(np, "partition", None)                # lower bounds would need it
    found = list(topk.no_random_access(np.arange(500), x, np.full(5, -1), q, 20, np.full(5, 1 << 62)))
    assert found == []


def test_units_stay_few():
    assert [topk.bands(1, 13, 8), topk.bands(16, 2442, 1000), topk.bands(1526, 244_000, 1000), topk.bands(1, 1, 8)] == [8, 63, 1, 1]


def test_large_components_stay_exact():
    x = np.array([[2**40 + 1, 1], [2**40, 3], [5, 5]])
    (_, c, s), = topk.no_random_access(np.array([1, 2, 3]), x, np.array([9]), np.array([[2**20 + 1, 1]]), 2)
    assert list(c) == [1, 2] and list(s) == [(2**40 + 1) * (2**20 + 1) + 1, 2**40 * (2**20 + 1) + 3]


def test_top_k_empty(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(empty, F.col("vec_id") % 20 == 0).count() == 0
    odd = spark.createDataFrame([(1, [1.0]), (3, [2.0])], "vec_id long, embedding array<float>")
    assert topk.top_k(odd, F.col("vec_id") % 20 == 0).count() == 0


ARTICLE = [f"Sentence {i} of the story goes on for a while, with some words, and ends here." for i in range(8)]
PAGES = {
    "plain": "<body><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav><article><h1>Title</h1>{p}</article>"
             "<footer>&copy; 2020 Somebody</footer></body>",
    "divs": '<body><div class="navbar"><a href=/>Home</a> | <a href=/b>More</a></div><div id="content"><h1>Title</h1>{p}</div>'
            '<div class="sidebar"><h3>Related</h3><ul><li><a href=/x>One</a></li></ul></div>'
            '<div class="cookie-notice"><p>We use cookies.</p></div></body>',
    "talk": "<body><header><h1>Site</h1></header><main><h1>Title</h1>{p}</main><section class='comments'><h2>Comments</h2>"
            "<div class=comment><p>I do not agree with this at all, sorry to say.</p></div></section>"
            "<form action=/s><label>Search</label><input><button>Go</button></form><script>var x = '<p>no</p>';</script></body>",
}


def page_rows():
    rng = np.random.default_rng(0)
    rows = []
    for i in range(40):
        text = "".join(f"<p>{' '.join(rng.choice(ARTICLE).split()[:rng.integers(5, 15)])}.</p>" for _ in range(rng.integers(3, 9)))
        rows.append((i, f"u{i}", PAGES["plain"].replace("{p}", text).replace("Title", f"Title {i}"), "x"))
    for k, (name, page) in enumerate(PAGES.items()):
        rows.append((100 + k, name, page.replace("{p}", "".join(f"<p>{t}</p>" for t in ARTICLE)), "x"))
    return rows + [(200, None, None, "x"), (201, "", "", "x"), (202, "u", "no markup &amp; <b>bold</b> <", "x"),
                   (203, "u", "<p>" * 3000 + "deep" + "<div>" * 3000, "x"), (None, "u", "<p>x</p>", "x"),
                   (0, "u0", rows[0][2], "x")]


def test_pages(spark):
    rows = page_rows()
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html.main_text(frame).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    want = "\n".join(["Title", *ARTICLE])
    for k in range(len(PAGES)):
        assert by[100 + k]["text"] == want, list(PAGES)[k]
    assert by[200]["text"] == by[201]["text"] == "" and by[200]["n_chars"] == 0
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert html.main_text(empty).count() == 0


def test_parsing_ends_what_browsers_end():
    def text(h):
        nodes = html.parse(h)
        return html.render(nodes, [html.own_lines(n) for n in nodes], np.array([not n.silent for n in nodes]))
    assert text("<p>a<p>b<li>c<li>d") == "a\nb\nc\nd"
    assert text("a &lt;b&gt; &#233;&eacute; <b>x</b>y<br>z") == "a <b> éé xy z"
    assert text("<p>x\n\t  y&nbsp;z</p><!-- <p>no</p> --><style>p{}</style>w") == "x y z\nw"
    assert text("<div>one<p>two</p>three</div>") == "one\ntwo\nthree"
    assert text("<p>end &am") == "end &am" and text("<p>cut<a href='x") == "cut"


def test_decoding_is_consistent():
    nodes = html.parse("<div><div><p>keep this</p></div><p>drop</p></div>")
    f, lines, own = html.features(nodes)
    z = np.array([-1.0, -0.5, 0.2, 3.0, -3.0])
    keep = html.decode(nodes, lines, own, z)
    assert all(not keep[i] or keep[n.parent] for i, n in enumerate(nodes) if i)
    assert list(keep) == [True, True, True, True, False]


def long_rows(n=60, words=6000):
    """Labelled documents that are all longer than what is learned from each."""
    import random
    rng, syllables = random.Random(9), {"en": "the and ing tion er on re at".split(), "de": "sch ung ein der keit zu ver lich".split()}
    out = []
    for i in range(n):
        lang = "en" if i % 2 else "de"
        text = " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))
        out.append((i, text.upper() + "!!" if i % 4 < 2 else text, lang))
    return out


def test_long_documents_alone_are_learned_from(spark):
    rows = long_rows()
    assert min(len(r[1].encode()) for r in rows) > langid.SAMPLE_BYTES
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = {r[0]: r[2] for r in rows}
    got = langid.identify(docs).collect()
    assert np.mean([r["lang_pred"] == want[r["doc_id"]] for r in got]) > 0.95 and np.mean([r["accepted"] for r in got]) > 0.9
    labels = spark.createDataFrame([(r[0], 0 if "!!" in r[1] else 1) for r in rows], "doc_id long, quality int")
    scored = quality.classify(docs, labels).collect()
    assert np.mean([r["predicted"] == (r["doc_id"] % 4 >= 2) for r in scored]) > 0.95


def test_a_rare_language_in_long_documents_is_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE", 200)
    monkeypatch.setattr(langid, "LEAST", 20)
    rows = [(i, f"the and tion here {i} with other words re at", "en") for i in range(3000)]
    rows += [(10_000 + r[0], r[1].lower(), "de") for r in long_rows(60, 4000) if r[2] == "de"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = [r["lang_pred"] for r in langid.identify(docs.where("doc_id >= 10000 or doc_id < 50")).collect() if r["doc_id"] >= 10_000]
    assert got and np.mean([g == "de" for g in got]) > 0.9
    seen = langid.train(docs).langs
    assert seen == ["de", "en"]


def test_bounded_pieces_are_spread_over_the_text(spark):
    from seatcast.llm.common import bounded
    text = "".join(f"{i:06d} " for i in range(20_000))
    got = spark.createDataFrame([(text,), ("short",), (None,)], "t string").select(bounded(F.col("t"), 4_000).alias("b")).collect()
    assert [r["b"] for r in got[1:]] == ["short", None] and len(got[0]["b"]) <= 4_000
    at = [text.index(p) for p in [got[0]["b"][i * 63:i * 63 + 62] for i in range(16)]]
    assert at == sorted(at) and all(i / 16 <= a / len(text) <= (i + 1) / 16 for i, a in enumerate(at))


def text_of(h):
    nodes = html.parse(h)
    return html.render(nodes, [html.own_lines(n) for n in nodes], np.array([not n.silent for n in nodes]))


def test_formulas_drawings_and_preformatted_text_stay_in_their_block():
    h = ("<article><p>Energy is <math><mi>E</mi></math> here.</p><p>a<svg/>b</p><math/><p>later text</p><xmp>code &amp; <b></xmp>"
         "<p>one<svg><path/><text>no</text></svg> two <label>name</label></p><p>x<button>press</button>y</p></article>")
    assert text_of(h) == "Energy is E here.\nab\nlater text\ncode &amp; <b>\none two name\nxy"


def test_a_tag_with_an_unclosed_quote_is_text():
    assert text_of('<p>before</p><p>1 <a href="x>y</a> 2</p><p>after</p>').startswith("before\n1")
    assert text_of('<p>before</p><p>1 <a href="x>y</a> 2</p><p>after</p>').endswith("after")


def test_long_pages_alone_are_learned_from(spark):
    body = lambda i: "".join(f"<p>Sentence number {i} {k}, which says something of its own and then ends.</p>" for k in range(1500))
    made = [(i, f"u{i}", f"<html><body><nav class=menu><ul><li><a href=/>Home</a></li><li><a href=/b>News</a></li></ul></nav>"
             f"<article>{body(i)}</article><div class=comments><p>I disagree with this, reader {i}.</p></div><footer>Legal</footer></body></html>")
            for i in range(30)]
    assert min(len(h) for *_, h in made) > 60_000
    got = html.main_text(spark.createDataFrame(made, "page_id long, url string, html string")).collect()
    for r in got:
        assert f"Sentence number {r['page_id']} 1499" in r["text"] and "I disagree" not in r["text"] and "Home" not in r["text"]
