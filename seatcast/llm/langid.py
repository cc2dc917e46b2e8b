"""Language ID: averaged hashed subword embeddings with a linear softmax.

A text is lower-cased, everything but letters becomes a blank, and its byte 3-
and 4-grams (blanks mark word borders) are hashed into an embedding table.  The
mean of their vectors goes through one linear layer.  Both are trained together
by stochastic gradient descent in numpy on the driver from a sample of about
``SAMPLE`` labelled rows, of any length and at least ``LEAST`` of each language;
a text longer than ``SAMPLE_BYTES`` is learned from pieces spread over all of it.
A fifth of the sample is set aside to fit a temperature (so that a score is the chance of being right)
and the score below which a prediction is rejected: ``KEEP`` of the set-aside
rows lie above it, and no more than ``CEILING`` is asked for.

Scoring reads whole texts in bounded blocks.  The layer is linear, so the table
is multiplied by it once, and a text's logits are the mean of its table rows.

Cases: null text, or one without a letter, is ``und`` with score 0 and rejected;
without training rows everything is ``und``; with a single language that one is
predicted with score 1; repeated rows get equal rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatcast.llm.common import bounded, held_out, stratified, texts_of

SAMPLE, SAMPLE_BYTES = 4_000, 20_000     # rows to learn from; bytes of each, spread over its text
LEAST = 100                              # rows of every language at least, where there are as many
BUCKET_BITS, DIM, EPOCHS, RATE = 16, 16, 8, 1.0
KEEP, CEILING = 0.998, 0.5
BLOCK = 1 << 19
UNKNOWN = "und"
MIXER = 0x9E3779B97F4A7C15
_BLANK = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def grams(text: bytes):
    """Hashed 3- and 4-gram indices of a lower-cased text, block by block."""
    clean = b" " + text.translate(_BLANK) + b" "
    for at in range(0, len(clean) - 2, BLOCK):
        b = np.frombuffer(clean[at:at + BLOCK + 3], np.uint8).astype(np.uint32)
        three = b[:-2] | b[1:-1] << 8 | b[2:] << 16
        four = three[:-1] | b[3:] << 24
        yield np.concatenate([(three[:BLOCK] * np.uint32(0x9E3779B1)) >> (32 - BUCKET_BITS),
                              ((four[:BLOCK] * np.uint32(0x85EBCA6B)) >> (32 - BUCKET_BITS)) + (1 << BUCKET_BITS)])


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray      # (buckets, languages): embedding times linear layer, over the temperature
    bias: np.ndarray
    threshold: float

    def scores(self, text: bytes) -> np.ndarray:
        total, n = np.zeros(len(self.langs)), 0
        for g in grams(text):
            total += np.take(self.table, g, axis=0).sum(axis=0, dtype=np.float64)
            n += len(g)
        z = total / max(n, 1) + self.bias
        p = np.exp(z - z.max())
        return p / p.sum()


def softmax(z):
    p = np.exp(z - z.max(axis=-1, keepdims=True))
    return p / p.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[str, str]], seed: int = 7) -> Model:
    """Train on (text, language) pairs."""
    rng = np.random.default_rng(seed)
    rows = [(t, lang) for t, lang in rows if any(map(str.isalpha, t))]
    langs = sorted({lang for _, lang in rows})
    n_buckets = 2 << BUCKET_BITS
    if len(langs) < 2:
        return Model(langs, np.zeros((n_buckets, len(langs)), np.float32), np.zeros(len(langs)), 0.0)
    bags = []
    for text, lang in rows:
        u, c = np.unique(np.concatenate(list(grams(text.lower().encode()))), return_counts=True)
        bags.append((u, (c / c.sum()).astype(np.float32), langs.index(lang)))
    n_check = len(bags) // 5
    check, train = bags[:n_check], bags[n_check:]
    emb = rng.uniform(-1 / DIM, 1 / DIM, (n_buckets, DIM)).astype(np.float32)
    lin, bias = np.zeros((DIM, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    steps, step = EPOCHS * len(train), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(train)):
            u, w, y = train[k]
            rate = RATE * (1 - step / steps)
            step += 1
            e = emb[u]
            h = w @ e
            g = softmax(h @ lin + bias)
            g[y] -= 1
            back = lin @ g
            lin -= rate * np.outer(h, g)
            bias -= 0.1 * rate * g
            emb[u] = e - (10 * rate) * w[:, None] * back
    table = emb @ lin
    temperature, threshold = 1.0, 0.0
    if check:
        z = np.array([w @ table[u] + bias for u, w, _ in check])
        y = np.array([y for *_, y in check])
        losses = {t: -np.log(softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean() for t in np.geomspace(0.25, 8, 26)}
        temperature = min(losses, key=losses.get)
        threshold = min(CEILING, float(np.quantile(softmax(z / temperature).max(axis=1), 1 - KEEP)))
    return Model(langs, (table / temperature).astype(np.float32), bias / temperature, threshold)


def train(docs: DataFrame) -> Model:
    """Fit on the sample: rows of low hash (of id and text) that may be learned
    from, whatever their length; more of rare languages.  Equal rows count once."""
    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.select(F.col("text").alias("t"), F.col("lang").alias("l"), F.xxhash64(F.lit("lang"), "doc_id", "text").alias("h"))
    sample = stratified(known, "h", SAMPLE, "l", LEAST).select("h", "l", bounded(F.col("t"), SAMPLE_BYTES).alias("t"))
    rows = sample.groupBy("h").agg(F.min("l").alias("l"), F.min("t").alias("t")).collect()
    rows.sort(key=lambda r: r["h"] * MIXER % (1 << 64))      # rare languages have higher hashes: mix them in
    return fit([(r["t"], r["l"]) for r in rows])


def predict(docs: DataFrame, model: Model, text: Column | str = "text") -> Column:
    """Struct column: lang_pred, score, accepted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double, accepted boolean")
    def of(texts: pa.Array) -> pa.Array:
        m = shared.value
        langs, scores = [], []
        for t in texts_of(pc.utf8_lower(texts)):
            if not m.langs or not any(map(str.isalpha, t.decode())):
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            p = m.scores(t)
            langs.append(m.langs[int(p.argmax())])
            scores.append(float(p.max()))
        accepted = [lang != UNKNOWN and s >= m.threshold for lang, s in zip(langs, scores)]
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                                           pa.array(accepted, pa.bool_())], names=["lang_pred", "score", "accepted"])

    return of(text)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted of every row."""
    got = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict(docs, train(docs)).alias("p"))
    return got.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.accepted")
