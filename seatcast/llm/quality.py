"""Quality classifier: a byte-level convolutional network in numpy.

The bytes of a text go through an embedding into overlapping chunks that cover
it from end to end.  Learned filters slide over each chunk, and each filter's
highest response is kept (max-pooling).  The mean and the maximum of the chunk
vectors over the document feed one logistic output.  All weights are trained by
Adam on the driver from about ``SAMPLE`` labelled ids, at least ``LEAST`` of each
label; a text longer than ``SAMPLE_BYTES`` is learned from pieces spread over all
of it, and each epoch sees up to ``TRAIN_CHUNKS`` chunks of a document.  The last fifth of the sample sets the output's scale and offset.

Scoring runs on the executors over whole texts, ``BATCH`` chunks at a time.

Cases: null or empty text is one chunk of padding and gets a score like any
other; very long texts are read in bounded batches; repeated rows get equal
rows; without labelled rows, or with one label only, the score is the mean
label (1 where there is none); an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatcast.llm.common import bounded, held_out, stage, stratified, texts_of

SAMPLE, SAMPLE_BYTES = 4_000, 20_000     # labelled ids to learn from; bytes of each, spread over its text
LEAST = 400                              # ids of either label at least, where there are as many
CHUNK, OVERLAP = 256, 16
WIDTH, STRIDE, EMB, FILTERS = 12, 2, 8, 32
POSITIONS = (CHUNK - WIDTH) // STRIDE + 1
TRAIN_CHUNKS, EPOCHS, LEAST_STEPS, BATCH_DOCS, RATE = 6, 8, 500, 32, 0.004
BATCH = 128                    # chunks a forward pass holds at a time
ACCEPT = 0.3
MIXER = 0x9E3779B97F4A7C15


def chunks(text: bytes) -> np.ndarray:
    """(m, CHUNK) bytes: chunk i begins at i * (CHUNK - OVERLAP); the end is padded with zeros."""
    step = CHUNK - OVERLAP
    m = max(1, -(-(len(text) - OVERLAP) // step))
    padded = np.frombuffer(text.ljust((m - 1) * step + CHUNK, b"\0"), np.uint8)
    return np.lib.stride_tricks.as_strided(padded, (m, CHUNK), (step, 1))


@dataclass
class Model:
    emb: np.ndarray       # (256, EMB)
    conv: np.ndarray      # (WIDTH * EMB, FILTERS)
    conv_bias: np.ndarray
    out: np.ndarray       # (2 * FILTERS,)
    bias: float
    constant: float | None = None

    def windows(self, c: np.ndarray) -> np.ndarray:
        """(m, POSITIONS, WIDTH * EMB) view of the embedded chunks."""
        x = np.take(self.emb, c, axis=0).reshape(len(c), CHUNK * EMB)
        s = x.strides
        return np.lib.stride_tricks.as_strided(x, (len(c), POSITIONS, WIDTH * EMB), (s[0], s[1] * STRIDE * EMB, s[1]))

    def pooled(self, c: np.ndarray, where: bool = False):
        """(m, FILTERS) highest responses, and their places if asked for."""
        w = self.windows(c)
        r = (np.ascontiguousarray(w).reshape(-1, WIDTH * EMB) @ self.conv).reshape(len(c), POSITIONS, FILTERS)
        if not where:
            return np.maximum(r.max(axis=1) + self.conv_bias, 0)
        at = r.argmax(axis=1)
        top = np.take_along_axis(r, at[:, None], 1)[:, 0] + self.conv_bias
        return np.maximum(top, 0), at, w

    def logit(self, pooled_sum, pooled_max, n) -> float:
        return float(np.concatenate([pooled_sum / n, pooled_max]) @ self.out + self.bias)

    def scores(self, texts, n_texts: int | None = None) -> list[float]:
        """Chunks of all texts run through the filters in full batches."""
        n_texts = len(texts) if n_texts is None else n_texts
        if self.constant is not None:
            return [self.constant] * n_texts
        sums = np.zeros((n_texts, FILTERS), np.float64)
        tops = np.zeros((n_texts, FILTERS), np.float32)
        counts = np.zeros(n_texts, np.int64)
        held, owner, n = [], [], 0

        def flush():
            p, own = self.pooled(np.concatenate(held)), np.concatenate(owner)
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            docs = own[first]
            sums[docs] += np.add.reduceat(p, first, axis=0)
            tops[docs] = np.maximum(tops[docs], np.maximum.reduceat(p, first, axis=0))
            counts[docs] += np.diff(np.r_[first, len(own)])

        for d, t in enumerate(texts):
            c = chunks(t)
            for at in range(0, len(c), BATCH):
                part = c[at:at + BATCH]
                held.append(part)
                owner.append(np.full(len(part), d))
                n += len(part)
                if n >= BATCH:
                    flush()
                    held, owner, n = [], [], 0
        if held:
            flush()
        z = np.concatenate([sums / np.maximum(counts, 1)[:, None], tops], axis=1) @ self.out + self.bias
        return (1 / (1 + np.exp(-np.clip(z, -40, 40)))).tolist()


def fit(rows: list[tuple[bytes, int]], seed: int = 11) -> Model:
    """Train on (text, label) pairs, back-propagating to the pooled places."""
    rng = np.random.default_rng(seed)
    labels = np.array([y for _, y in rows], np.float32)
    f32 = lambda *s, scale: (rng.standard_normal(s) * scale).astype(np.float32)
    m = Model(f32(256, EMB, scale=0.5), f32(WIDTH * EMB, FILTERS, scale=(WIDTH * EMB * 0.25) ** -0.5),
              np.zeros(FILTERS, np.float32), f32(2 * FILTERS, scale=0.1), 0.0)
    if not len(rows) or labels.min() == labels.max():
        m.constant = float(labels.mean()) if len(rows) else 1.0
        return m
    n_check = len(rows) // 5
    docs = [chunks(t) for t, _ in rows]
    bias = np.zeros(1, np.float32)
    params = [m.emb, m.conv, m.conv_bias, m.out, bias]
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step, train = 0, np.arange(n_check, len(rows))
    per_epoch = -(-len(train) // BATCH_DOCS)
    epochs = max(EPOCHS, -(-LEAST_STEPS // per_epoch))      # small samples are gone through more often
    total = epochs * per_epoch
    for _ in range(epochs):
        order = rng.permutation(train)
        for lo in range(0, len(order), BATCH_DOCS):
            pick = order[lo:lo + BATCH_DOCS]
            parts = [docs[d] if len(docs[d]) <= TRAIN_CHUNKS
                     else docs[d][rng.choice(len(docs[d]), TRAIN_CHUNKS, replace=False)] for d in pick]
            size = np.array([len(p) for p in parts])
            first = np.cumsum(size) - size
            c = np.concatenate(parts)
            pooled, at, w = m.pooled(c, where=True)
            doc = np.concatenate([np.add.reduceat(pooled, first, axis=0) / size[:, None],
                                  np.maximum.reduceat(pooled, first, axis=0)], axis=1)
            p = 1 / (1 + np.exp(-(doc @ m.out + bias[0])))
            g = (p - labels[pick]) / len(pick)
            own = np.repeat(np.arange(len(pick)), size)
            g_doc = g[:, None] * m.out
            g_pool = g_doc[own, :FILTERS] / size[own, None]
            g_pool = g_pool + np.where(pooled == doc[own, FILTERS:], g_doc[own, FILTERS:], 0)
            g_pool = np.where(pooled > 0, g_pool, 0).astype(np.float32)
            g_conv, g_emb = np.empty_like(m.conv), np.zeros_like(m.emb)
            rows_ = np.arange(len(c))
            for f in range(FILTERS):        # only the pooled window of each chunk has a gradient
                g_conv[:, f] = g_pool[:, f] @ w[rows_, at[:, f]]
                byte = c[rows_[:, None], at[:, f, None] * STRIDE + np.arange(WIDTH)]
                grad = g_pool[:, f, None, None] * m.conv[:, f].reshape(WIDTH, EMB)
                for e in range(EMB):
                    g_emb[:, e] += np.bincount(byte.ravel(), grad[..., e].ravel(), 256)
            step += 1
            rate = RATE * (1 - step / (total + 1))
            for prm, grad, (m1, m2) in zip(params, (g_emb, g_conv, g_pool.sum(0), doc.T @ g, [g.sum()]), state):
                grad = np.asarray(grad, np.float32)
                m1 += 0.1 * (grad - m1)
                m2 += 0.01 * (grad * grad - m2)
                prm -= rate * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-8)
    m.bias = float(bias[0])
    calibrate(m, rows[:n_check], labels[:n_check])
    return m


def calibrate(m: Model, rows, labels) -> None:
    """Scale and shift the output by logistic regression on the set-aside rows."""
    if not len(rows) or labels.min() == labels.max():
        return
    p = np.clip(np.array(m.scores([t for t, _ in rows])), 1e-6, 1 - 1e-6)
    z = np.log(p / (1 - p))
    y = np.where(labels > 0, (labels.sum() + 1) / (labels.sum() + 2), 1 / ((1 - labels).sum() + 2))   # never quite 0 or 1
    a, b = 1.0, 0.0
    for _ in range(50):        # Newton steps
        q = 1 / (1 + np.exp(-(a * z + b)))
        s, r = q * (1 - q) + 1e-6, q - y
        h = np.array([[(s * z * z).sum() + 1e-3, (s * z).sum()], [(s * z).sum(), s.sum() + 1e-3]])
        da, db = np.linalg.solve(h, [(r * z).sum(), r.sum()])
        a, b = a - np.clip(da, -1, 1), b - np.clip(db, -1, 1)
    if a > 0:
        m.out, m.bias = (m.out * a).astype(np.float32), float(m.bias * a + b)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on labelled ids of low hash that may be learned from, whatever the
    length of their texts; of an id that several rows have, one of them counts."""
    known = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").alias("id")).agg(F.max("quality").alias("y"))
             .withColumn("h", F.xxhash64(F.lit("quality"), "id")))
    picked = stage(stratified(known, "h", SAMPLE, "y", LEAST), "picked")     # a few thousand ids: Spark broadcasts them
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    found = texts.join(picked, F.col("doc_id") == F.col("id")).select("id", "y", "h", F.xxhash64("t").alias("at"),
                                                                      bounded(F.col("t"), SAMPLE_BYTES).alias("t"))
    rows = found.groupBy("id", "y", "h").agg(F.min_by("t", "at").alias("t")).collect()
    rows.sort(key=lambda r: (r["h"] * MIXER % (1 << 64), r["id"]))      # the rarer label has higher hashes: mix it in
    return fit([(r["t"].encode(), int(r["y"])) for r in rows])


def score(docs: DataFrame, model: Model, text: Column | str = "text") -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(texts_of(texts), len(texts)), pa.float64())

    return of(text)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    got = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(docs, train(docs, labels)).alias("score"))
    return got.select("*", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
