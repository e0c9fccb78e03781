"""Quality by a byte-level convolutional network in numpy.

A text is its UTF-8 bytes, cut into overlapping chunks that cover all of it.
Learned filters of WIDTH bytes run over each chunk (a filter is a table of
weights by offset and byte value, so the convolution is table look-ups and
sums); ReLU and max-pooling give one value per filter and chunk.  A text's
features are the maximum and the mean of its chunks' values and its length;
a logistic layer combines them into one probability.

A second input channel tells whether a byte continues a repetition: whether
it and the RUN - 1 bytes before it equal the bytes some lag up to MAX_LAG
earlier.  The filters weigh it like a byte value.

Empty and null texts have one chunk of padding.  Without training texts of
both classes every score is the share of label 1 (0 if there is none).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.llm.common import pick
from clickspark.llm.labels import Logistic, held_out, sample

CHUNK, STEP, WIDTH, FILTERS = 256, 224, 6, 16
MAX_LAG, RUN = 24, 6
VALUES = 512  # byte value, plus 256 where it continues a repetition
BLOCK = 64  # chunks convolved at a time
MAX_TRAIN = 800  # texts of each class
EPOCHS, BATCH, RATE = 8, 16, 0.02
FOLDS, FOLD = 5, 0
CUT = 0.3


def channels(body: bytes) -> np.ndarray:
    """Input values of a text: bytes, plus 256 inside a repetition."""
    x = np.frombuffer(body, np.uint8)
    again = np.zeros(len(x), bool)
    for lag in range(1, min(MAX_LAG, len(x) - RUN) + 1):
        same = x[lag:] == x[:-lag]
        two = same[1:] & same[:-1]
        run = two[4:] & two[2:-2] & two[:-4]  # six in a row
        again[lag + RUN - 1:] |= run
    return x + (again.astype(np.uint16) << 8)


def chunks(text: str) -> np.ndarray:
    """Rows of CHUNK + WIDTH - 1 input values; zero pads the end."""
    x = channels(text.encode())
    n = max(1, -(-(len(x) - (CHUNK - STEP)) // STEP))
    padded = np.zeros((n - 1) * STEP + CHUNK + WIDTH - 1, np.uint16)
    padded[:min(len(x), len(padded))] = x[:len(padded)]
    at = np.arange(n)[:, None] * STEP + np.arange(CHUNK + WIDTH - 1)
    return padded[at]


def convolve(w: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """(chunks, CHUNK, FILTERS) filter responses."""
    out = w[0][rows[:, :CHUNK]]
    for j in range(1, WIDTH):
        out += w[j][rows[:, j:j + CHUNK]]
    return out


def pool(w: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """(chunks, FILTERS) maxima after ReLU, block by block."""
    got = [np.maximum(convolve(w, rows[i:i + BLOCK]).max(1) + bias, 0)
           for i in range(0, len(rows), BLOCK)]
    return np.concatenate(got)


class Network:
    def __init__(self, texts: list[str], labels: list[int], share: float, seed: int = 0):
        self.share, self.last = share, None
        y = np.array(labels, float)
        if len(set(labels)) < 2:
            return
        rng = np.random.default_rng(seed)
        self.w = rng.normal(0, 0.1, (WIDTH, VALUES, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        top = rng.normal(0, 0.3, 2 * FILTERS + 1)
        cut = [chunks(t) for t in texts]
        state = [[np.zeros_like(p), np.zeros_like(p)] for p in (self.w, self.bias, top)]
        step = 0
        for epoch in range(EPOCHS):
            rate = RATE * (1 - epoch / EPOCHS)
            order = rng.permutation(len(texts))
            for at in range(0, len(order), BATCH):
                batch = order[at:at + BATCH]
                gw, gb, gt = np.zeros_like(self.w), np.zeros_like(self.bias), np.zeros_like(top)
                for i in batch:
                    self._gradient(cut[i], y[i], top, gw, gb, gt)
                step += 1
                for p, g, (m, v) in zip((self.w, self.bias, top), (gw, gb, gt), state):
                    g /= len(batch)
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-7)
        x = np.stack([self._features(c, len(t)) for c, t in zip(cut, texts)])
        self.last = Logistic(x, y, penalty=3.0, share=share)

    def _gradient(self, rows, y, top, gw, gb, gt) -> None:
        """Add one text's gradients.  Only the byte position that won the
        pooling of a chunk and filter gets any."""
        n = len(rows)
        best = np.empty((n, FILTERS), np.int64)
        act = np.empty((n, FILTERS), np.float32)
        for i in range(0, n, BLOCK):
            z = convolve(self.w, rows[i:i + BLOCK])
            best[i:i + BLOCK] = z.argmax(1)
            act[i:i + BLOCK] = z.max(1) + self.bias
        live = act > 0
        act = np.where(live, act, 0)
        who = act.argmax(0)
        f = np.concatenate([act.max(0), act.mean(0), [1.0]])
        d = 1 / (1 + np.exp(-np.clip(f @ top, -30, 30))) - y
        gt += d * f
        g = np.repeat(d * top[None, FILTERS:-1] / n, n, 0)
        g[who, np.arange(FILTERS)] += d * top[:FILTERS]
        g = (g * live).astype(np.float32)
        gb += g.sum(0)
        c, k = np.nonzero(g)
        for j in range(WIDTH):
            np.add.at(gw[j], (rows[c, best[c, k] + j], k), g[c, k])

    def _features(self, rows: np.ndarray, size: int) -> np.ndarray:
        a = pool(self.w, self.bias, rows)
        return np.concatenate([a.max(0), a.mean(0), [np.log1p(size)]])

    def score(self, texts: list[str]) -> np.ndarray:
        if not texts or self.last is None:
            return np.full(len(texts), self.share)
        return self.last.predict(np.stack([self._features(chunks(t), len(t)) for t in texts]))


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Network:
    """Train on at most ``max_train`` texts of each class outside the held-out
    fold, corrected to the share of label 1 among all rows outside it."""
    rows, share = sample(docs, labels, "quality", FOLDS, FOLD, max_train)
    return Network([t for t, _ in rows], [y for _, y in rows], share)


def score(docs: DataFrame, model: Network, id_col: str = "doc_id", text_col: str = "text",
          cut: float = CUT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row.  The model (a few
    hundred kilobytes, fixed) is broadcast."""
    src = pick(docs, doc_id=id_col, text=text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([src.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def run(batches):
        net = shared.value
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                s = net.score([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s, pa.float64())],
                                                 names=["doc_id", "score"])
    return src.mapInArrow(run, schema).select(
        "doc_id", held_out(FOLDS, FOLD).alias("held_out"), "score",
        (F.col("score") >= cut).cast("int").alias("predicted"))
