"""Bounded training samples and logistic calibration for the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickspark.llm.common import pick

#: Training texts are whole, and those longer than this are not drawn.
MAX_TRAIN_CHARS = 20_000


def held_out(folds: int, fold: int, key: str = "doc_id"):
    """Whether a row belongs to the fold kept from training: crc32 of the key
    as text, modulo ``folds``.  Null keys are held out."""
    crc = F.crc32(F.col(key).cast("string").cast("binary"))
    return F.coalesce(crc % folds == fold, F.lit(True))


def sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int,
           per_class: int) -> tuple[list[tuple[str, int]], float]:
    """At most ``per_class`` whole texts of each class, drawn by key hash, and
    the share of label 1 among all labelled rows outside the held-out fold.

    ``per_class`` bounds what reaches the driver (with MAX_TRAIN_CHARS).  Keys
    are drawn from the narrow label table first, so the texts are read in one
    scan against a broadcast of at most ``2 * per_class`` keys.  Rows with a
    null or other label, key or text are not drawn; a key labelled twice
    counts once, with its larger label.
    """
    lab = pick(labels, doc_id="doc_id", y=label)
    lab = (lab.where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(folds, fold))
           .groupBy("doc_id").agg(F.max("y").cast("int").alias("y")))
    drawn = [lab.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
             for y in (0, 1)]
    keys = F.broadcast(drawn[0].unionByName(drawn[1]))
    texts = pick(docs, doc_id="doc_id", text="text").where(
        F.col("text").isNotNull() & (F.length("text") <= MAX_TRAIN_CHARS))
    rows = texts.join(keys, "doc_id").select("doc_id", "text", "y").collect()
    first = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["text"])):
        first.setdefault(r["doc_id"], (r["text"], r["y"]))
    share = lab.agg(F.avg("y")).first()[0]
    return [first[k] for k in sorted(first)], float(share or 0.0)


class Logistic:
    """Logistic regression with an L2 penalty, by Newton steps on
    standardised features.  ``share`` of label 1 moves the intercept from the
    sample's share to that of the whole."""

    def __init__(self, x: np.ndarray, y: np.ndarray, penalty: float = 1.0,
                 share: float | None = None):
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-9
        z = self._design(x)
        w = np.zeros(z.shape[1])
        ridge = np.full(z.shape[1], penalty)
        ridge[0] = 1e-6
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            g = z.T @ (p - y) + ridge * w
            h = (z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge + 1e-9)
            step = np.linalg.solve(h, g)
            w -= np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-7:
                break
        if share is not None and 0 < share < 1:
            w[0] += np.log(share / (1 - share)) - np.log(y.mean() / (1 - y.mean()))
        self.w = w

    def _design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([np.ones((len(z), 1)), z])

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._design(x) @ self.w, -30, 30)))
