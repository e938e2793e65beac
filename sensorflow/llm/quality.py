"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are laid out in chunks of ``CHUNK`` bytes that overlap by
``OVERLAP``, so that every byte of the whole text is covered. Learned byte
embeddings are convolved with learned filters, each filter is max-pooled over
its chunk, and a small dense layer over the maxima and the filled length gives the chunk's probability; the text's
probability is their mean, weighted by the bytes each chunk adds.

Texts that are null or empty get the training share of label 1. Every row is
scored by itself: repeated rows and equal texts get equal scores, extra columns
stay (one named as the score is replaced), an empty table gives an empty one. In
training, rows without a label or text are left out, and a document labelled twice
counts with the larger label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import as_strided
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import ship

CHUNK = 512
OVERLAP = 64
DIM = 4
WIDTH = 8
FILTERS = 24
HIDDEN = 24
EPOCHS = 8
BATCH = 64
RATE = 0.004
#: Labelled rows of each class a fit takes at most, and chunks of each text.
TRAIN_ROWS = {0: 1500, 1: 2500}
TRAIN_CHUNKS = 4
#: Share of the training chunks that are cut short at a random byte.
CUT_SHORT = 0.3


def chunks(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(rows of CHUNK bytes, bytes each row adds); padded with zero bytes."""
    raw = text.encode("utf-8", errors="replace")
    step = CHUNK - OVERLAP
    n = max(1, -(-(len(raw) - OVERLAP) // step))
    size = (n - 1) * step + CHUNK
    padded = np.zeros(size, dtype=np.uint8)
    padded[: len(raw)] = np.frombuffer(raw, dtype=np.uint8)
    adds = np.full(n, step, dtype=np.float64)
    adds[0] = min(len(raw), CHUNK)
    if n > 1:
        adds[-1] = len(raw) - CHUNK - (n - 2) * step
    return as_strided(padded, (n, CHUNK), (step, 1), writeable=False), adds


@dataclass
class Network:
    """Embeddings (256, DIM), filters (WIDTH * DIM, FILTERS) and dense layers."""

    emb: np.ndarray
    conv: np.ndarray
    conv_bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    share: float

    @classmethod
    def new(cls, share: float) -> Network:
        rng = np.random.default_rng(11)
        draw = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
        zeros = lambda n: np.zeros(n, dtype=np.float32)
        return cls(
            draw(0.5, 256, DIM), draw((WIDTH * DIM) ** -0.5, WIDTH * DIM, FILTERS), zeros(FILTERS),
            draw(FILTERS**-0.5, FILTERS + 1, HIDDEN), zeros(HIDDEN),
            draw(HIDDEN**-0.5, HIDDEN), zeros(1), share,
        )

    def params(self) -> list[np.ndarray]:
        return [
            self.emb, self.conv, self.conv_bias, self.dense, self.dense_bias, self.out, self.out_bias
        ]

    def windows(self, rows: np.ndarray) -> np.ndarray:
        """Embedded windows (rows, places, WIDTH * DIM), without a copy."""
        e = np.ascontiguousarray(self.emb[rows])
        a, b, c = e.strides
        return as_strided(e, (len(rows), CHUNK - WIDTH + 1, WIDTH * DIM), (a, b, c), writeable=False)

    def forward(self, rows: np.ndarray):
        w = self.windows(rows)
        maps = w.reshape(-1, WIDTH * DIM) @ self.conv
        maps = maps.reshape(len(rows), -1, FILTERS)
        filled = np.log1p((rows != 0).sum(axis=1, keepdims=True)).astype(np.float32)
        pooled = np.hstack([np.maximum(maps.max(axis=1) + self.conv_bias, 0), filled])
        hidden = np.maximum(pooled @ self.dense + self.dense_bias, 0)
        logit = np.clip(hidden @ self.out + self.out_bias, -60, 60)
        return w, maps, pooled, hidden, 1 / (1 + np.exp(-logit))

    def gradients(self, rows: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        w, maps, pooled, hidden, p = self.forward(rows)
        d = ((p - y) / len(y)).astype(np.float32)
        d_hidden = d[:, None] * self.out * (hidden > 0)
        d_pooled = (d_hidden @ self.dense.T * (pooled > 0))[:, :-1]
        best = maps.argmax(axis=1)  # the place of each filter's maximum
        picked = w[np.arange(len(rows))[:, None], best]  # rows, filters, inputs
        d_conv = np.einsum("bf,bfi->if", d_pooled, picked)
        d_picked = (d_pooled[:, :, None] * self.conv.T).reshape(len(rows), FILTERS, WIDTH, DIM)
        seen = rows[np.arange(len(rows))[:, None, None], best[:, :, None] + np.arange(WIDTH)]
        d_emb = np.zeros_like(self.emb)
        np.add.at(d_emb, seen.ravel(), d_picked.reshape(-1, DIM))
        return [
            d_emb, d_conv, d_pooled.sum(0), pooled.T @ d_hidden, d_hidden.sum(0),
            hidden.T @ d, d.sum(keepdims=True),
        ]

    def scores(self, texts: list[str | None]) -> list[float]:
        parts = [chunks(t) if t else (np.zeros((0, CHUNK), np.uint8), np.zeros(0)) for t in texts]
        owner = np.repeat(np.arange(len(texts)), [len(a) for _, a in parts])
        weight = np.concatenate([a for _, a in parts]) if parts else np.zeros(0)
        p = np.zeros(len(owner))
        at, waiting, held = 0, [], 0
        for i, (rows, _) in enumerate(parts):
            waiting.append(rows)
            held += len(rows)
            if held >= BATCH or i == len(parts) - 1:
                block = np.concatenate(waiting)
                for j in range(0, len(block), BATCH):
                    p[at + j : at + j + BATCH][: len(block) - j] = self.forward(block[j : j + BATCH])[4]
                at, waiting, held = at + len(block), [], 0
        total = np.bincount(owner, weight, minlength=len(texts))
        mean = np.bincount(owner, weight * p, minlength=len(texts)) / np.maximum(total, 1e-9)
        return np.where(total > 0, np.clip(mean, 0, 1), self.share).tolist()


def fit(sample: list[tuple[str, int]], epochs: int = EPOCHS) -> Network:
    """Training on chunks of (text, 0/1) rows, each with its text's label. An
    empty or one-class sample leaves the constant network of its share."""
    sample = [(t, y) for t, y in sample if t]
    share = float(np.mean([y for _, y in sample])) if sample else 0.5
    net = Network.new(share)
    if share in (0.0, 1.0) or not sample:
        share = min(max(share, 1e-6), 1 - 1e-6)
        net.out[:] = 0
        net.out_bias[:] = np.log(share / (1 - share))
        return net
    rng = np.random.default_rng(13)
    rows, labels = [], []
    for text, y in sample:
        got, _ = chunks(text)
        pick = rng.permutation(len(got))[:TRAIN_CHUNKS]
        rows.append(got[np.sort(pick)])
        labels += [y] * len(pick)
    x, y = np.concatenate(rows), np.array(labels, dtype=np.float32)
    ends = np.where(rng.random(len(x)) < CUT_SHORT, rng.integers(8, CHUNK, len(x)), CHUNK)
    x = np.where(np.arange(CHUNK) < ends[:, None], x, 0).astype(np.uint8)
    params = net.params()
    mean, square, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), BATCH):
            batch = order[i : i + BATCH]
            t += 1
            for p, g, m, v in zip(params, net.gradients(x[batch], y[batch]), mean, square):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= RATE / (1 + epoch / 2) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-7)
    return net


def score_documents(documents: DataFrame, net: Network, column: str = "score") -> DataFrame:
    """``documents`` with a double column of the text's probability of label 1;
    no shuffle. The broadcast network holds some 1,800 numbers."""
    spark = documents.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast((*net.params(), net.share))

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        local = Network(*shared.value)
        for batch in texts:
            values: list[float] = []
            for i in range(0, len(batch), 256):  # bounds the bytes laid out at once
                values += local.scores(list(batch.iloc[i : i + 256]))
            yield pd.Series(values, dtype="float64")

    return documents.withColumn(column, score(F.col("text")))
