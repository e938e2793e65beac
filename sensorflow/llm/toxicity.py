"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word's vector is the mean of the vectors of the word and its character
n-grams, a text's vector the mean of its words' vectors, and a linear softmax
over it gives the class; embeddings and softmax are trained jointly with Adam
in numpy. Since n-gram vectors are shared, a misspelt or inflected word that
was never seen scores near the words it resembles.

Averaging and softmax are linear, so a trained model folds into one number per
subword: scoring sums these per distinct word and averages over all
words of the whole text. A text that is null, empty or without a word scores
the bias alone. Every row is scored by itself: repeated rows and equal texts get
equal scores, extra columns stay (one named as the score is replaced), an empty
table gives an empty one. In training, rows without a label or text are left out,
and a document labelled twice counts with the larger label.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import ship

SIZES = (3, 4, 5)
DIM = 4
#: Words of weight nothing that every average holds, so short texts don't swing.
NEUTRAL = 30
#: Weight of the sample's class share in the bias.
PRIOR = 0.5
RATE = 0.05
DECAY = 1e-4
EPOCHS = 150
#: A subword is learned if it stands in so many training documents, and in toxic
#: ones more or less often than chance by so many standard deviations.
MIN_DOCS = 5
MIN_Z = 6.0
CACHED_WORDS = 300_000
#: Labelled rows of each class a fit takes at most.
TRAIN_ROWS = {0: 2000, 1: 1000}

_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def subwords(word: str) -> list[str]:
    """The word itself and its n-grams, with boundary marks."""
    w = f"<{word}>"
    return [w] + [w[i : i + n] for n in SIZES for i in range(len(w) - n + 1)]


class Adam:
    def __init__(self, params: list[np.ndarray], rate: float) -> None:
        self.params, self.rate, self.t = params, rate, 0
        self.mean = [np.zeros_like(p) for p in params]
        self.square = [np.zeros_like(p) for p in params]

    def step(self, grads: list[np.ndarray]) -> None:
        self.t += 1
        for p, g, m, v in zip(self.params, grads, self.mean, self.square):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)


@dataclass
class Model:
    """The folded model: a number per learned subword, and the bias."""

    weights: dict[str, float]
    bias: float

    def word(self, word: str) -> float:
        grams = subwords(word)
        known = self.weights
        return sum([known[g] for g in grams if g in known]) / len(grams)

    def score(self, text: str, seen: dict[str, float]) -> float:
        found = words(text)
        if len(seen) > CACHED_WORDS:
            seen.clear()
        for w in set(found).difference(seen):
            seen[w] = self.word(w)
        total = math.fsum(map(seen.__getitem__, found))
        logit = total / (len(found) + NEUTRAL) + self.bias
        return 1 / (1 + math.exp(-min(max(logit, -500.0), 500.0)))


def fit(sample: list[tuple[str, int]], epochs: int = EPOCHS) -> Model:
    """Joint training on (text, 0/1) rows with Adam, classes
    weighted alike. An empty or one-class sample gives the constant model of
    its share of ones (one half if empty)."""
    y = np.array([label for _, label in sample], dtype=np.int64)
    share = float(y.mean()) if len(y) else 0.5
    if share in (0.0, 1.0) or not len(y):
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model({}, math.log(share / (1 - share)))
    in_docs: Counter[str] = Counter()
    in_toxic: Counter[str] = Counter()
    for (text, _), label in zip(sample, y):
        grams = {g for w in set(words(text)) for g in subwords(w)}
        in_docs.update(grams)
        if label:
            in_toxic.update(grams)
    spread = share * (1 - share)
    columns = {
        g: i
        for i, g in enumerate(
            sorted(
                g
                for g, n in in_docs.items()
                if n >= MIN_DOCS and (in_toxic[g] - n * share) ** 2 >= MIN_Z**2 * n * spread
            )
        )
    }
    del in_docs, in_toxic
    rows_of, cols_of, values_of = array("q"), array("q"), array("d")
    for d, (text, _) in enumerate(sample):
        counts = Counter(words(text))
        total = sum(counts.values()) + NEUTRAL
        bag: dict[int, float] = {}
        for w, n in counts.items():
            grams = subwords(w)
            for g in grams:
                if (c := columns.get(g)) is not None:
                    bag[c] = bag.get(c, 0.0) + n / (total * len(grams))
        rows_of.extend([d] * len(bag))
        cols_of.extend(bag)
        values_of.extend(bag.values())
    rows, cols, values = map(np.array, (rows_of, cols_of, values_of))
    # embeddings are learned per unit of a subword's usual weight in a text
    uses = np.maximum(1, np.bincount(cols, minlength=len(columns)))
    usual = np.bincount(cols, values, minlength=len(columns)) / uses
    values = values / usual[cols]

    def dot(to: np.ndarray, of: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
        sums = [np.bincount(to, c[of] * values, minlength=n) for c in np.ascontiguousarray(x.T)]
        return np.stack(sums, axis=1)

    rng = np.random.default_rng(7)
    emb = rng.normal(0, 1e-2, (len(columns), DIM))
    out = rng.normal(0, 0.5, (DIM, 2))
    bias = np.zeros(2)
    adam = Adam([emb, out, bias], RATE)
    target = np.eye(2)[y]
    balance = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))[:, None] / len(y)
    for _ in range(epochs):
        hidden = dot(rows, cols, emb, len(y))
        logits = hidden @ out + bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        d = (p - target) * balance
        d_emb = dot(cols, rows, d @ out.T, len(columns)) + DECAY * emb
        adam.step([d_emb, hidden.T @ d, d.sum(axis=0)])
    folded = emb @ (out[:, 1] - out[:, 0]) / usual
    prior = math.log(share / (1 - share))
    return Model(
        {g: float(folded[i]) for g, i in columns.items()}, float(bias[1] - bias[0]) + PRIOR * prior
    )


def score_documents(documents: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``documents`` with a double column of the text's probability; no shuffle.

    The model is broadcast; its size is bounded by that of the fit's sample.
    """
    spark = documents.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast((model.weights, model.bias))

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        local, seen = Model(*shared.value), {}
        for batch in texts:
            yield pd.Series([local.score(t or "", seen) for t in batch], dtype="float64")

    return documents.withColumn(column, score(F.col("text")))
