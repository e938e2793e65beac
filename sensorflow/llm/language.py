"""Language identification: a linear-chain conditional random field over words.

Every word of a text has a score for each language from its affixes, its inner
n-grams and its entry in a learned lexicon; learned transitions tie neighbouring
words together. Forward-backward over stretches of ``STRETCH`` words labels each
word of code-switched text with a distribution over the languages, and a text's
language is the one with the largest sum over all its words.

Training needs only texts and one language per text: training sequences are
spliced from stretches of texts in different languages, so that the field sees
switches, and the conditional likelihood is climbed with Adam in numpy.

A text that is null or holds no letter is ``und`` with score 0, as is every
text if no language could be learned. Of equally likely languages the first by
name counts. Every row is labelled by itself: repeated rows and equal texts get
equal labels, extra columns stay, an empty table gives an empty one; rows without
a language or text teach nothing.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import ship

STRETCH = 64
SEQUENCES = 6000
SEQUENCE = 32
#: Mean words of one language between two splices in a training sequence.
SPLICE = 16
EPOCHS = 60
RATE = 0.15
DECAY = 1e-6
MIN_COUNT = 3
CACHED_WORDS = 300_000
#: Training texts for each language, in expectation.
TRAIN_ROWS = 400

UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def features(word: str) -> list[str]:
    """Affixes of up to three letters, inner pairs and triples, the word itself."""
    return (
        [f"={word}"]
        + [f"^{word[:n]}" for n in (1, 2, 3) if n <= len(word)]
        + [f"{word[-n:]}$" for n in (1, 2, 3) if n <= len(word)]
        + [word[i : i + n] for n in (2, 3) for i in range(len(word) - n + 1)]
    )


def forward_backward(
    emission: np.ndarray, length: np.ndarray, transition: np.ndarray, start: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors (n, t, labels) and summed pair posteriors (labels, labels).

    ``emission`` (n, t, labels) holds log scores, ``length`` the words of each
    sequence; places beyond it get posterior zero.
    """
    n, steps, labels = emission.shape
    inside = np.arange(steps) < length[:, None]
    e = np.exp(emission - emission.max(axis=2, keepdims=True))
    step = np.exp(transition - transition.max())
    alpha, beta = np.empty_like(e), np.ones_like(e)
    a = np.exp(start - start.max()) * e[:, 0]
    alpha[:, 0] = a / a.sum(axis=1, keepdims=True)
    for t in range(1, steps):
        a = (alpha[:, t - 1] @ step) * e[:, t]
        alpha[:, t] = a / a.sum(axis=1, keepdims=True)
    for t in range(steps - 2, -1, -1):
        b = (beta[:, t + 1] * e[:, t + 1]) @ step.T
        b /= b.sum(axis=1, keepdims=True)
        beta[:, t] = np.where(inside[:, t + 1, None], b, 1.0)
    posterior = alpha * beta
    posterior /= posterior.sum(axis=2, keepdims=True)
    posterior *= inside[:, :, None]
    right = beta[:, 1:] * e[:, 1:]
    pair = alpha[:, :-1, :, None] * step * right[:, :, None, :]
    pair /= pair.sum(axis=(2, 3), keepdims=True)
    return posterior, (pair * inside[:, 1:, None, None]).sum(axis=(0, 1))


@dataclass
class Field:
    """Learned languages, feature weights, transitions and start scores."""

    labels: list[str]
    columns: dict[str, int]
    weights: np.ndarray
    transition: np.ndarray
    start: np.ndarray
    #: Distinct words seen: their rows in ``scores``; one worker's cache.
    rows: dict[str, int] = field(default_factory=dict)
    scores: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def emissions(self, found: list[str]) -> np.ndarray:
        new = set(found).difference(self.rows)
        if new:
            if len(self.rows) + len(new) > CACHED_WORDS:
                self.rows, new = {}, set(found)
            need = len(self.rows) + len(new)
            if need > len(self.scores):
                grown = np.zeros((2 * need, len(self.labels)))
                if self.rows:
                    grown[: len(self.rows)] = self.scores[: len(self.rows)]
                self.scores = grown
            owner, cols = array("q"), array("q")
            for w in new:
                known = [c for f in features(w) if (c := self.columns.get(f)) is not None]
                owner.extend([len(self.rows)] * len(known))
                cols.extend(known)
                self.rows[w] = len(self.rows)
            owner, cols = np.array(owner), np.array(cols)
            first = need - len(new)
            for k in range(len(self.labels)):
                self.scores[first:need, k] = np.bincount(
                    owner - first, self.weights[cols, k], minlength=len(new)
                )
        return self.scores[np.fromiter(map(self.rows.__getitem__, found), np.int64, len(found))]

    def word_posteriors(self, texts: list[list[str]]) -> np.ndarray:
        """The distribution of every word, texts one after the other."""
        flat = [w for t in texts for w in t]
        emission = self.emissions(flat)
        counts = np.array([len(t) for t in texts], dtype=np.int64)
        stretches = -(-counts // STRETCH)
        starts = np.repeat(np.cumsum(counts) - counts, stretches)
        nth = np.arange(len(starts)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
        length = np.minimum(np.repeat(counts, stretches) - nth * STRETCH, STRETCH)
        begin = starts + nth * STRETCH
        out = np.empty_like(emission)
        for i in range(0, len(begin), 2048):
            b, n = begin[i : i + 2048], length[i : i + 2048]
            place = b[:, None] + np.minimum(np.arange(n.max()), n[:, None] - 1)
            posterior, _ = forward_backward(emission[place], n, self.transition, self.start)
            inside = np.arange(n.max()) < n[:, None]
            out[place[inside]] = posterior[inside]
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        found = [words(t) if t else [] for t in texts]
        if not self.labels:
            return [(UNKNOWN, 0.0)] * len(texts)
        letters = [any(c.isalpha() for w in ws for c in w) for ws in found]
        posterior = self.word_posteriors(found)
        out, at = [], 0
        for ws, has_letter in zip(found, letters):
            if has_letter:
                mean = posterior[at : at + len(ws)].mean(axis=0)
                best = int(mean.argmax())
                out.append((self.labels[best], float(min(1.0, mean[best]))))
            else:
                out.append((UNKNOWN, 0.0))
            at += len(ws)
        return out


def _spliced(texts: dict[int, list[list[str]]], rng: np.random.Generator):
    """Training sequences of SEQUENCE words and their labels."""
    kinds = sorted(texts)
    for _ in range(SEQUENCES):
        ws: list[str] = []
        ys: list[int] = []
        while len(ws) < SEQUENCE:
            y = kinds[rng.integers(len(kinds))]
            text = texts[y][rng.integers(len(texts[y]))]
            at = rng.integers(len(text))
            part = text[at : at + 1 + int(rng.geometric(1 / SPLICE))]
            ws += part
            ys += [y] * len(part)
        yield ws[:SEQUENCE], ys[:SEQUENCE]


def fit(sample: list[tuple[str, str]], epochs: int = EPOCHS) -> Field:
    """A field from (text, language) rows."""
    labels = sorted({lang for _, lang in sample})
    texts: dict[int, list[list[str]]] = {}
    for text, lang in sorted(sample):
        if found := words(text):
            texts.setdefault(labels.index(lang), []).append(found)
    if not texts:
        return Field([], {}, np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0))
    n = len(labels)
    rng = np.random.default_rng(5)
    ids: dict[str, int] = {}
    drawn = list(_spliced(texts, rng))
    x = np.array([[ids.setdefault(w, len(ids)) for w in ws] for ws, _ in drawn])
    y = np.array([ys for _, ys in drawn])
    uses = np.bincount(x.ravel(), minlength=len(ids))
    count: Counter[str] = Counter()
    for w, i in ids.items():
        for f in set(features(w)):
            count[f] += int(uses[i])
    columns = {f: i for i, f in enumerate(sorted(f for f, c in count.items() if c >= MIN_COUNT))}
    parts = [(i, columns[f]) for w, i in ids.items() for f in features(w) if f in columns]
    of_word, of_feature = np.array(parts, dtype=np.int64).reshape(-1, 2).T
    weights, transition, start = np.zeros((len(columns), n)), np.zeros((n, n)), np.zeros(n)
    gold = np.eye(n)[y]
    gold_pairs = np.einsum("ntp,ntq->pq", gold[:, :-1], gold[:, 1:])
    length = np.full(len(x), SEQUENCE)
    params = [weights, transition, start]
    mean, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, epochs + 1):
        scores = np.stack(
            [np.bincount(of_word, c[of_feature], minlength=len(ids)) for c in weights.T], axis=1
        )
        posterior, pairs = forward_backward(scores[x], length, transition, start)
        off = (posterior - gold).reshape(-1, n)
        by_word = np.stack([np.bincount(x.ravel(), c, minlength=len(ids)) for c in off.T], axis=1)
        by_feature = np.stack(
            [np.bincount(of_feature, c[of_word], minlength=len(columns)) for c in by_word.T], axis=1
        )
        grads = [
            by_feature / x.size + DECAY * weights,
            (pairs - gold_pairs) / x.size + DECAY * transition,
            (posterior[:, 0] - gold[:, 0]).mean(axis=0),
        ]
        for p, g, m, v in zip(params, grads, mean, square):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return Field(labels, columns, weights, transition, start)


def training_sample(documents: DataFrame, may_learn: Column, rows: int = TRAIN_ROWS) -> list[tuple[str, str]]:
    """About ``rows`` (text, lang) of each language, drawn by the id's hash from
    the documents that may be learned from and have a text and a language."""
    known = documents.where(may_learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return []
    pairs = [F.lit(v) for lang, c in sorted(counts.items()) for v in (lang, min(1.0, rows / c))]
    drawn = (F.xxhash64("doc_id", "text") / F.lit(2.0**64) + 0.5) < F.create_map(*pairs)[F.col("lang")]
    return sorted((r[0], r[1]) for r in known.where(drawn).select("text", "lang").collect())


def identify_documents(documents: DataFrame, learned: Field) -> DataFrame:
    """``documents`` with ``lang_pred`` and ``score`` from its ``text``; no
    shuffle. The broadcast model is bounded by the fit's sample."""
    spark = documents.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(
        (learned.labels, learned.columns, learned.weights, learned.transition, learned.start)
    )

    @F.pandas_udf("lang_pred string, score double")
    def identify(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        local = Field(*shared.value)
        for batch in texts:
            rows: list[tuple[str, float]] = []
            for i in range(0, len(batch), 256):  # bounds the words laid out at once
                rows += local.predict(list(batch.iloc[i : i + 256]))
            yield pd.DataFrame(rows, columns=["lang_pred", "score"])

    return documents.withColumn("__found", identify(F.col("text"))).select(
        *documents.columns, "__found.lang_pred", "__found.score"
    )
