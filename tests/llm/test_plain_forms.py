"""Scores and fingerprints of whole texts against plain loops."""

import math
import random
import re

import numpy as np
import xxhash

from sensorflow.llm import fingerprints, quality, toxicity

from .conftest import SCHEMA, prose


def xx(data, seed=42):
    """The engine's 64-bit hash: signed, of bytes or of a long."""
    raw = data if isinstance(data, bytes) else (data & (2**64 - 1)).to_bytes(8, "little")
    value = xxhash.xxh64_intdigest(raw, seed=seed & (2**64 - 1))
    return value - 2**64 if value >= 2**63 else value


def chain(values):
    seed = 42
    for v in values:
        seed = xx(v, seed)
    return seed


def plain_fingerprint(text):
    """One-permutation MinHash, bin by bin."""
    if not text:
        return ""
    words = [xx(w.encode()) for w in re.split(r"[^\w]|_", text.lower()) if w]
    if not words:
        shingles = [xx(text.encode())]
    elif len(words) < fingerprints.WORDS:
        shingles = [chain(words)]
    else:
        shingles = [chain(words[i : i + fingerprints.WORDS]) for i in range(len(words) - fingerprints.WORDS + 1)]
    least = {}
    for s in shingles:
        b = (s & (2**64 - 1)) >> fingerprints.SHIFT
        least[b] = min(least.get(b, s), s)
    digits = []
    for i in range(fingerprints.BINS):
        b = i
        if i not in least:  # the donor: the filled bin first in this bin's own order
            b = min((chain([i, b]) & -fingerprints.BINS) | b for b in least) & (fingerprints.BINS - 1)
        digits.append("0123456789abcdef"[least[b] & (2**fingerprints.BITS - 1)])
    return "".join(digits)


def test_fingerprints_equal_plain_minhash(spark):
    texts = [prose(i, n) for i, n in enumerate((1, 3, 5, 6, 40, 300, 2000))]
    texts += ["größe 日本語 naïve 12 three_four five's six", "!!! ...", "", "a " * 50, "the the the the the"]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_documents(docs).collect()}
    for i, t in enumerate(texts):
        following = texts[(i + 1) % len(texts)]
        assert got[i]["fingerprint"] == plain_fingerprint(t), t
        half = len(t) // 2
        edited = plain_fingerprint(t[: len(t) - half] + following[:half])
        assert got[i]["edited_fingerprint"] == edited
        for name, other in (("near_edited", edited), ("near_next", plain_fingerprint(following))):
            own = plain_fingerprint(t)
            same = sum(a == b for a, b in zip(own, other)) / fingerprints.BINS
            want = 1.0 if own == other else 0.0 if not own or not other else max(0.0, (same - 1 / 16) / (15 / 16))
            assert abs(got[i][name] - want) < 1e-12


def test_toxicity_scores_equal_the_unfolded_network():
    """Word vectors averaged over subwords, text vectors over words, a softmax."""
    rng = np.random.default_rng(3)
    texts = [prose(i, n) for i, n in enumerate((1, 4, 60, 500))] + ["", "!!!", "zzz unseen", "a a a b"]
    known = sorted({g for t in texts[:3] for w in toxicity.words(t) for g in toxicity.subwords(w)})
    emb = {g: rng.normal(size=toxicity.DIM) for g in known}
    out, bias = rng.normal(size=(toxicity.DIM, 2)), rng.normal(size=2)
    folded = {g: float(v @ (out[:, 1] - out[:, 0])) for g, v in emb.items()}
    model = toxicity.Model(folded, float(bias[1] - bias[0]))
    seen = {}
    for t in texts:
        total, words = np.zeros(toxicity.DIM), toxicity.words(t)
        for w in words:
            grams = toxicity.subwords(w)
            total += sum((emb.get(g, 0) for g in grams), np.zeros(toxicity.DIM)) / len(grams)
        logits = total / (len(words) + toxicity.NEUTRAL) @ out + bias
        want = math.exp(logits[1]) / (math.exp(logits[0]) + math.exp(logits[1]))
        assert abs(model.score(t, seen) - want) < 1e-9


def plain_quality(net, text):
    """Chunk by chunk, filter by filter, place by place."""
    raw = text.encode()
    step = quality.CHUNK - quality.OVERLAP
    total = weights = 0.0
    start = 0
    while True:
        own = np.zeros(quality.CHUNK, dtype=int)
        part = raw[start : start + quality.CHUNK]
        own[: len(part)] = list(part)
        pooled = []
        for f in range(quality.FILTERS):
            best = max(
                sum(float(net.emb[own[p + k]] @ net.conv[k * quality.DIM : (k + 1) * quality.DIM, f])
                    for k in range(quality.WIDTH))
                for p in range(quality.CHUNK - quality.WIDTH + 1)
            )
            pooled.append(max(0.0, best + float(net.conv_bias[f])))
        pooled.append(math.log1p(np.count_nonzero(own)))
        hidden = np.maximum(np.array(pooled) @ net.dense + net.dense_bias, 0)
        p = 1 / (1 + math.exp(-float(hidden @ net.out + net.out_bias[0])))
        adds = len(part) if start == 0 else len(part) - quality.OVERLAP
        total, weights = total + adds * p, weights + adds
        if start + quality.CHUNK >= len(raw):
            return total / weights
        start += step


def test_quality_scores_equal_plain_loops():
    net = quality.Network.new(0.4)
    rng = random.Random(2)
    net.conv_bias += np.float32(0.1)
    texts = [prose(1, 5), "ü" * 400, "".join(rng.choices("abc é\n", k=1100)), "x"]
    for text, got in zip(texts, net.scores(texts)):
        assert abs(got - plain_quality(net, text)) < 1e-4
