"""Toxicity, quality, language and language-model scores."""

import math
import os
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sensorflow.llm import language, lm_scoring, quality, toxicity
from sensorflow.llm.common import id_remainder, labelled_sample

from .conftest import BAD, ENGLISH, GERMAN, crc, prose


def toxic_sample(n=400):
    rows = []
    for i in range(n):
        words = prose(i, 50 + i % 40).split()
        if i % 4 == 0:
            for k in range(3):
                words.insert((i * 7 + k * 11) % len(words), BAD[(i + k) % 3])
        rows.append((" ".join(words), int(i % 4 == 0)))
    return rows


@pytest.fixture(scope="module")
def tox():
    return toxicity.fit(toxic_sample())


def test_toxicity_learns_words_and_their_misspellings(tox):
    clean = prose(99991, 60)
    for word in (*BAD, "idiott", "morons"):
        words = clean.split()
        for at in (5, 20, 40):
            words.insert(at, word)
        assert tox.score(" ".join(words), {}) > 0.3, word
    assert tox.score(clean, {}) < 0.3
    assert 0 <= tox.score("", {}) < 0.3


def test_toxicity_constant_models():
    assert toxicity.fit([]).score("x", {}) == pytest.approx(0.5)
    assert toxicity.fit([("a b", 0)]).score("x", {}) < 1e-3


def test_toxicity_over_odd_rows(odd, empty, tox):
    scored = toxicity.score_documents(odd, tox, "__s")
    rows = scored.select("text", "__s").collect()
    assert len(rows) == 12
    assert all(abs(r["__s"] - tox.score(r["text"] or "", {})) < 1e-12 for r in rows)
    assert toxicity.score_documents(empty, tox).count() == 0


def quality_sample(n=240):
    rows = []
    for i in range(n):
        text = prose(i, 40 + 5 * (i % 30)).capitalize() + "."
        if i % 2:
            text = [text.upper().replace(" ", "!! "), text.replace(" ", "*** "), text.replace(" ", " | ")][i % 3]
        rows.append((text, 1 - i % 2))
    return rows


@pytest.fixture(scope="module")
def net():
    return quality.fit(quality_sample())


def test_quality_held_out(net):
    held = [(t, y) for t, y in quality_sample(300)[240:]]
    p = net.scores([t for t, _ in held])
    assert np.mean([(s >= 0.5) == (y == 1) for s, (_, y) in zip(p, held)]) >= 0.95


def test_quality_covers_the_whole_text(net):
    good = prose(3, 300).capitalize()
    junk = prose(4, 3000).replace(" ", "*** ")
    assert net.scores([good + " " + junk])[0] < 0.5 < net.scores([good])[0]
    rows, adds = quality.chunks("x" * 5000)
    assert adds.sum() == 5000 and rows.shape[1] == quality.CHUNK


def test_quality_gradients_match_differences():
    net = quality.Network.new(0.5)
    rows, _ = quality.chunks(prose(1, 400))
    y = np.arange(len(rows)) % 2
    for p in net.params():
        p[...] = p + 0.01

    def loss():
        p = net.forward(rows)[4].astype(np.float64)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grads = net.gradients(rows, y.astype(np.float32))
    for p, g in zip(net.params(), grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        keep, step = p[at], 2e-3
        p[at] = keep + step
        up = loss()
        p[at] = keep - step
        down = loss()
        p[at] = keep
        assert (up - down) / (2 * step) == pytest.approx(float(g[at]), rel=0.15, abs=2e-4)


def test_quality_over_odd_rows(odd, empty, net):
    rows = quality.score_documents(odd, net, "__s").select("text", "__s").collect()
    for r in rows:
        assert r["__s"] == pytest.approx(net.scores([r["text"]])[0], abs=1e-5)
        assert r["text"] or r["__s"] == net.share
    assert quality.score_documents(empty, net).count() == 0


@pytest.fixture(scope="module")
def field():
    sample = [(prose(i, 80), "en") for i in range(40)] + [(prose(i, 80, GERMAN), "de") for i in range(40)]
    return language.fit(sample, epochs=25)


def test_language_of_texts_and_words(field):
    en, de = prose(777, 50), prose(778, 50, GERMAN)
    got = field.predict([en, de, "", None, "123 !!", "²"])
    assert [g[0] for g in got] == ["en", "de", "und", "und", "und", "und"]
    mixed = language.words(en + " " + de)
    labels = np.array(field.labels)[field.word_posteriors([mixed]).argmax(axis=1)]
    assert (labels[:50] == "en").mean() > 0.9 and (labels[-50:] == "de").mean() > 0.9


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(0)
    e, t, s = rng.normal(size=(3, 5, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    length = np.array([5, 3, 1])
    got, pairs = language.forward_backward(e, length, t, s)
    want_pairs = np.zeros((3, 3))
    for i, n in enumerate(length):
        want, total, pair = np.zeros((5, 3)), 0.0, np.zeros((3, 3))
        for path in np.ndindex(*[3] * n):
            w = s[path[0]] + e[i, 0, path[0]]
            w += sum(t[path[k - 1], path[k]] + e[i, k, path[k]] for k in range(1, n))
            total += math.exp(w)
            for k, y in enumerate(path):
                want[k, y] += math.exp(w)
                if k:
                    pair[path[k - 1], y] += math.exp(w)
        assert np.allclose(got[i], want / total)
        want_pairs += pair / total
    assert np.allclose(pairs, want_pairs)


def test_language_over_odd_rows(odd, empty, field):
    rows = language.identify_documents(odd.select("doc_id", "text"), field).collect()
    for r in rows:
        lang, score = field.predict([r["text"]])[0]
        assert (r["lang_pred"], pytest.approx(r["score"], abs=1e-9)) == (lang, score)
    nothing = language.fit([])
    assert nothing.predict(["the"]) == [("und", 0.0)]
    assert language.training_sample(empty, empty["doc_id"].isNotNull()) == []
    assert language.identify_documents(empty, field).count() == 0


def test_labelled_sample_leaves_held_out_rows(spark, odd, empty):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(200)] + [(None, "x")], "doc_id bigint, text string")
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(200)] + [(3, 1), (None, 1), (5, None)], "doc_id bigint, toxic int"
    )
    got = labelled_sample(docs, labels, "toxic", 4, 2, {0: 30, 1: 1000})
    ids = [int(t[1:]) for t, _ in got]
    assert all(crc(i) % 4 != 2 for i in ids) and len(set(ids)) == len(ids)
    assert sum(y == 0 for _, y in got) == 30
    assert sum(y for _, y in got) == sum(crc(i) % 4 != 2 for i in range(1, 200, 2))
    left = docs.where(id_remainder(docs["doc_id"], 4) == 2).select("doc_id").collect()
    assert {r[0] for r in left} == {i for i in range(200) if crc(i) % 4 == 2}


def test_lm_scores_against_brute_force(spark, odd, empty):
    rows = [(i, prose(i, 30 + i)) for i in range(12)] + [(100, None), (101, "unseen words only"), (102, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    target = spark.createDataFrame([(i,) for i in (0, 1, 2, 2, None)], "doc_id bigint")
    got = {r["doc_id"]: r for r in lm_scoring.score_documents(docs, target).collect()}
    texts = {i: lm_scoring.words(t or "") for i, t in rows}
    counts = Counter(w for ws in texts.values() for w in ws)
    vocab = sorted(counts)
    ids = {w: i + 1 for i, w in enumerate(vocab)}

    def model(keys, scale):
        uni, pair, start = Counter(), Counter(), Counter()
        for k in keys:
            before = -1
            for w in texts[k]:
                uni[ids[w]] += 1
                pair[before, ids[w]] += 1
                start[before] += 1
                before = ids[w]
        total = sum(uni.values()) * scale
        one = lambda w: (uni[w] * scale + 1) / (total + len(vocab) + 1)

        def p(v, w):
            two = pair[v, w] / start[v] if start[v] else one(w)
            return lm_scoring.MIX * two + (1 - lm_scoring.MIX) * one(w)

        return p, sum(uni.values())

    p_target, n_target = model([0, 1, 2], 1.0)
    _, n_all = model(texts, 1.0)
    p_all, _ = model(texts, n_target / n_all)
    for k, ws in texts.items():
        lt = lb = 0.0
        before = -1
        for w in ws:
            lt -= math.log(p_target(before, ids[w]))
            lb -= math.log(p_all(before, ids[w]))
            before = ids[w]
        n = max(1, len(ws))
        assert got[k]["n_tokens"] == len(ws)
        assert got[k]["loss_target"] == pytest.approx(lt / n, abs=1e-5)
        assert got[k]["score"] == pytest.approx((lt - lb) / n, abs=1e-5)
    nobody = target.where("doc_id < 0")
    assert all(r["score"] == 0 for r in lm_scoring.score_documents(odd, nobody).collect())
    assert lm_scoring.score_documents(empty, target).count() == 0


def test_lm_bigrams_of_rare_words_count(spark, monkeypatch):
    """Documents that differ only in the order of two rare words."""
    monkeypatch.setattr(lm_scoring, "CHUNK_CHARS", 5000)
    common = " ".join(f"w{i} w{i} w{i} w{i} w{i} w{i} w{i} w{i}" for i in range(2200))
    rows = [(0, common), (1, "w1 aa bb w2"), (2, "w1 bb aa w2"), (3, "w1 aa bb w2 w3"), (4, "w1 bb aa w2 w3")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    target = docs.where("doc_id IN (0, 1)").select("doc_id")
    got = {r["doc_id"]: r["score"] for r in lm_scoring.score_documents(docs, target).collect()}
    assert got[3] < got[4] - 0.1


def test_lm_scores_do_not_depend_on_chunks_and_ranges(spark, odd, monkeypatch):
    target = odd.where("doc_id IN (0, 5, 6)").select("doc_id")

    def scores():
        rows = lm_scoring.score_documents(odd, target).collect()
        return sorted(((r["doc_id"], r["n_tokens"], round(r["loss_target"], 9), round(r["score"], 9)) for r in rows), key=str)

    want = scores()
    assert len(want) == odd.count() and any(r[3] for r in want)
    monkeypatch.setattr(lm_scoring, "CHUNK_CHARS", 700)
    monkeypatch.setattr(lm_scoring, "RANGE_CHARS", 2000)
    assert scores() == want


def test_lm_texts_are_shuffled_once(spark, tmp_path):
    """Texts are neither joined with the target ids nor written: both passes over the
    chunks read one exchange."""
    rows = [(i % 30 or None, prose(i % 45, 40)) for i in range(60)] + [(1, None), (None, "")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root))
    scored = lm_scoring.score_documents(docs, docs.where("doc_id < 9").select("doc_id"))
    assert len(scored.collect()) == len(rows)
    plan = scored._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert set(os.listdir(root)) == before
    assert [x for x in plan.splitlines() if "ReusedExchange" in x and "text#" in x]
    assert plan.count("MapInArrow") == 1


def test_lm_equal_rows_count_each(spark):
    """Many equal rows weigh as many, and a batch sends them as one."""
    rows = [(1, "aa bb cc")] * 200 + [(None, "aa cc")] * 50 + [(2, "cc bb aa dd"), (2, "aa dd")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    got = lm_scoring.score_documents(docs, docs.where("doc_id = 2").select("doc_id")).collect()
    assert Counter(r["doc_id"] for r in got) == {1: 200, None: 50, 2: 2}
    # "aa dd": 251 of 252 beginnings are aa, which dd follows 2 of 252 times; 706 tokens
    # of four words, 6 of them the target's
    loss = 0.0
    for n_one, n_two, held in ((252, 251, 252), (2, 2, 252)):
        one = (n_one * 6 / 706 + 1) / (6 + 4 + 1)
        loss -= math.log(lm_scoring.MIX * n_two / held + (1 - lm_scoring.MIX) * one)
    last = next(r for r in got if r["n_tokens"] == 2 and r["doc_id"] == 2)
    assert last["loss_background"] == pytest.approx(loss / 2, abs=1e-9)
    batch = pa.RecordBatch.from_pydict({"doc_id": ["1", "1", None, None], "text": ["a", "a", "", ""], "row": [5, 5, 5, 6]})
    found = pa.Table.from_batches(lm_scoring.merged_rows([batch])).to_pylist()
    assert sorted((r["row"], r["text"], r["times"]) for r in found) == [(5, "", 1), (5, "a", 2), (6, "", 1)]
    chunk = lm_scoring.Chunk(["aa bb", "aa"])
    n, t = chunk.counts(np.array([True, False]), np.array([3, 4]))
    # words aa, bb; contexts: beginning, aa; bigrams: beginning aa, aa bb
    assert sorted(n.tolist()) == [3, 3, 3, 7, 7, 7] and t.tolist() == [3] * 6


def test_lm_numbers_take_the_bytes_they_need():
    """A range's keys are sent as steps from its lower edge, without empty bytes."""
    rng = np.random.default_rng(5)
    x = np.sort(rng.integers(0, 2**64, 50_000, dtype=np.uint64))
    assert len(lm_scoring._packed(np.ones(1000, dtype=np.int64))) <= 1001
    for i, a, b in lm_scoring._slices(x, 7):
        data = lm_scoring._packed(np.diff(x[a:b], prepend=lm_scoring._edge(i, 7)))
        assert len(data) <= 7 * (b - a) + 1
        assert (np.cumsum(np.r_[lm_scoring._edge(i, 7), lm_scoring._unpacked(data)], dtype=np.uint64)[1:] == x[a:b]).all()
    for x in (np.zeros(3, np.uint64), np.zeros(0, np.uint64)):
        assert lm_scoring._unpacked(lm_scoring._packed(x)).tolist() == x.tolist()


def test_lm_packing_and_ranges():
    rng = np.random.default_rng(4)
    for n in (0, 1, 1000):
        x = rng.integers(0, 2**64, n, dtype=np.uint64)
        assert lm_scoring._unpacked(lm_scoring._packed(x)).tolist() == x.tolist()
        x.sort()
        for ranges in (1, 3, 64):
            parts = list(lm_scoring._slices(x, ranges))
            assert [v for _, a, b in parts for v in x[a:b].tolist()] == x.tolist()
            assert len({i for i, _, _ in parts}) == len(parts)


def test_english_and_german_fixture_words_differ():
    assert not set(ENGLISH.split()) & set(GERMAN.split())
