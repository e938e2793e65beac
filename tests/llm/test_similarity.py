"""Fingerprints, near duplicates and top-k search against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from sensorflow.llm import fingerprints, near_dedup, topk

from .conftest import ENGLISH, SCHEMA, prose


def shingles(text):
    w = [x for x in re.split(r"[\W_]+", text.lower()) if x]
    if not w:
        return {text} if text else set()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def by_id(row):
    return (row[0] is not None, row[0] or 0, row[1] or "")


def test_fingerprints_of_odd_rows(odd, odd_rows):
    docs = sorted(((r[0], r[1] or "") for r in odd_rows), key=by_id)
    got = fingerprints.fingerprint_documents(odd).collect()
    want = []
    for i, (doc_id, text) in enumerate(docs):
        following = docs[(i + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    assert sorted([(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got], key=key) == sorted(want, key=key)
    equal = {r["fingerprint"] for r in got if r["doc_id"] in (0, 7)}
    assert len(equal) == 1 and len(equal.pop()) == fingerprints.BINS
    assert all(r["fingerprint"] == "" for r in got if r["n_chars"] == 0)
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))


def test_fingerprint_likeness_is_near_the_truth(spark):
    base = [prose(i, 200) for i in range(60)]
    rows = [(2 * i, t) for i, t in enumerate(base)]
    rows += [(2 * i + 1, " ".join(t.split()[: 100 + i] + prose(i + 500, 100 - i).split())) for i, t in enumerate(base)]
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA)
    text = dict(rows)
    off = [r["near_next"] - jaccard(text[r["doc_id"]], text[(r["doc_id"] + 1) % 120])
           for r in fingerprints.fingerprint_documents(docs).collect()]
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.07


def test_fingerprint_tables_of_no_and_one_row(spark, empty):
    assert fingerprints.fingerprint_documents(empty).count() == 0
    one = spark.createDataFrame([(5, "a b c d e f", None, None, None)], SCHEMA)
    row = fingerprints.fingerprint_documents(one).first()
    assert row["near_next"] == 1.0


def test_fingerprint_next_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGES", 7)
    monkeypatch.setattr(fingerprints, "DOCS_PER_RANGE", 3)
    ids = sorted({(i * i * 37) % 100_003 for i in range(150)}) + [10**12]
    docs = spark.createDataFrame([(i, str(i)) for i in ids], "doc_id bigint, text string").repartition(4)
    got = {r["doc_id"]: r["next_text"] for r in fingerprints.with_next(docs, ["text"]).collect()}
    assert got == {i: str(ids[(k + 1) % len(ids)]) for k, i in enumerate(ids)}


def test_fingerprints_stay_in_the_jvm(odd):
    plan = fingerprints.fingerprint_documents(odd)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval|CartesianProduct", plan)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_alignment_is_exact():
    rng = random.Random(8)
    pairs, want = [], []
    for _ in range(400):
        a = [rng.randint(0, 20) for _ in range(rng.randint(0, 60))]
        b = list(a)
        for _ in range(rng.randint(0, 14)):
            if b and rng.random() < 0.5:
                del b[rng.randrange(len(b))]
            else:
                b.insert(rng.randint(0, len(b)), rng.randint(0, 20))
        pairs.append((np.array(a, np.uint32), np.array(b, np.uint32)))
        n = max(len(a), len(b))
        want.append(edit_distance(a, b) <= int(0.2 * n + 1e-9))
    assert near_dedup.similar(pairs).tolist() == want


def test_sketches_see_order():
    words = near_dedup.word_hashes(prose(3, 200), {})
    turned = np.concatenate([words[100:], words[:100]])
    same = near_dedup.sketches(words) == near_dedup.sketches(turned)
    kept = near_dedup.sketches(words) == near_dedup.sketches(words[3:])
    assert same.mean() < 0.75 < kept.mean()
    assert len(near_dedup.sketches(words[:2])) == near_dedup.SKETCHES


def near_rows():
    """Exact copies, a chain of near copies, a shared passage, odd texts."""
    base = prose(1, 120).split()
    rows = [(0, " ".join(base)), (1, " ".join(base)), (50, " ".join(base))]
    for i in range(2, 30):
        edited = list(base)
        for k in range(4):
            edited[(i * 13 + k * 29) % 120] = f"new{i}x{k}"
        rows.append((i, " ".join(edited)))
    passage = prose(70, 40)
    rows += [(100 + i, prose(200 + i, 60) + " " + passage + " " + prose(300 + i, 60)) for i in range(30)]
    rows += [(200, None), (201, ""), (202, "!!!"), (203, "!!!"), (204, "one two"), (205, "one two three")]
    return rows


def test_near_duplicates_against_brute_force(spark):
    rows = near_rows()
    docs = spark.createDataFrame([(*r, None, None, 1) for r in rows], SCHEMA).repartition(3)
    got = {r["doc_id"]: r for r in near_dedup.near_duplicates(docs).collect()}
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, s) in enumerate(rows):
        for j, t in rows[:n]:
            s_words, t_words = (near_dedup.word_hashes(x or "", {}).astype(np.uint32) for x in (s, t))
            same = (s or "") == (t or "")
            if same or (len(s_words) and len(t_words) and near_dedup.similar([(s_words, t_words)])[0]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert {i: r["class_id"] for i, r in got.items()} == {i: find(i) for i in root}
    assert {i for i, r in got.items() if r["is_kept"]} == set(root.values()) & {i for i in root if find(i) == i}
    kept = near_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({find(i) for i in root})


def substituted(rng, words, share):
    out = list(words)
    for k in rng.sample(range(len(out)), int(share * len(out))):
        out[k] = f"n{rng.randrange(10**9)}"
    return out


def test_pairs_behind_an_unlike_text_are_linked(spark):
    """Each pair shares a long passage with all, so that one text that is like
    none of them leads their buckets."""
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = [word() for _ in range(100)]
    rows = []
    for i in range(40):
        own = [word() for _ in range(200)]
        rows.append((2 * i, " ".join(passage + own)))
        rows.append((2 * i + 1, " ".join(passage + substituted(rng, own, 0.28))))
    docs = spark.createDataFrame([(*r, None, None, 1) for r in rows], SCHEMA).repartition(3)
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(docs).collect()}
    assert got == {i: i - i % 2 for i in range(80)}


def test_near_duplicates_in_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([(*r, None, None, 1) for r in near_rows()], SCHEMA)
    want = {tuple(r) for r in near_dedup.near_duplicates(docs).collect()}
    monkeypatch.setattr(near_dedup, "BLOCK_WORDS", 600)
    assert {tuple(r) for r in near_dedup.near_duplicates(docs).collect()} == want


@pytest.mark.parametrize("share, most", [(0.1, 0), (0.15, 3), (0.2, 9)])
def test_sketches_find_pairs_at_the_threshold(share, most):
    rng = random.Random(6)
    missed = 0
    for _ in range(300):
        a = [f"w{rng.randrange(10**6)}" for _ in range(300)]
        b = substituted(rng, a, share)
        x, y = (near_dedup.sketches(near_dedup.word_hashes(" ".join(t), {})) for t in (a, b))
        missed += not (x == y).any()
    assert missed <= most


def unit_of(texts):
    words = [near_dedup.word_hashes(t, {}).astype(np.uint32) for t in texts]
    return np.arange(len(texts)), words


def joined(n, pairs):
    label = list(range(n))
    for a, b in pairs:
        label = [label[a] if x == label[b] else x for x in label]
    return [[i for i in range(n) if label[i] == x] for x in sorted(set(label))]


@pytest.mark.parametrize("seed", range(6))
def test_unit_links_connect_all_similar_texts(seed):
    """Against all pairs, for unlike texts with a common passage, chains of near
    copies, repeated words and known roots."""
    rng = random.Random(seed)
    pool = [f"w{k}" for k in range(40 if seed % 2 else 5000)]
    passage = rng.choices(pool, k=30)
    texts = []
    for _ in range(12):
        own = passage + rng.choices(pool, k=rng.randrange(5, 80))
        for _ in range(rng.randrange(1, 5)):
            texts.append(" ".join(own))
            own = substituted(rng, own, rng.choice([0.02, 0.15, 0.25]))
    ids, words = unit_of(texts)
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if near_dedup.similar([(words[i], words[j])])[0]]
    got = near_dedup.unit_links(ids, words)
    assert joined(len(texts), got) == joined(len(texts), pairs)
    assert len(got) == len(texts) - len(joined(len(texts), pairs)) and set(got) <= set(pairs)
    roots = np.array([i // 2 for i in ids])
    some = [(2 * k, 2 * k + 1) for k in range(len(ids) // 2)]
    got = near_dedup.unit_links(roots, words)
    assert joined(len(texts), got + some) == joined(len(texts), pairs + some)
    first = ids % 3 == 0
    got = near_dedup.unit_links(ids, words, first)
    assert joined(len(texts), got) == joined(len(texts), [p for p in pairs if first[p[0]] != first[p[1]]])


@pytest.mark.parametrize("band", [0, 1, 3, 10, 40])
def test_banded_gives_the_distance_within_its_band(band):
    rng = random.Random(band)
    for _ in range(300):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 30))] for _ in range(2))
        want, got = edit_distance(a, b), near_dedup.banded(a, b, band)
        assert got == want if want <= band else got > band


def test_two_texts_are_compared_in_their_first_sketch_only(monkeypatch):
    """A group of near copies that its least text does not connect: no two are
    aligned in more than one of the sketches that they share, and no link is lost."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    ids, words = unit_of([" ".join(substituted(rng, base, 0.11)) for _ in range(60)])
    keys = np.stack([near_dedup.sketches(w.astype(np.uint64)) for w in words])
    tried, found = [], []
    real = near_dedup.similar
    monkeypatch.setattr(near_dedup, "similar", lambda pairs: tried.extend(pairs) or real(pairs))
    for j in range(near_dedup.SKETCHES):
        for key in np.unique(keys[:, j]):
            m = np.flatnonzero(keys[:, j] == key)
            links = near_dedup.unit_links(ids[m], [words[i] for i in m], None, keys[m, :j] if j else None)
            found += [(int(m[a]), int(m[b])) for a, b in links]
    pairs = {frozenset((x.tobytes(), y.tobytes())) for x, y in tried}
    assert len(tried) == len(pairs) > 60
    agree = [(i, k) for i in ids for k in range(i) if (keys[i] == keys[k]).any() and real([(words[i], words[k])])[0]]
    assert joined(len(ids), found) == joined(len(ids), agree)


def test_unlike_texts_with_a_passage_give_no_pairs(spark, monkeypatch, tmp_path):
    """Twice as many unlike texts around one passage: links leave the units, not
    pairs, and alignments do not grow with the square."""
    rng = random.Random(8)
    passage = [f"p{rng.randrange(10**6)}" for _ in range(40)]
    tried = {}
    for n in (200, 400):
        texts = [" ".join(rng.choices(ENGLISH.split(), k=600) + passage + [f"w{rng.randrange(10**6)}" for _ in range(360)])
                 for _ in range(n)]
        ids, words = unit_of(texts)
        count = []
        real = near_dedup.similar
        monkeypatch.setattr(near_dedup, "similar", lambda pairs: count.append(len(pairs)) or real(pairs))
        assert near_dedup.unit_links(ids, words) == []
        monkeypatch.setattr(near_dedup, "similar", real)
        tried[n] = sum(count)
        nodes = spark.createDataFrame([(f"{i:04d}", t) for i, t in enumerate(texts)], "node string, text string")
        (tmp_path / str(n)).mkdir()
        assert near_dedup.connected(nodes, str(tmp_path / str(n))).count() == 0
    assert tried == {200: 0, 400: 0}


def test_near_duplicates_of_odd_rows(odd, empty):
    rows = near_dedup.near_duplicates(odd).collect()
    assert len(rows) == 12
    classes = {}
    for r in rows:
        classes.setdefault(r["doc_id"], set()).add(r["class_id"])
    assert classes[0] == classes[7] == {0}
    kept = near_dedup.deduplicate(odd)
    assert kept.columns == odd.columns
    texts = sorted(r["text"] or "" for r in kept.collect())
    assert len(texts) == len(set(texts)) == 8
    assert near_dedup.near_duplicates(empty).count() == 0
    assert near_dedup.deduplicate(empty).count() == 0


def test_components_of_a_long_chain(spark):
    edges = [(f"{i:03d}", f"{i + 1:03d}") for i in range(40)] + [("a", "b"), ("b", "a"), ("c", "c")]
    got = near_dedup.components(spark.createDataFrame(edges, "a string, b string")).collect()
    assert {r["node"]: r["root"] for r in got} == {f"{i:03d}": "000" for i in range(41)} | {"a": "a", "b": "a"}


def brute_top(points, queries, k):
    out = set()
    for q, v in queries:
        scored = sorted((-int(v @ w), c) for c, w in points if c != q and len(w) == len(v))
        out |= {(q, n + 1, c, -s) for n, (s, c) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("spread, growth", [(1.0, 16), (0.05, 3)])
def test_top_k_against_brute_force(spark, monkeypatch, spread, growth):
    monkeypatch.setattr(topk, "GROWTH", growth)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8))
    vectors = {i: (centres[i % 6] + spread * rng.normal(size=8)).tolist() for i in range(300)}
    for i in range(100, 200):
        vectors[i] = vectors[100]  # one very common vector: ties
    rows = [(i, v) for i, v in vectors.items()] + [(7, vectors[7])]
    odd = [(1000, None), (1001, [float("nan")] * 8), (1002, [None] + [0.0] * 7), (1020, [float("inf")] * 8),
           (None, [0.0] * 8), (1040, [1.0, 2.0]), (1041, [3.0, 4.0]), (1060, [])]
    frame = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>").repartition(3)
    got = topk.top_k(frame, lambda i: i % 20 == 0, k=20, candidates_per_block=64, queries_per_block=6, seed_rows=12)
    result = {tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()}
    points = [(i, np.floor(64 * np.array(v)).astype(int)) for i, v in vectors.items()]
    points += [(1040, np.array([64, 128])), (1041, np.array([192, 256]))]
    want = brute_top(points, [(i, v) for i, v in points if i % 20 == 0], 20)
    assert result == want


def test_top_k_counts_ids_and_not_rows(spark):
    """One id holds a third of the rows, with different and good vectors."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(200)]
    rows += [(7, (3 + 0.1 * rng.normal(size=4)).tolist()) for _ in range(100)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    got = topk.top_k(frame, lambda i: i % 20 == 0, k=20, candidates_per_block=64, queries_per_block=6, seed_rows=12)
    result = {tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()}
    points = [(i, np.floor(64 * np.array(v)).astype(int)) for i, v in rows]
    want = set()
    for q, v in (p for p in points if p[0] % 20 == 0):
        best = {}
        for c, w in points:
            if c != q:
                best[c] = max(best.get(c, -(2**62)), int(v @ w))
        ranked = sorted((-s, c) for c, s in best.items())[:20]
        want |= {(q, n + 1, c, -s) for n, (s, c) in enumerate(ranked)}
    assert result == want


def test_top_k_with_large_numbers_and_no_rows(spark):
    rows = [(i, [float(2**27 * (i % 5)), float(3 * i)]) for i in range(0, 60, 3)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {tuple(r) for r in topk.top_k(frame, lambda i: i % 20 == 0, k=5).select("query_id", "rank", "vec_id", "score").collect()}
    points = [(i, np.floor(64 * np.array(v)).astype(np.int64)) for i, v in rows]
    assert got == brute_top(points, [p for p in points if p[0] % 20 == 0], 5)
    assert topk.top_k(frame.where("false"), lambda i: i % 20 == 0).count() == 0


def test_cover_tree_covers():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(size=(500, 6)), np.ones((200, 6))])
    tree = topk.cover_tree(points)
    for rows, centre, radius, children in zip(tree.rows, tree.centres, tree.radii, tree.children):
        assert np.linalg.norm(points[rows] - centre, axis=1).max() <= radius + 1e-9
        if children:
            assert sorted(np.concatenate([tree.rows[c] for c in children])) == sorted(rows)
