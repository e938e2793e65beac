"""SentencePiece, spelling variants and importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorflow.llm import pieces, resampling, spelling
from sensorflow.llm.queries import PIECES_FILE

LOWER = {i: i + 32 for i in range(65, 91)}


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES_FILE)


@pytest.fixture(scope="module")
def codec():
    return pieces.Codec(PIECES_FILE)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- SentencePiece ------------------------------------------------------------

PARTS = ["a", "b", "e", "t", "th", "in", "the ", " ", "  ", " " * 16, "▁", "é", "́", "漢", "😀",
         "\x00", "\n", "\t", "1", "23", "ﬁ", "　", "aa", "aaa", "ss", "=", "==", "//", "--", "...."]


def test_pieces_equal_the_library(library, codec):
    rng = random.Random(1)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(25))) for _ in range(3000)]
    texts += ["", "a" * 5000, " " * 5000 + "x", "ab " * 900, "".join(rng.choices("abcdeABCDE+/", k=20_000))]
    for text, ids in zip(texts, codec.encode_all(texts), strict=True):
        assert ids == library.encode(text, add_eos=True), text
        assert codec.decode(ids) == library.decode(ids)


@settings(deadline=None, max_examples=300)
@given(st.text(max_size=60))
def test_any_text_goes_round(text):
    codec = pieces.codec(PIECES_FILE)
    ids = codec.encode(text)
    assert ids[-1] == codec.end and codec.decode(ids) == text.replace("▁", " ")


def test_pieces_decode_any_ids(library, codec):
    rng = random.Random(2)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), rng.randrange(300)])
               for _ in range(rng.randrange(8))]
        assert codec.decode(ids) == library.decode(ids)


def test_merges_are_the_same_alone_and_without_counted_runs(library):
    """Words together or one by one, spaces counted out or merged: one result."""
    plain = pieces.Codec(PIECES_FILE)
    plain.runs = None
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choices([" ", "  ", "a", "b c", "\n"], k=rng.randrange(40)))
        assert plain.encode(text) == library.encode(text, add_eos=True)
    words = ["▁" + "".join(rng.choices("abst", k=rng.randrange(1, 40))) for _ in range(300)]
    assert plain.merged(words) == [plain.merged([w])[0] for w in words]


def test_pieces_of_odd_rows(odd, odd_rows, empty, library):
    got = sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
                 for r in pieces.encode_documents(odd, PIECES_FILE).collect())
    want = []
    for doc_id, text, *_ in odd_rows:
        ids = library.encode(text or "", add_eos=True)
        want.append((doc_id or -1, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))))
    assert got == sorted(want)
    assert pieces.encode_documents(empty, PIECES_FILE).count() == 0


def test_pieces_refuse_other_files(tmp_path, codec):
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(PIECES_FILE, "rb") as f:
        model.ParseFromString(f.read())
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "other.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="not a plain BPE model"):
        pieces.Codec(str(tmp_path / "other.model"))


# -- Spelling variants --------------------------------------------------------


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k:] == b[k + 1 :] if len(a) < len(b) else a[k + 1 :] == b[k + 1 :]


def brute_spelling(rows, times=10):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            word = run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[word] += len(word) >= 7
    words = {w: n for w, n in counts.items() if n >= 2}
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, some in near.items():
        if some and words[best := min(some, key=lambda x: (-words[x], x))] >= times * words[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {w: (form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def spelling_rows():
    """Chains of forms, ties, letters beyond ASCII, words below the length."""
    rows, at = [], 0
    counts = [("mistake", 400), ("mistakee", 30), ("mistakeee", 3), ("mistaké", 2), ("mastake", 2),
              ("größeres", 50), ("grösseres", 2), ("größeress", 4), ("GRÖSSERE", 3), ("abcdefg", 5),
              ("abcdefh", 50), ("abcdefi", 50), ("abcdef", 90), ("÷÷÷÷÷÷÷×", 3), ("÷÷÷÷÷÷÷", 30),
              ("aaaaaaaa", 40), ("aaaaaaa", 4), ("aaaaaaaaa", 2), ("baaaaaaa", 2)]
    for word, n in counts:
        for k in range(n):
            rows.append((at if k % 3 else None, f"{word.upper() if k % 2 else word}, x1{word}2" if k % 5 else word))
            at += 1
    return rows + [(at, None), (at + 1, ""), (at + 2, "12 . ?")]


def test_spelling_variants_equal_brute_force(spark):
    rng = random.Random(7)
    rows = spelling_rows()
    stems = ["".join(rng.choices("abcé", k=7)) for _ in range(60)]
    rows += [(i + 10_000, " ".join(rng.choices(stems, k=40)) + " " + "word " * 500) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS word", "2 AS n", "'x' AS form")
    want = brute_spelling(rows)
    assert any(v[0] and v[1] != v[0] for v in want.values())  # a chain of two forms
    for symbols in (1, 3, 8):
        got = {r["word"]: tuple(r)[1:] for r in spelling.spelling_variants(docs, symbols=symbols).collect()}
        assert got == want


def test_spelling_of_odd_rows(odd, odd_rows, empty):
    got = {r["word"]: tuple(r)[1:] for r in spelling.spelling_variants(odd).collect()}
    assert got == brute_spelling([r[:2] for r in odd_rows])
    assert spelling.spelling_variants(empty).count() == 0


@settings(deadline=None, max_examples=200)
@given(st.text("012", min_size=1, max_size=7), st.text("012", min_size=1, max_size=7))
def test_half_neighbourhood_rule(a, b):
    """Exactly one side of two reduced words one edit apart sends the other."""

    def half(r):
        out = {r[:i] + r[i + 1 :] for i in range(len(r))}
        return out | {r[:i] + s + r[i + 1 :] for i in range(len(r)) for s in "012" if s < r[i]}

    assert (b in half(a)) + (a in half(b)) == one_edit(a, b)


def test_half_neighbourhood_of_spark(spark):
    from pyspark.sql import functions as F

    words = spark.createDataFrame([("0",), ("210",), ("11",)], "r string")
    got = {r["r"]: set(r["h"]) for r in words.select("r", spelling.half_neighbourhood(F.col("r"), 3).alias("h")).collect()}
    assert got["210"] == {"210", "10", "20", "21", "110", "010", "200"}
    assert got["0"] == {"0", ""} and got["11"] == {"11", "1", "01", "10"}


# -- Importance resampling ----------------------------------------------------

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute_features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [zlib.crc32(g.encode()) % 10_000 for g in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def brute_resampling(rows, target):
    found = [(doc_id, *brute_features(text)) for doc_id, text in rows]
    s = Counter(b for _, _, f in found for b in f)
    t = Counter(b for text in target for b in brute_features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for doc_id, words, f in found:
        gains = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in f]
        weight = sum(gains) // len(f) if f else 0
        h = int(sha(f"7:{'' if doc_id is None else doc_id}")[:8], 16)
        out.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, words])
    drawn = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    for place, r in enumerate(drawn[: 25 * len(drawn) // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in out), key=str)


def test_features_of_any_text(monkeypatch):
    rng = random.Random(9)
    pool = ["The", "the", "Ünï", "x9", "日本", "a", " ", "  ", "\n", "-", "É", "_", "\x7f", "×"]
    for stretch in (1, 7, 1 << 20):
        monkeypatch.setattr(resampling, "STRETCH", stretch)
        for _ in range(300):
            text = "".join(rng.choices(pool, k=rng.randrange(60)))
            words, found = resampling.feature_buckets(text)
            want = brute_features(text)
            assert words == want[0] and sorted(found.tolist()) == sorted(want[1]), (stretch, text)


def test_resampling_equals_brute_force(spark, odd, odd_rows, empty):
    rng = random.Random(11)
    pool = [f"w{k}" for k in range(300)]
    rows = [r[:2] for r in odd_rows]
    rows += [(100 + i, " ".join(rng.choices(pool, k=rng.randrange(60)))) for i in range(300)]
    target = [" ".join(rng.choices(pool[:40], k=30)) for _ in range(20)] + [None, ""]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS score", "'x' AS buckets").repartition(5)
    aims = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(docs, aims)
    assert sorted(map(tuple, got.collect()), key=str) == brute_resampling(rows, target)
    nothing = resampling.resample(docs, aims.limit(0))
    assert sorted(map(tuple, nothing.collect()), key=str) == brute_resampling(rows, [])
    assert resampling.resample(empty, aims).count() == 0
    assert resampling.resample(odd, aims).columns == ["doc_id", "n_features", "weight", "score", "rank"]


def test_ranked_is_one_sequence(spark, tmp_path):
    rows = spark.range(5000).selectExpr("id", "id % 7 AS score")
    got = resampling.ranked(rows, [rows.score.desc(), rows.id.asc()], str(tmp_path)).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(1, 5001))
    assert [(-r["score"], r["id"]) for r in got] == sorted((-r["score"], r["id"]) for r in got)
