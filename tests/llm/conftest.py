import zlib

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ENGLISH = "the of and to in that it was for on are with as this from by be at or an"
GERMAN = "der die und das ist nicht ein eine mit von auf den dem des sich auch zu für im als"
BAD = ("idiot", "moron", "scum")


def prose(seed: int, words: int, vocab: str = ENGLISH) -> str:
    """Repeatable prose: a linear congruence over the vocabulary and its pairs."""
    pool = vocab.split()
    out = []
    for i in range(words):
        seed = (seed * 1103515245 + 12345) % (1 << 31)
        w = pool[(seed >> 8) % len(pool)]
        if seed % 3 == 0:
            w += pool[(seed >> 16) % len(pool)]
        out.append(w)
    return " ".join(out)


def crc(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode())


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows."""
    long_text = prose(5, 4000) + " " + "ab" * 3000 + " " + "x" * 2000
    return [
        (0, prose(1, 60), "en", "a", 1),
        (1, None, "en", "a", None),
        (2, "", None, "a", 0),
        (3, "   ", "en", None, 3),
        (4, "one two", "en", "a", 7),
        (5, "!!! 123 ...", "en", "a", 11),
        (6, long_text, "en", "a", len(long_text)),
        (7, prose(1, 60), "en", "b", 1),
        (7, prose(1, 60), "en", "b", 1),
        (None, prose(9, 30), "de", "b", 5),
        (None, None, None, None, None),
        (2**60 + 1, "größe 日本語 🙂 naïve", "de", "c", 18),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows with extra columns whose names the operators use inside."""
    extra = ", score double, node string, label int, `group` bigint, ids binary, edited string"
    rows = [(*r, 0.5, "n", 1, 2, b"x", "e") for r in odd_rows]
    return spark.createDataFrame(rows, SCHEMA + extra).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
