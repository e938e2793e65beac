"""Secret scans: three base patterns and a token-efficiency test.

Base kinds: ``assign`` (a keyword, an equals sign or colon, a value of six or
more characters), ``access`` (an AKIA key of 20 or more characters) and ``hex``
(24 or more lower-case hex digits). The method adds ``random``: a run of 20 or
more key characters whose characters per token, under a tiktoken vocabulary,
stay below ``ratio``. Natural words are few tokens; random strings are many. If
a run passes, its parts between ``/`` and ``=`` are tested, and in those that pass
the parts of letters and digits, each if it has 20 or more characters.
Excluded are digests of known length, UUIDs, numbers and identifiers (words of
letters, also joined by ``_``, ``-`` or ``/``, that take few tokens in lower
case), and runs inside a base span.

Null texts count as empty and have no spans. Offsets are code points, ends
exclusive.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.bpe import PATTERN
from sensorflow.llm.common import ship

KINDS = ("assign", "access", "hex", "random")
RATIO = 2.0
MIN_RUN = 20
STEP = 256

_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{MIN_RUN},}}")
_DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)")
_DIGEST_LENGTHS = {32, 40, 48, 56, 64, 96, 128}
_UUID = re.compile(r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}")
_NUMBER = re.compile(r"[0-9+/_=-]+")
_IDENTIFIER = re.compile(
    r"[+/_=-]*(?:(?:[A-Z]?[a-z]+|[A-Z]+)[0-9]{0,4}[+/_=-]+)*(?:[A-Z]?[a-z]+|[A-Z]+)[0-9]{0,4}[+/_=-]*"
)
#: Parts of a run, the longer ones first.
_PARTS = (re.compile(rf"[^/=]{{{MIN_RUN},}}"), re.compile(rf"[A-Za-z0-9]{{{MIN_RUN},}}"))
_LETTERS = re.compile(r"[A-Za-z]{3,}")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def chars_per_token(run: str, enc: tiktoken.Encoding) -> float:
    """Over steps of 256 characters, so long runs cost linear time."""
    steps = [run[i : i + STEP] for i in range(0, len(run), STEP)]
    return len(run) / sum(len(enc.encode_ordinary(s)) for s in steps)


def is_known(run: str, enc: tiktoken.Encoding, ratio: float = RATIO) -> bool:
    """Digests of known length, UUIDs, numbers and identifiers of words; letters
    that take many tokens are no words, parts of one or two letters may be."""
    if len(run) in _DIGEST_LENGTHS and _DIGEST.fullmatch(run):
        return True
    if _UUID.fullmatch(run) or _NUMBER.fullmatch(run):
        return True
    if not _IDENTIFIER.fullmatch(run):
        return False
    words = [w.lower() for w in _LETTERS.findall(run)]
    tokens = sum(len(w) / chars_per_token(w, enc) for w in words)
    return sum(map(len, words)) >= ratio * tokens


def random_parts(run: str, enc: tiktoken.Encoding, ratio: float = RATIO) -> list[tuple[int, int]]:
    """The run if it takes many tokens, else its longest parts that do."""
    todo, found = [(0, len(run), 0)], []
    while todo:
        s, e, level = todo.pop()
        part = run[s:e]
        if not is_known(part, enc, ratio) and chars_per_token(part, enc) < ratio:
            found.append((s, e))
        elif level < len(_PARTS):
            todo += [(s + m.start(), s + m.end(), level + 1) for m in _PARTS[level].finditer(part)]
    return sorted(found)


def find_spans(text: str, enc: tiktoken.Encoding, ratio: float = RATIO) -> list[tuple[int, int, int]]:
    """(start, kind, end) ascending; kinds by their place in KINDS."""
    found: list[tuple[int, int, int]] = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [
            (m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20
        ]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    base = sorted((s, e) for s, _, e in found)
    at, reach = 0, -1
    for m in _RUN.finditer(text):
        for s, e in random_parts(m[0], enc, ratio):
            s, e = m.start() + s, m.start() + e
            while at < len(base) and base[at][0] <= s:
                reach, at = max(reach, base[at][1]), at + 1
            if e > reach:
                found.append((s, 3, e))
    return sorted(found)


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan_documents(documents: DataFrame, vocabulary_path: str, ratio: float = RATIO) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans per row; no shuffle."""
    ship(documents.sparkSession)
    columns = ["n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"]

    @F.pandas_udf(
        "n_assign bigint, n_access bigint, n_hex bigint, n_random bigint,"
        " base_sha256 string, spans string"
    )
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = vocabulary(vocabulary_path)
        for batch in texts:
            rows = []
            for text in batch:
                spans = find_spans(text or "", enc, ratio)
                n = [sum(k == kind for _, k, _ in spans) for kind in range(len(KINDS))]
                base = shown([s for s in spans if s[1] < 3])
                rows.append((*n, hashlib.sha256(base.encode()).hexdigest(), shown(spans)))
            yield pd.DataFrame(rows, columns=columns)

    return documents.select("doc_id", run("text").alias("found")).select("doc_id", "found.*")


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each stretch of overlapping spans replaced by [SECRET]."""
    out, at = [], 0
    reach = -1
    for s, _, e in spans:
        if s >= reach:
            out += [text[at:s] if at <= s else "", "[SECRET]"]
            reach = e
        reach = max(reach, e)
        at = reach
    return "".join(out) + text[at:]


def redact_documents(documents: DataFrame, vocabulary_path: str, ratio: float = RATIO) -> DataFrame:
    """The same rows and columns with secrets in ``text`` replaced and ``n_chars``,
    where it is a column, recounted; null texts stay null."""
    ship(documents.sparkSession)

    @F.pandas_udf("string")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = vocabulary(vocabulary_path)
        for batch in texts:
            yield pd.Series(
                [t if t is None else redact(t, find_spans(t, enc, ratio)) for t in batch],
                dtype="object",
            )

    out = documents.withColumn("text", run("text"))
    if "n_chars" in documents.columns:
        changed = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
        out = out.withColumn("n_chars", changed.cast(documents.schema["n_chars"].dataType))
    return out
