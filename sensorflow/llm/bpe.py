"""Byte-level BPE encoding and decoding with tree concatenation.

``Codec`` reads a ``tokenizers`` JSON file (a parameter) of a byte-level BPE
and gives the ids that library gives. Ordinary text is cut by the tokenizer's
own pattern. A long run without any cut (a pretoken longer than ``leaf``
characters) is cut into leaves, the leaves are encoded in parallel, and the
halves are concatenated pairwise up a tree: a window of tokens around the join
is encoded again and grows until its first token equals the left half's token
there and its last token the right half's. A BPE token sequence is the encoding
of its bytes exactly when every two neighbours are, so the joined sequence is
then the encoding of the whole run.

``encode_documents`` is the Spark operator. Null texts count as empty; an empty
text has no ids and decodes to an empty text; extra columns are dropped.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import ship

# The public byte-level pattern, and the same without lookahead,
# which cuts alike wherever no two white-space characters stand together.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+|"
    r" ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
PATTERN_SINGLE_SPACES = (
    r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
)
_SPACE_RUN = re.compile(r"\s\s")

LEAF = 512


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in character of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Codec:
    """Encoder and decoder for one byte-level BPE file."""

    def __init__(self, path: str, leaf: int = LEAF) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if (
            model["type"] != "BPE"
            or pre["type"] != "ByteLevel"
            or pre["add_prefix_space"]
            or spec.get("normalizer")
        ):
            raise ValueError(f"{path}: not a plain byte-level BPE")
        alphabet = byte_alphabet()
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        plain = {s: i for s, i in model["vocab"].items() if s not in self.specials}
        to_bytes = {s: bytes(alphabet[c] for c in s) for s in plain}
        made = []
        for merge in model["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            made.append(plain[left + right])
        if made != sorted(made):
            raise ValueError(f"{path}: merges aren't in the order of their ids")
        ranks = {to_bytes[s]: i for s, i in plain.items()}
        self.table = {i: b for b, i in ranks.items()}
        self.table |= {i: s.encode() for s, i in self.specials.items()}
        self.full = tiktoken.Encoding(
            "full", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.single = tiktoken.Encoding(
            "single", pat_str=PATTERN_SINGLE_SPACES, mergeable_ranks=ranks, special_tokens={}
        )
        self.one_piece = tiktoken.Encoding(
            "one", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={}
        )
        self.leaf = leaf
        self.cut = regex.compile(PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.long_run = re.compile(rf"\S{{{leaf},}}|\s{{{leaf},}}")
        special = "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True)))
        self.special = re.compile(f"({special})") if special else None

    def encode(self, text: str) -> list[int]:
        if self.special is None or not any(s in text for s in self.specials):
            return self._plain(text)
        ids: list[int] = []
        for part in self.special.split(text):
            if part in self.specials:
                ids.append(self.specials[part])
            elif part:
                ids += self._plain(part)
        return ids

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.table[i] for i in ids]).decode("utf-8", errors="replace")

    def _plain(self, text: str) -> list[int]:
        if self.long_run.search(text):
            return self._with_long_runs(text)
        if _SPACE_RUN.search(text):
            return self.full.encode_ordinary(text)
        return self.single.encode_ordinary(text)

    def _with_long_runs(self, text: str) -> list[int]:
        ids: list[int] = []
        for m in self.cut.finditer(text):
            piece = m.group()
            if len(piece) > self.leaf:
                ids += self.encode_run(piece)
            else:
                ids += self.one_piece.encode_ordinary(piece)
        return ids

    def encode_run(self, run: str) -> list[int]:
        """One unsplit run by tree concatenation."""
        leaves = [run[i : i + self.leaf] for i in range(0, len(run), self.leaf)]
        parts = self.one_piece.encode_ordinary_batch(leaves, num_threads=2)
        while len(parts) > 1:
            pairs = zip(parts[::2], parts[1::2])
            odd = parts[len(parts) - len(parts) % 2 :]
            parts = [self._join(a, b) for a, b in pairs] + odd
        return parts[0]

    def _join(self, left: list[int], right: list[int]) -> list[int]:
        width = 2
        while True:
            a, b = min(width, len(left)), min(width, len(right))
            window = left[len(left) - a :] + right[:b]
            again = self.one_piece._encode_single_piece(
                b"".join([self.table[i] for i in window])
            )
            agrees_left = a == len(left) or again[0] == window[0]
            agrees_right = b == len(right) or again[-1] == window[-1]
            if agrees_left and agrees_right:
                return left[: len(left) - a] + again + right[b:]
            width *= 2


@lru_cache(maxsize=4)
def codec(path: str, leaf: int = LEAF) -> Codec:
    """One codec per worker process."""
    return Codec(path, leaf)


def encode_documents(documents: DataFrame, tokenizer_path: str, leaf: int = LEAF) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text.

    One scan and no shuffle; each row's text is encoded where it is read.
    """
    ship(documents.sparkSession)

    @F.pandas_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = codec(tokenizer_path, leaf)
        shown = [str(i) for i in range(max(bpe.table) + 1)]
        for batch in texts:
            rows = []
            for text in batch:
                ids = bpe.encode(text or "")
                joined = ",".join([shown[i] for i in ids])
                decoded = bpe.decode(ids)
                rows.append((len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (joined, decoded))))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return documents.select("doc_id", run("text").alias("coded")).select("doc_id", "coded.*")
