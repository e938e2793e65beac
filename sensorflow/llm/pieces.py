"""SentencePiece (BPE) encoding and decoding by vectorised merge rounds.

``Codec`` reads a SentencePiece BPE model file (a parameter) and gives the ids
that library gives. A text is cut into words at its spaces, as no piece holds a
space behind another character. The words not seen before are laid out as one
flat array of symbols; a round takes every word's least pair rank (a segmented
minimum), merges all its leftmost non-overlapping pairs of that rank at once,
closes the gaps, and looks up the pairs beside the merges; words without a pair
leave. So a batch takes as many rounds as its worst word, not as many as it has
merges.

The library merges one pair at a time, by score and then from the left. Merging
a rank's pairs at once gives the same unless a merge makes a pair of a better or
equal rank; the pieces for which the vocabulary allows that are known beforehand
and merged one by one. A long word is first cut between characters that no piece
holds side by side. Runs of spaces, if the model has pieces for them, are counted
out: their pieces have one score, below all others, so they are joined from the left
once the last space has found no place in its word.

``encode_documents`` is the Spark operator: one scan, no shuffle. Null texts
count as empty; an empty text has the end id only and decodes to an empty text;
ties and repeated rows are rows like any others; extra columns are dropped.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from sensorflow.llm.common import ship

SPACE = "▁"
#: Words kept in a worker's memory, symbols merged side by side, and the length
#: from which a word is cut between characters that never meet in a piece.
CACHED_WORDS = 400_000
SYMBOLS = 1 << 19
LONG = 64

_NONE = np.iinfo(np.int32).max
_WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_WORDS_AND_RUNS = re.compile(f"{SPACE}+(?={SPACE}[^{SPACE}])|{SPACE}?[^{SPACE}]+|{SPACE}+")
_TYPES = proto.ModelProto.SentencePiece


def _one_mark_each(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("sensorflow_one_mark_each", _one_mark_each)


class Codec:
    """Encoder and decoder for one SentencePiece BPE model."""

    def __init__(self, path: str) -> None:
        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        trainer, rules = model.trainer_spec, model.normalizer_spec
        kinds = {p.type for p in model.pieces}
        if (
            trainer.model_type != proto.TrainerSpec.BPE
            or not trainer.byte_fallback
            or trainer.treat_whitespace_as_suffix
            or rules.precompiled_charsmap
            or rules.remove_extra_whitespaces
            or not rules.add_dummy_prefix
            or not kinds <= {_TYPES.NORMAL, _TYPES.BYTE, _TYPES.CONTROL, _TYPES.UNKNOWN}
        ):
            raise ValueError(f"{path}: not a plain BPE model with byte fallback")
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _TYPES.NORMAL}
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in normal):
            raise ValueError(f"{path}: a piece holds a space behind another character")
        self.end = trainer.eos_id
        self.first_byte = next(i for i, p in enumerate(model.pieces) if p.type == _TYPES.BYTE)
        self.surface: list[bytes | None] = []
        for p in model.pieces:
            self.surface.append(
                p.piece.replace(SPACE, " ").encode() if p.type == _TYPES.NORMAL
                else bytes([int(p.piece[3:5], 16)]) if p.type == _TYPES.BYTE
                else trainer.unk_surface.encode() if p.type == _TYPES.UNKNOWN
                else b""
            )
        self.spaced = {i for p, i in normal.items() if p[0] == SPACE}
        self._lay_out(normal, [p.score for p in model.pieces])
        self.runs = self._space_runs(normal, [p.score for p in model.pieces])
        self.cache: dict[str, list[int]] = {}

    def _lay_out(self, normal: dict[str, int], scores: list[float]) -> None:
        """The pair table (sorted keys, ranks, merged symbols), the symbol of
        each character, and the merges that must go one by one. A symbol is a
        piece's id; a character without a piece is ``base`` plus its code point."""
        self.base = len(self.surface)
        self.wide = self.base + 0x110000
        ids = dict(normal)
        for c in {c for p in normal for c in p}:
            ids.setdefault(c, self.base + ord(c))
        ranks = {s: r for r, s in enumerate(sorted({scores[i] for i in normal.values()}, reverse=True))}
        found = []
        for piece, i in normal.items():
            for k in range(1, len(piece)):
                if (a := ids.get(piece[:k])) is not None and (b := ids.get(piece[k:])) is not None:
                    found.append((a * self.wide + b, ranks[scores[i]], i))
        found.sort()
        self.keys = np.array([f[0] for f in found] + [np.iinfo(np.int64).max], dtype=np.int64)
        self.ranks = np.array([f[1] for f in found] + [_NONE], dtype=np.int32)
        self.made = np.array([f[2] for f in found] + [0], dtype=np.int32)
        self.alone = np.zeros(self.base, dtype=bool)
        for key, rank, _ in found:
            for side in divmod(key, self.wide):
                if side < self.base and rank <= ranks[scores[side]]:
                    self.alone[side] = True
        self.meet = {p[k : k + 2] for p in normal for k in range(len(p) - 1)}
        self.symbol = {c: i for c, i in ids.items() if len(c) == 1}

    def _space_runs(self, normal: dict[str, int], scores: list[float]) -> dict[int, int] | None:
        """The piece of each number of spaces, if runs can be counted out."""
        runs = {p: i for p, i in normal.items() if SPACE * 2 in p}
        others = min(scores[i] for p, i in normal.items() if len(p) > 1 and p not in runs)
        if (
            SPACE not in normal
            or any(p.strip(SPACE) for p in runs)
            or len({scores[i] for i in runs.values()}) > 1
            or any(scores[i] >= others for i in runs.values())
        ):
            return None
        return {len(p): i for p, i in runs.items()} | {1: normal[SPACE]}

    # -- encoding ---------------------------------------------------------

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text]))

    def encode_all(self, texts: Iterable[str]) -> Iterator[list[int]]:
        """The ids of each text, the end id last; new words are merged together
        for all texts of about ``SYMBOLS`` characters."""
        held: list[list[str]] = []
        size = 0
        for text in texts:
            held.append(self._words(text))
            size += len(text)
            if size >= SYMBOLS:
                yield from self._joined(held)
                held, size = [], 0
        yield from self._joined(held)

    def _words(self, text: str) -> list[str]:
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        if SPACE * 2 not in marked and marked[-1] != SPACE:
            return [SPACE + w for w in marked[1:].split(SPACE)]
        return (_WORDS if self.runs is None else _WORDS_AND_RUNS).findall(marked)

    def _joined(self, texts: list[list[str]]) -> Iterator[list[int]]:
        cache = self.cache
        if len(cache) > CACHED_WORDS:
            cache.clear()
        self._learn({w for words in texts for w in words if w not in cache})
        for words in texts:
            ids: list[int] = []
            if self.runs is None or not any(w[-1] == SPACE for w in words):
                for w in words:
                    ids += cache[w]
            else:
                self._with_runs(words, ids)
            ids.append(self.end)
            yield ids

    def _with_runs(self, words: list[str], ids: list[int]) -> None:
        """Words and runs of spaces; the space before a word belongs to the run
        if it found no place in the word."""
        alone, spaces = self.symbol[SPACE], 0
        for w in words:
            if w[-1] == SPACE:
                spaces += len(w)
                continue
            found = self.cache[w]
            if spaces and found[0] == alone:
                spaces, found = spaces + 1, found[1:]
            ids += self._spaces(spaces)
            ids += found
            spaces = 0
        ids += self._spaces(spaces)

    def _spaces(self, n: int) -> list[int]:
        """A run of spaces: of equal scores the leftmost pair goes first, so each
        space is joined to what stands before it as long as that makes a piece."""
        stack: list[int] = []
        for _ in range(n):
            stack.append(1)
            while len(stack) > 1 and stack[-2] + stack[-1] in self.runs:
                stack[-2:] = [stack[-2] + stack[-1]]
        return [self.runs[k] for k in stack]

    def _learn(self, words: Iterable[str]) -> None:
        """Encode ``words`` into the cache, about ``SYMBOLS`` symbols at a time."""
        parts: list[str] = []
        owners: list[str] = []
        size = 0
        for w in words:
            if self.runs is not None and w[-1] == SPACE:
                self.cache[w] = []  # a run of spaces, counted out where it stands
                continue
            pieces = [w] if len(w) <= LONG else self._cut(w)
            self.cache[w] = []
            parts += pieces
            owners += [w] * len(pieces)
            size += len(w)
            if size >= SYMBOLS:
                self._store(parts, owners)
                parts, owners, size = [], [], 0
        if parts:
            self._store(parts, owners)

    def _cut(self, word: str) -> list[str]:
        """``word`` cut between characters that no piece holds side by side."""
        out, start = [], 0
        for k in range(1, len(word)):
            if word[k - 1 : k + 1] not in self.meet:
                out.append(word[start:k])
                start = k
        return [*out, word[start:]]

    def _store(self, parts: list[str], owners: list[str]) -> None:
        for owner, found in zip(owners, self.merged(parts)):
            self.cache[owner] += found

    def _rank(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; ``_NONE`` where there is none."""
        key = a * np.int64(self.wide) + b
        at = np.searchsorted(self.keys, key)
        known = self.keys[at] == key
        return np.where(known, self.ranks[at], _NONE), self.made[at]

    def merged(self, words: list[str]) -> list[list[int]]:
        """The ids of each (non-empty) word, by merge rounds over all of them."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        seen, code = np.unique(points, return_inverse=True)
        symbols = [self.symbol.get(chr(c), self.base + int(c)) for c in seen]
        sym = np.array(symbols, dtype=np.int64)[code]
        word = np.repeat(np.arange(len(words)), lengths)
        done_sym, done_word = [], []
        rank = np.full(len(sym), _NONE, dtype=np.int32)
        made = np.zeros(len(sym), dtype=np.int32)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner], made[inner] = self._rank(sym[inner], sym[inner + 1])
        while len(sym):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            least = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(sym)]))
            open_ = least != _NONE
            if not open_.all():  # words without a pair are finished
                done_sym.append(sym[~open_])
                done_word.append(word[~open_])
                sym, word, rank, made, least = (x[open_] for x in (sym, word, rank, made, least))
                if not len(sym):
                    break
            at = np.flatnonzero(rank == least)
            # pairs of one word that overlap stand side by side: every second of them
            run = np.r_[True, np.diff(at) != 1]
            place = np.arange(len(at))
            at = at[(place - np.maximum.accumulate(np.where(run, place, 0))) % 2 == 0]
            # merges that may make a better pair: the leftmost of the word only
            lone = self.alone[made[at]]
            if lone.any():
                first = np.r_[True, word[at[1:]] != word[at[:-1]]]
                mixed = np.zeros(len(first), dtype=bool)
                group = np.cumsum(first) - 1
                mixed = np.bincount(group, lone)[group] > 0
                at = at[first | ~mixed]
            sym[at] = made[at]
            keep = np.ones(len(sym), dtype=bool)
            keep[at + 1] = False
            fresh = np.zeros(len(sym), dtype=bool)
            fresh[at] = True
            sym, word, rank, made, fresh = (x[keep] for x in (sym, word, rank, made, fresh))
            fresh[:-1] |= fresh[1:]  # the pairs on both sides of a merge
            look = np.flatnonzero(fresh)
            rank[look] = _NONE
            look = look[look < len(sym) - 1]
            look = look[word[look] == word[look + 1]]
            rank[look], made[look] = self._rank(sym[look], sym[look + 1])
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        sym, counts = sym[order], np.bincount(word, minlength=len(words))
        if (sym >= self.base).any():
            sym, counts = self._as_bytes(sym, word[order], counts)
        flat = sym.tolist()
        ends = np.cumsum(counts).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def _as_bytes(self, sym: np.ndarray, word: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece as the pieces of their bytes."""
        out, sizes = [], []
        for s in sym.tolist():
            new = [s] if s < self.base else [self.first_byte + b for b in chr(s - self.base).encode()]
            out += new
            sizes.append(len(new))
        return np.array(out), np.bincount(word, sizes, minlength=len(counts)).astype(np.int64)

    # -- decoding ---------------------------------------------------------

    def decode(self, ids: list[int]) -> str:
        """Bytes that are no character give one mark each; control ids give
        nothing, but part the bytes on their sides."""
        parts: list[list[bytes]] = [[]]
        for i in ids:
            if self.surface[i]:
                parts[-1].append(self.surface[i])
            elif parts[-1]:
                parts.append([])
        text = "".join(b"".join(p).decode("utf-8", errors="sensorflow_one_mark_each") for p in parts)
        first = next((i for i in ids if self.surface[i]), None)
        # the space set before the text goes again
        if first is not None and first in self.spaced:
            return text[1:]
        return text


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """One codec per worker process."""
    return Codec(path)


def encode_documents(documents: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text."""
    ship(documents.sparkSession)

    @F.pandas_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        pieces = codec(model_path)
        shown = [str(i) for i in range(pieces.base)]
        for batch in texts:
            rows = []
            for ids in pieces.encode_all(t or "" for t in batch):
                joined = " ".join([shown[i] for i in ids])
                decoded = pieces.decode(ids)
                rows.append((len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (joined, decoded))))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return documents.select("doc_id", run("text").alias("coded")).select("doc_id", "coded.*")
