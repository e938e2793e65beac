"""Language-model scoring by cross-entropy difference.

Two word-bigram models share one vocabulary, all words of the corpus and one
unknown word: the target model counts the target documents, the background model
all documents. They are matched: background counts are scaled to the target's
number of tokens before both are smoothed alike. A text's beginning counts as a
word before its first:

    p(w | v) = mix * c(v, w) / c(v) + (1 - mix) * p(w)

A document's score is the mean over its tokens of the target model's loss less
the background model's, in nats: below zero it is more like the target.

All words and bigrams of all documents are counted; nothing is pruned. They are
told apart by 64-bit hashes. The documents are dealt, by a hash of id and text, to
chunks of about ``CHUNK_CHARS`` characters; their texts are shuffled this once, and
else a chunk's *distinct* keys:

1. every chunk gets the target ids among its own, counts its words, contexts and
   bigrams and sends each range of keys (sorted, as differences) to the task that
   adds up that range;
2. that task returns, to every chunk and in the chunk's own order, the totals, and
   the range's numbers of tokens and of distinct words;
3. the chunk, with its texts and the totals of all its keys, scores its documents.

So a bigram costs some bytes per chunk it occurs in, not per document, and no
task sees more than a chunk or a range. Equal rows are one, with their number, in
every batch that is read, so that many of them do not fill their chunk. Only the
number of characters reaches the driver.

A document without words has losses and score 0; if no target document has a
word, both models are uniform and every score is 0. Null texts count as empty;
repeated rows are scored, and counted, each; a null doc_id is never a target;
extra columns are dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import ship
from sensorflow.llm.near_dedup import word_hashes

MIX = 0.7
#: Characters of a chunk of documents, and of documents per range of keys.
CHUNK_CHARS = 4_000_000
RANGE_CHARS = 12_000_000
#: Kinds of keys, in their two lowest bits.
WORD, BEFORE, GRAM = 0, 1, 2

_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _keys(x: np.ndarray, kind: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return ((x ^ (x >> np.uint64(32))) & ~np.uint64(3)) | np.uint64(kind)


class Chunk:
    """The tokens of some texts: the owner of each, its word's, context's and
    bigram's key, and the distinct keys in order."""

    def __init__(self, texts: list[str]) -> None:
        seen: dict[str, int] = {}
        found = [word_hashes(t or "", seen) for t in texts]
        n = np.array([len(w) for w in found], dtype=np.int64)
        word = np.concatenate([np.zeros(0, np.uint64), *found])
        before = np.zeros_like(word)  # 0 at a beginning
        before[1:] = word[:-1]
        before[(np.cumsum(n) - n)[n > 0]] = 0
        gram = before * np.uint64(0x9E3779B97F4A7C15) + word
        self.n, self.owner = n, np.repeat(np.arange(len(texts)), n)
        parts = [_keys(word, WORD), _keys(before, BEFORE), _keys(gram, GRAM)]
        self.keys, places = np.unique(np.concatenate(parts), return_inverse=True)
        self.word, self.before, self.gram = np.split(places, 3)

    def counts(self, marked: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each key occurs in all and in the marked texts, each as often as
        ``times`` says."""
        hit, each = marked[self.owner], times[self.owner] if (times != 1).any() else None
        of = lambda keep: sum(
            np.bincount(x[keep], None if each is None else each[keep], minlength=len(self.keys)).astype(np.int64)
            for x in (self.word, self.before, self.gram)
        )
        return of(slice(None)), of(hit)

    def losses(self, n: np.ndarray, t: np.ndarray, size: int, n_all: int, n_target: int) -> tuple[np.ndarray, np.ndarray]:
        """Each text's summed loss under the target and the background model, from
        the totals ``n`` and ``t`` of its keys."""
        out = []
        for c, scale in ((t, 1.0), (n, n_target / n_all if n_all else 0.0)):
            one = (c[self.word] * scale + 1) / (n_target + size + 1)
            held = c[self.before]
            two = np.where(held > 0, c[self.gram] / np.maximum(held, 1), one) if n_target else one
            out.append(np.bincount(self.owner, -np.log(MIX * two + (1 - MIX) * one), minlength=len(self.n)))
        return out[0], out[1]


def _packed(values: np.ndarray) -> bytes:
    """64-bit numbers by byte planes, as many (the first byte) as the largest needs."""
    planes = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([planes]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1) if len(data) > 1 else np.zeros((1, 0), np.uint8)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, : len(planes)] = planes.T
    return out.view("<u8").ravel()


def _edge(i: int, ranges: int) -> np.uint64:
    """The least key of a range."""
    return np.uint64(min(i * ((1 << 64) // ranges + 1), (1 << 64) - 1))


def _slices(keys: np.ndarray, ranges: int) -> Iterator[tuple[int, int, int]]:
    """(range, start, end) of the sorted ``keys`` that lie in each range, if any do."""
    edges = np.array([_edge(i, ranges) for i in range(ranges)], dtype=np.uint64)
    at = np.searchsorted(keys, edges)
    for i, (a, b) in enumerate(zip(at, [*at[1:], len(keys)])):
        if b > a:
            yield i, int(a), int(b)


def count_chunk(part: pd.DataFrame, targets: pd.DataFrame, ranges: int) -> pd.DataFrame:
    """A chunk's distinct keys and counts, a row for each range of keys, also if the
    chunk has none of it; ``targets`` are the target ids in the chunk."""
    chunk = Chunk(list(part["text"]))
    n, t = chunk.counts(part["doc_id"].isin(targets["doc_id"]).to_numpy(), part["times"].to_numpy())
    at = {i: (a, b) for i, a, b in _slices(chunk.keys, ranges)}
    rows = []
    for i in range(ranges):
        a, b = at.get(i, (0, 0))
        steps = np.diff(chunk.keys[a:b], prepend=_edge(i, ranges))
        rows.append((i, int(part["chunk"].iloc[0]), _packed(steps), _packed(n[a:b]), _packed(t[a:b])))
    return pd.DataFrame(rows, columns=["range", "chunk", "keys", "n", "t"])


def total_range(part: pd.DataFrame, ranges: int) -> pd.DataFrame:
    """The totals of a range's keys, for each chunk in the chunk's order; and the
    range's distinct words, tokens and target tokens."""
    low = _edge(int(part["range"].iloc[0]), ranges)
    keys = [np.cumsum(_unpacked(k), dtype=np.uint64) for k in part["keys"]]
    ends = np.cumsum([len(k) for k in keys])
    keys = np.concatenate(keys)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)]
    starts, which = np.flatnonzero(new), np.cumsum(new, dtype=np.int32) - 1
    is_word = (keys[starts] + low) & np.uint64(3) == WORD
    del keys, new
    out = part[["range", "chunk"]].copy()
    found = {"words": int(is_word.sum())}
    for c, name in (("n", "all"), ("t", "target")):
        each = np.concatenate([_unpacked(x) for x in part[c]])
        sums = np.add.reduceat(each[order], starts) if len(starts) else each
        each[order] = sums[which]
        found[name] = int(sums[is_word].sum())
        out[c] = [_packed(x) for x in np.split(each, ends[:-1])]
    return out.assign(**found)


def score_chunk(part: pd.DataFrame, totals: pd.DataFrame) -> pd.DataFrame:
    """The losses of a chunk's documents, from the totals of every range."""
    chunk = Chunk(list(part["text"]))
    totals = totals.sort_values("range")
    n, t = (np.concatenate([np.zeros(0, "<u8"), *map(_unpacked, totals[c])]).astype(np.float64) for c in "nt")
    size, n_all, n_target = (int(totals[c].sum()) for c in ("words", "all", "target"))
    target, background = chunk.losses(n, t, size, n_all, n_target)
    each = np.maximum(chunk.n, 1)
    scored = pd.DataFrame(
        {
            "doc_id": part["doc_id"].array,
            "n_tokens": chunk.n,
            "loss_target": target / each,
            "loss_background": background / each,
        }
    )
    return scored.iloc[np.repeat(np.arange(len(scored)), part["times"])]


def merged_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch's equal rows (of one hash ``row``) as one row, with their number."""
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if len(rows["row"].unique()) < len(rows):
            rows = rows.group_by(rows.column_names).aggregate([([], "count_all")])
            rows = rows.rename_columns([*batch.schema.names, "times"])
        else:
            rows = rows.append_column("times", pa.array(np.ones(len(rows), dtype=np.int64)))
        yield from rows.to_batches()


def score_documents(documents: DataFrame, target_ids: DataFrame) -> DataFrame:
    """doc_id, n_tokens, loss_target, loss_background, score of every document;
    the target are the documents whose doc_id stands in ``target_ids``."""
    ship(documents.sparkSession)
    chars = documents.agg(F.sum(F.length("text"))).first()[0] or 0
    chunks, ranges = 1 + chars // CHUNK_CHARS, 1 + chars // RANGE_CHARS
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("row", F.xxhash64("doc_id", "text"))
    chunk = F.pmod("row", F.lit(chunks)).alias("chunk")
    # target ids grow with the corpus: merged at every size, never broadcast; they are
    # sent to the chunks where their rows lie, so that no text is moved for them
    marks = target_ids.where(F.col("doc_id").isNotNull()).select("doc_id").distinct().hint("merge")
    targets = docs.where(F.col("doc_id").isNotNull()).select("doc_id", chunk).distinct()
    targets = targets.join(marks, "doc_id", "left_semi").select("chunk", F.col("doc_id").cast("string").alias("doc_id"))
    # ids pass through Python as text, as nulls would turn numbers to doubles
    dealt = (
        docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "row")
        .mapInArrow(merged_rows, "doc_id string, text string, row bigint, times bigint")
        .select("doc_id", "text", "times", chunk)
        .groupBy("chunk")
    )
    counted = dealt.cogroup(targets.groupBy("chunk")).applyInPandas(
        lambda part, own: count_chunk(part, own, ranges),
        "range bigint, chunk bigint, keys binary, n binary, t binary",
    )
    totals = counted.groupBy("range").applyInPandas(
        lambda part: total_range(part, ranges),
        "range bigint, chunk bigint, n binary, t binary, words bigint, all bigint, target bigint",
    )
    scored = dealt.cogroup(totals.groupBy("chunk")).applyInPandas(
        score_chunk, "doc_id string, n_tokens bigint, loss_target double, loss_background double"
    )
    return scored.withColumn("doc_id", F.col("doc_id").cast(documents.schema["doc_id"].dataType)).withColumn(
        "score", F.col("loss_target") - F.col("loss_background")
    )
