"""Cost-balanced packing of token sequences.

Every document's ids (and an end id) are cut into full pieces of ``capacity``
tokens and one rest. Pieces are dealt by hash to groups of about
``docs_per_group`` documents. A group opens just enough sequences for its
tokens and takes its pieces in descending order: each goes to the sequence with
the lowest cost so far among those with room for it, where a piece of n tokens
costs ``linear * n + quadratic * n * n`` (feed-forward and attention). Pieces
that fit nowhere whole are cut over the room that is left, lowest cost first,
so a group pads less than one sequence.

Null texts count as empty (the end id alone); extra columns are dropped;
repeated rows are packed once each. Null or missing doc_ids stay null.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.bpe import codec
from sensorflow.llm.common import ship

CAPACITY = 2048
END_ID = 1
DOCS_PER_GROUP = 4096
LINEAR, QUADRATIC = 1.0, 1.0 / 1024


def assign(
    lengths: np.ndarray,
    capacity: int = CAPACITY,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
) -> list[tuple[int, int, int, int, int]]:
    """(piece, start in the piece, length, sequence, offset) for every part.

    ``lengths`` must be descending and at most ``capacity``.
    """
    n_seq = -(-int(lengths.sum()) // capacity)
    room = np.full(n_seq, capacity, dtype=np.int64)
    cost = np.zeros(n_seq)
    parts: list[tuple[int, int, int, int, int]] = []

    def put(piece: int, start: int, n: int, seq: int) -> None:
        parts.append((piece, start, n, seq, capacity - int(room[seq])))
        room[seq] -= n
        cost[seq] += linear * n + quadratic * n * n

    full = int(np.searchsorted(-lengths, -capacity, side="right"))
    for i in range(full):
        put(i, 0, capacity, i)
    left = []
    for i in range(full, len(lengths)):
        n = int(lengths[i])
        seq = int(np.argmin(np.where(room >= n, cost, np.inf)))
        if room[seq] >= n:
            put(i, 0, n, seq)
        else:
            left.append(i)
    for i in left:
        start, n = 0, int(lengths[i])
        while n:
            seq = int(np.argmin(np.where(room > 0, cost, np.inf)))
            take = min(n, int(room[seq]))
            put(i, start, take, seq)
            start, n = start + take, n - take
    return parts


def pack_documents(
    documents: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    docs_per_group: int = DOCS_PER_GROUP,
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset per piece.

    One shuffle, of the rests' ids (two bytes each for vocabularies below
    65,536) by group; full pieces carry no ids. Groups grow in number with the
    documents, not in size. ``salt`` (the row's place in its input partition)
    spreads repeated and null ids over the groups.
    """
    ship(documents.sparkSession)
    groups = max(1, -(-documents.count() // docs_per_group))
    # ids pass through Python as text: nulls would turn numbers to doubles there
    docs = documents.select(
        F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")).alias("text")
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = codec(tokenizer_path)
        narrow = "<u2" if max(max(bpe.table), end_id) < 1 << 16 else "<u4"
        salt = 0
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.array(bpe.encode(text) + [end_id], dtype="<u4")
                whole = len(ids) // capacity * capacity
                for start in range(0, whole, capacity):
                    crc = zlib.crc32(ids[start : start + capacity].tobytes())
                    rows.append((doc_id, salt, start, capacity, len(ids), crc, None))
                if whole < len(ids):
                    rest = ids[whole:]
                    rows.append(
                        (doc_id, salt, whole, len(rest), len(ids), 0, rest.astype(narrow).tobytes())
                    )
                salt += 1
            yield pd.DataFrame(
                rows, columns=["doc_id", "salt", "start", "length", "doc_tokens", "crc", "ids"]
            )

    pieces = docs.mapInPandas(
        cut,
        "doc_id string, salt bigint, start bigint, length bigint, doc_tokens bigint,"
        " crc bigint, ids binary",
    ).withColumn("group", F.pmod(F.xxhash64("doc_id", "salt"), F.lit(groups)))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(
            ["length", "doc_id", "start", "crc", "salt"], ascending=[False, True, True, True, True]
        )
        doc_id, start = pdf["doc_id"].array, pdf["start"].to_numpy()
        tokens, crc, raw = pdf["doc_tokens"].to_numpy(), pdf["crc"].to_numpy(), pdf["ids"].array
        lengths = pdf["length"].to_numpy()
        base = int(pdf["group"].iloc[0]) << 32
        out = []
        for i, at, n, seq, offset in assign(lengths, capacity):
            if raw[i] is not None:
                ids = np.frombuffer(raw[i], dtype=f"<u{len(raw[i]) // int(lengths[i])}")
                value = zlib.crc32(ids[at : at + n].astype("<u4").tobytes())
            else:
                value = int(crc[i])
            out.append((doc_id[i], int(start[i]) + at, n, value, int(tokens[i]), base + seq, offset))
        return pd.DataFrame(
            out,
            columns=[
                "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
            ],
        )

    packed = pieces.groupBy("group").applyInPandas(
        pack,
        "doc_id string, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,"
        " sequence_id bigint, offset bigint",
    )
    return packed.withColumn("doc_id", F.col("doc_id").cast(documents.schema["doc_id"].dataType))
