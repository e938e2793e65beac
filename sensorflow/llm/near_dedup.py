"""Near-duplicate classes by Order MinHash and banded alignment.

Equal texts (by md5) are one node. A node's words are cut into k-mers of
``WORDS`` words, each labelled with its occurrence number. For each of
``SKETCHES`` hash functions the ``TAKEN`` labelled k-mers with the least hashes,
in the order of the text, are an ordered sketch: two texts agree in a sketch
when they share these k-mers *and* their order, which follows edit rather than
set similarity. Texts that agree in a sketch are candidates, and every two
candidates are connected, ruled out by a bound that holds, or aligned (edit
distance over words in a band that doubles up to the allowed number of edits),
and linked at an edit similarity of ``SIMILARITY`` or more:

1. The texts of a sketch are aligned with the least of them: linear work, which
   connects most near copies.
2. Where the texts of a sketch are not all connected by now, they meet, with
   their words, in blocks of about ``BLOCK_WORDS`` words (every two blocks of a
   sketch in one task's unit). There, two texts are compared only if they agree in
   no sketch before this one, where they have met or been connected already, so
   every two are compared once at most; and only if enough of
   their rarest words agree: by any one order of words, here that of frequency in
   the unit, similar texts share at least k of their first ``d + k`` words, where
   d is the number of words that they may lack (k is ``1 / RARE`` of a text). An
   inverted index over these words counts the shared ones. If then the exact word
   bags, and those of runs of two and three words, allow the similarity, they are
   aligned, and links are joined in a local union-find, so a unit
   returns fewer links than it has texts; no pair is ever a row.

Classes are the connected components of the links.

Null texts count as empty, and all empty texts are one class. Texts of fewer
than ``WORDS`` words are one k-mer; texts without words have only equal texts as
partners. Repeated rows share a class; the smallest doc_id names it (null only
if there is no other). Extra columns are dropped by ``near_duplicates`` and kept
by ``deduplicate``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import ship
from sensorflow.session import scratch_path

WORDS = 3
SKETCHES = 48
TAKEN = 2
SIMILARITY = 0.8
CACHED_WORDS = 500_000
#: Similar texts are looked for by this share (one in so many) of their rarest words,
#: beyond those that they may lack.
RARE = 5
#: Words of a block, and of the units that are dealt to one group.
BLOCK_WORDS = 1 << 19
GROUP_WORDS = 1 << 21
#: Narrowest band, and the words from which runs of words are counted beforehand.
BAND = 256
LONG = 512

_WORD = re.compile(r"[^\W_]+")


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_SEEDS = _mix(np.arange(1, 1025, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def word_hashes(text: str, seen: dict[str, int]) -> np.ndarray:
    found = _WORD.findall(text.lower())
    if len(seen) > CACHED_WORDS:
        seen.clear()
    for w in set(found).difference(seen):
        seen[w] = xxhash.xxh64_intdigest(w)
    return np.fromiter(map(seen.__getitem__, found), np.uint64, len(found))


def sketches(words: np.ndarray, count: int | None = None) -> np.ndarray:
    """``count`` order-sensitive sketches of a sequence of word hashes."""
    count = SKETCHES if count is None else count
    if not len(words):
        return np.zeros(0, dtype=np.int64)
    n = max(1, len(words) - WORDS + 1)
    kmers = np.zeros(n, dtype=np.uint64)
    for k in range(min(WORDS, len(words))):
        kmers = _mix(kmers + words[k : k + n])
    labelled = _mix(kmers + _occurrence(kmers).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = np.empty(count, dtype=np.uint64)
    rows = max(1, min(count, 500_000 // n))  # bounds the hashes laid out at once
    for i in range(0, count, rows):
        seeds = _SEEDS[i : min(i + rows, count), None]
        values = (labelled ^ seeds) * seeds
        values ^= values >> np.uint64(31)
        values *= np.uint64(0xD6E8FEB86659FD93)
        places = np.empty((len(seeds), min(TAKEN, n)), dtype=np.int64)
        at = np.arange(len(seeds))
        for t in range(places.shape[1]):
            places[:, t] = values.argmin(axis=1)
            values[at, places[:, t]] = np.iinfo(np.uint64).max
        places.sort(axis=1)  # the order of the text
        mixed = np.zeros(len(seeds), dtype=np.uint64)
        for t in range(places.shape[1]):
            mixed = _mix(mixed + kmers[places[:, t]])
        out[i : i + rows] = mixed
    return out.view(np.int64)


def _occurrence(values: np.ndarray) -> np.ndarray:
    """How many equal values stand before each."""
    n = len(values)
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    nth = np.empty(n, dtype=np.int64)
    nth[order] = np.arange(n) - first
    return nth


def allowed_edits(n, at_least: float | None = None):
    """Edits (words) that texts of at most ``n`` words may have."""
    at_least = SIMILARITY if at_least is None else at_least
    return np.floor((1 - at_least) * n + 1e-9).astype(np.int64)


def unit_links(
    roots: np.ndarray,
    words: list[np.ndarray],
    first: np.ndarray | None = None,
    earlier: np.ndarray | None = None,
) -> list[tuple[int, int]]:
    """Links (of places) that connect the texts of a unit: for every two of different
    roots that are similar, a path of links. With ``first`` (the texts of the unit's
    first block) only pairs of a text of each block are compared; with ``earlier`` (a
    row of other sketches for each text) only pairs that agree in none of them.

    A link is returned only when it joins two sets, so there are fewer than texts.
    """
    _, label = np.unique(roots, return_inverse=True)
    n = np.array([len(w) for w in words], dtype=np.int64)
    if label.max(initial=0) == 0:
        return []
    flat = np.concatenate(words).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), n)
    # a bag as a set: each word with the number of equal ones before it in its text
    nth = _occurrence((flat << np.uint64(31)) ^ owner.astype(np.uint64))
    _, code, frequency = np.unique(
        (flat << np.uint64(32)) | nth.astype(np.uint64), return_inverse=True, return_counts=True
    )
    starts = np.r_[0, np.cumsum(n)]
    bags = [code[a:b] for a, b in zip(starts, starts[1:])]
    # rarest first; of its first words a text shares ``need`` with any it is like
    need = np.maximum(1, n // RARE)
    order = np.lexsort((code, frequency[code], owner))
    place = np.arange(len(code)) - starts[owner]
    taken = order[(place < (allowed_edits(n) + need)[owner]) & (frequency[code[order]] > 1)]
    by_word = taken[np.argsort(code[taken], kind="stable")]
    holders, held = owner[by_word], code[by_word]
    low = np.searchsorted(held, np.arange(len(frequency)))
    high = np.searchsorted(held, np.arange(len(frequency)), side="right")
    rare = [code[t] for t in np.split(taken, np.searchsorted(owner[taken], np.arange(1, len(words))))]
    mark = np.zeros(len(frequency), dtype=bool)
    found = []
    # a pair of two sets has a text outside the largest: these are compared with all
    largest = label == np.bincount(label).argmax()
    for i in np.flatnonzero(~largest):
        lists = [holders[low[c] : high[c]] for c in rare[i] if high[c] - low[c] > 1]
        if not lists:
            continue
        agree = np.bincount(np.concatenate(lists), minlength=len(words))
        near = np.flatnonzero((agree > 0) & (agree >= np.minimum(need, need[i])) & (label != label[i]))
        near = near[(near < i) | largest[near]]
        if first is not None:
            near = near[first[near] != first[i]]
        longer = np.maximum(n[near], n[i])
        near = near[longer - np.minimum(n[near], n[i]) <= allowed_edits(longer)]
        if earlier is not None:
            near = near[~(earlier[near] == earlier[i]).any(axis=1)]
        if not len(near):
            continue
        mark[bags[i]] = True
        shared = np.zeros(len(near), dtype=np.int64)
        for x in range(0, len(near), 256):
            some = near[x : x + 256]
            hits = mark[np.concatenate([bags[j] for j in some])]
            shared[x : x + 256] = np.add.reduceat(hits.astype(np.int64), np.cumsum(n[some]) - n[some])
        mark[bags[i]] = False
        longer = np.maximum(n[near], n[i])
        possible = longer - shared <= allowed_edits(longer)
        # the likest first: once they link, the rest of their sets need no alignment
        near = near[possible][np.argsort(-(shared / longer)[possible], kind="stable")]
        step = 4
        while len(near := near[label[near] != label[i]]):
            head, near = near[:step], near[step:]
            for j, ok in zip(head, similar([(words[i], words[j]) for j in head])):
                if ok and label[j] != label[i]:
                    found.append((int(i), int(j)))
                    label[label == label[j]] = label[i]
            step = min(4 * step, 256)
    return found


def _trimmed(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the common beginning and end."""
    n = min(len(a), len(b))
    differs = np.flatnonzero(a[:n] != b[:n])
    head = int(differs[0]) if len(differs) else n
    a, b, n = a[head:], b[head:], n - head
    differs = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    tail = int(differs[0]) if len(differs) else n
    return a[: len(a) - tail], b[: len(b) - tail]


def _not_shared(a: np.ndarray, b: np.ndarray) -> int:
    """Words of the longer bag that the other lacks: at most the edit distance."""
    _, code = np.unique(np.concatenate([a, b]), return_inverse=True)
    size = int(code.max()) + 1 if len(code) else 0
    in_a, in_b = np.bincount(code[: len(a)], minlength=size), np.bincount(code[len(a) :], minlength=size)
    return max(len(a), len(b)) - int(np.minimum(in_a, in_b).sum())


def _grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words."""
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out = _mix(out + words[k : k + n])
    return out


def _may_align(x: np.ndarray, y: np.ndarray, allowed: int) -> bool:
    """Whether bags allow ``allowed`` edits: an edit changes at most one word and
    q runs of q words. Runs tell long unlike texts of the same words apart; shorter
    ones are aligned as fast."""
    return _not_shared(x, y) <= allowed and (
        min(len(x), len(y)) < LONG
        or all(_not_shared(_grams(x, q), _grams(y, q)) <= q * allowed for q in (2, 3))
    )


def banded(a: list[int], b: list[int], band: int) -> int:
    """Edit distance within ``band`` of the diagonal; a value of at most ``band`` is
    the distance, a larger one says that it is larger.

    A column of the band is two integers, whose bits say where the distance rises
    or falls by one from a row to the next; so a column costs a few operations on
    ``2 * band`` bits (Hyyrö's bit-parallel form of the banded alignment).
    """
    if len(a) < len(b):
        a, b = b, a
    n, m = len(a), len(b)
    far, band = band + 1, min(band, n)
    if n - m > band:
        return far
    places: dict[int, int] = {}
    bit = 1
    for x in a:
        places[x] = places.get(x, 0) | bit
        bit <<= 1
    width = 2 * band + 2
    full = (1 << width) - 1
    rises, falls = full ^ ((1 << (band + 1)) - 1), 0
    lowest, end = 1 << (width - 1), 1 << (width - 2)
    # the distance at the band's lower edge, later in the last row; from either it
    # can fall by one a column only, in the columns that are left at the edge's end
    now, limit = band, 2 * band + m - n
    for i, x in enumerate(b):
        shift = i + band + 1 - width
        same = places.get(x, 0)
        same = (same >> shift if shift >= 0 else same << -shift) & full
        level = ((((same & rises) + rises) ^ rises) | same | falls) & full
        right_up, right_down = falls | (full ^ (level | rises)), level & rises
        if i < n - band:
            now += not level & lowest
        else:
            now += bool(right_up & end) - bool(right_down & end)
            end >>= 1
        if now > limit:
            return far
        level >>= 1
        rises, falls = right_down | (full ^ (level | right_up)), level & right_up
    return now


def similar(pairs: list[tuple[np.ndarray, np.ndarray]], at_least: float = SIMILARITY) -> np.ndarray:
    """Whether each pair's edit similarity, 1 - distance / longer length, is at
    least ``at_least``; exact."""
    result = np.zeros(len(pairs), dtype=bool)
    for i, (a, b) in enumerate(pairs):
        allowed = int(allowed_edits(max(len(a), len(b)), at_least))
        if abs(len(a) - len(b)) > allowed:
            continue
        x, y = _trimmed(a, b)
        if max(len(x), len(y)) <= allowed:
            result[i] = True
        elif _may_align(x, y, allowed):
            x, y, band = x.tolist(), y.tolist(), min(BAND, allowed)
            while (d := banded(x, y, band)) > band and band < allowed:
                band = min(2 * band, allowed)
            result[i] = d <= allowed
    return result


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), the root being the least
    node of its connected component; by alternating large and small stars.

    Each step is a grouped minimum (with partial aggregation) and an equi-join;
    lineage is cut by ``checkpoint``.
    """

    def large(e: DataFrame) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))

    def small(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        rest = down.join(least, "u").where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return rest.union(least.select("u", "m"))

    def print_of(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = edges.where("a != b").distinct().checkpoint()
    mark = print_of(now)
    while mark[0]:
        now = small(large(now).distinct()).distinct().checkpoint()
        if (new := print_of(now)) == mark:
            break
        mark = new
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select("b", "b")
    ).distinct()


def _written(df: DataFrame, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def aligned(pairs: DataFrame, sequences: DataFrame) -> DataFrame:
    """(a, b, ok) for the pairs (a, b) of ids of ``sequences``."""
    words = sequences.select("id", "words")
    sides = pairs.join(words.toDF("a", "x"), "a").join(words.toDF("b", "y"), "b")

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), 1024):
                part = batch.iloc[i : i + 1024]
                turned = [
                    (np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32))
                    for x, y in zip(part["x"], part["y"])
                ]
                yield pd.DataFrame({"a": part["a"], "b": part["b"], "ok": similar(turned)})

    return sides.mapInPandas(align, "a bigint, b bigint, ok boolean")


def block_links(sequences: DataFrame, roots: DataFrame, folder: str) -> DataFrame:
    """Links (a, b) of roots: those of texts that agree in a sketch and are not
    connected by ``roots`` (id, root). Two texts are compared in the first sketch that
    they agree in."""
    known = sequences.select("id", "n", "sketches").join(roots.toDF("id", "root"), "id", "left")
    members = known.select(
        "id", F.col("n").cast("bigint").alias("n"), F.coalesce("root", "id").alias("root"),
        F.posexplode("sketches").alias("j", "key"),
    ).select("id", "n", "root", "j", F.xxhash64("j", "key").alias("key"))
    open_ = (
        members.groupBy("key")
        .agg(F.sum("n").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
        .where("low != high")
        .select("key", F.ceil(F.col("n") / BLOCK_WORDS).alias("blocks"), "n")
    )
    buckets = _written(open_, folder, "buckets")
    groups = 64 + (buckets.agg(F.sum(F.col("n") * F.col("blocks"))).first()[0] or 0) // GROUP_WORDS
    dealt = (
        members.join(buckets.select("key", "blocks"), "key")
        .withColumn("own", F.pmod(F.xxhash64("id", "key"), F.col("blocks")))
        .select("id", "root", "j", "key", "own", "blocks")
        .join(sequences.select("id", "words", "sketches"), "id")
        .withColumn("earlier", F.slice("sketches", F.lit(1), F.col("j")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
        .withColumn("group", F.pmod(F.xxhash64("key", "low", "high"), F.lit(groups)))
        .select(
            "group", "j", "key", "low", "high", "root", "words", "earlier",
            (F.col("own") == F.col("low")).alias("first"),
        )
    )

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int]] = []
        for (j, _, low, high), unit in part.groupby(["j", "key", "low", "high"], sort=False):
            words = [np.frombuffer(w, np.uint32) for w in unit["words"]]
            sides = None if low == high else unit["first"].to_numpy()
            roots = unit["root"].to_numpy()
            earlier = np.stack(unit["earlier"].tolist()) if j else None
            found += [(roots[a], roots[b]) for a, b in unit_links(roots, words, sides, earlier)]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return dealt.groupBy("group").applyInPandas(compare, "a bigint, b bigint")


def connected(nodes: DataFrame, folder: str) -> DataFrame:
    """(node, root) for ``nodes`` (node, text of distinct nodes) that are linked to
    another: the root stands for the class."""
    ship(nodes.sparkSession)

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, int] = {}
        for batch in batches:
            words = [word_hashes(t, seen) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "id": batch["id"],
                    "node": batch["node"],
                    "n": [len(w) for w in words],
                    "words": [w.astype(np.uint32).tobytes() for w in words],
                    "sketches": [sketches(w) for w in words],
                }
            )

    # short ids, fixed once they are written
    sequences = _written(
        nodes.select(F.monotonically_increasing_id().alias("id"), "node", "text").mapInPandas(
            sketch, "id bigint, node string, n int, words binary, sketches array<bigint>"
        ),
        folder, "sequences",
    )
    members = sequences.select("id", F.posexplode("sketches").alias("j", "key"))
    members = members.select("id", F.xxhash64("j", "key").alias("key"))
    least = members.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("a")).where("n > 1")
    stars = members.join(least.select("key", "a"), "key").where("id != a")
    first = _written(
        aligned(stars.select("a", F.col("id").alias("b")).distinct(), sequences).where("ok").select("a", "b"),
        folder, "first",
    )
    roots = _written(components(first), folder, "roots").toDF("id", "root")
    second = _written(block_links(sequences, roots, folder), folder, "second")
    # the second links are few and join roots, so only these are followed again
    further = components(second)
    named = sequences.select("id", "node").join(roots, "id", "left").withColumn("own", F.coalesce("root", "id"))
    return (
        named.join(further.toDF("own", "last"), "own", "left")
        .where("root IS NOT NULL OR last IS NOT NULL")
        .select("node", F.coalesce("last", "own").cast("string").alias("root"))
    )


def classes(documents: DataFrame) -> DataFrame:
    """One row per distinct (text, smallest doc_id): node, least_id, root and
    class_id, the smallest doc_id of its class."""
    spark = documents.sparkSession
    folder = scratch_path(spark, "near-dedup")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(f"{folder}/checkpoints")
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    nodes = texts.withColumn("node", F.md5("text"))
    least = nodes.groupBy("node").agg(F.min("doc_id").alias("least_id"))
    # one row for each distinct text: equal texts are merged before they are shuffled
    distinct = nodes.where("text != ''").select("node", "text").dropDuplicates(["node", "text"])
    roots = connected(distinct, folder)
    named = least.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("least_id").alias("class_id"))
    return named.join(smallest, "root")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, class_id (the smallest doc_id of its class) and is_kept, true for
    the class's row of that doc_id, for every row of ``documents``."""
    found = classes(documents).select("node", "class_id")
    rows = documents.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("node"))
    return rows.join(found, "node").select(
        "doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("is_kept")
    )


def deduplicate(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` without all but one of each class: that with the
    smallest doc_id (null ids only if the class has no other)."""
    found = classes(documents)
    kept = (
        found.where(F.col("least_id").eqNullSafe(F.col("class_id")))
        .groupBy("class_id", "root")
        .agg(F.min("node").alias("__node"))
        .select(F.coalesce(F.col("class_id").cast("string"), F.lit("")).alias("__id"), "__node")
    )
    keyed = documents.withColumns(
        {
            "__id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
            "__node": F.md5(F.coalesce("text", F.lit(""))),
        }
    )
    return (
        keyed.join(kept, ["__id", "__node"], "left_semi")
        .dropDuplicates(["__id", "__node"])
        .select(documents.columns)
    )
