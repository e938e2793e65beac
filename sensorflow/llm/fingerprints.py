"""Document fingerprints: one-permutation MinHash with b-bit packing.

A text's five-word shingles (lower-cased letters and digits) are hashed once.
The upper bits of a hash name its bin, and each of the ``BINS`` bins keeps its
least hash. An empty bin takes the value of a filled bin, chosen by a random
order of the bins that depends only on the empty bin's number (optimal
densification), so equal shingle sets agree in every bin. The fingerprint packs
the ``BITS`` low bits of every bin as one hex digit.

Two fingerprints agree in a bin with probability J + (1 - J) / 2**BITS for
shingle sets of likeness J; ``likeness`` corrects that bias. Texts of fewer than
five words are one shingle; texts without a word but not empty are one shingle
of all their characters; null and empty texts have the empty fingerprint, whose
likeness is 1 to itself and 0 to any other.

Only DataFrame functions: everything runs in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

WORDS = 5
BINS = 128
BITS = 4
SHIFT = 64 - 7  # the upper 7 bits name one of 128 bins
#: Ranges of ids of equal depth, and most documents of a range on average.
RANGES = 256
DOCS_PER_RANGE = 100_000


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the fingerprint of its column ``text`` as column ``name``.

    Every step is a projection of its own, so that lambdas read finished arrays.
    """
    w, h, s, least, bins = (f"__{name}_{x}" for x in ("w", "h", "s", "least", "bins"))
    following = ", ".join(f"get({h}, i + {k})" for k in range(1, WORDS))
    steps = {
        w: f"filter(split(lower({text}), '[^\\\\p{{L}}\\\\p{{N}}]+'), x -> x != '')",
        h: f"transform({w}, x -> xxhash64(x))",
        s: f"""sort_array(CASE
            WHEN {text} IS NULL OR {text} = '' THEN cast(array() AS array<bigint>)
            WHEN size({h}) = 0 THEN array(xxhash64({text}))
            WHEN size({h}) < {WORDS} THEN array(xxhash64({h}))
            ELSE transform(slice({h}, 1, size({h}) - {WORDS - 1}), (x, i) -> xxhash64(x, {following}))
            END)""",
        least: f"""filter({s}, (x, i) -> i = 0
            OR shiftrightunsigned(x, {SHIFT}) != shiftrightunsigned(get({s}, i - 1), {SHIFT}))""",
        bins: f"transform({least}, x -> shiftrightunsigned(x, {SHIFT}))",
    }
    for column, expression in steps.items():
        df = df.withColumn(column, F.expr(expression))
    # a filled bin's own value, else that of the filled bin first in this bin's order
    donor = f"""array_min(transform({bins}, b -> (xxhash64(i, b) & -{BINS}L) | b)) & {BINS - 1}L"""
    digit = f"""substr('0123456789abcdef', cast(get({least}, cast(array_position({bins},
        if(array_contains({bins}, i), i, {donor})) - 1 AS int)) & {2**BITS - 1} AS int) + 1, 1)"""
    packed = f"""if(size({least}) = 0, '',
        array_join(transform(sequence(0L, {BINS - 1}L), i -> {digit}), ''))"""
    return df.withColumn(name, F.expr(packed)).drop(*steps)


def likeness(a: str, b: str) -> Column:
    """The estimated likeness of two fingerprint columns, between 0 and 1."""
    chance = 2.0**-BITS
    same = f"""aggregate(sequence(1, {BINS}), 0,
        (n, i) -> n + if(substr({a}, i, 1) = substr({b}, i, 1), 1, 0))"""
    return F.expr(
        f"""CASE WHEN {a} = {b} THEN 1.0D WHEN {a} = '' OR {b} = '' THEN 0.0D
        ELSE greatest(0.0D, ({same} / {BINS}.0D - {chance}D) / {1 - chance}D) END"""
    )


def with_next(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with ``next_<column>`` of the row next by ascending doc_id (null
    ids first, ties by text), after the last the first.

    Ids are dealt to ranges of about equal depth, and each range also gets a
    copy of the following range's first row, so that no window spans the table.
    What the driver holds is a first id per range: one of at least
    ``DOCS_PER_RANGE`` documents beyond the first ``RANGES``.
    """
    spark = df.sparkSession
    fractions = [i / RANGES for i in range(RANGES)]
    rows, bounds = df.agg(
        F.count("*"), F.percentile_approx(F.col("doc_id").cast("bigint"), fractions, 10_000)
    ).first()
    bounds = sorted(set(bounds or []))
    parts = max(1, -(-rows // (RANGES * DOCS_PER_RANGE)))
    at = F.col("doc_id").cast("bigint")
    if bounds:
        edges = F.array(*map(F.lit, bounds))
        coarse = F.size(F.filter(edges, lambda b: b <= at)) - 1
        low = F.get(edges, coarse)
        high = F.coalesce(F.get(edges, coarse + 1), F.lit(bounds[-1] + 1))
        inner = F.least(F.lit(parts - 1.0), F.floor((at - low) / (high - low) * parts))
        part = F.coalesce(coarse * parts + inner, F.lit(-1)).cast("bigint")
    else:
        part = F.lit(-1).cast("bigint")
    dealt = df.withColumn("__part", part)
    firsts = sorted(
        dealt.groupBy("__part").agg(F.min(at).alias("first")).collect(), key=lambda r: r["__part"]
    )
    copies = [(r["first"], firsts[i - 1]["__part"]) for i, r in enumerate(firsts)]
    # one row for each range
    edge = F.broadcast(spark.createDataFrame(copies, "__first bigint, __before bigint"))
    own = F.struct(F.col("__part").alias("part"), F.lit(0).alias("copy"))
    copy = F.struct(F.col("__before").alias("part"), F.lit(1).alias("copy"))
    places = F.when(F.col("__before").isNull(), F.array(own)).otherwise(F.array(own, copy))
    placed = dealt.join(edge, at.eqNullSafe(F.col("__first")), "left").select(
        *df.columns, F.inline(places).alias("__in", "__copy")
    )
    order = W.partitionBy("__in").orderBy("__copy", F.col("doc_id").asc_nulls_first(), "text")
    following = F.lead(F.struct(*columns)).over(order)
    return (
        placed.withColumn("__next", following)
        .where(F.col("__copy") == 0)
        .select(*df.columns, *[F.col(f"__next.{c}").alias(f"next_{c}") for c in columns])
    )


def fingerprint_documents(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next: each text beside the same text with its second half
    replaced by as much of the next document's beginning."""
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = with_fingerprint(docs, "text", "fingerprint")
    docs = with_next(docs, ["text", "fingerprint"])
    docs = docs.withColumn("n_chars", F.length("text").cast("bigint")).withColumn(
        "edited",
        F.expr(
            "concat(substring(text, 1, n_chars - n_chars div 2),"
            " substring(next_text, 1, n_chars div 2))"
        ),
    )
    docs = docs.withColumn("edited_sha256", F.sha2("edited", 256))
    docs = with_fingerprint(docs, "edited", "edited_fingerprint")
    return docs.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )
