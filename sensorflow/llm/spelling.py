"""Spelling variants: words one edit apart, found in a reduced alphabet.

Letters are hashed to ``SYMBOLS`` symbols, so many words share one reduced word.
Words one edit apart have reduced words at most one edit apart: equal ones where
two letters of one symbol are exchanged, else neighbours. The one-edit
neighbourhood of every distinct reduced word is generated and joined with the
distinct reduced words; as nearness works both ways, only its half of shorter
words and of smaller symbols is sent, which finds every pair from one of its
sides. The words of two matched reduced words meet in a join whose condition
verifies the original strings by edit distance, so only true pairs are rows.

A word's ``form`` is its most frequent near word if that is ``TIMES`` times as
frequent; ``root`` follows forms to the last by doubling (each form is at least
ten times as frequent as the one before, so a chain has at most 19 links).

Counts are made per task before they are shuffled. Null and empty texts have no
words; a null doc_id counts as an empty one; ties go to the smaller word;
repeated rows count again; extra columns are ignored.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.session import scratch_path

LEAST_LENGTH = 7
LEAST_COUNT = 2
TIMES = 10
SYMBOLS = 8
ERASED_EACH = 31

UPPER = "".join(map(chr, range(65, 91)))
LETTERS = UPPER.lower() + "".join(map(chr, range(0xC0, 0x100)))


def reduced_alphabet(symbols: int) -> str:
    """The symbol (0, 1, ...) of each letter, by a hash of the letter."""
    return "".join(chr(48 + (zlib.crc32(c.encode()) >> 8) % symbols) for c in LETTERS)


def erased(word: Column, doc_id: Column, each: int = ERASED_EACH) -> Column:
    """The word without one letter where ``each`` divides a hash of id and word."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = (h % F.char_length(word)).cast("int")
    without = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.char_length(word)))
    return F.when(h % each == 0, without).otherwise(word)


def vocabulary(documents: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n of the words of ``documents`` (doc_id, text)."""
    # a run shorter than the least length is no word with or without a letter
    run = r"[a-zA-ZÀ-ÿ]{%d,}" % least_length
    found = documents.select(
        "doc_id",
        F.explode(F.regexp_extract_all(F.translate("text", UPPER, UPPER.lower()), F.lit(run), F.lit(0))).alias("run"),
    )
    words = found.select(erased(F.col("run"), F.col("doc_id")).alias("word"))
    counted = words.where(F.char_length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least_count)


def half_neighbourhood(reduced: Column, symbols: int) -> Column:
    """The reduced word itself, and its one-edit neighbours that are shorter or
    have a smaller symbol in one place. From the other side of a pair these are
    the longer ones and those with a greater symbol."""
    places = F.sequence(F.lit(1), F.char_length(reduced))
    before = lambda i: F.substring(reduced, F.lit(1), i - 1)
    after = lambda i: F.substring(reduced, i + 1, F.char_length(reduced))
    every = F.array(*[F.lit(chr(48 + s)) for s in range(symbols)])
    shorter = F.transform(places, lambda i: F.concat(before(i), after(i)))
    smaller = F.flatten(
        F.transform(
            places,
            lambda i: F.transform(
                F.filter(every, lambda s: s < F.substring(reduced, i, F.lit(1))),
                lambda s: F.concat(before(i), s, after(i)),
            ),
        )
    )
    return F.array_distinct(F.concat(F.array(reduced), shorter, smaller))


def near_pairs(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(a, n_a, b, n_b) for all two words of ``words`` (word, n; distinct, of
    ``LETTERS``) exactly one edit apart, each pair once."""
    reduced = words.select(
        "word", "n", F.translate("word", LETTERS, reduced_alphabet(symbols)).alias("reduced")
    ).withColumn("cell", F.xxhash64("reduced"))
    cells = reduced.select("reduced", "cell").distinct()
    sent = cells.select("cell", F.explode(half_neighbourhood(F.col("reduced"), symbols)).alias("other"))
    matched = sent.select("cell", F.xxhash64("other").alias("other")).join(
        cells.select(F.col("cell").alias("other")), "other"
    )
    left = reduced.select("cell", F.col("word").alias("a"), F.col("n").alias("n_a")).join(matched, "cell")
    right = reduced.select(F.col("cell").alias("other"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    # a word meets its own cell once: there the smaller word is the left one
    near = (F.levenshtein("a", "b", 1) == 1) & ((F.col("cell") != F.col("other")) | (F.col("a") < F.col("b")))
    return left.join(right, "other").where(near).select("a", "n_a", "b", "n_b")


def roots(forms: DataFrame, folder: str) -> DataFrame:
    """word, root for the words of ``forms`` (word, form): forms followed to the
    last, in steps that double, each written."""
    spark = forms.sparkSession
    path = f"{folder}/forms"
    forms.select("word", F.col("form").alias("root")).write.parquet(path)
    step, open_ = 0, True
    while open_:
        now = spark.read.parquet(path)
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        path = f"{folder}/roots-{step}"
        now.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        ).write.parquet(path)
        open_ = not spark.read.parquet(path).where("moved").isEmpty()
        step += 1
    return spark.read.parquet(path).select("word", "root")


def spelling_variants(
    documents: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    times: int = TIMES,
    symbols: int = SYMBOLS,
) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``documents``."""
    folder = scratch_path(documents.sparkSession, "spelling")
    spark = documents.sparkSession
    vocabulary(documents, least_length, least_count).write.parquet(f"{folder}/words")
    words = spark.read.parquet(f"{folder}/words")
    near_pairs(words, symbols).write.parquet(f"{folder}/pairs")
    pairs = spark.read.parquet(f"{folder}/pairs")
    sides = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).union(
        pairs.select("b", "a", "n_a")
    )
    best = sides.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    best.select("word", "n_near", F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n")).write.parquet(
        f"{folder}/best"
    )
    described = words.join(spark.read.parquet(f"{folder}/best"), "word", "left")
    taken = F.col("form_n") >= times * F.col("n")
    described = described.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(taken, F.col("form")).alias("form"), F.when(taken, F.col("form_n")).alias("form_n"),
    )
    last = roots(described.where("form is not null").select("word", "form"), folder)
    return described.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
