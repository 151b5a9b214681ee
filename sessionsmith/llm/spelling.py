"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

Of two words x and y, where x is the longer one or as long, x contributes two disjoint chunks, each half its length (an odd
letter is left over), and y the positional grams of that length. One edit leaves one of the two chunks whole, and moves it by
at most one place: both words meet in it, and pairs that meet are verified.

Halves of short words are short, and many words may begin alike, so a chunk can be hot. Pairs are counted per chunk before
any is made. Where there are too many, the words that met are halved once more: without the chunk they have in common they
still are one edit apart, so again one contributes two chunks of what is left and the other its grams, and the key is both
chunks. That ends when one letter is left over, where as many words meet as there are letters. Every pair keeps a way to
meet, however often a key is halved, and no key makes more than ``PAIRS_EACH`` pairs before that.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_batches, stored

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: One occurrence in so many loses a letter.
DAMAGED = 97
#: Pairs that a chunk may make. Beyond, words are halved again.
PAIRS_EACH = 4096


def damaged(words: Counter, key: object, one_in: int = DAMAGED) -> Iterator[tuple[str, int]]:
    """Words of one text in lower case (A-Z only) and how often they occur. Those whose checksum with the key is divisible by ``one_in`` lose a letter."""
    low: Counter = Counter()
    for word, n in words.items():
        low[word.encode().lower()] += n
    begin = zlib.crc32(b"%s:" % str("" if key is None else key).encode())
    for raw, n in low.items():
        word = raw.decode()
        h = zlib.crc32(raw, begin)
        if one_in and h % one_in == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        yield word, n


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", one_in: int = DAMAGED, least_length: int = LEAST_LENGTH, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of all texts with ``least_length`` letters or more that occur ``least`` times or more.

    Words are counted per Arrow batch before they are shuffled, so a frequent word is one row per batch. Null texts have no
    words, a null key is empty in the checksum, repeated rows count each time. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if t:
                    for word, n in damaged(Counter(LETTERS.findall(t)), k, one_in):
                        if len(word) >= least_length:
                            found[word] += n
            yield pa.record_batch([pa.array(list(found.keys()), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

    counted = in_batches(docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")), run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def chunks(rows: DataFrame) -> DataFrame:
    """Each row's two chunks of half of ``rest``: (key, word, n, rest without the chunk)."""
    half = F.expr("CAST(length(rest) div 2 AS INT)")
    cut = rows.withColumn("half", half).withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))
    return cut.select(*_cut(F.col("k") * F.col("half"), F.length("rest")), "word", "n")


def grams(rows: DataFrame) -> DataFrame:
    """Each row's positional grams that can be a chunk of a string of length ``wanted``, at most one place away: the key, and what ``chunks`` gives, and ``wanted`` without the chunk.

    A string of the same length differs in one place, so nothing moves; one that is longer by one moves what follows.
    """
    shifts = F.when(F.col("wanted") == F.length("rest"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(-1)))
    cut = rows.withColumn("half", F.expr("CAST(wanted div 2 AS INT)")).withColumn("k", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("shift", F.explode(shifts))
    at = F.col("k") * F.col("half") + F.col("shift")
    inside = cut.where((at >= 0) & (at + F.col("half") <= F.length("rest")))
    return inside.select(*_cut(at, F.col("wanted")), "word", "n", (F.col("wanted") - F.col("half")).alias("wanted"))


def _cut(at: Column, length: Column) -> list[Column]:
    half = F.col("half")
    gram = F.substr(F.col("rest"), at + 1, half)
    rest = F.concat(F.substr(F.col("rest"), F.lit(1), at), F.substr(F.col("rest"), at + half + 1))
    return [F.xxhash64("key", length, "k", gram).alias("key"), rest.alias("rest")]


def near_pairs(words: DataFrame, pairs_each: int = PAIRS_EACH) -> DataFrame:
    """(a, n_a, b, n_b) of all pairs of words of ``words`` (word, n; each word once) that one inserted, deleted or replaced code point tells apart, each pair once in either order."""
    key = F.lit(0).cast("long").alias("key")
    left = words.select(key, F.col("word").alias("rest"), "word", "n")
    wanted = F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("wanted")
    right = words.select(key, F.col("word").alias("rest"), "word", "n", wanted)
    found = []
    while True:
        left, right = stored(chunks(left)), stored(grams(right))
        meeting = left.select("key", F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select("key", F.lit(0).alias("l"), F.lit(1).alias("r")))
        # What is left over for a chunk is as long as what it was cut from without it; halving ends at one letter.
        deep = right.where("wanted > 1").select("key").distinct()
        hot = meeting.groupBy("key").agg(F.sum("l").alias("l"), F.sum("r").alias("r")).where(F.col("l") * F.col("r") > pairs_each)
        hot = stored(hot.join(deep, "key", "left_semi").select("key"))
        if hot.isEmpty():
            found.append(verified(left, right))
            break
        found.append(verified(left.join(hot, "key", "left_anti"), right.join(hot, "key", "left_anti")))
        left, right = left.join(hot, "key", "left_semi"), right.join(hot, "key", "left_semi")
    return reduce(DataFrame.unionByName, found).distinct()


def verified(left: DataFrame, right: DataFrame) -> DataFrame:
    x, y = left.alias("x"), right.alias("y")
    longer = F.length("x.word") > F.length("y.word")
    met = x.join(y, F.col("x.key") == F.col("y.key")).where(longer | (F.col("x.word") < F.col("y.word")))
    near = met.where(F.levenshtein("x.word", "y.word", 1) == 1)
    return near.select(F.col("x.word").alias("a"), F.col("x.n").alias("n_a"), F.col("y.word").alias("b"), F.col("y.n").alias("n_b"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form): the last word that is reached by following forms. A form must be more frequent than its word, so there is no circle. Ways are doubled in each round."""
    reached = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(reached.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        reached = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return reached


def spelling_variants(words: DataFrame, pairs_each: int = PAIRS_EACH) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every row of ``words`` (word, n; each word once, not null).

    ``form`` is the near word of largest n (ties: smallest in code-point order) if that is at least twice the word's, else
    null with ``form_n``. ``root`` is where forms lead to, the word itself without one. An empty table gives an empty one.
    """
    words = stored(words.select("word", "n"))
    pairs = stored(near_pairs(words, pairs_each))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("n_b").alias("n_a"), F.col("a").alias("b"), F.col("n_a").alias("n_b")))
    best = both.groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("least"), F.col("b").alias("form"))).alias("best"))
    counted = words.join(best, "word", "left")
    led = -F.col("best.least") >= 2 * F.col("n")
    named = stored(counted.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(led, F.col("best.form")).alias("form"), F.when(led, -F.col("best.least")).alias("form_n")))
    ends = roots(named.where("form IS NOT NULL"))
    return named.join(ends, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
