"""Spelling variants: words one letter apart, found by PartEnum signatures of their letter multisets.

A word is the set of its (letter, occurrence) pairs, a binary vector. One inserted or deleted letter moves it by a
Hamming distance of one, a replaced one by two at most. PartEnum deals the pairs out to PARTS partitions and gives a word
one signature for each choice of two partitions that are left out: words at a distance of two or less differ in two
partitions at most, so they share the signature that leaves those out. Equal signatures are an equi-join.

A signature alone says nothing about the order of letters and would join all anagrams, so its key also holds half of the
word: one edit leaves either the first half or the rest of the shorter word as it is. A word takes part once as the
shorter (or equal) one and once as the longer one of a pair. Both conditions are exact: no pair of near words is lost,
no group of words is ever compared in full, and there is no cap. What meets is verified letter by letter.

All joins are by shuffle. Spark sizes a written table by its file and takes no account of the rows that a task makes of
one: a vocabulary of a few MB on disk would be broadcast as all its keys, by way of the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from flowlab.llm.tables import batch_of, written
from flowlab.llm.words import mixed

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = r"([A-Za-zÀ-ÿ]+)"
#: Partitions of the letter pairs; six signatures leave two of four out.
PARTS = 4
KEYS = pa.schema([("key", pa.int64()), ("word", pa.string()), ("n", pa.int64())])
STEP = np.uint64(0x9E3779B97F4A7C15)


def lowered(word: Column) -> Column:
    """A-Z in lower case, all else as it is. Few words need the walk along their letters."""
    return F.when(F.lower(word) == word, word).otherwise(F.translate(word, UPPER, LOWER))


def runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, word``: every maximal run of letters of every text. A null text has none."""
    text = F.col(text_column)
    found = docs.select(F.col(id_column).alias("id"), F.explode(F.regexp_extract_all(text, F.lit(LETTERS), F.lit(1))).alias("run"))
    return found.select("id", lowered(F.col("run")).alias("word"))


def thinned(words: DataFrame, modulus: int = 97) -> DataFrame:
    """Lets one run in ``modulus`` lose a letter, chosen by a checksum of document and run; a null id counts as empty."""
    spelt = F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("word"))
    words = words.withColumn("h", F.crc32(spelt.cast("binary")))
    place = (F.col("h") % F.char_length("word")).cast("int")
    rest = F.concat(F.substring("word", F.lit(1), place), F.substring("word", place + 2, F.char_length("word")))
    return words.select("id", F.when(F.col("h") % modulus == 0, rest).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """``word, n`` for words of so many letters and occurrences. Counts are summed in each task before the shuffle."""
    counts = words.filter(F.char_length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= min_count)


def _hash(values: np.ndarray) -> np.ndarray:
    return mixed(values.astype(np.uint64) * STEP + STEP)


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All code points, the number of the word of each, and the lengths of the words."""
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    codes = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.int64)
    return codes, np.repeat(np.arange(len(lengths)), lengths), lengths


def _signatures(codes: np.ndarray, row: np.ndarray, n: int) -> list[np.ndarray]:
    """One hash a word for each choice of two partitions left out: the sum of the hashes of the pairs in the others."""
    order = np.lexsort((codes, row))
    letter, row = codes[order], row[order]
    place = np.arange(len(letter))
    first = np.ones(len(letter), bool)
    first[1:] = (letter[1:] != letter[:-1]) | (row[1:] != row[:-1])
    occurrence = place - np.maximum.accumulate(np.where(first, place, 0))
    pair = _hash(letter * (1 << 32) + occurrence)
    sums = np.zeros((n, PARTS), np.uint64)
    np.add.at(sums, (row, (mixed(pair) % np.uint64(PARTS)).astype(np.int64)), pair)
    total = sums.sum(axis=1, dtype=np.uint64)
    left_out = np.array(list(combinations(range(PARTS), 2)))
    marks = _hash(np.arange(len(left_out)))
    return [mixed(total - sums[:, a] - sums[:, b] + mark) for (a, b), mark in zip(left_out, marks)]


def _halves(codes: np.ndarray, row: np.ndarray, lengths: np.ndarray, shorter: np.ndarray) -> list[np.ndarray]:
    """Hashes of the first half of ``shorter`` letters and of as many last letters as are then left."""
    ends = np.cumsum(lengths)
    starts = ends - lengths
    place = np.arange(len(codes)) - starts[row]
    front = np.concatenate([[np.uint64(0)], np.cumsum(_hash(codes * (1 << 32) + place), dtype=np.uint64)])
    back = np.concatenate([[np.uint64(0)], np.cumsum(_hash(codes * (1 << 32) + (lengths[row] - 1 - place)), dtype=np.uint64)])
    half = shorter // 2
    first = front[starts + half] - front[starts]
    last = back[ends] - back[ends - (shorter - half)]
    return [mixed(first + _hash(shorter * 2)), mixed(last + _hash(shorter * 2 + 1))]


def key_rows(longer: bool):
    """A task's part: a row for each signature and half of each word, taken as the longer or the shorter of a pair."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            word, n = batch.column("word"), batch.column("n")
            codes, row, lengths = _letters(word)
            halves = _halves(codes, row, lengths, lengths - 1 if longer else lengths)
            for signature in _signatures(codes, row, len(lengths)):
                for half in halves:
                    yield batch_of(KEYS, pa.array(mixed(signature * STEP + half).view(np.int64)), word, n)

    return rows


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, n_a, b, n_b``: every two of the distinct words that one inserted, deleted or replaced letter tells apart,
    once. ``words`` holds ``word`` and ``n``; words of a single letter have no halves and are near by length alone, so
    they are left out."""
    words = words.select("word", F.col("n").cast("long").alias("n")).filter(F.char_length("word") > 1)
    schema = "key long, word string, n long"
    short = words.mapInArrow(key_rows(False), schema)
    long = words.mapInArrow(key_rows(True), schema)
    a = short.select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
    b = short.withColumn("longer", F.lit(False)).union(long.withColumn("longer", F.lit(True)))
    b = b.select("key", F.col("word").alias("b"), F.col("n").alias("n_b"), "longer")
    # Keys are hashes: lengths make sure that a pair meets in one role only.
    more = F.char_length("b") - F.char_length("a")
    met = a.join(b.hint("merge"), "key").filter((F.col("longer") & (more == 1)) | (~F.col("longer") & (more == 0) & (F.col("a") < F.col("b"))))
    return met.filter(F.levenshtein("a", "b", 1) == 1).select("a", "n_a", "b", "n_b").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: where the chain of ``form`` of each ``word`` ends. A form is at least twice as frequent as its
    word, so chains are short and without circles; each round doubles the steps taken and is written before the next."""
    at = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = at.join(onward.hint("merge"), "root", "left")
        step = written(step.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        at = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return at


def variant_groups(words: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each row of a vocabulary (``word, n``, words distinct).

    ``form`` is the near word of largest n (ties: the smallest in code-point order) if it is at least twice as frequent
    as the word, else null; ``root`` is where forms lead to, the word itself without a form. An empty vocabulary gives
    no rows; other columns are ignored.
    """
    words = written(words.select("word", "n"), "words")
    pairs = written(near_pairs(words), "near-words")
    links = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("other_n")).union(
        pairs.select(F.col("b"), F.col("a"), F.col("n_a"))
    )
    best = links.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("least"), F.col("other"))).alias("best")
    )
    frequent = -F.col("best.least") >= 2 * F.col("n")
    found = words.join(best.hint("merge"), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best.other")).alias("form"), F.when(frequent, -F.col("best.least")).alias("form_n"),
    )
    found = written(found, "forms")
    ends = roots(found.filter("form is not null"))
    return found.join(ends.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", modulus: int | None = None) -> DataFrame:
    """Variant groups of the words of ``docs``; with ``modulus`` some runs lose a letter first, see ``thinned``.

    Null and empty texts have no words, rows repeated count again, no documents give no rows.
    """
    words = runs(docs, id_column, text_column)
    if modulus is not None:
        words = thinned(words, modulus)
    return variant_groups(vocabulary(words))
