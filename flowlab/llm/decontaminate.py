"""Benchmark decontamination with an Aho-Corasick automaton.

The items of a benchmark are normalised to words, A-Z in lower case, and cut into windows of ``window``
consecutive words (an item of fewer words is one window). One automaton over all windows, with words as
letters, finds every occurrence in a text in one scan. An occurrence is mapped back to the byte span of the
original text in UTF-8.

The automaton lives in every task, so its size is bounded: at most ``BLOCK_WORDS`` words of windows each. A
larger benchmark is matched block by block; rows then carry what earlier blocks found.

Defined results: a null or empty text has no words and no hit; an item without words, or null, matches nothing;
repeated rows are scored each on its own; items that share a window are all reported; an item without an id hits words
but is not listed; with no items, nothing is hit. A hit holds the number of its window, not the list of its items, which
many windows may share: ``items`` lists them once a row, ``window_items`` by window. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flowlab.llm.tables import pieces, text_place, written
from flowlab.llm.words import ALNUM, plain_words

WINDOW = 10
BLOCK_WORDS = 2_000_000

HITS = "array<struct<first:int,last:int,start:long,stop:long,window:long>>"


def item_windows(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> dict[tuple[bytes, ...], list[str | None]]:
    """Each distinct window and the ids of the items that hold it."""
    found: dict[tuple[bytes, ...], dict[str | None, None]] = {}
    for item, text in items:
        words = plain_words(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            found.setdefault(tuple(words[i:i + window]), {})[item] = None
    return {k: list(v) for k, v in found.items()}


class Matcher:
    """The automaton of one block of items; ``items_of`` lists the known ids of each of its windows."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        windows = item_windows(items, window)
        self.items_of = [[i for i in ids if i is not None] for ids in windows.values()]
        self.letters: dict[bytes, int] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for number, words in enumerate(windows):
            key = tuple(self.letters.setdefault(w, len(self.letters) + 1) for w in words)
            self.automaton.add_word(key, (len(key), number))
        if windows:
            self.automaton.make_automaton()

    def matches(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """First and last word of every occurrence, and the number of its window. Letter 0 is any other word."""
        if not self.letters or not words:
            return
        letters = tuple(map(self.letters.get, words, itertools.repeat(0)))
        if any(letters):
            for last, (size, number) in self.automaton.iter(letters):
                yield last - size + 1, last, number


def byte_spans(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte offsets in the UTF-8 text of word spans; normalising keeps every byte in its place."""
    words = [m.span() for m in re.finditer(rb"[^ ]+", text.encode("utf-8", "replace").translate(ALNUM))]
    return [(words[a][0], words[b][1]) for a, b in spans]


def blocks_of(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_words: int) -> list[list[tuple]]:
    """The items in blocks of bounded size; a benchmark is a stated query set and is read block by block."""
    blocks: list[list[tuple]] = [[]]
    size = 0
    for item, text in benchmark.select(F.col(item_col).cast("string"), F.col(text_col).cast("string")).toLocalIterator():
        if not text:
            continue
        cells = len(plain_words(text)) * window
        if size and size + cells > block_words:
            blocks.append([])
            size = 0
        blocks[-1].append((item, text))
        size += cells
    return blocks


def matched(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS, keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` of every row with ``n_words``, ``hits`` (first and last word from 0, the byte span in the
    original text, the number of the window) and ``items``, the sorted ids of all that is hit; null without a hit."""
    keep = docs.columns if keep is None else keep
    rows = _scanned(docs, benchmark, keep, text, item_id, item_text, window, block_words)
    return rows.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "n_words", "hits", "items")


def _scanned(
    docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``matched`` with the columns ``keep`` as ``k0, k1, ...``, fixed names that no other column has."""
    spark = docs.sparkSession
    kept = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    own = text in keep and text_place(docs, text) is not None
    body = f"k{keep.index(text)}" if own else "body"
    rows = docs.select(*kept, *([] if own else [F.col(f"`{text}`").cast("string").alias("body")]))
    rows = rows.withColumns({"n_words": F.lit(0).cast("long"), "hits": F.lit(None).cast(HITS), "items": F.lit(None).cast("array<string>")})
    blocks = blocks_of(benchmark, item_id, item_text, window, block_words)
    base = 0
    for number, block in enumerate(blocks):
        shared = spark.sparkContext.broadcast(block)
        more = number < len(blocks) - 1
        # A text that is not kept travels on only while blocks remain.
        names = [c for c in rows.columns if more or c != "body"]
        rows = rows.mapInArrow(_scan(shared, window, base, body, names), rows.select(*names).schema)
        if more:
            rows = written(rows, "matches")
            base += len(item_windows(block, window))
    return rows


def window_items(
    benchmark: DataFrame, *, item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``window, words, items``: what the numbers in hits stand for, from an equal benchmark read in the same order."""
    rows = []
    for block in blocks_of(benchmark, item_id, item_text, window, block_words):
        for words, ids in item_windows(block, window).items():
            rows.append((len(rows), [w.decode("utf-8", "replace") for w in words], [i for i in ids if i is not None]))
    return benchmark.sparkSession.createDataFrame(rows, "window long, words array<string>, items array<string>")


def _scan(shared, window: int, base: int, text: str, names: list[str]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value, window)
        for batch in itertools.chain.from_iterable(map(pieces, batches)):
            at = batch.schema.get_field_index
            counts, hits, items = [], batch.column(at("hits")).to_pylist(), batch.column(at("items")).to_pylist()
            for i, body in enumerate(batch.column(at(text))):
                body = body.as_py()
                words = plain_words(body)
                counts.append(len(words))
                found = list(matcher.matches(words))
                if found:
                    spans = byte_spans(body, [(a, b) for a, b, _ in found])
                    hits[i] = (hits[i] or []) + [
                        {"first": a, "last": b, "start": s, "stop": e, "window": base + n}
                        for (a, b, n), (s, e) in zip(found, spans)
                    ]
                    items[i] = sorted({*(items[i] or ()), *(x for n in {n for *_, n in found} for x in matcher.items_of[n])})
            columns = batch.columns
            columns[at("n_words")] = pa.array(counts, pa.int64())
            columns[at("hits")] = pa.array(hits, batch.schema.field("hits").type)
            columns[at("items")] = pa.array(items, batch.schema.field("items").type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema).select(names)

    return scan


def covered_words(hits: Column) -> Column:
    """How many words lie inside at least one hit."""
    ordered = F.array_sort(F.transform(F.coalesce(hits, F.array()), lambda h: F.struct(h["first"], h["last"])))
    start = F.struct(F.lit(-1).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        ordered, start,
        lambda acc, h: F.struct(
            F.greatest(acc["end"], h["last"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), h["last"] - F.greatest(acc["end"], h["first"] - 1))).cast("long").alias("n"),
        ),
        lambda acc: acc["n"],
    )


def contamination(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", **options) -> DataFrame:
    """Per row: ``doc_id, n_words, n_hit, n_items, items`` and ``contaminated`` (some word is hit)."""
    rows = matched(docs, benchmark, keep=[doc_id], **options).withColumn("items", F.coalesce("items", F.array()))
    return rows.select(
        F.col(doc_id), "n_words", covered_words(F.col("hits")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), "items", F.col("hits").isNotNull().alias("contaminated"), "hits",
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no window of the benchmark, with their columns as they are."""
    clean = _scanned(docs, benchmark, docs.columns, text, **options).filter("hits is null")
    return clean.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(docs.columns)])
