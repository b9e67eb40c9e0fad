"""Language-model scores by deleted interpolation.

P(w | h) = l2(b) c(h, w) / c(h) + l1(b) c(w) / N + l0(b) / (V + 1), where h is the word before (or the start of the
text), b the bucket of c(h): its number of binary digits. The weights of each bucket are learned by expectation-
maximisation on a tenth of the training texts that is held out of the counts meanwhile; the counts are then those of all
training texts.

Neither counts nor texts fit a broadcast, and a row for each word of the corpus would move it several times. So texts are
cut into blocks of about ``BLOCK_TOKENS`` tokens, written once as numbers of the words of the block. A block asks for
the counts of its distinct words and pairs: hashes, sorted, a slice for each hash bucket. The group of a bucket adds up
what all blocks counted and answers each of them in the order of its slice. A slice has a key once, so no word, however
common, makes a large group; the number of buckets follows the size of the input. Words have 64-bit hashes; pairs have
those of their bucket and 40 bits more.

Held-out counts for the weights are kept as a histogram of bucket and probabilities, in steps of an eighth of an octave,
so that it is bounded whatever the input.

Defined results: a null or empty text is its end alone; a null id is in training; repeated rows count and are scored
each; with nothing to learn from, words are unknown; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from flowlab.llm.tables import batch_of, written
from flowlab.llm.words import mixed, spaced_words, word_hashes

BLOCK_TOKENS = 1 << 21
BUCKET_TOKENS = 1 << 21
BYTES_PER_TOKEN = 6
PAIR_BYTES = 5
#: Tokens of a block whose probabilities are worked out at a time.
CHUNK_TOKENS = 1 << 18
STEPS = 8  # of an octave
EM_ROUNDS = 60
#: Where a bucket has no held-out token, and before the first round.
START_WEIGHTS = (0.5, 0.4, 0.1)

FIT, TUNE, TEST = 0, 1, 2
WORDS, PAIRS = 1, 2
END = b""  # no word is empty


def packed(a: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(a).tobytes(), 1)


def unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


# ---------------------------------------------------------------- blocks


@dataclass
class Block:
    """Texts as places of their words in ``vocabulary``, sorted hashes."""

    ids: np.ndarray
    lengths: np.ndarray
    vocabulary: np.ndarray

    def contexts(self) -> np.ndarray:
        """The word before each token; ``len(vocabulary)`` at the start of a text."""
        before = np.empty_like(self.ids)
        before[1:] = self.ids[:-1]
        before[np.cumsum(self.lengths) - self.lengths] = len(self.vocabulary)
        return before

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the distinct pairs, sorted, and for each token the place of its pair among them."""
        size = len(self.vocabulary) + 1
        keys = self.contexts().astype(np.int64)
        keys *= size
        keys += self.ids
        keys, back = np.unique(keys, return_inverse=True)
        back = back.astype(np.int32)
        with np.errstate(over="ignore"):
            names = np.append(mixed(self.vocabulary + np.uint64(1)), np.uint64(0))
            hashes = mixed(names[keys // size] ^ self.vocabulary[keys % size])
        order = np.argsort(hashes, kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        return hashes[order], place[back]


def roles(doc_id: str, parts: int, tune_parts: int) -> Column:
    """0: counted, 1: held out of the counts to learn the weights, 2: never learned from. By the checksum of the id."""
    crc = F.crc32(F.col(doc_id).cast("string"))
    return F.when(crc % parts == 0, TEST).when((crc / parts).cast("long") % tune_parts == 0, TUNE).otherwise(FIT)


def blocks(docs: DataFrame, doc_id: str, text: str, parts: int, tune_parts: int, block_tokens: int) -> DataFrame:
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc"), F.col(f"`{text}`").cast("string").alias("body")
    ).select("doc", roles("doc", parts, tune_parts).alias("role"), "body")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, part, number = word_hashes(), TaskContext.get().partitionId(), 0
        # One open block for each role, so that the weights need only the blocks of theirs.
        names: list[list] = [[], [], []]
        parts_of: list[list[np.ndarray]] = [[], [], []]
        held = [0, 0, 0]

        def flushed(role: int) -> pa.RecordBatch:
            nonlocal number
            number += 1
            vocabulary, ids = np.unique(np.concatenate(parts_of[role]), return_inverse=True)
            lengths = np.array([len(p) for p in parts_of[role]], "<i8")
            ids_of = names[role]
            row = (
                (part << 32) + number, role, len(ids_of), len(ids), packed(np.array([d or 0 for d in ids_of], "<i8")),
                packed(np.array([d is None for d in ids_of], np.uint8)), packed(lengths), packed(ids.astype("<i4")),
                vocabulary.astype("<u8").tobytes(),
            )
            names[role], parts_of[role], held[role] = [], [], 0
            return batch_of(schema, *([v] for v in row))

        for batch in batches:
            for doc, role, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                words = spaced_words(body.as_py())
                words.append(END)
                names[role].append(doc)
                parts_of[role].append(np.fromiter(map(cache.__getitem__, words), np.uint64, len(words)))
                held[role] += len(words)
                if held[role] >= block_tokens:
                    yield flushed(role)
        yield from (flushed(role) for role in range(3) if held[role])

    schema = pa.schema([
        ("block", pa.int64()), ("role", pa.int32()), ("docs", pa.int64()), ("tokens", pa.int64()), ("names", pa.binary()),
        ("nulls", pa.binary()), ("lengths", pa.binary()), ("ids", pa.binary()), ("vocabulary", pa.binary()),
    ])
    kinds = "block long, role int, docs long, tokens long, names binary, nulls binary, lengths binary, ids binary, vocabulary binary"
    return written(rows.mapInArrow(cut, kinds), "lm-blocks")


def block_of(ids: bytes, lengths: bytes, vocabulary: bytes) -> Block:
    return Block(unpacked(ids, "<i4"), unpacked(lengths, "<i8"), np.frombuffer(vocabulary, "<u8"))


# ---------------------------------------------------------------- counts


def slices(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket of sorted hashes begins and the last ends."""
    starts = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate(([0], np.searchsorted(hashes, starts), [len(hashes)]))


def pair_bytes(hashes: np.ndarray, bits: int) -> bytes:
    """The bits below those of the bucket."""
    low = (hashes << np.uint64(bits)) >> np.uint64(64 - 8 * PAIR_BYTES)
    return low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :PAIR_BYTES].tobytes()


def pair_numbers(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // PAIR_BYTES, 8), np.uint8)
    wide[:, :PAIR_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, PAIR_BYTES)
    return wide.view("<u8").reshape(-1)


def asked(table: DataFrame, bits: int) -> DataFrame:
    """A row for each block, kind and bucket: the hashes it asks for, and how often it has each."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, role, ids, lengths, vocabulary in zip(*(c.to_pylist() for c in batch.columns)):
                b = block_of(ids, lengths, vocabulary)
                pairs, place = b.pairs()
                for kind, hashes, places in ((WORDS, b.vocabulary, b.ids), (PAIRS, pairs, place)):
                    n = np.bincount(places, minlength=len(hashes)).astype("<u4")
                    cuts = slices(hashes, bits)
                    rows = [
                        (kind, k, number, role, hashes[s:e].tobytes() if kind == WORDS else pair_bytes(hashes[s:e], bits),
                         b"" if role == TEST else packed(n[s:e]))
                        for k, (s, e) in enumerate(zip(cuts, cuts[1:])) if e > s
                    ]
                    yield batch_of(schema, *zip(*rows))

    schema = pa.schema([
        ("kind", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("role", pa.int32()), ("hashes", pa.binary()), ("n", pa.binary()),
    ])
    return table.select("block", "role", "ids", "lengths", "vocabulary").mapInArrow(
        ask, "kind int, bucket int, block long, role int, hashes binary, n binary"
    )


ANSWER = "block long, kind int, bucket int, fit binary, tune binary, words long, fit_words long"


def answer(table: pa.Table) -> pa.Table:
    """Adds up one bucket and answers each block; ``words``: how many distinct words training has, all and counted."""
    kind = table.column("kind")[0].as_py()
    bucket = table.column("bucket")[0].as_py()
    blocks_, roles_ = table.column("block").to_pylist(), table.column("role").to_pylist()
    parts = [
        np.frombuffer(h, "<u8") if kind == WORDS else pair_numbers(h) for h in table.column("hashes").to_pylist()
    ]
    values, back = np.unique(np.concatenate(parts), return_inverse=True)
    ends = np.cumsum([len(p) for p in parts])
    totals = np.zeros((2, len(values)), np.int64)
    for end, part, role, n in zip(ends, parts, roles_, table.column("n").to_pylist()):
        if role != TEST:
            totals[role] += np.bincount(back[end - len(part):end], unpacked(n, "<u4"), len(values)).astype(np.int64)
    known, counted = int((totals.sum(axis=0) > 0).sum()), int((totals[FIT] > 0).sum())
    out = [
        (b, kind, bucket, *(packed(t[back[end - len(part):end]].astype("<u4")) for t in totals), 0, 0)
        for b, end, part in zip(blocks_, ends, parts)
    ]
    out.append((-1, kind, bucket, b"", b"", known * (kind == WORDS), counted * (kind == WORDS)))
    names = [f.split()[0] for f in ANSWER.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


@dataclass(frozen=True)
class Totals:
    """Tokens, distinct words and texts of training."""

    tokens: int
    words: int
    texts: int


class Looked:
    """The counts of one block, put back in place."""

    def __init__(self, b: Block, answers: pa.Table, texts: int, tune: bool):
        def gathered(kind: int, size: int) -> np.ndarray:
            rows = answers.filter(pa.compute.equal(answers.column("kind"), kind)).sort_by("bucket")
            n = np.concatenate([np.empty(0, np.int64), *(unpacked(v, "<u4") for v in rows.column("fit").to_pylist())])
            if tune:
                n = n + np.concatenate([np.empty(0, np.int64), *(unpacked(v, "<u4") for v in rows.column("tune").to_pylist())])
            if len(n) != size:
                raise RuntimeError("a block's counts are not whole")
            return n.astype(np.int64)

        pairs, place = b.pairs()
        words = gathered(WORDS, len(b.vocabulary))
        self.pair = gathered(PAIRS, len(pairs))[place]
        self.word = words[b.ids]
        self.context = np.append(words, texts)[b.contexts()]

    def chunks(self) -> Iterator[slice]:
        return (slice(at, at + CHUNK_TOKENS) for at in range(0, len(self.word), CHUNK_TOKENS))

    def bucket(self, some: slice) -> np.ndarray:
        return np.frexp(self.context[some].astype(float))[1]

    def parts(self, some: slice, totals: Totals) -> tuple[np.ndarray, np.ndarray, float]:
        """What pairs, words and nothing say of each of some tokens."""
        pair = self.pair[some] / np.maximum(self.context[some], 1)
        return pair, self.word[some] / max(1, totals.tokens), 1 / (totals.words + 1)


# ---------------------------------------------------------------- weights


def step(p: np.ndarray) -> np.ndarray:
    """Probabilities as eighths of octaves below one; -1 for zero."""
    return np.where(p > 0, np.rint(-STEPS * np.log2(np.maximum(p, 1e-300))), -1).astype(np.int64)


def em_weights(cells: np.ndarray, uniform: float, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Weights (pair, word, uniform) of 64 buckets from rows of bucket, steps of the pair's and the word's probability, and
    count."""
    weights = np.tile(np.array(START_WEIGHTS), (64, 1))
    weights[0] = (0, START_WEIGHTS[1], START_WEIGHTS[2])
    weights[0] /= weights[0].sum()
    if not len(cells):
        return weights
    bucket, n = cells[:, 0], cells[:, 3].astype(float)
    parts = [np.where(c < 0, 0, 2.0 ** (-c / STEPS)) for c in (cells[:, 1], cells[:, 2])] + [np.full(len(cells), uniform)]
    parts = np.stack(parts, axis=1)
    seen = np.bincount(bucket, n, 64) > 0
    for _ in range(rounds):
        share = weights[bucket] * parts
        share *= (n / share.sum(axis=1))[:, None]
        # A thousandth of a token keeps a weight from vanishing.
        total = np.stack([np.bincount(bucket, s, 64) for s in share.T], axis=1) + 0.001 * np.array([0, 1, 1])
        weights[seen] = (total / total.sum(axis=1, keepdims=True))[seen]
    weights[0, 0] = 0
    weights[0] /= weights[0].sum()
    return weights


# ---------------------------------------------------------------- operator


def scored(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", parts: int = 10, tune_parts: int = 10,
    block_tokens: int = BLOCK_TOKENS, bucket_tokens: int = BUCKET_TOKENS,
) -> DataFrame:
    """Per row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, the scores as log10. Rows whose
    checksum of the id divides by ``parts`` are never learned from."""
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")))).first()[0] or 0
    bits = max(3, math.ceil(math.log2(max(1, size / BYTES_PER_TOKEN / bucket_tokens))))
    table = blocks(docs, doc_id, text, parts, tune_parts, block_tokens)
    answers = written(asked(table, bits).groupBy("kind", "bucket").applyInArrow(answer, ANSWER), "lm-counts")
    sums = {r.role: r for r in table.groupBy("role").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).collect()}
    words, fit_words = answers.filter("block = -1").agg(F.sum("words"), F.sum("fit_words")).first()
    fit, tune = (((sums[r].tokens, sums[r].docs) if r in sums else (0, 0)) for r in (FIT, TUNE))
    counted = Totals(fit[0], fit_words or 0, fit[1])
    totals = Totals(fit[0] + tune[0], words or 0, fit[1] + tune[1])

    replies = answers.filter("block >= 0").select("block", "kind", "bucket", "fit", "tune")
    blocks_ = table.select("block", "role", "names", "nulls", "lengths", "ids", "vocabulary")

    def histogram(left: pa.Table, right: pa.Table) -> pa.Table:
        found = Looked(block_in(left), right, counted.texts, tune=False)
        cells, counts = [], []
        for some in found.chunks():
            pair, word, _ = found.parts(some, counted)
            # A step is less than 2**14, so the three numbers of a cell fit one.
            cell, n = np.unique(found.bucket(some).astype(np.int64) << 28 | step(pair) + 1 << 14 | step(word) + 1, return_counts=True)
            cells.append(cell)
            counts.append(n)
        cell, n = np.concatenate(cells), np.concatenate(counts)
        columns = (cell >> 28, (cell >> 14 & 16383) - 1, (cell & 16383) - 1, n)
        return pa.table({k: pa.array(v, pa.int64()) for k, v in zip("bpwn", columns)})

    tuned = blocks_.filter(F.col("role") == TUNE).groupBy("block").cogroup(
        replies.join(table.filter(F.col("role") == TUNE).select("block"), "block", "left_semi").groupBy("block")
    ).applyInArrow(histogram, "b long, p long, w long, n long")
    cells = tuned.groupBy("b", "p", "w").agg(F.sum("n").alias("n")).collect()
    weights = em_weights(np.array([tuple(r) for r in cells], np.int64).reshape(-1, 4), 1 / (counted.words + 1))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        b = block_in(left)
        found = Looked(b, right, totals.texts, tune=True)
        p, base = np.empty(len(b.ids)), np.empty(len(b.ids))
        for some in found.chunks():
            pair, word, uniform = found.parts(some, totals)
            w = weights[found.bucket(some)]
            p[some] = np.log10(w[:, 0] * pair + w[:, 1] * word + w[:, 2] * uniform)
            base[some] = np.log10((found.word[some] + 0.1) / (totals.tokens + 0.1 * (totals.words + 1)))
        starts = np.cumsum(b.lengths) - b.lengths
        names = unpacked(left.column("names")[0].as_py(), "<i8")
        nulls = unpacked(left.column("nulls")[0].as_py(), np.uint8).astype(bool)
        return pa.table([
            pa.array(names, pa.int64(), mask=nulls), pa.array(np.full(len(names), left.column("role")[0].as_py() == TEST)),
            pa.array(b.lengths, pa.int64()), pa.array(np.add.reduceat((found.word > 0).astype(np.int64), starts)),
            pa.array(np.full(len(names), totals.tokens, np.int64)), pa.array(np.add.reduceat(base, starts)),
            pa.array(np.add.reduceat(p, starts)),
        ], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return blocks_.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


def block_in(table: pa.Table) -> Block:
    """The block of a group, which is one row."""
    if table.num_rows != 1:
        raise RuntimeError("a block's texts are not whole")
    return block_of(*(table.column(c)[0].as_py() for c in ("ids", "lengths", "vocabulary")))
