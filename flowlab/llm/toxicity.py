"""Toxicity: a logistic classifier that is held to equal scores when identity terms are swapped.

Features are the words of the text and their openings of 5, 6 and 7 bytes, hashed; the value is the logarithm of one
plus the count. Besides the labels the model learns from counterfactuals: every labelled sentence with an identity
term is paired with copies that name another group instead, and the squared change of the score is penalised. A
neutral mention of a group thus cannot carry weight by itself.

Labelled rows beyond ``max_rows`` (by default 20,000) are not used for fitting; those of the smallest hashes of their
id are. Their features are written once, and each step of L-BFGS sums loss and gradient over them in Spark. All
rows are scored, with their whole texts.

Defined results: null and empty texts get the score of a text without words; a repeated label counts each time, one
without a value or text row not at all; with fewer than two classes the score is the smoothed share of label 1. Labels,
ids and other columns are never features. Only the named columns are read.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from flowlab.llm.tables import batch_of, pieces, text_place, written
from flowlab.llm.words import ALNUM, RecentCache

BITS = 18
OPENINGS = (5, 6, 7)
MAX_ROWS = 20_000
RIDGE = 1e-5
SWAP_PENALTY = 1.0
THRESHOLD = 0.3

# Terms that name groups; within a group each may stand for any other.
IDENTITY_GROUPS: tuple[tuple[str, ...], ...] = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "protestants"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("woman", "man"), ("women", "men"), ("female", "male"), ("girl", "boy"), ("girls", "boys"),
    ("immigrant", "citizen"), ("immigrants", "citizens"), ("disabled", "blind", "deaf"), ("old", "young"),
)

SENTENCE = re.compile(r"[.!?\n]+")


class Featurizer:
    def __init__(self, bits: int = BITS, groups: Sequence[Sequence[str]] = IDENTITY_GROUPS):
        self.size = 1 << bits
        # Words that seldom come again are not worth their memory.
        self.places = RecentCache(self._places, 100_000)
        self.others = {
            t.encode(): [o.encode() for o in group if o != t] for group in groups for t in group
        }

    def _places(self, word: bytes) -> bytes:
        """Where a word and its openings stand in the vector."""
        names = [word, *(word[:k] + b"*" for k in OPENINGS if len(word) >= k)]
        return np.array([xxhash.xxh32_intdigest(n) % self.size for n in names], "<u4").tobytes()

    def words(self, text: str) -> list[bytes]:
        return text.lower().encode("utf-8", "replace").translate(ALNUM).split()

    def features(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Places, each once, and their values."""
        if not words:
            return np.empty(0, np.int64), np.empty(0)
        n = Counter(words)
        parts = list(map(self.places.__getitem__, n))
        places = np.frombuffer(b"".join(parts), "<u4")
        times = np.repeat(np.fromiter(n.values(), float, len(n)), np.fromiter(map(len, parts), int, len(parts)) // 4)
        places, back = np.unique(places, return_inverse=True)
        return places.astype(np.int64), np.log1p(np.bincount(back, times))

    def swaps(self, text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each sentence with identity terms and each way to swap them: the change of its features."""
        for sentence in SENTENCE.split(text):
            words = self.words(sentence)
            named = sorted({w for w in words if w in self.others})
            for term, other in ((t, o) for t in named for o in self.others[t]):
                a, x = self.features(words)
                b, y = self.features([other if w == term else w for w in words])
                places, back = np.unique(np.concatenate((a, b)), return_inverse=True)
                change = np.bincount(back, np.concatenate((x, -y)))
                yield places[change != 0], change[change != 0]


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray  # the last is the bias
    bits: int = BITS

    def scores(self, texts: list[str | None], featurizer: Featurizer) -> np.ndarray:
        z = np.full(len(texts), self.weights[-1])
        for i, text in enumerate(texts):
            if text:
                places, values = featurizer.features(featurizer.words(text))
                z[i] += self.weights[places] @ values
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def held_out(doc_id: str, parts: int = 4, part: int = 2) -> Column:
    """Rows that are never learned from, by the checksum of their id."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string")) % parts == part, F.lit(False))


# ---------------------------------------------------------------- fitting


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, max_rows: int) -> DataFrame:
    """``y, body`` of at most ``max_rows`` labels; so few ids are broadcast, the texts stay where they are."""
    chosen = (
        labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y"))
        .filter("id is not null and y is not null").filter(~held_out("id"))
        .orderBy(F.xxhash64("id"), "id", "y").limit(max_rows)
    )
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("body"))
    return rows.join(F.broadcast(chosen), "id").select("y", F.coalesce("body", F.lit("")).alias("body"))


ROWS = pa.schema([("y", pa.int32()), ("places", pa.binary()), ("values", pa.binary())])


def featured(rows: DataFrame, bits: int, groups: Sequence[Sequence[str]]) -> DataFrame:
    """``y, places, values`` of each labelled text; for the changes of swapped sentences ``y`` is null."""
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Featurizer(bits, groups)
        for batch in batches:
            out = []
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                pairs = ((None, *p) for p in f.swaps(text))
                for kind, places, values in itertools.chain([(y, *f.features(f.words(text)))], pairs):
                    out.append((kind, places.astype("<u4").tobytes(), values.astype("<f4").tobytes()))
                    if len(out) >= 1000:
                        yield batch_of(ROWS, *zip(*out))
                        out = []
            if out:
                yield batch_of(ROWS, *zip(*out))

    return written(rows.mapInArrow(features, "y int, places binary, values binary"), "toxicity-features")


SUMS = pa.schema([
    ("loss", pa.float64()), ("change", pa.float64()), ("places", pa.binary()), ("g", pa.binary()), ("swapped", pa.binary()), ("s", pa.binary()),
])


def gradient(table: DataFrame, weights: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray]:
    """Sums over all rows: log loss, squared changes, and their gradients. One row comes back from each task, all in one
    job, with those places of the gradients that are not zero."""
    shared = table.sparkSession.sparkContext.broadcast(weights)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        size, loss, change = len(w), 0.0, 0.0
        total, swapped = np.zeros(size), np.zeros(size)
        for batch in batches:
            y = np.array([-1 if v is None else v for v in batch.column(0).to_pylist()])
            places = [np.frombuffer(v, "<u4") for v in batch.column(1).to_pylist()]
            row = np.repeat(np.arange(len(y)), [len(p) for p in places])
            place = np.concatenate(places) if places else np.empty(0, int)
            value = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<f4").astype(float)
            labelled = y >= 0
            z = np.bincount(row, w[place] * value, len(y)) + w[-1] * labelled
            loss += float(np.logaddexp(0, -(2 * y - 1) * z)[labelled].sum())
            change += float((z[~labelled] ** 2).sum())
            error = np.where(labelled, 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y, 0)
            total += np.bincount(place, error[row] * value, size)
            total[-1] += error.sum()
            swapped += np.bincount(place, np.where(labelled, 0, 2 * z)[row] * value, size)
        found = [(at, v[at]) for v in (total, swapped) for at in (np.flatnonzero(v),)]
        yield batch_of(SUMS, [loss], [change], *([x] for at, v in found for x in (at.astype("<u4").tobytes(), v.tobytes())))

    loss, change = 0.0, 0.0
    g, s = np.zeros(len(weights)), np.zeros(len(weights))
    kinds = "loss double, change double, places binary, g binary, swapped binary, s binary"
    for batch in table.mapInArrow(sums, kinds).toArrow().to_batches():
        for more, changed, *parts in zip(*batch.columns):
            loss, change = loss + more.as_py(), change + changed.as_py()
            places, values, swapped, changes = (p.as_buffer() for p in parts)
            g[np.frombuffer(places, "<u4")] += np.frombuffer(values)
            s[np.frombuffer(swapped, "<u4")] += np.frombuffer(changes)
    shared.destroy()
    return loss, change, g, s


def minimised(f: Callable, x: np.ndarray, steps: int, memory: int = 8, tolerance: float = 1e-4) -> np.ndarray:
    """L-BFGS with step halving."""
    value, g = f(x)
    history: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        q, parts = g.copy(), []
        for s, y in reversed(history):
            a = (s @ q) / (y @ s)
            parts.append(a)
            q -= a * y
        if history:
            s, y = history[-1]
            q *= (s @ y) / (y @ y)
        for (s, y), a in zip(history, reversed(parts)):
            q += (a - (y @ q) / (y @ s)) * s
        t = 1.0 if history else 1 / max(1.0, float(np.linalg.norm(g)))
        for _ in range(20):
            new, new_g = f(x - t * q)
            if new <= value - 1e-4 * t * (g @ q):
                break
            t /= 2
        else:
            return x
        s, y = -t * q, new_g - g
        if y @ s > 0:
            history = [*history[1 - memory:], (s, y)]
        x = x - t * q
        if value - new < tolerance * value:
            return x
        value, g = new, new_g
    return x


def fitted(
    docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    max_rows: int = MAX_ROWS, ridge: float = RIDGE, swap_penalty: float = SWAP_PENALTY, steps: int = 30, bits: int = BITS,
    groups: Sequence[Sequence[str]] = IDENTITY_GROUPS, tasks: int = 12,
) -> ToxicityModel:
    rows = training_rows(docs, labels, doc_id, text, label, max_rows)
    # At most ``tasks`` gradients come back to the driver in each step.
    table = featured(rows, bits, groups).coalesce(tasks)
    n = {r.y: r["count"] for r in table.groupBy("y").count().collect()}
    pairs, texts = n.pop(None, 0), sum(n.values())
    weights = np.zeros((1 << bits) + 1)
    share = (n.get(1, 0) + 0.1) / (texts + 1)
    weights[-1] = np.log(share / (1 - share))
    if not n.get(0) or not n.get(1):
        return ToxicityModel(weights, bits)

    def objective(w: np.ndarray) -> tuple[float, np.ndarray]:
        loss, change, g, s = gradient(table, w)
        plain = np.append(w[:-1], 0.0)
        scale = swap_penalty / max(1, pairs)
        return loss / texts + scale * change + ridge / 2 * float(plain @ plain), g / texts + scale * s + ridge * plain

    return ToxicityModel(minimised(objective, weights, steps), bits)


# ---------------------------------------------------------------- scoring


def scored(docs: DataFrame, model: ToxicityModel, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id, score``."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("body"))
    weights, bits = docs.sparkSession.sparkContext.broadcast(model.weights), model.bits

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        featurizer, model = Featurizer(bits), ToxicityModel(weights.value, bits)
        for batch in batches:
            schema = pa.schema([batch.schema.field(0), ("score", pa.float64())])
            yield batch_of(schema, batch.column(0), model.scores(batch.column(1).to_pylist(), featurizer))

    return rows.mapInArrow(score, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def without_toxic(docs: DataFrame, model: ToxicityModel, *, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score below the threshold, with their columns as they are."""
    at = text_place(docs, text)
    body = [F.col(f"`{text}`").cast("string").alias("body")] if at is None else []
    rows = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"), *body)
    weights, bits = docs.sparkSession.sparkContext.broadcast(model.weights), model.bits

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        featurizer, model = Featurizer(bits), ToxicityModel(weights.value, bits)
        for batch in batches:
            for part in pieces(batch):
                texts = part.column(1) if at is None else part.column(0).field(at)
                yield part.filter(pa.array(model.scores(texts.to_pylist(), featurizer) < threshold))

    return rows.mapInArrow(keep, rows.schema).select("row.*")
