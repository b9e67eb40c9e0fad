"""Byte-level BPE, encoded by a priority queue of merge ranks and decoded by concatenation.

A text is cut at the tokenizer's special strings, then into pieces by its pre-tokenizer's pattern. In a piece the bytes
are symbols of a doubly linked list. Every neighbouring pair that can merge waits in a heap with its rank; the pair of
the lowest rank, and of those the leftmost, is merged, its new neighbours are pushed, and entries whose symbols have
changed since are skipped when they come up. The queue of a short piece is the plain list of its pairs' ranks, whose least
is looked for. Words repeat, so a bounded cache keeps the ids of recent ones, as 32-bit integers.

Decoding joins the byte strings of the vocabulary; bytes that are not UTF-8 become U+FFFD.

Defined results: a null text is the empty one, with no ids; ids outside the vocabulary raise. Only the named column is
read; added columns replace none: a clash of names raises.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from flowlab.llm.tables import batch_of, pieces
from flowlab.llm.words import RUNS, RecentCache, plain_chunks

# Fixed value: the pattern by which this kind of byte-level pre-tokenizer cuts a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of a piece up to which looking through all its pairs is cheaper than a heap.
SHORT = 32
#: Ids that are decoded at a time.
PART_IDS = 1 << 18


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in the vocabulary: itself if it is visible, else one from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class BpeModel:
    """Vocabulary and merges of a byte-level BPE tokenizer file."""

    def __init__(self, spec: dict):
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (
            model["type"] == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex", True)
            and not before.get("add_prefix_space") and spec.get("normalizer") is None
            and not model.get("dropout") and not model.get("ignore_merges")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec.get("added_tokens", []))
        )
        if not plain:
            raise ValueError("only byte-level BPE without normaliser, prefix blank or options of its special tokens")
        alphabet = byte_alphabet()
        back = {c: b for b, c in enumerate(alphabet)}
        vocabulary = model["vocab"]
        self.first = [vocabulary.get(c) for c in alphabet]
        self.strings: dict[int, bytes] = {i: bytes(back[c] for c in t) for t, i in vocabulary.items()}
        # A pair of ids as one number gives the rank of its merge; a rank gives what merges into what.
        self.width = max(vocabulary.values()).bit_length()
        self.ranks: dict[int, int] = {}
        self.rules: list[tuple[int, int, int]] = []
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = vocabulary[left], vocabulary[right]
            self.ranks[a << self.width | b] = rank
            self.rules.append((a, b, vocabulary[left + right]))
        self.made = [new for _, _, new in self.rules]
        # The ranks of what two bytes begin with, by both bytes as one number.
        self.byte_ranks = [
            len(self.rules) if a is None or b is None else self.ranks.get(a << self.width | b, len(self.rules))
            for a in self.first for b in self.first
        ]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", []) if t["content"]}
        self.strings.update({i: c.encode() for c, i in self.special.items()})
        # The byte strings one after the other, by id; a size of -1 stands for no such id.
        self.sizes = np.full(max(self.strings) + 1, -1)
        for i, c in self.strings.items():
            self.sizes[i] = len(c)
        self.starts = np.cumsum(np.maximum(self.sizes, 0)) - np.maximum(self.sizes, 0)
        self.bytes = np.frombuffer(b"".join(self.strings[i] for i in sorted(self.strings)), np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        """The byte strings of the ids, one after the other."""
        return b"".join(self._joined(ids[at:at + PART_IDS]) for at in range(0, len(ids), PART_IDS))

    def _joined(self, ids: np.ndarray) -> bytes:
        if not 0 <= ids.min() <= ids.max() < len(self.sizes):
            raise KeyError("an id outside the vocabulary")
        sizes = self.sizes[ids]
        if (sizes < 0).any():
            raise KeyError("an id outside the vocabulary")
        at = np.repeat(self.starts[ids] - (np.cumsum(sizes) - sizes), sizes)
        at += np.arange(len(at))
        return self.bytes[at].tobytes()

    def merged(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        symbols = list(map(self.first.__getitem__, piece))
        if None in symbols:
            raise ValueError("the vocabulary lacks a byte")
        return self._merged_short(piece, symbols) if len(symbols) <= SHORT else self._merged_long(symbols)

    def _merged_short(self, piece: bytes, symbols: list[int]) -> list[int]:
        width, rank_of, made, byte_ranks = self.width, self.ranks.get, self.made, self.byte_ranks
        never = len(made)
        ranks = [byte_ranks[a << 8 | b] for a, b in zip(piece, piece[1:])]
        # The last entry stands for no pair.
        ranks.append(never)
        while (rank := min(ranks)) < never:
            i = ranks.index(rank)
            symbols[i] = new = made[rank]
            del symbols[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of(symbols[i - 1] << width | new, never)
            if i + 1 < len(symbols):
                ranks[i] = rank_of(new << width | symbols[i + 1], never)
        return symbols

    def _merged_long(self, symbols: list[int]) -> list[int]:
        n, width, rank_of, rules = len(symbols), self.width, self.ranks.get, self.rules
        # An entry of the queue is the rank and, below it, the place of the left symbol.
        low = n.bit_length()
        mask = (1 << low) - 1
        queue = [
            rank << low | i for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (rank := rank_of(a << width | b)) is not None
        ]
        if not queue:
            return symbols
        heapq.heapify(queue)
        after = [*range(1, n), -1]
        before = [*range(-1, n - 1)]
        while queue:
            entry = heapq.heappop(queue)
            i = entry & mask
            left, right, new = rules[entry >> low]
            if symbols[i] != left:
                continue  # stale: the symbol has merged meanwhile
            j = after[i]
            if j < 0 or symbols[j] != right:
                continue  # stale: its neighbour has
            symbols[i], symbols[j] = new, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (rank := rank_of(new << width | symbols[k])) is not None:
                    heapq.heappush(queue, rank << low | i)
            if (h := before[i]) >= 0 and (rank := rank_of(symbols[h] << width | new)) is not None:
                heapq.heappush(queue, rank << low | h)
        return [s for s in symbols if s >= 0]


class BpeEncoder:
    """Encodes and decodes texts; chunks that repeat are looked up."""

    def __init__(self, model: BpeModel, size: int = 200_000):
        self.model = model
        self.pattern = regex.compile(PATTERN)
        self.pieces = RecentCache(self._merged, size // 8)
        self.chunks = RecentCache(self._chunk, size // 8)
        # Chunks after a single blank are kept without it.
        self.after_blank = RecentCache(lambda chunk: self._chunk(chunk if chunk[:1] == "\n" else " " + chunk), size)
        names = sorted(model.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

    def _merged(self, piece: str) -> bytes:
        return array("i", self.model.merged(piece.encode("utf-8", "replace"))).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        parts = self.pattern.findall(chunk)
        if len(parts) == 1:
            return self._merged(parts[0])
        # A piece of one blank and what is no white space is a chunk after a blank by itself.
        return b"".join([
            self.after_blank[p[1:]] if p[0] == " " and p[1:] and not p[1].isspace() else self.pieces[p] for p in parts
        ])

    def _plain(self, text: str) -> bytes:
        # No piece reaches from visible characters into the white space after them, so texts are cut there first.
        chunks = plain_chunks(text)
        if chunks is None:
            return b"".join(map(self.chunks.__getitem__, RUNS.findall(text)))
        return self.chunks[chunks[0]] + b"".join(map(self.after_blank.__getitem__, chunks[1:]))

    def ids(self, text: str) -> np.ndarray:
        """The ids of a text, as 32-bit integers."""
        if self.special is None or not self.special.search(text):
            return np.frombuffer(self._plain(text) if text else b"", np.int32)
        ids: list[bytes] = []
        for part in self.special.split(text):
            if part in self.model.special:
                ids.append(array("i", [self.model.special[part]]).tobytes())
            elif part:
                ids.append(self._plain(part))
        return np.frombuffer(b"".join(ids), np.int32)

    def encode(self, text: str) -> list[int]:
        return self.ids(text).tolist()

    def decode(self, ids: Sequence[int] | np.ndarray) -> str:
        return self.model.joined(np.asarray(ids, np.int64)).decode("utf-8", "replace")


def _encoder(docs: DataFrame, tokenizer_path: str):
    """Builds the encoder inside a task from the broadcast file, about a megabyte."""
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    return lambda: BpeEncoder(BpeModel(json.loads(shared.value)))


def _added(docs: DataFrame, names: list[str]) -> None:
    clash = {c.lower() for c in docs.columns} & {n.lower() for n in names}
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")


def encoded(docs: DataFrame, tokenizer_path: str, *, text: str = "text", ids: str = "ids") -> DataFrame:
    """All columns and ``ids``, an array of the tokens of ``text``."""
    _added(docs, [ids])
    make = _encoder(docs, tokenizer_path)
    body = docs.schema.names.index(text)
    rows = docs.withColumn(ids, F.lit(None).cast("array<int>"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = make()
        for batch in chain.from_iterable(map(pieces, batches)):
            found = [encoder.ids(t or "") for t in batch.column(body).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, batch.schema.types[-1])], schema=batch.schema)

    return rows.mapInArrow(encode, rows.schema)


def decoded(tokens: DataFrame, tokenizer_path: str, *, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns and ``text``, the text of the ids; null ids are none."""
    _added(tokens, [text])
    make = _encoder(tokens, tokenizer_path)
    source = tokens.schema.names.index(ids)
    rows = tokens.withColumn(text, F.lit(None).cast("string"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = make()
        for batch in chain.from_iterable(map(pieces, batches)):
            found = [encoder.decode(t or []) for t in batch.column(source).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, batch.schema.types[-1])], schema=batch.schema)

    return rows.mapInArrow(decode, rows.schema)


def round_trip_digests(
    docs: DataFrame, tokenizer_path: str, *, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """Per row ``doc_id, n_tokens``, and the SHA-256 of the decimal ids joined by commas and of the text decoded from the
    ids; on request the ``ids`` too. Encoding and decoding run in one pass."""
    make = _encoder(docs, tokenizer_path)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("body"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = make()
        # Every number with its comma, filled up with zero bytes to the length of the longest.
        decimal = np.array([b"%d," % i for i in range(len(encoder.model.sizes))])
        for batch in chain.from_iterable(map(pieces, batches)):
            out = []
            for body in batch.column(1).to_pylist():
                ids = encoder.ids(body or "")
                named = decimal[ids].tobytes().translate(None, b"\0")[:-1]
                out.append((
                    len(ids), hashlib.sha256(named).hexdigest(), hashlib.sha256(encoder.decode(ids).encode()).hexdigest(),
                    *([ids] if with_ids else []),
                ))
            if out:
                yield batch_of(pa.schema([batch.schema.field(0), *fields]), batch.column(0), *zip(*out))

    fields = [pa.field("n_tokens", pa.int64()), pa.field("ids_sha256", pa.string()), pa.field("decoded_sha256", pa.string())]
    fields += [pa.field("ids", pa.list_(pa.int32()))] * with_ids
    kind = rows.schema["doc_id"].dataType.simpleString()
    more = ", ids array<int>" * with_ids
    return rows.mapInArrow(digests, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
