"""Token ids as binary files of patched frame-of-reference blocks.

Layout of a file (numbers little-endian):

    "PFOR1\\n", u32 ids a block
    blocks, each: u32 minimum, u8 width, u16 exceptions, then the packed low bits of (id - minimum),
        then u16 places and u32 values of the exceptions (what does not fit into the width)
    document table: i64 doc_id, u8 is-null flag, u64 ids, one after the other as three arrays
    block index: u64 start of each block in the file, u64 first id of each block
    footer: u64 documents, u64 ids, u64 blocks, u64 start of the document table, "PFOR1\\n"

The width is the number of bits that the ``PERCENTILE`` of a block's values needs, raised while the exceptions would
cost more than wider packing. Blocks run across documents; the index gives any id's block without a scan.

Documents are range-partitioned and sorted by id, so that files in the order of the manifest hold the ids of all
documents in ascending order. Defined results: null text is the empty text; null ids come first; rows that repeat an
id are ordered by their text; an empty table gives no files. Only the named columns are read.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from flowlab.llm.files import create, reader, spread
from flowlab.llm.tables import batch_of, written
from flowlab.llm.words import BEYOND, RUNS, RecentCache
from flowlab.storage import scratch_path

MAGIC = b"PFOR1\n"
BLOCK_IDS = 4096
PERCENTILE = 0.9
FILE_IDS = 32_000_000
TASK_BYTES = 64 << 20
#: Bytes of text whose chunks are looked up together.
PIECE_BYTES = 4 << 20
#: White space other than single blanks and line feeds between visible characters.
NOT_PLAIN = f"^[ \\n]|[ \\n]$|[ \\n][ \\n]|[\\t\\x0B-\\r\\x1C-\\x1F{BEYOND}]"

MANIFEST = "part int, seq int, path string, docs long, ids long, bytes long"


# ---------------------------------------------------------------- blocks


def pack_block(ids: np.ndarray) -> bytes:
    low = int(ids.min())
    rest = ids.astype(np.uint32) - np.uint32(low)
    bits = np.frexp(rest.astype(float))[1]
    kept = np.cumsum(np.bincount(bits, minlength=33))
    width = int(np.searchsorted(kept, PERCENTILE * len(ids)))
    # An exception costs 48 bits, a wider block one bit for each id.
    while width < 32 and (kept[-1] - kept[width]) * 48 > (kept[-1] - kept[width + 1]) * 48 + len(ids):
        width += 1
    places = np.flatnonzero(bits > width)
    return b"".join((
        struct.pack("<IBH", low, width, len(places)), packed_bits(rest, width),
        places.astype("<u2").tobytes(), rest[places].astype("<u4").tobytes(),
    ))


def packed_bits(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of each value, one after the other."""
    if not width:
        return b""
    at = np.arange(len(values), dtype=np.uint64) * np.uint64(width)
    shift = at & np.uint64(63)
    low = values & np.uint64((1 << width) - 1)
    words = -(-len(values) * width // 64)
    # Values are narrower than words, so each word but the last has one that begins there; the last of them may end in the next.
    first = -(-64 * np.arange(words) // width)
    out = np.zeros(words, np.uint64)
    begun = first[first < len(values)]
    out[:len(begun)] = np.bitwise_or.reduceat(low << shift, begun)
    last = first[1:] - 1
    out[1:] |= low[last] >> np.uint64(1) >> (np.uint64(63) - shift[last])
    return out.astype("<u8").tobytes()[:(len(values) * width + 7) // 8]


def unpack_block(data: bytes, count: int) -> np.ndarray:
    low, width, exceptions = struct.unpack_from("<IBH", data)
    size = (count * width + 7) // 8
    at = np.arange(count, dtype=np.uint64) * np.uint64(width)
    # The eight bytes from each place on; no value reaches beyond them.
    near = np.ndarray(size + 1, "<u8", data[7:7 + size] + bytes(8), strides=(1,))
    rest = (near[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7))) & np.uint64((1 << width) - 1)
    rest = rest.astype(np.uint32)
    if exceptions:
        places = np.frombuffer(data, "<u2", exceptions, 7 + size)
        rest[places] = np.frombuffer(data, "<u4", exceptions, 7 + size + 2 * exceptions)
    return rest + np.uint32(low)


class PforWriter:
    """One file; ids wait until a block is full, never a whole file."""

    def __init__(self, out, block: int = BLOCK_IDS):
        if not 1 <= block <= 65536:
            raise ValueError("a block holds 1 to 65536 ids")
        self.out, self.block, self.at = out, block, 0
        self.starts: list[int] = []
        self.docs: list[tuple[int | None, int]] = []
        self.waiting: list[np.ndarray] = []
        self.held = self.ids = 0
        self._put(MAGIC + struct.pack("<I", block))

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.empty(0, np.uint32)
        whole = len(ids) if last else len(ids) - len(ids) % self.block
        for i in range(0, whole, self.block):
            self.starts.append(self.at)
            self._put(pack_block(ids[i:min(i + self.block, whole)]))
        self.waiting = [ids[whole:]]
        self.held = len(ids) - whole

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.waiting.append(ids)
        self.held += len(ids)
        self.ids += len(ids)
        if self.held >= 16 * self.block:
            self._flush(False)

    def close(self) -> None:
        self._flush(True)
        table = self.at
        self._put(np.array([d or 0 for d, _ in self.docs], "<i8").tobytes())
        self._put(np.array([d is None for d, _ in self.docs], np.uint8).tobytes())
        self._put(np.array([n for _, n in self.docs], "<u8").tobytes())
        self._put(np.array(self.starts, "<u8").tobytes())
        self._put((np.arange(len(self.starts), dtype="<u8") * np.uint64(self.block)).astype("<u8").tobytes())
        self._put(struct.pack("<QQQQ", len(self.docs), self.ids, len(self.starts), table) + MAGIC)
        self.out.close()


class PforReader:
    """Reads the tables at the end, and ids block by block."""

    def __init__(self, source):
        self.source = source
        tail = struct.calcsize("<QQQQ") + len(MAGIC)
        end = source.size() - tail
        footer = source.read_at(tail, end)
        head = source.read_at(len(MAGIC) + 4, 0)
        if footer[-len(MAGIC):] != MAGIC or head[:len(MAGIC)] != MAGIC:
            raise ValueError("not a file of patched frame-of-reference blocks, or cut short")
        docs, self.ids, blocks, table = struct.unpack_from("<QQQQ", footer)
        (self.block,) = struct.unpack_from("<I", head, len(MAGIC))
        data = source.read_at(end - table, table)
        names = np.frombuffer(data, "<i8", docs)
        null = np.frombuffer(data, np.uint8, docs, 8 * docs)
        self.doc_ids = [None if n else int(d) for d, n in zip(names, null)]
        self.lengths = np.frombuffer(data, "<u8", docs, 9 * docs).astype(np.int64)
        self.starts = np.append(np.frombuffer(data, "<u8", blocks, 17 * docs), table).astype(np.int64)

    def span(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` to before ``stop``, from the blocks that hold them."""
        if stop <= start:
            return np.empty(0, np.uint32)
        a, b = start // self.block, (stop - 1) // self.block + 1
        data = self.source.read_at(int(self.starts[b] - self.starts[a]), int(self.starts[a]))
        parts = [
            unpack_block(data[self.starts[k] - self.starts[a]:self.starts[k + 1] - self.starts[a]],
                         min(self.block, self.ids - k * self.block))
            for k in range(a, b)
        ]
        return np.concatenate(parts)[start - a * self.block:stop - a * self.block]

    def documents(self, step: int = 1 << 20) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Every document: id, ids before it in this file, its ids. About ``step`` ids are unpacked at a time."""
        ends = np.cumsum(self.lengths)
        k = 0
        while k < len(self.lengths):
            first = int(ends[k] - self.lengths[k])
            until = max(k + 1, int(np.searchsorted(ends, first + step, "right")))
            ids = self.span(first, int(ends[until - 1]))
            for j in range(k, until):
                s = int(ends[j] - self.lengths[j])
                yield self.doc_ids[j], s, ids[s - first:int(ends[j]) - first]
            k = until


# ---------------------------------------------------------------- tokenizer


class Chunks:
    """Numbered chunks and their ids, one after the other."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.ids, self.sizes = np.empty(0, "<u4"), np.empty(0, np.int64)

    def numbers(self, chunks: list[str]) -> np.ndarray:
        """The number of each chunk, -1 for unknown ones."""
        return np.fromiter(map(self.number.get, chunks, itertools.repeat(-1)), np.int64, len(chunks))

    def add(self, chunks: list[str], ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The numbers of new, distinct chunks."""
        at = len(self.sizes)
        self.number.update(zip(chunks, range(at, at + len(chunks))))
        self.ids, self.sizes = np.concatenate((self.ids, ids)), np.concatenate((self.sizes, sizes))
        return np.arange(at, at + len(chunks))


def joined(ids: np.ndarray, sizes: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of what the ``numbers`` stand for, one after the other, and where each ends; ``sizes`` are those in ``ids``."""
    starts = np.cumsum(sizes) - sizes
    counts = sizes[numbers]
    until = np.cumsum(counts)
    at = np.repeat(starts[numbers] - (until - counts), counts)
    at += np.arange(len(at))
    return ids[at], until


class ChunkEncoder:
    """Encodes whole texts with a tokenizer, asking it once for what a text repeats.

    With a byte-level pre-tokenizer and no normaliser no token reaches from visible characters into the white space
    after them, so a text may be cut before any run of white space. The chunks are looked up, and unknown ones are
    encoded together, many to a call. Other tokenizers get the whole text.
    """

    def __init__(self, tokenizer_json: str, size: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
        tokenizer = Tokenizer.from_str(tokenizer_json)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.tokenizer, self.size = tokenizer, size
        self.chunked = splits_at_blanks(tokenizer_json)
        # Chunks that open with one blank are kept without it; those that open a text or with other white space are
        # in ``others`` as they are.
        self.after_blank, self.older = Chunks(), Chunks()
        self.others = RecentCache(lambda chunk: self.whole(chunk).tobytes(), size // 8)
        vocabulary = tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        for token, number in vocabulary.items():
            # How the byte-level alphabet writes a blank and a line feed.
            self.opens[number] = token.startswith(("Ġ", "Ċ"))

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def learnt(self, chunks: list[str]) -> np.ndarray:
        """The numbers of the distinct ``chunks``; those not seen before are encoded together."""
        found = self.after_blank.numbers(chunks)
        missing = np.flatnonzero(found < 0)
        if len(self.after_blank.number) + len(missing) > self.size:
            self.older, self.after_blank = self.after_blank, Chunks()
            self._take_over(chunks, found, np.flatnonzero(found >= 0), found)
        if not len(missing):
            return found
        before = np.full(len(chunks), -1)
        before[missing] = self.older.numbers([chunks[i] for i in missing.tolist()])
        self._take_over(chunks, found, np.flatnonzero(before >= 0), before)
        new = missing[before[missing] < 0]
        if not len(new):
            return found
        names = [chunks[i] for i in new.tolist()]
        ids = self.whole((" " + " ".join(names)).replace(" \n", "\n"))
        starts = np.flatnonzero(self.opens[ids])
        if len(starts) == len(names):
            sizes = np.diff(starts, append=len(ids))
        else:
            parts = [self.whole(c if c[:1] == "\n" else " " + c) for c in names]
            ids, sizes = np.concatenate(parts), np.array([len(p) for p in parts])
        found[new] = self.after_blank.add(names, ids, sizes)
        return found

    def _take_over(self, chunks: list[str], found: np.ndarray, places: np.ndarray, older: np.ndarray) -> None:
        """Moves the chunks at some places, which have the numbers ``older`` among the older ones, to those in use."""
        names, numbers = [chunks[i] for i in places.tolist()], older[places]
        ids, _ = joined(self.older.ids, self.older.sizes, numbers)
        found[places] = self.after_blank.add(names, ids, self.older.sizes[numbers])

    def plain(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of texts that can be cut at blanks and line feeds. Equal chunks are looked up once, then all ids are
        gathered at once."""
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        chunks = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        numbers = self.learnt(chunks)[codes]
        # What opens a text has no blank before it.
        first = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        opening = [np.frombuffer(self.others[chunks[c]], "<u4") for c in codes[first].tolist()]
        known = self.after_blank
        numbers[first] = len(known.sizes) + np.arange(len(first))
        sizes = np.concatenate((known.sizes, [len(ids) for ids in opening]))
        ids, until = joined(np.concatenate((known.ids, *opening)), sizes, numbers)
        stops = until[ends - 1]
        for start, stop in zip([0, *stops[:-1].tolist()], stops.tolist()):
            yield ids[start:stop].tobytes()

    def encode_batch(self, texts: pa.Array | list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not self.chunked:
            yield from (self.whole(t).tobytes() for t in texts.to_pylist())
            return
        if not len(texts):
            return
        size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        cuts = np.unique(np.searchsorted(size, np.arange(0, size[-1] + 1, PIECE_BYTES))).tolist()
        for start, stop in zip(cuts, [*cuts[1:], len(texts)]):
            piece = texts.slice(start, stop - start)
            odd = pc.or_(pc.match_substring_regex(piece, NOT_PLAIN), pc.equal(pc.binary_length(piece), 0))
            found = self.plain(piece.filter(pc.invert(odd))) if not pc.all(odd).as_py() else iter(())
            for place, other in enumerate(odd.to_pylist()):
                yield b"".join(map(self.others.__getitem__, RUNS.findall(piece[place].as_py()))) if other else next(found)


def splits_at_blanks(tokenizer_json: str) -> bool:
    spec = json.loads(tokenizer_json)
    before = spec.get("pre_tokenizer") or {}
    return (
        before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        and spec.get("normalizer") is None
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) or not t["content"]
                    for t in spec.get("added_tokens", []))
    )


# ---------------------------------------------------------------- Spark


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int | None, *, doc_id: str = "doc_id",
    text: str = "text", file_ids: int = FILE_IDS, block: int = BLOCK_IDS, task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Writes the ids of all documents in ascending order of ``doc_id`` (a whole number); returns the manifest."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        model = spark.sparkContext.broadcast(f.read())
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("body")
    ).withColumn("tie", F.xxhash64("body"))
    # A task of some size meets most of its words before. The tie parts rows that repeat an id.
    size = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    rows = rows.repartitionByRange(size // task_bytes + 1, F.col("doc").asc_nulls_first(), "tie")
    rows = rows.sortWithinPartitions(F.col("doc").asc_nulls_first(), "tie", "body").drop("tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(model.value)
        end = b"" if end_id is None else struct.pack("<I", end_id)
        part, lines, writer, path = TaskContext.get().partitionId(), [], None, None

        def close() -> None:
            writer.close()
            lines.append((part, len(lines), path, len(writer.docs), writer.ids, writer.at))

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode_batch(batch.column(1))):
                if writer is None:
                    path, out = create(folder, ".pfor")
                    writer = PforWriter(out, block)
                writer.add(doc, np.frombuffer(ids + end, "<u4"))
                if writer.ids >= file_ids:
                    close()
                    writer = None
        if writer is not None:
            close()
        if lines:
            yield batch_of(manifest, *zip(*lines))

    manifest = pa.schema([
        ("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("ids", pa.int64()),
        ("bytes", pa.int64()),
    ])
    return written(rows.mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: ``doc_id, start`` (ids of all documents before it) ``, ids`` (little-endian bytes)."""
    # One row a file; the ids before each file. The manifest is metadata, a line for millions of ids.
    order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("base", F.coalesce(F.sum("ids").over(order), F.lit(0).cast("long")))
    files = spread(placed.select("path", "base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with reader(path) as source:
                    rows, held = [], 0
                    for doc, start, ids in PforReader(source).documents():
                        rows.append((doc, base + start, ids.astype("<u4").tobytes()))
                        held += len(ids)
                        if held >= 1 << 20:
                            yield batch_of(schema, *zip(*rows))
                            rows, held = [], 0
                    if rows:
                        yield batch_of(schema, *zip(*rows))

    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])
    return files.mapInArrow(read, "doc_id long, start long, ids binary")


def token_round_trip(docs: DataFrame, tokenizer_path: str, end_id: int | None, **options) -> DataFrame:
    folder = scratch_path(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, folder, tokenizer_path, end_id, **options))
