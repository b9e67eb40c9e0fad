import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from flowlab.llm.pfor import ChunkEncoder, Chunks, PforReader, PforWriter, joined, pack_block, packed_bits, token_round_trip, unpack_block
from flowlab.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", " ", "a", "  a  b ", "x\n\n y", "tab\t end ", "don't  stop now 　 z", "<|endoftext|> a <|endoftext|>b", " \x1c a \x85 b", "\U0001f600 été 12 345!", "a \n", "end  "]


class Memory:
    def __init__(self, data):
        self.data = data

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        return self.data[at:at + n]


def stored(docs, block):
    out = io.BytesIO()
    data = {}
    out.close = lambda: data.setdefault("v", out.getvalue())
    w = PforWriter(out, block)
    for d, ids in docs:
        w.add(d, np.array(ids, "<u4"))
    w.close()
    return data["v"]


numbers = st.lists(st.one_of(st.integers(0, 60), st.integers(0, 2 ** 32 - 1)), min_size=1, max_size=300)


@settings(max_examples=200, deadline=None)
@given(numbers)
def test_block_round_trip(values):
    ids = np.array(values, np.uint32)
    assert unpack_block(pack_block(ids), len(ids)).tolist() == values


def test_exceptions_keep_blocks_narrow():
    ids = np.full(4096, 1000, np.uint32)
    ids[::1000] = 4_000_000_000
    assert len(pack_block(ids)) < 100


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-9, 9)), st.lists(st.integers(0, 50_000), max_size=40)), max_size=20), st.sampled_from([1, 7, 64]))
def test_file_round_trip(docs, block):
    r = PforReader(Memory(stored(docs, block)))
    assert [(d, ids.tolist()) for d, _, ids in r.documents(step=16)] == docs
    flat = [i for _, ids in docs for i in ids]
    assert r.span(len(flat) // 3, len(flat)).tolist() == flat[len(flat) // 3:]


def test_cut_file_is_refused():
    with pytest.raises(ValueError):
        PforReader(Memory(stored([(1, [1, 2, 3])], 4)[:-3]))


def test_chunks_encode_as_whole_texts():
    tokenizer = Tokenizer.from_file(PATH)
    with open(PATH, encoding="utf-8") as f:
        encoder = ChunkEncoder(f.read(), size=5)
    texts = [*TEXTS, "one two\nthree two\n\nfour", "two\nthree"]
    for _ in range(2):
        for text, ids in zip(texts, encoder.encode_batch(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab'1 \n\t é!<|"), max_size=25))
def test_chunks_encode_any_white_space(text):
    assert np.frombuffer(next(iter(ENCODER.encode_batch([text]))), "<u4").tolist() == ENCODER.tokenizer.encode(text, add_special_tokens=False).ids


ENCODER = ChunkEncoder(open(PATH, encoding="utf-8").read())


def brute(docs):
    tokenizer = Tokenizer.from_file(PATH)
    at, rows = 0, []
    for doc, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        rows.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return rows


def test_whole_table_against_the_library(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()]
    got = [tuple(r) for r in QUERIES["op10_pfor_tokens"](spark, SF_DIR).orderBy("start").collect()]
    assert got == brute(docs)


def test_edges(spark):
    rows = [(3, "b"), (None, "z"), (3, "a"), (1, None), (3, "a"), (-5, ""), (2, "word " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as start", "2 as ids")
    got = token_round_trip(docs, PATH, 2, file_ids=4, block=2).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, -5, 1, 2, 3, 3, 3]
    assert [len(r.ids) // 4 for r in got][1:3] == [1, 1]
    assert got[-1].start + len(got[-1].ids) // 4 == sum(len(r.ids) // 4 for r in got)
    assert token_round_trip(docs.limit(0), PATH, 2).count() == 0


@settings(max_examples=100, deadline=None)
@given(numbers, st.integers(1, 32))
def test_packed_bits_are_those_of_the_values(values, width):
    low = [v & ((1 << width) - 1) for v in values]
    want = sum(v << (i * width) for i, v in enumerate(low)).to_bytes((len(low) * width + 7) // 8, "little")
    assert packed_bits(np.array(values, np.uint32), width) == want


def test_chunks_keep_their_numbers_and_ids():
    chunks = Chunks()
    assert chunks.numbers(["a"]).tolist() == [-1]
    assert chunks.add(["a", "b"], np.array([5, 6, 7], "<u4"), np.array([1, 2])).tolist() == [0, 1]
    assert chunks.add(["c"], np.array([8], "<u4"), np.array([1])).tolist() == [2]
    ids, ends = joined(chunks.ids, chunks.sizes, chunks.numbers(["c", "b", "a", "b"]))
    assert (ids.tolist(), ends.tolist()) == ([8, 6, 7, 5, 6, 7], [1, 3, 4, 6])
