import hashlib
import json

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from flowlab.llm.bpe import BpeEncoder, BpeModel, byte_alphabet, decoded, encoded, round_trip_digests
from flowlab.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
SPEC = json.load(open(PATH, encoding="utf-8"))
ENCODER = BpeEncoder(BpeModel(SPEC), size=50)

TEXTS = [
    "", " ", "\n", "a", "  a  b ", "x\n\n y", "tab\t end ", "don't  stop now 　 z", "<|endoftext|> a <|endoftext|>b",
    "\U0001f600 été 12 345!", "a \n", "end  ", "aaaaaaaaaaaaaaaaaaaaaaaaa", "the thing " * 3, "<|endoftext|", "\x00\x1c\x85",
]


def expected(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", TEXTS)
def test_as_the_library(text):
    for _ in range(2):
        assert ENCODER.encode(text) == expected(text)
    assert ENCODER.decode(expected(text)) == LIBRARY.decode(expected(text), skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(min_codepoint=0, max_codepoint=0x2FF), st.sampled_from(" \n\t'sthe")), max_size=40))
def test_any_text(text):
    ids = ENCODER.encode(text)
    assert ids == expected(text)
    assert ENCODER.decode(ids) == text


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=12))
def test_any_ids_decode(ids):
    assert ENCODER.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_alphabet_is_one_to_one():
    assert len(set(byte_alphabet())) == 256


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        BpeModel({**SPEC, "normalizer": {"type": "Lowercase"}})


def test_whole_table_against_the_library(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op8_bpe_round_trip"](spark, SF_DIR).collect()}
    assert len(got) == len(docs)
    for r in docs:
        ids = expected(r.text)
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        assert tuple(got[r.doc_id])[1:] == want


def test_edges(spark):
    rows = [(1, None, 5), (None, "", 6), (2, "a b", 7), (2, "a b", 7), (3, "word " * 60_000, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    both = decoded(encoded(docs, PATH), PATH)
    assert both.columns == ["doc_id", "text", "n_tokens", "ids", "decoded"]
    for r in both.collect():
        assert r.ids == expected(r.text or "") and r.decoded == (r.text or "")
    assert encoded(docs.limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        encoded(docs.withColumnRenamed("n_tokens", "IDS"), PATH)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("aehinorst 'é1."), min_size=1, max_size=32).map(lambda t: t.encode()[:32]))
def test_short_and_long_pieces_merge_alike(piece):
    model = ENCODER.model
    assert model.merged(piece) == model._merged_long([model.first[b] for b in piece])


def test_short_pieces_need_no_heap(monkeypatch):
    encoder = BpeEncoder(ENCODER.model)
    monkeypatch.setattr("heapq.heapify", None)
    assert encoder.encode("some words, 12 of them\nare short.") == expected("some words, 12 of them\nare short.")


def test_ids_go_back_in_pieces(spark, monkeypatch):
    caught = []
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, schema: caught.append(f))
    round_trip_digests(docs, PATH, with_ids=True)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(3000)), "body": [f"text {i}" for i in range(3000)]})
    found = list(caught[0](iter([batch])))
    assert max(b.num_rows for b in found) <= 1024
    assert [i for b in found for i in b.column("ids").to_pylist()] == [expected(f"text {i}") for i in range(3000)]
