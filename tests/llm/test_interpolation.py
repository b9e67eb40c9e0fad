import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from flowlab.llm import interpolation
from flowlab.llm.interpolation import (
    PAIRS, WORDS, Block, Looked, Totals, em_weights, packed, pair_bytes, pair_numbers, scored, slices,
)
from flowlab.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def tokens(text):
    return re.findall(r"[^ \t-\r]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) + [None]


def crc(doc):
    return None if doc is None else zlib.crc32(str(doc).encode())


def model(rows, counted):
    words, pairs, texts = Counter(), Counter(), 0
    for d, t in rows:
        if counted(crc(d)):
            texts += 1
            w = tokens(t)
            words.update(w)
            pairs.update(zip(["^", *w], w))
    context = Counter({w: n for w, n in words.items() if w is not None})
    context["^"] = texts
    return words, pairs, context, sum(words.values()), len(words)


def parts(m, h, w):
    words, pairs, context, n, v = m
    c = context[h]
    return (c.bit_length(), pairs[h, w] / c if c else 0.0, words[w] / max(1, n), 1 / (v + 1))


def brute(rows):
    test = lambda c: c is not None and c % 10 == 0
    tune = lambda c: c is not None and not test(c) and c // 10 % 10 == 0
    fit = model(rows, lambda c: not test(c) and not tune(c))
    everything = model(rows, lambda c: not test(c))
    cells = []
    step = lambda p: round(-8 * math.log2(p)) if p > 0 else -1
    for d, t in rows:
        if tune(crc(d)):
            w = tokens(t)
            for h, x in zip(["^", *w], w):
                b, p2, p1, _ = parts(fit, h, x)
                cells.append((b, step(p2), step(p1), 1))
    weights = em_weights(np.array(cells, np.int64).reshape(-1, 4), 1 / (fit[4] + 1))
    words, _, _, n, v = everything
    out = []
    for d, t in rows:
        w = tokens(t)
        score = 0.0
        for h, x in zip(["^", *w], w):
            b, *p = parts(everything, h, x)
            score += math.log10(sum(weights[b] * p))
        base = sum(math.log10((words[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        out.append((d, test(crc(d)), len(w), sum(words[x] > 0 for x in w), n, base, score))
    return out


def same(got, want):
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-6, abs=1e-9)


def test_whole_table_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = QUERIES["op7_deleted_interpolation"](spark, SF_DIR).collect()
    same(got, brute(rows))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_many_blocks_and_buckets(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60).collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    same(scored(docs, block_tokens=500, bucket_tokens=300).collect(), brute(rows))


@pytest.mark.parametrize("rows", [
    [(1, "A b a b"), (1, "A b a b"), (None, "b a"), (2, None), (3, ""), (4, "c " * 20_000)],
    [(i, "x y") for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:3],
    [(5, "")],
])
def test_edges(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as role", "2 as block", "3 as score")
    got = scored(docs).collect()
    same(got, brute(rows))
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)


def test_empty_table(spark):
    assert scored(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2 ** 64 - 1), max_size=30, unique=True), st.integers(3, 12))
def test_slices_hold_all_bits(numbers, bits):
    h = np.array(sorted(numbers), np.uint64)
    cuts = slices(h, bits)
    assert cuts[0] == 0 and cuts[-1] == len(h) and len(cuts) == (1 << bits) + 1
    for k, (s, e) in enumerate(zip(cuts, cuts[1:])):
        assert all(int(x) >> (64 - bits) == k for x in h[s:e])
        assert pair_numbers(pair_bytes(h[s:e], bits)).tolist() == [(int(x) << bits & (1 << 64) - 1) >> 24 for x in h[s:e]]


def test_em_finds_the_mixture():
    rng = np.random.default_rng(1)
    # Two outcomes that only one part allows tell the weights.
    cells = np.array([[5, 0, -1, 700], [5, -1, 0, 300]])
    w = em_weights(cells, 1e-9)
    assert w[5] == pytest.approx([0.7, 0.3, 0], abs=1e-3)
    assert np.allclose(w.sum(axis=1), 1) and (w[:, 2] > 0).all() and w[0, 0] == 0


def test_probabilities_are_worked_out_in_chunks(monkeypatch):
    monkeypatch.setattr(interpolation, "CHUNK_TOKENS", 3)
    ids = np.array([0, 1, 2, 0, 1, 2, 2], np.int32)
    b = Block(ids, np.array([4, 3]), np.array([5, 9, 12], np.uint64))
    answers = pa.table({
        "kind": pa.array([WORDS, PAIRS], pa.int32()), "bucket": pa.array([0, 0], pa.int32()),
        "fit": [packed(np.array([2, 2, 3], "<u4")), packed(np.ones(len(b.pairs()[0]), "<u4"))],
    })
    found = Looked(b, answers, 2, tune=False)
    totals = Totals(7, 3, 2)
    chunks = list(found.chunks())
    assert [len(found.word[c]) for c in chunks] == [3, 3, 1]
    whole = found.parts(slice(0, 7), totals)
    for i in (0, 1):
        assert np.concatenate([found.parts(c, totals)[i] for c in chunks]).tolist() == whole[i].tolist()
    assert np.concatenate([found.bucket(c) for c in chunks]).tolist() == found.bucket(slice(0, 7)).tolist()
