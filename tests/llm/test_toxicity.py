import random
import zlib

import numpy as np
import pyarrow as pa

from flowlab.llm.queries import QUERIES
from flowlab.llm.tables import pieces
from flowlab.llm.toxicity import Featurizer, ToxicityModel, featured, fitted, gradient, minimised, scored, without_toxic
from tests.plans import assert_absent

WORDS = [f"w{i}" for i in range(300)]
BAD = ["idiot", "scum", "moron"]


def corpus(rng, n):
    """Toxic texts insult, mostly one group; neutral texts seldom name it, so that the name alone looks guilty."""
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(WORDS) for _ in range(30)]
        toxic = int(rng.random() < 0.4)
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
            if rng.random() < 0.8:
                words.insert(5, "muslim")
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    return rows, labels


def test_swaps_take_the_weight_off_identity_terms(spark):
    rows, labels = corpus(random.Random(1), 400)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    texts = ["the muslim family met w1 w2", "the christian family met w1 w2", "you are scum and an idiot you moron", "w3 w4 w5"]
    scores = {}
    for penalty in (0.0, 10.0):
        model = fitted(docs, marks, swap_penalty=penalty, bits=14)
        scores[penalty] = model.scores(texts, Featurizer(14))
    free, tied = scores[0.0], scores[10.0]
    assert abs(tied[0] - tied[1]) < 0.25 * abs(free[0] - free[1])
    assert tied[2] > 0.5 > tied[3]


def test_swapped_sentences():
    f = Featurizer(14)
    changes = list(f.swaps("a woman spoke. nobody else! one man, one woman"))
    assert len(changes) == 3
    model = ToxicityModel(np.zeros((1 << 14) + 1), 14)
    for places, values in changes:
        assert len(places) == len(values) > 0 and model.weights[places].sum() == 0
    assert list(f.swaps("plain text")) == []


def test_minimum_of_a_bowl():
    d = np.array([1.0, 30.0, 4.0])
    x = minimised(lambda w: (float(d @ (w - 2) ** 2), 2 * d * (w - 2)), np.zeros(3), 50, tolerance=1e-12)
    assert np.allclose(x, 2, atol=1e-3)


def test_a_gradient_is_one_job_and_the_sum_over_all_rows(spark):
    texts = ["the muslim family met w1 w2", "scum idiot scum", "w3 w4 w5 w5", "", "one man, one woman", "moron w1"]
    table = featured(spark.createDataFrame([(i % 2, t) for i, t in enumerate(texts)], "y int, body string"), 10, [("man", "woman"), ("muslim", "hindu")])
    table = table.repartition(3).localCheckpoint()
    weights = np.random.default_rng(1).normal(0, 0.1, (1 << 10) + 1)
    bus, tracker = spark.sparkContext._jsc.sc().listenerBus(), spark.sparkContext.statusTracker()

    def last_job() -> int:
        bus.waitUntilEmpty(10_000)
        return max(tracker.getJobIdsForGroup(None), default=-1)

    before = last_job()
    loss, change, g, s = gradient(table, weights)
    assert last_job() == before + 1
    want_loss, want_change, want_g, want_s = 0.0, 0.0, np.zeros(len(weights)), np.zeros(len(weights))
    for r in table.collect():
        places, values = np.frombuffer(r.places, "<u4"), np.frombuffer(r["values"], "<f4").astype(float)
        z = weights[places] @ values
        if r.y is None:
            want_change += z * z
            want_s[places] += 2 * z * values
        else:
            p = 1 / (1 + np.exp(-(z + weights[-1])))
            want_loss -= np.log(p if r.y else 1 - p)
            want_g[places] += (p - r.y) * values
            want_g[-1] += p - r.y
    assert want_s.any() and np.isclose(loss, want_loss) and np.isclose(change, want_change)
    assert np.allclose(g, want_g, atol=1e-12) and np.allclose(s, want_s, atol=1e-12)
    assert [v if np.isscalar(v) else v.tolist() for v in gradient(table.limit(0), weights)] == [0.0, 0.0, [0.0] * len(weights), [0.0] * len(weights)]


def test_held_out_rows_and_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = QUERIES["op5_fair_toxicity"](spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert len(rows) == docs
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [(r.predicted, toxic[r.doc_id]) for r in rows if r.held_out and r.doc_id in toxic]
    # A few per cent of the labels are wrong by design of the tables.
    assert sum(p == t for p, t in held) / len(held) > 0.96
    right = sum(p and t for p, t in held)
    assert right / sum(p for p, _ in held) > 0.95 and right / sum(t for _, t in held) > 0.7


def test_edges(spark):
    rows = [(1, "scum idiot"), (1, "scum idiot"), (2, None), (None, "scum"), (3, ""), (4, "w1 " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 as score", "1 as body", "2 as toxic")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    odd = spark.createDataFrame([(1, 1), (1, None), (None, 1), (99, 0), (3, 1)], "doc_id long, toxic int")
    for labels in (none, odd):
        model = fitted(docs, labels)
        got = scored(docs, model).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
        by_id = {r.doc_id: r.score for r in got}
        assert by_id[2] == by_id[3]
        assert without_toxic(docs, model, threshold=2.0).columns == docs.columns
        assert without_toxic(docs, model, threshold=2.0).count() == len(rows)
        assert without_toxic(docs, model, threshold=0.0).count() == 0
    assert fitted(docs, none).scores(["x"], Featurizer())[0] < 0.3
    assert scored(docs.limit(0), fitted(docs.limit(0), odd)).count() == 0


def test_texts_travel_once_and_numbers_are_read_as_texts(spark):
    model = ToxicityModel(np.zeros((1 << 18) + 1))
    docs = spark.createDataFrame([(i, f"w{i}") for i in range(3000)], "doc_id long, text string")
    kept = without_toxic(docs, model, threshold=0.6)
    assert_absent(kept, "body")
    assert sorted(map(tuple, kept.collect())) == sorted((i, f"w{i}") for i in range(3000))
    numbers = spark.createDataFrame([(1, 5)], "doc_id long, text int")
    assert [tuple(r) for r in without_toxic(numbers, model, threshold=0.6).collect()] == [(1, 5)]


def test_pieces_hold_all_rows_in_order():
    batch = pa.RecordBatch.from_pydict({"a": list(range(2500))})
    parts = list(pieces(batch, 1000))
    assert [p.num_rows for p in parts] == [1000, 1000, 500]
    assert [v for p in parts for v in p.column(0).to_pylist()] == list(range(2500))


def test_words_held_by_a_task_are_bounded():
    featurizer = Featurizer(bits=8)
    for i in range(250_000):
        featurizer.places[b"%d" % i]
    assert len(featurizer.places) + len(featurizer.places.old) <= 200_000
