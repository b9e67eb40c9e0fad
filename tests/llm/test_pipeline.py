import hashlib

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from flowlab.llm.queries import QUERIES
from tests.llm.test_decontaminate import brute as window_hits
from tests.llm.test_tensor_minhash import brute as components

SF_DIR = "/root/testdata/sf0.001"


def test_rows_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    toxic = {r.doc_id for r in QUERIES["op5_fair_toxicity"](spark, SF_DIR).collect() if r.predicted}
    rows = [(r.doc_id, r.text) for r in docs if r.doc_id not in toxic]
    firsts = {d for d, _, c in components(rows) if d == c}
    rows = [(d, t) for d, t in rows if d in firsts and not window_hits(t, items)[1]]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for d, t in rows:
        ids = library.encode(t, add_special_tokens=False).ids
        want[d] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), ids)
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.ids) for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert got == want
    assert len(want) < len(docs)


ROWS = [
    (1, "a b c d e f g", "en", "s", 13), (2, "a b c d e f g", "en", "s", 13), (None, None, None, None, None), (4, "", "en", "s", 0),
    (4, "", "en", "s", 0), (5, "idiot scum moron trash", "en", "s", 1), (6, "word " * 50_000, "de", "s", 2),
]


def test_stages_keep_columns_and_clean_rows(spark):
    table = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long").selectExpr(
        "*", "1 as row", "2 as hits", "3 as score", "4 as label", "array(5) as ids"
    )
    for docs in (table, table.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before = docs
            docs = stage(spark, docs, SF_DIR)
            assert docs.columns == before.columns, name
        got = sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)
        if before.count():
            assert got == sorted([(1, ROWS[0][1]), (None, None), (4, ""), (4, ""), (6, ROWS[6][1])] + [(5, ROWS[5][1])] * ((5, ROWS[5][1]) in got), key=str)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == len(got)
