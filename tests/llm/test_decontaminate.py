import hashlib
import re

from hypothesis import given, settings, strategies as st

from flowlab.llm.decontaminate import Matcher, contamination, matched, window_items, without_contaminated
from flowlab.llm.queries import QUERIES
from tests.plans import assert_absent

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SF_DIR = "/root/testdata/sf0.001"


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window=10):
    doc = words(text)
    hit, names = set(), set()
    for item, body in items:
        w = words(body)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            part = w[i:i + window]
            for j in range(len(doc) - len(part) + 1):
                if doc[j:j + len(part)] == part:
                    hit.update(range(j, j + len(part)))
                    names.add(str(item))
    return len(doc), len(hit), sorted(names)


def test_whole_table_against_brute_force(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    got = {r.doc_id: r for r in QUERIES["op2_decontaminate"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs:
        n, hit, names = brute(r.text, items)
        g = got[r.doc_id]
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        assert (g.n_words, g.n_hit, g.n_items, g.items_sha256, g.contaminated) == (n, hit, len(names), digest, hit > 0)
    assert any(g.contaminated for g in got.values())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=6), max_size=5), st.lists(st.sampled_from("abcd"), max_size=25))
def test_automaton_finds_every_window(items, doc):
    items = [(str(i), " ".join(w)) for i, w in enumerate(items)]
    matcher = Matcher(items, 3)
    found = [(a, b, matcher.items_of[n]) for a, b, n in matcher.matches([w.encode() for w in doc])]
    hit = {k for a, b, _ in found for k in range(a, b + 1)}
    assert (len(hit), sorted({i for *_, ids in found for i in ids})) == brute(" ".join(doc), items, 3)[1:]


ROWS = [(1, "x A-b, c  d", "en"), (2, None, "en"), (3, "", None), (3, "", None), (None, "a b c", "s"), (4, "Été a b c z", "s"), (5, "b c", "s")]


def test_edges_blocks_and_spans(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, hits string")
    items = spark.createDataFrame([(7, "a b c"), (8, "A B C"), (9, None), (10, ""), (11, "c d"), (12, "b")], "item_id int, text string")
    for block_words in (10 ** 6, 1):
        rows = contamination(docs, items, window=3, block_words=block_words).collect()
        got = sorted(((r.doc_id, r.n_words, r.n_hit, sorted(r["items"]), r.contaminated) for r in rows), key=str)
        want = sorted([
            (1, 5, 4, ["11", "12", "7", "8"], True), (2, 0, 0, [], False), (3, 0, 0, [], False), (3, 0, 0, [], False),
            (None, 3, 3, ["12", "7", "8"], True), (4, 5, 3, ["12", "7", "8"], True), (5, 2, 1, ["12"], True),
        ], key=str)
        assert got == want
    row = matched(docs.filter("doc_id = 4"), items, window=3, keep=["text"]).first()
    spans = {row.text.encode()[h.start:h.stop].decode() for h in row.hits}
    assert spans == {"a b c", "b"}


def test_items_without_an_id_and_shared_windows(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "w " * 500), (3, "z")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "b c")] + [(i, "w") for i in range(300)], "item_id int, text string")
    for block_words in (10 ** 6, 40):
        got = {r.doc_id: r for r in contamination(docs, items, window=2, block_words=block_words).collect()}
        assert (got[1].n_hit, got[1].n_items, got[1].contaminated) == (2, 0, True)
        assert got[2].n_hit == 500 and got[2]["items"] == sorted(map(str, range(300))) and not got[3].contaminated
        names = {r.window: (r.words, r["items"]) for r in window_items(items, window=2, block_words=block_words).collect()}
        assert {n for h in got[1].hits for n in names[h.window][0]} == {"b", "c"}
        assert {i for h in got[2].hits for i in names[h.window][1]} == set(map(str, range(300)))


def test_filter_keeps_columns_and_clean_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, hits string")
    items = spark.createDataFrame([(7, "a b c")], "item_id int, text string")
    clean = without_contaminated(docs, items, window=3)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [2, 3, 3, 5]
    assert without_contaminated(docs, items.limit(0)).count() == len(ROWS)
    assert without_contaminated(docs.limit(0), items).count() == 0


def test_texts_travel_once_and_numbers_are_read_as_texts(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "x")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "a b c"), (8, "5")], "item_id int, text string")
    clean = without_contaminated(docs, items, window=3)
    assert_absent(clean, "body")
    assert [tuple(r) for r in clean.collect()] == [(2, "x")]
    numbers = spark.createDataFrame([(1, 5), (2, 6)], "doc_id long, text int")
    assert [tuple(r) for r in without_contaminated(numbers, items).collect()] == [(2, 6)]
