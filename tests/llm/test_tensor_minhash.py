import random
import re

import numpy as np
from hypothesis import given, settings, strategies as st

from flowlab.llm import tensor_minhash
from flowlab.llm.components import components, with_least
from flowlab.llm.queries import QUERIES
from flowlab.llm.tensor_minhash import deduplicated, forest, linked, near_duplicates, shingles
from flowlab.llm.words import spaced_words, word_hashes

SF_DIR = "/root/testdata/sf0.001"


def shingle_set(text):
    w = re.findall(r"[^ \t-\r]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i:i + 4]) for i in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """Component of each row by comparing every pair of texts."""
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                up[find(i)] = find(j)
    names = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            names[find(i)] = min(d, names.get(find(i), d))
    return [(d, len(s), names.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def test_whole_table_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = QUERIES["op4_tensor_minhash"](spark, SF_DIR)
    assert found(got) == sorted(brute(rows), key=str)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())


def planted(seed=3, groups=12, copies=14):
    """Groups of copies with a few words changed, exact copies, and texts that share a passage."""
    rng = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = []
    for g in range(groups):
        base = [f"g{g}w{rng.randrange(5000)}" for _ in range(120)]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randrange(7)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
            texts.append(" ".join(words))
        texts += [texts[-1]] * 3 + [passage + " " + " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(90))]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_planted_groups_whole_and_in_tiles(spark):
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(brute(rows), key=str)
    assert found(near_duplicates(docs)) == want
    assert found(near_duplicates(docs, tile=4)) == want


ODD = [
    (5, "a b c d e f"), (3, "A b  C\td e f"), (3, "other words are here now"), (9, None), (8, ""), (7, " \n "), (None, "a b c d e f"),
    (11, "x y"), (12, "X Y"), (12, "x y"), (13, "y x"), (14, "w " * 40_000), (None, None), (None, "only here and nowhere else"),
]


def test_edges(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "1 as component", "2 as row", "3 as raw")
    assert found(near_duplicates(docs)) == sorted(brute(ODD), key=str)
    assert near_duplicates(docs.limit(0)).count() == 0
    kept = deduplicated(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([
        (3, "A b  C\td e f"), (3, "other words are here now"), (9, None), (8, ""), (7, " \n "), (11, "x y"), (13, "y x"),
        (14, "w " * 40_000), (None, None), (None, "only here and nowhere else"),
    ], key=str)


def test_repeated_rows_leave_one(spark):
    docs = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (2, "a b c d e"), (4, "k l m n o"), (4, "k l m n o")], "doc_id long, text string")
    assert sorted(tuple(r) for r in deduplicated(docs).collect()) == [(1, "a b c d e"), (4, "k l m n o")]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 12), max_size=12), min_size=1, max_size=8))
def test_linked_is_exact(sets):
    sets = [np.unique(np.array(s, np.uint64)) for s in sets]
    near = linked(sets, 80)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            if i == j:
                continue
            assert near[i, j] == (100 * both >= 80 * (len(a) + len(b) - both))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.lists(st.tuples(st.integers(0, 8), st.integers(0, 8)), max_size=10))
def test_forest(n, pairs):
    near = np.eye(n, dtype=bool)
    for a, b in pairs:
        if a < n and b < n:
            near[a, b] = near[b, a] = True
    reach = np.linalg.matrix_power(near.astype(int), n) > 0
    assert forest(near).tolist() == [int(np.flatnonzero(r)[0]) for r in reach]


def test_shingles_are_distinct_and_ordered():
    cache = word_hashes()
    assert len(shingles(spaced_words("a b a b a b a b"), cache)) == 2
    assert len(shingles(spaced_words("a b c"), cache)) == 1
    assert shingles(spaced_words("a b"), cache) != shingles(spaced_words("b a"), cache)
    assert len(shingles([], cache)) == 0


def test_components_of_paths_and_stars(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(2000 + rng.randrange(40), 2000 + rng.randrange(40)) for _ in range(25)]
    rng.shuffle(edges)
    edges = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in edges]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    joined = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in joined}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_hubs_and_other_nodes_find_their_least_neighbour(spark):
    # Node 0 is a hub; nodes 10,000 and up have two edges each, fewer than a 1,024th of all.
    rows = [(0, v) for v in range(1, 3000)] + [(u, u + d) for u in range(10_000, 12_000) for d in (7, 5)]
    edges = spark.createDataFrame(rows, "u long, v long")
    joined, low = with_least(edges, len(rows))
    least = {u: min(v for x, v in rows if x == u) for u in (0, 10_000, 11_999)}
    got = {(r.u, r.v): r.m for r in joined.collect()}
    assert sorted(got) == sorted(rows)
    assert all(m == (1 if u == 0 else u + 5) for (u, _), m in got.items())
    assert {u: m for u, m in ((r.u, r.m) for r in low.collect()) if u in least} == least


def test_components_around_hubs(spark):
    # Two stars joined by one path, and pairs of their own; a null end and a repeated edge change nothing.
    edges = [(50_000, v) for v in range(2, 2500)] + [(60_000, v) for v in range(3000, 5000)] + [(2499, 70_000), (70_000, 3000)]
    edges += [(u, u + 1) for u in range(100_000, 104_000, 2)] + [(50_000, 2), (None, 5), (5, None)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    joined = {50_000, 60_000, 70_000, *range(2, 2500), *range(3000, 5000)}
    assert got == {n: 2 for n in joined} | {n: n - n % 2 for n in range(100_000, 104_000)}


def test_rows_of_a_key_are_linked_to_the_smallest_by_one_shuffle(spark):
    rows = [(5, [1, 2], [7, 8]), (3, [1, 9], [7, 6]), (9, [4, 2], [5, 8]), (4, [0, 0], [0, 0]), (7, [1, 2], [7, 8])]
    reps = spark.createDataFrame(rows, "node long, left array<long>, right array<long>")
    found = tensor_minhash.table_links(reps)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 2
    assert sorted(map(tuple, found.collect())) == [(3, 5), (3, 7), (5, 7), (5, 9)]
