import random
import re
import zlib
from collections import Counter

import pytest

from flowlab.llm import spelling
from flowlab.llm.tables import written
from tests.plans import assert_absent

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_by_hand(docs, modulus):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if modulus and h % modulus == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    """One inserted, deleted or replaced letter."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def groups_by_hand(words):
    rows, forms = {}, {}
    for w, n in words.items():
        others = [v for v in words if near(w, v)]
        best = min(others, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * n else None
        rows[w] = (n, len(others))
    result = set()
    for w, (n, k) in rows.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        result.add((w, forms[w], root, n, k, words[forms[w]] if forms[w] else None))
    return result


def rows_of(df):
    return [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]


def variants(rng, word):
    letters = "abeilnorstéÀß"
    i = rng.randrange(len(word))
    return rng.choice([word[:i] + word[i + 1:], word[:i] + rng.choice(letters) + word[i:], word[:i] + rng.choice(letters) + word[i + 1:]])


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(3)
    base = ["".join(rng.choice("abeilnorsté") for _ in range(rng.randint(4, 9))) for _ in range(60)] + ["aaaaa", "aaaaaa", "listen", "silent", "ÀÉeau", "X" * 3000]
    pool = [w for b in base for w in [b] * rng.randint(1, 12)]
    pool += [variants(rng, variants(rng, rng.choice(base)) if rng.random() < 0.3 else rng.choice(base)) for _ in range(900)]
    pool *= 2
    rng.shuffle(pool)
    made = [(i, " ".join(rng.choice([w, w.upper() if w.isascii() else w, w + ","]) for w in pool[i * 20: i * 20 + 20])) for i in range(len(pool) // 20)]
    return [*made, (900, None), (901, ""), (902, "1 2 -- \n"), (None, "listen listen silent"), made[0], made[0]]


@pytest.mark.parametrize("modulus", [None, 3, 97])
def test_equals_brute_force(spark, docs, modulus):
    df = spark.createDataFrame([(i, t, "w", 1) for i, t in docs], "doc_id long, text string, word string, n int").repartition(5)
    got = rows_of(spelling.spelling_variants(df, modulus=modulus))
    assert len(got) == len(set(got)) and set(got) == groups_by_hand(words_by_hand(docs, modulus))
    assert any(f for _, f, *_ in got)


def test_every_near_pair_meets(spark):
    """All words of up to five letters over two: every edit at every place."""
    words = ["".join("ab"[i >> j & 1] for j in range(k)) for k in range(2, 6) for i in range(1 << k)]
    df = spark.createDataFrame([(w, i + 3) for i, w in enumerate(words)], "word string, n long").repartition(3)
    got = [tuple(sorted((r.a, r.b))) for r in spelling.near_pairs(df).collect()]
    wanted = {tuple(sorted((a, b))) for a in words for b in words if a < b and near(a, b)}
    assert len(got) == len(set(got)) and set(got) == wanted


def test_long_chains_end_at_their_root(spark):
    chain = [("a" * 5 + "b" * i, 3 * 2**i) for i in range(14)]
    df = spark.createDataFrame(chain, "word string, n long")
    got = {r.word: r.root for r in spelling.variant_groups(df).collect()}
    assert set(got.values()) == {chain[-1][0]}


def test_nothing_gives_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_variants(df, modulus=97).count() == 0
    alone = spark.createDataFrame([(1, "alone alone alone")], "doc_id long, text string")
    assert rows_of(spelling.spelling_variants(alone)) == [("alone", None, "alone", 3, 0, None)]


def test_no_words_are_broadcast(spark, monkeypatch):
    """Files of words are small, but each word becomes 12 rows of keys: by its files Spark would send them all to the driver."""
    tables = []

    def watched(df, name):
        assert_absent(df, "Broadcast")
        tables.append(name)
        return written(df, name)

    monkeypatch.setattr(spelling, "written", watched)
    words = [("b" * 5 + "a" * i, 3 * 2**i) for i in range(9)] + [("".join("cdefg"[i // 5**j % 5] for j in range(5)), 3) for i in range(50)]
    df = written(spark.createDataFrame(words, "word string, n long"), "vocabulary")
    assert_absent(spelling.near_pairs(df), "Broadcast")
    got = spelling.variant_groups(df)
    assert_absent(got, "Broadcast")
    assert {"words", "near-words", "forms", "roots"} <= set(tables)
    rows = rows_of(got)
    assert len(rows) == len(words) and set(rows) == groups_by_hand(dict(words))
