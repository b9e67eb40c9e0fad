import numpy as np

from flowlab.llm.nn_descent import best, nearest
from flowlab.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def brute(rows, queries, k):
    ids = [i for i, _ in rows]
    out = {}
    for q, x in queries:
        scored = []
        for i, y in zip(ids, (v for _, v in rows)):
            if i != q:
                s = 0.0
                for a, b in zip(x, y):
                    s += a * b
                scored.append((-s, i))
        out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def grouped(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_recall_and_scores_of_the_whole_table(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    want = brute(rows, [r for r in rows if r[0] % 20 == 0], 20)
    got = grouped(QUERIES["op3_nn_descent"](spark, SF_DIR))
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.9
    exact = {q: dict(brute(rows, [(q, dict(rows)[q])], len(rows))[q]) for q in list(want)[:3]}
    assert all(s == exact[q][i] for q in exact for i, s in got[q])


def test_edges(spark):
    rng = np.random.default_rng(0)
    same = [1.0, 2.0, 3.0]
    rows = [(i, rng.normal(size=3).tolist()) for i in range(30)] + [(100 + i, same) for i in range(40)] + [(100, same)]
    odd = [(200, None), (201, [0.0, 0.0, 0.0]), (202, [1.0, None, 2.0]), (203, [float("nan"), 1.0, 1.0]), (204, [float("inf"), 1.0, 1.0]), (205, [1.0]), (None, same)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").selectExpr("*", "1 as score", "2 as node")
    queries = table.filter("vec_id in (0, 7, 100, 139, 200, 201, 202, 203, 204, 205)")
    distinct = list(dict((i, v) for i, v in rows).items())
    want = brute(distinct, [(i, v) for i, v in distinct if i in (0, 7, 100, 139)], 25)
    got = grouped(nearest(table, queries, neighbours=25))
    assert got == want
    assert nearest(table.limit(0), queries).count() == 0
    assert nearest(table, queries.limit(0)).count() == 0
    few = grouped(nearest(table.filter("vec_id < 3"), table.filter("vec_id = 1")))
    assert [i for i, _ in few[1]] == [i for i, _ in brute(rows[:3], [rows[1]], 20)[1]]


def test_queries_outside_of_the_table(spark):
    rows = [(i, np.random.default_rng(i).normal(size=4).tolist()) for i in range(80)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = spark.createDataFrame([(500, [1.0, 0.0, 0.5, 0.0])], "vec_id long, embedding array<double>")
    assert grouped(nearest(table, asked, neighbours=5)) == brute(rows, [(500, [1.0, 0.0, 0.5, 0.0])], 5)


def test_one_id_with_two_vectors_has_the_lesser(spark):
    rows = [(1, [2.0, 9.0]), (1, [1.0, 5.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [0.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = table.filter("vec_id < 3")
    assert grouped(nearest(table, asked)) == {1: [(3, 10.0), (2, 6.0)], 2: [(1, 6.0), (3, 2.0)]}


def test_copies_start_at_their_class_and_the_search_goes_on_until_nothing_is_open(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(3000, 16)).tolist())]
    rows += [(10_000 + i, rows[i][1]) for i in range(0, 3000, 50)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = [r for r in rows if r[0] >= 10_000]
    got = grouped(nearest(table, table.filter("vec_id >= 10000"), neighbours=10, k=16, pool=40, opened=1))
    want = brute(rows, asked, 10)
    assert got.keys() == want.keys()
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want]) >= 0.95
    assert all((q - 10_000) in {i for i, _ in got[q]} for q in want if (q - 10_000) in {i for i, _ in want[q]})


def test_equal_queries_get_equal_lists(spark):
    rows = [(i, v) for i, v in enumerate(np.random.default_rng(4).normal(size=(200, 8)).tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = spark.createDataFrame([(q, rows[5][1]) for q in (5, 900, 901)], "vec_id long, embedding array<double>")
    assert grouped(nearest(table, asked, neighbours=6)) == brute(rows, [(q, rows[5][1]) for q in (5, 900, 901)], 6)


def test_best():
    u, v, s = np.array([1, 1, 1, 2]), np.array([5, 4, 5, 9]), np.array([0.5, 0.5, 0.9, 0.1])
    assert [a.tolist() for a in best(u, v, s, 2)] == [[1, 1, 2], [4, 5, 9], [0.5, 0.5, 0.1]]
