import numpy as np
import pandas as pd
import pytest

from flowlab.operators import profile
from flowlab.operators.profile import class_share, corr_matrix, histogram, value_counts

NAN, INF = float("nan"), float("inf")


def test_histogram_equals_numpy(spark):
    rng = np.random.default_rng(0)
    values = rng.normal(size=500)
    df = spark.createDataFrame(pd.DataFrame({"v": values, "w": np.arange(500)}))
    for c, data in (("v", values), ("w", np.arange(500))):
        want, edges = np.histogram(data, bins=30)
        rows = sorted(r for r in histogram(df, [c]).collect())
        assert [r.n for r in rows] == list(want)
        assert np.allclose([r.lower for r in rows], edges[:-1]) and np.isclose(rows[-1].upper, edges[-1])


def test_histogram_of_constants_and_gaps(spark):
    df = spark.createDataFrame(
        [(3.0, None, 1, "x"), (3.0, None, 2, "y"), (NAN, None, 2, "z"), (INF, None, None, "z")], "c double, n double, i int, s string"
    )
    rows = histogram(df, bins=4).collect()
    got = {c: [r.n for r in sorted(rows) if r.column_name == c] for c in ("c", "i", "n")}
    assert got == {"c": [0, 0, 2, 0], "i": [1, 0, 0, 2], "n": []}


def test_value_counts_and_share(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", None, 2), ("b", "x", 3)], "s string, t string, i int")
    assert sorted(tuple(r) for r in value_counts(df).collect()) == [("s", "a", 2), ("s", "b", 1), ("t", "x", 2)]
    shares = {r.t: (r.n, r.share) for r in class_share(df, "t").collect()}
    assert shares == {"x": (2, 100.0)}


def pandas_corr(frame):
    with np.errstate(all="ignore"):
        return frame.corr()


def test_corr_of_a_pair_does_not_depend_on_other_columns(spark):
    rows = [
        (1e8 + i % 2, i % 2 + 0.1 * (i % 7), float(i), i % 3, 2 * i) if i < 50 else (-1e8, None, float(i), 1, 5)
        for i in range(100)
    ]
    df = spark.createDataFrame(rows, "a double, b double, c double, d int, e int").repartition(5)
    want = np.corrcoef(np.array([r[:2] for r in rows[:50]], float).T)[0, 1]
    for columns in (["a", "b"], list("abcde")):
        got = {(r.column_a, r.column_b): r["corr"] for r in corr_matrix(df, columns).collect()}
        assert got["a", "b"] == pytest.approx(want, abs=1e-8)


def test_corr_without_common_rows(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (None, 3.0)], "a double, b double")
    got = {(r.column_a, r.column_b): r["corr"] for r in corr_matrix(df).collect()}
    assert got["a", "b"] is None and got["a", "a"] == pytest.approx(1)
    assert {r["corr"] for r in corr_matrix(df.limit(0)).collect()} == {None}


def test_corr_is_pairwise_complete(spark):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame(rng.normal(size=(300, 4)) + [1e6, 0, 5, -3], columns=list("abcd"))
    frame["b"] += frame["d"] * 0.5
    frame.loc[rng.random(300) < 0.3, "a"] = np.nan
    frame.loc[rng.random(300) < 0.3, "b"] = np.nan
    frame["k"] = 4.2
    want = pandas_corr(frame)
    df = spark.createDataFrame(frame).repartition(3)
    got = {(r.column_a, r.column_b): r["corr"] for r in corr_matrix(df).collect()}
    assert len(got) == 25
    for (a, b), v in got.items():
        if "k" in (a, b):
            assert v is None
        else:
            assert np.isclose(v, want.loc[a, b], atol=1e-9)


def test_corr_with_infinity_is_unknown_only_where_it_counts(spark):
    frame = pd.DataFrame({"a": [1.0, 2.0, INF, 4.0], "b": [2.0, 1.0, NAN, 5.0], "c": [1.0, 5.0, 2.0, 3.0]})
    got = {(r.column_a, r.column_b): r["corr"] for r in corr_matrix(spark.createDataFrame(frame)).collect()}
    assert got["a", "c"] is None and got["a", "a"] is None
    assert np.isclose(got["a", "b"], frame[["a", "b"]].iloc[[0, 1, 3]].corr().iloc[0, 1])
