import math

import pytest
from pyspark.sql import functions as F

from flowlab.operators.clean import (
    FillProfile, clean_headers, constant_profile, drop_columns, drop_constant_columns, exclude_labels,
    fill_with_max, filter_nonzero, max_finite,
)
from tests.plans import assert_absent, plan_text

INF, NAN = float("inf"), float("nan")


def same(a, b):
    return (a is None and b is None) or a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


def test_headers(spark):
    df = spark.createDataFrame([(1, 2)], "` Label` int, `Flow Bytes/s` int")
    assert clean_headers(df).columns == ["Label", "Flow_Bytes/s"]


def test_header_clash(spark):
    with pytest.raises(ValueError, match="A"):
        clean_headers(spark.createDataFrame([(1, 2)], "` A` int, A int"))


def test_drop_ignores_missing_names(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, c int")
    assert drop_columns(df, ["a.b", "zzz"]).columns == ["c"]


def test_filter_nonzero(spark):
    df = spark.createDataFrame([(0, "1"), (1, "1"), (None, "1"), (2, "0.0"), (3, "x")], "p int, t string")
    assert [r.p for r in filter_nonzero(df, ["p"]).collect()] == [1, 2, 3]
    assert [r.p for r in filter_nonzero(df, ["p", "t"]).collect()] == [1]
    assert filter_nonzero(df, []) is df


def test_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).withColumn("p", F.col("id").cast("int")).withColumn("q", F.lit(1)).write.parquet(path)
    df = filter_nonzero(spark.read.parquet(path), ["p"]).select("p")
    text = plan_text(df)
    assert "Not(EqualTo(p,0))" in text and "ReadSchema: struct<p:int>" in text


def test_exclude_labels(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "` y` string")
    assert [r[0] for r in exclude_labels(df, " y", ["b"]).collect()] == ["a"]
    assert [r[0] for r in exclude_labels(df, " y").collect()] == ["a", "b"]


@pytest.mark.parametrize("kind", ["double", "string"])
def test_fill_with_max(spark, kind):
    values = [1.0, 5.0, INF, None, -INF, NAN]
    df = spark.createDataFrame([(v,) for v in values], "`v/s` double").coalesce(1)
    df = df.select(F.col("`v/s`").cast(kind))
    got = [r[0] for r in fill_with_max(df, ["v/s"]).collect()]
    assert all(same(a, b) for a, b in zip(got, [1.0, 5.0, 5.0, 5.0, -INF, NAN])), got


def test_fill_without_finite_values(spark):
    df = spark.createDataFrame([(None,), (INF,)], "v double")
    assert [r.v for r in fill_with_max(df, ["v"]).collect()] == [None, None]


def test_unreadable_text_is_filled(spark):
    df = spark.createDataFrame([("Infinity",), ("12.5",), ("n/a",)], "v string").coalesce(1)
    assert [r.v for r in fill_with_max(df, ["v"]).collect()] == [12.5, 12.5, 12.5]
    assert max_finite(df, ["v"]).first().v == 12.5


ROWS = [(7, 7, 7.0, None, 7, "x", True, {"k": 1}), (7, None, NAN, None, 8, "x", True, {"k": 1})]
SCHEMA = "a int, b int, c double, d int, e int, f string, g boolean, h map<string,int>"


def test_constant_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert drop_constant_columns(df).columns == ["d", "e"]
    flags = {r.column_name: r.is_constant for r in constant_profile(df).collect()}
    assert flags == dict(a=True, b=True, c=True, d=False, e=False, f=True, g=True, h=True)


def test_constant_profile_does_not_expand_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(ROWS, SCHEMA).drop("h").write.parquet(path)
    text = plan_text(constant_profile(spark.read.parquet(path)))
    # One expansion of the single result row is the unpivot; none feeds the aggregate.
    assert text.count("Expand") <= 1 and "count(distinct" not in text


@pytest.mark.parametrize("values", [
    [1.0, INF, None, 1.0], [1.0, 2.0, INF], [INF, None], [1.0, -INF, None], [-INF, INF], [NAN, 3.0, None], [None, None],
])
def test_one_pass_profile_equals_two_steps(spark, values):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v double, i int").coalesce(1)
    two_steps = drop_constant_columns(fill_with_max(df, ["v"]))
    one_pass = FillProfile.fit(df, ["v"]).transform(df)
    assert one_pass.columns == two_steps.columns
    for a, b in zip(one_pass.collect(), two_steps.collect()):
        assert all(same(x, y) for x, y in zip(a, b))


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert_absent(fill_with_max(filter_nonzero(df, ["a"]), ["c"]), "Python", "Arrow", "NestedLoop")
