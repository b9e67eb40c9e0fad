import pytest
from pyspark.sql import functions as F

from flowlab.operators import encode, star
from tests.plans import assert_absent


def table_of(mapping):
    return {r.value: r["index"] for r in mapping.table.collect()}


@pytest.fixture(params=["small", "large"])
def size(request, monkeypatch):
    if request.param == "large":
        monkeypatch.setattr(encode, "SMALL_TABLE_ROWS", 0)


def test_order_is_frequency_then_text(spark, size):
    df = spark.createDataFrame([(v,) for v in "bacc"] + [(None,)], "v string")
    assert table_of(encode.index_mappings(df, ["v"])["v"]) == {"c": 0, "a": 1, "b": 2}


def test_numbers_tie_by_text(spark, size):
    df = spark.createDataFrame([(6,), (17,), (17,), (6,), (1,)], "p int")
    assert table_of(encode.index_mappings(df, ["p"])["p"]) == {17: 0, 6: 1, 1: 2}


def test_many_values(spark, size):
    df = spark.range(500).select((F.col("id") % 137).cast("string").alias("v"))
    got = table_of(encode.index_mappings(df, ["v"])["v"])
    counts = {}
    for i in range(500):
        counts[str(i % 137)] = counts.get(str(i % 137), 0) + 1
    want = {v: i for i, v in enumerate(sorted(counts, key=lambda v: (-counts[v], v)))}
    assert got == want


def test_invalid_values(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("z", 4)], "v string, id int")
    mapping = encode.index_mappings(df.filter("v in ('a', 'b')"), ["v"])["v"]
    kept = encode.apply_index(df, "v", "i", mapping, "keep")
    assert {r.id: r.i for r in kept.collect()} == {1: 0, 2: 1, 3: 2, 4: 2} and kept.columns == ["id", "i"]
    skipped = encode.apply_index(df, "v", "i", mapping, "skip", drop=False)
    assert {r.v: r.i for r in skipped.collect()} == {"a": 0, "b": 1}
    with pytest.raises(Exception, match="no index for v"):
        encode.apply_index(df, "v", "i", mapping).collect()
    with pytest.raises(ValueError):
        encode.apply_index(df, "v", "i", mapping, "guess")


def test_index_is_integer_and_plan_is_broadcast(spark):
    df = spark.createDataFrame([("a",), ("b",)], "v string")
    indexed, mappings = encode.string_index(df, [("v", "i")])
    assert dict(indexed.dtypes) == {"i": "int"} and set(mappings) == {"v"}
    assert_absent(indexed, "SortMergeJoin", "Python", "NestedLoop")


def test_star_round_trip(spark):
    df = spark.createDataFrame(
        [(1, "a", None, "x"), (2, "a", None, "y"), (3, None, 5, "x"), (4, "", 5, "x")], "id int, ip string, port int, label string"
    )
    spec = {"source": ["ip", "port"], "packet": ["id"]}
    dims, fact = star.star_dimensions(df, spec), star.star_fact(df, spec)
    assert dims["source"].count() == 3 and fact.columns == ["source_id", "packet_id", "label"]
    back = star.star_join(fact, dims).select(*df.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_star_keeps_rows_with_negative_zero(spark):
    df = spark.createDataFrame([(1, -0.0), (2, 0.0)], "id int, v double")
    spec = {"value": ["v"]}
    assert star.star_join(star.star_fact(df, spec), star.star_dimensions(df, spec)).count() == 2


def test_date_parts(spark):
    df = spark.sql("select timestamp_ntz'2018-11-03 09:18:16' as t")
    assert star.date_parts(df, "t").drop("t").first() == (2018, 11, 3)


def test_star_keys_are_unambiguous(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "z"), ("<null>", "z"), ("-", "z"), ("", "1:x"), ("1:", "x")]
    df = spark.createDataFrame(rows, "s string, t string").selectExpr("*", "monotonically_increasing_id() as id")
    spec = {"pair": ["s", "t"]}
    joined = star.star_join(star.star_fact(df, spec), star.star_dimensions(df, spec))
    assert sorted(((r.s, r.t) for r in joined.collect()), key=str) == sorted(rows, key=str)


def test_stored_star_joins_again_without_moving_rows(spark):
    rows = [(i, i % 40, i % 3, None if i % 7 == 0 else -0.0 if i % 2 else 0.0) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, big int, small int, v double").repartition(5)
    spec = {"large": ["big", "v"], "little": ["small"]}
    stored = star.store_star(df, spec, plain_rows=10, bucket_rows=100)
    assert stored.bucketed_by == "large_id"
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = star.star_join(stored.fact, {"large": stored.dimensions["large"]})
        assert_absent(joined, "Exchange")
        assert joined.count() == 500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    back = star.star_join(stored.fact, stored.dimensions).select(*df.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    plain = star.store_star(df, spec)
    assert plain.bucketed_by is None and star.star_join(plain.fact, plain.dimensions).count() == 500
    empty = star.store_star(df.limit(0), spec)
    assert star.star_join(empty.fact, empty.dimensions).count() == 0
