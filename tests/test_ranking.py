"""Balance, split and folds against a plain row_number, on every path of the ranking module."""

from collections import Counter

import pytest
from pyspark.sql import Window, functions as F

from flowlab.operators import ranking
from flowlab.operators.balance import balance_bernoulli, balance_exact
from flowlab.operators.ranking import hash_position, running_totals
from flowlab.operators.split import stratified_kfold, stratified_split, train_test
from tests.plans import assert_absent


@pytest.fixture(params=["one bucket", "many buckets", "large tables"])
def path(request, monkeypatch):
    if request.param != "one bucket":
        monkeypatch.setattr(ranking, "BUCKET_ROWS", 16)
    if request.param == "large tables":
        monkeypatch.setattr(ranking, "SMALL_TABLE_ROWS", 0)
    return request.param


@pytest.fixture(scope="module")
def rows(spark):
    """A class with two thirds of the rows, small ones, one of a single row, and NULL."""
    label = (
        F.when(F.col("id") % 3 < 2, "big").when(F.col("id") == 2, "one")
        .when(F.col("id") % 15 == 5, None).when(F.col("id") % 2 == 0, "mid").otherwise("low")
    )
    return spark.range(900).select("id", label.alias(" Label"), (F.col("id") * 2).alias("x")).persist()


def ranked(rows):
    w = Window.partitionBy(" Label").orderBy(hash_position(["id"], 2))
    size = F.count(F.lit(1)).over(Window.partitionBy(" Label"))
    return rows.withColumn("rn", F.row_number().over(w)).withColumn("n", size)


def test_balance_is_exact(rows, path):
    got = balance_exact(rows, " Label", ["id"], ["one"])
    sizes = Counter(r[" Label"] for r in got.collect())
    assert set(sizes) == {"big", "mid", "low"} and len(set(sizes.values())) == 1
    least = min(sizes.values())
    kept = ranked(rows.filter("` Label` is not null and ` Label` <> 'one'")).filter(F.col("rn") <= least)
    assert {r.id for r in got.collect()} == {r.id for r in kept.collect()}
    assert got.columns == rows.columns


def test_balance_of_nothing(rows):
    assert balance_exact(rows.filter("id < 0"), " Label", ["id"]).count() == 0


def test_bernoulli_shares(rows):
    by_key = Counter(r[" Label"] for r in balance_bernoulli(rows, " Label", ["one"], key=["id"]).collect())
    by_rand = Counter(r[" Label"] for r in balance_bernoulli(rows, " Label", ["one"]).collect())
    least = min(n for l, n in Counter(r[" Label"] for r in rows.collect()).items() if l not in (None, "one"))
    for sizes in (by_key, by_rand):
        assert set(sizes) == {"big", "mid", "low"}
        assert all(abs(n - least) <= 5 * least**0.5 for n in sizes.values())


def test_bernoulli_with_key_ignores_partitioning(rows):
    one = balance_bernoulli(rows.coalesce(1), " Label", ["one"], key=["id"])
    many = balance_bernoulli(rows.repartition(7), " Label", ["one"], key=["id"])
    assert sorted(r.id for r in one.collect()) == sorted(r.id for r in many.collect())


def test_split_matches_plain_rank(rows, path):
    got = {r.id: r.is_test for r in stratified_split(rows, " Label", ["id"]).collect()}
    want = {r.id: r.rn <= round(r.n * 0.15 + 1e-12) for r in ranked(rows).collect()}
    assert got == want


def test_split_is_disjoint_and_complete(rows):
    train, test = train_test(rows, " Label", ["id"])
    a, b = {r.id for r in train.collect()}, {r.id for r in test.collect()}
    assert not a & b and len(a | b) == 900 and train.columns == rows.columns


def test_folds_match_ntile(rows, path):
    got = {r.id: r.fold for r in stratified_kfold(rows, " Label", ["id"], k=4).collect()}
    w = Window.partitionBy(" Label").orderBy(hash_position(["id"], 2))
    want = {r.id: r.t - 1 for r in rows.withColumn("t", F.ntile(4).over(w)).collect()}
    assert got == want
    labels = {r.id: r[" Label"] for r in rows.collect()}
    for label in set(labels.values()):
        sizes = Counter(f for i, f in got.items() if labels[i] == label)
        assert max(sizes.values()) - min(sizes.get(f, 0) for f in range(4)) <= 1


def test_one_fold_is_refused(rows):
    with pytest.raises(ValueError):
        stratified_kfold(rows, " Label", ["id"], k=1)


def test_full_rows_are_not_shuffled(rows):
    for make in (balance_exact, stratified_split, stratified_kfold):
        df = make(rows, " Label", ["id"])
        assert_absent(df, "hashpartitioning", "SinglePartition", "Sort ", "Window")


def test_keys_that_repeat_are_refused(spark, path):
    copies = spark.range(200).select((F.col("id") % 2).alias("y"), F.lit(1).alias("k"))
    for make in (stratified_split, stratified_kfold):
        with pytest.raises(Exception, match="do not tell the rows apart"):
            make(copies, "y", ["k"]).collect()
    uneven = copies.unionAll(copies.filter("y = 1"))
    with pytest.raises(Exception, match="do not tell the rows apart"):
        balance_exact(uneven, "y", ["k"]).collect()


@pytest.mark.parametrize("parts", ["1", "3", "8"])
def test_running_totals(spark, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.range(200).select((F.col("id") % 3).alias("g"), F.expr("(id * 37) % 211").alias("v"), F.lit(2).alias("w"))
        got = running_totals(df, ["g"], [F.col("v").desc()], {"t": F.col("w")}).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert len(got) == 200
    for r in got:
        assert r.t == 2 * sum(1 for o in got if o.g == r.g and o.v >= r.v)
        assert r.t_total == 2 * sum(1 for o in got if o.g == r.g)


@pytest.mark.parametrize("limit", [100_000, 3])
def test_running_totals_of_odd_groups(spark, monkeypatch, limit):
    """Null groups, null values and groups over several batches and partitions, with few sums and with many."""
    monkeypatch.setattr("flowlab.operators.ranking.SMALL_TABLE_ROWS", limit)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(None if i % 4 == 0 else "a" if i % 2 else "b", i, None if i % 5 == 0 else i) for i in range(150)] + [("c", 1000, None)]
        df = spark.createDataFrame(rows, "g string, v int, w int")
        got = running_totals(df, ["g"], [F.col("v").asc()], {"t": F.col("w"), "n": F.lit(1)})
        if limit > 3:
            assert_absent(got, "hashpartitioning", "Sort ", "Window")
        got = got.collect()
        assert got[0].asDict().keys() == {"g", "v", "w", "t", "n", "t_total", "n_total"} and len(got) == 151
        for r in got:
            group = [o for o in rows if o[0] == r.g]
            upto = [o for o in group if o[1] <= r.v]
            assert (r.t, r.n) == (sum(o[2] or 0 for o in upto), len(upto))
            assert (r.t_total, r.n_total) == (sum(o[2] or 0 for o in group), len(group))
        assert running_totals(df.limit(0), ["g"], [F.col("v").asc()], {"n": F.lit(1)}).count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
