import datetime

import pytest

from flowlab.operators.clean import constant_profile
from flowlab.operators.distinct import (
    counts_so_far, distinct_counts, distinct_sketches, estimated_counts, merged_sketches, record_snapshot,
)

SCHEMA = "`a b` double, c string, d timestamp_ntz, e int, f double"


def rows(start, stop):
    day = datetime.datetime(2020, 1, 1)
    return [(float(i % 50), str(i), day + datetime.timedelta(days=i % 400), i % 7, None) for i in range(start, stop)]


def counts(df):
    return {r.column_name: r.n for r in df.collect()}


def test_exact_counts(spark):
    odd = [(float("nan"), None, None, None, None), (-0.0, "", None, 0, float("nan")), (0.0, "", None, 0, None), (float("inf"), " ", None, 1, None)]
    df = spark.createDataFrame(odd, SCHEMA).repartition(3)
    assert counts(distinct_counts(df)) == {"a b": 2, "c": 2, "d": 0, "e": 2, "f": 0}
    assert counts(distinct_counts(df, ["e"])) == {"e": 2}
    assert set(counts(distinct_counts(df.limit(0))).values()) <= {0}
    flat = spark.createDataFrame([(5.0, "x", None, 1, None)] * 4, SCHEMA)
    ones = {c for c, n in counts(distinct_counts(flat)).items() if n == 1}
    assert ones == {r.column_name for r in constant_profile(flat).collect() if r.is_constant}


def test_sketches_of_snapshots_merge(spark, tmp_path):
    folder = str(tmp_path / "sketches")
    for name, part in (("one", rows(0, 6000)), ("two", rows(4000, 9000)), ("two", rows(4000, 20000))):
        record_snapshot(spark.createDataFrame(part, SCHEMA), folder, name)
    found = {r.column_name: (r.n, r.n_rows) for r in counts_so_far(spark, folder).collect()}
    want = counts(distinct_counts(spark.createDataFrame(rows(0, 20000), SCHEMA)))
    assert set(found) == set(want)
    for column, (n, n_rows) in found.items():
        assert n == pytest.approx(want[column], rel=0.05) and n_rows == 22000


def test_sketches_of_different_precision(spark):
    df = spark.createDataFrame(rows(0, 3000), SCHEMA)
    both = distinct_sketches(df, ["c"], 12).union(distinct_sketches(df, ["c"], 10))
    assert counts(estimated_counts(merged_sketches(both)))["c"] == pytest.approx(3000, rel=0.12)
    assert counts(estimated_counts(distinct_sketches(df.limit(0))))["c"] == 0
