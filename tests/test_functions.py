import math

from pyspark.sql import functions as F

from flowlab.functions import argmax_class, log_softmax_loss, port_id, private_ip, softmax
from flowlab.functions.names import clean_name, quoted


def column(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_private_ip_edges(spark):
    addresses = ["172.15.0.1", "172.16.0.1", "172.31.9.9", "172.32.0.1", "192.168.0.1", "192.167.0.1",
                 "10.0.0.1", "abc", "192", None, "", "172.x.1.1"]
    df = spark.createDataFrame([(a,) for a in addresses], "ip string").coalesce(1)
    assert column(df, private_ip(F.col("ip"))) == [0, 1, 1, 0, 1, 0, 0, 0, 0, 0, 0, 0]


def test_port_id_edges(spark):
    df = spark.createDataFrame([(p,) for p in [80, 445, 3268, 5353, 50000, 0, None]], "p int").coalesce(1)
    assert column(df, port_id(F.col("p"))) == [1, 2, 5, 11, 0, 0, None]


def test_port_id_takes_text_longs_and_the_first_group(spark):
    df = spark.createDataFrame([("80", 80), ("x", 81), (None, None)], "t string, l long").coalesce(1)
    groups = {"a": [80, 1], "b": [80, 81]}
    assert column(df, port_id(F.col("t"), groups)) == [1, 0, None]
    assert column(df, port_id(F.col("l"), groups)) == [1, 2, None]
    assert column(df, port_id(F.col("l"), {})) == [0, 0, None]


def test_ids_are_not_looked_up_again(spark):
    # Service 2's port is 1: a port of service 1 must not be taken for it.
    df = spark.createDataFrame([(500,), (1,)], "p int").coalesce(1)
    assert column(df, port_id(F.col("p"), {"a": [500], "b": [1]})) == [1, 2]


def test_softmax_and_argmax(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],), ([1000.0, 0.0, -1000.0],)], "s array<double>").coalesce(1)
    first, second = column(df, softmax(F.col("s")))
    assert math.isclose(sum(first), 1.0) and first[1] == first[2] > first[0]
    assert second == [1.0, 0.0, 0.0]
    assert column(df, argmax_class(F.col("s"))) == [1, 0]


def test_loss_of_large_scores_is_finite(spark):
    df = spark.createDataFrame([(1, [1000.0, 0.0]), (0, [0.0, 0.0])], "y int, s array<double>").coalesce(1)
    losses = column(df, log_softmax_loss(F.col("y"), F.col("s")))
    assert losses[0] == 1000.0 and math.isclose(losses[1], math.log(2))


def test_names(spark):
    assert clean_name("  Flow Bytes/s ") == "Flow_Bytes/s"
    df = spark.createDataFrame([(1, 2)], "`a.b` int, `c``d` int")
    assert df.select(quoted("a.b"), quoted("c`d")).first() == (1, 2)
