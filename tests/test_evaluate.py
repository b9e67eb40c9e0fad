import math

import pytest

from flowlab.operators.evaluate import (
    accuracy, classification_report, confusion_counts, confusion_matrix, fold_scores, log_loss, mean_cv_score, pr_curve, roc_curve,
)


@pytest.fixture(scope="module")
def judged(spark):
    pairs = [(0, 0, 0), (0, 0, 0), (0, 1, 0), (1, 1, 1), (1, 1, 1), (2, 0, 1), (2, 0, 1), (0, 3, 1)]
    return spark.createDataFrame(pairs, "y int, p int, f int").persist()


def test_accuracy_and_folds(judged):
    assert accuracy(judged, "y", "p").first()[0] == 50.0
    assert {r.f: r.accuracy for r in fold_scores(judged, "y", "p", "f").collect()} == {0: pytest.approx(200 / 3), 1: 40.0}
    assert mean_cv_score(judged, "y", "p", "f").first()[0] == pytest.approx((200 / 3 + 40) / 2)


def test_confusion_lists_every_class(judged):
    df = confusion_matrix(judged, "y", "p")
    assert df.columns == ["label", "pred_0", "pred_1", "pred_2", "pred_3", "pred_other"]
    assert sorted(map(tuple, df.collect())) == [(0, 2, 1, 0, 1, 0), (1, 0, 2, 0, 0, 0), (2, 2, 0, 0, 0, 0), (3, 0, 0, 0, 0, 0)]
    assert sorted(map(tuple, confusion_matrix(judged, "y", "p", [0, 1, 2, 3]).collect())) == sorted(map(tuple, df.collect()))


def test_confusion_of_text_labels(spark):
    df = spark.createDataFrame([("SYN flood", "a.b"), ("a.b", "a.b")], "y string, p string")
    got = confusion_matrix(df, "y", "p")
    assert got.columns == ["label", "pred_SYN flood", "pred_a.b", "pred_other"]
    assert sorted(map(tuple, got.collect())) == [("SYN flood", 0, 1, 0), ("a.b", 0, 1, 0)]


def test_confusion_keeps_rows_that_are_not_listed(spark):
    df = spark.createDataFrame([(0, 0), (1, 2), (2, 7), (None, 1), (9, None)], "y int, p int")
    got = {r.label: tuple(r)[1:] for r in confusion_matrix(df, "y", "p", [0, 1, 2]).collect()}
    assert got == {0: (1, 0, 0, 0), 1: (0, 0, 1, 0), 2: (0, 0, 0, 1), None: (0, 1, 0, 0), 9: (0, 0, 0, 1)}
    assert sum(map(sum, (tuple(r)[1:] for r in confusion_matrix(df, "y", "p").collect()))) == 5
    assert confusion_counts(df, "y", "p").count() == 5


@pytest.mark.parametrize("row", [(None, 0.1, 0.2), (5, 0.1, 0.2), (0, None, 0.2), (0, float("nan"), 0.2)])
def test_unknown_labels_and_scores_fail(spark, row):
    df = spark.createDataFrame([(0, 0.3, 0.1), row], "y int, a double, b double")
    if row[1] == row[1]:
        with pytest.raises(Exception, match="log loss"):
            log_loss(df, "y", ["a", "b"]).collect()
    if row[0] != 5:
        with pytest.raises(Exception, match="curve"):
            pr_curve(df, "y", ["a", "b"]).collect()


def test_report(judged):
    got = {r.name: (r.precision, r.recall, r.f1, r.support) for r in classification_report(judged, "y", "p").collect()}
    assert got["0"] == pytest.approx((0.5, 0.5, 0.5, 4))
    assert got["1"] == pytest.approx((2 / 3, 1.0, 0.8, 2))
    assert got["2"] == (0, 0, 0, 2) and got["3"] == (0, 0, 0, 0)
    assert got["macro avg"] == pytest.approx(((0.5 + 2 / 3) / 4, 1.5 / 4, 1.3 / 4, 8))
    assert got["weighted avg"] == pytest.approx(((2 + 4 / 3) / 8, 4 / 8, 3.6 / 8, 8))
    assert got["accuracy"] == pytest.approx((0.5, 0.5, 0.5, 8)) and len(got) == 7


def test_log_loss(spark):
    df = spark.createDataFrame([(0, 0.0, 0.0), (1, 1.0, 3.0)], "y int, a double, b double")
    want = (math.log(2) + math.log(1 + math.exp(-2))) / 2
    assert log_loss(df, "y", ["a", "b"]).first()[0] == pytest.approx(want)


def test_curves_equal_brute_force(spark):
    rows = [(i % 3, ((i * 7) % 11) / 11, ((i * 5) % 13) / 13, ((i * 3) % 4) / 4) for i in range(90)]
    df = spark.createDataFrame(rows, "y int, a double, b double, c double").repartition(5)
    pr = {(r["class"], r.threshold): (r.precision, r.recall) for r in pr_curve(df, "y", ["a", "b", "c"]).collect()}
    roc = {(r["class"], r.threshold): (r.fpr, r.tpr) for r in roc_curve(df, "y", ["a", "b", "c"]).collect()}
    want = set()
    for c in range(3):
        for t in {r[1 + c] for r in rows}:
            tp = sum(r[0] == c and r[1 + c] >= t for r in rows)
            fp = sum(r[0] != c and r[1 + c] >= t for r in rows)
            want.add((c, t))
            assert pr[c, t] == pytest.approx((tp / (tp + fp), tp / 30))
            assert roc[c, t] == pytest.approx((fp / 60, tp / 30))
    assert set(pr) == set(roc) == want


def test_curve_of_a_class_without_rows(spark):
    df = spark.createDataFrame([(0, 0.5, 0.1), (0, 0.6, 0.2)], "y int, a double, b double")
    assert {r.recall for r in pr_curve(df, "y", ["a", "b"]).collect() if r["class"] == 1} == {0.0}
    assert {r.fpr for r in roc_curve(df, "y", ["a", "b"]).collect() if r["class"] == 0} == {0.0}
