import numpy as np
import pandas as pd
import pytest

from flowlab.operators import matrices
from flowlab.operators.discriminant import DiscriminantModel, class_means, lda_variance_ratio
from flowlab.operators.scale import MinMaxModel, minmax_scale


def test_minmax(spark):
    df = spark.createDataFrame([(3, 0.0, "a", None), (3, 5.0, "b", 1.0), (3, 10.0, "c", 2.0)], "k int, v double, y string, n double").coalesce(1)
    rows = minmax_scale(df, ["y"]).collect()
    assert [(r.k, r.v, r.y, r.n) for r in rows] == [(0, 0, "a", None), (0, 0.5, "b", 0), (0, 1, "c", 1)]
    with pytest.raises(ValueError, match="y"):
        minmax_scale(df)


def test_minmax_of_gaps_and_infinities(spark):
    df = spark.createDataFrame([(None, float("nan")), (None, 2.0), (None, 4.0)], "a double, b double").coalesce(1)
    rows = minmax_scale(df).collect()
    assert [r.a for r in rows] == [None] * 3 and np.isnan(rows[0].b) and [r.b for r in rows[1:]] == [0, 1]
    with pytest.raises(ValueError, match="infinite"):
        minmax_scale(spark.createDataFrame([(float("inf"),)], "a double"))


def test_fit_and_transform_are_separate(spark):
    train = spark.createDataFrame([(0.0,), (2.0,)], "v double")
    other = spark.createDataFrame([(4.0,)], "v double")
    assert MinMaxModel.fit(train).transform(other).first().v == 2.0
    assert minmax_scale(other, fit_on=train).first().v == 2.0


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    y = rng.integers(0, 4, 600)
    x = rng.normal(size=(600, 5)) * [1, 2, 0.5, 10, 1] + rng.normal(size=(4, 5))[y] * [3, 1, 1, 5, 0]
    data = pd.DataFrame(x, columns=[f"x{i}" for i in range(5)])
    data["flat"] = 1.0
    data["y"] = y
    return data


def solved(frame):
    """Generalized eigenvalues of (between, within) scatter and the projected class means."""
    x, y = frame[[c for c in frame if c.startswith("x")]].to_numpy(), frame["y"].to_numpy()
    mean = x.mean(0)
    within, between = np.zeros((5, 5)), np.zeros((5, 5))
    for c in np.unique(y):
        part = x[y == c]
        within += (part - part.mean(0)).T @ (part - part.mean(0))
        between += len(part) * np.outer(part.mean(0) - mean, part.mean(0) - mean)
    values, vectors = np.linalg.eig(np.linalg.solve(within, between))
    order = np.argsort(-values.real)[:3]
    axes = vectors.real[:, order]
    # Unit within-class covariance along every axis.
    axes /= np.sqrt(np.diag(axes.T @ within @ axes) / (len(y) - 4))
    return values.real[order] / values.real[order].sum(), (x - mean) @ axes


def test_discriminant_equals_eigen_solution(spark, frame):
    ratios, projected = solved(frame)
    df = spark.createDataFrame(frame.assign(row=range(600))).repartition(4)
    model = DiscriminantModel.fit(df, "y", [c for c in frame if c != "y"])
    assert np.allclose(model.ratios, ratios) and model.max_components == 3
    got = model.transform(df, 3).toPandas().sort_values("row")
    assert list(got.columns) == ["c0", "c1", "c2", "y", "row"]
    assert np.allclose(np.abs(got[["c0", "c1", "c2"]].to_numpy()), np.abs(projected), atol=1e-6)


def test_variance_table(spark, frame):
    rows = lda_variance_ratio(spark.createDataFrame(frame), "y").collect()
    assert [r.k for r in rows] == [1, 2, 3] and np.isclose(rows[-1].ratio, 1.0)
    assert np.allclose(np.diff([0] + [r.ratio for r in rows]), solved(frame)[0])


def test_text_labels(spark, frame):
    text = spark.createDataFrame(frame.assign(y=frame["y"].map(lambda v: f"class {v}")))
    assert np.allclose(DiscriminantModel.fit(text, "y").ratios, solved(frame)[0])


def test_class_means(spark, frame):
    rows = class_means(spark.createDataFrame(frame), ["x0", "x3"], "y").collect()
    for r in rows:
        part = frame[frame["y"] == r.y]
        assert r.n == len(part) and np.isclose(r.prior, len(part) / 600) and np.allclose(r.means, part[["x0", "x3"]].mean())


def test_unusable_input(spark, frame):
    df = spark.createDataFrame(frame)
    with pytest.raises(ValueError, match="components"):
        DiscriminantModel.fit(df, "y").transform(df, 4)
    for bad in (df.filter("y = 1"), df.filter("false")):
        with pytest.raises(ValueError):
            DiscriminantModel.fit(bad, "y")
    for gap in ("x1 = null", "x1 = double('nan')", "x1 = double('infinity')", "y = null"):
        column, value = gap.split(" = ")
        with pytest.raises(ValueError, match="known"):
            DiscriminantModel.fit(df.selectExpr("*", f"if(x0 > 2, {value}, {column}) as new").drop(column).withColumnRenamed("new", column), "y")


def test_fewer_axes_than_asked(spark):
    """Three classes on one line span one axis, whatever number is asked for."""
    rows = [(float(i % 3) + (i % 5) * 0.01, (i % 7) * 0.1, i % 3) for i in range(210)]
    df = spark.createDataFrame(rows, "a double, b double, y int")
    model = DiscriminantModel.fit(df, "y")
    assert model.max_components == 2 and model.transform(df, 2).columns[-1] == "y"
    assert model.explained_variance()[-1][1] == pytest.approx(1.0)


def test_wide_and_many_classes_equal_the_dense_solution(spark, frame):
    """Conjugate gradients, and class means that stay in a table, give the dense ratios and axes."""
    both = spark.createDataFrame(frame.assign(twice=2 * frame["x1"])).repartition(5)
    dense = DiscriminantModel.fit(both, "y")
    for limits in ({"dense_width": 2}, {"driver_cells": 8}):
        other = DiscriminantModel.fit(both, "y", **limits)
        assert np.allclose(other.ratios, dense.ratios) and np.allclose(other.centre, dense.centre)
        x = frame.assign(twice=2 * frame["x1"])[dense.features].to_numpy()
        assert np.allclose(np.abs((x - other.centre) @ other.axes), np.abs((x - dense.centre) @ dense.axes), atol=1e-6)
    with pytest.raises(ValueError, match="numbers"):
        DiscriminantModel.fit(both, "y", dense_width=2, driver_cells=8)
    with pytest.raises(ValueError, match="tell them apart"):
        DiscriminantModel.fit(both.selectExpr("*", "cast(y = 1 as double) as tells"), "y", dense_width=2)


@pytest.mark.parametrize("parts, driver_bytes", [(1, 0), (3, 0), (40, 0), (3, 1 << 20)])
def test_matrices_merge_in_levels(spark, parts, driver_bytes):
    x = np.arange(60 * 7, dtype=float).reshape(60, 7) % 11
    rows = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>").repartition(parts)
    layout = matrices.Layout(1, 7, 7, upper=True, band_bytes=120)

    def term(batch):
        m = batch.column(0).flatten().to_numpy().reshape(-1, 7)
        return (m.T @ m)[None]

    found = matrices.summed(rows, layout, term, driver_bytes=driver_bytes)
    assert found.select("part").distinct().count() == 1
    assert np.allclose(matrices.gathered(found, layout)[0], x.T @ x)
    cells = {(r.i, r.j): r.v for r in matrices.upper_cells(found, layout, ["v"]).collect()}
    assert cells == {(i, j): (x.T @ x)[i, j] for i in range(7) for j in range(i, 7)}
    none = matrices.summed(rows.filter("false"), layout, term, driver_bytes=driver_bytes)
    assert none.count() == 0 and not matrices.gathered(none, layout).any()
