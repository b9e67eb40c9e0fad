"""Classification quality: matrices, reports, losses and threshold curves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from flowlab.functions.names import quoted
from flowlab.functions.scores import log_softmax_loss
from flowlab.operators.ranking import running_totals

# A matrix has a column per class; more classes are listed by ``confusion_counts``.
MATRIX_CLASSES = 10_000


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: percentage of rows whose prediction is their label."""
    hit = F.when(quoted(label) == quoted(prediction), 100.0).otherwise(0.0)
    return df.agg(F.avg(hit).alias("accuracy"))


def fold_scores(df: DataFrame, label: str, prediction: str, fold: str) -> DataFrame:
    """``(fold, accuracy)``: accuracy inside each fold."""
    hit = F.when(quoted(label) == quoted(prediction), 100.0).otherwise(0.0)
    return df.groupBy(quoted(fold)).agg(F.avg(hit).alias("accuracy"))


def mean_cv_score(df: DataFrame, label: str, prediction: str, fold: str) -> DataFrame:
    """One row: the mean over the folds of the accuracy inside a fold."""
    return fold_scores(df, label, prediction, fold).agg(F.avg("accuracy").alias("mean_accuracy"))


def confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``(label, pred, n)``: the matrix in long form, NULL being a value like any other."""
    return df.groupBy(quoted(label).alias("label"), quoted(prediction).alias("pred")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(
    df: DataFrame, label: str, prediction: str, classes: Sequence | None = None
) -> DataFrame:
    """``(label, pred_<class>..., pred_other)``: a row and a column per class, empty cells 0.

    Without ``classes`` they are looked up first; give them to save that pass. No row is left out:
    predictions that are NULL or not listed count as ``pred_other``, labels that are NULL or not
    listed have rows of their own. ``confusion_counts`` holds the same for any number of classes.
    """
    counts = confusion_counts(df, label, prediction)
    if classes is None:
        seen = counts.select(F.explode(F.array("label", "pred")).alias("c")).filter("c is not null").distinct()
        rows = seen.orderBy("c").limit(MATRIX_CLASSES + 1).collect()
        if len(rows) > MATRIX_CLASSES:
            raise ValueError(f"more than {MATRIX_CLASSES} classes do not fit a matrix; use confusion_counts")
        classes = [r["c"] for r in rows]
    classes = list(classes)
    # A row of zeros per class, so that classes without rows are listed too.
    blank = df.sparkSession.createDataFrame([(c, None, 0) for c in classes], counts.schema)
    n = F.col("n")

    def total(hit: Column) -> Column:
        return F.sum(F.when(hit, n).otherwise(0)).cast("long")

    listed = F.coalesce(F.col("pred").isin(classes), F.lit(False))
    return counts.unionAll(blank).groupBy("label").agg(
        *[total(F.col("pred") == c).alias(f"pred_{c}") for c in classes], total(~listed).alias("pred_other")
    )


def _ratio(part: Column, whole: Column) -> Column:
    """0 where the divisor is 0; ANSI mode would fail the job there."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``(name, precision, recall, f1, support)`` per class and for the three averages.

    The data is counted once to (label, prediction) pairs; everything after that works on that
    small table. An undefined ratio is 0. The accuracy row holds the accuracy in all columns.
    """
    cells = confusion_counts(df, label, prediction)
    hits = F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("long")

    def side(name: str, support: Column, predicted: Column, hits: Column) -> Column:
        return F.struct(
            F.col(name).alias("class"), support.alias("support"), predicted.alias("predicted"),
            hits.cast("long").alias("hits"),
        )

    sides = cells.select(F.inline(F.array(
        side("label", F.col("n"), zero, hits), side("pred", zero, F.col("n"), zero)
    )))
    per_class = (
        sides.groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
        .withColumn("precision", _ratio(F.col("hits"), F.col("predicted")))
        .withColumn("recall", _ratio(F.col("hits"), F.col("support")))
        .withColumn(
            "f1", _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
        )
    )
    scores = ["precision", "recall", "f1"]
    # One grouping-set pass gives the class rows and the row over all classes.
    rolled = per_class.rollup("class").agg(
        F.grouping("class").alias("overall"),
        F.sum("support").cast("long").alias("support"),
        F.try_divide(F.sum("hits"), F.sum("support")).alias("hit_rate"),
        *[F.avg(s).alias(s) for s in scores],
        *[F.try_divide(F.sum(F.col(s) * F.col("support")), F.sum("support")).alias(f"w_{s}") for s in scores],
    )

    def line(name: Column, values: Sequence[str]) -> Column:
        return F.struct(
            name.cast("string").alias("name"),
            *[F.col(v).alias(s) for v, s in zip(values, scores)], F.col("support"),
        )

    averages = F.array(
        line(F.lit("accuracy"), ["hit_rate"] * 3),
        line(F.lit("macro avg"), scores),
        line(F.lit("weighted avg"), [f"w_{s}" for s in scores]),
    )
    one = F.array(line(F.col("class"), scores))
    return rolled.select(F.inline(F.when(F.col("overall") == 1, averages).otherwise(one)))


def log_loss(df: DataFrame, label: str, scores: Sequence[str] | str) -> DataFrame:
    """One row: mean cross entropy of raw class scores, ``label`` being the score's position.

    A label without a score, or NULL among label or scores, fails the job: a mean over the other
    rows would look better than the model is.
    """
    values = quoted(scores) if isinstance(scores, str) else F.array(*[quoted(c) for c in scores])
    loss = F.coalesce(log_softmax_loss(quoted(label), values), F.raise_error(F.lit("log loss: a label or score is unknown")))
    return df.agg(F.avg(loss).alias("log_loss"))


def threshold_counts(df: DataFrame, label: str, scores: Sequence[str]) -> DataFrame:
    """``(class, threshold, tp, fp, positives, negatives)`` for every class and distinct score.

    One-vs-rest: class i is judged by ``scores[i]``; tp and fp count the rows at or above the
    threshold. Equal scores are merged before the shuffle; the cumulation is spread over range
    partitions, so a class with a billion distinct scores is no single task. A NULL label or a NULL
    or NaN score fails the job.
    """
    values = [quoted(c) for c in scores]
    known = quoted(label).isNotNull()
    for v in values:
        known = known & v.isNotNull() & ~F.isnan(v)
    checked = F.when(known, quoted(label)).otherwise(F.raise_error(F.lit("curve: a label or score is unknown")))
    each = F.posexplode(F.array(*values)).alias("class", "threshold")
    long = df.select(each, checked.alias("label"))
    hit = (F.col("label") == F.col("class")).cast("long")
    steps = long.groupBy("class", "threshold").agg(F.sum(hit).alias("pos"), F.sum(1 - hit).alias("neg"))
    summed = running_totals(
        steps, ["class"], [F.col("threshold").desc()], {"tp": F.col("pos"), "fp": F.col("neg")}
    )
    return summed.select(
        "class", "threshold", "tp", "fp",
        F.col("tp_total").alias("positives"), F.col("fp_total").alias("negatives"),
    )


def pr_curve(df: DataFrame, label: str, scores: Sequence[str]) -> DataFrame:
    """``(class, threshold, precision, recall)`` at every distinct score."""
    t = threshold_counts(df, label, scores)
    return t.select(
        "class", "threshold",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        _ratio(F.col("tp"), F.col("positives")).alias("recall"),
    )


def roc_curve(df: DataFrame, label: str, scores: Sequence[str]) -> DataFrame:
    """``(class, threshold, fpr, tpr)`` at every distinct score."""
    t = threshold_counts(df, label, scores)
    return t.select(
        "class", "threshold",
        _ratio(F.col("fp"), F.col("negatives")).alias("fpr"),
        _ratio(F.col("tp"), F.col("positives")).alias("tpr"),
    )
