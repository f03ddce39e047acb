"""Classifier metrics and probability quality, each from counts that one aggregation makes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.numbers import edge_bin
from millrace.operators.ordering import running_totals

_EPS = 1e-15


def accuracy(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    return df.agg((F.avg((F.col(y) == F.col(p)).cast("double")) * 100).alias("accuracy"))


def confusion_matrix(df: DataFrame, classes: list[int], y: str = "y", p: str = "p", other: int = -1) -> DataFrame:
    """Count per (true, predicted) for a list of classes, zero cells shown. Labels outside the list, null ones too,
    are counted under ``other``, so the cells add up to the rows."""

    def shown(c: str) -> Column:
        return F.when(F.col(c).isin(classes), F.col(c)).otherwise(F.lit(other)).cast("int").alias(c)

    counts = df.select(shown(y), shown(p)).groupBy(y, p).agg(F.count("*").alias("n"))
    names = [*classes, other]
    cells = df.sparkSession.createDataFrame([(a, b) for a in names for b in names], f"{y} int, {p} int")
    return cells.join(F.broadcast(counts), [y, p], "left").select(y, p, F.coalesce("n", F.lit(0)).alias("n"))


def _hits():
    tp = F.count_if((F.col("y") == 1) & (F.col("p") == 1))
    fp = F.count_if((F.col("y") == 0) & (F.col("p") == 1))
    fn = F.count_if((F.col("y") == 1) & (F.col("p") == 0))
    return tp, fp, fn


def _rates():
    tp, fp, fn = _hits()
    return [
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, tp + fn).alias("recall"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"),
    ]


def precision_recall_f1(df: DataFrame) -> DataFrame:
    return df.agg(*_rates())


def _loss(p: str):
    q = F.greatest(F.least(F.col(p).cast("double"), F.lit(1 - _EPS)), F.lit(_EPS))
    return F.avg(F.when(F.col("y") == 1, -F.log(q)).otherwise(-F.log(1 - q)))


def log_loss(df: DataFrame, p: str = "p") -> DataFrame:
    """Mean negative log likelihood of scores or of hard classes, clipped away from 0 and 1."""
    return df.agg(_loss(p).alias("log_loss"))


def _per_score(df: DataFrame, *keys: str, score: str = "score") -> DataFrame:
    return df.groupBy(*keys, score).agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg")
    )


def roc_curve(df: DataFrame, score: str = "score") -> DataFrame:
    """(score, tpr, fpr) for each distinct score taken as threshold."""
    per = _per_score(df, score=score)
    totals = per.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n"))).scalar()
    sums = running_totals(per, [F.desc(score)], {"tp": "pos", "fp": "neg"})
    return sums.select(
        score,
        F.try_divide("tp", totals.getField("p")).alias("tpr"),
        F.try_divide("fp", totals.getField("n")).alias("fpr"),
    )


def roc_auc(df: DataFrame, *groups: str, score: str = "score") -> DataFrame:
    """Area under the ROC curve by the trapezoid rule, per group if there are groups.

    The trapezoid of one score is its negatives times the mean number of positives above and
    up to it. One global running sum in (group, score) order serves all groups: what earlier
    groups added is taken off as a product of sums.
    """
    per = _per_score(df, *groups, score=score)
    order = [*[F.asc(g) for g in groups], F.desc(score)]
    sums = running_totals(per, order, {"seen": "pos"})
    before = F.min(F.col("seen") - F.col("pos"))
    area = F.sum(F.col("neg") * (F.col("seen") - F.col("pos") / 2)) - before * F.sum("neg")
    return sums.groupBy(*groups).agg(F.try_divide(area, F.sum("pos") * F.sum("neg")).alias("auc"))


def value_counts_with_rate(df: DataFrame, score: str = "score") -> DataFrame:
    return df.groupBy(score).agg(F.count("*").alias("n"), F.avg("y").alias("rate"))


def _binned(df: DataFrame, score: str, n_bins: int) -> DataFrame:
    return df.groupBy(edge_bin(F.col(score), n_bins).alias("bin")).agg(
        F.count("*").alias("n"), F.avg(score).alias("mean_score"), F.avg("y").alias("rate")
    )


def calibration(df: DataFrame, score: str = "score", n_bins: int = 10) -> DataFrame:
    """Mean squared gap between predicted and observed rate per bin; lower is better."""
    gap = F.pow(F.col("mean_score") - F.col("rate"), 2)
    return _binned(df, score, n_bins).agg((F.sum(F.col("n") * gap) / F.sum("n")).alias("calibration"))


def discrimination(df: DataFrame, score: str = "score", n_bins: int = 10) -> DataFrame:
    """Mean squared gap between the bins' rates and the base rate; higher is better.

    As mean of squares minus square of mean, so the base rate needs no second pass.
    """
    n, rate = F.col("n"), F.col("rate")
    return _binned(df, score, n_bins).agg(
        (F.sum(n * rate * rate) / F.sum("n") - F.pow(F.sum(n * rate) / F.sum("n"), 2)).alias("discrimination")
    )


def metrics_report(df: DataFrame, group: str = "dataset") -> DataFrame:
    """One row per named set: confusion counts, accuracy, precision, recall, F1, log loss, AUC."""
    tp, fp, fn = _hits()
    counted = df.groupBy(group).agg(
        F.count("*").alias("n"),
        tp.alias("tp"),
        fp.alias("fp"),
        fn.alias("fn"),
        F.count_if((F.col("y") == 0) & (F.col("p") == 0)).alias("tn"),
        (F.avg((F.col("y") == F.col("p")).cast("double")) * 100).alias("accuracy"),
        *_rates(),
        _loss("p").alias("log_loss"),
    )
    return counted.join(roc_auc(df, group), group)
