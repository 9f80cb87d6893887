"""Classification metrics over prediction tables.

Inputs are long tables (row, label, class, score): one row per (prediction
row, class), which is what ``probabilities_long`` makes of a Spark ML
``probability`` vector.  AUROC and average precision need the rows in score
order; they use ``running_sums`` (pre-aggregated per distinct score,
value-range buckets), never a global single-task sort.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import materialize_if_large, running_sums


def probabilities_long(pred: DataFrame, key: str, label: str, prob: str = "probability",
                       classes: list | None = None) -> DataFrame:
    """(key, label, class, score) from a probability vector or array column.
    Class i is the i-th entry (or ``classes[i]``)."""
    arr = vector_to_array(F.col(prob)) if not pred.schema[prob].dataType.typeName() == "array" else F.col(prob)
    x = pred.select(F.col(key).alias("key"), F.col(label).alias("label"), F.posexplode(arr).alias("_i", "score"))
    if classes is not None:
        cls = F.element_at(F.array(*[F.lit(c) for c in classes]), F.col("_i") + 1)
    else:
        cls = F.col("_i")
    return x.select("key", "label", cls.alias("class"), F.col("score").cast("double"))


def _class_counts(long: DataFrame) -> DataFrame:
    pos = (F.col("label") == F.col("class")).cast("long")
    return long.select("class", "score", pos.alias("pos"), (F.lit(1) - pos).alias("neg"))


def auroc_per_class(long: DataFrame, known_rows: int | None = None) -> DataFrame:
    """One-vs-rest AUROC per class (Mann-Whitney, ties count one half):
    sum over positives of (#negatives with lower score + 0.5 #negatives with
    equal score) / (P N).  NULL when a class has no positive or no negative."""
    rs = running_sums(_class_counts(long), ["score"], ["pos", "neg"], by=["class"], known_rows=known_rows)
    below = F.col("cum_neg") - F.col("neg")
    contrib = F.col("pos") * (below + F.lit(0.5) * F.col("neg"))
    agg = rs.groupBy("class").agg(F.sum(contrib).alias("_u"), F.first("tot_pos").alias("_p"),
                                  F.first("tot_neg").alias("_n"))
    auc = F.when((F.col("_p") > 0) & (F.col("_n") > 0), F.col("_u") / (F.col("_p") * F.col("_n")))
    return agg.select("class", auc.alias("auroc"))


def average_precision_per_class(long: DataFrame, known_rows: int | None = None) -> DataFrame:
    """Average precision per class: sum over distinct thresholds (descending)
    of (R_n - R_n-1) P_n = sum of pos_t * precision(t) / P."""
    rs = running_sums(_class_counts(long), ["score"], ["pos", "neg"], by=["class"], descending=True,
                      known_rows=known_rows)
    prec = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    agg = rs.groupBy("class").agg(F.sum(F.col("pos") * prec).alias("_s"), F.first("tot_pos").alias("_p"))
    return agg.select("class", F.when(F.col("_p") > 0, F.col("_s") / F.col("_p")).alias("auprc"))


def accuracy(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    return pred.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def brier_long(long: DataFrame) -> DataFrame:
    """Multi-class Brier: mean over rows of sum over classes (p_c - 1[y = c])^2."""
    pos = (F.col("label") == F.col("class")).cast("double")
    # rows = pairs / classes (every row carries every class); the distinct
    # count is over the few class values, not over the row keys
    rows = F.count(F.lit(1)) / F.countDistinct("class")
    return long.agg((F.sum((F.col("score") - pos) ** 2) / rows).alias("brier"))


def classification_metrics(long: DataFrame, pred: DataFrame | None = None, label: str = "label",
                           prediction: str = "prediction", split: str | None = None) -> DataFrame:
    """(split, metric, value) with macro AUROC, macro AUPRC, accuracy, Brier.

    ``long`` = (key, label, class, score); ``pred`` = one row per key with the
    predicted label (for accuracy; when None the arg-max class is used).  A
    macro value is NULL (NaN in the reference) when any class's value is
    undefined.
    """
    long = materialize_if_large(long)  # scored once, read by five passes
    n = long.count()  # one measurement for both ordered passes
    au = auroc_per_class(long, n).agg(
        F.when(F.count("auroc") == F.count(F.lit(1)), F.avg("auroc")).alias("value")) \
        .select(F.lit("auroc").alias("metric"), "value")
    ap = average_precision_per_class(long, n).agg(
        F.when(F.count("auprc") == F.count(F.lit(1)), F.avg("auprc")).alias("value")) \
        .select(F.lit("auprc").alias("metric"), "value")
    if pred is None:
        best = long.groupBy("key", "label").agg(
            F.max(F.struct(F.col("score"), (-F.col("class").cast("double")).alias("nc"))).alias("_b"))
        pred = best.select("key", "label", (-F.col("_b.nc")).alias("prediction"))
        label, prediction = "label", "prediction"
    acc = accuracy(pred, label, prediction).select(F.lit("accuracy").alias("metric"),
                                                   F.col("accuracy").alias("value"))
    br = brier_long(long).select(F.lit("brier").alias("metric"), F.col("brier").alias("value"))
    out = au.unionByName(ap).unionByName(acc).unionByName(br)
    if split is not None:
        out = out.select(F.lit(split).alias("split"), "metric", "value")
    return out
