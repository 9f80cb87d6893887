"""Group fairness of binary predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import require_columns


def most_frequent(df: DataFrame, col: str):
    """Most frequent value that is not NULL (ties -> smallest value): a grouped
    count, then a top-1 of the small per-value table."""
    r = (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
         .orderBy(F.col("_n").desc(), F.col(col).asc()).limit(1).collect())
    return r[0][col] if r else None


def fairness_audit(df: DataFrame, attr: str, label: str, pred: str,
                   privileged: Sequence | None = None, unprivileged: Sequence | None = None) -> DataFrame:
    """(metric, value) rows:

    demographic_parity_difference  P(pred=1 | unpriv) - P(pred=1 | priv)
    equal_opportunity_difference   TPR_unpriv - TPR_priv
    average_odds_difference        ((FPR_u - FPR_p) + (TPR_u - TPR_p)) / 2

    Default privileged group = the most frequent attribute value;
    unprivileged = every other value, pooled.  One conditional aggregate
    (TP/FP/TN/FN per side) over the data.
    """
    require_columns(df, [attr, label, pred])
    if privileged is None:
        privileged = [most_frequent(df, attr)]
    priv = F.col(attr).isin(list(privileged))
    unpriv = F.col(attr).isin(list(unprivileged)) if unprivileged is not None else ~priv
    y, yh = F.col(label).cast("int"), F.col(pred).cast("int")

    def cnt(cond):
        return F.sum(F.when(cond, 1).otherwise(0))

    aggs = []
    for side, g in (("p", priv), ("u", unpriv)):
        aggs += [cnt(g).alias(f"n_{side}"), cnt(g & (yh == 1)).alias(f"pp_{side}"),
                 cnt(g & (y == 1) & (yh == 1)).alias(f"tp_{side}"), cnt(g & (y == 1)).alias(f"pos_{side}"),
                 cnt(g & (y == 0) & (yh == 1)).alias(f"fp_{side}"), cnt(g & (y == 0)).alias(f"neg_{side}")]
    a = df.agg(*aggs)

    def rate(num, den):
        return F.when(F.col(den) > 0, F.col(num) / F.col(den))

    spd = rate("pp_u", "n_u") - rate("pp_p", "n_p")
    eod = rate("tp_u", "pos_u") - rate("tp_p", "pos_p")
    fpd = rate("fp_u", "neg_u") - rate("fp_p", "neg_p")
    aod = (fpd + eod) / 2
    return a.select(F.explode(F.array(
        F.struct(F.lit("demographic_parity_difference").alias("metric"), spd.alias("value")),
        F.struct(F.lit("equal_opportunity_difference").alias("metric"), eod.alias("value")),
        F.struct(F.lit("average_odds_difference").alias("metric"), aod.alias("value")))).alias("m")
    ).select("m.metric", "m.value")
