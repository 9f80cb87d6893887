"""Average treatment effect under back-door adjustment.

The causal graph is fixed by the arguments: treatment -> outcome and every
confounder -> treatment, confounder -> outcome.  The adjustment set is
therefore the confounders; no graph text is parsed.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import require_columns
from ..functions.ordered import asof_lookup, global_row_index
from ..session import cut_lineage


def ols(df: DataFrame, y: str, xs: Sequence[str]) -> np.ndarray:
    """Least squares with intercept from one pass of centred cross products
    (``covar_pop`` for every pair, numerically stable); the (p x p) system is
    solved on the driver.  Returns [intercept, b_1..b_p]."""
    xs = list(xs)
    p = len(xs)
    aggs = [F.avg(c).alias(f"m{i}") for i, c in enumerate(xs)] + [F.avg(y).alias("my")]
    aggs += [F.covar_pop(xs[i], xs[j]).alias(f"c{i}_{j}") for i in range(p) for j in range(i, p)]
    aggs += [F.covar_pop(xs[i], y).alias(f"cy{i}") for i in range(p)]
    r = df.select(*[F.col(c).cast("double").alias(c) for c in set(xs + [y])]).dropna().agg(*aggs).collect()[0]
    C = np.zeros((p, p))
    for i in range(p):
        for j in range(i, p):
            C[i, j] = C[j, i] = r[f"c{i}_{j}"]
    cy = np.array([r[f"cy{i}"] for i in range(p)])
    b = np.linalg.solve(C, cy) if p > 1 else cy / C[0, 0]
    b0 = r["my"] - sum(b[i] * r[f"m{i}"] for i in range(p))
    return np.concatenate([[b0], b])


def _propensity(df: DataFrame, t: str, confounders: Sequence[str]) -> DataFrame:
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    va = VectorAssembler(inputCols=list(confounders), outputCol="_f", handleInvalid="skip")
    x = va.transform(df.withColumn("_tt", F.col(t).cast("double")))
    m = LogisticRegression(featuresCol="_f", labelCol="_tt", maxIter=100, regParam=0.0).fit(x)
    return m.transform(x).withColumn("_ps", vector_to_array("probability")[1]).drop("_f", "rawPrediction",
                                                                                   "probability", "prediction")


def matched_effect(df: DataFrame, treatment: str, outcome: str, score: str) -> DataFrame:
    """One row (ate, att, atc): every row is compared with the rows of the
    other group whose ``score`` is nearest (their mean outcome where several
    are), with replacement.

    Rows are first reduced to distinct (group, score).  The nearest score of
    the other group is the nearer of its last one at or below and its first one
    at or above, two as-of lookups over value ranges (carried across bucket
    borders), so no pairs are formed.  Rows with a missing treatment, outcome
    or score take no part; without rows in both groups the result is NULL.
    """
    t = F.col(treatment).cast("int")
    x = df.select(t.alias("t"), F.col(outcome).cast("double").alias("y"), F.col(score).cast("double").alias("s")).dropna()
    per = cut_lineage(x.groupBy("t", "s").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y")))
    sums = None
    for group in (1, 0):
        own = per.where(F.col("t") == group).withColumn("m", -F.col("s"))
        other = per.where(F.col("t") == 1 - group).select(F.col("s").alias("ds"), (-F.col("s")).alias("dm"),
                                                           F.col("n").alias("dn"), F.col("y").alias("dy"))
        side = {"lo": ("s", "ds"), "hi": ("m", "dm")}
        for name, (mine, theirs) in side.items():
            steps = other.select(F.col(theirs).alias("at"), F.col("ds").alias(f"{name}_s"), F.col("dn").alias(f"{name}_n"),
                                 F.col("dy").alias(f"{name}_y"))
            own = asof_lookup(steps, own, mine, "at", [f"{name}_s", f"{name}_n", f"{name}_y"])
        low, high = F.col("s") - F.col("lo_s"), F.col("hi_s") - F.col("s")
        # at equal distances both sides count; an equal score is one and the same row on both
        use_low = F.col("lo_s").isNotNull() & (F.col("hi_s").isNull() | (low <= high))
        use_high = F.col("hi_s").isNotNull() & (F.col("lo_s").isNull() | ((high <= low) & (F.col("hi_s") != F.col("lo_s"))))
        total = F.when(use_low, F.col("lo_y")).otherwise(0.0) + F.when(use_high, F.col("hi_y")).otherwise(0.0)
        count = F.when(use_low, F.col("lo_n")).otherwise(0) + F.when(use_high, F.col("hi_n")).otherwise(0)
        gap = (F.col("y") - F.col("n") * total / F.nullif(count, F.lit(0))) * (1 if group else -1)
        one = own.agg(F.lit(group).alias("t"), F.sum("n").alias("n"), F.sum(gap).alias("gap"))
        sums = one if sums is None else sums.unionByName(one)
    treated = F.col("t") == 1
    whole = sums.agg(F.sum("gap").alias("gap"), F.sum("n").alias("n"), F.count("gap").alias("sides"),
                     F.max(F.when(treated, F.col("gap") / F.col("n"))).alias("att"),
                     F.max(F.when(~treated, F.col("gap") / F.col("n"))).alias("atc"))
    return whole.select(F.when(F.col("sides") == 2, F.col("gap") / F.col("n")).alias("ate"), "att", "atc")


def treatment_effect(df: DataFrame, treatment: str, outcome: str, confounders: Sequence[str] = (),
                     method: str = "backdoor.linear_regression", strata: int = 5, clip: float = 1e-6) -> DataFrame:
    """One row (method, ate).

    ``backdoor.linear_regression``: coefficient of the treatment in the OLS
    of outcome on treatment + confounders.
    ``backdoor.propensity_score_weighting``: Hajek-normalised inverse
    propensity weighting, propensities from logistic regression.
    ``backdoor.propensity_score_stratification``: strata of equal size by
    propensity rank; ATE = size-weighted mean of within-stratum differences
    over strata that hold both groups.
    ``backdoor.propensity_score_matching``: nearest neighbours by propensity
    (``matched_effect``).
    """
    require_columns(df, [treatment, outcome, *confounders])
    spark = df.sparkSession
    m = method.split(".")[-1]
    if m == "linear_regression":
        coef = ols(df, outcome, [treatment, *confounders])
        ate = float(coef[1])
        return spark.createDataFrame([(method, ate)], "method string, ate double")
    if not confounders:
        raise ValueError(f"{method} needs confounders")
    x = _propensity(df, treatment, confounders)
    ps = F.least(F.greatest(F.col("_ps"), F.lit(clip)), F.lit(1 - clip))
    t, y = F.col("_tt"), F.col(outcome).cast("double")
    if m == "propensity_score_weighting":
        r = x.agg((F.sum(t * y / ps) / F.sum(t / ps) -
                   F.sum((1 - t) * y / (1 - ps)) / F.sum((1 - t) / (1 - ps))).alias("ate"))
        return r.select(F.lit(method).alias("method"), "ate")
    if m == "propensity_score_stratification":
        idx = global_row_index(x.select("_tt", outcome, "_ps"), ["_ps", outcome, "_tt"], index_col="_i")
        n = idx.agg(F.count(F.lit(1)).alias("_n"))
        s = idx.crossJoin(F.broadcast(n)).withColumn("_s", F.floor(F.col("_i") * strata / F.col("_n")))
        per = s.groupBy("_s").agg(
            F.count(F.lit(1)).alias("ns"), F.avg(F.when(t == 1, y)).alias("y1"), F.avg(F.when(t == 0, y)).alias("y0"))
        ok = per.where("y1 IS NOT NULL AND y0 IS NOT NULL")
        r = ok.agg((F.sum(F.col("ns") * (F.col("y1") - F.col("y0"))) / F.sum("ns")).alias("ate"))
        return r.select(F.lit(method).alias("method"), "ate")
    if m == "propensity_score_matching":
        return matched_effect(x, "_tt", outcome, "_ps").select(F.lit(method).alias("method"), "ate")
    raise ValueError(f"unknown method {method}")
