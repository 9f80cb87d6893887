"""Reproducible splits, folds, samples and bootstrap replicates.

Every assignment is a function of (seed, row key): a rerun, a retried task
or another cluster size gives the same rows.  Ranks inside a class come from
``rank_in_group``, which slices each class by the top bits of a uniform hash,
so the largest class is spread over many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import seeded_hash, seeded_uniform
from ..functions.ordered import _join_keys, rank_in_group, running_sums


ROWS_PER_PART = 1 << 20    # of a ``training_table``


def _ranked(df: DataFrame, by: Sequence[str], key: str, seed: int) -> DataFrame:
    x = df.withColumn("_h", seeded_hash(seed, key))
    return rank_in_group(x, by, "_h", [key], rank_col="_rank", size_col="_n")


def _assign(r: DataFrame, cols: Sequence[str], test: float, val: float, out: str) -> DataFrame:
    n = F.col("_n")
    n_test = F.floor(n * F.lit(float(test)) + F.lit(0.5))
    vf = val / (1.0 - test) if 0.0 < val < 1.0 else 0.0
    n_val = F.floor((n - n_test) * F.lit(float(vf)) + F.lit(0.5))
    rk = F.col("_rank")
    split = (F.when(rk <= n_test, F.lit("test"))
             .when(rk <= n_test + n_val, F.lit("val"))
             .otherwise(F.lit("train")))
    return r.select(*cols, split.alias(out))


def stratified_split(df: DataFrame, label: str, key: str, test: float = 0.2, val: float = 0.0,
                     seed: int = 42, out: str = "split") -> DataFrame:
    """Per class with n_c rows: the first round(n_c * test) rows in seeded-hash
    order are ``test``; of the rest, round(rest * val / (1 - test)) are
    ``val`` (only when 0 < val < 1); the others ``train``."""
    return _assign(_ranked(df, [label], key, seed), df.columns, test, val, out)


def random_split(df: DataFrame, key: str, test: float = 0.2, val: float = 0.0, seed: int = 42,
                 out: str = "split") -> DataFrame:
    """Unstratified form of ``stratified_split`` (one group; used for survival)."""
    return _assign(_ranked(df, [], key, seed), df.columns, test, val, out)


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42,
                     out: str = "fold") -> DataFrame:
    """Shuffled stratified k-fold: fold = (rank in class - 1) mod k, so fold
    sizes differ by at most one per class."""
    r = _ranked(df, [label], key, seed)
    return r.select(*df.columns, F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int").alias(out))


def ordered_folds(df: DataFrame, label: str | None, key: str, k: int = 5, out: str = "fold") -> DataFrame:
    """Unshuffled folds: contiguous blocks of the rows in key order, inside
    every class when ``label`` is given.

    Block sizes are those of dealing the rows, class after class (in the order
    of their first keys), to the folds in turn: they differ by at most one per
    class and overall.  The key must be numeric (ranks by bucketed running
    counts).  The classes are assumed to fit the driver.
    """
    by = [label] if label else []
    counts = running_sums(df.select(*by, key, F.lit(1).alias("_one")), [key], ["_one"], by=by)
    ranks = counts.select(*by, key, (F.col("cum__one") - 1).alias("_rank"))
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.min(key).alias("_first"))
    before = F.sum("_n").over(Window.orderBy("_first").rowsBetween(Window.unboundedPreceding, -1))  # a row per class
    sizes = sizes.select(*by, "_n", F.coalesce(before, F.lit(0)).alias("_at"))
    x = _join_keys(df, ranks, [*by, key])
    x = _join_keys(x, sizes, by) if by else x.crossJoin(F.broadcast(sizes))
    # places at .. at + n - 1 of the deal fall to fold j as often as they leave remainder j
    held = [F.floor((F.col("_at") + F.col("_n") - 1 - j) / k) - F.floor((F.col("_at") - 1 - j) / k) for j in range(k)]
    fold, upto = F.lit(0), F.lit(0)
    for j in range(k - 1):
        upto = upto + held[j]
        fold = fold + F.when(F.col("_rank") >= upto, 1).otherwise(0)
    return x.select(*df.columns, fold.cast("int").alias(out))


def training_table(df: DataFrame) -> DataFrame:
    """``df`` in memory, in as many parts as the cluster runs tasks, more only
    for many rows: each pass of a fit is a job with one small result per part,
    so the parts follow the rows, not the bytes that were read for them.  The
    caller releases it with ``unpersist``."""
    from ..session import cut_lineage
    x = cut_lineage(df)    # computed once: counted, then dealt out
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-x.count() // ROWS_PER_PART))
    return x.repartition(parts).persist()


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """At most n rows without replacement: the n smallest seeded hashes (a
    distributed top-n, ``TakeOrderedAndProject``)."""
    h = seeded_hash(seed, key)
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


def poisson_weight(u: Column, max_k: int = 12) -> Column:
    """Poisson(1) draw from a uniform by inverse CDF: the number of CDF
    thresholds (from the pmf) at or below u, as plain compiled comparisons."""
    cdf, acc = [], 0.0
    for j in range(max_k):
        acc += math.exp(-1.0) / math.factorial(j)
        cdf.append(acc)
    return sum((F.when(u >= F.lit(c), 1).otherwise(0) for c in cdf), F.lit(0))


def bootstrap_metric(df: DataFrame, value: str, key: str, replicates: int = 500, seed: int = 42,
                     alpha: float = 0.05, weight: str | None = None) -> DataFrame:
    """Poisson bootstrap of a mean (e.g. accuracy = mean of correct).

    Replicate b gives row i the weight Poisson(1) drawn from hash(seed, key,
    b); the replicate statistic is sum(w x) / sum(w).  Rows x replicates are
    generated inside the scan (``explode``) and folded by a partial
    aggregate per task, so only replicates x tasks partial rows are shuffled.
    Output: estimate (full-data mean), lower and upper percentile bounds,
    replicates.
    """
    x = df.select(F.col(key).alias("_k"), F.col(value).cast("double").alias("_v"),
                  (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("_w0"))
    est = x.agg((F.sum(F.col("_v") * F.col("_w0")) / F.sum("_w0")).alias("estimate"))
    reps = x.select("*", F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("_b"))
    w = poisson_weight(seeded_uniform(seed, "_k", "_b")).cast("double") * F.col("_w0")
    stat = (reps.withColumn("_pw", w).groupBy("_b")
            .agg((F.sum(F.col("_pw") * F.col("_v")) / F.sum("_pw")).alias("_s")))
    lohi = stat.agg(F.percentile(F.col("_s"), F.array(F.lit(alpha / 2), F.lit(1 - alpha / 2))).alias("_q"))
    return est.crossJoin(lohi).select(
        "estimate", F.col("_q")[0].alias("lower"), F.col("_q")[1].alias("upper"),
        F.lit(replicates).cast("long").alias("replicates"))
