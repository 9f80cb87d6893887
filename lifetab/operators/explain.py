"""Shapley-value explanations and their aggregation.

``shapley_linear`` is exact for models whose class margin is linear in the
standardised features.  ``shapley_sampled`` estimates Shapley values of any
fitted pipeline by permutation sampling: for each explained row, sampled
permutation and sampled background row it builds the p + 1 coalition points
along the permutation, scores all points in one ``transform`` and takes
differences of neighbouring coalitions (``lag`` inside each small
(row, permutation, background) group).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import seeded_hash, seeded_uniform
from .models import classifier_of, predict


def shapley_linear(model, df: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """phi_j = b_cj * (z_j - mean z_j) for every class margin c, z the
    standardised features (the pipeline's scaler), mean over ``df``.
    Output long (row_key, class, feature, value)."""
    features = list(features)
    scaler, clf = model.stages[1], classifier_of(model)
    mu = scaler.mean.toArray()
    sd = scaler.std.toArray()
    if hasattr(clf, "coefficientMatrix"):
        coef = clf.coefficientMatrix.toArray()
    else:
        coef = np.atleast_2d(clf.coefficients.toArray())
    z = [((F.col(f).cast("double") - float(mu[j])) / float(sd[j] if sd[j] else 1.0)).alias(f"_z{j}")
         for j, f in enumerate(features)]
    x = df.select(F.col(key).alias("row_key"), *z)
    means = x.agg(*[F.avg(f"_z{j}").alias(f"_m{j}") for j in range(len(features))])
    x = x.crossJoin(F.broadcast(means))
    entries = []
    for c in range(coef.shape[0]):
        for j, f in enumerate(features):
            entries.append(F.struct(F.lit(c).alias("class"), F.lit(f).alias("feature"),
                                    (F.lit(float(coef[c, j])) * (F.col(f"_z{j}") - F.col(f"_m{j}"))).alias("value")))
    return x.select("row_key", F.explode(F.array(*entries)).alias("s")).select(
        "row_key", "s.class", "s.feature", "s.value")


def _below(j):
    return lambda v: v < F.col("_u")[j]


def shapley_sampled(model, rows: DataFrame, background: DataFrame, key: str, features: Sequence[str],
                    permutations: int = 8, backgrounds: int = 8, seed: int = 42) -> DataFrame:
    """Permutation-sampling Shapley values of the class probabilities.

    Each explained row gets ``permutations`` feature orders and, per order,
    ``backgrounds`` background rows chosen by hash (an equi-join on the
    background index, not a cross product).  Output long (row_key, class,
    feature, value), averaged over the samples; per (row, class) the values
    sum to f(x) minus the mean f over the sampled background rows.
    """
    features = list(features)
    p = len(features)
    bg = background.select(F.col(key).alias("_bgi"), *[F.col(f).cast("double").alias(f) for f in features])
    # the background is a sample: its size is checked first, so the one
    # ordered task that numbers it 0..nb-1 (hash order) is bounded
    nb = bg.count()
    if nb > 100000:
        raise ValueError("background must be a sample (use splits.sample_n)")
    bg = bg.withColumn("_h", seeded_hash(seed, "_bgi"))
    w = Window.orderBy("_h", "_bgi")
    bg = bg.withColumn("_bg", F.row_number().over(w) - 1).drop("_h", "_bgi")
    r = rows.select(F.col(key).alias("row_key"), *[F.col(f).cast("double").alias(f"_x_{f}") for f in features])
    r = r.select("*", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))).alias("_perm"))
    # permutation as ranks of hashed feature positions
    rk = [seeded_uniform(seed, "row_key", "_perm", F.lit(j)) for j in range(p)]
    r = r.select("*", F.array(*rk).alias("_u"))
    r = r.select("*", F.explode(F.sequence(F.lit(0), F.lit(backgrounds - 1))).alias("_b"))
    r = r.withColumn("_bg", F.pmod(seeded_hash(seed, "row_key", "_perm", "_b"), F.lit(nb)))
    x = r.join(bg, "_bg")
    # coalition step i = 0..p: features whose permutation rank < i come from the row
    x = x.select("*", F.explode(F.sequence(F.lit(0), F.lit(p))).alias("_i"))
    rank = [F.size(F.filter("_u", _below(j))) for j in range(p)]
    cols = [F.when(rank[j] < F.col("_i"), F.col(f"_x_{f}")).otherwise(F.col(f)).alias(f)
            for j, f in enumerate(features)]
    # the feature added at step i (i >= 1) is the one with rank i - 1
    pts = x.select("row_key", "_perm", "_b", "_i", *cols,
                   F.get(F.array_compact(F.array(*[F.when(rank[j] == F.col("_i") - 1, F.lit(f))
                                                   for j, f in enumerate(features)])), 0).alias("feature"))
    scored = predict(model, pts).select("row_key", "_perm", "_b", "_i", "feature",
                                        vector_to_array("probability").alias("_p"))
    wgrp = Window.partitionBy("row_key", "_perm", "_b").orderBy("_i")
    diffs = scored.withColumn("_prev", F.lag("_p").over(wgrp)).where(F.col("_i") > 0)
    d = diffs.select("row_key", "feature", F.posexplode(F.zip_with("_p", "_prev", lambda a, b: a - b))
                     .alias("class", "value"))
    return d.groupBy("row_key", "class", "feature").agg(F.avg("value").alias("value"))


def feature_importance(shap_long: DataFrame) -> DataFrame:
    """Mean absolute value per feature: |phi| averaged over classes, then
    over rows; ordered by importance (descending), then name."""
    per_row = shap_long.groupBy("row_key", "feature").agg(F.avg(F.abs("value")).alias("_a"))
    return (per_row.groupBy("feature").agg(F.avg("_a").alias("importance"))
            .orderBy(F.col("importance").desc(), F.col("feature")))


def group_importance(importance: DataFrame, groups: DataFrame, group: str = "group",
                     feature: str = "feature") -> DataFrame:
    """Mean of the member features' importances per group; groups without a
    present feature are dropped; features may belong to several groups.
    ``groups`` is a (group, feature) table; the join strategy is left to AQE
    (a group map can be large: genes x pathways)."""
    g = groups.select(F.col(group).alias("group"), F.col(feature).alias("feature")).distinct()
    j = importance.join(g, "feature")
    return (j.groupBy("group").agg(F.avg("importance").alias("importance"))
            .orderBy(F.col("importance").desc(), F.col("group")))


def group_table(mapping: dict) -> list[tuple[str, str]]:
    """(group, feature) rows from a {group: [features]} mapping."""
    return [(g, f) for g, fs in mapping.items() for f in fs]
