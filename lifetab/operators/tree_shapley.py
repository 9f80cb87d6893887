"""Exact Shapley values of Spark's tree models (path-dependent), and kernel
Shapley values of any scoring function.

**Trees.**  The expectation given a set S of known features goes down a tree by
the row at splits on S and by the training cover at the others.  For one leaf
that is its value times a product over the features of its path: ``o`` (1 if
the row takes the path at all splits on the feature) for known ones, ``z`` (the
product of cover shares) for the others.  Shapley values of a product are sums
over subset sizes, the coefficients of the polynomial prod(z + o t), so a leaf
costs a few small vectors.  A row counts only by the 0/1 pattern of its ``o``,
so a batch of rows is worked off by its distinct patterns.

**Kernel.**  Shapley values are the solution of a weighted least-squares fit of
the coalitions' mean scores; the fit is linear in these scores, so its operator
is worked out once on the driver (features x coalitions) and the solution is a
sum over the distributed table of coalition scores.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import seeded_hash
from ..functions.sums import as_matrix
from ..session import scratch_path
from .models import classifier_of, predict

TREE_MODELS = ("RandomForestClassificationModel", "DecisionTreeClassificationModel", "GBTClassificationModel")


def tree_leaves(clf, spark) -> list[tuple]:
    """Every leaf of a fitted tree model: (path features, cover shares, splits
    (place among the features, threshold, goes left), value per class).  Read
    from the model's saved node table; its size is that of the model."""
    kind = clf.__class__.__name__
    if kind not in TREE_MODELS:
        raise ValueError(f"no tree model: {kind}")
    path = scratch_path(spark, "trees")
    clf.write().save(path)
    one = kind.startswith("Decision")
    rows = spark.read.parquet(f"{path}/data")
    rows = rows.select(F.lit(0).alias("tree"), F.struct(*rows.columns).alias("n")) if one else \
        rows.select(F.col("treeID").alias("tree"), F.col("nodeData").alias("n"))
    trees: dict[int, dict] = {}
    for r in rows.collect():
        trees.setdefault(r["tree"], {})[r["n"]["id"]] = r["n"]
    margin = kind.startswith("GBT")
    weight = clf.treeWeights if not one else [1.0]
    share = 1.0 if margin else 1.0 / sum(weight)
    out = []
    for t, nodes in sorted(trees.items()):
        # cover: training rows of a node (their weight); variance statistics start with it
        cover = {i: (n["impurityStats"][0] if margin else sum(n["impurityStats"])) for i, n in nodes.items()}
        stack = [(0, {}, [])]
        while stack:
            i, z, splits = stack.pop()
            n = nodes[i]
            if n["leftChild"] < 0:
                if margin:
                    value = np.array([-1.0, 1.0]) * n["prediction"]
                else:
                    value = np.array(n["impurityStats"]) / (sum(n["impurityStats"]) or 1.0)
                place = {f: k for k, f in enumerate(z)}
                out.append((np.array(list(z), int), np.array(list(z.values()), float),
                            [(place[f], thr, left) for f, thr, left in splits], value * weight[t] * share))
                continue
            f, s = n["split"]["featureIndex"], n["split"]
            if s["numCategories"] >= 0:
                raise ValueError("trees with categorical splits are not explained")
            for child, left in ((n["leftChild"], True), (n["rightChild"], False)):
                part = cover[child] / cover[i] if cover[i] else 0.0
                stack.append((child, z | {f: z.get(f, 1.0) * part}, [*splits, (f, s["leftCategoriesOrThreshold"][0], left)]))
    return out


def expected_value(leaves) -> np.ndarray:
    """Mean prediction per class over the training cover."""
    return sum(z.prod() * value for _, z, _, value in leaves)


def leaf_shares(o: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Shapley values of the product of z (unknown) or o (known) over features,
    for rows of 0/1 patterns ``o``."""
    n, d = o.shape
    weight = [math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d) for k in range(d)]
    out = np.zeros((n, d))
    for i in range(d):
        poly = np.zeros((d, n))
        poly[0] = 1.0
        for j in range(d):
            if j != i:
                poly[1:] = poly[1:] * z[j] + poly[:-1] * o[:, j]
                poly[0] *= z[j]
        out[:, i] = (o[:, i] - z[i]) * (np.array(weight)[:, None] * poly).sum(0)
    return out


def forest_values(x: np.ndarray, leaves, classes: int) -> np.ndarray:
    """Shapley values, rows x features x classes, of a batch of rows."""
    out = np.zeros((x.shape[0], x.shape[1], classes))
    for feats, z, splits, value in leaves:
        d = len(feats)
        if not d:
            continue
        o = np.ones((len(x), d), bool)
        for k, thr, left in splits:
            below = x[:, feats[k]] <= thr      # a missing value goes right, as in the model
            o[:, k] &= below if left else ~below
        codes, first, back = np.unique(o @ (1 << np.arange(d, dtype=np.int64)), return_index=True, return_inverse=True)
        shares = leaf_shares(o[first], z)[back]
        out[:, feats, :] += shares[:, :, None] * value
    return out


def shapley_tree(model, rows: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """Long (row_key, class, feature, value) of a fitted pipeline whose
    classifier is a tree, a forest or boosted trees.  Per row and class the
    values sum to the prediction less ``expected_value``: of the class
    probability, for boosted trees of the margin."""
    spark, features = rows.sparkSession, list(features)
    leaves = tree_leaves(classifier_of(model), spark)
    classes = len(leaves[0][3])
    p = len(features)
    held = spark.sparkContext.broadcast(leaves)     # as large as the model
    x = rows
    for stage in model.stages[:2]:
        x = stage.transform(x)
    x = x.select(F.col(key).alias("row_key"), vector_to_array("scaled").alias("x"))
    kind = x.schema["row_key"].dataType.simpleString()

    def explain(batches):
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                phi = forest_values(as_matrix(part.column("x"), p), held.value, classes)
                n = len(phi) * p * classes
                yield pa.RecordBatch.from_arrays(
                    [part.column("row_key").take(pa.array(np.repeat(np.arange(len(phi)), p * classes))),
                     pa.array(np.tile(np.arange(classes), len(phi) * p), pa.int32()),
                     pa.array(features).take(pa.array(np.tile(np.repeat(np.arange(p), classes), len(phi)))),
                     pa.array(phi.reshape(n))], names=["row_key", "class", "feature", "value"])

    return x.mapInArrow(explain, f"row_key {kind}, class int, feature string, value double")


# --------------------------------------------------------------------------- kernel
def coalition_design(p: int, samples: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(coalitions as 0/1 rows, weights): whole sizes from the outside in while
    they fit ``samples``, then pairs of a random coalition and its complement
    that share the weight of the sizes left."""
    size_weight = np.array([0.0] + [(p - 1) / (s * (p - s)) for s in range(1, p)])
    masks, weights = [], []
    left, sizes = samples, list(range(1, p // 2 + 1))
    while sizes:
        s = sizes[0]
        both = {s, p - s}
        count = math.comb(p, s) * len(both)
        if count > left:
            break
        for k in sorted(both):
            for chosen in combinations(range(p), k):
                m = np.zeros(p, bool)
                m[list(chosen)] = True
                masks.append(m)
                weights.append(size_weight[k] / math.comb(p, k))
        left -= count
        sizes.pop(0)
    if sizes and left >= 2:
        rng = np.random.default_rng(seed)
        mass = np.array([size_weight[s] * (1 if 2 * s == p else 2) for s in sizes])
        drawn: dict[bytes, int] = {}
        for s in rng.choice(sizes, size=left // 2, p=mass / mass.sum()):
            m = np.zeros(p, bool)
            m[rng.choice(p, s, replace=False)] = True
            for half in (m, ~m):
                drawn[half.tobytes()] = drawn.get(half.tobytes(), 0) + 1
        total = sum(drawn.values())
        for m, n in sorted(drawn.items()):
            masks.append(np.frombuffer(m, bool))
            weights.append(mass.sum() * n / total)
    return np.array(masks, bool).reshape(-1, p), np.array(weights)


def kernel_operator(masks: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Linear map from the scores of (coalitions, all features, none) to the
    Shapley values: weighted least squares under the constraint that the values
    sum to score(all) - score(none)."""
    n, p = masks.shape
    out = np.zeros((p, n + 2))
    if p > 1:
        x = masks[:, :-1].astype(float) - masks[:, -1:]
        a = np.linalg.pinv(x.T @ (weights[:, None] * x)) @ (x * weights[:, None]).T
        last = a @ masks[:, -1].astype(float)
        out[:-1, :n] = a
        out[:-1, n] = -last
        out[:-1, n + 1] = last - a.sum(1)
    out[-1, n], out[-1, n + 1] = 1.0, -1.0
    out[-1] -= out[:-1].sum(0)
    return out


def class_probabilities(model) -> Callable[[DataFrame], DataFrame]:
    """Scoring function of a fitted classifier pipeline."""
    return lambda df: predict(model, df).withColumn("value", vector_to_array("probability"))


def shapley_kernel(score: Callable[[DataFrame], DataFrame], rows: DataFrame, background: DataFrame, key: str,
                   features: Sequence[str], samples: int | None = None, seed: int = 42) -> DataFrame:
    """Long (row_key, class, feature, value).  ``score`` adds ``value``, an array
    of outputs, to a table with the features.  A coalition's score is the mean
    over the background rows with the coalition's features from the explained
    row.  With all 2^p - 2 coalitions within ``samples`` (2 p + 2048) the values
    are exact.  ``background`` must be a sample of at most 10,000 rows: rows x
    coalitions x background points are scored."""
    features = list(features)
    p = len(features)
    spark = rows.sparkSession
    masks, weights = coalition_design(p, samples or 2 * p + 2048, seed)
    operator = kernel_operator(masks, weights)
    masks = np.vstack([masks, np.ones((1, p), bool), np.zeros((1, p), bool)])
    table = F.broadcast(spark.createDataFrame(
        [(s, m.tolist(), operator[:, s].tolist()) for s, m in enumerate(masks)], "_s int, _mask array<boolean>, _op array<double>"))
    held = background.select(*[F.col(f).cast("double").alias(f) for f in features]).limit(10_001).collect()
    if not held or len(held) > 10_000:
        raise ValueError("the background must be a sample of 1 to 10,000 rows")
    base = F.broadcast(spark.createDataFrame([(b, *r) for b, r in enumerate(held)],
                                             "_b int, " + ", ".join(f"`_g{j}` double" for j in range(p))))
    x = rows.select(F.col(key).alias("row_key"), *[F.col(f).cast("double").alias(f"_x{j}") for j, f in enumerate(features)])
    x = x.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(masks) - 1))).alias("_s"))
    x = x.repartition(seeded_hash(seed, "row_key", "_s")).join(table.drop("_op"), "_s")
    x = x.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(held) - 1))).alias("_b")).join(base, "_b")
    points = x.select("row_key", "_s", *[F.when(F.col("_mask")[j], F.col(f"_x{j}")).otherwise(F.col(f"_g{j}")).alias(f)
                                         for j, f in enumerate(features)])
    scored = score(points).select("row_key", "_s", F.posexplode("value").alias("class", "v"))
    mean = scored.groupBy("row_key", "class", "_s").agg(F.avg("v").alias("v"))
    each = mean.join(table.drop("_mask"), "_s")
    sums = each.groupBy("row_key", "class").agg(*[F.sum(F.col("_op")[j] * F.col("v")).alias(f"_f{j}") for j in range(p)])
    return sums.select("row_key", "class", F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"_f{j}").alias("value")) for j, f in enumerate(features)])).alias("s")) \
        .select("row_key", "class", "s.feature", "s.value")
