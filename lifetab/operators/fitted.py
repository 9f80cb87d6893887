"""Preprocessing as ``pyspark.ml`` estimators: z-score, ComBat, Yeo-Johnson,
iterative imputation, PCA.

``fit`` takes the statistics from the rows it is given (the training rows);
``transform`` applies them to any table, one projection each.  A fitted model
holds its statistics in the parameter ``state`` (numbers per feature, per
feature and batch, or per pair of features) and is saved with its parameters,
alone or as a stage of a ``PipelineModel``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import nan_to_null
from ..functions.sums import as_matrix, column_moments, cross_products, sum_over, vector_column
from ..session import cut_lineage


class _Fitted(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """A model whose statistics are one parameter."""
    state = Param(Params._dummy(), "state", "fitted statistics")

    def __init__(self, cols=None, state=None):
        super().__init__()
        if cols is not None:
            self._set(inputCols=list(cols), state=state)

    @property
    def stats(self) -> dict:
        return self.getOrDefault(self.state)

    def _replace(self, df: DataFrame, new: dict) -> DataFrame:
        """``df`` with some columns replaced, in the same order."""
        return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


class _Fit(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """An estimator over ``inputCols``."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)


def _number(x) -> float | None:
    """A float that JSON can hold."""
    return None if x is None or not np.isfinite(x) else float(x)


def _scaled(c, mean, std):
    """(c - mean) / std; 0 where the deviation is 0 or undefined."""
    return (c - F.lit(mean)) / F.lit(std) if std else F.lit(0.0)


# --------------------------------------------------------------------------- B3
class ZScore(_Fit):
    """Appends ``z_<column>``; missing cells stay missing."""

    def _fit(self, df):
        cols = self.getInputCols()
        _, mean, std = column_moments(df, cols) if cols else ((), (), ())
        return ZScoreModel(cols, {"mean": [*map(_number, mean)], "std": [*map(_number, std)]})


class ZScoreModel(_Fitted):
    def _transform(self, df):
        s = self.stats
        return df.select("*", *[_scaled(nan_to_null(c), m, d).alias(f"z_{c}")
                                for c, m, d in zip(self.getInputCols(), s["mean"], s["std"])])


# --------------------------------------------------------------------------- F3
class ComBat(_Fit):
    """Batch correction with the location and scale of every batch seen in
    ``fit``; rows of other batches, or of none, stay as they are."""
    batchCol = Param(Params._dummy(), "batchCol", "batch column", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, batchCol=None):
        Estimator.__init__(self)
        self._set(**self._input_kwargs)

    def _fit(self, df):
        from .transforms import combat_parameters
        cols, batch = self.getInputCols(), self.getOrDefault(self.batchCol)
        par = {}
        for r in combat_parameters(df, batch, cols).collect():      # features x batches rows
            par.setdefault(r["batch"], {})[r["feature"]] = [_number(r[k]) for k in ("alpha", "shift", "scale")]
        return ComBatModel(cols, {"batch": batch, "par": {b: [f.get(j) for j in range(len(cols))] for b, f in par.items()}})


class ComBatModel(_Fitted):
    def _transform(self, df):
        s, cols = self.stats, self.getInputCols()
        spark = df.sparkSession
        rows = [(b, [tuple(f) if f else None for f in fs]) for b, fs in sorted(s["par"].items())]
        table = spark.createDataFrame(rows, "_b string, _p array<struct<a: double, m: double, s: double>>")
        x = df.join(table, F.col(s["batch"]).cast("string") == F.col("_b"), "left")
        new = {}
        for j, c in enumerate(cols):
            p, v = F.get("_p", j), nan_to_null(c)
            new[c] = F.when(p["a"].isNull() | p["m"].isNull(), v).otherwise(p["a"] + (v - p["m"]) / p["s"])
        return x.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


# --------------------------------------------------------------------------- F4
class YeoJohnson(_Fit):
    """Power transform with the most likely lambda, then standardised."""

    def _fit(self, df):
        from .transforms import _yj, yeo_johnson_lambdas
        cols = self.getInputCols()
        lam = yeo_johnson_lambdas(df, cols) if cols else {}
        y = df.select(*[_yj(nan_to_null(c), lam[c]).alias(c) for c in cols])
        _, mean, std = column_moments(y, cols) if cols else ((), (), ())
        return YeoJohnsonModel(cols, {"lambda": [lam[c] for c in cols], "mean": [*map(_number, mean)],
                                      "std": [*map(_number, std)]})


class YeoJohnsonModel(_Fitted):
    def _transform(self, df):
        from .transforms import _yj
        s = self.stats
        return self._replace(df, {c: _scaled(_yj(nan_to_null(c), lam), m, d) for c, lam, m, d in zip(
            self.getInputCols(), s["lambda"], s["mean"], s["std"])})


# --------------------------------------------------------------------------- F5
def _replay(x: np.ndarray, gone: np.ndarray, steps) -> np.ndarray:
    """Applies regressions (column, coefficients) in turn to the missing cells."""
    for j, coef in steps:
        rows = gone[:, j]
        if rows.any():
            x[rows, j] = coef[0] + np.delete(x[rows], j, 1) @ coef[1:]
    return x


class IterativeImputer(_Fit):
    """Round-robin regression imputation.

    On standardised columns, missing cells start at the mean.  A round visits
    the incomplete columns, fewest missing cells first; a column's regression
    on all others (a small ridge on all but the intercept) is solved from one
    Gram matrix over the rows that have it, summed over Arrow batches, and
    fills its missing cells.  Stops when no filled cell moved by more than
    ``tol`` times the largest absolute value.  ``transform`` replays the
    regressions in turn.  A column without any value stays missing.
    """
    rounds = Param(Params._dummy(), "rounds", "most rounds", typeConverter=TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "relative tolerance", typeConverter=TypeConverters.toFloat)
    ridge = Param(Params._dummy(), "ridge", "penalty", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, rounds=10, tol=1e-3, ridge=1e-6):
        Estimator.__init__(self)
        self._setDefault(rounds=10, tol=1e-3, ridge=1e-6)
        self._set(**self._input_kwargs)

    def _fit(self, df):
        cols = self.getInputCols()
        p = len(cols)
        n, mean, std = column_moments(df, cols) if cols else (np.zeros(0),) * 3
        known = n > 0
        mean, std = np.where(known, mean, 0.0), np.where(known & (std > 0), std, 1.0)
        x = df.select(vector_column(cols))
        top = x.agg(F.count(F.lit(1)), F.max(F.array_max(F.transform("x", F.abs)))).first()
        todo = sorted((int(j) for j in range(p) if known[j] and n[j] < top[0]), key=lambda j: (-n[j], j))
        scale, rounds = top[1] or 1.0, []

        def start(batches):
            for b in batches:
                m = as_matrix(b.column("x"), p)
                gone = np.isnan(m)
                z = np.where(gone, 0.0, (m - mean) / std)
                yield _state(z, gone, np.zeros(len(m)))

        kind = "x array<double>, gone array<boolean>, moved double"
        now = cut_lineage(x.mapInArrow(start, kind)) if todo else None
        for _ in range(self.getOrDefault(self.rounds) if todo else 0):
            steps = []
            for j in todo:
                def gram(batches, j=j, steps=tuple(steps)):
                    out = np.zeros((p, p + 1))
                    for b in batches:
                        z, gone = _cells(b, p)
                        z = _replay(z, gone, steps)[~gone[:, j]]
                        a = np.column_stack([np.ones(len(z)), np.delete(z, j, 1)])
                        out += a.T @ np.column_stack([a, z[:, j]])
                    return out.ravel()

                g = sum_over(now, gram, p * (p + 1)).reshape(p, p + 1)
                penalty = self.getOrDefault(self.ridge) * g[0, 0] * np.eye(p)
                penalty[0, 0] = 0.0
                steps.append((j, np.linalg.lstsq(g[:, :p] + penalty, g[:, p], rcond=None)[0]))

            def fill(batches, steps=tuple(steps)):
                for b in batches:
                    z, gone = _cells(b, p)
                    new = _replay(z.copy(), gone, steps)
                    yield _state(new, gone, (np.abs(new - z) * std).max(1))

            now = cut_lineage(now.mapInArrow(fill, kind))
            rounds.append([[j, c.tolist()] for j, c in steps])
            if (now.agg(F.max("moved")).first()[0] or 0.0) < self.getOrDefault(self.tol) * scale:
                break
        return IterativeImputerModel(cols, {"mean": mean.tolist(), "std": std.tolist(), "known": known.tolist(),
                                            "steps": [s for r in rounds for s in r]})


def _state(z, gone, moved):
    p = z.shape[1]
    offsets = pa.array(np.arange(len(z) + 1) * p, pa.int32())
    return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(z.ravel())),
                                       pa.ListArray.from_arrays(offsets, pa.array(gone.ravel())), pa.array(moved)],
                                      names=["x", "gone", "moved"])


def _cells(batch, p):
    gone = batch.column("gone").flatten().to_numpy(zero_copy_only=False).reshape(-1, p).astype(bool)
    return as_matrix(batch.column("x"), p).copy(), gone


class IterativeImputerModel(_Fitted):
    def _transform(self, df):
        s, cols = self.stats, self.getInputCols()
        p = len(cols)
        mean, std, known = (np.array(s[k]) for k in ("mean", "std", "known"))
        steps = [(j, np.array(c)) for j, c in s["steps"]]

        @F.arrow_udf("array<double>")
        def filled(x: pa.Array) -> pa.Array:
            m = as_matrix(x, p)
            gone = np.isnan(m)
            z = _replay(np.where(gone, 0.0, (m - mean) / std), gone, steps) * std + mean
            z[:, ~known] = np.nan
            return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * p, pa.int32()),
                                            pa.array(z.ravel(), from_pandas=True))

        if not cols:
            return df
        x = df.select("*", filled(vector_column(cols)).alias("_filled"))
        return x.select(*[F.coalesce(nan_to_null(c), F.get("_filled", cols.index(c))).alias(c) if c in cols else F.col(c)
                          for c in df.columns])


# --------------------------------------------------------------------------- F6
class PCAScores(_Fit):
    """Appends ``pca_1..pca_k``, the scores on the principal axes of the rows
    without missing cells; every axis is signed so that its largest loading is
    positive.  Rows with a missing cell get NULL."""
    k = Param(Params._dummy(), "k", "axes", typeConverter=TypeConverters.toInt)
    prefix = Param(Params._dummy(), "prefix", "name of the scores", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, k=50, prefix="pca_"):
        Estimator.__init__(self)
        self._setDefault(k=50, prefix="pca_")
        self._set(**self._input_kwargs)

    def _fit(self, df):
        cols = self.getInputCols()
        n, total, _ = cross_products(df, cols)
        mean = total / n if n else total
        _, _, gram = cross_products(df, cols, mean)
        values, axes = np.linalg.eigh(gram / max(n - 1, 1))
        k = min(self.getOrDefault(self.k), len(cols))
        values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
        axes = axes * np.where(axes[np.abs(axes).argmax(0), np.arange(k)] < 0, -1.0, 1.0)
        return PCAScoresModel(cols, {"mean": mean.tolist(), "axes": axes.tolist(), "variance": values.tolist(),
                                     "prefix": self.getOrDefault(self.prefix)})


class PCAScoresModel(_Fitted):
    def _transform(self, df):
        s, cols = self.stats, self.getInputCols()
        mean, axes = np.array(s["mean"]), np.array(s["axes"])
        p, k = axes.shape

        @F.arrow_udf("array<double>")
        def scores(x: pa.Array) -> pa.Array:
            y = (as_matrix(x, p) - mean) @ axes
            return pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * k, pa.int32()),
                                            pa.array(y.ravel(), from_pandas=True))

        x = df.select("*", scores(vector_column(cols)).alias("_scores"))
        return x.select(*df.columns, *[F.get("_scores", i).alias(f"{s['prefix']}{i + 1}") for i in range(k)])
