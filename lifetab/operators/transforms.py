"""Preprocessing transforms: ComBat batch correction, Yeo-Johnson power
transform, iterative (round-robin regression) imputation, PCA scores, and
attaching gene-level features.

Each is split into a statistics step (distributed aggregates over the data,
producing a table bounded by features x batches or features x candidates)
and an apply step (one projection, or a join on the batch key).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import nan_to_null, numeric_columns
from ..session import cut_lineage


# --------------------------------------------------------------------------- F3
def _combat_eb(pdf: pd.DataFrame) -> pd.DataFrame:
    """Empirical-Bayes shrinkage for one batch over all features.
    Input columns: feature, n, gamma_hat, delta_hat (standardised scale)."""
    g = pdf["gamma_hat"].to_numpy(float)
    d = pdf["delta_hat"].to_numpy(float)
    n = pdf["n"].to_numpy(float)
    gbar = np.nanmean(g)
    t2 = np.nanvar(g, ddof=1) if np.sum(~np.isnan(g)) > 1 else 0.0
    ok = ~np.isnan(d)
    if ok.sum() > 1 and np.nanvar(d[ok], ddof=1) > 0:
        m, s2 = np.mean(d[ok]), np.var(d[ok], ddof=1)
        a, b = (2 * s2 + m * m) / s2, (m * s2 + m ** 3) / s2
    else:
        a = b = None
    ss = np.where(np.isnan(d), 0.0, d * np.maximum(n - 1, 0))  # within-batch sum of squares
    gs, ds = g.copy(), np.where(np.isnan(d), 1.0, d)
    if a is not None and t2 > 0:
        for _ in range(1000):
            g_new = (n * t2 * g + ds * gbar) / (n * t2 + ds)
            sum2 = ss + n * (g - g_new) ** 2
            d_new = (0.5 * sum2 + b) / (n / 2.0 + a - 1.0)
            d_new = np.where(np.isnan(d), 1.0, d_new)
            change = max(np.nanmax(np.abs(g_new - gs) / np.maximum(np.abs(gs), 1e-12)),
                         np.nanmax(np.abs(d_new - ds) / np.maximum(np.abs(ds), 1e-12)))
            gs, ds = g_new, d_new
            if change < 1e-4:
                break
    return pd.DataFrame({"batch": pdf["batch"], "feature": pdf["feature"], "gamma_star": gs, "delta_star": ds})


def combat(df: DataFrame, batch: str, cols: Sequence[str] | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """Parametric ComBat (location/scale, empirical Bayes), no covariates.

    Per feature: grand mean and pooled variance (residuals around the batch
    means, divided by n).  Per (feature, batch): gamma_hat = standardised
    batch mean, delta_hat = standardised batch variance.  Batch priors
    (normal for gamma, inverse gamma for delta, by moments) and the EB fixed
    point run per batch over the features (``applyInPandas`` grouped by
    batch; a group is one batch's feature table).  Rows are adjusted with
    x* = alpha + (x - alpha - sigma gamma*) / sqrt(delta*), parameters joined
    on the batch key.  A batch with one row is corrected in location only.
    Counts are of the values present; rows without a batch stay as they are.
    """
    from .fitted import ComBat
    cols = list(cols) if cols is not None else numeric_columns(df, exclude=[batch, *exclude])
    return ComBat(inputCols=cols, batchCol=batch).fit(df).transform(df)


def combat_parameters(df: DataFrame, batch: str, cols: Sequence[str]) -> DataFrame:
    """(batch, feature number, alpha, shift, scale) of the adjustment
    alpha + (x - shift) / scale: features x batches rows."""
    x = df.select("*", *[nan_to_null(c).alias(f"_v{j}") for j, c in enumerate(cols)])
    hat = _combat_hat(x, batch, cols)
    eb = hat.select(F.col("batch").cast("string").alias("batch"), "feature", "n", "gamma_hat", "delta_hat") \
        .groupBy("batch").applyInPandas(
            _combat_eb, "batch string, feature int, gamma_star double, delta_star double")
    par = hat.withColumn("batch", F.col("batch").cast("string")).join(eb, ["batch", "feature"])
    scale = F.when(F.col("delta_star") > 0, F.sqrt("delta_star")).otherwise(F.lit(1.0))
    return par.select("batch", "feature", "alpha",
                      F.when(F.col("sigma") > 0, F.col("alpha") + F.col("sigma") * F.col("gamma_star"))
                      .otherwise(F.col("alpha")).alias("shift"),
                      F.when(F.col("sigma") > 0, scale).otherwise(F.lit(1.0)).alias("scale"))


def combat_summary(df: DataFrame, batch: str, cols: Sequence[str]) -> DataFrame:
    """The location/scale step of ComBat: per (batch, feature) n, alpha (grand
    mean), sigma (pooled std), gamma_hat and delta_hat."""
    cols = list(cols)
    x = df.select("*", *[nan_to_null(c).alias(f"_v{j}") for j, c in enumerate(cols)])
    hat = _combat_hat(x, batch, cols)
    names = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("feature") + 1)
    return hat.select("batch", names.alias("feature"), "n", "alpha", "sigma", "gamma_hat", "delta_hat")


def _combat_hat(x: DataFrame, batch: str, cols: Sequence[str]) -> DataFrame:
    per = x.where(F.col(batch).isNotNull()).groupBy(F.col(batch).alias("batch")).agg(
        *[F.count(f"_v{j}").alias(f"n{j}") for j in range(len(cols))],
        *[F.avg(f"_v{j}").alias(f"m{j}") for j in range(len(cols))],
        *[F.var_samp(f"_v{j}").alias(f"v{j}") for j in range(len(cols))])
    # long (batch, feature) summary: batches x features rows
    long = per.select("batch", F.explode(F.array(*[
        F.struct(F.lit(j).alias("feature"), F.col(f"n{j}").alias("n"), F.col(f"m{j}").alias("m"), F.col(f"v{j}").alias("v"))
        for j in range(len(cols))])).alias("s")).select("batch", "s.n", "s.feature", "s.m", "s.v")
    tot = long.groupBy("feature").agg(F.sum("n").alias("ntot"),
                                      (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("alpha"))
    st = long.join(tot, "feature")
    # pooled variance = within-batch SS / N
    pooled = st.groupBy("feature").agg(
        (F.sum(F.coalesce(F.col("v"), F.lit(0.0)) * (F.col("n") - 1)) / F.first("ntot")).alias("s2"))
    st = st.join(pooled, "feature").withColumn("sigma", F.sqrt("s2"))
    sig = F.when(F.col("sigma") > 0, F.col("sigma"))
    return st.select("batch", "feature", "n", "alpha", "sigma",
                     ((F.col("m") - F.col("alpha")) / sig).alias("gamma_hat"),
                     (F.col("v") / (sig * sig)).alias("delta_hat"))


# --------------------------------------------------------------------------- F4
def _yj(x, lam: float, lp=None, ln=None):
    """Yeo-Johnson psi(x, lam); ``lp`` = ln(1 + x) and ``ln`` = ln(1 - x) may be
    passed precomputed (the candidate lambdas of one column share them)."""
    lp = F.log1p(x) if lp is None else lp
    ln = F.log1p(-x) if ln is None else ln
    pos = (F.exp(F.lit(lam) * lp) - 1.0) / lam if abs(lam) > 1e-12 else lp
    neg = -(F.exp(F.lit(2.0 - lam) * ln) - 1.0) / (2.0 - lam) if abs(lam - 2.0) > 1e-12 else -ln
    return F.when(x >= 0, pos).otherwise(neg)


def yeo_johnson_lambdas(df: DataFrame, cols: Sequence[str], lo: float = -2.0, hi: float = 4.0,
                        grid: int = 13, refine: int = 2, refine_points: int = 5) -> dict[str, float]:
    """Maximum-likelihood lambda per column.  LL(l) = -n/2 ln var(psi(x, l))
    + (l - 1) sum sign(x) ln(1 + |x|).

    Rows are first reduced to (value, count) per column.  Pass 1 evaluates
    ``grid`` lambdas on [lo, hi] for every column in one aggregate; a column
    whose best candidate lies on an edge gets a wider grid beyond that edge,
    again and again, so lambda is not bounded.  Then ``refine`` passes of
    ``refine_points`` lambdas close in on the optimum, the vertex of the
    parabola through the best candidate and its neighbours.
    """
    cols = list(cols)
    long = df.select(F.explode(F.array(*[F.struct(F.lit(j).alias("j"), nan_to_null(c).cast("double").alias("x"))
                                         for j, c in enumerate(cols)])).alias("z")).select("z.j", "z.x")
    vals = cut_lineage(long.where("x is not null").groupBy("j", "x").agg(F.count(F.lit(1)).alias("w")))
    sign = F.signum("x") * F.log1p(F.abs("x"))
    base = {r["j"]: (r["n"], r["s"]) for r in vals.groupBy("j").agg(F.sum("w").alias("n"), F.sum(sign * F.col("w")).alias("s")).collect()}

    def likelihood(cands: dict) -> dict:
        """Log-likelihood of every candidate: column number -> array."""
        table = F.create_map(*[v for j, lam in cands.items() for v in (F.lit(j), F.array(*[F.lit(float(l)) for l in lam]))])
        rows = vals.where(F.col("j").isin(list(cands))).select("j", "x", "w", F.posexplode(table[F.col("j")]).alias("i", "l"))
        up, down = F.log1p(F.greatest("x", F.lit(0.0))), F.log1p(-F.least("x", F.lit(0.0)))
        rest = F.lit(2.0) - F.col("l")
        psi = F.when(F.col("x") >= 0, F.when(F.abs("l") > 1e-12, F.expm1(F.col("l") * up) / F.col("l")).otherwise(up)).otherwise(
            F.when(F.abs(rest) > 1e-12, -F.expm1(rest * down) / rest).otherwise(-down))
        rows = rows.withColumn("p", psi)
        mid = rows.groupBy("j", "i").agg((F.sum(F.col("p") * F.col("w")) / F.sum("w")).alias("m"))
        var = rows.join(mid, ["j", "i"]).groupBy("j", "i").agg(
            (F.sum((F.col("p") - F.col("m")) ** 2 * F.col("w")) / F.sum("w")).alias("v")).collect()  # columns x candidates
        out = {j: np.full(len(lam), -np.inf) for j, lam in cands.items()}
        for r in var:
            n, own = base[r["j"]]
            if r["v"] is not None and np.isfinite(r["v"]) and r["v"] > 0:
                out[r["j"]][r["i"]] = -n / 2.0 * np.log(r["v"]) + (cands[r["j"]][r["i"]] - 1.0) * own
        return out

    best = {j: float(lo) for j in range(len(cols))}
    cands = {j: np.linspace(lo, hi, grid) for j in base}
    found: dict = {}
    while cands:    # widen beyond an edge until the best candidate is inside
        ll, wider = likelihood(cands), {}
        for j, lam in cands.items():
            k = int(np.argmax(ll[j]))
            top = ll[j][k]
            if not np.isfinite(top) or (j in found and top <= found[j][2]):
                continue
            found[j] = (lam, ll[j], top)
            reach = 2 * (lam[-1] - lam[0])
            if k == 0:
                wider[j] = np.linspace(lam[0] - reach, lam[1], grid)
            elif k == len(lam) - 1:
                wider[j] = np.linspace(lam[-2], lam[-1] + reach, grid)
        cands = wider

    def vertex(lam, ll):
        k = int(np.argmax(ll))
        if 0 < k < len(lam) - 1 and np.isfinite(ll[k - 1]) and np.isfinite(ll[k + 1]):
            den = ll[k - 1] - 2 * ll[k] + ll[k + 1]
            if den < 0:
                return float(lam[k] + 0.5 * (lam[1] - lam[0]) * (ll[k - 1] - ll[k + 1]) / den)
        return float(lam[k])

    step0 = (hi - lo) / (grid - 1)
    state = {j: (vertex(lam, ll), lam[1] - lam[0]) for j, (lam, ll, _) in found.items()}
    while coarse := {j: np.linspace(e - st, e + st, grid) for j, (e, st) in state.items() if st > step0 * 1.01}:
        ll = likelihood(coarse)
        state |= {j: (vertex(lam, ll[j]), lam[1] - lam[0]) for j, lam in coarse.items()}
    half = {j: step0 / 2 for j in state}
    for _ in range(refine if state else 0):
        near = {j: np.linspace(e - half[j], e + half[j], refine_points) for j, (e, _) in state.items()}
        ll = likelihood(near)
        state = {j: (vertex(lam, ll[j]), lam[1] - lam[0]) for j, lam in near.items()}
        half = {j: st / 4 for j, (_, st) in state.items()}
    best |= {j: e for j, (e, _) in state.items()}
    return {c: best[j] for j, c in enumerate(cols)}


def yeo_johnson(df: DataFrame, cols: Sequence[str] | None = None, exclude: Sequence[str] = (),
                standardize: bool = True, lambdas: dict | None = None) -> DataFrame:
    """Yeo-Johnson transform of each column with its ML lambda, then
    (optionally) standardised to mean 0 / population std 1."""
    from .features import zscore
    cols = list(cols) if cols is not None else numeric_columns(df, exclude=exclude)
    lam = lambdas or yeo_johnson_lambdas(df, cols)
    y = df.select(*[F.col(c) for c in df.columns if c not in cols],
                  *[_yj(nan_to_null(c), lam[c]).alias(c) for c in cols]).select(*df.columns)
    if not standardize:
        return y
    z = zscore(y, cols, prefix="_z_")
    return z.select(*[F.col(f"_z_{c}").alias(c) if c in cols else F.col(c) for c in df.columns])


# --------------------------------------------------------------------------- F5
def iterative_impute(df: DataFrame, cols: Sequence[str] | None = None, exclude: Sequence[str] = (),
                     rounds: int = 10, tol: float = 1e-3, ridge: float = 1e-6) -> DataFrame:
    """Round-robin regression imputation of a table by its own rows
    (``fitted.IterativeImputer``)."""
    from .fitted import IterativeImputer
    cols = list(cols) if cols is not None else numeric_columns(df, exclude=exclude)
    return IterativeImputer(inputCols=cols, rounds=rounds, tol=tol, ridge=ridge).fit(df).transform(df)


# --------------------------------------------------------------------------- F6
def pca_scores(df: DataFrame, cols: Sequence[str] | None = None, exclude: Sequence[str] = (), k: int = 50,
               prefix: str = "pca_") -> DataFrame:
    """Append ``pca_1..pca_k`` (k = min(k, #columns)): scores of the centred
    data on its own principal axes (``fitted.PCAScores``)."""
    from .fitted import PCAScores
    cols = list(cols) if cols is not None else numeric_columns(df, exclude=exclude)
    return PCAScores(inputCols=cols, k=k, prefix=prefix).fit(df).transform(df)


# --------------------------------------------------------------------------- F8
def attach_gene_features(df: DataFrame, tables: dict[str, DataFrame], gene: str = "gene",
                         value: str = "score") -> DataFrame:
    """Left join gene-level features (gene, value) onto the rows of each gene:
    one column per feature table instead of one constant column per gene."""
    out = df
    for name, t in tables.items():
        out = out.join(t.select(F.col("gene").alias(gene), F.col(value).alias(name)), gene, "left")
    return out
