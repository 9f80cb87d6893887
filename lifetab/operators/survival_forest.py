"""Random survival forest: log-rank splits over histograms, Nelson-Aalen leaves.

Features are binned at quantiles, times at the distinct event times (or at
``time_bins`` quantiles of them).  All trees grow together, level by level: a
task finds the node of each of its rows in every tree and adds up, per open
node and drawn feature, events and exits by (bin, time); these sparse
histograms meet by (node, feature), where the log-rank statistic of every split
is evaluated, and only the best split of each reaches the driver.  A row's
number of draws in a tree is a Poisson(1) number of its key, so the forest does
not depend on partitions or retries.

Rows without a duration or an event take no part.  A missing feature goes right
at every split, in training and in scoring.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import nan_to_null
from ..functions.ordered import exact_quantiles
from ..functions.sums import as_matrix, vector_column
from ..session import cut_lineage

HIST_BYTES = 64 << 20       # histograms that a task holds at a time
TASK_ROWS = 50_000          # rows a task takes at least
# Cumulative probabilities of 0, 1, 2.. draws of a row in a bootstrap sample.
DRAWS = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(25)])


def event_grid(df: DataFrame, duration: str, event: str, time_bins: int) -> np.ndarray:
    """The distinct event times, or ``time_bins`` quantiles of the event times."""
    hits = df.where(F.col(event) == 1).select(F.col(duration).cast("double").alias("t")).where("t IS NOT NULL")
    found = [r["t"] for r in hits.select("t").distinct().orderBy("t").limit(time_bins + 1).collect()]
    if len(found) > time_bins:
        qs = [(i + 1) / time_bins for i in range(time_bins)]
        found = sorted({r["value"] for r in exact_quantiles(hits, "t", qs).collect()})
    return np.array(found, float)


def time_codes(t: np.ndarray, e: np.ndarray, grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(exit, event place): the number of grid times at which a row is at risk,
    and the grid time its event counts at (only for rows with an event)."""
    at = np.minimum(np.searchsorted(grid, t, "left"), len(grid) - 1)
    return np.where(e == 1, at + 1, np.searchsorted(grid, t, "right")), at


def logrank(d: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(statistic, rows left) of every split "bin <= b" from the events (bins x
    times) and exits (bins x (times + 1)) of a node."""
    risk = n[:, ::-1].cumsum(1)[:, ::-1][:, 1:]
    left_d, left_y, all_d, all_y = d.cumsum(0)[:-1], risk.cumsum(0)[:-1], d.sum(0), risk.sum(0)
    y = np.maximum(all_y, 1e-300)
    share = left_y / y
    gap = (left_d - share * all_d).sum(1)
    more = np.where(all_y > 1, (all_y - all_d) / np.where(all_y > 1, all_y - 1, 1.0), 0.0)
    var = (all_d * share * (1 - share) * more).sum(1)
    return np.where(var > 1e-12, gap ** 2 / np.maximum(var, 1e-12), 0.0), n.cumsum(0)[:-1].sum(1)


def _sparse(flat: np.ndarray) -> tuple[bytes, bytes]:
    at = np.flatnonzero(flat)
    return at.astype(np.int32).tobytes(), flat[at].tobytes()


def _add(out: np.ndarray, ats, values):
    for a, v in zip(ats, values):
        out[np.frombuffer(a.as_py(), np.int32)] += np.frombuffer(v.as_py())


HIST = "node int, slot int, at binary, v binary"


def _histograms(table: DataFrame, place, slots: np.ndarray, bins: int, times: int) -> DataFrame:
    """Sparse histograms (node, slot) of one task each.  ``place(codes, keys)``
    yields (rows, node of each row, draws) for every tree; ``slots`` has the
    features to look at, a row per node."""
    size = bins * (2 * times + 1)
    nodes, width = slots.shape

    def emit(batches):
        hist = np.zeros((nodes, width, size))
        flat = hist.reshape(-1)
        for b in batches:
            codes = np.frombuffer(b"".join(b.column("codes").to_pylist()), np.uint8).reshape(b.num_rows, -1)
            out, hit = b.column("out").to_numpy(), b.column("hit").to_numpy()
            ev = b.column("ev").to_numpy() == 1
            for rows, node, w in place(codes, b.column("h").to_numpy()):
                for s in range(width):
                    first = (node * width + s) * size + codes[rows, slots[node, s]].astype(np.int64) * (2 * times + 1)
                    np.add.at(flat, first + times + out[rows], w)
                    e = ev[rows]
                    np.add.at(flat, first[e] + hit[rows][e], w[e])
        rows = [(n, s, *_sparse(hist[n, s])) for n in range(nodes) for s in range(width) if hist[n, s].any()]
        cols = list(zip(*rows)) or [[]] * 4
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["node", "slot", "at", "v"])

    return table.mapInArrow(emit, HIST)


def _parts(flat: np.ndarray, bins: int, times: int):
    both = flat.reshape(bins, 2 * times + 1)
    return both[:, :times], both[:, times:]


def logrank_splits(df: DataFrame, duration: str, event: str, feature: str, thresholds: Sequence[float],
                   time_bins: int = 64) -> DataFrame:
    """(threshold, n_left, statistic) of the splits "feature <= threshold" of all rows."""
    spark, bounds = df.sparkSession, np.array(sorted(thresholds), float)
    grid = event_grid(df, duration, event, time_bins)
    table = _binned(df, duration, event, [feature], [bounds], grid, F.lit(0))
    bins, times = len(bounds) + 1, len(grid)
    every = lambda codes, keys: [(np.arange(len(codes)), np.zeros(len(codes), np.int64), np.ones(len(codes)))]
    hist = _histograms(table, every, np.zeros((1, 1), int), bins, times)

    def evaluate(t):
        flat = np.zeros(bins * (2 * times + 1))
        _add(flat, t.column("at"), t.column("v"))
        stat, left = logrank(*_parts(flat, bins, times))
        return pa.table({"threshold": bounds, "n_left": left.astype(np.int64), "statistic": stat})

    return hist.groupBy("node", "slot").applyInArrow(evaluate, "threshold double, n_left long, statistic double")


def _binned(df, duration, event, features, bounds, grid, key) -> DataFrame:
    p = len(features)
    src = df.select(F.xxhash64(key).alias("h"), F.col(duration).cast("double").alias("t"),
                    F.col(event).cast("int").alias("e"), vector_column(features)).where("t IS NOT NULL AND e IS NOT NULL")

    def code(batches):
        for b in batches:
            x = as_matrix(b.column("x"), p)
            codes = np.stack([np.where(np.isnan(x[:, j]), len(c), np.searchsorted(c, x[:, j], "left"))
                              for j, c in enumerate(bounds)], 1).astype(np.uint8)
            e = b.column("e").to_numpy()
            out, hit = time_codes(b.column("t").to_numpy(), e, grid)
            raw = codes.tobytes()
            yield pa.RecordBatch.from_arrays(
                [b.column("h"), pa.array([raw[i:i + p] for i in range(0, len(raw), p)], pa.binary()),
                 pa.array(out, pa.int32()), pa.array(hit, pa.int32()), pa.array(e, pa.int32())],
                names=["h", "codes", "out", "hit", "ev"])

    table = cut_lineage(src.mapInArrow(code, "h long, codes binary, out int, hit int, ev int"))
    # every pass gives a row per task and open node: no more tasks than the rows are worth
    return table.coalesce(max(1, -(-table.count() // TASK_ROWS)))


def draws(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Times that the rows of these key hashes are drawn for a tree."""
    x = keys.astype(np.uint64) ^ np.uint64((0x9E3779B97F4A7C15 * (tree + 1) + 0xD1B54A32D192ED03 * (seed + 1)) % 2 ** 64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    u = ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2 ** 53
    return np.searchsorted(DRAWS, u, "right").astype(float)


class Tree:
    """Nodes as parallel lists; a node without a feature is a leaf."""

    def __init__(self, nodes=None):
        self.feature, self.cut, self.left, self.right = nodes or ([-1], [0], [0], [0])

    def split(self, node: int, feature: int, cut) -> tuple[int, int]:
        n = len(self.feature)
        self.feature[node], self.cut[node], self.left[node], self.right[node] = feature, cut, n, n + 1
        for column, value in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.right, 0)):
            column += [value, value]
        return n, n + 1

    def find(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every row of ``x`` (bins, or values with cuts as numbers)."""
        feature, cut = np.array(self.feature), np.array(self.cut)
        left, right = np.array(self.left), np.array(self.right)
        at = np.zeros(len(x), np.int64)
        while True:
            inner = np.flatnonzero(feature[at] >= 0)
            if not len(inner):
                return at
            own = at[inner]
            at[inner] = np.where(x[inner, feature[own]] <= cut[own], left[own], right[own])


@dataclass
class SurvivalForest:
    features: list[str]
    grid: np.ndarray
    trees: list[Tree]           # cuts are values
    hazards: list[np.ndarray]   # per tree: nodes x times, cumulative

    def hazard(self, df: DataFrame, out: str = "cum_hazard") -> DataFrame:
        """Adds the mean cumulative hazard at the grid times."""
        p, trees, hazards, times = len(self.features), self.trees, self.hazards, len(self.grid)

        @F.arrow_udf("array<double>")
        def mean(x: pa.Array) -> pa.Array:
            m = as_matrix(x, p)
            total = np.zeros((len(m), times))
            for tree, h in zip(trees, hazards):
                total += h[tree.find(m)]
            return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * times, pa.int32()),
                                            pa.array((total / len(trees)).ravel()))

        return df.withColumn(out, mean(vector_column(self.features)))

    def risk(self, df: DataFrame, out: str = "risk") -> DataFrame:
        """Sum of the cumulative hazard over the event times: expected events."""
        summed = F.aggregate("_h", F.lit(0.0), lambda a, v: a + v)
        return self.hazard(df, "_h").withColumn(out, summed).drop("_h")

    def survival(self, df: DataFrame, times: Sequence[float], prefix: str = "s_") -> DataFrame:
        """Adds risk and S(t | x) = exp(-H(t | x)) at each time."""
        x = self.hazard(df, "_h").withColumn("risk", F.aggregate("_h", F.lit(0.0), lambda a, v: a + v))
        places = np.searchsorted(self.grid, np.array(times, float), "right") - 1
        return x.select(*df.columns, "risk", *[(F.exp(-F.col("_h")[int(k)]) if k >= 0 else F.lit(1.0)).alias(f"{prefix}{i}")
                                               for i, k in enumerate(places)])

    def numbers(self) -> dict:
        return {"features": self.features, "grid": self.grid.tolist(), "hazards": [h.tolist() for h in self.hazards],
                "trees": [[t.feature, [float(c) for c in t.cut], t.left, t.right] for t in self.trees]}

    def save(self, path: str) -> None:
        from .survival import _write_numbers
        _write_numbers(SparkSession.getActiveSession(), path, "survival_forest", self.numbers())


def load_numbers(s: dict) -> SurvivalForest:
    return SurvivalForest(s["features"], np.array(s["grid"]), [Tree(t) for t in s["trees"]],
                          [np.array(h).reshape(len(h), -1) for h in s["hazards"]])


def fit_survival_forest(df: DataFrame, duration: str, event: str, features: Sequence[str], key: str, num_trees: int = 100,
                        max_features: str | int = "sqrt", min_split: int = 6, min_leaf: int = 3, max_depth: int = 8,
                        bins: int = 32, time_bins: int = 64, seed: int = 42) -> SurvivalForest:
    """Fits the forest: nodes with at least ``min_split`` drawn rows split at the
    largest log-rank statistic over ``max_features`` drawn features, with
    ``min_leaf`` rows on either side, down to ``max_depth``."""
    features = list(features)
    p = len(features)
    grid = event_grid(df, duration, event, time_bins)
    if not len(grid):
        raise ValueError("no events to learn from")
    times = len(grid)
    qs = [i / bins for i in range(1, bins)]
    found = df.agg(*[F.percentile_approx(nan_to_null(c), qs, 10_000).alias(f"q{j}") for j, c in enumerate(features)]).first()
    bounds = [np.array(sorted(set(found[f"q{j}"] or []))) for j in range(p)]
    table = _binned(df, duration, event, features, bounds, grid, F.col(key))
    drawn = p if max_features in (None, "all") else max_features if isinstance(max_features, int) else \
        max(1, int(math.log2(p))) if max_features == "log2" else max(1, int(math.sqrt(p)))
    drawn = min(drawn, p)
    forest = [Tree() for _ in range(num_trees)]
    per_pass = max(1, HIST_BYTES // (drawn * bins * (2 * times + 1) * 8))

    def placed(open_nodes):
        """Places rows in the open nodes [(tree, node)] by their draws."""
        by_tree: dict[int, dict] = {}
        for i, (t, n) in enumerate(open_nodes):
            by_tree.setdefault(t, {})[n] = i
        shape = {t: (forest[t], np.array([by_tree[t].get(n, -1) for n in range(len(forest[t].feature))])) for t in by_tree}

        def place(codes, keys):
            for t, (tree, index) in shape.items():
                w = draws(keys, t, seed)
                rows = np.flatnonzero(w)
                node = index[tree.find(codes[rows])]
                ok = node >= 0
                yield rows[ok], node[ok], w[rows][ok]
        return place

    front = [(t, 0) for t in range(num_trees)]
    for _ in range(max_depth if any(map(len, bounds)) else 0):
        following = []
        for at in range(0, len(front), per_pass):
            part = front[at:at + per_pass]
            slots = np.stack([np.random.default_rng([seed, t, n]).choice(p, drawn, replace=False) for t, n in part])
            hist = _histograms(table, placed(part), slots, bins, times)

            def best(t):
                flat = np.zeros(bins * (2 * times + 1))
                _add(flat, t.column("at"), t.column("v"))
                stat, left = logrank(*_parts(flat, bins, times))
                whole = flat.reshape(bins, -1)[:, times:].sum()
                ok = (left >= min_leaf) & (whole - left >= min_leaf) & (whole >= min_split)
                stat = np.where(ok, stat, -1.0)
                b = int(stat.argmax())
                return pa.table({"node": t.column("node").slice(0, 1), "slot": t.column("slot").slice(0, 1),
                                 "stat": [float(stat[b])], "cut": pa.array([b], pa.int32()),
                                 "left": [float(left[b])], "whole": [float(whole)]})

            rows = hist.groupBy("node", "slot").applyInArrow(
                best, "node int, slot int, stat double, cut int, left double, whole double").collect()
            chosen: dict[int, tuple] = {}
            for r in rows:
                rank = (-r["stat"], r["slot"])
                if r["stat"] > 0 and (r["node"] not in chosen or rank < chosen[r["node"]][0]):
                    chosen[r["node"]] = rank, r
            for i, (_, r) in sorted(chosen.items()):
                t, n = part[i]
                sides = forest[t].split(n, int(slots[i, r["slot"]]), r["cut"])
                following += [(t, c) for c, size in zip(sides, (r["left"], r["whole"] - r["left"])) if size >= min_split]
        front = following
        if not front:
            break
    leaves = [(t, n) for t, tree in enumerate(forest) for n, f in enumerate(tree.feature) if f < 0]
    hazards = [np.zeros((len(tree.feature), times)) for tree in forest]
    per_pass = max(1, HIST_BYTES // ((2 * times + 1) * 8))
    for at in range(0, len(leaves), per_pass):
        part = leaves[at:at + per_pass]
        # a feature with one bin is added, so a leaf's histogram is over its rows
        hist = _histograms(table.withColumn("codes", F.concat("codes", F.lit(b"\x00"))), _with_bin(placed(part)),
                           np.full((len(part), 1), p), 1, times)

        def hazard(t):
            flat = np.zeros(2 * times + 1)
            _add(flat, t.column("at"), t.column("v"))
            d, out = flat[:times], flat[times:]
            risk = out[::-1].cumsum()[::-1][1:]
            step = np.divide(d, risk, out=np.zeros(times), where=risk > 0)
            return pa.table({"node": t.column("node").slice(0, 1), "h": pa.array([step.cumsum().tobytes()], pa.binary())})

        for r in hist.groupBy("node").applyInArrow(hazard, "node int, h binary").collect():
            t, n = part[r["node"]]
            hazards[t][n] = np.frombuffer(r["h"])
    for tree in forest:
        tree.cut = [float(bounds[f][c]) if f >= 0 else 0.0 for f, c in zip(tree.feature, tree.cut)]
    return SurvivalForest(features, grid, forest, hazards)


def _with_bin(place):
    """Rows are placed by their own codes; the constant one at the end is not used."""
    return lambda codes, keys: place(codes[:, :-1], keys)
