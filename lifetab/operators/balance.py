"""Class balance: inverse-frequency weights, random oversampling, SMOTE."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import seeded_hash, seeded_uniform
from ..functions.ordered import (bucketize, default_buckets, global_row_index, quantile_bounds, rank_in_group,
                                 replicate, top_k_per_group)

BLOCK_BYTES = 4 << 20    # of vectors in a block of ``smote``'s neighbour search


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight) with weight = N / (K * n_c): N rows, K classes.

    One grouped count (partial aggregation), then the totals of that small
    per-class table."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    tot = counts.agg(F.sum("n").alias("_N"), F.count(F.lit(1)).alias("_K"))
    return (counts.crossJoin(F.broadcast(tot))
            .select("label", "n", (F.col("_N") / (F.col("_K") * F.col("n"))).alias("weight")))


def with_class_weights(df: DataFrame, label: str, weight_col: str = "weight", undersample: bool = False) -> DataFrame:
    """Attach the class weight to every row (the ``weightCol`` of an estimator).
    ``undersample``: weights n_min / n_c instead (the largest weight is 1), so
    a Poisson bootstrap draws about n_min rows of every class, the expected
    composition of a balanced (under-sampled) bootstrap.  The per-class table
    is joined on the label; AQE broadcasts it after measuring it."""
    cw = class_weights(df, label)
    if undersample:
        top = cw.agg(F.max("weight").alias("_top"))
        cw = cw.crossJoin(F.broadcast(top)).withColumn("weight", F.col("weight") / F.col("_top"))
    w = cw.select(F.col("label").alias("_lbl"), F.col("weight").alias(weight_col))
    return df.join(w, df[label].eqNullSafe(w["_lbl"])).drop("_lbl")


def random_oversample(df: DataFrame, label: str, key: str, seed: int = 42) -> DataFrame:
    """Replicate rows so every class reaches the majority count.

    A class with n_c rows and target n_max: every row gets floor(n_max/n_c)
    copies, and the first n_max mod n_c rows in seeded-hash order one more.
    Copies are numbered 1.. (copy 1 = the original).  Ranks come from
    ``rank_in_group`` (hash-bucketed, so a big class is spread over tasks).
    """
    x = df.withColumn("_h", seeded_hash(seed, key))
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).agg(
        F.max("n").alias("mx"), F.min("n").alias("mn")).first()  # two numbers from the per-class table
    most = None if sizes["mn"] is None else -(-sizes["mx"] // sizes["mn"])
    r = rank_in_group(x, [label], "_h", [key], rank_col="_rank", size_col="_n")
    nmax = r.agg(F.max("_n").alias("_nmax"))
    r = r.crossJoin(F.broadcast(nmax))
    reps = (F.floor(F.col("_nmax") / F.col("_n")) +
            F.when(F.col("_rank") <= F.pmod(F.col("_nmax"), F.col("_n")), 1).otherwise(0))
    # a small class's rows get many copies: chunked so no task emits them all
    return replicate(r.select(*df.columns, reps.alias("_reps")), F.col("_reps"), "copy",
                     max_count=most).drop("_reps")


def _nearest(k: int, d: int):
    """The k nearest rows of a block for every query of a slice, among those
    inside the query's band (without a bound: all that have a projection).
    Rows with NaN meet one another alone, rows with NULL are nobody's
    neighbours; a NULL key meets no row, a NULL distance comes first, NaN
    last, and ties go by key."""
    def vectors(column):    # and whether a row holds a NULL
        flat = pc.list_flatten(column.combine_chunks())
        x = pc.fill_null(flat, 0.0).to_numpy(zero_copy_only=False).reshape(-1, d)
        return x, flat.is_null().to_numpy(zero_copy_only=False).reshape(-1, d).any(axis=1)

    def run(probe: pa.Table, cand: pa.Table) -> pa.Table:
        cand = cand.take(pc.sort_indices(cand, sort_keys=[("_nkey", "ascending")]))
        n, m = probe.num_rows, cand.num_rows
        at, col, dist = [], [], []
        if n and m:
            keys = pa.chunked_array([*probe["_key"].chunks, *cand["_nkey"].chunks]).combine_chunks().dictionary_encode()
            code = pc.fill_null(keys.indices, -1).to_numpy(zero_copy_only=False)
            own, other = code[:n], code[n:]
            x, x_null = vectors(probe["_x"])
            y, y_null = vectors(cand["_y"])
            y = np.ascontiguousarray(y.T)
            p, q = (c.to_numpy().astype(np.float64) for c in (probe["_p"], cand["_q"]))    # NULL becomes NaN
            r, free = probe["_r"].to_numpy().astype(np.float64), probe["_r"].is_null().to_numpy()
            odd = np.isnan(r) & ~free & probe["_p"].is_valid().to_numpy()
            regular, nan = ~np.isnan(q), np.isnan(q) & cand["_q"].is_valid().to_numpy()
        step = max(1, 65_536 // max(1, m))
        for a in range(0, n if m else 0, step):
            b = min(n, a + step)
            total = np.zeros((b - a, m))
            for j in range(d):    # in the order of the components, as the SQL sums them
                part = x[a:b, j, None] - y[j]
                total += part * part
            # a NULL distance is -1 here, so it comes first
            total = np.where(x_null[a:b, None] | y_null, -1.0, np.sqrt(total))
            with np.errstate(invalid="ignore"):
                fits = (free[a:b, None] & regular) | (odd[a:b, None] & nan) | (np.abs(q - p[a:b, None]) <= r[a:b, None])
            fits &= (other != own[a:b, None]) & (other >= 0) & (own[a:b, None] >= 0)
            for i in range(b - a):
                ok = np.flatnonzero(fits[i])
                v = total[i, ok]
                if len(v) > k:
                    most = np.partition(v, k - 1)[k - 1]
                    if most == most:
                        ok, v = ok[v <= most], v[v <= most]
                first = np.argsort(v, kind="stable")[:k]
                at.append(np.full(len(first), a + i)), col.append(ok[first]), dist.append(v[first])
        at, col, dist = (np.concatenate([np.zeros(0, t), *c]) for t, c in ((np.int64, at), (np.int64, col), (np.float64, dist)))
        own, found = probe.take(pa.array(at)), cand.take(pa.array(col))
        return pa.table({"_label": own["_label"], "_key": own["_key"], "_nkey": found["_nkey"], "_nidx": found["_nidx"],
                         "_d": pa.array(dist, pa.float64(), mask=dist < 0)})
    return run


def smote(df: DataFrame, label: str, features: Sequence[str], key: str, k: int = 5, seed: int = 42,
          band_buckets: int | None = None) -> DataFrame:
    """SMOTE oversampling: every class is raised to the majority count with
    synthetic rows x + u * (neighbour - x), u in [0, 1), the neighbour one
    of the k nearest same-class rows (Euclidean).  Originals are kept
    (``synthetic`` = 0).  Synthetic rows get a key of their own, from a hash
    of (seed, class, number) (negative, or text that starts with
    ``synthetic-``), so later splits deal them out like any rows; other
    columns are NULL.

    Deterministic: synthetic row s of class c uses base row rank
    ((s - 1) mod n_c) + 1 (seeded-hash order), neighbour index and u from
    hashes of (seed, c, s).  A class with one row is duplicated.

    Exact k nearest neighbours, of the rows that synthetic rows start from
    (those ranked up to the class's missing count):
    1. project rows on a fixed random unit direction; bucket the projection
       by its quantiles (equal-count buckets);
    2. an upper bound r(x) on the k-th neighbour distance from the k rows
       next to x in projection order inside its bucket (infinite when the
       bucket is too small);
    3. since |proj(y) - proj(x)| <= |y - x|, every true neighbour lies in
       the projection band [p - r, p + r]: the rows of a class, in projection
       order, are cut into blocks of ``BLOCK_BYTES``, and x goes to the blocks
       its band meets;
    4. a task meets one block with one slice of as many of its queries and
       hands on each query's k smallest distances (ties by key), as row
       numbers; the k smallest per x over all blocks are kept.  Vectors move
       with the blocks and the picked neighbours alone, never with pairs.
    """
    features = list(features)
    d = len(features)
    rng = np.random.default_rng(seed)
    direction = rng.normal(size=d)
    direction = direction / np.linalg.norm(direction)
    vec = F.array(*[F.col(c).cast("double") for c in features])
    base = df.select(F.col(key).alias("_key"), F.col(label).alias("_label"), vec.alias("_x"))
    # the projection is one dot-product expression over the vector column (a
    # d-term sum would be copied into every band expression by the optimizer)
    weights = F.array(*[F.lit(float(w)) for w in direction])
    base = base.withColumn("_p", F.aggregate(F.zip_with("_x", weights, lambda a, b: a * b), F.lit(0.0),
                                             lambda acc, v: acc + v))

    counts = base.groupBy("_label").agg(F.count(F.lit(1)).alias("_n"))
    nmax = counts.agg(F.max("_n").alias("_nmax"))
    need = counts.crossJoin(F.broadcast(nmax)).select("_label", "_n", (F.col("_nmax") - F.col("_n")).alias("_m"))
    minority = need.where("_m > 0").select("_label")
    # rows in projection order, written once; ``_idx`` is a row's number
    rows = global_row_index(base.join(minority, "_label", "left_semi"), ["_label", "_p", "_key"])
    band_buckets = band_buckets or default_buckets(df.sparkSession)

    # projection buckets: quantiles of the projection (equal-count buckets,
    # so a concentrated class is still spread), binary search on the JVM
    bounds = quantile_bounds(rows, "_p", band_buckets)
    rows = bucketize(rows, "_p", bounds, out="_b")

    # synthetic rows: s = 1..m per class; base = rank ((s-1) mod n) + 1, so
    # rows ranked above m are not used
    hashed = rows.select("_label", "_key", "_idx").withColumn("_h", seeded_hash(seed, "_key"))
    ranked = rank_in_group(hashed, ["_label"], "_h", ["_key"], rank_col="_rank", size_col="_n")
    used = ranked.join(need.select("_label", "_m"), "_label").where(F.col("_rank") <= F.col("_m"))

    # step 2: upper bound from the k following rows in projection order
    w = Window.partitionBy("_label", "_b").orderBy("_p", "_key")
    near = rows.select("_label", "_key", "_x", "_b", "_p",
                       F.collect_list(F.col("_x")).over(w.rowsBetween(1, k)).alias("_nb"))
    ub = near.select("_label", "_key", "_x", "_p", F.when(F.size("_nb") >= k, F.array_max(F.transform(
        "_nb", lambda y: F.sqrt(F.aggregate(F.zip_with("_x", y, lambda a, b: (a - b) * (a - b)),
                                            F.lit(0.0), lambda s, v: s + v))))).alias("_r"))
    queries = ub.join(used.select("_label", "_key").distinct(), ["_label", "_key"], "left_semi")

    # step 3: blocks of rows, and slices of as many queries
    per_block = max(256, BLOCK_BYTES // (8 * d))
    block = F.floor(F.col("_idx") / per_block).alias("_blk")
    per_class = need.where("_m > 0").agg(F.max(F.least("_m", "_n")).alias("q"),
                                         F.max(F.ceil(F.col("_m") / F.col("_n"))).alias("u")).first()  # per-class table
    slices = max(1, -(-int(per_class["q"] or 0) // per_block))
    spans = rows.groupBy("_label", block).agg(F.min("_p").alias("_from"), F.max("_p").alias("_to"))  # a row per block
    slack = F.col("_r") + (F.abs("_p") + F.col("_r")) * 1e-9
    meets = F.col("_r").isNull() | F.isnan("_r") | ((F.col("_to") >= F.col("_p") - slack) & (F.col("_from") <= F.col("_p") + slack))
    probe = (queries.join(F.broadcast(spans), "_label").where(meets)
             .select("_label", "_blk", F.pmod(F.hash("_key"), F.lit(slices)).alias("_slice"), "_key", "_x", "_p", "_r"))
    cand = rows.select(F.col("_label").alias("_nlabel"), block.alias("_nblk"),
                       F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("_nslice"), F.col("_key").alias("_nkey"), F.col("_x").alias("_y"), F.col("_p").alias("_q"), F.col("_idx").alias("_nidx"))

    # step 4
    types = {f.name: f.dataType.simpleString() for f in base.schema.fields}
    near = probe.groupBy("_label", "_blk", "_slice").cogroup(cand.groupBy("_nlabel", "_nblk", "_nslice")).applyInArrow(
        _nearest(k, d), f"_label {types['_label']}, _key {types['_key']}, _nkey {types['_key']}, _nidx long, _d double")
    knn = top_k_per_group(near, ["_label", "_key"], [F.col("_d").asc(), F.col("_nkey").asc()], k, rank_col="_j")
    nbrs = knn.groupBy("_label", "_key").agg(
        F.sort_array(F.collect_list(F.struct(F.col("_j"), F.col("_nidx")))).alias("_nbrs"))

    with_nb = used.join(nbrs, ["_label", "_key"], "left")
    # every base row is used ceil(m / n) times at most; its uses are
    # replicated in chunks (a one-row class may need m copies)
    uses = replicate(with_nb, F.ceil(F.col("_m") / F.col("_n")), "_t", start=0, max_count=per_class["u"])
    s = F.col("_t") * F.col("_n") + F.col("_rank")
    syn = uses.withColumn("_s", s).where(F.col("_s") <= F.col("_m"))
    nb_count = F.when(F.col("_nbrs").isNull(), F.lit(0)).otherwise(F.size("_nbrs"))
    pick = (F.pmod(seeded_hash(seed, "_label", "_s", F.lit("nb")), F.greatest(nb_count, F.lit(1))) + 1).cast("int")
    u = seeded_uniform(seed, "_label", "_s", F.lit("u"))
    syn = syn.select("_label", "_s", "_idx", F.when(nb_count > 0, F.element_at("_nbrs", pick).getField("_nidx")).alias("_nidx"))
    syn = (syn.join(rows.select("_idx", "_x"), "_idx")
           .join(rows.select(F.col("_idx").alias("_nidx"), F.col("_x").alias("_y")), "_nidx", "left"))
    syn = syn.select("_label", "_s", F.zip_with("_x", F.coalesce("_y", "_x"), lambda a, b: a + u * (b - a)).alias("_v"))

    lab_type = df.schema[label].dataType
    key_type = df.schema[key].dataType
    own = seeded_hash(seed, "_label", "_s", F.lit("key"))
    if key_type.typeName() == "string":
        own = F.concat(F.lit("synthetic-"), F.col("_label").cast("string"), F.lit("-"), own.cast("string"))
    elif key_type.typeName() != "long":
        own = -1 - F.pmod(own, F.lit(2**31 - 1))
    else:
        own = -1 - own
    original = df.select(*df.columns, F.lit(0).alias("synthetic"))
    synthetic = syn.select(*[
        (F.col("_label").cast(lab_type).alias(c) if c == label else
         own.cast(key_type).alias(c) if c == key and c not in features else
         F.col("_v")[features.index(c)].cast(df.schema[c].dataType).alias(c) if c in features else
         F.lit(None).cast(df.schema[c].dataType).alias(c)) for c in df.columns], F.lit(1).alias("synthetic"))
    return original.unionByName(synthetic)
