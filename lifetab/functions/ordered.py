"""Ordered computations (prefix sums, ranks) without a single-task window.

A window ``ORDER BY x`` with no (or a low-cardinality) ``PARTITION BY``
sends every row to one task.  At cluster scale, and when one class or key
holds a third of the rows, that task is the whole job.  The helpers here
split the order domain into value-range buckets first:

1. rows are pre-aggregated to one row per distinct (group, order key)
   (map-side combine; a hot key collapses to one row);
2. the bucket of a row is a monotone function of its order value: either
   given by the caller (the top bits of a uniform hash) or the number of
   global quantile boundaries below it (``percentile_approx`` over the
   pre-aggregated keys: a few numbers per shuffle partition collected once,
   then a binary search per row on the JVM);
3. totals per (group, bucket) are a small table (groups x buckets rows)
   whose running sum gives each bucket's offset;
4. the exact running sum inside a bucket is a window partitioned by
   (group, bucket), so the work is spread over all buckets.

The result is exact; the buckets only decide where the work runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def _join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with NULL-safe equality (a NULL group is a group),
    keeping one copy of each key column."""
    lk = left.alias("_l")
    rk = right.alias("_r")
    cond = [F.col(f"_l.{k}").eqNullSafe(F.col(f"_r.{k}")) for k in keys]
    j = lk.join(rk, cond, how) if cond else lk.crossJoin(rk)
    rest = [c for c in right.columns if c not in keys]
    return j.select(*[F.col(f"_l.{c}") for c in left.columns], *[F.col(f"_r.{c}") for c in rest])


def _cols(xs) -> list[str]:
    if xs is None:
        return []
    if isinstance(xs, str):
        return [xs]
    return list(xs)


def default_buckets(spark) -> int:
    """Value-range buckets per ordered pass: a few per shuffle partition."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(16, min(1 << 16, 4 * n))


def plan_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan (no job runs)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001
        return None


def materialize_if_large(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint directory when its estimated size is
    above ``lifetab.ordered.materializeBytes`` (256 MB): a table read by two
    jobs (bounds, then the pass itself) is then computed once instead of
    scanning its input twice."""
    limit = int(df.sparkSession.conf.get("lifetab.ordered.materializeBytes", str(256 << 20)))
    size = plan_bytes(df)
    if size is not None and size > limit:
        from ..session import cut_lineage
        return cut_lineage(df)
    return df


def small_rows(spark) -> int:
    """Distinct-key count up to which an ordered pass runs as one plain window
    per group (the count is measured first, so the single-task window has a
    proven size)."""
    return int(spark.conf.get("lifetab.ordered.smallRows", "100000"))


def quantile_bounds(df: DataFrame, col: str, buckets: int, with_count: bool = False):
    """``buckets - 1`` approximate quantiles of ``col`` (one aggregate job;
    the result is ``buckets`` numbers on the driver, bounded by the caller).
    With ``with_count`` also the row count, from the same job."""
    qs = ", ".join(repr(i / buckets) for i in range(1, buckets))
    acc = max(10000, 10 * buckets)
    row = df.agg(F.expr(f"percentile_approx(CAST(`{col}` AS DOUBLE), array({qs}), {acc})").alias("b"),
                 F.count(F.lit(1)).alias("n")).first()
    vals = [] if row is None or row["b"] is None else row["b"]
    bounds = sorted({float(v) for v in vals if v is not None and v == v})
    return (bounds, int(row["n"])) if with_count else bounds


def bucketize(df: DataFrame, col: str, bounds: Sequence[float], out: str = "_bk") -> DataFrame:
    """``out`` = number of bounds <= value (binary search on the JVM, via
    Spark ML's ``Bucketizer``); monotone in the value, equal values share a
    bucket; NULL/NaN go to the last bucket."""
    if not bounds:
        return df.withColumn(out, F.lit(0))
    from pyspark.ml.feature import Bucketizer
    splits = [float("-inf")] + list(bounds) + [float("inf")]
    x = df.withColumn("_bkin", F.col(col).cast("double"))
    bk = Bucketizer(splits=splits, inputCol="_bkin", outputCol=out, handleInvalid="keep")
    return bk.transform(x).withColumn(out, F.col(out).cast("int")).drop("_bkin")


def quantile_bucket(df: DataFrame, order_col: str, buckets: int | None = None) -> DataFrame:
    """Add ``_bk``: the value-range bucket of ``order_col`` among global quantiles."""
    buckets = buckets or default_buckets(df.sparkSession)
    return bucketize(df, order_col, quantile_bounds(df, order_col, buckets))


def running_sums(df: DataFrame, order_cols: Sequence[str] | str, sum_cols: Sequence[str] | str,
                 by: Sequence[str] | str = (), bucket: Column | None = None,
                 buckets: int | None = None, descending: bool = False,
                 prefix: str = "cum_", total_prefix: str = "tot_", known_rows: int | None = None) -> DataFrame:
    """Exact inclusive running sums per group in the order of ``order_cols``.

    Returns one row per distinct (by, order_cols) with the summed
    ``sum_cols``, ``cum_<c>`` (sum over rows whose order key is <= this one,
    or >= when ``descending``) and ``tot_<c>`` (group total).  ``bucket``,
    when given, must be a column monotone in the order key (evaluated on the
    input rows); otherwise quantile buckets of the first order column are used
    (it must then be numeric).  ``known_rows``: an upper bound of the input
    rows the caller has already measured; when it is below the small-size
    threshold the bounds job is skipped.
    """
    order_cols, sum_cols, by = _cols(order_cols), _cols(sum_cols), _cols(by)
    order_exprs = [F.col(c).desc() if descending else F.col(c).asc() for c in order_cols]
    if bucket is not None:
        keyed = (df.withColumn("_bk", bucket)
                 .groupBy(*by, "_bk", *order_cols)
                 .agg(*[F.sum(c).alias(c) for c in sum_cols]))
        if descending:
            keyed = keyed.withColumn("_bk", -F.col("_bk"))
    else:
        keyed = df.groupBy(*by, *order_cols).agg(*[F.sum(c).alias(c) for c in sum_cols])
        spark = df.sparkSession
        if known_rows is not None and known_rows <= small_rows(spark):
            bounds, n = [], known_rows
        else:
            keyed = materialize_if_large(keyed)
            bounds, n = quantile_bounds(keyed, order_cols[0], buckets or default_buckets(spark), with_count=True)
        if n <= small_rows(spark):
            # measured small: one window per group, no bucket bookkeeping
            w = Window.partitionBy(*by).orderBy(*order_exprs).rowsBetween(Window.unboundedPreceding, 0)
            whole = Window.partitionBy(*by)
            return keyed.select(*by, *order_cols, *sum_cols,
                                *[F.sum(c).over(w).alias(f"{prefix}{c}") for c in sum_cols],
                                *[F.sum(c).over(whole).alias(f"{total_prefix}{c}") for c in sum_cols])
        keyed = bucketize(keyed, order_cols[0], bounds)
        if descending:
            keyed = keyed.withColumn("_bk", -F.col("_bk"))

    totals = keyed.groupBy(*by, "_bk").agg(*[F.sum(c).alias(f"_b_{c}") for c in sum_cols])
    before = Window.partitionBy(*by).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = totals.select(
        *by, "_bk",
        *[F.coalesce(F.sum(f"_b_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sum_cols],
        *[F.sum(f"_b_{c}").over(whole).alias(f"{total_prefix}{c}") for c in sum_cols])

    local = Window.partitionBy(*by, "_bk").orderBy(*order_exprs).rowsBetween(Window.unboundedPreceding, 0)
    out = keyed.select("*", *[F.sum(c).over(local).alias(f"_l_{c}") for c in sum_cols])
    out = _join_keys(out, offsets, [*by, "_bk"])
    return out.select(
        *by, *order_cols, *sum_cols,
        *[(F.col(f"_l_{c}") + F.col(f"_o_{c}")).alias(f"{prefix}{c}") for c in sum_cols],
        *[F.col(f"{total_prefix}{c}") for c in sum_cols])


def global_row_index(df: DataFrame, order_cols: Sequence[str] | str, index_col: str = "_idx",
                     partitions: int | None = None, known_rows: int | None = None) -> DataFrame:
    """0-based position of each row in the total order of ``order_cols``.

    Range-partitions on the order columns (one shuffle), sorts inside each
    partition, numbers rows locally, and adds the count of all earlier
    partitions (a table with one row per partition).  Rows should be distinct
    in ``order_cols`` for a deterministic result.  The counts and the row
    positions read the same range exchange (Spark reuses it: one set of
    sampled bounds per query).
    """
    order_cols = _cols(order_cols)
    spark = df.sparkSession
    if known_rows is not None and known_rows <= small_rows(spark):
        # measured small: one ordered window (bounded by the measurement)
        w = Window.orderBy(*order_cols)
        return df.withColumn(index_col, (F.row_number().over(w) - 1).cast("long"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    mid = F.monotonically_increasing_id()
    numbered = ranged.select("*", F.shiftright(mid, 33).alias("_pid"),
                             mid.bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos"))
    # written once: pruned differently, the count and the rows could otherwise
    # be two range exchanges with different sampled bounds
    from ..session import cut_lineage
    numbered = cut_lineage(numbered)
    counts = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    out = numbered.join(F.broadcast(offsets), "_pid")
    return out.select(*[c for c in df.columns], (F.col("_off") + F.col("_pos")).alias(index_col))


def rank_in_group(df: DataFrame, by: Sequence[str] | str, hash_col: str, tie_cols: Sequence[str] | str,
                  rank_col: str = "_rank", size_col: str = "_n", bucket_bits: int = 14) -> DataFrame:
    """1-based rank of each row inside its group in (hash, tie) order, plus the group size.

    ``hash_col`` must be a uniform 60-bit hash: its top ``bucket_bits`` bits
    split every group (a hot class included) into ``2**bucket_bits`` equal
    slices, so no task holds a whole class.
    """
    by, tie_cols = _cols(by), _cols(tie_cols)
    x = df.withColumn("_bk", F.shiftright(F.col(hash_col), 60 - bucket_bits).cast("int"))
    # slice sizes by a partial aggregate (a tiny shuffle), local ranks by one
    # exchange of the rows on (group, slice)
    totals = x.groupBy(*by, "_bk").agg(F.count(F.lit(1)).alias("_bn"))
    before = Window.partitionBy(*by).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = totals.select(*by, "_bk", F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_off"),
                            F.sum("_bn").over(whole).alias(size_col))
    local = Window.partitionBy(*by, "_bk").orderBy(F.col(hash_col), *[F.col(c) for c in tie_cols])
    ranked = x.withColumn("_lr", F.row_number().over(local))
    out = _join_keys(ranked, offsets, [*by, "_bk"])
    return out.select(*df.columns, (F.col("_lr") + F.col("_off")).cast("long").alias(rank_col),
                      F.col(size_col).cast("long").alias(size_col))


def top_k_per_group(df: DataFrame, by: Sequence[str] | str, order_exprs: Sequence[Column], k: int,
                    salt: Column | None = None, salt_buckets: int = 64, rank_col: str = "rank") -> DataFrame:
    """The first ``k`` rows of every group in ``order_exprs`` order (ranks 1..k).

    Two stages, so a group holding a large share of the rows is not one
    task's window: rows are first ranked inside (group, salt bucket) and
    only each bucket's first k survive; the final rank runs over at most
    k x salt_buckets rows per group.  The order must be total (end it with a
    unique key) for a deterministic result.
    """
    by = _cols(by)
    if salt is not None:
        x = df.withColumn("_salt", F.pmod(F.xxhash64(salt), F.lit(salt_buckets)))
        w1 = Window.partitionBy(*by, "_salt").orderBy(*order_exprs)
        x = x.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k).drop("_r1", "_salt")
    else:
        x = df
    w = Window.partitionBy(*by).orderBy(*order_exprs)
    return x.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def exact_quantiles(df: DataFrame, col: str, qs: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy's default): (q, value).

    Distinct values get their running counts (``running_sums``); each quantile
    position (N - 1) q falls inside one value's count range, found by
    expanding each distinct value once per quantile and filtering (no join,
    no collect of the values)."""
    vals = df.select(F.col(col).cast("double").alias("_v"), F.lit(1).alias("_one")).where("_v IS NOT NULL")
    rs = running_sums(vals, ["_v"], ["_one"])
    x = rs.select("_v", (F.col("cum__one") - F.col("_one")).alias("_a"), F.col("cum__one").alias("_b"),
                  F.col("tot__one").alias("_N"),
                  F.explode(F.array(*[F.lit(float(q)) for q in qs])).alias("q"))
    h = (F.col("_N") - 1) * F.col("q")
    lo, hi = F.floor(h), F.ceil(h)
    hit_lo = (F.col("_a") <= lo) & (lo < F.col("_b"))
    hit_hi = (F.col("_a") <= hi) & (hi < F.col("_b"))
    y = x.where(hit_lo | hit_hi).groupBy("q").agg(
        F.max(F.when(hit_lo, F.col("_v"))).alias("_vl"), F.max(F.when(hit_hi, F.col("_v"))).alias("_vh"),
        F.first("_N").alias("_N"))
    h2 = (F.col("_N") - 1) * F.col("q")
    return y.select("q", (F.col("_vl") + (h2 - F.floor(h2)) * (F.col("_vh") - F.col("_vl"))).alias("value"))


def asof_lookup(steps: DataFrame, queries: DataFrame, q_time: str, s_time: str, values: Sequence[str],
                by: Sequence[str] | str = (), buckets: int | None = None,
                known_rows: int | None = None) -> DataFrame:
    """For every query row, ``values`` of the step row with the largest
    ``s_time`` <= ``q_time`` (same ``by`` group); NULL before the first step.

    Query times are reduced to distinct values first (a hot time is one
    row), merged with the steps, bucketed by the quantiles of the step
    times, and resolved by a last-non-null window inside each bucket plus
    the carried value of the previous buckets (a buckets-sized table).  The
    answers join back to the queries on (by, time).
    """
    by, values = _cols(by), list(values)
    st = steps.select(*by, F.col(s_time).cast("double").alias("_t"),
                      F.struct(*[F.col(v) for v in values]).alias("_val"))
    qt = queries.select(*by, F.col(q_time).cast("double").alias("_t")).distinct()
    qs = qt.select(*by, "_t", F.lit(None).cast(st.schema["_val"].dataType).alias("_val"))
    u = st.withColumn("_isq", F.lit(0)).unionByName(qs.withColumn("_isq", F.lit(1)))
    if known_rows is not None and known_rows <= small_rows(steps.sparkSession):
        # measured small: one last-non-null window per group
        w0 = Window.partitionBy(*by).orderBy("_t", "_isq").rowsBetween(Window.unboundedPreceding, 0)
        res = (u.withColumn("_res", F.last("_val", ignorenulls=True).over(w0)).where("_isq = 1")
               .select(*by, F.col("_t").alias("_qt"), "_res"))
        out = queries.join(res, [*[queries[b].eqNullSafe(res[b]) for b in by],
                                 queries[q_time].cast("double") == res["_qt"]], "left")
        return out.select(*[queries[c] for c in queries.columns], *[F.col(f"_res.{v}").alias(v) for v in values])
    u = bucketize(u, "_t", quantile_bounds(steps.select(F.col(s_time).alias("_st")), "_st",
                                           buckets or default_buckets(steps.sparkSession)))
    w = Window.partitionBy(*by, "_bk").orderBy("_t", "_isq").rowsBetween(Window.unboundedPreceding, 0)
    inside = u.withColumn("_last", F.last("_val", ignorenulls=True).over(w))
    # every bucket that holds a step or a query has a row here, so the carry
    # reaches over buckets without steps
    is_step = F.col("_isq") == 0
    carry = u.groupBy(*by, "_bk").agg(F.max_by("_val", F.when(is_step, F.col("_t"))).alias("_bl"))
    wb = Window.partitionBy(*by).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    carry = carry.select(*by, "_bk", F.last("_bl", ignorenulls=True).over(wb).alias("_prev"))
    ans = _join_keys(inside.where("_isq = 1").select(*by, "_t", "_bk", "_last"), carry, [*by, "_bk"], "left")
    val = F.coalesce("_last", "_prev")
    res = ans.select(*by, F.col("_t").alias("_qt"), val.alias("_res"))
    out = queries.join(res, [*[queries[b].eqNullSafe(res[b]) for b in by],
                             queries[q_time].cast("double") == res["_qt"]], "left")
    return out.select(*[queries[c] for c in queries.columns], *[F.col(f"_res.{v}").alias(v) for v in values])


def replicate(df: DataFrame, count: Column, out: str = "copy", chunk: int = 100_000,
              start: int = 1, max_count: int | None = None) -> DataFrame:
    """Each row repeated ``count`` times with ``out`` = start, start + 1, ...

    Rows whose count exceeds ``chunk`` are first split into chunk rows that
    are spread over tasks (a repartition on the chunk rows, which are few),
    and each task expands only its chunks, so one row that needs a huge
    number of copies does not become one task's output.  ``max_count``, when
    the caller knows it (from a small table), skips the chunked branch if no
    row can exceed a chunk."""
    x = df.withColumn("_cnt", count.cast("long"))
    if max_count is not None and max_count <= chunk:
        rows = x.where(F.col("_cnt") > 0).select(
            "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_cnt") - 1)).alias("_i"))
        return rows.select(*df.columns, (F.col("_i") + start).alias(out))
    nchunks = F.greatest(F.ceil(F.col("_cnt") / F.lit(chunk)), F.lit(0)).cast("long")
    big = (x.where(F.col("_cnt") > chunk)
           .select("*", F.explode(F.sequence(F.lit(0).cast("long"), nchunks - 1)).alias("_ch"))
           .repartition("_ch"))
    small = x.where(F.col("_cnt") <= chunk).withColumn("_ch", F.lit(0).cast("long"))
    both = small.unionByName(big)
    lo = F.col("_ch") * chunk
    hi = F.least(lo + chunk, F.col("_cnt")) - 1
    rows = both.where(F.col("_cnt") > 0).select(
        "*", F.explode(F.sequence(lo, hi)).alias("_i"))
    return rows.select(*df.columns, (F.col("_i") + start).alias(out))
