"""Feature derivation: z-scores, category codes, sequence features, gene lists,
growth-count survival outcomes, scalar-feature broadcast."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import nan_to_null, non_numeric_columns, numeric_columns, require_columns
from ..functions.ordered import global_row_index, small_rows


WIDE_COLUMNS = 32


def zscore(df: DataFrame, cols: Sequence[str] | None = None, exclude: Iterable[str] = (),
           prefix: str = "z_") -> DataFrame:
    """Append ``z_<c>`` = (x - mean) / population std for each numeric column.

    NaN and NULL are skipped by the statistics and stay NULL.  A column whose
    std is 0 or undefined gets 0.0 in every row (missing rows included).  Raw
    columns are kept.  Cost: one aggregate pass (partial + final hash
    aggregate; above ``WIDE_COLUMNS`` columns a (column, value) explode
    grouped by column), then one projection against the single stats row
    broadcast to every task; no shuffle of the data itself.
    """
    cols = list(cols) if cols is not None else numeric_columns(df, exclude)
    clash = [prefix + c for c in cols if prefix + c in df.columns]
    if clash:
        raise ValueError(f"z-score columns already exist: {clash}")
    if not cols:
        return df
    if len(cols) > WIDE_COLUMNS:
        # many columns: the statistics come from one (feature, value) explode
        # and a grouped aggregate with one group per column, instead of 2p
        # aggregate expressions; the result is the same single stats row
        vals = df.select(F.explode(F.array(*[
            F.struct(F.lit(i).alias("i"), nan_to_null(c).alias("v")) for i, c in enumerate(cols)])).alias("_e"))
        per = vals.groupBy(F.col("_e.i").alias("i")).agg(F.avg("_e.v").alias("m"), F.stddev_pop("_e.v").alias("s"))
        arr = per.agg(F.sort_array(F.collect_list(F.struct("i", "m", "s"))).alias("_st"))
        stats = arr.select(*[e for i in range(len(cols)) for e in (
            F.get("_st", i)["m"].alias(f"_m{i}"), F.get("_st", i)["s"].alias(f"_s{i}"))])
    else:
        stats = df.agg(*[e for i, c in enumerate(cols) for e in (
            F.avg(nan_to_null(c)).alias(f"_m{i}"), F.stddev_pop(nan_to_null(c)).alias(f"_s{i}"))])
    x = df.crossJoin(F.broadcast(stats))
    zs = []
    for i, c in enumerate(cols):
        s = F.col(f"_s{i}")
        z = (nan_to_null(c) - F.col(f"_m{i}")) / s
        zs.append(F.when(s.isNull() | F.isnan(s) | (s == 0), F.lit(0.0)).otherwise(z).alias(prefix + c))
    return x.select(*[F.col(c) for c in df.columns], *zs)


def zscore_long(df: DataFrame, feature: str = "feature", value: str = "value",
                out: str = "z") -> DataFrame:
    """Z-score in long form (key..., feature, value): the layout for very wide
    matrices.  Statistics by ``groupBy(feature)`` (partial aggregation), joined
    back on the feature key; AQE broadcasts the stats when they are small."""
    v = nan_to_null(value)
    stats = df.groupBy(feature).agg(F.avg(v).alias("_m"), F.stddev_pop(v).alias("_s"))
    x = df.join(stats, feature)
    s = F.col("_s")
    z = F.when(s.isNull() | F.isnan(s) | (s == 0), F.lit(0.0)).otherwise((v - F.col("_m")) / s)
    return x.select(*df.columns, z.alias(out))


def category_codes(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """0-based code of each value among the sorted distinct non-NULL values;
    NULL -> -1.  The distinct values are numbered by a range-partitioned global
    index (no single-task window), then joined back: broadcast when their
    counted number is small, as a shuffle by a few values would send a class's
    rows to one task."""
    out = out or col
    labels = df.select(F.col(col).alias("_label")).where(F.col("_label").isNotNull()).distinct()
    codes = global_row_index(labels, ["_label"], index_col="_code")
    if codes.count() <= small_rows(df.sparkSession):
        codes = F.broadcast(codes)
    joined = df.join(codes, df[col].eqNullSafe(codes["_label"]), "left")
    code = F.coalesce(F.col("_code"), F.lit(-1)).cast("int")
    cols = [F.col(c) for c in df.columns if c != out]
    return joined.select(*cols, code.alias(out))


def code_table(df: DataFrame, col: str) -> DataFrame:
    """The (value, code) table itself."""
    labels = df.select(F.col(col).alias(col)).where(F.col(col).isNotNull()).distinct()
    return global_row_index(labels, [col], index_col="code").select(col, F.col("code").cast("int"))


def gene_list(df: DataFrame, gene_col: str = "gene", target: str | None = None) -> DataFrame:
    """Distinct gene identifiers: the ``gene`` column if present, otherwise the
    names of non-numeric, non-target columns (as a one-column DataFrame)."""
    if gene_col in df.columns:
        return df.select(F.col(gene_col).cast("string").alias("gene")).where("gene IS NOT NULL").distinct()
    names = non_numeric_columns(df, exclude=[target] if target else [])
    return df.sparkSession.createDataFrame([(n,) for n in names], "gene string")


def sequence_features(df: DataFrame, seq: str = "seq", id_col: str = "id", target: str | None = "target",
                      target_value: int = 0) -> DataFrame:
    """Per sequence: length and GC fraction ((G+C)/length, 0.0 when empty),
    case-insensitive, plus a constant target column.  (Counting g/c/G/C on
    the raw text equals upper-casing first for sequence letters, and keeps
    the length of texts whose upper case is longer, such as German sharp s.)"""
    s = F.coalesce(F.col(seq), F.lit(""))
    n = F.length(s)
    gc = n - F.length(F.translate(s, "GCgc", ""))
    cols = [F.col(id_col), n.cast("int").alias("seq_length"),
            F.when(n > 0, gc / n).otherwise(F.lit(0.0)).alias("gc_content")]
    if target:
        cols.append(F.lit(target_value).cast("int").alias(target))
    return df.select(*cols)


def enrichment_feature_name(term_name, term_id) -> F.Column:
    """``enrich_`` + term name (spaces -> '_'), falling back to the term id, then 'unknown'."""
    name = F.coalesce(F.col(term_name) if isinstance(term_name, str) else term_name,
                      F.col(term_id) if isinstance(term_id, str) else term_id, F.lit("unknown"))
    return F.concat(F.lit("enrich_"), F.regexp_replace(name, " ", "_"))


def neg_log10(p) -> F.Column:
    """-log10(p), 0.0 when p <= 0 (or missing)."""
    col = F.col(p) if isinstance(p, str) else p
    return F.when(col > 0, -F.log10(col)).otherwise(F.lit(0.0))


def broadcast_features(df: DataFrame, features: DataFrame, name: str = "feature",
                       value: str = "score") -> DataFrame:
    """Copy a small (feature, score) table to every row as constant columns.

    This is the reference's layout (one column per key).  The feature table is
    bounded by the caller (e.g. the top-10 terms); it is pivoted to one row
    and cross joined as a broadcast.
    """
    n = features.count()
    if n > 10000:
        raise ValueError(f"{n} scalar features are too many to copy to every row; join on the key instead")
    names = [r[0] for r in features.select(name).distinct().orderBy(name).collect()]
    wide = features.groupBy().pivot(name, names).agg(F.first(value))
    return df.crossJoin(F.broadcast(wide))


def counts_to_survival(df: DataFrame, unit: str, t: str, count: str, ref_times: Sequence | None = None,
                       threshold: float = 0.5) -> DataFrame:
    """Growth counts over time -> (unit, duration, event).

    The reference point is the maximum count over ``ref_times`` (all times
    when None) = 100 %.  The duration is the first time after the reference
    time whose count falls below ``threshold`` x peak (event = 1); otherwise
    the last observed time (event = 0).
    """
    require_columns(df, [unit, t, count])
    ref = df if ref_times is None else df.where(F.col(t).isin(list(ref_times)))
    # peak = largest count, earliest time on ties; an aggregate (partial per
    # task), so a unit with a huge number of rows is not a single-task window
    best = F.max(F.struct(F.col(count).alias("c"), (-F.col(t)).alias("nt")))
    peak = (ref.groupBy(unit).agg(best.alias("_b"))
            .select(unit, (-F.col("_b.nt")).alias("_pt"), F.col("_b.c").alias("_peak")))
    x = df.join(peak, unit)
    after = x.where((F.col(t) > F.col("_pt")) & (F.col(count) < F.col("_peak") * threshold))
    first_drop = after.groupBy(unit).agg(F.min(t).alias("_drop"))
    last = df.groupBy(unit).agg(F.max(t).alias("_last"))
    out = last.join(first_drop, unit, "left")
    return out.select(unit, F.coalesce("_drop", "_last").alias("duration"),
                      F.when(F.col("_drop").isNotNull(), 1).otherwise(0).cast("int").alias("event"))
