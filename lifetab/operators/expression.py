"""Expression matrices and sample metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import numeric_columns

PIVOT_LIMIT = 10000


def _distinct_values(df: DataFrame, col: str, limit: int = PIVOT_LIMIT) -> list:
    vals = df.select(col).where(F.col(col).isNotNull()).distinct().limit(limit + 1).collect()
    if len(vals) > limit:
        raise ValueError(f"more than {limit} distinct {col} values; pass them explicitly or keep the long form")
    return sorted(r[0] for r in vals)


def assemble_expression(long: DataFrame, sample: str = "sample", gene: str = "gene",
                        values: Sequence[str] | None = None, samples: Sequence | None = None) -> DataFrame:
    """Long (sample, gene, value...) -> wide gene x sample matrix.

    Columns are ``<sample>_<value column>``; only genes measured in every
    sample are kept (inner alignment); the first column is ``gene``.  One
    ``groupBy(gene).pivot(sample, samples)``; the sample list is the given one
    or the distinct samples (bounded by ``PIVOT_LIMIT``)."""
    values = list(values) if values is not None else numeric_columns(long, exclude=[sample, gene])
    if not values:
        raise ValueError("no numeric expression columns")
    samples = list(samples) if samples is not None else _distinct_values(long, sample)
    aggs = [F.first(v, ignorenulls=True).alias(v) for v in values] + [F.count(F.lit(1)).alias("_present")]
    wide = long.groupBy(F.col(gene).alias("gene")).pivot(sample, samples).agg(*aggs)
    present = sum((F.when(F.col(f"{s}__present") > 0, 1).otherwise(0) for s in samples), F.lit(0))
    keep = wide.where(present == len(samples))
    return keep.select("gene", *[F.col(f"{s}_{v}").alias(f"{s}_{v}") for s in samples for v in values])


def parse_characteristics(df: DataFrame, sample: str = "gsm", chars: str = "characteristics",
                          keys: Sequence[str] | None = None) -> DataFrame:
    """Per-sample 'key: value' / 'key=value' strings -> one wide row per sample.

    Each string is split once on ':' if it has one, else once on '='; other
    strings are ignored.  Keys are trimmed, lower-cased, spaces -> '_';
    values trimmed; the last occurrence of a key wins.  Missing = NULL.
    """
    ex = df.select(F.col(sample).alias("gsm"), F.posexplode(chars).alias("_pos", "_s"))
    s = F.col("_s")
    colon, eq = F.instr(s, ":"), F.instr(s, "=")
    at = F.when(colon > 0, colon).when(eq > 0, eq)
    kv = ex.where(at.isNotNull()).select(
        "gsm", "_pos",
        F.regexp_replace(F.lower(F.trim(F.substring(s, F.lit(1), at - 1))), " ", "_").alias("key"),
        F.trim(F.substring(s, at + 1, F.lit(1 << 30))).alias("value"))
    last = kv.groupBy("gsm", "key").agg(F.max_by("value", "_pos").alias("value"))
    keys = list(keys) if keys is not None else _distinct_values(last, "key")
    return last.groupBy("gsm").pivot("key", keys).agg(F.first("value"))


def join_expression_metadata(long: DataFrame, meta: DataFrame, sample: str = "sample",
                             meta_key: str = "gsm") -> DataFrame:
    """Long expression rows with their sample's metadata (inner join on the sample key)."""
    m = meta.withColumnRenamed(meta_key, sample) if meta_key != sample else meta
    return long.join(m, sample)


