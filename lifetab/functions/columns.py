"""Column selection, checks and small scalar expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Names of numeric (non-boolean) columns, in schema order."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def non_numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if not isinstance(f.dataType, T.NumericType) and f.name not in skip]


def require_columns(df: DataFrame, cols: Iterable[str], what: str = "input") -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks column(s) {missing}; has {df.columns}")


def nan_to_null(c) -> Column:
    """SQL NULL for NaN, so aggregates skip it (Spark's avg does not skip NaN)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.nanvl(col.cast("double"), F.lit(None).cast("double"))


def sigmoid(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col))


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


def round6(c) -> Column:
    """Round to 6 digits and turn -0.0 into 0.0 (stable text/hash form)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), 6) + F.lit(0.0)
