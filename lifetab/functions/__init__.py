"""Column-level helpers: hashing, ordered sums, column selection."""

from .columns import (drop_columns, nan_to_null, non_numeric_columns, numeric_columns,
                      require_columns, round6, sigmoid)
from .hashing import seeded_hash, seeded_uniform, sql_seeded_hash
from .ordered import global_row_index, quantile_bucket, rank_in_group, running_sums

__all__ = [
    "drop_columns", "nan_to_null", "non_numeric_columns", "numeric_columns", "require_columns",
    "round6", "sigmoid", "seeded_hash", "seeded_uniform", "sql_seeded_hash", "global_row_index",
    "quantile_bucket", "rank_in_group", "running_sums",
]
