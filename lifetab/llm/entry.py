"""The registered queries of this folder and their DuckDB SQL."""

from __future__ import annotations

from . import (fill_middle, fingerprints, jaccard_join, language_id, line_dedup, lm_scoring, merkle, mixing, packing, pii,
               sharding, topk_search, toxicity)

MODULES = (lm_scoring, toxicity, topk_search, mixing, line_dedup, jaccard_join, pii, fingerprints, language_id, packing,
           fill_middle, merkle, sharding)

QUERIES = {name: getattr(m, name) for m in MODULES for name in vars(m) if name.startswith("op") and name[2].isdigit()}
SQL = {name: sql for m in MODULES for name, sql in getattr(m, "SQL", {}).items()}
