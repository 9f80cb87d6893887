"""Readers and sinks."""

from .readers import (read_chronological, read_fasta, read_fasta_records, read_labeled_text, read_matrix,
                      read_processed, read_replicative, read_source, read_triplets)
from .sinks import load_model, load_preferred_model, save_model, write_expression, write_metrics, write_table

__all__ = ["read_chronological", "read_fasta", "read_fasta_records", "read_labeled_text", "read_matrix",
           "read_processed", "read_replicative", "read_source", "read_triplets", "load_model",
           "load_preferred_model", "save_model", "write_expression", "write_metrics", "write_table"]
