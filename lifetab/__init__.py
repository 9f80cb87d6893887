"""lifetab: tabular lifespan / omics analysis as Spark DataFrame operators.

Subpackages:
  sources    readers and sinks
  functions  column helpers (hashing, ordered sums, column selection)
  operators  feature, gene, split, balance, model, metric, survival,
             selection, explanation, causal and fairness operators
  plans      the query catalogue over the driver tables and the
             prepare -> train pipeline
  streaming  scoring a stored model over a stream
"""

__version__ = "0.1.0"
