"""A training corpus from ``documents``: toxicity filter, line dedup,
near-duplicate removal, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; stages but the
last keep the columns of ``documents``.  ``run`` chains them, each stage's rows
written to the shared checkpoint folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifetab.llm import jaccard_join, line_dedup, mixing, packing, toxicity
from lifetab.llm.common import load, materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier of operator 2 does not reject (score under 0.5)."""
    model = toxicity.train(docs, load(spark, sf_dir, "labels"))
    return toxicity.clean(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: repeated passages cut; n_chars follows the text.  Documents
    that consisted of repeated passages only go."""
    cut = line_dedup.dedup_lines(docs)
    cut = cut.where((F.col("lines_removed") == 0) | (F.trim("text") != ""))
    return cut.withColumn("n_chars", F.when(F.col("lines_removed") > 0, F.length("text").cast("long"))
                          .otherwise(F.col("n_chars"))).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: one document of each group stays."""
    return jaccard_join.one_per_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: every document as often as the mix takes it, in training order."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: pieces placed in sequences of at most 2048 tokens."""
    return packing.pack(docs, packing.default_tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# A trained classifier and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
