"""Readers for the input layouts the reference accepts.

All readers are Spark data sources (text, CSV, Parquet); nothing is parsed
on the driver.  Types are declared where the layout fixes them and inferred
only for the generic matrix reader, as the reference does.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.features import category_codes, sequence_features

# Fixed column layout of the whitespace-delimited labelled-protein table
# (fixed values that must equal the reference's; in file order).
LABELED_TEXT_COLUMNS = ["Sequence_Name", "mcg", "gvh", "alm", "mit", "erl", "pox", "vac", "nuc",
                        "localization_site"]

FASTA_SUFFIXES = (".fasta", ".fa", ".fna", ".faa")


def read_labeled_text(spark: SparkSession, path: str, target: str = "target") -> DataFrame:
    """Whitespace-delimited, no header, the ten fixed columns.  The label
    (last column) becomes 0-based codes in sorted order under ``target``;
    the original label column is dropped; ``Sequence_Name`` is kept."""
    raw = spark.read.text(path).where(F.length(F.regexp_replace("value", r"\s", "")) > 0)
    parts = F.split(F.trim(F.col("value")), r"\s+")
    cols = [parts[0].alias(LABELED_TEXT_COLUMNS[0])]
    cols += [parts[i].cast("double").alias(c) for i, c in enumerate(LABELED_TEXT_COLUMNS[1:9], start=1)]
    cols.append(parts[9].alias(LABELED_TEXT_COLUMNS[9]))
    df = raw.select(*cols)
    coded = category_codes(df, LABELED_TEXT_COLUMNS[9], out="_code")
    return coded.select(*LABELED_TEXT_COLUMNS[:9], F.col("_code").alias(target))


def read_matrix(spark: SparkSession, path: str, sep: str | None = None, schema=None,
                expect: Sequence[str] = (), infer: bool = True) -> DataFrame:
    """Delimited file with a header: comma when the suffix is .csv, tab
    otherwise; types inferred unless a schema is given.  ``expect`` lists
    columns that should exist (a warning is logged when one is missing)."""
    if sep is None:
        sep = "," if str(path).lower().endswith(".csv") else "\t"
    reader = spark.read.option("header", True).option("sep", sep).option("nanValue", "NaN")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", infer)
    df = reader.csv(path)
    missing = [c for c in expect if c and c not in df.columns]
    if missing:
        import logging
        logging.warning("columns %s not found in %s", missing, path)
    return df


def read_replicative(spark, path, target=None, **kw) -> DataFrame:
    """Replicative-lifespan table: a matrix, checked for the target column."""
    return read_matrix(spark, path, expect=[target] if target else (), **kw)


def read_chronological(spark, path, target=None, **kw) -> DataFrame:
    """Chronological-lifespan table: a matrix, checked for the target column."""
    return read_matrix(spark, path, expect=[target] if target else (), **kw)


def read_fasta_records(spark: SparkSession, path: str) -> DataFrame:
    """(id, description, seq): records split by the text source where a line
    starts with '>' (one inside a header is part of it), so a file is read in
    many tasks; id is the first header token, the sequence is the remaining
    lines joined."""
    raw = spark.read.option("lineSep", "\n>").text(path)
    raw = raw.select(F.regexp_replace("value", r"\A\s*>", "").alias("value"))    # a file's first record
    rec = raw.where(F.length(F.regexp_replace("value", r"\s", "")) > 0)
    lines = F.split(F.col("value"), r"\r?\n")
    header = F.regexp_replace(lines[0], r"^\s+|\s+$", "")
    seq = F.array_join(F.slice(lines, 2, 1 << 30), "")
    return rec.select(F.split(header, r"\s+")[0].alias("id"),
                      F.trim(F.regexp_replace(header, r"^\S+", "")).alias("description"),
                      F.regexp_replace(seq, r"\s+", "").alias("seq"))


def read_fasta(spark: SparkSession, path: str, target: str = "target") -> DataFrame:
    """(id, seq_length, gc_content, target=0); error when the file holds no record."""
    rec = read_fasta_records(spark, path)
    if rec.limit(1).count() == 0:
        raise ValueError(f"no FASTA records in {path}")
    return sequence_features(rec, seq="seq", id_col="id", target=target)


def read_triplets(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Long single-cell / spatial counts (cell, gene, count): the layout that
    scales past a wide matrix."""
    return (spark.read.option("header", True).option("sep", sep)
            .schema("cell string, gene string, count double").csv(path))


def read_source(spark: SparkSession, kind: str | None, path, target: str = "target",
                join_on: str = "gene", **kw) -> DataFrame:
    """Reader dispatch: explicit kinds first (geo-style long expression,
    multiomics, scrna, spatial, rls, cls); then the labelled text layout
    (kind 'uci', or a non-csv kind with suffix .data, .txt or none); then
    csv/tsv by kind or suffix; then FASTA; else an error."""
    kind = (kind or "").lower()
    p = str(path[0] if isinstance(path, (list, tuple)) else path)
    suffix = os.path.splitext(p)[1].lower()
    if kind == "geo":
        from ..operators.expression import assemble_expression
        return assemble_expression(read_matrix(spark, p, **kw))
    if kind == "multiomics":
        from ..operators.genes import merge_layers
        paths = list(path) if isinstance(path, (list, tuple)) else [path]
        return merge_layers([read_matrix(spark, x, **kw) for x in paths], on=join_on, names=paths)
    if kind in {"scrna", "spatial"}:
        return read_matrix(spark, p, **kw)
    if kind == "rls":
        return read_replicative(spark, p, target, **kw)
    if kind == "cls":
        return read_chronological(spark, p, target, **kw)
    if kind == "uci" or (kind != "csv" and suffix in {".data", "", ".txt"}):
        return read_labeled_text(spark, p, target)
    if kind in {"csv", "tsv"} or suffix in {".csv", ".tsv"}:
        return read_matrix(spark, p, **kw)
    if kind == "fasta" or suffix in FASTA_SUFFIXES:
        return read_fasta(spark, p, target)
    raise ValueError(f"unsupported data type {kind!r} for {p}")


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """Re-read a processed table written by ``write_table`` (Parquet)."""
    return spark.read.parquet(path)
