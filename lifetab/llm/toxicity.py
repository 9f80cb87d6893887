"""Toxicity (operator 2): FTRL-proximal logistic regression over hashed word
n-grams and skip-grams.

Features are the distinct words, word pairs and pairs with one word between
them of a text (lower case, letters and digits only), hashed to a fixed table.
Longer words also count by their stems (the first four and five letters), as
single words, so that inflected forms share what is learned.
Training: a bounded sample of the labelled ids that have a document (``sample``
of them, the least by a hash of the id) is dealt to a few shards; every round each shard runs
FTRL-proximal from the shared state (per-coordinate rates, L1), and the mean of
the shards' changes is the next state.  L1 leaves few weights, so the model is
a small table whatever the corpus; scoring is one pass without a shuffle.

Defined cases: a null or empty text scores the bias alone; ids with several
labels are toxic if at least half of them say so; null ids or labels do not
train; without any training label every score is 0.5 and nothing is rejected
on that ground alone; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_bucket, load, materialise, mix64, text_chunks, texts_of, word_hashes, words_of

BITS = 19
STEMS = (4, 5)
SAMPLE = 16_384
SHARDS = 4
ROUNDS = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 2.0, 0.1
HOLD_OUT = 5


def features(texts, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every occurrence of a word, stem, pair and skip pair."""
    clean = pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\p{L}\p{N}\s]+", " ")
    offs, flat = words_of(clean)
    hashes, which = word_hashes(flat)
    w = hashes[which] if len(which) else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    rows, feats = [row], [w]
    for gap, salt in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        same = row[gap:] == row[:-gap]
        feats.append(mix64(w[:-gap] * np.uint64(salt) + w[gap:])[same] if len(w) > gap else w[:0])
        rows.append(row[gap:][same] if len(w) > gap else row[:0])
    size = pc.utf8_length(flat).to_numpy(zero_copy_only=False)
    for letters in STEMS:
        long = size > letters
        stems, which = word_hashes(pc.utf8_slice_codeunits(flat.filter(pa.array(long)), 0, letters))
        feats.append(mix64(stems + np.uint64(letters))[which] if len(which) else w[:0])
        rows.append(row[long])
    index = (mix64(np.concatenate(feats)) & np.uint64((1 << bits) - 1)).astype(np.int64)
    return np.concatenate(rows), index


def _weights(z, n):
    w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    return np.where(np.abs(z) <= L1, 0.0, w)


def _bias(z, n):
    return -z / ((BETA + math.sqrt(n)) / ALPHA)


def _extract(bits: int):
    def run(batches):
        for chunk in text_chunks(batches):
            row, index = features(texts_of(chunk), bits)
            both = np.unique(row * (1 << bits) + index)
            offs = np.searchsorted(both, np.arange(chunk.num_rows + 1) << bits)
            feats = (both & ((1 << bits) - 1)).astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [chunk.column("shard"), chunk.column("place"), chunk.column("y"),
                 pa.array([feats[a:b].tobytes() for a, b in zip(offs[:-1], offs[1:])], pa.binary())],
                names=["shard", "place", "y", "feats"])
    return run


def _epoch(z0, n0, round_: int):
    """One pass of FTRL-proximal over each shard in the task, from the shared state."""
    def learn(rows):
        z, n = z0.astype(np.float64), n0.astype(np.float64)
        for _, y, feats in sorted(rows, key=lambda r: ((r[0] * (2 * round_ + 1)) & (2**64 - 1), r[0])):
            f = np.append(np.frombuffer(feats, "<u4").astype(np.int64), len(z) - 1)
            zf, nf = z[f], n[f]
            w = _weights(zf, nf)
            w[-1] = _bias(zf[-1], nf[-1])
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, w.sum()))))
            g = p - y
            sigma = (np.sqrt(nf + g * g) - np.sqrt(nf)) / ALPHA
            z[f] = zf + g - sigma * w
            n[f] = nf + g * g
        at = np.flatnonzero(n != n0)
        return at.astype("<i4").tobytes(), (z - z0)[at].astype("<f4").tobytes(), (n - n0)[at].astype("<f4").tobytes()

    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for shard, *row in zip(*(batch.column(c).to_pylist() for c in ("shard", "place", "y", "feats"))):
                held.setdefault(shard, []).append(row)
        out = [learn(held[s]) for s in sorted(held)]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.binary()) for i in range(3)], names=["at", "dz", "dn"])
    return run


def _mean(size: int):
    """The mean of the shards' changes (a fixed number of shards, at most a table each)."""
    def run(batches):
        z, n, shards = np.zeros(size, np.float32), np.zeros(size, np.float32), 0
        for batch in batches:
            for at, dz, dn in zip(*(batch.column(c) for c in ("at", "dz", "dn"))):
                at = np.frombuffer(at.as_py(), "<i4")
                z[at] += np.frombuffer(dz.as_py(), "<f4")
                n[at] += np.frombuffer(dn.as_py(), "<f4")
                shards += 1
        if shards:
            yield pa.RecordBatch.from_arrays([pa.array([(x / shards).astype("<f4").tobytes()], pa.binary()) for x in (z, n)], names=["dz", "dn"])
    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample: int = SAMPLE, bits: int = BITS, shards: int = SHARDS, rounds: int = ROUNDS):
    """(feature numbers, weights, bias) learned from at most ``sample`` labelled
    ids; the bias is None if there was no row to learn from."""
    spark = docs.sparkSession
    lab = labels.select(F.col(id_col).alias("_l"), F.col(label_col).cast("double").alias("y")).dropna()
    lab = lab.where(id_bucket(F.col("_l"), HOLD_OUT) > 0).groupBy("_l").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    lab = lab.join(docs.select(F.col(id_col).alias("_l")), "_l", "left_semi")
    lab = lab.withColumn("place", F.xxhash64(F.lit("toxicity"), "_l")).orderBy("place", "_l").limit(sample)
    lab = F.broadcast(lab.withColumn("shard", F.pmod("place", F.lit(shards)).cast("int")))  # ``sample`` rows at most
    rows = docs.select(F.col(id_col).alias("_l"), F.col(text_col).alias("text")).join(lab, "_l")
    kind = "shard int, place long, y int, feats binary"
    data = materialise(rows.select("shard", "place", "y", "text").mapInArrow(_extract(bits), kind)
                       .repartition(shards, "shard").sortWithinPartitions("shard", "place"), "toxicity")
    z, n = np.zeros((1 << bits) + 1, np.float32), np.zeros((1 << bits) + 1, np.float32)
    for round_ in range(rounds):    # one task averages the shards' changes; two tables come back
        parts = data.mapInArrow(_epoch(z, n, round_), "at binary, dz binary, dn binary")
        for r in parts.repartition(1).mapInArrow(_mean(len(z)), "dz binary, dn binary").collect():
            z = z + np.frombuffer(r["dz"], "<f4")
            n = n + np.frombuffer(r["dn"], "<f4")
    w = _weights(z[:-1], n[:-1])
    at = np.flatnonzero(w)
    return at, w[at], _bias(z[-1], n[-1]) if n[-1] > 0 else None     # every row moves the bias' n


def margins(spark: SparkSession, model, bits: int = BITS):
    """A function for tasks: Arrow texts to the model's log odds.  The weights
    left by L1 are broadcast (at most 2^bits of them)."""
    at, w, bias = model
    bias = bias or 0.0
    table = spark.sparkContext.broadcast((at.astype(np.int32), w.astype(np.float32)))
    full = []

    def margin(texts):
        if not full:
            full.append(np.zeros(1 << bits, np.float32))
            full[0][table.value[0]] = table.value[1]
        row, index = features(texts, bits)
        hit = full[0][index] != 0
        both = np.unique(row[hit] * (1 << bits) + index[hit])
        total = np.bincount(both >> bits, full[0][both & ((1 << bits) - 1)], len(texts)) + bias
        return np.clip(total, -30, 30)
    return margin


def score(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """(doc_id, score) of every row, one pass."""
    margin = margins(docs.sparkSession, model, bits)

    def run(batches):
        for chunk in text_chunks(batches):
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), pa.array(1 / (1 + np.exp(-margin(texts_of(chunk)))))],
                                             names=["doc_id", "score"])
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, f"doc_id {dict(src.dtypes)['doc_id']}, score double")


def clean(docs: DataFrame, model, text_col: str = "text", bits: int = BITS, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores under ``threshold``;
    all rows if the model learned from none."""
    if model[2] is None:
        return docs
    margin = margins(docs.sparkSession, model, bits)

    def run(batches):
        for batch in batches:
            for chunk in text_chunks([batch], text_col):
                keep = 1 / (1 + np.exp(-margin(texts_of(chunk, text_col)))) < threshold
                yield chunk.filter(pa.array(keep))
    return docs.mapInArrow(run, docs.schema)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, load(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", (id_bucket(F.col("doc_id"), HOLD_OUT) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
