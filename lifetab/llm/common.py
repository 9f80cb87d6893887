"""Helpers shared by the operators: tables, shared scratch, Arrow batches of text."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lifetab.session import ensure_checkpoint_dir

# The white space of the contracts, as a Java regex class body.
WS = r"\x20\x09-\x0D"
CHUNK_BYTES = 2 << 20


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str = "table", by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: cuts lineage, survives lost executors, and gives later plans real
    sizes.  A fresh folder per call, so reruns never meet old files."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lifetab-{name}-{uuid.uuid4().hex}"
    out = df.write.option("compression", "zstd")
    (out.partitionBy(*by) if by else out).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_bucket(col, modulus: int):
    """crc32 of the id's decimal text modulo ``modulus``; a null id gives -1."""
    return F.coalesce(F.crc32(col.cast("string")) % F.lit(modulus), F.lit(-1).cast("bigint"))


def ranked(df: DataFrame, name: str, *cols) -> DataFrame:
    """Adds ``name``: the 0-based position in the order of ``cols``.  The rows
    are range-partitioned and written once; only one count per partition goes
    through the driver."""
    spark = df.sparkSession
    t = materialise(df.repartitionByRange(partitions(spark), *cols)
                    .withColumn("_pid", F.spark_partition_id()), "ranked")
    ahead, offsets = 0, []
    for r in sorted(t.groupBy("_pid").count().collect(), key=lambda r: r["_pid"]):
        offsets += [F.lit(r["_pid"]), F.lit(ahead)]
        ahead += r["count"]
    if not offsets:
        return t.withColumn(name, F.lit(0).cast("bigint")).drop("_pid")
    within = F.row_number().over(W.partitionBy("_pid").orderBy(*cols)) - 1
    return t.withColumn(name, (F.create_map(*offsets)[F.col("_pid")] + within).cast("bigint")).drop("_pid")


def placed(df: DataFrame, name: str, within: str, *cols) -> DataFrame:
    """Adds ``name``: the 0-based position of a row among those of its (not
    null) group ``within``, in the order of ``cols``.  Rows are range-partitioned
    by group and order and written once, so a hot group lies in many files; the
    offsets are a table with a row per file and group in it."""
    spark = df.sparkSession
    t = df.repartitionByRange(partitions(spark), within, *cols).sortWithinPartitions(within, *cols)
    t = materialise(t.withColumn("_row", F.monotonically_increasing_id()), "placed")
    t = t.withColumn("_pid", F.shiftright("_row", 33))      # the upper bits are the partition
    parts = t.groupBy("_pid", within).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy(within).orderBy("_pid").rowsBetween(W.unboundedPreceding, -1))
    shift = parts.select("_pid", within, (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    return (t.join(shift, ["_pid", within]).withColumn(name, F.col("_row") + F.col("_shift"))
            .drop("_pid", "_row", "_shift"))


# ---- inside tasks -----------------------------------------------------------

def text_chunks(batches, column: str = "text", limit: int = CHUNK_BYTES):
    """Cuts Arrow batches so that each piece holds about ``limit`` bytes of
    text (a longer single text is a piece of its own).  Arrow's freed memory
    goes back to the system after every piece, so idle workers stay small."""
    free = pa.default_memory_pool().release_unused
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, upto - at)
            at = upto
            free()


def grouped(batches, *keys: str):
    """(key values, Arrow table) of every run of rows with equal ``keys``."""
    held, parts = None, []
    for rb in batches:
        if not rb.num_rows:
            continue
        new = np.zeros(rb.num_rows - 1, bool)
        for k in keys:
            c = rb.column(k)
            new |= pc.not_equal(c.slice(1), c.slice(0, rb.num_rows - 1)).to_numpy(zero_copy_only=False)
        cuts = (np.flatnonzero(new) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, rb.num_rows]):
            key = tuple(rb.column(k)[a].as_py() for k in keys)
            if parts and key != held:
                yield held, pa.Table.from_batches(parts)
                parts = []
            held = key
            parts.append(rb.slice(a, b - a))
    if parts:
        yield held, pa.Table.from_batches(parts)


def texts_of(batch, column: str = "text"):
    return pc.fill_null(batch.column(column), "")


def words_of(texts) -> tuple[np.ndarray, pa.Array]:
    """Row offsets and the flat array of white-space separated words."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    offs = lists.offsets.to_numpy().astype(np.int64)
    offs = offs - offs[0]
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    if not full.all():
        offs = np.concatenate([[0], np.cumsum(full)])[offs]
        flat = flat.filter(pa.array(full))
    return offs, flat


def word_hashes(words) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each distinct word, index of each word into them)."""
    import xxhash
    enc = words.dictionary_encode()
    h = xxhash.xxh3_64_intdigest
    own = enc.dictionary.to_pylist()
    return (np.fromiter((h(w) for w in own), np.uint64, len(own)),
            enc.indices.to_numpy(zero_copy_only=False))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads a 64-bit value over all its bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def row_sums(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets (0 for empty rows)."""
    out = np.zeros((len(offs) - 1, *values.shape[1:]), values.dtype)
    full = np.flatnonzero(np.diff(offs))
    if len(full):
        out[full] = np.add.reduceat(values, offs[full], axis=0)
    return out
