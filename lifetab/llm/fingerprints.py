"""Document fingerprints (operator 8): prefix polynomial hashes.

A text's prefix array holds, for two bases modulo 2^31 - 1, the sum of
(code point + 1) * base^place up to every place, so any two spans are compared
in constant time and the longest common extension of two places is found by
binary search.

The fingerprint keeps, from those arrays: the length and hash of the whole
text, hashes of prefixes and suffixes on a ladder of lengths, and the least
hashes of all spans of 12 code points.  Two fingerprints give the length of
the common prefix and suffix by binary search over the ladder, and the share
of common spans; their likeness is the larger share, 1 for equal texts.

Neighbours in id order: rows are dealt to ranges of the id, the first row of
each range also goes to the range before it, and each range is one sorted
stream with one row of memory.

Defined cases: null text is empty; null ids come first; equal ids are in the
order of their texts' hashes; a single row is its own next; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifetab.functions.ordered import bucketize

from .common import load, partitions

P = np.uint64((1 << 31) - 1)
BASES = (1_000_003, 1_234_577)
SPAN = 12
KEEP = 48
LADDER = sorted({int(1.2 ** k) for k in range(120)})   # past 2^31, longer than any text


def _fold(x: np.ndarray) -> np.ndarray:
    """x modulo 2^31 - 1 (below 2^63)."""
    x = (x & P) + (x >> np.uint64(31))
    x = (x & P) + (x >> np.uint64(31))
    return x - P * (x >= P)


class Powers:
    """Powers of the bases and of their inverses, grown on demand."""

    def __init__(self):
        self.up = [np.ones(1, np.uint64) for _ in BASES]
        self.down = [np.ones(1, np.uint64) for _ in BASES]

    def grow(self, n: int):
        for table, roots in ((self.up, BASES), (self.down, [pow(b, -1, int(P)) for b in BASES])):
            for i, root in enumerate(roots):
                while len(table[i]) <= n:
                    step = np.uint64(pow(root, len(table[i]), int(P)))
                    table[i] = np.concatenate([table[i], _fold(table[i] * step)])


class PrefixHash:
    """Prefix arrays of one text (code points as an integer array)."""

    def __init__(self, points: np.ndarray, powers: Powers):
        self.n, self.powers = len(points), powers
        powers.grow(self.n)
        c = points.astype(np.uint64) + np.uint64(1)
        self.prefix = []
        for up in powers.up:
            t = c * up[:self.n]
            t = (t & P) + (t >> np.uint64(31))
            self.prefix.append(np.concatenate([np.zeros(1, np.uint64), _fold(np.cumsum(t, dtype=np.uint64))]))

    def span(self, start, length, base: int = 0):
        """Hashes of spans, the same wherever a span stands (arrays or numbers)."""
        start = np.asarray(start)
        p = self.prefix[base]
        return _fold((p[start + length] + P - p[start]) * self.powers.down[base][start])

    def key(self, start, length) -> np.ndarray:
        return (self.span(start, length, 0) << np.uint64(31)) | self.span(start, length, 1)

    def extension(self, i: int, other: "PrefixHash", j: int) -> int:
        """Longest common extension of place i here and place j there."""
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            mid = (low + high + 1) // 2
            if self.key(i, mid) == other.key(j, mid):
                low = mid
            else:
                high = mid - 1
        return low


class Fingerprint:
    __slots__ = ("n", "whole", "heads", "tails", "least")

    def __init__(self, points: np.ndarray, powers: Powers):
        h = PrefixHash(points, powers)
        self.n = h.n
        self.whole = int(h.key(0, h.n))
        steps = np.array([x for x in LADDER if x <= h.n], np.int64)
        short = np.uint64((1 << 24) - 1)
        self.heads = (h.key(0 * steps, steps) & short).astype(np.int64)
        self.tails = (h.key(h.n - steps, steps) & short).astype(np.int64)
        spans = h.span(np.arange(max(h.n - SPAN + 1, 0)), SPAN) if h.n >= SPAN else np.array([self.whole & int(P)] if h.n else [], np.uint64)
        spans = (spans * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        if len(spans) > 8 * KEEP:
            few = np.unique(np.partition(spans, 4 * KEEP)[:4 * KEEP])
            spans = few if len(few) >= KEEP else spans
        self.least = np.unique(spans)[:KEEP].astype(np.int64)

    def text(self) -> str:
        part = ["".join(f"{x:0{w}x}" for x in v.tolist()) for v, w in ((self.heads, 6), (self.tails, 6), (self.least, 8))]
        return f"{self.n:x}-{self.whole:016x}-" + "-".join(part)

    def like(self, other: "Fingerprint") -> float:
        if (self.n, self.whole) == (other.n, other.whole):
            return 1.0
        if not self.n or not other.n:
            return 0.0
        ends = 0
        for a, b in ((self.heads, other.heads), (self.tails, other.tails)):
            low, high = 0, min(len(a), len(b))
            while low < high:       # equal up to some step of the ladder, then not
                mid = (low + high + 1) // 2
                low, high = (mid, high) if a[mid - 1] == b[mid - 1] else (low, mid - 1)
            ends += LADDER[low - 1] if low else 0
        both = np.union1d(self.least, other.least)[:KEEP]
        shared = np.isin(both, self.least) & np.isin(both, other.least)
        most = max(self.n, other.n)
        return float(min(max(ends / most, shared.mean()), 1 - 1 / (most + 1)))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def _stream(batches):
    """Rows (p, ahead, doc_id, text) sorted; a row's next is the following own
    row of its range, or the first row sent ahead."""
    powers = Powers()
    out: list[tuple] = []
    last = None     # (range, id, text, fingerprint) that waits for its next

    def finish(row, text, mark):
        _, key, own, fp = row
        half = len(own) // 2
        edited = own[:len(own) - half] + text[:half]
        fe = Fingerprint(_points(edited), powers)
        out.append((key, len(own), hashlib.sha256(edited.encode()).hexdigest(), fp.text(), fe.text(), fp.like(fe), fp.like(mark)))

    def batch():
        cols = list(zip(*out)) or [[]] * 7
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
        rows = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=list(names))
        out.clear()
        return rows

    for rb in batches:
        for p, ahead, key, text in zip(*(rb.column(c) for c in ("p", "ahead", "doc_id", "text"))):
            p, ahead, key, text = p.as_py(), ahead.as_py(), key.as_py(), text.as_py() or ""
            if ahead and (last is None or last[0] != p):
                continue
            fp = Fingerprint(_points(text), powers)
            if last is not None and last[0] == p:
                finish(last, text, fp)
            last = None if ahead else (p, key, text, fp)
            if len(out) >= 500:
                yield batch()
    yield batch()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every text, of its edited text, and their likeness to it."""
    spark = docs.sparkSession
    n = partitions(spark)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    src = src.withColumn("_o", F.coalesce("doc_id", F.lit(-2**63).cast("long")))
    bounds = src.where("doc_id is not null").approxQuantile("doc_id", [i / n for i in range(1, n)], 0.2 / n) if n > 1 else []
    src = bucketize(src, "_o", sorted(set(bounds)), "p").withColumn("p", F.col("p").cast("int"))
    heads = sorted((r["p"], r["o"]) for r in src.groupBy("p").agg(F.min("_o").alias("o")).collect())  # a row per range
    ahead = {o: heads[i - 1][0] for i, (_, o) in enumerate(heads)}
    if not ahead:
        return spark.createDataFrame([], SCHEMA)
    before = F.create_map(*[F.lit(x) for kv in ahead.items() for x in kv])[F.col("_o")]
    both = F.when(before.isNull(), F.array(F.struct(F.lit(0).alias("ahead"), F.col("p").alias("p")))).otherwise(
        F.array(F.struct(F.lit(0).alias("ahead"), F.col("p").alias("p")), F.struct(F.lit(1).alias("ahead"), before.alias("p"))))
    dealt = src.withColumn("_z", F.explode(both)).select("_z.p", "_z.ahead", "_o", "doc_id", "text", F.xxhash64("text").alias("_t"))
    return (dealt.repartition(n, "p").sortWithinPartitions("p", "ahead", "_o", "_t")
            .select("p", "ahead", "doc_id", "text").mapInArrow(_stream, SCHEMA))


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document."""
    return fingerprints(load(spark, sf_dir, "documents"))
