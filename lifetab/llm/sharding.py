"""Sharding (operator 13): minimax contiguous partition of atomic groups.

Rows with equal texts are one atomic group.  Groups stand in the order of
their least id on one axis, each as long as its rows' sizes.  The shards are
``shards`` contiguous runs of groups with the least possible largest run: a
binary search over capacities, each checked greedily (fill a shard up to the
capacity, cut, go on).

The search needs the axis only near its cuts.  ``Axis`` holds a bounded number
of true group ends and knows between which of them others may lie.  A greedy
check runs twice over it, once with the last known end and once with the place
itself, which is sure to be feasible or sure not to be; where the two disagree,
the gaps on both paths are looked up in the table in one job, until none is
left.  What reaches the driver is bounded by parameters, not by the data.

A group that alone fills the capacity gets a shard of its own and the search
goes on over the others, so one hot group does not leave the other shards
uneven.  Cuts go to the end nearest to an equal share of what is left, where
the rest stays feasible within the capacity.

Scale: texts are read once and leave the scan as two hashes, a crc and a size;
groups aggregate before the shuffle; group ends are running sums over a range
sort; rows meet their group's shard by key, those of groups with over a
thousandth of all rows (at most a thousand groups) by broadcast; places in
shards come from a range sort, in which a hot group lies in many tasks.

Defined cases: a null text has no bytes and is in one group with the empty
text; null ids come first; repeated rows are of one group; fewer groups than
shards leave shards empty; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lifetab.functions.ordered import bucketize

from .common import load, materialise, partitions, placed

SHARDS = 24
OVERHEAD = 8            # bytes a row takes besides its text
GRID = 1 << 16          # gaps that one look-up job may split into
PROBES = 32             # capacities whose unclear paths are looked up together
HOT = 1000              # a group above a HOT-th of the rows is met by broadcast


class Axis:
    """Known group ends; ``open`` marks gaps that may hold more."""

    def __init__(self, groups: DataFrame, total: int):
        self.groups, self.total = groups, total
        self.ends = np.array([0, total], np.int64)
        self.open = np.array([True, False])
        self.resolve([0])

    def resolve(self, gaps):
        """Looks up the open gaps that follow the given known ends: each is cut
        into cells, and every cell's first and last end become known."""
        gaps = sorted({int(g) for g in gaps if self.open[g]})
        narrow = [g for g in gaps if self.ends[g + 1] - self.ends[g] < 2]
        self.open[narrow] = False
        gaps = [g for g in gaps if self.open[g]]
        if not gaps:
            return
        parts = max(2, GRID // len(gaps))
        lows, highs = self.ends[gaps], self.ends[np.array(gaps) + 1]
        width = [max(1, -(-int(b - a) // parts)) for a, b in zip(lows, highs)]
        inside = self.groups.where((F.col("end") > int(lows[0])) & (F.col("end") < int(highs[-1])))
        bounds = sorted({int(x) for pair in zip(lows + 1, highs) for x in pair})
        place = {x: i + 1 for i, x in enumerate(bounds)}    # the place among all bounds tells the gap
        spark = self.groups.sparkSession
        table = F.broadcast(spark.createDataFrame(          # at most GRID rows
            [(place[int(a) + 1], int(a), w) for a, w in zip(lows, width)], "_bk int, _low long, _width long"))
        cells = (bucketize(inside.select("end"), "end", bounds).join(table, "_bk")
                 .groupBy("_bk", F.expr("(end - _low) div _width").alias("cell"))
                 .agg(F.min("end").alias("first"), F.max("end").alias("last"), F.count(F.lit(1)).alias("n")).collect())
        known = dict(zip(self.ends.tolist(), self.open.tolist()))
        for g in gaps:
            known[int(self.ends[g])] = False
        for c in cells:
            known[c["first"]] = c["n"] > 2
            known[c["last"]] = False
        self.ends = np.array(sorted(known), np.int64)
        self.open = np.array([known[e] for e in self.ends.tolist()])

    def learn(self, ends):
        """Takes in further ends that the caller knows."""
        for x in ends:
            i = self.last(x)
            if self.ends[i] != x:
                self.ends = np.insert(self.ends, i + 1, x)
                self.open = np.insert(self.open, i + 1, self.open[i])

    def last(self, x: int) -> int:
        """Index of the last known end at or before ``x``."""
        return int(np.searchsorted(self.ends, x, "right")) - 1

    def fill(self, runs, capacity: int, sure: bool, most: int, gaps: set | None = None):
        """Greedy check: number of shards (``most`` + 1 if more) that hold the
        runs (start, end).  ``sure`` cuts at known ends only; otherwise where an
        unknown one may lie.  ``gaps`` collects the unclear places met."""
        count = 0
        for at, stop in runs:
            while at < stop:
                count += 1
                if count > most:
                    return count
                x = min(at + capacity, stop)
                i = self.last(x)
                lo = int(self.ends[i])
                if self.open[i] and lo < x:
                    if gaps is not None:
                        gaps.add(i)
                    lo = lo if sure else x
                if lo <= at:        # no known end within reach
                    return most + 1
                at = lo
        return count

    def capacity(self, runs, shards: int, least: int) -> int:
        """Smallest capacity with which ``shards`` hold the runs."""
        whole = sum(b - a for a, b in runs)
        low, high = max(least, -(-whole // shards)), whole       # answer in low..high
        while True:
            def search(sure, a, b):
                while a < b:
                    mid = (a + b) // 2
                    a, b = (a, mid) if self.fill(runs, mid, sure, shards) <= shards else (mid + 1, b)
                return a

            high = search(True, low, high)
            low = search(False, low, high)
            if low == high:
                return high
            gaps: set = set()
            for c in np.unique(np.linspace(low, high, PROBES).astype(np.int64)).tolist():
                for sure in (True, False):
                    self.fill(runs, c, sure, shards, gaps)
            self.resolve(gaps)


def _runs(total: int, alone: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The parts of the axis between the groups in ``alone``."""
    edges = sorted({0, total, *(x for g in alone for x in g)})
    return [r for r in zip(edges, edges[1:]) if r not in set(alone)]


def minimax(groups: DataFrame, shards: int = SHARDS) -> tuple[list[int], int]:
    """(cuts, capacity): ends of the shards but the last, over a table with the
    ``size`` and running sum ``end`` of ordered atomic groups, and the size of
    the largest shard."""
    total = groups.agg(F.max("end")).first()[0]
    if not total:
        return [], 0
    axis = Axis(groups, total)
    top = groups.orderBy(F.col("size").desc(), "end").limit(shards + 1).select("size", "end").collect()
    top = [(r["end"] - r["size"], r["end"]) for r in top]
    largest = [b - a for a, b in top] + [1]
    alone: list[tuple[int, int]] = []       # groups with a shard of their own
    runs, left = [(0, total)], shards
    least = capacity = axis.capacity(runs, left, largest[0])
    while left > 1 and len(alone) < len(top) and capacity == largest[len(alone)]:
        alone.append(top[len(alone)])       # it fills the capacity, so nothing is beside it
        runs, left = _runs(total, alone), left - 1
        axis.learn(top[len(alone) - 1])
        if not runs:
            break
        capacity = axis.capacity(runs, left, largest[len(alone)])
    cuts = [b for _, b in alone]
    for j, (at, stop) in enumerate(runs):
        later = runs[j + 1:]
        while at < stop:
            share = at + -(-(sum(b - a for a, b in later) + stop - at) // left)
            i = axis.last(min(share, stop))
            near = [int(e) for e in axis.ends[i:i + 2] if at < e <= min(at + capacity, stop)]
            near.sort(key=lambda e: abs(e - share))
            left -= 1
            far = int(axis.ends[axis.last(min(at + capacity, stop))])
            at = next((e for e in near if axis.fill([(e, stop), *later], capacity, True, left) <= left), far)
            cuts.append(at)
    return sorted(set(cuts) - {total}), least


def shard(docs: DataFrame, shards: int = SHARDS, overhead: int = OVERHEAD, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless in a shard) of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + overhead).cast("bigint").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("_g"),
                       F.xxhash64(F.lit("second"), text).alias("_g2"),
                       F.monotonically_increasing_id().alias("_tie"))
    rows = materialise(rows, "sizes")
    groups = rows.groupBy("_g", "_g2").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"),
                                           F.min("doc_id").alias("least"), F.count_if(F.col("doc_id").isNull()).alias("nulls"))
    order = [F.col("nulls") == 0, F.col("least").asc_nulls_first(), F.col("_g"), F.col("_g2")]
    groups = materialise(running_end(groups, "size", "end", *order), "groups")
    cuts, _ = minimax(groups, shards)
    groups = bucketize(groups, "_before", cuts, "shard").select("_g", "_g2", "shard", "end", "rows")
    # rows take their group's shard and end; hot groups are few by their definition
    limit = rows.count() // HOT
    hot = groups.where(F.col("rows") > limit).select("_g", "_g2", F.col("shard").alias("_s"), F.col("end").alias("_e"))
    some = rows.join(F.broadcast(hot), ["_g", "_g2"], "left")
    of_hot = some.where("_s is not null").withColumnsRenamed({"_s": "shard", "_e": "end"})
    others = some.where("_s is null").drop("_s", "_e").join(groups.where(F.col("rows") <= limit).drop("rows"), ["_g", "_g2"])
    both = of_hot.unionByName(others).withColumn("_k", F.col("shard").cast("string"))
    out = placed(both, "slot", "_k", F.col("end"), F.col("doc_id").asc_nulls_first(), F.col("_tie"))
    return out.select("doc_id", "size", "text_crc32", "shard", "slot")


def running_end(df: DataFrame, size: str, name: str, *order) -> DataFrame:
    """Adds ``_before`` and ``name``: the sums of ``size`` before and up to a row
    in the order given.  Rows are range-sorted and written once; the totals of
    the files are a table with one row each."""
    t = df.repartitionByRange(partitions(df.sparkSession), *order).sortWithinPartitions(*order)
    t = materialise(t.withColumn("_row", F.monotonically_increasing_id()), "running")
    t = t.withColumn("_pid", F.shiftright("_row", 33))
    parts = t.groupBy("_pid").agg(F.sum(size).alias("_sum"))
    ahead = F.coalesce(F.sum("_sum").over(W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    t = t.join(F.broadcast(parts.select("_pid", ahead.alias("_ahead"))), "_pid")    # a row per partition
    # inside a file: runs of rows, then rows of a run, so no window holds a whole file
    t = t.withColumn("_run", F.shiftright("_row", 12))
    runs = t.groupBy("_pid", "_run").agg(F.sum(size).alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(W.partitionBy("_pid").orderBy("_run").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    t = t.join(runs.select("_run", before.alias("_earlier")), "_run")
    inside = F.sum(size).over(W.partitionBy("_run").orderBy("_row").rowsBetween(W.unboundedPreceding, 0))
    t = t.withColumn(name, F.col("_ahead") + F.col("_earlier") + inside)
    return t.withColumn("_before", F.col(name) - F.col(size)).drop("_pid", "_row", "_run", "_ahead", "_earlier")


def op13_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of 24, sizes near equal, equal texts together."""
    out = shard(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
