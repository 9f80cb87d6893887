"""Mixing sources to target weights (operator 4): a time-varying curriculum.

Each source has a weight (its share of all words) and a schedule, a piecewise
linear weight over training time 0..1.  The schedule's integral, scaled to the
source's target, is its cumulative demand of words at any time; the words of a
source lie on one axis in a hashed order of its documents, repeated while the
target lasts, and a document's training position is the time at which the
demand reaches its place on the axis (the integral inverted in closed form).
Documents are range-sorted by position.

Targets: weights share all words; a target stops at ``cap`` times its
source's words and the excess is reshared by weight until none is above.

Scale: a source is cut into 1024 hash slices, so the running word count of a
hot source is many small windows plus one row per slice.

Defined cases: a null text has size 0; null sources are one source, last in
order; null ids are placed by their texts, equal ids ordered by size (equal
rows are interchangeable); an empty table gives no rows; a source without words has target 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import WS, load, materialise, ranked

WEIGHTS = (5.0, 2.0, 1.0)
# Knots (time, weight) by place in the cycle of weights: heavy sources fade, light ones grow.
SCHEDULES = (((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))
CAP = 3.0
SLICES = 1024


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """Per source key ``_k``: its words, weight, place in the cycle and target."""
    by = ranked(sizes.groupBy("_k").agg(F.sum("size").alias("source_size")), "_rank", F.col("_k"))
    by = by.withColumn("_cycle", (F.col("_rank") % len(weights)).cast("int"))
    by = by.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), F.col("_cycle") + 1))
    by = materialise(by, "sources")
    total, wsum = by.agg(F.sum("source_size"), F.sum("_w")).first()
    total = total or 0
    limit = F.lit(cap) * F.col("source_size")
    rate, n = (total / wsum if wsum else 0.0), -1
    while True:  # the rate only rises, so the set of full sources only grows
        full = F.col("_w") * F.lit(rate) > limit
        held, free, count = by.agg(F.sum(F.when(full, limit).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("_w"))),
                                   F.count_if(full)).first()
        if count == n or not free:
            break
        rate, n = (total - held) / free, count
    return by.withColumn("target", F.least(F.col("_w") * F.lit(rate), limit))


def position(share, knots):
    """Time at which the integral of the schedule has reached ``share`` (0..1)."""
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
    total, before, out = sum(areas), 0.0, None
    for ((t0, w0), (t1, w1)), area in zip(zip(knots, knots[1:]), areas):
        need = F.greatest(share * F.lit(total) - F.lit(before), F.lit(0.0))
        slope = (w1 - w0) / (t1 - t0)
        at = F.least(F.lit(t0) + 2 * need / (F.lit(w0) + F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * need, F.lit(0.0)))), F.lit(t1))
        hit = share * F.lit(total) <= F.lit(before + area)
        out = F.when(hit, at) if out is None else out.when(hit, at)
        before += area
    return out.otherwise(F.lit(knots[-1][0]))


def plan_mix(docs: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, cap: float = CAP, seed: str = "mix",
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with size, source_size, target, taken, copies and the places
    (``_at``: words of the source before it; ``_cycle``) of every row."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(f"[^{WS}]+")), F.lit(0)).cast("bigint")
    key = F.when(F.col(source_col).isNull(), F.lit("n")).otherwise(F.concat(F.lit("a"), F.col(source_col)))
    name = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text "), F.xxhash64(text_col).cast("string")))
    place = F.md5(F.concat(F.lit(seed), name))
    base = docs.withColumns({"size": size, "_k": key, "_h": place})
    base = base.withColumn("_slice", F.conv(F.substring("_h", 1, 5), 16, 10).cast("int") % SLICES)
    sizes = materialise(base.groupBy("_k", "_slice").agg(F.sum("size").alias("size")), "slices")
    before = F.sum("size").over(W.partitionBy("_k").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1))
    slices = sizes.select("_k", "_slice", F.coalesce(before, F.lit(0)).alias("_before"))
    offsets = slices.join(source_targets(sizes, weights, cap).drop("_rank", "_w"), "_k")
    order = [F.col("_h"), F.col(id_col), F.col("size")]
    inside = F.sum("size").over(W.partitionBy("_k", "_slice").orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    rows = base.withColumn("_in", F.coalesce(inside, F.lit(0))).join(offsets, ["_k", "_slice"])
    rows = rows.withColumn("_at", F.col("_before") + F.col("_in"))
    middle = F.col("target") - F.col("_at") - F.col("size") / 2
    copies = F.when(F.col("source_size") > 0, F.greatest(F.ceil(middle / F.col("source_size")), F.lit(0))).otherwise(F.lit(0))
    return (rows.withColumn("copies", copies.cast("bigint"))
            .withColumn("taken", (F.col("copies") * F.col("size")).cast("bigint"))
            .drop("_before", "_in", "_slice", "_k"))


def when_taken(copy, schedules=SCHEDULES):
    """Training position of copy ``copy`` (0-based) of a planned row."""
    share = F.least((copy * F.col("source_size") + F.col("_at")) / F.col("target"), F.lit(1.0))
    out = None
    for i, knots in enumerate(schedules):
        hit = F.col("_cycle") == i
        out = F.when(hit, position(share, knots)) if out is None else out.when(hit, position(share, knots))
    return out


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each row as often as it is taken, in training order,
    with the columns of ``docs``."""
    used = [options.get(f"{c}_col", d) for c, d in (("id", "doc_id"), ("text", "text"), ("source", "source"))]
    rows = docs.select(*used, F.struct(*docs.columns).alias("_row"))    # the plan's names may be columns of ``docs``
    planned = plan_mix(rows, **options).where("copies > 0")
    each = planned.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)))
    each = each.withColumn("_time", when_taken(F.col("_copy"), options.get("schedules", SCHEDULES)))
    return each.orderBy("_time", "_h", "_copy").select("_row.*")


def op4_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, range-sorted by first position."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = plan_mix(docs).withColumn("position", F.when(F.col("copies") > 0, when_taken(F.lit(0))))
    return (out.select("doc_id", "size", "source_size", "target", "taken", "position")
            .orderBy(F.col("position").asc_nulls_last(), "doc_id"))
