"""Line dedup (operator 5): overlapping three-line windows.

Every run of three consecutive non-blank lines is hashed (128 bits, lines
trimmed); so is every run of one or two lines that holds ``long_words`` words
or more, since a long passage may stand on a single line.  A window that
occurs more than once keeps its first occurrence, in the order (id, text
hash, line); the lines that later occurrences cover are merged into ranges and
cut out.  The globally first copy of every line is never cut.

Scale: counting windows is one partially aggregated shuffle of two hashes per
window; only windows that repeat are joined back, and text is shuffled once,
to meet its ranges.  A window that stands in a third of the documents is one
row after the partial aggregation, and its occurrences are split by the
adaptive skew join.

Defined cases: null text stays null, an empty one empty; blank lines belong
to no window and go only when a range covers them; rows that repeat another
row's id and text count as that row; a text whose lines all go is empty; an
empty table gives no rows; extra columns are kept as they are, but for one
named ``lines_removed``, which is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import WS, load, materialise

LINES = 3
LONG_WORDS = 50


def line_windows(docs: DataFrame, lines: int = LINES, long_words: int = LONG_WORDS) -> DataFrame:
    """(_id, _t, a, b, first, last): two hashes of each window and the lines it covers."""
    cut = F.expr("transform(split(_text, '\\n', -1), (x, i) -> struct(i as i, trim(x) as s))")
    own = docs.select("_id", "_t", F.filter(cut, lambda x: x["s"] != "").alias("_l"))
    count = F.regexp_count
    own = own.select("_id", "_t", F.transform("_l", lambda x: F.struct(
        x["i"].alias("i"), F.xxhash64(x["s"]).alias("h"), F.xxhash64(F.lit(1), F.reverse(x["s"])).alias("g"),
        count(x["s"], F.lit(f"[^{WS}]+")).alias("w"))).alias("_l"))
    wins = f"""flatten(transform(_l, (x, p) -> filter(transform(sequence(1, {lines}), k ->
        if(p + k > size(_l), null, struct(
            xxhash64(k, transform(slice(_l, p + 1, k), y -> y.h)) as a,
            xxhash64(k, transform(slice(_l, p + 1, k), y -> y.g)) as b,
            x.i as first, _l[p + k - 1].i as last, k as k,
            aggregate(slice(_l, p + 1, k), 0, (s, y) -> s + y.w) as w))),
        z -> z is not null and (z.k = {lines} or z.w >= {long_words}))))"""
    out = own.select("_id", "_t", F.explode(F.expr(wins)).alias("z"))
    return out.select("_id", "_t", "z.a", "z.b", "z.first", "z.last")


def covered_ranges(wins: DataFrame) -> DataFrame:
    """(_id, _t, _ranges): merged line ranges that later occurrences cover."""
    rep = (wins.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("_id", "_t", "first")).alias("keep"))
           .where("n > 1").drop("n"))
    here = F.struct("_id", "_t", "first")
    late = wins.join(rep, ["a", "b"]).where(~here.eqNullSafe(F.col("keep"))).select("_id", "_t", "first", "last")
    own = W.partitionBy("_id", "_t").orderBy("first", "last")
    reach = F.max("last").over(own.rowsBetween(W.unboundedPreceding, -1))
    fresh = F.when(reach.isNull() | (F.col("first") > reach + 1), 1).otherwise(0)
    marked = late.distinct().withColumn("_new", fresh).withColumn("_island", F.sum("_new").over(own))
    islands = marked.groupBy("_id", "_t", "_island").agg(F.min("first").alias("s"), F.max("last").alias("e"))
    return islands.groupBy("_id", "_t").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("_ranges"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                lines: int = LINES, long_words: int = LONG_WORDS) -> DataFrame:
    """``docs`` with repeated passages cut from ``text_col``, and
    ``lines_removed`` (number of lines that went)."""
    keyed = docs.withColumns({"_id": F.col(id_col), "_text": F.col(text_col)})
    keyed = keyed.withColumn("_t", F.xxhash64("_text"))
    wins = materialise(line_windows(keyed.select("_id", "_t", "_text"),
                                    lines, long_words).distinct(), "windows")
    ranges = covered_ranges(wins).withColumnsRenamed({"_id": "_id2", "_t": "_t2"})
    hit = keyed.join(ranges, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_t") == F.col("_t2")), "left")
    kept = """array_join(flatten(transform(sequence(0, size(_ranges)), i -> slice(_lines,
        if(i = 0, 1, _ranges[i - 1].e + 2),
        if(i = size(_ranges), size(_lines), _ranges[i].s) - if(i = 0, 0, _ranges[i - 1].e + 1)))), '\\n')"""
    gone = F.coalesce(F.expr("aggregate(_ranges, 0, (n, r) -> n + r.e - r.s + 1)"), F.lit(0))
    out = hit.withColumn("_lines", F.expr("if(_ranges is null, null, split(_text, '\\n', -1))"))
    out = out.withColumn("_cut", F.when(F.col("_ranges").isNull(), F.col("_text")).otherwise(F.expr(kept)))
    return out.select(*[F.col("_cut").alias(c) if c == text_col else F.col(c) for c in docs.columns if c != "lines_removed"],
                      gone.cast("bigint").alias("lines_removed"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its repeated passages cut."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "text", "lines_removed")
