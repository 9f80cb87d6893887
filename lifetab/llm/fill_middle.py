"""Fill-in-middle transformation (operator 11): counted-quantifier regex.

A text is a run of units, a word with the white space before it or closing
white space.  ``regexp_count`` gives their number n; two hashes of the id
choose two cuts a <= b among the n + 1 places.  One match of a pattern built
for the row, ``(unit{a}+)(unit{b-a}+)(.*)``, captures prefix, middle and suffix,
and its replacement writes the output.  The counted groups are possessive, so
the matcher loops over units and keeps no place to return to: memory does not
grow with the number of units.

Forms: psm ``<P>`` prefix ``<S>`` suffix ``<M>`` middle; spm ``<S>`` suffix
``<P>`` prefix ``<M>`` middle; plain: the text, for the share of rows that is not
transformed, for empty texts and for texts that hold a marker.  No marker can
arise where two parts meet (a marker ends in the only ``>`` it has, and parts
hold none of them), so ``restore`` gives the text back exactly.

One scan, no shuffle, column functions only.

Defined cases: a null text is empty; a null id hashes as the empty string;
repeated rows give repeated rows; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WS, load

SEED = 42
RATE = 50       # of 100 texts are transformed
SPM = 80        # of 100 transformed texts have the suffix first
MARKERS = ("<P>", "<S>", "<M>")
UNIT = rf"[{WS}]*+[^{WS}]++|[{WS}]++"


def hash_parts(seed: int, key: Column) -> list[Column]:
    """The first four 32-bit numbers of the sha256 of ``seed:key``."""
    hexed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(hexed, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def counted_pattern(first: Column, second: Column) -> Column:
    """Pattern whose groups are ``first`` units, ``second`` units, and the rest."""
    return F.concat(F.lit(rf"(?s)\A((?:{UNIT}){{"), first.cast("string"), F.lit(rf"}}+)((?:{UNIT}){{"),
                    second.cast("string"), F.lit(r"}+)(.*+)\z"))


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM, markers=MARKERS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, n, form, prefix_chars, middle_chars, output of every row."""
    p, s, m = markers
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"),
                       F.regexp_count(text, F.lit(UNIT)).cast("bigint").alias("n"))
    rows = rows.select("*", *[h.alias(f"_h{i}") for i, h in enumerate(hash_parts(seed, F.col("doc_id")), 1)])
    marked = F.lit(False)
    for x in markers:
        marked = marked | F.contains("text", F.lit(x))
    cuts = [F.col(f"_h{i}") % (F.col("n") + 1) for i in (1, 2)]
    rows = rows.select(
        "doc_id", "text", "n", F.least(*cuts).alias("_a"), F.greatest(*cuts).alias("_b"),
        F.when((F.col("text") == "") | marked | (F.col("_h3") % 100 >= rate), "plain")
        .when(F.col("_h4") % 100 < spm, "spm").otherwise("psm").alias("form"))
    order = F.when(F.col("form") == "spm", F.lit(f"{s}$3{p}$1{m}$2")).otherwise(F.lit(f"{p}$1{s}$3{m}$2"))
    rows = rows.withColumn("output", F.when(F.col("form") == "plain", F.col("text")).otherwise(
        F.regexp_replace("text", counted_pattern(F.col("_a"), F.col("_b") - F.col("_a")), order)))
    at = {x: F.instr("output", F.lit(x)) for x in markers}
    prefix = F.when(F.col("form") == "psm", at[s] - len(p) - 1).when(F.col("form") == "spm", at[m] - at[p] - len(p))
    middle = F.when(F.col("form") != "plain", F.length("output") - at[m] - len(m) + 1)
    return rows.select("doc_id", "text", "n", "form", prefix.cast("bigint").alias("prefix_chars"),
                       middle.cast("bigint").alias("middle_chars"), "output")


def restore(output: Column, form: Column, markers=MARKERS) -> Column:
    """The text that ``output`` was made from."""
    p, s, m = (re.escape(x) for x in markers)
    psm = F.regexp_replace(output, F.lit(rf"(?s)\A{p}(.*?){s}(.*?){m}(.*+)\z"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(rf"(?s)\A{s}(.*?){p}(.*?){m}(.*+)\z"), F.lit("$2$3$1"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, cut into prefix, middle and suffix."""
    out = fill_in_middle(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


_WS = r"\x20\x09-\x0D"
SQL = {"op11_fill_in_middle": rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[{_WS}]*[^{_WS}]+|[{_WS}]+') AS u
  FROM documents),
e AS (
  SELECT doc_id, t, u, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS c1,
         ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS c2,
         ('0x' || h[17:24])::BIGINT % 100 AS c3, ('0x' || h[25:32])::BIGINT % 100 AS c4
  FROM d),
f AS (
  SELECT doc_id, t, n, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c3 >= 50
                           THEN 'plain' WHEN c4 < 80 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(u[1:least(c1, c2)], '') AS p,
         array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
         array_to_string(u[greatest(c1, c2) + 1:n], '') AS s
  FROM e)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f"""}
