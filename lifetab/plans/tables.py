"""Driver tables and the derived tables the query catalogue shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def surv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per events.user_id: start = first event; the event of interest is the
    first ``purchase`` with value > 150; duration = whole calendar days from
    start to that purchase, else to the user's last event (censored).
    Extra covariates: mean event value, number of events."""
    ev = load(spark, sf_dir, "events")
    hit = F.when((F.col("event_type") == "purchase") & (F.col("value") > 150), F.col("ts"))
    per = ev.groupBy("user_id").agg(
        F.min("ts").alias("t0"), F.max("ts").alias("t1"), F.min(hit).alias("tp"),
        F.avg("value").alias("mean_value"), F.count(F.lit(1)).alias("n_events"))
    end = F.coalesce("tp", "t1")
    return per.select(
        "user_id",
        F.datediff(F.to_date(end), F.to_date("t0")).cast("double").alias("duration"),
        F.when(F.col("tp").isNotNull(), 1).otherwise(0).cast("int").alias("event"),
        "mean_value", F.col("n_events").cast("double").alias("n_events"))


SURV_SQL = """
surv AS (
  SELECT user_id,
         CAST(date_diff('day', CAST(min(ts) AS DATE), CAST(coalesce(min(CASE WHEN event_type = 'purchase' AND value > 150 THEN ts END), max(ts)) AS DATE)) AS DOUBLE) AS duration,
         CASE WHEN min(CASE WHEN event_type = 'purchase' AND value > 150 THEN ts END) IS NOT NULL THEN 1 ELSE 0 END AS event,
         avg(value) AS mean_value,
         CAST(count(*) AS DOUBLE) AS n_events
  FROM events GROUP BY user_id
)"""


def doc_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels x documents with a fixed score formula on n_chars (a stand-in
    classifier output): p = 1 / (1 + exp(-(ln(n_chars) - 7))), predicted
    label = p >= 0.5."""
    lab = load(spark, sf_dir, "labels")
    doc = load(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    x = lab.join(doc, "doc_id")
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.log(F.col("n_chars").cast("double")) - F.lit(7.0))))
    return x.select("doc_id", "lang", "source", "n_chars", "quality", "toxic", p.alias("p1"),
                    F.when(p >= 0.5, 1).otherwise(0).cast("int").alias("pred"))


DOC_SCORES_SQL = """
ds AS (
  SELECT l.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic,
         1.0 / (1.0 + exp(-(ln(CAST(d.n_chars AS DOUBLE)) - 7.0))) AS p1,
         CASE WHEN 1.0 / (1.0 + exp(-(ln(CAST(d.n_chars AS DOUBLE)) - 7.0))) >= 0.5 THEN 1 ELSE 0 END AS pred
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id
)"""


def part_supplier_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplied interaction network: part -- supplier for every lineitem."""
    li = load(spark, sf_dir, "lineitem")
    return li.select(F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("src"),
                     F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("dst"))


def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part")
    sup = load(spark, sf_dir, "supplier")
    return (part.select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("gene"),
                        F.col("p_retailprice").alias("x"))
            .unionByName(sup.select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("gene"),
                                    F.col("s_acctbal").alias("x"))))


GRAPH_SQL = """
e AS (
  SELECT DISTINCT least(a, b) AS src, greatest(a, b) AS dst
  FROM (SELECT 'p' || CAST(l_partkey AS VARCHAR) AS a, 's' || CAST(l_suppkey AS VARCHAR) AS b FROM lineitem)
  WHERE a <> b
),
ends AS (SELECT src AS gene FROM e UNION ALL SELECT dst FROM e),
f AS (
  SELECT 'p' || CAST(p_partkey AS VARCHAR) AS gene, p_retailprice AS x FROM part
  UNION ALL SELECT 's' || CAST(s_suppkey AS VARCHAR), s_acctbal FROM supplier
),
nodes AS (SELECT gene FROM f UNION SELECT gene FROM ends),
deg AS (SELECT gene, count(*) AS d FROM ends GROUP BY gene),
cent AS (
  SELECT nodes.gene, CAST(coalesce(d, 0) AS BIGINT) AS degree,
         CASE WHEN (SELECT count(*) FROM nodes) <= 1 THEN 1.0
              ELSE coalesce(d, 0) / ((SELECT count(*) FROM nodes) - 1) END AS centrality
  FROM nodes LEFT JOIN deg USING (gene)
)"""


DOC_FEATURES = ["n_chars", "n_words", "n_lines", "digit_frac", "upper_frac", "punct_frac"]


def doc_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels x documents with text statistics over the whole text (all
    built-in string functions): characters, words, lines, and the fractions
    of digits, upper-case letters and punctuation."""
    lab = load(spark, sf_dir, "labels")
    doc = load(spark, sf_dir, "documents")
    t = F.col("text")
    n = F.greatest(F.length(t), F.lit(1)).cast("double")

    def frac(pattern):
        return (F.length(t) - F.length(F.regexp_replace(t, pattern, ""))) / n

    x = doc.select("doc_id", "lang",
                   F.col("n_chars").cast("double").alias("n_chars"),
                   F.size(F.split(F.trim(t), r"\s+")).cast("double").alias("n_words"),
                   F.size(F.split(t, "\n")).cast("double").alias("n_lines"),
                   frac(r"[0-9]").alias("digit_frac"), frac(r"\p{Lu}").alias("upper_frac"),
                   frac(r"\p{P}").alias("punct_frac"))
    return lab.join(x, "doc_id")


def embedding_features(spark: SparkSession, sf_dir: str, dims: int = 64) -> DataFrame:
    """embeddings as a wide table e0..e{dims-1} with the label."""
    e = load(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(dims)])
