"""Query catalogue: every operator run over the driver tables, with the
equivalent DuckDB SQL used as the correctness oracle.

Conventions so that the two sides hash equal: every computed double is
rounded to 6 digits (and -0.0 folded to 0.0), integers are BIGINT, names are
aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import round6
from . import tables as tb

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn
    return deco


def normalize(df: DataFrame) -> DataFrame:
    """Integers -> BIGINT, floating -> DOUBLE rounded to 6 digits."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            cols.append(F.col(f.name).cast("long").alias(f.name))
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            cols.append(round6(f.name).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def R(expr: str) -> str:
    """SQL twin of ``round6``."""
    return f"round(CAST({expr} AS DOUBLE), 6) + 0.0"


def _t(spark, sf, name):
    return tb.load(spark, sf, name)


# =========================================================================== B3
from ..operators import features as fx  # noqa: E402


@query("zscore", f"""
SELECT o_orderkey, {R("CASE WHEN s IS NULL OR s = 0 THEN 0.0 ELSE (o_totalprice - m) / s END")} AS z_o_totalprice
FROM orders, (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders) st
""")
def q_zscore(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return normalize(fx.zscore(o, ["o_totalprice"]).select("o_orderkey", "z_o_totalprice"))


@query("zscore_nulls", f"""
WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price FROM orders)
SELECT o_orderkey, {R("CASE WHEN s IS NULL OR s = 0 THEN 0.0 ELSE (price - m) / s END")} AS z_price
FROM x, (SELECT avg(price) AS m, stddev_pop(price) AS s FROM x) st
""")
def q_zscore_nulls(spark, sf):
    o = _t(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, None).otherwise(F.col("o_totalprice")).alias("price"))
    return normalize(fx.zscore(o, ["price"]).select("o_orderkey", "z_price"))


@query("zscore_constant", f"""
WITH x AS (SELECT p_partkey, p_retailprice, CAST(p_size * 0 + 5 AS DOUBLE) AS c FROM part)
SELECT p_partkey,
       {R("CASE WHEN s1 IS NULL OR s1 = 0 THEN 0.0 ELSE (p_retailprice - m1) / s1 END")} AS z_p_retailprice,
       {R("CASE WHEN s2 IS NULL OR s2 = 0 THEN 0.0 ELSE (c - m2) / s2 END")} AS z_c
FROM x, (SELECT avg(p_retailprice) m1, stddev_pop(p_retailprice) s1, avg(c) m2, stddev_pop(c) s2 FROM x) st
""")
def q_zscore_constant(spark, sf):
    p = _t(spark, sf, "part").select("p_partkey", "p_retailprice", (F.col("p_size") * 0 + 5).cast("double").alias("c"))
    return normalize(fx.zscore(p, exclude=["p_partkey"]).select("p_partkey", "z_p_retailprice", "z_c"))


@query("zscore_wide", f"""
WITH u AS (SELECT vec_id, CAST(i - 1 AS BIGINT) AS dim, CAST(embedding[i] AS DOUBLE) AS x
           FROM embeddings, range(1, 65) t(i)),
st AS (SELECT dim, avg(x) AS m, stddev_pop(x) AS s FROM u GROUP BY dim)
SELECT vec_id, dim, {R("CASE WHEN s IS NULL OR s = 0 THEN 0.0 ELSE (x - m) / s END")} AS z
FROM u JOIN st USING (dim)
""")
def q_zscore_wide(spark, sf):
    e = _t(spark, sf, "embeddings")
    wide = e.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)])
    z = fx.zscore(wide, [f"e{i}" for i in range(64)])
    long = z.select("vec_id", F.explode(F.array(*[
        F.struct(F.lit(i).cast("long").alias("dim"), F.col(f"z_e{i}").alias("z")) for i in range(64)])).alias("s"))
    return normalize(long.select("vec_id", "s.dim", "s.z"))


@query("zscore_long", f"""
WITH u AS (SELECT l_partkey, l_returnflag AS feature, sum(l_quantity) AS value FROM lineitem GROUP BY l_partkey, l_returnflag),
st AS (SELECT feature, avg(value) AS m, stddev_pop(value) AS s FROM u GROUP BY feature)
SELECT l_partkey, feature, {R("CASE WHEN s IS NULL OR s = 0 THEN 0.0 ELSE (value - m) / s END")} AS z
FROM u JOIN st USING (feature)
""")
def q_zscore_long(spark, sf):
    li = _t(spark, sf, "lineitem")
    u = li.groupBy("l_partkey", F.col("l_returnflag").alias("feature")).agg(F.sum("l_quantity").alias("value"))
    return normalize(fx.zscore_long(u, "feature", "value").select("l_partkey", "feature", "z"))


# =========================================================================== B4
@query("category_codes", """
WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS p FROM orders)
SELECT o_orderkey, CAST(CASE WHEN p IS NULL THEN -1 ELSE dense_rank() OVER (PARTITION BY p IS NULL ORDER BY p) - 1 END AS BIGINT) AS code
FROM x
""")
def q_category_codes(spark, sf):
    o = _t(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 11 == 0, None).otherwise(F.col("o_orderpriority")).alias("p"))
    return normalize(fx.category_codes(o, "p", out="code").select("o_orderkey", "code"))


# =========================================================================== D1
from ..operators import balance as bal  # noqa: E402


@query("class_weights", f"""
SELECT CAST(quality AS BIGINT) AS label, count(*) AS n,
       {R("sum(count(*)) OVER () / (count(*) OVER () * count(*))")} AS weight
FROM labels GROUP BY quality
""")
def q_class_weights(spark, sf):
    return normalize(bal.class_weights(_t(spark, sf, "labels"), "quality"))


@query("class_weights_orders", f"""
SELECT o_orderstatus AS label, count(*) AS n,
       {R("sum(count(*)) OVER () / (count(*) OVER () * count(*))")} AS weight
FROM orders GROUP BY o_orderstatus
""")
def q_class_weights_orders(spark, sf):
    return normalize(bal.class_weights(_t(spark, sf, "orders"), "o_orderstatus"))


# =========================================================================== C1
from ..operators import genes as gx  # noqa: E402


@query("merge_layers", f"""
WITH l0 AS (SELECT p_partkey AS gene, p_retailprice, p_size FROM part),
l1 AS (SELECT l_partkey AS gene, sum(l_quantity) AS qty, count(*) AS n FROM lineitem GROUP BY l_partkey),
l2 AS (SELECT l_partkey AS gene, avg(l_extendedprice) AS price FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_partkey)
SELECT gene, {R("p_retailprice")} AS p_retailprice, CAST(p_size AS BIGINT) AS p_size,
       {R("qty")} AS qty_m1, CAST(n AS BIGINT) AS n_m1, {R("price")} AS price_m2
FROM l0 JOIN l1 USING (gene) JOIN l2 USING (gene)
""")
def q_merge_layers(spark, sf):
    part, li = _t(spark, sf, "part"), _t(spark, sf, "lineitem")
    l0 = part.select(F.col("p_partkey").alias("gene"), "p_retailprice", "p_size")
    l1 = li.groupBy(F.col("l_partkey").alias("gene")).agg(F.sum("l_quantity").alias("qty"),
                                                         F.count(F.lit(1)).alias("n"))
    l2 = (li.where(F.col("l_returnflag") == "R").groupBy(F.col("l_partkey").alias("gene"))
          .agg(F.avg("l_extendedprice").alias("price")))
    return normalize(gx.merge_layers([l0, l1, l2], on="gene"))


# =========================================================================== A5/B7
@query("sequence_features", f"""
SELECT doc_id AS id, CAST(length(text) AS BIGINT) AS seq_length,
       {R("CASE WHEN length(text) > 0 THEN (length(text) - length(translate(text, 'GCgc', ''))) / length(text) ELSE 0.0 END")} AS gc_content,
       CAST(0 AS BIGINT) AS target
FROM documents
""")
def q_sequence_features(spark, sf):
    d = _t(spark, sf, "documents")
    return normalize(fx.sequence_features(d, seq="text", id_col="doc_id").withColumnRenamed("doc_id", "id"))


# =========================================================================== C2/E4
@query("ortholog_map", """
SELECT gene, ortholog FROM (
  SELECT l_partkey AS gene, l_suppkey AS ortholog,
         row_number() OVER (PARTITION BY l_partkey ORDER BY l_linenumber, l_suppkey) AS rn
  FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part)
) WHERE rn = 1
""")
def q_ortholog_map(spark, sf):
    li, part = _t(spark, sf, "lineitem"), _t(spark, sf, "part")
    mapping = li.select(F.col("l_partkey").alias("gene"), F.col("l_suppkey").alias("ortholog"),
                        F.col("l_linenumber").alias("rank"))
    genes = part.select(F.col("p_partkey").alias("gene"))
    return normalize(gx.map_orthologs(genes, mapping))


# =========================================================================== D4/E1/B8
def _enrichment_sql(tg_cte: str, q_cte: str, prefix: str = "") -> str:
    return f"""
WITH {tg_cte},
bg AS (SELECT DISTINCT gene FROM tg),
{q_cte},
sizes AS (SELECT (SELECT count(*) FROM bg) AS bn, (SELECT count(*) FROM q) AS qn),
cnt AS (
  SELECT term_id, min(term_name) AS term_name, count(*) AS tk,
         count(*) FILTER (WHERE gene IN (SELECT gene FROM q)) AS hk
  FROM (SELECT DISTINCT term_id, term_name, gene FROM tg) GROUP BY term_id
),
t AS (SELECT cnt.*, bn, qn FROM cnt, sizes WHERE hk > 0),
terms AS (
  SELECT term_id, i,
         lgamma(tk + 1) - lgamma(i + 1) - lgamma(tk - i + 1)
       + lgamma(bn - tk + 1) - lgamma(qn - i + 1) - lgamma(bn - tk - qn + i + 1)
       - (lgamma(bn + 1) - lgamma(qn + 1) - lgamma(bn - qn + 1)) AS lt
  FROM t, generate_series(t.hk, least(t.qn, t.tk)) g(i)
),
pv AS (SELECT term_id, least(1.0, sum(exp(lt))) AS p FROM terms GROUP BY term_id),
m AS (SELECT count(*) AS m FROM t),
res AS (
  SELECT t.term_id, t.term_name, CAST(hk AS BIGINT) AS hits, CAST(tk AS BIGINT) AS term_size,
         CAST(qn AS BIGINT) AS query_size, CAST(bn AS BIGINT) AS background_size,
         coalesce(p, 0.0) AS p_value, least(1.0, coalesce(p, 0.0) * m) AS p_adjusted
  FROM t LEFT JOIN pv USING (term_id), m
)
SELECT term_id, term_name, hits, term_size, query_size, background_size,
       {R("p_value")} AS p_value, {R("p_adjusted")} AS p_adjusted,
       {R("CASE WHEN p_adjusted > 0 THEN -log10(p_adjusted) ELSE 0.0 END")} AS score,
       '{prefix}enrich_' || replace(coalesce(term_name, term_id, 'unknown'), ' ', '_') AS feature
FROM res ORDER BY p_adjusted, p_value, term_id LIMIT 10
"""


ENRICH_TG = ("tg AS (SELECT DISTINCT p_brand AS term_id, 'brand ' || substr(p_brand, 7) AS term_name, "
             "CAST(p_partkey AS VARCHAR) AS gene FROM part)")
ENRICH_Q = ("q AS (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS gene FROM lineitem GROUP BY l_partkey "
            "HAVING sum(l_quantity) > 800 AND CAST(l_partkey AS VARCHAR) IN (SELECT gene FROM bg))")


def _enrich_inputs(spark, sf):
    part, li = _t(spark, sf, "part"), _t(spark, sf, "lineitem")
    tg = part.select(F.col("p_brand").alias("term_id"),
                     F.concat(F.lit("brand "), F.substring("p_brand", 7, 1000)).alias("term_name"),
                     F.col("p_partkey").cast("string").alias("gene"))
    q = (li.groupBy("l_partkey").agg(F.sum("l_quantity").alias("q")).where("q > 800")
         .select(F.col("l_partkey").cast("string").alias("gene")))
    return tg, q


@query("enrichment", _enrichment_sql(ENRICH_TG, ENRICH_Q))
def q_enrichment(spark, sf):
    tg, q = _enrich_inputs(spark, sf)
    return normalize(gx.pathway_enrichment(q, tg, top=10))


ORTH_TG = ("tg AS (SELECT DISTINCT CAST(s.s_nationkey AS VARCHAR) AS term_id, n.n_name AS term_name, "
           "CAST(s.s_suppkey AS VARCHAR) AS gene FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey)")
ORTH_Q = """q0 AS (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS gene FROM lineitem GROUP BY l_partkey HAVING sum(l_quantity) > 800),
om AS (SELECT gene, ortholog FROM (
  SELECT CAST(l_partkey AS VARCHAR) AS gene, CAST(l_suppkey AS VARCHAR) AS ortholog,
         row_number() OVER (PARTITION BY l_partkey ORDER BY l_linenumber, CAST(l_suppkey AS VARCHAR)) AS rn
  FROM lineitem) WHERE rn = 1 AND gene IN (SELECT gene FROM q0)),
q AS (SELECT DISTINCT ortholog AS gene FROM om WHERE ortholog IN (SELECT gene FROM bg))"""


@query("enrichment_ortholog", _enrichment_sql(ORTH_TG, ORTH_Q, prefix="orth_"))
def q_enrichment_ortholog(spark, sf):
    _, q = _enrich_inputs(spark, sf)
    li, sup, nat = _t(spark, sf, "lineitem"), _t(spark, sf, "supplier"), _t(spark, sf, "nation")
    mapping = li.select(F.col("l_partkey").cast("string").alias("gene"),
                        F.col("l_suppkey").cast("string").alias("ortholog"), F.col("l_linenumber").alias("rank"))
    tg = sup.join(nat, sup.s_nationkey == nat.n_nationkey).select(
        F.col("s_nationkey").cast("string").alias("term_id"), F.col("n_name").alias("term_name"),
        F.col("s_suppkey").cast("string").alias("gene"))
    return normalize(gx.ortholog_enrichment(q, mapping, tg, top=10))


# =========================================================================== C5
@query("synthetic_edges", """
WITH g AS (SELECT DISTINCT p_name || '#' || CAST(p_partkey AS VARCHAR) AS g FROM part)
SELECT a.g AS src, b.g AS dst FROM g a JOIN g b ON a.g < b.g
WHERE (('0x' || substr(md5(a.g || b.g), 1, 8))::BIGINT) % 17 = 0
""")
def q_synthetic_edges(spark, sf):
    part = _t(spark, sf, "part")
    genes = part.select(F.concat(F.col("p_name"), F.lit("#"), F.col("p_partkey").cast("string")).alias("gene"))
    return gx.synthetic_edges(genes)


# =========================================================================== D3/E2/H11
@query("degree_centrality", f"""
WITH {tb.GRAPH_SQL.strip()}
SELECT gene, degree, {R("centrality")} AS centrality FROM cent
""")
def q_degree_centrality(spark, sf):
    nodes = tb.graph_nodes(spark, sf).select("gene")
    return normalize(gx.degree_centrality(nodes, tb.part_supplier_edges(spark, sf)))


@query("network_top_k", f"""
WITH {tb.GRAPH_SQL.strip()}
SELECT gene, degree, {R("centrality")} AS centrality FROM cent ORDER BY centrality DESC, gene LIMIT 50
""")
def q_network_top_k(spark, sf):
    nodes = tb.graph_nodes(spark, sf).select("gene")
    return normalize(gx.network_top_k(nodes, tb.part_supplier_edges(spark, sf), k=50))


@query("neighbour_propagate", f"""
WITH {tb.GRAPH_SQL.strip()},
arcs AS (SELECT src AS a, dst AS b FROM e UNION ALL SELECT dst, src FROM e),
dg AS (SELECT f.gene, CAST(coalesce(c.cnt, 0) + 1 AS DOUBLE) AS d
       FROM f LEFT JOIN (SELECT a, count(*) AS cnt FROM arcs GROUP BY a) c ON f.gene = c.a),
allarcs AS (SELECT a, b FROM arcs UNION ALL SELECT gene, gene FROM f)
SELECT aa.a AS gene, {R("sum((1.0 / sqrt(da.d * db.d)) * f.x)")} AS x
FROM allarcs aa JOIN dg da ON aa.a = da.gene JOIN dg db ON aa.b = db.gene JOIN f ON f.gene = aa.b
GROUP BY aa.a
""")
def q_neighbour_propagate(spark, sf):
    feats = tb.graph_nodes(spark, sf)
    return normalize(gx.neighbour_propagate(feats, tb.part_supplier_edges(spark, sf), cols=["x"]))


# =========================================================================== C7/E5
@query("literature_hits", r"""
WITH terms AS (
  SELECT DISTINCT t AS feature FROM (
    SELECT unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) AS t FROM benchmark)
  WHERE length(t) > 0
),
toks AS (
  SELECT doc_id, t AS token FROM (
    SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) AS t FROM documents)
  WHERE length(t) > 0
),
hits AS (SELECT token AS feature, doc_id, count(*) AS hits FROM toks WHERE token IN (SELECT feature FROM terms) GROUP BY token, doc_id),
r AS (SELECT feature, doc_id, hits, row_number() OVER (PARTITION BY feature ORDER BY hits DESC, doc_id) AS rank FROM hits)
SELECT feature, doc_id, CAST(hits AS BIGINT) AS hits, CAST(rank AS BIGINT) AS rank FROM r WHERE rank <= 3
""")
def q_literature_hits(spark, sf):
    bench, docs = _t(spark, sf, "benchmark"), _t(spark, sf, "documents")
    terms = (bench.select(F.explode(F.split(F.lower("text"), r"[^\p{L}\p{N}]+")).alias("feature"))
             .where("feature <> ''").distinct())
    return normalize(gx.literature_hits(terms, docs, k=3))


# =========================================================================== G1-G5, F2, G7
from ..functions.hashing import sql_seeded_hash  # noqa: E402
from ..operators import splits as sp  # noqa: E402

H_ORDER = sql_seeded_hash(42, "o_orderkey")


@query("stratified_split", f"""
WITH r AS (SELECT o_orderkey, o_orderstatus,
                  row_number() OVER (PARTITION BY o_orderstatus ORDER BY {H_ORDER}, o_orderkey) AS rk,
                  count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders),
c AS (SELECT *, floor(n * 0.2 + 0.5) AS nt FROM r),
d AS (SELECT *, floor((n - nt) * 0.25 + 0.5) AS nv FROM c)
SELECT o_orderkey, o_orderstatus,
       CASE WHEN rk <= nt THEN 'test' WHEN rk <= nt + nv THEN 'val' ELSE 'train' END AS split
FROM d
""")
def q_stratified_split(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return sp.stratified_split(o, "o_orderstatus", "o_orderkey", test=0.2, val=0.2, seed=42)


@query("random_split", f"""
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY {H_ORDER}, o_orderkey) AS rk,
                  count(*) OVER () AS n FROM orders),
c AS (SELECT *, floor(n * 0.2 + 0.5) AS nt FROM r)
SELECT o_orderkey, CASE WHEN rk <= nt THEN 'test' ELSE 'train' END AS split FROM c
""")
def q_random_split(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey")
    return sp.random_split(o, "o_orderkey", test=0.2, seed=42)


@query("stratified_folds", f"""
SELECT o_orderkey, o_orderstatus,
       CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY {H_ORDER}, o_orderkey) - 1) % 5 AS BIGINT) AS fold
FROM orders
""")
def q_stratified_folds(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return normalize(sp.stratified_folds(o, "o_orderstatus", "o_orderkey", k=5, seed=42))


@query("ordered_folds", """
WITH c AS (SELECT o_orderstatus, count(*) AS n, min(o_orderkey) AS first FROM orders GROUP BY 1),
a AS (SELECT o_orderstatus, n, coalesce(sum(n) OVER (ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at_ FROM c),
f AS (SELECT o_orderstatus, p % 5 AS fold, count(*) AS held FROM a, generate_series(CAST(at_ AS BIGINT), CAST(at_ + n - 1 AS BIGINT)) g(p) GROUP BY 1, 2),
u AS (SELECT o_orderstatus, fold, sum(held) OVER (PARTITION BY o_orderstatus ORDER BY fold) AS upto FROM f),
r AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS rk FROM orders)
SELECT o_orderkey, r.o_orderstatus, CAST(min(u.fold) AS BIGINT) AS fold
FROM r JOIN u ON r.o_orderstatus = u.o_orderstatus AND r.rk < u.upto GROUP BY 1, 2
""")
def q_ordered_folds(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return normalize(sp.ordered_folds(o, "o_orderstatus", "o_orderkey", k=5))


@query("sample_n", f"""
SELECT o_orderkey, o_custkey FROM orders ORDER BY {H_ORDER}, o_orderkey LIMIT 200
""")
def q_sample_n(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return sp.sample_n(o, 200, "o_orderkey", seed=42)


@query("random_oversample", f"""
WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY quality),
mx AS (SELECT max(n) AS nmax FROM c),
r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {sql_seeded_hash(42, "doc_id")}, doc_id) AS rk
      FROM labels)
SELECT doc_id, CAST(quality AS BIGINT) AS quality,
       CAST(unnest(generate_series(1, nmax // n + CASE WHEN rk <= nmax % n THEN 1 ELSE 0 END)) AS BIGINT) AS copy
FROM r JOIN c USING (quality), mx
""")
def q_random_oversample(spark, sf):
    lab = _t(spark, sf, "labels").select("doc_id", "quality")
    return normalize(bal.random_oversample(lab, "quality", "doc_id", seed=42))


def _poisson_case(u: str) -> str:
    import math
    cdf, acc = [], 0.0
    for j in range(12):
        acc += math.exp(-1.0) / math.factorial(j)
        cdf.append(acc)
    return " + ".join(f"CASE WHEN {u} >= {c!r} THEN 1 ELSE 0 END" for c in cdf)


@query("bootstrap_metric", f"""
WITH {tb.DOC_SCORES_SQL.strip()},
x AS (SELECT doc_id, CAST(pred = quality AS DOUBLE) AS v FROM ds),
b AS (SELECT doc_id, v, b FROM x, range(1, 501) g(b)),
u AS (SELECT b, v, CAST({sql_seeded_hash(42, "doc_id", "b")} AS DOUBLE) / CAST(1152921504606846976 AS DOUBLE) AS u FROM b),
w AS (SELECT b, v, CAST({_poisson_case("u")} AS DOUBLE) AS w FROM u),
s AS (SELECT b, sum(w * v) / sum(w) AS st FROM w GROUP BY b)
SELECT {R("(SELECT avg(v) FROM x)")} AS estimate, {R("quantile_cont(st, 0.025)")} AS lower,
       {R("quantile_cont(st, 0.975)")} AS upper, CAST(500 AS BIGINT) AS replicates FROM s
""")
def q_bootstrap_metric(spark, sf):
    ds = tb.doc_scores(spark, sf).select("doc_id", (F.col("pred") == F.col("quality")).cast("double").alias("v"))
    return normalize(sp.bootstrap_metric(ds, "v", "doc_id", replicates=500, seed=42))


# =========================================================================== I1-I5
from ..operators import metrics as mx  # noqa: E402


def _doc_long(spark, sf):
    ds = tb.doc_scores(spark, sf)
    return (ds.select(F.col("doc_id").alias("key"), F.col("quality").alias("label"), F.lit(0).alias("class"),
                      (F.lit(1.0) - F.col("p1")).alias("score"))
            .unionByName(ds.select(F.col("doc_id").alias("key"), F.col("quality").alias("label"),
                                   F.lit(1).alias("class"), F.col("p1").alias("score"))))


DOC_LONG_SQL = tb.DOC_SCORES_SQL.strip() + """,
lf AS (SELECT doc_id AS key, quality AS label, 0 AS class, 1.0 - p1 AS score FROM ds
       UNION ALL SELECT doc_id, quality, 1, p1 FROM ds)"""

EMB_LONG_SQL = """
u AS (SELECT vec_id AS key, label, CAST(i - 1 AS BIGINT) AS class, exp(CAST(embedding[i] AS DOUBLE)) AS ex
      FROM embeddings, range(1, 11) t(i)),
lf AS (SELECT key, label, class, ex / sum(ex) OVER (PARTITION BY key) AS score FROM u)"""


def _emb_long(spark, sf):
    e = _t(spark, sf, "embeddings")
    ex = F.transform(F.slice("embedding", 1, 10), lambda v: F.exp(v.cast("double")))
    x = e.select(F.col("vec_id").alias("key"), F.col("label"), ex.alias("_ex"))
    x = x.select("key", "label", "_ex", F.aggregate("_ex", F.lit(0.0), lambda a, v: a + v).alias("_z"))
    return x.select("key", "label", F.posexplode("_ex").alias("class", "_e"), "_z").select(
        "key", "label", F.col("class").cast("long"), (F.col("_e") / F.col("_z")).alias("score"))


AUROC_SQL = """
SELECT CAST(a.class AS BIGINT) AS class,
       round(sum(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END) / count(*), 6) + 0.0 AS auroc
FROM lf a JOIN lf b ON a.class = b.class AND a.label = a.class AND b.label <> b.class
GROUP BY a.class"""

AUPRC_SQL = """
g AS (SELECT class, score, sum(CASE WHEN label = class THEN 1 ELSE 0 END) AS pos,
             sum(CASE WHEN label <> class THEN 1 ELSE 0 END) AS neg FROM lf GROUP BY class, score),
c AS (SELECT *, sum(pos) OVER (PARTITION BY class ORDER BY score DESC) AS cp,
             sum(neg) OVER (PARTITION BY class ORDER BY score DESC) AS cn,
             sum(pos) OVER (PARTITION BY class) AS tp FROM g),
ap AS (SELECT class, sum(pos * cp / (cp + cn)) / max(tp) AS auprc FROM c GROUP BY class)"""


@query("auroc", f"WITH {DOC_LONG_SQL}\n{AUROC_SQL}")
def q_auroc(spark, sf):
    return normalize(mx.auroc_per_class(_doc_long(spark, sf)))


@query("auprc", f"WITH {DOC_LONG_SQL},\n{AUPRC_SQL.strip()}\nSELECT CAST(class AS BIGINT) AS class, {R('auprc')} AS auprc FROM ap")
def q_auprc(spark, sf):
    return normalize(mx.average_precision_per_class(_doc_long(spark, sf)))


@query("auroc_multiclass", f"WITH {EMB_LONG_SQL.strip()}\n{AUROC_SQL}")
def q_auroc_multiclass(spark, sf):
    return normalize(mx.auroc_per_class(_emb_long(spark, sf)))


def _metrics_sql(long_sql: str, acc_sql: str) -> str:
    return f"""
WITH {long_sql.strip()},
{AUPRC_SQL.strip()},
au AS ({AUROC_SQL.replace("round(", "(").replace(", 6) + 0.0 AS auroc", ") AS auroc")}),
br AS (SELECT sum((score - CASE WHEN label = class THEN 1.0 ELSE 0.0 END) ^ 2) / (count(*) / count(DISTINCT class)) AS brier FROM lf)
SELECT 'auroc' AS metric, {R("avg(auroc)")} AS value FROM au
UNION ALL SELECT 'auprc', {R("avg(auprc)")} FROM ap
UNION ALL SELECT 'accuracy', {R(acc_sql)}
UNION ALL SELECT 'brier', {R("brier")} FROM br
"""


@query("classification_metrics", _metrics_sql(DOC_LONG_SQL, "(SELECT avg(CAST(pred = quality AS DOUBLE)) FROM ds)"))
def q_classification_metrics(spark, sf):
    ds = tb.doc_scores(spark, sf)
    return normalize(mx.classification_metrics(_doc_long(spark, sf), ds, label="quality", prediction="pred"))


@query("classification_metrics_multiclass", _metrics_sql(
    EMB_LONG_SQL, "(SELECT avg(CAST(label = pc AS DOUBLE)) FROM (SELECT key, any_value(label) AS label, "
                  "arg_max(class, score) AS pc FROM lf GROUP BY key))"))
def q_classification_metrics_multiclass(spark, sf):
    return normalize(mx.classification_metrics(_emb_long(spark, sf)))


# =========================================================================== I8, I6, I7, F9
from ..operators import survival as sv  # noqa: E402

KM_SQL = """
g AS (SELECT {by}duration AS time, count(*) AS n, sum(event) AS d FROM surv GROUP BY {by}duration),
r AS (SELECT *, sum(n) OVER ({part}ORDER BY time DESC) AS at_risk FROM g),
km AS (SELECT {by}time, at_risk, d, n - d AS c,
   CASE WHEN sum(CASE WHEN d >= at_risk AND d > 0 THEN 1 ELSE 0 END) OVER ({part}ORDER BY time) > 0 THEN 0.0
        ELSE exp(sum(CASE WHEN d < at_risk THEN ln(1.0 - d / at_risk) ELSE 0.0 END) OVER ({part}ORDER BY time)) END AS s,
   CASE WHEN sum(CASE WHEN n - d >= at_risk - d AND n - d > 0 THEN 1 ELSE 0 END) OVER ({part}ORDER BY time) > 0 THEN 0.0
        ELSE exp(sum(CASE WHEN n - d < at_risk - d THEN ln(1.0 - (n - d) / (at_risk - d)) ELSE 0.0 END) OVER ({part}ORDER BY time)) END AS gs
 FROM r)"""


@query("kaplan_meier", f"""
WITH {tb.SURV_SQL.strip()},
{KM_SQL.format(by="", part="").strip()}
SELECT {R("time")} AS time, CAST(at_risk AS BIGINT) AS at_risk, CAST(d AS BIGINT) AS events,
       CAST(c AS BIGINT) AS censored, {R("s")} AS survival FROM km
""")
def q_kaplan_meier(spark, sf):
    s = tb.surv(spark, sf)
    return normalize(sv.kaplan_meier(s, "duration", "event"))


@query("km_by_group", f"""
WITH {tb.SURV_SQL.strip().replace("FROM events GROUP BY user_id", "FROM events GROUP BY user_id")},
surv2 AS (SELECT user_id % 3 AS grp, * FROM surv),
{KM_SQL.format(by="grp, ", part="PARTITION BY grp ").replace("FROM surv GROUP BY", "FROM surv2 GROUP BY").strip()}
SELECT CAST(grp AS BIGINT) AS grp, {R("time")} AS time, CAST(at_risk AS BIGINT) AS at_risk, CAST(d AS BIGINT) AS events,
       CAST(c AS BIGINT) AS censored, {R("s")} AS survival FROM km
""")
def q_km_by_group(spark, sf):
    s = tb.surv(spark, sf).withColumn("grp", F.col("user_id") % 3)
    return normalize(sv.kaplan_meier(s, "duration", "event", by=["grp"]))


@query("concordance", f"""
WITH {tb.SURV_SQL.strip()},
p AS (SELECT a.mean_value AS ri, b.mean_value AS rj FROM surv a JOIN surv b
      ON a.event = 1 AND (b.duration > a.duration OR (b.duration = a.duration AND b.event = 0)))
SELECT {R("sum(CASE WHEN rj < ri THEN 1 ELSE 0 END)")} AS concordant,
       {R("sum(CASE WHEN rj = ri THEN 1 ELSE 0 END)")} AS tied_risk,
       {R("count(*)")} AS comparable,
       {R("(sum(CASE WHEN rj < ri THEN 1.0 ELSE 0.0 END) + 0.5 * sum(CASE WHEN rj = ri THEN 1.0 ELSE 0.0 END)) / count(*)")} AS c_index
FROM p
""")
def q_concordance(spark, sf):
    s = tb.surv(spark, sf)
    return normalize(sv.concordance_index(s, "duration", "event", "mean_value"))


@query("integrated_brier", f"""
WITH {tb.SURV_SQL.strip()},
{KM_SQL.format(by="", part="").strip()},
tl AS (SELECT quantile_cont(duration, [0.1, 0.3, 0.5, 0.7, 0.9]) AS qs FROM surv),
tv AS (SELECT unnest(qs) AS tau, unnest(range(0, 5)) AS k FROM tl),
sk AS (SELECT tau, k,
         coalesce((SELECT s FROM km WHERE km.time <= tau ORDER BY km.time DESC LIMIT 1), 1.0) AS s_tau,
         coalesce((SELECT gs FROM km WHERE km.time <= tau ORDER BY km.time DESC LIMIT 1), 1.0) AS g_tau FROM tv),
obs AS (SELECT surv.duration AS tt, surv.event AS ee, km.gs AS gt FROM surv JOIN km ON surv.duration = km.time),
bs AS (SELECT tau, k,
         avg(CASE WHEN tt <= tau AND ee = 1 AND gt > 0 THEN s_tau * s_tau / gt ELSE 0.0 END
           + CASE WHEN tt > tau AND g_tau > 0 THEN (1 - s_tau) * (1 - s_tau) / g_tau ELSE 0.0 END) AS brier
       FROM obs, sk GROUP BY tau, k)
SELECT {R("tau")} AS time, {R("brier")} AS brier, CAST(NULL AS DOUBLE) AS integrated_brier FROM bs
UNION ALL
SELECT NULL, NULL, {R("sum((b1.brier + b2.brier) / 2 * (b2.tau - b1.tau)) / (max(b2.tau) - min(b1.tau))")}
FROM bs b1 JOIN bs b2 ON b2.k = b1.k + 1
""")
def q_integrated_brier(spark, sf):
    s = tb.surv(spark, sf)
    taus = sv.duration_percentiles(s, "duration")
    km = sv.kaplan_meier(s, "duration", "event")
    st = {round(r["t"], 12): r["survival"] for r in sv.survival_at(km, taus).collect()}
    pred = s.select("duration", "event", *[F.lit(float(st[round(t, 12)])).alias(f"s{k}") for k, t in enumerate(taus)])
    return normalize(sv.integrated_brier(pred, "duration", "event", taus, [f"s{k}" for k in range(len(taus))]))


@query("duration_percentiles", f"""
WITH {tb.SURV_SQL.strip()},
tl AS (SELECT quantile_cont(duration, [0.1, 0.3, 0.5, 0.7, 0.9]) AS qs FROM surv)
SELECT {R("unnest([0.1, 0.3, 0.5, 0.7, 0.9])")} AS q, {R("unnest(qs)")} AS value FROM tl
""")
def q_duration_percentiles(spark, sf):
    from ..functions.ordered import exact_quantiles
    return normalize(exact_quantiles(tb.surv(spark, sf), "duration", [0.1, 0.3, 0.5, 0.7, 0.9]))


@query("counts_to_survival", """
WITH d0 AS (SELECT min(CAST(ts AS DATE)) AS d0 FROM events),
d AS (SELECT user_id, date_diff('day', (SELECT d0 FROM d0), CAST(ts AS DATE)) AS day, count(*) AS cnt
      FROM events GROUP BY user_id, day),
pk AS (SELECT user_id, max(cnt) AS peak FROM d GROUP BY user_id),
pt AS (SELECT d.user_id, min(day) AS pday, max(peak) AS peak FROM d JOIN pk ON d.user_id = pk.user_id AND d.cnt = pk.peak
       GROUP BY d.user_id),
dr AS (SELECT d.user_id, min(day) AS dday FROM d JOIN pt ON d.user_id = pt.user_id
       WHERE day > pday AND cnt < peak * 0.5 GROUP BY d.user_id),
la AS (SELECT user_id, max(day) AS lday FROM d GROUP BY user_id)
SELECT la.user_id, CAST(coalesce(dday, lday) AS BIGINT) AS duration,
       CAST(CASE WHEN dday IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS event
FROM la LEFT JOIN dr ON la.user_id = dr.user_id
""")
def q_counts_to_survival(spark, sf):
    ev = _t(spark, sf, "events")
    d0 = ev.agg(F.min(F.to_date("ts")).alias("_d0"))
    daily = (ev.crossJoin(F.broadcast(d0))
             .groupBy("user_id", F.datediff(F.to_date("ts"), F.col("_d0")).alias("day"))
             .agg(F.count(F.lit(1)).alias("cnt")))
    return normalize(fx.counts_to_survival(daily, "user_id", "day", "cnt"))


# =========================================================================== K3
from ..operators import fairness as fa  # noqa: E402


@query("fairness_audit", f"""
WITH {tb.DOC_SCORES_SQL.strip()},
pv AS (SELECT lang FROM ds GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1),
a AS (SELECT CASE WHEN lang = (SELECT lang FROM pv) THEN 'p' ELSE 'u' END AS side, toxic AS y, quality AS yh FROM ds),
s AS (SELECT side, CAST(sum(yh) AS DOUBLE) / count(*) AS ppr,
        CAST(sum(CASE WHEN y = 1 AND yh = 1 THEN 1 ELSE 0 END) AS DOUBLE) / nullif(sum(CASE WHEN y = 1 THEN 1 ELSE 0 END), 0) AS tpr,
        CAST(sum(CASE WHEN y = 0 AND yh = 1 THEN 1 ELSE 0 END) AS DOUBLE) / nullif(sum(CASE WHEN y = 0 THEN 1 ELSE 0 END), 0) AS fpr
      FROM a GROUP BY side),
u AS (SELECT * FROM s WHERE side = 'u'), p AS (SELECT * FROM s WHERE side = 'p')
SELECT 'demographic_parity_difference' AS metric, {R("u.ppr - p.ppr")} AS value FROM u, p
UNION ALL SELECT 'equal_opportunity_difference', {R("u.tpr - p.tpr")} FROM u, p
UNION ALL SELECT 'average_odds_difference', {R("((u.fpr - p.fpr) + (u.tpr - p.tpr)) / 2")} FROM u, p
""")
def q_fairness_audit(spark, sf):
    ds = tb.doc_scores(spark, sf)
    return normalize(fa.fairness_audit(ds, "lang", "toxic", "quality"))


# =========================================================================== K2
from ..operators import causal as ca  # noqa: E402

ATE_BASE_SQL = """
x AS (SELECT CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1.0 ELSE 0.0 END AS t,
             o.o_totalprice AS y, c.c_acctbal AS c
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""


def _ate_frame(spark, sf):
    o, c = _t(spark, sf, "orders"), _t(spark, sf, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1.0).otherwise(0.0).alias("t"),
        F.col("o_totalprice").alias("y"), F.col("c_acctbal").alias("c"))


@query("ate_regression", f"""
WITH {ATE_BASE_SQL.strip()},
m AS (SELECT covar_pop(t, t) AS tt, covar_pop(c, c) AS cc, covar_pop(t, c) AS tc,
             covar_pop(t, y) AS ty, covar_pop(c, y) AS cy FROM x)
SELECT 'backdoor.linear_regression' AS method, {R("(ty * cc - cy * tc) / (tt * cc - tc * tc)")} AS ate FROM m
""")
def q_ate_regression(spark, sf):
    return normalize(ca.treatment_effect(_ate_frame(spark, sf), "t", "y", ["c"]))


@query("ate_simple", f"""
WITH {ATE_BASE_SQL.strip()}
SELECT 'backdoor.linear_regression' AS method, {R("regr_slope(y, t)")} AS ate FROM x
""")
def q_ate_simple(spark, sf):
    return normalize(ca.treatment_effect(_ate_frame(spark, sf), "t", "y", []))


def _ipw_sql(steps: int = 8) -> str:
    """Newton steps of the two-parameter logistic regression of t on the
    standardised c, then the normalised weights."""
    ctes = ["z AS (SELECT t, y, (c - avg(c) OVER ()) / stddev_pop(c) OVER () AS c FROM x)",
            "b0 AS (SELECT ln(avg(t) / (1 - avg(t))) AS a, CAST(0 AS DOUBLE) AS b FROM z)"]
    for i in range(steps):
        ctes.append(f"""h{i} AS (SELECT any_value(a) AS a, any_value(b) AS b, sum(t - p) AS g0, sum((t - p) * c) AS g1,
             sum(p * (1 - p)) AS h00, sum(p * (1 - p) * c) AS h01, sum(p * (1 - p) * c * c) AS h11
      FROM (SELECT t, c, a, b, 1 / (1 + exp(-(a + b * c))) AS p FROM z, b{i}))""")
        ctes.append(f"""b{i + 1} AS (SELECT a + (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01) AS a,
             b + (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01) AS b FROM h{i})""")
    body = ",\n".join(ctes)
    return f"""
WITH {ATE_BASE_SQL.strip()},
{body},
w AS (SELECT t, y, 1 / (1 + exp(-(a + b * c))) AS p FROM z, b{steps})
SELECT 'backdoor.propensity_score_weighting' AS method,
       round(sum(t * y / p) / sum(t / p) - sum((1 - t) * y / (1 - p)) / sum((1 - t) / (1 - p)), 2) + 0.0 AS ate FROM w
"""


@query("ate_ipw", _ipw_sql())
def q_ate_ipw(spark, sf):
    # an iterative fit agrees with another to its tolerance: two digits of a price
    out = ca.treatment_effect(_ate_frame(spark, sf), "t", "y", ["c"], method="backdoor.propensity_score_weighting")
    return out.select("method", (F.round("ate", 2) + 0.0).alias("ate"))


@query("ate_stratified")
def q_ate_stratified(spark, sf):
    return normalize(ca.treatment_effect(_ate_frame(spark, sf), "t", "y", ["c"],
                                         method="backdoor.propensity_score_stratification"))


# =========================================================================== H6-H8 (rows-only)
@query("cox_fit")
def q_cox_fit(spark, sf):
    s = tb.surv(spark, sf)
    m = sv.cox_fit(s, "duration", "event", ["mean_value", "n_events"])
    return normalize(m.coefficients(spark))


@query("aft_fit")
def q_aft_fit(spark, sf):
    s = tb.surv(spark, sf)
    _, coef = sv.aft_fit(s, "duration", "event", ["mean_value", "n_events"], offset=1.0)
    return normalize(coef)


@query("discrete_time_forest")
def q_discrete_time_forest(spark, sf):
    s = tb.surv(spark, sf)
    taus = sv.duration_percentiles(s, "duration")
    m = sv.discrete_time_forest(s, "duration", "event", ["mean_value", "n_events"], "user_id")
    return normalize(m.survival(s.select("user_id", "mean_value", "n_events"), "user_id", taus))


# =========================================================================== A6, A7, item 16
from ..operators import expression as ex  # noqa: E402


SAMPLES = ["AF", "AO", "NF", "NO", "RF", "RO"]


def _pivot_cols() -> str:
    cols = []
    for x in SAMPLES:
        cols.append(R("max(CASE WHEN sample = '" + x + "' THEN value END)") + f" AS {x}_value")
    return ",\n       ".join(cols)


@query("assemble_expression", f"""
WITH l AS (SELECT l_partkey AS gene, l_returnflag || l_linestatus AS sample, avg(l_quantity) AS value
           FROM lineitem GROUP BY l_partkey, l_returnflag || l_linestatus)
SELECT gene, {_pivot_cols()}
FROM l GROUP BY gene HAVING count(DISTINCT sample) = 6
""")
def q_assemble_expression(spark, sf):
    """Samples = return flag x line status (6); genes = parts; parts missing a
    sample are dropped by the inner alignment (a few at every scale)."""
    li = _t(spark, sf, "lineitem")
    long = li.groupBy(F.col("l_partkey").alias("gene"),
                      F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("sample")) \
        .agg(F.avg("l_quantity").alias("value"))
    return normalize(ex.assemble_expression(long))


def _characteristics(spark, sf):
    d = _t(spark, sf, "documents")
    return d.select(F.col("doc_id").alias("gsm"), F.array(
        F.concat(F.lit("Lang: "), F.col("lang")),
        F.concat(F.lit("source = "), F.col("source")),
        F.concat(F.lit("n chars:"), F.col("n_chars").cast("string")),
        F.lit("free text without separator"),
        F.concat(F.lit("LANG :"), F.upper(F.col("lang")))).alias("characteristics"))


@query("parse_characteristics", """
SELECT doc_id AS gsm, upper(lang) AS lang, CAST(n_chars AS VARCHAR) AS n_chars, source FROM documents
""")
def q_parse_characteristics(spark, sf):
    return normalize(ex.parse_characteristics(_characteristics(spark, sf)))


@query("join_expression_metadata", f"""
WITH l AS (SELECT o.o_custkey AS sample, li.l_partkey AS gene, sum(li.l_quantity) AS value
           FROM lineitem li JOIN orders o ON li.l_orderkey = o.o_orderkey GROUP BY o.o_custkey, li.l_partkey)
SELECT sample, gene, {R("value")} AS value, c_mktsegment, CAST(c_nationkey AS BIGINT) AS c_nationkey
FROM l JOIN customer ON l.sample = customer.c_custkey
""")
def q_join_expression_metadata(spark, sf):
    li, o, c = _t(spark, sf, "lineitem"), _t(spark, sf, "orders"), _t(spark, sf, "customer")
    long = (li.join(o, li.l_orderkey == o.o_orderkey)
            .groupBy(F.col("o_custkey").alias("sample"), F.col("l_partkey").alias("gene"))
            .agg(F.sum("l_quantity").alias("value")))
    meta = c.select(F.col("c_custkey").alias("gsm"), "c_mktsegment", "c_nationkey")
    return normalize(ex.join_expression_metadata(long, meta))


# =========================================================================== H1-H10, I9 (rows-only)
from ..operators import models as md  # noqa: E402

EMB = [f"e{i}" for i in range(64)]


def _train(spark, sf, which, name, params=None, use_weights=False):
    if which == "emb":
        df, key, label, feats = tb.embedding_features(spark, sf), "vec_id", "label", EMB
    else:
        df, key, label, feats = tb.doc_features(spark, sf), "doc_id", "quality", tb.DOC_FEATURES
    _, metrics = md.train_and_evaluate(df, key, label, feats, name=name, params=params,
                                       use_class_weights=use_weights, seed=42)
    return normalize(metrics)


@query("train_logreg")
def q_train_logreg(spark, sf):
    return _train(spark, sf, "emb", "logreg")


@query("train_rf")
def q_train_rf(spark, sf):
    return _train(spark, sf, "emb", "rf")


@query("train_gbt")
def q_train_gbt(spark, sf):
    return _train(spark, sf, "doc", "xgb")


@query("balanced_forest")
def q_balanced_forest(spark, sf):
    return _train(spark, sf, "doc", "balanced_rf")


@query("cost_sensitive")
def q_cost_sensitive(spark, sf):
    return _train(spark, sf, "doc", "cost_sensitive_logreg")


@query("elastic_net")
def q_elastic_net(spark, sf):
    return _train(spark, sf, "emb", "elastic_net", {"regParam": 0.01})


@query("svm")
def q_svm(spark, sf):
    return _train(spark, sf, "doc", "svm")


@query("mlp")
def q_mlp(spark, sf):
    return _train(spark, sf, "emb", "mlp", {"maxIter": 100})


# =========================================================================== J1, J3-J5 (rows-only)
from ..operators import selection as sel  # noqa: E402


@query("rfe_cv")
def q_rfe_cv(spark, sf):
    df = tb.doc_features(spark, sf)
    return sel.rfe_cv(df, tb.DOC_FEATURES, "quality", "doc_id", "logreg", step=1)


@query("search")
def q_search(spark, sf):
    df = tb.doc_features(spark, sf)
    return normalize(sel.search(df, tb.DOC_FEATURES, "quality", "doc_id", "logreg",
                                {"regParam": [0.001, 0.01, 0.1], "elasticNetParam": [0.0, 0.5]}))


@query("nested_cv")
def q_nested_cv(spark, sf):
    df = tb.doc_features(spark, sf)
    return normalize(sel.nested_cv(df, tb.DOC_FEATURES, "quality", "doc_id", "logreg",
                                   {"regParam": [0.001, 0.1]}))


# =========================================================================== K1, D5, D6, E3
from ..operators import explain as xp  # noqa: E402

GROUPS_SQL = """
groups AS (
  SELECT 'g' || CAST(i // 8 AS VARCHAR) AS grp, 'e' || CAST(i AS VARCHAR) AS feature FROM range(0, 64) t(i)
  UNION ALL SELECT 'head', 'e' || CAST(i AS VARCHAR) FROM range(0, 16) t(i)
  UNION ALL SELECT 'absent', 'zz'
)"""


def _emb_shap_long(spark, sf):
    e = _t(spark, sf, "embeddings")
    return e.select(F.col("vec_id").alias("row_key"), F.col("label").alias("class"),
                    F.posexplode(F.slice("embedding", 1, 64)).alias("_i", "_v")).select(
        "row_key", "class", F.concat(F.lit("e"), F.col("_i").cast("string")).alias("feature"),
        F.col("_v").cast("double").alias("value"))


def _groups(spark):
    rows = [(f"g{i // 8}", f"e{i}") for i in range(64)] + [("head", f"e{i}") for i in range(16)] + [("absent", "zz")]
    return spark.createDataFrame(rows, "group string, feature string")


EMB_SHAP_SQL = """
sl AS (SELECT vec_id AS row_key, 'e' || CAST(i - 1 AS VARCHAR) AS feature, CAST(embedding[i] AS DOUBLE) AS value
       FROM embeddings, range(1, 65) t(i)),
fi AS (SELECT feature, avg(a) AS importance FROM (SELECT row_key, feature, avg(abs(value)) AS a FROM sl GROUP BY row_key, feature) GROUP BY feature)"""


@query("feature_importance", f"""
WITH {EMB_SHAP_SQL.strip()}
SELECT feature, {R("importance")} AS importance FROM fi
""")
def q_feature_importance(spark, sf):
    return normalize(xp.feature_importance(_emb_shap_long(spark, sf)))


@query("group_importance", f"""
WITH {EMB_SHAP_SQL.strip()},
{GROUPS_SQL.strip()}
SELECT grp AS "group", {R("avg(importance)")} AS importance FROM fi JOIN groups USING (feature) GROUP BY grp
""")
def q_group_importance(spark, sf):
    imp = xp.feature_importance(_emb_shap_long(spark, sf))
    return normalize(xp.group_importance(imp, _groups(spark)))


@query("shapley_linear")
def q_shapley_linear(spark, sf):
    from ..session import cut_lineage
    df = cut_lineage(tb.doc_features(spark, sf))  # whole-text statistics computed once
    model = md.fit_classifier(df, tb.DOC_FEATURES, "quality", "logreg")
    return normalize(xp.feature_importance(xp.shapley_linear(model, df, "doc_id", tb.DOC_FEATURES)))


@query("shapley_sampled")
def q_shapley_sampled(spark, sf):
    from ..session import cut_lineage
    df = cut_lineage(tb.doc_features(spark, sf))  # whole-text statistics computed once
    model = md.fit_classifier(df, tb.DOC_FEATURES, "quality", "logreg")
    rows = sp.sample_n(df, 200, "doc_id", seed=42)
    bg = sp.sample_n(df, 50, "doc_id", seed=7)
    sh = xp.shapley_sampled(model, rows, bg, "doc_id", tb.DOC_FEATURES)
    return normalize(xp.feature_importance(sh))


# =========================================================================== F1, F3-F6 (rows-only)
from ..operators import transforms as tf  # noqa: E402

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("smote")
def q_smote(spark, sf):
    df = tb.embedding_features(spark, sf)
    out = bal.smote(df, "label", EMB, "vec_id", k=5, seed=42)
    return normalize(out.groupBy("label", "synthetic").agg(F.count(F.lit(1)).alias("n"),
                                                            *[F.avg(f"e{i}").alias(f"mean_e{i}") for i in range(64)]))


@query("combat")
def q_combat(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", *LI_NUM)
    out = tf.combat(li, "l_returnflag", LI_NUM)
    return normalize(out.groupBy("l_returnflag").agg(*[F.avg(c).alias(f"mean_{c}") for c in LI_NUM],
                                                     *[F.stddev_samp(c).alias(f"sd_{c}") for c in LI_NUM]))


@query("yeo_johnson")
def q_yeo_johnson(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LI_NUM)
    out = tf.yeo_johnson(li, LI_NUM)
    return normalize(out.select("l_orderkey", "l_linenumber", *LI_NUM))


@query("iterative_impute")
def q_iterative_impute(spark, sf):
    li = _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.when(F.col("l_orderkey") % 7 == 0, None).otherwise(F.col("l_extendedprice")).alias("l_extendedprice"),
        F.when(F.col("l_linenumber") == 3, None).otherwise(F.col("l_discount")).alias("l_discount"), "l_tax")
    out = tf.iterative_impute(li, LI_NUM)
    return normalize(out)


@query("pca_scores")
def q_pca_scores(spark, sf):
    df = tb.embedding_features(spark, sf)
    out = tf.pca_scores(df, EMB, k=50)
    return normalize(out.select("vec_id", *[f"pca_{i}" for i in range(1, 51)]))


# =========================================================================== B6, B10, F8, L1
@query("gene_list", """
SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS gene FROM lineitem
""")
def q_gene_list(spark, sf):
    li = _t(spark, sf, "lineitem").select(F.col("l_partkey").alias("gene"))
    return fx.gene_list(li)


_ENRICH_INNER = _enrichment_sql(ENRICH_TG, ENRICH_Q).strip()


@query("broadcast_features", f"""
SELECT p.p_partkey, pv.* FROM part p,
  (PIVOT (SELECT feature, score FROM ({_ENRICH_INNER})) ON feature USING first(score)) pv
""")
def q_broadcast_features(spark, sf):
    tg, q = _enrich_inputs(spark, sf)
    top = normalize(gx.pathway_enrichment(q, tg, top=10)).select("feature", "score")
    return normalize(fx.broadcast_features(_t(spark, sf, "part").select("p_partkey"), top))


@query("attach_gene_features", f"""
WITH {tb.GRAPH_SQL.strip()}
SELECT 'p' || CAST(li.l_partkey AS VARCHAR) AS gene, li.l_orderkey, CAST(li.l_linenumber AS BIGINT) AS l_linenumber,
       {R("c.centrality")} AS centrality
FROM lineitem li LEFT JOIN cent c ON c.gene = 'p' || CAST(li.l_partkey AS VARCHAR)
""")
def q_attach_gene_features(spark, sf):
    from ..operators import transforms as tf2
    li = _t(spark, sf, "lineitem").select(
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("gene"), "l_orderkey", "l_linenumber")
    cent = gx.degree_centrality(tb.graph_nodes(spark, sf).select("gene"), tb.part_supplier_edges(spark, sf))
    return normalize(tf2.attach_gene_features(li, {"centrality": cent.select("gene", F.col("centrality").alias("score"))}))


@query("pipeline_run")
def q_pipeline_run(spark, sf):
    from . import pipeline as pl
    df = tb.doc_features(spark, sf).drop("lang", "toxic")
    config = {"seed": 42, "task": {"target": "quality", "data_type": "csv", "problem_type": "classification",
                                   "preprocessing": {"variance_stabilization": True}},
              "split": {"test_size": 0.2, "val_size": 0.2}, "model": {"name": "rf"}}
    return normalize(pl.run(spark, config, df=df, key="doc_id"))


@query("combat_summary", f"""
WITH u AS (SELECT l_returnflag AS batch, f.feature, f.x FROM lineitem,
             (SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) AS feature,
                     unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS x) f),
pb AS (SELECT batch, feature, count(*) AS n, avg(x) AS m, var_samp(x) AS v FROM u GROUP BY batch, feature),
pf AS (SELECT feature, sum(n * m) / sum(n) AS alpha, sqrt(sum(coalesce(v, 0) * (n - 1)) / sum(n)) AS sigma
       FROM pb GROUP BY feature)
SELECT batch, feature, CAST(n AS BIGINT) AS n, {R("sigma")} AS sigma,
       {R("(m - alpha) / sigma")} AS gamma_hat, {R("v / (sigma * sigma)")} AS delta_hat
FROM pb JOIN pf USING (feature)
""")
def q_combat_summary(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_returnflag", *LI_NUM)
    # alpha (a mean of 2-decimal values) is left out: its exact value often ends
    # in 5 at the 7th decimal, where any 6-digit rounding is a coin toss
    return normalize(tf.combat_summary(li, "l_returnflag", LI_NUM).drop("alpha"))


@query("smote_counts", """
WITH c AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
mx AS (SELECT max(n) AS nmax FROM c)
SELECT CAST(label AS BIGINT) AS label, CAST(0 AS BIGINT) AS synthetic, CAST(n AS BIGINT) AS n FROM c
UNION ALL
SELECT CAST(label AS BIGINT), CAST(1 AS BIGINT), CAST(nmax - n AS BIGINT) FROM c, mx WHERE nmax > n
""")
def q_smote_counts(spark, sf):
    df = tb.embedding_features(spark, sf)
    out = bal.smote(df, "label", EMB, "vec_id", k=5, seed=42)
    return normalize(out.groupBy("label", "synthetic").agg(F.count(F.lit(1)).alias("n")))


@query("yeo_johnson_apply", f"""
WITH p AS (SELECT l_orderkey, l_linenumber,
                  (exp(0.5 * ln(1 + l_quantity)) - 1) / 0.5 AS q,
                  (exp(1.5 * ln(1 + l_discount)) - 1) / 1.5 AS d FROM lineitem),
s AS (SELECT avg(q) AS mq, stddev_pop(q) AS sq, avg(d) AS md, stddev_pop(d) AS sd FROM p)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       {R("(q - mq) / sq")} AS l_quantity, {R("(d - md) / sd")} AS l_discount
FROM p, s
""")
def q_yeo_johnson_apply(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    out = tf.yeo_johnson(li, ["l_quantity", "l_discount"], lambdas={"l_quantity": 0.5, "l_discount": 1.5})
    return normalize(out)


def _smote_sql() -> str:
    h_key = sql_seeded_hash(42, "vec_id")
    h_nb = sql_seeded_hash(42, "label", "s", "'nb'")
    h_u = sql_seeded_hash(42, "label", "s", "'u'")
    means = ",\n       ".join(f"{R(f'avg(v[{i + 1}])')} AS mean_e{i}" for i in range(64))
    return f"""
WITH base AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
c AS (SELECT label, count(*) AS n FROM base GROUP BY label),
mx AS (SELECT max(n) AS nmax FROM c),
need AS (SELECT label, n, nmax - n AS m FROM c, mx WHERE nmax > n),
rows AS (SELECT b.*, need.n, need.m,
                row_number() OVER (PARTITION BY b.label ORDER BY {h_key}, b.vec_id) AS rk
         FROM base b JOIN need USING (label)),
pairs AS (SELECT a.label, a.vec_id, b.vec_id AS nk, b.v AS y,
                 sqrt(list_sum(list_transform(range(1, 65), lambda i: (a.v[i] - b.v[i]) * (a.v[i] - b.v[i])))) AS d
          FROM rows a JOIN rows b ON a.label = b.label AND a.vec_id <> b.vec_id),
knn AS (SELECT label, vec_id, y, row_number() OVER (PARTITION BY label, vec_id ORDER BY d, nk) AS j FROM pairs),
nb AS (SELECT label, vec_id, count(*) AS k FROM knn WHERE j <= 5 GROUP BY label, vec_id),
syn0 AS (SELECT r.label, r.vec_id, r.v, t.t * r.n + r.rk AS s, r.m
         FROM rows r, LATERAL (SELECT unnest(range(0, CAST(ceil(r.m / r.n) AS BIGINT))) AS t) t),
syn1 AS (SELECT s0.*, nb.k FROM syn0 s0 LEFT JOIN nb USING (label, vec_id) WHERE s <= m),
syn2 AS (SELECT s1.*, CAST(({h_nb}) % greatest(coalesce(k, 0), 1) + 1 AS BIGINT) AS pick,
                CAST({h_u} AS DOUBLE) / CAST(1152921504606846976 AS DOUBLE) AS u FROM syn1 s1),
syn AS (SELECT s2.label, list_transform(range(1, 65), lambda i: s2.v[i] + s2.u * (coalesce(kn.y, s2.v)[i] - s2.v[i])) AS v
        FROM syn2 s2 LEFT JOIN knn kn ON kn.label = s2.label AND kn.vec_id = s2.vec_id AND kn.j = s2.pick),
allrows AS (SELECT label, 0 AS synthetic, v FROM base UNION ALL SELECT label, 1, v FROM syn)
SELECT CAST(label AS BIGINT) AS label, CAST(synthetic AS BIGINT) AS synthetic, count(*) AS n,
       {means}
FROM allrows GROUP BY label, synthetic
"""


SQL["smote"] = _smote_sql().strip()


def _yj_sql_psi(x: str, lam: str) -> str:
    pos = f"CASE WHEN abs({lam}) > 1e-12 THEN (exp({lam} * ln(1 + {x})) - 1) / {lam} ELSE ln(1 + {x}) END"
    neg = (f"CASE WHEN abs({lam} - 2) > 1e-12 THEN -(exp((2 - {lam}) * ln(1 - {x})) - 1) / (2 - {lam}) "
           f"ELSE -ln(1 - {x}) END")
    return f"CASE WHEN {x} >= 0 THEN {pos} ELSE {neg} END"


def _yj_sql_pass(k: int, cands: str) -> str:
    """CTEs ll{k} (log-likelihood per candidate) and e{k} (parabola vertex)."""
    psi = _yj_sql_psi("u.x", "c.lam")
    return f"""
c{k} AS ({cands}),
ll{k} AS (
  SELECT c.col, c.i, c.lam,
         CASE WHEN sum(p) IS NULL OR (sum(p * p) / b.n - (sum(p) / b.n) ^ 2) <= 0 THEN NULL
              ELSE -b.n / 2.0 * ln(sum(p * p) / b.n - (sum(p) / b.n) ^ 2) + (c.lam - 1.0) * b.s END AS ll
  FROM (SELECT c.col, c.i, c.lam, {psi} AS p FROM c{k} c JOIN u ON u.col = c.col) c
  JOIN base b ON b.col = c.col GROUP BY c.col, c.i, c.lam, b.n, b.s),
best{k} AS (SELECT col, arg_max(i, ll) AS k, max(i) AS last FROM ll{k} WHERE ll IS NOT NULL GROUP BY col),
e{k} AS (
  SELECT b.col, l1.lam - l0.lam AS step,
         CASE WHEN b.k > 0 AND b.k < b.last AND lo.ll IS NOT NULL AND hi.ll IS NOT NULL
                   AND lo.ll - 2 * m.ll + hi.ll < 0
              THEN m.lam + 0.5 * (l1.lam - l0.lam) * (lo.ll - hi.ll) / (lo.ll - 2 * m.ll + hi.ll)
              ELSE m.lam END AS est
  FROM best{k} b
  JOIN ll{k} m ON m.col = b.col AND m.i = b.k
  JOIN ll{k} l0 ON l0.col = b.col AND l0.i = 0
  JOIN ll{k} l1 ON l1.col = b.col AND l1.i = 1
  LEFT JOIN ll{k} lo ON lo.col = b.col AND lo.i = b.k - 1
  LEFT JOIN ll{k} hi ON hi.col = b.col AND hi.i = b.k + 1)"""


def _yj_sql() -> str:
    cols = LI_NUM
    unp = ", ".join(f"'{c}'" for c in cols)
    vals = ", ".join(cols)
    lin = ("SELECT e.col, t.i, CASE WHEN t.i = 4 THEN e.est + {h} "
           "ELSE (e.est - {h}) + t.i * (((e.est + {h}) - (e.est - {h})) / 4) END AS lam "
           "FROM e{p} e, range(0, 5) t(i)")
    grid = "SELECT col, i, CASE WHEN i = 12 THEN 4.0 ELSE -2.0 + i * 0.5 END AS lam FROM (SELECT DISTINCT col FROM u), range(0, 13) t(i)"
    body = ",".join([
        _yj_sql_pass(1, grid),
        _yj_sql_pass(2, lin.format(h="e.step / 2", p=1)),
        _yj_sql_pass(3, lin.format(h="e.step / 4", p=2)),
    ])
    psi = _yj_sql_psi("u.x", "e3.est")
    outs = ",\n       ".join(
        f"{R(f'max(CASE WHEN z.col = {chr(39)}{c}{chr(39)} THEN z.z END)')} AS {c}" for c in cols)
    return f"""
WITH u AS (SELECT rid, l_orderkey, l_linenumber, f.col, f.x
           FROM (SELECT row_number() OVER () AS rid, * FROM lineitem) li,
                (SELECT unnest([{unp}]) AS col, unnest([{vals}]) AS x) f),
base AS (SELECT col, count(x) AS n, sum(sign(x) * ln(1 + abs(x))) AS s FROM u GROUP BY col),{body},
t AS (SELECT u.rid, u.l_orderkey, u.l_linenumber, u.col, {psi} AS p FROM u JOIN e3 ON e3.col = u.col),
st AS (SELECT col, avg(p) AS m, stddev_pop(p) AS sd FROM t GROUP BY col),
z AS (SELECT t.rid, t.l_orderkey, t.l_linenumber, t.col,
             CASE WHEN sd IS NULL OR sd = 0 THEN 0.0 ELSE (p - m) / sd END AS z FROM t JOIN st USING (col))
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       {outs}
FROM z GROUP BY rid, l_orderkey, l_linenumber
"""


SQL["yeo_johnson"] = _yj_sql().strip()


# =========================================================================== L1 / A17 / I9: fitted on training rows
@query("prepare_fit_on_train", f"""
WITH t AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_returnflag AS batch, l_quantity, l_extendedprice,
             l_orderkey % 5 <> 0 AS train FROM lineitem),
st AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS sp
       FROM t WHERE train)
SELECT l_orderkey, l_linenumber, {R("(l_quantity - mq) / sq")} AS z_l_quantity,
       {R("(l_extendedprice - mp) / sp")} AS z_l_extendedprice FROM t, st
""")
def q_prepare_fit_on_train(spark, sf):
    """Fitted on the rows of orders whose key 5 does not divide, saved, loaded, applied to all rows."""
    from pyspark.ml import PipelineModel

    from ..session import scratch_path
    from . import pipeline as pl
    cols = ["l_quantity", "l_extendedprice"]
    df = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *[F.col(c).cast("double").alias(c) for c in cols])
    path = scratch_path(spark, "preprocessing")
    pl.preprocessor({}, cols, cols).fit(df.where("l_orderkey % 5 <> 0")).write().save(path)
    return normalize(PipelineModel.load(path).transform(df).drop(*cols))


@query("evaluate_saved_survival", """
SELECT split, metric, true AS equal FROM (VALUES ('test'), ('val')) a(split), (VALUES ('concordance_index'), ('integrated_brier')) b(metric)
""")
def q_evaluate_saved_survival(spark, sf):
    """The one-call survival run; its saved preprocessing and model, loaded
    again, give the same figures on the same raw rows."""
    from ..session import scratch_path
    from . import pipeline as pl
    df = tb.surv(spark, sf)
    path = scratch_path(spark, "survival")
    config = {"seed": 42, "paths": {"processed": f"{path}/processed", "results": f"{path}/results"},
              "task": {"problem_type": "survival", "target_time": "duration", "target_event": "event",
                       "preprocessing": {"variance_stabilization": True}},
              "split": {"test_size": 0.2, "val_size": 0.2}, "model": {"name": "cox", "params": {"penalizer": 0.01}}}
    first = pl.run(spark, config, df=df, key="user_id")
    rows = spark.read.parquet(f"{path}/processed").select("user_id", "split").join(df, "user_id")
    again = [pl.evaluate_saved(spark, config, rows.where(F.col("split") == s).drop("split"), "user_id").select(
        F.lit(s).alias("split"), "metric", F.col("value").alias("again")) for s in ("test", "val")]
    both = first.join(again[0].unionByName(again[1]), ["split", "metric"])
    return both.select("split", "metric", F.coalesce(
        F.abs(F.col("value") - F.col("again")) < 1e-9, F.col("value").isNull() & F.col("again").isNull()).alias("equal"))


# =========================================================================== K1: tree and kernel Shapley values
from ..operators import tree_shapley as ts  # noqa: E402


@query("shapley_tree", """
SELECT m.model, CAST(c.class AS BIGINT) AS class, (SELECT count(*) FROM documents JOIN labels USING (doc_id)) AS n, CAST(0 AS DOUBLE) AS largest_gap
FROM (VALUES ('rf'), ('xgboost')) m(model), (VALUES (0), (1)) c(class)
""")
def q_shapley_tree(spark, sf):
    """Forest and boosted trees: the largest gap over all rows between the sum
    of a row's values and its prediction less the expected one."""
    from pyspark.ml.functions import vector_to_array

    from ..session import cut_lineage
    df = cut_lineage(tb.doc_features(spark, sf))
    out = None
    for name, params, col in (("rf", {"numTrees": 20}, "probability"), ("xgboost", {"maxIter": 10}, "rawPrediction")):
        model = md.fit_classifier(df, tb.DOC_FEATURES, "quality", name, params)
        base = ts.expected_value(ts.tree_leaves(md.classifier_of(model), spark))
        sums = ts.shapley_tree(model, df, "doc_id", tb.DOC_FEATURES).groupBy("row_key", "class").agg(F.sum("value").alias("s"))
        pred = md.predict(model, df).select(F.col("doc_id").alias("row_key"), F.posexplode(vector_to_array(col)).alias("class", "f"))
        gap = F.abs(F.col("f") - F.get(F.array(*map(F.lit, base.tolist())), F.col("class")) - F.col("s"))
        one = pred.join(sums, ["row_key", "class"]).groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.max(gap).alias("largest_gap"))
        one = one.withColumn("model", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return normalize(out.select("model", "class", "n", "largest_gap"))


@query("shapley_kernel", f"""
WITH x AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS size, p_retailprice AS price, CAST(length(p_name) AS DOUBLE) AS name,
             CAST(length(p_type) AS DOUBLE) AS kind FROM part),
bg AS (SELECT avg(size) AS size, avg(price) AS price, avg(name) AS name, avg(kind) AS kind
       FROM (SELECT * FROM x ORDER BY {sql_seeded_hash(7, "p_partkey")}, p_partkey LIMIT 50))
SELECT p_partkey AS row_key, CAST(0 AS BIGINT) AS class, f.feature, {R("f.value")} AS value
FROM (SELECT p_partkey, unnest([{{'feature': 'size', 'value': 2 * (x.size - bg.size)}}, {{'feature': 'price', 'value': 0.5 * (x.price - bg.price)}},
        {{'feature': 'name', 'value': -3 * (x.name - bg.name)}}, {{'feature': 'kind', 'value': 0 * (x.kind - bg.kind)}}]) AS f FROM x, bg)
""")
def q_shapley_kernel(spark, sf):
    """Every part, a linear score, a background of 50 rows: exact values."""
    x = _t(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price"),
                                     F.length("p_name").cast("double").alias("name"), F.length("p_type").cast("double").alias("kind"))
    score = lambda df: df.withColumn("value", F.array(2 * F.col("size") + 0.5 * F.col("price") - 3 * F.col("name") + 7))
    bg = sp.sample_n(x, 50, "p_partkey", seed=7)
    return normalize(ts.shapley_kernel(score, x, bg, "p_partkey", ["size", "price", "name", "kind"]))


# =========================================================================== K2: matching
@query("ate_matching", f"""
WITH {ATE_BASE_SQL.strip()},
p AS (SELECT t, c AS s, count(*) AS n, sum(y) AS y FROM x GROUP BY t, c),
lo AS (SELECT p.t, p.s, p.n, p.y, d.s AS ls, d.n AS ln, d.y AS ly FROM (SELECT *, 1 - t AS u FROM p) p ASOF LEFT JOIN p d ON p.u = d.t AND p.s >= d.s),
both_ AS (SELECT lo.*, d.s AS hs, d.n AS hn, d.y AS hy FROM (SELECT *, 1 - t AS u FROM lo) lo ASOF LEFT JOIN p d ON lo.u = d.t AND lo.s <= d.s),
u AS (SELECT *, ls IS NOT NULL AND (hs IS NULL OR s - ls <= hs - s) AS a,
             hs IS NOT NULL AND (ls IS NULL OR (hs - s <= s - ls AND hs <> ls)) AS b FROM both_),
g AS (SELECT t, n, (y - n * (CASE WHEN a THEN ly ELSE 0 END + CASE WHEN b THEN hy ELSE 0 END)
             / (CASE WHEN a THEN ln ELSE 0 END + CASE WHEN b THEN hn ELSE 0 END)) * (2 * t - 1) AS gap FROM u)
SELECT {R("sum(gap) / sum(n)")} AS ate, {R("sum(CASE WHEN t = 1 THEN gap END) / sum(CASE WHEN t = 1 THEN n END)")} AS att,
       {R("sum(CASE WHEN t = 0 THEN gap END) / sum(CASE WHEN t = 0 THEN n END)")} AS atc FROM g
""")
def q_ate_matching(spark, sf):
    return normalize(ca.matched_effect(_ate_frame(spark, sf), "t", "y", "c"))


# =========================================================================== H7: log-rank survival forest
from ..operators import survival_forest as sf_  # noqa: E402

LOGRANK_CUTS = [40.0, 60.0, 80.0, 100.0, 120.0]


@query("logrank_split", f"""
WITH {tb.SURV_SQL.strip()},
h AS (SELECT unnest({LOGRANK_CUTS}::DOUBLE[]) AS threshold),
e AS (SELECT DISTINCT duration AS g FROM surv WHERE event = 1),
r AS (SELECT h.threshold, e.g, count(*) FILTER (s.duration >= e.g) AS y,
        count(*) FILTER (s.duration >= e.g AND s.mean_value <= h.threshold) AS yl,
        count(*) FILTER (s.duration = e.g AND s.event = 1) AS d,
        count(*) FILTER (s.duration = e.g AND s.event = 1 AND s.mean_value <= h.threshold) AS dl
      FROM surv s, e, h GROUP BY 1, 2),
z AS (SELECT threshold, sum(dl - d * yl / y) AS u,
        sum(CASE WHEN y > 1 THEN d * (yl / y) * (1 - yl / y) * (y - d) / (y - 1) ELSE 0 END) AS v FROM r GROUP BY 1)
SELECT threshold, (SELECT count(*) FROM surv WHERE mean_value <= threshold) AS n_left,
       {R("CASE WHEN v > 1e-12 THEN u * u / v ELSE 0 END")} AS statistic FROM z
""")
def q_logrank_split(spark, sf):
    """Every candidate split of one root node; whole days are few enough for the exact statistic."""
    return normalize(sf_.logrank_splits(tb.surv(spark, sf), "duration", "event", "mean_value", LOGRANK_CUTS, time_bins=4096))


@query("survival_forest")
def q_survival_forest(spark, sf):
    """Concordance and integrated Brier score of the forest on the rows it did not see."""
    s = sp.random_split(tb.surv(spark, sf), "user_id", test=0.2, seed=42)
    m = sf_.fit_survival_forest(s.where("split = 'train'"), "duration", "event", ["mean_value", "n_events"], "user_id")
    return normalize(sv.evaluate_survival(m, s.where("split = 'test'"), "duration", "event", "user_id"))


# =========================================================================== A1-A5, A9-A11: readers over text written from the tables
@query("read_labeled", """
SELECT 'L' || l_orderkey || '_' || l_linenumber AS "Sequence_Name", l_quantity AS mcg, l_discount AS gvh, l_tax AS alm,
       CAST(l_linenumber AS DOUBLE) AS mit, 0.5 AS erl, 0.0 AS pox, 0.25 AS vac, 1.0 AS nuc,
       CAST(dense_rank() OVER (ORDER BY l_returnflag) - 1 AS BIGINT) AS site
FROM lineitem
""".replace(" 0.5 AS", " CAST(0.5 AS DOUBLE) AS").replace(" 0.0 AS", " CAST(0 AS DOUBLE) AS").replace(
    " 0.25 AS", " CAST(0.25 AS DOUBLE) AS").replace(" 1.0 AS", " CAST(1 AS DOUBLE) AS"))
def q_read_labeled(spark, sf):
    """Labelled white-space text: ten fixed columns, the label coded in sorted order."""
    from ..session import scratch_path
    from ..sources import readers
    path = scratch_path(spark, "labelled") + ".data"
    name = F.concat(F.lit("L"), F.col("l_orderkey"), F.lit("_"), F.col("l_linenumber"))
    fields = [name, *[F.col(c).cast("double").cast("string") for c in ("l_quantity", "l_discount", "l_tax", "l_linenumber")],
              *map(F.lit, ("0.5", "0.0", "0.25", "1.0")), F.col("l_returnflag")]
    _t(spark, sf, "lineitem").select(F.concat_ws("  ", *fields).alias("value")).write.text(path)
    return normalize(readers.read_source(spark, "uci", path, target="site"))


@query("read_matrix", f"""
SELECT c_custkey, c_name, c_mktsegment, CAST(c_nationkey AS BIGINT) AS c_nationkey, {R("c_acctbal")} AS c_acctbal,
       CAST(l_partkey AS BIGINT) AS n_m1
FROM customer JOIN (SELECT o_custkey, count(*) AS l_partkey FROM orders GROUP BY 1) ON c_custkey = o_custkey
""")
def q_read_matrix(spark, sf):
    """Two delimited files with headers, types inferred, merged on their key."""
    from ..session import scratch_path
    from ..sources import readers
    a, b = scratch_path(spark, "matrix") + ".csv", scratch_path(spark, "matrix") + ".tsv"
    _t(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey", "c_acctbal").write.option("header", True).csv(a)
    n = _t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    n.write.option("header", True).option("sep", "\t").csv(b)
    return normalize(readers.read_source(spark, "multiomics", [a, b], join_on="c_custkey"))


@query("read_fasta", f"""
WITH s AS (SELECT 'doc' || doc_id AS id, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS q FROM documents)
SELECT id, CAST(length(q) AS BIGINT) AS seq_length,
       {R("CASE WHEN length(q) > 0 THEN (length(q) - length(replace(replace(q, 'G', ''), 'C', ''))) / length(q) ELSE 0.0 END")} AS gc_content,
       CAST(0 AS BIGINT) AS target
FROM s
""")
def q_read_fasta(spark, sf):
    """Sequence records of all documents' letters: lines of 60, '>' inside headers."""
    from ..session import scratch_path
    from ..sources import readers
    path = scratch_path(spark, "sequences") + ".fasta"
    seq = F.regexp_replace(F.upper(F.regexp_replace("text", "[^A-Za-z]", "")), "(.{60})", "$1\n")
    _t(spark, sf, "documents").select(F.concat(F.lit(">doc"), F.col("doc_id"), F.lit(" from >"), F.coalesce("source", F.lit("")),
                                               F.lit("\n"), seq).alias("value")).write.text(path)
    return normalize(readers.read_source(spark, "fasta", path))


@query("read_triplets", f"""
SELECT CAST(l_orderkey AS VARCHAR) AS cell, CAST(l_partkey AS VARCHAR) AS gene, {R("l_quantity")} AS count FROM lineitem
""")
def q_read_triplets(spark, sf):
    from ..session import scratch_path
    from ..sources import readers
    path = scratch_path(spark, "triplets") + ".csv"
    _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("cell"), F.col("l_partkey").alias("gene"),
                                     F.col("l_quantity").alias("count")).write.option("header", True).csv(path)
    return normalize(readers.read_triplets(spark, path))


# =========================================================================== F5, F6, H6: rows that SQL can follow
@query("pca_invariants", f"""
WITH u AS (SELECT i, CAST(embedding[i] AS DOUBLE) AS v FROM embeddings, range(1, 65) t(i))
SELECT 'total_variance' AS metric, {R("sum(s)")} AS value FROM (SELECT var_samp(v) AS s FROM u GROUP BY i)
UNION ALL SELECT 'largest_mean', CAST(0 AS DOUBLE) UNION ALL SELECT 'largest_covariance', CAST(0 AS DOUBLE)
UNION ALL SELECT 'variances_out_of_order', CAST(0 AS DOUBLE)
""")
def q_pca_invariants(spark, sf):
    """All 64 axes: variances add up to the columns', scores are centred and uncorrelated, the variances fall."""
    out = tf.pca_scores(tb.embedding_features(spark, sf), EMB, k=64)
    pc = [F.col(f"pca_{i}") for i in range(1, 65)]
    r = out.agg(*[F.var_samp(c).alias(f"v{i}") for i, c in enumerate(pc)], F.greatest(*[F.abs(F.avg(c)) for c in pc]).alias("m"),
                F.greatest(*[F.abs(F.covar_samp(a, b)) for a, b in zip(pc, pc[1:])]).alias("c"))
    v = [F.col(f"v{i}") for i in range(64)]
    drop = sum((F.when(b > a + 1e-12, 1.0).otherwise(0.0) for a, b in zip(v, v[1:])), F.lit(0.0))
    total = sum(v[1:], v[0])
    return normalize(r.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), x.alias("value")) for n, x in (
        ("total_variance", total), ("largest_mean", F.col("m")), ("largest_covariance", F.col("c")), ("variances_out_of_order", drop))]))
        .alias("s")).select("s.*"))


@query("impute_regression", """
WITH x AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity AS q, l_extendedprice AS p, l_orderkey % 7 = 0 AS gone FROM lineitem),
b AS (SELECT regr_slope(p, q) AS s, regr_intercept(p, q) AS i FROM x WHERE NOT gone)
SELECT l_orderkey, l_linenumber, q AS l_quantity, round(CASE WHEN gone THEN i + s * q ELSE p END, 3) + 0.0 AS l_extendedprice FROM x, b
""")
def q_impute_regression(spark, sf):
    """One incomplete column and no penalty: missing cells are on the regression line of the others."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.when(
        F.col("l_orderkey") % 7 != 0, F.col("l_extendedprice")).alias("l_extendedprice"))
    out = tf.iterative_impute(li, ["l_quantity", "l_extendedprice"], ridge=0.0)
    return normalize(out.withColumn("l_extendedprice", F.round("l_extendedprice", 3)))


def _cox_sql(steps: int = 8) -> str:
    """Newton steps of the Breslow partial likelihood of one standardised covariate."""
    ctes = ["z AS (SELECT duration AS t, event AS e, (mean_value - avg(mean_value) OVER ()) / stddev_samp(mean_value) OVER () AS x FROM surv)",
            "b0 AS (SELECT CAST(0 AS DOUBLE) AS b)"]
    for i in range(steps):
        ctes.append(f"""g{i} AS (SELECT t, any_value(b) AS b, sum(exp(b * x)) AS w0, sum(x * exp(b * x)) AS w1, sum(x * x * exp(b * x)) AS w2,
             sum(e) AS d, sum(e * x) AS ex FROM z, b{i} GROUP BY t)""")
        ctes.append(f"""r{i} AS (SELECT b, d, ex, sum(w0) OVER w AS s0, sum(w1) OVER w AS s1, sum(w2) OVER w AS s2
             FROM g{i} WINDOW w AS (ORDER BY t DESC))""")
        ctes.append(f"""b{i + 1} AS (SELECT any_value(b) + sum(ex - d * s1 / s0) / sum(d * (s2 / s0 - (s1 / s0) ** 2)) AS b FROM r{i})""")
    body = ",\n".join(ctes)
    return f"""
WITH {tb.SURV_SQL.strip()},
{body}
SELECT 'mean_value' AS covariate, {R("b / (SELECT stddev_samp(mean_value) FROM surv)")} AS coef FROM b{steps}
"""


@query("cox_breslow", _cox_sql())
def q_cox_breslow(spark, sf):
    m = sv.cox_fit(tb.surv(spark, sf), "duration", "event", ["mean_value"], ties="breslow")
    return normalize(m.coefficients(spark).select("covariate", "coef"))
