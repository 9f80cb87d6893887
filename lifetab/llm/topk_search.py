"""Exact top-k search (operator 3): ball-tree branch and bound per shard.

Vectors become integers (floor(256 x)) and are dealt to shards by a hash of
their id; every shard is a ball tree.  A block of queries walks a tree
depth-first: at each node it drops the queries whose upper bound (inner
product with the centre plus norm times radius) is below their current k-th
score, and each query takes the child with the larger bound first.  The k-th
scores are shared: every block first searches one shard, and the scores found
there bound its search of all others, which carry them on from tree to tree.

Scale: the work is a grid of (query block, shard group) tasks over written
trees; a task holds one block and one tree.  Many equal vectors are a ball of
radius 0, bounded exactly.

Defined cases: vectors that are null or hold a null or non-finite component
take no part; shorter vectors count as padded with zeros; repeated rows count
once; of other rows that share the query's id all are its own; components and
scores beyond 64 bits stay at the bounds; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import load, materialise

K = 5
EVERY = 50
SCALE = 256
SHARD_ROWS = 8192
QUERY_ROWS = 512
LEAF = 128
GROUP = 8           # shards a task searches in turn
LOW = np.iinfo(np.int64).min


def _matrix(vectors) -> tuple[np.ndarray, np.ndarray]:
    """Rows of (id, integer vector), repeated rows once, in id order."""
    own = sorted({(i, tuple(v)) for i, v in vectors})
    dim = max((len(v) for _, v in own), default=0)
    out = np.zeros((len(own), dim), np.int64)
    for row, (_, v) in zip(out, own):
        row[:len(v)] = v
    return np.array([i for i, _ in own], np.int64), out


def dots(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products (float64 while every sum is below 2^53)."""
    dim = min(q.shape[1], x.shape[1])
    q, x = q[:, :dim], x[:, :dim]
    most = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(x.astype(np.float64)).max(initial=0)) * max(dim, 1)
    if most < 2**53:
        return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    return np.clip(q.astype(object) @ x.T.astype(object), LOW, -(LOW + 1)).astype(np.int64)


def build_tree(ids: np.ndarray, x: np.ndarray, leaf: int = LEAF) -> dict:
    """Ball tree: points in leaf order; per node its range, centre, radius and children."""
    order = np.arange(len(ids))
    f = x.astype(np.float64)
    nodes: list[list] = []

    def make(a: int, b: int) -> int:
        rows = f[order[a:b]]
        centre = rows.mean(axis=0)
        gap = np.sqrt(((rows - centre) ** 2).sum(axis=1))
        me = len(nodes)
        nodes.append([a, b, -1, -1, centre, gap.max()])
        if b - a > leaf and gap.max() > 0:
            far = rows[gap.argmax()]
            other = rows[((rows - far) ** 2).sum(axis=1).argmax()]
            side = rows @ (other - far)
            half = (b - a) // 2
            order[a:b] = order[a:b][np.argsort(side, kind="stable")]
            nodes[me][2:4] = make(a, a + half), make(a + half, b)
        return me

    if len(ids):
        make(0, len(ids))
    return {"ids": ids[order], "x": x[order], "span": np.array([n[:4] for n in nodes], np.int64).reshape(-1, 4),
            "centre": np.array([n[4] for n in nodes]), "radius": np.array([n[5] for n in nodes])}


class QueryBlock:
    """Queries with their best k so far (scores descending, ties by smaller id)."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int, score=None, found=None):
        self.ids, self.q, self.k = ids, q, k
        self.norm = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
        self.score = np.full((len(ids), k), LOW) if score is None else score
        self.found = np.full((len(ids), k), -LOW - 1) if found is None else found
        self.visited = 0

    def state(self) -> dict:
        return {x: getattr(self, x) for x in ("ids", "q", "k", "score", "found")}

    def add(self, active: np.ndarray, ids: np.ndarray, scores: np.ndarray):
        scores = np.where(self.ids[active][:, None] == ids[None, :], LOW, scores)
        better = (scores >= self.score[active, -1][:, None]).any(axis=1)
        active, scores = active[better], scores[better]
        if not len(active):
            return
        both = np.concatenate([self.score[active], scores], axis=1)
        who = np.concatenate([self.found[active], np.broadcast_to(ids, scores.shape)], axis=1)
        who = np.where(both == LOW, -LOW - 1, who)
        best = np.lexsort((who, -np.maximum(both, LOW + 1)), axis=-1)[:, :self.k]
        self.score[active] = np.take_along_axis(both, best, 1)
        self.found[active] = np.take_along_axis(who, best, 1)

    def search(self, tree: dict):
        if not len(tree["ids"]):
            return
        dim = min(self.q.shape[1], tree["x"].shape[1])
        q = self.q[:, :dim].astype(np.float64)
        centre, radius, span = tree["centre"][:, :dim], tree["radius"], tree["span"]
        reach = np.sqrt((centre ** 2).sum(axis=1)) + radius

        def bound(node: int, active: np.ndarray) -> np.ndarray:
            top = q[active] @ centre[node] + self.norm[active] * radius[node]
            return top + 1e-9 * self.norm[active] * reach[node] + 1e-6     # rounding

        def visit(node: int, active: np.ndarray, top: np.ndarray):
            active = active[top >= self.score[active, -1]]
            if not len(active):
                return
            self.visited += len(active)
            a, b, left, right = span[node]
            if left < 0:
                for at in range(a, b, 4 * LEAF):
                    upto = min(at + 4 * LEAF, b)
                    self.add(active, tree["ids"][at:upto], dots(self.q[active], tree["x"][at:upto]))
                return
            x, y = bound(left, active), bound(right, active)
            first = x >= y
            for pick, near, far, t, u in ((first, left, right, x, y), (~first, right, left, y, x)):
                if pick.any():
                    visit(near, active[pick], t[pick])
                    visit(far, active[pick], u[pick])

        every = np.arange(len(self.ids))
        visit(0, every, bound(0, every))


def _grouped(batches, columns: list[str], key: int):
    """Rows of consecutive equal leading columns."""
    now, held = None, []
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in columns)):
            if row[:key] != now:
                if held:
                    yield now, held
                now, held = row[:key], []
            held.append(row[key:])
    if held:
        yield now, held


def _pack(make):
    def run(batches):
        for (g,), rows in _grouped(batches, ["g", "id", "v"], 1):
            ids, x = _matrix(rows)
            yield pa.RecordBatch.from_arrays([pa.array([g], pa.int32()), pa.array([pickle.dumps(make(ids, x))], pa.binary())], names=["g", "blob"])
    return run


def _searches(batches):
    """(block number, searched block) of each group: a block, then its trees."""
    block, now = None, None
    for b in batches:
        for qb, sg, kind, blob in zip(*(b.column(c) for c in ("qb", "sg", "kind", "blob"))):
            key = (qb.as_py(), sg.as_py())
            if kind.as_py() == 0:
                if block is not None:
                    yield now[0], block
                now, block = key, QueryBlock(**pickle.loads(blob.as_py()))
            elif key == now:
                block.search(pickle.loads(blob.as_py()))
    if block is not None:
        yield now[0], block


def _first(batches):
    for qb, block in _searches(batches):
        yield pa.RecordBatch.from_arrays([pa.array([qb], pa.int32()), pa.array([pickle.dumps(block.state())], pa.binary())], names=["g", "blob"])


def _second(batches):
    for _, block in _searches(batches):
        real = block.found != -LOW - 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(block.ids, real.sum(axis=1))), pa.array(block.found[real]), pa.array(block.score[real])],
            names=["query_id", "vec_id", "score"])


def exact_topk(vectors: DataFrame, is_query, k: int = K, scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of every row
    that satisfies ``is_query``."""
    good = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    ints = F.transform(vec_col, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & F.coalesce(good, F.lit(False)))
    rows = rows.select(F.col(id_col).cast("long").alias("id"), ints.alias("v"), is_query.alias("q"))
    n, nq = rows.agg(F.count(F.lit(1)), F.count_if("q")).first()
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-nq // QUERY_ROWS))

    def packed(df, groups, make, name):
        dealt = df.withColumn("g", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int")).select("g", "id", "v")
        dealt = dealt.repartition(groups, "g").sortWithinPartitions("g", "id")
        return materialise(dealt.mapInArrow(_pack(make), "g int, blob binary"), name)

    trees = packed(rows, shards, build_tree, "trees")
    queries = packed(rows.where("q"), blocks, lambda ids, x: QueryBlock(ids, x, k).state(), "queries")

    def grid(left, pairs, search, schema):
        """left: blocks with the shard groups ``sg`` they search; pairs: trees with (qb, sg)."""
        both = left.select(F.col("g").alias("qb"), "sg", F.lit(0).alias("kind"), F.lit(0).alias("shard"), "blob")
        both = both.unionByName(pairs.select("qb", "sg", F.lit(1).alias("kind"), F.col("g").alias("shard"), "blob"))
        both = both.repartition("qb", "sg").sortWithinPartitions("qb", "sg", "kind", "shard")
        return both.mapInArrow(search, schema)

    home = F.expr(f"filter(sequence(0, {blocks - 1}), b -> b % {shards} = g)")
    first = grid(queries.withColumn("sg", F.lit(0)), trees.select("g", "blob", F.explode(home).alias("qb"), F.lit(0).alias("sg")),
                 _first, "g int, blob binary")
    first = materialise(first, "first")
    others = F.expr(f"filter(sequence(0, {blocks - 1}), b -> b % {shards} != g)")
    groups = -(-shards // GROUP)
    rest = grid(first.withColumn("sg", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))),
                trees.select("g", "blob", F.explode(others).alias("qb"), F.floor(F.col("g") / GROUP).cast("int").alias("sg")),
                _second, "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = rest.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op3_ball_tree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows for every vector whose id is divisible by 50."""
    return exact_topk(load(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


SQL = {"op3_ball_tree_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""}
