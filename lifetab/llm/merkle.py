"""Merkle dataset manifest (operator 12): octopus multiproofs.

Every row is a leaf: the sha256 of its columns, each ``-`` if null, else its
UTF-8 byte count, a colon and its value.  Per source the leaves ascend by id;
every ``ARITY`` consecutive nodes become their hash until one is left, the
source's subroot; the subroots in the order of their sources likewise give the
root.  A proof is, level by level up to the root, the digests left and right of
the path in its run; ``fold`` recomputes the root from any leaf and a proof.

A node's coordinate is (tree, level, place).  Leaf partitions are runs of
``block`` = ARITY^k leaves of one source.  Each computes the minimal union of
nodes that the proofs of all its leaves need and its own leaves do not give
(``missing``), these are fetched for all partitions by one join, and the
partition derives the shared interiors and expands the proofs of its leaves.

Scale: leaves are range-sorted by (source, id) once, so a hot source lies in
many tasks; a task holds one block of digests at a time; the node table holds
only what blocks can miss, the tops of blocks and the nodes above (a
``block``-th of the leaves); nothing goes to the driver but the number of
sources and of levels.

Defined cases: a null text, source or any column is hashed as ``-``; null
sources are one source, first in order; null ids come first, equal ids are
ordered by leaf; equal rows are leaves of their own; an empty table gives no
rows; columns that are not named are neither hashed nor returned.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import grouped, load, materialise, partitions, placed

ARITY = 3
BLOCK = 3 ** 7
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = "2"       # tree of the subroots; trees of sources are "0" (null) and "1" + name


def leaf_hash(columns, replaced: dict[str, Column] | None = None) -> Column:
    """Digest of a row; ``replaced`` gives other values for some columns."""
    parts = []
    for c in columns:
        v = (replaced or {}).get(c, F.col(c)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def height(width: int, arity: int = ARITY) -> int:
    """Levels above ``width`` leaves."""
    up = 0
    while width > 1:
        width, up = -(-width // arity), up + 1
    return up


def climb(digests: list[str], levels: int, arity: int = ARITY) -> list[list[str]]:
    """The nodes of ``levels`` levels above consecutive, aligned nodes."""
    out = [digests]
    for _ in range(levels):
        d = out[-1]
        out.append([hashlib.sha256("".join(d[i:i + arity]).encode()).hexdigest() for i in range(0, len(d), arity)])
    return out


def missing(places, width: int, arity: int = ARITY) -> list[tuple[int, np.ndarray]]:
    """Per level the places of the nodes that the proofs of the leaves
    ``places`` need and that these leaves do not give, in a tree of ``width``."""
    known, out, level = np.unique(places), [], 0
    while width > 1:
        runs = np.unique(known // arity)
        members = (runs[:, None] * arity + np.arange(arity)).ravel()
        out.append((level, np.setdiff1d(members[members < width], known, assume_unique=True)))
        known, width, level = runs, -(-width // arity), level + 1
    return [(l, m) for l, m in out if len(m)]


def fold(leaf: Column, before: Column, after: Column) -> Column:
    """Root recomputed from a leaf and its proof."""
    steps = F.arrays_zip(before.alias("before"), after.alias("after"))
    return F.aggregate(steps, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


NODE = "tree string, level int, place long, width long, top boolean, digest string"


def build(leaves: DataFrame, block: int = BLOCK, arity: int = ARITY, inner: bool = False) -> DataFrame:
    """Node table of all trees (tree, place, width, digest): the tops of the
    blocks of leaves and all above; with ``inner`` also all below.  ``top``
    marks the root of a tree."""
    k = height(block, arity)
    now, level, out = leaves, 0, []
    while True:
        def up(batches, level=level, lowest=1 if level else 0 if inner else None):
            for (tree, b), t in grouped(batches, "tree", "_block"):
                width = t.column("width")[0].as_py()    # nodes of this level in the tree
                steps = min(k, height(width, arity))
                levels = climb(t.column("digest").to_pylist(), steps, arity)
                for i in range(steps if lowest is None else lowest, steps + 1):
                    n = -(-width // arity ** i)
                    d = levels[i]
                    first = b * block // arity ** i
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([tree] * len(d)), pa.array([level + i] * len(d), pa.int32()),
                         pa.array(range(first, first + len(d)), pa.int64()), pa.array([n] * len(d), pa.int64()),
                         pa.array([n == 1] * len(d)), pa.array(d)], names=["tree", "level", "place", "width", "top", "digest"])

        dealt = now.withColumn("_block", F.expr(f"place div {block}")).select("tree", "_block", "place", "width", "digest")
        dealt = dealt.repartition(partitions(leaves.sparkSession), "tree", "_block").sortWithinPartitions("tree", "_block", "place")
        nodes = materialise(dealt.mapInArrow(up, NODE), "nodes")
        out.append(nodes)
        level += k
        now = nodes.where((F.col("level") == level) & (F.col("width") > 1))
        if now.isEmpty():
            break
    nodes = out[0]
    for more in out[1:]:
        nodes = nodes.unionByName(more)
    return nodes


def manifest(docs: DataFrame, columns=COLUMNS, id_col: str = "doc_id", source_col: str = "source", carry=(),
             leaf: Column | None = None, arity: int = ARITY, block: int = BLOCK) -> DataFrame:
    """Per row: id, the columns ``carry``, leaf, subroot, root and its proof, the
    concatenated digests ``before`` and ``after`` the path at every level.
    ``leaf`` gives another leaf digest than that of ``columns``."""
    if arity ** height(block, arity) != block:
        raise ValueError("block must be a power of arity")
    spark = docs.sparkSession
    src = F.col(source_col)
    rows = docs.select(F.struct(F.col(id_col), *carry).alias("kept"), (leaf_hash(columns) if leaf is None else leaf).alias("leaf"),
                       F.when(src.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), src.cast("string"))).alias("tree"))
    own = f"kept.{id_col}"
    rows = placed(rows, "place", "tree", F.col(own).asc_nulls_first(), F.col("leaf"))
    rows = materialise(rows, "leaves")
    sizes = rows.groupBy("tree").agg(F.count(F.lit(1)).alias("width"))
    # one row per leaf partition, with its source's size
    blocks = rows.where(F.col("place") % block == 0).select("tree", F.expr(f"place div {block}").alias("block"))
    blocks = materialise(blocks.join(sizes, "tree"), "blocks")
    sized = rows.withColumn("block", F.expr(f"place div {block}")).join(blocks, ["tree", "block"])
    nodes = build(sized.withColumnRenamed("leaf", "digest"), block, arity)
    # the sources' subroots are the leaves of the upper tree
    roots = nodes.where("top").select("tree", "digest").withColumn("upper", F.lit(TOP))
    roots = materialise(placed(roots, "rank", "upper", F.col("tree")), "subroots")
    sources = roots.count()
    above = build(roots.select(F.col("upper").alias("tree"), F.col("rank").alias("place"),
                               F.lit(sources).cast("long").alias("width"), "digest"), block, arity, inner=True)
    k = height(block, arity)

    blocks = blocks.join(roots.select("tree", "rank"), "tree")

    def ask(batches):
        for rb in batches:
            out = []
            for tree, b, width, rank in zip(*(rb.column(c).to_pylist() for c in ("tree", "block", "width", "rank"))):
                own = missing(np.arange(b * block, min((b + 1) * block, width)), width, arity)
                for kind, of, need in ((1, tree, own), (2, TOP, missing([rank], sources, arity))):
                    out += [(tree, b, kind, of, level, place) for level, places in need for place in places.tolist()]
            names = ("tree", "block", "kind", "of", "level", "place")
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int64())
            cols = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=list(names))

    asked = blocks.mapInArrow(ask, "tree string, block long, kind int, of string, level int, place long")
    held = nodes.unionByName(above).select(F.col("tree").alias("of"), "level", "place", "digest")
    fetched = asked.join(held, ["of", "level", "place"]).drop("of")
    head = blocks.select("tree", "block", F.lit(0).alias("kind"), F.lit(0).alias("level"), F.col("rank").alias("place"),
                         "width")
    kept_type = rows.schema["kept"].dataType
    leaves = rows.select("tree", F.expr(f"place div {block}").alias("block"), F.lit(3).alias("kind"), F.lit(0).alias("level"),
                         "place", F.col("leaf").alias("digest"), "kept")
    parts = (head.unionByName(fetched, allowMissingColumns=True).unionByName(leaves, allowMissingColumns=True)
             .withColumn("kept", F.col("kept").cast(kept_type)))

    def expand(batches):
        for (_, b), t in grouped(batches, "tree", "block"):
            kind = t.column("kind").to_numpy()
            level = t.column("level").to_numpy()
            place = t.column("place").to_numpy()
            digest = t.column("digest").combine_chunks()
            width, rank = t.column("width")[0].as_py(), int(place[0])
            got = {(int(c), int(l), int(p)): d for c, l, p, d in zip(
                kind, level, place, digest.slice(0, int((kind < 3).sum())).to_pylist()) if c}
            first = int((kind < 3).sum())
            n = len(kind) - first
            own = climb(digest.slice(first).to_pylist(), min(k, height(width, arity)), arity)
            before, after = [], []      # per level: one string per leaf

            def run(kind, level, nodes, start, width):
                """Strings left and right of every node of a level."""
                left, right = [], []
                for i, _ in enumerate(nodes):
                    p = start + i
                    r = p - p % arity
                    side = [nodes[q - start] if start <= q < start + len(nodes) else got[kind, level, q]
                            for q in range(r, min(r + arity, width))]
                    left.append("".join(side[:p - r]))
                    right.append("".join(side[p - r + 1:]))
                return left, right

            leaf_at = np.arange(n)
            w, at = width, b * block
            for i, nodes in enumerate(own):
                if w == 1:
                    break
                left, right = run(1, i, nodes, at, w)
                which = leaf_at // arity ** i
                before.append(pa.array(left).take(pa.array(which)))
                after.append(pa.array(right).take(pa.array(which)))
                if len(nodes) == 1 and i == len(own) - 1:
                    break
                w, at = -(-w // arity), at // arity
            # above the block all leaves share one path
            i, node = len(own) - 1, own[-1][0]
            rest, w, p = [], -(-width // arity ** i), b * block // arity ** i
            while w > 1:
                (x,), (y,) = run(1, i, [node], p, w)
                if i >= len(own):
                    rest.append((x, y))
                node = hashlib.sha256((x + node + y).encode()).hexdigest()
                i, w, p = i + 1, -(-w // arity), p // arity
            subroot, i, w, p = node, 0, sources, rank
            while w > 1:
                (x,), (y,) = run(2, i, [node], p, w)
                rest.append((x, y))
                node = hashlib.sha256((x + node + y).encode()).hexdigest()
                i, w, p = i + 1, -(-w // arity), p // arity
            same = [[pa.array([s]).take(pa.array(np.zeros(n, np.int64))) for s in side] for side in (
                [x for x, _ in rest], [y for _, y in rest])]
            depth = len(before) + len(rest)
            offsets = pa.array(np.arange(n + 1) * depth, pa.int32())
            by_leaf = (np.arange(depth) * n + np.arange(n)[:, None]).ravel()    # level-major to leaf-major

            def lists(columns):
                flat = pa.concat_arrays(columns).take(pa.array(by_leaf)) if columns else pa.array([], pa.string())
                return pa.ListArray.from_arrays(offsets, flat)

            kept = t.column("kept").combine_chunks().slice(first)
            one = pa.array(np.zeros(n, np.int64))
            yield pa.RecordBatch.from_arrays(
                [kept, digest.slice(first), pa.array([subroot]).take(one), pa.array([node]).take(one),
                 lists(before + same[0]), lists(after + same[1])],
                names=["kept", "leaf", "subroot", "root", "before", "after"])

    schema = f"kept {kept_type.simpleString()}, leaf string, subroot string, root string, before array<string>, after array<string>"
    dealt = parts.repartition(partitions(spark), "tree", "block").sortWithinPartitions("tree", "block", "kind", "place")
    return (dealt.select("tree", "block", "kind", "level", "place", "width", "digest", "kept")
            .mapInArrow(expand, schema).select("kept.*", "leaf", "subroot", "root", "before", "after"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents; every second one's text loses its line breaks
    before its proof is checked."""
    docs = load(spark, sf_dir, "documents").select(*COLUMNS)
    cut = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    tampered = leaf_hash(COLUMNS, {"text": F.when(cut, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))})
    out = manifest(docs.withColumn("checked", tampered), carry=["checked"])
    out = out.withColumn("folded_root", fold(F.col("checked"), F.col("before"), F.col("after")))
    proof = F.array_join(F.zip_with("before", "after", lambda b, a: F.concat(b, a)), "")
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


_SIDE = "string_agg(s.d, '' ORDER BY s.i) FILTER (s.i {} n.i)"


def _tree(name: str) -> str:
    """Levels of the trees of CTE ``name``_0 (k, l, i, c, d), the strings beside
    every node, and for every leaf (k, i) its proof and path."""
    return f"""
{name}_t(k, l, i, c, d) AS (
  SELECT * FROM {name}_0 UNION ALL
  SELECT k, l + 1, i // 3, any_value((c + 2) // 3), sha256(string_agg(d, '' ORDER BY i))
  FROM {name}_t WHERE c > 1 GROUP BY k, l, i // 3),
{name}_s AS (
  SELECT n.k, n.l, n.i, coalesce({_SIDE.format('<')}, '') AS b, coalesce({_SIDE.format('>')}, '') AS a
  FROM {name}_t n JOIN {name}_t s ON n.k IS NOT DISTINCT FROM s.k AND n.l = s.l AND n.i // 3 = s.i // 3
  WHERE n.c > 1 GROUP BY n.k, n.l, n.i)"""


def _crc32(text: str) -> str:
    """Lowest bit first: every byte is one step that takes it in and seven more."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c), 0, 0, 0, 0, 0, 0, 0]::BIGINT[]))"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda r, b: "
            "xor(xor(r, b) >> 1, 3988292384 * (xor(r, b) & 1))))")


def _field(c: str) -> str:
    return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"


_LEAF = "sha256(" + " || ".join(_field(c) for c in COLUMNS) + ")"
SQL = {"op12_merkle_manifest": f"""
WITH RECURSIVE e AS (
  SELECT doc_id, source, {_LEAF} AS leaf,
         CASE WHEN {_crc32("doc_id::VARCHAR")} % 2 = 0 THEN {_LEAF.replace("text::", "replace(text, chr(10), '')::")}
              ELSE {_LEAF} END AS checked
  FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
             count(*) OVER (PARTITION BY source) AS c FROM e),
own_0 AS (SELECT source AS k, 0::BIGINT AS l, i, c, leaf AS d FROM p),{_tree("own")},
sub AS (SELECT k AS source, d AS subroot, row_number() OVER (ORDER BY k NULLS FIRST) - 1 AS i, count(*) OVER () AS c
        FROM own_t WHERE c = 1),
up_0 AS (SELECT 0 AS k, 0::BIGINT AS l, i, c, subroot AS d FROM sub),{_tree("up")},
path(doc_id, source, pos, l, i, f, x) AS (
  SELECT doc_id, source, i AS pos, 0::BIGINT AS l, i, checked AS f, '' AS x FROM p UNION ALL
  SELECT q.doc_id, q.source, q.pos, q.l + 1, q.i // 3, sha256(s.b || q.f || s.a), q.x || s.b || s.a
  FROM path q JOIN own_s s ON q.source IS NOT DISTINCT FROM s.k AND q.l = s.l AND q.i = s.i),
ends AS (SELECT doc_id, source, pos, arg_max(f, l) AS f, arg_max(x, l) AS x FROM path GROUP BY ALL),
path2(doc_id, source, pos, l, i, f, x) AS (
  SELECT e.doc_id, e.source, e.pos, 0::BIGINT AS l, sub.i, e.f, e.x FROM ends e JOIN sub ON e.source IS NOT DISTINCT FROM sub.source UNION ALL
  SELECT q.doc_id, q.source, q.pos, q.l + 1, q.i // 3, sha256(s.b || q.f || s.a), q.x || s.b || s.a
  FROM path2 q JOIN up_s s ON q.l = s.l AND q.i = s.i),
ends2 AS (SELECT doc_id, source, pos, arg_max(f, l) AS f, arg_max(x, l) AS x FROM path2 GROUP BY ALL),
top AS (SELECT d AS root FROM up_t WHERE c = 1)
SELECT p.doc_id, p.leaf, sub.subroot, top.root, sha256(z.x) AS proof_sha256, z.f AS folded_root, z.f = top.root AS verified
FROM p JOIN ends2 z ON p.source IS NOT DISTINCT FROM z.source AND p.i = z.pos
JOIN sub ON p.source IS NOT DISTINCT FROM sub.source CROSS JOIN top"""}
